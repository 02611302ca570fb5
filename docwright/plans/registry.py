"""The registered queries and the SQL each is compared with."""

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    """Register fn(spark, folder) -> DataFrame under a name, with its SQL if it has one."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add
