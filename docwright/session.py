"""Session used by the benchmark and the tests; a cluster brings its own."""

from pyspark.sql import SparkSession


def local_session(cpus: int, memory: str = "12g") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("docwright")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
