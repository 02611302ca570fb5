"""Tables that are replaced as a whole, in versions.

A version is a folder of its own. It counts from the moment its row stands in the table of commits, which Spark appends as a whole;
a run that is lost before leaves a folder that nothing names, and readers keep the version before. So a table can be read and
replaced in one job. One writer at a time.
"""

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

COMMIT = "version long, path string, writer string, batch_id long"


@dataclass
class Snapshots:
    """A versioned table in a shared folder. `schema` is what it holds, and what is read before the first version."""

    spark: SparkSession
    folder: str
    schema: str

    def commits(self) -> DataFrame:
        path = f"{self.folder}/commits"
        self.spark.createDataFrame([], COMMIT).write.mode("ignore").parquet(path)
        return self.spark.read.schema(COMMIT).parquet(path)

    def head(self) -> Row | None:
        """The newest commit."""
        return self.commits().orderBy(F.desc("version")).first()

    def of_batch(self, writer: str, batch_id: int) -> Row | None:
        """The commit that a writer made for one of its batches."""
        return self.commits().where((F.col("writer") == writer) & (F.col("batch_id") == batch_id)).orderBy(F.desc("version")).first()

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, of the newest one by default."""
        commit = self.head() if version is None else self.commits().where(F.col("version") == version).first()
        if commit is None:
            if version is not None:
                raise ValueError(f"there is no version {version} in {self.folder}")
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(commit["path"])

    def replace(self, frame: DataFrame, writer: str | None = None, batch_id: int | None = None) -> int:
        """Stores the frame, which may read this table, as the next version. A batch that a writer has stored before changes nothing."""
        if writer is not None and (done := self.of_batch(writer, batch_id)):
            return done["version"]
        path = f"{self.folder}/data/{uuid.uuid4().hex}"
        names = self.spark.createDataFrame([], self.schema).schema
        frame.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in names]).write.parquet(path)
        head = self.head()
        version = head["version"] + 1 if head else 1
        self.spark.createDataFrame([(version, path, writer, batch_id)], COMMIT).coalesce(1).write.mode("append").parquet(f"{self.folder}/commits")
        return version
