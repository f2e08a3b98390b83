"""Tables kept for a while in the folder that all machines share.

Each table is written as Parquet and read again: that cuts the lineage, survives lost executors,
and lets Spark drop the shuffle files of what made it as soon as it is written.  The folder is the session's
spark.checkpoint.dir; only where that is unset (as in tests) a local temporary folder is used.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        folder = "file://" + tempfile.mkdtemp(prefix="readloom-")
    return folder.rstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


#: Whether Spark removes an action's shuffle files when the action ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Actions in this block leave no shuffle files behind."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


class Scratch:
    """Named tables in one folder of an operator's run; close() leaves only those named."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/readloom-{name}-{uuid.uuid4().hex[:12]}"
        self.made: list[str] = []
        atexit.register(self._at_exit)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        where = f"{self.path}/{name}"
        with shuffles_removed(self.spark):
            df.write.mode("overwrite").parquet(where)
        self.made.append(name)
        schema = df.schema
        return self.spark.read.schema(schema).parquet(where)

    def drop(self, *names: str) -> None:
        for name in names:
            if name in self.made:
                delete(self.spark, f"{self.path}/{name}")
                self.made.remove(name)

    def close(self, *but: str) -> None:
        self.drop(*[x for x in self.made if x not in but])

    def _at_exit(self) -> None:
        with contextlib.suppress(Exception):
            delete(self.spark, self.path)
