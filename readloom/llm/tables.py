"""How the operators read their input: the columns they need, whatever else a table holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ids_and_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) alone; nothing else of the table is read."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts: what the number of buckets and partitions is taken from."""
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def power_of_two(x: float) -> int:
    return 1 << max(0, int(max(1.0, x) - 1).bit_length())
