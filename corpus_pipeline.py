"""A corpus pipeline: quality selection, near-duplicate and substring removal, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each one's result as Parquet in
the shared folder and reads it as the next one's docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm import bpe, decontaminate, near_dedup, quality, substring_dedup
from readloom.llm.scratch import Scratch
from readloom.llm.tables import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Percent of shingles that near copies share at least.
SIMILARITY = 80


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier selects; it learns from the labelled ones among docs."""
    return quality.select_quality(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: its smallest doc_id, or of equal ids one row.

    Groups are of five-word shingles at a similarity of SIMILARITY percent or more.  Of rows with one doc_id the one
    that is smallest in its columns stays, so retries agree.  Rows with a null doc_id belong to no group and stay.
    """
    groups = near_dedup.near_duplicates(docs, percent=SIMILARITY)
    dropped = groups.filter(~F.col("kept")).select("doc_id").distinct()
    left = docs.join(dropped, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    several = left.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    chosen = left.join(several, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(row).alias("row")).select("row.*")
    return left.join(several, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(chosen)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated passages; a text that loses words has the others joined by one space.

    Documents that lose all their words go; others keep their text as it was.  n_chars is counted again.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    stripped = substring_dedup.remove_repeats(docs, carry=others)
    left = stripped.filter("n_removed = 0 or n_removed < n_words")
    lost = F.col("n_removed") > 0
    made = {"doc_id": F.col("doc_id"), "text": F.when(lost, F.col("kept_text")).otherwise(F.col("text"))}
    made |= {c: F.col(f"more.`{c}`") for c in others}
    if "n_chars" in others:
        made["n_chars"] = F.when(lost, F.length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(made["n_chars"])
    return left.select(*[made[c].alias(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text."""
    return bpe.encode_decode(docs, bpe.tokenizer_path("word_bpe_49k.json"), with_texts=False)


STAGES = [
    ("quality classifier", select_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("substring dedup", drop_repeated_passages),
    ("benchmark decontamination", drop_contaminated),
    ("BPE encoding and decoding", encode),
]

#: SQL can't express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    before = None
    for i, (_, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage-{i}")
        if before:
            scratch.drop(before)
        before = f"stage-{i}"
    return docs
