"""Lookups by key: taxonomy, lineage, what a cache lacks, concatenated references."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readloom.scratch import Scratch

#: Ranks that stand in for a missing one, in this order.
FALLBACK_RANKS = ["realm", "kingdom", "order", "family", "subfamily"]


def with_group(genomes: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """genomes with group, 'unknown' where the taxonomy has none."""
    return genomes.join(taxonomy.select("genome_id", "group"), "genome_id", "left").withColumn("group", F.coalesce("group", F.lit("unknown")))


def lineage_group(lineages: DataFrame, level: str) -> DataFrame:
    """(taxid, group) from (taxid, rank, name): the name at the level, else at the first rank that stands in."""
    order = F.when(F.col("rank") == level, 0)
    for i, r in enumerate(FALLBACK_RANKS):
        order = order.when(F.col("rank") == r, i + 1)
    return lineages.withColumn("o", order).filter("o is not null").groupBy("taxid").agg(F.min_by("name", F.struct("o", "name")).alias("group"))


def accession_groups(accessions: DataFrame, taxids: DataFrame, groups: DataFrame) -> DataFrame:
    """(accession, group) over two keyed lookups, 'unknown' where either has none."""
    found = accessions.join(taxids.select("accession", "taxid"), "accession", "left").join(groups.select("taxid", "group"), "taxid", "left")
    return found.select("accession", F.coalesce("group", F.lit("unknown")).alias("group"))


def missing(wanted: DataFrame, present: DataFrame, by: str = "accession") -> DataFrame:
    """What is wanted and not present."""
    return wanted.select(by).distinct().join(present.select(by), by, "left_anti")


def running_base(counts: DataFrame, key: str, n: str) -> DataFrame:
    """(key, base): the sum of n over all smaller keys, by counts of ranges of keys: no order in one task.

    Keys are dealt to ranges, each range's sum is one row, and the sums before a range are added to the sums in it.
    """
    spark = counts.sparkSession
    parts = spark.sparkContext.defaultParallelism
    dealt = counts.select(key, n).repartitionByRange(parts, key).withColumn("_part", F.spark_partition_id())
    # The ranges are sampled anew with each run, so they are kept.
    dealt = Scratch(spark, "bases").save(dealt, "dealt")
    sums = dealt.groupBy("_part").agg(F.sum(n).alias("_sum"))  # a row for each range
    before = sums.select("_part", F.coalesce(F.sum("_sum").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    own = F.coalesce(F.sum(n).over(Window.partitionBy("_part").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return dealt.withColumn("_own", own).join(F.broadcast(before), "_part").select(key, (F.col("_before") + F.col("_own")).alias("base"))


def concatenated(records: DataFrame) -> DataFrame:
    """(name, seq): records of all genomes with a running number in their names, as one reference.

    Numbers run over (genome_id, record_idx): a genome's first one from sums of genomes' counts of records.
    """
    counts = records.groupBy("genome_id").agg(F.count("*").alias("n"))
    own = F.row_number().over(Window.partitionBy("genome_id").orderBy("record_idx")) - 1
    numbered = records.withColumn("own", own).join(running_base(counts, "genome_id", "n"), "genome_id")
    return numbered.select(F.concat_ws("_", "genome_id", (F.col("base") + F.col("own")).cast("string"), "record_id").alias("name"), "seq")


def concatenated_with_lengths(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((name, seq), (name, length)) of genomes of exactly one record each; ValueError if one has another number."""
    odd = records.groupBy("genome_id").agg(F.count("*").alias("n")).filter("n <> 1")
    if n := odd.count():
        raise ValueError(f"{n} genomes don't have exactly one record, such as {[r['genome_id'] for r in odd.sort('genome_id').limit(5).collect()]}")
    named = records.select(F.col("genome_id").cast("string").alias("name"), "seq")
    return named, named.select("name", F.length("seq").cast("long").alias("length"))


def check_layout(genomes: DataFrame) -> None:
    """ValueError unless there is a viral and a non-viral genome."""
    r = genomes.agg(F.count_if(F.col("category") == "virus").alias("viral"), F.count_if(F.col("category") != "virus").alias("other")).first()
    if not r["viral"] or not r["other"]:
        raise ValueError(f"need at least one viral and one other genome; found {r['viral']} and {r['other']}")
