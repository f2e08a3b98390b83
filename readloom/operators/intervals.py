"""Interval sets: merging, masking reads, exporting the masked regions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def merge_intervals(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """Unions of overlapping or touching intervals [start, end) of the same keys."""
    order = Window.partitionBy(*keys).orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = intervals.distinct().withColumn("opens", (reach.isNull() | (F.col("start") > reach)).cast("int"))
    numbered = opened.withColumn("island", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("island")


def mask_reads(reads: DataFrame, intervals: DataFrame, keys: list[str], bin_size: int = 10_000) -> DataFrame:
    """Reads that overlap no interval of the same keys (half-open).

    Both sides are dealt by bins of positions, so that one genome with many reads and intervals isn't
    one range join: an interval stands in each bin it touches, and so does a read.
    """
    bins = lambda: F.explode(F.expr(f"sequence(start div {bin_size}, greatest(start, end - 1) div {bin_size})"))
    named = intervals.select(*[F.col(k).alias(f"iv_{k}") for k in keys], F.col("start").alias("iv_start"), F.col("end").alias("iv_end"), bins().alias("iv_bin"))
    same = [F.col(k) == F.col(f"iv_{k}") for k in keys]
    placed = reads.withColumn("bin", bins())
    # A read in one bin, as most are, is decided there; one that spans several goes if any of them hits.
    cond = (F.col("bin") == F.col("iv_bin")) & (F.col("start") < F.col("iv_end")) & (F.col("end") > F.col("iv_start"))
    for s in same:
        cond = cond & s
    hit = placed.join(named, cond, "left_semi").select(*keys, "read_id").distinct()
    return reads.join(hit, [*keys, "read_id"], "left_anti")


def export_regions(genomes: DataFrame, intervals: DataFrame, keys: list[str], min_length: int = 200) -> DataFrame:
    """(region_id, seq): the masked regions, named by genome, record and 1-based inclusive place."""
    long = intervals.filter((F.col("end") > F.col("start")) & (F.col("end") - F.col("start") >= min_length))
    name = F.concat(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]), F.lit("|"), (F.col("start") + 1).cast("string"), F.lit("-"), F.col("end").cast("string"))
    piece = F.substring("seq", (F.col("start") + 1).cast("int"), (F.col("end") - F.col("start")).cast("int"))
    return long.join(genomes.select(*keys, "seq"), keys).select(name.alias("region_id"), piece.alias("seq"))


def hits_to_intervals(hits: DataFrame) -> DataFrame:
    """Merged query intervals of alignment hits with 1-based inclusive qstart, qend in either order."""
    spans = hits.select("qseqid", (F.least("qstart", "qend") - 1).cast("long").alias("start"), F.greatest("qstart", "qend").cast("long").alias("end"))
    return merge_intervals(spans, ["qseqid"])
