"""How many reads each genome may give: a nullable column `read_limit`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom import rng


def genome_stats(records: DataFrame, length: int = 250, min_length: int | None = None, max_length: int | None = None) -> DataFrame:
    """(genome_id, total_bases, max_reads) over all records of each genome."""
    if min_length is not None and max_length is not None:
        length = (min_length + max_length) // 2
    totals = records.groupBy("genome_id").agg(F.sum(F.length("seq")).cast("long").alias("total_bases"))
    return totals.withColumn("max_reads", F.expr(f"total_bases div {length}"))


def balanced(stats: DataFrame) -> DataFrame:
    """stats with read_limit: the smallest capacity of all genomes."""
    least = stats.agg(F.min("max_reads").alias("read_limit"))  # one row
    return stats.crossJoin(F.broadcast(least))


def weighted(genomes: DataFrame, base: int, weights: dict[str, float]) -> DataFrame:
    """read_limit: base times the category's weight, rounded down, and at least 1; weight 1 for others."""
    table = F.create_map(*[F.lit(x) for kv in sorted(weights.items()) for x in kv]) if weights else None
    weight = F.coalesce(F.try_element_at(table, F.col("category")), F.lit(1.0)) if weights else F.lit(1.0)
    return genomes.withColumn("read_limit", F.greatest(F.lit(1), F.floor(F.lit(float(base)) * weight)).cast("long"))


def exponential(genomes: DataFrame, base: int, seed: int = 42) -> DataFrame:
    """read_limit: base times an exponential weight, scaled to the mean 1, and at least 1.

    The weights' sum is taken in fixed point, so that it doesn't depend on the order of summation.
    """
    drawn = genomes.withColumn("w", F.round(-F.log(F.lit(1.0) - rng.draw(rng.key_of(seed, "genome_id"))) * 1e6).cast("long"))
    total = drawn.agg(F.sum("w").alias("w_sum"), F.count("*").alias("n"))  # one row
    limit = F.when(F.col("w_sum") > 0, F.expr(f"greatest(1L, ({int(base)}L * w * n) div w_sum)")).otherwise(F.lit(base).cast("long"))
    return drawn.crossJoin(F.broadcast(total)).withColumn("read_limit", limit).drop("w", "w_sum", "n")


def by_taxonomy(stats: DataFrame, taxonomy: DataFrame, of_category: str = "virus") -> DataFrame:
    """Budgets that give each taxonomic group the same number of reads.

    stats: genome_id, category, max_reads and, if there is one, read_limit.  The target is the smallest group's
    capacity; it is shared evenly within a group, at least one read each and never above a genome's capacity.
    Genomes without a group are 'unknown'.  If some group has no capacity, nothing is balanced.  Other
    categories keep their read_limit.
    """
    if "read_limit" not in stats.columns:
        stats = stats.withColumn("read_limit", F.lit(None).cast("long"))
    named = stats.join(taxonomy.select("genome_id", "group"), "genome_id", "left").withColumn("group", F.coalesce("group", F.lit("unknown")))
    groups = named.filter(F.col("category") == of_category).groupBy("group").agg(F.sum("max_reads").alias("capacity"), F.count("*").alias("members"))
    target = groups.agg(F.min("capacity").alias("target"))  # one row
    share = groups.crossJoin(F.broadcast(target)).filter("target > 0").select("group", F.expr("greatest(1L, target div members)").alias("share"))
    mine = (F.col("category") == of_category) & F.col("share").isNotNull()
    return named.join(share, "group", "left").withColumn("read_limit", F.when(mine, F.least("max_reads", "share")).otherwise(F.col("read_limit"))).drop("share")
