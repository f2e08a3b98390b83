"""Cutting sequences into reads (fixed length) and contigs (variable length), under per-genome budgets.

Input: genomes with genome_id, seq and whatever else; a nullable column `read_limit` bounds the
candidate positions of a genome, before any filter.  Output: the genome's columns but seq, with
read_id, chunk_idx, start, end (0-based, half-open), kind and the piece as seq.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readloom import rng

#: Reads of the nested blocks that sequences are cut into first: substring counts characters from its text's start.
READS_PER_BLOCK = (256, 16)


def _limit(df: DataFrame, n):
    return F.least(n, F.col("read_limit")) if "read_limit" in df.columns else n  # least() skips nulls


def fixed_reads(genomes: DataFrame, length: int = 250, prefix: str = "_read_") -> DataFrame:
    """Non-overlapping windows of one length from position 0; the remainder is dropped."""
    if length < 1:
        raise ValueError("the read length must be at least 1")
    others = [c for c in genomes.columns if c not in ("seq", "read_limit")]
    n = _limit(genomes, F.floor(F.length("seq") / length).cast("long"))
    cut = genomes.withColumn("_n", n).filter("_n > 0").select(*others, "_n", F.lit(0).cast("long").alias("_base"), "seq")
    for per in READS_PER_BLOCK:
        cut = cut.select(*others, "_n", "_base", "seq", F.explode(F.expr(f"sequence(0L, (_n - 1) div {per})")).alias("_block"))
        first, span = F.col("_block") * per, per * length
        cut = cut.select(*others, F.least(F.col("_n") - first, F.lit(per)).alias("_n"), (F.col("_base") + first).alias("_base"), F.substring("seq", (first * length + 1).cast("int"), F.lit(span)).alias("seq"))
    reads = cut.select(*others, "_base", "seq", F.explode(F.expr("sequence(0L, _n - 1)")).alias("_i"))
    reads = reads.select(*others, (F.col("_base") + F.col("_i")).alias("chunk_idx"), "_i", "seq")
    at = (F.col("_i") * length + 1).cast("int")
    return reads.select(
        *others, F.concat(F.col("genome_id").cast("string"), F.lit(prefix), F.col("chunk_idx").cast("string")).alias("read_id"), "chunk_idx",
        (F.col("chunk_idx") * length).alias("start"), ((F.col("chunk_idx") + 1) * length).alias("end"), F.lit("read").alias("kind"), F.substring("seq", at, F.lit(length)).alias("seq"),
    )


def variable_contigs(genomes: DataFrame, min_length: int, max_length: int, seed: int = 42) -> DataFrame:
    """Contiguous pieces of lengths drawn from min..max; the last is clipped and kept if min_length long.

    The k-th length is a function of (seed, genome_id, k), and starts are prefix sums of lengths, over
    narrow rows: the sequences are joined to them afterwards.
    """
    if not 1 <= min_length <= max_length:
        raise ValueError("lengths must satisfy 1 <= min_length <= max_length")
    others = [c for c in genomes.columns if c not in ("seq", "read_limit")]
    most = _limit(genomes, F.ceil(F.length("seq") / min_length).cast("long"))
    sized = genomes.select("genome_id", F.length("seq").cast("long").alias("total"), most.alias("n")).filter("n > 0")
    drawn = sized.select("genome_id", "total", F.explode(F.expr("sequence(0L, n - 1)")).alias("chunk_idx"))
    span = F.lit(min_length) + F.floor(rng.draw(rng.key_of(seed, "genome_id", "chunk_idx")) * (max_length - min_length + 1))
    before = Window.partitionBy("genome_id").orderBy("chunk_idx").rowsBetween(Window.unboundedPreceding, -1)
    placed = drawn.withColumn("span", span.cast("long")).withColumn("start", F.coalesce(F.sum("span").over(before), F.lit(0).cast("long")))
    placed = placed.withColumn("end", F.least(F.col("start") + F.col("span"), F.col("total"))).filter(F.col("end") - F.col("start") >= min_length)
    pieces = placed.select("genome_id", "chunk_idx", "start", "end").join(genomes.select(*others, "seq"), "genome_id")
    return pieces.select(
        *others, F.concat(F.col("genome_id").cast("string"), F.lit("_contig_"), F.col("chunk_idx").cast("string")).alias("read_id"), "chunk_idx", "start", "end", F.lit("contig").alias("kind"),
        F.substring("seq", (F.col("start") + 1).cast("int"), (F.col("end") - F.col("start")).cast("int")).alias("seq"),
    )


def extra_pool(records: DataFrame, length: int, limit: int | None = None) -> DataFrame:
    """Reads of every record of a multi-record pool, named extra_viral_{record}; each record has its own budget."""
    named = records.withColumn("genome_id", F.concat(F.lit("extra_viral_"), F.col("record_idx").cast("string")))
    if limit is not None:
        named = named.withColumn("read_limit", F.lit(limit).cast("long"))
    return fixed_reads(named, length)


def abundance(reads: DataFrame) -> DataFrame:
    """(genome_id, read_count, proportion), the ground truth of a data set."""
    counts = reads.groupBy("genome_id").agg(F.count("*").alias("read_count"))
    total = counts.agg(F.sum("read_count").alias("total"))  # one row
    return counts.crossJoin(F.broadcast(total)).select("genome_id", "read_count", (F.col("read_count") / F.col("total")).alias("proportion"))
