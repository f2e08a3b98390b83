"""Turns of conversations, numbered in their order without one task for each conversation.

Rows are sorted by ranges of (conv_id, turn, role, text), so that a conversation of any length lies over as many partitions
as its rows need.  Each task numbers the rows of a conversation that it holds; only conversations that go on over a
partition's end, fewer than there are partitions, need the sums of their earlier parts added.

Nulls: a null turn comes first, a null role or text is empty; rows of a null conv_id are a conversation of their own.  Ties in turn
go by role, then text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readloom.llm.scratch import Scratch


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) alone, nulls made empty."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role"), text("text"))


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, before, n, chars = TaskContext.get().partitionId(), object(), 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column("conv_id").to_pylist()
        new = np.array([a != b for a, b in zip(ids, [before, *ids])])
        at = np.arange(len(ids))
        first = np.maximum.accumulate(np.where(new, at, 0))
        total = np.concatenate([[0], np.cumsum(pc.utf8_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64))])
        goes_on = ~np.maximum.accumulate(new)  # rows of the conversation that the last batch ended in
        i, end = at - first + np.where(goes_on, n, 0), total[1:] - total[first] + np.where(goes_on, chars, 0)
        before, n, chars = ids[-1], int(i[-1]) + 1, int(end[-1])
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(np.full(len(ids), part)), pa.array(i), pa.array(end), batch.column("role"), batch.column("text")], ["conv_id", "part", "i", "chars", "role", "text"])


def numbered(turns: DataFrame, scratch: Scratch, name: str = "turns") -> DataFrame:
    """(conv_id, pos, end, role, text): a turn's number from 0, and the code points of the texts up to its end."""
    dealt = turns.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 16)).sortWithinPartitions("conv_id", "turn", "role", "text")
    rows = scratch.save(dealt.mapInArrow(_numbered, "conv_id long, part long, i long, chars long, role string, text string"), name)
    parts = rows.groupBy("conv_id", "part").agg((F.max("i") + 1).alias("n"), F.max("chars").alias("chars"))
    several = parts.groupBy("conv_id").agg(F.count("*").alias("parts")).filter("parts > 1").select(F.col("conv_id").alias("of"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # At most two rows for each partition.
    bases = parts.join(several, parts.conv_id.eqNullSafe(F.col("of"))).select(F.col("conv_id").alias("of"), F.col("part").alias("in"), F.sum("n").over(earlier).alias("base"), F.sum("chars").over(earlier).alias("base_chars"))
    bases = scratch.save(bases.filter("base is not null"), f"{name}-bases")
    full = rows.join(F.broadcast(bases), rows.conv_id.eqNullSafe(F.col("of")) & (F.col("part") == F.col("in")), "left")
    return full.select("conv_id", (F.col("i") + F.coalesce("base", F.lit(0))).alias("pos"), (F.col("chars") + F.coalesce("base_chars", F.lit(0))).alias("end"), "role", "text")
