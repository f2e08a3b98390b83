"""Filter interaction audit by permutation-trie execution.

All orders of n filters are the leaves of a trie: a node is a prefix of filters that have been applied, an edge applies one
more.  What survives a prefix doesn't depend on its order, so all prefixes of one set share a state.

1. Each filter's verdict on each document is found once, in one pass over the texts; that a text repeats an earlier one comes from digests.
2. The trie is walked depth-first.  At a state met for the first time the survivors, a persisted DataFrame of verdicts, are
   counted: for each filter left, how many documents it removes here, in each part.  Then each filter is applied to the
   survivors and the next state entered; a state met again is not.  A state's survivors go when its subtree is done, so at
   most as many DataFrames are held at once as there are filters.  So 2^n states and n 2^(n-1) edges are run for the n! orders.
3. The report reads the edges of each order's path.

Edge cases: a null text is empty; a null part is the empty string; a document counts as marked if any row of its id in the marks'
table says so; repeated rows are documents of their own, and only a smaller id makes a text a repetition; a null id
is neither smaller nor larger than any; very long texts are read whole; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm.scratch import Scratch
from readloom.llm.tables import table
from readloom.llm.words import SPACED, WordTable, as_bytes, row_slices

LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SIGNS = 100, 80, 10, b"#$%&*|"

# --- verdicts -------------------------------------------------------------------------------------

_signs = np.isin(np.arange(256), list(SIGNS))


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many bytes of each row are flagged."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def text_verdicts(column) -> dict[str, np.ndarray]:
    """Whether each text fails A (few words), B (few distinct ones), C (many capitals), D (signs)."""
    raw, offsets = as_bytes(column)
    words = WordTable(raw, offsets, SPACED)
    row = np.repeat(np.arange(len(offsets) - 1), words.counts)
    order = np.lexsort((words.hash, row))
    h, r = words.hash[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    distinct = np.bincount(r[new], minlength=len(offsets) - 1)
    points = _per_row((raw & 0xC0) != 0x80, offsets)
    return {
        "A": words.counts < LEAST_WORDS,
        "B": 100 * distinct < LEAST_DISTINCT * words.counts,
        "C": 100 * _per_row((raw >= 65) & (raw <= 90), offsets) > MOST_CAPITALS * points,
        "D": _per_row(_signs[raw], offsets) > 0,
    }


def _verdicts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in row_slices(batch, "text"):
            found = text_verdicts(piece.column("text"))
            raw, offsets = as_bytes(piece.column("text"))
            data = memoryview(np.ascontiguousarray(raw))
            digests = [hashlib.sha256(data[a:b]).digest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            columns = [piece.column("doc_id"), piece.column("part"), pa.array(digests, pa.binary()), *[pa.array(v) for v in found.values()]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "digest", *found])


def document_verdicts(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """(part, A, B, C, D, E, good, toxic) of each document; E: its text is that of a smaller doc_id."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), F.col("text").cast("string").alias("text"))
    found = scratch.save(texts.mapInArrow(_verdicts, "doc_id long, part string, digest binary, A boolean, B boolean, C boolean, D boolean"), "verdicts")
    several = found.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("digest", "first")
    repeated = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    full = found.join(several, "digest", "left").withColumn("E", repeated).join(marks, "doc_id", "left")
    return full.select("part", *"ABCDE", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


# --- the trie -------------------------------------------------------------------------------------


def walk_orders(verdicts: DataFrame, filters: Sequence[str], marks: Sequence[str], scratch: Scratch, part: str = "part") -> DataFrame:
    """(part, state, filter, n, removed, <mark>_lost...): a row for each edge and part that has survivors there.

    verdicts: a boolean column for each filter (it fails) and mark.  state: the filters applied before, in their order in `filters`.
    """
    name = lambda state: "".join(f for f in filters if f in state)
    met: set[frozenset] = set()
    edges: list[DataFrame] = []

    def count(survivors: DataFrame, state: frozenset) -> None:
        """What each filter left removes here."""
        sums = [F.sum((F.col(f) & F.col(m) if m else F.col(f)).cast("long")).alias(f"{f}:{m}") for f in filters if f not in state for m in ("", *marks)]
        counted = survivors.groupBy(part).agg(F.count("*").alias("n"), *sums)
        each = [F.struct(F.lit(f).alias("filter"), F.col(f"`{f}:`").alias("removed"), *[F.col(f"`{f}:{m}`").alias(f"{m}_lost") for m in marks]) for f in filters if f not in state]
        edges.append(scratch.save(counted.select(part, F.lit(name(state)).alias("state"), "n", F.explode(F.array(*each)).alias("x")).select(part, "state", "n", "x.*"), f"edges-{name(state)}"))

    def enter(survivors: DataFrame, state: frozenset) -> None:
        met.add(state)
        count(survivors, state)
        for f in filters:
            after = state | {f}
            if f in state or after in met or len(after) == len(filters):
                continue
            left = survivors.filter(~F.col(f)).drop(f)
            if len(after) == len(filters) - 1:  # one edge is left, and is counted as it is read
                met.add(after)
                count(left, after)
            else:
                # Counting fills it; a lost executor's part of it is made again from the state before, at last from the written root.
                kept = left.persist(StorageLevel.MEMORY_AND_DISK)
                enter(kept, after)
                kept.unpersist()

    enter(scratch.save(verdicts.select(part, *filters, *marks), "root"), frozenset())
    scratch.drop("root")
    every = edges[0]
    for e in edges[1:]:
        every = every.unionByName(e)
    return scratch.save(every, "edges")


def order_report(edges: DataFrame, filters: Sequence[str], marks: Sequence[str], part: str = "part") -> DataFrame:
    """A row for each part, order and step: kept, removed, redundant, unique_fails, <mark>_lost..., shapley."""
    spark, n = edges.sparkSession, len(filters)
    steps = [("".join(o), i + 1, f, "".join(x for x in filters if x in o[:i])) for o in permutations(filters) for i, f in enumerate(o)]
    orders = spark.createDataFrame(steps, "filter_order string, step int, filter string, state string")
    weight = F.create_map(*[F.lit(x) for k in range(n) for x in (k, factorial(k) * factorial(n - 1 - k))])
    others = F.create_map(*[F.lit(x) for f in filters for x in (f, "".join(g for g in filters if g != f))])
    at = lambda of, value: F.coalesce(F.max(F.when(of, value)), F.lit(0))
    about = edges.groupBy(part, "filter").agg(
        at(F.col("state") == "", F.col("removed")).alias("fails"),
        at(F.col("state") == others[F.col("filter")], F.col("removed")).alias("unique_fails"),
        F.sum(F.col("removed") * weight[F.length("state")]).cast("long").alias("shapley"),
    )
    # A few hundred steps, for each part.
    full = about.join(F.broadcast(orders), "filter").join(edges, [part, "filter", "state"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return full.select(
        part, "filter_order", "step", zero(F.col("n") - F.col("removed")).alias("kept"), zero(F.col("removed")).alias("removed"), (F.col("fails") - zero(F.col("removed"))).alias("redundant"), "unique_fails",
        *[zero(F.col(f"{m}_lost")).alias(f"{m}_lost") for m in marks], "shapley",
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, filters, marks = Scratch(spark, "audit"), "ABCDE", ["good", "toxic"]
    verdicts = document_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), scratch)
    return order_report(walk_orders(verdicts, filters, marks, scratch), filters, marks)


QUERIES = {"op11_filter_audit": op11_filter_audit}
