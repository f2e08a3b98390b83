"""Nearest neighbours by inner product, with a vantage-point tree per shard.

Vectors are lifted by one coordinate, sqrt(m^2 - |v|^2) with m the largest norm of all, and queries by
a zero: the largest inner product is then the smallest Euclidean distance, a metric, which the trees
need.  Rows are dealt to shards by hash; each shard builds one tree over its distinct vectors.  Every query
visits every shard, in blocks, with the best 20 so far, and leaves out a subtree if the triangle
inequality says that it can hold nothing nearer.  `relax` tunes that: bounds are multiplied by it, so
above 1 more is pruned and something may be missed; 1 is exact, and is what the query uses.

How much that prunes depends on the vectors: near-isotropic ones in many dimensions, as the synthetic table's, have
all distances so close to each other that no bound leaves a subtree out; the README has figures.

Scores are plain sums of products in double precision, in the order of components, the same for equal vectors, so
ties are exact and go to the smaller id.  Equal vectors are one point of a tree; of such a point's rows only the
smallest ids can be among a query's nearest, and so only they are kept: as many as are asked for, and one
more for the query's own.

Edge cases: a vector that is null, empty, zero, of a length other than the most common, or holds a null
or non-finite component takes no part, nor does a row with a null id; rows of one id are candidates
each; a query's own id is no candidate; fewer candidates than asked for are all returned; an empty
table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from readloom.llm.scratch import Scratch
from readloom.llm.tables import table

NEAREST, EVERY, SHARD_ROWS, LEAF, QUERY_BLOCK = 20, 20, 16_384, 256, 512


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed in the order of the components: the same on every machine, and in SQL."""
    return np.cumsum(a * b, axis=1)[:, -1] if a.shape[1] else np.zeros(len(a))


class VantageTree:
    """A tree over distinct points: (vantage, radius, inside, outside), or a leaf's point numbers."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points = points
        self.leaf = leaf
        self.root = self._build(np.arange(len(points)), 1)

    def _build(self, at: np.ndarray, salt: int):
        if len(at) <= self.leaf:
            return at
        vantage = at[(salt * 2654435761) % len(at)]
        away = np.sqrt(((self.points[at] - self.points[vantage]) ** 2).sum(1))
        radius = float(np.median(away))
        near = away <= radius
        if near.all():  # too many at one distance to split
            return at
        return vantage, radius, self._build(at[near], 2 * salt), self._build(at[~near], 2 * salt + 1)


class _Best:
    """For a block of queries: the scores and ids of the best candidates so far, best first."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.scores = np.full((n, k), -np.inf)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)

    def offer(self, q: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Candidates: query, score and id of each."""
        some = np.unique(q)
        all_q = np.concatenate([np.repeat(some, self.k), q])
        all_scores, all_ids = np.concatenate([self.scores[some].ravel(), scores]), np.concatenate([self.ids[some].ravel(), ids])
        order = np.lexsort((all_ids, -all_scores, all_q))
        ranked = all_q[order]
        first = np.searchsorted(ranked, some)
        top = order[(first[:, None] + np.arange(self.k)).ravel()]
        self.scores[some], self.ids[some] = all_scores[top].reshape(-1, self.k), all_ids[top].reshape(-1, self.k)


class Shard:
    """The tree of one shard, and the rows of its points."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, largest: float, k: int, leaf: int = LEAF):
        _, first, which = np.unique(vectors.view(np.dtype((np.void, vectors.shape[1] * 8))).ravel(), return_index=True, return_inverse=True)
        order = np.lexsort((ids, which))
        rank = np.arange(len(ids)) - np.searchsorted(which[order], which[order])
        order = order[rank <= k]
        self.ids = ids[order]
        self.begin = np.searchsorted(which[order], np.arange(len(first) + 1))
        self.vectors = vectors[first]
        norms = np.einsum("ij,ij->i", self.vectors, self.vectors)
        self.height = np.sqrt(np.maximum(largest * largest - norms, 0))
        self.largest, self.k = largest, k
        self.products = 0  # query-point products that searches have done in leaves
        self.tree = VantageTree(np.concatenate([self.vectors, self.height[:, None]], 1), leaf)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, relax: float = 1.0) -> _Best:
        best = _Best(len(queries), self.k)
        squared = np.einsum("ij,ij->i", queries, queries)
        slack = 1e-7 * (self.largest + np.sqrt(squared).max(initial=0))
        margin = 1e-9 * (1 + self.largest * np.sqrt(squared).max(initial=0))
        flat = np.concatenate([queries, np.zeros((len(queries), 1))], 1)

        def reach(q: np.ndarray) -> np.ndarray:
            """Distance of each query's worst kept candidate."""
            worst = best.scores[q, -1]
            return np.where(np.isfinite(worst), np.sqrt(np.maximum(squared[q] + self.largest**2 - 2 * np.where(np.isfinite(worst), worst, 0), 0)), np.inf)

        def visit(node, q: np.ndarray) -> None:
            if not len(q):
                return
            if not isinstance(node, tuple):
                # Matrix products are fast but may round equal vectors apart, so they only choose, with
                # slack, whose scores are then summed plainly.
                rough = queries[q] @ self.vectors[node].T
                least = best.scores[q, -1]
                if len(node) > self.k + 1:
                    least = np.maximum(least, np.partition(rough, len(node) - self.k - 1, axis=1)[:, len(node) - self.k - 1])
                i, j = np.nonzero(rough >= (least - margin)[:, None])
                self.products += rough.size
                if not len(i):
                    return
                point = node[j]
                scores = dots(queries[q[i]], self.vectors[point])
                copies = self.begin[point + 1] - self.begin[point]
                pair = np.repeat(np.arange(len(i)), copies)
                ids = self.ids[np.repeat(self.begin[point] - np.cumsum(copies) + copies, copies) + np.arange(len(pair))]
                asked = q[i[pair]]
                other = ids != query_ids[asked]
                best.offer(asked[other], scores[pair][other], ids[other])
                return
            vantage, radius, inside, outside = node
            away = np.sqrt(((flat[q] - self.tree.points[vantage]) ** 2).sum(1))
            within = away <= radius
            for first, second, side in ((inside, outside, within), (outside, inside, ~within)):
                mine, gap = q[side], np.abs(away[side] - radius)
                visit(first, mine)
                visit(second, mine[gap * relax <= reach(mine) + slack])

        visit(self.tree.root, np.arange(len(queries)))
        return best


def _valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that take part, their vectors packed as doubles, with length and squared norm."""
    for batch in batches:
        ids, packed, sizes, norms = [], [], [], []  # packed_id: as the shards read it
        for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("embedding")):
            if i is None or not v.is_valid or v.values.null_count or not len(v.values):
                continue
            x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
            if np.isfinite(x).all() and x.any():
                ids.append(i)
                packed.append(x.tobytes())
                sizes.append(len(x))
                norms.append(float(x @ x))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([np.int64(i).tobytes() for i in ids], pa.binary()), pa.array(packed, pa.binary()), pa.array(sizes, pa.int64()), pa.array(norms, pa.float64())], ["vec_id", "packed_id", "vector", "size", "norm"])


def _pack_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, QUERY_BLOCK):
            x = batch.slice(i, QUERY_BLOCK)
            ids = np.array(x.column("vec_id").to_pylist(), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([ids.tobytes()], pa.binary()), pa.array([b"".join(x.column("vector").to_pylist())], pa.binary())], ["ids", "vectors"])


def _search(largest: float, size: int, k: int, relax: float):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = shard = None
        rows: list[tuple[bytes, bytes]] = []
        for batch in batches:
            for r in batch.to_pylist():
                if r["shard"] != at:
                    at, shard, rows = r["shard"], None, []
                if r["kind"] == 0:  # rows come before queries
                    rows.append((r["ids"], r["vectors"]))
                    continue
                if shard is None:
                    if not rows:
                        continue
                    ids = np.frombuffer(b"".join(x for x, _ in rows), np.int64)
                    shard = Shard(ids, np.frombuffer(b"".join(x for _, x in rows), np.float64).reshape(len(ids), size), largest, k)
                    rows = []
                ids = np.frombuffer(r["ids"], np.int64)
                best = shard.search(ids, np.frombuffer(r["vectors"], np.float64).reshape(len(ids), size), relax)
                q, c = np.nonzero(np.isfinite(best.scores))
                yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(best.ids[q, c]), pa.array(best.scores[q, c])], ["query_id", "vec_id", "score"])

    return work


def nearest(vectors: DataFrame, *, every: int = EVERY, k: int = NEAREST, relax: float = 1.0, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) for each row whose vec_id is divisible by `every`."""
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    scratch = Scratch(spark, "vectors")
    valid = scratch.save(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(_valid, "vec_id long, packed_id binary, vector binary, size long, norm double"), "valid")
    stats = valid.groupBy("size").agg(F.count("*").alias("n"), F.max("norm").alias("norm")).sort(F.desc("n"), "size").first()
    if stats is None:
        return spark.createDataFrame([], schema)
    same = valid.filter(F.col("size") == stats["size"])
    shards = -(-stats["n"] // shard_rows)
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    rows = same.select(shard.alias("shard"), F.lit(0).alias("kind"), F.col("packed_id").alias("ids"), F.col("vector").alias("vectors"))
    asked = same.filter(F.col("vec_id") % every == 0).select("vec_id", "vector").mapInArrow(_pack_queries, "ids binary, vectors binary")
    asked = asked.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"), "ids", "vectors")
    dealt = rows.union(asked).repartitionById(int(shards), F.col("shard")).sortWithinPartitions("shard", "kind")
    found = dealt.mapInArrow(_search(stats["norm"] ** 0.5, stats["size"], k, relax), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_vp_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


QUERIES = {"op9_vp_nearest": op9_vp_nearest}
