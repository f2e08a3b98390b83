"""MinHash near-duplicate groups with min-max hashing, exact on full sets.

Each permutation of the shingle hashes gives two signature values, its minimum and its maximum, so
40 permutations give the 80 values that 20 bands of 4 take: a pair of similarity 0.85 shares no
band with probability (1 - 0.85^4)^20, about 4 in 10 million.

1. Documents with the same set become one class (its smallest doc_id); copies meet in no bucket.
2. Classes of one band bucket are linked to the bucket's most popular member (the one in the most
   crowded buckets, as the original of many copies is).  Pairs whose signatures' first bytes put them more
   than six deviations under the threshold go; the others are confirmed on full sets.
3. Buckets whose members still lie in several components are settled exactly: small ones by their
   pairs; in larger ones the members outside the bucket's largest component are compared with all, in blocks of
   bounded bytes, two a task, in which estimates order the pairs and a union-find skips those already joined; what is
   returned is at most a spanning forest.  Moved are the bucket's members once for each block of such outsiders.
4. Components of all confirmed links.

No bucket is capped or cut: every pair that shares a band is compared on its full sets or already
lies in one component.  Hashes have 64 bits; equal hashes are taken for equal shingles.

Edge cases: a null, empty or blank text has an empty set, is linked with nothing and kept; fewer
than k words make one shingle; rows of one doc_id are one node; rows with a null doc_id take no part
(component_id null, kept); an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm.components import connected_components
from readloom.llm.scratch import Scratch
from readloom.llm.tables import ids_and_texts, table
from readloom.llm.words import SPACED_LOWER, mix64, ngrams, odd_constants, read_words, row_slices

PERMUTATIONS, ROWS = 40, 4
#: Members of a bucket that are compared by pairs of rows; larger buckets go in blocks of so many, or so many bytes.
SMALL_BUCKET, BLOCK, BLOCK_BYTES = 6, 2048, 8 << 20
_mult, _add = odd_constants(PERMUTATIONS, 101), mix64(np.arange(PERMUTATIONS, dtype=np.uint64) + np.uint64(1001))


def shingle_sets(column, k: int = 5) -> Iterator[np.ndarray]:
    """For each row, its sorted distinct shingle hashes."""
    words = read_words(column, SPACED_LOWER)
    grams = ngrams(words.hash, k)
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        n = b - a
        if n >= k:
            yield np.unique(grams[a : b - k + 1])
        else:
            yield ngrams(words.hash[a:b], n, seed=n) if n else np.zeros(0, np.uint64)


def min_max(shingles: np.ndarray, permutations: int = PERMUTATIONS) -> np.ndarray:
    """2 x permutations values: the minimum, then the maximum, under each permutation."""
    mult, add = _mult[:permutations], _add[:permutations]
    low, high = np.full(permutations, np.iinfo(np.uint64).max, np.uint64), np.zeros(permutations, np.uint64)
    for i in range(0, len(shingles), 4096):
        h = np.multiply.outer(mult, shingles[i : i + 4096])
        h += add[:, None]
        np.minimum(low, h.min(1), out=low)
        np.maximum(high, h.max(1), out=high)
    return np.concatenate([low, high])


_band_steps = odd_constants(ROWS, 55)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A key for each band; the band's number is part of it."""
    rows = signature.reshape(-1, ROWS)
    return mix64((rows * _band_steps).sum(1) + np.arange(len(rows), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _signatures(k: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in row_slices(batch, "text"):
                size, one, two, bands, sketches = [], [], [], [], []
                for s in shingle_sets(piece.column("text"), k):
                    size.append(len(s))
                    one.append(mix64(s).sum(dtype=np.uint64) if len(s) else 0)
                    two.append(mix64(s ^ np.uint64(0x5555)).sum(dtype=np.uint64) if len(s) else 0)
                    signature = min_max(s)
                    sketches.append((signature >> np.uint64(56)).astype(np.uint8).tobytes())
                    bands.append(band_keys(signature) if len(s) else np.zeros(0, np.uint64))
                lengths = np.cumsum([0] + [len(b) for b in bands]).astype(np.int32)
                keys = pa.ListArray.from_arrays(pa.array(lengths), pa.array(np.concatenate(bands).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(size, pa.int64()), pa.array(np.array(one, np.uint64).view(np.int64)), pa.array(np.array(two, np.uint64).view(np.int64)), keys, pa.array(sketches, pa.binary())],
                    ["doc_id", "n_shingles", "set_a", "set_b", "bands", "sketch"],
                )

    return work


def _sets(k: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in row_slices(batch, "text"):
                sets = [s.tobytes() for s in shingle_sets(piece.column("text"), k)]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(sets, pa.binary())], ["id", "shingles"])

    return work


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 x intersection >= percent x union, of two sorted sets."""
    small, large = sorted((len(a), len(b)))
    if not small or 100 * small < percent * large:
        return False
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (small + large - common)


def _confirm(percent: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            read = lambda x: np.frombuffer(x.as_py(), np.uint64)
            keep = [linked(read(x), read(y), percent) for x, y in zip(batch.column("set_of_a"), batch.column("set_of_b"))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return work


def least_agreement(values: int, percent: int) -> int:
    """Six deviations under the values that a pair at the threshold agrees on."""
    p = percent / 100
    return max(1, int(values * p - 6 * (values * p * (1 - p)) ** 0.5))


def _likely(percent: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("sketch_a", "sketch_b"))
            yield batch.select(["a", "b"]).filter(pa.array((x == y).sum(1) >= least_agreement(x.shape[1], percent)))

    return work


def confirmed(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int, scratch: Scratch, name: str) -> DataFrame:
    """The pairs (a, b) that are linked on their full sets."""
    pairs = pairs.join(classes.select(F.col("id").alias("a"), F.col("sketch").alias("sketch_a")), "a").join(classes.select(F.col("id").alias("b"), F.col("sketch").alias("sketch_b")), "b")
    pairs = scratch.save(pairs.select("a", "b", "sketch_a", "sketch_b").mapInArrow(_likely(percent), "a long, b long").distinct(), name)
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_of_a"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_of_b"))
    # Sets are large and the pairs may be few or many: the same plan at every size, which AQE can split.
    sized = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").select("a", "b", "set_of_a", "set_of_b")
    small, large = F.least(F.length("set_of_a"), F.length("set_of_b")), F.greatest(F.length("set_of_a"), F.length("set_of_b"))
    return sized.filter(small * 100 >= large * percent).mapInArrow(_confirm(percent), "a long, b long")


class _Union:
    def __init__(self, labels):
        self.up = {x: x for x in labels}

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x


def block_links(ids: np.ndarray, labels: np.ndarray, sides: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Confirmed links between members of two blocks (or within one) that join different components.

    The likeliest pairs come first, so that most of the others are already joined when met.  A pair
    is left out by its sketch only where the estimate lies more than six deviations under percent.
    """
    order = np.argsort(sides, kind="stable")
    ids, labels, sides, sets = ids[order], labels[order], sides[order], [sets[i] for i in order]
    sketch = np.stack([(min_max(s, 32) >> np.uint64(48)).astype(np.uint16) for s in sets])
    size = np.array([len(s) for s in sets])
    least = least_agreement(64, percent)
    names, at = np.unique(labels, return_inverse=True)
    split = int((sides == 0).sum())
    crossing = split < len(ids)
    left, right, close = [], [], []
    for i in range(split if crossing else len(ids)):
        j0 = split if crossing else i + 1
        agree = (sketch[j0:] == sketch[i]).sum(1)
        near = np.flatnonzero((at[j0:] != at[i]) & (agree >= least) & (100 * np.minimum(size[j0:], size[i]) >= percent * np.maximum(size[j0:], size[i])))
        left.append(np.full(len(near), i, np.int32))
        right.append((near + j0).astype(np.int32))
        close.append(agree[near].astype(np.uint8))
    left, right = np.concatenate(left), np.concatenate(right)
    order = np.argsort(255 - np.concatenate(close), kind="stable")
    union, links = _Union(range(len(names))), []
    for lo in range(0, len(order), 1 << 14):
        # Pairs that are joined by now are left out at once.
        roots = np.array([union.root(x) for x in range(len(names))])
        some = order[lo : lo + (1 << 14)]
        some = some[roots[at[left[some]]] != roots[at[right[some]]]]
        for i, j in zip(left[some].tolist(), right[some].tolist()):
            x, y = union.root(int(at[i])), union.root(int(at[j]))
            if x != y and linked(sets[i], sets[j], percent):
                union.up[max(x, y)] = min(x, y)
                links.append((int(min(ids[i], ids[j])), int(max(ids[i], ids[j]))))
    return links


def _blocks(percent: int):
    def work(key, group):
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in group.column("shingles")]
        of = lambda c: group.column(c).to_numpy()
        links = block_links(of("id"), of("label"), of("side"), sets, percent)
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return work


def near_duplicates(docs: DataFrame, *, k: int = 5, percent: int = 85) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept (it is the smallest of its component)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "near")
    pairs = ids_and_texts(docs)
    rows = scratch.save(pairs.mapInArrow(_signatures(k), "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, sketch binary"), "rows")
    classes = scratch.save(rows.filter("n_shingles > 0 and doc_id is not null").groupBy("set_a", "set_b").agg(F.min("doc_id").alias("id"), F.max("n_shingles").alias("size"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "classes")

    keyed = classes.select("id", "size", F.explode("bands").alias("key"))
    crowds = keyed.groupBy("key").agg(F.count("*").alias("crowd")).filter("crowd > 1")
    members = scratch.save(keyed.join(crowds, "key"), "members")
    popular = members.groupBy("id").agg(F.sum("crowd").alias("fame"))
    heads = members.join(popular, "id").groupBy("key").agg(F.max(F.struct("fame", (-F.col("id")).alias("minus"))).alias("head")).select("key", (-F.col("head.minus")).alias("head"))
    stars = members.join(heads, "key").filter("id <> head").select(F.least("id", "head").alias("a"), F.greatest("id", "head").alias("b")).distinct()
    stars = scratch.save(stars, "stars")

    wanted = members.select(F.col("id").alias("doc_id")).distinct()
    sets = scratch.save(pairs.join(wanted.hint("merge"), "doc_id", "left_semi").mapInArrow(_sets(k), "id long, shingles binary"), "sets")
    links = scratch.save(confirmed(stars, classes, sets, percent, scratch, "likely-stars"), "links")
    labels = connected_components(links, scratch, "first")

    labelled = members.join(labels, members.id == labels.node, "left").select("key", "id", "crowd", "size", F.coalesce("label", "id").alias("label"))
    mixed = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("key")
    open_ = scratch.save(labelled.join(mixed, "key"), "open")
    scratch.drop("members", "first-0")
    few = open_.filter(F.col("crowd") <= SMALL_BUCKET)
    left, right = few.select("key", F.col("id").alias("a"), F.col("label").alias("label_a")), few.select("key", F.col("id").alias("b"), F.col("label").alias("label_b"))
    rest = left.join(right, "key").filter("a < b and label_a <> label_b").select("a", "b").distinct().join(stars, ["a", "b"], "left_anti")
    more = scratch.save(confirmed(rest, classes, sets, percent, scratch, "likely-rest"), "more")

    # Members outside the bucket's largest component are side 0, and all of them side 1: each of the one is compared
    # with each of the other that lies in another component.
    many = open_.filter(F.col("crowd") > SMALL_BUCKET)
    # A bucket's shape comes from sums by label, combined before they are moved: members meet it in one join, which
    # Spark can split where a bucket is large.
    shares = many.groupBy("key", "label").agg(F.count("*").alias("n"), F.sum(F.col("size") * 8 + 200).alias("heavy"))
    shape = shares.groupBy("key").agg(F.sum("n").alias("n"), F.sum("heavy").alias("heavy"), F.max(F.struct("n", (-F.col("label")).alias("minus"), "heavy")).alias("top"))
    needed = lambda n, heavy: F.greatest(F.lit(1), F.ceil(n / BLOCK), F.ceil(heavy / BLOCK_BYTES)).cast("int")
    across, down = needed(F.col("n"), F.col("heavy")), needed(F.col("n") - F.col("top.n"), F.col("heavy") - F.col("top.heavy"))
    shape = scratch.save(shape.select("key", (-F.col("top.minus")).alias("largest"), across.alias("across"), down.alias("down")), "shape")
    sided = many.join(shape, "key").withColumn("outside", F.col("label") != F.col("largest"))
    place = lambda n, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    outside = sided.filter("outside").select("key", "id", "label", place("down", 1).alias("one"), every("across").alias("two"), F.lit(0).alias("side"))
    whole = sided.select("key", "id", "label", every("down").alias("one"), place("across", 2).alias("two"), F.lit(1).alias("side"))
    filled = outside.unionByName(whole).join(sets.hint("merge"), "id").select("key", "one", "two", "side", "id", "label", "shingles")
    blocks = scratch.save(filled.groupBy("key", "one", "two").applyInArrow(_blocks(percent), "a long, b long"), "blocks")

    # A doc_id whose rows have several sets is one node: it links their classes.
    both = F.struct("set_a", "set_b")
    several = rows.filter("n_shingles > 0 and doc_id is not null").groupBy("doc_id").agg(F.min(both).alias("low"), F.max(both).alias("high")).filter("low <> high").select("doc_id")
    own = rows.join(several, "doc_id").join(classes.select("set_a", "set_b", "id"), ["set_a", "set_b"]).select(F.least("doc_id", "id").alias("a"), F.greatest("doc_id", "id").alias("b"))
    everything = links.union(more).union(blocks).union(own).distinct()
    labels = connected_components(everything, scratch, "last")
    named = classes.select("set_a", "set_b", "id").join(labels, F.col("id") == F.col("node"), "left").select("set_a", "set_b", F.coalesce("label", "id").alias("component"))
    # Every set has a class, but rows with no set or no id have none.
    out = rows.select("doc_id", "n_shingles", "set_a", "set_b").join(named, ["set_a", "set_b"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce(F.when(F.col("n_shingles") > 0, F.col("component")), F.col("doc_id")))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"))
    result = scratch.save(out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))), "result")
    scratch.close("result")
    return result


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op1_minhash_near_dedup": op1_minhash_near_dedup}
