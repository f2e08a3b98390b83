"""Similarity of sequences by k-mer seeds, and what is built on it.

A query is similar to a subject if some alignment of the two has at least `identity` percent equal characters and spans at
least `coverage` of the query.  Alignments are found from seeds: equal k-mers.  similar_texts decides on a seeded
diagonal's whole overlap of the two: whether any stretch of it is long and equal enough; with a gap, on the best local
alignment of a band of diagonals (gapped.py).  alignments gives one row a diagonal, from the first seed's start to the last
one's end.  Seeds of a period up to 8 are masked, as aligners mask low complexity.

What is shuffled is narrow: (key, id, position, length), a key being a k-mer's 64-bit hash.  Keys only choose
diagonals; seeds, stretches and matches are read off the sequences afterwards.  Equal sequences are told by their md5.

* Equal sequences are one class, compared once; what comes out is pairs of classes' representatives (their smallest
  ids) and each sequence's class, so a group of n copies gives n rows.
* Of a sequence's k-mers only minimizers are joined, about two of thirteen; each shared k-mer holds a shared one.
* Only keys that both sides have (or that two of a single side have) get rows: bare keys are counted first, and a bitmap of fixed
  size of the shared ones is sent to the tasks that make rows (a false answer costs a row).
* A row knows the minimizer before its own.  Where two sequences share that one too, at the same distance, they meet there and
  not here, so two near copies meet once for each run that they share, not for each key.
* Texts stay where they are read: of copies only ids are joined, and before texts are joined to pairs, those in no pair are left out by a
  bitmap of the ids in pairs (possibly_among).  Where the queries' keys are few, the subjects' texts aren't written either, but read again.
* A join of seeds keeps only offsets whose overlap is long enough, before any row is made of them; the offsets of a pair are
  dealt in groups of OFFSETS at most, and each group takes the parts of both sequences that it lays on each other.
* Keys, and then the rows of shared ones, are dealt in buckets by their first bits, many in a row, and meet in their bucket.
* Keys of a passage that very many sequences hold would give a row for each two of these.  Rows of such keys carry two bits of each
  character around them; they are laid on each other, the most crowded ones in blocks, and only pairs whose bits differ in no more
  places than similar sequences may are made rows.
* The greedy choice goes by prefixes of the order that grow by GROWTH: each is compared with what was kept before it, and only what
  is left with itself.  Kept sequences' keys are made once, in a KeyIndex.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from readloom.functions.sequences import reverse_complement
from readloom.operators import gapped, kmers
from readloom.operators.kmers import PERIODS
from readloom.scratch import Scratch, shuffles_removed

#: Windows of a k-mer that one minimizer is chosen of, at most; bits of the bitmap of keys; offsets of a pair in one row at most.
RUN, KEY_BITS, OFFSETS = 12, 26, 64
#: A key is common if more than COMMON x COMMON pairs of rows hold it, and crowded if more than BLOCK x BLOCK do; rows of a block of its rows; characters to either side of a row.
COMMON, BLOCK, SIDE = 16, 2048, 256
#: Bits of a key that dealt rows are told by; keys of a bucket, about; keys that a task deals at once.
TOLD, PER_BUCKET, PACK = 40, 1 << 19, 1 << 20
#: Share of a bitmap below which the queries' keys alone leave few of the subjects' rows.
FEW = 0.02
#: Of the greedy choice: candidates of the first prefix, and how many times longer each next one is.
FIRST, GROWTH = 4096, 32


def _masked(kmer: Column, k: int) -> Column:
    found = F.lit(False)
    for p in PERIODS:
        found = found | F.startswith(kmer, F.substring(kmer, p + 1, k - p))
    return found


def spread(df: DataFrame) -> DataFrame:
    """df over at least as many partitions as there are cores: a few small files would leave most of them idle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


#: Sizes of the nested cuts of a sequence: substring counts characters from its text's start.
CUTS = (1 << 16, 256)


def kmer_index(sequences: DataFrame, k: int = 28, stride: int = 1, masked: bool = True) -> DataFrame:
    """(id, pos, kmer) of the k-mers at every stride-th position, without the masked ones unless masked is false.

    Sequences are cut into overlapping blocks, and those into smaller ones, before k-mers are.
    """
    cut = spread(sequences.select("id", "seq")).withColumn("base", F.lit(0).cast("long")).filter(F.length("seq") >= k)
    for size in CUTS:
        size = -(-size // stride) * stride
        cut = cut.select("id", "seq", "base", F.explode(F.expr(f"sequence(0L, (length(seq) - {k}) div {size})")).alias("b"))
        cut = cut.select("id", (F.col("base") + F.col("b") * size).alias("base"), F.substring("seq", (F.col("b") * size + 1).cast("int"), F.lit(size + k - 1)).alias("seq"))
    places = F.expr(f"sequence(0L, least(length(seq) - {k}, {size - 1}), {stride}L)")
    # Cut inside the generator: a filter on its output isn't pushed into it, where each k-mer would be cut again for each test.
    each = F.transform(places, lambda i: F.struct(i.alias("i"), F.substring(F.col("seq"), (i + 1).cast("int"), F.lit(k)).alias("kmer")))
    found = cut.select("id", "base", F.explode(each).alias("x")).select("id", (F.col("base") + F.col("x.i")).alias("pos"), F.col("x.kmer").alias("kmer"))
    return found.filter(~_masked(F.col("kmer"), k)) if masked else found


# --- keys and joins --------------------------------------------------------------------------------


def run_of(k: int) -> int:
    """Windows of a k-mer that one minimizer is chosen of: RUN, or fewer where the windows would be too short for their periods."""
    return max(1, min(RUN, k - 2 * max(PERIODS)))


def _hits(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    head = (keys.view(np.uint64) >> np.uint64(64 - KEY_BITS)).astype(np.int64)
    return (bitmap[head >> 3] >> (head & 7).astype(np.uint8) & 1).astype(bool)


def _around(code: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Two bits of each of the SIDE characters before each place and from it on, within low..high: rows of bytes."""
    bits = (kmers.mix(code + np.uint32(1)) & np.uint64(3)).astype(np.uint8)
    place = at[:, None] + np.arange(-SIDE, SIDE)
    there = (place >= low[:, None]) & (place < high[:, None])
    near = np.where(there, bits[np.clip(place, 0, len(bits) - 1)], 0)
    return np.concatenate([np.packbits(near & 1, 1), np.packbits(near >> 1, 1)], 1)


def seed_keys(
    sequences: DataFrame, k: int = 28, *, sparse: bool = True, masked: bool = True, wanted: np.ndarray | None = None, dust: bool = False, chained: bool = False, common: np.ndarray | None = None,
) -> DataFrame:
    """(id, pos, n, key) of the sequences' k-mers, or of their minimizers if sparse; n is the sequence's length.

    wanted: a key_bitmap, of whose keys alone rows are made.  dust: without k-mers that meet an interval of low complexity.
    chained: also prev, a hash of the key before and its distance, 0 if there is none.  common: a key_bitmap, of whose keys rows
    have in `around` what _around says, and others null.
    """
    more = [T.StructField("prev", T.LongType())] * chained + [T.StructField("around", T.BinaryType())] * (common is not None)
    schema = T.StructType([sequences.schema["id"], T.StructField("pos", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("key", T.LongType()), *more])
    context = sequences.sparkSession.sparkContext
    send, often = (context.broadcast(x) if x is not None else None for x in (wanted, common))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in kmers.slices(batch, "seq"):
                code, first = kmers.codes(piece.column("seq").to_pylist())
                low = kmers.dust(code, first) if dust else None
                at, keys = kmers.minimizers(code, first, k, run_of(k), low) if sparse else kmers.all_windows(code, first, k, masked, low)
                prev = np.zeros(len(at), np.int64)
                if chained and len(at):
                    joined = at[:-1] >= first[np.searchsorted(first, at[1:], "right") - 1]
                    prev[1:] = np.where(joined, kmers.mix(keys[:-1] + np.diff(at).astype(np.uint64)).view(np.int64), 0)
                keys = keys.view(np.int64)
                if send is not None:
                    hit = _hits(send.value, keys)
                    at, keys, prev = at[hit], keys[hit], prev[hit]
                row = np.searchsorted(first, at, "right") - 1
                size = np.diff(first)[row].astype(np.int32)
                columns = [piece.column("id").take(pa.array(row)), pa.array(at - first[row]), pa.array(size), pa.array(keys), *[pa.array(prev)] * chained]
                if often is not None:
                    around = np.full(len(at), None, object)
                    hit = np.flatnonzero(_hits(often.value, keys))
                    for lo in range(0, len(hit), 4096):
                        some = hit[lo : lo + 4096]
                        around[some] = [x.tobytes() for x in _around(code, at[some], first[row[some]], first[row[some] + 1])]
                    columns.append(pa.array(around, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return spread(sequences.select("id", "seq")).mapInArrow(work, schema)


def among(keys: DataFrame, wanted: np.ndarray) -> DataFrame:
    """Rows of those keys that a key_bitmap has."""
    send = keys.sparkSession.sparkContext.broadcast(wanted)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_hits(send.value, batch.column("key").to_numpy())))

    return keys.mapInArrow(work, keys.schema)


def low_complexity(sequences: DataFrame) -> DataFrame:
    """(id, start, end) of the intervals of low complexity of each sequence (id, seq), as kmers.dust finds them; touching ones are one."""
    schema = T.StructType([sequences.schema["id"], T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in kmers.slices(batch, "seq"):
                code, first = kmers.codes(piece.column("seq").to_pylist())
                # A text's end ends an interval.
                low = np.insert(kmers.dust(code, first).astype(np.int8), first[1:], 0)
                edge = np.flatnonzero(np.diff(np.concatenate([[0], low])))
                opens, closes = edge[::2], edge[1::2]
                moved = first + np.arange(len(first))
                row = np.searchsorted(moved, opens, "right") - 1
                yield pa.RecordBatch.from_arrays([piece.column("id").take(pa.array(row)), pa.array(opens - moved[row]), pa.array(closes - moved[row])], ["id", "start", "end"])

    return spread(sequences.select("id", "seq")).mapInArrow(work, schema)


def save_index(index: DataFrame, table: str, buckets: int = 64) -> None:
    """Keeps subjects' keys bucketed, so that later joins need not shuffle them: give it as `index`."""
    index.write.mode("overwrite").bucketBy(buckets, "key").sortBy("key").saveAsTable(table)


def _head(key: Column) -> Column:
    return F.shiftrightunsigned(key, 64 - KEY_BITS) + 1


def _bitmap_parts(keys: DataFrame) -> DataFrame:
    """(part, bits) of a bitmap of the first KEY_BITS bits of the keys: 4 KB for each 32,768 bits."""
    head = _head(F.col("key"))
    return keys.groupBy(F.bitmap_bucket_number(head).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(head)).alias("bits"))


def key_bitmap(posted: DataFrame) -> np.ndarray:
    """The first KEY_BITS bits of the keys, as a bitmap that is built in Spark: of one size, whatever the number of keys."""
    out = np.zeros(1 << (KEY_BITS - 3), np.uint8)
    for r in _bitmap_parts(posted).collect():
        out[(r["part"] - 1) * 4096 : r["part"] * 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


def possibly_among(side: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of side whose id is in ids, and by chance a few more; with left_anti, all others.  None is shuffled: a bitmap of at most 8 MB is sent."""
    key = lambda c: F.xxhash64(F.col(c).cast("string"))
    parts = _bitmap_parts(ids.select(key("id").alias("key")))
    head = _head(key("id"))
    spot = F.bitmap_bit_position(head)
    byte = F.conv(F.hex(F.substring("bits", F.floor(spot / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = (F.col("part") == F.bitmap_bucket_number(head)) & (F.getbit(byte, (spot % 8).cast("int")) == 1)
    return side.join(F.broadcast(parts), hit, how)


def with_texts(side: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, seq) of side for a join on ids: of other ids only a few are left to be shuffled."""
    return possibly_among(side.select("id", "seq"), ids)


def _stranded(sequences: DataFrame, strand: str) -> DataFrame:
    return sequences.select("id", "seq") if strand == "+" else sequences.select("id", reverse_complement("seq").alias("seq"))


def asked_keys(queries: DataFrame, k: int, both_strands: bool, posted: DataFrame | None, **how) -> DataFrame:
    """(q, strand, qpos, qn, key) of the queries' strands, of keys that are posted; then what else seed_keys gives."""
    if posted is not None:
        how["wanted"] = key_bitmap(posted)
    out = None
    for strand in ("+", "-") if both_strands else ("+",):
        of = seed_keys(_stranded(queries, strand), k, **how)
        of = of.select(F.col("id").alias("q"), F.lit(strand).alias("strand"), F.col("pos").alias("qpos"), F.col("n").alias("qn"), *of.columns[3:])
        out = of if out is None else out.unionByName(of)
    return out


def seeds_of(query: np.ndarray, subject: np.ndarray, k: int) -> np.ndarray:
    """Where the two, laid one on the other, share an unmasked k-mer."""
    same = np.concatenate([[0], np.cumsum(query == subject)])
    n = len(query) - k + 1
    return np.flatnonzero((same[k:] - same[: max(n, 0)] == k) & ~kmers.periodic(subject, k)) if n > 0 else np.zeros(0, np.int64)


def _spans(k: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, lengths, matches = [], [], []
            for start, x, y in zip(batch.column("qstart").to_pylist(), batch.column("qpart").to_pylist(), batch.column("spart").to_pylist()):
                (x, _), (y, _) = kmers.codes([x]), kmers.codes([y])
                n = min(len(x), len(y))
                seeds = seeds_of(x[:n], y[:n], k)
                a, b = (int(seeds[0]), int(seeds[-1]) + k) if len(seeds) else (0, 0)
                starts.append(start + a)
                lengths.append(b - a)
                matches.append(int((x[a:b] == y[a:b]).sum()))
            made = {"qstart": starts, "length": lengths, "matches": matches}
            yield pa.RecordBatch.from_arrays([pa.array(made[c], pa.int64()) if c in made else batch.column(c) for c in ["q", "s", "strand", "offset", "qlen", *made]], ["q", "s", "strand", "offset", "qlen", *made])

    return work


def alignments(queries: DataFrame, subjects: DataFrame | None = None, *, k: int = 28, min_span: float = 0.0, min_bases: int = 0, both_strands: bool = False, index: DataFrame | None = None) -> DataFrame:
    """(q, s, strand, qstart, qend, sstart, length, matches, qlen) of each seeded alignment, 0-based half-open.

    queries and subjects have id and seq.  Without subjects, queries are compared with each other.  min_span
    (a share of the query) and min_bases leave out shorter alignments before sequences are read.  index: the
    subjects' keys, as seed_keys(subjects, k, sparse=False) gives them.
    """
    subjects = queries if subjects is None else subjects
    posted = index if index is not None else Scratch(queries.sparkSession, "keys").save(seed_keys(subjects, k, sparse=False), "posted")
    asked = asked_keys(queries, k, both_strands, posted, sparse=False, masked=False)
    seeds = asked.join(posted.select(F.col("id").alias("s"), F.col("pos").alias("spos"), "key"), "key").filter(F.col("q") != F.col("s"))
    spans = seeds.groupBy("q", "s", "strand", (F.col("qpos") - F.col("spos")).alias("offset")).agg(F.min("qpos").alias("qstart"), (F.max("qpos") + k - F.min("qpos")).alias("length"), F.first("qn").alias("qlen"))
    enough = lambda df: df.filter((F.col("length") >= F.col("qlen") * min_span) & (F.col("length") >= min_bases))
    piece = lambda seq, start: F.substring(seq, (start + 1).cast("int"), F.col("length").cast("int"))
    whole = F.when(F.col("strand") == "-", reverse_complement("seq")).otherwise(F.col("seq"))
    named = ["q", "s", "strand", "offset", "qlen", "qstart", "length"]
    full = enough(spans).join(queries.select(F.col("id").alias("q"), "seq"), "q").select(*named, piece(whole, F.col("qstart")).alias("qpart"))
    full = full.join(subjects.select(F.col("id").alias("s"), "seq"), "s").select(*named, "qpart", piece(F.col("seq"), F.col("qstart") - F.col("offset")).alias("spart"))
    kept = full.select(*named[:5]).schema
    for c in ("qstart", "length", "matches"):
        kept.add(c, "long")
    found = enough(full.mapInArrow(_spans(k), kept).filter("length > 0"))
    return found.select("q", "s", "strand", "qstart", (F.col("qstart") + F.col("length")).alias("qend"), (F.col("qstart") - F.col("offset")).alias("sstart"), "length", "matches", F.col("qlen").cast("int").alias("qlen"))


# --- similar sequences -----------------------------------------------------------------------------


def similar_on(query: np.ndarray, subject: np.ndarray, identity: float, least: int) -> bool:
    """Whether some stretch of the two, laid one on the other, at least `least` long, has `identity` percent equal codes."""
    same = query == subject
    if len(same) < least or 100 * int(same.sum()) < identity * least - 1e-6:
        return False
    # A stretch is equal enough if its sum is not negative: look for one between two prefix sums.
    total = np.concatenate([[0.0], np.cumsum(same * 100.0 - identity)])
    return bool((total[least:] >= np.minimum.accumulate(total[: len(total) - least]) - 1e-6).any())


def decided(batch: pa.RecordBatch, k: int, identity: float, coverage: float, both_ways: bool) -> tuple[np.ndarray, np.ndarray]:
    """Whether each row's query is similar to its subject on some offset, and if both_ways the other way round.

    All offsets are laid at once.  An overlap that is equal enough as a whole needs no search for a stretch, and one with too few equal
    codes for any has none.
    """
    number = lambda c: batch.column(c).to_numpy().astype(np.int64)
    (x, at), (y, bt) = (kmers.codes(batch.column(c).to_pylist()) for c in ("qpart", "spart"))
    offsets = batch.column("offsets")
    row = pc.list_parent_indices(offsets).to_numpy(zero_copy_only=False).astype(np.int64)
    o = pc.list_flatten(offsets).to_numpy(zero_copy_only=False).astype(np.int64) - number("qfrom")[row] + number("sfrom")[row]
    least = [np.maximum(1, np.ceil(number(c) * coverage)).astype(np.int64) for c in ("qlen", "slen")[: 1 + both_ways]]
    begin, end = np.maximum(0, o), np.minimum(np.diff(at)[row], np.diff(bt)[row] + o)
    size = np.maximum(0, end - begin)
    out = np.zeros(batch.num_rows, bool), np.zeros(batch.num_rows, bool)
    total = np.cumsum(size)
    lo = 0
    while lo < len(row):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + kmers.SLICE, "right")))
        n, r = size[lo:hi], row[lo:hi]
        ends = np.concatenate([[0], np.cumsum(n)])
        step = np.arange(ends[-1]) - np.repeat(ends[:-1], n)
        mine, theirs = x[np.repeat(at[r] + begin[lo:hi], n) + step], y[np.repeat(bt[r] + begin[lo:hi] - o[lo:hi], n) + step]
        same = mine == theirs
        equal = np.diff(np.concatenate([[0], np.cumsum(same)])[ends])
        open_ = [(n >= need[r]) & (equal * 100.0 >= identity * need[r] - 1e-6) for need in least]
        if np.logical_or.reduce(open_).any():
            seed = np.zeros(len(same) + 1, np.int64)
            if len(same) >= k:
                seed[1 : len(same) - k + 2] = kmers.over(same, k, np.logical_and) & kmers.inside(ends, k) & ~kmers.periodic(theirs, k)
            seeded = np.diff(np.cumsum(seed)[ends]) > 0
            whole = equal * 100.0 >= identity * n - 1e-6
            for need, maybe, found in zip(least, open_, out):
                found[r[maybe & seeded & whole]] = True
                for i in np.flatnonzero(maybe & seeded & ~whole):
                    if not found[r[i]] and similar_on(mine[ends[i] : ends[i + 1]], theirs[ends[i] : ends[i + 1]], identity, int(need[r[i]])):
                        found[r[i]] = True
        lo = hi
    return out


def _similar(k: int, identity: float, coverage: float, both_ways: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ahead, back = decided(batch, k, identity, coverage, both_ways)
            q, s = batch.column("q"), batch.column("s")
            yield pa.RecordBatch.from_arrays([q, s], ["q", "s"]).filter(pa.array(ahead))
            yield pa.RecordBatch.from_arrays([s, q], ["q", "s"]).filter(pa.array(back))

    return work


class KeyIndex:
    """Sequences, one of each text, and their minimizers, in a folder: what is added is a part, whose keys are made once.

    A part counts when it is whole: one that a failed job left is not read, and is written anew by the next.
    """

    def __init__(self, spark: SparkSession, path: str, k: int = 28):
        self.spark, self.path, self.k = spark, path.rstrip("/"), k
        self.parts: list[str] = []
        folder = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        if store.exists(folder):
            names = sorted(x.getPath().getName() for x in store.listStatus(folder))
            self.parts = [x for x in names if store.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{x}/whole/_SUCCESS"))]
            made = self._read("whole").first().asDict() if self.parts else {}
            if self.parts and made["k"] != k:
                raise ValueError(f"the index was made for k = {made['k']}")
            if self.parts and made.get("run") != run_of(k):
                raise ValueError("the index was made with other minimizers: build it anew")

    def _read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path}/{p}/{table}" for p in self.parts])

    @property
    def members(self) -> DataFrame:
        """(id, text, n) of every sequence; text is its md5."""
        return self._read("members")

    @property
    def sequences(self) -> DataFrame:
        """(id, text, seq), one of each text."""
        return self._read("sequences")

    @property
    def keys(self) -> DataFrame:
        """(id, pos, n, key, prev) of those."""
        return self._read("keys")

    def add(self, sequences: DataFrame) -> None:
        """sequences: distinct ids that the index doesn't have, and seq; nulls are left out."""
        part = f"part-{len(self.parts):06d}"
        put = lambda df, name: df.write.mode("overwrite").parquet(f"{self.path}/{part}/{name}")
        got = lambda name: self.spark.read.parquet(f"{self.path}/{part}/{name}")
        with shuffles_removed(self.spark):
            put(sequences.filter("seq is not null").select("id", F.md5("seq").alias("text"), F.length("seq").alias("n")), "members")
            first = got("members").groupBy("text").agg(F.min("id").alias("id"))
            if self.parts:
                first = first.join(self.sequences.select("text"), "text", "left_anti")
            put(sequences.select("id", "seq").join(first, "id").select("id", "text", "seq"), "sequences")
            put(seed_keys(got("sequences"), self.k, chained=True), "keys")
            put(self.spark.createDataFrame([(self.k, run_of(self.k))], "k int, run int"), "whole")
        self.parts.append(part)


@dataclass
class Similar:
    """members and subjects: id, text (a digest), rep (the smallest id of its text); subjects also seeded.

    pairs: distinct (q, s) of representatives of different texts, q similar to s.  Sequences of one text are similar
    to each other if it has a seed.  All are read from tables in the shared folder, which close() deletes.  Without
    subjects of their own, queries are both.
    """

    members: DataFrame
    subjects: DataFrame
    pairs: DataFrame
    scratch: Scratch

    def close(self) -> None:
        self.scratch.close()


class _Rows:
    """Rows of keys as arrays, of which pairs may be similar.  around: what _around says of each, joined; slot: the place of each row there."""

    def __init__(self, ids: pa.Array, pos: np.ndarray, n: np.ndarray, prev: np.ndarray, own: bool, identity: float, coverage: float):
        self.ids, self.pos, self.n, self.prev, self.own, self.identity, self.coverage = ids, pos, n, prev, own, identity, coverage
        named = ids.dictionary_encode()
        order = pc.array_sort_indices(named.dictionary).to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.rank = place[named.indices.to_numpy()]

    def look_around(self, around: bytes, slot: np.ndarray) -> None:
        self.slot, held = slot, np.flatnonzero(slot >= 0)
        bits = np.frombuffer(around, np.uint64).reshape(len(held), 2, -1)
        pos, n, place = np.empty(len(held), np.int64), np.empty(len(held), np.int64), np.arange(-SIDE, SIDE)
        pos[slot[held]], n[slot[held]] = self.pos[held], self.n[held]
        there = np.packbits((place >= -pos[:, None]) & (place < (n - pos)[:, None]), 1).view(np.uint64)
        self.words = [[np.ascontiguousarray(x) for x in part.T] for part in (bits[:, 0], bits[:, 1], there)]

    def may(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the two are of different sequences, overlap enough and don't meet at the key before."""
        offset = self.pos[a] - self.pos[b]
        overlap = np.minimum(self.n[a], self.n[b] + offset) - np.maximum(0, offset)
        enough = overlap >= self.reach(a, b) * self.coverage - 1e-6
        return enough & (self.rank[a] != self.rank[b]) & ((self.prev[a] != self.prev[b]) | (self.prev[a] == 0))

    def reach(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.minimum(self.n[a], self.n[b]) if self.own else self.n[a]

    def alike(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether bits around the two differ in no more places than of similar sequences."""
        offset = self.pos[a] - self.pos[b]
        overlap = np.minimum(self.n[a], self.n[b] + offset) - np.maximum(0, offset)
        # Places that differ in any bit differ; of those of the overlap so many may, if a stretch of it is similar.
        most = overlap - np.ceil(self.reach(a, b) * self.coverage) * (self.identity / 100) + 1e-3
        differ = np.zeros(len(a), np.int64)
        one, two = self.slot[a], self.slot[b]
        for x, y, m in zip(*self.words):
            differ += np.bitwise_count(((x[one] ^ x[two]) | (y[one] ^ y[two])) & m[one] & m[two])
        return differ <= most

    def facing(self, left: np.ndarray, right: np.ndarray, apart) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of the two sides that may be similar."""
        step = max(1, (1 << 17) // max(1, len(right)))
        for lo in range(0, len(left), step):
            a, b = left[lo : lo + step, None], right[None, :]
            one, two = np.nonzero(apart(a, b) & self.may(a, b))
            one, two = left[lo + one], right[two]
            good = self.alike(one, two)
            yield one[good], two[good]

    def met(self, pairs: list[tuple[np.ndarray, np.ndarray]], strand: pa.Array, symmetric: bool) -> pa.Table:
        """(q, s, strand, qn, sn, offset), each once; if symmetric the smaller id is q."""
        q, s = (np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64) for x in (zip(*pairs) if pairs else ((), ())))
        if symmetric:
            q, s = np.where(self.rank[q] < self.rank[s], q, s), np.where(self.rank[q] < self.rank[s], s, q)
        columns = [self.ids.take(pa.array(q)), self.ids.take(pa.array(s)), strand.take(pa.array(q)), pa.array(self.n[q], pa.int32()), pa.array(self.n[s], pa.int32()), pa.array(self.pos[q] - self.pos[s])]
        return pa.Table.from_arrays(columns, ["q", "s", "strand", "qn", "sn", "offset"])


def _met_schema(id_type: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("q", id_type), T.StructField("s", id_type), T.StructField("strand", T.StringType()), T.StructField("qn", T.IntegerType()), T.StructField("sn", T.IntegerType()), T.StructField("offset", T.LongType())])


def _facing(symmetric: bool, own: bool, identity: float, coverage: float):
    """A group's work: rows of two blocks of one common key, to (q, s, strand, qn, sn, offset) of those that may be similar."""

    def work(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        one = lambda c: table.column(c).combine_chunks()
        n, pos, prev, block = (table.column(c).to_numpy() for c in ("n", "pos", "prev", "block"))
        mine, theirs = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        of_query = table.column("asked").to_numpy(zero_copy_only=False)
        rows = _Rows(one("id"), pos, n, prev, own, identity, coverage)
        rows.look_around(b"".join(table.column("around").to_pylist()), np.arange(len(n)))
        left, right = (np.flatnonzero(block == mine), np.flatnonzero(block == theirs)) if symmetric else (np.flatnonzero(of_query), np.flatnonzero(~of_query))
        apart = (lambda a, b: a < b) if symmetric and mine == theirs else (lambda a, b: rows.rank[a] < rows.rank[b]) if own and not symmetric else lambda a, b: True
        return rows.met(list(rows.facing(left, right, apart)), one("strand"), symmetric)

    return work


def _common_meetings(asked: DataFrame, posted: DataFrame | None, shared: DataFrame, own: bool, identity: float, coverage: float) -> DataFrame:
    """(q, s, strand, qn, sn, offset) of rows of crowded keys that may be similar; without posted, of asked with each other.

    A key's rows are dealt in blocks of about BLOCK, and each two blocks are a group, so no group holds all of a key.
    """
    symmetric = posted is None
    blocks = lambda c: F.expr(f"({c} - 1) div {BLOCK} + 1")
    keys = shared.filter("crowded").select("key", blocks("a").alias("na"), blocks("c").alias("nc"))

    def dealt(rows: DataFrame, mine: str, theirs: str, asked: bool) -> DataFrame:
        told = F.col("key").bitwiseAND(F.lit(-1 << (64 - TOLD)))
        out = rows.filter("around is not null").withColumn("key", told).join(keys, "key").withColumn("block", F.pmod(F.xxhash64("id", "pos"), F.col(mine)))
        out = out.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col(theirs) - 1))).withColumn("asked", F.lit(asked))
        ends = (F.least("block", "other"), F.greatest("block", "other")) if symmetric else (F.col("block"), F.col("other")) if asked else (F.col("other"), F.col("block"))
        return out.select("key", ends[0].alias("i"), ends[1].alias("j"), "id", "strand", "pos", "n", "prev", "block", "asked", "around")

    rows = dealt(asked.select(F.col("q").alias("id"), "strand", F.col("qpos").alias("pos"), F.col("qn").alias("n"), "key", "prev", "around"), "na", "nc", True)
    if not symmetric:
        rows = rows.unionByName(dealt(posted.withColumn("strand", F.lit("+")), "nc", "na", False))
    return rows.groupBy("key", "i", "j").applyInArrow(_facing(symmetric, own, identity, coverage), _met_schema(rows.schema["id"].dataType))


def _planes(x: np.ndarray) -> bytes:
    """Numbers byte by byte, all lowest ones first: bytes that are alike lie together, and are moved as next to nothing."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def _of_planes(column: pa.ChunkedArray, kind) -> list[np.ndarray]:
    width = np.dtype(kind).itemsize
    return [np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(width, -1).T).view(kind).ravel() for x in column.to_pylist()]


def _told(table: pa.Table, bits: int) -> list[np.ndarray]:
    """The keys of each row of dealt keys."""
    return [np.cumsum(x) + np.uint64(b << (TOLD - bits)) for b, x in zip(table.column("bucket").to_pylist(), _of_planes(table.column("key"), np.uint64))]


def _dealt_keys(side: DataFrame, k: int, bits: int, asked: bool, strand: str, *, texts: bool, wanted: np.ndarray | None = None, common: np.ndarray | None = None, crowded: np.ndarray | None = None, which: str = "all") -> DataFrame:
    """The keys of side in 2^bits buckets, those that a task has at once as one row of each bucket: bucket, asked, strand, key.

    side has sequences if `texts`, else rows of keys.  With wanted: only those keys, and also id, pos, n, prev, and of the rows of
    common keys `at`, their places, and around; without rows of the crowded keys.  which: "common" or "plain" rows alone.
    """
    id_type = side.schema["id"].dataType
    full = wanted is not None
    binary = lambda c: T.StructField(c, T.BinaryType())
    schema = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("asked", T.BooleanType()), T.StructField("strand", T.StringType()), binary("key")])
    if full:
        schema = T.StructType([*schema, T.StructField("id", T.ArrayType(id_type)), *map(binary, ("pos", "n", "prev", "at", "around"))])
    send = [side.sparkSession.sparkContext.broadcast(x) if x is not None else None for x in (wanted, common, crowded)]

    def made(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            if not texts:
                n, pos, prev = (batch.column(c).to_numpy() for c in ("n", "pos", "prev")) if full else (None, None, None)
                yield batch.column("id") if full else None, pos, n, batch.column("key").to_numpy().view(np.uint64), prev, None
                continue
            for piece in kmers.slices(batch, "seq"):
                code, first = kmers.codes(piece.column("seq").to_pylist())
                at, keys = kmers.minimizers(code, first, k, run_of(k))
                if not full:
                    yield None, None, None, keys, None, None
                    continue
                prev = np.zeros(len(at), np.int64)
                if len(at):
                    joined = at[:-1] >= first[np.searchsorted(first, at[1:], "right") - 1]
                    prev[1:] = np.where(joined, kmers.mix(keys[:-1] + np.diff(at).astype(np.uint64)).view(np.int64), 0)
                hit = np.flatnonzero(_hits(send[0].value, keys.view(np.int64)))
                at, keys, prev = at[hit], keys[hit], prev[hit]
                row = np.searchsorted(first, at, "right") - 1
                yield piece.column("id").take(pa.array(row)), at - first[row], np.diff(first)[row], keys, prev, (code, at, first[row], first[row + 1])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for ids, pos, n, keys, prev, text in made(batches):
            told, some = keys >> np.uint64(64 - TOLD), [np.zeros(len(keys), bool), []]
            if full:
                keep = _hits(send[0].value, keys.view(np.int64))
                often = _hits(send[1].value, keys.view(np.int64))
                if send[2] is not None:
                    keep &= ~(often & np.isin(told, send[2].value))
                if which != "all":
                    keep &= often == (which == "common")
                hit = np.flatnonzero(keep)
                told, ids, pos, n, prev, often = told[hit], ids.take(pa.array(hit)), pos[hit], n[hit], prev[hit], often[hit]
                if text is not None:
                    code, at, low, high = text[0], *(x[hit][often] for x in text[1:])
                    around = [_around(code, at[i : i + 4096], low[i : i + 4096], high[i : i + 4096]) for i in range(0, len(at), 4096)]
                    some = [often, around]
                else:
                    some = [np.zeros(len(told), bool), []]
            held.append((told, ids, pos, n, prev, *some))
            size += len(told)
            if size >= PACK:
                yield packed(held)
                held, size = [], 0
        if size:
            yield packed(held)

    def packed(held: list) -> pa.RecordBatch:
        told = np.concatenate([x[0] for x in held])
        order = np.argsort(told, kind="stable")
        told = told[order]
        ends = np.searchsorted(told >> np.uint64(TOLD - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
        out = {f.name: [] for f in schema}
        if full:
            pos, n = (np.concatenate([x[i] for x in held]).astype(np.uint32)[order] for i in (2, 3))
            prev = np.concatenate([x[4] for x in held])[order]
            ids = pa.concat_arrays([x[1] for x in held]).take(pa.array(order))
            often = np.concatenate([x[5] for x in held])
            slot = (np.cumsum(often) - 1)[order]
            often = often[order]
            around = np.concatenate([np.zeros((0, SIDE // 2), np.uint8), *[y for x in held for y in x[6]]])
        for b in np.flatnonzero(np.diff(ends)):
            lo, hi = ends[b], ends[b + 1]
            out["bucket"].append(int(b))
            out["asked"].append(asked)
            out["strand"].append(strand)
            out["key"].append(_planes(np.diff(told[lo:hi], prepend=np.uint64(int(b) << (TOLD - bits)))))
            if full:
                here = np.flatnonzero(often[lo:hi])
                out["id"].append(ids.slice(lo, hi - lo))
                for c, x in (("pos", pos[lo:hi]), ("n", n[lo:hi]), ("prev", prev[lo:hi]), ("at", here.astype(np.uint32))):
                    out[c].append(_planes(np.ascontiguousarray(x)))
                out["around"].append(around[slot[lo:hi][here]].tobytes())
        columns = [pa.array(out[c], pa.int32() if c == "bucket" else pa.bool_() if c == "asked" else pa.string() if c == "strand" else pa.binary()) for c in out if c != "id"]
        if full:
            sizes = np.concatenate([[0], np.cumsum([len(x) for x in out["id"]])]).astype(np.int32)
            columns.insert(list(out).index("id"), pa.ListArray.from_arrays(pa.array(sizes), pa.concat_arrays(out["id"])))
        return pa.RecordBatch.from_arrays(columns, list(out))

    columns = ["id", "seq"] if texts else ["id", "pos", "n", "key", "prev"] if full else ["id", "key"]
    return spread(side.select(*columns)).mapInArrow(work, schema)


def _counted(bits: int, mutual: bool):
    """A bucket's work: its keys to (key, a, c), how many rows of queries and of subjects hold each that both have."""

    def work(table: pa.Table) -> pa.Table:
        told, asked = _told(table, bits), table.column("asked").to_pylist()
        none = [np.zeros(0, np.uint64)]
        keys, a = np.unique(np.concatenate(none + [x for x, mine in zip(told, asked) if mine]), return_counts=True)
        if mutual:
            keys, a = keys[a > 1], a[a > 1]
            c = a
        else:
            others, c = np.unique(np.concatenate(none + [x for x, mine in zip(told, asked) if not mine]), return_counts=True)
            keys, mine, theirs = np.intersect1d(keys, others, True, True)
            a, c = a[mine], c[theirs]
        return pa.Table.from_arrays([pa.array((keys << np.uint64(64 - TOLD)).view(np.int64)), pa.array(a.astype(np.int64)), pa.array(c.astype(np.int64))], ["key", "a", "c"])

    return work


def _meeting(bits: int, mutual: bool, own: bool, identity: float, coverage: float, common: int):
    """A bucket's work: its rows to (q, s, strand, qn, sn, offset) of those that may be similar; `common` and more pairs are told by their bits."""

    def work(table: pa.Table) -> pa.Table:
        told = _told(table, bits)
        each = np.array([len(x) for x in told])
        told = np.concatenate(told)
        one = lambda c, kind: np.concatenate(_of_planes(table.column(c), kind)).astype(np.int64)
        asked = np.repeat(table.column("asked").to_numpy(zero_copy_only=False), each)
        strand = table.column("strand").combine_chunks().take(pa.array(np.repeat(np.arange(len(each)), each)))
        rows = _Rows(table.column("id").combine_chunks().flatten(), one("pos", np.uint32), one("n", np.uint32), one("prev", np.int64), own, identity, coverage)
        slot, at = np.full(len(told), -1), _of_planes(table.column("at"), np.uint32)
        here = np.concatenate([lo + x for lo, x in zip(np.cumsum(each) - each, at)]).astype(np.int64)
        slot[here] = np.arange(len(here))
        order = np.argsort(told, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], np.diff(told[order]) > 0]))
        size = np.diff(np.append(starts, len(order)))
        a = np.add.reduceat(asked[order].astype(np.int64), starts)
        crowd = size * size if mutual else a * (size - a)
        pairs = []
        # Rows of one key lie next to each other: each is laid on the first after it, then on the second, and so on.
        last = np.repeat(np.where(crowd > common, 0, starts + size), size)
        live, d = np.arange(len(order)), 1
        while len(live):
            live = live[live + d < last[live]]
            x, y = order[live], order[live + d]
            if not mutual:
                good = asked[x] != asked[y]
                x, y = np.where(asked[x], x, y)[good], np.where(asked[x], y, x)[good]
            good = rows.may(x, y)
            if own and not mutual:
                good &= rows.rank[x] < rows.rank[y]
            pairs.append((x[good], y[good]))
            d += 1
        many = np.flatnonzero(crowd > common)
        if len(many):
            rows.look_around(b"".join(table.column("around").to_pylist()), slot)
        for r in many:
            group = order[starts[r] : starts[r] + size[r]]
            if mutual:
                pairs += rows.facing(group, group, lambda a, b: a < b)
            else:
                apart = (lambda a, b: rows.rank[a] < rows.rank[b]) if own else lambda a, b: True
                pairs += rows.facing(group[asked[group]], group[~asked[group]], apart)
        return rows.met(pairs, strand, mutual)

    return work


def _bucket_meetings(unique: DataFrame, others: DataFrame, saved: DataFrame | None, own: bool, k: int, both_strands: bool, identity: float, coverage: float, scratch: Scratch) -> DataFrame:
    """(q, s, strand, qn, sn, offset) where a query and a subject share a seed, overlap enough and may be similar.

    Keys are dealt in buckets and counted there; then rows of those that both sides have are, and meet in their bucket.  Keys that
    more than BLOCK x BLOCK pairs of rows hold are crowded: their rows are dealt in blocks.
    """
    mutual = own and not both_strands
    strands = ("+", "-") if both_strands else ("+",)
    common_ids = None
    letters = sum(side.agg(F.sum(F.length("seq"))).first()[0] or 0 for side in ([unique] if own else [unique, others]))
    bits = min(14, max(5, math.ceil(math.log2(2 * letters / (run_of(k) + 1) / PER_BUCKET + 1))))

    def dealt(**how) -> DataFrame:
        sides = [_dealt_keys(_stranded(unique, x), k, bits, True, x, texts=True, **how) for x in strands]
        if not mutual and saved is None:
            sides.append(_dealt_keys(others, k, bits, False, "+", texts=True, **how))
        elif not mutual and not how:
            sides.append(_dealt_keys(saved, k, bits, False, "+", texts=False))
        elif not mutual:
            # A saved row of a common key is made again, with what is around it.
            sides.append(_dealt_keys(saved, k, bits, False, "+", texts=False, which="plain", **how))
            sides.append(_dealt_keys(with_texts(others, common_ids).join(common_ids, "id", "left_semi"), k, bits, False, "+", texts=True, which="common", **how))
        out = sides[0]
        for x in sides[1:]:
            out = out.unionByName(x)
        return out

    counts = dealt().groupBy("bucket").applyInArrow(_counted(bits, mutual), "key long, a long, c long")
    pairs = F.col("a") * F.col("c")
    common = pairs > COMMON * COMMON
    shared = scratch.save(counts.withColumn("common", common).withColumn("crowded", common & (pairs > BLOCK * BLOCK)), "shared")
    # A crowded key has more than 2 x BLOCK rows, so these are few.
    crowded = np.array([r["key"] for r in shared.filter("crowded").select("key").collect()], np.int64).view(np.uint64) >> np.uint64(64 - TOLD)
    how = {"wanted": key_bitmap(shared), "common": key_bitmap(shared.filter("common"))}
    if saved is not None:
        common_ids = scratch.save(among(saved, how["common"]).select("id").distinct(), "common")
    rows = dealt(**how, crowded=crowded if len(crowded) else None)
    schema = _met_schema(unique.schema["id"].dataType)
    met = rows.groupBy("bucket").applyInArrow(_meeting(bits, mutual, own, identity, coverage, COMMON * COMMON), schema)
    if len(crowded):
        only = key_bitmap(shared.filter("crowded"))
        of = {"wanted": only, "common": only, "chained": True}
        posted = None if mutual else seed_keys(others, k, **of)
        met = met.unionByName(_common_meetings(asked_keys(unique, k, both_strands, None, **of), posted, shared, own, identity, coverage))
    return met


def _meetings(unique: DataFrame, others: DataFrame, saved: DataFrame | None, members: DataFrame | None, own: bool, k: int, both_strands: bool, identity: float, coverage: float, gap: int, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(q, s, strand, qn, sn, offset) where a query and a subject share a seed and overlap enough, and (rep) of subjects with a seed; and others.

    saved: the subjects' keys, if there are any.  members: what _classes gives of others, if these have copies: those get no rows.
    Not every offset's every seed is told, but one at least.
    """
    mutual = own and not both_strands
    bare = lambda side, strands: asked_keys(side, k, strands, None).select("key")
    few = None
    if not own:
        bitmap = key_bitmap(bare(unique, both_strands))
        few = bitmap if np.bitwise_count(bitmap).sum() < FEW * (1 << KEY_BITS) else None
    if few is None and members is not None:
        others = scratch.save(_representatives(others, members), "subjects-unique")
    reps = saved.select(F.col("id").alias("rep")) if saved is not None else seed_holders(others, k)
    if few is None and not gap:
        return _bucket_meetings(unique, others, saved, own, k, both_strands, identity, coverage, scratch), reps, others
    if few is not None:
        found = seed_keys(others, k, wanted=few, chained=True) if saved is None else among(saved, few)
        posted = scratch.save(found if members is None else found.join(_copies(members), "id", "left_anti"), "posted")
        asked = scratch.save(asked_keys(unique, k, both_strands, posted, chained=True), "asked")
    else:
        one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
        if mutual:
            counts = bare(unique, False).groupBy("key").agg(F.count("*").alias("a")).filter("a > 1")
        else:
            sides = bare(unique, both_strands).select("key", one.alias("a"), none.alias("c")).unionByName((bare(others, False) if saved is None else saved.select("key")).select("key", none.alias("a"), one.alias("c")))
            counts = sides.groupBy("key").agg(F.sum("a").alias("a"), F.sum("c").alias("c")).filter("a > 0 and c > 0")
        how = {"wanted": key_bitmap(counts), "chained": True}
        asked = scratch.save(asked_keys(unique, k, both_strands, None, **how), "asked")
        if mutual:
            posted = asked.select(F.col("q").alias("id"), F.col("qpos").alias("pos"), F.col("qn").alias("n"), "key", "prev")
        else:
            posted = scratch.save(seed_keys(others, k, **how) if saved is None else among(saved, how["wanted"]), "posted")
    offset = F.col("qpos") - F.col("spos")
    overlap = F.least(F.col("qn"), F.col("sn") + offset) - F.greatest(F.lit(0), offset)
    # Of two of the same table each pair is met once, and both directions are decided.
    apart = F.col("q") < F.col("s") if own else F.col("q") != F.col("s")
    reach = F.least("qn", "sn") if own else F.col("qn")
    # A band's diagonals overlap by so much more at most.
    enough = overlap + (gap + gapped.BUCKET if gap else 0) >= reach * F.lit(coverage) - 1e-6
    first = (F.col("a.prev") != F.col("b.prev")) | (F.col("a.prev") == 0)
    mine, theirs = asked.select("q", "strand", "qpos", "qn", "key", "prev"), posted.select(F.col("id").alias("s"), F.col("pos").alias("spos"), F.col("n").alias("sn"), "key", "prev")
    met = mine.alias("a").join(theirs.alias("b"), (F.col("a.key") == F.col("b.key")) & apart & enough & first).select("q", "s", "strand", "qn", "sn", offset.alias("offset"))
    return met, reps, others


def _classes(side: DataFrame, name: str, scratch: Scratch) -> DataFrame:
    """(id, text, rep) of the sequences of side, rep being the smallest id of its text (a digest)."""
    keyed = scratch.save(side.filter("seq is not null").select("id", F.md5("seq").alias("text")), f"{name}-keyed")
    members = scratch.save(keyed.join(keyed.groupBy("text").agg(F.min("id").alias("rep")), "text").select("id", "text", "rep"), f"{name}-members")
    scratch.drop(f"{name}-keyed")
    return members


def _copies(members: DataFrame) -> DataFrame:
    """(id) of those that stand for no text."""
    copies = members.filter("id <> rep").select("id")
    return copies.join(possibly_among(members.filter("id = rep").select("id"), copies), "id", "left_anti")


def _representatives(side: DataFrame, members: DataFrame) -> DataFrame:
    """(id, seq) of the rows of side whose id stands for a text.

    What is surely no copy stays where it is; of the others those that stand for a text after all are looked up.
    """
    side, copies = side.filter("id is not null and seq is not null").select("id", "seq"), members.filter("id <> rep").select("id")
    doubtful = possibly_among(members.filter("id = rep").select("id"), copies)
    return possibly_among(side, copies, "left_anti").unionByName(with_texts(side, doubtful).join(doubtful, "id", "left_semi"))


def seed_holders(sequences: DataFrame, k: int) -> DataFrame:
    """(rep) of the sequences that have an unmasked k-mer."""
    schema = T.StructType([T.StructField("rep", sequences.schema["id"].dataType)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in kmers.slices(batch, "seq"):
                code, first = kmers.codes(piece.column("seq").to_pylist())
                # A text is told by where its first unmasked k-mer lies.
                at = np.flatnonzero(kmers.inside(first, k) & ~kmers.periodic(code, k))
                yield pa.RecordBatch.from_arrays([piece.column("id").take(pa.array(np.unique(np.searchsorted(first, at, "right") - 1)))], ["rep"])

    return spread(sequences.select("id", "seq")).mapInArrow(work, schema)


def similar_texts(queries: DataFrame, subjects: DataFrame | KeyIndex | None = None, *, identity: float = 90.0, coverage: float = 0.8, k: int = 28, both_strands: bool = False, gap: int = 0) -> Similar:
    """Which queries are similar to which subjects, or to each other; queries and subjects have seq and a distinct id.

    subjects may be a KeyIndex, whose keys are read and not made again.  gap: alignments may have gaps, and shift by so many
    characters at least.
    """
    scratch = Scratch(queries.sparkSession, "similar")
    own = subjects is None

    query_members = _classes(queries, "queries", scratch)
    unique = scratch.save(_representatives(queries, query_members), "queries-unique")
    if isinstance(subjects, KeyIndex):
        if subjects.k != k:
            raise ValueError(f"the index was made for k = {subjects.k}")
        if not subjects.parts:
            subjects = queries.limit(0)
    saved = several = None
    if isinstance(subjects, KeyIndex):
        subject_members = subjects.members.join(subjects.sequences.select("text", F.col("id").alias("rep")), "text")
        others, saved = subjects.sequences.select("id", "seq"), subjects.keys
    elif own:
        subject_members, others = query_members, unique
    else:
        subject_members = several = _classes(subjects, "subjects", scratch)
        others = subjects.filter("id is not null and seq is not null").select("id", "seq")
    seeds, posted, others = _meetings(unique, others, saved, several, own, k, both_strands, identity, coverage, gap, scratch)
    size = gapped.BUCKET if gap else OFFSETS
    grouped = seeds.groupBy("q", "s", "strand", F.floor(F.col("offset") / F.lit(float(size))).cast("long").alias("bucket"))
    pairs = scratch.save(grouped.agg(F.first("qn").alias("qlen"), F.first("sn").alias("slen"), F.collect_set("offset").alias("offsets")), "met")  # `size` offsets at most
    scratch.drop("asked", "posted", "shared", "common")
    cut = gapped.bands(pairs, unique, others, gap, size)
    if gap:
        keys = cut.select("q", "s", "strand", "qlen", "slen").schema
        found = cut.mapInArrow(gapped.aligned(keys, k, gap, gapped.Scoring(), True), gapped.with_found(keys))
        best = scratch.save(gapped.best_of(found, "q", "s"), "best").filter(F.col("matches") * 100.0 >= F.col("length") * F.lit(identity) - 1e-6)
        enough = lambda n: best.filter(F.col("length") >= F.col(n) * F.lit(coverage) - 1e-6)
        decided = enough("qlen").select("q", "s")
        if own:
            decided = decided.unionByName(enough("slen").select(F.col("s").alias("q"), F.col("q").alias("s")))
    else:
        decided = cut.mapInArrow(_similar(k, identity, coverage, own), cut.select("q", "s").schema).distinct()
    decided = scratch.save(decided, "pairs")

    seeded = scratch.save(posted.distinct(), "seeded").withColumn("seeded", F.lit(True))
    subject_members = subject_members.join(seeded, "rep", "left").select("id", "text", "rep", F.coalesce("seeded", F.lit(False)).alias("seeded"))
    scratch.drop("met", "best", "queries-unique", "subjects-unique")
    return Similar(subject_members if own else query_members, subject_members, decided, scratch)


def similar_pairs(queries: DataFrame, subjects: DataFrame | None = None, **more) -> DataFrame:
    """Distinct (q, s) of different texts, q similar to s; of equal sequences the smallest id stands for all."""
    return similar_texts(queries, subjects, **more).pairs


def similar_to(candidates: DataFrame, kept: DataFrame | KeyIndex, **more) -> DataFrame:
    """(id) of candidates that are similar to another sequence in kept; the other tables made for it are gone."""
    found = similar_texts(candidates, kept, **more)
    by_pairs = found.members.join(found.pairs.select(F.col("q").alias("rep")).distinct(), "rep", "left_semi").select("id")
    texts = found.subjects.filter("seeded").groupBy("text").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    by_text = found.members.join(texts, "text").filter((F.col("low") != F.col("id")) | (F.col("high") != F.col("id"))).select("id")
    out = found.scratch.save(by_pairs.union(by_text).distinct(), "similar")
    found.scratch.close("similar")
    return out


def drop_similar(candidates: DataFrame, kept: DataFrame | KeyIndex, **more) -> DataFrame:
    """Candidates similar to nothing in kept."""
    return candidates.join(similar_to(candidates.select("id", "seq"), kept, **more), "id", "left_anti")


def filter_statistics(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row (n, kept, removed): what a filter left of its input."""
    n, kept = (df.agg(F.count("*").alias(c)) for df, c in ((before, "n"), (after, "kept")))
    return n.crossJoin(F.broadcast(kept)).select("n", "kept", (F.col("n") - F.col("kept")).alias("removed"))  # two single rows


def similar_by_hits(hits: DataFrame, lengths: DataFrame, identity: float = 90.0, coverage: float = 0.8) -> DataFrame:
    """Distinct qseqid that has a hit of enough identity and length; queries of unknown or zero length don't count."""
    known = lengths.filter("qlen > 0")
    return hits.join(known, "qseqid").filter((F.col("pident") >= identity) & (F.col("length") >= F.col("qlen") * coverage)).select("qseqid").distinct()


def greedy_dedup(candidates: DataFrame, pairs: DataFrame, *, members: DataFrame | None = None, batch: int | None = None, scratch: Scratch | None = None) -> DataFrame:
    """The ordered greedy choice: a candidate is kept unless it is similar to an earlier kept one.

    candidates: id and rank (distinct, from 0).  pairs: (q, s), q similar to s; with members (id, rep, seeded) pairs
    are of representatives, and seeded members of a class are similar to each other.  With batch, candidates of
    one batch of ranks are not compared with each other.  Of a class only the earliest batch can stay.  Computed as
    the fixed-priority maximal independent set, in rounds that decide all whose earlier neighbours are decided, and
    that end after as many rounds as the longest chain of dependent decisions; rounds read open edges only.
    """
    scratch = scratch or Scratch(candidates.sparkSession, "greedy")
    turn = (lambda c: F.col(c)) if batch is None else (lambda c: F.expr(f"{c} div {batch}"))
    plain = candidates
    if members is not None:
        of = members.filter("seeded").select("id", "rep")
        candidates = scratch.save(plain.select("id", "rank").join(of, "id").groupBy("rep").agg(F.min("rank").alias("rank")).select(F.col("rep").alias("id"), "rank"), "classes")
    rank = candidates.select("id", "rank")
    edges = pairs.join(rank.select(F.col("id").alias("q"), F.col("rank").alias("rq")), "q").join(rank.select(F.col("id").alias("s"), F.col("rank").alias("rs")), "s")
    edges = scratch.save(edges.filter(turn("rs") < turn("rq")).select("q", "s"), "edges-0")
    #: Decided nodes; a node without earlier neighbours has no row: it is kept.
    gone = None
    for round_ in range(1, 10_000):
        waiting = edges.select(F.col("q").alias("id")).distinct()
        # An edge from a node that waits for nothing decides its other end.
        new = scratch.save(edges.join(waiting.select(F.col("id").alias("s")), "s", "left_anti").select(F.col("q").alias("id")).distinct(), f"gone-{round_}")
        gone = new if gone is None else gone.unionByName(new)
        # What is gone neither waits nor counts.
        left = edges.join(new.select(F.col("id").alias("q")), "q", "left_anti").join(new.select(F.col("id").alias("s")), "s", "left_anti")
        edges = scratch.save(left.select("q", "s"), f"edges-{round_}")
        scratch.drop(f"edges-{round_ - 1}")
        if edges.isEmpty():
            break
    if members is None:
        return plain.join(gone, "id", "left_anti")
    earliest = candidates.join(gone, "id", "left_anti").select(F.col("id").alias("rep"), F.col("rank").alias("first"))
    placed = plain.select("id", "rank").join(of, "id").join(earliest, "rep", "left")
    dropped = placed.filter(F.col("first").isNull() | (turn("rank") > turn("first"))).select("id")
    return plain.join(dropped, "id", "left_anti")


def prefixes(ranked: DataFrame, batch: int | None, first: int, growth: int) -> list[int]:
    """Ranks that cut the order into prefixes of about first, first x growth, ... candidates; none lies inside a batch.

    Any cuts give the same choice; these come from approximate shares, a few numbers.
    """
    n = ranked.count()
    sizes = []
    while first < n:
        sizes.append(first)
        first *= growth
    if not sizes:
        return []
    at = ranked.agg(F.percentile_approx("rank", [x / n for x in sizes], 10_000).alias("at")).first()["at"]
    step = batch or 1
    return sorted({(x // step + 1) * step for x in at})


def one_batch(ranked: DataFrame, batch: int) -> bool:
    """Whether all candidates are of one batch: none of them is compared with another."""
    ends = ranked.agg(F.min(F.expr(f"rank div {batch}")).alias("low"), F.max(F.expr(f"rank div {batch}")).alias("high")).first()
    return ends["low"] == ends["high"]


def greedy_choice(reads: DataFrame, ranked: DataFrame, *, batch: int | None = None, first: int = FIRST, growth: int = GROWTH, k: int = 28, **more) -> DataFrame:
    """The greedy choice among reads (id, seq) in the order of ranked (id, rank): rows of ranked.

    Each prefix of the order is compared with what was kept of those before it, by the keys that are kept with it, and only
    what is left with itself, if it is of several batches: of n near copies nearly all meet one that is kept, not each other.
    """
    scratch = Scratch(reads.sparkSession, "choice")
    # Both are read several times.
    reads, ranked = scratch.save(reads.select("id", "seq"), "reads"), scratch.save(ranked, "ranked")
    cuts = prefixes(ranked, batch, first, growth)
    index, kept = KeyIndex(reads.sparkSession, f"{scratch.path}/index", k), None
    for n, (low, high) in enumerate(zip([None, *cuts], [*cuts, None])):
        part = ranked
        if low is not None:
            part = part.filter(F.col("rank") >= low)
        if high is not None:
            part = part.filter(F.col("rank") < high)
        alone = batch is not None and one_batch(part, batch)
        own = reads.select("id", "seq").join(part.select("id"), "id", "left_semi") if cuts else reads.select("id", "seq")
        if index.parts:
            own = scratch.save(own, f"own-{n}")
            alike = similar_to(own, index, k=k, **more)
            part, own = part.join(alike, "id", "left_anti"), own.join(alike, "id", "left_anti")
        if alone:
            chosen = scratch.save(part, f"chosen-{n}")
        else:
            found = similar_texts(own, k=k, **more)
            chosen = scratch.save(greedy_dedup(part, found.pairs, members=found.members, batch=batch, scratch=found.scratch), f"chosen-{n}")
            found.close()
        if high is not None:
            index.add(own.join(chosen.select("id"), "id", "left_semi"))
        scratch.drop(f"own-{n}")
        kept = chosen if kept is None else kept.unionByName(chosen)
    return kept.select(ranked.columns)


def diversity_penalty(candidates: DataFrame, previous: DataFrame | KeyIndex, **more) -> DataFrame:
    """(attempt, penalty): how many of each attempt's genomes are similar to earlier replicates' ones.

    candidates: attempt, id, seq; the similarity join runs once for all attempts.
    """
    distinct = candidates.select("id", "seq").dropDuplicates(["id"])
    similar = similar_to(distinct, previous if isinstance(previous, KeyIndex) else previous.select("id", "seq"), **more).withColumn("similar", F.lit(1))
    return candidates.join(similar, "id", "left").groupBy("attempt").agg(F.count_distinct(F.when(F.col("similar") == 1, F.col("id"))).alias("penalty"))


def best_attempt(penalties: DataFrame) -> DataFrame:
    """The attempt of the smallest penalty, the first of equals."""
    return penalties.agg(F.min_by("attempt", F.struct("penalty", "attempt")).alias("attempt"), F.min("penalty").alias("penalty"))
