"""Benchmark decontamination by CGK random-walk embedding and bit-sampling LSH.

A document is contaminated by an item if some run of its words lies within an edit distance of the
item of a fifth of the item's words.  Words are runs of letters and digits, A-Z lower-cased; a
word put in, left out or replaced is one edit.

* Items and item-sized windows are sequences of word hashes.  The CGK walk reads a sequence over
  3 x size steps; at each step it emits the word it stands on and moves on, or not, as a random
  bit of (step, word) says.  Few edits leave most of the two walks' outputs equal, so edit distance
  becomes Hamming distance.
* Bit sampling: a key is the words at a few sampled steps of the walk.  Step 0, the window's first
  word, is always sampled, which makes it the cheap first test of a window; for an edit there, an item is
  embedded from several starts, long words (which are rare ones), each with the rest of the item as its window.
  There are as many keys per start as reach the target recall: the share of equal steps between items (of a
  size, SAMPLE at most) and edited copies of them, at the threshold, is measured when the plan is made.
* Long items are embedded in pieces of about PIECE words, so windows, walks and the number of keys stay bounded:
  of an item within its bound one piece at least is within its own.  Such a piece's place gives the item's.
* Any window that shares a key with a piece is verified exactly: Myers' bit-vector algorithm gives the
  smallest edit distance between the whole piece and any run of words around the window, and, for an item of several pieces,
  that between the whole item and the words around each place that a piece gave it.

Items and windows meet in a join.  Items' keys are a table; documents are read once, whatever the number of items,
and a window is moved only if its first word begins an item's window of that size and one of its keys may be an
item's, as a bitmap of words and two of the keys' bits say, all of fixed size (a false answer costs a row).  A moved window is its keys and the words
around it that verification can need, at most four windows' worth; an item that a third of all documents hold makes
a few rows a document.

Items of fewer than LEAST_WORDS words, whose bound is 0, say too little to contaminate a text: they match nothing, and
short_items lists them.

Edge cases: null or empty texts and items match nothing; rows of one doc_id are one document (without an id, rows of
one text); a null doc_id or item_id stays null in the result; extra columns are not read; equal items are each
reported; an empty benchmark (or table) gives an empty result.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from readloom.llm.scratch import Scratch
from readloom.llm.tables import table
from readloom.llm.words import ALNUM_LOWER, WordTable, mix64, odd_constants, read_words, row_slices

#: Starts per item, and bytes of a long word; sampled steps per key besides step 0; least words of an item.
STARTS, LONG_WORD, SAMPLED, LEAST_WORDS = 6, 7, 2, 5
#: Words of a piece of an item; an item of up to half as many more is one piece.
PIECE = 96
#: Entries of a size whose edited copies are tried; bits of the bitmap of first words, and of each of the two of keys at most.
SAMPLE, WORD_BITS, KEY_BITS = 64, 20, 26
TARGET_RECALL, SIMILARITY, STRETCH = 0.99, 0.8, 3


def edit_bound(words: int, similarity: float = SIMILARITY) -> int:
    return int(words * (1 - similarity) + 1e-9)


def _mask(places: np.ndarray, m: int) -> int:
    bits = np.zeros(m, bool)
    bits[places] = True
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


#: Bytes of the masks that are kept at once.
MASK_BYTES = 64 << 20


def least_edits(pattern: Sequence, text: Iterable) -> int:
    """The smallest edit distance between pattern and any run of text's symbols (Myers' bit vectors).

    Of a long pattern the masks of rare symbols are made as they are met: those kept take MASK_BYTES at most.
    """
    m = len(pattern)
    if not m:
        return 0
    places: dict = defaultdict(list)
    for i, c in enumerate(pattern):
        places[c].append(i)
    often = m * m // 8 // MASK_BYTES  # at most m / often symbols stand more often, with m / 8 bytes each
    masks = {c: _mask(np.array(at), m) if len(at) > 8 else sum(1 << i for i in at) for c, at in places.items() if len(at) > often}
    full, high = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best = m
    for c in text:
        eq = masks.get(c)
        if eq is None:
            at = places.get(c, ())
            eq = _mask(np.array(at), m) if len(at) > 8 else sum(1 << i for i in at)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        rise, fall = down | (full & ~(diagonal | up)), up & diagonal
        score += 1 if rise & high else -1 if fall & high else 0
        rise, fall = (rise << 1) & full, (fall << 1) & full
        up, down = fall | (full & ~(diagonal | rise)), rise & diagonal
        best = min(best, score)
    return best


def walk(words: np.ndarray, at: np.ndarray, end: np.ndarray, steps: int) -> np.ndarray:
    """The CGK walks over words[at:end], one per row; beyond its end a walk emits 0."""
    out = np.zeros((len(at), steps), np.uint64)
    here = at.astype(np.int64).copy()
    salts = odd_constants(steps, 313)
    padded = np.append(words, np.uint64(0))
    for step in range(steps):
        word = padded[np.where(here < end, here, len(words))]
        out[:, step] = word
        here += (mix64(word ^ salts[step]) >> np.uint64(63)).astype(np.int64)
    return out


def keys_of(walked: np.ndarray, samples: np.ndarray) -> np.ndarray:
    """A key for each row and repeat: a hash of the sampled steps and step 0."""
    mult = odd_constants(samples.shape[1] + 1, 717)
    total = np.multiply(walked[:, 0], mult[-1])[:, None] + np.arange(len(samples), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for j in range(samples.shape[1]):
        total = total + walked[:, samples[:, j]] * mult[j]
    return mix64(total)


def _size_class(n: int) -> int:
    """Window sizes are dealt in steps of a quarter, so that items of like size share windows."""
    return int(round(4 * math.log2(max(n, 1))))


def starts_of(lengths: list[int]) -> list[int]:
    """Words that an item is embedded from: its longest ones among those that leave two fifths of it behind them."""
    order = sorted(range(max(1, int(0.6 * len(lengths) + 0.5))), key=lambda s: (-lengths[s], s))[:STARTS]
    return [s for rank, s in enumerate(order) if rank < 3 or lengths[s] >= LONG_WORD]


def pieces_of(n: int) -> list[int]:
    """Where the pieces of an item of n words begin and end."""
    parts = max(1, -(-n // PIECE)) if n > PIECE + PIECE // 2 else 1
    return [n * i // parts for i in range(parts + 1)]


_PIECES = "item_id long, n long, words binary, pieces array<struct<at: long, n: long, words: binary, starts: array<long>, sizes: array<long>, firsts: array<long>>>"


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each item's words, packed, and its pieces: their words, their starts, and those's window sizes and first words."""
    many = pa.list_(pa.int64())
    kind = pa.list_(pa.struct([("at", pa.int64()), ("n", pa.int64()), ("words", pa.binary()), ("starts", many), ("sizes", many), ("firsts", many)]))
    for batch in batches:
        for part in row_slices(batch, "item"):
            words = read_words(part.column("item"), ALNUM_LOWER)
            length = words.end - words.start
            packed, pieces = [], []
            for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
                cuts = pieces_of(b - a) if b - a >= LEAST_WORDS else [0]
                own = []
                for x, y in zip(cuts[:-1], cuts[1:]):
                    h = words.hash[a + x : a + y]
                    of = starts_of(length[a + x : a + y].tolist())
                    own.append({"at": x, "n": y - x, "words": h.tobytes(), "starts": of, "sizes": [_size_class(y - x - s) for s in of], "firsts": h[of].view(np.int64).tolist()})
                packed.append(words.hash[a:b].tobytes())
                pieces.append(own)
            yield pa.RecordBatch.from_arrays([part.column("item_id"), pa.array(np.diff(words.first), pa.int64()), pa.array(packed, pa.binary()), pa.array(pieces, kind)], ["item_id", "n", "words", "pieces"])


class SizeClass:
    """How windows of one size are embedded: their words, the walk's steps and the sampled ones."""

    def __init__(self, size: int, window: int, least: int, sample: list[np.ndarray], similarity: float, target: float):
        rng = np.random.default_rng([7, size])
        self.size, self.window = size, window
        repeats = self._repeats(sample, STRETCH * window, rng, similarity, target)
        # Steps that all the class's items reach on average.
        reach = max(2, min(STRETCH * window, STRETCH * least // 2))
        places = range(1, max(reach, SAMPLED + 1))
        if repeats >= math.comb(len(places), SAMPLED):
            self.samples = np.array(list(combinations(places, SAMPLED)))
        else:
            # Distinct places: the second is drawn among those that are left, and so on.
            drawn = np.stack([rng.integers(0, len(places) - i, repeats) for i in range(SAMPLED)], 1)
            for i in range(1, SAMPLED):
                earlier = np.sort(drawn[:, :i], 1)
                for k in range(i):
                    drawn[:, i] += drawn[:, i] >= earlier[:, k]
            self.samples = np.sort(drawn, 1) + places[0]
        self.salt = np.uint64((size + 1) * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF)

    @staticmethod
    def _repeats(sample: list[np.ndarray], steps: int, rng, similarity: float, target: float) -> int:
        """Keys needed for the target recall, from the share of equal steps with copies edited at the threshold."""
        shares = []
        for words in sample:
            hit = rng.random(len(words)) < 1 - similarity
            hit[0] = False
            kind = rng.integers(0, 3, len(words))
            new = []
            for w, h, k in zip(words, hit, kind):
                if not h:
                    new.append(w)
                elif k:  # replaced, or put before; else deleted
                    new += [np.uint64(rng.integers(1 << 62))] + [w] * int(k == 2)
            new = np.array(new, np.uint64)
            a, b = walk(words, np.array([0]), np.array([len(words)]), steps)[0], walk(new, np.array([0]), np.array([len(new)]), steps)[0]
            shares.append((a == b)[1:][a[1:] > 0].mean() if (a[1:] > 0).any() else 1.0)
        p = max(1 / steps, float(np.quantile(shares, 0.2))) ** SAMPLED
        return max(8, math.ceil(math.log(1 - target) / math.log(1 - min(p, 0.999))))

    def keys(self, words: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The keys of the windows words[at:end], a row each."""
        return mix64(keys_of(walk(words, at, end, int(self.samples.max()) + 1), self.samples) ^ self.salt)


def _item_keys(classes: dict[int, SizeClass]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes).tolist():
                some = batch.filter(pa.array(sizes == size))
                words = [np.frombuffer(w, np.uint64) for w in some.column("words").to_pylist()]
                base = np.concatenate([[0], np.cumsum([len(w) for w in words])])
                keys = classes[size].keys(np.concatenate(words), base[:-1] + some.column("start").to_numpy(), base[1:])
                each = pa.array(np.repeat(np.arange(len(keys)), keys.shape[1]))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), some.column("piece").take(each), some.column("start").take(each)], ["key", "piece", "start"])

    return work


def bitmap(rows: DataFrame, column: str, bits: int, *by: str) -> dict:
    """For each value of `by`, whether a 64-bit hash with these first bits is among the rows; built in Spark."""
    head = F.shiftrightunsigned(column, 64 - bits) + 1
    parts = rows.groupBy(*by, F.bitmap_bucket_number(head).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(head)).alias("bits")).collect()  # 4 KB for each 32,768 bits
    out: dict = defaultdict(lambda: np.zeros(1 << bits, bool))
    for r in parts:
        found = np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little").astype(bool)
        held, lo = out[tuple(r[c] for c in by)], (r["part"] - 1) * 32_768
        held[lo : lo + 32_768] |= found[: len(held) - lo]
    return out


class Plan:
    """What tasks need of a benchmark: its size classes and the bitmaps; a key may be an item's if both of its parts are told."""

    def __init__(self, classes: dict[int, SizeClass], first_words: dict[int, np.ndarray], key_bits: int, keys: list[np.ndarray]):
        self.classes, self.key_bits, self.keys = classes, key_bits, [np.packbits(k) for k in keys]
        self.order = sorted(classes)
        if len(self.order) > 64:  # sizes of pieces are bounded
            raise ValueError("PIECE is too long")
        self.first = np.zeros(1 << WORD_BITS, np.uint64)
        for bit, size in enumerate(self.order):
            self.first[first_words[size]] |= np.uint64(1 << bit)

    def _told(self, keys: np.ndarray, which: int) -> np.ndarray:
        head = (keys >> np.uint64(64 - self.key_bits)).astype(np.int64)
        return (self.keys[which][head >> 3] >> (7 - (head & 7)).astype(np.uint8) & 1).astype(bool)

    def candidates(self, words: WordTable) -> Iterator[tuple[int, int, int, np.ndarray]]:
        """(row, word, size, keys) of windows that may share these keys with an item."""
        h = words.hash
        if not len(h) or not self.order:
            return
        mask = self.first[h >> np.uint64(64 - WORD_BITS)]
        at = np.flatnonzero(mask)
        mask, row = mask[at], np.searchsorted(words.first, at, "right") - 1
        for bit, size in enumerate(self.order):
            where = np.flatnonzero(mask & np.uint64(1 << bit))
            for lo in range(0, len(where), 4096):
                w = where[lo : lo + 4096]
                p, kind = at[w], self.classes[size]
                keys = kind.keys(h, p, np.minimum(p + kind.window, words.first[row[w] + 1]))
                hit = self._told(keys, 0)
                hit[hit] = self._told(keys[hit] << np.uint64(self.key_bits), 1)
                for i in np.flatnonzero(hit.any(1)).tolist():
                    yield int(row[w[i]]), int(p[i]), size, np.unique(keys[i][hit[i]])


def _windows(plan: Plan):
    names = ["doc_id", "row", "place", "size", "base", "keys", "around"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in row_slices(batch, "text"):
                words = read_words(piece.column("text"), ALNUM_LOWER)
                ids, hashes = piece.column("doc_id"), piece.column("row")
                out = []
                for r, p, size, keys in plan.candidates(words):
                    # All that an item with such a window can need: it is no longer than 2.5 windows.
                    reach = 2 * plan.classes[size].window + 2
                    first, end = int(words.first[r]), int(words.first[r + 1])
                    lo = max(first, p - reach)
                    out.append((ids[r].as_py(), hashes[r].as_py(), p - first, size, lo - first, keys.view(np.int64).tolist(), words.hash[lo : min(end, p + reach)].tobytes()))
                    if len(out) == 4096:
                        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)], names)
                        out = []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)], names)

    return work


def _verify(similarity: float):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edits = []
            for place, base, around, start, words in zip(*(batch.column(c).to_pylist() for c in ("place", "base", "around", "start", "words"))):
                piece, text = np.frombuffer(words, np.uint64).tolist(), np.frombuffer(around, np.uint64)
                bound = edit_bound(len(piece), similarity)
                # The words around the window: the piece's extent, and what the edits may add on each side.
                a = max(0, place - start - bound - base)
                n = least_edits(piece, text[a : max(a, place - start + len(piece) + bound - base)].tolist())
                edits.append(n if n <= bound else None)
            names = ["doc_id", "row", "number", "item_id", "n", "at", "start"]
            found = pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(edits, pa.int64()), batch.column("place")], [*names, "edits", "at_word"])
            yield found.filter(found.column("edits").is_valid())

    return work


def _verify_whole(similarity: float):
    """Items of several pieces against the words around the places that a piece gave them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                item, text = np.frombuffer(one.column("words")[0].as_py(), np.uint64), read_words(one.column("text"), ALNUM_LOWER).hash
                bound, place = edit_bound(len(item), similarity), one.column("place")[0].as_py()
                # Places of one stretch of `bound` words; the true one is no further away than the bound, and so is the end.
                a = max(0, place * bound - 2 * bound)
                edits = least_edits(item.tolist(), text[a : (place + 1) * bound + len(item) + 2 * bound].tolist())
                if edits <= bound:
                    yield pa.RecordBatch.from_arrays([*(one.column(c) for c in ("doc_id", "row", "number", "item_id")), pa.array([edits]), one.column("at_word")], ["doc_id", "row", "number", "item_id", "edits", "at_word"])

    return work


def plan_of(benchmark: DataFrame, scratch: Scratch, similarity: float) -> tuple[Plan, tuple[DataFrame, DataFrame], DataFrame]:
    """The plan, the items (number, item_id, n, words) and their pieces (piece, number, item_id, n, at, words), and the pieces' keys (key, piece, start)."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("item")).mapInArrow(_items, _PIECES)
    items = scratch.save(items.filter(f"n >= {LEAST_WORDS}").withColumn("number", F.monotonically_increasing_id()), "items")
    pieces = items.select("number", "item_id", F.col("n").alias("whole"), F.explode("pieces").alias("p")).select("number", "item_id", "whole", "p.*")
    pieces = scratch.save(pieces.withColumn("piece", F.monotonically_increasing_id()), "pieces")
    entries = pieces.select("piece", "item_id", "n", "words", F.explode(F.arrays_zip("starts", "sizes", "firsts")).alias("x")).select("piece", "item_id", "n", "words", F.col("x.starts").alias("start"), F.col("x.sizes").alias("size"), F.col("x.firsts").alias("first"))
    tail = F.col("n") - F.col("start")
    extents = {r["size"]: r for r in entries.groupBy("size").agg(F.max(tail).alias("window"), F.min(tail).alias("least"), F.count("*").alias("n")).collect()}  # a row for each size
    rank = F.row_number().over(Window.partitionBy("size").orderBy(F.xxhash64("item_id", "start"), "piece", "start"))
    sample = defaultdict(list)
    for r in entries.withColumn("rank", rank).filter(F.col("rank") <= SAMPLE).sort("size", "rank").collect():  # SAMPLE a size
        sample[r["size"]].append(np.frombuffer(r["words"], np.uint64)[r["start"] :])
    classes = {size: SizeClass(size, e["window"], e["least"], sample[size], similarity, TARGET_RECALL) for size, e in extents.items()}
    keys = scratch.save(entries.select("piece", "words", "start", "size").mapInArrow(_item_keys(classes), "key long, piece long, start long").distinct(), "keys")
    first_words = {size: bits for (size,), bits in bitmap(entries, "first", WORD_BITS, "size").items()}
    n = sum(e["n"] * len(classes[size].samples) for size, e in extents.items())
    key_bits = min(KEY_BITS, max(16, math.ceil(math.log2(256 * max(n, 1)))))
    parts = [bitmap(keys.select(F.expr(part).alias("key")), "key", key_bits)[()] for part in ("key", f"shiftleft(key, {key_bits})")]
    return Plan(classes, first_words, key_bits, parts), (items.select("number", "item_id", "n", "words"), pieces.select("piece", "number", "item_id", F.col("whole").alias("n"), "at", "words")), keys


_FOUND = "doc_id long, row long, number long, item_id long, edits long, at_word long"


def matches(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, similarity: float) -> DataFrame:
    """(doc_id, row, number, item_id, edits, at_word) of all windows that are close enough to an item; row hashes the text."""
    plan, (items, pieces), keys = plan_of(benchmark, scratch, similarity)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("row", F.xxhash64("text"))
    windows = texts.mapInArrow(_windows(plan), "doc_id long, row long, place long, size long, base long, keys array<long>, around binary")
    windows = scratch.save(windows.withColumn("window", F.monotonically_increasing_id()), "windows")
    met = windows.select("window", F.explode("keys").alias("key")).join(keys, "key").select("window", "piece", "start").distinct()
    full = met.join(windows.drop("keys", "size"), "window").join(pieces, "piece")
    verified = full.select("doc_id", "row", "place", "base", "around", "number", "item_id", "n", "at", "start", "words")
    near = scratch.save(verified.mapInArrow(_verify(similarity), "doc_id long, row long, number long, item_id long, n long, at long, start long, edits long, at_word long"), "near")
    one_piece = F.col("n") <= PIECE + PIECE // 2
    found = near.filter(one_piece).select("doc_id", "row", "number", "item_id", "edits", "at_word")
    # Where the whole of a long item would begin, to the nearest `bound` words: a few places a document, however many pieces agree.
    begins = F.col("at_word") - F.col("start") - F.col("at")
    bound = F.greatest(F.lit(1), F.floor(F.col("n") * (1 - similarity) + 1e-9))
    long = near.filter(~one_piece).groupBy("doc_id", "row", "number", F.floor(begins / bound).cast("long").alias("place")).agg(F.min("at_word").alias("at_word"))
    long = scratch.save(long, "long")
    if not long.isEmpty():  # only then are texts read again
        held = texts.select(F.col("doc_id").alias("of"), F.col("row").alias("of_row"), "text")
        full = long.join(held, (F.col("row") == F.col("of_row")) & F.col("doc_id").eqNullSafe(F.col("of"))).dropDuplicates(["doc_id", "row", "number", "place"]).join(items.drop("n"), "number")
        whole = full.select("doc_id", "row", "number", "item_id", "place", "at_word", "text", "words").mapInArrow(_verify_whole(similarity), _FOUND)
        found = found.unionByName(whole)
    return scratch.save(found, "matches")


def contaminated(docs: DataFrame, benchmark: DataFrame, *, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, edits, at_word): a row for each item found in each document, its best window (of a long item, its first)."""
    scratch = Scratch(docs.sparkSession, "benchmark")
    found = matches(docs, benchmark, scratch, similarity)
    scratch.close("matches")
    unknown = F.when(F.col("doc_id").isNull(), F.col("row"))
    best = found.groupBy("doc_id", unknown.alias("text"), "number", "item_id").agg(F.min(F.struct("edits", "at_word")).alias("best"))
    return best.select("doc_id", "item_id", "best.edits", "best.at_word")


def short_items(benchmark: DataFrame) -> DataFrame:
    """(item_id, n): items of too few words to be looked for, and how many they have."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("item"))
    return items.mapInArrow(_items, _PIECES).filter(f"n < {LEAST_WORDS}").select("item_id", "n")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, similarity: float = SIMILARITY) -> DataFrame:
    """The documents in which no item is found, as they are."""
    scratch = Scratch(docs.sparkSession, "benchmark")
    found = matches(docs, benchmark, scratch, similarity).select(F.col("doc_id").alias("_found_id"), F.col("row").alias("_found_row")).distinct()
    scratch.close("matches")
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("_found_id")) & (F.xxhash64(docs["text"].cast("string")) == F.col("_found_row"))
    return docs.join(found, same, "left_anti")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op7_decontaminate": op7_decontaminate}
