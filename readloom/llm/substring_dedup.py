"""Removal of repeated passages, found by difference-cover anchors.

A window is 13 consecutive words; a word goes if a window over it also starts in a document with a
smaller doc_id.  Windows are judged on the input.  Positions modulo 7 in {1, 2, 4} are a difference
cover: for any two positions i and j there is a shift below 7 that takes both into it.  So of any
two equal windows, some run of 7 words stands at cover positions in both; only those runs (3 of 7)
are hashed and moved.

1. Anchors: runs at cover positions, by hash; those that two documents share are flagged.
2. Extension: windows over a flagged anchor, and no others, are hashed whole (96 bits); of each hash
   the smallest doc_id is found, and windows of larger ones are repeats.
3. Words under repeats are removed.

Answers go back packed too, a row for each hash range and part of the documents; a task reads the
answers for a part and then streams the part's texts.  What is moved is packed: a task combines the anchors (windows) of its texts by hash first, so a
passage that a third of all documents share counts once a slice of text, and no key gathers a row
per document.  Rows are dealt by hash range, each range to its own task, and a reducer sorts one range at a time.

Edge cases: a null, empty or blank text has no words, and keeps the empty text; fewer than 13 words
have no window; rows of one doc_id don't count as other documents; rows with a null doc_id have nothing
removed and remove nothing; extra columns are not read by the query; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from readloom.llm.scratch import Scratch
from readloom.llm.tables import ids_and_texts, power_of_two, table, text_bytes
from readloom.llm.words import SPACED, ngrams, read_words, row_slices

#: Words of a window; the cover's period and positions; words of an anchor (a window has one at each shift).
WINDOW, PERIOD, COVER = 13, 7, (1, 2, 4)
ANCHOR = WINDOW - PERIOD + 1
#: Bytes of text that a task combines at once, and that a hash range stands for; the least number of ranges, and tasks at most.
SLICE_BYTES, RANGE_BYTES, LEAST_RANGES, MOST_TASKS = 3 << 20, 16 << 20, 8, 1 << 15

_PACKED = "range int, docs array<long>, hashes binary, checks binary, doc_of binary, places binary"


def _empty(n: int) -> np.ndarray:
    return np.zeros(n, np.int64)


def _positions(words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place in its row, and words from there to the row's end, of every word."""
    counts = words.counts
    row = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(words.hash)) - words.first[:-1][row]
    return row, place, counts[row] - place


def _grouped(hashes: np.ndarray, checks: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """A sort order, and where in it a new hash begins."""
    order = np.argsort(hashes, kind="stable") if checks is None else np.lexsort((checks, hashes))
    h = hashes[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    if checks is not None:
        c = checks[order]
        new[1:] |= c[1:] != c[:-1]
    return order, new


def _low_high(values: np.ndarray, order: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest value of each one's group, in the values' own order."""
    at = np.flatnonzero(new)
    v = values[order]
    size = np.diff(np.append(at, len(v)))
    low, high = np.empty_like(v), np.empty_like(v)
    low[order], high[order] = np.repeat(np.minimum.reduceat(v, at), size), np.repeat(np.maximum.reduceat(v, at), size)
    return low, high


def _short(hashes: np.ndarray, shift: int) -> bytes:
    """40 bits of each hash below the range's own: two anchors that agree in them and differ elsewhere only add windows to look at."""
    low = (hashes >> np.uint64(24 - shift if shift <= 24 else 0)) & np.uint64((1 << 40) - 1)
    return (low & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes() + (low >> np.uint64(32)).astype(np.uint8).tobytes()


def _long(packed: bytes) -> np.ndarray:
    n = len(packed) // 5
    return np.frombuffer(packed, np.uint32, n).astype(np.uint64) | np.frombuffer(packed, np.uint8, n, 4 * n).astype(np.uint64) << np.uint64(32)


def _pack(shift: int, docs: np.ndarray, hashes, checks, row, place, known) -> Iterator[dict]:
    """A row for each hash range: what the range must decide, and (as hash-free entries) what is known."""
    part = (hashes >> np.uint64(64 - shift)).astype(np.int64) if shift else _empty(len(hashes))
    order = np.lexsort((place, row, part))
    bounds = np.flatnonzero(np.diff(part[order], prepend=-1))
    for a, b in zip(bounds.tolist(), [*bounds[1:].tolist(), len(order)]):
        at = order[a:b]
        held, index = np.unique(row[at], return_inverse=True)
        yield {
            "range": int(part[at[0]]), "docs": docs[held].tolist(), "hashes": _short(hashes[at], shift) if checks is None else hashes[at].tobytes(), "checks": b"" if checks is None else checks[at].tobytes(),
            "doc_of": (index.astype(np.int32) * 2 + known[at]).tobytes(), "places": place[at].astype(np.int32).tobytes(),
        }


def _batch(rows: list[dict]) -> pa.RecordBatch:
    types = [pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    names = ["range", "docs", "hashes", "checks", "doc_of", "places"]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, types)], names)


def _combine(ids: np.ndarray, hashes, checks, row, place, by_smaller: bool, shift: int) -> Iterator[dict]:
    """Combines one slice's entries.

    Anchors (by_smaller false): one that two of the slice's documents have is known to be shared;
    one occurrence of it goes to its range, for other slices' sake, and the others only as known.
    Windows (by_smaller true): those of a document other than the slice's smallest are known repeats.
    """
    if not len(hashes):
        return
    order, new = _grouped(hashes, checks)
    low, high = _low_high(ids[row], order, new)
    known = ids[row] > low if by_smaller else low != high
    asks = ~known
    if not by_smaller:  # of each group one that asks, known or not
        asks[order[new]] = True
    told = known & ~asks
    yield from _pack(shift, ids, hashes[asks], None if checks is None else checks[asks], row[asks], place[asks], known[asks])
    if told.any():  # no question left: to any range, without hashes
        rows, places = row[told], place[told]
        order = np.lexsort((places, rows))
        held, index = np.unique(rows[order], return_inverse=True)
        yield {
            "range": int(mix_range(ids[held[0]], shift)), "docs": ids[held].tolist(), "hashes": b"", "checks": b"",
            "doc_of": index.astype(np.int32).tobytes(), "places": places[order].astype(np.int32).tobytes(),
        }


def mix_range(doc_id: int, shift: int) -> int:
    return (int(doc_id) * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> (64 - shift) if shift else 0


def part_of(ids: np.ndarray, parts: int) -> np.ndarray:
    return (ids ^ (ids >> 7) ^ (ids >> 17)) % parts


def _part_column(parts: int):
    """The same of a column; texts without an id are dealt by themselves."""
    i = F.coalesce("doc_id", F.xxhash64("text"))
    return F.pmod(i.bitwiseXOR(F.shiftright(i, 7)).bitwiseXOR(F.shiftright(i, 17)), F.lit(parts)).cast("int")


def _with_places(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of texts, with the places that were found in each; a part's answers come before its texts."""
    part, held, ids, places = None, [], np.zeros(0, np.int64), np.zeros(0, np.int32)
    for batch in batches:
        key = batch.column("part").to_numpy().astype(np.int64) * 2 + batch.column("kind").to_numpy()
        bounds = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
        for a, b in zip(bounds, bounds[1:]):
            if a == b:
                continue
            run = batch.slice(a, b - a)
            if key[a] >> 1 != part:
                part, held, ids, places = key[a] >> 1, [], np.zeros(0, np.int64), np.zeros(0, np.int32)
            if key[a] % 2 == 0:
                held += [(np.array(d, np.int64)[np.frombuffer(o, np.int32)], np.frombuffer(p, np.int32)) for d, o, p in zip(*(run.column(c).to_pylist() for c in ("docs", "doc_of", "places")))]
                continue
            if held:
                ids, places = np.concatenate([ids, *(x for x, _ in held)]), np.concatenate([places, *(x for _, x in held)])
                order = np.argsort(ids, kind="stable")
                ids, places, held = ids[order], places[order], []
            for piece in row_slices(run, "text", SLICE_BYTES):
                wanted = piece.column("doc_id").fill_null(0).to_numpy()
                lo, hi = np.searchsorted(ids, wanted, "left"), np.searchsorted(ids, wanted, "right")
                known = piece.column("doc_id").is_valid().to_pylist()
                yield piece, [np.unique(places[x:y]) if k else places[:0] for x, y, k in zip(lo.tolist(), hi.tolist(), known)]


def _anchors(shift: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in row_slices(batch, "text", SLICE_BYTES):
                words = read_words(piece.column("text"), SPACED)
                row, place, left = _positions(words)
                grams = ngrams(words.hash, ANCHOR)
                at = np.flatnonzero(np.isin(place % PERIOD, COVER) & (left >= ANCHOR) & (words.counts[row] >= WINDOW))
                rows = list(_combine(piece.column("doc_id").to_numpy(), grams[at], None, row[at], place[at], False, shift))
                if rows:
                    yield _batch(rows)

    return work


def _windows(shift: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, found in _with_places(batches):
            some = np.flatnonzero([len(x) > 0 for x in found])
            if not len(some):
                continue
            piece, found = piece.take(pa.array(some)), [found[i] for i in some]
            words = read_words(piece.column("text"), SPACED)
            row, place, left = _positions(words)
            over = np.zeros(len(words.hash) + 1, np.int32)
            for first, p in zip(words.first.tolist(), found):
                np.add.at(over, first + np.maximum(p.astype(np.int64) - PERIOD + 1, 0), 1)
                np.add.at(over, first + p.astype(np.int64) + 1, -1)
            at = np.flatnonzero((np.cumsum(over[:-1]) > 0) & (left >= WINDOW))
            if not len(at):
                continue
            hashes, checks = ngrams(words.hash, WINDOW), (ngrams(words.hash, WINDOW, seed=7) >> np.uint64(32)).astype(np.uint32)
            rows = list(_combine(piece.column("doc_id").to_numpy(), hashes[at], checks[at], row[at], place[at], True, shift))
            if rows:
                yield _batch(rows)

    return work


def _decide(by_smaller: bool, parts: int):
    """Reads rows in order of range; for each range gives (doc_id, places) of what is shared, or repeated."""

    def answer(rows: list[dict]) -> Iterator[dict]:
        told = [(np.array(r["docs"], np.int64)[np.frombuffer(r["doc_of"], np.int32)], np.frombuffer(r["places"], np.int32)) for r in rows if not r["hashes"]]
        rows = [r for r in rows if r["hashes"]]
        if rows:
            hashes = np.concatenate([np.frombuffer(r["hashes"], np.uint64) if by_smaller else _long(r["hashes"]) for r in rows])
            checks = np.concatenate([np.frombuffer(r["checks"], np.uint32) for r in rows]) if by_smaller else None
            coded = [np.frombuffer(r["doc_of"], np.int32) for r in rows]
            ids = np.concatenate([np.array(r["docs"], np.int64)[c >> 1] for r, c in zip(rows, coded)])
            known = (np.concatenate(coded) & 1).astype(bool)
            places = np.concatenate([np.frombuffer(r["places"], np.int32) for r in rows])
            low, high = _low_high(ids, *_grouped(hashes, checks))
            hit = ids > low if by_smaller else known | (low != high)
            told.append((ids[hit], places[hit]))
        if not told:
            return
        ids, places = np.concatenate([x for x, _ in told]), np.concatenate([x for _, x in told])
        part = part_of(ids, parts)
        order = np.lexsort((places, ids, part))
        ids, places, part = ids[order], places[order], part[order]
        bounds = np.flatnonzero(np.diff(part, prepend=-1))
        for a, b in zip(bounds.tolist(), [*bounds[1:].tolist(), len(ids)]):
            held, index = np.unique(ids[a:b], return_inverse=True)
            yield {"part": int(part[a]), "docs": held.tolist(), "doc_of": index.astype(np.int32).tobytes(), "places": places[a:b].astype(np.int32).tobytes()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None

        def out(rows: list[dict]) -> Iterator[pa.RecordBatch]:
            found = list(answer(rows))
            types = {"part": pa.int32(), "docs": pa.list_(pa.int64()), "doc_of": pa.binary(), "places": pa.binary()}
            for i in range(0, len(found), 256):
                yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in found[i : i + 256]], t) for n, t in types.items()], list(types))

        for batch in batches:
            for r in batch.to_pylist():
                if r["range"] != at:
                    if held:
                        yield from out(held)
                    held, at = [], r["range"]
                held.append(r)
        if held:
            yield from out(held)

    return work


def _strip(window: int, columns: list[str]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, places in _with_places(batches):
            ids, n_words, n_removed, texts, digests = [], [], [], [], []
            for doc_id, text, p in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist(), places):
                words = (text or "").encode().split()
                removed = 0
                if len(p):
                    cover = np.zeros(len(words) + 1, np.int32)
                    cover[p] += 1
                    np.subtract.at(cover, p + window, 1)
                    gone = np.cumsum(cover[:-1]) > 0
                    removed = int(gone.sum())
                kept = b" ".join([words[i] for i in np.flatnonzero(~gone).tolist()] if removed else words)
                ids.append(doc_id)
                n_words.append(len(words))
                n_removed.append(removed)
                texts.append(kept.decode() if "kept_text" in columns else None)
                digests.append(hashlib.sha256(kept).hexdigest())
            made = {
                "doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
                "kept_sha256": pa.array(digests, pa.string()), "kept_text": pa.array(texts, pa.string()),
            }
            yield pa.RecordBatch.from_arrays([made[c] if c in made else piece.column(c) for c in columns], columns)

    return work


def remove_repeats(docs: DataFrame, *, carry: list[str] | None = None, with_text: bool = True) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 and, if asked, kept_text.

    With carry, also text and, in the struct `more`, the columns named there, unchanged, whatever their names.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "repeats")
    pairs = ids_and_texts(docs)
    carried = carry is not None
    more = F.struct(*[F.col(f"`{c}`") for c in carry] or [F.lit(0).alias("none")]) if carried else None
    whole = pairs if more is None else docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), more.alias("more"))
    known = pairs.filter("doc_id is not null")
    ranges = power_of_two(max(text_bytes(pairs) / RANGE_BYTES, LEAST_RANGES))
    shift = ranges.bit_length() - 1

    def decided(packed: DataFrame, by_smaller: bool) -> DataFrame:
        dealt = packed.repartitionById(min(ranges, MOST_TASKS), F.col("range")).sortWithinPartitions("range")
        return dealt.mapInArrow(_decide(by_smaller, ranges), "part int, docs array<long>, doc_of binary, places binary")

    def joined(texts: DataFrame, answers: DataFrame) -> DataFrame:
        """Answers and texts of each part together, the answers first."""
        rows = texts.select(_part_column(ranges).alias("part"), F.lit(1).alias("kind"), *texts.columns).unionByName(answers.withColumn("kind", F.lit(0)), allowMissingColumns=True)
        return rows.repartitionById(min(ranges, MOST_TASKS), F.col("part")).sortWithinPartitions("part", "kind")

    shared = scratch.save(decided(known.mapInArrow(_anchors(shift), _PACKED), False), "anchors")
    repeats = scratch.save(decided(joined(known, shared).mapInArrow(_windows(shift), _PACKED), True), "windows")
    scratch.drop("anchors")
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256", *["kept_text"] * with_text, *["text", "more"] * carried]
    types = {"doc_id": T.LongType(), "n_words": T.LongType(), "n_removed": T.LongType(), "kept_sha256": T.StringType(), "kept_text": T.StringType(), "text": T.StringType(), "more": whole.schema["more"].dataType if carried else None}
    out = joined(whole, repeats).mapInArrow(_strip(WINDOW, columns), T.StructType([T.StructField(c, types[c]) for c in columns]))
    return out


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


QUERIES = {"op10_substring_dedup": op10_substring_dedup}
