"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the bytes of a text cuts it into chunks wherever the last 32 bytes hash to a
given pattern, so a passage that many documents share falls into the same chunks in each.  A task
keeps the encodings of the chunks it has met and encodes each distinct one once.  A cut can fall
inside a word, where the two sides' tokens are not those of the whole text; each join is therefore
repaired: the text from the last whole word before it to the first one after it is encoded again, and
the new tokens must begin and end with those that the two chunks have for these words.  Where they
don't, the text is taken over twice as many words on each side, until both ends agree or the window is the
whole text.  ``tests/llm`` holds the result against the library on whole texts.

Below the chunks, words that came before are not encoded again either.  Both stores are bounded;
when one is full it is emptied, which costs time and changes no result.

Decoding joins the tokens' strings by spaces where the tokenizer has no decoder of its own, as the library
does, and otherwise is the library's on the whole text's ids.

Edge cases: a null text is encoded as an empty one, with no tokens; a very long text without
white space is one repair that spans all its chunks, whose bytes are joined once; rows are independent, so repeated rows and
ids (and null ids) give repeated results; extra columns are not read; an empty table gives an
empty result.  The store of chunks is a task's own: a chunk that two tasks meet is encoded twice.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from readloom.llm.tables import ids_and_texts, table
from readloom.llm.words import as_bytes, odd_constants, row_slices

#: Mean bytes of a chunk, and how many entries of each kind a task keeps.
CHUNK_BYTES, KEPT_CHUNKS, KEPT_WORDS, KEPT_JOINS, LONGEST_KEPT_WORD = 512, 20_000, 200_000, 100_000, 64

_gear = (odd_constants(256, 23) >> np.uint64(32)).astype(np.uint32)
_SPACE = b" \n\t\r\x0b\x0c"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def chunk_cuts(raw: np.ndarray, chunk_bytes: int = CHUNK_BYTES) -> np.ndarray:
    """Offsets at which a chunk begins: where the gear hash of the 32 bytes before has its low bits zero.

    The hash sums shifted table entries, so it is built by doubling the window: 1, 2, ... 32 bytes.
    Cuts never fall inside a UTF-8 character.
    """
    h = _gear[raw]
    for width in (1, 2, 4, 8, 16):
        wider = h.copy()
        wider[width:] += h[:-width] << np.uint32(width)
        h = wider
    at = np.flatnonzero((h >> np.uint32(32 - chunk_bytes.bit_length() + 1)) == 0) + 1
    at = at[at < len(raw)]
    return at[(raw[at] & 0xC0) != 0x80]


def byte_letters() -> dict[int, str]:
    """The letter that byte-level BPE writes for each byte: printable Latin-1 as it is, the rest from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b if b in plain else next(others)) for b in range(256)}


_letters = byte_letters()
#: A word of Latin letters and then signs: one or two pre-tokens, of characters that normalisation leaves alone but for case.
PLAIN_WORD = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?%#$&*|()/_=+@\"-]*)")


def as_letters(text: str) -> str:
    return text if text.isascii() and text.isprintable() and " " not in text else "".join([_letters[b] for b in text.encode()])


NOTHING = (0, "", "")


def added(entries: list) -> tuple[int, str, str]:
    some = [e for e in entries if e[0]]
    return sum([e[0] for e in some]), " ".join([e[1] for e in some]), " ".join([e[2] for e in some])


def between(ids: list[int], first, last, vocabulary: dict[int, str]) -> tuple[int, str, str] | None:
    """The entry of the ids between first's and last's, or None if ids don't begin and end with those."""
    texts, n = [str(i) for i in ids], len(ids)
    if n < first[0] + last[0] or " ".join(texts[: first[0]]) != first[1] or " ".join(texts[n - last[0] :]) != last[1]:
        return None
    inner = ids[first[0] : n - last[0]]
    return len(inner), " ".join(texts[first[0] : n - last[0]]), " ".join([vocabulary[i] for i in inner])


def window_at(parts: list, at: int) -> tuple[bytes, bytes, bytes]:
    """The word before the join that is part `at`, the text at it, and the word after."""
    before = parts[at - 1] if at else None
    after = parts[at + 1] if at + 1 < len(parts) else None
    return (before.words[-1] if before and before.words else b""), parts[at].text, (after.words[0] if after and after.words else b"")


class Part(NamedTuple):
    """What a chunk, or the text at a join, adds to a row: its text, and its words if it has whole ones."""

    text: bytes
    words: tuple[bytes, ...]


Entry = tuple[int, str, str]  # number of ids, the ids and the tokens, each joined by one space


class ChunkedCodec:
    """Encodes and decodes with a tokenizer; joins of chunks are repaired until both sides agree."""

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        self.vocabulary = {i: t for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.model = self.tokenizer.model
        self.stems: dict[str, Entry] = {}
        self.words: dict[bytes, Entry] = {}
        self.chunks: dict[bytes, tuple[bytes, tuple[bytes, ...] | None, bytes]] = {}
        self.inner: dict[bytes, Entry] = {}
        self.joins: dict[tuple[bytes, bytes, bytes], Entry | None] = {}
        self.met = self.encoded = self.repaired = self.widened = 0
        # White space must end tokens and leave none, and plain words must be what the model alone makes of them.
        alone = lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids
        probe = ["Plain", "words,", "don't", "Über-all", "x1"]
        if alone(" \n".join(probe)) != [i for w in probe for i in alone(w)] or any(self.encode_words({w.encode()})[w.encode()] != self.entry(alone(w)) for w in probe):
            raise ValueError(f"{path}: a tokenizer of another kind, whose words can't be encoded one by one")

    def split(self, chunk: bytes) -> tuple[bytes, tuple[bytes, ...] | None, bytes]:
        """(open word at the start, whole words, open word at the end); None if no white space is in it."""
        words = chunk.split()
        head = tail = b""
        if chunk[:1] not in _SPACE and len(words) and words[0] != chunk:
            head = words.pop(0)
        elif len(words) and words[0] == chunk:
            return chunk, None, b""
        if words and chunk[-1:] not in _SPACE:
            tail = words.pop()
        return head, tuple(words), tail

    def encode_words(self, new: set[bytes]) -> dict[bytes, Entry]:
        if not new:
            return {}
        out, odd = {}, []
        for word in new:
            text = word.decode("utf-8", "replace")
            if m := PLAIN_WORD.fullmatch(text):  # its pre-tokens are plain: only the library's merges are needed
                stem, signs = m.groups()
                got = self.stem(stem.lower())
                if signs:
                    got = added([got, self.stem(signs)])
                out[word] = got
            else:
                odd.append((word, text))
        if odd:
            for (word, _), e in zip(odd, self.tokenizer.encode_batch_fast([t for _, t in odd], add_special_tokens=False)):
                out[word] = self.entry(e.ids)
        return out

    def entry(self, ids: list[int]) -> tuple[int, str, str]:
        vocabulary = self.vocabulary
        return len(ids), " ".join([str(i) for i in ids]), " ".join([vocabulary[i] for i in ids])

    def stem(self, text: str) -> tuple[int, str, str]:
        got = self.stems.get(text)
        if got is None:
            tokens = self.model.tokenize(as_letters(text))
            got = len(tokens), " ".join([str(t.id) for t in tokens]), " ".join([t.value for t in tokens])
            if len(text) <= LONGEST_KEPT_WORD:
                if len(self.stems) >= KEPT_WORDS:
                    self.stems.clear()
                self.stems[text] = got
        return got

    def plan(self, data: bytes, bounds: list[int]) -> list[Part]:
        """The parts of one row: chunks with whole words, and between them the texts at the joins."""
        parts: list[Part] = []
        open_: list[bytes] = []  # the pieces of a word that goes on
        for lo, hi in zip(bounds, bounds[1:]):
            if lo == hi:
                continue
            chunk = data[lo:hi]
            self.met += 1
            entry = self.chunks.get(chunk)
            if entry is None:
                self.encoded += 1
                if len(self.chunks) >= KEPT_CHUNKS:
                    self.chunks.clear()
                entry = self.chunks[chunk] = self.split(chunk)
            head, whole, tail = entry
            if whole is None:  # no white space in it: the word goes on into the next chunk
                open_.append(chunk)
                continue
            if open_ or head:
                parts.append(Part(b"".join([*open_, head]), ()))
            if whole:
                parts.append(Part(chunk, whole))
            open_ = [tail] if tail else []
        if open_:
            parts.append(Part(b"".join(open_), ()))
        return parts

    def repair(self, wanted: set[tuple[bytes, bytes, bytes]], known) -> None:
        """Encodes the windows (word before, text at the join, word after) and keeps what agrees, else None."""
        new = sorted(w for w in wanted if w not in self.joins)
        texts = [b" ".join([x for x in w if x]).decode("utf-8", "replace") for w in new]
        for w, e in zip(new, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            self.joins[w] = between(e.ids, known(w[0]) if w[0] else NOTHING, known(w[2]) if w[2] else NOTHING, self.vocabulary)

    def widened_row(self, row: bytes, parts: list[Part], bad: list[int], known) -> Entry:
        """The row with the join that didn't agree encoded over more and more words; with several such, whole."""
        self.widened += 1
        at, reach = bad[0], 2
        before = [w for p in parts[:at] for w in (p.words or (p.text,))]
        after = [w for p in parts[at + 1 :] for w in (p.words or (p.text,))]
        while len(bad) == 1 and reach < min(len(before), len(after)):
            left, right = known(before[-reach]), known(after[reach - 1])
            window = b" ".join([*before[-reach:], parts[at].text, *after[:reach]]).decode("utf-8", "replace")
            inner = between(self.tokenizer.encode(window, add_special_tokens=False).ids, left, right, self.vocabulary)
            if inner is not None:
                return added([*map(known, before[:-reach]), left, inner, right, *map(known, after[reach:])])
            reach *= 2
        return self.entry(self.tokenizer.encode(row.decode("utf-8", "replace"), add_special_tokens=False).ids)

    def run(self, raw: np.ndarray, offsets: np.ndarray) -> Iterator[Entry]:
        """For each row: number of ids, the ids as text joined by one space, the decoded text."""
        data, cuts = raw.tobytes(), chunk_cuts(raw) if len(raw) else np.zeros(0, np.int64)
        spans = np.searchsorted(cuts, offsets)
        rows = [self.plan(data, [int(offsets[i]), *cuts[spans[i] : spans[i + 1]].tolist(), int(offsets[i + 1])]) for i in range(len(offsets) - 1)]
        needed: set[bytes] = set()
        fresh: dict[bytes, tuple[bytes, ...]] = {}
        windows: set[tuple[bytes, bytes, bytes]] = set()
        for parts in rows:
            for i, (text, whole) in enumerate(parts):
                if not whole:
                    windows.add(window_at(parts, i))
                elif text not in self.inner and text not in fresh:
                    fresh[text] = whole
                    needed.update([w for w in whole if w not in self.words])
        needed |= {w for before, _, after in windows for w in (before, after) if w and w not in self.words}
        new = self.encode_words(needed)
        known = lambda w: self.words.get(w) or new.get(w) or self.encode_words({w})[w]
        self.repaired += len(windows)
        self.repair(windows, known)
        made = {chunk: added([known(w) for w in whole]) for chunk, whole in fresh.items()}
        for i, parts in enumerate(rows):
            got = [(self.inner.get(text) or made[text]) if whole else self.joins[window_at(parts, n)] for n, (text, whole) in enumerate(parts)]
            bad = [n for n, g in enumerate(got) if g is None]
            entry = self.widened_row(data[int(offsets[i]) : int(offsets[i + 1])], parts, bad, known) if bad else added(got)
            if self.tokenizer.decoder is not None:
                entry = (*entry[:2], self.tokenizer.decode([int(x) for x in entry[1].split()], skip_special_tokens=False))
            yield entry
        if len(self.words) + len(new) > KEPT_WORDS:
            self.words.clear()
        self.words.update((k, v) for k, v in new.items() if len(k) <= LONGEST_KEPT_WORD)
        if len(self.inner) + len(made) > KEPT_CHUNKS:
            self.inner.clear()
        self.inner.update(made)
        if len(self.joins) > KEPT_JOINS or any(len(w[1]) > LONGEST_KEPT_WORD for w in windows):
            self.joins.clear()


def encode_decode(docs: DataFrame, path: str, *, with_texts: bool = True) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked, ids and decoded text."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if with_texts else "")
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
        for batch in batches:
            for piece in row_slices(batch, "text"):
                codec = codec or ChunkedCodec(path)
                n, ids_sha, text_sha, ids, texts = [], [], [], [], []
                for count, listed, decoded in codec.run(*as_bytes(piece.column("text"))):
                    n.append(count)
                    ids_sha.append(sha(listed))
                    text_sha.append(sha(decoded))
                    if with_texts:
                        ids.append([int(x) for x in listed.split()])
                        texts.append(decoded)
                arrays = [piece.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
                if with_texts:
                    arrays += [pa.array(ids, pa.list_(pa.int32())), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names[: len(arrays)])

    return ids_and_texts(docs).mapInArrow(work, schema)


def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), with_texts=False)


QUERIES = {"op2_bpe_codec": op2_bpe_codec}
