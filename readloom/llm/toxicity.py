"""Toxicity: noisy-channel deobfuscation, then a learned score of the restored text.

1. Character language model: trigram counts over the whole corpus (A-Z folded, bytes beyond ASCII in
   a few classes, everything else a boundary).  Each partition sends its counts; their sum is bounded
   by the alphabet, 32 to the third.
2. Words that may be obfuscated (with a letter and a leet sign anywhere, separators between letters or a letter twice
   in a row, and single letters or leet signs in a row) become character lattices: a leet sign may stand for its
   letters, a separator for nothing, a repeated letter for one or two.  Viterbi decodes the likeliest letters under
   the channel and the language model; of a lattice with few paths all are tried, many words at once.  Of a row of single
   letters each stretch is decoded, in bounded blocks, as words before and after may be single letters too: when texts are scored,
   stretches of as many letters as the longest learned word has; when words are learned, of LEARNED_SPACED at most, and the whole row.
   All words are also taken as they are; one of signs alone is only that.
3. The score is a noisy-or over learned words, and starts of words, of the restored text:
   1 - (1 - base) x product of (1 - p) over the distinct learned ones in it, p being the share of toxic texts
   among the labelled ones that have it, and base that among those that have none.  Near copies count once
   in that share: texts with the same smallest word hash are one.  Spark counts, in two steps (the words of toxic
   texts, then which clean ones have them), and only learned words come to the driver.

Labels are learned only from rows whose crc32(doc_id as text) mod 4 is not 2, and of those at most SAMPLE, the
ones with the smallest hash of their doc_id.  No label, language, source or doc_id enters a score.

Edge cases: a null, empty or wordless text scores the base rate; labels without a document or with a
null are left out; with no labels the base is 0 and every score 0; repeated rows and ids (and null ids, not
held out) give repeated results; very long texts are scored whole; extra columns are not read; an empty
table gives an empty result.
"""

from __future__ import annotations

import functools
import math
import os.path
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm.scratch import Scratch
from readloom.llm.tables import ids_and_texts, table
from readloom.llm.words import SPACED, WordRule, WordTable, as_bytes, mix64, odd_constants, row_slices

#: Labelled rows learned from at most; groups of copies that a learned word must be in; its least share of toxic texts.
SAMPLE, LEAST_GROUPS, LEAST_SHARE, THRESHOLD = 8_000, 6, 0.8, 0.3
#: Words are runs of ASCII letters and bytes beyond ASCII; A-Z lower-cased.
LETTERS_LOWER = WordRule(bytes(b for b in range(128) if not chr(b).isalpha()), lower=True)
#: What signs of leetspeak stand for, and signs that only separate.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "*": "aeiou", "#": "aeiou"}
SEPARATORS = ".-_*~'`^/\\,:"
#: Channel costs (minus log probability) of: a letter as itself, leet for a letter, a separator put in, a repeat put in.
PLAIN, SIGN, BREAK, REPEAT = 0.0, 0.7, 0.7, 0.7

# --- the language model -------------------------------------------------------------------------

_code = np.zeros(256, np.int64)
_code[97:123] = _code[65:91] = np.arange(1, 27)
_code[128:256] = 27 + (np.arange(128) & 3)
SYMBOLS = 32


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SYMBOLS**3, np.int64)
    for batch in batches:
        for piece in row_slices(batch, "text"):
            raw, _ = as_bytes(piece.column("text"))
            if len(raw) > 2:
                c = _code[raw]
                gram = (c[:-2] * SYMBOLS + c[1:-1]) * SYMBOLS + c[2:]
                total += np.bincount(gram, minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["gram", "n"])


class CharModel:
    """Minus log probabilities of a character after two others, with the bigram as a back-off."""

    def __init__(self, counts: np.ndarray):
        three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(np.float64)
        two = three.sum(0)
        one = two.sum(0)
        p1 = (one + 1) / (one.sum() + SYMBOLS)
        p2 = (two + 8 * p1) / (two.sum(1, keepdims=True) + 8)
        p3 = (three + 8 * p2[None]) / (three.sum(2, keepdims=True) + 8)
        self.cost = -np.log(p3)
        self.rows = self.cost.tolist()


def corpus_char_model(docs: DataFrame) -> CharModel:
    counts = np.zeros(SYMBOLS**3, np.int64)
    grams = ids_and_texts(docs).select("text").mapInArrow(_gram_counts, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    for r in grams.collect():  # at most SYMBOLS cubed
        counts[r["gram"]] = r["n"]
    return CharModel(counts)


# --- the noisy channel --------------------------------------------------------------------------


@functools.cache
def _symbol(letter: str) -> int:
    return int(_code[letter.encode()[0]])


@functools.cache
def edges_of(c: str, repeated: bool) -> tuple[tuple[str, float], ...]:
    """What a character may stand for ('' for nothing) and the channel's cost; repeated: it is the one before again."""
    edges: list[tuple[str, float]] = []
    if c.isalpha():
        edges.append((c, PLAIN))
        if repeated:
            edges.append(("", REPEAT))
    else:
        edges += [(x, SIGN) for x in LEET.get(c, "")]
        if repeated and c in LEET:
            edges.append(("", REPEAT))
        if c in SEPARATORS or c.isspace() or not edges:
            edges.append(("", BREAK))
    return tuple(edges)


def lattice(lower: str, begin: int = 0) -> list[tuple[tuple[str, float], ...]]:
    """The edges of each character from `begin` on."""
    return [edges_of(lower[i], i > 0 and lower[i - 1] == lower[i]) for i in range(begin, len(lower))]


class Decoder:
    """Viterbi over lattices, states being the last two letters; a text that goes on from the one before is decoded from there."""

    #: Letters that each state keeps of its own before those that all states share are set aside.
    OWN = 4096

    def __init__(self, model: CharModel):
        self.model, self.rows = model, model.rows
        self.begin()

    def begin(self) -> None:
        self.lower, self.shared = "", ""
        self.beams: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}

    def decode(self, observed: str) -> str:
        """The likeliest word; of equally likely ones the first in order."""
        lower, cost = observed.lower(), self.rows
        if not lower.startswith(self.lower):
            self.begin()
        shared, beams, limit = [self.shared], self.beams, self.OWN
        for edges in lattice(lower, len(self.lower)):
            new: dict[tuple[int, int], tuple[float, str]] = {}
            for (a, b), (so_far, text) in beams.items():
                costs = cost[a][b]
                for letter, channel in edges:
                    if letter:
                        s = _symbol(letter)
                        state, total, grown = (b, s), so_far + channel + costs[s], text + letter
                    else:
                        state, total, grown = (a, b), so_far + channel, text
                    held = new.get(state)
                    if held is None or (total, grown) < held:
                        new[state] = (total, grown)
            beams = new
            if len(next(iter(beams.values()))[1]) > limit:
                common = os.path.commonprefix([text for _, text in beams.values()])
                shared.append(common)
                beams = {state: (total, text[len(common) :]) for state, (total, text) in beams.items()}
                limit = self.OWN + 2 * max(len(text) for _, text in beams.values())
        self.lower, self.shared, self.beams = lower, "".join(shared), beams
        return self.shared + min((total + cost[a][b][0], text) for (a, b), (total, text) in beams.items())[1]


def decode(observed: str, model: CharModel) -> str:
    return Decoder(model).decode(observed)


#: Characters and paths of a lattice all of whose paths are tried at once; others are left to Viterbi.
SHORT, FEW = 64, 64
#: Characters of paths that are tried at a time.
CELLS = 1 << 20


def _every_path(words: list[str], model: CharModel) -> list[str | None]:
    """The likeliest word of each lattice of at most FEW paths, by the cost of every path; None for larger ones."""
    found: list[str | None] = [None] * len(words)
    length = np.array([len(w) for w in words], np.int64)
    code = np.frombuffer("".join(words).encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(length)])
    again = np.zeros(len(code), bool)
    again[1:] = code[1:] == code[:-1]
    again[first[:-1][length > 0]] = False
    kinds, which = np.unique(2 * code + again, return_inverse=True)
    edges = [edges_of(chr(k >> 1), bool(k & 1)) for k in kinds.tolist()]
    # The last kind pads short words: it stands for nothing and costs nothing.
    width = max(map(len, edges), default=1)
    symbol, cost, letter = np.full((len(kinds) + 1, width), -1), np.zeros((len(kinds) + 1, width)), np.zeros((len(kinds) + 1, width), np.uint32)
    for k, of in enumerate(edges):
        for n, (x, channel) in enumerate(of):
            symbol[k, n], cost[k, n], letter[k, n] = _symbol(x) if x else -1, channel, ord(x) if x else 0
    options = np.array([*map(len, edges), 1])
    table = model.cost.reshape(-1)
    order = np.argsort(length, kind="stable")
    order = order[length[order] <= SHORT]
    at = 0
    while at < len(order):
        # Words of like length, padded to the longest of them.
        some = order[at : at + max(1, CELLS // (FEW * SHORT))]
        at += len(some)
        n = max(1, int(length[some[-1]]))
        grid = np.full((len(some), n), len(kinds))
        row = np.repeat(np.arange(len(some)), length[some])
        place = np.arange(len(row)) - np.repeat(np.cumsum(length[some]) - length[some], length[some])
        grid[row, place] = which[first[some][row] + place]
        grown = np.cumprod(options[grid].astype(np.float64), 1)
        few = grown[:, -1] <= FEW
        some, grid, grown = some[few], grid[few], grown[few].astype(np.int64)
        if not len(some):
            continue
        paths = grown[:, -1]
        owner = np.repeat(np.arange(len(some)), paths)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(paths) - paths, paths)
        before = np.concatenate([np.ones((len(some), 1), np.int64), grown[:, :-1]], 1)
        kind = grid[owner]
        choice = number[:, None] // before[owner] % options[kind]
        taken = symbol[kind, choice]
        channel = cost[kind, choice]
        total, state = np.zeros(len(owner)), np.zeros(len(owner), np.int64)
        for j in range(n):
            total += channel[:, j]
            says = taken[:, j] >= 0
            to = state * SYMBOLS + np.where(says, taken[:, j], 0)
            total += np.where(says, table[to], 0.0)
            state = np.where(says, to % (SYMBOLS * SYMBOLS), state)
        total += table[state * SYMBOLS]
        best = np.lexsort((total, owner))
        start = np.cumsum(paths) - paths
        texts = letter[kind, choice]
        spelled = lambda path: texts[path][texts[path] > 0].tobytes().decode("utf-32-le", "replace")
        for i, w in enumerate(some.tolist()):
            a, b = start[i], start[i] + paths[i]
            least = total[best[a]]
            k = a + 1
            while k < b and total[best[k]] == least:
                k += 1
            found[w] = min(spelled(p) for p in best[a:k])
    return found


def decode_all(observed: list[str], decoder: Decoder) -> list[str]:
    """The likeliest word of each."""
    lower = [x.lower() for x in observed]
    return [decoder.decode(x) if y is None else y for x, y in zip(observed, _every_path(lower, decoder.model))]


_kind = np.zeros(256, np.uint8)  # 1 letter, 2 leet sign, 4 separator
for _b in range(256):
    _c = chr(_b)
    _kind[_b] = (1 if _b >= 128 or _c.isalpha() else 0) | (2 if _b < 128 and _c in LEET else 0) | (4 if _b < 128 and _c in SEPARATORS else 0)
_ends = np.isin(np.arange(256), list(b".,;:!?"))
_euro = "€".encode()
#: Letters of the longest word that is learned from inside a longer row of single letters.  What is looked for has no such
#: bound: stretches go as far as the longest learned word.
LEARNED_SPACED = 24
#: Stretches of single letters that are decoded at a time.
PLACES = 20_000


def suspicious(raw: np.ndarray, words: WordTable) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Numbers of words that may be obfuscated, and rows [a, b) of at least three single letters or leet signs."""
    if len(words.start) == 0:
        return np.zeros(0, np.int64), []
    kind = _kind[raw]
    letter = (kind & 1).astype(bool)
    mark = (kind & 2) > 0
    if len(raw) > 2:
        mark[:-2] |= (raw[:-2] == _euro[0]) & (raw[1:-1] == _euro[1]) & (raw[2:] == _euro[2])
    low = raw | 0x20
    same = np.zeros(len(raw), bool)
    same[1:] = letter[1:] & (raw[1:] < 128) & (low[1:] == low[:-1])
    # letters of two bytes
    same[3:] |= (raw[3:] == raw[1:-2]) & (raw[2:-1] == raw[:-3]) & (raw[2:-1] >= 0xC3) & (raw[3:] >= 128) & (raw[3:] < 0xC0)
    same[words.start] = False
    same[np.minimum(words.start + 1, words.end - 1)] &= raw[np.minimum(words.start + 1, words.end - 1)] < 128
    mark |= same
    at = np.arange(len(raw))
    first = np.minimum.reduceat(np.where(letter, at, len(raw)), words.start)
    last = np.maximum.reduceat(np.where(letter, at, -1), words.start)
    breaks = np.flatnonzero((kind & 4) > 0)
    word = np.searchsorted(words.start, breaks, "right") - 1
    inside = (word >= 0) & (breaks > first[word]) & (breaks < last[word])
    mark[breaks[inside]] = True
    flagged = (np.add.reduceat(mark, words.start, dtype=np.int64) > 0) & (last >= 0)
    size = words.end - words.start
    head, tail = raw[words.start], raw[words.end - 1]
    one = (((size == 1) | ((size == 2) & _ends[tail])) & (head < 128) & ((kind[words.start] & 3) > 0)) | ((size == 3) & (head == _euro[0]) & (tail == _euro[2]) & (raw[np.minimum(words.start + 1, words.end - 1)] == _euro[1]))
    runs = []
    at = np.flatnonzero(one)
    if len(at):
        row = np.searchsorted(words.first, at, "right")
        cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(row) != 0)) + 1
        runs = [(int(g[0]), int(g[-1]) + 1) for g in np.split(at, cut) if len(g) >= 3 and (last[g] >= 0).any()]
    return np.flatnonzero(flagged), runs


def stretches(letters: list[bytes], longest: int) -> Iterator[bytes]:
    """A row of single letters, and every stretch of three or more in it that may stand for at most `longest` letters.

    A sign that also separates may stand for nothing: such ones don't count, and of more than `longest` in a row the
    others can say nothing new.
    """
    yield b" ".join(letters)
    must = [chr(x[0]) not in SEPARATORS for x in letters]
    kept, run = [], 0
    for i, m in enumerate(must):
        run = 0 if m else run + 1
        if run <= longest:
            kept.append(i)
    for n in range(len(kept)):
        said = 0
        for k in range(n, len(kept)):
            said += must[kept[k]]
            if said > longest:
                break
            if k >= n + 2 and k - n + 1 < len(letters):
                yield b" ".join([letters[x] for x in kept[n : k + 1]])


_starts = odd_constants(9, 909)


def word_starts(raw: np.ndarray, words: WordTable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, hash, bytes) of the first 4, 5, ... 8 bytes of each word that is at least so long."""
    length = words.end - words.start
    which, hashes, sizes = [], [], []
    at, total = np.arange(len(length)), np.zeros(len(length), np.uint64)
    for k in range(1, 9):
        long = length[at] >= k
        at, total = at[long], total[long]
        total = total + LETTERS_LOWER.value[raw[words.start[at] + k - 1]] * _starts[k]
        if k >= 4:
            which.append(at)
            hashes.append(mix64(total + np.uint64(k)))
            sizes.append(np.full(len(at), k))
    return np.concatenate(which), np.concatenate(hashes), np.concatenate(sizes)


def tokens_of(column) -> tuple[WordTable, np.ndarray, np.ndarray, np.ndarray]:
    """Words of letters, and (row, hash, bytes) of each word and each of its starts."""
    raw, offsets = as_bytes(column)
    words = WordTable(raw, offsets, LETTERS_LOWER)
    row = np.repeat(np.arange(len(offsets) - 1), words.counts)
    which, starts, sizes = word_starts(raw, words)
    return words, np.concatenate([row, row[which]]), np.concatenate([words.hash, starts]), np.concatenate([words.end - words.start, sizes])


class Restorer:
    """Tokens of texts, with those of the words that suspicious words were restored to.

    longest: letters of the longest word that is looked for inside a row of single letters.
    """

    def __init__(self, model: CharModel, longest: int = LEARNED_SPACED, keep: int = 200_000):
        self.decoder, self.longest, self.keep = Decoder(model), longest, keep
        self.known: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}

    def restored(self, words: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The tokens that each word's decoded forms have, with their bytes; those of new words are made at once."""
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        if len(self.known) + len(new) > self.keep:
            self.known.clear()
            new = list(dict.fromkeys(words))
        texts, of = [], []
        for i, word in enumerate(new):
            whole = word.decode("utf-8", "replace")
            bare = whole.strip(SEPARATORS + "!?;\"'()")
            # A sign at an end may be punctuation or a letter.
            forms = {bare} | ({whole} if any(c in LEET for c in whole.replace(bare, "", 1)) else set())
            texts.extend(sorted(forms))
            of.extend([i] * len(forms))
        if new:
            texts = decode_all(texts, self.decoder)
            _, rows, hashes, sizes = tokens_of(pa.array(texts, pa.string()))
            owner = np.array(of)[rows]
            order = np.lexsort((hashes, owner))
            owner, hashes, sizes = owner[order], hashes[order], sizes[order]
            once = np.ones(len(owner), bool)
            once[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
            owner, hashes, sizes = owner[once], hashes[once], sizes[once]
            bounds = np.searchsorted(owner, np.arange(len(new) + 1))
            for word, x, y in zip(new, bounds[:-1].tolist(), bounds[1:].tolist()):
                self.known[word] = hashes[x:y], sizes[x:y]
        return [self.known[w] for w in words]

    def tokens(self, column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, hash) of every token of the restored text, and each row's smallest word hash (0 if none)."""
        rows, hashes, _, least = self.sized_tokens(column)
        return rows, hashes, least

    def sized_tokens(self, column) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The same with each token's bytes."""
        raw, offsets = as_bytes(column)
        words, rows, hashes, sizes = tokens_of(column)
        spaced = WordTable(raw, offsets, SPACED)
        rows, hashes, sizes = [rows], [hashes], [sizes]
        flagged, runs = suspicious(raw, spaced)
        if len(flagged):
            # Each distinct word once.
            _, sample, which = np.unique(spaced.hash[flagged], return_index=True, return_inverse=True)
            found = self.restored([raw[spaced.start[w] : spaced.end[w]].tobytes() for w in flagged[sample].tolist()])
            n = np.array([len(h) for h, _ in found])
            rows.append(np.repeat(np.searchsorted(spaced.first, flagged, "right") - 1, n[which]))
            # Each place's word's tokens, one after another.
            begin = np.cumsum(n) - n
            at = np.arange(n[which].sum()) + np.repeat(begin[which] - (np.cumsum(n[which]) - n[which]), n[which])
            hashes.append(np.concatenate([h for h, _ in found])[at])
            sizes.append(np.concatenate([z for _, z in found])[at])
        spelled = lambda a, b: [raw[spaced.start[w] : spaced.end[w]].tobytes() for w in range(a, b)]
        places = chain.from_iterable(((a, x) for x in stretches(spelled(a, b), self.longest)) for a, b in runs)
        while block := list(islice(places, PLACES)):
            found = self.restored([x for _, x in block])
            of = np.searchsorted(spaced.first, [a for a, _ in block], "right") - 1
            some = np.rec.fromarrays([np.repeat(of, [len(h) for h, _ in found]), np.concatenate([h for h, _ in found]), np.concatenate([z for _, z in found])], names="row,hash,size")
            some = np.unique(some)  # neighbouring stretches share most starts
            rows.append(some["row"])
            hashes.append(some["hash"])
            sizes.append(some["size"])
        least = np.zeros(len(offsets) - 1, np.uint64)
        full = np.flatnonzero(words.counts)
        if len(full):
            least[full] = np.minimum.reduceat(words.hash, words.first[:-1][full])
        return np.concatenate(rows), np.concatenate(hashes), np.concatenate(sizes), least


# --- the score ----------------------------------------------------------------------------------


class ToxicModel:
    """longest: letters of the longest learned word."""

    def __init__(self, chars: CharModel, base: float, words: dict[int, float], longest: int = 0):
        self.chars, self.base, self.longest = chars, base, longest
        self.words = np.array(sorted(words), np.uint64)
        self.log_clean = np.array([math.log1p(-words[w]) for w in sorted(words)])
        self.bits = np.zeros(1 << 16, bool)
        self.bits[(self.words >> np.uint64(48)).astype(np.int64)] = True

    def score(self, rows: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
        total = np.full(n, math.log1p(-self.base))
        if len(self.words) and len(hashes):
            some = self.bits[(hashes >> np.uint64(48)).astype(np.int64)]
            rows, hashes = rows[some], hashes[some]
            at = np.searchsorted(self.words, hashes)
            at[at == len(self.words)] = 0
            hit = self.words[at] == hashes
            pairs = np.unique(rows[hit] * len(self.words) + at[hit])
            np.add.at(total, pairs // len(self.words), self.log_clean[pairs % len(self.words)])
        return 1 - np.exp(total)


def held_out(doc_id: Column | str = "doc_id") -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE) -> ToxicModel:
    chars = corpus_char_model(docs)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
    chosen = known.sort(F.xxhash64("doc_id"), "doc_id", "toxic").limit(sample)
    labelled = ids_and_texts(docs).join(F.broadcast(chosen), "doc_id").select("toxic", "text")  # at most `sample` rows

    scratch = Scratch(docs.sparkSession, "toxic")

    def gathered(label: int, wanted: np.ndarray | None) -> DataFrame:
        """(group, token, size) of the sample's texts with a label, and of those tokens the wanted; a text has token 0 too."""

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            restorer = Restorer(chars)
            for batch in batches:
                for piece in row_slices(batch, "text"):
                    rows, hashes, sizes, least = restorer.sized_tokens(piece.column("text"))
                    if wanted is not None:
                        keep = np.isin(hashes, wanted)
                        rows, hashes, sizes = rows[keep], hashes[keep], sizes[keep]
                    order = np.lexsort((hashes, rows))
                    rows, hashes, sizes = rows[order], hashes[order], sizes[order]
                    new = np.ones(len(rows), bool)
                    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
                    group, token = np.concatenate([least, least[rows[new]]]), np.concatenate([np.zeros(len(least), np.uint64), hashes[new]])
                    size = np.concatenate([np.zeros(len(least), np.int64), sizes[new]])
                    yield pa.RecordBatch.from_arrays([pa.array(group.view(np.int64)), pa.array(token.view(np.int64)), pa.array(size)], ["group", "token", "size"])

        found = labelled.filter(F.col("toxic") == label).select("text").mapInArrow(work, "group long, token long, size long")
        return scratch.save(found.distinct(), f"tokens-{label}")

    def counted(pairs: DataFrame, least: int) -> dict[int, int]:
        """Groups that have each token, of tokens that enough have; 0 stands for all."""
        return {r["token"]: r["n"] for r in pairs.groupBy("token").agg(F.count("*").alias("n")).filter(f"n >= {least} or token = 0").collect()}  # of the sample

    def unsigned(tokens) -> np.ndarray:
        return np.array(sorted(tokens), np.int64).view(np.uint64)

    toxic = gathered(1, None)
    n = counted(toxic, LEAST_GROUPS)
    toxic_groups = n.pop(0, 0)
    clean = gathered(0, unsigned(n))
    m = counted(clean, 1)
    clean_groups = m.pop(0, 0)
    share = {t: (n[t] - 0.5) / (n[t] + m.get(t, 0) + 1) for t in n}
    learned = [t for t in share if share[t] >= LEAST_SHARE]
    lexicon = dict(zip(np.array(learned, np.int64).view(np.uint64).tolist(), [min(share[t], 0.999) for t in learned]))

    def without(pairs: DataFrame, groups: int) -> int:
        """Groups that have no learned token."""
        told = docs.sparkSession.createDataFrame([(t,) for t in learned], "token long")
        return groups - pairs.join(told, "token", "left_semi").select("group").distinct().count()

    odd, plain = without(toxic, toxic_groups), without(clean, clean_groups)
    told = docs.sparkSession.createDataFrame([(t,) for t in learned], "token long")
    longest = toxic.join(told, "token", "left_semi").agg(F.max("size")).first()[0] or 0
    scratch.close()
    return ToxicModel(chars, (odd + 0.5) / (odd + plain + 5) if toxic_groups + clean_groups else 0.0, lexicon, longest)


def score_toxicity(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model.chars, model.longest)
        for batch in batches:
            for piece in row_slices(batch, "text"):
                score = model.score(*restorer.tokens(piece.column("text"))[:2], piece.num_rows)
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    scored = ids_and_texts(docs).mapInArrow(work, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, learn(docs, table(spark, sf_dir, "labels")))


QUERIES = {"op5_toxicity": op5_toxicity}
