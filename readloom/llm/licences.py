"""License scans: Aho-Corasick for notices and tags, shunting-yard for licence expressions.

Texts are folded to words (A-Z lower-cased, runs of letters and digits) joined by one space, and one
automaton finds every phrase that stands as whole consecutive words, overlapping ones too.  The
phrases are the base ones, more notices, and the words of an identifier tag.  Behind a tag, the line
of the original text is read as a licence expression: a shunting-yard parser turns `and`, `or`,
`with` and brackets into postfix order, and it is evaluated over how free each licence leaves the reader:
`or` takes the freer side, `and` the stricter, `with` an exception moves halfway to free.  Each
licence named adds its identifier to the labels.

`score` is the freedom that the text grants: the strictest of what its expressions and notices say, 1
for a text that says nothing.  A notice inside a longer one (the GPL's name in the LGPL's) has a label, but
the longer one alone decides the score.  An expression ends with its line or where the next tag begins, and
what counts is the longest start of it that is one; time and memory grow in proportion to the text.

Edge cases: a null, empty or wordless text has no words, no places and the score 1; an expression that can't
be parsed gives the labels of the licences in it, and counts as the strictest of them; very long texts
are scanned whole; repeated rows and ids (and null ids) give repeated results; extra columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from readloom.llm.tables import ids_and_texts, table
from readloom.llm.words import row_slices

#: The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Further notices, their labels, and the freedom each grants.
NOTICES = {
    "apache license": ("apache", 0.9),
    "mit license": ("mit", 1.0),
    "permission is hereby granted free of charge": ("mit", 1.0),
    "redistribution and use in source and binary forms": ("bsd", 1.0),
    "bsd license": ("bsd", 1.0),
    "mozilla public license": ("mpl", 0.6),
    "gnu lesser general public license": ("lgpl", 0.5),
    "gnu affero general public license": ("agpl", 0.2),
    "creative commons attribution": ("cc-by", 0.9),
    "public domain": ("public-domain", 1.0),
    "proprietary and confidential": ("proprietary", 0.0),
}
BASE_FREEDOM = {"cc-by": 0.9, "gpl": 0.3, "reserved": 0.0}
TAG = "spdx license identifier"
#: Freedom by the start of a licence identifier, the longest that fits.
IDENTIFIERS = {
    "mit": 1.0, "bsd": 1.0, "isc": 1.0, "zlib": 1.0, "unlicense": 1.0, "0bsd": 1.0, "cc0": 1.0, "apache": 0.9, "cc-by": 0.9,
    "cc-by-sa": 0.5, "cc-by-nc": 0.3, "cc-by-nd": 0.2, "mpl": 0.6, "epl": 0.6, "lgpl": 0.5, "gpl": 0.3, "agpl": 0.2,
}
UNKNOWN = 0.4

_fold = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_tag = re.compile(r"spdx[^0-9a-z\x80-\U0010ffff]+license[^0-9a-z\x80-\U0010ffff]+identifier[ \t]*:?", re.IGNORECASE | re.ASCII)
_token = re.compile(r"\(|\)|[0-9A-Za-z.+:-]+")
_rank = {"or": 1, "and": 2, "with": 3}


@lru_cache(maxsize=4096)
def freedom(identifier: str) -> float:
    name = identifier.lower()
    fits = [k for k in IDENTIFIERS if name == k or (name.startswith(k) and name[len(k)] in "-+.0123456789")]
    return IDENTIFIERS[max(fits, key=len)] if fits else UNKNOWN


class ShuntingYard:
    """Reads an expression token by token: operands in order, operators behind their operands."""

    def __init__(self):
        self.out: list[str] = []
        self.held: list[str] = []
        self.operand, self.depth = True, 0  # whether an operand must come next; brackets that are open

    def push(self, token: str) -> None:
        """Takes the next token; ValueError if nothing that begins so is an expression."""
        low = token.lower()
        if low in _rank:
            if self.operand:
                raise ValueError("an operator without a left side")
            while self.held and self.held[-1] != "(" and _rank[self.held[-1]] >= _rank[low]:
                self.out.append(self.held.pop())
            self.held.append(low)
            self.operand = True
        elif token == "(":
            if not self.operand:
                raise ValueError("a bracket after an operand")
            self.held.append(token)
            self.depth += 1
        elif token == ")":
            if self.operand:
                raise ValueError("an empty bracket or a missing right side")
            if not self.depth:
                raise ValueError("a bracket that wasn't opened")
            while self.held[-1] != "(":
                self.out.append(self.held.pop())
            self.held.pop()
            self.depth -= 1
        else:
            if not self.operand:
                raise ValueError("two operands together")
            self.out.append(token)
            self.operand = False

    @property
    def complete(self) -> bool:
        return not self.operand and not self.depth


def to_postfix(tokens: list[str]) -> list[str]:
    """The tokens in postfix order; ValueError if they are no expression."""
    yard = ShuntingYard()
    for t in tokens:
        yard.push(t)
    if not yard.complete:
        raise ValueError("an unfinished expression")
    return yard.out + yard.held[::-1]


def evaluate(postfix: list[str]) -> float:
    stack: list = []
    for t in postfix:
        if t not in _rank:
            stack.append(t)
            continue
        right, left = stack.pop(), stack.pop()
        left = freedom(left) if isinstance(left, str) else left
        if t == "with":
            stack.append((1 + left) / 2)
            continue
        right = freedom(right) if isinstance(right, str) else right
        stack.append(max(left, right) if t == "or" else min(left, right))
    return freedom(stack[0]) if isinstance(stack[0], str) else stack[0]


def names_of(tokens: list[str]) -> list[str]:
    """The licences named among tokens: not operators, brackets or exceptions."""
    before = ["", *(t.lower() for t in tokens)]
    return [t.lower() for t, b in zip(tokens, before) if t not in "()" and t.lower() not in _rank and b != "with"]


def read_expression(line: str) -> tuple[float, list[str]]:
    """(freedom, identifiers) of the longest start of a line that is an expression; one pass finds where it ends."""
    tokens = [t.rstrip(".") or "." for t in _token.findall(line)]
    yard, end = ShuntingYard(), 0
    for i, t in enumerate(tokens):
        try:
            yard.push(t)
        except ValueError:
            break
        if yard.complete:
            end = i + 1
    if end:
        return evaluate(to_postfix(tokens[:end])), names_of(tokens[:end])
    known = [n for n in names_of(tokens) if freedom(n) != UNKNOWN]
    return min([freedom(n) for n in known], default=1.0), known


@lru_cache(maxsize=1)
def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for phrase in [*BASE, *NOTICES, TAG]:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


def longest(hits: list[tuple[int, int, str]]) -> list[str]:
    """The phrases of (start, end, phrase) that stand inside no longer one."""
    out, reached = [], -1
    for _, end, phrase in sorted(hits, key=lambda h: (h[0], -h[1])):
        if end > reached:
            out.append(phrase)
            reached = end
    return out


def expressions(text: str) -> Iterator[str]:
    """What stands behind each identifier tag, to the end of its line or the next tag."""
    tags = list(_tag.finditer(text))
    for m, after in zip(tags, [*(t.start() for t in tags[1:]), len(text)]):
        stop = text.find("\n", m.end(), after)
        yield text[m.end() : after if stop < 0 else stop]


def scan(text: str | None) -> dict:
    text = text or ""
    words = text.encode("utf-8").translate(_fold).decode().split(" ")
    words = [w for w in words if w]
    joined = f" {' '.join(words)} "
    hits, labels, score = [], set(), 1.0
    for end, phrase in automaton().iter(joined):
        hits.append((end - len(phrase), end, phrase))
    base = {BASE[p] for _, _, p in hits if p in BASE}
    labels |= {NOTICES[p][0] for _, _, p in hits if p in NOTICES}
    for phrase in longest(hits):
        if phrase != TAG:
            score = min(score, BASE_FREEDOM[BASE[phrase]] if phrase in BASE else NOTICES[phrase][1])
    starts = [at for at, _, p in hits if p in BASE]
    if starts:  # places in the joined text to numbers of words
        places = list(accumulate((len(w) + 1 for w in words), initial=1))
        starts = [bisect_left(places, at) for at in starts]
    if any(p == TAG for _, _, p in hits):
        for line in expressions(text):
            free, names = read_expression(line)
            labels.update(names)
            score = min(score, free)
    return {
        "n_words": len(words), "n_base": len(starts), "first_word": min(starts, default=None), "last_word": max(starts, default=None),
        "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(base | labels)), "score": score,
    }


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    types = {"n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(), "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in row_slices(batch, "text"):
                rows = [scan(t) for t in piece.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *[pa.array([r[n] for r in rows], t) for n, t in types.items()]], ["doc_id", *types])

    return ids_and_texts(docs).mapInArrow(work, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


QUERIES = {"op3_license_scan": op3_license_scan}
