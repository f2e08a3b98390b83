"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A text is hashed into buckets: its words, its runs of three bytes, and the shapes of its runs of SHAPE words: which of them
are the same word, whatever the words are.  A bucket's value is the square root of its share of the text's words (of its
runs of bytes).  One weight vector is shared by all grades; ordered thresholds cut its score s into grades, P(grade <= k) =
sigmoid(t_k - s).  From those come the expected grade and the tail probabilities that selection uses.

The ratings of the query and the pipeline are 0 (low quality), 1 (good, but toxic) and 2 (good), made of
`labels`; a text is selected if P(grade >= 1) is at least 0.5.  The model is fitted on the driver on at
most SAMPLE labelled rows, those with the smallest hash of their doc_id; the penalty on weights is the one of DECAYS
under which a quarter of those rows, held out, is likeliest; each fit begins where the one before ended.  Every document is scored, whole.

Edge cases: a null, empty or blank text has no words and is never selected (its grade is that of
score 0 with selected false); labels without a document, null ratings and null ids are left out; of labelled
rows of one doc_id and grade the smallest text counts; with no labelled rows, or ratings of one grade only, nothing
can be learned and every text with words is selected; repeated rows and ids give repeated results; extra columns are
kept by `select_quality`, whatever their names; `score_quality` leaves out those named as its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from readloom.llm.tables import ids_and_texts, table
from readloom.llm.words import SPACED_LOWER, WordTable, as_bytes, mix64, odd_constants, row_slices

#: Labelled rows that the model is fitted on at most; bits of the hashes of words, of runs of bytes and of shapes; words of a shape.
SAMPLE, WORD_BITS, RUN_BITS, SHAPE_BITS, SHAPE = 4_000, 13, 12, 10, 6
RUNS, SHAPES = 1 << WORD_BITS, (1 << WORD_BITS) + (1 << RUN_BITS)
WIDTH = SHAPES + (1 << SHAPE_BITS)
#: Counts held at once while texts are scored.
CELLS = 1 << 20
#: Penalties to choose from.
DECAYS = (1e-3, 1e-4, 3e-5)

_byte = odd_constants(3, 41)


class Tokens(NamedTuple):
    """For each kind of token, buckets and where each row's begin; each row's words and runs of bytes."""

    kinds: list[tuple[np.ndarray, np.ndarray]]
    words: np.ndarray
    runs: np.ndarray


def shapes(h: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Of the SHAPE words up to each word of its text, which stand there again: a number for each word.

    Its digits say how many words back, inside that run, each word stood last.
    """
    back = np.zeros(len(h), np.int64)
    for gap in range(SHAPE - 1, 0, -1):
        again = (h[gap:] == h[:-gap]) & (place[gap:] >= gap)
        back[gap:][again] = gap
    code = np.zeros(len(h), np.int64)
    for behind in range(SHAPE - 1):
        here = back[: len(h) - behind]
        inside = (here < SHAPE - behind) & (place[behind:] >= behind)
        code[behind:] += np.where(inside, here, 0) * SHAPE**behind
    return code


def hashed(column) -> Tokens:
    """The tokens of a slice, a row's after another's."""
    raw, offsets = as_bytes(column)
    words = WordTable(raw, offsets, SPACED_LOWER)
    h = words.hash
    row = np.repeat(np.arange(len(offsets) - 1), words.counts)
    shape = shapes(h, np.arange(len(h)) - words.first[:-1][row])
    kinds = [((h >> np.uint64(64 - WORD_BITS)).astype(np.int64), words.first)]
    kinds.append(((mix64(shape) >> np.uint64(64 - SHAPE_BITS)).astype(np.int64) + SHAPES, words.first))
    runs = np.maximum(np.diff(offsets) - 2, 0)
    if len(raw) > 2:
        code = raw.astype(np.uint64)
        mixed = code[:-2] * _byte[0]
        mixed += code[1:-1] * _byte[1]
        mixed += code[2:] * _byte[2]
        inside = np.ones(len(raw), bool)  # a run stays in its row
        for back in (1, 2):
            ends = offsets[1:] - back
            inside[ends[ends >= offsets[:-1]]] = False
        bucket = (mix64(mixed) >> np.uint64(64 - RUN_BITS)).astype(np.int64)[inside[:-2]]
        kinds.append((bucket + RUNS, np.concatenate([[0], np.cumsum(runs)])))
    return Tokens(kinds, words.counts, runs)


def values(tokens: Tokens) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, values of some rows by bucket): as many rows at a time as CELLS allows."""
    step = max(1, CELLS // WIDTH)
    for a in range(0, len(tokens.words), step):
        b = min(a + step, len(tokens.words))
        x = np.zeros((b - a) * WIDTH, np.float32)
        for bucket, first in tokens.kinds:
            row = np.repeat(np.arange(0, (b - a) * WIDTH, WIDTH), np.diff(first[a : b + 1]))
            at = row + bucket[first[a] : first[b]]
            if len(at) * 20 > len(x):
                x += np.bincount(at, minlength=len(x))
            else:
                np.add.at(x, at, 1)
        x = x.reshape(b - a, WIDTH)
        words, runs = (1 / np.maximum(t[a:b], 1)[:, None].astype(np.float32) for t in (tokens.words, tokens.runs))
        x[:, :RUNS] *= words
        x[:, RUNS:SHAPES] *= runs
        x[:, SHAPES:] *= words
        yield a, np.sqrt(x, out=x)


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in row_slices(batch, "text"):
            packed = []
            for _, x in values(hashed(piece.column("text"))):
                for row in x:
                    at = np.flatnonzero(row)
                    packed.append(at.astype(np.uint16).tobytes() + row[at].tobytes())
            yield pa.RecordBatch.from_arrays([piece.column("grade"), pa.array(packed, pa.binary())], ["grade", "features"])


class Sparse:
    """Rows of features as (feature, value) pairs, by row and by feature."""

    def __init__(self, row: np.ndarray, feature: np.ndarray, value: np.ndarray, n: int, width: int):
        self.n, self.width = n, width
        order = np.argsort(row, kind="stable")
        self.row, self.feature, self.value = row[order], feature[order], value[order]
        self.full, self.begins = np.unique(self.row, return_index=True)
        order = np.argsort(feature, kind="stable")
        self.by_feature = row[order], value[order], *np.unique(feature[order], return_index=True)

    def times(self, w: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n)
        if len(self.full):
            out[self.full] = np.add.reduceat(self.value * w[self.feature], self.begins)
        return out

    def back(self, g: np.ndarray) -> np.ndarray:
        row, value, features, first = self.by_feature
        out = np.zeros(self.width)
        if len(features):
            out[features] = np.add.reduceat(value * g[row], first)
        return out

    def rows(self, which: np.ndarray) -> Sparse:
        place = np.full(self.n, -1)
        place[which] = np.arange(len(which))
        keep = place[self.row] >= 0
        return Sparse(place[self.row[keep]], self.feature[keep], self.value[keep], len(which), self.width)

    @classmethod
    def dense(cls, x: np.ndarray) -> Sparse:
        row, feature = np.nonzero(x)
        return cls(row, feature, x[row, feature], *x.shape)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def loss_and_gradients(x: Sparse, y: np.ndarray, w: np.ndarray, gaps: np.ndarray, decay: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean minus log likelihood and penalty; gradients by w and by gaps (the first threshold, then logs of differences)."""
    levels, n = len(gaps), len(y)
    t = np.cumsum(np.concatenate([gaps[:1], np.exp(gaps[1:])]))
    below = np.concatenate([[-np.inf], t, [np.inf]])
    s = x.times(w)
    lo, hi = _sigmoid(below[y] - s), _sigmoid(below[y + 1] - s)
    p = np.maximum(hi - lo, 1e-9)
    d_hi, d_lo = hi * (1 - hi) / p, lo * (1 - lo) / p
    grad_w = x.back((d_hi - d_lo) / n) + decay * w
    grad_t = np.array([-(d_hi[y == k].sum() - d_lo[y == k + 1].sum()) / n for k in range(levels)])
    tail = np.cumsum(grad_t[::-1])[::-1]
    return float(-np.log(p).mean() + decay * (w @ w) / 2), grad_w, np.concatenate([tail[:1], tail[1:] * np.exp(gaps[1:])])


class OrdinalModel:
    """Weights of features and ordered thresholds."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def tails(self, s: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..."""
        return _sigmoid(s[:, None] - self.thresholds[None, :])

    def likelihood(self, x: Sparse, y: np.ndarray) -> float:
        tails = np.concatenate([np.ones((x.n, 1)), self.tails(x.times(self.weights)), np.zeros((x.n, 1))], 1)
        at = np.arange(x.n)
        return float(np.log(np.maximum(tails[at, y] - tails[at, y + 1], 1e-9)).mean())

    def scores(self, column) -> tuple[np.ndarray, np.ndarray]:
        """(score, number of words) of each row."""
        tokens, weights = hashed(column), self.weights.astype(np.float32)
        s = np.zeros(len(tokens.words))
        for a, x in values(tokens):
            s[a : a + len(x)] = x @ weights
        return s, tokens.words


def fit(grades: np.ndarray, x: Sparse, rounds: int = 100, decay: float = 1e-4, rate: float = 0.1, start: OrdinalModel | None = None) -> OrdinalModel:
    """Maximum likelihood with a penalty, by full-batch Adam from `start` on; thresholds stay in order by log gaps."""
    y, levels = grades.astype(int), int(grades.max())
    w, gaps = np.zeros(x.width), np.zeros(levels)
    share = np.clip([(y <= k).mean() for k in range(levels)], 1e-3, 1 - 1e-3)
    t = np.log(share / (1 - share))
    if start is not None:
        w, t = start.weights.copy(), start.thresholds
    gaps[0] = t[0]
    gaps[1:] = np.log(np.maximum(np.diff(t), 1e-2))
    moments = [[np.zeros_like(v), np.zeros_like(v)] for v in (w, gaps)]
    for step in range(1, rounds + 1):
        _, *gradients = loss_and_gradients(x, y, w, gaps, decay)
        for value, grad, m in zip((w, gaps), gradients, moments):
            m[0] += 0.1 * (grad - m[0])
            m[1] += 0.001 * (grad**2 - m[1])
            value -= rate * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-8)
    return OrdinalModel(w, np.cumsum(np.concatenate([gaps[:1], np.exp(gaps[1:])])))


#: Rounds of the first fit, and of each that goes on from another.
ROUNDS, MORE_ROUNDS = 100, 25


def best_fit(grades: np.ndarray, x: Sparse) -> OrdinalModel:
    """The fit with the penalty that suits every fourth row best, when those are held out: from the largest penalty down."""
    out = np.arange(len(grades)) % 4 == 3
    seen, unseen = np.flatnonzero(~out), np.flatnonzero(out)
    if not len(unseen) or set(grades[seen]) != set(grades):
        return fit(grades, x)
    part, rest = x.rows(seen), x.rows(unseen)
    tried: list[tuple[float, float, OrdinalModel]] = []
    for decay in sorted(DECAYS, reverse=True):
        model = fit(grades[seen], part, ROUNDS if not tried else MORE_ROUNDS, decay, 0.1 if not tried else 0.03, tried[-1][2] if tried else None)
        tried.append((model.likelihood(rest, grades[unseen].astype(int)), decay, model))
    _, decay, model = max(tried, key=lambda r: r[:2])
    return fit(grades, x, MORE_ROUNDS, decay, 0.03, model)


def learn(docs: DataFrame, ratings: DataFrame, *, sample: int = SAMPLE) -> OrdinalModel | None:
    """Fits on the labelled documents; ratings has doc_id and grade (0, 1, ...)."""
    known = ratings.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("grade").cast("long").alias("grade")).filter("doc_id is not null and grade >= 0")
    chosen = known.distinct().sort(F.xxhash64("doc_id"), "doc_id", "grade").limit(sample)
    # At most `sample` rows: a bounded broadcast, and after it a bounded number of texts.
    labelled = ids_and_texts(docs).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "grade").agg(F.min("text").alias("text"))
    rows = labelled.select("grade", "text").mapInArrow(_sparse, "grade long, features binary").collect()  # of the sample
    rows.sort(key=lambda r: (r["features"], r["grade"]))
    if len({r["grade"] for r in rows}) < 2:
        return None
    sizes = [len(r["features"]) // 6 for r in rows]
    feature = np.concatenate([np.frombuffer(r["features"], np.uint16, n) for r, n in zip(rows, sizes)]).astype(np.int64)
    value = np.concatenate([np.frombuffer(r["features"][2 * n :], np.float32) for r, n in zip(rows, sizes)])
    return best_fit(np.array([r["grade"] for r in rows]), Sparse(np.repeat(np.arange(len(rows)), sizes), feature, value, len(rows), WIDTH))


def grades_of(labels: DataFrame) -> DataFrame:
    """0: low quality; 1: good but toxic; 2: good."""
    return labels.select("doc_id", F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality").isNotNull(), 2).alias("grade"))


def judged(model: OrdinalModel | None, column, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(tail probabilities, whether selected) of each row."""
    if model is None:
        n = hashed(column).words
        return np.ones((len(n), 1)), n > 0
    s, n = model.scores(column)
    tails = model.tails(s)
    return tails, (tails[:, 0] >= least) & (n > 0)


def score_quality(docs: DataFrame, model: OrdinalModel | None, *, least: float = 0.5) -> DataFrame:
    """docs with expected_grade, p_at_least (an array) and selected."""
    columns = [f for f in docs.schema if f.name not in ("expected_grade", "p_at_least", "selected")]
    names = [f.name for f in columns]
    schema = T.StructType([*columns, T.StructField("expected_grade", T.DoubleType()), T.StructField("p_at_least", T.ArrayType(T.DoubleType())), T.StructField("selected", T.BooleanType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in row_slices(batch, "text"):
                tails, selected = judged(model, piece.column("text"), least)
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(tails.sum(1)), pa.array(tails.tolist(), pa.list_(pa.float64())), pa.array(selected)], [*names, "expected_grade", "p_at_least", "selected"])

    return docs.select(*[F.col(f"`{n}`") for n in names]).mapInArrow(work, schema)


def select_quality(docs: DataFrame, labels: DataFrame, *, least: float = 0.5) -> DataFrame:
    """The documents that the classifier selects, as they are."""
    model = learn(docs, grades_of(labels))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in row_slices(batch, "text"):
                yield piece.filter(pa.array(judged(model, piece.column("text"), least)[1]))

    return docs.mapInArrow(work, docs.schema)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return score_quality(ids_and_texts(docs), learn(docs, grades_of(labels))).drop("text")


QUERIES = {"op4_quality": op4_quality}
