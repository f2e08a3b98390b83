"""Scoring reads with a pluggable classifier, and selecting by score."""

from __future__ import annotations

import io
import math
import subprocess
import warnings
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Scorer = Callable[[pd.DataFrame], pd.DataFrame]


class ScorerFailed(RuntimeError):
    """An external classifier ended badly, was too slow, or said what can't be read."""


def _number(text: object) -> float:
    try:
        return float(text)
    except (TypeError, ValueError):
        return math.nan


def process_scorer(command: list[str], *, timeout: float = 600, retries: int = 1, rows: int = 2000) -> Scorer:
    """A scorer that is another program: it reads FASTA on its standard input and writes lines of name, prediction and score.

    One process scores `rows` reads at most, so memory and time are bounded; it is tried again `retries` times if it ends with
    another status than 0 or takes more than timeout seconds.  Lines whose score is no number (a header) are left out; reads
    that it says nothing of have no prediction.
    """

    def once(text: str) -> pd.DataFrame:
        done = subprocess.run(command, input=text, capture_output=True, text=True, timeout=timeout)
        if done.returncode:
            raise ScorerFailed(f"{command[0]} ended with status {done.returncode}: {done.stderr[-500:]}")
        if not done.stdout.strip():
            return pd.DataFrame({"name": [], "prediction": [], "score": []}, dtype=str).astype({"score": float})
        said = pd.read_csv(io.StringIO(done.stdout), sep="\t", header=None, names=["name", "prediction", "score"], usecols=[0, 1, 2], dtype=str, keep_default_na=False, quoting=3)
        said["score"] = [_number(x) for x in said["score"]]
        return said.dropna(subset=["score"])

    def score(batch: pd.DataFrame) -> pd.DataFrame:
        found = []
        for lo in range(0, len(batch), rows):
            part = batch.iloc[lo : lo + rows]
            text = "".join(f">{name}\n{seq}\n" for name, seq in zip(part["read_id"], part["seq"]))
            for left in range(retries, -1, -1):
                try:
                    found.append(once(text))
                    break
                except (ScorerFailed, subprocess.TimeoutExpired, pd.errors.ParserError) as e:
                    if not left:
                        raise ScorerFailed(str(e)) from e
                    warnings.warn(f"{command[0]} is tried again: {e}", stacklevel=2)
        return pd.concat(found) if found else batch.head(0).assign(name="", prediction="", score=0.0)

    return score


def gc_scorer(batch: pd.DataFrame) -> pd.DataFrame:
    """A stand-in for a classifier: the share of G and C decides."""
    share = batch["seq"].str.count("[GCgc]") / batch["seq"].str.len().clip(lower=1)
    return pd.DataFrame({"name": batch["read_id"], "prediction": share.ge(0.5).map({True: "phage", False: "bacteria"}), "score": share})


def predict(reads: DataFrame, scorer: Scorer = gc_scorer, min_length: int = 200) -> DataFrame:
    """(name, prediction, score) of the reads that are long enough."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield scorer(batch)[["name", "prediction", "score"]]

    return reads.filter(F.length("seq") >= min_length).select(F.col("read_id").cast("string"), "seq").mapInPandas(work, "name string, prediction string, score double")


def select_by_score(reads: DataFrame, predictions: DataFrame, threshold: float = 0.5, min_length: int = 200, by: str = "read_id") -> DataFrame:
    """The long enough reads with a prediction at or above the threshold, whatever its label."""
    positive = predictions.filter(F.col("score") >= threshold).select(F.col("name").alias(by))
    return reads.filter(F.length("seq") >= min_length).join(positive, by, "left_semi")
