"""Progress of plans: counts that Spark observes while an action runs, told to a callback when it ends."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

Callback = Callable[[str, int], None]


def log(step: str, rows: int) -> None:
    logging.getLogger("readloom").info("%s: %d rows", step, rows)


def observed(df: DataFrame, step: str, tell: Callback = log) -> tuple[DataFrame, Callable[[], None]]:
    """df, and what to call after its action: it tells the callback the step's rows, counted as they passed."""
    seen = Observation(f"readloom {step}")
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), lambda: tell(step, seen.get["rows"])
