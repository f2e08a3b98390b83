"""Accession catalogs with dates: normalising, splitting by date, previews and the cutoff search."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readloom.functions.sequences import check_split_date, date_key, iso_date


def merge_metadata(catalog: DataFrame, side: DataFrame | None = None) -> DataFrame:
    """(accession, create_date, title), one row per accession.

    side, the older metadata map, wins whole if it has any row; else inline metadata is used, of which a
    later category (by category_order, then pos) overwrites an earlier one.
    """
    last = F.max_by(F.struct("create_date", "title"), F.struct("category_order", "pos"))
    inline = catalog.filter("create_date is not null or title is not null").groupBy("accession").agg(last.alias("m")).select("accession", "m.*")
    if side is None:
        return inline
    any_side = side.limit(1).select(F.lit(True).alias("any"))
    return side.select("accession", "create_date", "title").unionByName(inline.join(F.broadcast(any_side), F.lit(True), "left_anti"))


def first_of_each(catalog: DataFrame) -> DataFrame:
    """Distinct accessions in order of first appearance."""
    return catalog.groupBy("accession").agg(F.min(F.struct("category_order", "pos")).alias("first"))


def with_split(dated: DataFrame, cutoff: str) -> DataFrame:
    """dated with is_train: before the cutoff, or without a usable date."""
    y, m, d = check_split_date(cutoff)
    cut = F.struct(F.lit(y).alias("y"), F.lit(m).alias("m"), F.lit(d).alias("d"))
    missing = F.col("create_date").isNull() | (F.col("create_date") == "")
    return dated.withColumn("is_train", missing | (date_key("create_date") < cut))


def preview(dated: DataFrame, cutoff: str) -> DataFrame:
    """Counts and percentages of train and test, per category and in total (category 'total')."""
    marked = with_split(dated, cutoff)
    counts = marked.rollup("category").agg(F.grouping("category").alias("g"), F.count("*").alias("n"), F.count_if("is_train").alias("n_train"))
    counts = counts.withColumn("category", F.when(F.col("g") == 1, "total").otherwise(F.col("category"))).withColumn("n_test", F.col("n") - F.col("n_train"))
    share = lambda c: F.when(F.col("n") > 0, F.col(c) * 100.0 / F.col("n")).otherwise(0.0)
    return counts.select("category", "n", "n_train", "n_test", share("n_train").alias("train_percent"), share("n_test").alias("test_percent"))


def cutoff_counts(dated: DataFrame, categories: list[str]) -> DataFrame:
    """For each date that occurs, as a cutoff: train and test counts in all and per category.

    Rows without a usable date are always train.  Rows are counted by date first, so the one ordered
    window runs over as many rows as there are dates.
    """
    keyed = dated.withColumn("key", F.when(F.col("create_date").isNotNull() & (F.col("create_date") != ""), date_key("create_date")))
    per_date = keyed.groupBy("key").agg(F.count("*").alias("n_all"), *[F.count_if(F.col("category") == c).alias(f"n_{i}") for i, c in enumerate(categories)])
    names = ["all", *[str(i) for i in range(len(categories))]]
    after = Window.orderBy("key").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    usable = F.coalesce(F.col("key.y") > 0, F.lit(False))
    placed = per_date.select("key", *[f"n_{x}" for x in names], *[F.sum(f"n_{x}").over(whole).alias(f"total_{x}") for x in names]).filter(usable)
    placed = placed.select("key", *[f"total_{x}" for x in names], *[F.sum(f"n_{x}").over(after).alias(f"test_{x}") for x in names])
    return placed.select(iso_date(F.col("key")).alias("cutoff"), *[F.expr(f"total_{x} - test_{x}").alias(f"train_{x}") for x in names], *[f"test_{x}" for x in names])


def search_cutoff(dated: DataFrame, categories: list[str], min_train: int, min_test: int, min_train_of: dict[str, int] | None = None, min_test_of: dict[str, int] | None = None) -> DataFrame:
    """The latest date that, as the cutoff, leaves at least the asked numbers of train and test: a row or none."""
    ok = (F.col("train_all") >= min_train) & (F.col("test_all") >= min_test)
    for minima, side in ((min_train_of or {}, "train"), (min_test_of or {}, "test")):
        for category, n in minima.items():
            ok = ok & (F.col(f"{side}_{categories.index(category)}") >= n)
    return cutoff_counts(dated, categories).filter(ok).sort(F.desc("cutoff")).limit(1)
