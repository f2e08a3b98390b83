"""Remote sources behind a small protocol, so that everything runs offline by default.

A fetcher is a plain callable, shipped to executors.  Each batch of keys is one call, retried with growing
pauses; a batch that fails for good is tried key by key, and keys that fail alone are reported as missing.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Search:
    """What a category's sequences must be: organism, words of the title, length range, and more."""

    title: str
    low: int
    high: int
    organism: str | None = None
    refseq: bool = True
    complete: bool = False

    def term(self) -> str:
        """The search as the nucleotide service's own query text."""
        parts = [f"{self.organism}[Organism]"] if self.organism else []
        parts.append(f"{self.title}[Title]")
        parts += ["refseq[filter]"] if self.refseq else []
        parts.append(f"({self.low}:{self.high}[Sequence Length])")
        parts += ["complete[Properties]", "NOT WGS[Properties]"] if self.complete else []
        return " AND ".join(parts)

    def predicate(self, columns: list[str]) -> Column:
        """The same over a catalog's columns; what the catalog doesn't hold isn't asked for.

        organism: names of the lineage in one text; refseq: a boolean; properties: an array of texts.
        """
        found = F.col("length").between(self.low, self.high)
        has = lambda c, text: F.coalesce(F.lower(c).contains(text), F.lit(False))
        if self.organism and "organism" in columns:
            found = found & has("organism", self.organism)
        if "title" in columns:
            found = found & has("title", self.title)
        if self.refseq and "refseq" in columns:
            found = found & F.coalesce("refseq", F.lit(False))
        if self.complete and "properties" in columns:
            low = F.transform(F.coalesce("properties", F.array().cast("array<string>")), F.lower)
            found = found & F.array_contains(low, "complete") & ~F.array_contains(low, "wgs")
        return found


#: What is searched for by default, by category.
SEARCHES = {
    "bacteria": Search("complete genome", 10_000, 5_000_000, "bacteria"),
    "virus": Search("complete genome", 5_000, 500_000, "viruses"),
    "archaea": Search("complete genome", 10_000, 5_000_000, "archaea"),
    "plasmid": Search("plasmid", 5_000, 500_000),
}


def searches(complete_only: bool = False) -> dict[str, Search]:
    return {c: Search(s.title, s.low, s.high, s.organism, s.refseq, complete_only) for c, s in SEARCHES.items()}


def search(catalog: DataFrame, category: str, count: int | None = None, complete_only: bool = False) -> DataFrame:
    """The offline search: catalog rows of a category that its predicates let through, in catalog order; the first count."""
    rows = catalog.filter(F.col("category") == category).filter(searches(complete_only)[category].predicate(catalog.columns))
    return rows if count is None else rows.sort("category_order", "pos").limit(count)


# --- fetchers ---------------------------------------------------------------------------------------

Fetcher = Callable[[list[str]], dict[str, dict[str, str]]]
#: (term, first, how many) to (number of all that match, accessions of this page).
Pager = Callable[[str, int, int], tuple[int, list[str]]]
Progress = Callable[[str, int, int], None]


def attempts(call: Callable, tries: int = 3, pause: float = 1.0):
    for attempt in range(1, tries + 1):
        try:
            return call()
        except Exception:
            if attempt == tries:
                raise
            time.sleep(pause * attempt)
    return None


def with_retries(fetch: Fetcher, keys: list[str], tries: int = 3, pause: float = 1.0) -> dict[str, dict[str, str]]:
    return attempts(lambda: fetch(keys), tries, pause)


def fetch_each(keys: DataFrame, fetch: Fetcher, columns: list[str], *, key: str = "accession", batch: int = 500, tries: int = 3, pause: float = 1.0, between: float = 0.0, partitions: int = 1) -> DataFrame:
    """keys with the fetched columns (null where nothing was found) and `failed`.

    partitions bounds the calls made at once, for services that ask for it, and between is a pause after each.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i in range(0, len(pdf), batch):
                part = pdf[key].iloc[i : i + batch].tolist()
                failed: set[str] = set()
                try:
                    got = with_retries(fetch, part, tries, pause)
                except Exception:
                    got = {}
                    for k in part:
                        try:
                            got |= with_retries(fetch, [k], tries, pause)
                        except Exception:
                            failed.add(k)
                time.sleep(between)
                yield pd.DataFrame({key: part, **{c: [got.get(k, {}).get(c) for k in part] for c in columns}, "failed": [k in failed for k in part]})

    schema = f"{key} string, " + ", ".join(f"{c} string" for c in columns) + ", failed boolean"
    return keys.select(F.col(key).cast("string")).distinct().repartition(partitions).mapInPandas(work, schema)


def search_top(fetch_page: Pager, term: str, count: int) -> list[str]:
    """The first count accessions, of a page with some to spare."""
    return attempts(lambda: fetch_page(term, 0, max(2 * count, 100)))[1][:count]


def search_all(spark: SparkSession, fetch_page: Pager, term: str, *, page: int = 10_000, tries: int = 3, pause: float = 2.0, between: float = 0.4, partitions: int = 1, progress: Progress | None = None) -> DataFrame:
    """(pos, accession) of all that match, a page a call; one partition keeps to one call at a time."""
    total, _ = attempts(lambda: fetch_page(term, 0, 0), tries, pause)
    if progress:
        progress("pages", 0, -(-total // page))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for first in pdf["id"].tolist():
                _, found = attempts(lambda first=first: fetch_page(term, first, page), tries, pause)
                time.sleep(between)
                yield pd.DataFrame({"pos": range(first, first + len(found)), "accession": found})

    return spark.range(0, total, page, numPartitions=partitions).mapInPandas(work, "pos long, accession string")


def summary_fields(summary: dict) -> tuple[str, str | None, str]:
    """(key, create_date, title) of a summary: its versioned accession, else its caption, else its id."""
    text = lambda c: str(summary.get(c) or "").strip()
    return text("AccessionVersion") or text("Caption") or text("Id"), text("CreateDate") or None, text("Title")


def by_summary(fetch: Callable[[list[str]], list[dict]]) -> Fetcher:
    """A fetcher of dates and titles from one of summaries."""

    def fetched(keys: list[str]) -> dict[str, dict[str, str]]:
        return {key: {"create_date": date, "title": title} for key, date, title in map(summary_fields, fetch(keys)) if key}

    return fetched


def by_record(fetch: Callable[[list[str]], list[tuple[str, str, str]]]) -> Fetcher:
    """A fetcher of sequences from one of records (id, description, seq), one for each key and in their order."""

    def fetched(keys: list[str]) -> dict[str, dict[str, str]]:
        records = fetch(keys)
        if len(records) != len(keys):
            raise RuntimeError(f"{len(records)} records for {len(keys)} keys")
        return {k: {"record_id": i, "description": d, "seq": s} for k, (i, d, s) in zip(keys, records)}

    return fetched


def fetch_metadata(accessions: DataFrame, fetch: Callable[[list[str]], list[dict]], **more) -> DataFrame:
    """(accession, create_date, title, failed), by batches of 500 summaries."""
    return fetch_each(accessions, by_summary(fetch), ["create_date", "title"], **more)


def fetch_dates(accessions: DataFrame, fetch: Callable[[list[str]], list[dict]], **more) -> DataFrame:
    """(accession, create_date, failed), each batch asked for once."""
    return fetch_each(accessions, by_summary(fetch), ["create_date"], **({"tries": 1} | more))


def fetch_sequences(accessions: DataFrame, fetch: Callable[[list[str]], list[tuple[str, str, str]]], **more) -> DataFrame:
    """(accession, record_id, description, seq, failed), by batches of 20."""
    return fetch_each(accessions, by_record(fetch), ["record_id", "description", "seq"], **({"batch": 20} | more))
