"""Column functions on sequences, read ids and catalog dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BASES = "ACGT"
CATEGORIES = ("bacteria", "virus", "archaea", "plasmid")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ascii_upper(seq: Column | str) -> Column:
    """Upper case of a-z alone: keeps the length, which upper() does not (sharp s)."""
    return F.translate(_col(seq), LOWER, UPPER)


def reverse_complement(seq: Column | str) -> Column:
    return F.reverse(F.translate(_col(seq), "ACGTacgt", "TGCAtgca"))


def is_unambiguous(seq: Column | str, alphabet: str = BASES) -> Column:
    """Whether all characters are in the alphabet, in either case; an empty sequence passes."""
    return F.translate(ascii_upper(seq), alphabet, "") == ""


def category_of_path(path: Column | str) -> Column:
    """The parent folder's name if it is a category, else 'other'."""
    parent = F.lower(F.element_at(F.split(_col(path), "/"), -2))
    return F.when(parent.isin(*CATEGORIES), parent).otherwise("other")


def genome_of_read(read_id: Column | str) -> Column:
    """The genome's id in a read's id; where a column has it, use that."""
    found = F.regexp_extract(_col(read_id), r"^(.*)_(read|contig)_[^_]*$", 1)
    return F.when(found == "", _col(read_id)).otherwise(found)


def error_rate(i: Column, length: Column, base: float = 0.001, end: float = 0.012) -> Column:
    """Substitution rate at a position: linear from base at the first to end at the last."""
    return F.lit(base) + F.lit(end - base) * i / F.greatest(F.lit(1), length - 1)


def phred(i: Column, length: Column, base: float = 0.001, end: float = 0.012) -> Column:
    """Phred score of that rate, rounded half to even, within 0 to 41; 30 where there is no length."""
    score = F.bround(F.lit(-10.0) * F.log10(error_rate(i, length, base, end)), 0).cast("int")
    return F.when(length <= 0, F.lit(30)).otherwise(F.least(F.lit(41), F.greatest(F.lit(0), score)))


def phred_text(qualities: Column) -> Column:
    """Phred+33 text of an array of scores."""
    return F.array_join(F.transform(qualities, lambda q: F.char(q + 33)), "")


def date_key(date: Column | str) -> Column:
    """(year, month, day) of YYYY/MM/DD or YYYY-MM-DD, as numbers and unchecked; (0, 0, 0) of anything else."""
    parts = F.split(F.regexp_replace(_col(date), "-", "/"), "/")
    numbers = [parts.getItem(i).try_cast("int") for i in range(3)]
    good = (F.size(parts) == 3) & numbers[0].isNotNull() & numbers[1].isNotNull() & numbers[2].isNotNull()
    field = lambda n: F.when(good, n).otherwise(0)
    return F.struct(field(numbers[0]).alias("y"), field(numbers[1]).alias("m"), field(numbers[2]).alias("d"))


def iso_date(key: Column) -> Column:
    return F.format_string("%04d-%02d-%02d", key["y"], key["m"], key["d"])


def check_split_date(text: str) -> tuple[int, int, int]:
    """The parts of a YYYY-MM-DD split date; ValueError unless it looks like one (no calendar is consulted)."""
    parts = text.split("-")
    if len(text) != 10 or len(parts) != 3 or not all(p.isdigit() for p in parts):
        raise ValueError(f"not a date as YYYY-MM-DD: {text!r}")
    y, m, d = map(int, parts)
    if not (1 <= m <= 12 and 1 <= d <= 31):
        raise ValueError(f"no such month or day: {text!r}")
    return y, m, d


def parse_weights(text: str | None) -> dict[str, float] | None:
    """'bacteria=0.5,virus=2' as a dict; parts without = are skipped; None if nothing is left."""
    pairs = [p.split("=", 1) for p in (text or "").split(",") if "=" in p]
    return {k.strip(): float(v) for k, v in pairs} or None
