"""Sequencing errors, mutations and base qualities.

Each draw is a function of (seed, read_id, position, stream), so results depend on nothing else.  Bases are
A, C, G and T in upper case; a-z is folded first where any rate is positive, and other symbols pass untouched.
"""

from __future__ import annotations

from hashlib import md5

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom import rng
from readloom.functions.sequences import BASES, ascii_upper, error_rate, phred
from readloom.operators.similarity import spread


_BASES = frozenset(BASES)


def _draw(seed: int, i: Column, stream: str) -> Column:
    return rng.draw(rng.key_of(seed, "read_id", i, F.lit(stream)))


def _other_base(base: Column, u: Column) -> Column:
    """One of the three other bases."""
    others = F.replace(F.lit(BASES), base, F.lit(""))
    return F.substring(others, (F.floor(u * 3) + 1).cast("int"), F.lit(1))


def _per_base(seq: Column, f) -> Column:
    letters = F.filter(F.split(ascii_upper(seq), ""), lambda c: c != "")
    return F.array_join(F.transform(letters, lambda c, i: F.when(F.lit(BASES).contains(c), f(c, i)).otherwise(c)), "")


def mutate(reads: DataFrame, substitution: float = 0.0, indel: float = 0.0, seed: int = 42) -> DataFrame:
    """Uniform substitutions and indels: per base an indel at its rate (half put a random base before it, half
    delete it), then, unless deleted, a substitution at its rate."""
    if substitution <= 0 and indel <= 0:
        return reads

    def changed(read_id: str | None, seq: str | None) -> str | None:
        if seq is None:
            return None
        head = f"{seed}:" if read_id is None else f"{seed}:{read_id}:"
        out = []
        for i, c in enumerate(seq):
            if c not in _BASES:
                out.append(c)
                continue
            # As _draw, of the streams that the letter needs only.
            draw = lambda stream: int.from_bytes(md5(f"{head}{i}:{stream}".encode()).digest()[:4], "big") / 4294967296.0  # noqa: B023, E731
            if indel > 0 and draw("indel") < indel:
                if draw("kind") >= 0.5:
                    continue
                out.append(BASES[int(draw("ins") * 4)])
            out.append(BASES.replace(c, "")[int(draw("base") * 3)] if substitution > 0 and draw("sub") < substitution else c)
        return "".join(out)

    @F.arrow_udf("string")
    def mutated(ids: pa.Array, seqs: pa.Array) -> pa.Array:
        return pa.array(map(changed, ids.to_pylist(), seqs.to_pylist()), pa.string())

    return spread(reads).withColumn("seq", mutated(F.col("read_id").cast("string"), ascii_upper("seq")))


def illumina_errors(reads: DataFrame, seed: int = 42, base: float = 0.001, end: float = 0.012) -> DataFrame:
    """Substitutions at a rate that rises along the read."""
    if base <= 0 and end <= 0:
        return reads

    def change(c: Column, i: Column) -> Column:
        return F.when(_draw(seed, i, "err") < error_rate(i, F.length("seq"), base, end), _other_base(c, _draw(seed, i, "base"))).otherwise(c)

    return spread(reads).withColumn("seq", _per_base(F.col("seq"), change))


def with_qualities(reads: DataFrame) -> DataFrame:
    """reads with qual: a Phred score per base of the final sequence."""
    n = F.length("seq")
    return reads.withColumn("qual", F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: phred(i, n))).otherwise(F.array().cast("array<int>")))


#: Error models by name; a model beats uniform rates.
ERROR_MODELS = {"illumina": illumina_errors}


def perturb(reads: DataFrame, *, error_model: str | None = None, substitution: float = 0.0, indel: float = 0.0, seed: int = 42) -> DataFrame:
    if error_model is not None:
        if error_model not in ERROR_MODELS:
            raise ValueError(f"no such error model: {error_model!r}; there are {sorted(ERROR_MODELS)}")
        return ERROR_MODELS[error_model](reads, seed)
    return mutate(reads, substitution, indel, seed)
