"""Readloom: sequence-dataset analytics as composable Spark DataFrame operators.

The verbs below take paths or DataFrames and return DataFrames; the modules under operators, sources and plans
hold everything else.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

__all__ = ["build_metagenome", "download_genomes", "get_file_stats", "load_accessions", "validate_genome_dir"]


def load_accessions(spark: SparkSession, path: str) -> DataFrame:
    """accession, category, category_order, pos, create_date, title of an accession file."""
    from readloom.sources.readers import read_catalog

    return read_catalog(spark, path)[0]


def download_genomes(accessions: DataFrame, fetch: Callable, path: str, *, cached: DataFrame | None = None, **more) -> DataFrame:
    """Fetches accession, category that a cache (genome_id) lacks, and writes a file each: (accession, failed)."""
    from readloom.scratch import Scratch
    from readloom.sources import remote, sinks

    wanted = accessions if cached is None else accessions.join(cached.selectExpr("genome_id AS accession"), "accession", "left_anti")
    wanted = wanted.select("accession", "category").dropDuplicates(["accession"])
    got = Scratch(accessions.sparkSession, "fetched").save(remote.fetch_sequences(wanted, fetch, **more), "records")
    sinks.write_genome_files(got.filter("not failed and seq is not null").join(wanted, "accession").selectExpr("accession AS genome_id", "category", "seq"), path)
    return got.selectExpr("accession", "failed OR seq IS NULL AS failed")


def build_metagenome(genomes: DataFrame, recipe=None, **more) -> DataFrame:
    """The reads of a data set; see plans.datasets.build_dataset."""
    from readloom.plans import datasets

    return datasets.build_dataset(genomes, recipe or datasets.Recipe(), **more)


def get_file_stats(genomes: DataFrame, length: int = 250) -> DataFrame:
    """genome_id, total_bases, max_reads."""
    from readloom.operators.budgets import genome_stats

    return genome_stats(genomes, length)


def validate_genome_dir(spark: SparkSession, path: str) -> DataFrame:
    """The genomes of a folder; ValueError unless a viral and another one are there."""
    from readloom.operators.lookup import check_layout
    from readloom.sources.readers import read_genomes

    genomes = read_genomes(spark, path)
    check_layout(genomes)
    return genomes
