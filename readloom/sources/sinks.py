"""Writers: FASTA, FASTQ, tab-separated tables, and JSON catalogs and intervals.

Each writes a folder of part files, in parallel; one_file=True asks for a single part, for small outputs.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.functions.sequences import phred_text
from readloom.operators.perturb import with_qualities
from readloom.scratch import Scratch


def fasta_text(reads: DataFrame, wrap: int | None = 60) -> DataFrame:
    """(value): one FASTA record a row; reads has read_id, seq and, if it has them, start and end."""
    header = F.concat(F.lit(">"), F.col("read_id").cast("string"))
    if {"start", "end"} <= set(reads.columns):
        header = F.concat(header, F.lit(" start="), F.col("start").cast("string"), F.lit(" end="), F.col("end").cast("string"))
    body = F.col("seq") if wrap is None else F.regexp_replace("seq", f"(.{{{wrap}}})(?=.)", "$1\n")
    return reads.select(F.concat_ws("\n", header, body).alias("value"))


def fastq_text(reads: DataFrame) -> DataFrame:
    """(value): one FASTQ record a row; qualities are added where there are none."""
    if "qual" not in reads.columns:
        reads = with_qualities(reads)
    return reads.select(F.concat_ws("\n", F.concat(F.lit("@"), F.col("read_id").cast("string")), "seq", F.lit("+"), phred_text(F.col("qual"))).alias("value"))


def _write(text: DataFrame, path: str, one_file: bool, mode: str) -> None:
    (text.coalesce(1) if one_file else text).write.mode(mode).text(path)


def write_fasta(reads: DataFrame, path: str, *, wrap: int | None = 60, one_file: bool = False, mode: str = "errorifexists") -> None:
    _write(fasta_text(reads, wrap), path, one_file, mode)


def write_fastq(reads: DataFrame, path: str, *, one_file: bool = False, mode: str = "errorifexists") -> None:
    _write(fastq_text(reads), path, one_file, mode)


def write_tsv(rows: DataFrame, path: str, *, order: str | None = None, mode: str = "errorifexists") -> None:
    """A tab-separated table with a header, sorted by a column if asked."""
    (rows.sort(order) if order else rows).write.mode(mode).csv(path, sep="\t", header=True)


def write_genomes(genomes: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A folder for each category, of FASTA part files whose headers name the genomes."""
    record = F.concat_ws("\n", F.concat(F.lit(">"), F.col("genome_id").cast("string")), F.col("seq"))
    genomes.select("category", record.alias("value")).write.mode(mode).partitionBy("category").text(path)


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def write_genome_files(genomes: DataFrame, path: str, wrap: int = 60) -> DataFrame:
    """One file for each genome, path/category/genome_id.fasta, as read_genomes reads them; (genome_id, file) of each.

    In two phases: tasks write to a folder of this run, under a name of their attempt that is renamed when whole; when all
    have ended, what they wrote is moved to its place.  A failed run leaves nothing, and a repeated task nothing twice.
    """
    spark, run = genomes.sparkSession, f"_run-{uuid.uuid4().hex[:12]}"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(path)
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for r in batch.to_pylist():
                folder, seq = f"{root}/{run}/{r['category']}", r["seq"] or ""
                store.create_dir(folder, recursive=True)
                lines = "\n".join(seq[i : i + wrap] for i in range(0, len(seq), wrap))
                with store.open_output_stream(f"{folder}/.{r['genome_id']}-{attempt}") as out:
                    out.write(f">{r['genome_id']}\n{lines}\n".encode())
                store.move(f"{folder}/.{r['genome_id']}-{attempt}", f"{folder}/{r['genome_id']}.fasta")
            yield batch.select(["genome_id", "category"])

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = _store(path)
        for batch in batches:
            files = []
            for r in batch.to_pylist():
                name = f"{r['category']}/{r['genome_id']}.fasta"
                # A task that is run again finds its files moved.
                if store.get_file_info(f"{root}/{run}/{name}").type != fs.FileType.NotFound:
                    store.create_dir(f"{root}/{r['category']}", recursive=True)
                    store.move(f"{root}/{run}/{name}", f"{root}/{name}")
                files.append(f"{root}/{name}")
            yield pa.RecordBatch.from_arrays([batch.column("genome_id"), pa.array(files, pa.string())], ["genome_id", "file"])

    scratch = Scratch(spark, "files")
    rows = genomes.select(F.col("genome_id").cast("string").alias("genome_id"), F.col("category").cast("string").alias("category"), "seq")
    try:
        # Saved: reading a result again must not write its files again.
        written = scratch.save(rows.mapInArrow(work, "genome_id string, category string"), "written")
        out = scratch.save(written.distinct().mapInArrow(moved, "genome_id string, file string"), "files")
    finally:
        store, root = _store(path)
        from pyarrow import fs

        if store.get_file_info(f"{root}/{run}").type != fs.FileType.NotFound:
            store.delete_dir(f"{root}/{run}")
    return out


def copy_cached(wanted: DataFrame, cache: DataFrame, path: str, by: str = "genome_id") -> DataFrame:
    """Writes the wanted genomes of a cache as files; ValueError, and nothing written, if the cache lacks one."""
    lacking = wanted.select(by).distinct().join(cache.select(by), by, "left_anti")
    if n := lacking.count():
        raise ValueError(f"{n} genomes are not in the cache, such as {[r[by] for r in lacking.sort(by).limit(5).collect()]}")
    return write_genome_files(cache.join(wanted.select(by).distinct(), by, "left_semi"), path)


def catalog_json(catalog: DataFrame, timestamp: str, metadata: bool = True) -> DataFrame:
    """(value): one JSON object of the whole catalog, categories as lists; for catalogs that fit one value."""
    item = F.struct("accession", F.coalesce("create_date", F.lit("")).alias("create_date"), F.coalesce("title", F.lit("")).alias("title")) if metadata else F.col("accession")
    names = {"bacterial": "bacteria", "viral": "virus", "archaea": "archaea", "plasmid": "plasmid"}
    lists = [F.transform(F.array_sort(F.collect_list(F.when(F.col("category") == c, F.struct("pos", item.alias("item"))))), lambda x: x["item"]).alias(n) for n, c in names.items()]
    return catalog.agg(*lists).select(F.to_json(F.struct(F.lit(timestamp).alias("timestamp"), *names)).alias("value"))


def intervals_json(intervals: DataFrame) -> DataFrame:
    """(value): a JSON object a genome record, from 'genome<TAB>record' to its [start, end] pairs."""
    pairs = F.transform(F.array_sort(F.collect_list(F.struct("start", "end"))), lambda x: F.array(x["start"], x["end"]))
    keyed = intervals.groupBy("genome_id", "record_id").agg(pairs.alias("pairs"))
    return keyed.select(F.to_json(F.create_map(F.concat_ws("\t", "genome_id", "record_id"), F.col("pairs"))).alias("value"))


def replace_text(text: DataFrame, path: str) -> None:
    """Puts the one row of text at path in place of what stands there: written beside it, then renamed over it."""
    spark = text.sparkSession
    scratch = Scratch(spark, "text")
    folder = f"{scratch.path}/text"
    text.coalesce(1).write.text(folder)
    fs = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    part = next(x.getPath() for x in fs.Path(folder).getFileSystem(conf).listStatus(fs.Path(folder)) if x.getPath().getName().startswith("part-"))
    target = fs.Path(path).makeQualified(fs.Path(path).getFileSystem(conf).getUri(), fs.Path(spark._jvm.java.lang.System.getProperty("user.dir")))
    beside = fs.Path(target.getParent(), f".{target.getName()}-{uuid.uuid4().hex[:8]}")
    fs.FileUtil.copy(part.getFileSystem(conf), part, target.getFileSystem(conf), beside, False, conf)
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    fs.FileContext.getFileContext(target.toUri(), conf).rename(beside, target, options)
    scratch.close()
