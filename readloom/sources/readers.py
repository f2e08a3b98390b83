"""Readers: FASTA folders, catalogs, hit tables, intervals and taxonomies."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from readloom.functions.sequences import CATEGORIES, category_of_path
from readloom.operators.intervals import hits_to_intervals
from readloom.scratch import Scratch
from readloom.sources.schemas import CATALOG_ITEM, CATALOG_KEYS, HITS_4, HITS_12, PREDICTIONS


def _records(files: DataFrame) -> DataFrame:
    """Records of whole FASTA files: value and path to record_idx, record_id, description, seq."""
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.fasta$", "")
    parts = files.select("path", stem.alias("genome_id"), F.posexplode(F.split(F.concat(F.lit("\n"), "value"), r"\r?\n>")).alias("n", "part")).filter("n > 0")
    header = F.regexp_extract("part", r"^([^\r\n]*)", 1)
    body = F.regexp_replace(F.regexp_replace("part", r"^[^\r\n]*", ""), r"\s+", "")
    return parts.select("genome_id", (F.col("n") - 1).alias("record_idx"), F.regexp_extract(header, r"^(\S*)", 1).alias("record_id"), F.trim(F.regexp_replace(header, r"^\S*", "")).alias("description"), category_of_path("path").alias("category"), body.alias("seq"), "path")


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, block, i, value): each record's number in its block of a file; what stands before a file's first record is left out."""
    before, n = None, 0
    for batch in batches:
        keys = list(zip(batch.column("path").to_pylist(), batch.column("block").to_pylist()))
        keep, i, opens = [], [], []
        for row, key in enumerate(keys):
            if key != before:
                before, n = key, 0
                if key[1] == 0:  # only a file's first record still has its sign
                    if not (batch.column("value")[row].as_py() or "").startswith(">"):
                        continue
                    opens.append(row)
            keep.append(row)
            i.append(n)
            n += 1
        value = batch.column("value")
        if opens:
            mask = np.zeros(batch.num_rows, bool)
            mask[opens] = True
            value = pc.if_else(pa.array(mask), pc.binary_replace_slice(value, 0, 1, ""), value)
        rows = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("path").take(rows), batch.column("block").take(rows), pa.array(i, pa.int64()), value.take(rows)], ["path", "block", "i", "value"])


def _fasta(spark: SparkSession, paths: str | list[str], first_only: bool = False) -> DataFrame:
    """Records of *.fasta files.  Files are split in blocks of bytes and read in parallel; a record belongs to the block that it begins in.

    Numbers of records are those in their block and the counts of the blocks before it; with first_only none is needed.
    """
    raw = spark.read.option("pathGlobFilter", "*.fasta").option("lineSep", "\n>").text(paths)
    placed = raw.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")).mapInArrow(_placed, "path string, block long, i long, value string")
    if first_only:
        placed = placed.filter("block = 0 and i = 0").withColumn("base", F.lit(0))
    else:
        scratch = Scratch(spark, "fasta")
        counts = placed.groupBy("path", "block").agg(F.count("*").alias("n"))
        earlier = F.sum("n").over(Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
        bases = scratch.save(counts.select("path", "block", earlier.alias("base")).filter("base > 0"), "bases")
        # Most files are one block: then nothing is joined.
        placed = placed.withColumn("base", F.lit(0)) if bases.isEmpty() else placed.join(bases, ["path", "block"], "left")
    header = F.regexp_extract("value", r"^([^\r\n]*)", 1)
    body = F.regexp_replace(F.regexp_replace("value", r"^[^\r\n]*", ""), r"\s+", "")
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.fasta$", "")
    number = (F.col("i") + F.coalesce("base", F.lit(0))).cast("int")
    return placed.select(stem.alias("genome_id"), number.alias("record_idx"), F.regexp_extract(header, r"^(\S*)", 1).alias("record_id"), F.trim(F.regexp_replace(header, r"^\S*", "")).alias("description"), category_of_path("path").alias("category"), body.alias("seq"), "path")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """Records of one FASTA file, or of a folder or glob of *.fasta files."""
    return _fasta(spark, path)


def read_genomes(spark: SparkSession, root: str, first_record_only: bool = True) -> DataFrame:
    """Genomes of the category folders under root or, if those hold none, of root itself.

    A flat file's category comes from its name's start (viral_ ...), else it is 'other'.  Only the first record of a
    genome is kept unless all are asked for.
    """
    fs = spark._jvm.org.apache.hadoop.fs
    base = fs.Path(root)
    store = base.getFileSystem(spark._jsc.hadoopConfiguration())
    folders = [f"{root}/{c}" for c in CATEGORIES if store.exists(fs.Path(f"{root}/{c}")) and any(s.getPath().getName().endswith(".fasta") for s in store.listStatus(fs.Path(f"{root}/{c}")))]
    if folders:
        return _fasta(spark, folders, first_record_only)
    named = F.coalesce(*[F.when(F.col("genome_id").startswith(f"{k}_"), v) for k, v in {"bacterial": "bacteria", "viral": "virus", "archaea": "archaea", "plasmid": "plasmid"}.items()], F.lit("other"))
    return _fasta(spark, root, first_record_only).withColumn("category", named)


def viral(genomes: DataFrame) -> DataFrame:
    return genomes.filter(F.col("category") == "virus")


def non_viral(genomes: DataFrame) -> DataFrame:
    return genomes.filter(F.col("category") != "virus")


def read_catalog(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, str | None]:
    """(catalog, side map, timestamp) of an accession JSON, whose lists hold ids or objects, or a mix.

    catalog: accession, category, category_order, pos, create_date, title; items without an accession are
    dropped.  side: accession, create_date, title of the older metadata map.
    """
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", "timestamp string, accession_metadata map<string, struct<create_date: string, title: string>>, " + ", ".join(f"{k} array<string>" for k in CATALOG_KEYS)).alias("j"))
    lists = None
    for i, (key, category) in enumerate(CATALOG_KEYS.items()):
        # An object in an array<string> arrives as its JSON text.
        one = whole.select(F.posexplode(f"j.{key}").alias("pos", "item")).withColumn("o", F.when(F.col("item").startswith("{"), F.from_json("item", CATALOG_ITEM)))
        one = one.select(F.when(F.col("o").isNotNull(), F.col("o.accession")).otherwise(F.col("item")).alias("accession"), F.lit(category).alias("category"), F.lit(i).alias("category_order"), "pos", "o.create_date", "o.title")
        lists = one if lists is None else lists.unionByName(one)
    side = whole.select(F.explode("j.accession_metadata").alias("accession", "m")).select("accession", "m.create_date", "m.title")
    stamp = whole.select("j.timestamp").first()
    return lists.filter("accession is not null and accession <> ''"), side, stamp[0] if stamp else None


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """12-column hits; rows with fewer than the eight needed columns are skipped."""
    return spark.read.schema(HITS_12).csv(path, sep="\t", mode="PERMISSIVE").filter("qseqid is not null and qstart is not null and qend is not null")


def read_hit_intervals(spark: SparkSession, path: str) -> DataFrame:
    return hits_to_intervals(read_hits(spark, path))


def read_similar_hits(spark: SparkSession, path: str) -> DataFrame:
    """4-column hits; malformed rows are skipped."""
    return spark.read.schema(HITS_4).csv(path, sep="\t", mode="PERMISSIVE").filter("pident is not null and length is not null")


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """name, prediction, score; the header and rows with a bad score are skipped; ValueError if none is left."""
    rows = spark.read.schema("name string, prediction string, score string").csv(path, sep="\t").withColumn("score", F.col("score").try_cast("double")).filter("score is not null")
    if rows.isEmpty():
        raise ValueError(f"no predictions in {path}")
    return rows.to(spark.createDataFrame([], PREDICTIONS).schema)


def read_intervals(spark: SparkSession, path: str) -> DataFrame:
    """genome_id, record_id, start, end of JSON objects from 'genome<TAB>record' to [start, end] pairs."""
    pairs = spark.read.text(path, wholetext=True).select(F.explode(F.split("value", r"\n(?=\{)")).alias("value"))
    keyed = pairs.select(F.explode(F.from_json("value", "map<string, array<array<bigint>>>")).alias("key", "pairs"))
    names = F.split("key", "\t")
    return keyed.select(names[0].alias("genome_id"), names[1].alias("record_id"), F.explode("pairs").alias("p")).select("genome_id", "record_id", F.col("p")[0].alias("start"), F.col("p")[1].alias("end"))


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """genome_id, group of a JSON object."""
    return spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string, string>")).alias("genome_id", "group"))


def last_of_each(catalog: DataFrame) -> DataFrame:
    """One row per accession: that of its last category."""
    w = Window.partitionBy("accession").orderBy(F.desc("category_order"), F.desc("pos"))
    return catalog.withColumn("n", F.row_number().over(w)).filter("n = 1").drop("n")


# --- taxonomy replies ------------------------------------------------------------------------------

_TAXA = "Taxon array<struct<TaxId: string, LineageEx: struct<Taxon: array<struct<TaxId: string, ScientificName: string, Rank: string>>>>>"
_LINKS = "LinkSet array<struct<LinkSetDb: array<struct<DbTo: string, Link: array<struct<Id: string>>>>>>"


def lineages_of(replies: DataFrame) -> DataFrame:
    """(taxid, rank, name, place) of taxonomy replies (value: XML), a row for each named rank of a lineage; place counts from its root.

    A taxon without a lineage has one row without rank and name; replies that are no XML give none.
    """
    taxa = replies.select(F.explode(F.from_xml("value", F.lit(_TAXA), {"ignoreNamespace": "true"}).getField("Taxon")).alias("t")).filter("t.TaxId is not null and t.TaxId <> ''")
    each = taxa.select(F.col("t.TaxId").alias("taxid"), F.posexplode_outer("t.LineageEx.Taxon").alias("place", "l"))
    return each.select("taxid", F.lower("l.Rank").alias("rank"), F.col("l.ScientificName").alias("name"), "place")


def taxids_of(replies: DataFrame) -> DataFrame:
    """(accession, taxid) of link replies (accessions: those asked for, in order; value: XML).

    A reply has a set of links for each accession, in order, or one set with a link for each; the first taxonomy link of a set counts.
    """
    sets = F.from_xml("value", F.lit(_LINKS), {"ignoreNamespace": "true"}).getField("LinkSet")
    links = lambda s: F.get(F.filter(s.getField("LinkSetDb"), lambda d: d.getField("DbTo") == "taxonomy"), F.lit(0)).getField("Link")
    parsed = replies.select("accessions", F.coalesce(sets, F.array()).alias("sets"))
    ids = F.when((F.size("sets") == 1) & (F.size("accessions") > 1), F.transform(links(F.get("sets", F.lit(0))), lambda x: x.getField("Id"))).otherwise(F.transform("sets", lambda s: F.get(links(s), F.lit(0)).getField("Id")))
    each = parsed.select(F.explode(F.arrays_zip(F.col("accessions").alias("accession"), ids.alias("taxid"))).alias("x"))
    return each.select("x.accession", "x.taxid").filter("accession is not null and taxid is not null and taxid <> ''")
