"""Command line: the engine's plans over FASTA folders and accession catalogs.

Commands that need sequences from outside take a folder of genomes; what it lacks is fetched into it by a function that is
named as module:function (--fetcher), which gives a record (id, description, sequence) for each accession, in order.  The
catalog commands work offline on the metadata that the catalog holds.
"""

from __future__ import annotations

import argparse
import importlib
import shlex
import sys
from collections.abc import Callable
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom import download_genomes
from readloom.functions.sequences import check_split_date, parse_weights
from readloom.operators import budgets, chunking, gapped, intervals, lookup, sampling, scoring, similarity, temporal
from readloom.plans import datasets
from readloom.scratch import Scratch
from readloom.session import get_session
from readloom.sources import readers, sinks
from readloom.sources.schemas import CATALOG_KEYS

CAPS = list(CATALOG_KEYS.values())


class Refused(Exception):
    """Arguments that cannot be used; its text goes to standard error."""


def _existing(path: str | None, what: str) -> str | None:
    if path is not None and not Path(path).exists():
        raise Refused(f"{what} not found: {path}")
    return path


def _not_negative(args: argparse.Namespace, *names: str) -> None:
    for name in names:
        value = getattr(args, name, None)
        if value is not None and value < 0:
            raise Refused(f"--{name.replace('_', '-')} must not be negative")


def _date(text: str) -> str:
    try:
        check_split_date(text)
    except ValueError as e:
        raise Refused(str(e)) from None
    return text


def _catalog(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(catalog, catalog with dates and titles), of which a side map wins whole."""
    _existing(path, "accessions file")
    catalog, side, _ = readers.read_catalog(spark, path)
    merged = temporal.merge_metadata(catalog, side)
    return catalog, catalog.drop("create_date", "title").join(merged, "accession", "left")


def _caps(args: argparse.Namespace, prefix: str = "max_") -> dict[str, int]:
    return {c: n for c in CAPS if (n := getattr(args, f"{prefix}{c}", None)) is not None}


def _show(df: DataFrame) -> None:
    for row in df.collect():  # reports of a few rows
        print("\t".join(f"{k}={v}" for k, v in row.asDict().items()))


def _recipe(args: argparse.Namespace) -> datasets.Recipe:
    recipe = datasets.Recipe(
        sequence_length=args.sequence_length, reads_per_genome=args.reads_per_organism, min_length=args.min_contig_length, max_length=args.max_contig_length, seed=args.seed,
        cap_total=args.cap_total_reads, forbid_ambiguous=args.forbid_ambiguous, substitution_rate=args.substitution_rate, indel_rate=args.indel_rate, error_model=args.error_model,
        fastq=args.output_fastq, abundance_profile=parse_weights(args.abundance_profile), abundance_distribution=args.abundance_distribution, balanced=args.balanced,
        balance_by_taxonomy=args.balance_viral_by_taxonomy, filter_similar=args.filter_similar, similarity_threshold=args.similarity_threshold, min_coverage=args.min_coverage, oversample=args.oversample_factor,
    )
    try:
        recipe.check()
    except ValueError as e:
        raise Refused(str(e)) from None
    if recipe.balance_by_taxonomy and not args.viral_taxonomy:
        raise Refused("--balance-viral-by-taxonomy needs --viral-taxonomy")
    return recipe


def _genomes(spark: SparkSession, path: str, checked: bool = True) -> DataFrame:
    _existing(path, "input")
    if Path(path).is_file():
        return readers.read_fasta(spark, path).filter("record_idx = 0")
    genomes = readers.read_genomes(spark, path)
    if checked:
        try:
            lookup.check_layout(genomes)
        except ValueError as e:
            raise Refused(str(e)) from None
    return genomes


def _write_reads(reads: DataFrame, args: argparse.Namespace) -> None:
    def one(part: DataFrame, path: str) -> None:
        (sinks.write_fastq if args.output_fastq else sinks.write_fasta)(part, path, mode="overwrite")

    if "split" in reads.columns:
        for split in ("train", "test"):
            one(reads.filter(F.col("split") == split).drop("split"), f"{args.output}_{split}")
    else:
        one(reads, args.output)
    if args.write_abundance:
        sinks.write_tsv(chunking.abundance(reads), f"{args.output}_abundance", order="genome_id", mode="overwrite")


def _build(spark: SparkSession, args: argparse.Namespace, genomes: DataFrame, masks: DataFrame | None = None) -> DataFrame:
    recipe = _recipe(args)
    taxonomy = readers.read_taxonomy(spark, _existing(args.viral_taxonomy, "taxonomy")) if args.viral_taxonomy else None
    extra = readers.read_fasta(spark, _existing(args.extra_viral_fasta, "extra viral FASTA")) if args.extra_viral_fasta else None
    if getattr(args, "eve_intervals", None):
        masks = readers.read_intervals(spark, _existing(args.eve_intervals, "intervals"))
    reads = datasets.build_dataset(genomes.select("genome_id", "category", "seq"), recipe, masks=masks, taxonomy=taxonomy, extra=extra)
    if args.train_test_split is not None:
        reads = datasets.split_and_filter(reads, args.train_test_split, recipe)
    return reads


def _viral_hits(genomes: DataFrame, reference: DataFrame | None, identity: float, evalue: float | None = None, max_subjects: int | None = None, index: DataFrame | None = None) -> DataFrame:
    """Merged intervals of non-viral genomes that align with viral ones.

    With an E-value, or a bound on subjects, alignments have gaps, and of each pair the best one counts.
    """
    others = readers.non_viral(genomes).select(F.col("genome_id").alias("id"), "seq")
    against = reference if reference is not None else readers.viral(genomes).select(F.col("genome_id").alias("id"), "seq")
    if evalue is not None or max_subjects is not None:
        hits = gapped.gapped_alignments(others, against, k=16, both_strands=True, max_evalue=evalue, max_subjects=max_subjects, index=index).filter("length >= 50")
    else:
        hits = similarity.alignments(others, against, k=16, min_bases=50, both_strands=True, index=index)
    hits = hits.filter(F.col("matches") * 100 >= F.col("length") * identity)
    # Places on the reverse strand are counted from its end.
    start = F.when(F.col("strand") == "-", F.col("qlen") - F.col("qend")).otherwise(F.col("qstart"))
    end = F.when(F.col("strand") == "-", F.col("qlen") - F.col("qstart")).otherwise(F.col("qend"))
    return intervals.merge_intervals(hits.select(F.col("q").alias("genome_id"), start.alias("start"), end.alias("end")), ["genome_id"])


def _fetcher(name: str) -> Callable:
    module, _, function = name.partition(":")
    try:
        return getattr(importlib.import_module(module), function)
    except (ImportError, AttributeError, ValueError) as e:
        raise Refused(f"no such fetcher: {name} ({e})") from None


def _fill(spark: SparkSession, args: argparse.Namespace, wanted: DataFrame) -> None:
    """Fetches the wanted genomes (accession, category) that the genome folder lacks; refused without a fetcher, or if one fails."""
    folder = args.genome_dir
    if args.fetcher:
        fetch = _fetcher(args.fetcher)
        Path(folder).mkdir(parents=True, exist_ok=True)
    present = readers.read_genomes(spark, _existing(folder, "genome folder")).select(F.col("genome_id").alias("accession"))
    lacking = wanted.select("accession", "category").dropDuplicates(["accession"]).join(present, "accession", "left_anti")
    if not (n := lacking.count()):
        return
    if not args.fetcher:
        raise Refused(f"{n} accessions have no genome in {folder}; give a --fetcher")
    got = download_genomes(lacking, fetch, folder, pause=args.fetch_pause, between=args.fetch_pause)
    if failed := got.filter("failed").count():
        raise Refused(f"{failed} of {n} accessions could not be fetched")


# --- commands ---------------------------------------------------------------------------------------


def download(spark, args):
    """Selects accessions, from a catalog or from counts per category, fetches them if it can, and reports what the genome folder lacks."""
    _not_negative(args, "num_bacteria", "num_virus", "num_archaea", "num_plasmid", *[f"max_{c}" for c in CAPS])
    catalog, _ = _catalog(spark, args.accessions_file)
    caps = _caps(args) or {c: getattr(args, f"num_{c}") for c in CAPS}
    chosen = sampling.stratified(temporal.first_of_each(catalog).join(readers.last_of_each(catalog).select("accession", "category"), "accession"), caps, args.sample_seed)
    if args.save_accessions:
        listed = chosen.select("accession", "category", F.col("first.pos").alias("pos"), F.lit(None).cast("string").alias("create_date"), F.lit(None).cast("string").alias("title"))
        sinks.catalog_json(listed, datetime.now(timezone.utc).isoformat(), metadata=False).coalesce(1).write.mode("overwrite").text(args.save_accessions)
    if args.fetcher:
        if not args.genome_dir:
            raise Refused("--fetcher needs --genome-dir")
        _fill(spark, args, chosen)
    present = readers.read_genomes(spark, _existing(args.genome_dir, "genome folder")).select(F.col("genome_id").alias("accession")) if args.genome_dir else chosen.select("accession").limit(0)
    _show(lookup.missing(chosen, present).agg(F.count("*").alias("missing")))


def snapshot(spark, args):
    catalog, dated = _catalog(spark, args.accessions_file)
    whole = dated if not args.no_metadata else catalog
    sinks.catalog_json(whole, datetime.now(timezone.utc).isoformat(), metadata=not args.no_metadata).coalesce(1).write.mode("overwrite").text(args.output)


def migrate_snapshot(spark, args):
    """Rewrites a catalog with its metadata inline."""
    _, dated = _catalog(spark, args.path)
    _, _, stamp = readers.read_catalog(spark, args.path)
    sinks.replace_text(sinks.catalog_json(dated, stamp or ""), args.path)


def chunk(spark, args):
    genomes = _genomes(spark, args.input)
    _write_reads(_build(spark, args, genomes), args)


def _acquired(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """The genomes of a catalog's accessions, of each category as many as asked for; what the folder lacks is fetched, or refused."""
    catalog, _ = _catalog(spark, args.accessions_file)
    caps = {c: n for c in CAPS if (n := getattr(args, f"num_{c}", None)) is not None}
    chosen = sampling.stratified(readers.last_of_each(catalog).select("accession", "category"), caps, args.sample_seed)
    # Kept: what is fetched is what is taken.
    chosen = Scratch(spark, "chosen").save(chosen, "chosen")
    _fill(spark, args, chosen)
    return _genomes(spark, args.genome_dir).join(chosen.select(F.col("accession").alias("genome_id")), "genome_id", "left_semi")


def pipeline(spark, args):
    _recipe(args)
    genomes = _acquired(spark, args) if args.accessions_file else _genomes(spark, args.genome_dir)
    masks = None
    if args.run_blastn_filter:
        masks = _viral_hits(genomes, None, args.perc_identity, args.evalue, args.max_target_seqs)
        sinks.write_fasta(intervals.export_regions(genomes, masks, ["genome_id"], args.eve_min_length).withColumnRenamed("region_id", "read_id"), f"{args.output}_eve", mode="overwrite")
    reads = _build(spark, args, genomes, masks)
    _write_reads(reads, args)
    if args.run_seeker:
        _seek(reads, f"{args.output}_seeker", args.threshold, args.seeker_min_length, args.seeker_command)


def blastn_filter(spark, args):
    if args.viral_reference_fasta and args.viral_db:
        raise Refused("give a viral reference FASTA or a viral table, not both")
    genomes = _genomes(spark, args.genome_dir)
    reference = index = None
    if args.viral_reference_fasta:
        reference = readers.read_fasta(spark, _existing(args.viral_reference_fasta, "viral reference")).select(F.col("record_id").alias("id"), "seq")
    elif args.viral_db:
        reference = spark.read.parquet(_existing(args.viral_db, "viral table")).select(F.col("name").alias("id"), "seq")
        keys = Path(str(args.viral_db).replace("viral_db", "viral_keys"))
        index = spark.read.parquet(str(keys)) if keys.exists() and keys != Path(args.viral_db) else None
    masks = _viral_hits(genomes, reference, args.perc_identity, args.evalue, args.max_target_seqs, index)
    keyed = masks.join(genomes.select("genome_id", "record_id"), "genome_id")
    sinks.intervals_json(keyed).write.mode("overwrite").text(f"{args.out_dir}/eve_intervals")
    if args.export_eve_fasta:
        sinks.write_fasta(intervals.export_regions(genomes, keyed, ["genome_id", "record_id"], args.eve_min_length).withColumnRenamed("region_id", "read_id"), f"{args.out_dir}/eve_regions", mode="overwrite")


def build_viral_db(spark, args):
    """The viral genomes of a catalog as one table, and their keys beside it, under the catalog's date."""
    catalog, _ = _catalog(spark, args.accessions_file)
    _, _, stamp = readers.read_catalog(spark, args.accessions_file)
    records = readers.read_genomes(spark, _existing(args.genome_dir, "genome folder"), first_record_only=False)
    wanted = catalog.filter("category = 'virus'").select(F.col("accession").alias("genome_id")).distinct()
    day = (stamp or "")[:10]
    try:
        check_split_date(day)
    except ValueError:
        day = datetime.now(timezone.utc).strftime("%Y-%m-%d")
    made = f"{args.output_dir}/viral_db/date={day}"
    lookup.concatenated(records.join(wanted, "genome_id", "left_semi")).write.mode("overwrite").parquet(made)
    keys = similarity.seed_keys(spark.read.parquet(made).select(F.col("name").alias("id"), "seq"), 16, sparse=False)
    keys.write.mode("overwrite").parquet(f"{args.output_dir}/viral_keys/date={day}")


def _seek(reads: DataFrame, out: str, threshold: float, min_length: int, command: str | None = None) -> None:
    """command: another program that scores (see scoring.process_scorer)."""
    scorer = scoring.process_scorer(shlex.split(command)) if command else scoring.gc_scorer
    # Scored once: both files are of the same predictions.
    predictions = Scratch(reads.sparkSession, "seek").save(scoring.predict(reads, scorer, min_length=min_length), "predictions")
    sinks.write_tsv(predictions, f"{out}/predictions", mode="overwrite")
    sinks.write_fasta(scoring.select_by_score(reads, predictions, threshold, min_length), f"{out}/positives", mode="overwrite")


def seeker(spark, args):
    reads = readers.read_fasta(spark, _existing(args.input, "input")).select(F.col("record_id").alias("read_id"), "seq")
    _seek(reads, args.out_dir, args.threshold, args.min_length, args.command_line)


def temporal_split(spark, args):
    cutoff = _date(args.split_date)
    catalog, dated = _catalog(spark, args.accessions_file)
    marked = temporal.with_split(dated, cutoff)
    for path, side in ((args.output_train, "is_train"), (args.output_test, "not is_train")):
        sinks.catalog_json(marked.filter(side), f"{'before' if side == 'is_train' else 'from'} {cutoff}", metadata=False).coalesce(1).write.mode("overwrite").text(path)


def temporal_split_info(spark, args):
    cutoff = _date(args.split_date)
    _show(temporal.preview(_catalog(spark, args.accessions_file)[1], cutoff))


def temporal_split_search(spark, args):
    _not_negative(args, "min_train", "min_test", *[f"min_{s}_{c}" for s in ("train", "test") for c in CAPS])
    dated = readers.last_of_each(_catalog(spark, args.accessions_file)[1])
    of = lambda side: {c: n for c in CAPS if (n := getattr(args, f"min_{side}_{c}")) is not None}
    # Bacteria and viruses have the whole test minimum each unless told otherwise.
    test = {"bacteria": args.min_test, "virus": args.min_test} | of("test")
    found = temporal.search_cutoff(dated, CAPS, args.min_train, args.min_test, of("train"), test)
    if found.isEmpty():
        raise Refused("no date leaves enough on both sides")
    _show(found)


def filter_test_against_train(spark, args):
    sides = [readers.read_fasta(spark, _existing(p, w)).select(F.col("record_id").alias("id"), "seq") for p, w in ((args.train, "train"), (args.test, "test"))]
    kept = similarity.drop_similar(sides[1], sides[0], identity=args.similarity_threshold, coverage=args.min_coverage, both_strands=True)
    _show(similarity.filter_statistics(sides[1], kept))
    sinks.write_fasta(kept.withColumnRenamed("id", "read_id"), args.output, mode="overwrite")


def temporal_pipeline(spark, args):
    cutoff = _date(args.split_date)
    _, dated = _catalog(spark, args.accessions_file)
    genomes = readers.read_genomes(spark, _existing(args.genome_dir, "genome folder")).select("genome_id", "category", "seq")
    recipe = datasets.Recipe(sequence_length=args.sequence_length, reads_per_genome=args.reads_per_organism)
    masks = None
    if args.run_blastn_filter:
        reference = spark.read.parquet(_existing(args.viral_db, "viral table")).select(F.col("name").alias("id"), "seq") if args.viral_db else None
        masks = _viral_hits(genomes, reference, args.perc_identity, args.evalue)
    reads = datasets.temporal_datasets(genomes, dated.select("accession", "category", "create_date"), cutoff, recipe, train_caps=dict.fromkeys(CAPS, args.train_per_category), test_caps=dict.fromkeys(CAPS, args.test_per_category), seeds=(args.train_seed, args.test_seed), masks=masks)
    for split in ("train", "test"):
        sinks.write_fasta(reads.filter(F.col("split") == split), f"{args.output_dir}/{split}", mode="overwrite")


def viral_taxonomy(spark, args):
    """Groups of a catalog's viruses, from a table of accession, taxid, and a table of taxid, rank, name or a folder of XML replies."""
    catalog, _ = _catalog(spark, args.accessions_file)
    taxids = spark.read.csv(_existing(args.taxids, "taxid table"), sep="\t", header=True)
    found = Path(_existing(args.lineages, "lineages"))
    if found.suffix == ".xml" or any(found.glob("*.xml")):
        lineages = readers.lineages_of(spark.read.text(str(found), wholetext=True))
    else:
        lineages = spark.read.csv(str(found), sep="\t", header=True)
    wanted = catalog.filter("category = 'virus'").select("accession").distinct()
    groups = lookup.accession_groups(wanted, taxids, lookup.lineage_group(lineages, args.level))
    pairs = groups.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("accession", "group"))))).alias("value"))
    pairs.coalesce(1).write.mode("overwrite").text(args.output)


def benchmark_recipe(spark, args):
    if args.per_category < 1 or args.replicates < 1 or args.diversity_attempts < 1 or not 0 <= args.train_percent <= 100:
        raise Refused("per-category, replicates and diversity-attempts must be at least 1, and train-percent between 0 and 100")
    recipe = datasets.Recipe(sequence_length=args.sequence_length, reads_per_genome=args.reads_per_organism, seed=args.seed)
    if args.accessions_file:
        wanted = readers.last_of_each(_catalog(spark, args.accessions_file)[0]).select("accession", "category")
        _fill(spark, args, wanted)
    genomes = _genomes(spark, args.genome_dir).select("genome_id", "category", "seq")
    if args.accessions_file:
        genomes = genomes.join(wanted.select(F.col("accession").alias("genome_id")), "genome_id", "left_semi")
    reads = datasets.benchmark_replicates(genomes, recipe, per_category=args.per_category, replicates=args.replicates, attempts=args.diversity_attempts, train_percent=args.train_percent, copy_to=args.genomes_to)
    text = reads.select("replicate", "split", F.concat_ws("\n", F.concat(F.lit(">"), "read_id"), "seq").alias("value"))
    text.write.mode("overwrite").partitionBy("replicate", "split").text(args.output_dir)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="readloom", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(name, f, *required, **options):
        p = commands.add_parser(name, help=(f.__doc__ or "").strip() or None)
        p.set_defaults(run=f)
        for r in required:
            p.add_argument(r if r == "path" else f"--{r}", **({} if r == "path" else {"required": True}))
        for k, v in options.items():
            flag = f"--{k.replace('_', '-')}"
            if v is False:
                p.add_argument(flag, action="store_true")
            elif isinstance(v, type):
                p.add_argument(flag, type=v, default=None)
            else:
                p.add_argument(flag, type=type(v), default=v)
        return p

    made = dict(
        reads_per_organism=int, balanced=False, min_contig_length=int, max_contig_length=int, seed=int, cap_total_reads=int, forbid_ambiguous=False, substitution_rate=0.0, indel_rate=0.0,
        extra_viral_fasta=str, abundance_profile=str, abundance_distribution=str, viral_taxonomy=str, balance_viral_by_taxonomy=False, error_model=str, output_fastq=False, write_abundance=False,
        filter_similar=False, similarity_threshold=90.0, min_coverage=0.8, oversample_factor=2.0, train_test_split=float,
    )
    caps = {f"max_{c}": int for c in CAPS}
    fetched = {"fetcher": str, "fetch_pause": 0.4}
    command("download", download, "accessions-file", num_bacteria=10, num_virus=10, num_archaea=0, num_plasmid=0, genome_dir=str, save_accessions=str, sample_seed=42, **fetched, **caps)
    command("snapshot", snapshot, "accessions-file", "output", no_metadata=False)
    command("migrate-snapshot", migrate_snapshot, "path")
    command("chunk", chunk, "input", "output", sequence_length=250, eve_intervals=str, **made)
    command("pipeline", pipeline, "genome-dir", "output", sequence_length=250, run_seeker=False, threshold=0.5, seeker_min_length=200, run_blastn_filter=False, perc_identity=70.0, eve_min_length=200, evalue=float, max_target_seqs=int, seeker_command=str, eve_intervals=str, accessions_file=str, sample_seed=42, **fetched, **{f"num_{c}": int for c in CAPS}, **(made | {"reads_per_organism": 1000}))
    command("blastn-filter", blastn_filter, "genome-dir", "out-dir", perc_identity=70.0, evalue=float, max_target_seqs=int, export_eve_fasta=False, eve_min_length=200, viral_reference_fasta=str, viral_db=str)
    command("build-viral-db", build_viral_db, "accessions-file", "genome-dir", "output-dir")
    command("seeker", seeker, "input", "out-dir", threshold=0.5, min_length=200, command_line=str)
    command("temporal-split", temporal_split, "accessions-file", "split-date", "output-train", "output-test")
    command("temporal-split-info", temporal_split_info, "accessions-file", "split-date")
    command("temporal-split-search", temporal_split_search, "accessions-file", min_train=1, min_test=1, **{f"min_{s}_{c}": int for s in ("train", "test") for c in CAPS})
    command("filter-test-against-train", filter_test_against_train, "train", "test", "output", similarity_threshold=90.0, min_coverage=0.8)
    command("temporal-pipeline", temporal_pipeline, "accessions-file", "split-date", "genome-dir", "output-dir", train_per_category=100, test_per_category=25, sequence_length=1000, reads_per_organism=30, train_seed=42, test_seed=43, run_blastn_filter=False, viral_db=str, perc_identity=70.0, evalue=float)
    command("viral-taxonomy", viral_taxonomy, "accessions-file", "taxids", "lineages", "output", level="family")
    command("benchmark-recipe", benchmark_recipe, "genome-dir", "output-dir", per_category=50, replicates=5, train_percent=80.0, diversity_attempts=3, seed=42, sequence_length=250, reads_per_organism=1000, accessions_file=str, genomes_to=str, **fetched)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        args.run(spark or get_session(), args)
    except Refused as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
