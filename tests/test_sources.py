"""Files in and out, and the command line."""

import json

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from readloom.cli import main
from readloom.operators import chunking, temporal
from readloom.sources import readers, remote, sinks

from test_operators import dna


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("genomes")
    for i, c in enumerate(["bacteria", "virus", "archaea", "plasmid"]):
        (root / c).mkdir()
        for j in range(3):
            text = dna(1200, 10 * i + j)
            lines = "\n".join(text[k : k + 60] for k in range(0, 1200, 60))
            second = f">{c}{j}.2 second\nACGTNN\n" if j == 0 else ""
            (root / c / f"{c}{j}.fasta").write_text(f">{c}{j}.1 first record of {c}\n{lines}\n{second}")
    (root / "virus" / "notes.txt").write_text(">not a genome\nACGT\n")
    return root


@pytest.fixture(scope="module")
def catalog(tmp_path_factory):
    path = tmp_path_factory.mktemp("catalog") / "catalog.json"
    item = lambda a, d: {"accession": a, "create_date": d, "title": f"title of {a}"}
    data = {
        "timestamp": "2025-03-04T05:06:07Z", "bacterial": [item(f"bacteria{i}", f"202{3 + i}/01/01") for i in range(3)], "viral": [item(f"virus{i}", f"202{3 + i}-06-01") for i in range(3)],
        "archaea": ["archaea0", {"accession": "", "title": "x"}, item("archaea1", ""), {"accession": "archaea2"}], "plasmid": [],
    }
    path.write_text(json.dumps(data))
    return path


def test_fasta_folders(spark, folder, tmp_path):
    first = readers.read_genomes(spark, str(folder))
    assert first.count() == 12 and readers.viral(first).count() == 3 and readers.non_viral(first).count() == 9
    every = {(r["genome_id"], r["record_idx"]): r for r in readers.read_genomes(spark, str(folder), first_record_only=False).collect()}
    r = every["virus0", 0]
    assert (r["record_id"], r["description"], r["category"], r["seq"]) == ("virus0.1", "first record of virus", "virus", dna(1200, 10))
    assert len(every) == 16 and every["virus0", 1]["seq"] == "ACGTNN"
    flat = tmp_path / "flat"
    flat.mkdir()
    (flat / "viral_x.fasta").write_text(">x\nAC\nGT\n")
    (flat / "y.fasta").write_text("\n>y\nA\n")
    assert {(r["genome_id"], r["category"], r["seq"]) for r in readers.read_genomes(spark, str(flat)).collect()} == {("viral_x", "virus", "ACGT"), ("y", "other", "A")}


def test_catalogs(spark, catalog, tmp_path):
    rows, side, stamp = readers.read_catalog(spark, str(catalog))
    assert stamp == "2025-03-04T05:06:07Z" and side.count() == 0
    assert sorted(r["accession"] for r in rows.collect()) == sorted([f"bacteria{i}" for i in range(3)] + [f"virus{i}" for i in range(3)] + [f"archaea{i}" for i in range(3)])
    text = sinks.catalog_json(rows, stamp).first()["value"]
    again = tmp_path / "again.json"
    again.write_text(text)
    assert {tuple(r) for r in readers.read_catalog(spark, str(again))[0].select("accession", "category", "pos").collect()} == {tuple(r) for r in rows.select("accession", "category", (F.row_number().over(Window.partitionBy("category").orderBy("pos")) - 1).alias("pos")).collect()}
    old = tmp_path / "old.json"
    old.write_text(json.dumps({"bacterial": ["a", "b"], "viral": [{"accession": "a", "create_date": "1999/01/01", "title": "t"}], "accession_metadata": {"a": {"create_date": "2020/01/01", "title": "side"}}}))
    rows, side, _ = readers.read_catalog(spark, str(old))
    assert {r["accession"]: r["create_date"] for r in temporal.merge_metadata(rows, side).collect()} == {"a": "2020/01/01"}
    assert {r["accession"]: r["create_date"] for r in temporal.merge_metadata(rows, side.limit(0)).collect()} == {"a": "1999/01/01"}
    assert {r["accession"]: r["category"] for r in readers.last_of_each(rows).collect()} == {"a": "virus", "b": "bacteria"}


def test_hits_intervals_predictions_taxonomy(spark, tmp_path):
    hits = tmp_path / "hits.tsv"
    hits.write_text("g\ts\t99.0\t100\t0\t0\t1\t100\t1\t100\t1e-9\t200\ng\ts\t99\ng\ts\t99.0\t51\t0\t0\t200\t150\t1\t51\t1e-9\t90\n")
    assert sorted((r["start"], r["end"]) for r in readers.read_hit_intervals(spark, str(hits)).collect()) == [(0, 100), (149, 200)]
    short = tmp_path / "short.tsv"
    short.write_text("q1\ts\t95.0\t900\nbad\nq2\ts\tx\t1\n")
    assert [r["qseqid"] for r in readers.read_similar_hits(spark, str(short)).collect()] == ["q1"]
    iv = spark.createDataFrame([("g", "r", 5, 9), ("g", "r", 1, 3), ("h", "r", 0, 2)], "genome_id string, record_id string, start long, end long")
    sinks.intervals_json(iv).write.text(str(tmp_path / "iv"))
    assert {tuple(r) for r in readers.read_intervals(spark, str(tmp_path / "iv")).collect()} == {tuple(r) for r in iv.collect()}
    good = tmp_path / "p.tsv"
    good.write_text("name\tprediction\tscore\na\tphage\t0.9\nb\tphage\tbad\n")
    assert [tuple(r) for r in readers.read_predictions(spark, str(good)).collect()] == [("a", "phage", 0.9)]
    good.write_text("name\tprediction\tscore\n")
    with pytest.raises(ValueError):
        readers.read_predictions(spark, str(good))
    tax = tmp_path / "tax.json"
    tax.write_text('{"a": "F", "b": "G"}')
    assert {tuple(r) for r in readers.read_taxonomy(spark, str(tax)).collect()} == {("a", "F"), ("b", "G")}


def test_sinks(spark, tmp_path):
    reads = spark.createDataFrame([("g_read_0", "g", 0, 130, "A" * 130)], "read_id string, genome_id string, start long, end long, seq string")
    assert sinks.fasta_text(reads).first()["value"] == ">g_read_0 start=0 end=130\n" + "A" * 60 + "\n" + "A" * 60 + "\n" + "A" * 10
    lines = sinks.fastq_text(reads).first()["value"].split("\n")
    assert lines[0] == "@g_read_0" and lines[2] == "+" and len(lines[3]) == 130 and lines[3][0] == chr(30 + 33)
    sinks.write_fasta(reads, str(tmp_path / "x.fasta"), one_file=True)
    assert readers._records(spark.read.text(str(tmp_path / "x.fasta"), wholetext=True).select("value", F.lit("/virus/x.fasta").alias("path"))).first()["seq"] == "A" * 130
    sinks.write_tsv(chunking.abundance(reads), str(tmp_path / "ab"), order="genome_id")
    assert spark.read.csv(str(tmp_path / "ab"), sep="\t", header=True).first().asDict() == {"genome_id": "g", "read_count": "1", "proportion": "1.0"}


def test_remote_batches_fall_back_to_single_keys(spark):
    def fetch(keys):
        if len(keys) > 1 and "bad" in keys or keys == ["bad"]:
            raise OSError("no")
        return {k: {"title": k.upper()} for k in keys if k != "none"}

    keys = spark.createDataFrame([("a",), ("bad",), ("none",)], "accession string")
    got = {r["accession"]: (r["title"], r["failed"]) for r in remote.fetch_each(keys, fetch, ["title"], tries=2, pause=0.0).collect()}
    assert got == {"a": ("A", False), "bad": (None, True), "none": (None, False)}


@pytest.mark.parametrize(
    "argv",
    [
        ["chunk", "--input", "/nowhere", "--output", "x"],
        ["chunk", "--input", "{genomes}", "--output", "x", "--sequence-length", "0"],
        ["chunk", "--input", "{genomes}", "--output", "x", "--sequence-length", "-5"],
        ["chunk", "--input", "{genomes}", "--output", "x", "--reads-per-organism", "-1"],
        ["chunk", "--input", "{genomes}", "--output", "x", "--cap-total-reads", "-1"],
        ["chunk", "--input", "{genomes}", "--output", "x", "--min-contig-length", "9", "--max-contig-length", "5"],
        ["chunk", "--input", "{genomes}", "--output", "x", "--min-contig-length", "9"],
        ["chunk", "--input", "{genomes}", "--output", "x", "--substitution-rate", "2"],
        ["chunk", "--input", "{genomes}", "--output", "x", "--eve-intervals", "/nowhere.json"],
        ["chunk", "--input", "{genomes}", "--output", "x", "--balance-viral-by-taxonomy", "--reads-per-organism", "5"],
        ["chunk", "--input", "{genomes}", "--output", "x", "--viral-taxonomy", "/nowhere.json"],
        ["download", "--accessions-file", "/nowhere.json"],
        ["download", "--accessions-file", "{catalog}", "--num-bacteria", "-1"],
        ["temporal-split", "--accessions-file", "/nowhere.json", "--split-date", "2025-01-01", "--output-train", "a", "--output-test", "b"],
        ["temporal-split-info", "--accessions-file", "{catalog}", "--split-date", "2020-13-45"],
        ["temporal-split-search", "--accessions-file", "{catalog}", "--min-train", "-1"],
        ["temporal-split-search", "--accessions-file", "{catalog}", "--min-train", "100"],
        ["blastn-filter", "--genome-dir", "/nowhere", "--out-dir", "x"],
        ["seeker", "--input", "/nowhere.fasta", "--out-dir", "x"],
        ["filter-test-against-train", "--train", "/nowhere", "--test", "/nowhere", "--output", "x"],
        ["benchmark-recipe", "--genome-dir", "{genomes}", "--output-dir", "x", "--replicates", "0"],
    ],
)
def test_bad_arguments_are_refused(spark, folder, catalog, argv, capsys):
    assert main([a.format(genomes=folder, catalog=catalog) for a in argv], spark) == 1
    assert capsys.readouterr().err.startswith("error: ")


def test_commands(spark, folder, catalog, tmp_path, capsys):
    run = lambda *argv: main([str(a) for a in argv], spark)
    out = tmp_path / "reads"
    assert run("chunk", "--input", folder, "--output", out, "--reads-per-organism", 3, "--write-abundance") == 0
    assert sum(line.value.startswith(">") for line in spark.read.text(str(out)).collect()) == 36
    assert spark.read.csv(f"{out}_abundance", sep="\t", header=True).count() == 12
    assert run("pipeline", "--genome-dir", folder, "--output", tmp_path / "p", "--output-fastq", "--run-blastn-filter", "--run-seeker", "--train-test-split", 50, "--cap-total-reads", 20) == 0
    assert spark.read.text(f"{tmp_path}/p_train").count() + spark.read.text(f"{tmp_path}/p_test").count() == 80
    assert run("temporal-split", "--accessions-file", catalog, "--split-date", "2025-01-01", "--output-train", tmp_path / "tr", "--output-test", tmp_path / "te") == 0
    train = json.loads(spark.read.text(str(tmp_path / "tr")).first()["value"])
    assert train["viral"] == ["virus0", "virus1"] and train["archaea"] == ["archaea0", "archaea1", "archaea2"]
    assert run("temporal-split-info", "--accessions-file", catalog, "--split-date", "2025-01-01") == 0
    assert run("temporal-split-search", "--accessions-file", catalog, "--min-train", 2, "--min-test", 1) == 0
    assert "cutoff=2025-01-01" in capsys.readouterr().out
    assert run("temporal-pipeline", "--accessions-file", catalog, "--split-date", "2025-01-01", "--genome-dir", folder, "--output-dir", tmp_path / "tp", "--sequence-length", 200, "--reads-per-organism", 2) == 0
    assert run("build-viral-db", "--accessions-file", catalog, "--genome-dir", folder, "--output-dir", tmp_path / "db") == 0
    db = f"{tmp_path}/db/viral_db/date=2025-03-04"
    assert spark.read.parquet(db).count() == 4
    assert run("blastn-filter", "--genome-dir", folder, "--out-dir", tmp_path / "eve", "--viral-db", db, "--export-eve-fasta") == 0
    assert run("download", "--accessions-file", catalog, "--genome-dir", folder, "--save-accessions", tmp_path / "acc", "--max-virus", 1) == 0
    assert run("snapshot", "--accessions-file", catalog, "--output", tmp_path / "snap") == 0
    copy = tmp_path / "copy.json"
    copy.write_text(catalog.read_text())
    assert run("migrate-snapshot", copy) == 0 and json.loads(copy.read_text())["viral"][0]["accession"] == "virus0"
    assert run("filter-test-against-train", "--train", folder / "virus", "--test", folder / "bacteria", "--output", tmp_path / "f") == 0
    (tmp_path / "taxids.tsv").write_text("accession\ttaxid\nvirus0\t1\n")
    (tmp_path / "lineages.tsv").write_text("taxid\trank\tname\n1\tfamily\tF\n")
    assert run("viral-taxonomy", "--accessions-file", catalog, "--taxids", tmp_path / "taxids.tsv", "--lineages", tmp_path / "lineages.tsv", "--output", tmp_path / "tax") == 0
    assert json.loads(spark.read.text(str(tmp_path / "tax")).first()["value"]) == {"virus0": "F", "virus1": "unknown", "virus2": "unknown"}
    assert run("benchmark-recipe", "--genome-dir", folder, "--output-dir", tmp_path / "b", "--per-category", 1, "--replicates", 2, "--reads-per-organism", 2, "--diversity-attempts", 2) == 0
    assert run("seeker", "--input", folder / "virus", "--out-dir", tmp_path / "s") == 0


def test_searches_are_predicates(spark):
    rows = [("a", "bacteria", "cellular; Bacteria; x", "X complete genome", True, 20_000, ["complete"]), ("b", "bacteria", "Bacteria", "draft", True, 20_000, []), ("c", "bacteria", "Bacteria", "complete genome", False, 20_000, None),
            ("d", "bacteria", "Bacteria", "Complete Genome", True, 9_999, []), ("e", "bacteria", "Bacteria", "complete genome", True, 20_000, ["Complete", "WGS"]), ("f", "plasmid", None, "plasmid p", True, 5_000, None)]
    table = spark.createDataFrame([(*r, 0, n) for n, r in enumerate(rows)], "accession string, category string, organism string, title string, refseq boolean, length long, properties array<string>, category_order int, pos int")
    found = lambda *a, **k: {r["accession"] for r in remote.search(table, *a, **k).collect()}
    assert found("bacteria") == {"a", "e"} and found("bacteria", 1) == {"a"} and found("bacteria", complete_only=True) == {"a"} and found("plasmid") == {"f"}
    assert remote.searches(True)["virus"].term() == "viruses[Organism] AND complete genome[Title] AND refseq[filter] AND (5000:500000[Sequence Length]) AND complete[Properties] AND NOT WGS[Properties]"


def test_remote_pages(spark, tmp_path):
    flaky = tmp_path / "tried"

    def page(term, first, n):
        if first == 20 and not flaky.exists():
            flaky.write_text("once")
            raise OSError("busy")
        return 47, [f"{term}{i}" for i in range(first, min(47, first + n))]

    told = []
    got = remote.search_all(spark, page, "t", page=10, pause=0.0, between=0.0, progress=lambda *a: told.append(a)).collect()
    assert sorted((r["pos"], r["accession"]) for r in got) == [(i, f"t{i}") for i in range(47)] and told == [("pages", 0, 5)]
    assert remote.search_top(page, "t", 3) == ["t0", "t1", "t2"]


def test_remote_summaries_and_records(spark):
    keys = spark.createDataFrame([("A.1",), ("B",), ("7",), ("none",)], "accession string")
    all_ = [{"AccessionVersion": "A.1", "Caption": "A", "CreateDate": " 2020/01/02 ", "Title": " t "}, {"Caption": "B", "Title": None}, {"Id": 7, "CreateDate": "2021/01/01", "Title": "x"}]
    got = {r["accession"]: (r["create_date"], r["title"], r["failed"]) for r in remote.fetch_metadata(keys, lambda ks: all_, pause=0.0).collect()}
    assert got == {"A.1": ("2020/01/02", "t", False), "B": (None, "", False), "7": ("2021/01/01", "x", False), "none": (None, None, False)}
    assert {r["accession"]: r["create_date"] for r in remote.fetch_dates(keys, lambda ks: all_).collect()}["7"] == "2021/01/01"

    def records(ks):  # leaves out what it doesn't know
        return [(f"{k}.1", "d", "ACGT" * len(k)) for k in ks if k != "none"]

    got = {r["accession"]: (r["seq"], r["failed"]) for r in remote.fetch_sequences(keys, records, tries=1, pause=0.0).collect()}
    assert got == {"A.1": ("ACGT" * 3, False), "B": ("ACGT", False), "7": ("ACGT", False), "none": (None, True)}


def test_genome_files_and_the_python_verbs(spark, folder, catalog, tmp_path):
    import readloom
    from readloom.operators import lookup

    genomes = readloom.validate_genome_dir(spark, str(folder))
    wanted = genomes.filter("genome_id in ('virus1', 'bacteria2')").select("genome_id")
    assert sinks.copy_cached(wanted, genomes, str(tmp_path / "copy")).count() == 2
    back = {(r["genome_id"], r["category"], r["seq"]) for r in readers.read_genomes(spark, str(tmp_path / "copy")).collect()}
    assert back == {(r["genome_id"], r["category"], r["seq"]) for r in genomes.join(wanted, "genome_id").collect()}
    with pytest.raises(ValueError, match="1 genomes are not in the cache"):
        sinks.copy_cached(spark.createDataFrame([("nowhere",), ("virus1",)], "genome_id string"), genomes, str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()
    rows = readloom.load_accessions(spark, str(catalog))
    done = readloom.download_genomes(rows.filter("category = 'virus'"), lambda ks: [(k, "", "ACGT") for k in ks], str(tmp_path / "got"), cached=genomes.filter("genome_id = 'virus0'").select("genome_id"))
    assert sorted(tuple(r) for r in done.collect()) == [("virus1", False), ("virus2", False)]
    assert sorted(p.name for p in (tmp_path / "got" / "virus").glob("*.fasta")) == ["virus1.fasta", "virus2.fasta"]
    assert readloom.get_file_stats(genomes).first()["total_bases"] == 1200 and readloom.build_metagenome(genomes).count() == 12 * 4
    records = readers.read_genomes(spark, str(folder), first_record_only=False)
    names = sorted((r["name"] for r in lookup.concatenated(records).collect()), key=lambda n: int(n.split("_")[1]))
    ordered = sorted((r["genome_id"], r["record_idx"], r["record_id"]) for r in records.collect())
    assert names == [f"{g}_{n}_{i}" for n, (g, _, i) in enumerate(ordered)]
    assert {tuple(r) for r in lookup.concatenated_with_lengths(genomes)[1].collect()} == {(f"{c}{j}", 1200) for c in ("bacteria", "virus", "archaea", "plasmid") for j in range(3)}
    with pytest.raises(ValueError):
        lookup.concatenated_with_lengths(records)


def test_progress_is_told(spark):
    from readloom.progress import observed

    told = []
    df, tell = observed(spark.range(12), "step", lambda *a: told.append(a))
    df.collect()
    tell()
    assert told == [("step", 12)]


def test_acquisition_and_masking_commands(spark, folder, catalog, tmp_path, capsys):
    out = str(tmp_path / "p")
    assert main(["pipeline", "--genome-dir", str(folder), "--output", out, "--accessions-file", str(catalog), "--num-bacteria", "1", "--num-virus", "1", "--num-archaea", "0", "--reads-per-organism", "2"], spark) == 0
    assert spark.read.text(out).filter("value like '>%'").count() == 4
    lacking = tmp_path / "c.json"
    lacking.write_text(json.dumps({"timestamp": "2025-01-01", "bacterial": ["nowhere"], "viral": [], "archaea": [], "plasmid": []}))
    assert main(["pipeline", "--genome-dir", str(folder), "--output", out, "--accessions-file", str(lacking)], spark) == 1
    assert main(["benchmark-recipe", "--genome-dir", str(folder), "--output-dir", str(tmp_path / "b"), "--accessions-file", str(lacking)], spark) == 1
    assert "nowhere" not in capsys.readouterr().out
    assert main(["benchmark-recipe", "--genome-dir", str(folder), "--output-dir", str(tmp_path / "b"), "--per-category", "1", "--replicates", "1", "--reads-per-organism", "2", "--genomes-to", str(tmp_path / "g")], spark) == 0
    assert len(list((tmp_path / "g" / "replicate_0").glob("*/*.fasta"))) == 4
    assert main(["temporal-pipeline", "--accessions-file", str(catalog), "--split-date", "2024-06-01", "--genome-dir", str(folder), "--output-dir", str(tmp_path / "t"), "--sequence-length", "100", "--run-blastn-filter"], spark) == 0
