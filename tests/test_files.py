"""FASTA files split in blocks, replies as XML, files committed in two phases, and the commands' newer options."""

import json
import random
import sys

import pytest

from readloom.cli import main
from readloom.operators import lookup
from readloom.sources import readers, sinks

from tests.test_operators import dna


def test_fasta_files_are_split(spark, tmp_path):
    """Records of any length over blocks of a few hundred bytes, with other line ends, a preamble, empty records and odd headers."""
    rng, expected = random.Random(1), {}
    for f in range(4):
        text = ["", "\n", "; a comment\n>", ""][f]
        for k in range(30):
            seq = dna(rng.choice([0, 5, 70, 900]), k)
            end = "\r\n" if f == 3 else "\n"
            text += f"{'' if f == 2 and k == 0 else '>'}rec{k} d > x{k}{end}" + end.join(seq[i : i + 60] for i in range(0, len(seq), 60)) + end
            expected[f"f{f}", k] = (f"rec{k}", f"d > x{k}", seq)
        (tmp_path / f"f{f}.fasta").write_text(text, newline="")
    (tmp_path / "empty.fasta").write_text("")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        found = readers.read_fasta(spark, str(tmp_path))
        rows = found.collect()
        assert found.rdd.getNumPartitions() > 50
        assert {r["genome_id"] for r in readers.read_genomes(spark, str(tmp_path)).filter("record_id = 'rec0'").collect()} == {"f0", "f1", "f2", "f3"}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {(r["genome_id"], r["record_idx"]): (r["record_id"], r["description"], r["seq"]) for r in rows} == expected and len(rows) == len(expected)


TAXA = """<?xml version="1.0"?><TaxaSet><Taxon><TaxId>10</TaxId><ScientificName>v</ScientificName><LineageEx>
<Taxon><TaxId>1</TaxId><ScientificName>Ribo</ScientificName><Rank>realm</Rank></Taxon><Taxon><TaxId>2</TaxId><ScientificName>Fam</ScientificName><Rank>Family</Rank></Taxon></LineageEx></Taxon>
<Taxon><TaxId>11</TaxId></Taxon><Taxon><TaxId>12</TaxId><LineageEx><Taxon><ScientificName>Ord</ScientificName><Rank>order</Rank></Taxon><Taxon><ScientificName>no rank</ScientificName></Taxon></LineageEx></Taxon></TaxaSet>"""
LINK = "<LinkSetDb><DbTo>{}</DbTo>{}</LinkSetDb>"


def test_replies_of_lineages_and_links(spark, tmp_path):
    replies = spark.createDataFrame([(TAXA,), ("<TaxaSet></TaxaSet>",), ("no xml",), (None,)], "value string")
    groups = {r["taxid"]: r["group"] for r in lookup.lineage_group(readers.lineages_of(replies), "family").collect()}
    assert groups == {"10": "Fam", "12": "Ord"}  # a missing level falls back in the stated order
    assert {r["taxid"]: r["group"] for r in lookup.lineage_group(readers.lineages_of(replies), "realm").collect()} == {"10": "Ribo", "12": "Ord"}
    one = lambda *ids: "".join(f"<Link><Id>{i}</Id></Link>" for i in ids)
    each = "<e>" + "".join(f"<LinkSet>{x}</LinkSet>" for x in (LINK.format("taxonomy", one(10)), LINK.format("other", one(7)), LINK.format("other", one(7)) + LINK.format("taxonomy", one(12, 99)))) + "</e>"
    together = "<e><LinkSet>" + LINK.format("taxonomy", one(10, 11)) + "</LinkSet></e>"
    links = spark.createDataFrame([(["a", "b", "c"], each), (["d", "e"], together), (["f"], "bad"), (["g"], together)], "accessions array<string>, value string")
    taxids = readers.taxids_of(links)
    assert {tuple(r) for r in taxids.collect()} == {("a", "10"), ("c", "12"), ("d", "10"), ("e", "11"), ("g", "10")}
    wanted = spark.createDataFrame([(x,) for x in "abcdefg"], "accession string")
    named = lookup.accession_groups(wanted, taxids, lookup.lineage_group(readers.lineages_of(replies), "family"))
    assert {r["accession"]: r["group"] for r in named.collect()} == {"a": "Fam", "b": "unknown", "c": "Ord", "d": "Fam", "e": "unknown", "f": "unknown", "g": "Fam"}
    # The command takes replies in place of a table.
    (tmp_path / "c.json").write_text(json.dumps({"timestamp": "2025-01-01", "bacterial": [], "viral": ["a", "c", "x"], "archaea": [], "plasmid": []}))
    (tmp_path / "t.tsv").write_text("accession\ttaxid\na\t10\nc\t12\n")
    (tmp_path / "replies").mkdir()
    (tmp_path / "replies" / "one.xml").write_text(TAXA)
    assert main(["viral-taxonomy", "--accessions-file", str(tmp_path / "c.json"), "--taxids", str(tmp_path / "t.tsv"), "--lineages", str(tmp_path / "replies"), "--output", str(tmp_path / "tax")], spark) == 0
    assert {tuple(r) for r in readers.read_taxonomy(spark, str(tmp_path / "tax")).collect()} == {("a", "Fam"), ("c", "Ord"), ("x", "unknown")}


def test_genome_files_are_committed_or_not_at_all(spark, tmp_path):
    rows = [(f"g{i}", ["virus", "bacteria"][i % 2], dna(130, i)) for i in range(20)]
    genomes = spark.createDataFrame(rows, "genome_id string, category string, seq string").repartition(4)
    out = sinks.write_genome_files(genomes, str(tmp_path / "out"))
    assert {r["file"] for r in out.collect()} == {str(tmp_path / "out" / c / f"{g}.fasta") for g, c, _ in rows}
    again = {(r["genome_id"], r["seq"]) for r in readers.read_genomes(spark, str(tmp_path / "out")).collect()}
    assert again == {(g, s) for g, _, s in rows} and not [p for p in (tmp_path / "out").rglob("*") if p.name.startswith((".", "_"))]
    # Added to what is there; a run that fails leaves nothing of itself.
    sinks.write_genome_files(genomes.limit(1).replace({"g0": "h0", "g1": "h0"}), str(tmp_path / "out"))
    assert len(list((tmp_path / "out").rglob("*.fasta"))) == 21
    from pyspark.sql import functions as F

    failing = genomes.withColumn("seq", F.when(F.col("genome_id") == "g7", F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("seq"))).withColumn("genome_id", F.concat(F.lit("bad"), "genome_id"))
    with pytest.raises(Exception, match="lost"):
        sinks.write_genome_files(failing, str(tmp_path / "out"))
    assert len(list((tmp_path / "out").rglob("*.fasta"))) == 21 and not [p for p in (tmp_path / "out").rglob("*") if p.name.startswith((".", "_", "bad"))]


def test_commands_with_gaps_keys_and_programs(spark, tmp_path):
    for c in ("bacteria", "virus"):
        (tmp_path / "g" / c).mkdir(parents=True)
    virus, rest = dna(400, 1), dna(600, 2)
    host = rest[:300] + virus[50:170] + virus[175:330] + rest[300:]
    (tmp_path / "g" / "virus" / "v1.fasta").write_text(f">v1\n{virus}\n")
    (tmp_path / "g" / "bacteria" / "b1.fasta").write_text(f">b1\n{host}\n")
    (tmp_path / "c.json").write_text(json.dumps({"timestamp": "2025-03-04T00:00:00Z", "bacterial": ["b1"], "viral": [{"accession": "v1", "create_date": "2024/01/01", "title": "t"}], "archaea": [], "plasmid": []}))
    base = ["--accessions-file", str(tmp_path / "c.json")]
    assert main(["build-viral-db", *base, "--genome-dir", str(tmp_path / "g"), "--output-dir", str(tmp_path / "db")], spark) == 0
    table = tmp_path / "db" / "viral_db" / "date=2025-03-04"
    assert (tmp_path / "db" / "viral_keys" / "date=2025-03-04").exists()
    for name, more in {"plain": [], "gaps": ["--evalue", "1e-5"], "none": ["--evalue", "1e-300"], "few": ["--max-target-seqs", "1"]}.items():
        assert main(["blastn-filter", "--genome-dir", str(tmp_path / "g"), "--out-dir", str(tmp_path / name), "--viral-db", str(table), *more], spark) == 0
    got = {n: sorted((r["start"], r["end"]) for r in readers.read_intervals(spark, str(tmp_path / n / "eve_intervals")).collect()) for n in ("plain", "gaps", "few")}
    assert len(got["gaps"]) == 1 and got["gaps"] == got["few"] and abs(got["gaps"][0][0] - 300) <= 8 and abs(got["gaps"][0][1] - 575) <= 8
    assert got["plain"] and got["plain"][0][0] >= got["gaps"][0][0] - 8
    assert not list((tmp_path / "none" / "eve_intervals").glob("*.txt")) or readers.read_intervals(spark, str(tmp_path / "none" / "eve_intervals")).count() == 0
    script = tmp_path / "score.py"
    script.write_text("import sys\nfor r in sys.stdin.read().split('>')[1:]:\n    n, s = r.split()[:2]\n    print(n, 'phage', float(n == 'v1'), sep='\\t')\n")
    assert main(["seeker", "--input", str(tmp_path / "g" / "virus" / "v1.fasta"), "--out-dir", str(tmp_path / "seek"), "--command-line", f"{sys.executable} {script}"], spark) == 0
    assert spark.read.text(str(tmp_path / "seek" / "positives")).count() > 0
    assert main(["migrate-snapshot", str(tmp_path / "c.json")], spark) == 0
    assert json.loads((tmp_path / "c.json").read_text())["viral"][0]["accession"] == "v1" and not [p for p in tmp_path.glob(".*") if not p.name.endswith(".crc")]


def fetch_records(keys):
    if "broken" in keys:
        raise OSError("no such record")
    return [(f"{k}.1", f"of {k}", dna(600, sum(map(ord, k)))) for k in keys]


def test_what_the_folder_lacks_is_fetched(spark, tmp_path, capsys):
    catalog = {"timestamp": "2025-01-01", "bacterial": ["b1", "b2"], "viral": ["v1", "v2"], "archaea": [], "plasmid": []}
    (tmp_path / "c.json").write_text(json.dumps(catalog))
    base = ["--accessions-file", str(tmp_path / "c.json"), "--genome-dir", str(tmp_path / "g")]
    (tmp_path / "g" / "virus").mkdir(parents=True)
    (tmp_path / "g" / "virus" / "v1.fasta").write_text(">v1\nACGT\n")
    recipe = ["benchmark-recipe", *base, "--output-dir", str(tmp_path / "out"), "--per-category", "1", "--replicates", "1", "--diversity-attempts", "1", "--reads-per-organism", "2"]
    assert main(recipe, spark) == 1 and "3 accessions" in capsys.readouterr().err
    ours = ["--fetcher", "tests.test_files:fetch_records", "--fetch-pause", "0"]
    assert main([*recipe, "--fetcher", "nowhere:nothing"], spark) == 1
    assert main([*recipe, *ours], spark) == 0
    held = {(r["category"], r["genome_id"]): r["seq"] for r in readers.read_genomes(spark, str(tmp_path / "g")).collect()}
    assert set(held) == {("bacteria", "b1"), ("bacteria", "b2"), ("virus", "v1"), ("virus", "v2")}
    assert held["virus", "v1"] == "ACGT" and held["virus", "v2"] == dna(600, ord("v") + ord("2"))
    catalog["viral"].append("broken")
    (tmp_path / "c.json").write_text(json.dumps(catalog))
    assert main(["download", *base, *ours], spark) == 1 and "1 of 1" in capsys.readouterr().err
    fresh = ["--accessions-file", str(tmp_path / "d.json"), "--genome-dir", str(tmp_path / "new")]
    (tmp_path / "d.json").write_text(json.dumps(catalog | {"viral": ["v9"]}))
    assert main(["pipeline", *fresh, *ours, "--output", str(tmp_path / "reads"), "--reads-per-organism", "2", "--num-bacteria", "1"], spark) == 0
    assert len(list((tmp_path / "new").rglob("*.fasta"))) == 2
