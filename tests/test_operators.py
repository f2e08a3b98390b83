"""Hand values and properties of the engine's own operators."""

import hashlib
import random
import time
import warnings

import pytest
from pyspark.sql import functions as F

from readloom import catalog
from readloom.functions import sequences as sq
from readloom.operators import budgets, chunking, intervals, lookup, perturb, sampling, scoring, similarity, temporal
from readloom.plans import datasets


def genomes(spark, *seqs, **more):
    return spark.createDataFrame([(f"g{i}", "virus" if i % 2 == 0 else "bacteria", s) for i, s in enumerate(seqs)], "genome_id string, category string, seq string")


def dna(n, seed=0):
    rng = random.Random(seed)
    return "".join(rng.choice("ACGT") for _ in range(n))


def test_fixed_reads_tile_the_prefix(spark):
    text = dna(1001)
    rows = chunking.fixed_reads(genomes(spark, text, "A" * 249, "", None, "C" * 250)).collect()
    first = sorted((r for r in rows if r["genome_id"] == "g0"), key=lambda r: r["chunk_idx"])
    assert [(r["chunk_idx"], r["start"], r["end"]) for r in first] == [(0, 0, 250), (1, 250, 500), (2, 500, 750), (3, 750, 1000)]
    assert "".join(r["seq"] for r in first) == text[:1000]
    assert {r["genome_id"] for r in rows} == {"g0", "g4"}


def test_long_sequences_are_cut_in_blocks(spark):
    text = dna(10 * 700 + 3)
    rows = chunking.fixed_reads(genomes(spark, text), 10).sort("chunk_idx").collect()
    assert len(rows) == 700 and "".join(r["seq"] for r in rows) == text[:7000]
    assert chunking.fixed_reads(genomes(spark, text).withColumn("read_limit", F.lit(0).cast("long")), 10).count() == 0


def test_budget_comes_before_filters(spark):
    g = genomes(spark, "N" * 250 + "ACGT" * 250).withColumn("read_limit", F.lit(2).cast("long"))
    kept = chunking.fixed_reads(g).filter(sq.is_unambiguous("seq")).collect()
    assert [r["chunk_idx"] for r in kept] == [1]


def test_contigs(spark):
    text = dna(5000)
    rows = chunking.variable_contigs(genomes(spark, text, dna(99)), 100, 400).sort("chunk_idx").collect()
    assert all(r["genome_id"] == "g0" for r in rows) and rows[0]["start"] == 0
    for a, b in zip(rows, rows[1:]):
        assert a["end"] == b["start"] and 100 <= a["end"] - a["start"] <= 400
    assert 5000 - rows[-1]["end"] < 100 and all(r["seq"] == text[r["start"] : r["end"]] for r in rows)
    with pytest.raises(ValueError):
        chunking.variable_contigs(genomes(spark, text), 5, 4)


def merged(spark, *pairs):
    rows = intervals.merge_intervals(spark.createDataFrame([("g", a, b) for a, b in pairs], "k string, start long, end long"), ["k"])
    return sorted((r["start"], r["end"]) for r in rows.collect())


def test_merge_intervals(spark):
    assert merged(spark, (0, 10), (5, 8), (10, 12), (20, 30)) == [(0, 12), (20, 30)]
    assert merged(spark, (0, 10), (5, 8), (10, 12), (20, 30), (1, 25)) == [(0, 30)]
    rng = random.Random(1)
    pairs = [(a, a + rng.randint(1, 9)) for a in (rng.randint(0, 300) for _ in range(60))]
    got = merged(spark, *pairs)
    assert {x for a, b in got for x in range(a, b)} == {x for a, b in pairs for x in range(a, b)}
    assert all(b < c for (_, b), (c, _) in zip(got, got[1:]))


def test_masks_are_half_open(spark):
    reads = spark.createDataFrame([("r0", "g", 0, 10), ("r1", "g", 10, 20), ("r2", "g", 9_995, 30_005), ("r3", "h", 10, 20)], "read_id string, genome_id string, start long, end long")
    iv = spark.createDataFrame([("g", 10, 20), ("g", 15_000, 15_001)], "genome_id string, start long, end long")
    assert {r["read_id"] for r in intervals.mask_reads(reads, iv, ["genome_id"]).collect()} == {"r0", "r3"}
    hits = spark.createDataFrame([("q", 1, 100), ("q", 200, 150)], "qseqid string, qstart int, qend int")
    assert sorted((r["start"], r["end"]) for r in intervals.hits_to_intervals(hits).collect()) == [(0, 100), (149, 200)]


def test_budgets(spark):
    g = spark.createDataFrame([("a", "virus"), ("b", "bacteria"), ("c", "archaea"), ("d", "other")], "genome_id string, category string")
    got = {r["genome_id"]: r["read_limit"] for r in budgets.weighted(g, 1000, {"virus": 2.0, "bacteria": 0.5, "archaea": 0.0}).collect()}
    assert got == {"a": 2000, "b": 500, "c": 1, "d": 1000}
    stats = spark.createDataFrame([("a", "virus", 10, None), ("b", "virus", 10, None), ("c", "virus", 8, None), ("d", "bacteria", 5, 7)], "genome_id string, category string, max_reads long, read_limit long")
    groups = spark.createDataFrame([("a", "G1"), ("b", "G1"), ("c", "G2")], "genome_id string, group string")
    got = {r["genome_id"]: r["read_limit"] for r in budgets.by_taxonomy(stats, groups).collect()}
    assert got == {"a": 4, "b": 4, "c": 8, "d": 7}
    dry = stats.unionByName(spark.createDataFrame([("e", "virus", 0, None)], stats.schema))
    got = {r["genome_id"]: r["read_limit"] for r in budgets.by_taxonomy(dry, groups).collect()}
    assert got == {"a": None, "b": None, "c": None, "d": 7, "e": None}
    limits = [r["read_limit"] for r in budgets.exponential(spark.range(500).select(F.col("id").alias("genome_id")), 100).collect()]
    assert abs(sum(limits) / 500 - 100) < 5 and min(limits) >= 1


@pytest.mark.parametrize("n, percent, train", [(3, 80, 2), (1, 80, 1), (5, 100, 5), (5, 0, 1), (1000, 33, 330), (7, 250, 7)])
def test_train_test(spark, n, percent, train):
    rows = sampling.train_test(spark.range(n).select(F.col("id").cast("string").alias("read_id")), percent).collect()
    assert len(rows) == n and sum(r["split"] == "train" for r in rows) == train


def test_samples_do_not_depend_on_partitions(spark):
    ids = spark.range(400).select(F.col("id").cast("string").alias("read_id"))
    pick = lambda df: {r["read_id"] for r in sampling.cap(df, 50).collect()}
    assert pick(ids.repartition(7)) == pick(ids.coalesce(1)) and len(pick(ids)) == 50
    pool = spark.createDataFrame([(f"id{i}", "x") for i in range(10)], "accession string, category string")
    seen = pool.filter("accession not in ('id8', 'id9')")
    two = {r["accession"] for r in sampling.prefer_unseen(pool, seen, 2).collect()}
    three = {r["accession"] for r in sampling.prefer_unseen(pool, seen, 3).collect()}
    assert two == {"id8", "id9"} and two < three and len(three) == 3


def test_dates(spark):
    dates = ["2024/12/31", "2025/01/01", "2025-01-01", None, "", "rubbish", "2020-02-31", "2025/1/2"]
    dated = spark.createDataFrame([(str(i), "virus", d) for i, d in enumerate(dates)], "accession string, category string, create_date string")
    got = {r["accession"]: r["is_train"] for r in temporal.with_split(dated, "2025-01-01").collect()}
    assert [got[str(i)] for i in range(8)] == [True, False, False, True, True, True, True, False]
    total = temporal.preview(dated, "2025-01-01").filter("category = 'total'").first()
    assert (total["n"], total["n_train"], total["n_test"], total["train_percent"]) == (8, 5, 3, 62.5)
    best = temporal.search_cutoff(dated, ["virus"], 1, 1).first()
    assert best["cutoff"] == "2025-01-02" and best["test_all"] == 1
    assert temporal.search_cutoff(dated, ["virus"], 1, 6).count() == 0
    for bad in ("2020-13-45", "2020-1-1", "2020/01/01", "x"):
        with pytest.raises(ValueError):
            sq.check_split_date(bad)
    sq.check_split_date("2020-02-31")


def test_phred(spark):
    got = perturb.with_qualities(spark.createDataFrame([("r", "A" * 250), ("s", "A"), ("t", "")], "read_id string, seq string"))
    got = {r["read_id"]: r["qual"] for r in got.collect()}
    assert got["r"][0] == 30 and got["r"][-1] == 19 and len(got["r"]) == 250 and got["s"] == [30] and got["t"] == []
    assert sorted(got["r"], reverse=True) == got["r"]


def test_perturbation(spark):
    reads = spark.createDataFrame([(f"r{i}", dna(200, i)[:-3] + "NnR") for i in range(60)], "read_id string, seq string")
    same = perturb.mutate(reads).collect()
    assert {r["seq"] for r in same} == {r["seq"] for r in reads.collect()}
    before = {r["read_id"]: r["seq"] for r in reads.collect()}
    subs = {r["read_id"]: r["seq"] for r in perturb.mutate(reads, 0.1).collect()}
    changed = sum(a != b for k in before for a, b in zip(before[k].upper(), subs[k]))
    assert all(len(subs[k]) == 200 and subs[k].endswith("NNR") for k in subs) and 0.07 < changed / (197 * 60) < 0.13
    indels = perturb.mutate(reads, 0, 0.3).withColumn("n", F.length("seq")).agg(F.avg("n"), F.max("n")).first()
    assert 190 < indels[0] < 210 and indels[1] > 200
    ends = {r["read_id"]: r["seq"] for r in perturb.illumina_errors(reads, 1, 0.0, 0.5).collect()}
    half = lambda lo, hi: sum(a != b for k in before for a, b in zip(before[k][lo:hi].upper(), ends[k][lo:hi]))
    assert half(100, 197) > 2 * half(0, 100)
    with pytest.raises(ValueError):
        perturb.perturb(reads, error_model="other")


def test_perturbation_is_the_work_of_all_cores(spark):
    """One file of reads is dealt to all cores, with the same draws as SQL has of each letter."""
    reads = spark.createDataFrame([(f"r{i}", dna(40, i) + "né") for i in range(20)] + [(None, "acgt"), ("e", ""), ("n", None)], "read_id string, seq string").coalesce(1)
    mutated = perturb.mutate(reads, 0.3, 0.3, 7)
    assert mutated.rdd.getNumPartitions() >= 4 and perturb.illumina_errors(reads).rdd.getNumPartitions() >= 4 and mutated.columns == reads.columns
    draw = lambda i, letter, stream: int(hashlib.md5(f"7:{i}:{letter}:{stream}".encode()).hexdigest()[:8], 16) / 2**32
    before, after = ({r["read_id"]: r["seq"] for r in df.collect()} for df in (reads, mutated))
    assert after["e"] == "" and after["n"] is None and len(after) == 23
    for name in (f"r{i}" for i in range(20)):
        out = ""
        for i, c in enumerate(before[name][:40]):
            if draw(name, i, "indel") < 0.3 and draw(name, i, "kind") >= 0.5:
                continue
            out += "ACGT"[int(draw(name, i, "ins") * 4)] if draw(name, i, "indel") < 0.3 else ""
            out += "ACGT".replace(c, "")[int(draw(name, i, "base") * 3)] if draw(name, i, "sub") < 0.3 else c
        assert after[name] == out + "Né"


def test_similarity(spark):
    base = dna(400, 9)
    flip = lambda s, at: "".join({"A": "C", "C": "G", "G": "T", "T": "A"}[c] if i in at else c for i, c in enumerate(s))
    q = spark.createDataFrame([("same", base[:250]), ("near", flip(base[:250], {125, 200})), ("part", base[100:350]), ("far", dna(250, 77)), ("back", base[:250][::-1].translate(str.maketrans("ACGT", "TGCA"))), ("low", "AT" * 125)], "id string, seq string")
    s = spark.createDataFrame([("ref", base[:260]), ("low2", "AT" * 130)], "id string, seq string")
    plain = {r["q"] for r in similarity.similar_pairs(q, s).collect()}
    assert plain == {"same", "near"}
    assert {r["q"] for r in similarity.similar_pairs(q, s, both_strands=True).collect()} == {"same", "near", "back"}
    assert {r["q"] for r in similarity.similar_pairs(q, s, coverage=0.5).collect()} == {"same", "near", "part"}
    assert {r["id"] for r in similarity.drop_similar(q, s.limit(0)).collect()} == {"same", "near", "part", "far", "back", "low"}


def test_similarity_is_that_of_the_whole_diagonal(spark):
    """Every unmasked seed counts, and a stretch may reach beyond the first and the last one: against brute force."""
    base, rng = dna(1000, 5), random.Random(6)
    flip = lambda s, at: "".join({"A": "C", "C": "G", "G": "T", "T": "A"}[c] if i in at else c for i, c in enumerate(s))
    q = {"ends": flip(base[:250], {27, 222}), "run": dna(25, 1) + base[300:500] + dna(25, 2), "tail": base[600:805] + flip(base[805:850], set(range(45)))}
    q |= {f"r{i}": flip(base[i * 9 : i * 9 + 250], {rng.randrange(250) for _ in range(rng.randint(10, 40))}) for i in range(60)}
    s = {"a": base[:250], "b": dna(24, 3) + base[300:500] + dna(26, 4), "c": base[600:850], **{f"s{i}": base[i * 50 : i * 50 + 250] for i in range(15)}}

    def similar(x, y):
        for off in range(-249, 250):
            same = [x[i] == y[i - off] for i in range(max(0, off), min(250, 250 + off))]
            pairs = [(i, j) for i in range(len(same)) for j in range(i + 200, len(same) + 1)] if sum(same) >= 180 else []
            if any(sum(same[i:j]) * 100 >= (j - i) * 90 for i, j in pairs) and "1" * 28 in "".join(str(int(e)) for e in same):
                return True
        return False

    expected = {(a, b) for a, x in q.items() for b, y in s.items() if similar(x, y)}
    assert {("ends", "a"), ("run", "b"), ("tail", "c")} <= expected and len({a for a, _ in expected}) < len(q)
    table = lambda d: spark.createDataFrame(list(d.items()), "id string, seq string")
    found = similarity.similar_texts(table(q), table(s))
    pairs = {(r["q"], r["s"]) for r in found.pairs.collect()}
    reps = [{r["id"]: r["rep"] for r in side.collect()} for side in (found.members, found.subjects)]
    assert reps[1]["s0"] == "a" and reps[1]["s12"] == "c"  # equal texts are one class
    assert {(a, b) for a in q for b in s if (reps[0][a], reps[1][b]) in pairs} == expected
    assert {r["id"] for r in similarity.similar_to(table(q), table(s)).collect()} == {a for a, _ in expected}


def test_copies_are_compared_once(spark):
    """Equal texts: rows in proportion to their number, and the same choice as when all are compared."""
    texts = {"a": dna(300, 1), "b": dna(300, 1)[:290] + dna(10, 2), "c": dna(300, 3), "low": "ACGT" * 75, "short": "ACG"}
    rows = [(f"{name}{i}", seq) for name, seq in texts.items() for i in range(30)] + [("null", None)]
    reads = spark.createDataFrame(rows, "id string, seq string")
    found = similarity.similar_texts(reads)
    assert {(r["q"], r["s"]) for r in found.pairs.collect()} == {("a0", "b0"), ("b0", "a0")}
    assert found.members.count() == 150 and {r["rep"] for r in found.members.filter("seeded").collect()} == {"a0", "b0", "c0"}
    order = spark.createDataFrame([(i, n) for n, (i, _) in enumerate(reversed(rows))], "id string, rank long")
    kept = {r["id"] for r in similarity.greedy_choice(reads, order).collect()}
    assert kept == {"b29", "c29", "null"} | {f"{x}{i}" for x in ("low", "short") for i in range(30)}
    batched = {r["id"] for r in similarity.greedy_choice(reads, order, batch=10).collect()}  # null takes rank 0 of the first batch
    assert {i for i in batched if i[0] in "abc"} == {f"b{i}" for i in range(29, 20 - 1, -1) if (151 - 1 - (30 + i)) // 10 == (151 - 1 - 59) // 10} | {f"c{i}" for i in range(30) if (150 - (60 + i)) // 10 == (150 - 89) // 10}


def test_a_common_passage_makes_few_rows(spark, monkeypatch, tmp_path):
    """Reads that share one passage and nothing else don't meet, in one table or in two; what is similar is found as without blocks."""
    rng, passage = random.Random(3), dna(70, 99)
    cut = lambda s, at: (s[:at] + passage + s[at:])[:250]
    flip = lambda s, at: "".join({"A": "C", "C": "G", "G": "T", "T": "A"}[c] if i in at else c for i, c in enumerate(s))
    texts = {f"r{i:03d}": cut(dna(250, 1000 + i), rng.randrange(150)) for i in range(200)}
    # Near copies that share no other run of 28 than the passage, some just similar and some not, and shifted ones.
    texts |= {f"s{i:03d}": flip(texts[f"r{i:03d}"], {x for x in range(rng.randrange(20), 250, 12 + i % 4) if passage[:20] not in texts[f"r{i:03d}"][max(0, x - 70) : x + 20]}) for i in range(60)}
    texts |= {f"t{i:03d}": dna(20 + i, i) + texts[f"r{i:03d}"][: 230 - i] for i in range(40)}
    table = lambda d: spark.createDataFrame(list(d.items()), "id string, seq string")
    rows, save = {}, similarity.Scratch.save

    def counted(self, df, name):
        out = save(self, df, name)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(similarity.Scratch, "save", counted)
    monkeypatch.setattr(similarity, "FEW", 0.0)
    sides = [(table(texts), None), (table({k: v for k, v in texts.items() if k < "s"}), table({k: v for k, v in texts.items() if k >= "s"}))]
    index = similarity.KeyIndex(spark, f"file://{tmp_path}/index")
    index.add(sides[1][1])
    for (queries, subjects), both in zip([*sides, (sides[1][0], index)], (False, True, False)):
        got = {}
        for common, block in ((10_000, 2048), (4, 32)):
            monkeypatch.setattr(similarity, "COMMON", common)
            monkeypatch.setattr(similarity, "BLOCK", block)
            got[common] = {(r["q"], r["s"]) for r in similarity.similar_pairs(queries, subjects, both_strands=both).collect()}
        assert got[4] == got[10_000] and 20 < len({x for p in got[4] for x in p if x[0] == "t"}) < 41 and any(x[0] == "s" for p in got[4] for x in p)
        # The passage alone would give about 20,000 rows, or 10,000 of two tables.
        assert rows["met"] < 600


def moved_by(spark, action):
    """Bytes that an action shuffles, and what it gives."""
    store = spark.sparkContext._jsc.sc().statusStore()
    total = lambda: sum(store.executorList(False).apply(i).totalShuffleWrite() for i in range(store.executorList(False).size()))
    before = total()
    got = action()
    for last in iter(total, None):  # the store hears of a task a little later
        time.sleep(0.3)
        if total() == last:
            return last - before, got


@pytest.fixture
def unsent(spark):
    """As with large tables: Spark broadcasts none by itself."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("two", [False, True])
def test_keys_are_moved_in_few_bytes(spark, unsent, monkeypatch, two):
    """Reads of which few are similar: few bytes are shuffled for their keys, and small buckets give what large ones do."""
    texts = {f"r{i:04d}": dna(250, i) for i in range(2400)}
    texts |= {f"s{i:04d}": texts[f"r{i:04d}"][5:] + "ACGTC" for i in range(0, 1200, 12)}
    table = lambda rows: spark.createDataFrame([x for x in texts.items() if x[0][0] in rows], "id string, seq string")
    monkeypatch.setattr(similarity, "FEW", 0.0)
    sides = [table("s"), table("r")] if two else [table("rs")]
    expected = {(f"s{i:04d}", f"r{i:04d}") for i in range(0, 1200, 12)}
    expected |= set() if two else {(b, a) for a, b in expected}
    found = lambda: {tuple(r) for r in similarity.similar_pairs(*sides).collect()}
    moved, pairs = moved_by(spark, found)
    assert pairs == expected and moved < 1_300_000
    monkeypatch.setattr(similarity, "PER_BUCKET", 64, raising=False)
    assert found() == expected


@pytest.mark.parametrize("gap", [0, 8])
def test_texts_of_subjects_stay_where_they_are(spark, unsent, monkeypatch, tmp_path, gap):
    """Few queries against many long texts: no text is written or shuffled but those of pairs."""
    texts = {f"d{i:03d}": dna(20_000, i) for i in range(200)}
    texts |= {f"e{i:03d}": texts[f"d{i:03d}"] for i in range(50)} | {"a000": texts["d007"], "e999": dna(400, 997), "null": None, "short": "ACG"}
    spark.createDataFrame(list(texts.items()), "id string, seq string").repartition(8).write.parquet(f"{tmp_path}/texts")
    subjects = spark.read.parquet(f"{tmp_path}/texts")
    back = str.maketrans("ACGT", "TGCA")
    queries = {"one": texts["d007"][500:900], "two": texts["d150"][:300][::-1].translate(back), "same": texts["e999"], "far": dna(300, 999), "half": texts["d009"][:150] + dna(150, 998)}
    written, save = {}, similarity.Scratch.save

    def kept(self, df, name):
        out = save(self, df, name)
        written[name] = out.agg(F.sum(F.length("seq"))).first()[0] if "seq" in out.columns else 0
        return out

    monkeypatch.setattr(similarity.Scratch, "save", kept)
    asked = spark.createDataFrame(list(queries.items()), "id string, seq string")

    def run():
        found = similarity.similar_texts(asked, subjects, both_strands=True, gap=gap)
        return {tuple(r) for r in found.pairs.collect()}, {r["id"]: (r["rep"], r["seeded"]) for r in found.subjects.collect()}

    moved, (pairs, reps) = moved_by(spark, run)
    assert pairs == {("one", "a000"), ("two", "d150"), ("same", "e999")}
    assert reps.keys() == texts.keys() - {"null"} and reps["short"] == ("short", False)
    assert all(reps[x] == (min(y for y in texts if texts[y] == texts[x]), True) for x in reps if x != "short")
    assert sum(written.values()) == sum(map(len, queries.values())) and moved < sum(len(x or "") for x in texts.values()) / 10
    again = {r["id"] for r in similarity.similar_to(asked, subjects, both_strands=True, gap=gap).collect()}
    assert again == {"one", "two", "same"}


@pytest.mark.parametrize("bits", [4, 26])
def test_representatives_are_not_shuffled(spark, unsent, monkeypatch, tmp_path, bits):
    """One row of each text, whatever the bitmap answers; with a large one texts stay where they are."""
    monkeypatch.setattr(similarity, "KEY_BITS", bits)
    texts = {i: dna(20_000, i % 150) for i in range(200)}
    spark.createDataFrame([*texts.items(), (None, dna(100, 1)), (500, None)], "id long, seq string").repartition(8).write.parquet(f"{tmp_path}/texts")
    side, scratch = spark.read.parquet(f"{tmp_path}/texts"), similarity.Scratch(spark, "test")
    members = similarity._classes(side, "side", scratch)
    moved, got = moved_by(spark, lambda: {r["id"]: r["seq"] for r in similarity._representatives(side, members).collect()})
    assert got == {i: texts[i] for i in range(150)}
    assert bits == 4 or moved < 100_000
    assert {r["id"] for r in similarity._copies(members).collect()} == set(range(150, 200))
    scratch.close()


def test_saved_indexes_and_statistics(spark):
    docs = spark.createDataFrame([(f"d{i}", dna(400, i)) for i in range(8)], "id string, seq string")
    items = spark.createDataFrame([(f"i{i}", "NNNNN" + dna(400, i)[100:200]) for i in range(0, 8, 2)], "id string, seq string")
    plain = sorted(tuple(r) for r in similarity.alignments(docs, items, k=16, min_bases=50).collect())
    assert [(r[0], r[1], r[3], r[6], r[7]) for r in plain] == [(f"d{i}", f"i{i}", 100, 100, 100) for i in range(0, 8, 2)]
    spark.sql("DROP TABLE IF EXISTS seed_index")
    similarity.save_index(similarity.seed_keys(items, 16, sparse=False), "seed_index", buckets=3)
    by_index = similarity.alignments(docs, items, k=16, min_bases=50, index=spark.table("seed_index"))
    assert sorted(tuple(r) for r in by_index.collect()) == plain
    spark.sql("DROP TABLE seed_index")
    kept = similarity.drop_similar(items, docs, coverage=0.9)
    assert tuple(similarity.filter_statistics(items, kept).first()) == (4, 0, 4)


def test_minimizers_miss_no_kmer():
    import numpy as np

    from readloom.operators import kmers

    rng = random.Random(2)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 120))) for _ in range(60)] + ["ab" * 60, "x", "", None, "é" * 50 + dna(60)]
    code, first = kmers.codes(texts)
    at, keys = kmers.minimizers(code, first, 28, 8)
    held = {}
    for row, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        mine = {int(p) - a: int(k) for p, k in zip(at, keys) if a <= p < b}
        for i in range(b - a - 27):
            kmer = texts[row][i : i + 28]
            low = any(kmer[p:] == kmer[:-p] for p in kmers.PERIODS)
            inner = frozenset((p - i, k) for p, k in mine.items() if i <= p <= i + 7)
            assert low or inner
            # An equal k-mer elsewhere holds one of the same minimizers at the same place.
            if not low:
                for other in held.setdefault(kmer, []):
                    assert inner & other
                held[kmer].append(inner)
    assert any(len(v) > 1 for v in held.values()) or len(held) > 100
    plain, _ = kmers.all_windows(code, first, 28, True)
    assert len(plain) == sum(len(v) for v in held.values())
    assert np.array_equal(kmers.window_keys(code, 28)[plain], kmers.all_windows(code, first, 28, True)[1])


def test_hits_that_count(spark):
    hits = spark.createDataFrame([("q1", "s1", 95.0, 900), ("q2", "s1", 80.0, 900), ("q3", "s1", 95.0, 500), ("q1", "s1", 92.0, 800)], "qseqid string, sseqid string, pident double, length int")
    lengths = spark.createDataFrame([("q1", 1000), ("q2", 1000), ("q3", 1000)], "qseqid string, qlen int")
    assert [r["qseqid"] for r in similarity.similar_by_hits(hits, lengths).collect()] == ["q1"]


@pytest.mark.parametrize("batch", [None, 4])
def test_greedy_is_the_sequential_choice(spark, batch):
    rng = random.Random(8)
    pairs = [(i, j) for i in range(40) for j in range(40) if i != j and rng.random() < 0.06]
    similar = {}
    for q, s in pairs:
        similar.setdefault(q, set()).add(s)
    kept = []
    for i in range(40):
        earlier = kept if batch is None else [k for k in kept if k // batch < i // batch]
        if not similar.get(i, set()) & set(earlier):
            kept.append(i)
    ranked = spark.range(40).select("id", F.col("id").alias("rank"))
    got = similarity.greedy_dedup(ranked, spark.createDataFrame(pairs, "q long, s long"), batch=batch)
    assert sorted(r["id"] for r in got.collect()) == kept


def test_scoring(spark):
    reads = spark.createDataFrame([("a", "GC" * 150), ("b", "AT" * 150), ("c", "GC" * 50)], "read_id string, seq string")
    predictions = scoring.predict(reads)
    assert {r["name"] for r in predictions.collect()} == {"a", "b"}
    assert [r["read_id"] for r in scoring.select_by_score(reads, predictions).collect()] == ["a"]


def test_lookups(spark):
    cached, wanted = spark.createDataFrame([("B1",), ("V1",)], "accession string"), spark.createDataFrame([("B1",), ("B2",), ("V1",), ("V2",)], "accession string")
    assert {r["accession"] for r in lookup.missing(wanted, cached).collect()} == {"B2", "V2"}
    lineages = spark.createDataFrame([(1, "family", "F"), (1, "order", "O"), (2, "order", "O"), (2, "realm", "R"), (3, "genus", "G")], "taxid int, rank string, name string")
    assert {r["taxid"]: r["group"] for r in lookup.lineage_group(lineages, "family").collect()} == {1: "F", 2: "R"}
    with pytest.raises(ValueError):
        lookup.check_layout(genomes(spark, "A"))


def test_build_dataset(spark):
    g = genomes(spark, dna(3000, 1), dna(3000, 2), dna(3000, 1))
    recipe = datasets.Recipe(reads_per_genome=4, filter_similar=True, similarity_batch=None)
    reads = datasets.build_dataset(g, recipe).collect()
    assert len({r["seq"] for r in reads}) == len(reads) == 12 and len({r["read_id"] for r in reads}) == 12
    masks = spark.createDataFrame([("g0", 0, 600)], "genome_id string, start long, end long")
    plain = datasets.build_dataset(g, datasets.Recipe(reads_per_genome=4, fastq=True), masks=masks).collect()
    assert sorted(r["chunk_idx"] for r in plain if r["genome_id"] == "g0") == [3] and all(len(r["qual"]) == len(r["seq"]) for r in plain)
    split = datasets.split_and_filter(datasets.build_dataset(g, datasets.Recipe()), 50, datasets.Recipe())
    train = {r["seq"] for r in split.filter("split = 'train'").collect()}
    assert not train & {r["seq"] for r in split.filter("split = 'test'").collect()}
    with pytest.raises(ValueError):
        datasets.build_dataset(g, datasets.Recipe(sequence_length=0))


def test_replicates_and_temporal(spark):
    g = spark.createDataFrame([(f"a{i}", ["bacteria", "virus"][i % 2], dna(1500, i)) for i in range(12)], "genome_id string, category string, seq string")
    reads = datasets.benchmark_replicates(g, datasets.Recipe(reads_per_genome=3), per_category=2, replicates=3, attempts=2)
    used = {i: {r["genome_id"] for r in reads.filter(F.col("replicate") == i).select("genome_id").distinct().collect()} for i in range(3)}
    assert all(len(x) == 4 for x in used.values()) and not used[0] & used[1] and not used[1] & used[2] and not used[0] & used[2]
    dated = g.select(F.col("genome_id").alias("accession"), "category", F.when(F.col("genome_id") < "a5", "2024/01/01").otherwise("2025/06/01").alias("create_date"))
    both = datasets.temporal_datasets(g, dated, "2025-01-01", datasets.Recipe(reads_per_genome=2), train_caps={"bacteria": 2, "virus": 2}, test_caps={"bacteria": 1, "virus": 1})
    got = {(r["split"], r["genome_id"]) for r in both.select("split", "genome_id").distinct().collect()}
    assert all((x < "a5") == (s == "train") for s, x in got) and len(got) == 6


def test_whole_texts_are_read(spark):
    """Queries see every window of every document, but for the two that show a budget."""
    sf_dir = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in catalog.read(spark, sf_dir, "documents").select("doc_id", "text").collect()}
    every = {f"{i}_read_{k}": t[k * 250 : (k + 1) * 250] for i, t in texts.items() for k in range(len(t) // 250)}
    assert max(int(r.rsplit("_", 1)[1]) for r in every) >= catalog.BUDGET
    assert {r["read_id"]: r["seq"] for r in catalog.QUERIES["fixed_chunks"](spark, sf_dir).collect()} == every
    for name in ("train_test_split", "read_id_genomes"):
        assert {r["read_id"] for r in catalog.QUERIES[name](spark, sf_dir).collect()} == set(every)
    assert {r["read_id"] for r in catalog.QUERIES["fixed_chunks_budget"](spark, sf_dir).collect()} == {r for r in every if int(r.rsplit("_", 1)[1]) < catalog.BUDGET}
    contigs = catalog.QUERIES["variable_contigs"](spark, sf_dir).groupBy("genome_id").agg(F.max("end").alias("end")).collect()
    assert all(len(texts[r["genome_id"]]) - r["end"] < 100 for r in contigs)
    kept = {r["id"] for r in catalog.QUERIES["dedup_strict"](spark, sf_dir).collect()}
    assert any(int(i.rsplit("_", 1)[1]) >= catalog.BUDGET for i in kept) and {every[i] for i in kept} <= set(every.values())


def test_a_short_data_set_is_refilled(spark):
    """Copies remove more than the spare reads: the genomes' next positions fill up to the target, or a warning says so."""
    start = dna(2000, 11)
    g = genomes(spark, start + dna(3000, 12), start + dna(3000, 13), start + dna(3000, 14))
    recipe = datasets.Recipe(reads_per_genome=4, filter_similar=True, similarity_batch=None)
    with warnings.catch_warnings():
        warnings.filterwarnings("error", message="the data set is short")
        reads = datasets.build_dataset(g, recipe).collect()
    assert len({r["seq"] for r in reads}) == len({r["read_id"] for r in reads}) == len(reads) == 12
    assert max(r["chunk_idx"] for r in reads) >= 8
    with pytest.warns(UserWarning, match="8 of 12"):
        assert datasets.build_dataset(genomes(spark, start, start, start), recipe).count() == 8
