"""Gapped alignments, their statistics, growing indexes and the choice by prefixes."""

import math
import random

import numpy as np
import pytest

from readloom.operators import gapped, kmers, similarity
from tests.test_operators import dna

SCORING = gapped.Scoring()


def plain(q, s, high, width):
    """The same recurrence, cell by cell, over tuples (score, matches, -columns)."""
    zero, never = (0, 0, 0), (-(10**9), 0, 0)
    add = lambda a, *b: tuple(x + y for x, y in zip(a, b))
    best, where = zero, (0, 0)
    H, D = {}, {}
    for i in range(len(q)):
        E = never
        for j in range(width):
            c = i - high + j
            down = max(add(H.get((i - 1, c), never if j == width - 1 else zero), -SCORING.open - SCORING.extend, 0, -1), add(D.get((i - 1, c), never), -SCORING.extend, 0, -1)) if j < width - 1 else never
            cell = zero
            if 0 <= c < len(s):
                before = H.get((i - 1, c - 1), zero)
                cell = max(cell, add(before, SCORING.reward, 1, -1) if q[i] == s[c] else add(before, -SCORING.penalty, 0, -1))
            cell = max(cell, down)
            whole = max(cell, E)
            E = max(add(E, -SCORING.extend, 0, -1), add(cell, -SCORING.open - SCORING.extend, 0, -1))
            H[i, c], D[i, c] = whole, down
            if whole > best:
                best, where = whole, (i + 1, c + 1)
    return best, where


def test_bands_are_those_of_the_plain_recurrence():
    rng = random.Random(1)
    for _ in range(60):
        base = [rng.randint(0, 2) for _ in range(rng.randint(1, 30))]
        other = [x for x in base if rng.random() < 0.9 for x in ([x] if rng.random() < 0.9 else [x, rng.randint(0, 2)])]
        other = [rng.randint(0, 2) for _ in range(rng.randint(0, 5))] + other
        high, width = rng.randint(-3, 6), rng.randint(1, 12)
        path, q_end, s_end = gapped.banded([np.array(base), np.array(base * 2)], [np.array(other, np.int64), np.array(other, np.int64)], np.array([-high, -high]), width, SCORING)
        (score, matches, minus), (i, j) = plain(base, other, high, width)
        got = [int(x[0]) for x in gapped.unpacked(path)]
        assert got == [score, matches, -minus] and (not score or (q_end[0], s_end[0]) == (i, j))


def test_gaps(spark):
    """99 % identity and one gap in the middle: similar with gaps, not without."""
    base = dna(300, 31)
    flip = {"A": "C", "C": "G", "G": "T", "T": "A"}
    read = base[:125] + base[131:256]
    read = "".join(flip[c] if i in (20, 200) else c for i, c in enumerate(read))
    more = base[:125] + "ACGTA" + base[125:245]
    far = base[:125] + base[170:295]
    q = spark.createDataFrame([("gap", read), ("more", more), ("far", far), ("none", dna(250, 77)), ("null", None)], "id string, seq string")
    s = spark.createDataFrame([("ref", base), ("null", None)], "id string, seq string")
    assert similarity.similar_to(q, s).count() == 0
    for table in (s, s.unionByName(s.limit(0))):
        assert {r["id"] for r in similarity.similar_to(q, table, gap=8).collect()} == {"gap", "more"}
    own = similarity.similar_texts(spark.createDataFrame([("a", base[:256]), ("b", read), ("c", base[:100])], "id string, seq string"), gap=8)
    assert {(r["q"], r["s"]) for r in own.pairs.collect()} == {("a", "b"), ("b", "a"), ("c", "a"), ("c", "b")}
    got = {r["q"]: r for r in gapped.gapped_alignments(q, s).collect()}
    assert set(got) == {"gap", "more", "far"}
    assert (got["gap"]["matches"], got["gap"]["length"], got["gap"]["score"], got["gap"]["qend"], got["gap"]["send"]) == (248, 256, 248 * 2 - 2 * 3 - 5 - 6 * 2, 250, 256)
    assert got["far"]["length"] <= 130


def test_strands_subjects_and_evalues(spark):
    base = dna(400, 32)
    turned = base[50:350][::-1].translate(str.maketrans("ACGT", "TGCA"))
    q = spark.createDataFrame([(1, base[:200]), (2, turned[:200])], "id long, seq string")
    s = spark.createDataFrame([(10, base), (11, base[:120]), (12, dna(400, 33)), (13, base[100:160]), (14, None)], "id long, seq string")
    got = {(r["q"], r["s"]): r for r in gapped.gapped_alignments(q, s, both_strands=True).collect()}
    assert set(got) == {(1, 10), (1, 11), (1, 13), (2, 10)} and got[2, 10]["strand"] == "-" and got[2, 10]["length"] == 200
    # Most seeds first.
    assert {r["s"] for r in gapped.gapped_alignments(q, s, max_subjects=2).filter("q = 1").collect()} == {10, 11}
    measured = gapped.statistics(q, s, SCORING)
    assert (measured.letters, measured.subjects) == (400 + 120 + 400 + 60, 4)
    equal = 0.25
    rate, entropy = gapped.rate_and_entropy(equal, SCORING)
    assert abs(equal * math.exp(2 * rate) + (1 - equal) * math.exp(-3 * rate) - 1) < 1e-12 and 0.5 < rate < 0.7 and entropy > 0
    r = got[1, 13]
    assert abs(r["bits"] - (r["score"] * measured.rate - math.log(0.41)) / math.log(2)) < 1e-9
    less = max(0, math.floor(math.log(0.41 * 200 * measured.letters) / measured.entropy))
    assert abs(r["log10_evalue"] - math.log10(0.41 * max(1, 200 - less) * max(1, measured.letters - less * 4) * 2.0 ** -((r["score"] * measured.rate) / math.log(2)))) < 1e-9
    assert {(r["q"], r["s"]) for r in gapped.gapped_alignments(q, s, both_strands=True, max_evalue=10 ** got[1, 11]["log10_evalue"]).collect()} == {(1, 10), (1, 11), (2, 10)}
    assert gapped.gapped_alignments(q.limit(0), s).count() == 0 and gapped.gapped_alignments(q, s.limit(0)).count() == 0
    with pytest.raises(ValueError):
        gapped.rate_and_entropy(0.9, SCORING)


def test_a_key_index_grows(spark, tmp_path, monkeypatch):
    texts = [dna(300, i) for i in range(6)]
    table = lambda rows: spark.createDataFrame(rows, "id string, seq string")
    q = table([(f"q{i}", t[:280]) for i, t in enumerate(texts)] + [("same", texts[0]), ("low", "ACGT" * 70)])
    index = similarity.KeyIndex(spark, f"file://{tmp_path}/index")
    assert similarity.similar_to(q, index).count() == 0
    index.add(table([("a", texts[0]), ("b", texts[1]), ("c", texts[1]), ("low2", "ACGT" * 70), ("null", None)]))
    assert {r["id"] for r in similarity.similar_to(q, index).collect()} == {"q0", "q1", "same"}
    index.add(table([("d", texts[2]), ("e", texts[0])]))
    # Opened again; a part that isn't whole doesn't count.
    table([("f", texts[3])]).write.parquet(f"file://{tmp_path}/index/part-000002/members")
    again = similarity.KeyIndex(spark, f"file://{tmp_path}/index")
    assert again.parts == index.parts and again.sequences.count() == 4 and again.members.count() == 6

    def no_keys(*a, **k):
        if "a" in {r["id"] for r in a[0].select("id").collect()}:
            raise AssertionError("keys of kept sequences are made again")
        return made(*a, **k)

    made = similarity.seed_keys
    monkeypatch.setattr(similarity, "seed_keys", no_keys)
    assert {r["id"] for r in similarity.similar_to(q, again).collect()} == {"q0", "q1", "q2", "same"}
    again.add(table([("f", texts[3])]))
    assert {r["id"] for r in similarity.similar_to(q, again).collect()} == {"q0", "q1", "q2", "q3", "same"}
    with pytest.raises(ValueError):
        similarity.KeyIndex(spark, f"file://{tmp_path}/index", 20)


@pytest.mark.parametrize("batch", [None, 7])
def test_the_choice_by_prefixes_is_the_sequential_one(spark, batch):
    """Near copies of a few texts, exact copies, and others: whatever the prefixes, the same choice; links stay linear."""
    rng = random.Random(12)
    bases = [dna(260, i) for i in range(6)]
    rows = []
    for i in range(240):
        b = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 3, 12, 20, 24])):
            b[rng.randrange(260)] = rng.choice("ACGT")
        rows.append((i, "".join(b)))
    reads = spark.createDataFrame(rows, "id long, seq string")
    ranked = spark.createDataFrame([(i, (i * 89) % 241) for i, _ in rows], "id long, rank long")
    whole = similarity.greedy_choice(reads, ranked, batch=batch, first=10_000)
    expected = sorted(r["id"] for r in whole.collect())
    links = []
    made = similarity.similar_texts

    def counted(*a, **k):
        found = made(*a, **k)
        links.append(found.pairs.count())
        return found

    similarity.similar_texts = counted
    try:
        got = similarity.greedy_choice(reads, ranked, batch=batch, first=12, growth=3)
        assert sorted(r["id"] for r in got.collect()) == expected and got.columns == ["id", "rank"]
    finally:
        similarity.similar_texts = made
    assert sum(links) < 12 * len(rows) / (1 if batch is None else 0.5)


def test_keys_are_told_by_a_bitmap(spark):
    posted = similarity.seed_keys(spark.createDataFrame([(i, dna(300, i)) for i in range(20)], "id long, seq string"), 28)
    bits, keys = similarity.key_bitmap(posted), np.array([r["key"] for r in posted.collect()], np.int64)
    head = (keys.view(np.uint64) >> np.uint64(64 - similarity.KEY_BITS)).astype(np.int64)
    assert (bits[head >> 3] >> (head & 7).astype(np.uint8) & 1).all() and np.unpackbits(bits).sum() == len(set(head.tolist()))
    assert kmers.PERIODS


def test_alignments_tell_where_they_begin(spark):
    base = dna(300, 41)
    q = spark.createDataFrame([("mid", dna(30, 42) + base[50:130] + base[134:200] + dna(25, 43)), ("turned", (dna(30, 42) + base[50:200])[::-1].translate(str.maketrans("ACGT", "TGCA")))], "id string, seq string")
    s = spark.createDataFrame([("ref", base)], "id string, seq string")
    got = {r["q"]: r for r in gapped.gapped_alignments(q, s, both_strands=True).collect()}
    mid, turned = got["mid"], got["turned"]
    # Letters next to the true ends may match by chance.
    assert abs(mid["qstart"] - 30) <= 6 and abs(mid["sstart"] - 50) <= 6 and abs(mid["qend"] - 176) <= 6 and abs(mid["send"] - 200) <= 6
    assert turned["strand"] == "-" and abs(turned["qstart"] - 30) <= 6 and turned["qend"] == 180 and turned["send"] == 200
    for r, x in ((mid, q.first()["seq"]),):
        assert r["matches"] >= 0.9 * r["length"] and x[r["qstart"]] == base[r["sstart"]] and x[r["qend"] - 1] == base[r["send"] - 1]


def plain_dust(text, window=64, score=2.0):
    """Every interval, and every interval in it."""
    from collections import Counter

    scores = {}
    for a in range(len(text)):
        for b in range(a + 4, min(len(text), a + window) + 1):
            triplets = Counter(text[i : i + 3] for i in range(a, b - 2))
            scores[a, b] = sum(c * (c - 1) // 2 for c in triplets.values()) / (b - a - 3)
    low = set()
    for (a, b), s in scores.items():
        if s > score and all(scores[x, y] <= s for x in range(a, b) for y in range(x + 4, b + 1)):
            low.update(range(a, b))
    return low


def test_low_complexity_is_that_of_every_interval():
    rng = random.Random(7)
    texts = ["ACACACACACACAC" + dna(15, 1), "A" * 12 + dna(10, 2) + "A" * 9, dna(30, 3), "", "ab", None, "the the the the the end", "xyz" * 7 + "q"]
    texts += ["".join(rng.choice("aab") for _ in range(rng.randint(0, 28))) for _ in range(12)]
    for window in (64, 12):
        code, first = kmers.codes(texts)
        got = kmers.dust(code, first, window)
        for t, a, b in zip(texts, first[:-1], first[1:]):
            assert set(np.flatnonzero(got[a:b]).tolist()) == plain_dust(t or "", window), t


def test_seeds_keep_out_of_low_complexity(spark):
    poor = "ACGATTCGGA" * 12
    rows = [(1, dna(100, 1) + poor + dna(100, 2)), (2, poor), (3, None), (4, "A" * 40)]
    table = spark.createDataFrame(rows, "id long, seq string")
    found = {(r["id"], r["start"], r["end"]) for r in similarity.low_complexity(table).collect()}
    assert {i for i, *_ in found} == {1, 2, 4} and (2, 0, 120) in found
    low = min((a, b) for i, a, b in found if i == 1)
    assert 90 <= low[0] <= 100 and 220 <= low[1] <= 230
    for sparse in (True, False):
        k = 21 if sparse else 28
        at = {r["pos"] for r in similarity.seed_keys(table, 28, sparse=sparse, dust=True).filter("id = 1").collect()}
        assert at and not [p for p in at if p < low[1] and p + k > low[0]]
        assert not similarity.seed_keys(table, 28, sparse=sparse, dust=True).filter("id in (2, 4)").count()
    q = spark.createDataFrame([(9, dna(60, 5) + poor)], "id long, seq string")
    assert gapped.gapped_alignments(q, table).count() == 2 and gapped.gapped_alignments(q, table, dust=True).count() == 0


def test_subjects_rows_are_only_of_the_queries_kmers(spark, monkeypatch):
    """Rows are made of k-mers that a query may have, not of every letter of the subjects, on one strand and on both."""
    rng = random.Random(12)
    text = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    docs = {i: text(3000) for i in range(20)}
    items = {100: docs[3][500:700], 101: docs[5][100:300][::-1].translate(str.maketrans("ACGT", "TGCA"))}
    rows, save = {}, gapped.Scratch.save

    def counted(self, df, name):
        out = save(self, df, name)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(gapped.Scratch, "save", counted)
    table = lambda d: spark.createDataFrame(list(d.items()), "id long, seq string")
    for both, expected in ((False, {(100, 3)}), (True, {(100, 3), (101, 5)})):
        found = gapped.gapped_alignments(table(items), table(docs), both_strands=both).collect()
        assert {(r["q"], r["s"]) for r in found} == expected and all(r["matches"] == 200 for r in found)
        assert 173 * len(expected) <= rows["posted"] < 173 * len(expected) + 20


def test_one_batch_is_not_compared_with_itself(spark, monkeypatch):
    """Two batches, each a prefix: the later one is compared with the earlier one, and neither with itself."""
    near = lambda i: dna(250, i % 20)[: 240 + i % 7] + dna(10 - i % 7, 900 + i)
    reads = spark.createDataFrame([(i, near(i)) for i in range(60)] + [(60, None)], "id long, seq string")
    ranked = spark.createDataFrame([(i, int(i % 20 >= 10)) for i in range(61)], "id long, rank long")
    sides, made = [], similarity.similar_texts

    def counted(queries, subjects=None, **more):
        sides.append(subjects is None)
        return made(queries, subjects, **more)

    expected = {r["id"] for r in similarity.greedy_choice(reads, ranked, batch=1).collect()}
    monkeypatch.setattr(similarity, "similar_texts", counted)
    got = {r["id"] for r in similarity.greedy_choice(reads, ranked, batch=1, first=8).collect()}
    assert got == expected == set(range(61)) and sides == [False]
    ranked = spark.createDataFrame([(i, int(i >= 25)) for i in range(61)], "id long, rank long")
    got = {r["id"] for r in similarity.greedy_choice(reads, ranked, batch=1, first=8).collect()}
    assert got == set(range(25)) | {60} and sides == [False, False]
