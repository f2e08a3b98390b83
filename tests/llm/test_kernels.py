"""Kernels held against brute force, without Spark."""

import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from readloom.llm import bpe, decontaminate, licences, near_dedup, quality, templates, token_files, toxicity, vp_search
from readloom.llm.words import ALNUM_LOWER, SPACED, SPACED_LOWER, as_bytes, read_words, row_slices

TEXTS = ["", None, "a", "  lead  two\n \nx <|endoftext|> y", "Tab\tb c  d ", "x" * 3000, "É́ ̸a's isn't  \n word\n", "Ünï 世界 ab12 don't!!", "a  \n b", "end ", "\n", "the cat. sat\nOn the mat.\n\nYes"] + ["repeat me again " * 80] * 3


@pytest.mark.parametrize("rule, pattern, lower", [(SPACED, rb"[^\x20\x09-\x0D]+", False), (SPACED_LOWER, rb"[^\x20\x09-\x0D]+", True), (ALNUM_LOWER, rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", True)])
@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.one_of(st.none(), st.text(max_size=60)), max_size=6))
def test_words_are_those_of_the_pattern(rule, pattern, lower, texts):
    words = read_words(pa.array(texts, pa.string()), rule)
    raw, _ = as_bytes(pa.array(texts, pa.string()))
    seen = {}
    for i, t in enumerate(texts):
        data = (t or "").encode()
        data = re.sub(rb"[A-Z]", lambda m: m[0].lower(), data) if lower else data
        expected = re.findall(pattern, data)
        a, b = words.first[i], words.first[i + 1]
        got = [raw[x:y].tobytes() for x, y in zip(words.start[a:b], words.end[a:b])]
        assert [re.sub(rb"[A-Z]", lambda m: m[0].lower(), g) if lower else g for g in got] == expected
        for w, h in zip(expected, words.hash[a:b].tolist()):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def batch_of(texts):
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["doc_id", "text"])


def test_bpe_equals_the_library():
    codec = bpe.ChunkedCodec(bpe.tokenizer_path("word_bpe_49k.json"))
    got = [r for s in row_slices(batch_of(TEXTS), "text", 4000) for r in codec.run(*as_bytes(s.column("text")))]
    for text, (n, ids, decoded) in zip(TEXTS, got):
        expected = codec.tokenizer.encode(text or "", add_special_tokens=False).ids
        assert (n, ids) == (len(expected), " ".join(map(str, expected))), text
        assert decoded == codec.tokenizer.decode(expected, skip_special_tokens=False)
    assert codec.encoded < codec.met  # copies share chunks


@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.text(alphabet="ab c\n.'É1 \t", max_size=400), max_size=4))
def test_bpe_of_any_text(texts):
    codec = bpe.ChunkedCodec(bpe.tokenizer_path("word_bpe_49k.json")) if not hasattr(test_bpe_of_any_text, "codec") else test_bpe_of_any_text.codec
    test_bpe_of_any_text.codec = codec
    for text, (_, ids, _) in zip(texts, codec.run(*as_bytes(pa.array(texts, pa.string())))):
        assert ids == " ".join(map(str, codec.tokenizer.encode(text, add_special_tokens=False).ids))


def test_joins_that_do_not_agree_are_widened(monkeypatch):
    """Windows that are refused: the first ones, then all."""
    texts = ["some words, then MORE of them (1) " * 200, "x" * 2000 + " y " + "z" * 900, "short"]
    plain = bpe.between
    for refused in (1, 3, 1_000_000):
        codec = bpe.ChunkedCodec(bpe.tokenizer_path("word_bpe_49k.json"))
        calls = iter(range(1 << 30))
        monkeypatch.setattr(bpe, "between", lambda *a: None if next(calls) < refused else plain(*a))
        got = list(codec.run(*as_bytes(pa.array(texts))))
        assert codec.widened > 0
        for text, (n, ids, decoded) in zip(texts, got):
            expected = codec.tokenizer.encode(text, add_special_tokens=False).ids
            assert (n, ids) == (len(expected), " ".join(map(str, expected)))
            assert decoded == codec.tokenizer.decode(expected, skip_special_tokens=False)


def test_tokenizers_of_another_kind_are_refused():
    with pytest.raises(ValueError):
        bpe.ChunkedCodec(bpe.tokenizer_path("byte_bpe_50k.json"))


@settings(max_examples=80, deadline=None)
@given(texts=st.lists(st.text(alphabet="ab c\n.'É1 \t ", max_size=60), max_size=4))
def test_pieces_equal_the_library(texts):
    encoder = token_files.piece_encoder(bpe.tokenizer_path("byte_bpe_50k.json"))
    for text, got in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(got, encoder.dtype).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_pieces_of_odd_texts():
    encoder = token_files.piece_encoder(bpe.tokenizer_path("byte_bpe_50k.json"))
    texts = [t or "" for t in TEXTS]
    for text, got in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(got, encoder.dtype).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, text


def edits(pattern, text):
    prev = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        cur = [i]
        for j, x in enumerate(text, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (c != x)))
        prev = cur
    return min(prev)


@settings(max_examples=150, deadline=None)
@given(p=st.lists(st.integers(0, 3), min_size=1, max_size=70), t=st.lists(st.integers(0, 3), max_size=90))
def test_least_edits(p, t):
    assert decontaminate.least_edits(p, t) == edits(p, t)


def test_nearest_are_exact_and_relaxed_ones_close():
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(1500, 16))
    vectors[200:500] = vectors[200]
    ids = rng.permutation(1500)
    largest = float(np.sqrt((vectors**2).sum(1).max()))
    shard = vp_search.Shard(ids, vectors, largest, 20, leaf=32)
    queries = np.arange(0, 1500, 20)
    for relax, least in ((1.0, 1.0), (1.3, 0.8)):
        best = shard.search(ids[queries], vectors[queries], relax)
        hits = 0
        for n, q in enumerate(queries):
            s = np.einsum("ij,kj->ik", vectors[q : q + 1], vectors)[0]
            order = [k for k in np.lexsort((ids, -s)) if ids[k] != ids[q]][:20]
            if relax == 1.0:
                assert ids[order].tolist() == best.ids[n].tolist()
            hits += len(set(ids[order].tolist()) & set(best.ids[n].tolist()))
        assert hits >= least * 20 * len(queries)


def test_block_links_join_what_brute_force_joins():
    rng = np.random.default_rng(9)
    base = rng.integers(0, 1 << 62, 150).astype(np.uint64)
    sets = []
    for i in range(120):
        s = base.copy()
        k = int(rng.integers(0, 40))
        s[rng.choice(150, k, replace=False)] = rng.integers(0, 1 << 62, k).astype(np.uint64)
        sets.append(np.unique(s))
    ids = np.arange(120)

    def components(links):
        up = list(range(120))
        def root(x):
            while up[x] != x:
                x = up[x]
            return x
        for a, b in links:
            up[max(root(a), root(b))] = min(root(a), root(b))
        return [root(x) for x in range(120)]

    brute = [(a, b) for a in range(120) for b in range(a) if near_dedup.linked(sets[a], sets[b], 85)]
    for sides in (np.zeros(120, int), (ids % 2)):
        links = near_dedup.block_links(ids, ids.copy(), sides, sets, 85)
        pairs = brute if not sides.any() else [(a, b) for a, b in brute if a % 2 != b % 2]
        assert components(links) == components(pairs)
        assert len(links) < 120


def test_pairs_at_the_threshold_meet():
    """Pairs of similarity exactly 0.85 and 0.8 that share no band, or are taken for unlikely by their sketches."""
    rng = np.random.default_rng(12)
    for common, one, other, percent, least in ((85, 8, 7, 85, 2999), (80, 10, 10, 80, 2997)):
        found = 0
        for _ in range(3000):
            h = rng.integers(0, 1 << 63, common + one + other).astype(np.uint64)
            a, b = np.sort(h[: common + one]), np.sort(np.concatenate([h[:common], h[common + one :]]))
            assert near_dedup.linked(a, b, percent)
            x, y = near_dedup.min_max(a), near_dedup.min_max(b)
            agree = ((x >> np.uint64(56)) == (y >> np.uint64(56))).sum()
            found += bool((near_dedup.band_keys(x) == near_dedup.band_keys(y)).any()) and agree >= near_dedup.least_agreement(80, percent)
        print("met", percent, found)
        assert found >= least


def test_min_max_agreement_estimates_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 62, 1000).astype(np.uint64)
    b = np.concatenate([a[:800], rng.integers(0, 1 << 62, 200).astype(np.uint64)])
    x, y = near_dedup.min_max(a), near_dedup.min_max(b)
    assert abs((x == y).mean() - 800 / 1200) < 0.2


def test_licence_expressions():
    post = licences.to_postfix("( MIT OR Apache-2.0 ) AND GPL-2.0 WITH Classpath-exception-2.0".split())
    assert post == ["MIT", "Apache-2.0", "or", "GPL-2.0", "Classpath-exception-2.0", "with", "and"]
    assert licences.evaluate(post) == min(1.0, (1 + 0.3) / 2)
    for bad in ("MIT OR", "( MIT", "AND MIT", "MIT GPL-2.0", "( )", "MIT )"):
        with pytest.raises(ValueError):
            licences.to_postfix(bad.split())
    assert licences.read_expression(" GPL-2.0 OR")[1] == ["gpl-2.0"]


def test_the_longest_notice_gives_the_score():
    assert licences.scan("under the GNU Lesser General Public License")["score"] == 0.5
    both = licences.scan("GNU Lesser General Public License, or the General Public License")
    assert (both["score"], both["n_base"], both["labels"]) == (0.3, 2, "gpl,lgpl")


def test_expressions_end_with_their_line_or_the_next_tag():
    got = licences.scan("SPDX-License-Identifier: MIT OR SPDX-License-Identifier: (LGPL-2.1 AND ISC) rest\nGPL-2.0")
    assert (got["labels"], got["score"]) == ("isc,lgpl-2.1,mit", 0.5)


@given(tokens=st.lists(st.sampled_from(["MIT", "GPL-2.0", "and", "OR", "with", "(", ")"]), max_size=9))
@settings(max_examples=200, deadline=None)
def test_one_pass_finds_the_longest_expression(tokens):
    for end in range(len(tokens), -1, -1):
        try:
            licences.to_postfix(tokens[:end])
            break
        except ValueError:
            pass
    if end:
        assert licences.read_expression(" ".join(tokens)) == (licences.evaluate(licences.to_postfix(tokens[:end])), licences.names_of(tokens[:end]))


@pytest.mark.parametrize("text", ["SPDX-License-Identifier: " + "(" * 1_000_000, "cc by " * 170_000, "SPDX-License-Identifier: MIT " * 35_000, "x" * 1_000_000, "spdx " + "- " * 500_000])
def test_long_texts_take_time_in_proportion(text):
    began = time.process_time()
    licences.scan(text)
    assert time.process_time() - began < 10


@settings(max_examples=100, deadline=None)
@given(text=st.one_of(st.none(), st.lists(st.sampled_from(["cc", "by", "CC", "General", "public", "license", "all", "rights", "reserved", "x", "é", ".", "\n"]), max_size=30).map(" ".join)))
def test_license_places(text):
    got = licences.scan(text)
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    starts = [i for p in licences.BASE for q in [p.split()] for i in range(len(words)) if words[i : i + len(q)] == q]
    assert (got["n_words"], got["n_base"]) == (len(words), len(starts))
    assert (got["first_word"], got["last_word"]) == (min(starts, default=None), max(starts, default=None))
    assert 0 <= got["score"] <= 1


def test_ordinal_thresholds_are_ordered_and_grades_learned():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(800, 6)).astype(np.float32)
    s = x @ np.array([2, -1, 0, 0, 0.5, 0]) + rng.logistic(size=800) * 0.3
    grades = np.digitize(s, [-1.5, 0, 1.5])
    model = quality.fit(grades, quality.Sparse.dense(x), rounds=400)
    assert (np.diff(model.thresholds) > 0).all() and len(model.thresholds) == 3
    tails = model.tails(x @ model.weights)
    assert (np.diff(tails, axis=1) <= 0).all()
    assert np.corrcoef(tails.sum(1), grades)[0, 1] > 0.85


def test_ordinal_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(40, 5)) * (rng.random((40, 5)) < 0.6), rng.integers(0, 4, 40)
    w, gaps, e = rng.normal(size=5), np.array([-1.0, 0.1, -0.3]), 1e-6
    loss = lambda w, gaps: quality.loss_and_gradients(quality.Sparse.dense(x), y, w, gaps, 0.01)[0]
    t = np.cumsum([gaps[0], *np.exp(gaps[1:])])
    plain = 0.0
    for row, k in zip(x, y):
        cut = [0.0, *(1 / (1 + np.exp(-(t - row @ w)))), 1.0]
        plain -= np.log(cut[k + 1] - cut[k]) / len(y)
    assert abs(loss(w, gaps) - plain - 0.005 * w @ w) < 1e-9
    _, by_w, by_gaps = quality.loss_and_gradients(quality.Sparse.dense(x), y, w, gaps, 0.01)
    for i in range(5):
        d = np.eye(5)[i] * e
        assert abs((loss(w + d, gaps) - loss(w - d, gaps)) / (2 * e) - by_w[i]) < 1e-5
    for i in range(3):
        d = np.eye(3)[i] * e
        assert abs((loss(w, gaps + d) - loss(w, gaps - d)) / (2 * e) - by_gaps[i]) < 1e-5


def test_hashed_values_are_those_of_plain_counts():
    texts = ["a b a b a", None, "", "One  one two\nthree", "xy", " \t", "w " * 700, "é ü", "a b c d e f a b c d e f a", "x y z x y z y x"]
    tokens = quality.hashed(pa.array(texts))
    got = np.concatenate([x for _, x in quality.values(tokens)])
    for text, row in zip(texts, got):
        raw = (text or "").encode()
        words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), raw))
        expected = Counter()
        for i, w in enumerate(words):
            expected[read_words(pa.array([w.decode()]), SPACED_LOWER).hash[0] >> np.uint64(64 - quality.WORD_BITS)] += 1
            run = words[max(0, i - quality.SHAPE + 1) : i + 1][::-1]
            code = sum(next((g for g in range(1, len(run) - k) if run[k + g] == run[k]), 0) * quality.SHAPE**k for k in range(len(run)))
            expected[quality.SHAPES + int(quality.mix64(np.array([code]))[0] >> np.uint64(64 - quality.SHAPE_BITS))] += 1
        assert abs((row[: quality.RUNS] ** 2).sum() - (1 if words else 0)) < 1e-5 and abs((row[quality.SHAPES :] ** 2).sum() - (1 if words else 0)) < 1e-5
        for at, n in expected.items():
            assert abs(row[int(at)] ** 2 - n / len(words)) < 1e-5
        runs = row[quality.RUNS : quality.SHAPES]
        assert abs((runs**2).sum() - (1 if len(raw) > 2 else 0)) < 1e-5 and (runs > 0).sum() <= max(0, len({raw[i : i + 3] for i in range(len(raw) - 2)}))


def test_shapes_are_of_places_not_of_words():
    one, other = (quality.hashed(pa.array([t])).kinds[1][0] for t in ("p q p q r s t p u", "aa bb aa bb cc dd ee aa ff"))
    assert (one == other).all() and len(set(one.tolist())) > 3


def test_a_fit_goes_on_from_another():
    rng = np.random.default_rng(4)
    x = quality.Sparse.dense((rng.random((300, 8)) < 0.5).astype(np.float32))
    grades = np.digitize(x.times(np.array([2.0, -2, 1, 0, 0, 0, 0, 0])) + rng.logistic(size=300) * 0.3, [0, 1.5])
    loss = lambda m: quality.loss_and_gradients(x, grades, m.weights, np.concatenate([m.thresholds[:1], np.log(np.diff(m.thresholds))]), 1e-3)[0]
    first = quality.fit(grades, x, 20, 1e-3)
    more = quality.fit(grades, x, 380, 1e-3, 0.1, first)
    assert loss(more) < loss(first) and abs(loss(more) - loss(quality.fit(grades, x, 400, 1e-3))) < 0.02


def char_model():
    text = " ".join(["the idiot said a stupid thing to the loser and the moron was disgusting"] * 50)
    counts = np.zeros(32**3, np.int64)
    for b in toxicity._gram_counts(iter([pa.RecordBatch.from_arrays([pa.array([text])], ["text"])])):
        counts[b.column(0).to_numpy()] = b.column(1).to_numpy()
    return toxicity.CharModel(counts)


def test_words_are_restored():
    model = char_model()
    for seen, meant in {"1d10t": "idiot", "i.d.i.o.t": "idiot", "5tup1d": "stupid", "l0$er": "loser", "idiiiiot": "idiot", "m0r0n": "moron", "i d i o t": "idiot", "d1sgust1ng": "disgusting"}.items():
        assert toxicity.decode(seen, model) == meant
    restorer = toxicity.Restorer(model)
    wanted = toxicity.tokens_of(pa.array(["idiot"]))[2][0]
    for text in ("You 1d10t.", "an i d i o t here", "so i-d-i-o-t", "IDIOT"):
        rows, hashes, _ = restorer.tokens(pa.array(["fine words.", text, None, ""]))
        assert wanted in hashes[rows == 1] and wanted not in hashes[rows == 0]


@settings(max_examples=60, deadline=None)
@given(st.text("abist10!.-( ü", max_size=7))
def test_decoding_equals_trying_every_path(seen):
    model = char_model()

    def cost(letters):
        total, a, b = 0.0, 0, 0
        for c in [toxicity._symbol(x) for x in letters] + [0]:
            total, a, b = total + model.rows[a][b][c], b, c
        return total

    paths = [("", 0.0)]
    for edges in toxicity.lattice(seen):
        paths = [(text + letter, so_far + channel) for text, so_far in paths for letter, channel in edges]
    got = toxicity.decode(seen, model)
    assert abs(min(c + cost(t) for t, c in paths if t == got) - min(c + cost(t) for t, c in paths)) < 1e-9


def test_decoding_goes_on_from_the_text_before(monkeypatch):
    model, rng = char_model(), random.Random(3)
    decoder = toxicity.Decoder(model)
    for _ in range(50):
        seen = "".join(rng.choice("abcdeiost013$! .Σİ€") for _ in range(12))
        assert [decoder.decode(seen[:k]) for k in range(13)] == [toxicity.decode(seen[:k], model) for k in range(13)]
    long = "".join(rng.choice("abci01!") for _ in range(3000))
    whole = toxicity.decode(long, model)
    monkeypatch.setattr(toxicity.Decoder, "OWN", 16)
    assert toxicity.decode(long, model) == whole
    # Rows of single letters in blocks give the tokens of one block.
    rows = pa.array([" ".join(rng.choice("idt10s!") for _ in range(80)), "fine words", " ".join("scum")])
    expected = {(r, h) for r, h in zip(*map(np.ndarray.tolist, toxicity.Restorer(model).tokens(rows)[:2]))}
    monkeypatch.setattr(toxicity, "PLACES", 7)
    assert {(r, h) for r, h in zip(*map(np.ndarray.tolist, toxicity.Restorer(model).tokens(rows)[:2]))} == expected


@pytest.mark.parametrize(
    "seen, meant",
    [("s(um", "scum"), ("los€r", "loser"), ("i--d--i--o--t", "idiot"), ("s..c..u..m", "scum"), ("!diot", "idiot"), ("idi07", "idiot"), ("iiddiioott", "idiot"), ("i d 1 o t", "idiot"), ("a i d i o t", "idiot"), ("a 1 d 1 0 t.", "idiot"), ("m0r0n!", "moron")],
)
def test_each_planted_form_is_restored(seen, meant):
    text = " ".join(["the idiot said a stupid thing to the loser and the moron and the scum was disgusting"] * 50)
    counts = np.zeros(32**3, np.int64)
    for b in toxicity._gram_counts(iter([pa.RecordBatch.from_arrays([pa.array([text])], ["text"])])):
        counts[b.column(0).to_numpy()] = b.column(1).to_numpy()
    restorer = toxicity.Restorer(toxicity.CharModel(counts))
    wanted = toxicity.tokens_of(pa.array([meant]))[2][0]
    rows, hashes, _ = restorer.tokens(pa.array(["fine words.", f"so {seen}", None, "", f"{seen} it is"]))
    assert {1, 4} == set(rows[hashes == wanted].tolist())


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("aabist10!.-(*# ü€Σ", max_size=9), max_size=6))
def test_decoding_many_words_at_once_is_decoding_each(seen):
    model = char_model()
    decoder = toxicity.Decoder(model)
    many = toxicity.decode_all(seen, decoder)
    cost = lambda x, t: min([c for u, c in paths(x) if u == t], default=np.inf)

    def paths(x):
        found = [("", 0.0, (0, 0))]
        for edges in toxicity.lattice(x.lower()):
            found = [(t + y, c + channel + (model.rows[s[0]][s[1]][toxicity._symbol(y)] if y else 0), (s[1], toxicity._symbol(y)) if y else s) for t, c, s in found for y, channel in edges]
        return [(t, c + model.rows[a][b][0]) for t, c, (a, b) in found]

    for x, got in zip(seen, many):
        each = toxicity.decode(x, model)
        assert got == each or (len(x) < 7 and abs(cost(x, got) - cost(x, each)) < 1e-9)


def test_a_long_spelled_word_is_found_inside_a_longer_row():
    model, word = char_model(), "antidisestablishmentarianistic"
    assert len(word) == 30
    restorer = toxicity.Restorer(model, longest=30)
    wanted = toxicity.tokens_of(pa.array([word]))[2][0]
    rows, hashes, sizes, _ = restorer.sized_tokens(pa.array(["q x " + " ".join(word) + " z q", "q x z", " ".join(word)]))
    assert set(rows[hashes == wanted].tolist()) == {0, 2} and set(sizes[hashes == wanted].tolist()) == {30}


def test_stretches_are_all_that_can_hold_a_word():
    import itertools

    rng = random.Random(8)
    for _ in range(200):
        letters = [rng.choice([b"a", b"b", b"1", b"*", b"*", b"B."]) for _ in range(rng.randint(3, 12))]
        longest = rng.randint(3, 6)
        got = set(toxicity.stretches(letters, longest))
        for i, j in itertools.combinations(range(len(letters) + 1), 2):
            own = letters[i:j]
            least = sum(x != b"*" for x in own)
            if len(own) >= 3 and least <= longest and (b"*" * (longest + 1)) not in b"".join(own):
                assert b" ".join(own) in got
    # A row of signs that may be nothing takes work in proportion.
    assert sum(1 for _ in toxicity.stretches([b"*"] * 5000, 8)) < 200
    assert sum(1 for _ in toxicity.stretches([b"a"] * 5000, 8)) < 5000 * 8


def test_suspicion_does_not_cross_texts():
    model = char_model()
    apart = [toxicity.Restorer(model).tokens(pa.array([t])) for t in ("a word.", "Next one")]
    both = toxicity.Restorer(model).tokens(pa.array(["a word.", "Next one"]))
    assert Counter(both[1].tolist()) == Counter([*apart[0][1].tolist(), *apart[1][1].tolist()])


def test_edits_of_long_patterns_need_no_mask_for_each_word(monkeypatch):
    rng = random.Random(6)
    pattern = [rng.choice([0, 1, rng.randint(2, 400)]) for _ in range(1500)]
    text = [rng.randint(2, 400) for _ in range(100)] + [x for x in pattern if rng.random() < 0.9] + [0] * 50
    whole = decontaminate.least_edits(pattern, text)
    monkeypatch.setattr(decontaminate, "MASK_BYTES", 2_000)
    assert decontaminate.least_edits(pattern, text) == whole


PAGE = '<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><a>Home</a></nav><div class="ad">Buy</div>{}<footer>&copy; x</footer></body></html>'


@pytest.mark.parametrize(
    "body, text",
    [
        ("<article><h1>A &amp; B</h1><p><b>One\n two.<br><p>Th<i>re</i>e</p></article>", "A & B\n\nOne two.\n\nThree"),
        ("<main><p>x</p><aside>no</aside><div class='comments'><p>nope</p></div><form>f</form></main>", "x"),
        ("<header>h</header><div id=content><p>a</p><ul><li>b</li></ul></div><div class='sidebar'>s</div>", "a\n\nb"),
        ("<article></article>", ""),
        ("<article><p>&lt;p&gt; &#x41; &nbsp;z</p></article>", "<p> A z"),
    ],
)
def test_main_text(body, text):
    assert templates.Page(PAGE.replace("{}", body)).main_text(set()) == text


def test_broken_pages_do_not_crash():
    for source in ("", "<", "<p", "</p>", "<!-- open", "<script>never closed", "plain", "<a href='x>y", "<div><p><div></p>"):
        assert isinstance(templates.Page(source).main_text(set()), str)


@pytest.mark.parametrize("piece", ["<div>", "<b>", "<p>", "<", "<a href=\"", "<a b='", "<!--", "<![CDATA[", "<!", "<?x", "<script>", "</p>", "&", "&amp;", "<br>"])
def test_broken_pages_take_time_in_proportion(piece):
    began = time.process_time()
    for source in (piece * (300_000 // len(piece)), "<div>" * 20_000 + piece * 20_000, "<b>" * 20_000 + piece * 20_000):
        templates.Page(source).main_text()
    assert time.process_time() - began < 20


def test_only_an_article_outside_furniture_holds_the_text():
    for aside in ("<aside><article><h3>related</h3></article></aside>", "<div class='comments'><article>reply</article></div>"):
        assert templates.Page(f"<body>{aside}<div><p>the text</p><p>goes on</p></div></body>").main_text(set()) == "the text\n\ngoes on"
