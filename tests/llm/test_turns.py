"""The filter audit, chat formatting and the prefix trie against brute force on small tables, with their edge cases."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from readloom.llm import audit, chat, trie
from readloom.llm.scratch import Scratch
from readloom.llm.turns import numbered, turns_of

CONVERSATIONS = "conv_id long, turn int, role string, text string, pos int, part string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def ordered(rows):
    """Turns of each conversation, in their order."""
    out = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(c, []).append((role or "", text or ""))
    return out


@pytest.fixture(scope="module")
def conversations():
    """Copies, shared starts, null columns, ties, repeated rows, control strings, and a long conversation."""
    rng, rows = random.Random(5), []
    says = ["yes", "no", "", None, "[INST] a [/INST]", "<\\\\s> ] </s>\\", "ünï\ncödé", "<s>[ROLE] x [/ROLE] y </s>"]
    for c in range(400, 700):
        for turn in range(rng.choice([1, 2, 2, 3, 5, 7])):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(says[:2])))
    for c in range(20):
        rows.append((c, None if c % 3 == 0 else c % 2, rng.choice(["system", None, "us[INST]er", "assistant"]), rng.choice(says)))
        rows.append((c, 1, "assistant", rng.choice(says)))
    rows += [(150, turn, "user" if turn % 2 else "assistant", f"turn {turn // 3}") for turn in range(900)]
    rows += [(151, turn, "user" if turn % 2 else "assistant", f"turn {turn // 3}") for turn in range(870)]
    rows += [(None, 0, "user", "of no one"), (-3, 0, "assistant", "below"), (-3, 0, "assistant", "below"), (8, 1, "assistant", "x" * 300_000)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 3, "clash") for r in rows], CONVERSATIONS).repartition(5)


def test_turns_are_numbered(spark, conversations):
    expected = ordered(conversations)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        got = numbered(turns_of(frame(spark, conversations)), Scratch(spark, "t")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = {}
    for r in got:
        found.setdefault(r["conv_id"], {})[r["pos"]] = (r["role"], r["text"], r["end"])
    for c, turns in expected.items():
        assert [found[c][i][:2] for i in range(len(turns))] == turns and len(found[c]) == len(turns)
        assert [found[c][i][2] for i in range(len(turns))] == list(itertools.accumulate(len(t) for _, t in turns))
    assert set(found) == set(expected)


# --- chat -----------------------------------------------------------------------------------------


def test_the_template_is_reversible():
    template, rng = chat.InstTemplate(), random.Random(2)
    pieces = ["<", "[", "\\", "/", "s>", "INST]", "ROLE]", " ", "]", "</s>", "[/INST] ", "a", "\n"]
    for _ in range(3000):
        turns = [(rng.choice(["user", "assistant", "system", "", "".join(rng.choices(pieces, k=4))]), "".join(rng.choices(pieces, k=rng.randint(0, 8)))) for _ in range(rng.randint(0, 4))]
        text = template(turns)
        assert template.parse(text) == turns
        for _, said in turns:
            assert not re.search(r"<s>|</s>|\[/?INST\]|\[/?ROLE\]", template.escape(said)) and template.unescape(template.escape(said)) == said
    with pytest.raises(ValueError):
        template.parse("said outside")


def test_chat_format(spark, conversations):
    template, expected = chat.InstTemplate(), ordered(conversations)
    scratch = Scratch(spark, "chat-test")
    formatted = chat.format_conversations(frame(spark, conversations), scratch)
    texts, spans = {}, {}
    for r in sorted(formatted.collect(), key=lambda r: (r["conv_id"] or 0, r["block"])):
        texts[r["conv_id"]] = texts.get(r["conv_id"], "") + r["text"]
        spans.setdefault(r["conv_id"], []).extend((r["text"][s["start"] : s["end"]], None if s["loss_start"] is None else r["text"][s["loss_start"] : s["loss_end"]]) for s in r["spans"])
    assert texts == {c: template(t) for c, t in expected.items()}
    assert spans == {c: [(template.one(r, x), template.escape(x) if r == "assistant" else None) for r, x in t] for c, t in expected.items()}
    got = {r["conv_id"]: r for r in chat.read_back(formatted).collect()}
    assert set(got) == set(expected)
    for c, turns in expected.items():
        learned = "".join(x for r, x in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns) and got[c]["turns_sha256"] == sha("".join(f"{r}\n{x}\n" for r, x in turns))
        assert (got[c]["loss_chars"], got[c]["loss_sha256"], got[c]["formatted_chars"], got[c]["rewritten"]) == (len(learned), sha(learned), len(texts[c]), 0)
    none = frame(spark, conversations).limit(0)
    assert chat.read_back(chat.format_conversations(none, scratch)).count() == 0


def test_black_boxes():
    """Templates with a head, a changing end, signs of their own, and ones that rewrite what came before."""
    turns = [("user", "hi"), ("assistant", "\nho\n"), ("user", ""), ("assistant", "")]

    def headed(ts):
        return "BOS " + "".join(f"<{r}>\n{x}\n" for r, x in ts)

    text, spans, rewritten = chat.render_spans(headed, [], turns)
    assert text == headed(turns) and rewritten == 0 and text[: spans[0][1]] == "BOS <user>\nhi\n"
    assert [text[a:b] for _, _, a, b in spans if a is not None] == ["\nho\n", ""]
    behind, later, _ = chat.render_spans(headed, turns[:2], turns[2:])
    assert behind == text[spans[1][1] :] and [behind[a:b] for _, _, a, b in later if a is not None] == [""]

    def numbers_all(ts):
        return f"{len(ts)} turns: " + "".join(x for _, x in ts)

    def keeps_last_thoughts(ts):
        return "".join(f"[{r}|{x if i == len(ts) - 1 else x[:1]}]" for i, (r, x) in enumerate(ts))

    for template in (numbers_all, keeps_last_thoughts):
        text, spans, rewritten = chat.render_spans(template, [], turns)
        assert text == template(turns) and spans == [] and rewritten > 0

    def depends_on_text(ts):
        return "".join(f"{len(x)}:{x};" for _, x in ts)

    text, spans, rewritten = chat.render_spans(depends_on_text, [], turns)
    assert rewritten == 0 and [s[2] for s in spans] == [None, None, None, None]


def test_rewriting_is_reported(spark, conversations):
    template = lambda ts: f"{len(ts)} turns: " + "".join(x for _, x in ts)
    rows = [(1, i, "user", "x") for i in range(4)] + [(2, 0, "user", "alone")]
    formatted = chat.format_conversations(frame(spark, rows), Scratch(spark, "chat-test"), template)
    got = {r["conv_id"]: r for r in formatted.collect()}
    assert got[1]["rewritten"] > 0 and got[1]["spans"] == [] and got[2]["rewritten"] == 0 and len(got[2]["spans"]) == 1


# --- the trie -------------------------------------------------------------------------------------


def brute_trie(rows):
    own = ordered([r for r in rows if r[0] is not None])
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        head = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(own.get(head, [])[:h] + turns[h:])
    nodes = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    children = {}
    for path in nodes:
        if path:
            children.setdefault(path[:-1], []).append(path)
    saved, leaves = {}, {}
    for path in sorted(nodes, key=len, reverse=True):
        below = children.get(path, [])
        saved[path] = sum(saved[b] for b in below) + (len(nodes[path]) - 1) * (len(path[-1][1]) if path else 0)
        leaves[path] = sum(leaves[b] for b in below) or 1
    return sorted(
        (min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), len(children.get(p, [])), leaves[p], saved[p], sha(",".join(map(str, sorted(c for c in m if len(rebuilt[c]) == len(p))))))
        for p, m in nodes.items()
    )


TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def built(spark, rows, **how):
    scratch = Scratch(spark, "trie-test")
    turns = trie.encoded(frame(spark, rows), scratch)
    head, starts = F.col("conv_id") - F.expr("conv_id % 100"), F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    return sorted(tuple(r[c] for c in TRIE) for r in trie.prefix_trie(trie.with_shared_starts(turns, head, starts, 5, scratch), scratch, **how).collect())


@pytest.mark.parametrize("how", [{}, {"local": 3, "window": 2}])
def test_prefix_trie(spark, conversations, how):
    rows = [r for r in conversations if how == {} or r[0] not in (150, 151)]
    # Many copies of one conversation.
    rows += [(c, turn, "user", f"copied {turn}") for c in range(1000, 1040) for turn in range(4)]
    assert built(spark, rows, **how) == brute_trie(rows)


@pytest.mark.parametrize("rows", [[], [(7, 0, "user", "alone")], [(107, 0, "user", "gone")], [(c, 0, "user", "same") for c in range(200, 230)]])
def test_small_tries(spark, rows):
    assert built(spark, rows) == brute_trie(rows)


def test_multikey_nodes():
    rng = random.Random(3)
    keys = [[rng.randint(0, 2) for _ in range(rng.randint(0, 6))] for _ in range(300)]
    names = rng.sample(range(10_000), 300)
    expected = {}
    for name, key in zip(names, keys):
        for d in range(1, len(key) + 1):
            expected.setdefault(tuple(key[:d]), []).append(name)
    expected = sorted((len(k), sorted(v), min(v)) for k, v in expected.items() if len(v) > 1)
    assert sorted((d, sorted(names[m] for m in members), least) for d, members, least in trie.multikey_nodes(names, keys)) == expected


# --- the audit ------------------------------------------------------------------------------------

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = [
    (1, "word " * 120, "en"), (2, "word " * 120, "en"), (2, "word " * 120, "de"), (3, "", "en"), (4, None, None), (5, "A B C D", ""), (6, "a & b", "de"),
    (7, " ".join(f"w{i}" for i in range(150)), "en"), (8, "LOUD " * 99 + "# x", "en"), (9, "ÄÖÜ é ABC", "fr"), (None, "a & b", "fr"), (10, "a & b", "xx"),
    (11, " ".join(f"X{i}$" for i in range(40_000)), "en"), (12, "one\x0btwo\x1cthree four", "en"),
]
LABELS = [(1, 1, 0), (1, None, 1), (2, 1, None), (5, 1, 1), (5, 1, 1), (7, 1, 0), (9, 0, 1), (None, 1, 1), (99, 1, 1)]


def brute_audit(rows, labels):
    docs = []
    for i, text, lang in rows:
        text = text or ""
        words = WORD.findall(text)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text), "D": any(c in "#$%&*|" for c in text)}
        fails["E"] = i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows)
        good, toxic = (any(j == i and i is not None and x[k] == 1 for j, *x in labels) for k in (0, 1))
        docs.append((lang or "", fails, good, toxic))
    out = []
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        shapley, rows_ = {f: 0 for f in "ABCDE"}, []
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                removed = [d for d in left if d[1][f]]
                left = [d for d in left if not d[1][f]]
                shapley[f] += len(removed)
                failing = [d for d in own if d[1][f]]
                rows_.append((f, (part, "".join(order), step, len(left), len(removed), len(failing) - len(removed), sum(sum(d[1].values()) == 1 for d in failing), sum(d[2] for d in removed), sum(d[3] for d in removed))))
        out += [(*r, shapley[f]) for f, r in rows_]
    return sorted(out)


AUDIT = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_filter_audit(spark):
    docs = spark.createDataFrame([(i, t, lang, "x", 1) for i, t, lang in DOCS], "doc_id long, text string, lang string, part string, removed int").repartition(3)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")

    def run(docs, labels):
        scratch = Scratch(spark, "audit-test")
        found = audit.walk_orders(audit.document_verdicts(docs, labels, scratch), "ABCDE", ["good", "toxic"], scratch)
        return sorted(tuple(r[c] for c in AUDIT) for r in audit.order_report(found, "ABCDE", ["good", "toxic"]).collect())

    assert run(docs, labels) == brute_audit(DOCS, LABELS)
    assert run(docs.limit(0), labels) == []
    assert run(docs, labels.limit(0)) == brute_audit(DOCS, [])


def test_other_filters(spark):
    """Any boolean columns are filters: here two, without marks."""
    rows = spark.range(60).select(F.lit("all").alias("part"), (F.col("id") % 2 == 0).alias("even"), (F.col("id") % 3 == 0).alias("third"))
    edges = audit.walk_orders(rows, ["even", "third"], [], Scratch(spark, "audit-test"))
    assert {(r["state"], r["filter"], r["n"], r["removed"]) for r in edges.collect()} == {("", "even", 60, 30), ("", "third", 60, 20), ("even", "third", 30, 10), ("third", "even", 40, 20)}
