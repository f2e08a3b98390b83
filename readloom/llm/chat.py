"""Chat formatting by incremental black-box rendering.

A template is anything that renders a list of (role, text) turns to a string; nothing is known of how it does so.

1. Successive prefixes of a conversation are rendered and consecutive outputs compared: what a turn adds to the output
   before it is its span.  If the output before is not a prefix of the new one, the template rewrites history:
   `rewritten` counts the characters that later turns changed, and such a block has no spans.
2. In the span of a turn that is to be learned, the text lies between what the template puts around it: the turn is
   rendered once more with a mark for its text, and the marks' surroundings are looked for in the span.  Where they
   aren't found (a template whose signs depend on the text), the loss span is null.
3. A conversation is rendered in blocks of BLOCK turns, each behind the last `context` turns of the block before, so that no task
   holds a whole conversation and prefixes stay short.  A template whose output for a turn depends on more
   than that many turns before it needs a larger context.

What comes out is one row a block: its text, so that a conversation's blocks in order are its formatted text, and
the spans in it.  `read_back` parses that text again and digests what it finds; conversations of one block are digested where they lie,
those of several are streamed in order, so memory is bounded (a digest of a whole conversation is serial by its nature).

InstTemplate is the query's template.  It escapes control strings inside texts and roles reversibly: a backslash more
stands behind the bracket of everything that is one, or would be one without its backslashes.

Edge cases: a null role or text is empty; turns of equal number go by role, then text, and a null number comes first;
equal rows are turns of their own; rows of a null conv_id are one conversation; very long texts are rendered whole; an empty table
gives an empty result (in the query: conversation -1 alone); extra columns are not read.
"""

from __future__ import annotations

import hashlib
import os.path
import re
from collections.abc import Callable, Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm.scratch import Scratch
from readloom.llm.tables import table
from readloom.llm.turns import numbered, turns_of

Turn = tuple[str, str]
#: Turns of a block, and turns before it that it is rendered behind.
BLOCK, CONTEXT = 64, 2
#: Roles whose texts are learned.
LEARNED = ("assistant",)

# --- a template -----------------------------------------------------------------------------------


class InstTemplate:
    """[INST] a user's text [/INST], <s> an assistant's text </s>, <s>[ROLE] role [/ROLE] any other's text </s>."""

    _inner = re.compile(r"([<\[])(\\*)(/?(?:s>|INST\]|ROLE\]))")
    _escaped = re.compile(r"([<\[])\\(\\*/?(?:s>|INST\]|ROLE\]))")
    _signs = re.compile(r"<s>\[ROLE\] | \[/ROLE\] |\[INST\] | \[/INST\]|<s> | </s>")

    def escape(self, text: str) -> str:
        return self._inner.sub(r"\1\\\2\3", text) if "<" in text or "[" in text else text

    def unescape(self, text: str) -> str:
        return self._escaped.sub(r"\1\2", text) if "\\" in text else text

    def one(self, role: str, text: str) -> str:
        if role == "user":
            return f"[INST] {self.escape(text)} [/INST]"
        head = "" if role == "assistant" else f"[ROLE] {self.escape(role)} [/ROLE]"
        return f"<s>{head} {self.escape(text)} </s>"

    def __call__(self, turns: Sequence[Turn]) -> str:
        return "".join([self.one(role, text) for role, text in turns])

    def parse(self, formatted: str) -> list[Turn]:
        """The turns again; formatted begins and ends at a turn."""
        turns, role, at = [], "", 0
        while at < len(formatted):
            opened = self._signs.match(formatted, at)
            kind = opened[0] if opened else None
            role = {"[INST] ": "user", "<s> ": "assistant"}.get(kind)
            begin = opened.end() if opened else at
            if kind == "<s>[ROLE] ":
                closed = self._next(formatted, begin, " [/ROLE] ")
                role, begin = self.unescape(formatted[begin : closed[0]]), closed[1]
            if role is None:
                raise ValueError(f"no turn begins at {at}")
            closed = self._next(formatted, begin, " [/INST]" if kind == "[INST] " else " </s>")
            turns.append((role, self.unescape(formatted[begin : closed[0]])))
            at = closed[1]
        return turns

    @staticmethod
    def _next(formatted: str, begin: int, sign: str) -> tuple[int, int]:
        # No sign stands inside an escaped text, so the first one is the right one.
        at = formatted.find(sign, begin)
        if at < 0:
            raise ValueError(f"a turn has no {sign!r}")
        return at, at + len(sign)


# --- rendering ------------------------------------------------------------------------------------


def _loss(render: Callable, before: list[Turn], role: str, prefix: str, span: str) -> tuple[int, int] | None:
    """Where in its span a turn's text lies."""
    mark = "\ue000"
    while mark in role:
        mark += "\ue000"
    marked = render([*before, (role, mark)])
    if not marked.startswith(prefix):
        return None
    head, found, tail = marked[len(prefix) :].partition(mark)
    if not found or len(head) + len(tail) > len(span) or not span.startswith(head) or not span.endswith(tail):
        return None
    return len(head), len(span) - len(tail)


def render_spans(render: Callable[[Sequence[Turn]], str], before: Sequence[Turn], turns: Sequence[Turn], learned: Sequence[str] = LEARNED) -> tuple[str, list[tuple[int, int, int | None, int | None]], int]:
    """(text, spans, rewritten) of turns that stand behind `before`; a span is (start, end, loss start, loss end) in the text."""
    done = list(before)
    out = render(done) if done else ""
    base, spans, rewritten = len(out), [], 0
    for role, text in turns:
        new = render([*done, (role, text)])
        if new.startswith(out):
            loss = _loss(render, done, role, out, new[len(out) :]) if role in learned else None
            a = len(out) - base
            spans.append((a, len(new) - base, a + loss[0] if loss else None, a + loss[1] if loss else None))
        else:
            rewritten += len(out) - len(os.path.commonprefix([out, new]))
        done.append((role, text))
        out = new
    return out[base:] if not rewritten else out[min(base, len(out)) :], [] if rewritten else spans, rewritten


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("loss_start", pa.int64()), ("loss_end", pa.int64())])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _rendered(render: Callable, learned: Sequence[str], block: int):
    def flushed(rows: list[tuple]) -> pa.RecordBatch:
        spans = [[dict(zip(("start", "end", "loss_start", "loss_end"), s)) for s in r[3]] for r in rows]
        columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string()), pa.array(spans, pa.list_(_SPAN)), pa.array([r[4] for r in rows], pa.int64()), pa.array([r[5] for r in rows], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["conv_id", "block", "text", "spans", "n_turns", "rewritten"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        # (conv_id, block, pos, role, text), sorted
        for (conv, number), rows in groupby(_rows(batches), key=lambda r: r[:2]):
            rows = list(rows)  # block + context turns at most
            before = [r[3:] for r in rows if r[2] < number * block]
            own = [r[3:] for r in rows if r[2] >= number * block]
            text, spans, rewritten = render_spans(render, before, own, learned)
            held.append((conv, number, text, spans, len(own), rewritten))
            size += len(text)
            if size > 1 << 20 or len(held) >= 2048:
                yield flushed(held)
                held, size = [], 0
        if held:
            yield flushed(held)

    return work


def format_conversations(conversations: DataFrame, scratch: Scratch, template: Callable[[Sequence[Turn]], str] | None = None, *, learned: Sequence[str] = LEARNED, block: int = BLOCK, context: int = CONTEXT) -> DataFrame:
    """(conv_id, block, text, spans, n_turns, rewritten): the formatted text, a row for each block of a conversation."""
    turns = numbered(turns_of(conversations), scratch)
    own = F.expr(f"pos div {block}")
    # The last turns of a block also stand before the next one.
    ahead = F.expr(f"(pos + {context}) div {block}")
    dealt = turns.withColumn("block", F.explode(F.when(ahead > own, F.array(own, own + 1)).otherwise(F.array(own)))).select("conv_id", "block", "pos", "role", "text")
    sorted_ = dealt.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "pos")
    schema = "conv_id long, block long, text string, spans array<struct<start: long, end: long, loss_start: long, loss_end: long>>, n_turns long, rewritten long"
    # A block that would hold nothing but what stands before it has no turns of its own.
    return scratch.save(sorted_.mapInArrow(_rendered(template or InstTemplate(), learned, block), schema).filter("n_turns > 0"), "formatted")


# --- reading back ---------------------------------------------------------------------------------

_DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewritten long"


def _digests(template: InstTemplate):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = []
        names = [c.split()[0] for c in _DIGEST.split(", ")]
        # (conv_id, text, spans, rewritten), each conversation's blocks in order
        for conv, blocks in groupby(_rows(batches), key=lambda r: r[0]):
            every, learned = hashlib.sha256(), hashlib.sha256()
            n = loss = chars = rewritten = 0
            for _, text, spans, changed in blocks:
                for role, said in template.parse(text):
                    every.update(f"{role}\n{said}\n".encode())
                    n += 1
                for s in spans:
                    if s["loss_start"] is not None:
                        said = template.unescape(text[s["loss_start"] : s["loss_end"]])
                        learned.update(said.encode())
                        loss += len(said)
                chars += len(text)
                rewritten += changed
            done.append((conv, n, every.hexdigest(), loss, learned.hexdigest(), chars, rewritten))
            if len(done) == 4096:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in done])
                done = []
        if done:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in done])

    return work


def read_back(formatted: DataFrame, template: InstTemplate | None = None, *, block: int = BLOCK) -> DataFrame:
    """One row per conversation: what its formatted text holds, parsed again."""
    work = _digests(template or InstTemplate())
    alone = (F.col("block") == 0) & (F.col("n_turns") < block)
    short = formatted.filter(alone).select("conv_id", "text", "spans", "rewritten")
    long = formatted.filter(~alone).repartition("conv_id").sortWithinPartitions("conv_id", "block").select("conv_id", "text", "spans", "rewritten")
    return short.mapInArrow(work, _DIGEST).unionByName(long.mapInArrow(work, _DIGEST))


#: The query's added conversation: control strings inside texts.
PLANTED = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = spark.createDataFrame(PLANTED, "conv_id long, turn long, role string, text string")
    formatted = format_conversations(turns_of(table(spark, sf_dir, "conversations")).unionByName(added), Scratch(spark, "chat"))
    return read_back(formatted)


QUERIES = {"op12_chat_format": op12_chat_format}
