"""A prefix trie of conversations by distributed MSD radix partitioning.

Each node is a distinct sequence of first turns (role, text); its members are the conversations that begin with it.

1. Turns get dictionary ids: distinct turns by a 256-bit digest, numbered once in a written table.
2. Conversations of one sequence are one class (its smallest id, with a count): equal exclusive sums of two 64-bit hashes of
   (depth, id) and of equal length.  So however many copies there are, one of them is partitioned.
3. Buckets are nodes with at least two classes that go on.  A bucket of more than LOCAL classes is dealt by its next turn's
   id, a digit that is summed before it is moved; smaller ones are local: a task takes their next WINDOW ids and
   finishes them by multikey quicksort, whose recursion into equal ids emits nodes.  Groups that are still equal at the
   window's end are buckets of the next round.  A class alone in its bucket needs no sorting: the rest of its
   sequence is a chain, whose nodes are rows of the turns' table.
4. Sums over subtrees need no walk: a node stands at the smallest of its classes, and a class's own nodes are the
   lower end of its path, so a node's sum is that of its members' own ones.

A node's ends are one class (equal sequences), so its digest is made once for a class, streamed in order of conv_id.

Rounds: as many as the deepest node with more than LOCAL different classes, and one for each WINDOW turns that fewer share.

Edge cases: null role or text is empty; a null turn comes first, equal ones go by role, then text; rows of a null conv_id take no
part; repeated rows are turns of their own; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from readloom.llm.scratch import Scratch
from readloom.llm.tables import table
from readloom.llm.turns import numbered, turns_of

#: Classes of a bucket that one task sorts at most, and ids that it takes of each.
LOCAL, WINDOW = 2048, 32

# --- the sequences --------------------------------------------------------------------------------


def encoded(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, pos, end, id, chars): turns as dictionary ids; end counts code points up to a turn's end."""
    turns = numbered(turns_of(conversations).filter("conv_id is not null"), scratch)
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))
    told = scratch.save(turns.select("conv_id", "pos", "end", F.length("text").cast("long").alias("chars"), digest.alias("digest")), "told")
    names = scratch.save(told.groupBy("digest").agg(F.lit(1)).select("digest", F.monotonically_increasing_id().alias("id")), "dictionary")
    return scratch.save(told.join(names.hint("merge"), "digest").select("conv_id", "pos", "end", "id", "chars"), "encoded")


def with_shared_starts(turns: DataFrame, head: Column, starts: Column, most: int, scratch: Scratch) -> DataFrame:
    """(c, depth, id, chars, upto) of each conversation's rebuilt sequence, from its root (depth 0) on.

    The first starts (most at most) turns are those of conversation `head`, a column of conv_id (all of its turns if fewer,
    none if it is absent); the conversation's own follow after as many of its first.
    """
    lengths = turns.groupBy("conv_id").agg(F.count("*").alias("n"), F.max("end").alias("total"))
    heads = turns.filter(F.col("pos") < most)
    sizes = heads.groupBy("conv_id").agg(F.count("*").alias("have"))
    convs = lengths.select("conv_id", head.alias("head"), starts.cast("long").alias("starts"))
    held = convs.join(sizes.select(F.col("conv_id").alias("head"), "have"), "head", "left").select("conv_id", "head", "starts", F.least("starts", F.coalesce("have", F.lit(0))).alias("taken"))
    first = heads.select(F.col("conv_id").alias("head"), "pos", F.col("end").alias("upto"), "id", "chars")
    led = held.join(first, "head").filter("pos < taken").select(F.col("conv_id").alias("c"), (F.col("pos") + 1).alias("depth"), "id", "chars", "upto")
    led = scratch.save(led.unionByName(held.select(F.col("conv_id").alias("c"), F.lit(0).cast("long").alias("depth"), F.lit(-1).cast("long").alias("id"), F.lit(0).cast("long").alias("chars"), F.lit(0).cast("long").alias("upto"))), "led")
    lead = led.groupBy("c").agg(F.max("upto").alias("led"))
    skipped = turns.filter(F.col("pos") < most).groupBy("conv_id").agg(F.collect_list(F.struct("pos", "end")).alias("ends"))  # `most` at most
    shift = held.join(lead, F.col("conv_id") == F.col("c")).join(skipped, "conv_id")
    own_start = F.coalesce(F.array_max(F.transform(F.filter("ends", lambda e: e.pos < F.col("starts")), lambda e: e.end)), F.lit(0))
    shift = shift.select("conv_id", "starts", "taken", (F.col("led") - own_start).alias("ahead"))
    own = turns.join(shift.hint("merge"), "conv_id").filter("pos >= starts")
    own = own.select(F.col("conv_id").alias("c"), (F.col("taken") + F.col("pos") - F.col("starts") + 1).alias("depth"), "id", "chars", (F.col("end") + F.col("ahead")).alias("upto"))
    return scratch.save(led.unionByName(own), "sequences")


# --- local buckets --------------------------------------------------------------------------------


def multikey_nodes(names: list[int], keys: list[list[int]]) -> Iterator[tuple[int, list[int], int]]:
    """(depth, members, smallest name) of each group of at least two strings that are equal in their first `depth` keys.

    Three-way radix quicksort: of the strings of a bucket, those with the pivot's key at its depth go on together to the
    next depth, where they are a node; the smaller and the larger ones stay.
    """
    stack = [(list(range(len(names))), 0)]
    while stack:
        members, depth = stack.pop()
        while len(members) > 1:
            going = [m for m in members if len(keys[m]) > depth]
            if len(going) < 2:
                break
            # The median of three.
            pivot = sorted((keys[going[0]][depth], keys[going[len(going) // 2]][depth], keys[going[-1]][depth]))[1]
            less, equal, more = [], [], []
            for m in going:
                key = keys[m][depth]
                (equal if key == pivot else less if key < pivot else more).append(m)
            if len(equal) > 1:
                yield depth + 1, equal, min(names[m] for m in equal)
                stack.append((equal, depth + 1))
            if len(less) > 1:
                stack.append((less, depth))
            members = more


def _finished(window: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = [], [], []

        def flushed() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(np.array(v, np.int64)) for v in out], ["c", "depth", "node"])
            for v in out:
                v.clear()
            return made

        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        # (depth of the bucket, its node, c, depth, id), sorted
        for (base, _), bucket in groupby(rows, key=lambda r: r[:2]):
            names, keys = [], []
            for c, own in groupby(bucket, key=lambda r: r[2]):
                names.append(c)
                keys.append([r[4] for r in own])
            for depth, members, least in multikey_nodes(names, keys):
                out[0].extend(names[m] for m in members)
                out[1].extend([base + depth] * len(members))
                out[2].extend([least] * len(members))
            if len(out[0]) > 50_000:
                yield flushed()
        yield flushed()

    return work


# --- the trie -------------------------------------------------------------------------------------


def shared_paths(sequences: DataFrame, classes: DataFrame, scratch: Scratch, local: int = LOCAL, window: int = WINDOW) -> DataFrame:
    """(c, depth, node): for each class the nodes on its path that at least two classes share, each named by its smallest.

    sequences: (c, depth, id); classes: (c, length).
    """
    everyone = classes.agg(F.min("c").alias("node"), F.count("*").alias("several")).filter("several > 1")
    first = classes.crossJoin(F.broadcast(everyone)).select("c", F.lit(0).cast("long").alias("depth"), "node", "length")  # one row
    live = scratch.save(first, "paths-0")
    paths, round_ = live.select("c", "depth", "node"), 0
    while True:
        round_ += 1
        # Those that end at their node go no further.
        going = live.filter("length > depth")
        sizes = going.groupBy("depth", "node").agg(F.count("*").alias("size")).filter("size > 1")
        sized = scratch.save(going.join(sizes, ["depth", "node"]), f"going-{round_}")
        if sized.isEmpty():
            break
        nexts = sequences.select(F.col("c").alias("of"), F.col("depth").alias("at"), "id")
        # Large buckets: dealt by the id of the next turn.
        large = sized.filter(F.col("size") > local).join(nexts, (F.col("of") == F.col("c")) & (F.col("at") == F.col("depth") + 1)).select("c", "depth", "node", "length", "id")
        large = scratch.save(large, f"large-{round_}")
        digits = large.groupBy("depth", "node", "id").agg(F.min("c").alias("least"), F.count("*").alias("size")).filter("size > 1")
        dealt = large.join(digits, ["depth", "node", "id"]).select("c", (F.col("depth") + 1).alias("depth"), F.col("least").alias("node"), "length", F.lit(True).alias("open"))
        # Small buckets: finished by a task each, as far as the window goes.
        small = sized.filter(F.col("size") <= local).select("c", "depth", "node", "length")
        ids = small.join(nexts, (F.col("of") == F.col("c")) & (F.col("at") > F.col("depth")) & (F.col("at") <= F.col("depth") + window)).select("depth", "node", "c", "at", "id")
        ids = ids.repartition("depth", "node").sortWithinPartitions("depth", "node", "c", "at")
        done = ids.mapInArrow(_finished(window), "c long, depth long, node long")
        last = small.select(F.col("c").alias("of"), (F.col("depth") + window).alias("edge"), "length")
        done = done.join(last, F.col("of") == F.col("c")).select("c", "depth", "node", "length", (F.col("depth") == F.col("edge")).alias("open"))
        found = scratch.save(dealt.unionByName(done), f"paths-{round_}")
        scratch.drop(f"going-{round_}", f"large-{round_}")
        paths = paths.unionByName(found.select("c", "depth", "node"))
        live = found.filter("open").select("c", "depth", "node", "length")
    return scratch.save(paths, "paths")


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(c, digest) of each class's members, which come in order."""
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
    done = []
    for c, members in groupby(rows, key=lambda r: r[0]):
        digest = hashlib.sha256()
        for i, (_, member) in enumerate(members):
            digest.update(f"{',' if i else ''}{member}".encode())
        done.append({"c": c, "ends": digest.hexdigest()})
        if len(done) == 4096:
            yield pa.RecordBatch.from_pylist(done)
            done = []
    if done:
        yield pa.RecordBatch.from_pylist(done)


def prefix_trie(sequences: DataFrame, scratch: Scratch, *, local: int = LOCAL, window: int = WINDOW) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    sequences: (c, depth, id, chars, upto), depths from 0 (the root) on without gaps; upto sums chars.
    """
    hashes = [F.bit_xor(F.xxhash64("depth", "id", F.lit(s))).alias(f"h{s}") for s in (1, 2)]
    each = scratch.save(sequences.groupBy("c").agg(F.max("depth").alias("length"), F.max("upto").alias("total"), *hashes), "each")
    alike = ["length", "h1", "h2"]
    reps = scratch.save(each.groupBy(*alike).agg(F.min("c").alias("rep"), F.count("*").alias("weight"), F.first("total").alias("total")), "reps")
    members = each.join(reps, alike).select("rep", "c")
    alone = F.sha2(F.col("c").cast("string"), 256)
    # A class of one needs no sorting.
    single = reps.filter("weight = 1").select(F.col("rep").alias("c")).select("c", alone.alias("ends"))
    copies = members.join(reps.filter("weight > 1").select("rep"), "rep", "left_semi").select(F.col("rep").alias("g"), F.col("c").alias("m"))
    ends = single.unionByName(copies.repartition("g").sortWithinPartitions("g", "m").mapInArrow(_ends, "c long, ends string"))
    ends = scratch.save(ends, "ends")

    classes = reps.select(F.col("rep").alias("c"), "length", "weight", "total")
    own = scratch.save(sequences.join(classes.select("c").hint("merge"), "c", "left_semi"), "own")
    paths = shared_paths(own, classes.select("c", "length"), scratch, local, window)

    # Of each class: the last node that it shares, and what its own chain below that saves.
    last = paths.groupBy("c").agg(F.max("depth").alias("shared"), F.max_by("node", "depth").alias("at"))
    known = classes.join(last, "c", "left").select("c", "length", "weight", "total", F.coalesce("shared", F.lit(-1)).alias("shared"), "at")
    upto = own.select(F.col("c").alias("of"), F.col("depth").alias("d"), F.col("upto").alias("passed"))
    known = known.join(upto, (F.col("of") == F.col("c")) & (F.col("d") == F.col("shared")), "left")
    chain = (F.col("weight") - 1) * (F.col("total") - F.coalesce("passed", F.lit(0)))
    known = scratch.save(known.select("c", "length", "weight", "total", "shared", "at", chain.alias("chain")), "known")

    # Shared nodes.
    nodes = paths.join(known.select("c", "weight", "length", "shared"), "c")
    nodes = nodes.groupBy("depth", "node").agg(F.sum("weight").alias("n_convs"), F.sum((F.col("length") > F.col("shared")).cast("long")).alias("n_leaves"), F.sum(((F.col("shared") == F.col("depth")) & (F.col("length") > F.col("shared"))).cast("long")).alias("tails"))
    lengths = own.select(F.col("c").alias("node"), "depth", "chars")
    nodes = scratch.save(nodes.join(lengths, ["depth", "node"]).withColumn("own_saved", (F.col("n_convs") - 1) * F.col("chars")).drop("chars"), "nodes")
    above = paths.select(F.col("c").alias("node"), (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"))
    parents = scratch.save(nodes.select("depth", "node").join(above, ["depth", "node"], "left"), "parents")
    children = parents.filter("parent is not null").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("node")).agg(F.count("*").alias("forks"))
    below = Window.partitionBy("node").orderBy(F.desc("depth"))
    # What a class's own nodes save, from a depth down, and all of them together with its chain.
    runs = nodes.select("node", "depth", F.sum("own_saved").over(below).alias("down"))
    whole = nodes.groupBy(F.col("node").alias("c")).agg(F.sum("own_saved").alias("held"))
    whole = known.select("c", "chain").join(whole, "c", "left").select("c", "chain", (F.col("chain") + F.coalesce("held", F.lit(0))).alias("everything"))
    others = paths.join(whole, "c").groupBy("depth", "node").agg(F.sum(F.when(F.col("c") == F.col("node"), F.col("chain")).otherwise(F.col("everything"))).alias("others"))
    ending = known.filter("length = shared").join(ends, "c").select(F.col("shared").alias("depth"), F.col("at").alias("node"), "ends")
    nothing = F.sha2(F.lit(""), 256)
    full = nodes.join(parents, ["depth", "node"]).join(children, ["depth", "node"], "left").join(runs, ["depth", "node"]).join(others, ["depth", "node"]).join(ending, ["depth", "node"], "left")
    many = full.select(
        F.col("node").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", (F.coalesce("forks", F.lit(0)) + F.col("tails")).alias("n_children"), "n_leaves",
        (F.col("down") + F.col("others")).alias("saved_tokens"), F.coalesce("ends", nothing).alias("ends_sha256"),
    )

    # Chains: every row of a class beyond the last node that it shares.
    row = own.join(known.join(ends, "c").hint("merge"), "c").filter("depth > shared")
    parent = F.when(F.col("depth") == 0, None).when(F.col("depth") == F.col("shared") + 1, F.col("at")).otherwise(F.col("c"))
    chains = row.select(
        F.col("c").alias("conv_id"), "depth", parent.alias("parent_conv_id"), F.col("weight").alias("n_convs"), (F.col("depth") < F.col("length")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        ((F.col("weight") - 1) * (F.col("total") - F.col("upto") + F.col("chars"))).alias("saved_tokens"), F.when(F.col("depth") == F.col("length"), F.col("ends")).otherwise(nothing).alias("ends_sha256"),
    )
    return many.unionByName(chains)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "trie")
    turns = encoded(table(spark, sf_dir, "conversations"), scratch)
    head = F.col("conv_id") - F.expr("conv_id % 100")
    starts = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    return prefix_trie(with_shared_starts(turns, head, starts, 5, scratch), scratch)


QUERIES = {"op13_prefix_trie": op13_prefix_trie}
