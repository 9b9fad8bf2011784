"""Prefix trie of conversations by the Euler-tour technique.

A node is a distinct sequence of first turns.  A turn's digest is keyed by its
depth, and the running sums of these digests name the sequences, so equal prefixes
of different conversations meet by one aggregate, however long they are.  A node is
then known by its smallest member and its depth.

Every node has an arc that enters it and an arc that leaves it; the arcs' order is
the Euler tour of the trie.  The tour is a linked list: an enter arc is followed by
that of the first child, an exit arc by the next sibling's enter arc or the parent's
exit arc.  The list is ranked distributedly (``list_totals``): chains within a piece
of a conversation are walked in their task, random splitters then shorten what is
left by pointer doubling until it is of bounded size, and the totals go back the
same way.  What a subtree holds is the difference of two totals: those at the arcs
that enter and leave it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from crease.llm.common import cut, shuffle_width
from crease.operators.scan import running_totals

#: Conversations share the turns of the first one of their hundred; h is a hash modulo SHARES.
HUNDRED, SHARES = 100, 6
#: Rows of one key that one window may hold; longer ones are scanned in blocks.
HOT = 100_000
#: Depths of a conversation that are walked together; one in SPLIT arcs is a splitter; arcs ranked in one task at most.
PIECE, SPLIT, BASE = 512, 16, 16_000
_SUMS = ["s0", "s1", "s2", "s3"]


def running(df: DataFrame, key: list[str], order: list[str], values: dict[str, Column], hot: int = HOT) -> DataFrame:
    """``df`` with the running sums of ``values`` over the rows of equal ``key`` up
    to and including the row.  Keys of more than ``hot`` rows are scanned in blocks of
    their order, the others by a window."""
    df = cut(df)
    big = cut(df.groupBy(*key).count().filter(F.col("count") > hot).drop("count"))
    window = Window.partitionBy(*key).orderBy(*[F.col(c).asc_nulls_first() for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    plain = lambda rows: rows.select("*", *[F.sum(v).over(window).alias(k) for k, v in values.items()])
    if big.isEmpty():
        return plain(df)
    blocked = running_totals(df.join(big, key, "left_semi").select(*df.columns), key, order, values, exclusive=False)
    return plain(df.join(big, key, "left_anti").select(*df.columns)).unionByName(blocked)


def rebuilt(turns: DataFrame, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, digest, chars) of the turns (role, text) of all rebuilt
    conversations, and (conv_id, n_turns) of the conversations, turnless ones too."""
    c = F.col("conv_id")
    rows = turns.filter(c.isNotNull()).select(
        c.cast("long").alias("conv_id"), F.col("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    share = F.crc32(c.cast("string")) % SHARES
    placed = running(rows, ["conv_id"], ["turn", "role", "text"], {"at": F.lit(1)}, hot).select(
        "conv_id", "at", F.sha2(F.concat_ws("\x1f", F.length("role"), "role", "text"), 256).alias("turn"),
        F.length("text").cast("long").alias("chars"))
    placed = cut(placed)
    sizes = placed.groupBy("conv_id").agg(F.max("at").alias("n")) \
        .select("conv_id", "n", share.alias("h"), (c - c % HUNDRED).alias("first"))
    lent = sizes.select(c.alias("first"), F.least("n", F.lit(SHARES)).alias("lent"))
    convs = cut(sizes.join(lent, "first", "left").select(
        "conv_id", "first", "h", F.least("h", F.coalesce("lent", F.lit(0))).cast("long").alias("taken"),
        F.greatest(F.col("n") - F.col("h"), F.lit(0)).alias("own")))
    shared = placed.filter((c % HUNDRED == 0) & (F.col("at") < SHARES)) \
        .select(c.alias("first"), "at", "turn", "chars")
    taken = convs.filter("taken > 0").select("conv_id", "first", "taken").join(shared, "first") \
        .filter(F.col("at") <= F.col("taken")).select("conv_id", F.col("at").alias("depth"), "turn", "chars")
    own = placed.filter(F.col("at") > share).join(convs.filter("own > 0").select("conv_id", "h", "taken"), "conv_id") \
        .select("conv_id", (F.col("at") - F.col("h") + F.col("taken")).alias("depth"), "turn", "chars")
    both = taken.unionByName(own).select(
        "conv_id", F.col("depth").cast("long").alias("depth"), F.xxhash64("depth", "turn").alias("x"),
        F.xxhash64("turn", "depth", F.lit(1)).alias("y"), "chars")
    return both, convs.select("conv_id", (F.col("taken") + F.col("own")).cast("long").alias("n_turns"))


def nodes(turns: DataFrame, convs: DataFrame, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """(depth, conv_id, parent_conv_id, n_convs, chars) of all nodes, and (depth,
    conv_id, ends_sha256) of those where conversations end."""
    half = lambda name, k: (F.shiftrightunsigned(name, 32) if k else F.col(name).bitwiseAND(F.lit((1 << 32) - 1)))
    parts = {"s0": half("x", 0), "s1": half("x", 1), "s2": half("y", 0), "s3": half("y", 1)}
    sums = running(turns, ["conv_id"], ["depth"], parts, hot)
    above = [(F.col(s) - parts[s]).alias(f"p{s[1]}") for s in _SUMS]
    path = cut(sums.select("conv_id", "depth", "chars", *_SUMS, *above))
    grown = path.groupBy("depth", *_SUMS).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"),
        *[F.max(f"p{k}").alias(f"p{k}") for k in range(4)])
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0").select(
        F.lit(0).cast("long").alias("depth"), *[F.lit(0).cast("long").alias(s) for s in _SUMS], "conv_id", "n_convs",
        F.lit(0).cast("long").alias("chars"), *[F.lit(0).cast("long").alias(f"p{k}") for k in range(4)])
    named = cut(root.unionByName(grown))
    parents = named.select((F.col("depth") + 1).alias("depth"), *[F.col(s).alias(f"p{s[1]}") for s in _SUMS],
                           F.col("conv_id").alias("parent_conv_id"))
    known = named.join(parents, ["depth", "p0", "p1", "p2", "p3"], "left") \
        .select("depth", "conv_id", "parent_conv_id", "n_convs", "chars")
    ended = path.join(convs.select("conv_id", F.col("n_turns").alias("depth")), ["conv_id", "depth"]).select("depth", *_SUMS, "conv_id")
    turnless = convs.filter("n_turns = 0").select(F.lit(0).cast("long").alias("depth"), *[F.lit(0).cast("long").alias(s) for s in _SUMS],
                                                  "conv_id")
    digests = _end_digests(ended.unionByName(turnless))
    return known, digests.join(named, ["depth", *_SUMS]).select("depth", "conv_id", "ends_sha256")


def _end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 over the sorted ids per node, read as a stream: a node where very
    many conversations end is one digest by its definition, but never held whole."""
    keys = ["depth", *_SUMS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, done = None, None, []
        for batch in batches:
            for *key, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if key != now:
                    if digest is not None:
                        done.append((*now, digest.hexdigest()))
                    now, digest = key, hashlib.sha256(str(conv).encode())
                else:
                    digest.update(f",{conv}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], [*keys, "ends_sha256"])
                done = []
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*now, digest.hexdigest())], [*keys, "ends_sha256"])

    return ends.repartition(shuffle_width(ends.sparkSession), *keys).sortWithinPartitions(*keys, "conv_id") \
        .mapInArrow(run, "depth long, s0 long, s1 long, s2 long, s3 long, ends_sha256 string")


def tour(known: DataFrame, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """The nodes with ``n_children``, and the Euler tour as a linked list: arcs
    (c, q), q = 2 * depth and 1 more for the exit arc, the arc after them (nc, nq;
    null at the tour's end), and what they weigh: leaves and tokens saved."""
    children = known.filter("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("parent_conv_id").alias("conv_id"),
                                                F.col("conv_id").alias("child"))
    families = children.groupBy("depth", "conv_id").agg(F.count(F.lit(1)).alias("n_children"), F.min("child").alias("eldest"))
    full = cut(known.join(families, ["depth", "conv_id"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")))
    ordered = cut(running(children, ["depth", "conv_id"], ["child"], {"place": F.lit(1)}, hot))
    younger = ordered.select("depth", "conv_id", (F.col("place") - 1).alias("place"), F.col("child").alias("next"))
    after = ordered.join(younger, ["depth", "conv_id", "place"], "left") \
        .select((F.col("depth") + 1).alias("depth"), F.col("child").alias("conv_id"), F.col("conv_id").alias("parent"), "next")
    q, leaf = F.col("depth") * 2, F.col("n_children") == 0
    enter = full.select(
        F.col("conv_id").alias("c"), q.alias("q"), F.when(leaf, F.col("conv_id")).otherwise(F.col("eldest")).alias("nc"),
        F.when(leaf, q + 1).otherwise(q + 2).alias("nq"), leaf.cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    leave = full.select("depth", "conv_id").join(after, ["depth", "conv_id"], "left").select(
        F.col("conv_id").alias("c"), (q + 1).alias("q"), F.coalesce("next", "parent").alias("nc"),
        F.when(F.col("next").isNotNull(), q).when(F.col("parent").isNotNull(), q - 1).alias("nq"),
        F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"))
    return full, enter.unionByName(leave)


_ARC = "c long, q long, nc long, nq long, leaves long, saved long"


def _walked(arcs: DataFrame, piece: int) -> DataFrame:
    """Every arc with the first arc after it outside its piece (of ``piece`` depths
    of one conversation) and the weights up to there; ``head`` where no arc of the
    piece comes before it."""
    span = 2 * piece

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*_ARC.replace(" long", "").split(", "), "head"]

        def one(held: list) -> list:
            at = {(r[0], r[1]): r for r in held}
            inner = {(r[2], r[3]) for r in held if (r[2], r[3]) in at}
            done: dict[tuple, tuple] = {}
            for start in at:
                trail, here = [], start
                while here in at and here not in done:
                    trail.append(here)
                    here = at[here][2:4]
                total = done[here] if here in done else (*here, 0, 0)
                for k in reversed(trail):
                    total = (total[0], total[1], total[2] + at[k][4], total[3] + at[k][5])
                    done[k] = total
            return [(*k, *v, k not in inner) for k, v in done.items()]

        now, held, done = None, [], []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if (row[0], row[1] // span) != now:
                    done += one(held)
                    now, held = (row[0], row[1] // span), []
                held.append(row)
            if len(done) > 10_000:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64() if k < 6 else pa.bool_()) for k, c in enumerate(zip(*done))], names)
                done = []
        done += one(held)
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64() if k < 6 else pa.bool_()) for k, c in enumerate(zip(*done))], names)

    piece_of = F.floor(F.col("q") / span)
    return arcs.select(*_ARC.replace(" long", "").split(", ")).repartition(shuffle_width(arcs.sparkSession), "c", piece_of) \
        .sortWithinPartitions("c", "q").mapInArrow(run, _ARC + ", head boolean")


def _ranked(arcs: DataFrame) -> DataFrame:
    """Totals of a list of bounded size, in one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        after = {}
        for batch in batches:
            for c, q, nc, nq, leaves, saved in zip(*(x.to_pylist() for x in batch.columns)):
                after[nc, nq] = (c, q, leaves, saved)
        here, one, two, out = (None, None), 0, 0, []
        while here in after:
            c, q, leaves, saved = after[here]
            one, two, here = one + leaves, two + saved, (c, q)
            out.append((c, q, one, two))
        if len(out) != len(after):
            raise RuntimeError("the tour is no list")
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], ["c", "q", "leaves", "saved"])

    return arcs.select("c", "q", "nc", "nq", "leaves", "saved").repartition(1).mapInArrow(run, "c long, q long, leaves long, saved long")


def list_totals(arcs: DataFrame, base: int = BASE, split: int = SPLIT, piece: int = PIECE, turn: int = 0) -> DataFrame:
    """(c, q, leaves, saved): for every arc of the list the weights from it to the
    list's end.  The first call walks pieces, the further ones pick splitters by a
    hash; every call ranks a list some times shorter than its own."""
    if turn == 0:
        links = cut(_walked(arcs, piece))
    else:
        if arcs.count() <= base:
            return cut(_ranked(arcs))
        first = arcs.select("c", "q").join(arcs.select(F.col("nc").alias("c"), F.col("nq").alias("q")), ["c", "q"], "left_anti")
        chosen = F.pmod(F.xxhash64("c", "q", F.lit(turn)), F.lit(split)) == 0
        start = arcs.join(first.withColumn("first", F.lit(True)), ["c", "q"], "left") \
            .select("c", "q", "nc", "nq", "leaves", "saved", (chosen | F.col("first").isNotNull()).alias("head"))
        stops = F.pmod(F.xxhash64("nc", "nq", F.lit(turn)), F.lit(split)) == 0
        now, ready = cut(start.withColumn("done", F.col("nc").isNull() | stops)), []
        while True:  # pointer doubling up to the next splitter
            ready.append(now.filter("done").drop("done"))
            rest = now.filter(~F.col("done"))
            if rest.isEmpty():
                break
            on = now.select(F.col("c").alias("nc"), F.col("q").alias("nq"), F.col("nc").alias("tc"), F.col("nq").alias("tq"),
                            F.col("leaves").alias("tl"), F.col("saved").alias("ts"), F.col("done").alias("td"))
            settled = reduce(DataFrame.unionByName, ready[:-1]).select(
                F.col("c").alias("nc"), F.col("q").alias("nq"), F.col("nc").alias("tc"), F.col("nq").alias("tq"),
                F.col("leaves").alias("tl"), F.col("saved").alias("ts"), F.lit(True).alias("td")) if len(ready) > 1 else None
            on = on if settled is None else on.unionByName(settled)
            now = cut(rest.join(on, ["nc", "nq"]).select(
                "c", "q", F.col("tc").alias("nc"), F.col("tq").alias("nq"), (F.col("leaves") + F.col("tl")).alias("leaves"),
                (F.col("saved") + F.col("ts")).alias("saved"), "head", F.col("td").alias("done")))
        links = reduce(DataFrame.unionByName, ready)
    further = list_totals(links.filter("head").drop("head"), base, split, piece, turn + 1) \
        .select(F.col("c").alias("nc"), F.col("q").alias("nq"), F.col("leaves").alias("tl"), F.col("saved").alias("ts"))
    return cut(links.join(further, ["nc", "nq"], "left").select(
        "c", "q", (F.col("leaves") + F.coalesce("tl", F.lit(0))).alias("leaves"),
        (F.col("saved") + F.coalesce("ts", F.lit(0))).alias("saved")))


def prefix_trie(turns: DataFrame, hot: int = HOT, base: int = BASE, split: int = SPLIT, piece: int = PIECE) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations: ``(conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``.

    ``turns`` has conv_id, turn, role and text; other columns are not read.  Turns
    are ordered by turn (null first), of equal ones by role, then text; repeated rows
    are turns of their own; null roles and texts are empty.  Rows without conv_id
    take no part.  An empty table has no node.  Very long texts are read once, as
    digests; a very long conversation is scanned and walked in pieces.
    """
    paths, convs = rebuilt(turns, hot)
    known, ends = nodes(paths, convs, hot)
    full, arcs = tour(cut(known), hot)
    totals = list_totals(arcs, base, split, piece)
    sign = F.when(F.col("q") % 2 == 0, 1).otherwise(-1)
    held = totals.groupBy(F.col("c").alias("conv_id"), F.floor(F.col("q") / 2).alias("depth")).agg(
        F.sum(sign * F.col("leaves")).alias("n_leaves"), F.sum(sign * F.col("saved")).alias("saved_tokens"))
    nobody = hashlib.sha256(b"").hexdigest()
    return full.join(held, ["conv_id", "depth"]).join(ends, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(nobody)).alias("ends_sha256"))
