"""Spelling variants of words by a bit-sliced position index.

Words at one edit (one code point inserted, deleted or replaced) are found in
groups that agree outside a window.  Two words at one edit, the shorter of length
L, agree either up to the middle, and then the edit lies behind it, or from the
middle on; so a word enters, for every L it may stand in, one group per half.  A
group of too many words halves its window and deals its words to the two halves,
until it is small or its window is one letter.  Every pair meets in exactly one
group: in a left half only pairs that differ before its end count.

Within a group the words are numbered by falling frequency, and for every
(position, letter) of the window a bitset holds the words with that letter there.
A word's near words then come from word-parallel recurrences over its letters: one
bitset of the words without an error so far, and one per kind of the single error,
which reads the index at a position shifted by one.  The number of near words is a
popcount, the most frequent one the lowest bit; no pair is ever written out.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from crease.llm.common import cut, frugal, shuffle_width, small_batches

#: Shortest word, least number of occurrences, and how much more frequent a form is than its variant.
SHORTEST, LEAST, RATIO = 6, 5, 5
#: A run of text whose hash this divides loses one letter.
DROP = 199
#: Words of a group at most, while its window has more than one letter.
GROUP = 2048
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_HELD = 300_000


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST,
                drop: int | None = DROP) -> DataFrame:
    """``(word, n)``: occurrences of the words of ``shortest`` code points or more.

    Words are maximal runs of letters A-Z, a-z and U+00C0 to U+00FF, A-Z
    lower-cased.  Where ``drop`` divides h, the CRC-32 of ``<id>:<word>``, the
    run loses its code point h % length.  Null and empty texts have no words; the
    runs of a row without id are taken as they are; repeated rows count each.
    """
    small_batches(docs.sparkSession)
    runs = re.compile(f"[A-Za-zÀ-ÿ]{{{shortest},}}").findall

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                              ["word", "n"])

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                doc, own = doc.as_py(), {}
                for run in runs(text.as_py() or ""):
                    own[run] = own.get(run, 0) + 1
                low: dict[str, int] = {}
                for run, n in own.items():
                    run = run.lower() if run.isascii() else run.translate(_LOWER)
                    low[run] = low.get(run, 0) + n
                lead = zlib.crc32(f"{doc}:".encode())
                for run, n in low.items():
                    if drop and doc is not None:
                        h = zlib.crc32(run.encode(), lead)
                        if h % drop == 0:
                            at = h % len(run)
                            run = run[:at] + run[at + 1:]
                            if len(run) < shortest:
                                continue
                    held[run] = held.get(run, 0) + n
                if len(held) > _HELD:
                    yield out()
                    held = {}
        if held:
            yield out()

    return docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).mapInArrow(frugal(count), "word string, n long") \
        .groupBy("word").agg(F.sum("n").alias("n"))


def _placed(rows: DataFrame, a: Column, b: Column) -> DataFrame:
    """Rows (word, n, size, more) with a window and the hash of what a group agrees in.
    ``size`` is the length of the group's shorter words; a longer one has ``more`` = 1."""
    out = rows.withColumn("a", a.cast("int")).withColumn("b", b.cast("int"))
    word, start = F.col("word"), F.col("b") + F.col("more") + 1
    return out.withColumn("key", F.xxhash64("size", "a", "b", word.substr(F.lit(1), F.col("a")),
                                            word.substr(start, F.length(word))))


_KEY = ["size", "a", "b", "key"]


def _halves(rows: DataFrame) -> DataFrame:
    mid = F.floor((F.col("a") + F.col("b")) / 2)
    sides = rows.withColumn("left", F.explode(F.array(F.lit(True), F.lit(False)))) \
        .withColumn("u", F.when(F.col("left"), F.col("a")).otherwise(mid)) \
        .withColumn("v", F.when(F.col("left"), mid).otherwise(F.col("b"))) \
        .select("word", "n", "size", "more", "u", "v")
    return _placed(sides, F.col("u"), F.col("v")).drop("u", "v")


def groups(words: DataFrame, shortest: int = SHORTEST, most: int = GROUP) -> DataFrame:
    """(word, n, size, more, a, b, key): words dealt to groups of at most ``most``
    words, unless their window is one letter (then the alphabet bounds them)."""
    size = F.length("word")
    roles = words.select("word", "n", F.explode(F.array(
        F.struct(size.alias("size"), F.lit(0).alias("more")), F.struct((size - 1).alias("size"), F.lit(1).alias("more")))).alias("r")) \
        .select("word", "n", "r.size", "r.more").filter(F.col("size") >= max(2, shortest))
    open_ = cut(_halves(_placed(roles, F.lit(0), F.col("size"))))
    done = None
    while True:
        hot = cut(open_.filter(F.col("b") - F.col("a") > 1).groupBy(*_KEY).count().filter(F.col("count") > most).drop("count"))
        if hot.isEmpty():
            return open_ if done is None else done.unionByName(open_)
        small = open_.join(hot, _KEY, "left_anti").select(*open_.columns)
        done = small if done is None else done.unionByName(small)
        open_ = cut(_halves(open_.join(hot, _KEY, "left_semi").select(*open_.columns)))


def near_sets(members: list[tuple[str, int]], last: bool) -> list[int]:
    """Bitset of near words for each of the ``members`` (window's letters, 1 for
    the longer words): bit k stands for ``members[k]``.  ``last`` tells that the
    window reaches the end of the words; elsewhere an insertion at the window's
    end belongs to the right half."""
    index: dict[tuple[int, str], int] = {}
    shorts = longs = 0
    for k, (letters, more) in enumerate(members):
        bit = 1 << k
        if more:
            longs |= bit
        else:
            shorts |= bit
        for p, c in enumerate(letters):
            index[p, c] = index.get((p, c), 0) | bit
    at, out = index.get, []
    for letters, more in members:
        if more:
            same, less, before = shorts, 0, 0
            for p, c in enumerate(letters):
                less = (less & at((p - 1, c), 0)) | same  # c is the letter too many, or came before
                before, same = same, same & at((p, c), 0)
            out.append(less if last else less & ~before)
        else:
            same, other, gain = shorts | longs, 0, 0
            for p, c in enumerate(letters):
                here = at((p, c), 0)
                other = (other & here) | (same & ~here)
                gain = (gain | same) & at((p + 1, c), 0)  # the word's letter at p is one too many, or came before
                same &= here
            out.append((other & shorts) | ((gain | same if last else gain & ~same) & longs))
    return out


def near_words(words: DataFrame, shortest: int = SHORTEST, most: int = GROUP) -> DataFrame:
    """(word, n_near, near, near_n): the number of words at one edit and the most
    frequent of these (ties: the smallest in code-point order), for the words that
    have any.  ``words`` are distinct, with their number of occurrences ``n``."""
    dealt = groups(words, shortest, most).select(*_KEY, "more", "word", "n") \
        .repartition(shuffle_width(words.sparkSession), *_KEY).sortWithinPartitions(*_KEY)

    def one(size: int, a: int, b: int, held: list) -> Iterator[tuple]:
        by: dict[tuple, list] = {}
        for more, word, n in held:  # equal hashes, then equal letters outside the window
            by.setdefault((word[:a], word[b + more:]), []).append((-n, word, more))
        for members in by.values():
            if len(members) > 1:
                members.sort()
                found = near_sets([(w[a:b + more], more) for _, w, more in members], b == size)
                for (_, word, _), near in zip(members, found):
                    if near:
                        n, best, _ = members[(near & -near).bit_length() - 1]
                        yield word, near.bit_count(), best, -n

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            now, held = None, []
            for batch in batches:
                for size, a, b, key, more, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                    if (size, a, b, key) != now:
                        if len(held) > 1:
                            yield from one(*now[:3], held)
                        now, held = (size, a, b, key), []
                    held.append((more, word, n))
            if len(held) > 1:
                yield from one(*now[:3], held)

        def out(part: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), (
                pa.string(), pa.int64(), pa.string(), pa.int64()))], ["word", "n_near", "near", "near_n"])

        part: list = []
        for row in rows():
            part.append(row)
            if len(part) == 20_000:
                yield out(part)
                part = []
        if part:
            yield out(part)

    found = dealt.mapInArrow(frugal(search), "word string, n_near long, near string, near_n long")
    best = F.min(F.struct((-F.col("near_n")).alias("o"), F.col("near"))).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best) \
        .select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.o")).alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): the form of the form, and so on to the last.
    Pointers are doubled, so chains of c forms take log2(c) rounds; they end, as a
    form is always more frequent than its variant."""
    hops = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        on = hops.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = cut(hops.join(on, "root", "left"))
        if longer.filter(F.col("further").isNotNull()).isEmpty():
            return hops
        hops = longer.select("word", F.coalesce("further", "root").alias("root"))


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST, least: int = LEAST,
             ratio: int = RATIO, drop: int | None = DROP, most: int = GROUP) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)``, one row per distinct word of at
    least ``shortest`` code points and ``least`` occurrences.

    ``form`` is the near word of largest n (ties: the smallest in code-point order)
    if it has at least ``ratio`` times the word's n, else null; ``root`` the end of
    the chain of forms, the word itself if it has no form.  An empty table, and one
    of null and empty texts, gives no rows; very long texts are read whole, very
    long runs are words like others; columns but the two named are not read.
    """
    words = cut(word_counts(docs, id_col, text_col, shortest, drop).filter(F.col("n") >= least))
    near = near_words(words, shortest, most)
    is_form = F.col("near_n") >= ratio * F.col("n")
    known = cut(words.join(near, "word", "left").select(
        "word", F.when(is_form, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("near_n")).alias("form_n")))
    ends = roots(known.filter(F.col("form").isNotNull()))
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
