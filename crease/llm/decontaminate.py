"""Benchmark decontamination: size-partitioned MinHash containment search for
short test items inside documents of any length, verified by exact shingle
containment.

Items are partitioned by their number of shingles into classes [2**c, 2**(c+1)).
For a class, a document is read as windows of two adjacent blocks of 2**(c+1)
shingles, so every run as long as an item of the class lies whole in a window,
and a window is at most eight times an item: containment ``t`` then means a
Jaccard similarity of at least ``j(t)``, and the number of MinHash bands (of one
row, as ``j`` is small) follows from ``j`` and the target recall.  Documents are
mapped only, never shuffled; what goes to every task are slices of items of a
fixed size, pass by pass.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from crease.llm.common import frugal, small_batches
from crease.llm.shingles import SHINGLE, mix, shingle_hashes, words_of

CONTAINMENT, RECALL = 0.8, 0.9995
#: Items and code points of one pass: with at most 64 bands their tables take under 20 MB, their texts as much.
SLICE, SLICE_CHARS = 20_000, 20_000_000
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_BATCH = 400_000


def band_count(containment: float = CONTAINMENT, recall: float = RECALL) -> int:
    """Bands of one row that find an item of 2**c of 2**(c+2) shingles with the
    wanted recall, ``containment`` of it being there."""
    jaccard = containment / (4 + 1 - containment)
    return math.ceil(math.log(1 - recall) / math.log(1 - jaccard))


class Index:
    """A slice of items: shingle sets and, by size class and band, their MinHash
    values.  An item of fewer words than a shingle is one gram of all its words,
    looked up among a document's grams of that length (``short``)."""

    def __init__(self, items: list[tuple], n: int, containment: float, recall: float):
        self.ids, self.sets = [], []
        short: dict[int, dict[int, list]] = {}
        for item, text in items:
            hashes = np.unique(shingle_hashes(text, n))
            if len(hashes):
                self.ids.append(item)
                self.sets.append(hashes)
            elif words := len(words_of(text)):
                short.setdefault(words, {}).setdefault(int(shingle_hashes(text, words)[0]), []).append(item)
        self.short = {words: (np.array(sorted(grams), np.uint64), grams) for words, grams in short.items()}
        self.n, self.containment = n, containment
        self.factors = mix(np.arange(1, band_count(containment, recall) + 1, dtype=np.uint64)) | np.uint64(1)
        sizes = np.array([len(s) for s in self.sets], np.int64)
        self.classes = {}
        for c in sorted({int(s).bit_length() - 1 for s in sizes}):
            own = np.flatnonzero((sizes >> c) == 1)
            low = np.array([[((self.sets[i] * f) >> np.uint64(32)).min() for i in own] for f in self.factors], np.uint32)
            order = np.argsort(low, axis=1, kind="stable")
            bits = min(24, max(16, int(len(own)).bit_length() + 7))
            maps = np.zeros((len(self.factors), 1 << bits), bool)
            for k, row in enumerate(low):
                maps[k, row & ((1 << bits) - 1)] = True
            self.classes[c] = (own[order], np.take_along_axis(low, order, axis=1), maps)

    def candidates(self, docs: list[np.ndarray]) -> set[tuple[int, int]]:
        """Pairs (document, item) that share a MinHash value in some window."""
        found: set[tuple[int, int]] = set()
        if not self.classes or not docs:
            return found
        least = min(self.classes) + 1
        unit = 1 << least
        blocks = np.array([-(-len(d) // unit) for d in docs], np.int64)
        flat = np.full(int(blocks.sum()) * unit, _NONE, np.uint64)
        owner = np.repeat(np.arange(len(docs)), blocks)
        at = np.concatenate(([0], np.cumsum(blocks)))
        for start, d in zip((at * unit).tolist(), docs):
            flat[start:start + len(d)] = d
        empty = flat == _NONE
        for k, factor in enumerate(self.factors):
            low = ((flat * factor) >> np.uint64(32)).astype(np.uint32)
            low[empty] = 0xFFFFFFFF
            low, doc, starts = low.reshape(-1, unit).min(axis=1), owner, at
            for c in range(least - 1, max(self.classes) + 1):
                if c >= least:  # blocks of twice the size, each within its document
                    sizes = -(-np.diff(starts) // 2)
                    grown = np.concatenate(([0], np.cumsum(sizes)))
                    first = np.repeat(starts[:-1] - 2 * grown[:-1], sizes) + 2 * np.arange(int(sizes.sum()))
                    second = np.minimum(first + 1, np.repeat(starts[1:] - 1, sizes))
                    low, doc, starts = np.minimum(low[first], low[second]), np.repeat(np.arange(len(docs)), sizes), grown
                if c in self.classes:
                    window = low.copy()
                    pair = doc[1:] == doc[:-1]
                    window[:-1][pair] = np.minimum(low[:-1], low[1:])[pair]
                    order, values, maps = self.classes[c]
                    hit = np.flatnonzero(maps[k][window & (maps.shape[1] - 1)])
                    if len(hit):
                        left = np.searchsorted(values[k], window[hit], "left")
                        right = np.searchsorted(values[k], window[hit], "right")
                        for h, a, b in zip(hit[right > left].tolist(), left[right > left].tolist(),
                                           right[right > left].tolist()):
                            found.update((int(doc[h]), int(i)) for i in order[k, a:b])
        return found

    def short_items(self, text: str | None) -> Iterator[tuple[object, float]]:
        """(item id, 1) of the items of few words that stand in a text."""
        for words, (grams, items) in self.short.items():
            for gram in np.intersect1d(shingle_hashes(text, words), grams).tolist():
                yield from ((i, 1.0) for i in items[gram])

    def search(self, docs: list[np.ndarray]) -> Iterator[tuple[int, object, float]]:
        """(document, item id, containment) of the candidates that hold."""
        at, own = -1, None
        for d, i in sorted(self.candidates(docs)):
            if d != at:
                at, own = d, np.unique(docs[d])
            place = np.searchsorted(own, self.sets[i])
            share = float((own[np.minimum(place, len(own) - 1)] == self.sets[i]).mean())
            if share >= self.containment:
                yield d, self.ids[i], share


def _slices(items: DataFrame, item_col: str, text_col: str, size: int) -> Iterator[list[tuple]]:
    """The distinct items in slices of at most ``size``, and of ``SLICE_CHARS`` and one more text."""
    rows = items.select(F.col(item_col), F.col(text_col)).dropna().distinct()
    part, chars = [], 0
    for row in rows.toLocalIterator():
        part.append((row[0], row[1]))
        chars += len(row[1])
        if len(part) == size or chars >= SLICE_CHARS:
            yield part
            part, chars = [], 0
    if part:
        yield part


def _matches(docs: DataFrame, text_col: str, items: DataFrame, item_col: str, item_text: str, n: int,
             containment: float, recall: float, slice_items: int):
    """For each slice, a function Arrow batch -> [(row, item id, containment)]."""
    spark = docs.sparkSession
    small_batches(spark)

    def searcher(part):
        shared = spark.sparkContext.broadcast(part)

        def make():
            index = Index(shared.value, n, containment, recall)

            def search(texts) -> list[tuple]:
                out, first, group, size = [], 0, [], 0
                for k, text in enumerate(texts):
                    text = text.as_py()
                    out += [(k, i, s) for i, s in index.short_items(text)]
                    group.append(shingle_hashes(text, n))
                    size += len(group[-1])
                    if size >= _BATCH or k == len(texts) - 1:
                        out += [(first + d, i, s) for d, i, s in index.search(group)]
                        first, group, size = k + 1, [], 0
                return out

            return search

        return make

    return [searcher(part) for part in _slices(items, item_col, item_text, slice_items)]


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", item_text: str = "text", n: int = SHINGLE,
                    containment: float = CONTAINMENT, recall: float = RECALL, slice_items: int = SLICE) -> DataFrame:
    """``(id_col, item_col, containment)``: for every row of ``docs`` the items
    of which it holds at least ``containment`` of the shingles.

    An item of fewer than ``n`` words is found where its words stand one after the
    other.  Null and empty texts, null items and items without words match nothing;
    very long texts are read whole; a repeated document row or an item id with
    several texts gives a row each; an empty table on either side gives no rows.  If
    both ids have one name, the item's is lengthened by ``_item``; other columns
    are not read.
    """
    item_out = f"{item_col}_item" if item_col in (id_col, "containment") else item_col
    out = StructType([docs.schema[id_col], StructField(item_out, items.schema[item_col].dataType), StructField("containment", DoubleType())])

    def one(make):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            search = make()
            for batch in batches:
                found = search(batch.column(1))
                ids = batch.column(0).take(pa.array([f[0] for f in found], pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, pa.array([f[1] for f in found], to_arrow_type(out[1].dataType)),
                                                  pa.array([f[2] for f in found], pa.float64())], out.names)
        return docs.select(id_col, text_col).mapInArrow(frugal(run), out)

    passes = [one(make) for make in _matches(docs, text_col, items, item_col, item_text, n, containment, recall,
                                             slice_items)]
    return reduce(DataFrame.unionAll, passes) if passes else docs.sparkSession.createDataFrame([], out)


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text: str = "text", n: int = SHINGLE, containment: float = CONTAINMENT,
                      recall: float = RECALL, slice_items: int = SLICE) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item; cases as in ``contained_items``."""
    for make in _matches(docs, text_col, items, item_col, item_text, n, containment, recall, slice_items):
        at = docs.columns.index(text_col)

        def run(batches: Iterator[pa.RecordBatch], make=make, at=at) -> Iterator[pa.RecordBatch]:
            search = make()
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[f[0] for f in search(batch.column(at))]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(frugal(run), docs.schema)
    return docs
