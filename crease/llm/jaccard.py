"""N-gram Jaccard join of documents by MinHash banding.

1. Texts of equal n-gram sets form a class; only one row of a class goes on.
2. Band hashes (bands and rows chosen for the target recall) are shuffled; rows
   that share one are linked to the smallest row of its bucket: a star per bucket,
   never its pairs.  Connected stars are candidate groups, so every pair that
   shares a band lies within one group.
3. A group's full n-gram sets meet in blocks of bounded size, every pair of blocks
   in one task, and every pair of the group is verified there exactly, once.  A
   task gives back each row's number of links and the links of a spanning forest
   of its block pair, not the pairs.
4. Components of the verified links are the near-duplicate classes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from crease.llm.common import cut, frugal, shuffle_width, small_batches, squeeze, unsqueeze, unused
from crease.llm.shingles import SHINGLE, mix, shingle_hashes, words_of
from crease.llm.components import components

SIMILARITY, RECALL = 0.8, 0.9995
#: Rows of a block: at least, at most; in between a group is cut into 32 blocks.
BLOCK_LEAST, BLOCK_MOST = 128, 1024


def banding(similarity: float = SIMILARITY, recall: float = RECALL, most_hashes: int = 128) -> tuple[int, int]:
    """(bands, rows): among those that find a pair of ``similarity`` with
    ``recall``, the one with the most rows, which lets the fewest others in."""
    best = (1, 1)
    for rows in range(1, 17):
        hit = similarity ** rows
        bands = 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - hit))
        if bands * rows <= most_hashes:
            best = (bands, rows)
    return best


def gram_set(text: str | None, n: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of a text's word n-grams; a text of fewer words is one gram
    of all its words, an empty one has none."""
    grams = shingle_hashes(text, n)
    if not len(grams):
        words = words_of(text)
        if words:
            grams = np.array([xxhash.xxh3_64_intdigest(" ".join(words).encode("utf-8", "surrogatepass"), seed=n)], np.uint64)
    return np.unique(grams)


def _signatures(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """Band hashes of non-empty sets, one row per set."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    factors = mix(np.arange(1, bands * rows + 1, dtype=np.uint64)) | np.uint64(1)
    out = np.zeros((len(sets), bands), np.uint64)
    for k, factor in enumerate(factors):
        low = np.minimum.reduceat((flat * factor) >> np.uint64(24), starts)
        out[:, k // rows] = mix(out[:, k // rows] + low + np.uint64(k + 1))
    return out.view(np.int64)


def _tagged(docs: DataFrame, id_col: str, text_col: str, n: int, bands: int, rows: int, group: int = 400_000) -> DataFrame:
    """Row number, id, content key, digest and size of the gram set, band hashes
    and the packed text, cut from its lineage."""
    out = StructType([StructField("row", LongType(), False), StructField("id", docs.schema[id_col].dataType),
                      StructField("k1", LongType()), StructField("k2", LongType()),
                      StructField("d1", LongType()), StructField("d2", LongType()), StructField("size", LongType()),
                      StructField("bands", ArrayType(LongType())), StructField("packed", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            sets, part, size, signed = [], [], 0, {}

            def sign():
                nonlocal part, size
                if part:
                    signed.update(zip(part, _signatures([sets[i] for i in part], bands, rows).tolist()))
                part, size = [], 0

            texts = batch.column(1).to_pylist()
            for i, text in enumerate(texts):
                sets.append(gram_set(text, n))
                if len(sets[-1]):
                    part.append(i)
                    size += len(sets[-1])
                    if size >= group:
                        sign()
            sign()
            digests = [np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64).tolist() for s in sets]
            m = len(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(row, row + m), pa.int64()), batch.column(0), batch.column(2), batch.column(3),
                 pa.array([d[0] for d in digests], pa.int64()), pa.array([d[1] for d in digests], pa.int64()),
                 pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([signed.get(i, []) for i in range(m)], pa.list_(pa.int64())),
                 pa.array([squeeze((t or "").encode("utf-8", "surrogatepass")) for t in texts], pa.binary())], out.names)
            row += m

    return cut(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"), *content_key(id_col, text_col))
               .mapInArrow(frugal(run), out))


def content_key(id_col: str, text_col: str):
    """Two hashes of id and text that together tell rows apart (equal rows agree)."""
    return (F.xxhash64(F.col(id_col), F.col(text_col)).alias("k1"),
            F.xxhash64(F.lit(1), F.col(text_col), F.lit(2), F.col(id_col)).alias("k2"))


def link_block(left: list[np.ndarray], right: list[np.ndarray] | None, similarity: float) -> np.ndarray:
    """Boolean matrix: which sets of ``left`` and ``right`` (``left`` itself if
    None) reach the similarity; exact counts of shared grams."""
    sets = left + (right or [])
    flat, lens = np.concatenate(sets), np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), lens)
    order = np.argsort(flat, kind="stable")
    new = np.concatenate(([True], flat[order][1:] != flat[order][:-1]))
    gram = np.cumsum(new) - 1
    held = np.bincount(gram)
    keep = held[gram] > 1
    gram, owner = (np.cumsum(held > 1) - 1)[gram[keep]], owner[order][keep]
    a, b = len(left), len(right) if right is not None else len(left)
    shared = np.zeros((a, b), np.float32)
    for start in range(0, int(gram[-1]) + 1 if len(gram) else 0, 4096):
        lo, hi = np.searchsorted(gram, [start, start + 4096])
        grid = np.zeros((len(sets), 4096), np.float32)
        grid[owner[lo:hi], gram[lo:hi] - start] = 1
        shared += grid[:a] @ (grid[a:] if right is not None else grid).T
    la, lb = lens[:a, None], (lens[a:] if right is not None else lens)[None, :]
    linked = shared >= similarity * (la + lb - shared) - 1e-6
    if right is None:
        np.fill_diagonal(linked, False)
    return linked


def _verify(blocks: DataFrame, n: int, similarity: float, width: int) -> DataFrame:
    """(row, links, other): for rows with links within a block pair, the number
    of documents linked and a row of its spanning forest."""
    out = StructType([StructField("row", LongType()), StructField("links", LongType()), StructField("other", LongType())])

    def answer(rows: list[dict]) -> pa.RecordBatch:
        within = rows[0]["i"] == rows[0]["j"]
        a = [r for r in rows if r["own"] == r["i"]]
        b = None if within else [r for r in rows if r["own"] == r["j"]]
        result: dict[int, list] = {}
        if a and (within or b):
            sets = [[gram_set(unsqueeze(r["packed"]).decode("utf-8", "surrogatepass"), n) for r in side or ()]
                    for side in (a, b)]
            linked = link_block(sets[0], None if within else sets[1], similarity)
            other = a if within else b
            for here, there, grid in ((a, other, linked),) if within else ((a, b, linked), (b, a, linked.T)):
                copies = np.array([r["copies"] for r in there], np.int64)
                for k in np.flatnonzero(grid.any(axis=1)).tolist():
                    result[here[k]["row"]] = [int(copies[grid[k]].sum()), None]
            every = {r["row"]: r["row"] for r in a + (b or [])}

            def root(x):
                while every[x] != x:
                    every[x] = every[every[x]]
                    x = every[x]
                return x

            for k, m in zip(*np.nonzero(linked)):
                x, y = root(a[k]["row"]), root(other[m]["row"])
                if x != y:
                    every[max(x, y)] = min(x, y)
            for row in result:
                result[row][1] = root(row)
        return pa.RecordBatch.from_arrays([pa.array(list(result), pa.int64()),
                                           pa.array([v[0] for v in result.values()], pa.int64()),
                                           pa.array([v[1] for v in result.values()], pa.int64())], out.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []
        for batch in batches:
            for r in batch.to_pylist():
                key = (r["grp"], r["i"], r["j"])
                if key != at and rows:
                    yield answer(rows)
                    rows = []
                at = key
                rows.append(r)
        if rows:
            yield answer(rows)

    return blocks.repartition(width, "grp", "i", "j").sortWithinPartitions("grp", "i", "j").mapInArrow(frugal(run), out)


def _classes(docs: DataFrame, id_col: str, text_col: str, n: int, similarity: float, recall: float):
    """(tagged rows, classes, verified): ``classes`` has node (its smallest row),
    digest, copies and smallest id; ``verified`` has row, links, label for nodes with links."""
    small_batches(docs.sparkSession)
    bands, rows = banding(similarity, recall)
    width = shuffle_width(docs.sparkSession)
    tagged = _tagged(docs, id_col, text_col, n, bands, rows)
    classes = tagged.groupBy("d1", "d2").agg(F.min("row").alias("node"), F.count("*").alias("copies"),
                                             F.min("id").alias("least"), F.max("size").alias("size"))
    nodes = cut(classes.filter(F.col("size") > 0))
    own = tagged.join(nodes.select(F.col("node").alias("row"), "copies"), "row")
    keys = cut(own.select("row", F.posexplode("bands").alias("band", "hash"))
               .select(F.xxhash64("band", "hash").alias("key"), "row"))
    stars = keys.groupBy("key").agg(F.min("row").alias("least"), F.count("*").alias("held")) \
        .filter(F.col("held") > 1).select("key", "least")
    stars = keys.join(stars, "key").filter(F.col("row") != F.col("least")).select(F.col("row").alias("a"), F.col("least").alias("b"))
    stars = cut(stars.distinct())
    ends = stars.select(F.col("a").alias("id")).unionAll(stars.select(F.col("b").alias("id"))).distinct()
    groups = cut(components(stars, ends))
    held = groups.groupBy("lbl").agg(F.count("*").alias("held"))
    block = F.least(F.greatest(F.ceil(F.col("held") / 32), F.lit(BLOCK_LEAST)), F.lit(BLOCK_MOST))
    placed = groups.join(held, "lbl").withColumn("cuts", F.ceil(F.col("held") / block).cast("int")) \
        .select(F.col("id").alias("row"), F.col("lbl").alias("grp"), "cuts",
                F.pmod(F.xxhash64("id"), F.col("cuts")).cast("int").alias("own"))
    blocks = own.select("row", "copies", "packed").join(placed, "row") \
        .withColumn("x", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))) \
        .select("row", "copies", "packed", "grp", "own", F.least("own", "x").alias("i"), F.greatest("own", "x").alias("j"))
    links = cut(_verify(blocks, n, similarity, width))
    edges = links.filter(F.col("row") != F.col("other")).select(F.col("row").alias("a"), F.col("other").alias("b"))
    labels = components(edges, links.select(F.col("row").alias("id")).distinct())
    verified = links.groupBy("row").agg(F.sum("links").alias("links")) \
        .join(labels.select(F.col("id").alias("row"), F.col("lbl").alias("label")), "row")
    return tagged, classes, cut(verified)


def _placed(tagged: DataFrame, classes: DataFrame, verified: DataFrame) -> DataFrame:
    """``classes`` with links and the near-duplicate class: its label and smallest id."""
    known = classes.join(verified.withColumnRenamed("row", "node"), "node", "left") \
        .withColumn("label", F.coalesce("label", "node"))
    tops = known.groupBy("label").agg(F.min("least").alias("class_id"))
    return known.join(tops, "label").select(
        "d1", "d2", "label", "size", F.col("least").alias("text_id"), "class_id",
        F.when(F.col("size") > 0, F.coalesce("links", F.lit(0)) + F.col("copies") - 1).otherwise(F.lit(0)).alias("n_links"))


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE,
                    similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """``(id_col, class_id, text_id, n_links)``, one row per row of ``docs``.

    ``n_links`` counts the other rows of similarity ``similarity`` or more,
    equal texts included; ``class_id`` is the smallest id of those connected by
    links, ``text_id`` that of equal n-gram sets.  Texts of under ``n`` words
    are one gram of all their words.  Null and empty texts have no gram and no
    links, and their class is their own id; null ids are never the smallest; repeated
    rows are linked to each other; an empty table stays empty.
    """
    tagged, classes, verified = _classes(docs, id_col, text_col, n, similarity, recall)
    known = _placed(tagged, classes, verified).drop("label")
    empty = F.col("size") == 0
    return tagged.select("id", "d1", "d2").join(known, ["d1", "d2"]).select(
        F.col("id").alias(id_col), F.when(empty, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(empty, F.col("id")).otherwise(F.col("text_id")).alias("text_id"), "n_links")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE,
             similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """The rows of ``docs``, all columns, with one row of each near-duplicate
    class: the one of the smallest id (then of the smallest content hash; of equal
    rows any one).  Texts without a gram are kept, repeated rows of them once; very
    long texts are read whole; an empty table stays empty; other columns pass
    through, whatever their names.
    """
    one, two = unused(docs, "__k1", "__k2")
    tagged, classes, verified = _classes(docs, id_col, text_col, n, similarity, recall)
    known = _placed(tagged, classes, verified).select("d1", "d2", "label", "size")
    rows = tagged.select("row", "id", "k1", "k2", "d1", "d2").join(known, ["d1", "d2"])
    group = F.when(F.col("size") > 0, F.col("label")).otherwise(F.xxhash64("k1", "k2", F.lit("empty")))
    first = F.struct(F.col("id").isNull(), "id", "k1", "k2")
    kept = rows.groupBy(group.alias("g"), (F.col("size") > 0).alias("some")).agg(F.min(first).alias("m")) \
        .select(F.col("m.k1").alias(one), F.col("m.k2").alias(two)).distinct()
    k1, k2 = content_key(id_col, text_col)
    return docs.select("*", k1.alias(one), k2.alias(two)).join(kept, [one, two], "left_semi") \
        .dropDuplicates([one, two]).select(*docs.columns)
