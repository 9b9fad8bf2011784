"""Value of every distinct word of a corpus, computed once and joined back to
every position.

The occurrences of a word are never shuffled one by one.  A task cuts its texts
into chunks of bounded size; a chunk keeps its distinct words once and each text
as positions into that list.  Three steps follow:

1. the distinct words of every chunk are dealt by a hash of the word, packed per
   (chunk, bucket), so all chunks' copies of a word meet in one task, which
   computes its value once;
2. the values go back to the chunk that asked for them;
3. the chunk puts the values in the places of its words, text by text.

A word held by a third of all positions costs one entry per chunk, so no key is
hot; a task holds one chunk's word list and a bounded cache of values.  Texts are
shuffled once, as positions.  The input must give the same rows in the same order
when a task is repeated, as files and checkpoints do; a chunk that changes between
attempts is an error, never a wrong text.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from crease.llm.common import frugal, give_back, pack_ints, pack_strings, shuffle_width, small_batches, unpack_ints, unpack_strings

PERM, VALUES, TEXTS = 0, 1, 2
CACHE_WORDS = 400_000


def word_values(docs: DataFrame, id_col: str, text_col: str, split: Callable[[], Callable[[str], list[str]]],
                value_of: Callable[[], Callable[[list[bytes]], list[bytes]]],
                assemble: Callable[[list[bytes]], Callable[[np.ndarray], object]],
                out: StructField, chunk_chars: int = 8_000_000, block_chars: int = 500_000) -> DataFrame:
    """One row (id, ``out``) per row of ``docs``; a null text counts as empty.

    ``split()`` gives the function text -> words; ``value_of()`` the function
    from new distinct words to their packed values (called with words in sorted
    order); ``assemble(values)`` receives a chunk's values, one per distinct
    word, and gives the function from a text's word positions to its output.
    """
    id_type = docs.schema[id_col].dataType
    small_batches(docs.sparkSession)
    buckets = max(64, 4 * shuffle_width(docs.sparkSession))

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut_words, part, number = split(), TaskContext.get().partitionId(), 0
        index, texts, ids, chars, content = _fresh()

        def name() -> int:  # a chunk is named by what it holds, so that different attempts never mix
            content.update(f"{part}/{number}")
            return int.from_bytes(content.digest(), "little", signed=True) | 1 << 32  # above every bucket

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                words = cut_words(text)
                content.update(text.encode("utf-8", "surrogatepass"))
                ids.append(doc)
                texts.append((np.fromiter(map(index.__getitem__, words), np.uint32, len(words)), len(text)))
                chars += len(text)
                if chars >= chunk_chars:
                    yield from _chunk_rows(name(), index, texts, ids, buckets, block_chars, id_arrow)
                    number += 1
                    index, texts, ids, chars, content = _fresh()
        if ids:
            yield from _chunk_rows(name(), index, texts, ids, buckets, block_chars, id_arrow)

    id_arrow, out_arrow = to_arrow_type(id_type), to_arrow_type(out.dataType)
    packed = StructType([StructField("dest", LongType()), StructField("kind", IntegerType()),
                         StructField("chunk", LongType()), StructField("bucket", IntegerType()),
                         StructField("ids", ArrayType(id_type)), StructField("lens", BinaryType()),
                         StructField("payload", BinaryType())])
    width = shuffle_width(docs.sparkSession)
    # One exchange for words (by bucket) and texts (by chunk): texts stay where it brings them.
    dealt = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(frugal(chunks), packed) \
        .repartition(width, "dest")

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute, known = value_of(), {}
        for batch in batches:
            for kind, chunk, bucket, payload in zip(*(batch.column(c) for c in ("kind", "chunk", "bucket", "payload"))):
                if kind.as_py() != VALUES:
                    continue
                words = unpack_strings(payload.as_py())
                new = [w for w in words if w not in known]
                if len(known) + len(new) > CACHE_WORDS:
                    known, new = {}, words
                known.update(zip(new, compute(new)))
                yield _row(chunk.as_py(), VALUES, chunk.as_py(), bucket.as_py(), None, None,
                           pack_strings([known[w] for w in words]), id_arrow)

    def back(left: pa.Table, right: pa.Table) -> pa.Table:
        found, kinds = [], left.column("kind").to_pylist()
        if not right.num_rows and set(kinds) == {VALUES}:
            return pa.Table.from_arrays([pa.array([], id_arrow), pa.array([], out_arrow)], ["id", out.name])
        for k in np.argsort(right.column("bucket").to_numpy(), kind="stable").tolist():
            found += unpack_strings(right.column("payload")[k].as_py())
        if kinds.count(PERM) != 1:
            raise RuntimeError("a chunk has changed between attempts: checkpoint the input first")
        perm = unpack_ints(left.column("payload")[kinds.index(PERM)].as_py())
        if len(perm) != len(found):
            raise RuntimeError("a chunk's words and values differ: checkpoint the input first")
        ordered = [b""] * len(found)
        for k, v in zip(perm.tolist(), found):
            ordered[k] = v
        place, ids, texts = assemble(ordered), [], []
        del found, ordered
        for k in (k for k, kind in enumerate(kinds) if kind == TEXTS):
            ends = np.cumsum(np.frombuffer(left.column("lens")[k].as_py(), np.uint32))
            ids += left.column("ids")[k].as_py()
            texts.append(pa.array([place(s) for s in np.split(unpack_ints(left.column("payload")[k].as_py()), ends[:-1])],
                                  out_arrow))
        result = pa.Table.from_arrays([pa.array(ids, id_arrow), pa.chunked_array(texts, out_arrow)], ["id", out.name])
        del place, texts
        give_back()
        return result

    # No filter here: it would be pushed below the exchange, which both readers are to share.
    return dealt.groupBy("dest").cogroup(dealt.mapInArrow(frugal(values), packed).groupBy("dest")) \
        .applyInArrow(back, StructType([StructField("id", id_type), out]))


def _fresh():
    index = defaultdict()
    index.default_factory = index.__len__
    return index, [], [], 0, xxhash.xxh3_64()


def _row(dest, kind, chunk, bucket, ids, lens, payload, id_arrow) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([dest], pa.int64()), pa.array([kind], pa.int32()), pa.array([chunk], pa.int64()),
         pa.array([bucket], pa.int32()), pa.array([ids], pa.list_(id_arrow)), pa.array([lens], pa.binary()),
         pa.array([payload], pa.binary())], ["dest", "kind", "chunk", "bucket", "ids", "lens", "payload"])


def _chunk_rows(chunk, index, texts, ids, buckets, block_chars, id_arrow) -> Iterator[pa.RecordBatch]:
    """A chunk's words by bucket, the place of each, and its texts in blocks.
    Words are renumbered by falling frequency, which packs the texts best."""
    n = len(index)
    counts = np.zeros(n, np.int64)
    for seq, _ in texts:
        counts += np.bincount(seq, minlength=n) if len(seq) * 4 > n else 0
        if len(seq) * 4 <= n:
            np.add.at(counts, seq, 1)
    rank = np.empty(n, np.uint32)
    rank[np.argsort(-counts, kind="stable")] = np.arange(n, dtype=np.uint32)
    words = [w.encode() for w in index]
    bucket = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, n)
    order = sorted(range(n), key=words.__getitem__)
    order = np.array(order, np.int64)[np.argsort(bucket[order], kind="stable")] if n else np.zeros(0, np.int64)
    yield _row(chunk, PERM, chunk, -1, None, None, pack_ints(rank[order]), id_arrow)
    ends = np.flatnonzero(np.diff(bucket[order], append=-1)) + 1 if n else []
    start = 0
    for end in ends:
        part = order[start:end]
        yield _row(int(bucket[part[0]]), VALUES, chunk, int(bucket[part[0]]), None, None, pack_strings([words[i] for i in part]), id_arrow)
        start = end
    block, chars, first = [], 0, 0
    for k, (seq, size) in enumerate(texts):
        block.append(rank[seq])
        chars += size
        if chars >= block_chars or k == len(texts) - 1:
            lens = np.fromiter(map(len, block), np.uint32, len(block))
            yield _row(chunk, TEXTS, chunk, -1, ids[first:k + 1], lens.tobytes(), pack_ints(np.concatenate(block)), id_arrow)
            block, chars, first = [], 0, k + 1
