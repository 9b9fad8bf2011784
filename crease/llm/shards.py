"""Training-order materialisation of token sequences as fixed-stride shards.

A keyed Feistel permutation with cycle walking gives every sequence its place in
the training order, without sorting or a table of the order.  Its domain counts
for each text as many sequences as its bytes could give, which is known before
any text is tokenised; so places are unique but have gaps.  They are dealt by
range: a shard takes a range of places and writes its sequences in their order,
as records of one length.  A sequence's global slot, from 0 on without gaps, is
the number of records in earlier shards (their files' sizes) and its position in
its own; so a reader goes to any slot, and on from there, by arithmetic.

A record holds the document's id, the sequence's number in it and its token count
(64, 32 and 32 bits), the ids in 16 bits each, zeros up to the fixed length, and
a closing line feed.  The files are written by Spark's own text writer and commit
protocol, so they reach any file system that Spark does, and a lost task leaves
no half shard.
"""

from __future__ import annotations

import functools
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from crease.llm.bpe import ranks, read_ranks, vocabulary_path
from crease.llm.common import frugal, shuffle_width, small_batches, squeeze, unsqueeze
from crease.llm.shingles import mix

#: Tokens of a sequence; places of a shard (about half of them are sequences).
LENGTH, PER_SHARD = 512, 32_768
ROUNDS = 6


class Order:
    """Keyed bijection of 0 .. n-1: a Feistel network over the next even number
    of bits; values beyond n walk on along their cycle."""

    def __init__(self, n: int, key: str):
        self.n, self.half = n, max(1, (max(1, n - 1).bit_length() + 1) // 2)
        self.keys = [np.uint64(int.from_bytes(hashlib.sha256(f"{key}/{r}".encode()).digest()[:8], "big")) for r in range(ROUNDS)]

    def _once(self, x: np.ndarray) -> np.ndarray:
        half, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        left, right = x >> half, x & mask
        for k in self.keys:
            left, right = right, left ^ (mix(right ^ k) & mask)
        return left << half | right

    def _back(self, x: np.ndarray) -> np.ndarray:
        half, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        left, right = x >> half, x & mask
        for k in reversed(self.keys):
            left, right = right ^ (mix(left ^ k) & mask), left
        return left << half | right

    def _walk(self, x: np.ndarray, step) -> np.ndarray:
        out = step(np.asarray(x, np.uint64))
        while (beyond := out >= self.n).any():
            out[beyond] = step(out[beyond])
        return out.astype(np.int64)

    def slot(self, index: np.ndarray) -> np.ndarray:
        return self._walk(index, self._once)

    def index(self, slot: np.ndarray) -> np.ndarray:
        return self._walk(slot, self._back)


def record_type(length: int) -> np.dtype:
    return np.dtype([("doc", "<i8"), ("at", "<i4"), ("n", "<i4"), ("ids", "<u2", (length,)), ("end", "u1")])


@functools.lru_cache(maxsize=1)
def _tokenizer(table: bytes):
    import tiktoken
    from public_tokenizers import PATTERN
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks(table), special_tokens={})


def write_shards(docs: DataFrame, folder: str, key: str = "epoch-0", id_col: str = "doc_id", text_col: str = "text",
                 path: str | None = None, length: int = LENGTH, per_shard: int = PER_SHARD) -> bool:
    """Writes the sequences of ``docs`` below ``folder`` (``shard=<number>``, one
    file each) in the order that ``key`` gives; returns whether there are any.

    A document's ids are cut into sequences of ``length``.  Null and empty texts
    have none; a null id is written as -1; repeated rows have sequences of their
    own; an empty table writes nothing.  Texts are tokenised and tokens moved
    once; before, the texts' sizes are added up (one number per input partition
    reaches the driver).  The input must give the same rows in both passes, as
    files and checkpoints do; else the write fails.
    """
    spark = docs.sparkSession
    small_batches(spark)
    data = read_ranks(path or vocabulary_path())
    if max(ranks(data).values()) > 0xFFFF:
        raise ValueError("a vocabulary of over 65,536 tokens does not fit 16-bit records")
    table = spark.sparkContext.broadcast(data)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    room = F.ceil(F.octet_length("t") / length)  # no token is shorter than a byte
    sizes = {r["part"]: r["n"] for r in texts.groupBy(F.spark_partition_id().alias("part")).agg(F.sum(room).alias("n")).collect()}
    starts, total = {}, 0
    for part in sorted(sizes):
        starts[part], total = total, total + sizes[part]
    if not total:
        return False
    order, shards = Order(total, key), -(-total // per_shard)
    width = min(shards, shuffle_width(spark))
    given = StructType([StructField("place", LongType()), StructField("packed", BinaryType())])
    step = 2 * length

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = _tokenizer(table.value).encode_ordinary, TaskContext.get().partitionId()
        at = starts.get(part, 0)
        for batch in batches:
            index, packed = [], []
            rooms = -(-pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False) // length)
            for doc, text, own in zip(batch.column(0).to_pylist(), batch.column(1), rooms.tolist()):
                ids = np.array(encode(text.as_py()), "<u2").tobytes() if own else b""
                for k, start in enumerate(range(0, len(ids), step)):
                    index.append(at + k)
                    packed.append(squeeze(struct.pack("<qi", -1 if doc is None else doc, k) + ids[start:start + step]))
                at += own
            if at > starts.get(part, 0) + sizes.get(part, 0):
                break
            places = order.slot(np.array(index, np.int64)) if index else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(packed, pa.binary())], given.names)
        if at != starts.get(part, 0) + sizes.get(part, 0):
            raise RuntimeError("the input has changed between passes: checkpoint it first")

    size = record_type(length).itemsize

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            records = []
            for packed in batch.column("packed"):
                raw = unsqueeze(packed.as_py())
                records.append((raw[:12] + struct.pack("<i", (len(raw) - 12) // 2) + raw[12:]).ljust(size - 1, b"\0"))
            yield pa.RecordBatch.from_arrays([batch.column("shard"), pa.array(records, pa.binary())], ["shard", "record"])

    to = F.floor(F.col("shard") * width / shards).cast("int")
    texts.mapInArrow(frugal(place), given).withColumn("shard", F.floor(F.col("place") / per_shard)) \
        .repartitionById(width, to).sortWithinPartitions("shard", "place") \
        .mapInArrow(frugal(fill), "shard long, record binary").select("shard", F.col("record").cast("string").alias("value")) \
        .write.partitionBy("shard").option("lineSep", "\n").option("compression", "none").text(folder)
    return True


def read_shards(spark: SparkSession, folder: str, length: int = LENGTH, first_slot: int = 0) -> DataFrame:
    """``(slot, shard, offset, doc_id, at, n_tokens, ids)`` of the records from
    ``first_slot`` on; shards that end before it are not opened."""
    kind = record_type(length)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    # one number per shard
    sizes = {r["shard"]: r["length"] for r in files.select(F.col("shard").cast("long").alias("shard"), "length").collect()}
    starts, total = {}, 0
    for shard in sorted(sizes):
        if sizes[shard] % kind.itemsize:
            raise ValueError(f"shard {shard} is not a whole number of records")
        starts[shard], total = total, total + sizes[shard] // kind.itemsize
    first_shard = max([s for s in starts if starts[s] <= first_slot], default=0)
    wanted = files.select(F.col("shard").cast("long").alias("shard"), "content").filter(F.col("shard") >= first_shard)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content")):
                rows = np.frombuffer(content.as_buffer(), kind)
                for start in range(0, len(rows), 4096):
                    part = rows[start:start + 4096]
                    at = np.arange(start, start + len(part), dtype=np.int64)
                    keep = at + starts[shard] >= first_slot
                    part, at = part[keep], at[keep]
                    flat = part["ids"].tobytes()
                    ids = [flat[i:i + 2 * n] for i, n in zip(range(0, len(flat), 2 * length), part["n"].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(at + starts[shard]), pa.array(np.full(len(at), shard, np.int64)),
                         pa.array(at * kind.itemsize), pa.array(np.ascontiguousarray(part["doc"])),
                         pa.array(part["at"].astype(np.int64)), pa.array(part["n"].astype(np.int64)),
                         pa.array(ids, pa.binary())],
                        ["slot", "shard", "offset", "doc_id", "at", "n_tokens", "ids"])

    return wanted.mapInArrow(frugal(run), "slot long, shard long, offset long, doc_id long, at long, n_tokens long, ids binary")
