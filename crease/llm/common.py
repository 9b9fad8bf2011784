"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from crease.session import checkpoint_dir, ship


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of the data folder, through Spark's reader only."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, its lineage cut there."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def small_batches(spark: SparkSession, size: int = 8 << 20) -> None:
    """Lowers the session's Arrow batches to ``size`` bytes: rows of whole texts
    stand in an executor's memory several times (JVM, pipe, Python, result)."""
    ship(spark)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    number, unit = re.fullmatch(r"(-?\d+)([kmgt]?)b?", spark.conf.get(key).strip().lower()).groups()
    now = int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]
    if now <= 0 or now > size:
        spark.conf.set(key, f"{size}b")


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of ``df`` has them (whatever its case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def give_back() -> None:
    """Returns freed memory to the system.  Python workers are used again by later
    tasks, and what their allocators keep adds up in an executor's memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim:
        trim(0)


def frugal(run: Callable) -> Callable:
    """An Arrow function over batches that leaves no memory behind in its worker."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def bounded_sample(rows: DataFrame, size: int, *keys: str) -> DataFrame:
    """At most ``size`` rows, distinct in ``keys``: the first in the order of a
    hash of these, so that runs agree.  About twice as many leave their tasks,
    whatever the table's size and however often a row is repeated."""
    near, total = rows.withColumn("__hash", F.xxhash64(*keys)), rows.count()
    if total > 2 * size:
        near = near.filter(F.shiftrightunsigned("__hash", 24) < int((1 << 40) * (2 * size / total)))
    return near.dropDuplicates(["__hash"]).orderBy("__hash").limit(size).drop("__hash")


_ZIP, _UNZIP = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def squeeze(data: bytes) -> bytes:
    return _ZIP.compress(data)


def unsqueeze(data: bytes) -> bytes:
    return _UNZIP.decompress(data)


def pack_ints(values: np.ndarray) -> bytes:
    """Non-negative integers below 2**24 + 255, small ones frequent: one byte
    each, larger ones as an escape and three byte planes; then zstd."""
    values = np.asarray(values, np.uint32)
    small = values < 255
    rest = values[~small] - 255
    planes = [np.where(small, values, 255).astype(np.uint8)]
    planes += [((rest >> s) & 255).astype(np.uint8) for s in (0, 8, 16)]
    return squeeze(np.uint32(len(values)).tobytes() + b"".join(p.tobytes() for p in planes))


def unpack_ints(data: bytes) -> np.ndarray:
    raw = np.frombuffer(unsqueeze(data), np.uint8)
    n = int(raw[:4].view(np.uint32)[0])
    out = raw[4:4 + n].astype(np.uint32)
    rest = raw[4 + n:].reshape(3, -1).astype(np.uint32)
    out[out == 255] = 255 + (rest[0] | (rest[1] << 8) | (rest[2] << 16))
    return out


def pack_strings(words: list[bytes]) -> bytes:
    lens = np.fromiter(map(len, words), np.uint32, len(words))
    return squeeze(np.uint32(len(words)).tobytes() + lens.tobytes() + b"".join(words))


def unpack_strings(data: bytes) -> list[bytes]:
    raw = unsqueeze(data)
    n = int(np.frombuffer(raw, np.uint32, 1)[0])
    ends = np.cumsum(np.frombuffer(raw, np.uint32, n, 4).astype(np.int64)) + 4 + 4 * n
    return [raw[a:b] for a, b in zip(np.concatenate(([4 + 4 * n], ends[:-1])).tolist(), ends.tolist())] if n else []


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Flat positions of the slices (start, length), one after the other."""
    total = int(lens.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lens)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lens), lens)
