"""Byte-level BPE: encoding by a global distinct-word shuffle, decoding by a
join with the token-byte table."""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from crease.llm.common import frugal, ragged
from crease.llm.wordshuffle import word_values

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: A token-byte table of at most this many bytes goes to every task whole.
TABLE_BYTES = 64 << 20


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def read_ranks(path: str) -> bytes:
    """A rank file whole; its size is that of the vocabulary, not of the data."""
    with open(path, "rb") as f:
        data = f.read(TABLE_BYTES + 1)
    if len(data) > TABLE_BYTES:
        raise ValueError(f"{path}: a vocabulary of over {TABLE_BYTES} bytes")
    return data


@functools.lru_cache(maxsize=2)
def ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


@functools.lru_cache(maxsize=2)
def _encoder(data: bytes):
    import tiktoken
    return tiktoken.Encoding("ranks", pat_str=r"[\s\S]+", mergeable_ranks=ranks(data), special_tokens={})


def pre_tokens(pattern: str):
    """Function text -> pre-tokens, as the pattern's successive matches."""
    import regex
    return regex.compile(pattern).findall


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
           pattern: str | None = None, **chunking) -> DataFrame:
    """``(id_col, ids)``, one row per row of ``docs``: ``ids`` holds the token
    ids as little-endian unsigned 32-bit integers.

    Every match of ``pattern`` is encoded on its own, once for all its places in
    the corpus, and joined back by position.  Null and empty texts give no ids,
    repeated rows a row each, a null id stays null; an empty table stays empty.
    """
    from public_tokenizers import PATTERN
    pattern = pattern or PATTERN
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(read_ranks(path or vocabulary_path()))

    def split():
        return pre_tokens(pattern)

    def value_of():
        piece = _encoder(table.value).encode_ordinary  # its pattern takes the whole word
        return lambda words: [np.array(piece(w.decode()), np.uint32).tobytes() for w in words]

    def assemble(values: list[bytes]):
        lens = np.fromiter(map(len, values), np.int64, len(values)) // 4
        flat = np.frombuffer(b"".join(values), "<u4")
        starts = np.cumsum(lens) - lens
        return lambda seq: flat[ragged(starts[seq], lens[seq])].tobytes()

    out = word_values(docs, id_col, text_col, split, value_of, assemble, StructField("ids", BinaryType()), **chunking)
    return out.select(F.col("id").alias(id_col), "ids")


def token_bytes(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The token-byte table ``(token_id, bytes)`` of a rank file."""
    rows = sorted((i, bytearray(b)) for b, i in ranks(read_ranks(path or vocabulary_path())).items())
    return spark.createDataFrame(rows, "token_id int, bytes binary")


def decode(encoded: DataFrame, table: DataFrame, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes that its ids stand for as ``out_col``.

    The ids are joined map-side with ``table`` (token_id, bytes), which grows
    with the vocabulary only; a table of over ``TABLE_BYTES`` is refused.  Null
    ids give empty bytes; an id that the table lacks is an error.  A column named
    ``out_col`` is replaced; others pass through; an empty table stays empty.
    """
    spark, encoded = encoded.sparkSession, encoded.drop(out_col)
    size = table.agg(F.sum(F.length("bytes") + 8), F.count("*")).first()
    if (size[0] or 0) > TABLE_BYTES:
        raise ValueError("the token-byte table is not bounded by a vocabulary")
    rows = {int(r[0]): bytes(r[1]) for r in table.select("token_id", "bytes").collect()}
    top = max(rows, default=-1) + 1
    shared = spark.sparkContext.broadcast((b"".join(rows.get(i, b"") for i in range(top)),
                                           np.array([len(rows[i]) if i in rows else -1 for i in range(top)], np.int64)))
    at = encoded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, lens = np.frombuffer(shared.value[0], np.uint8), shared.value[1]
        starts = np.cumsum(np.maximum(lens, 0)) - np.maximum(lens, 0)
        for batch in (b.slice(i, 500) for b in batches for i in range(0, b.num_rows, 500)):
            decoded = []
            for value in batch.column(at):
                ids = np.frombuffer(value.as_py() or b"", "<u4")
                if len(ids) and (ids.max() >= len(lens) or lens[ids].min() < 0):
                    raise ValueError("an id is not in the token-byte table")
                decoded.append(flat[ragged(starts[ids], lens[ids])].tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.binary())],
                                             [*batch.schema.names, out_col])

    return encoded.mapInArrow(frugal(run), StructType([*encoded.schema.fields, StructField(out_col, BinaryType())]))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
            **chunking) -> DataFrame:
    """Per document: token count, hash of the ids, hash of the decoded bytes."""
    spark = docs.sparkSession
    both = decode(encode(docs, id_col, text_col, path, **chunking), token_bytes(spark, path))
    return both.select(id_col, (F.length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
