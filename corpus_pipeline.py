"""A training-data pipeline over ``documents``.

Every stage takes the rows that its predecessor kept, and its decisions take
effect: junk goes, one document of each near-duplicate group stays, documents
that hold benchmark items go, personal data is replaced, and the rest is encoded.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from crease.llm.bpe import digests
from crease.llm.common import cut, read
from crease.llm.decontaminate import drop_contaminated
from crease.llm.jaccard import keep_one
from crease.llm.pii import surrogates
from crease.llm.quality import score, train_on


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a score of a half or more."""
    return score(docs, train_on(docs, read(spark, sf_dir, "labels")), least=0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class linked by 5-gram Jaccard similarities of 0.8 or more."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data and secrets; ``n_chars`` follows the text."""
    out = surrogates(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document, as their digests with those of the round trip."""
    return digests(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("private_data", private_data), ("tokens", tokens)]
#: Learned, hashed and iterated stages have no SQL; the tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; each result is cut from its lineage, as its
    followers read it more than once."""
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = cut(docs)
    return docs
