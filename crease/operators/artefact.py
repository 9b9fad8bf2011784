"""Saved models with their contract (L20, L22): beside the model lies a manifest of its
features, label names and dictionaries, which scoring holds the input against."""

from __future__ import annotations

import json
import pickle
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Artefact:
    """A fitted model, the numeric columns that it reads, the names of its classes
    (empty: regression) and, per encoded column, the dictionary value -> code."""

    model: object
    features: list[str]
    labels: list[str] = field(default_factory=list)
    dictionaries: dict[str, dict[str, int]] = field(default_factory=dict)
    unknown: int = 0

    def save(self, spark: SparkSession, path: str) -> None:
        """Model and manifest under ``path``, written by Spark to the storage it names."""
        whole = isinstance(self.model, PipelineModel)
        if whole:
            self.model.write().overwrite().save(f"{path}/model")
        manifest = {"kind": "pipeline" if whole else "object", "features": self.features, "labels": self.labels,
                    "dictionaries": self.dictionaries, "unknown": self.unknown}
        blob = bytearray() if whole else bytearray(pickle.dumps(self.model))
        spark.createDataFrame([(json.dumps(manifest), blob)], "manifest string, model binary").coalesce(1) \
            .write.mode("overwrite").parquet(f"{path}/manifest")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Artefact":
        """The saved model; only load what you have saved yourself."""
        row = spark.read.parquet(f"{path}/manifest").first()
        m = json.loads(row["manifest"])
        if missing := {"kind", "features", "labels", "dictionaries", "unknown"} - set(m):
            raise ValueError(f"the manifest lacks {sorted(missing)}")
        model = PipelineModel.load(f"{path}/model") if m["kind"] == "pipeline" else pickle.loads(bytes(row["model"]))
        return Artefact(model, m["features"], m["labels"], m["dictionaries"], m["unknown"])

    def score(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """``keep`` columns, ``prediction`` and, for classes, ``label`` (its name) and
        ``probability`` (one number per class).  Columns of the dictionaries are encoded,
        unknown values with the ``unknown`` code; a missing column, or one of another
        kind than the model was fitted on, is refused."""
        kinds = dict(df.dtypes)
        for c in self.features:
            if c not in kinds:
                raise ValueError(f"the model reads {c}, which the table lacks")
            numeric = kinds[c].startswith(("tinyint", "smallint", "int", "bigint", "float", "double", "decimal", "boolean"))
            if (c in self.dictionaries) == numeric:
                raise ValueError(f"{c} is {kinds[c]}; the model was fitted on {'text' if c in self.dictionaries else 'numbers'}")
        coded = df.select(*df.columns if not self.dictionaries else [
            self._code(c).alias(c) if c in self.dictionaries else F.col(c) for c in df.columns])
        scored = self.model.transform(coded.withColumn("__keep", F.struct(*[F.col(c) for c in keep])))
        kept = [F.col(f"__keep.{c}").alias(c) for c in keep]
        if not self.labels:
            return scored.select(*kept, F.col("prediction").cast("double").alias("prediction"))
        from crease.operators.models import _probabilities
        names = F.array(*map(F.lit, self.labels))
        return scored.select(*kept, F.col("prediction").cast("double").alias("prediction"),
                             F.get(names, F.col("prediction").cast("int")).alias("label"), _probabilities(scored).alias("probability"))

    def _code(self, column: str) -> Column:
        table = self.dictionaries[column]
        known = F.create_map(*[x for v, k in table.items() for x in (F.lit(v), F.lit(k))]) if table else F.create_map()
        return F.coalesce(known[F.col(column)], F.lit(self.unknown)) if table else F.lit(self.unknown)
