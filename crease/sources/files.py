"""File sources and sinks, session stages, preview and table metadata (S-series)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crease.operators.profile import NUMERIC_TYPES

# Stage order of a session, oldest first; "latest" is the last one present.
STAGES = ["original", "cleaned", "encoded", "scaled", "pca"]
# Text read as null in CSV input (pandas' default markers that occur in practice).
CSV_NULLS = ""


def strip_column_names(df: DataFrame) -> DataFrame:
    """Trim blanks around column names."""
    return df.toDF(*[c.strip() for c in df.columns])


def scan_csv(spark: SparkSession, path: str, schema=None, infer: bool = True) -> DataFrame:
    """CSV with a header; types inferred (or given); names stripped."""
    r = spark.read.option("header", True).option("nullValue", CSV_NULLS).option("nanValue", "NaN")
    r = r.schema(schema) if schema is not None else r.option("inferSchema", infer)
    return strip_column_names(r.csv(path))


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def drop_stray_index_columns(df: DataFrame, prefix: str = "Unnamed") -> DataFrame:
    """Drop columns whose name starts with ``Unnamed`` (exported row labels)."""
    stray = [c for c in df.columns if c.startswith(prefix)]
    return df.drop(*stray) if stray else df


def resolve_column(df: DataFrame, candidates: list[str], hints: tuple = ("run", "score"),
                   numeric: bool = True) -> str:
    """First existing candidate; else a column whose name contains a hint; else
    the last numeric column (last non-numeric when ``numeric`` is False)."""
    for c in candidates:
        if c in df.columns:
            return c
    for c in df.columns:
        if any(h in c.lower() for h in hints):
            return c
    pool = [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES) == numeric]
    if not pool:
        raise ValueError("no column matches")
    return pool[-1]


def stage_path(base: str, session: str, stage: str) -> str:
    return f"{base.rstrip('/')}/{session}/{stage}"


def stage_save(df: DataFrame, base: str, session: str, stage: str) -> str:
    if stage not in STAGES:
        raise ValueError(stage)
    p = stage_path(base, session, stage)
    df.write.mode("overwrite").parquet(p)
    return p


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS"))


def has_stage(spark: SparkSession, base: str, session: str, stage: str) -> bool:
    return _exists(spark, stage_path(base, session, stage))


def stage_load(spark: SparkSession, base: str, session: str, stage: str) -> DataFrame:
    return spark.read.parquet(stage_path(base, session, stage))


def stage_latest(spark: SparkSession, base: str, session: str) -> tuple[str, DataFrame]:
    """The most advanced stage present: pca > scaled > encoded > cleaned > original."""
    for stage in reversed(STAGES):
        if has_stage(spark, base, session, stage):
            return stage, stage_load(spark, base, session, stage)
    raise FileNotFoundError(f"no stage for session {session}")


def sink_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, no row labels."""
    df.write.mode("overwrite").option("header", True).csv(path)


def sink_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def preview(df: DataFrame, order: list[str], n: int = 10, tail: bool = False) -> DataFrame:
    """First (or last) n rows in ``order`` -- a top-n, not a sort of the table."""
    if tail:
        return df.orderBy(*[F.desc(c) for c in order]).limit(n).orderBy(*order)
    return df.orderBy(*order).limit(n)


def table_metadata(df: DataFrame) -> DataFrame:
    """One row: rows, columns, numeric and other column counts, column names."""
    num = sum(1 for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES))
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(len(df.columns)).cast("long").alias("columns"), F.lit(num).cast("long").alias("numeric_columns"),
        F.lit(len(df.columns) - num).cast("long").alias("other_columns"),
        F.lit(",".join(df.columns)).alias("column_names"))
