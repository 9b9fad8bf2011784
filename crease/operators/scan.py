"""Skew-safe ordered scans: running totals and average ranks.

A window ``partitionBy(key).orderBy(t)`` sends every row of a key to one task.
When one key holds a third of all rows that task holds a third of the data.
``running_totals`` instead cuts the order axis into blocks at global quantiles
of the first order column (a hot key dominates those quantiles, so it is cut
into many blocks), computes running sums inside each (key, block) with an
ordinary window, and adds the block's offset: the total of the key's earlier
blocks, taken from a table with one row per non-empty (key, block).
This is the two-level parallel prefix sum written as DataFrame operations.

The block of a row is a pure function of its value (the boundaries are
literals computed once), so every branch of the plan -- and every retry of a
lost task -- assigns the same block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BLK = "__blk"
# Quantile accuracy of the block boundaries (only balance depends on it).
_ACCURACY = 10000
# Strings drawn per block for the boundaries of a string axis.
_STRINGS_PER_BLOCK = 40


def _n_blocks(df: DataFrame, n_blocks: int | None) -> int:
    if n_blocks:
        return int(n_blocks)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _numeric_projection(df: DataFrame, col: str | Column) -> Column:
    """Order-preserving (non-strict) numeric image of the first order column."""
    c = F.col(col) if isinstance(col, str) else col
    name = col if isinstance(col, str) else None
    dt = df.schema[name].dataType if name and name in df.columns else None
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(dt, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(dt, T.StringType):
        return c  # strings are compared as strings
    if isinstance(dt, T.BooleanType):
        return c.cast("int").cast("double")
    return c.cast("double")


def _bucket(x: Column, bounds: list) -> Column:
    """Number of boundaries <= x (binary search as a CASE tree); null -> -1."""

    def build(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(x < F.lit(bounds[mid]), build(lo, mid)).otherwise(build(mid + 1, hi))

    return F.when(x.isNull(), F.lit(-1)).otherwise(build(0, len(bounds)))


def block_boundaries(df: DataFrame, x: Column, n_blocks: int) -> list[float]:
    """Distinct approximate quantiles of ``x`` (at most n_blocks - 1 values)."""
    if n_blocks <= 1:
        return []
    if isinstance(df.select(x).schema[0].dataType, T.StringType):
        return _string_boundaries(df.select(x.alias("x")), n_blocks)
    probs = [i / n_blocks for i in range(1, n_blocks)]
    row = df.select(F.percentile_approx(x, probs, _ACCURACY).alias("q")).first()
    qs = row["q"] if row is not None else None
    return sorted({float(q) for q in (qs or []) if q is not None})


def _string_boundaries(values: DataFrame, n_blocks: int) -> list[str]:
    """Boundaries between strings, from at most ``_STRINGS_PER_BLOCK * n_blocks``
    of the distinct values, drawn by hash.  Only the balance depends on them."""
    size = _STRINGS_PER_BLOCK * n_blocks
    known = values.filter(F.col("x").isNotNull())
    total = known.agg(F.approx_count_distinct("x")).first()[0]
    near = F.shiftrightunsigned(F.xxhash64("x"), 24)
    if total > size:
        known = known.filter(near < int((1 << 40) * (2 * size / total)))
    drawn = sorted(r[0] for r in known.distinct().limit(2 * size).collect())
    return sorted({drawn[i * len(drawn) // n_blocks] for i in range(1, n_blocks)}) if drawn else []


def order_bounds(df: DataFrame, order_col: str, n_blocks: int | None = None) -> list[float]:
    """Block boundaries of an order column, to share between several running
    totals over the same axis (computed once from a cheap source, e.g. the base
    table, instead of from each intermediate result)."""
    return block_boundaries(df.select(order_col), _numeric_projection(df, order_col), _n_blocks(df, n_blocks))


def running_totals(df: DataFrame, keys: list[str], order: list[str | Column],
                   values: dict[str, Column], exclusive: bool = True,
                   n_blocks: int | None = None, bounds: list[float] | None = None) -> DataFrame:
    """Append, for every ``name -> expr`` in ``values``, the sum of ``expr`` over the
    rows of the same ``keys`` group that come earlier in ``order`` (``exclusive``)
    or up to and including the row.  ``order`` must be a total order; the first
    order column must be numeric, date/time or string.  Empty sums are 0.
    ``bounds`` (from ``order_bounds``) skips the boundary pass over ``df``; any
    boundaries give the same result, they only set the balance of the blocks.
    Rows whose first order value is null come first; where there are any, the
    second order column cuts them into blocks of their own.
    """
    n = _n_blocks(df, n_blocks)
    tmp = {name: f"__v_{name}" for name in values}
    x = _numeric_projection(df, order[0])
    if bounds is None:
        bounds = block_boundaries(df, x, n)
        blank = df.filter(F.col(order[0]).isNull()) if isinstance(order[0], str) and len(order) > 1 \
            and isinstance(order[1], str) else None
        second = order_bounds(blank, order[1], n) if blank is not None and df.schema[order[0]].nullable else []
    else:
        second = []
    block = _bucket(x, bounds)
    if second:
        within = _bucket(_numeric_projection(df, order[1]), second)
        block = F.when(x.isNull(), within - len(second) - 1).otherwise(block)
    base = df.select("*", *[expr.alias(tmp[name]) for name, expr in values.items()], block.alias(_BLK))

    w_local = Window.partitionBy(*keys, _BLK).orderBy(*order)
    frame = w_local.rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    local = base.select(
        "*", *[F.coalesce(F.sum(tmp[name]).over(frame), F.lit(0)).alias(f"__l_{name}") for name in values])

    blocks = base.groupBy(*keys, _BLK).agg(*[F.sum(tmp[name]).alias(f"__t_{name}") for name in values])
    w_off = Window.partitionBy(*keys).orderBy(_BLK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        *[F.col(k).alias(f"__k_{i}") for i, k in enumerate(keys)], F.col(_BLK).alias("__kb"),
        *[F.coalesce(F.sum(f"__t_{name}").over(w_off), F.lit(0)).alias(f"__o_{name}") for name in values])

    cond = [F.col(k).eqNullSafe(F.col(f"__k_{i}")) for i, k in enumerate(keys)] + [F.col(_BLK) == F.col("__kb")]
    joined = local.join(offsets, cond, "inner")
    out_cols = [F.col(c) for c in df.columns]
    out_cols += [(F.col(f"__l_{name}") + F.col(f"__o_{name}")).alias(name) for name in values]
    return joined.select(*out_cols)


def last_known(df: DataFrame, keys: list[str], order: list[str], values: dict[str, Column],
               n_blocks: int | None = None, bounds: list[float] | None = None) -> DataFrame:
    """Append, for every ``name -> expr`` in ``values``, the last non-null value of
    ``expr`` among the rows of the same ``keys`` group that come earlier in ``order``
    (a total order; its first column numeric, date/time or string); null where there
    is none.

    Blocks as in ``running_totals``, but what a block hands on is the latest known
    value ("latest wins" is as associative as a sum), so a hot key is many blocks.
    """
    x = _numeric_projection(df, order[0])
    if bounds is None:
        bounds = block_boundaries(df, x, _n_blocks(df, n_blocks))
    own = {name: f"__v_{name}" for name in values}
    base = df.select("*", *[expr.alias(own[name]) for name, expr in values.items()], _bucket(x, bounds).alias(_BLK))
    before = Window.partitionBy(*keys, _BLK).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = base.select("*", *[F.last(own[name], ignorenulls=True).over(before).alias(f"__l_{name}") for name in values])
    at = F.struct(*[F.col(c) for c in order])
    blocks = base.groupBy(*keys, _BLK).agg(*[F.max_by(v, F.when(F.col(v).isNotNull(), at)).alias(v) for v in own.values()])
    earlier = Window.partitionBy(*keys).orderBy(_BLK).rowsBetween(Window.unboundedPreceding, -1)
    handed = blocks.select(*[F.col(k).alias(f"__k_{i}") for i, k in enumerate(keys)], F.col(_BLK).alias("__kb"),
                           *[F.last(own[name], ignorenulls=True).over(earlier).alias(f"__o_{name}") for name in values])
    cond = [F.col(k).eqNullSafe(F.col(f"__k_{i}")) for i, k in enumerate(keys)] + [F.col(_BLK) == F.col("__kb")]
    return local.join(handed, cond).select(*df.columns, *[F.coalesce(f"__l_{name}", f"__o_{name}").alias(name) for name in values])


def rank_histogram(df: DataFrame, value: str, keys: list[str] | None = None,
                   n_blocks: int | None = None) -> DataFrame:
    """Per distinct (keys, value): tie count ``ties`` and pandas-style average rank
    ``avg_rank`` (1-based).  Nulls are not ranked.

    Counts per distinct value, then the running count of smaller values
    (``running_totals``), so no single-partition window is needed:
    rank = smaller + (ties + 1) / 2.
    """
    keys = keys or []
    hist = (df.filter(F.col(value).isNotNull())
              .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("ties")))
    bounds = order_bounds(df.filter(F.col(value).isNotNull()), value, n_blocks)  # one-column pass over the input
    cum = running_totals(hist, keys, [value], {"below": F.col("ties")}, exclusive=True,
                         n_blocks=n_blocks, bounds=bounds)
    return cum.select(*keys, value, "ties", (F.col("below") + (F.col("ties") + 1) / 2.0).alias("avg_rank"))


def quantiles(df: DataFrame, wanted: dict[str, tuple[Column, list[float]]], by: list[str] | None = None,
              n_blocks: int | None = None) -> DataFrame:
    """Exact linearly interpolated quantiles: ``by`` columns plus, per ``name ->
    (value, probabilities)``, an array column (null where a group has no value).

    No group's values meet in one buffer: values are counted per distinct value,
    a blocked running count gives their positions, and every quantile picks the
    two neighbouring positions by a conditional maximum.  Without ``by`` the
    result is one row, without rows too.
    """
    by = by or []
    long = df.select(*by, F.explode(F.array(*[F.struct(F.lit(name).alias("c"), value.cast("double").alias("x"))
                                              for name, (value, _) in wanted.items()])).alias("__e")) \
        .select(*by, F.col("__e.c").alias("__c"), F.col("__e.x").alias("__x")).filter(F.col("__x").isNotNull())
    hist = long.groupBy(*by, "__c", "__x").agg(F.count(F.lit(1)).alias("__held"))
    at = running_totals(hist, [*by, "__c"], ["__x"], {"__before": F.col("__held")}, n_blocks=n_blocks)
    sizes = hist.groupBy(*[F.col(k).alias(f"__by{i}") for i, k in enumerate(by)], F.col("__c").alias("__of")) \
        .agg(F.sum("__held").alias("__size"))
    same = [F.col(k).eqNullSafe(F.col(f"__by{i}")) for i, k in enumerate(by)] + [F.col("__c") == F.col("__of")]
    probs = sorted({p for _, ps in wanted.values() for p in ps})
    holds = lambda place: F.max(F.when((F.col("__before") <= place) &
                                       (place < F.col("__before") + F.col("__held")), F.col("__x")))
    picked = at.join(sizes, same).groupBy(*by, "__c").agg(
        F.first("__size").alias("__size"),
        *[agg for i, p in enumerate(probs) for place in [(F.col("__size") - 1) * F.lit(float(p))]
          for agg in (holds(F.floor(place)).alias(f"__lo{i}"), holds(F.ceil(place)).alias(f"__hi{i}"))])
    value = {p: F.when(F.col(f"__lo{i}") == F.col(f"__hi{i}"), F.col(f"__lo{i}")).otherwise(
        F.col(f"__lo{i}") * (1 - frac) + F.col(f"__hi{i}") * frac)
        for i, p in enumerate(probs) for frac in [F.pmod((F.col("__size") - 1) * F.lit(float(p)), F.lit(1.0))]}
    return picked.groupBy(*by).agg(*[
        F.max(F.when(F.col("__c") == name, F.array(*[value[p] for p in ps]))).alias(name) for name, (_, ps) in wanted.items()])


def modes(df: DataFrame, wanted: dict[str, Column]) -> dict:
    """Most frequent non-null value per name (ties: the smallest), by counts per value."""
    return {name: (df.select(value.alias("v")).filter(F.col("v").isNotNull()).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
                   .agg(F.min_by("v", F.struct(-F.col("n"), F.col("v")))).first()[0]) for name, value in wanted.items()}


def average_rank(df: DataFrame, value: str, keys: list[str] | None = None,
                 rank_col: str = "avg_rank", n_blocks: int | None = None) -> DataFrame:
    """``df`` with the average rank of ``value`` within ``keys`` (null -> null)."""
    keys = keys or []
    ranks = rank_histogram(df, value, keys, n_blocks).select(*keys, value, F.col("avg_rank").alias(rank_col))
    return df.join(ranks, on=[*keys, value], how="left")


# Salt buckets of the two-phase top-n.
TOP_N_SALTS = 64


def top_n(df: DataFrame, group: list[str], order: list[str | Column], n: int, rank_col: str = "rank",
          salt_by: list[str] | None = None, salts: int = TOP_N_SALTS) -> DataFrame:
    """The first ``n`` rows of each group in ``order`` (a total order), with their
    1-based rank.  Two phases so a hot group is not ranked in one task: top-n
    per (group, salt) with the salt a hash of ``salt_by`` columns, then top-n
    over the at most n x salts survivors of each group."""
    salt_cols = salt_by or [c for c in df.columns if c not in group][:4]
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(c) for c in salt_cols]), F.lit(salts)))
    w1 = Window.partitionBy(*group, "__salt").orderBy(*order)
    first = salted.withColumn("__r1", F.row_number().over(w1)).filter(F.col("__r1") <= n).drop("__r1", "__salt")
    w2 = Window.partitionBy(*group).orderBy(*order)
    return first.withColumn(rank_col, F.row_number().over(w2)).filter(F.col(rank_col) <= n)
