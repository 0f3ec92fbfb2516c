"""Profiles (A1-A10): one aggregate pass each, reported in long form
(one row per column) so that wide tables give narrow results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltwatch.config import DEFAULT_SCALE
from voltwatch.functions.columns import numeric_present, present
from voltwatch.operators.quantiles import quantiles
from voltwatch.plans.layout import small_side


def _long(df_one_row: DataFrame, cols: list[str], fields: list[str]) -> DataFrame:
    """Turn a one-row aggregate with columns ``{field}__{col}`` into one
    row per col (a stack over a single row: no shuffle)."""
    structs = [F.struct(F.lit(c).alias("column"), *[F.col(f"{f}__{c}").alias(f) for f in fields]) for c in cols]
    return df_one_row.select(F.inline(F.array(*structs)))


def null_profile(df: DataFrame, cols=None) -> DataFrame:
    """A1: NULL (and NaN) count per column, in one pass."""
    cols = present(df, cols or df.columns)
    types = {f.name: f.dataType.typeName() for f in df.schema.fields}

    def isnull(c):
        cond = F.col(c).isNull()
        if types[c] in ("double", "float"):
            cond = cond | F.isnan(c)
        return cond

    agg = df.agg(*[F.count_if(isnull(c)).cast("long").alias(f"nulls__{c}") for c in cols])
    return _long(agg, cols, ["nulls"])


def imputation_report(before: DataFrame, after: DataFrame, cols) -> DataFrame:
    """A2: NULLs removed per column (before - after), only columns > 0."""
    cols = present(before, cols)
    b = null_profile(before, cols).withColumnRenamed("nulls", "before")
    a = null_profile(after, cols).withColumnRenamed("nulls", "after")
    j = b.join(F.broadcast(a), "column")  # one row per column on both sides
    return j.select("column", (F.col("before") - F.col("after")).alias("imputed")).where("imputed > 0")


def describe(df: DataFrame, cols=None, exact: bool = True, accuracy: int = 10_000,
             scale=DEFAULT_SCALE) -> DataFrame:
    """A3: count, mean, std (sample), min, 25/50/75 %, max per numeric column.

    Exact percentiles interpolate linearly like pandas and never put a
    large column into one task (see ``operators.quantiles``); ``exact=False``
    uses a bounded sketch instead."""
    cols = numeric_present(df, cols or df.columns)
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"count__{c}"), F.avg(x).alias(f"mean__{c}"),
                 F.stddev_samp(x).alias(f"std__{c}"), F.min(x).alias(f"min__{c}"), F.max(x).alias(f"max__{c}")]
    if exact:
        qrow = quantiles(df, [], cols, [0.25, 0.5, 0.75], scale).first()
        qv = {c: (qrow[c] if qrow is not None and qrow[c] is not None else [None] * 3) for c in cols}
    else:
        aggs += [F.percentile_approx(F.col(c).cast("double"), [0.25, 0.5, 0.75], accuracy).alias(f"q__{c}")
                 for c in cols]
    one = df.agg(*aggs)
    sel = []
    for c in cols:
        if exact:
            qs = [F.lit(v).cast("double") for v in qv[c]]
        else:
            qs = [F.col(f"q__{c}")[i] for i in range(3)]
        sel += [F.col(f"count__{c}"), F.col(f"mean__{c}"), F.col(f"std__{c}"), F.col(f"min__{c}"),
                qs[0].alias(f"p25__{c}"), qs[1].alias(f"p50__{c}"), qs[2].alias(f"p75__{c}"), F.col(f"max__{c}")]
    return _long(one.select(*sel), cols, ["count", "mean", "std", "min", "p25", "p50", "p75", "max"])


def schema_profile(df: DataFrame, cols=None) -> DataFrame:
    """A4: Spark type and non-null count per column."""
    cols = present(df, cols or df.columns)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    agg = df.agg(*[F.count(c).alias(f"non_null__{c}") for c in cols])
    agg = agg.select(*[x for c in cols for x in (F.lit(types[c]).alias(f"type__{c}"), F.col(f"non_null__{c}"))])
    return _long(agg, cols, ["type", "non_null"])


def value_counts(df: DataFrame, col: str, by_label: bool = False) -> DataFrame:
    """A5: count and share per value; ``by_label`` sorts by the value."""
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    total = df.count()  # a scalar; no single-partition window over the groups
    out = g.withColumn("share", F.col("count") / F.lit(total if total else None).cast("double"))
    return out.orderBy(col) if by_label else out


def distinct_values(df: DataFrame, cols) -> DataFrame:
    """Distinct rows over ``cols`` (unique values, distinct pairs)."""
    return df.select(*cols).distinct()


def distinct_counts(df: DataFrame, cols=None, approx: bool = False) -> DataFrame:
    """Number of distinct non-null values per column."""
    cols = present(df, cols or df.columns)
    fn = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.count_distinct(c))
    agg = df.agg(*[fn(c).cast("long").alias(f"distinct__{c}") for c in cols])
    return _long(agg, cols, ["distinct"])


def group_quantiles(df: DataFrame, by, col: str, qs=(0.5,), exact: bool = True, scale=DEFAULT_SCALE) -> DataFrame:
    """Per-group mean, median and quantiles (NULLs skipped, linear
    interpolation)."""
    g = df.groupBy(*by).agg(F.avg(col).alias("mean"))
    if exact:
        q = quantiles(df, by, [col], qs, scale).withColumnRenamed(col, "_q")
    else:
        q = df.groupBy(*by).agg(F.percentile_approx(col, list(qs), 10_000).alias("_q"))
    g = g.join(q, list(by))  # both one row per group
    return g.select(*by, "mean", *[F.col("_q")[i].alias(f"q{int(round(x * 100)):02d}") for i, x in enumerate(qs)])


def box_stats(df: DataFrame, cols, by=None, whisker: float = 1.5,
              broadcast_rows: int = DEFAULT_SCALE.broadcast_rows) -> DataFrame:
    """A10: quartiles, IQR, whiskers (most extreme values within
    ``whisker`` IQR of the box) and outlier count per column (and group).

    Melted first, so it is two aggregations keyed by (group, column)."""
    cols = numeric_present(df, cols)
    by = list(by or [])
    m = df.select(*by, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols])))
    keys = by + ["column"]
    q = quantiles(m, keys, ["v"], [0.25, 0.5, 0.75]).withColumnRenamed("v", "_q")
    q = q.select(*keys, F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q3"))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    q = q.withColumn("lo_fence", F.col("q1") - whisker * F.col("iqr")).withColumn(
        "hi_fence", F.col("q3") + whisker * F.col("iqr"))
    # one row per (group, column): broadcast when the group count is bounded
    j = m.join(small_side(q, broadcast_rows) if by else F.broadcast(q), keys)
    inside = (F.col("v") >= F.col("lo_fence")) & (F.col("v") <= F.col("hi_fence"))
    s = j.groupBy(*keys, "q1", "median", "q3", "iqr").agg(
        F.min(F.when(inside, F.col("v"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_hi"),
        F.count_if(F.col("v").isNotNull() & ~inside).cast("long").alias("outliers"),
    )
    return s


def change_count(before: DataFrame, after: DataFrame, keys, cols) -> DataFrame:
    """A9 probe in long form: rows whose value changed per column."""
    from voltwatch.operators.clean import changed_rows
    one = changed_rows(before, after, keys, cols)
    return _long(one.select(*[F.col(c).alias(f"changed__{c}") for c in cols]), list(cols), ["changed"])
