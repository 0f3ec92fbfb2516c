"""Mergeable statistics: one row per period and feature, compared later without its rows.

A row holds counts, mean, second moment, extremes and a KLL quantile sketch,
whose size is bounded by ``K`` whatever the number of values (rank error about
1.6 / K).  Rows of days merge into weeks, months or a reference, and two such
rows give quantiles, the mean-shift flag, PSI and the KS gap.  Up to about K
values a sketch holds them all, so small periods are exact.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltwatch.functions.tails import ks_tail

#: Size parameter of the sketches, and points at which two of them are compared.
K, GRID = 4096, 200
PSI_BINS, PSI_EPS, MEAN_SHIFT_SIGMAS = 10, 1e-4, 2.0


def melted(df: DataFrame, cols, keep=()) -> DataFrame:
    """(keep..., feature, v) with one row per value; NaN counts as missing."""
    cells = [F.struct(F.lit(c).alias("feature"), F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias("v")) for c in cols]
    return df.select(*keep, F.inline(F.array(*cells)))


def statistics(k: int = K) -> list[Column]:
    """Aggregates of a column ``v``; all are map-side combined and bounded."""
    return [
        F.count("v").alias("n"), F.count_if(F.col("v").isNull()).cast("long").alias("nulls"), F.avg("v").alias("mean"),
        (F.var_pop("v") * F.count("v")).alias("m2"), F.min("v").alias("min"), F.max("v").alias("max"),
        F.kll_sketch_agg_double("v", F.lit(k)).alias("sketch"),
    ]


def sketch(df: DataFrame, cols, by=(), k: int = K) -> DataFrame:
    """One row of statistics per ``by`` key and feature."""
    return melted(df, cols, by).groupBy(*by, "feature").agg(*statistics(k))


def merge(parts: DataFrame, by=(), k: int = K) -> DataFrame:
    """Rows of statistics merged by the ``by`` columns and the feature (all parts of a feature with none)."""
    keys = [*by, "feature"]
    w = Window.partitionBy(*keys)  # one row per part and feature
    mean = F.try_divide(F.sum(F.col("n") * F.coalesce("mean", F.lit(0.0))).over(w), F.sum("n").over(w))
    d = parts.withColumn("_vw_mean", mean)
    off = F.coalesce(F.col("m2") + F.col("n") * F.pow(F.col("mean") - F.col("_vw_mean"), F.lit(2.0)), F.lit(0.0))
    return d.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.max("_vw_mean").alias("mean"),
        F.when(F.sum("n") > 0, F.sum(off)).alias("m2"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"),
    )


def std(n: str = "n", m2: str = "m2") -> Column:
    """Sample standard deviation; NULL below two values."""
    return F.when(F.col(n) > 1, F.sqrt(F.col(m2) / (F.col(n) - 1)))


def quantile(q: float | list[float], sketch_col: str = "sketch", n: str = "n") -> Column:
    """Quantile(s) of a sketch, a value of the data; NULL without values."""
    probe = F.array(*[F.lit(float(x)) for x in q]) if isinstance(q, list) else F.lit(float(q))
    return F.when(F.col(n) > 0, F.kll_sketch_get_quantile_double(sketch_col, probe))


def ranks(sketch_col: str, points: dict[str, list[float]], when: Column) -> Column:
    """Shares of values <= each of the feature's points, as an array; NULL where ``when`` fails."""
    cases = [F.when(when & (F.col("feature") == f), F.kll_sketch_get_rank_double(sketch_col, F.array(*[F.lit(x) for x in xs]))) for f, xs in points.items() if xs]
    return F.coalesce(*cases) if cases else F.lit(None).cast("array<double>")


def compare(ref: DataFrame, cur: DataFrame, by=(), sigmas: float = MEAN_SHIFT_SIGMAS, bins: int = PSI_BINS, eps: float = PSI_EPS) -> DataFrame:
    """Current rows (per ``by`` and feature) against one reference row per feature.

    Returns both sides' n, mean, std and median, ``mean_drift``, ``no_data``
    (no current value), ``psi`` on the reference's quantile bins, and the KS
    gap with its p-value.  The gap is read at and just below GRID quantiles of
    the reference, so it is within 1 / GRID plus the sketches' rank error of
    the exact one.  The driver sees these quantiles only, a fixed number per
    feature.
    """
    probes = ref.select("feature", quantile([i / bins for i in range(1, bins)]).alias("edges"), quantile([i / GRID for i in range(GRID + 1)]).alias("grid")).collect()
    edges = {r.feature: list(r.edges or []) for r in probes}
    grid = {r.feature: sorted({y for x in r.grid or [] for y in (x, math.nextafter(x, -math.inf))}) for r in probes}
    sides = []
    for d, p in ((ref, "ref"), (cur, "cur")):
        own = [F.col(c).alias(f"{p}_{c}") for c in ("n", "mean", "sketch")]
        sides.append(d.select(*(by if p == "cur" else ()), "feature", *own, std().alias(f"{p}_std"), quantile(0.5).alias(f"{p}_median")))
    d = sides[1].join(sides[0], "feature", "left")  # one reference row per feature
    both = F.coalesce((F.col("ref_n") > 0) & (F.col("cur_n") > 0), F.lit(False))

    def shares(p: str) -> Column:
        up = F.concat(F.array(F.lit(0.0)), ranks(f"{p}_sketch", edges, both), F.array(F.lit(1.0)))
        return F.transform(F.sequence(F.lit(1), F.lit(bins)), lambda i: F.greatest(F.get(up, i) - F.get(up, i - 1), F.lit(eps)))

    terms = F.zip_with(shares("ref"), shares("cur"), lambda p, q: (q - p) * F.log(q / p))
    gaps = F.zip_with(ranks("ref_sketch", grid, both), ranks("cur_sketch", grid, both), lambda a, b: F.abs(a - b))
    d = d.withColumns({"psi": F.when(both, F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)), "ks_gap": F.when(both, F.array_max(gaps))})
    shift = F.abs(F.col("cur_mean") - F.col("ref_mean")) > sigmas * F.col("ref_std")
    return d.select(
        *by, "feature", *(f"{p}_{c}" for c in ("n", "mean", "std", "median") for p in ("ref", "cur")),
        F.coalesce(shift, F.lit(False)).alias("mean_drift"), (F.col("cur_n") == 0).alias("no_data"), "psi", "ks_gap",
        ks_tail(F.col("ks_gap"), F.col("ref_n"), F.col("cur_n")).alias("ks_p"),
    )
