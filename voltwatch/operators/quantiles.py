"""Exact quantiles without holding a group in one task (A3, A8, A10, W3,
W6, W7 at scale).

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer, which is fine for an ordinary entity but not for a
global column or a hot group of continuous readings.  Here:

1. one aggregate per group: count n and a bounded-memory sketch
   (``percentile_approx``, rank error <= n / accuracy) of every column at q -/+
   a margin.  The sketch is coarse: fine ones cost more than all other steps;
2. the sketch values bound a narrow band of ranks around each target rank;
   one pass counts the rows below the bands, another keeps only the band rows
   (about 2 * margin * n per quantile), a value that many share as one;
3. a band is cut into ``CUTS`` bins, one aggregate adds up the weights of each,
   and the bin with the target rank becomes the range, until few values are
   left, which a window ranks.  The values at ranks floor(q (n-1)) and
   ceil(q (n-1)) are interpolated linearly, as pandas.

If a band misses its target rank (it cannot, by the sketch's guarantee, but
the check is cheap) all values are narrowed in the same way.  So no task
ever holds all values of a group, or of a band.  Results equal ``percentile``
exactly.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltwatch.config import DEFAULT_SCALE
from voltwatch.plans.layout import materialize, null_safe

ACCURACY = 10_000
#: Half width of a band, in sketch errors.
MARGIN = 3.0
#: Bins of a narrowing step, and distinct values that one window may rank.
CUTS, FEW = 1024, 100_000


def narrowed(values: DataFrame, targets: DataFrame, keys: list[str], few: int = FEW) -> DataFrame:
    """targets (keys and ``_vw_rank``, from 0) with the value at that rank, ``_vw_at``.

    ``values`` are the weighted distinct values (keys, _vw_v, _vw_w).  Every
    round keeps, per target, the bin of its rank: its least and largest value
    and the weight in front of it.  The first and last bin hold only the least
    and largest value themselves, so each round leaves values out.
    """
    a, b = F.col("_vw_a"), F.col("_vw_b")
    own = [*keys, "_vw_rank"]
    ends = null_safe(targets, values.groupBy(*keys).agg(F.min("_vw_v").alias("_vw_a"), F.max("_vw_v").alias("_vw_b"), F.count(F.lit(1)).alias("_vw_c")), keys, "inner")
    ends = materialize(ends.withColumn("_vw_below", F.lit(0).cast("long")))
    while (ends.agg(F.max("_vw_c")).first()[0] or 0) > few:
        inside = null_safe(values, ends, keys, "inner").where((F.col("_vw_v") >= a) & (F.col("_vw_v") <= b))
        share = F.nanvl((F.col("_vw_v") - a) / (b - a), F.lit(0.5))
        cut = F.when(F.col("_vw_v") <= a, 0).when(F.col("_vw_v") >= b, CUTS - 1).otherwise(1 + F.least(F.floor(share * (CUTS - 2)), F.lit(CUTS - 3)))
        bins = inside.groupBy(*own, "_vw_below", cut.alias("_vw_cut")).agg(
            F.sum("_vw_w").alias("_vw_w"), F.count(F.lit(1)).alias("_vw_c"), F.min("_vw_v").alias("_vw_a"), F.max("_vw_v").alias("_vw_b"))
        w = Window.partitionBy(*own).orderBy("_vw_cut")  # at most CUTS rows a target
        bins = bins.withColumn("_vw_end", F.col("_vw_below") + F.sum("_vw_w").over(w))
        held = bins.where((F.col("_vw_rank") < F.col("_vw_end")) & (F.col("_vw_rank") >= F.col("_vw_end") - F.col("_vw_w")))
        ends = materialize(held.withColumn("_vw_below", F.col("_vw_end") - F.col("_vw_w")).select(*own, "_vw_a", "_vw_b", "_vw_c", "_vw_below"))
    rest = null_safe(values, ends, keys, "inner").where((F.col("_vw_v") >= a) & (F.col("_vw_v") <= b))
    end = F.col("_vw_below") + F.sum("_vw_w").over(Window.partitionBy(*own).orderBy("_vw_v"))  # at most ``few`` rows
    rest = rest.withColumn("_vw_end", end)
    at = (F.col("_vw_rank") < F.col("_vw_end")) & (F.col("_vw_rank") >= F.col("_vw_end") - F.col("_vw_w"))
    return rest.where(at).select(*own, F.col("_vw_v").alias("_vw_at"))


def exact_quantiles(df: DataFrame, by, cols, qs, accuracy: int = ACCURACY,
                    broadcast_rows: int = DEFAULT_SCALE.broadcast_rows) -> DataFrame:
    """Return one row per group with an ``array<double>`` of the quantiles
    ``qs`` for every column (NULL when the group has no value)."""
    by, cols, qs = list(by), list(cols), [float(q) for q in qs]
    m = df.select(*by, F.inline(F.array(*[
        F.struct(F.lit(c).alias("_vw_f"), F.col(c).cast("double").alias("_vw_v")) for c in cols])))
    m = m.where(F.col("_vw_v").isNotNull())
    keys = by + ["_vw_f"]
    # a value that many rows share is one weighted row from here on
    values = m.groupBy(*keys, "_vw_v").agg(F.count(F.lit(1)).alias("_vw_w"))
    margin = MARGIN / accuracy
    fr = sorted({min(1.0, max(0.0, q + s * margin)) for q in qs for s in (-1, 1)})
    pos = {f: i for i, f in enumerate(fr)}
    xs = df.select(*by, *[F.col(c).cast("double").alias(f"_vw_x{i}") for i, c in enumerate(cols)])
    sk = xs.groupBy(*by).agg(*[x for i in range(len(cols)) for x in (
        F.count(f"_vw_x{i}").alias(f"_vw_n{i}"), F.percentile_approx(f"_vw_x{i}", fr, accuracy).alias(f"_vw_ap{i}"))])
    sk = materialize(sk)
    limits = sk
    if by and sk.count() <= broadcast_rows:
        limits = F.broadcast(sk)
    # one row per group beside its rows: which bands hold a value, and how many values lie below each band
    j = null_safe(xs, limits, by, "inner") if by else xs.crossJoin(F.broadcast(sk))
    spots = [(i, k, F.col(f"_vw_x{i}"), *(F.col(f"_vw_ap{i}")[pos[min(1.0, max(0.0, q + s * margin))]] for s in (-1, 1)))
             for i in range(len(cols)) for k, q in enumerate(qs)]
    below = j.groupBy(*by).agg(*[F.count_if(x < a).alias(f"_vw_b{i}_{k}") for i, k, x, a, _ in spots])
    named = lambda i, k, *more: F.struct(F.lit(cols[i]).alias("_vw_f"), F.lit(k).alias("_vw_q"), *more)
    below = below.select(*by, F.inline(F.array(*[named(i, k, F.col(f"_vw_b{i}_{k}").alias("_vw_below")) for i, k, *_ in spots])))
    hits = F.array_compact(F.array(*[F.when((x >= a) & (x <= b), named(i, k, x.alias("_vw_v"))) for i, k, x, a, b in spots]))
    own = [*keys, "_vw_q"]
    band = materialize(j.select(*by, F.inline(hits)).groupBy(*own, "_vw_v").agg(F.count(F.lit(1)).alias("_vw_w")))

    ranks = sk.select(*by, F.inline(F.array(*[
        named(i, k, F.lit(q).alias("_vw_qv"), F.col(f"_vw_n{i}").alias("_vw_n")) for i in range(len(cols)) for k, q in enumerate(qs)])))
    pos_expr = F.col("_vw_qv") * (F.col("_vw_n") - 1)
    ranks = ranks.where("_vw_n > 0").withColumn("_vw_lo", F.floor(pos_expr).cast("long")).withColumn("_vw_hi", F.ceil(pos_expr).cast("long"))
    ranks = materialize(null_safe(ranks, below, own))
    # a band is ranked like a whole column, from the rank it begins with
    inner = ranks.select(*own, F.explode(F.array_distinct(F.array(*[F.col(r) - F.col("_vw_below") for r in ("_vw_lo", "_vw_hi")]))).alias("_vw_rank"))
    at = materialize(narrowed(band, inner, own))
    res = ranks
    for r, v in (("_vw_lo", "_vw_vlo"), ("_vw_hi", "_vw_vhi")):
        here = at.withColumnRenamed("_vw_at", v)
        res = null_safe(res.withColumn("_vw_rank", F.col(r) - F.col("_vw_below")), here, [*own, "_vw_rank"]).drop("_vw_rank")
    res = res.persist()
    missed = res.where(F.col("_vw_vlo").isNull() | F.col("_vw_vhi").isNull())
    if not missed.isEmpty():
        targets = missed.select(*keys, F.explode(F.array("_vw_lo", "_vw_hi")).alias("_vw_rank")).distinct()
        at = materialize(narrowed(values, targets, keys))
        for r, v in (("_vw_lo", "_vw_vlo"), ("_vw_hi", "_vw_vhi")):
            res = null_safe(res, at.withColumnRenamed("_vw_rank", r), [*keys, r]).withColumn(v, F.coalesce(v, "_vw_at")).drop("_vw_at")
    frac = F.col("_vw_qv") * (F.col("_vw_n") - 1) - F.col("_vw_lo")
    between = F.col("_vw_vlo") + (F.col("_vw_vhi") - F.col("_vw_vlo")) * frac
    res = res.withColumn("_vw_val", F.when((frac == 0) | (F.col("_vw_vlo") == F.col("_vw_vhi")), F.col("_vw_vlo")).otherwise(between))
    out = res.groupBy(*by).pivot("_vw_f", cols).agg(
        F.sort_array(F.collect_list(F.struct("_vw_q", "_vw_val"))).alias("a"))
    sel = [F.col(c) for c in by]
    for c in cols:
        sel.append(F.when(F.size(c) > 0, F.transform(F.col(c), lambda s: s["_vw_val"])).alias(c))
    if not by:
        return out.select(*sel) if out.columns else out
    return null_safe(df.select(*by).distinct(), out.select(*sel), by)  # a group without values has none in m


def _check(qs):
    for q in qs:
        if not 0.0 <= q <= 1.0 or math.isnan(q):
            raise ValueError(f"quantile out of range: {q}")


def quantiles(df: DataFrame, by, cols, qs, scale=DEFAULT_SCALE, max_group: int | None = None) -> DataFrame:
    """Exact quantiles per group, one row per group, ``array<double>`` per
    column.  Groups of at most ``scale.hot_entity_rows`` rows use Spark's
    ``percentile`` (its buffer is then bounded); larger groups use the
    banded method above, so no task holds a large group's values.
    ``max_group`` skips the size job when the caller knows it."""
    by, cols, qs = list(by), list(cols), [float(q) for q in qs]
    _check(qs)
    if max_group is None:
        if by:
            max_group = df.groupBy(*by).count().agg(F.max("count")).first()[0] or 0
        else:
            max_group = df.count()
    if max_group <= scale.hot_entity_rows:
        arr = F.array(*[F.lit(q) for q in qs])
        aggs = [F.percentile(F.col(c).cast("double"), arr).alias(c) for c in cols]
        return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    return exact_quantiles(df, by, cols, qs, broadcast_rows=scale.broadcast_rows)
