"""Cleaning: fills (W1-W5) and quantile clipping.

All per-entity work runs through a :class:`~voltwatch.plans.layout.Layout`:
one shuffle by entity for ordinary entities; hot entities are split into
segments and stitched back with carries (fills) or a per-entity aggregate
(group statistics), so no task ever holds a whole hot entity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltwatch.config import DEFAULT_SCALE, Columns, Scale
from voltwatch.functions.columns import nan_to_null, numeric_present, present
from voltwatch.operators.quantiles import quantiles
from voltwatch.plans.layout import SEG, Layout, finish, null_safe, prepare

FILL_METHODS = ("ffill", "mean", "median")


def impute(
    df: DataFrame,
    cfg: Columns,
    cols,
    method: str = "ffill",
    layout: Layout | None = None,
    scale: Scale = DEFAULT_SCALE,
    residual: float | None = 0.0,
) -> DataFrame:
    """Fill NULL/NaN per entity (or over the whole table when
    ``cfg.entity`` is None).

    ffill   forward fill in (time, tie) order, then backward fill
    mean    entity mean; median: entity median (exact, linear interpolation)
    Whatever is still NULL (an entity with no value at all) becomes
    ``residual`` (W4).  Absent columns are skipped (W12).
    """
    if method not in FILL_METHODS:
        raise ValueError(f"Unsupported imputation method: {method}")
    cols = present(df, cols)
    if not cols:
        return df
    types = {f.name: f.dataType for f in df.schema.fields}
    df = df.select(*[nan_to_null(c, types[c]).alias(c) if c in cols else F.col(c)
                     for c in df.columns])
    if method == "ffill":
        out = _fill_ffill_bfill(df, cfg, cols, layout, scale)
    else:
        out = _fill_stat(df, cfg, cols, method, layout, scale)
    if residual is not None:
        out = out.fillna(residual, subset=cols)
    return out


def _fill_ffill_bfill(df, cfg, cols, layout, scale):
    lay, d, added = prepare(df, cfg, layout, scale)
    fwd = lay.window().rowsBetween(Window.unboundedPreceding, 0)
    # backward fill = a running "last non-null" in reversed order: Spark
    # evaluates a current..unbounded-following frame once per row (O(n^2)),
    # a running frame once per partition (same exchange, one more sort)
    bwd = lay.window(reverse=True).rowsBetween(Window.unboundedPreceding, 0)
    car = lay.carries(d, cols)
    if car is not None:
        keys = ([cfg.entity] if cfg.entity else []) + [SEG]
        d = null_safe(d, car, keys)
    # reversed-order window first, so the ascending order that follows is
    # kept by every later window of the chain (2 sorts in all, not 3)
    d = d.withColumns({f"_vw_bf_{c}": F.last(c, True).over(bwd) for c in cols})
    exprs = {}
    for c in cols:
        parts = [F.last(c, True).over(fwd)]
        if car is not None:
            parts.append(F.col(f"_vw_prev_{c}"))
        parts.append(F.col(f"_vw_bf_{c}"))
        if car is not None:
            parts.append(F.col(f"_vw_next_{c}"))
        exprs[c] = F.coalesce(*parts)
    out = d.withColumns(exprs).drop(*[f"_vw_bf_{c}" for c in cols])
    if car is not None:
        out = out.drop(*[f"_vw_{k}_{c}" for c in cols for k in ("prev", "next")])
    return finish(lay, out, added)


def _stat_expr(c: str, method: str) -> Column:
    if method == "mean":
        return F.avg(c)
    return F.percentile(F.col(c), F.lit(0.5))


def group_stats(df: DataFrame, cfg: Columns, aggs: dict[str, Column], lay: Layout) -> DataFrame:
    """Attach per-entity aggregates to every row.

    Not segmented: a window aggregate over the entity partition that the
    surrounding window stages already shuffled, so no extra exchange and no
    join.  Segmented: a real aggregate by entity (partial aggregation on the
    map side) joined back; broadcast only when the entity count is within
    ``Scale.broadcast_rows``, otherwise a shuffle join that AQE splits when
    skewed.  Global: one aggregate row, applied as literals.
    """
    if cfg.entity is None:
        row = df.agg(*[a.alias(n) for n, a in aggs.items()]).first()
        return df.withColumns({n: F.lit(row[n]).cast("double") for n in aggs})
    if not lay.segmented:
        w = Window.partitionBy(cfg.entity)
        return df.withColumns({n: a.over(w) for n, a in aggs.items()})
    stats = df.groupBy(cfg.entity).agg(*[a.alias(n) for n, a in aggs.items()])
    if lay.n_entities <= lay.scale.broadcast_rows:
        stats = F.broadcast(stats)
    return null_safe(df, stats, [cfg.entity])


def _fill_stat(df, cfg, cols, method, layout, scale):
    lay, d, added = prepare(df, cfg, layout, scale, need_layout=cfg.entity is not None)
    if method == "median" and (cfg.entity is None or lay.segmented):
        # large groups: exact median without one task holding the group
        d = _attach_quantiles(d, cfg, cols, [0.5], lay, scale, "_vw_s_")
        d = d.withColumns({f"_vw_s_{c}": F.col(f"_vw_s_{c}")[0] for c in cols})
    else:
        d = group_stats(d, cfg, {f"_vw_s_{c}": _stat_expr(c, method) for c in cols}, lay)
    out = d.withColumns({c: F.coalesce(F.col(c), F.col(f"_vw_s_{c}")) for c in cols})
    out = out.drop(*[f"_vw_s_{c}" for c in cols])
    return finish(lay, out, added)


def _attach_quantiles(d, cfg, cols, qs, lay, scale, prefix):
    """Per-entity (or global) exact quantile arrays as columns ``prefix+c``."""
    if cfg.entity is None:
        row = quantiles(d, [], cols, qs, scale).first()
        return d.withColumns({
            f"{prefix}{c}": F.array(*[F.lit(None if row[c] is None else v).cast("double")
                                      for v in (row[c] or [None] * len(qs))])
            for c in cols})
    # segmented means some entity exceeds hot_entity_rows: no size job needed
    q = quantiles(d, [cfg.entity], cols, qs, scale,
                  max_group=scale.hot_entity_rows + 1 if lay.segmented else None)
    q = q.select(cfg.entity, *[F.col(c).alias(f"{prefix}{c}") for c in cols])
    if lay.n_entities <= lay.scale.broadcast_rows:
        q = F.broadcast(q)
    return null_safe(d, q, [cfg.entity])


def clip_quantiles(
    df: DataFrame,
    cfg: Columns,
    cols,
    lower: float = 0.01,
    upper: float = 0.99,
    exact: bool = True,
    layout: Layout | None = None,
    scale: Scale = DEFAULT_SCALE,
) -> DataFrame:
    """Clip each numeric column to its [lower, upper] quantiles per
    entity (or globally).  NULL stays NULL.  Absent or non-numeric columns
    are skipped.

    ``exact=True`` uses ``percentile`` (linear interpolation, as pandas);
    its buffer holds one counter per distinct value, merged map-side, so it
    is bounded by the distinct readings of an entity, not its rows.
    ``exact=False`` uses a bounded-memory sketch (``percentile_approx``).

    Note (H8): quantile clipping also trims real faults when the fault lasts
    longer than ``1 - upper`` of an entity's rows.
    """
    cols = numeric_present(df, cols)
    if not cols:
        return df
    lay, d, added = prepare(df, cfg, layout, scale, need_layout=cfg.entity is not None)

    if exact and (cfg.entity is None or lay.segmented):
        d = _attach_quantiles(d, cfg, cols, [lower, upper], lay, scale, "_vw_q_")
    else:
        def q(c):
            if exact:
                return F.percentile(F.col(c), F.array(F.lit(lower), F.lit(upper)))
            return F.percentile_approx(F.col(c), [lower, upper], scale.approx_accuracy).cast("array<double>")

        d = group_stats(d, cfg, {f"_vw_q_{c}": q(c) for c in cols}, lay) if cfg.entity else _global_q(d, cols, q)
    exprs = {}
    for c in cols:
        b = F.col(f"_vw_q_{c}")
        v = F.col(c)
        clipped = F.least(F.greatest(v, b[0]), b[1])
        exprs[c] = F.when(v.isNull(), v).otherwise(clipped.cast(df.schema[c].dataType))
    out = d.withColumns(exprs).drop(*[f"_vw_q_{c}" for c in cols])
    return finish(lay, out, added)


def _global_q(d, cols, q):
    row = d.agg(*[q(c).alias(c) for c in cols]).first()
    return d.withColumns({
        f"_vw_q_{c}": F.array(F.lit(row[c][0]).cast("double"), F.lit(row[c][1]).cast("double"))
        if row[c] is not None else F.array(F.lit(None).cast("double"), F.lit(None).cast("double"))
        for c in cols
    })


def changed_rows(before: DataFrame, after: DataFrame, keys, cols) -> DataFrame:
    """Rows whose value changed, per column (exact; comparing float sums
    as the reference does is fragile).  Both frames must share ``keys``."""
    a = before.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in cols])
    j = a.join(after.select(*keys, *cols), list(keys))
    return j.agg(*[
        F.count_if(~F.col(f"_b_{c}").eqNullSafe(F.col(c))).cast("long").alias(c) for c in cols
    ])
