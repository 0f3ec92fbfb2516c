"""Labelling and data-quality operators re-aimed from the generators
(G1-G7).  Random draws are md5 uniforms of (seed, row key, column), so a
rerun, a retried task or another engine gives the same rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltwatch.config import DEFAULT_SCALE, Columns, Scale
from voltwatch.functions.columns import uniform
from voltwatch.operators.features import with_frames
from voltwatch.plans.layout import finish, prepare, running

# Fixed values of the reference's generators.
NOISE_SIGMA = {
    "Module_Avg_Surface_Temp_C": 0.2,
    "Module_Max_Surface_Temp_C": 0.25,
    "Module_Voltage_V": 0.05,
    "Module_Current_A": 0.1,
    "Sim_OffGas_CO_ppm_proxy": 5.0,
    "Sim_OffGas_H2_ppm_proxy": 5.0,
    "Sim_OffGas_VOC_ppm_proxy": 5.0,
    "Ambient_Temp_Rack_C": 0.1,
}
DEFAULT_SIGMA = 0.1
MISSING_RATE_PERCENT = 0.05
OUTLIER_RATE_PERCENT = 0.01
OUTLIER_FACTOR = 7
PREDICTION_WINDOW_S = 20 * 60
GUARD_S = 30
CRITICAL_TEMP = 140.0
CRITICAL_RATE_PER_S = 0.5
RATE_MIN_TEMP = 110.0
FAULT_RAMPS = {
    "Module_Avg_Surface_Temp_C": (10.0, 60.0, 2, None, None),
    "Module_Voltage_V": (-2.0, -15.0, 1, 30.0, None),
    "Module_SoC_percent": (-5.0, -40.0, 1, 0.0, None),
    "Sim_OffGas_CO_ppm_proxy": (50.0, 400.0, 1, None, None),
    "Sim_OffGas_H2_ppm_proxy": (60.0, 500.0, 1, None, None),
    "Sim_OffGas_VOC_ppm_proxy": (70.0, 600.0, 1, None, None),
}


def _key(cfg: Columns) -> list[Column]:
    return [F.col(c) for c in cfg.keys()]


def gaussian(seed, *parts) -> Column:
    """Standard normal draw by Box-Muller from two md5 uniforms."""
    u1 = uniform(seed, *parts, F.lit("n1"))
    u2 = uniform(seed, *parts, F.lit("n2"))
    return F.sqrt(-2.0 * F.log(1.0 - u1)) * F.cos(2.0 * math.pi * u2)


def inject(df: DataFrame, cfg: Columns, cols, sigma: dict | None = None,
           p_missing: float = MISSING_RATE_PERCENT, p_outlier: float = OUTLIER_RATE_PERCENT,
           factor: float = OUTLIER_FACTOR, seed: int = 42, noise: bool = False,
           key: list[str] | None = None) -> DataFrame:
    """G1: per cell, NULL with probability p_missing %; otherwise an outlier
    shift of +/- factor * sigma with probability p_outlier %; missing wins.
    ``noise`` adds Gaussian noise of sigma first.  Draws are keyed by
    ``key`` columns (default: entity, time, tie)."""
    sigma = sigma or NOISE_SIGMA
    key = [F.col(c) for c in key] if key else _key(cfg)
    out = {}
    for c in cols:
        s = float(sigma.get(c, DEFAULT_SIGMA))
        v = F.col(c).cast("double")
        if noise:
            v = v + s * gaussian(seed, *key, F.lit(c))
        um = uniform(seed, *key, F.lit(c), F.lit("m"))
        uo = uniform(seed, *key, F.lit(c), F.lit("o"))
        sign = F.when(uniform(seed, *key, F.lit(c), F.lit("s")) < 0.5, F.lit(-1.0)).otherwise(F.lit(1.0))
        out[c] = (F.when(um * 100 < p_missing, F.lit(None).cast("double"))
                  .when(uo * 100 < p_outlier, v + sign * factor * s).otherwise(v))
    return df.withColumns(out)


def rate_per_second(df: DataFrame, cfg: Columns, col: str, out: str | None = None,
                    layout=None, scale: Scale = DEFAULT_SCALE) -> DataFrame:
    """Change per second between consecutive rows of an entity (0 for
    the first row or when no time passed)."""
    out = out or f"Rate_{col}"
    lay, d, added = prepare(df, cfg, layout, scale)
    w = lay.window()
    t = F.col(cfg.time)
    dt = F.timestamp_diff("MICROSECOND", F.lag(t, 1).over(w), t)  # zone-free for timestamp_ntz
    e = {out: F.coalesce(F.when(dt > 0, (F.col(col) - F.lag(col, 1).over(w)) / (dt / 1e6)), F.lit(0.0))}
    res = with_frames(d, cfg, e, 1, lay, scale)
    return finish(lay, res, added)


def first_event(df: DataFrame, cfg: Columns, cond: Column, out: str = "event_time") -> DataFrame:
    """First time per entity at which ``cond`` holds (one row per entity
    that has such a time); an aggregate with map-side combine."""
    by = [cfg.entity] if cfg.entity else []
    g = df.where(cond).groupBy(*by).agg(F.min(cfg.time).alias(out))
    return g


def critical_condition(temp: str, rate: str, temp_max: float = CRITICAL_TEMP,
                       rate_max: float = CRITICAL_RATE_PER_S, rate_temp: float = RATE_MIN_TEMP) -> Column:
    """The reference's point of no return: T >= 140, or rate >= 0.5/s with
    T > 110."""
    return (F.col(temp) >= temp_max) | ((F.col(rate) >= rate_max) & (F.col(temp) > rate_temp))


def horizon_label(df: DataFrame, cfg: Columns, events: DataFrame, window_s: int = PREDICTION_WINDOW_S,
                  guard_s: int = GUARD_S, out: str = "horizon_label", event_col: str = "event_time") -> DataFrame:
    """1 when event - window - guard <= t < event - guard, else 0.
    ``events`` has one row per entity (from :func:`first_event`) and is
    joined by entity (a broadcast when it is small, AQE decides)."""
    by = [cfg.entity] if cfg.entity else []
    t = F.col(cfg.time)
    ev = F.col(event_col)
    lo = ev - F.make_dt_interval(secs=F.lit(window_s + guard_s))
    hi = ev - F.make_dt_interval(secs=F.lit(guard_s))
    if by:
        from voltwatch.plans.layout import small_side
        # one row per entity with an event: broadcast when that is bounded
        j = df.join(small_side(events.select(*by, event_col), DEFAULT_SCALE.broadcast_rows), by, "left")
    else:
        row = events.first()
        j = df.withColumn(event_col, F.lit(row[event_col] if row else None).cast(df.schema[cfg.time].dataType))
    lab = F.when(ev.isNotNull() & (t >= lo) & (t < hi), F.lit(1)).otherwise(F.lit(0))
    return j.withColumn(out, lab)


def severity(df: DataFrame, cfg: Columns, sticky: tuple[str, Column], tiers: list[tuple[str, Column]],
             default: str = "Normal", out: str = "health_status", layout=None,
             scale: Scale = DEFAULT_SCALE) -> DataFrame:
    """Tier per row; the ``sticky`` tier holds from its first occurrence
    on (running count of the condition > 0, segmented so a hot entity is
    not one task), then the other tiers in order, else ``default``."""
    name, cond = sticky
    d = running(df.withColumn("_vw_sticky", F.coalesce(cond, F.lit(False)).cast("long")), cfg,
                {"_vw_seen": F.col("_vw_sticky")}, layout=layout, scale=scale)
    expr = F.when(F.col("_vw_seen") > 0, F.lit(name))
    for tname, tcond in tiers:
        expr = expr.when(tcond, F.lit(tname))
    return d.withColumn(out, expr.otherwise(F.lit(default))).drop("_vw_sticky", "_vw_seen")


def inject_ramp(df: DataFrame, cfg: Columns, entity_value, start: int, n: int, ramps: dict | None = None,
                label: str | None = None, layout=None, scale: Scale = DEFAULT_SCALE) -> DataFrame:
    """In rows [start, start + n) (0-based position in time order) of
    one entity, add a + b * p**power with p = (i - start) / n, then apply
    floor/ceiling, and set the label to 1.  ``ramps``: col -> (a, b, power,
    floor, ceiling)."""
    ramps = ramps or FAULT_RAMPS
    d = running(df, cfg, {}, layout=layout, scale=scale, row_number="_vw_rn")
    i = F.col("_vw_rn") - 1
    inside = (F.col(cfg.entity) == F.lit(entity_value)) & (i >= start) & (i < start + n)
    p = (i - start) / float(n)
    out = {}
    for c, (a, b, power, lo, hi) in ramps.items():
        if c not in df.columns:
            continue
        v = F.col(c) + a + b * F.pow(p, power)
        if lo is not None:
            v = F.greatest(v, F.lit(lo))
        if hi is not None:
            v = F.least(v, F.lit(hi))
        out[c] = F.when(inside & F.col(c).isNotNull(), v).otherwise(F.col(c))
    label = label or cfg.label
    if label:
        out[label] = F.when(inside, F.lit(1)).otherwise(F.col(label))
    return d.withColumns(out).drop("_vw_rn")


def injected_check(df: DataFrame, cfg: Columns, entity_value, expected: int, label: str | None = None) -> DataFrame:
    """Labelled rows found for the entity vs expected, and whether any
    other entity carries the label."""
    label = label or cfg.label
    y = F.col(label) == 1
    mine = F.col(cfg.entity) == F.lit(entity_value)
    return df.agg(
        F.count_if(y & mine).cast("long").alias("found"),
        F.lit(expected).cast("long").alias("expected"),
        F.count_if(y & ~mine).cast("long").alias("elsewhere"),
    ).withColumn("ok", (F.col("found") == F.col("expected")))
