"""Catalog: cleaning and feature queries (W1-W12, L1) on the driver tables."""

from __future__ import annotations

from voltwatch.config import Columns
from voltwatch.operators import clean, features
from voltwatch.plans.featureset import FeatureSpec, feature_pipeline
from voltwatch.plans.layout import plan_layout
from voltwatch.plans.registry import query, rolling_digits, rounded
from voltwatch.sources.tables import EVENTS, EVENTS_SQL, events_telemetry, table


def W(part="user_id", order="ts, event_id", frame="ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"):
    p = f"PARTITION BY {part} " if part else ""
    return f"OVER ({p}ORDER BY {order} {frame})"


FWD = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
BWD = "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
GLOBAL = EVENTS.with_(entity=None)


def _ffill_sql(c, part="user_id"):
    return (f"coalesce({c}, last_value({c} IGNORE NULLS) {W(part, frame=FWD)}, "
            f"first_value({c} IGNORE NULLS) {W(part, frame=BWD)}, 0)")


# ---------------------------------------------------------------- W1-W5
@query("fill_forward_back", f"""
WITH {EVENTS_SQL}
SELECT event_id, user_id, ts, round({_ffill_sql('value')}, 6) AS value, round({_ffill_sql('k')}, 6) AS k
FROM tele""")
def q_fill_forward_back(spark, sf):
    d = clean.impute(events_telemetry(spark, sf), EVENTS, ["value", "k"], "ffill")
    return rounded(d.select("event_id", "user_id", "ts", "value", "k"))


@query("fill_mean", f"""
WITH {EVENTS_SQL}
SELECT event_id, user_id, ts,
       round(coalesce(value, avg(value) OVER (PARTITION BY user_id), 0), 6) AS value
FROM tele""")
def q_fill_mean(spark, sf):
    d = clean.impute(events_telemetry(spark, sf), EVENTS, ["value"], "mean")
    return rounded(d.select("event_id", "user_id", "ts", "value"))


@query("fill_median", f"""
WITH {EVENTS_SQL}
SELECT event_id, user_id, ts,
       round(coalesce(value, median(value) OVER (PARTITION BY user_id), 0), 6) AS value
FROM tele""")
def q_fill_median(spark, sf):
    d = clean.impute(events_telemetry(spark, sf), EVENTS, ["value"], "median")
    return rounded(d.select("event_id", "user_id", "ts", "value"))


@query("fill_global_mean", f"""
WITH {EVENTS_SQL}
SELECT event_id, user_id, ts,
       round(coalesce(value, (SELECT avg(value) FROM tele), 0), 6) AS value
FROM tele""")
def q_fill_global_mean(spark, sf):
    d = clean.impute(events_telemetry(spark, sf), GLOBAL, ["value"], "mean")
    return rounded(d.select("event_id", "user_id", "ts", "value"))


@query("fill_global_median", f"""
WITH {EVENTS_SQL}
SELECT event_id, user_id, ts,
       round(coalesce(value, (SELECT median(value) FROM tele), 0), 6) AS value
FROM tele""")
def q_fill_global_median(spark, sf):
    d = clean.impute(events_telemetry(spark, sf), GLOBAL, ["value"], "median")
    return rounded(d.select("event_id", "user_id", "ts", "value"))


@query("fill_global_ffill", f"""
WITH {EVENTS_SQL}
SELECT event_id, user_id, ts, round({_ffill_sql('value', None)}, 6) AS value
FROM tele""")
def q_fill_global_ffill(spark, sf):
    d = clean.impute(events_telemetry(spark, sf), GLOBAL, ["value"], "ffill")
    return rounded(d.select("event_id", "user_id", "ts", "value"))


# ---------------------------------------------------------------- W6, W7
def _clip_sql(c, lo, hi):
    return f"round(CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest({c}, {lo}), {hi}) END, 6)"


@query("clip_by_entity", f"""
WITH {EVENTS_SQL},
q AS (SELECT user_id,
             quantile_cont(value, 0.01) AS lo_v, quantile_cont(value, 0.99) AS hi_v,
             quantile_cont(k, 0.01) AS lo_k, quantile_cont(k, 0.99) AS hi_k
      FROM tele GROUP BY user_id)
SELECT event_id, user_id, ts, {_clip_sql('value', 'lo_v', 'hi_v')} AS value,
       {_clip_sql('k', 'lo_k', 'hi_k')} AS k
FROM tele JOIN q USING (user_id)""")
def q_clip_by_entity(spark, sf):
    d = clean.clip_quantiles(events_telemetry(spark, sf), EVENTS, ["value", "k", "event_type"])
    return rounded(d.select("event_id", "user_id", "ts", "value", "k"))


LINE = Columns(entity="l_suppkey", time="l_shipdate", tie="l_orderkey")


@query("clip_by_supplier", f"""
WITH q AS (SELECT l_suppkey, quantile_cont(l_extendedprice, 0.01) AS lo,
                  quantile_cont(l_extendedprice, 0.99) AS hi
           FROM lineitem GROUP BY l_suppkey)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_suppkey,
       {_clip_sql('l_extendedprice', 'lo', 'hi')} AS l_extendedprice
FROM lineitem JOIN q USING (l_suppkey)""")
def q_clip_by_supplier(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey",
                                              "l_extendedprice", "l_shipdate")
    d = clean.clip_quantiles(li, LINE, ["l_extendedprice"])
    return rounded(d.select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"))


@query("clip_global", f"""
WITH q AS (SELECT quantile_cont(l_quantity, 0.01) AS lo_q, quantile_cont(l_quantity, 0.99) AS hi_q,
                  quantile_cont(l_extendedprice, 0.01) AS lo_p, quantile_cont(l_extendedprice, 0.99) AS hi_p,
                  quantile_cont(l_discount, 0.01) AS lo_d, quantile_cont(l_discount, 0.99) AS hi_d
           FROM lineitem)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       {_clip_sql('l_quantity', 'lo_q', 'hi_q')} AS l_quantity,
       {_clip_sql('l_extendedprice', 'lo_p', 'hi_p')} AS l_extendedprice,
       {_clip_sql('l_discount', 'lo_d', 'hi_d')} AS l_discount
FROM lineitem, q""")
def q_clip_global(spark, sf):
    li = table(spark, sf, "lineitem")
    cols = ["l_quantity", "l_extendedprice", "l_discount"]
    d = clean.clip_quantiles(li, LINE.with_(entity=None), cols)
    return rounded(d.select("l_orderkey", "l_linenumber", *cols))


# ---------------------------------------------------------------- W8-W11
def _delta_sql(c, k):
    return f"round(coalesce({c} - lag({c}, {k}) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0), 6)"


@query("delta_k", f"""
WITH {EVENTS_SQL}
SELECT event_id, user_id, ts,
       {_delta_sql('value', 1)} AS Delta_1_value, {_delta_sql('k', 1)} AS Delta_1_k,
       {_delta_sql('value', 3)} AS Delta_3_value, {_delta_sql('k', 3)} AS Delta_3_k
FROM tele""")
def q_delta_k(spark, sf):
    d = features.delta(events_telemetry(spark, sf), EVENTS, ["value", "k"], (1, 3))
    return rounded(d.select("event_id", "user_id", "ts", "Delta_1_value", "Delta_1_k",
                            "Delta_3_value", "Delta_3_k"))


def _roll_sql(stat, n, c, part="user_id"):
    fn = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max", "sum": "sum"}[stat]
    p = f"PARTITION BY {part} " if part else ""
    return (f"round(coalesce({fn}({c}) OVER ({p}ORDER BY ts, event_id ROWS BETWEEN {n - 1} PRECEDING "
            f"AND CURRENT ROW), 0), {rolling_digits(stat)}) AS Rolling_{stat}_{n}_{c}")


ROLL_STATS = ("mean", "std", "min", "max", "sum")
ROLL_WINDOWS = (6, 30, 60)


@query("rolling_stats", f"""
WITH {EVENTS_SQL}
SELECT event_id, user_id, ts,
       {', '.join(_roll_sql(s, n, c) for c in ('value', 'k') for n in ROLL_WINDOWS for s in ROLL_STATS)}
FROM tele""")
def q_rolling_stats(spark, sf):
    d = features.rolling(events_telemetry(spark, sf), EVENTS, ["value", "k"], ROLL_WINDOWS, ROLL_STATS)
    names = [features.rolling_name(s, n, c) for c in ("value", "k") for n in ROLL_WINDOWS for s in ROLL_STATS]
    return rounded(d.select("event_id", "user_id", "ts", *names))


@query("rolling_global", f"""
WITH {EVENTS_SQL}
SELECT event_id, user_id, ts, {_roll_sql('mean', 6, 'k', None)}, {_roll_sql('std', 6, 'k', None)},
       round(coalesce(k - lag(k, 1) OVER (ORDER BY ts, event_id), 0), 6) AS Delta_1_k
FROM tele""")
def q_rolling_global(spark, sf):
    d = events_telemetry(spark, sf)
    lay = plan_layout(d, GLOBAL)  # one layout decision for both operators
    d = features.rolling(d, GLOBAL, ["k"], (6,), ("mean", "std"), layout=lay)
    d = features.delta(d, GLOBAL, ["k"], 1, layout=lay)
    return rounded(d.select("event_id", "user_id", "ts", "Rolling_mean_6_k", "Rolling_std_6_k", "Delta_1_k"))


FEATURE_SPEC = FeatureSpec(fill=("value", "k"), clip=("value", "k"), delta=("value", "k"),
                           rolling=("value", "k"), windows=ROLL_WINDOWS, stats=("mean", "std"))


def _features_sql():
    filled = f"""filled AS (
  SELECT event_id, user_id, ts, label, {_ffill_sql('value')} AS value, {_ffill_sql('k')} AS k FROM tele)"""
    q = """q AS (SELECT user_id, quantile_cont(value, 0.01) AS lo_v, quantile_cont(value, 0.99) AS hi_v,
                quantile_cont(k, 0.01) AS lo_k, quantile_cont(k, 0.99) AS hi_k FROM filled GROUP BY user_id)"""
    clipped = """clipped AS (
  SELECT event_id, user_id, ts, label, least(greatest(value, lo_v), hi_v) AS value,
         least(greatest(k, lo_k), hi_k) AS k FROM filled JOIN q USING (user_id))"""
    rolls = ", ".join(_roll_sql(s, n, c) for c in ("value", "k") for n in ROLL_WINDOWS for s in ("mean", "std"))
    return f"""
WITH {EVENTS_SQL}, {filled}, {q}, {clipped}
SELECT event_id, user_id, ts, CAST(label AS BIGINT) AS label, round(value, 6) AS value, round(k, 6) AS k,
       {_delta_sql('value', 1)} AS Delta_1_value, {_delta_sql('k', 1)} AS Delta_1_k,
       {rolls}
FROM clipped"""


@query("telemetry_features", _features_sql())
def q_telemetry_features(spark, sf):
    d = events_telemetry(spark, sf).drop("event_type")
    return rounded(feature_pipeline(d, EVENTS, FEATURE_SPEC))


@query("label_onsets", f"""
WITH {EVENTS_SQL}
SELECT event_id, user_id, ts, CAST(label AS BIGINT) AS label,
       CAST(coalesce(label = 1 AND lag(label) OVER (PARTITION BY user_id ORDER BY ts, event_id) = 0, false)
            AS BIGINT) AS is_onset
FROM tele""")
def q_label_onsets(spark, sf):
    d = features.onsets(events_telemetry(spark, sf), EVENTS)
    return rounded(d.select("event_id", "user_id", "ts", "label", "is_onset"))


MORE_STATS = ("var", "count", "median")


def _roll_more_sql(stat, n, c):
    fn = {"var": "var_samp", "count": "count", "median": "median"}[stat]
    return (f"round(coalesce(CAST({fn}({c}) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN {n - 1} "
            f"PRECEDING AND CURRENT ROW) AS DOUBLE), 0), 6) AS Rolling_{stat}_{n}_{c}")


@query("rolling_more_stats", f"""
WITH {EVENTS_SQL}
SELECT event_id, user_id, ts, {', '.join(_roll_more_sql(s, 6, 'value') for s in MORE_STATS)}
FROM tele""")
def q_rolling_more_stats(spark, sf):
    """The other registered statistics (variance, count of non-null
    readings, median of the frame) on the NULL-injected readings."""
    d = features.rolling(events_telemetry(spark, sf), EVENTS, ["value"], (6,), MORE_STATS)
    names = [features.rolling_name(s, 6, "value") for s in MORE_STATS]
    return rounded(d.select("event_id", "user_id", "ts", *names))
