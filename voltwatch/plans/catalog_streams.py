"""Catalog: Structured Streaming queries (S10, T1-T7) over the events
table replayed as a file stream in time-ordered micro-batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltwatch.operators import ml, sketches, validate
from voltwatch.plans.registry import query, rolling_digits, rounded
from voltwatch.sources.io import scratch_path
from voltwatch.sources.tables import EVENTS, table
from voltwatch.streaming import streams as S

CHUNKS, FILES = 6, 8  # micro-batches of the replay, least files of each


def _events_stream(spark, sf, closing=None):
    ev = table(spark, sf, "events")
    files = max(FILES, spark.sparkContext.defaultParallelism)  # a micro-batch has a task per file: one for every core
    folder = S.stream_folder(spark, ev, "ts", CHUNKS, "event_id", files, closing)
    sdf = S.read_stream(spark, folder, ev.schema, max_files=files)
    return sdf.withColumn("label", (F.col("event_type") == "error").cast("int")).withColumn(
        "k", F.get_json_object("props", "$.k").cast("double"))


def _run_agg(spark, sdf_agg, name):
    out = scratch_path(spark, name)
    S.run_aggregate(sdf_agg, f"{out}/out", f"{out}/chk", f"{name}_{out[-12:]}")
    return spark.read.parquet(f"{out}/out")


_SLIDING = """w AS (SELECT date_trunc('minute', ts) - k * INTERVAL 1 MINUTE AS ws, ts, event_type, value
           FROM events, (SELECT unnest(range(0, 5)) AS k) r)"""


@query("stream_outcome_rate", f"""
WITH {_SLIDING}
SELECT ws AS window_start, ws + INTERVAL 5 MINUTE AS window_end, CAST(count(*) AS BIGINT) AS events,
       CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS positives,
       round(count(*) / 5.0, 6) AS rate_per_min,
       round(count(*) FILTER (WHERE event_type = 'error') / count(*), 6) AS positive_share
FROM w GROUP BY ws""")
def q_stream_outcome_rate(spark, sf):
    return rounded(_run_agg(spark, S.outcome_rate(_events_stream(spark, sf), "ts", "label"), "rate"))


P95_THRESHOLD, ALERT_SPAN = 150.0, 5


_P95_SQL = f"""
WITH {_SLIDING},
p AS (SELECT ws, quantile_cont(value, 0.95) AS p95, count(*) AS events FROM w GROUP BY ws),
o AS (SELECT *, p95 > {P95_THRESHOLD} AS over FROM p),
l AS (SELECT *, {' AND '.join(
    f"coalesce(lag(over, {i}) OVER (ORDER BY ws), false) AND "
    f"coalesce(epoch(ws) - epoch(lag(ws, {i}) OVER (ORDER BY ws)) = {60 * i}, false)"
    for i in range(1, ALERT_SPAN))} AS prev_ok FROM o)
SELECT ws AS window_start, ws + INTERVAL 5 MINUTE AS window_end, round(p95, 6) AS p95,
       CAST(events AS BIGINT) AS events, CAST(over AS BIGINT) AS over, CAST(over AND prev_ok AS BIGINT) AS alert
FROM l"""


@query("stream_p95_alert", _P95_SQL)
def q_stream_p95_alert(spark, sf):
    out = scratch_path(spark, "p95")
    S.alert_stream(S.value_quantile(_events_stream(spark, sf), "ts", "value", 0.95), "p95", P95_THRESHOLD,
                   ALERT_SPAN, f"{out}/out", f"{out}/chk", f"p95_{out[-12:]}")
    return rounded(spark.read.parquet(f"{out}/out"))


@query("stream_daily_stats", """
SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
       CAST(count(*) AS BIGINT) AS events, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
       round(min(value), 6) AS min, round(max(value), 6) AS max
FROM events GROUP BY 1""")
def q_stream_daily_stats(spark, sf):
    return rounded(_run_agg(spark, S.daily_stats(_events_stream(spark, sf), "ts", "value"), "daily"))


@query("stream_alert_append", _P95_SQL)
def q_stream_alert_append(spark, sf):
    """T4, T5 in append mode: closed windows feed a second stateful operator; nothing is rewritten.  The replay
    ends with a row that closes the last windows and the spans behind them."""
    sdf = _events_stream(spark, sf, "25 minutes")
    w = S.value_quantile(sdf, "ts", "value", 0.95, window_col="_vw_w")
    out = scratch_path(spark, "alerts")
    S.run_aggregate(S.chained_alerts(w, "p95", P95_THRESHOLD, ALERT_SPAN), f"{out}/out", f"{out}/chk", f"alerts_{out[-12:]}", "append")
    return rounded(spark.read.parquet(f"{out}/out").drop("epoch"))


_WEEKS = """v AS (SELECT date_trunc('week', ts) AS week, 'value' AS feature, value AS v FROM events
      UNION ALL SELECT date_trunc('week', ts), 'k', CAST(json_extract_string(props, '$.k') AS DOUBLE) FROM events)"""


def _weekly(spark, sf):
    """Days sketched on the stream, stored, and merged into weeks without the events."""
    days = _run_agg(spark, S.sketch_stream(_events_stream(spark, sf), "ts", ["value", "k"]), "sketches")
    return sketches.merge(days.withColumn("week", F.date_trunc("week", "window_start").cast("timestamp_ntz")), ["week"])


@query("stream_weekly_sketches", f"""
WITH {_WEEKS}
SELECT week, feature, CAST(count(v) AS BIGINT) AS n, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, round(min(v), 6) AS min,
       round(max(v), 6) AS max, round(quantile_disc(v, 0.5), 6) AS median, round(quantile_disc(v, 0.95), 6) AS p95
FROM v GROUP BY week, feature""")
def q_stream_weekly_sketches(spark, sf):
    """Equal to the exact values while a week has at most about ``sketches.K`` readings (sf0.01)."""
    w = _weekly(spark, sf)
    return rounded(w.select("week", "feature", "n", "mean", sketches.std().alias("std"), "min", "max",
                            sketches.quantile(0.5).alias("median"), sketches.quantile(0.95).alias("p95")))


@query("weekly_sketch_drift", f"""
WITH {_WEEKS},
r AS (SELECT * FROM v WHERE week = (SELECT min(week) FROM v)),
e AS (SELECT feature, count(v) AS ref_n, avg(v) AS ref_mean, stddev_samp(v) AS ref_std, quantile_disc(v, 0.5) AS ref_median,
             [{', '.join(f'quantile_disc(v, 0.{i})' for i in range(1, 10))}] AS edges FROM r GROUP BY feature),
p AS (SELECT r.feature, [{', '.join(f'count(*) FILTER (WHERE r.v <= edges[{i}]) / count(r.v)' for i in range(1, 10))}] AS up
      FROM r JOIN e ON r.feature = e.feature GROUP BY r.feature),
c AS (SELECT v.week, v.feature, count(v.v) AS cur_n, avg(v.v) AS cur_mean, stddev_samp(v.v) AS cur_std, quantile_disc(v.v, 0.5) AS cur_median,
             [{', '.join(f'count(*) FILTER (WHERE v.v <= edges[{i}]) / count(v.v)' for i in range(1, 10))}] AS up
      FROM v JOIN e ON v.feature = e.feature GROUP BY v.week, v.feature),
b AS (SELECT c.week, c.feature, sum((q - t) * ln(q / t)) AS psi FROM (
        SELECT c.week, c.feature,
               greatest(list_extract(list_append(c.up, 1.0), i) - CASE WHEN i > 1 THEN list_extract(c.up, i - 1) ELSE 0 END, 0.0001) AS q,
               greatest(list_extract(list_append(p.up, 1.0), i) - CASE WHEN i > 1 THEN list_extract(p.up, i - 1) ELSE 0 END, 0.0001) AS t
        FROM c JOIN p ON c.feature = p.feature, (SELECT unnest(range(1, 11)) AS i)) c GROUP BY c.week, c.feature)
SELECT c.week, c.feature, CAST(ref_n AS BIGINT) AS ref_n, CAST(cur_n AS BIGINT) AS cur_n, round(ref_mean, 6) AS ref_mean, round(cur_mean, 6) AS cur_mean,
       round(ref_std, 6) AS ref_std, round(cur_std, 6) AS cur_std, round(ref_median, 6) AS ref_median, round(cur_median, 6) AS cur_median,
       CAST(abs(cur_mean - ref_mean) > 2 * ref_std AS BIGINT) AS mean_drift, CAST(cur_n = 0 AS BIGINT) AS no_data, round(psi, 6) AS psi
FROM c JOIN e ON c.feature = e.feature JOIN b ON b.week = c.week AND b.feature = c.feature""")
def q_weekly_sketch_drift(spark, sf):
    """D1, D3 on stored sketches: every week against the first, no event read twice."""
    w = _weekly(spark, sf)
    first = w.agg(F.min("week")).first()[0]
    d = sketches.compare(w.where(F.col("week") == F.lit(first).cast("timestamp_ntz")).drop("week"), w, ["week"])
    return rounded(d.drop("ks_gap", "ks_p"))


STREAM_WINDOWS = (6, 30, 60)
STATE_TTL_S = 30 * 86400  # an entity silent for 30 days of event time loses its tail


def _roll(stat, n, c):
    fn = {"mean": "avg", "std": "stddev_samp"}[stat]
    return (f"round(coalesce({fn}({c}) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN {n - 1} "
            f"PRECEDING AND CURRENT ROW), 0), {rolling_digits(stat)}) AS Rolling_{stat}_{n}_{c}")


def _delta(c):
    return f"round(coalesce({c} - lag({c}) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0), 6) AS Delta_1_{c}"


@query("stream_features", f"""
WITH e AS (SELECT event_id, ts, user_id, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)
SELECT event_id, user_id, ts, {_delta('value')}, {_delta('k')},
       {', '.join(_roll(s, n, c) for c in ('value', 'k') for n in STREAM_WINDOWS for s in ('mean', 'std'))}
FROM e""")
def q_stream_features(spark, sf):
    sdf = _events_stream(spark, sf, S.WATERMARK).select("event_id", "ts", "user_id", "value", "k")
    out = scratch_path(spark, "features")
    S.feature_stream(sdf, EVENTS, ["value", "k"], STREAM_WINDOWS, ("mean", "std"), 1,
                     out=f"{out}/out", checkpoint=f"{out}/chk", name=f"features_{out[-12:]}",
                     state_ttl_s=STATE_TTL_S)
    res = spark.read.parquet(f"{out}/out").drop("epoch")
    return rounded(res.drop("value", "k"))


@query("stream_score")
def q_stream_score(spark, sf):
    """A model trained on the batch table scores the replayed stream;
    rows breaking a rule go to quarantine (reported as a count column)."""
    ev = table(spark, sf, "events").withColumn("label", (F.col("event_type") == "error").cast("int")).withColumn(
        "k", F.get_json_object("props", "$.k").cast("double"))
    feats = ["value", "k"]
    model = ml.train(ev, feats, "label", "rf")
    rules = validate.required_doubles(feats, {"k": (0, 95)})
    out = scratch_path(spark, "score")
    scored, quar = S.score_stream(_events_stream(spark, sf), model, rules, f"{out}/out", f"{out}/chk",
                                  keep=["event_id", "user_id"], name=f"score_{out[-12:]}")
    res = spark.read.parquet(scored).drop("epoch")
    nq = spark.read.parquet(quar).count()
    return res.select("event_id", F.col("user_id").cast("string").alias("entity_id"), "prediction", "probability",
                      F.lit(nq).alias("quarantined"))
