"""Catalog: profiles, metrics, reshaping, keys, validation and labelling
queries (A1-A17, R1-R4, C8-C14, G1-G7) on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltwatch.config import Columns
from voltwatch.functions.columns import format_id, label_text, ordinal_key, parent_key
from voltwatch.operators import clean, labels, metrics, profile, reshape, validate
from voltwatch.plans.registry import query, rounded
from voltwatch.sources.tables import EVENTS, EVENTS_SQL, events_telemetry, table

TELE_COLS = ["event_id", "ts", "user_id", "event_type", "value", "k", "label"]


def _union(parts):
    return "\nUNION ALL\n".join(parts)


# ---------------------------------------------------------------- A1, A2, A4, A7
@query("null_profile", f"""
WITH {EVENTS_SQL}
{_union([f"SELECT '{c}' AS column, CAST(count(*) - count({c}) AS BIGINT) AS nulls FROM tele" for c in TELE_COLS])}""")
def q_null_profile(spark, sf):
    return rounded(profile.null_profile(events_telemetry(spark, sf)))


@query("imputation_report", f"""
WITH {EVENTS_SQL}
SELECT * FROM (
{_union([f"SELECT '{c}' AS column, CAST(count(*) - count({c}) AS BIGINT) AS imputed FROM tele" for c in ('value', 'k')])}
) WHERE imputed > 0""")
def q_imputation_report(spark, sf):
    before = events_telemetry(spark, sf)
    after = clean.impute(before, EVENTS, ["value", "k"], "ffill")
    return rounded(profile.imputation_report(before, after, ["value", "k"]))


EVENT_TYPES = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string",
               "value": "double", "props": "string"}


@query("schema_profile", _union([
    f"SELECT '{c}' AS column, '{t}' AS type, CAST(count({c}) AS BIGINT) AS non_null FROM events"
    for c, t in EVENT_TYPES.items()]))
def q_schema_profile(spark, sf):
    return rounded(profile.schema_profile(table(spark, sf, "events")))


ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query("distinct_counts", _union([
    f"SELECT '{c}' AS column, CAST(count(DISTINCT {c}) AS BIGINT) AS distinct FROM orders" for c in ORDER_COLS]))
def q_distinct_counts(spark, sf):
    return rounded(profile.distinct_counts(table(spark, sf, "orders"), ORDER_COLS))


@query("distinct_pairs", "SELECT DISTINCT user_id, event_type FROM events")
def q_distinct_pairs(spark, sf):
    return profile.distinct_values(table(spark, sf, "events"), ["user_id", "event_type"])


# ---------------------------------------------------------------- A3, A5, A8, A10, A13
LINE_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("describe_numeric", _union([f"""
SELECT '{c}' AS column, CAST(count({c}) AS BIGINT) AS count, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min,
       round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
       round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS max
FROM lineitem""" for c in LINE_NUM]))
def q_describe_numeric(spark, sf):
    return rounded(profile.describe(table(spark, sf, "lineitem"), LINE_NUM))


@query("value_counts", """
SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS count,
       round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM orders GROUP BY o_orderpriority""")
def q_value_counts(spark, sf):
    return rounded(profile.value_counts(table(spark, sf, "orders"), "o_orderpriority", by_label=True))


@query("outcome_counts", """
SELECT CASE WHEN event_type = 'error' THEN 'Hazardous' ELSE 'Normal' END AS outcome,
       CAST(count(*) AS BIGINT) AS count
FROM events GROUP BY 1""")
def q_outcome_counts(spark, sf):
    ev = events_telemetry(spark, sf)
    return ev.groupBy(label_text("label").alias("outcome")).agg(F.count(F.lit(1)).alias("count"))


@query("group_quantiles", """
SELECT l_returnflag, l_linestatus, round(avg(l_extendedprice), 6) AS mean,
       round(quantile_cont(l_extendedprice, 0.01), 6) AS q01,
       round(quantile_cont(l_extendedprice, 0.5), 6) AS q50,
       round(quantile_cont(l_extendedprice, 0.99), 6) AS q99
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def q_group_quantiles(spark, sf):
    li = table(spark, sf, "lineitem")
    return rounded(profile.group_quantiles(li, ["l_returnflag", "l_linestatus"], "l_extendedprice",
                                           (0.01, 0.5, 0.99)))


BOX_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


@query("box_stats", f"""
WITH m AS ({_union([f"SELECT l_returnflag, '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM lineitem" for c in BOX_COLS])}),
q AS (SELECT l_returnflag, feature, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
             quantile_cont(v, 0.75) AS q3 FROM m GROUP BY l_returnflag, feature),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT f.l_returnflag, f.feature AS "column", round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(iqr, 6) AS iqr,
       round(min(CASE WHEN v BETWEEN lo AND hi THEN v END), 6) AS whisker_lo,
       round(max(CASE WHEN v BETWEEN lo AND hi THEN v END), 6) AS whisker_hi,
       CAST(count(*) FILTER (WHERE v IS NOT NULL AND NOT (v BETWEEN lo AND hi)) AS BIGINT) AS outliers
FROM m JOIN f ON m.l_returnflag = f.l_returnflag AND m.feature = f.feature
GROUP BY f.l_returnflag, f.feature, q1, median, q3, iqr""")
def q_box_stats(spark, sf):
    return rounded(profile.box_stats(table(spark, sf, "lineitem"), BOX_COLS, by=["l_returnflag"]))


@query("change_probe", f"""
WITH {EVENTS_SQL},
q AS (SELECT user_id, quantile_cont(value, 0.01) AS lo_v, quantile_cont(value, 0.99) AS hi_v,
             quantile_cont(k, 0.01) AS lo_k, quantile_cont(k, 0.99) AS hi_k FROM tele GROUP BY user_id)
SELECT 'value' AS column,
       CAST(count(*) FILTER (WHERE value IS DISTINCT FROM
       (CASE WHEN value IS NULL THEN NULL ELSE least(greatest(value, lo_v), hi_v) END)) AS BIGINT) AS changed
FROM tele JOIN q USING (user_id)
UNION ALL
SELECT 'k' AS column,
       CAST(count(*) FILTER (WHERE k IS DISTINCT FROM
       (CASE WHEN k IS NULL THEN NULL ELSE least(greatest(k, lo_k), hi_k) END)) AS BIGINT) AS changed
FROM tele JOIN q USING (user_id)""")
def q_change_probe(spark, sf):
    before = events_telemetry(spark, sf)
    after = clean.clip_quantiles(before, EVENTS, ["value", "k"])
    return rounded(profile.change_count(before, after, ["event_id"], ["value", "k"]))


# ---------------------------------------------------------------- A11-A17
@query("class_weights", """
SELECT CAST(toxic AS BIGINT) AS toxic, CAST(count(*) AS BIGINT) AS n,
       round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight
FROM labels GROUP BY toxic""")
def q_class_weights(spark, sf):
    return rounded(metrics.class_weight_table(table(spark, sf, "labels"), "toxic"))


@query("positive_weight", """
SELECT CAST(count(*) FILTER (WHERE toxic = 0) AS BIGINT) AS n_neg,
       CAST(count(*) FILTER (WHERE toxic = 1) AS BIGINT) AS n_pos,
       round(CASE WHEN count(*) FILTER (WHERE toxic = 1) = 0 THEN 1.0
             ELSE count(*) FILTER (WHERE toxic = 0) / count(*) FILTER (WHERE toxic = 1) END, 6) AS positive_weight
FROM labels""")
def q_positive_weight(spark, sf):
    return rounded(metrics.class_counts(table(spark, sf, "labels"), "toxic"))


PRED_THRESHOLD = 50.0


def _scored(spark, sf):
    ev = events_telemetry(spark, sf, with_nulls=False)
    return ev.withColumn("pred", (F.col("value") >= PRED_THRESHOLD).cast("int"))


_CM = f"""cm AS (
  SELECT count(*) FILTER (WHERE label = 0 AND pred = 0) AS tn, count(*) FILTER (WHERE label = 0 AND pred = 1) AS fp,
         count(*) FILTER (WHERE label = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE label = 1 AND pred = 1) AS tp,
         count(*) FILTER (WHERE label IS NOT NULL AND pred IS NULL) AS not_scored
  FROM (SELECT CAST(event_type = 'error' AS INTEGER) AS label,
               CAST(value >= {PRED_THRESHOLD} AS INTEGER) AS pred FROM events) s)"""


def _z(a, b):
    return f"CASE WHEN ({b}) = 0 THEN 0.0 ELSE ({a}) / ({b}) END"


@query("confusion_report", f"""
WITH {_CM},
r AS (SELECT *, {_z('tp', 'tp + fp')} AS p1, {_z('tp', 'tp + fn')} AS r1,
             {_z('tn', 'tn + fn')} AS p0, {_z('tn', 'tn + fp')} AS r0, tn + fp + fn + tp AS n FROM cm),
f AS (SELECT *, {_z('2 * p1 * r1', 'p1 + r1')} AS f1, {_z('2 * p0 * r0', 'p0 + r0')} AS f0,
             {_z('tp + tn', 'n')} AS acc FROM r)
SELECT '0' AS class, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1,
       CAST(tn + fp AS BIGINT) AS support FROM f
UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), CAST(tp + fn AS BIGINT) FROM f
UNION ALL SELECT 'accuracy', round(acc, 6), round(acc, 6), round(acc, 6), CAST(n AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6),
                 CAST(n AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round({_z('p0 * (tn + fp) + p1 * (tp + fn)', 'n')}, 6),
                 round({_z('r0 * (tn + fp) + r1 * (tp + fn)', 'n')}, 6),
                 round({_z('f0 * (tn + fp) + f1 * (tp + fn)', 'n')}, 6), CAST(n AS BIGINT) FROM f""")
def q_confusion_report(spark, sf):
    return rounded(metrics.report(_scored(spark, sf), "label", "pred"))


@query("confusion_matrix", f"WITH {_CM} SELECT CAST(tn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, "
                           "CAST(fn AS BIGINT) AS fn, CAST(tp AS BIGINT) AS tp, "
                           "CAST(not_scored AS BIGINT) AS not_scored FROM cm")
def q_confusion_matrix(spark, sf):
    return metrics.confusion(_scored(spark, sf), "label", "pred")


RANKING_SQL = """
WITH s AS (SELECT value AS score, CAST(event_type = 'error' AS INTEGER) AS y FROM events WHERE value IS NOT NULL),
g AS (SELECT score, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY score),
c AS (SELECT pos, neg,
             sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
             sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp FROM g),
t AS (SELECT sum(neg * (2 * tp - pos) / 2.0) AS roc,
             sum(pos * (tp / (tp + fp) + CASE WHEN tp - pos + fp - neg = 0 THEN 1.0
                                             ELSE (tp - pos) / (tp - pos + fp - neg) END) / 2.0) AS pr,
             sum(pos) AS p, sum(neg) AS n FROM c)
SELECT round(CASE WHEN p > 0 AND n > 0 THEN roc / (p * n) END, 6) AS roc_auc,
       round(CASE WHEN p > 0 AND n > 0 THEN pr / p END, 6) AS pr_auc FROM t"""


@query("ranking_metrics", RANKING_SQL)
def q_ranking_metrics(spark, sf):
    return rounded(metrics.ranking_metrics(_scored(spark, sf), "value", "label"))


# ---------------------------------------------------------------- R1, R3, R4
@query("melt_features", _union([
    f"SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, '{c}' AS Feature, "
    f"round(CAST({c} AS DOUBLE), 6) AS Value FROM lineitem"
    for c in LINE_NUM]))
def q_melt_features(spark, sf):
    li = table(spark, sf, "lineitem")
    return rounded(reshape.melt(li, ["l_orderkey", "l_linenumber"], LINE_NUM))


@query("time_grid_gaps", """
WITH b AS (SELECT user_id, date_trunc('day', ts) AS bucket, count(*) AS rows FROM events GROUP BY 1, 2),
s AS (SELECT user_id, min(bucket) AS lo, max(bucket) AS hi FROM b GROUP BY user_id),
g AS (SELECT user_id, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS bucket FROM s)
SELECT g.user_id, CAST(g.bucket AS TIMESTAMP) AS bucket, CAST(coalesce(b.rows, 0) AS BIGINT) AS rows
FROM g LEFT JOIN b ON g.user_id = b.user_id AND g.bucket = b.bucket""")
def q_time_grid_gaps(spark, sf):
    ev = table(spark, sf, "events")
    return reshape.time_grid(ev, Columns(entity="user_id", time="ts"), "1 day")


HOT_VALUE = 300.0


def _daily(spark, sf):
    ev = table(spark, sf, "events")
    day = reshape.bucket_start(F.col("ts"), 86400, ev.schema["ts"].dataType)  # stays timestamp_ntz
    d = ev.groupBy("user_id", day.alias("day")).agg(F.max("value").alias("max_value"))
    return d.select((F.col("user_id") / 8).cast("long").alias("rack"), (F.col("user_id") % 8).alias("ordinal"),
                    "day", "user_id", "max_value", (F.col("max_value") > HOT_VALUE).alias("hot"))


@query("neighbour_exposure", f"""
WITH d AS (SELECT user_id // 8 AS rack, user_id % 8 AS ordinal, date_trunc('day', ts) AS day, user_id,
                  max(value) AS max_value FROM events GROUP BY user_id, date_trunc('day', ts)),
h AS (SELECT *, max_value > {HOT_VALUE} AS hot FROM d)
SELECT a.rack, a.ordinal, a.day, a.user_id, round(a.max_value, 6) AS max_value, CAST(a.hot AS BIGINT) AS hot,
       round(CAST(200 * count(b.user_id) AS DOUBLE), 6) AS exposure
FROM h a LEFT JOIN h b ON a.rack = b.rack AND a.day = b.day AND abs(a.ordinal - b.ordinal) = 1 AND b.hot
GROUP BY a.rack, a.ordinal, a.day, a.user_id, a.max_value, a.hot""")
def q_neighbour_exposure(spark, sf):
    return rounded(reshape.neighbour_exposure(_daily(spark, sf), "rack", "ordinal", "day", "hot"))


# ---------------------------------------------------------------- C8-C10, C14
@query("parent_key", """
SELECT c_custkey, split_part(c_name, '#', 1) AS parent,
       CAST(TRY_CAST(nullif(regexp_extract(c_name, '#(\\d+)$', 1), '') AS INTEGER) AS BIGINT) AS ordinal
FROM customer""")
def q_parent_key(spark, sf):
    c = table(spark, sf, "customer")
    return rounded(c.select("c_custkey", parent_key("c_name", "#").alias("parent"),
                            ordinal_key("c_name", r"#(\d+)$").alias("ordinal")))


@query("ordinal_key", """
SELECT p_partkey, split_part(p_brand, '#', 1) AS parent,
       CAST(TRY_CAST(nullif(regexp_extract(p_brand, '#(\\d+)$', 1), '') AS INTEGER) AS BIGINT) AS ordinal,
       format('{}_Module{:02d}', split_part(p_brand, '#', 1),
              TRY_CAST(nullif(regexp_extract(p_brand, '#(\\d+)$', 1), '') AS INTEGER)) AS rebuilt
FROM part""")
def q_ordinal_key(spark, sf):
    p = table(spark, sf, "part")
    par, ordn = parent_key("p_brand", "#"), ordinal_key("p_brand", r"#(\d+)$")
    return rounded(p.select("p_partkey", par.alias("parent"), ordn.alias("ordinal"),
                            format_id(par, ordn).alias("rebuilt")))


def _rules():
    return {
        "value_required": F.col("value").isNotNull(),
        "k_range": F.col("k").between(0, 95),
        "value_range": F.col("value").between(0, 400),
    }


@query("validate_rows", f"""
WITH {EVENTS_SQL},
r AS (SELECT event_id,
             list_filter([CASE WHEN NOT coalesce(value IS NOT NULL, false) THEN 'value_required' END,
                          CASE WHEN NOT coalesce(k BETWEEN 0 AND 95, false) THEN 'k_range' END,
                          CASE WHEN NOT coalesce(value BETWEEN 0 AND 400, false) THEN 'value_range' END],
                         lambda x: x IS NOT NULL) AS reasons FROM tele)
SELECT event_id, CAST(len(reasons) = 0 AS BIGINT) AS is_valid, array_to_string(reasons, ',') AS reasons FROM r""")
def q_validate_rows(spark, sf):
    tagged = events_telemetry(spark, sf).withColumn("r", validate.failed_rules(_rules()))
    return tagged.select("event_id", (F.size("r") == 0).cast("long").alias("is_valid"),
                         F.array_join("r", ",").alias("reasons"))


# ---------------------------------------------------------------- G1-G7
RAW = EVENTS  # events without injected NULLs for the labelling queries
CRIT_VALUE, CRIT_RATE, CRIT_RATE_VALUE = 450.0, 0.01, 300.0
RATE_SQL = """(SELECT *, coalesce(CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) > 0
        THEN (value - lag(value) OVER w) / ((epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1e6) END, 0) AS Rate_value
   FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""


def _critical(spark, sf):
    ev = events_telemetry(spark, sf, with_nulls=False)
    ev = labels.rate_per_second(ev, RAW, "value")
    return ev, labels.first_event(ev, RAW, labels.critical_condition("value", "Rate_value", CRIT_VALUE, CRIT_RATE,
                                                                   CRIT_RATE_VALUE))


_FIRST_SQL = f"""fe AS (SELECT user_id, min(ts) AS event_time FROM {RATE_SQL} r
   WHERE value >= {CRIT_VALUE} OR (Rate_value >= {CRIT_RATE} AND value > {CRIT_RATE_VALUE}) GROUP BY user_id)"""


@query("first_critical_event", f"WITH {_FIRST_SQL} SELECT user_id, event_time FROM fe")
def q_first_critical_event(spark, sf):
    return _critical(spark, sf)[1]


HORIZON_S, GUARD = 86400, 3600


@query("horizon_label", f"""
WITH {_FIRST_SQL}
SELECT e.event_id, e.user_id, e.ts,
       CAST(CASE WHEN fe.event_time IS NOT NULL
                  AND e.ts >= fe.event_time - INTERVAL {HORIZON_S + GUARD} SECOND
                  AND e.ts < fe.event_time - INTERVAL {GUARD} SECOND THEN 1 ELSE 0 END AS BIGINT) AS horizon_label
FROM events e LEFT JOIN fe USING (user_id)""")
def q_horizon_label(spark, sf):
    ev, fe = _critical(spark, sf)
    out = labels.horizon_label(ev, RAW, fe, HORIZON_S, GUARD)
    return rounded(out.select("event_id", "user_id", "ts", "horizon_label"))


@query("severity_tier", """
SELECT event_id, user_id, ts,
       CASE WHEN max(CAST(value >= 450 AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) = 1 THEN 'Runaway'
            WHEN value > 300 THEN 'PreRunaway' WHEN value > 150 THEN 'Degrading' ELSE 'Normal' END AS health_status
FROM events""")
def q_severity_tier(spark, sf):
    ev = events_telemetry(spark, sf, with_nulls=False)
    v = F.col("value")
    out = labels.severity(ev, RAW, ("Runaway", v >= 450), [("PreRunaway", v > 300), ("Degrading", v > 150)])
    return out.select("event_id", "user_id", "ts", "health_status")


INJ_SIGMA = {"value": 10.0, "k": 5.0}
INJ_MISS, INJ_OUT, INJ_FACTOR, SEED = 5.0, 2.0, 7.0, 42


def _u(tag, c):
    return (f"(CAST(('0x' || substr(md5(concat_ws(':', '{SEED}', CAST(event_id AS VARCHAR), '{c}', '{tag}')), 1, 8))"
            f" AS BIGINT) / 4294967296.0)")


def _inject_sql(c):
    s = INJ_SIGMA[c]
    noisy = f"({c} + {s} * sqrt(-2.0 * ln(1.0 - {_u('n1', c)})) * cos(2.0 * pi() * {_u('n2', c)}))"
    return (f"round(CASE WHEN {_u('m', c)} * 100 < {INJ_MISS} THEN NULL "
            f"WHEN {_u('o', c)} * 100 < {INJ_OUT} THEN {noisy} + (CASE WHEN {_u('s', c)} < 0.5 THEN -1.0 ELSE 1.0 END)"
            f" * {INJ_FACTOR} * {s} ELSE {noisy} END, 6) AS {c}")


@query("inject_missing_outlier", f"""
WITH raw AS (SELECT event_id, ts, user_id, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
             FROM events)
SELECT event_id, user_id, ts, {_inject_sql('value')}, {_inject_sql('k')} FROM raw""")
def q_inject_missing_outlier(spark, sf):
    ev = events_telemetry(spark, sf, with_nulls=False)
    out = labels.inject(ev, Columns(entity="user_id", time="ts", tie="event_id"), ["value", "k"], INJ_SIGMA,
                        INJ_MISS, INJ_OUT, INJ_FACTOR, SEED, noise=True, key=["event_id"])
    return rounded(out.select("event_id", "user_id", "ts", "value", "k"))


RAMP_USER, RAMP_START, RAMP_N = 7, 10, 20
RAMPS = {"value": (10.0, 60.0, 2, None, None), "k": (-2.0, -15.0, 1, 30.0, None)}


@query("inject_ramp", f"""
WITH {EVENTS_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM tele),
p AS (SELECT *, user_id = {RAMP_USER} AND i >= {RAMP_START} AND i < {RAMP_START + RAMP_N} AS inside,
             (i - {RAMP_START}) / {float(RAMP_N)} AS p FROM r)
SELECT event_id, user_id, ts,
       round(CASE WHEN inside AND value IS NOT NULL THEN value + 10.0 + 60.0 * pow(p, 2) ELSE value END, 6) AS value,
       round(CASE WHEN inside AND k IS NOT NULL THEN greatest(k - 2.0 - 15.0 * p, 30.0) ELSE k END, 6) AS k,
       CAST(CASE WHEN inside THEN 1 ELSE label END AS BIGINT) AS label
FROM p""")
def q_inject_ramp(spark, sf):
    out = labels.inject_ramp(events_telemetry(spark, sf), EVENTS, RAMP_USER, RAMP_START, RAMP_N, RAMPS)
    return rounded(out.select("event_id", "user_id", "ts", "value", "k", "label"))


@query("injected_check", f"""
WITH {EVENTS_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM tele),
l AS (SELECT user_id, CASE WHEN user_id = {RAMP_USER} AND i >= {RAMP_START} AND i < {RAMP_START + RAMP_N}
                           THEN 1 ELSE 0 END AS label FROM r)
SELECT CAST(count(*) FILTER (WHERE label = 1 AND user_id = {RAMP_USER}) AS BIGINT) AS found,
       CAST({RAMP_N} AS BIGINT) AS expected,
       CAST(count(*) FILTER (WHERE label = 1 AND user_id <> {RAMP_USER}) AS BIGINT) AS elsewhere,
       CAST(count(*) FILTER (WHERE label = 1 AND user_id = {RAMP_USER}) = {RAMP_N} AS BIGINT) AS ok
FROM l""")
def q_injected_check(spark, sf):
    # a clean table (all labels 0, as the generator starts) gets one fault window
    base = events_telemetry(spark, sf).withColumn("label", F.lit(0))
    out = labels.inject_ramp(base, EVENTS, RAMP_USER, RAMP_START, RAMP_N, RAMPS)
    return rounded(labels.injected_check(out, EVENTS, RAMP_USER, RAMP_N))
