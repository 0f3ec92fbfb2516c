"""Catalog: split and scaling (M1, M2), drift and monitoring (D1-D10) with
oracles, and the model queries (M3-M14, D5) checked on rows only."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltwatch.functions.columns import label_text, prediction_typing
from voltwatch.operators import boosting, drift, logistic, metrics, ml
from voltwatch.plans.catalog_features import FEATURE_SPEC
from voltwatch.plans.featureset import feature_pipeline
from voltwatch.plans.layout import materialize
from voltwatch.plans.registry import query, rounded
from voltwatch.sources.tables import EVENTS, EVENTS_SQL, events_telemetry

SEED = 42


def _u_sql(expr, seed=SEED):
    return f"(CAST(('0x' || substr(md5(concat_ws(':', '{seed}', CAST({expr} AS VARCHAR))), 1, 8)) AS BIGINT) / 4294967296.0)"


SPLIT_SQL = f"""split AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY label ORDER BY {_u_sql('event_id')}, event_id)
                 <= floor(count(*) OVER (PARTITION BY label) * 0.2 + 0.5) AS INTEGER) AS is_test
  FROM tele)"""


def _split(spark, sf, with_nulls=True):
    return ml.stratified_split(events_telemetry(spark, sf, with_nulls), "label", "event_id")


# ---------------------------------------------------------------- M1, M2
@query("stratified_split", f"""
WITH {EVENTS_SQL}, {SPLIT_SQL}
SELECT event_id, CAST(label AS BIGINT) AS label, CAST(is_test AS BIGINT) AS is_test FROM split""")
def q_stratified_split(spark, sf):
    return rounded(_split(spark, sf).select("event_id", "label", "is_test"))


@query("scale_features", f"""
WITH {EVENTS_SQL}, {SPLIT_SQL},
f AS (SELECT event_id, is_test, coalesce(value, 0) AS value, k FROM split),
s AS (SELECT avg(value) AS mv, stddev_pop(value) AS sv, avg(k) AS mk, stddev_pop(k) AS sk FROM f WHERE is_test = 0)
SELECT event_id, CAST(is_test AS BIGINT) AS is_test,
       round((value - mv) / CASE WHEN sv = 0 OR sv IS NULL THEN 1 ELSE sv END, 6) AS value,
       round((k - mk) / CASE WHEN sk = 0 OR sk IS NULL THEN 1 ELSE sk END, 6) AS k
FROM f, s""")
def q_scale_features(spark, sf):
    d = _split(spark, sf).fillna(0.0, subset=["value"])
    stats = ml.scaler_dict(ml.fit_scaler(d.where("is_test = 0"), ["value", "k"]))
    return rounded(ml.scale(d, stats).select("event_id", "is_test", "value", "k"))


# ---------------------------------------------------------------- D1-D4
CUT = "2024-01-16 00:00:00"
DRIFT_COLS = ["value", "k"]


def _halves(spark, sf, with_nulls=True):
    ev = events_telemetry(spark, sf, with_nulls)
    cut = F.lit(CUT).cast("timestamp_ntz")
    return ev.where(F.col("ts") < cut), ev.where(F.col("ts") >= cut)


_MELT_SQL = f"""m AS (
  SELECT CASE WHEN ts < TIMESTAMP '{CUT}' THEN 0 ELSE 1 END AS side, 'value' AS feature, value AS v FROM tele
  UNION ALL
  SELECT CASE WHEN ts < TIMESTAMP '{CUT}' THEN 0 ELSE 1 END AS side, 'k' AS feature, k AS v FROM tele)"""
_STATS = ["n", "mean", "median", "min", "max", "std", "null_pct", "distinct"]
_SUMMARY_SQL = """s AS (
  SELECT side, feature, count(*) AS n, avg(v) AS mean, median(v) AS median, min(v) AS min, max(v) AS max,
         stddev_samp(v) AS std, count(*) FILTER (WHERE v IS NULL) / count(*) AS null_pct,
         count(DISTINCT v) AS "distinct" FROM m GROUP BY side, feature),
sm AS (SELECT r.feature, """ + ", ".join(
    [f'r."{x}" AS ref_{x}' for x in _STATS] + [f'c."{x}" AS cur_{x}' for x in _STATS]) + """,
       coalesce(abs(c.mean - r.mean) > 2.0 * r.std, false) AS mean_drift, c.null_pct = 1 AS no_data
  FROM s r JOIN s c ON r.feature = c.feature AND r.side = 0 AND c.side = 1)"""


def _r(c):
    return f"round({c}, 6) AS {c}"


@query("drift_summary", f"""
WITH {EVENTS_SQL}, {_MELT_SQL}, {_SUMMARY_SQL}
SELECT feature, {', '.join(f'CAST({p}_n AS BIGINT) AS {p}_n' for p in ('ref', 'cur'))},
       {', '.join(_r(f'{p}_{x}') for p in ('ref', 'cur') for x in _STATS if x not in ('n', 'distinct'))},
       {', '.join(f'CAST({p}_distinct AS BIGINT) AS {p}_distinct' for p in ('ref', 'cur'))},
       CAST(mean_drift AS BIGINT) AS mean_drift, CAST(no_data AS BIGINT) AS no_data
FROM sm""")
def q_drift_summary(spark, sf):
    ref, cur = _halves(spark, sf)
    return rounded(drift.drift_summary(ref, cur, DRIFT_COLS))


_KS_SQL = """g AS (SELECT feature, v, count(*) FILTER (WHERE side = 0) AS a, count(*) FILTER (WHERE side = 1) AS b
       FROM m WHERE v IS NOT NULL GROUP BY feature, v),
c AS (SELECT feature,
             sum(a) OVER (PARTITION BY feature ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ca,
             sum(b) OVER (PARTITION BY feature ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cb,
             sum(a) OVER (PARTITION BY feature) AS na, sum(b) OVER (PARTITION BY feature) AS nb FROM g),
d AS (SELECT feature, na, nb, max(abs(ca / na - cb / nb)) AS ks_stat FROM c GROUP BY feature, na, nb),
l AS (SELECT *, (sqrt(na * nb / (na + nb)) + 0.12 + 0.11 / sqrt(na * nb / (na + nb))) * ks_stat AS lam FROM d),
ks AS (SELECT feature, na, nb, ks_stat,
              CASE WHEN lam = 0 THEN 1.0 ELSE least(greatest(1 - sqrt(2 * pi()) / lam * list_sum(list_transform(range(1, 201),
                    lambda j: exp(-(2 * j - 1) * (2 * j - 1) * pi() * pi() / (8 * lam * lam)))), 0.0), 1.0) END AS ks_p FROM l)"""


@query("drift_ks", f"""
WITH {EVENTS_SQL}, {_MELT_SQL}, {_KS_SQL}
SELECT feature, CAST(na AS BIGINT) AS n_ref, CAST(nb AS BIGINT) AS n_cur, round(ks_stat, 6) AS ks_stat,
       round(ks_p, 6) AS ks_p FROM ks""")
def q_drift_ks(spark, sf):
    ref, cur = _halves(spark, sf)
    return rounded(drift.drift_ks(ref, cur, DRIFT_COLS))


_PSI_SQL = """e AS (SELECT feature, quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges
       FROM m WHERE side = 0 GROUP BY feature),
bn AS (SELECT m.feature, m.side, len(list_filter(e.edges, lambda x: x < m.v)) AS bin
       FROM m JOIN e ON m.feature = e.feature WHERE m.v IS NOT NULL),
pg AS (SELECT feature, bin, count(*) FILTER (WHERE side = 0) AS a, count(*) FILTER (WHERE side = 1) AS b
       FROM bn GROUP BY feature, bin),
pq AS (SELECT feature, greatest(a / sum(a) OVER (PARTITION BY feature), 0.0001) AS p,
              greatest(b / sum(b) OVER (PARTITION BY feature), 0.0001) AS q FROM pg),
psi AS (SELECT feature, sum((q - p) * ln(q / p)) AS psi FROM pq GROUP BY feature)"""


@query("drift_psi", f"""
WITH {EVENTS_SQL}, {_MELT_SQL}, {_PSI_SQL}
SELECT feature, round(psi, 6) AS psi,
       CASE WHEN psi < 0.1 THEN 'stable' WHEN psi <= 0.2 THEN 'moderate' ELSE 'significant' END AS band
FROM psi""")
def q_drift_psi(spark, sf):
    ref, cur = _halves(spark, sf)
    return rounded(drift.drift_psi(ref, cur, DRIFT_COLS))


@query("drift_chi2", f"""
WITH {EVENTS_SQL},
m AS (SELECT CASE WHEN ts < TIMESTAMP '{CUT}' THEN 0 ELSE 1 END AS side, 'event_type' AS feature,
             CAST(event_type AS VARCHAR) AS cat FROM tele
      UNION ALL
      SELECT CASE WHEN ts < TIMESTAMP '{CUT}' THEN 0 ELSE 1 END, 'k', CAST(CAST(k AS INTEGER) AS VARCHAR) FROM tele),
o AS (SELECT feature, cat, side, count(*) AS o FROM m GROUP BY feature, cat, side),
cells AS (SELECT c.feature, c.cat, s.side, coalesce(o.o, 0) AS o
          FROM (SELECT DISTINCT feature, cat FROM o) c JOIN (SELECT DISTINCT feature, side FROM o) s
               ON c.feature = s.feature
          LEFT JOIN o ON o.feature = c.feature AND o.cat = c.cat AND o.side = s.side),
ex AS (SELECT *, sum(o) OVER (PARTITION BY feature, cat) * sum(o) OVER (PARTITION BY feature, side)
                 / sum(o) OVER (PARTITION BY feature) AS e FROM cells)
SELECT feature, round(chi2, 6) AS chi2, dof,
       round(1 - list_sum(list_transform(range(0, 2000),
             lambda i: exp((dof / 2.0 + i) * ln(chi2 / 2) - chi2 / 2 - lgamma(dof / 2.0 + i + 1)))), 6) AS p_value
FROM (SELECT feature, sum((o - e) * (o - e) / e) AS chi2, CAST((count(DISTINCT cat) - 1) * (count(DISTINCT side) - 1) AS BIGINT) AS dof
      FROM ex GROUP BY feature)""")
def q_drift_chi2(spark, sf):
    ref, cur = _halves(spark, sf)
    cast = {"k": F.col("k").cast("int")}
    return rounded(drift.drift_chi2(ref.withColumns(cast), cur.withColumns(cast), ["event_type", "k"]))


# ---------------------------------------------------------------- D7-D10
THRESH_PROD, THRESH_NEW = 50.0, 40.0


def _pred(spark, sf, thr=THRESH_PROD):
    ev = events_telemetry(spark, sf, with_nulls=False)
    return ev.withColumn("pred", (F.col("value") >= thr).cast("int"))


_PERF_SQL = f"""pf AS (
  SELECT date_trunc('day', ts) AS period_start,
         count(*) FILTER (WHERE label = 0 AND pred = 0) AS tn, count(*) FILTER (WHERE label = 0 AND pred = 1) AS fp,
         count(*) FILTER (WHERE label = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE label = 1 AND pred = 1) AS tp,
         count(*) FILTER (WHERE label IS NOT NULL AND pred IS NULL) AS not_scored
  FROM (SELECT ts, CAST(event_type = 'error' AS INTEGER) AS label,
               CAST(value >= {THRESH_PROD} AS INTEGER) AS pred FROM events) x GROUP BY 1),
perf AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
                CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall,
                CASE WHEN tp + fn > 0 THEN fn / (tp + fn) END AS fn_rate FROM pf)"""


def _areas_sql(name: str, key: str, where: str = "true") -> str:
    """ROC and PR areas of ``value`` per key, for the oracle."""
    return f"""{name}_g AS (SELECT {key} AS key, value, count(*) FILTER (WHERE event_type = 'error') AS pos,
                count(*) FILTER (WHERE event_type <> 'error') AS neg FROM events WHERE value IS NOT NULL AND {where} GROUP BY 1, 2),
{name}_c AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM {name}_g
         WINDOW w AS (PARTITION BY key ORDER BY value DESC ROWS UNBOUNDED PRECEDING)),
{name}_s AS (SELECT key, sum(pos) AS p, sum(neg) AS n, sum(neg * (2 * tp - pos) / 2.0) AS roc,
                sum(pos * (tp / (tp + fp) + CASE WHEN tp - pos + fp - neg = 0 THEN 1.0 ELSE (tp - pos) / (tp - pos + fp - neg) END) / 2.0) AS pr
         FROM {name}_c GROUP BY key),
{name} AS (SELECT key, CASE WHEN p > 0 AND n > 0 THEN roc / (p * n) END AS roc_auc, CASE WHEN p > 0 AND n > 0 THEN pr / p END AS pr_auc FROM {name}_s)"""


_DAYS_SQL = f"""{_areas_sql('day_area', "date_trunc('day', ts)")},
{_areas_sql('base_area', '0', f"ts < TIMESTAMP '{CUT}'")},
days AS (SELECT perf.*, roc_auc, pr_auc, ((SELECT pr_auc FROM base_area) - pr_auc) / (SELECT pr_auc FROM base_area) AS pr_auc_drop
         FROM perf LEFT JOIN day_area ON day_area.key = perf.period_start)"""


def _days(spark, sf):
    """Performance by day, with the PR area of the first half as baseline."""
    d = _pred(spark, sf)
    base = metrics.ranking_metrics(d.where(F.col("ts") < F.lit(CUT).cast("timestamp_ntz")), "value", "label").first()["pr_auc"]
    return drift.performance_by_period(d, "ts", "label", "pred", "1 day", score="value", pr_baseline=base)


@query("performance_by_day", f"""
WITH {_PERF_SQL}, {_DAYS_SQL}
SELECT CAST(period_start AS TIMESTAMP) AS period_start, CAST(tn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp,
       CAST(fn AS BIGINT) AS fn, CAST(tp AS BIGINT) AS tp, round(precision, 6) AS precision,
       CAST(not_scored AS BIGINT) AS not_scored, round(recall, 6) AS recall,
       round(CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END, 6) AS f1,
       round(fn_rate, 6) AS fn_rate, CAST(recall < 0.85 AS BIGINT) AS recall_alarm, round(roc_auc, 6) AS roc_auc,
       round(pr_auc, 6) AS pr_auc, round(pr_auc_drop, 6) AS pr_auc_drop, CAST(coalesce(pr_auc_drop > 0.1, false) AS BIGINT) AS pr_alarm
FROM days""")
def q_performance_by_day(spark, sf):
    return rounded(_days(spark, sf))


@query("error_rows", f"""
SELECT event_id, user_id, ts, CAST(event_type = 'error' AS BIGINT) AS label,
       CAST(value >= {THRESH_PROD} AS BIGINT) AS pred,
       CASE WHEN value >= {THRESH_PROD} THEN 'false_positive' ELSE 'false_negative' END AS error
FROM events WHERE CAST(event_type = 'error' AS INTEGER) <> CAST(value >= {THRESH_PROD} AS INTEGER)""")
def q_error_rows(spark, sf):
    e = drift.error_rows(_pred(spark, sf), "label", "pred")
    return rounded(e.select("event_id", "user_id", "ts", "label", "pred", "error"))


#: Trigger name -> its condition in the oracle, in reason order.
_TRIGGERS = {
    "mean_shift": "mean_drift_features > 0", "no_data": "no_data_features > 0", "psi": "max_psi > 0.2", "ks": "ks_failing_share > 0",
    "recall": "min_recall < 0.85", "fn_rate": "max_fn_rate > 0.1", "pr_auc": "max_pr_auc_drop > 0.1",
}


@query("retrain_triggers", f"""
WITH {EVENTS_SQL}, {_MELT_SQL}, {_SUMMARY_SQL}, {_KS_SQL}, {_PSI_SQL}, {_PERF_SQL}, {_DAYS_SQL},
one AS (SELECT (SELECT count(*) FILTER (WHERE mean_drift) FROM sm) AS mean_drift_features,
               (SELECT count(*) FILTER (WHERE no_data) FROM sm) AS no_data_features,
               (SELECT max(psi) FROM psi) AS max_psi, (SELECT min(ks_p) FROM ks) AS min_ks_p,
               (SELECT count(*) FILTER (WHERE ks_p < 0.05) / count(*) FROM ks) AS ks_failing_share,
               (SELECT min(recall) FROM days) AS min_recall, (SELECT max(fn_rate) FROM days) AS max_fn_rate,
               (SELECT max(pr_auc_drop) FROM days) AS max_pr_auc_drop),
fl AS (SELECT *, {', '.join(f'coalesce({c}, false) AS t_{k}' for k, c in _TRIGGERS.items())} FROM one)
SELECT CAST(mean_drift_features AS BIGINT) AS mean_drift_features, CAST(no_data_features AS BIGINT) AS no_data_features,
       {', '.join(_r(c) for c in ('max_psi', 'min_ks_p', 'ks_failing_share', 'min_recall', 'max_fn_rate', 'max_pr_auc_drop'))},
       {', '.join(f'CAST(t_{k} AS BIGINT) AS trigger_{k}' for k in _TRIGGERS)},
       array_to_string(list_filter([{', '.join(f"CASE WHEN t_{k} THEN '{k}' END" for k in _TRIGGERS)}],
                                   lambda x: x IS NOT NULL), ',') AS reasons,
       CAST({' OR '.join(f't_{k}' for k in _TRIGGERS)} AS BIGINT) AS retrain
FROM fl""")
def q_retrain_triggers(spark, sf):
    ref, cur = _halves(spark, sf)
    summ = drift.drift_summary(ref, cur, DRIFT_COLS)
    psi = drift.drift_psi(ref, cur, DRIFT_COLS)
    ks = drift.drift_ks(ref, cur, DRIFT_COLS)
    return rounded(drift.triggers(summ, psi, ks, _days(spark, sf)))


def ledger_from_metrics(spark, sf, run_id: str, thr: float):
    ev = _pred(spark, sf, thr)
    m = metrics.evaluate(ev, "label", "pred")
    return m.select(F.lit("threshold").alias("experiment"), F.lit(run_id).alias("run_id"),
                    F.lit("metric").alias("kind"), F.col("metric").alias("key"),
                    F.col("value").cast("string").alias("value"))


def _gate_cte(thr, name):
    return f"""{name} AS (
  SELECT CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
         CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall
  FROM (SELECT count(*) FILTER (WHERE label = 0 AND pred = 1) AS fp, count(*) FILTER (WHERE label = 1 AND pred = 0) AS fn,
               count(*) FILTER (WHERE label = 1 AND pred = 1) AS tp
        FROM (SELECT CAST(event_type = 'error' AS INTEGER) AS label, CAST(value >= {thr} AS INTEGER) AS pred
              FROM events) x) y)"""


@query("promotion_gate", f"""
WITH {_gate_cte(THRESH_NEW, 'nw')}, {_gate_cte(THRESH_PROD, 'pr')}
SELECT round(nw.recall, 6) AS new_recall, round(pr.recall, 6) AS prod_recall,
       round(nw.precision, 6) AS new_precision, round(pr.precision, 6) AS prod_precision,
       CAST(nw.recall > pr.recall AND nw.precision >= 0.0 AS BIGINT) AS promote
FROM nw, pr""")
def q_promotion_gate(spark, sf):
    ledger = ledger_from_metrics(spark, sf, "new", THRESH_NEW).unionByName(
        ledger_from_metrics(spark, sf, "prod", THRESH_PROD))
    return rounded(drift.promotion_gate(ledger, "new", "prod"))


# ---------------------------------------------------------------- models (rows only)
def _features(spark, sf):
    d = events_telemetry(spark, sf).drop("event_type")
    d = feature_pipeline(d, EVENTS, FEATURE_SPEC)
    d = ml.stratified_split(d, "label", "event_id")
    feats = [c for c in d.columns if c not in ("event_id", "ts", "user_id", "label", "is_test")]
    return d, feats


@query("train_compare")
def q_train_compare(spark, sf):
    """Three weighted models, evaluated on the
    stratified test rows, tabulated and ranked by PR-AUC."""
    d, feats = _features(spark, sf)
    d = materialize(d)
    tr, te = d.where("is_test = 0"), d.where("is_test = 1")
    forest = ml.train(tr, feats, "label", "rf")
    boosted = boosting.train(tr, feats, "label", "event_id", boosting.Spec(positive=boosting.positive_weight(tr, "label")))
    scored = {
        "Logistic Regression": logistic.train(tr, feats, "label").score(te, keep=["label"]),
        "Random Forest": ml.score(te, forest, keep=["label"]),
        "Gradient Boosting": boosted.score(te, keep=["label"]),
    }
    parts = [metrics.evaluate(sc, "label", "prediction", "probability").withColumn("model", F.lit(name)) for name, sc in scored.items()]
    led = parts[0]
    for p in parts[1:]:
        led = led.unionByName(p)
    from voltwatch.operators.reshape import results_table
    keys = ["accuracy", "precision_1", "recall_1", "f1_1", "roc_auc", "pr_auc", "tn", "fp", "fn", "tp"]
    table = results_table(led, "model", "metric", "value", keys)
    return table.orderBy(F.desc_nulls_last("pr_auc"))


@query("batch_score")
def q_batch_score(spark, sf):
    """Train on the split's train rows, score every row."""
    d, feats = _features(spark, sf)
    m = ml.train(d.where("is_test = 0"), feats, "label", "gbt")
    sc = ml.score(d, m, keep=["event_id", "user_id"])
    typed = prediction_typing(F.col("prediction"), F.col("probability"), F.col("user_id").cast("string"))
    return sc.select("event_id", *typed, label_text("prediction").alias("outcome"))


@query("smote_balance")
def q_smote_balance(spark, sf):
    """M7: scaled train rows balanced 1:1 by SMOTE, class counts after."""
    d, feats = _features(spark, sf)
    tr = materialize(d.where("is_test = 0").select("event_id", "label", *feats))  # read five times
    stats = ml.scaler_dict(ml.fit_scaler(tr.fillna(0.0, subset=feats), feats))
    tr = ml.scale(tr.fillna(0.0, subset=feats), stats)
    bal = ml.smote(tr, feats, "label", k=ml.SMOTE_K, id_col="event_id")
    return bal.groupBy("label").agg(F.count(F.lit(1)).alias("rows"), *[F.avg(c).alias(f"mean_{c}") for c in feats[:2]])


@query("random_search")
def q_random_search(spark, sf):
    """Random search (20 draws x 3 holdouts, as the reference), refit
    of the best draw on all train rows, evaluation on test."""
    d, feats = _features(spark, sf)
    d = materialize(d)
    tr, te = d.where("is_test = 0"), d.where("is_test = 1")
    best = ml.best_draw(ml.random_search(tr, feats, "label", "event_id"))
    spec = ml.boosted_spec(best, boosting.positive_weight(tr, "label"))
    sc = boosting.train(tr, feats, "label", "event_id", spec).score(te, keep=["label"])
    ev = metrics.evaluate(sc, "label", "prediction", "probability")
    return ev.withColumn("best_draw", F.lit(best["draw"])).withColumn("best_cv_f1", F.lit(best["mean_f1"]))


@query("adversarial_auc")
def q_adversarial_auc(spark, sf):
    """Reference vs current halves of January, AUC and importances."""
    ref, cur = _halves(spark, sf, with_nulls=False)
    auc, imps = drift.adversarial(ref, cur, DRIFT_COLS)
    row = auc.first()
    return imps.withColumn("roc_auc", F.lit(row["roc_auc"])).withColumn("pr_auc", F.lit(row["pr_auc"]))


# ---------------------------------------------------------------- O4, M15, M16, D6
BEST_THRESHOLDS = (30.0, 40.0, 50.0, 60.0)


def _f1_sql(thr):
    return f"""SELECT 'thr_{int(thr)}' AS run_id,
       CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END AS f1_1
FROM (SELECT count(*) FILTER (WHERE label = 0 AND pred = 1) AS fp, count(*) FILTER (WHERE label = 1 AND pred = 0) AS fn,
             count(*) FILTER (WHERE label = 1 AND pred = 1) AS tp
      FROM (SELECT CAST(event_type = 'error' AS INTEGER) AS label, CAST(value >= {thr} AS INTEGER) AS pred
            FROM events) x) y"""


@query("best_run", f"""
WITH r AS ({' UNION ALL '.join(_f1_sql(t) for t in BEST_THRESHOLDS)})
SELECT run_id, round(f1_1, 6) AS f1_1 FROM r ORDER BY f1_1 DESC, run_id LIMIT 1""")
def q_best_run(spark, sf):
    """The best run of a ledger by a metric (top-1 over the ledger)."""
    led = None
    for t in BEST_THRESHOLDS:
        part = ledger_from_metrics(spark, sf, f"thr_{int(t)}", t)
        led = part if led is None else led.unionByName(part)
    f1 = led.where(F.col("key") == "f1_1").select("run_id", F.col("value").cast("double").alias("f1_1"))
    return rounded(f1.orderBy(F.desc("f1_1"), "run_id").limit(1))  # a top-1, ties by name


def _rank_sql(table, label, id_col, seed=SEED):
    return f"""SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY {_u_sql(id_col, seed)}, {id_col}) AS rk,
       count(*) OVER (PARTITION BY {label}) AS nc FROM {table}"""


@query("resample_balance", f"""
WITH r AS ({_rank_sql('labels', 'toxic', 'doc_id')}),
c AS (SELECT max(nc) FILTER (WHERE toxic = 1) AS n_min, max(nc) FILTER (WHERE toxic <> 1) AS n_maj FROM r),
o AS (SELECT r.doc_id, r.toxic,
             CASE WHEN r.toxic = 1 THEN c.n_maj // c.n_min + CASE WHEN r.rk <= c.n_maj % c.n_min THEN 1 ELSE 0 END
                  ELSE 1 END AS copies FROM r, c)
SELECT 'over' AS mode, doc_id, CAST(toxic AS BIGINT) AS toxic, CAST(copy AS BIGINT) AS copy
FROM o, LATERAL (SELECT unnest(range(1, copies + 1)) AS copy) t
UNION ALL
SELECT 'under', r.doc_id, CAST(r.toxic AS BIGINT), CAST(1 AS BIGINT) FROM r, c WHERE r.toxic = 1 OR r.rk <= c.n_min""")
def q_resample_balance(spark, sf):
    """Random oversampling of the minority and undersampling of the
    majority (md5 ranks), as one long result."""
    lab = table_labels(spark, sf)
    over = ml.oversample(lab, "toxic", "doc_id").select(F.lit("over").alias("mode"), "doc_id", "toxic", "copy")
    under = ml.undersample(lab, "toxic", "doc_id").select(F.lit("under").alias("mode"), "doc_id", "toxic",
                                                          F.lit(1).alias("copy"))
    return rounded(over.unionByName(under))


def table_labels(spark, sf):
    from voltwatch.sources.tables import table
    return table(spark, sf, "labels")


@query("minmax_interactions", f"""
WITH {EVENTS_SQL}
SELECT event_id, user_id,
       round(CASE WHEN max(value) OVER (PARTITION BY user_id) = min(value) OVER (PARTITION BY user_id) THEN 0.0
             ELSE (value - min(value) OVER (PARTITION BY user_id))
                  / (max(value) OVER (PARTITION BY user_id) - min(value) OVER (PARTITION BY user_id)) END, 6)
           AS MinMax_value,
       round(CASE WHEN max(k) OVER (PARTITION BY user_id) = min(k) OVER (PARTITION BY user_id) THEN 0.0
             ELSE (k - min(k) OVER (PARTITION BY user_id))
                  / (max(k) OVER (PARTITION BY user_id) - min(k) OVER (PARTITION BY user_id)) END, 6) AS MinMax_k,
       round(value * k, 6) AS value_x_k
FROM tele""")
def q_minmax_interactions(spark, sf):
    """Per-entity min-max normalisation and an interaction term."""
    ev = events_telemetry(spark, sf)
    out = ml.interactions(ml.minmax(ev, ["value", "k"], by=["user_id"]), [("value", "k")])
    return rounded(out.select("event_id", "user_id", "MinMax_value", "MinMax_k", "value_x_k"))


@query("prediction_drift")
def q_prediction_drift(spark, sf):
    """KS and PSI of the model's class-1 probability between the two
    halves of January, and the shift of the predicted positive share."""
    ref, cur = _halves(spark, sf, with_nulls=False)
    model = ml.train(ref, DRIFT_COLS, "label", "rf")
    sr = ml.score(ref, model)
    sc = ml.score(cur, model)
    ks = drift.drift_ks(sr, sc, ["probability"])
    psi = drift.drift_psi(sr, sc, ["probability"])
    share = (sr.agg(F.avg("prediction").alias("ref_pos_share"))
             .unionByName(sc.agg(F.avg("prediction").alias("cur_pos_share")), allowMissingColumns=True)
             .agg(F.max("ref_pos_share").alias("ref_pos_share"), F.max("cur_pos_share").alias("cur_pos_share"))
             .withColumn("feature", F.lit("probability")))
    return ks.join(psi, "feature").join(share, "feature")


# ---------------------------------------------------------------- H7 leakage-safe splits
@query("split_by_entity", f"""
WITH u AS (SELECT DISTINCT user_id FROM events),
r AS (SELECT user_id, row_number() OVER (ORDER BY {_u_sql('user_id')}, user_id) AS rk, count(*) OVER () AS n FROM u)
SELECT e.event_id, e.user_id, CAST(r.rk <= floor(r.n * 0.2 + 0.5) AS BIGINT) AS is_test
FROM events e JOIN r USING (user_id)""")
def q_split_by_entity(spark, sf):
    """H7: whole entities to test, so rolling windows do not leak."""
    ev = events_telemetry(spark, sf)
    return rounded(ml.entity_split(ev, "user_id").select("event_id", "user_id", "is_test"))


@query("split_by_time", """
WITH c AS (SELECT quantile_cont(CAST(epoch_us(ts) AS DOUBLE), 0.8) AS cut FROM events)
SELECT event_id, CAST(CAST(epoch_us(ts) AS DOUBLE) >= cut AS BIGINT) AS is_test FROM events, c""")
def q_split_by_time(spark, sf):
    """H7: the latest 20 % of time to test."""
    ev = events_telemetry(spark, sf)
    return rounded(ml.time_split(ev, "ts").select("event_id", "is_test"))
