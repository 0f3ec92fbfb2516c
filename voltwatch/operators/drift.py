"""Drift, monitoring and retraining decisions.

Reference and current frames are melted to (feature, v) and compared per
feature with aggregates; the KS statistic uses exact running counts over
distinct values (segmented, so one feature with billions of distinct
values is not one task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltwatch.config import DEFAULT_SCALE, Columns, Scale
from voltwatch.functions.tails import chi2_tail, ks_tail
from voltwatch.operators import metrics
from voltwatch.operators.quantiles import quantiles
from voltwatch.plans.layout import null_safe, running

# Fixed values from the monitoring notes.
PSI_BANDS = (0.1, 0.2)
KS_ALPHA = 0.05
MEAN_SHIFT_SIGMAS = 2.0
RECALL_FLOOR = 0.85
PSI_EPS = 1e-4
PR_DROP = 0.1
FN_RISE = 0.1


def _melt(df: DataFrame, cols, side: int | None = None) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in cols])
    out = df.select(F.inline(arr))
    return out.withColumn("side", F.lit(side)) if side is not None else out


def side_summary(df: DataFrame, cols) -> DataFrame:
    m = _melt(df, cols)
    g = m.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), F.avg("v").alias("mean"),
        F.min("v").alias("min"), F.max("v").alias("max"), F.stddev_samp("v").alias("std"),
        (F.count_if(F.col("v").isNull()) / F.count(F.lit(1))).alias("null_pct"),
        F.count_distinct("v").cast("long").alias("distinct"))
    med = quantiles(m, ["feature"], ["v"], [0.5]).select("feature", F.col("v")[0].alias("median"))
    return g.join(med, "feature", "left")  # one row per feature on both sides


def drift_summary(ref: DataFrame, cur: DataFrame, cols, sigmas: float = MEAN_SHIFT_SIGMAS) -> DataFrame:
    """Summary of each feature on both sides; ``mean_drift`` when the
    current mean moved more than ``sigmas`` reference std, ``no_data`` when
    the current side has no value of the feature (or no rows)."""
    stats = ["n", "mean", "median", "min", "max", "std", "null_pct", "distinct"]
    r = side_summary(ref, cols).select("feature", *[F.col(s).alias(f"ref_{s}") for s in stats])
    c = side_summary(cur, cols).select("feature", *[F.col(s).alias(f"cur_{s}") for s in stats])
    j = r.join(c, "feature", "full")  # one row per feature on both sides
    j = j.fillna(0, ["ref_n", "cur_n", "ref_distinct", "cur_distinct"])
    shift = F.abs(F.col("cur_mean") - F.col("ref_mean"))
    j = j.withColumn("mean_drift", F.coalesce(shift > sigmas * F.col("ref_std"), F.lit(False)))
    return j.withColumn("no_data", (F.col("cur_n") == 0) | (F.col("cur_null_pct") == 1))


def drift_ks(ref: DataFrame, cur: DataFrame, cols, scale: Scale = DEFAULT_SCALE) -> DataFrame:
    """Two-sample KS statistic (max CDF gap) and p-value per feature
    (exact for small samples, else asymptotic); NULLs are ignored, and a side
    without values gives NULLs."""
    m = _melt(ref, cols, 0).unionByName(_melt(cur, cols, 1)).where(F.col("v").isNotNull())
    g = m.groupBy("feature", "v").agg(F.count_if(F.col("side") == 0).alias("a"),
                                      F.count_if(F.col("side") == 1).alias("b"))
    tot = g.groupBy("feature").agg(F.sum("a").alias("na"), F.sum("b").alias("nb"))
    cum = running(g, Columns(entity="feature", time="v"), {"ca": F.col("a"), "cb": F.col("b")}, scale=scale)
    cum = cum.join(F.broadcast(tot), "feature")  # one row per feature
    gap = F.abs(F.try_divide("ca", "na") - F.try_divide("cb", "nb"))  # NULL when a side has no value
    d = cum.groupBy("feature", "na", "nb").agg(F.max(gap).alias("ks_stat"))
    return d.select("feature", F.col("na").cast("long").alias("n_ref"), F.col("nb").cast("long").alias("n_cur"),
                    "ks_stat", ks_tail(F.col("ks_stat"), F.col("na"), F.col("nb")).alias("ks_p"))


def drift_psi(ref: DataFrame, cur: DataFrame, cols, bins: int = 10, eps: float = PSI_EPS,
              scale: Scale = DEFAULT_SCALE) -> DataFrame:
    """D3: population stability index on the reference's quantile bins
    (bin i holds values above i edges); empty shares become ``eps``, and a
    feature without values on one side has the index NULL."""
    qs = [i / bins for i in range(1, bins)]
    mr, mc = _melt(ref, cols, 0), _melt(cur, cols, 1)
    edges = quantiles(mr, ["feature"], ["v"], qs, scale).withColumnRenamed("v", "edges")
    m = mr.unionByName(mc).where(F.col("v").isNotNull()).join(F.broadcast(edges), "feature", "left")
    m = m.withColumn("bin", F.size(F.filter("edges", lambda e: e < F.col("v"))))
    g = m.groupBy("feature", "bin").agg(F.count_if(F.col("side") == 0).alias("a"),
                                        F.count_if(F.col("side") == 1).alias("b"))
    w = Window.partitionBy("feature")
    na, nb = F.sum("a").over(w), F.sum("b").over(w)
    p = F.greatest(F.try_divide(F.col("a"), na), F.lit(eps))
    q = F.greatest(F.try_divide(F.col("b"), nb), F.lit(eps))
    # a side without values has no shares: the index is NULL
    g = g.withColumn("term", F.when((na > 0) & (nb > 0), (q - p) * F.log(q / p)))
    out = g.groupBy("feature").agg(F.sum("term").alias("psi"))
    lo, hi = PSI_BANDS
    return out.withColumn("band", F.when(F.col("psi") < lo, "stable").when(F.col("psi") <= hi, "moderate")
                          .otherwise("significant"))


def drift_chi2(ref: DataFrame, cur: DataFrame, cols) -> DataFrame:
    """Chi-square statistic, degrees of freedom and p-value of the
    category x side contingency table, per categorical column; NULL is a
    category."""
    def melt_s(df, side):
        arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")).alias("cat")) for c in cols])
        return df.select(F.inline(arr)).withColumn("side", F.lit(side))

    m = melt_s(ref, 0).unionByName(melt_s(cur, 1))
    o = m.groupBy("feature", "cat", "side").agg(F.count(F.lit(1)).alias("o"))
    cats = o.select("feature", "cat").distinct().withColumn("_one", F.lit(1))
    sides = o.select("feature", "side").distinct()
    cells = cats.join(sides, "feature").join(o, ["feature", "cat", "side"], "left").fillna(0, ["o"])
    wf = Window.partitionBy("feature")
    e = (F.sum("o").over(Window.partitionBy("feature", "cat")) * F.sum("o").over(Window.partitionBy("feature", "side"))
         / F.sum("o").over(wf))
    cells = cells.withColumn("e", e)
    agg = cells.groupBy("feature").agg(
        F.sum((F.col("o") - F.col("e")) ** 2 / F.col("e")).alias("chi2"),
        F.count_distinct("cat").alias("r"), F.count_distinct("side").alias("c"))
    dof = ((F.col("r") - 1) * (F.col("c") - 1)).cast("long")
    return agg.select("feature", "chi2", dof.alias("dof"), chi2_tail(F.col("chi2"), dof).alias("p_value"))


def adversarial(ref: DataFrame, cur: DataFrame, cols, trees: int = 100, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Classify reference (0) vs current (1) with a random forest on a
    stratified holdout; returns (metrics row with roc_auc/pr_auc, feature
    importances)."""
    from voltwatch.operators import ml

    d = ref.select(*cols).withColumn("_side", F.lit(0)).unionByName(cur.select(*cols).withColumn("_side", F.lit(1)))
    d = d.withColumn("_rid", F.xxhash64(*cols, "_side"))
    d = ml.stratified_split(d, "_side", "_rid", seed=seed)
    tr, te = d.where("is_test = 0"), d.where("is_test = 1")
    m = ml.train(tr, list(cols), "_side", "rf", {"numTrees": trees}, weight_mode=None, seed=seed)
    sc = ml.score(te, m, keep=["_side"])
    auc = metrics.ranking_metrics(sc, "probability", "_side")
    imp = m.model.stages[-1].featureImportances.toArray().tolist()
    spark = ref.sparkSession
    imps = spark.createDataFrame([(c, float(v)) for c, v in zip(cols, imp)], "feature string, importance double")
    return auc, imps


def performance_by_period(df: DataFrame, time: str, label: str, pred: str, period: str = "1 day",
                          recall_floor: float = RECALL_FLOOR, score: str | None = None,
                          pr_baseline: float | None = None, pr_drop: float = PR_DROP,
                          scale: Scale = DEFAULT_SCALE) -> DataFrame:
    """Confusion counts, rows not scored, precision, recall, F1 (class 1)
    and false-negative rate per tumbling period; ``recall_alarm`` when recall
    < floor.  With a ``score`` column also the ROC and PR areas of each period
    (NULL with one class), and with a baseline the relative drop of the PR
    area; ``pr_alarm`` when it exceeds ``pr_drop``."""
    from voltwatch.operators.reshape import _seconds, bucket_start
    start = bucket_start(F.col(time), _seconds(period), df.schema[time].dataType)
    d = df.withColumn("period_start", start)
    cm = metrics.confusion(d, label, pred, by=["period_start"])
    p = metrics._div(F.col("tp"), F.col("tp") + F.col("fp"))
    r = metrics._div(F.col("tp"), F.col("tp") + F.col("fn"))
    out = cm.select("period_start", "tn", "fp", "fn", "tp", "not_scored", p.alias("precision"), r.alias("recall"),
                    metrics._div(2 * p * r, p + r).alias("f1"), F.try_divide("fn", F.col("fn") + F.col("tp")).alias("fn_rate"),
                    (r < recall_floor).alias("recall_alarm"))
    if score is None:
        return out
    areas = metrics.ranking_metrics(d.where(F.col(label).isNotNull()), score, label, scale, by="period_start")
    out = null_safe(out, areas, ["period_start"])  # one row per period on both sides
    if pr_baseline is not None:
        drop = (F.lit(pr_baseline) - F.col("pr_auc")) / F.lit(pr_baseline)
        out = out.withColumn("pr_auc_drop", drop).withColumn("pr_alarm", F.coalesce(drop > pr_drop, F.lit(False)))
    return out


def error_rows(df: DataFrame, label: str, pred: str) -> DataFrame:
    """False positives, false negatives and labelled rows without a
    prediction, tagged."""
    y, p = F.col(label), F.col(pred)
    kind = F.when(p.isNull(), "not_scored").when(p == 1, "false_positive").otherwise("false_negative")
    return df.where(y.isNotNull() & ~y.eqNullSafe(p)).withColumn("error", kind)


def triggers(summary: DataFrame, psi: DataFrame, ks: DataFrame, perf: DataFrame, model_age_days: float | None = None,
             max_age_days: float = 30.0, psi_limit: float = PSI_BANDS[1], alpha: float = KS_ALPHA,
             recall_floor: float = RECALL_FLOOR, ks_share: float = 0.0, pr_drop: float = PR_DROP,
             fn_baseline: float = 0.0, fn_rise: float = FN_RISE) -> DataFrame:
    """One row of trigger booleans and a reason list (any trigger ->
    retrain).  Each input is reduced to one row first.

    ``ks`` fires when more than ``ks_share`` of the features fail the test
    (0: any), ``no_data`` when a feature has no current value, ``fn_rate``
    when a period's false-negative rate is ``fn_rise`` above its baseline,
    ``pr_auc`` when a period's PR area (if ``perf`` has ``pr_auc_drop``)
    dropped by more than ``pr_drop``."""
    drop = F.col("pr_auc_drop") if "pr_auc_drop" in perf.columns else F.lit(None).cast("double")
    parts = [
        summary.agg(F.count_if("mean_drift").cast("long").alias("mean_drift_features"), F.count_if("no_data").cast("long").alias("no_data_features")),
        psi.agg(F.max("psi").alias("max_psi")),
        ks.agg(F.min("ks_p").alias("min_ks_p"), F.try_divide(F.count_if(F.col("ks_p") < alpha), F.count(F.lit(1))).alias("ks_failing_share")),
        perf.agg(F.min("recall").alias("min_recall"), F.max("fn_rate").alias("max_fn_rate"), F.max(drop).alias("max_pr_auc_drop")),
    ]
    one = parts[0]
    for x in parts[1:]:
        one = one.unionByName(x, allowMissingColumns=True)
    one = one.agg(*[F.max(c).alias(c) for c in one.columns])
    flags = {
        "mean_shift": F.col("mean_drift_features") > 0,
        "no_data": F.col("no_data_features") > 0,
        "psi": F.col("max_psi") > psi_limit,
        "ks": F.col("ks_failing_share") > ks_share,
        "recall": F.col("min_recall") < recall_floor,
        "fn_rate": F.col("max_fn_rate") - fn_baseline > fn_rise,
        "pr_auc": F.col("max_pr_auc_drop") > pr_drop,
    }
    if model_age_days is not None:
        flags["age"] = F.lit(model_age_days > max_age_days)
    out = one.withColumns({f"trigger_{k_}": F.coalesce(v, F.lit(False)) for k_, v in flags.items()})
    reasons = F.array(*[F.when(F.col(f"trigger_{k_}"), F.lit(k_)) for k_ in flags])
    out = out.withColumn("reasons", F.array_join(F.filter(reasons, lambda x: x.isNotNull()), ","))
    return out.withColumn("retrain", F.col("reasons") != "")


def promotion_gate(ledger: DataFrame, new_run: str, prod_run: str, precision_floor: float = 0.0) -> DataFrame:
    """Promote when the new run's recall beats production and its
    precision stays at or above the floor (ledger self-join on key)."""
    m = ledger.where(F.col("kind") == "metric").select("run_id", "key", F.col("value").cast("double").alias("v"))
    n = m.where(F.col("run_id") == new_run).select("key", F.col("v").alias("new"))
    p = m.where(F.col("run_id") == prod_run).select("key", F.col("v").alias("prod"))
    j = n.join(p, "key")
    piv = j.groupBy().agg(
        F.max(F.when(F.col("key") == "recall_1", F.col("new"))).alias("new_recall"),
        F.max(F.when(F.col("key") == "recall_1", F.col("prod"))).alias("prod_recall"),
        F.max(F.when(F.col("key") == "precision_1", F.col("new"))).alias("new_precision"),
        F.max(F.when(F.col("key") == "precision_1", F.col("prod"))).alias("prod_precision"))
    return piv.withColumn("promote", F.coalesce((F.col("new_recall") > F.col("prod_recall"))
                                                & (F.col("new_precision") >= precision_floor), F.lit(False)))
