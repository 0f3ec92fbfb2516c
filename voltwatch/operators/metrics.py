"""Class weights and model metrics as plain DataFrame aggregates
(A11-A17, M6, M12).  No evaluator and no collect of scores: ROC and PR
areas come from running sums over distinct scores, computed with the
segmented running-sum primitive so a billion distinct scores never meet in
one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltwatch.config import DEFAULT_SCALE, Columns, Scale
from voltwatch.plans.layout import running, small_side


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Negatives, positives and the positive weight neg/pos (1 when
    there is no positive)."""
    y = F.col(label)
    return df.agg(F.count_if(y == 0).cast("long").alias("n_neg"),
                  F.count_if(y == 1).cast("long").alias("n_pos")).withColumn(
        "positive_weight",
        F.when(F.col("n_pos") == 0, F.lit(1.0)).otherwise(F.col("n_neg") / F.col("n_pos")))


def class_weight_table(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n / (k * n_c) per class."""
    from pyspark.sql import Window
    g = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    allw = Window.partitionBy()
    return g.withColumn("weight", F.sum("n").over(allw) / (F.count(F.lit(1)).over(allw) * F.col("n")))


def with_weights(df: DataFrame, label: str, mode: str = "balanced", out: str = "weight") -> DataFrame:
    """M6: add a per-row weight column.

    balanced  n / (k * n_c) (class_weight='balanced')
    positive  neg/pos for the positive class, 1 otherwise (scale_pos_weight)
    The class table has one row per label value (NULL is one) and is joined,
    broadcast if its counted size allows, so the rows are then not shuffled.
    """
    if mode == "balanced":
        w = class_weight_table(df, label).select(F.col(label).alias("_vw_lab"), F.col("weight").alias(out))
        w = small_side(w, DEFAULT_SCALE.broadcast_rows)
        return df.join(w, F.col(label).eqNullSafe(F.col("_vw_lab")), "left").drop("_vw_lab")
    if mode == "positive":
        r = class_counts(df, label).first()
        return df.withColumn(out, F.when(F.col(label) == 1, F.lit(float(r["positive_weight"]))).otherwise(1.0))
    raise ValueError(f"unknown weight mode: {mode}")


def confusion(df: DataFrame, label: str, pred: str, by=()) -> DataFrame:
    """Tn, fp, fn, tp (binary, label and prediction in {0, 1}) and the
    labelled rows without a prediction."""
    y, p = F.col(label), F.col(pred)
    aggs = [F.count_if((y == 0) & (p == 0)).cast("long").alias("tn"),
            F.count_if((y == 0) & (p == 1)).cast("long").alias("fp"),
            F.count_if((y == 1) & (p == 0)).cast("long").alias("fn"),
            F.count_if((y == 1) & (p == 1)).cast("long").alias("tp"),
            F.count_if(y.isNotNull() & p.isNull()).cast("long").alias("not_scored")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def _div(a: Column, b: Column) -> Column:
    """Zero division gives 0 (as the reference's report does)."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def report_from_confusion(cm: DataFrame, by=()) -> DataFrame:
    """Precision, recall, F1, support per class, macro and weighted
    averages and accuracy, from a confusion row."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    p1, r1 = _div(tp, tp + fp), _div(tp, tp + fn)
    p0, r0 = _div(tn, tn + fn), _div(tn, tn + fp)
    f1 = _div(2 * p1 * r1, p1 + r1)
    f0 = _div(2 * p0 * r0, p0 + r0)
    s1, s0 = tp + fn, tn + fp
    acc = _div(tp + tn, n)

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("class"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.cast("double").alias("f1"),
                        s.cast("long").alias("support"))

    rows = F.array(
        row("0", p0, r0, f0, s0), row("1", p1, r1, f1, s1),
        row("accuracy", acc, acc, acc, n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        row("weighted avg", _div(p0 * s0 + p1 * s1, n), _div(r0 * s0 + r1 * s1, n),
            _div(f0 * s0 + f1 * s1, n), n),
    )
    return cm.select(*by, F.inline(rows))


def report(df: DataFrame, label: str, pred: str, by=()) -> DataFrame:
    return report_from_confusion(confusion(df, label, pred, by), by)


def _curve(df: DataFrame, score: str, label: str, scale: Scale, by: str | None = None) -> DataFrame:
    """Distinct scores (of each ``by`` key), descending, with running tp and fp."""
    keys = [by] if by else []
    g = df.where(F.col(score).isNotNull()).groupBy(*keys, score).agg(
        F.count_if(F.col(label) == 1).cast("long").alias("pos"),
        F.count_if(F.col(label) != 1).cast("long").alias("neg"),
    ).withColumn("_vw_neg_score", -F.col(score).cast("double"))
    cfg = Columns(entity=by, time="_vw_neg_score")
    return running(g, cfg, {"tp": F.col("pos"), "fp": F.col("neg")}, scale=scale)


def ranking_metrics(df: DataFrame, score: str, label: str, scale: Scale = DEFAULT_SCALE,
                    by: str | None = None) -> DataFrame:
    """A16 ROC-AUC and A17 PR-AUC (trapezoid, PR curve starting at recall 0,
    precision 1).  NULL when only one class is present.  With ``by`` one row
    per value of that column; a value with very many scores is cut into
    segments like a hot entity."""
    c = _curve(df, score, label, scale, by)
    tp_prev = F.col("tp") - F.col("pos")
    fp_prev = F.col("fp") - F.col("neg")
    prec = F.col("tp") / (F.col("tp") + F.col("fp"))
    prec_prev = F.when(tp_prev + fp_prev == 0, F.lit(1.0)).otherwise(tp_prev / (tp_prev + fp_prev))
    keys = [by] if by else []
    agg = c.groupBy(*keys).agg(
        F.sum(F.col("neg") * (2 * F.col("tp") - F.col("pos")) / 2.0).alias("_roc"),
        F.sum(F.col("pos") * (prec + prec_prev) / 2.0).alias("_pr"),
        F.sum("pos").alias("_p"), F.sum("neg").alias("_n"),
    )
    ok = (F.col("_p") > 0) & (F.col("_n") > 0)
    return agg.select(
        *keys,
        F.when(ok, F.col("_roc") / (F.col("_p") * F.col("_n"))).alias("roc_auc"),
        F.when(ok, F.col("_pr") / F.col("_p")).alias("pr_auc"),
    )


def evaluate(df: DataFrame, label: str, pred: str, score: str | None = None,
             scale: Scale = DEFAULT_SCALE) -> DataFrame:
    """The evaluation suite in long form (metric, value): confusion
    counts, accuracy, class-1 and macro precision/recall/F1, ROC-AUC and PR-AUC.
    Long form unions the single-row aggregates instead of joining them."""
    cm = confusion(df, label, pred)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    p1, r1 = _div(tp, tp + fp), _div(tp, tp + fn)
    p0, r0 = _div(tn, tn + fn), _div(tn, tn + fp)
    f1, f0 = _div(2 * p1 * r1, p1 + r1), _div(2 * p0 * r0, p0 + r0)
    vals = {"tn": tn, "fp": fp, "fn": fn, "tp": tp, "accuracy": _div(tp + tn, tn + fp + fn + tp),
            "precision_1": p1, "recall_1": r1, "f1_1": f1, "not_scored": F.col("not_scored"),
            "precision_macro": (p0 + p1) / 2, "recall_macro": (r0 + r1) / 2, "f1_macro": (f0 + f1) / 2}
    out = cm.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("metric"), v.cast("double").alias("value")) for k, v in vals.items()])))
    if score is not None:
        rk = ranking_metrics(df, score, label, scale)
        out = out.unionByName(rk.select(F.inline(F.array(
            F.struct(F.lit("roc_auc").alias("metric"), F.col("roc_auc").alias("value")),
            F.struct(F.lit("pr_auc").alias("metric"), F.col("pr_auc").alias("value"))))))
    return out
