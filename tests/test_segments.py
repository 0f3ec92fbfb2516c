"""Hot-entity segmentation must not change any result: force tiny segments
and compare with the plain per-entity window."""

import pandas as pd
from pyspark.sql import functions as F
import pytest

from conftest import SF001
from voltwatch.config import Columns, Scale
from voltwatch.operators import clean, features
from voltwatch.plans.featureset import FeatureSpec, feature_pipeline
from voltwatch.plans.layout import plan_layout
from voltwatch.sources.tables import EVENTS, events_telemetry

HOT = Scale(hot_entity_rows=24, broadcast_rows=1_000_000)
GLOBAL = EVENTS.with_(entity=None)
GHOT = Scale(hot_entity_rows=300)


def frame(df):
    pdf = df.toPandas()
    return pdf.sort_values("event_id").reset_index(drop=True).round(9)


def same(a, b):
    pd.testing.assert_frame_equal(frame(a), frame(b)[frame(a).columns.tolist()], check_dtype=False)


@pytest.fixture(scope="module")
def ev(spark):
    return events_telemetry(spark, SF001).cache()


def test_layout_is_segmented(ev):
    lay = plan_layout(ev, EVENTS, HOT)
    assert lay.segmented and lay.n_segments > 15
    seg = lay.assign(ev).groupBy(EVENTS.entity, "_vw_seg").count().toPandas()
    assert seg["count"].min() >= 8  # segments stay well above the halo sizes used here


@pytest.mark.parametrize("method", ["ffill", "mean", "median"])
def test_fill_hot_equals_plain(ev, method):
    same(clean.impute(ev, EVENTS, ["value", "k"], method),
         clean.impute(ev, EVENTS, ["value", "k"], method, scale=HOT))


def test_global_ffill_segmented(ev):
    lay = plan_layout(ev, GLOBAL, GHOT)
    assert lay.segmented and len(lay.global_cuts) >= 3
    same(clean.impute(ev, GLOBAL, ["value"], "ffill", scale=Scale(hot_entity_rows=10**9)),
         clean.impute(ev, GLOBAL, ["value"], "ffill", scale=GHOT))


def test_clip_hot_equals_plain(ev):
    same(clean.clip_quantiles(ev, EVENTS, ["value", "k"]),
         clean.clip_quantiles(ev, EVENTS, ["value", "k"], scale=HOT))


def test_delta_rolling_onsets_hot(ev):
    a = features.rolling(features.delta(ev, EVENTS, ["value", "k"], 3), EVENTS, ["value", "k"], (2, 6), ("mean", "std", "max"))
    b = features.rolling(features.delta(ev, EVENTS, ["value", "k"], 3, scale=HOT), EVENTS, ["value", "k"], (2, 6),
                         ("mean", "std", "max"), scale=HOT)
    same(a, b)
    same(features.onsets(ev, EVENTS), features.onsets(ev, EVENTS, scale=HOT))


def test_global_rolling_segmented(ev):
    big = Scale(hot_entity_rows=10**9)
    same(features.rolling(ev, GLOBAL, ["k"], (6,), ("mean", "std"), scale=big),
         features.rolling(ev, GLOBAL, ["k"], (6,), ("mean", "std"), scale=GHOT))


def test_feature_pipeline_hot(ev):
    spec = FeatureSpec(fill=("value", "k"), clip=("value", "k"), delta=("value",), rolling=("value", "k"),
                       windows=(3, 6), stats=("mean", "std"))
    same(feature_pipeline(ev, EVENTS, spec), feature_pipeline(ev, EVENTS, spec, scale=HOT))


def test_frame_longer_than_a_segment(ev):
    same(features.rolling(ev, EVENTS, ["k"], (60,), ("mean",)),
         features.rolling(ev, EVENTS, ["k"], (60,), ("mean",), scale=HOT))


def test_tied_times_and_null_entity(ev):
    """Few distinct times (short and long segments) and a hot NULL entity."""
    odd = ev.withColumns({
        "user_id": F.when(F.col("user_id") % 3 > 0, F.col("user_id") % 2),
        "ts": F.date_trunc("day", F.col("ts")).cast("timestamp_ntz"),
    })
    for scale in (Scale(hot_entity_rows=40), Scale(hot_entity_rows=7)):
        same(features.rolling(odd, EVENTS, ["k"], (60, 5), ("sum",)),
             features.rolling(odd, EVENTS, ["k"], (60, 5), ("sum",), scale=scale))
        same(clean.impute(odd, EVENTS, ["value"], "mean"), clean.impute(odd, EVENTS, ["value"], "mean", scale=scale))
        same(clean.impute(odd, EVENTS, ["value"], "ffill"),
             clean.impute(odd, EVENTS, ["value"], "ffill", scale=scale))
        same(clean.clip_quantiles(odd, EVENTS, ["value"]), clean.clip_quantiles(odd, EVENTS, ["value"], scale=scale))


def test_many_cuts_are_planned(spark):
    from voltwatch.plans.layout import _bisect
    cuts = F.array(*[F.lit(i) for i in range(2000)])
    got = spark.range(-1, 2002).select("id", _bisect(cuts, F.col("id"), 2000).alias("n"))
    assert got.where(F.least(F.greatest(F.col("id") + 1, F.lit(0)), F.lit(2000)) != F.col("n")).count() == 0


def test_running_based_operators_hot(ev):
    from voltwatch.operators import labels
    v = F.col("value")
    tiers = [("PreRunaway", v > 300), ("Degrading", v > 150)]
    same(labels.severity(ev, EVENTS, ("Runaway", v >= 400), tiers),
         labels.severity(ev, EVENTS, ("Runaway", v >= 400), tiers, scale=HOT))
    same(labels.inject_ramp(ev, EVENTS, 7, 3, 12, {"value": (10.0, 60.0, 2, None, None)}),
         labels.inject_ramp(ev, EVENTS, 7, 3, 12, {"value": (10.0, 60.0, 2, None, None)}, scale=HOT))
    same(labels.rate_per_second(ev, EVENTS, "k"), labels.rate_per_second(ev, EVENTS, "k", scale=HOT))


def test_curve_and_ks_segmented(spark, ev):
    from voltwatch.operators import drift, metrics
    tiny = Scale(hot_entity_rows=40)
    d = ev.where(F.col("value").isNotNull())
    a = metrics.ranking_metrics(d, "value", "label").first()
    b = metrics.ranking_metrics(d, "value", "label", tiny).first()
    assert a["roc_auc"] == pytest.approx(b["roc_auc"], abs=1e-12) and a["pr_auc"] == pytest.approx(b["pr_auc"], abs=1e-12)
    half = F.col("event_id") < 500
    x = {r["feature"]: r["ks_stat"] for r in drift.drift_ks(d.where(half), d.where(~half), ["value", "k"]).collect()}
    y = {r["feature"]: r["ks_stat"] for r in drift.drift_ks(d.where(half), d.where(~half), ["value", "k"], tiny).collect()}
    assert x == pytest.approx(y)


def test_segments_are_small_once_a_series_is_cut(spark):
    """A segment has about ``segment_rows`` rows, however many a series may have before it is cut."""
    d = spark.range(4000).select((F.col("id") * 7919 % 4001).alias("t"), F.col("id").alias("i"), F.lit("A").alias("e"))
    for entity in (None, "e"):
        lay = plan_layout(d, Columns(entity=entity, time="t", tie="i"), Scale(hot_entity_rows=2000, segment_rows=200))
        sizes = [r["count"] for r in lay.assign(d).groupBy("_vw_seg").count().collect()]
        assert len(sizes) >= 15 and max(sizes) <= 500
