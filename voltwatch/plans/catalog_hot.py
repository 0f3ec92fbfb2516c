"""Catalog: layout queries with the split of hot entities forced by a small
``hot_entity_rows``, under the oracles of the plain queries: the strategy must
never change a result."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltwatch.config import Scale
from voltwatch.operators import clean, drift, features, labels, metrics, ml
from voltwatch.plans.catalog_features import FEATURE_SPEC, GLOBAL
from voltwatch.plans.catalog_models import DRIFT_COLS, _halves
from voltwatch.plans.catalog_profiles import _scored
from voltwatch.plans.featureset import feature_pipeline
from voltwatch.plans.layout import plan_layout
from voltwatch.plans.registry import ORACLES, query, rounded
from voltwatch.sources.tables import EVENTS, events_telemetry

ENTITY_HOT = Scale(hot_entity_rows=40)  # most users of events are above it
TABLE_HOT = Scale(hot_entity_rows=1000)  # for series over a whole table or class


@query("telemetry_features_split", ORACLES["telemetry_features"])
def q_telemetry_features_split(spark, sf):
    d = events_telemetry(spark, sf).drop("event_type")
    return rounded(feature_pipeline(d, EVENTS, FEATURE_SPEC, scale=ENTITY_HOT))


@query("fill_global_ffill_split", ORACLES["fill_global_ffill"])
def q_fill_global_ffill_split(spark, sf):
    d = clean.impute(events_telemetry(spark, sf), GLOBAL, ["value"], "ffill", scale=TABLE_HOT)
    return rounded(d.select("event_id", "user_id", "ts", "value"))


@query("rolling_global_split", ORACLES["rolling_global"])
def q_rolling_global_split(spark, sf):
    d = events_telemetry(spark, sf)
    lay = plan_layout(d, GLOBAL, TABLE_HOT)
    d = features.rolling(d, GLOBAL, ["k"], (6,), ("mean", "std"), layout=lay)
    d = features.delta(d, GLOBAL, ["k"], 1, layout=lay)
    return rounded(d.select("event_id", "user_id", "ts", "Rolling_mean_6_k", "Rolling_std_6_k", "Delta_1_k"))


@query("severity_tier_split", ORACLES["severity_tier"])
def q_severity_tier_split(spark, sf):
    v = F.col("value")
    out = labels.severity(events_telemetry(spark, sf, with_nulls=False), EVENTS, ("Runaway", v >= 450),
                          [("PreRunaway", v > 300), ("Degrading", v > 150)], scale=ENTITY_HOT)
    return out.select("event_id", "user_id", "ts", "health_status")


@query("drift_ks_split", ORACLES["drift_ks"])
def q_drift_ks_split(spark, sf):
    ref, cur = _halves(spark, sf)
    return rounded(drift.drift_ks(ref, cur, DRIFT_COLS, scale=TABLE_HOT))


@query("ranking_metrics_split", ORACLES["ranking_metrics"])
def q_ranking_metrics_split(spark, sf):
    return rounded(metrics.ranking_metrics(_scored(spark, sf), "value", "label", scale=TABLE_HOT))


@query("stratified_split_split", ORACLES["stratified_split"])
def q_stratified_split_split(spark, sf):
    d = ml.stratified_split(events_telemetry(spark, sf), "label", "event_id", scale=TABLE_HOT)
    return rounded(d.select("event_id", "label", "is_test"))
