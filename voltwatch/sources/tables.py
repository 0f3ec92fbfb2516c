"""Driver test tables mapped onto telemetry roles.

events  -> entity user_id, time ts, tie event_id, sensors value and k,
           label event_type = 'error'.  ``value`` gets NULLs by a fixed rule
           (event_id % 17 = 0) so that the fill operators have work to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltwatch.config import Columns

EVENTS = Columns(entity="user_id", time="ts", tie="event_id", sensors=("value", "k"), label="label")

# Fixed rule for injected NULLs in events.value (same in every oracle).
NULL_EVERY = 17


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_telemetry(spark: SparkSession, sf_dir: str, with_nulls: bool = True) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    value = F.col("value")
    if with_nulls:
        value = F.when(F.col("event_id") % NULL_EVERY == 0, F.lit(None).cast("double")).otherwise(value)
    return ev.select(
        "event_id", "ts", "user_id", "event_type",
        value.alias("value"),
        F.get_json_object("props", "$.k").cast("double").alias("k"),
        (F.col("event_type") == "error").cast("int").alias("label"),
    )


# The same view in DuckDB SQL, for oracles.
EVENTS_SQL = f"""tele AS (
  SELECT event_id, ts, user_id, event_type,
         CASE WHEN event_id % {NULL_EVERY} = 0 THEN NULL ELSE value END AS value,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
         CAST(event_type = 'error' AS INTEGER) AS label
  FROM events)"""
