"""Catalog: sources, sorts, cohorts and unions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltwatch.operators import reshape
from voltwatch.plans.registry import query, rounded
from voltwatch.sources import io
from voltwatch.sources.tables import events_telemetry, table

CUT = "2024-01-16 00:00:00"


@query("csv_roundtrip", "SELECT event_id, ts, user_id, event_type, round(value, 6) AS value, props FROM events")
def q_csv_roundtrip(spark, sf):
    """S4 then S1: write the table as CSV with a header, read it back with
    the declared schema (no inference), times as timestamp_ntz."""
    ev = table(spark, sf, "events")
    path = io.scratch_path(spark, "csv")
    io.write_processed(ev, path, fmt="csv", sort_within=["user_id", "ts", "event_id"])
    back = io.read_telemetry(spark, path, ev.schema, fmt="csv", time_col="ts")
    return rounded(back)


TURN = T.StructType([T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                     T.StructField("text", T.StringType())])
CONV_REQUEST = T.StructType([T.StructField("conv_id", T.LongType()),
                             T.StructField("readings", T.ArrayType(TURN))])


@query("nested_request_inline", "SELECT conv_id, turn, role, text FROM conversations")
def q_nested_request_inline(spark, sf):
    """Conversations written as nested JSON requests (one document per
    conversation, its turns as an array), read back with an explicit schema
    and flattened with ``inline``."""
    conv = table(spark, sf, "conversations")
    nested = conv.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("readings"))
    path = io.scratch_path(spark, "requests")
    nested.write.json(path)
    return io.read_requests(spark, path, CONV_REQUEST, keep=["conv_id"], multi_line=False)


@query("two_cohorts", """
WITH f AS (SELECT user_id AS u FROM events WHERE event_type = 'error' ORDER BY ts, user_id LIMIT 1),
o AS (SELECT user_id AS u FROM events WHERE user_id <> (SELECT u FROM f) ORDER BY ts, user_id LIMIT 1)
SELECT event_id, user_id, ts, CASE WHEN user_id = (SELECT u FROM f) THEN 'failing' ELSE 'normal' END AS cohort
FROM events WHERE user_id = (SELECT u FROM f) OR user_id = (SELECT u FROM o)""")
def q_two_cohorts(spark, sf):
    """The first entity (by time, entity) that shows the label and the
    first other entity, as two cohorts.  min_by over the order key is one
    aggregate; only the two ids reach the driver."""
    ev = events_telemetry(spark, sf)
    key = F.struct("ts", "user_id")
    failing = ev.where(F.col("label") == 1).agg(F.min_by("user_id", key)).first()[0]
    other = ev.where(F.col("user_id") != failing).agg(F.min_by("user_id", key)).first()[0]
    out = ev.where(F.col("user_id").isin(failing, other))
    return out.select("event_id", "user_id", "ts",
                      F.when(F.col("user_id") == failing, "failing").otherwise("normal").alias("cohort"))


HEAD_N = 5


@query("head_tail", f"""
(SELECT 'head' AS part, event_id, ts, user_id FROM events ORDER BY ts, event_id LIMIT {HEAD_N})
UNION ALL
(SELECT 'tail' AS part, event_id, ts, user_id FROM events ORDER BY ts DESC, event_id DESC LIMIT {HEAD_N})""")
def q_head_tail(spark, sf):
    """O1/O2: first and last n rows in (time, tie) order (top-k per
    partition, then a merge of k rows per task)."""
    ev = table(spark, sf, "events").select("event_id", "ts", "user_id")
    head = ev.orderBy("ts", "event_id").limit(HEAD_N).withColumn("part", F.lit("head"))
    tail = ev.orderBy(F.desc("ts"), F.desc("event_id")).limit(HEAD_N).withColumn("part", F.lit("tail"))
    return head.unionByName(tail)


@query("history_plus_new", f"""
SELECT event_id, ts, user_id, value, NULL::DOUBLE AS k FROM events WHERE ts < TIMESTAMP '{CUT}'
UNION ALL
SELECT event_id, ts, user_id, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
FROM events WHERE ts >= TIMESTAMP '{CUT}'""")
def q_history_plus_new(spark, sf):
    """History plus newly arrived data with an extra column, matched by
    name; the missing column is NULL in the history rows."""
    ev = events_telemetry(spark, sf, with_nulls=False)
    cut = F.lit(CUT).cast("timestamp_ntz")
    hist = ev.where(F.col("ts") < cut).select("event_id", "ts", "user_id", "value")
    new = ev.where(F.col("ts") >= cut).select("event_id", "ts", "user_id", "value", "k")
    return rounded(reshape.combine(hist, new))


@query("rescue_requests", """
WITH t AS (SELECT CASE WHEN event_id % 13 = 0 OR event_id % 17 = 0 THEN 'malformed' WHEN value > 150 THEN 'value_range' ELSE 'valid' END AS reason,
                  value, event_id % 13 = 0 OR event_id % 17 = 0 AS broken FROM events)
SELECT reason, CAST(count(*) AS BIGINT) AS rows, CAST(count(*) FILTER (WHERE broken) AS BIGINT) AS texts,
       round(sum(CASE WHEN broken THEN 0 ELSE value END), 4) AS total
FROM t GROUP BY reason""")
def q_rescue_requests(spark, sf):
    """Events as JSON lines, every 13th cut off and every 17th with a word for a number, read back with rescue."""
    ev = table(spark, sf, "events")
    line = F.to_json(F.struct("event_id", "user_id", "value"))
    words = F.regexp_replace(line, '"value":[^,}]*', '"value":"many"')
    line = F.when(F.col("event_id") % 13 == 0, F.substring(line, 1, 17)).when(F.col("event_id") % 17 == 0, words).otherwise(line)
    path = io.scratch_path(spark, "rescue")
    ev.select(line.alias("value")).write.text(path)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()), T.StructField("value", T.DoubleType())])
    valid, bad = io.read_rescued(spark, path, schema, "json", {"value_range": F.col("value") <= 150})
    both = valid.select(F.lit("valid").alias("reason"), F.lit(None).cast("string").alias("text"), "value").unionByName(
        bad.select(F.array_join("reasons", ",").alias("reason"), F.col(io.CORRUPT).alias("text"), "value"))
    total = F.sum(F.when(F.col("text").isNull(), F.col("value")).otherwise(0.0))
    out = both.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"), F.count("text").alias("texts"), F.round(total, 4).alias("total"))
    return out
