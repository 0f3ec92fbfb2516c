"""Reshaping and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltwatch.config import Columns


def melt(df: DataFrame, ids, values, var: str = "Feature", val: str = "Value") -> DataFrame:
    """Wide -> long (ids, Feature, Value); values cast to double."""
    d = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in values])
    return d.unpivot(list(ids), list(values), var, val)


def results_table(ledger: DataFrame, run_col: str = "run_id", key_col: str = "key",
                  value_col: str = "value", keys=None) -> DataFrame:
    """R2: long run ledger -> one row per run, one column per key."""
    g = ledger.groupBy(run_col)
    g = g.pivot(key_col, list(keys)) if keys else g.pivot(key_col)
    return g.agg(F.first(value_col))


def time_grid(df: DataFrame, cfg: Columns, step: str, start=None, end=None) -> DataFrame:
    """Every entity at every step between its first and last bucket;
    ``rows`` = readings in the bucket (0 marks a gap).

    The grid is built per entity from its own span (``explode(sequence)``),
    not by crossing all entities with all steps, and joined to the bucketed
    counts on (entity, bucket).
    """
    e, t = cfg.entity, cfg.time
    secs = _seconds(step)
    b = df.select(e, bucket_start(F.col(t), secs, df.schema[t].dataType).alias("bucket"))
    counts = b.groupBy(e, "bucket").agg(F.count(F.lit(1)).alias("rows"))
    span = counts.groupBy(e).agg(F.min("bucket").alias("lo"), F.max("bucket").alias("hi"))
    if start is not None:
        span = span.withColumn("lo", F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        span = span.withColumn("hi", F.lit(end).cast("timestamp_ntz"))
    grid = span.select(e, F.explode(F.sequence("lo", "hi", F.expr(f"INTERVAL {secs} SECONDS"))).alias("bucket"))
    out = grid.join(counts, [e, "bucket"], "left").withColumn("rows", F.coalesce("rows", F.lit(0)).cast("long"))
    return out


def bucket_start(t, secs: int, dtype):
    """Start of the fixed-width bucket holding ``t``, computed on the
    wall clock (no time zone is applied to a zone-less timestamp)."""
    kind = "TIMESTAMP_NTZ" if dtype.typeName() == "timestamp_ntz" else "TIMESTAMP"
    epoch = F.expr(f"{kind}'1970-01-01 00:00:00'")
    s = F.timestamp_diff("SECOND", epoch, t)
    return F.timestamp_add("SECOND", F.floor(s / secs) * secs, epoch)


def _seconds(step: str) -> int:
    n, unit = step.split()
    mult = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600,
            "day": 86400, "days": 86400}[unit]
    return int(n) * mult


def neighbour_exposure(df: DataFrame, parent: str, ordinal: str, time: str, hot_col: str,
                       contribution: float = 200.0, distance: int = 1) -> DataFrame:
    """For every (parent, time, ordinal) row, the sum of ``contribution``
    over rows of the same parent and time whose ordinal differs by exactly
    ``distance`` and which are hot.

    An equi-join on (parent, time, ordinal +/- distance): the hot rows are
    shifted to the ordinals they heat, so no pairs are enumerated and no
    nested loop runs.
    """
    hot = df.where(F.col(hot_col)).select(parent, time, ordinal)
    shifted = hot.select(parent, time, F.inline(F.array(
        F.struct((F.col(ordinal) - distance).alias(ordinal)),
        F.struct((F.col(ordinal) + distance).alias(ordinal)))))
    heat = shifted.groupBy(parent, time, ordinal).agg((F.count(F.lit(1)) * contribution).alias("exposure"))
    out = df.join(heat, [parent, time, ordinal], "left")
    return out.withColumn("exposure", F.coalesce("exposure", F.lit(0.0)).cast("double"))


def combine(history: DataFrame, new: DataFrame) -> DataFrame:
    """History + new data, columns matched by name, missing ones NULL."""
    return history.unionByName(new, allowMissingColumns=True)
