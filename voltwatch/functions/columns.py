"""Scalar column builders (C1, C4, C5, C8-C13, C15, C16 and helpers)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
           T.DoubleType, T.DecimalType)


def present(df: DataFrame, cols) -> list[str]:
    """Keep only the columns that exist, in the given order."""
    have = set(df.columns)
    return [c for c in cols if c in have]


def numeric_present(df: DataFrame, cols) -> list[str]:
    """Columns that exist and are numeric (W6 skips the others)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return [c for c in cols if c in types and isinstance(types[c], NUMERIC)]


def nan_to_null(c: str | Column, dtype=None) -> Column:
    """pandas has one missing marker (NaN); Spark keeps NULL and NaN apart.
    Turn NaN into NULL so fills, averages and percentiles agree."""
    col = F.col(c) if isinstance(c, str) else c
    if dtype is not None and not isinstance(dtype, (T.DoubleType, T.FloatType)):
        return col
    return F.when(F.isnan(col), F.lit(None)).otherwise(col)


def as_timestamp(df: DataFrame, c: str, fmt: str | None = None) -> DataFrame:
    """Cast text to timestamp_ntz only when it is not already a time."""
    dt = df.schema[c].dataType
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return df
    expr = F.to_timestamp_ntz(F.col(c), F.lit(fmt)) if fmt else F.to_timestamp_ntz(F.col(c))
    return df.withColumn(c, expr)


def parent_key(c: str | Column, sep: str = "_") -> Column:
    """Text before the first separator (rack from module id)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.split_part(col, F.lit(sep), F.lit(1))


def ordinal_key(c: str | Column, pattern: str = r"_Module(\d+)$") -> Column:
    """Integer captured by ``pattern``; NULL when it does not parse."""
    col = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.regexp_extract(col, pattern, 1), F.lit("")).try_cast("int")


def format_id(parent: Column, ordinal: Column, fmt: str = "%s_Module%02d") -> Column:
    """Build an entity id from parent and ordinal."""
    return F.format_string(fmt, parent, ordinal)


def label_text(c: str | Column, positive: str = "Hazardous", negative: str = "Normal") -> Column:
    """C11: 1 -> positive text, anything else -> negative text."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col == 1, F.lit(positive)).otherwise(F.lit(negative))


def clamp(c: str | Column, lo=None, hi=None) -> Column:
    """Bound a value; NULL stays NULL (greatest/least would skip it)."""
    col = F.col(c) if isinstance(c, str) else c
    out = col
    if lo is not None:
        out = F.greatest(out, lo if isinstance(lo, Column) else F.lit(lo))
    if hi is not None:
        out = F.least(out, hi if isinstance(hi, Column) else F.lit(hi))
    return F.when(col.isNull(), F.lit(None).cast("double")).otherwise(out)


def uniform(seed: int | str, *parts: str | Column) -> Column:
    """Repeatable uniform in [0, 1) from md5('seed:part:...'); the same value
    in any engine with md5 (never rand(), which changes with partitioning)."""
    cols = [F.lit(str(seed))] + [F.col(p).cast("string") if isinstance(p, str) else p.cast("string")
                                 for p in parts]
    h = F.md5(F.concat_ws(":", *cols))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def prediction_typing(pred: Column, prob: Column | None, entity: Column | None) -> list[Column]:
    """Int label, optional double probability, 'Unknown' id."""
    out = [
        F.coalesce(entity, F.lit("Unknown")).alias("entity_id") if entity is not None
        else F.lit("Unknown").alias("entity_id"),
        pred.cast("int").alias("prediction"),
    ]
    out.append((prob.cast("double") if prob is not None else F.lit(None).cast("double")).alias("probability"))
    return out
