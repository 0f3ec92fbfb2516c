"""Row validation and feature alignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltwatch.functions.columns import NUMERIC


def failed_rules(rules: dict[str, Column]) -> Column:
    """Names of the rules a row breaks (a NULL outcome counts as broken)."""
    checks = [F.when(~F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules.items()]
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def validate(df: DataFrame, rules: dict[str, Column], reasons: str = "reasons"):
    """C14: split into (valid, quarantine); quarantine rows carry the list of
    broken rules.  Both come from one tagged frame (one scan when cached or
    written with ``foreachBatch``)."""
    tagged = df.withColumn(reasons, failed_rules(rules))
    valid = tagged.where(F.size(reasons) == 0).drop(reasons)
    quarantine = tagged.where(F.size(reasons) > 0)
    return valid, quarantine


def well_formed(corrupt: str) -> dict[str, Column]:
    """Rule of a read with a corrupt-record column: the record could be parsed."""
    return {"malformed": F.col(corrupt).isNull()}


def required_doubles(cols, ranges: dict | None = None) -> dict[str, Column]:
    """Rules of the scoring request: every feature present and finite,
    plus closed ranges (e.g. 0 <= SoC <= 100)."""
    rules = {f"{c}_required": F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in cols}
    for c, (lo, hi) in (ranges or {}).items():
        rules[f"{c}_range"] = F.col(c).between(lo, hi)
    return rules


def select_numeric(df: DataFrame, exclude=()) -> list[str]:
    """Numeric columns that are not excluded (ids, time, target)."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in ex]


def align(df: DataFrame, features: list[str] | None, fill: float | None = 0.0, exclude=(),
          keep=()) -> DataFrame:
    """Reorder to the trained feature list; name the missing ones in the
    error.  Without a list, fall back to all numeric columns minus
    ``exclude``.  Remaining NULLs become ``fill``."""
    if features is None:
        features = select_numeric(df, exclude)
    missing = [c for c in features if c not in df.columns]
    if missing:
        raise ValueError(f"Missing features: {missing}")
    out = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in features])
    return out.fillna(fill, subset=list(features)) if fill is not None else out


def check_columns(df: DataFrame, expected) -> DataFrame:
    """One row listing expected columns that are absent (warn only)."""
    missing = [c for c in expected if c not in df.columns]
    return df.sparkSession.createDataFrame(
        [(len(expected), missing)], T.StructType([
            T.StructField("expected", T.IntegerType()),
            T.StructField("missing", T.ArrayType(T.StringType()))]))


def require_column(df: DataFrame, name: str) -> DataFrame:
    """S3: the target must exist."""
    if name not in df.columns:
        raise ValueError(f"Target column '{name}' not found in data")
    return df
