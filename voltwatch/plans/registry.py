"""Query registry shared by the catalog modules.

Each entry is ``name -> (spark, sf_dir) -> DataFrame`` and, where the
operator is expressible in SQL, an independent DuckDB oracle in
``ORACLES``.  Doubles are rounded to 6 digits on both sides (rolling means to
9), counts are bigint; column names match one to one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


def rolling_digits(stat: str) -> int:
    """Digits a rolling statistic is rounded to.

    Readings have 2 decimals and interpolated clip bounds 4, so the mean of up
    to 60 of them ends within 9 decimals or never ends: at 9 digits no exact
    tie is left that two summation orders could round to different sides.
    """
    return 9 if stat == "mean" else 6


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles for comparison; cast integral and boolean to bigint."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            n = rolling_digits("mean") if f.name.startswith("Rolling_mean_") else digits
            out.append(F.round(F.col(f.name).cast("double"), n).alias(f.name))
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType, T.BooleanType)):
            out.append(F.col(f.name).cast("long").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
