"""S2, S3, S5, S7, C1, C7 and the empty-input guard."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from voltwatch.config import Columns
from voltwatch.functions.columns import as_timestamp, clamp
from voltwatch.operators import validate
from voltwatch.plans.featureset import FeatureSpec, empty_guard, feature_pipeline
from voltwatch.sources import io

CFG = Columns(entity="e", time="t", tie="i")


def test_check_and_require_columns(spark):
    df = spark.createDataFrame([(1, 2.0)], "Module_ID int, Module_Voltage_V double")
    rep = validate.check_columns(df, io.EXPECTED_COLUMNS).first()
    assert rep["expected"] == 13 and "Timestamp" in rep["missing"] and "Module_ID" not in rep["missing"]
    with pytest.raises(ValueError, match="Hazard_Label"):
        validate.require_column(df, "Hazard_Label")


def test_text_time_and_telemetry_csv(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-01 00:00:10", "A_Module01", float("nan"))], "ts string, m string, v double")
    t = as_timestamp(df, "ts")
    assert t.schema["ts"].dataType.typeName() == "timestamp_ntz"
    assert as_timestamp(t, "ts") is t  # already a time: untouched
    rows = [(dt.datetime(2024, 1, 1, 0, 0, 10 * i), "RackA1_Module01", "RackA1", *[float(i)] * 9, 0) for i in range(3)]
    tele = spark.createDataFrame(rows, io.TELEMETRY_SCHEMA)
    path = str(tmp_path / "raw")
    io.write_processed(tele, path, fmt="csv")
    back = io.read_telemetry(spark, path, io.TELEMETRY_SCHEMA, fmt="csv")
    assert back.orderBy("Timestamp").collect() == tele.orderBy("Timestamp").collect()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        io.read_telemetry(spark, str(tmp_path / "absent"), fmt="csv").count()


def test_partitioned_sink(spark, tmp_path):
    df = spark.createDataFrame([(1, "s1", 1), (2, "s2", 1), (3, "s1", 2)], "x int, scenario string, run int")
    io.write_processed(df, str(tmp_path / "p"), partition_by=["scenario", "run"])
    back = spark.read.parquet(str(tmp_path / "p"))
    assert back.where("scenario = 's1' AND run = 2").count() == 1


def test_align_and_clamp(spark):
    df = spark.createDataFrame([(1, 2.0, None, "x")], "id int, a double, b double, s string")
    out = validate.align(df, ["b", "a"]).first()
    assert list(out.asDict()) == ["b", "a"] and out["b"] == 0.0
    with pytest.raises(ValueError, match="Missing features"):
        validate.align(df, ["a", "zz"])
    assert validate.align(df, None, exclude=["id"]).columns == ["a", "b"]
    r = df.select(clamp("a", 0, 1).alias("c"), clamp("b", 0, 1).alias("d")).first()
    assert r["c"] == 1 and r["d"] is None


def test_empty_input_gives_empty_output(spark):
    df = spark.createDataFrame([], "e string, t timestamp_ntz, i long, x double")
    spec = FeatureSpec(fill=("x",), clip=("x",), delta=("x",), rolling=("x",), windows=(3,))
    out = empty_guard(df, feature_pipeline, CFG, spec)
    assert out.count() == 0 and "Rolling_std_3_x" in out.columns


def test_csv_by_name(spark, tmp_path):
    from pyspark.sql import types as T
    from voltwatch.sources import io
    (tmp_path / "x.csv").write_text("b,extra,a\n2.0,z,1.0\n")
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in "abc"])
    row = io.read_telemetry(spark, str(tmp_path / "x.csv"), schema, "csv").first()
    assert row.asDict() == {"a": 1.0, "b": 2.0, "c": None}
