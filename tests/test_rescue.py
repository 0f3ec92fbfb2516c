"""Malformed records: rows read = valid + quarantined, in batch and on a stream."""

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltwatch.operators import validate
from voltwatch.sources import io
from voltwatch.streaming import streams as S

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.TimestampNTZType()), T.StructField("x", T.DoubleType())])


def put(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_csv(spark, tmp_path):
    lines = ["id,t,x", "1,2024-01-01 00:00:00,1.5", "2,not a time,2.5", "3,2024-01-01 00:00:02,abc", "4,2024-01-01 00:00:03", "5,2024-01-01 00:00:04,9.0,extra", "6,2024-01-01 00:00:05,900.0", "7,2024-01-01 00:00:06,"]
    put(tmp_path / "csv", "a.csv", lines)
    valid, bad = io.read_rescued(spark, str(tmp_path / "csv"), SCHEMA, "csv", {"x_range": F.coalesce(F.col("x") < 100, F.lit(True))})
    assert sorted(r.id for r in valid.collect()) == [1, 7]
    got = {r[io.CORRUPT] or r.id: r.reasons for r in bad.collect()}
    assert got == {lines[2]: ["malformed"], lines[3]: ["malformed"], lines[4]: ["malformed"], lines[5]: ["malformed"], 6: ["x_range"]}
    assert valid.count() + bad.count() == len(lines) - 1 and valid.columns == ["id", "t", "x"]


def test_json_lines(spark, tmp_path):
    lines = ['{"id": 1, "x": 2.0}', '{"id": 2, "x": "two"}', '{"id": 3, "x": 1', "plain text", '{"id": 5, "x": null, "more": [1]}', "[]x", "[]", '[{"id": 9}]', "", "  "]
    put(tmp_path / "json", "a.json", lines)
    valid, bad = io.read_rescued(spark, str(tmp_path / "json"), SCHEMA, "json")
    assert sorted(r.id for r in valid.collect()) == [1, 5]
    assert sorted(r[io.CORRUPT] for r in bad.collect()) == sorted([lines[1], lines[2], lines[3], *lines[5:8]])
    assert {tuple(r.reasons) for r in bad.collect()} == {("malformed",)}
    put(tmp_path / "none", "a.json", [""])
    assert [x.count() for x in io.read_rescued(spark, str(tmp_path / "none"), SCHEMA)] == [0, 0]


def test_stream_quarantine(spark, tmp_path):
    """The same rule in the scoring stream's quarantine."""
    from voltwatch.operators import ml

    d = spark.createDataFrame([(i, float(i % 10), int(i % 10 > 4)) for i in range(100)], "id long, x double, y int")
    model = ml.train(d, ["x"], "y", "lr")
    for k in range(2):
        put(tmp_path / "in", f"{k}.json", [f'{{"id": {10 * k + i}, "x": {i}.0}}' for i in range(8)] + ['{"id": 99, "x": ', f'{{"id": {10 * k + 8}}}'])
    sdf = spark.readStream.schema(io.with_corrupt(SCHEMA)).options(**io.CORRUPT_OPTIONS).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    rules = {**validate.well_formed(io.CORRUPT), **validate.required_doubles(["x"])}
    scored, quarantine = S.score_stream(sdf, model, rules, str(tmp_path / "out"), str(tmp_path / "chk"), keep=["id"], name="rescue_stream")
    good, bad = spark.read.parquet(scored), spark.read.parquet(quarantine)
    assert good.count() == 16 and bad.count() == 4
    assert sorted(tuple(r.reasons) for r in bad.collect()) == [("malformed", "x_required")] * 2 + [("x_required",)] * 2
    assert {r[io.CORRUPT] for r in bad.collect()} == {'{"id": 99, "x": ', None}
