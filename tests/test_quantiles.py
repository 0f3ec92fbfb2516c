"""The banded exact quantile must equal Spark's percentile exactly."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from voltwatch.config import Scale
from voltwatch.operators.quantiles import exact_quantiles, quantiles

QS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.mark.parametrize("by", [[], ["l_returnflag"], ["l_suppkey"]])
@pytest.mark.parametrize("accuracy", [50, 10_000])
def test_banded_equals_percentile(spark, by, accuracy):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    cols = ["l_quantity", "l_extendedprice", "l_discount"]
    a = exact_quantiles(li, by, cols, QS, accuracy=accuracy).collect()
    b = li.groupBy(*by).agg(*[F.percentile(c, F.array(*[F.lit(q) for q in QS])).alias(c) for c in cols]).collect()
    key = lambda r: tuple(r[k] for k in by)
    a, b = {key(r): r for r in a}, {key(r): r for r in b}
    assert a.keys() == b.keys()
    for k in b:
        for c in cols:
            assert a[k][c] == pytest.approx(b[k][c], abs=1e-9)


def test_auto_switch_and_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, 2.0), (1, 4.0), (2, None)], "g int, x double")
    small = {r["g"]: r["x"] for r in quantiles(df, ["g"], ["x"], [0.5]).collect()}
    big = {r["g"]: r["x"] for r in quantiles(df, ["g"], ["x"], [0.5], Scale(hot_entity_rows=1)).collect()}
    assert small[1] == [3.0] and big[1] == [3.0]
    assert small[2] is None and big.get(2) is None


def test_half_of_the_rows_share_one_value(spark):
    from voltwatch.operators.quantiles import exact_quantiles
    df = spark.range(4000).select(
        F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("g"),
        F.when(F.col("id") % 2 == 0, 7.0).otherwise(F.col("id") / 10).alias("v"))
    qs = [0.0, 0.25, 0.5, 0.75, 1.0]
    want = {r.g: r.a for r in df.groupBy("g").agg(F.percentile("v", F.array(*map(F.lit, qs))).alias("a")).collect()}
    for accuracy in (10, 1_000_000):
        got = {r.g: r.v for r in exact_quantiles(df, ["g"], ["v"], qs, accuracy).collect()}
        assert got.keys() == want.keys() and None in got
        assert all(abs(x - y) < 1e-9 for g in want for x, y in zip(got[g], want[g]))


def test_missed_bands_are_narrowed(spark, monkeypatch):
    """Coarse sketches without a margin miss ranks; narrowing finds them by bins, ties and infinities included."""
    from voltwatch.operators import quantiles as Q

    monkeypatch.setattr(Q, "MARGIN", 0.0)
    monkeypatch.setattr(Q, "CUTS", 8)
    asked = []
    plain = Q.narrowed

    def small(values, targets, keys):
        asked.append(targets.count())
        return plain(values, targets, keys, few=5)

    monkeypatch.setattr(Q, "narrowed", small)
    v = F.when(F.col("id") % 3 == 0, F.lit(7.0)).when(F.col("id") % 50 == 1, F.lit(float("inf"))).when(F.col("id") % 50 == 2, F.lit(float("-inf")))
    df = spark.range(3000).select((F.col("id") % 2).alias("g"), v.otherwise(F.exp(F.col("id") % 701 / 10)).alias("v"), (F.col("id") * 7919 % 3001).cast("double").alias("x"))
    qs = [0.0, 0.3, 0.5, 0.9, 1.0]
    for by in ([], ["g"]):
        aggs = [F.percentile(c, F.array(*map(F.lit, qs))).alias(c) for c in ("v", "x")]
        want = {r["g"] if by else 0: (r["v"], r["x"]) for r in df.groupBy(*by).agg(*aggs).collect()}
        got = {r["g"] if by else 0: (r["v"], r["x"]) for r in Q.exact_quantiles(df, by, ["v", "x"], qs, accuracy=4).collect()}
        assert got.keys() == want.keys()
        for k in want:
            assert got[k][1] == pytest.approx(want[k][1])
            assert got[k][0] == pytest.approx(want[k][0])
    assert sum(asked) > 10


def test_wide_bands_are_not_ranked_whole(spark, monkeypatch):
    """A band of a coarse sketch holds a share of the rows: it is narrowed by bins too, before a window ranks it."""
    from voltwatch.operators import quantiles as Q

    most, plain = [], Q.narrowed

    def small(values, targets, keys):
        most.append(values.groupBy(*keys).count().agg(F.max("count")).first()[0])
        return plain(values, targets, keys, few=20)

    monkeypatch.setattr(Q, "narrowed", small)
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_011).cast("double").alias("x"))
    want = df.agg(F.percentile("x", F.array(*map(F.lit, QS)))).first()[0]
    assert Q.exact_quantiles(df, [], ["x"], QS, accuracy=100).first()["x"] == pytest.approx(want)
    assert len(most) == 1 and 20 < most[0] < 4_000
