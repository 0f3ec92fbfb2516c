"""Model store, requests, ledger, SMOTE and split properties."""

import json

import pytest
from pyspark.sql import Window, functions as F

from conftest import SF001
from voltwatch.operators import drift, ml, validate
from voltwatch.sources import io
from voltwatch.sources.tables import events_telemetry


@pytest.fixture(scope="module")
def ev(spark):
    return events_telemetry(spark, SF001, with_nulls=False).cache()


def test_split_sizes_and_strata(ev):
    s = ml.stratified_split(ev, "label", "event_id")
    got = {(r["label"], r["is_test"]): r["count"] for r in s.groupBy("label", "is_test").count().collect()}
    for y in (0, 1):
        n = got.get((y, 0), 0) + got.get((y, 1), 0)
        assert got.get((y, 1), 0) == int(n * 0.2 + 0.5)
    # hot-class path gives the same rows
    from voltwatch.config import Scale
    hot = ml.stratified_split(ev, "label", "event_id", scale=Scale(hot_entity_rows=50))
    a = {r[0] for r in s.where("is_test = 1").select("event_id").collect()}
    b = {r[0] for r in hot.where("is_test = 1").select("event_id").collect()}
    assert a == b


def test_model_save_load_and_score(spark, ev, tmp_path):
    m = ml.train(ev, ["value", "k"], "label", "rf", {"numTrees": 5})
    path = str(tmp_path / "model")
    m.save(path)
    back = ml.ScoringModel.load(spark, path)
    assert back.features == ["value", "k"]
    a = ml.score(ev, m, keep=["event_id"]).orderBy("event_id").collect()
    b = ml.score(ev, back, keep=["event_id"]).orderBy("event_id").collect()
    assert a == b
    with pytest.raises(ValueError, match="Missing features"):
        ml.score(ev.drop("k"), m)


def test_request_validation(spark, tmp_path):
    reading = {c: 0.0 for c in io.FEATURES_30}
    ok = dict(reading, Module_ID="K8sTestModule01", Module_SoC_percent=70.0)
    bad = dict(reading, Module_ID="HazardTest01", Module_SoC_percent=130.0)
    missing = {k: v for k, v in ok.items() if k != "Module_Voltage_V"}
    p = tmp_path / "req.json"
    p.write_text(json.dumps({"readings": [ok, bad, missing]}, indent=2))
    rows = io.read_requests(spark, str(p))
    assert rows.count() == 3
    rules = validate.required_doubles(io.FEATURES_30, {"Module_SoC_percent": (0, 100)})
    valid, quarantine = validate.validate(rows, rules)
    assert [r["Module_ID"] for r in valid.collect()] == ["K8sTestModule01"]
    reasons = {r["Module_ID"]: r["reasons"] for r in quarantine.collect()}
    assert reasons["HazardTest01"] == ["Module_SoC_percent_range"]
    assert reasons["K8sTestModule01"] == ["Module_Voltage_V_required"]


def test_ledger_and_gate(spark, tmp_path):
    led = io.ledger_rows(spark, "exp", "new", {"maxIter": 20}, {"recall_1": 0.9, "precision_1": 0.5}).unionByName(
        io.ledger_rows(spark, "exp", "prod", None, {"recall_1": 0.8, "precision_1": 0.6}))
    io.log_run(led, str(tmp_path / "ledger"))
    back = spark.read.parquet(str(tmp_path / "ledger"))
    g = drift.promotion_gate(back, "new", "prod", precision_floor=0.4).first()
    assert g["promote"] and g["new_recall"] == pytest.approx(0.9)
    assert not drift.promotion_gate(back, "new", "prod", precision_floor=0.55).first()["promote"]


def test_smote_balances_and_interpolates(ev):
    tr = ev.select("event_id", "value", "k", "label")
    out = ml.smote(tr, ["value", "k"], "label", id_col="event_id")
    counts = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert counts[0] == counts[1]
    mino = tr.where("label = 1").agg(F.min("value"), F.max("value"), F.min("k"), F.max("k")).first()
    syn = out.where("label = 1").agg(F.min("value"), F.max("value"), F.min("k"), F.max("k")).first()
    assert syn[0] >= mino[0] - 1e-9 and syn[1] <= mino[1] + 1e-9
    assert syn[2] >= mino[2] - 1e-9 and syn[3] <= mino[3] + 1e-9


def test_knn_exact_blocks_agree(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    pts = [(i, [float(x) for x in rng.normal(size=3)]) for i in range(60)]
    df = spark.createDataFrame(pts, "id long, v array<double>")
    one = ml.knn_exact(df, "id", "v", 5, 1000).orderBy("id", "_vw_rank").collect()
    many = ml.knn_exact(df, "id", "v", 5, 7, chunk=4).orderBy("id", "_vw_rank").collect()
    assert one == many and len(one) == 60 * 5
    arr = np.array([p[1] for p in pts])
    d = ((arr[:, None, :] - arr[None, :, :]) ** 2).sum(-1)
    np.fill_diagonal(d, np.inf)
    want = np.argsort(d, axis=1, kind="stable")[:, :5]
    got = np.array([r["_vw_nn"] for r in one]).reshape(60, 5)
    assert (np.sort(got, 1) == np.sort(want, 1)).all()


def test_entity_and_time_splits(ev):
    s = ml.entity_split(ev, "user_id")
    per = s.groupBy("user_id").agg(F.countDistinct("is_test").alias("n"), F.max("is_test").alias("t")).collect()
    assert all(r["n"] == 1 for r in per)  # an entity is never split
    assert sum(r["t"] for r in per) == int(len(per) * 0.2 + 0.5)
    t = ml.time_split(ev, "ts")
    lo = t.where("is_test = 1").agg(F.min("ts")).first()[0]
    hi = t.where("is_test = 0").agg(F.max("ts")).first()[0]
    assert hi < lo
    share = t.where("is_test = 1").count() / t.count()
    assert abs(share - 0.2) < 0.01


def test_null_labels_and_predictions_are_kept(spark):
    rows = [(i, None if i % 10 == 0 else i % 2, None if i % 7 == 0 else i % 2) for i in range(100)]
    d = spark.createDataFrame(rows, "id long, y int, p int")
    s = ml.stratified_split(d, "y", "id")
    got = {(r["y"], r["is_test"]): r["count"] for r in s.groupBy("y", "is_test").count().collect()}
    assert sum(got.values()) == 100 and got[(None, 1)] == 2 and got[(None, 0)] == 8
    from voltwatch.operators import metrics
    lost = sum(1 for _, y, p in rows if y is not None and p is None)
    cm = metrics.confusion(d, "y", "p").first()
    assert cm["not_scored"] == lost and cm["fp"] == cm["fn"] == 0
    assert drift.error_rows(d, "y", "p").where("error = 'not_scored'").count() == lost
    w = metrics.with_weights(d, "y").groupBy("y").agg(F.max("weight").alias("w")).collect()
    n = {y: sum(1 for r in rows if r[1] == y) for y in (None, 0, 1)}
    assert {r["y"]: round(r["w"], 9) for r in w} == {y: round(100 / (3 * c), 9) for y, c in n.items()}


def test_kept_features_are_not_scaled(spark):
    from voltwatch.operators import ml

    d = spark.createDataFrame([(i, float(i), None if i == 3 else float(i % 4), int(i > 20)) for i in range(40)], "id long, a double, b double, y int")
    model = ml.train(d, ["a", "b"], "y", "lr")
    got = ml.score(d, model, keep=["id", "b", "a"]).orderBy("id").collect()
    assert [(r.id, r.a, r.b) for r in got] == [(i, float(i), None if i == 3 else float(i % 4)) for i in range(40)]
    assert [r.probability for r in got] == [r.probability for r in ml.score(d, model, keep=["id"]).orderBy("id").collect()]


def test_split_keeps_rows_where_they_are(spark):
    """A class is never put into one task, and its cut is exact also among rows that share the cut's draw."""
    d = spark.range(0, 5000, 1, 16).select("id", F.when(F.col("id") % 7 > 0, F.col("id") % 7 % 2).alias("y"))
    s = ml.stratified_split(d, "y", "id")
    sizes = s.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 16 and max(r["count"] for r in sizes) <= 320
    w = Window.partitionBy("y").orderBy(F.substring(F.md5(F.concat_ws(":", F.lit("42"), "id")), 1, 8), "id")
    n = F.count(F.lit(1)).over(Window.partitionBy("y"))
    want = d.where(F.lit(True)).withColumn("is_test", (F.row_number().over(w) <= F.floor(n * 0.2 + 0.5)).cast("int"))
    assert sorted(map(tuple, s.select("id", "is_test").collect())) == sorted(map(tuple, want.select("id", "is_test").collect()))
    few = spark.createDataFrame([(i % 3 or None, "a" if i < 90 else "b") for i in range(92)], "id long, y string")  # repeated and NULL ids
    got = {(r.y, r.is_test): r["count"] for r in ml.stratified_split(few, "y", "id").groupBy("y", "is_test").count().collect()}
    assert got == {("a", 1): 18, ("a", 0): 72, ("b", 0): 2}


def test_learners_read_even_partitions(spark, monkeypatch):
    """Rows that came in one large partition are dealt anew before a learner scans them again and again."""
    monkeypatch.setattr(ml, "PART_ROWS", 100)
    d, n = ml._even(spark.range(0, 1000, 1, 1).persist())
    assert n == 1000 and max(r["count"] for r in d.groupBy(F.spark_partition_id()).count().collect()) <= 100
    d.unpersist()


def test_neighbours_without_ranking_a_block(spark, monkeypatch):
    """The k nearest by distance, ties to the least ids, from candidates: no whole row of distances is partitioned."""
    import numpy as np

    rng = np.random.default_rng(3)
    x = np.concatenate([rng.integers(0, 6, (600, 3)).astype(float), np.zeros((40, 3))])  # many ties and copies
    pts = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "i long, v array<double>")
    got = {}
    for r in ml.knn_exact(pts, "i", "v", 5, block_rows=200).orderBy("i", "_vw_rank").collect():
        got.setdefault(r.i, []).append(r._vw_nn)
    for i in range(len(x)):
        d = ((x - x[i]) ** 2).sum(1)
        want = sorted((d[j], j) for j in range(len(x)) if j != i)[:5]
        assert got[i] == [j for _, j in want]
    widths, plain = [], np.partition
    monkeypatch.setattr(np, "partition", lambda a, *r, **k: (widths.append(a.shape[1]), plain(a, *r, **k))[1])
    row, col, _ = ml._nearest(x[:9], np.arange(9), np.arange(640), x, (x * x).sum(1), 5)
    assert widths == [20] and [col[row == i].tolist() for i in range(9)] == [got[i] for i in range(9)]


def test_small_children_are_summed(monkeypatch):
    """Of two children only the smaller one's rows are read again."""
    import numpy as np
    from voltwatch.operators import boosting

    rng = np.random.default_rng(4)
    bins = rng.integers(0, 64, (4000, 5)).astype(np.uint8)
    y = (rng.random(4000) < 0.2 + 0.6 * (bins[:, 0] > 30)).astype(int)
    read, plain = [], boosting.node_sums
    monkeypatch.setattr(boosting, "node_sums", lambda b, rows, g, h: (read.append(len(rows)), plain(b, rows, g, h))[1])
    trees, margin = boosting.fit_rows(bins, y, np.arange(4000), np.ones(4000, bool), boosting.Spec(trees=1, depth=4))
    assert read[0] == 4000 and sum(read[1:]) <= 3 * 2000
    assert np.array_equal(margin, trees[0].value[trees[0].nodes(bins)])
