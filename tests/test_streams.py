"""Stream state bound (T2 TTL) and stream = batch on a tiny replay."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from voltwatch.config import Columns
from voltwatch.sources.io import scratch_path
from voltwatch.streaming import streams as S

CFG = Columns(entity="e", time="t", tie="i")
T0 = dt.datetime(2024, 1, 1)


def test_state_ttl_expires_idle_entity(spark):
    day = dt.timedelta(days=1)
    chunks = [
        [("A", T0 + dt.timedelta(seconds=10 * j), j, float(j)) for j in range(5)] + [("B", T0, 100, 1.0)],
        [("B", T0 + 40 * day, 101, 2.0)],
        [("A", T0 + 41 * day, 5, 50.0), ("B", T0 + 41 * day, 102, 3.0)],
        [(None, T0 + 42 * day, None, None)],
    ]
    schema = "e string, t timestamp_ntz, i long, x double"
    folder = scratch_path(spark, "ttl-in")
    for rows in chunks:  # one append per chunk: files in time order
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    sdf = S.read_stream(spark, folder, spark.createDataFrame([], schema).schema, max_files=1)
    out = scratch_path(spark, "ttl-out")
    S.feature_stream(sdf, CFG, ["x"], (3,), ("mean",), 1, out=f"{out}/o", checkpoint=f"{out}/c",
                     name="ttl_test", state_ttl_s=30 * 86400)
    res = {(r["e"], r["i"]): r for r in spark.read.parquet(f"{out}/o").collect()}
    assert len(res) == 9
    # A's tail (values 0..4) expired after 30 idle days: the new reading starts afresh
    assert res[("A", 5)]["Delta_1_x"] == 0.0 and res[("A", 5)]["Rolling_mean_3_x"] == 50.0
    # B was silent for 40 days, then reported within the TTL: its frames start afresh, then continue
    assert res[("B", 101)]["Delta_1_x"] == 0.0 and res[("B", 102)]["Delta_1_x"] == 1.0
    assert res[("A", 4)]["Rolling_mean_3_x"] == 3.0


def test_late_rows_are_dropped_in_append_mode(spark):
    minute = dt.timedelta(minutes=1)
    chunks = [
        [("A", T0 + i * minute, i, 1.0) for i in range(60)],          # up to 00:59
        [("A", T0 + 61 * minute, 101, 1.0)],                           # windows up to 00:49 close
        [("A", T0 + 2 * minute, 100, 1.0), ("A", T0 + 62 * minute, 102, 1.0)],  # 00:02 arrives late
    ]
    schema = "e string, t timestamp_ntz, i long, x double"
    folder = scratch_path(spark, "late-in")
    for rows in chunks:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    sdf = S.read_stream(spark, folder, spark.createDataFrame([], schema).schema, max_files=1)
    sdf = sdf.withColumn("y", F.lit(1))
    out = scratch_path(spark, "late-out")
    dropped = S.run_aggregate(S.outcome_rate(sdf, "t", "y"), f"{out}/o", f"{out}/c", "late_test", mode="append")
    assert dropped >= 0
    res = spark.read.parquet(f"{out}/o")
    # the window [00:00, 00:05) closed before the late 00:02 reading arrived: it keeps 5 events
    first = res.where(F.col("window_start") == F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).collect()
    assert [r["events"] for r in first] == [5]
    # no window holds the late row twice over: total events of closed windows come from on-time rows
    assert res.where(F.col("window_end") <= F.lit("2024-01-01 00:07:00").cast("timestamp_ntz")) \
        .agg(F.max("events")).first()[0] == 5


def test_replay_keeps_rows_without_time_and_uses_many_files(spark):
    rows = [("A", None if j % 9 == 0 else T0 + dt.timedelta(seconds=j), j, float(j)) for j in range(200)]
    d = spark.createDataFrame(rows, "e string, t timestamp_ntz, i long, x double")
    folder = S.stream_folder(spark, d, "t", 3, "i", 4)
    back = spark.read.parquet(folder)
    assert back.count() == 200 and back.where("t is null").count() == 23
    assert len(back.inputFiles()) == 12


def test_alerts_need_a_whole_span(spark):
    starts = [0, 1, 2, 3, 5, 6, 7]  # minute 4 has no window
    rows = [(T0 + dt.timedelta(minutes=m), None if m == 7 else 9.0 if m else 1.0) for m in starts]
    w = spark.createDataFrame(rows, "window_start timestamp_ntz, p double")
    got = {r["window_start"].minute: r["alert"] for r in S.alerts(w, "p", 5.0, 3).collect()}
    assert [m for m in starts if got[m]] == [3]


def test_replay_of_uneven_times_keeps_every_row(spark):
    """An outlier and bursts of equal times: each micro-batch is one chunk, so no row is late."""
    rows = [("A", T0 - dt.timedelta(days=900), 0, 0.0)]
    rows += [("AB"[j % 2], T0 + dt.timedelta(milliseconds=j), j, float(j)) for j in range(1, 121)]
    rows += [("A", T0 + dt.timedelta(days=1), j, float(j)) for j in range(121, 160)]
    d = spark.createDataFrame(rows, "e string, t timestamp_ntz, i long, x double")
    folder = S.stream_folder(spark, d, "t", 3, "i", 4, closing="10 minutes")
    assert len(spark.read.parquet(folder).inputFiles()) % 4 == 1
    few = S.stream_folder(spark, d.where("i < 2 OR i > 158"), "t", 3, "i", 4)
    assert len(spark.read.parquet(few).inputFiles()) % 4 == 0 and spark.read.parquet(few).count() == 3
    sdf = S.read_stream(spark, folder, d.schema, max_files=4)
    out = scratch_path(spark, "uneven-out")
    S.feature_stream(sdf, CFG, ["x"], (3,), ("mean",), 1, out=f"{out}/o", checkpoint=f"{out}/c", name="uneven_test")
    got = spark.read.parquet(f"{out}/o")
    assert sorted(r.i for r in got.collect()) == list(range(160))


def features_of(spark, chunks, tmp, watermark="10 minutes", ttl=None, windows=(3, 5)):
    """Rows on time with their features, and late rows, of a stream of one file per chunk."""
    schema = "e string, t timestamp_ntz, i long, x double, note string"
    folder = scratch_path(spark, f"{tmp}-in")
    for rows in chunks:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    end = max(t for rows in chunks for _, t, *_ in rows if t) + dt.timedelta(days=2)
    spark.createDataFrame([(None, end, None, None, None)], schema).coalesce(1).write.mode("append").parquet(folder)
    sdf = S.read_stream(spark, folder, spark.createDataFrame([], schema).schema, max_files=1)
    out = scratch_path(spark, f"{tmp}-out")
    S.feature_stream(sdf, CFG, ["x"], windows, ("mean", "std"), 2, out=f"{out}/o", checkpoint=f"{out}/c", name=tmp, state_ttl_s=ttl, watermark=watermark)
    return spark.read.parquet(f"{out}/o").drop("epoch"), spark.read.parquet(f"{out}/o-late").drop("epoch")


def batch_features(spark, rows, windows=(3, 5)):
    from voltwatch.operators.features import delta, rolling

    d = spark.createDataFrame(rows, "e string, t timestamp_ntz, i long, x double, note string")
    return rolling(delta(d, CFG, ["x"], 2), CFG, ["x"], windows, ("mean", "std"))


def test_shuffled_stream_equals_batch(spark):
    """Any arrival order within the watermark, ties, NULL values and a NULL entity: the rows of the batch operators."""
    import random

    rng = random.Random(5)
    rows = [(rng.choice(["A", "B", None]), T0 + dt.timedelta(seconds=20 * (j // 2)), j, None if j % 17 == 0 else float(rng.randrange(50)), f"n{j}") for j in range(240)]
    order = sorted(rows, key=lambda r: (r[1] - T0).total_seconds() + rng.random() * 500)  # up to 500 s late, 600 allowed
    got, late = features_of(spark, [order[k : k + 48] for k in range(0, 240, 48)], "shuffled")
    want = batch_features(spark, rows)
    assert late.count() == 0
    names = sorted(got.columns)
    key = lambda r: (r.i,)
    a = sorted(got.select(*names).collect(), key=key)
    b = sorted(want.select(*names).collect(), key=key)
    assert [tuple(None if v is None else round(v, 9) if isinstance(v, float) else v for v in r) for r in a] == [
        tuple(None if v is None else round(v, 9) if isinstance(v, float) else v for v in r) for r in b]


def test_late_rows_are_counted_not_lost(spark):
    """Emitted + late = input; late rows keep their columns and leave the others' frames alone."""
    minute = dt.timedelta(minutes=1)
    chunks = [
        [("A", T0 + m * minute, m, float(m), "on time") for m in range(0, 60, 5)],
        [("A", T0 + 61 * minute, 100, 61.0, "on time"), ("A", T0 + 12 * minute, 101, 12.0, "late"), ("A", T0 + 49 * minute, 102, 49.0, "on time")],
        [("A", T0 + 50 * minute, 103, 50.0, "late"), ("B", T0 + 3 * minute, 104, 3.0, "late"), ("A", T0 + 58 * minute, 105, 58.0, "on time")],
        [("A", None, 106, 7.0, "late")],
    ]
    got, late = features_of(spark, chunks, "late_features")
    assert {(r.i, r.note) for r in late.collect()} == {(101, "late"), (103, "late"), (104, "late"), (106, "late")}
    rows = [r for c in chunks for r in c if r[4] == "on time"]
    assert got.count() + late.count() == sum(map(len, chunks))
    want = {r.i: r.Rolling_mean_3_x for r in batch_features(spark, rows).collect()}
    assert {r.i: r.Rolling_mean_3_x for r in got.collect()} == want


def test_ttl_does_not_depend_on_batches(spark):
    """A silence beyond the time to live restarts the frames, within one emission as between two."""
    rows = [("A", T0 + dt.timedelta(hours=h), i, float(i * i), "") for i, h in enumerate([0, 1, 2, 30, 31, 32, 60, 61])]
    whole, _ = features_of(spark, [rows], "ttl_whole", ttl=86400)
    cut, _ = features_of(spark, [[r] for r in rows], "ttl_cut", ttl=86400)
    value = lambda d: {r.i: (r.Delta_2_x, r.Rolling_mean_5_x) for r in d.collect()}
    assert value(whole) == value(cut)
    assert {i: v[0] for i, v in value(whole).items()} == {0: 0, 1: 0, 2: 4, 3: 0, 4: 0, 5: 16, 6: 0, 7: 0}


def test_rows_without_time_come_first(spark):
    chunks = [[("A", T0, 1, 1.0, ""), ("A", None, 2, 5.0, "")], [("A", T0 + dt.timedelta(hours=1), 3, 2.0, "")]]
    got, late = features_of(spark, chunks, "no_time")
    assert late.count() == 0 and {r.i: r.Rolling_mean_3_x for r in got.collect()} == {2: 5.0, 1: 3.0, 3: 8 / 3}


def test_chained_alerts_equal_alerts(spark):
    """Spans with gaps, NULL quantiles and single windows: the second operator flags the rows that the table version flags."""
    import random

    rng = random.Random(11)
    rows = [(T0 + dt.timedelta(minutes=m, seconds=rng.randrange(60)), None if m % 23 == 0 else rng.choice([1.0, 9.0, 9.0, 9.0])) for m in range(150) if m % 11 or m > 60]
    d = spark.createDataFrame(rows, "ts timestamp_ntz, v double")
    w = S.windowed(d, "ts", "1 minute", None, [F.max("v").alias("p"), F.count("v").alias("n")], window_col="_vw_w")
    for span in (1, 3, 5):
        want = S.alerts(w.drop("_vw_w"), "p", 5.0, span)
        got = S.chained_alerts(w, "p", 5.0, span)
        key = lambda r: (r.window_start, r.p, r.n, r.over, r.alert or False)
        assert sorted(map(key, got.collect()), key=str) == sorted(map(key, want.collect()), key=str)
        assert got.where("alert").count() > 0


def test_alert_stream_appends_each_window_once(spark):
    """Closed windows come out once, late rows change nothing, and the last windows wait for the watermark."""
    minute = dt.timedelta(minutes=1)
    chunks = [[(T0 + m * minute, 9.0 if m % 10 < 6 else 1.0) for m in range(60)], [(T0 + 90 * minute, 1.0)], [(T0 + 5 * minute, 1.0), (T0 + 91 * minute, 1.0)]]
    folder = scratch_path(spark, "alert-in")
    for rows in chunks:
        spark.createDataFrame(rows, "ts timestamp_ntz, v double").coalesce(1).write.mode("append").parquet(folder)
    sdf = S.read_stream(spark, folder, spark.createDataFrame([], "ts timestamp_ntz, v double").schema, max_files=1)
    w = S.windowed(sdf, "ts", "1 minute", None, [F.max("v").alias("p")], window_col="_vw_w")
    out = scratch_path(spark, "alert-out")
    S.run_aggregate(S.chained_alerts(w, "p", 5.0, 3), f"{out}/o", f"{out}/c", "alert_append_test", "append")
    got = spark.read.parquet(f"{out}/o").collect()
    at = {int((r.window_start - T0) / minute): (r.p, r.alert) for r in got}
    assert len(at) == len(got) == 60 and all(at[m] == ((9.0, m % 10 >= 2) if m % 10 < 6 else (1.0, False)) for m in range(60))


def test_entities_share_buckets(spark):
    """One state and one call serve many entities: the rows of the batch operators, for every statistic."""
    from voltwatch.operators.features import delta, rolling

    stats = ("mean", "std", "var", "min", "max", "sum", "count", "median")
    rows = [(f"E{j % 7}", T0 + dt.timedelta(seconds=20 * j), j, None if j % 13 == 0 else float(j * j % 31)) for j in range(300)]
    schema = "e string, t timestamp_ntz, i long, x double"
    folder = scratch_path(spark, "bucket-in")
    for part in (rows[:100], rows[100:220], rows[220:], [(None, T0 + dt.timedelta(days=2), None, None)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
    sdf = S.read_stream(spark, folder, spark.createDataFrame([], schema).schema, max_files=1)
    out = scratch_path(spark, "bucket-out")
    S.feature_stream(sdf, CFG, ["x"], (3, 6), stats, 2, out=f"{out}/o", checkpoint=f"{out}/c", name="bucket_test", buckets=2)
    got = spark.read.parquet(f"{out}/o").drop("epoch")
    want = rolling(delta(spark.createDataFrame(rows, schema), CFG, ["x"], 2), CFG, ["x"], (3, 6), stats)
    names = sorted(want.columns)
    key = lambda r: r.i
    pairs = list(zip(sorted(got.select(names).collect(), key=key), sorted(want.select(names).collect(), key=key), strict=True))
    assert len(pairs) == 300
    for a, b in pairs:
        assert all(x == pytest.approx(y, abs=1e-9) if isinstance(y, float) else x == y for x, y in zip(a, b, strict=True)), (a, b)


def test_replay_has_a_file_per_core(spark, tmp_path, monkeypatch):
    """A micro-batch is read by as many tasks as the session has cores, and no trigger spans two chunks."""
    from voltwatch.plans import catalog_streams as C
    rows = [(i, T0 + dt.timedelta(minutes=i), i % 7, "ok", 1.0, "{}") for i in range(60)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string") \
        .write.parquet(str(tmp_path / "events.parquet"))
    read, seen = S.read_stream, []
    monkeypatch.setattr(S, "read_stream", lambda sp, folder, schema, max_files: (seen.append((folder, max_files)), read(sp, folder, schema, max_files=max_files))[1])
    monkeypatch.setattr(C, "FILES", 1)
    C._events_stream(spark, str(tmp_path))
    (folder, files), = seen
    assert files == spark.sparkContext.defaultParallelism > 1
    back = spark.read.parquet(folder)
    assert len(back.inputFiles()) == C.CHUNKS * files and back.count() == 60
