"""Structured Streaming operators.

Sinks are Parquet folders written by ``foreachBatch`` under shared storage
(never a driver-memory sink): row outputs are appended per epoch into
``epoch=<id>`` folders, which a replayed epoch overwrites (idempotent);
complete-mode aggregates overwrite the whole folder each epoch.

Stream timestamps: files carry ``timestamp_ntz``; watermarks need
``timestamp``.  The wall clock is mapped to an instant as if it were UTC
(zone-free both ways), so window boundaries follow the wall clock in any
session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltwatch.config import Columns
from voltwatch.functions.stats import ROLLING
from voltwatch.operators import ml, sketches, validate as V
from voltwatch.sources.io import scratch_path
from voltwatch.streaming import ordered

NTZ_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
WATERMARK = "10 minutes"
#: Groups of entities that share the states of the feature stream.
BUCKETS = 1024


def ntz_to_instant(c: Column) -> Column:
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.expr(NTZ_EPOCH), c))


def instant_to_ntz(c: Column) -> Column:
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), F.expr(NTZ_EPOCH))


# ---------------------------------------------------------------- S10 source / sink
def read_stream(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet",
                glob: str | None = None, max_files: int | None = None) -> DataFrame:
    """A file stream with an explicit schema."""
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(folder)


def run_to_end(sdf: DataFrame, batch_fn, name: str, checkpoint: str, mode: str = "append") -> int:
    """Run ``sdf`` with ``foreachBatch(batch_fn)`` until the available input
    is processed (``availableNow``), then stop.  Returns the number of rows
    the stateful operators dropped as later than the watermark (from the
    query progress)."""
    q = (sdf.writeStream.outputMode(mode).foreachBatch(batch_fn).queryName(name)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    try:
        q.awaitTermination()
    finally:
        q.stop()
    if q.exception():
        raise q.exception()
    return late_rows(q)


def late_rows(q) -> int:
    """Rows dropped by the watermark over the query's recent progress."""
    return int(sum(op.get("numRowsDroppedByWatermark", 0) or 0
                   for p in q.recentProgress for op in (p.get("stateOperators") or [])))


def append_epoch(path: str):
    """foreachBatch writer: rows of epoch e replace ``path/epoch=e``."""
    def write(batch: DataFrame, epoch: int):
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
    return write


def overwrite_all(path: str):
    """foreachBatch writer for complete-mode aggregates."""
    def write(batch: DataFrame, epoch: int):
        batch.write.mode("overwrite").parquet(path)
    return write


# ---------------------------------------------------------------- T1 scoring with quarantine
def score_stream(sdf: DataFrame, model: ml.ScoringModel, rules: dict[str, Column], out: str, checkpoint: str,
                 keep=(), name: str = "score_stream") -> tuple[str, str]:
    """Validate every reading; valid rows are scored (label and class-1
    probability), invalid rows go to a quarantine sink with their reasons.
    Returns (scored path, quarantine path)."""
    scored_p, quar_p = f"{out}/scored", f"{out}/quarantine"

    def batch_fn(batch: DataFrame, epoch: int):
        tagged = batch.withColumn("reasons", V.failed_rules(rules)).persist()
        try:
            ok = tagged.where(F.size("reasons") == 0).drop("reasons")
            ml.score(ok, model, keep=list(keep)).write.mode("overwrite").parquet(f"{scored_p}/epoch={epoch}")
            tagged.where(F.size("reasons") > 0).write.mode("overwrite").parquet(f"{quar_p}/epoch={epoch}")
        finally:
            tagged.unpersist()

    run_to_end(sdf, batch_fn, name, checkpoint)
    return scored_p, quar_p


# ---------------------------------------------------------------- T2 online delta and rolling
def feature_stream(sdf: DataFrame, cfg: Columns, cols, windows=(6, 30, 60), stats=("mean", "std"), k: int = 1,
                   out: str | None = None, checkpoint: str | None = None, name: str = "feature_stream",
                   state_ttl_s: int | None = None, watermark: str = WATERMARK, buckets: int = BUCKETS):
    """Per-entity delta and rolling features on a stream, equal to the
    batch operators for any arrival order within the watermark (see
    ``ordered``).  Rows come out once the watermark has passed them; rows
    that arrive later than that have ``late`` set and no features.

    ``state_ttl_s`` bounds the state: an entity whose newest reading is
    that much older than the event-time watermark loses its tail.

    ``buckets`` groups of entities share their states and calls; a checkpoint
    keeps the number it was made with.  More entities want more buckets: one
    holds about 60 short rows of each.

    Returns the streaming DataFrame when ``out`` is None (its query needs the
    RocksDB state store, ``ordered.PROVIDER``), else runs it to the end into
    ``out``, late rows into ``<out>-late``.  Rows the watermark has not
    passed at the end stay in the checkpoint's state for the next run;
    ``stream_folder(closing=...)`` ends a replay with a row that releases them.
    """
    for s in stats:
        if s not in ROLLING:
            raise ValueError(f"Unsupported rolling statistic: {s}")
    cols = list(cols)
    names = ordered.feature_names(cols, windows, stats, k)
    own = sdf.schema
    # the processor decides itself what is late, so the operator's input has no watermark column
    src = sdf.withColumn("_vw_et", ntz_to_instant(F.col(cfg.time))).withWatermark("_vw_et", watermark).select(
        *own.names, F.when(F.col(cfg.entity).isNull(), -1).otherwise(F.pmod(F.xxhash64(cfg.entity), F.lit(buckets))).cast("int").alias("_vw_bucket"))
    proc = ordered.OrderedFeatures(cfg.entity, cfg.time, cfg.tie, cols, windows, stats, k, names, own.names, state_ttl_s)
    res = src.groupBy("_vw_bucket").transformWithStateInPandas(
        proc, ordered.out_schema(own, names), "Append", "EventTime")
    if out is None:
        return res

    def write(batch: DataFrame, epoch: int):
        batch = batch.persist()
        try:
            batch.where(~F.col("late")).drop("late").write.mode("overwrite").parquet(f"{out}/epoch={epoch}")
            batch.where("late").select(*own.names).write.mode("overwrite").parquet(f"{out}-late/epoch={epoch}")
        finally:
            batch.unpersist()

    conf = sdf.sparkSession.conf
    before = conf.get(ordered.PROVIDER)
    conf.set(ordered.PROVIDER, ordered.ROCKSDB)
    try:
        run_to_end(res, write, name, checkpoint)
    finally:
        conf.set(ordered.PROVIDER, before)
    return out


# ---------------------------------------------------------------- T3-T7 windowed rates and statistics
def windowed(sdf: DataFrame, time: str, length: str, slide: str | None, aggs: list[Column], by=(),
             watermark: str = WATERMARK, window_col: str | None = None) -> DataFrame:
    """Event-time windows with a watermark: late rows (older than the
    watermark) are dropped from append-mode results; the window start/end
    come back as wall-clock timestamp_ntz.  ``window_col`` also keeps the
    event-time window itself, for a stateful operator behind this one."""
    t = ntz_to_instant(F.col(time)) if isinstance(sdf.schema[time].dataType, T.TimestampNTZType) else F.col(time)
    d = sdf.withColumn("_vw_t", t).withWatermark("_vw_t", watermark)
    w = F.window("_vw_t", length, slide) if slide else F.window("_vw_t", length)
    g = d.groupBy(w.alias("_w"), *by).agg(*aggs)
    return g.select(instant_to_ntz(F.col("_w.start")).alias("window_start"),
                    instant_to_ntz(F.col("_w.end")).alias("window_end"), *[c for c in g.columns if c != "_w"],
                    *([F.col("_w").alias(window_col)] if window_col else []))


def outcome_rate(sdf: DataFrame, time: str, label: str, length="5 minutes", slide="1 minute") -> DataFrame:
    """T3 + T6: events and positives per sliding window, their rate per
    minute and the positive share."""
    mins = _minutes(length)
    return windowed(sdf, time, length, slide, [
        F.count(F.lit(1)).alias("events"), F.count_if(F.col(label) == 1).cast("long").alias("positives"),
    ]).withColumn("rate_per_min", F.col("events") / mins).withColumn(
        "positive_share", F.col("positives") / F.col("events"))


def value_quantile(sdf: DataFrame, time: str, value: str, q: float = 0.95, length="5 minutes", slide="1 minute",
                   exact: bool = True, window_col: str | None = None) -> DataFrame:
    """T4: a quantile of a value (e.g. p95 latency) per sliding window.

    ``exact`` keeps every distinct value of an open window as state; else the
    state is one bounded KLL sketch per window and the quantile a value of the
    data (rank error about 1.6 / ``sketches.K``)."""
    out = f"p{int(q * 100)}"
    if exact:
        return windowed(sdf, time, length, slide, [F.percentile(value, q).alias(out), F.count(F.lit(1)).alias("events")], window_col=window_col)
    v = F.col(value).cast("double")
    aggs = [F.kll_sketch_agg_double(v, F.lit(sketches.K)).alias("sketch"), F.count(v).alias("n"), F.count(F.lit(1)).alias("events")]
    d = windowed(sdf, time, length, slide, aggs, window_col=window_col)
    return d.select("window_start", "window_end", sketches.quantile(q).alias(out), "events", *([window_col] if window_col else []))


def alerts(windows: DataFrame, metric: str, threshold: float, span: int, slide_s: int = 60) -> DataFrame:
    """T5: a window alerts when the metric is over the threshold in it and
    in the ``span - 1`` windows before it (consecutive slides), i.e. over
    the threshold for the whole span.  ``windows`` has one row per window;
    each window over the threshold counts for itself and the ``span - 1`` next
    starts, so there is no window over all rows in one task."""
    d = windows.withColumn("over", F.col(metric) > threshold)
    later = F.array(*[F.timestamp_add("SECOND", F.lit(i * slide_s), F.col("window_start")) for i in range(span)])
    runs = d.where("over").select(F.explode(later).alias("window_start")).groupBy("window_start").agg(
        F.count(F.lit(1)).alias("_vw_n"))
    full = F.coalesce(F.col("_vw_n"), F.lit(0)) == span
    return d.join(runs, "window_start", "left").withColumn("alert", F.col("over") & full).drop("_vw_n")


def alert_stream(sdf_windows: DataFrame, metric: str, threshold: float, span: int, out: str, checkpoint: str,
                 name: str = "alert_stream", slide_s: int = 60) -> int:
    """T5 inside ``foreachBatch``: every epoch receives the complete window
    table, flags the alerts on it and rewrites ``out`` (windows + over +
    alert).  Returns rows dropped by the watermark, as ``run_to_end``."""
    def write(batch: DataFrame, epoch: int):
        batch = batch.persist()
        try:
            alerts(batch, metric, threshold, span, slide_s).write.mode("overwrite").parquet(out)
        finally:
            batch.unpersist()
    return run_to_end(sdf_windows, write, name, checkpoint, mode="complete")


def chained_alerts(windows: DataFrame, metric: str, threshold: float, span: int, slide_s: int = 60) -> DataFrame:
    """T5 as a second stateful operator behind the windows, in append mode.

    ``windows`` is a windowed aggregate with its window in ``_vw_w``.  A
    sliding window over the windows' own times holds the last ``span`` of them;
    it is emitted once, when the watermark has passed it, and its state is
    those few rows.  A window alerts if it is over the threshold with the
    ``span - 1`` before it, as in ``alerts``."""
    d = windows.withColumn("over", F.col(metric) > threshold).withColumn("_vw_t", F.window_time("_vw_w"))
    own = [c for c in windows.columns if c != "_vw_w"]
    last = F.max_by(F.struct(*own, "over", "_vw_w"), F.col("_vw_w.end"))
    g = d.groupBy(F.window("_vw_t", f"{span * slide_s} seconds", f"{slide_s} seconds").alias("_s")).agg(
        last.alias("r"), F.count_if("over").alias("_n"))
    # sliding windows whose newest member is an older window end in a gap
    g = g.where(F.col("r._vw_w.end") == F.col("_s.end"))
    return g.select(*[F.col(f"r.{c}").alias(c) for c in own], F.col("r.over").alias("over"), (F.col("r.over") & (F.col("_n") == span)).alias("alert"))


def daily_stats(sdf: DataFrame, time: str, value: str, length="1 day") -> DataFrame:
    """Tumbling-window statistics of a value."""
    return windowed(sdf, time, length, None, [
        F.count(F.lit(1)).alias("events"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max")])


def sketch_stream(sdf: DataFrame, time: str, cols, length="1 day", watermark: str = WATERMARK) -> DataFrame:
    """Mergeable statistics (``sketches``) per tumbling window and feature,
    to be stored and compared later without the rows.  State is bounded: one
    sketch per open window and feature."""
    d = sketches.melted(sdf, cols, [time])
    return windowed(d, time, length, None, sketches.statistics(), ["feature"], watermark)


def _minutes(length: str) -> float:
    n, unit = length.split()
    return float(n) * {"second": 1 / 60, "seconds": 1 / 60, "minute": 1, "minutes": 1, "hour": 60,
                       "hours": 60, "day": 1440, "days": 1440}[unit]


def run_aggregate(sdf_agg: DataFrame, out: str, checkpoint: str, name: str, mode: str = "complete") -> int:
    """Run a windowed aggregate to the end into ``out``.

    complete  every epoch rewrites the whole result (all windows, late rows
              included: complete mode keeps all state);
    append    closed windows are appended per epoch; rows later than the
              watermark are dropped.
    Returns Spark's ``numRowsDroppedByWatermark`` summed over the run; for
    window aggregates Spark may drop late rows before the state store and
    report 0, so treat it as a lower bound.
    """
    writer = overwrite_all(out) if mode == "complete" else append_epoch(out)
    return run_to_end(sdf_agg, writer, name, checkpoint, mode=mode)


def chunk_cuts(df: DataFrame, time: str, chunks: int) -> list:
    """At most ``chunks`` - 1 rising times that cut the rows into chunks of about equal count."""
    us = F.timestamp_diff("MICROSECOND", F.expr(NTZ_EPOCH), F.col(time).cast("timestamp_ntz"))
    qs = [i / chunks for i in range(1, chunks)]
    found = df.agg(F.percentile_approx(us, qs, 10_000), F.min(us)).first() if qs else (None, None)
    return sorted({c for c in found[0] or [] if c > found[1]})


def stream_folder(spark: SparkSession, df: DataFrame, time: str, chunks: int, key: str, files: int = 8,
                  closing: str | None = None) -> str:
    """Write ``df`` in time order, one append of exactly ``files`` files per
    chunk, so that a stream of ``files`` files per trigger replays a chunk per
    micro-batch.  The times are cut at equal counts, so an outlier makes no
    chunk of its own; rows of one time stay together.  Rows are dealt to the
    files by the hash of ``key`` (unique, so that a hot entity is dealt too);
    rows without a time come first.  A file without rows is written as well,
    and the number of files is checked: a trigger never spans two chunks.
    ``closing`` is a watermark delay: the replay then ends with a row of NULLs
    whose time lies beyond it, so that the watermark passes every real row."""
    path = scratch_path(spark, "stream-in")
    cuts = chunk_cuts(df, time, chunks)
    us = F.timestamp_diff("MICROSECOND", F.expr(NTZ_EPOCH), F.col(time).cast("timestamp_ntz"))
    # the chunk of a row: the number of cuts at or before its time
    chunk = F.coalesce(sum([(us >= c).cast("int") for c in cuts], F.lit(0)), F.lit(0))
    for i in range(len(cuts) + 1):
        df.where(chunk == i).repartition(files, key).write.mode("append").parquet(path)
        missing = files * (i + 1) - len(spark.read.schema(df.schema).parquet(path).inputFiles())
        for _ in range(missing):  # partitions without rows wrote no file
            df.limit(0).coalesce(1).write.mode("append").parquet(path)
        if (n := len(spark.read.schema(df.schema).parquet(path).inputFiles())) != files * (i + 1):
            raise ValueError(f"chunk {i} of the replay ends at file {n}, not {files * (i + 1)}")
    if closing:
        after = F.col("_vw_end") + F.expr(f"INTERVAL {closing}") + F.expr("INTERVAL 1 SECOND")
        last = df.agg(F.max(F.col(time).cast("timestamp_ntz")).alias("_vw_end"))
        types = {f.name: f.dataType for f in df.schema.fields}
        last.select(*[(after if c == time else F.lit(None)).cast(types[c]).alias(c) for c in df.columns]) \
            .coalesce(1).write.mode("append").parquet(path)
    return path
