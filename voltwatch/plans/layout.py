"""Physical layout of a time series table: how entities map to tasks.

Every per-entity window (fill, lag, rolling, onset) is computed over
``Window.partitionBy(entity, SEG).orderBy(time, tie)``.  For an ordinary
entity ``SEG`` is 0, so this is the plain per-entity window and costs one
shuffle.  An entity with more than ``Scale.hot_entity_rows`` rows (one key
may hold a third of a 100 TB table) is cut into time segments at
approximate quantiles of its own timestamps; each segment is a separate
window partition, so the hot entity is spread over many tasks.

Exactness across cuts is restored in two ways:

* carries for unbounded frames (forward/backward fill): a per-segment
  summary, one row per hot segment, gives the last/first non-null value
  before/after each segment;
* halos for bounded frames (lag k, rolling n): the ``h`` rows before each
  hot segment are copied into it, flagged, used as frame context, then
  dropped.  Tied times can make a segment short, and a frame may be longer
  than a segment, so a halo is taken from as many segments as it needs.

Joins on the entity treat NULL as a key of its own, as the windows do.

The global variant (``entity=None``) is the same with one implicit entity.
"""

from __future__ import annotations

import datetime as _dt
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltwatch.config import DEFAULT_SCALE, Columns, Scale

SEG = "_vw_seg"
NSEG = "_vw_nseg"
HALO = "_vw_halo"
CUTS = "_vw_cuts"


@dataclass
class Layout:
    cfg: Columns
    scale: Scale
    n_entities: int
    segmented: bool
    hot: DataFrame | None = None  # (entity, CUTS) for hot entities only
    global_cuts: list | None = None  # cut points when entity is None
    n_segments: int = 1  # total hot segments (bounds carry/halo tables)
    max_cuts: int = 0

    # -- window specs ----------------------------------------------------
    def part_cols(self) -> list[str]:
        cols = [self.cfg.entity] if self.cfg.entity else []
        if self.segmented:
            cols.append(SEG)
        return cols

    def window(self, reverse: bool = False) -> Window:
        order = [F.col(c).desc() if reverse else F.col(c) for c in self.cfg.order()]
        return Window.partitionBy(*self.part_cols()).orderBy(*order)

    def entity_window(self) -> Window:
        """Whole-entity window, usable only when not segmented."""
        return Window.partitionBy(*([self.cfg.entity] if self.cfg.entity else []))

    # -- segment assignment ---------------------------------------------
    def assign(self, df: DataFrame) -> DataFrame:
        """Add SEG and NSEG columns (no-op columns when not segmented)."""
        if not self.segmented:
            return df
        t = F.col(self.cfg.time)
        if self.cfg.entity is None:
            dtype = df.schema[self.cfg.time].dataType
            cuts = F.array(*[typed_lit(v, dtype) for v in self.global_cuts])
            out = df.withColumn(CUTS, cuts)
        else:
            out = null_safe(df, F.broadcast(self.hot), [self.cfg.entity])
        out = out.withColumn(SEG, _bisect(F.col(CUTS), t, self._max_cuts()))
        out = out.withColumn(
            NSEG, F.when(F.col(CUTS).isNull(), F.lit(1)).otherwise(F.size(CUTS) + 1)
        )
        return out.drop(CUTS)

    def _max_cuts(self) -> int:
        if self.cfg.entity is None:
            return len(self.global_cuts)
        return max(1, self.max_cuts)

    def strip(self, df: DataFrame) -> DataFrame:
        return df.drop(SEG, NSEG, HALO)

    # -- halo for bounded frames ----------------------------------------
    def with_halo(self, df: DataFrame, h: int) -> DataFrame:
        """Union ``df`` (HALO false) with the ``h`` rows before every hot
        segment (HALO true); they come from as many segments as it takes."""
        if not self.segmented or h <= 0:
            return df.withColumn(HALO, F.lit(False))
        cfg = self.cfg
        ent = [cfg.entity] if cfg.entity else []
        desc = Window.partitionBy(*self.part_cols()).orderBy(
            *[F.col(c).desc() for c in cfg.order()]
        )
        # which segments need how many of a segment's last rows: all that
        # start less than h rows after its end (one row per hot segment)
        sizes = df.where(F.col(NSEG) > 1).groupBy(*ent, SEG).agg(F.count(F.lit(1)).alias("_vw_n"))
        place = Window.partitionBy(*ent).orderBy(SEG)
        begins = sizes.withColumn("_vw_at", F.sum("_vw_n").over(place) - F.col("_vw_n"))
        after = Window.partitionBy(*ent).orderBy("_vw_at")
        near = F.collect_list(F.struct(F.col(SEG).alias("seg"), F.col("_vw_at").alias("at")))
        goes = begins.select(
            *ent, F.lag(SEG).over(after).alias(SEG), F.col("_vw_at").alias("_vw_from"),
            near.over(after.rangeBetween(0, h - 1)).alias("_vw_near"))
        goes = goes.where(F.col(SEG).isNotNull()).select(*ent, SEG, "_vw_from", F.explode("_vw_near").alias("_vw_near"))
        goes = goes.select(*ent, SEG, F.col("_vw_near.seg").alias("_vw_to"),
                           (h - (F.col("_vw_near.at") - F.col("_vw_from"))).alias("_vw_take"))
        ends = (
            df.where(F.col(SEG) < F.col(NSEG) - 1)
            .withColumn("_vw_rrn", F.row_number().over(desc))
            .where(F.col("_vw_rrn") <= h)
        )
        tails = (
            null_safe(ends, goes, [*ent, SEG], "inner")
            .where(F.col("_vw_rrn") <= F.col("_vw_take"))
            .withColumn(SEG, F.col("_vw_to"))
            .drop("_vw_rrn", "_vw_to", "_vw_take")
            .withColumn(HALO, F.lit(True))
        )
        return df.withColumn(HALO, F.lit(False)).unionByName(tails)

    def drop_halo(self, df: DataFrame) -> DataFrame:
        return df.where(~F.col(HALO)).drop(HALO)

    # -- carries for unbounded frames -------------------------------------
    def carries(self, df: DataFrame, cols: list[str]) -> DataFrame | None:
        """Per hot segment: last non-null before it and first non-null after
        it, for every column.  One row per hot segment (bounded by
        ``n_segments``), so it is broadcast."""
        if not self.segmented:
            return None
        cfg = self.cfg
        key = F.struct(*[F.col(c) for c in cfg.order()])
        ent = [cfg.entity] if cfg.entity else []
        hot_rows = df.where(F.col(NSEG) > 1)
        aggs = []
        for c in cols:
            ordkey = F.when(F.col(c).isNotNull(), key)
            aggs.append(F.max_by(F.col(c), ordkey).alias(f"_vw_last_{c}"))
            aggs.append(F.min_by(F.col(c), ordkey).alias(f"_vw_first_{c}"))
        summ = hot_rows.groupBy(*ent, SEG).agg(*aggs)
        before = Window.partitionBy(*ent).orderBy(SEG).rowsBetween(Window.unboundedPreceding, -1)
        after = Window.partitionBy(*ent).orderBy(F.col(SEG).desc()).rowsBetween(Window.unboundedPreceding, -1)
        sel = [*ent, SEG]
        for c in cols:
            sel.append(F.last(f"_vw_last_{c}", True).over(before).alias(f"_vw_prev_{c}"))
            sel.append(F.last(f"_vw_first_{c}", True).over(after).alias(f"_vw_next_{c}"))
        return F.broadcast(summ.select(*sel))


def typed_lit(v, dtype) -> Column:
    """Literal of the column's own type (timestamps go through text so that
    no time zone is applied to a zone-less value)."""
    if isinstance(v, _dt.datetime):
        return F.lit(v.isoformat(sep=" ")).cast(dtype)
    return F.lit(v).cast(dtype)


def _bisect(cuts: Column, t: Column, max_len: int) -> Column:
    """Number of cut points <= t in a sorted array, by binary search.

    The steps are folded by a lambda, whose variable is one reference, so the
    expression has the same size for any number of cuts."""
    steps = [1 << j for j in range(max_len.bit_length(), -1, -1)]
    found = F.aggregate(
        F.array(*[F.lit(x) for x in steps]), F.lit(0),
        lambda idx, x: F.when(F.get(cuts, idx + x - 1) <= t, idx + x).otherwise(idx))
    return F.when(cuts.isNull(), F.lit(0)).otherwise(found)


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on equal keys where NULL equals NULL (an entity may be NULL);
    the result has the key columns of ``left``."""
    right = right.select(*[F.col(c).alias(f"_vw_k_{c}" if c in keys else c) for c in right.columns])
    on = F.lit(True)
    for c in keys:
        on = on & F.col(c).eqNullSafe(F.col(f"_vw_k_{c}"))
    return left.join(right, on, how).drop(*[f"_vw_k_{c}" for c in keys])


def plan_layout(df: DataFrame, cfg: Columns, scale: Scale = DEFAULT_SCALE) -> Layout:
    """Decide the layout from row counts per entity (one aggregate job).

    Only the list of hot entities and their cut points reach the driver; it
    is bounded by total_rows / segment_rows entries.
    """
    hot_rows = scale.hot_entity_rows
    seg_rows = min(hot_rows, scale.segment_rows)  # what a task sorts stays the same at any size
    acc = scale.approx_accuracy
    t = cfg.time
    if cfg.entity is None:
        n = df.count()
        if n <= hot_rows:
            return Layout(cfg, scale, 1, False)
        k = math.ceil(n / seg_rows)
        acc = max(acc, 4 * k)  # a cut is off by a quarter segment at most
        fr = [i / k for i in range(1, k)]
        cuts = df.agg(F.percentile_approx(t, fr, acc)).first()[0]
        cuts = sorted(set(c for c in cuts if c is not None))
        return Layout(cfg, scale, 1, True, global_cuts=cuts, n_segments=len(cuts) + 1,
                      max_cuts=len(cuts))

    e = cfg.entity
    counts = df.groupBy(e).agg(F.count(F.lit(1)).alias("_vw_n"))
    row = counts.agg(
        F.count(F.lit(1)).alias("n_entities"),
        F.collect_list(F.when(F.col("_vw_n") > hot_rows, F.struct(e, "_vw_n"))).alias("hot"),
    ).first()
    n_entities, hot_list = row["n_entities"], row["hot"]
    if not hot_list:
        return Layout(cfg, scale, n_entities, False)
    spark = df.sparkSession
    ks = {r[e]: math.ceil(r["_vw_n"] / seg_rows) for r in hot_list}
    big_k = max(ks.values())
    acc = max(acc, 4 * big_k)  # a cut is off by a quarter segment at most
    fr = [i / big_k for i in range(1, big_k)]
    hot_keys = spark.createDataFrame(
        [(key, k) for key, k in ks.items()], schema=df.select(e).schema.add("_vw_k", T.IntegerType())
    )
    # cut positions j*K/k_e for j=1..k_e-1 of a common K-quantile grid
    q = (
        null_safe(df, F.broadcast(hot_keys), [e], "inner")
        .groupBy(e, "_vw_k")
        .agg(F.percentile_approx(t, fr, acc).alias("_vw_all"))
        .select(
            e,
            F.array_sort(
                F.array_distinct(
                    F.transform(
                        F.sequence(F.lit(1), F.col("_vw_k") - 1),
                        lambda j: F.element_at(
                            "_vw_all", F.round(j * big_k / F.col("_vw_k")).cast("int")
                        ),
                    )
                )
            ).alias(CUTS),
        )
    ).collect()
    hot = spark.createDataFrame(q, schema=df.select(e).schema.add(CUTS, T.ArrayType(df.schema[t].dataType)))
    n_seg = sum(len(r[CUTS]) + 1 for r in q)
    max_cuts = max(len(r[CUTS]) for r in q)
    return Layout(cfg, scale, n_entities, True, hot=hot, n_segments=n_seg, max_cuts=max_cuts)


def prepare(df: DataFrame, cfg: Columns, layout: Layout | None, scale: Scale = DEFAULT_SCALE,
            need_layout: bool = True):
    """Return (layout, frame with segment columns, whether we added them).

    ``need_layout=False`` skips the row-count job for operators whose global
    variant is a plain aggregate (mean fill, clip)."""
    if layout is None:
        if need_layout:
            layout = plan_layout(df, cfg, scale)
        else:
            layout = Layout(cfg, scale, 1, False)
    if layout.segmented and SEG not in df.columns:
        return layout, layout.assign(df), True
    return layout, df, False


def finish(layout: Layout, df: DataFrame, added: bool) -> DataFrame:
    return layout.strip(df) if added else df


def running(df: DataFrame, cfg: Columns, sums: dict[str, Column], layout: Layout | None = None,
            scale: Scale = DEFAULT_SCALE, row_number: str | None = None) -> DataFrame:
    """Exact running totals in (entity, time, tie) order, ROWS frame from the
    first row of the entity to the current one, without putting a hot entity
    (or, for ``entity=None``, the whole table) into one task.

    Each segment computes its local running sum; a per-segment total table
    (one row per hot segment) gives the offset of all earlier segments.
    ``sums`` maps output name -> numeric expression; ``row_number`` adds a
    1-based position.
    """
    lay, d, added = prepare(df, cfg, layout, scale)
    w = lay.window().rowsBetween(Window.unboundedPreceding, 0)
    tmp = {f"_vw_x_{n}": e for n, e in sums.items()}
    if row_number:
        tmp[f"_vw_x_{row_number}"] = F.lit(1)
    d = d.withColumns(tmp)
    local = {n[len("_vw_x_"):]: F.sum(n).over(w) for n in tmp}
    if not lay.segmented:
        out = d.withColumns(local).drop(*tmp)
        return finish(lay, out, added)
    ent = [cfg.entity] if cfg.entity else []
    tot = d.where(F.col(NSEG) > 1).groupBy(*ent, SEG).agg(*[F.sum(n).alias(n) for n in tmp])
    pw = Window.partitionBy(*ent).orderBy(SEG).rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(*ent, SEG, *[F.coalesce(F.sum(n).over(pw), F.lit(0)).alias(f"_vw_o_{n}") for n in tmp])
    d = null_safe(d, F.broadcast(off), [*ent, SEG])
    out = d.withColumns({
        n[len("_vw_x_"):]: F.sum(n).over(w) + F.coalesce(F.col(f"_vw_o_{n}"), F.lit(0)) for n in tmp
    }).drop(*tmp, *[f"_vw_o_{n}" for n in tmp])
    return finish(lay, out, added)


def small_side(df: DataFrame, limit: int) -> DataFrame:
    """Broadcast ``df`` only when it is proven small: it is persisted (so
    the count is not recomputed) and counted; above ``limit`` rows the
    caller's join stays a shuffle join, which AQE splits when skewed."""
    from pyspark import StorageLevel

    d = df.persist(StorageLevel.MEMORY_AND_DISK)
    return F.broadcast(d) if d.count() <= limit else d


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage between stages that re-read their input several times
    (carries, quantile bands, halo tails): a reliable checkpoint into the
    session's shared checkpoint folder (never ``localCheckpoint``), so a
    lost executor re-reads the files instead of recomputing the stages.
    The partitioning is kept, so the next window by (entity, SEG) does not
    shuffle again."""
    from voltwatch.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
