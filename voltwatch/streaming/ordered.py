"""Per-entity delta and rolling features on a stream that arrives out of order.

A stateful processor (``transformWithState``) keeps two states per bucket of
entities: a list of readings that wait, and the last max(window) - 1 readings of
each entity already emitted.  Entities are dealt to buckets by hash, so that the
cost of a call, of its states and its timer is paid once for many entities and
features are computed for all of a bucket's rows together.  A reading waits until the watermark has passed it; an event-time
timer then emits everything that is due, in (time, tie) order, with frames
over the tail.  So any arrival order within the watermark gives the rows of
the batch operators.  A reading older than the watermark on arrival is not
lost: it comes out at once with ``late`` true and no features, and goes to a
side output, so emitted + late = input.

State is bounded by the readings within the watermark's delay plus the tail;
with ``ttl_s`` an entity that is silent for so long loses its tail.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from voltwatch.operators.features import delta_name, rolling_name

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def feature_names(cols, windows, stats, k: int) -> list[str]:
    return [delta_name(k, c) for c in cols] + [rolling_name(s, n, c) for c in cols for n in windows for s in stats]


def out_schema(schema: T.StructType, names: list[str]) -> T.StructType:
    extra = [T.StructField(c, T.DoubleType()) for c in names] + [T.StructField("late", T.BooleanType())]
    return T.StructType(schema.fields + extra)


def _pack(df: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.Table.from_pandas(df, preserve_index=False)
    with pa.ipc.new_stream(sink, table.schema) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpack(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_pandas()


def _stat(name: str, x: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """A rolling statistic of every row of x (its frame, newest first) over the valid cells; NaN without enough of them."""
    n = valid.sum(1)
    if name == "count":
        return n.astype(float)
    if name in ("min", "max"):
        fill, least = (np.inf, np.min) if name == "min" else (-np.inf, np.max)
        return np.where(n > 0, least(np.where(valid, x, fill), 1), np.nan)
    if name == "median":
        s = np.sort(np.where(valid, x, np.inf), 1)
        rows, top = np.arange(len(x)), np.maximum(n, 1)
        return np.where(n > 0, (s[rows, (top - 1) // 2] + s[rows, top // 2]) / 2, np.nan)
    total = np.where(valid, x, 0.0).sum(1)
    if name == "sum":
        return np.where(n > 0, total, np.nan)
    mean = total / np.maximum(n, 1)
    if name == "mean":
        return np.where(n > 0, mean, np.nan)
    var = (np.where(valid, x - mean[:, None], 0.0) ** 2).sum(1) / np.maximum(n - 1, 1)
    return np.where(n > 1, np.sqrt(var) if name == "std" else var, np.nan)


#: Statistics of ``_stat``; a registered one of another name is asked of pandas.
OWN_STATS = ("mean", "std", "var", "min", "max", "sum", "count", "median")
#: Rows whose frames are laid out at once.
ROWS = 4096


class OrderedFeatures(StatefulProcessor):
    """See the module text.  ``time`` is a wall clock without zone, read as UTC like the watermark."""

    def __init__(self, entity: str, time: str, tie: str | None, cols: list[str], windows, stats, k: int, names: list[str], own: list[str], ttl_s: int | None):
        self.entity, self.time, self.tie, self.cols, self.windows, self.stats, self.k = entity, time, tie, cols, tuple(windows), tuple(stats), k
        self.names, self.own, self.ttl_ms = names, own, ttl_s * 1000 if ttl_s else None
        self.tail_rows = max(max(windows) - 1, k)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        packed = T.StructType([T.StructField("rows", T.BinaryType())])
        self.waiting = handle.getListState("waiting", packed)
        self.tail = handle.getValueState("tail", packed)

    def close(self) -> None:
        pass

    def micros(self, df: pd.DataFrame) -> np.ndarray:
        """Event times; a row without a time sorts before all others."""
        return df[self.time].to_numpy("datetime64[us]").astype("int64")

    def remind(self, us: int) -> None:
        """Be called once the watermark has passed this time."""
        self.handle.registerTimer(max(1, int(us) // 1000 + 1))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        first = None
        for df in rows:
            df = df[self.own]
            us = self.micros(df)
            late = us < passed * 1000 if passed > 0 else np.zeros(len(df), bool)
            if late.any():
                yield df[late].assign(**dict.fromkeys(self.names, np.nan), late=True)
            if not late.all():
                self.waiting.appendValue((_pack(df[~late]),))
                least = int(us[~late].min())
                first = least if first is None else min(first, least)
        if first is not None:
            self.remind(first)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        parts = [_unpack(r[0]) for r in self.waiting.get()] if self.waiting.exists() else []
        old = _unpack(self.tail.get()[0]) if self.tail.exists() else None
        tail = old
        if parts:
            df = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
            us = self.micros(df)
            due = us < passed * 1000
            if due.any():
                self.waiting.clear()
                if not due.all():
                    self.waiting.appendValue((_pack(df[~due]),))
                    self.remind(us[~due].min())
                out, tail = self.emit(df[due], old)
                yield out
        if tail is not None:
            tail = self.expire(tail, passed)
            if len(tail) == 0:
                self.tail.clear()
            elif tail is not old:
                self.tail.update((_pack(tail),))

    def expire(self, tail: pd.DataFrame, passed: int) -> pd.DataFrame:
        """The tails without those of entities that have been silent for the time to live."""
        if not self.ttl_ms or not len(tail):
            return tail
        code = pd.factorize(tail[self.entity], use_na_sentinel=False)[0]
        last = np.flatnonzero(np.append(code[1:] != code[:-1], True))  # an entity's rows stand together, in order
        end = self.micros(tail)[last] // 1000 + self.ttl_ms
        kept = end >= passed
        if kept.any():
            self.handle.registerTimer(max(1, int(end[kept].min()) + 1))
        return tail if kept.all() else tail[np.isin(code, code[last[kept]])]

    def emit(self, df: pd.DataFrame, old: pd.DataFrame | None) -> tuple[pd.DataFrame, pd.DataFrame]:
        """The due rows in order, with their features over their entity's tail, and the tails to keep."""
        new = df.sort_values([self.time, *([self.tie] if self.tie else [])], kind="mergesort", na_position="first")
        held = [self.entity, self.time, *self.cols]
        rows = new[held] if old is None else pd.concat([old, new[held]], ignore_index=True)
        before = 0 if old is None else len(old)
        code = pd.factorize(rows[self.entity], use_na_sentinel=False)[0]
        order = np.argsort(code, kind="stable")  # by entity, its tail first
        rows, code = rows.iloc[order], code[order]
        head = np.append(True, code[1:] != code[:-1])
        place = np.arange(len(rows))
        if self.ttl_ms:  # a silence beyond the time to live starts afresh, wherever the micro-batches are cut
            silent = np.diff(self.micros(rows) // 1000, prepend=0) > self.ttl_ms
            begins = head | silent
        else:
            begins = head
        back = place - np.maximum.accumulate(np.where(begins, place, 0))  # rows in front of a row
        at = np.flatnonzero(order >= before)
        found = {}
        for c in self.cols:
            self.frames(c, rows[c].to_numpy("float64", na_value=np.nan), begins, back, at, found)
        out = new.iloc[order[at] - before].assign(**{n: found[n] for n in self.names}, late=False)
        left = np.append(np.flatnonzero(head)[1:], len(rows))[np.cumsum(head) - 1] - place  # rows from a row to its entity's last
        return out, rows[left <= self.tail_rows]

    def frames(self, c: str, x: np.ndarray, begins: np.ndarray, back: np.ndarray, at: np.ndarray, found: dict) -> None:
        """Features of the rows ``at``, which look back over at most ``back`` rows; NULL counts as 0."""
        lag = np.where(back[at] >= self.k, x[at] - x[np.maximum(at - self.k, 0)], np.nan)
        found[delta_name(self.k, c)] = np.nan_to_num(lag, nan=0.0, posinf=np.inf, neginf=-np.inf)
        for n in self.windows:
            for s in self.stats:
                found[rolling_name(s, n, c)] = np.zeros(len(at))
        step = np.arange(max(self.windows))
        for lo in range(0, len(at), ROWS):
            some = at[lo : lo + ROWS]
            frame = x[np.maximum(some[:, None] - step, 0)]
            valid = (step <= back[some][:, None]) & np.isfinite(frame)
            for n in self.windows:
                for s in self.stats:
                    if s in OWN_STATS:
                        got = _stat(s, frame[:, :n], valid[:, :n])
                        found[rolling_name(s, n, c)][lo : lo + ROWS] = np.nan_to_num(got, nan=0.0, posinf=np.inf, neginf=-np.inf)
        for n in self.windows:
            for s in self.stats:
                if s not in OWN_STATS:
                    part = pd.Series(x).groupby(np.cumsum(begins)).rolling(window=n, min_periods=1).agg(s)
                    found[rolling_name(s, n, c)] = part.fillna(0.0).to_numpy()[at]
