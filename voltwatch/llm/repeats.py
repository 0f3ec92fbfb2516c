"""Finding every window of fixed length that occurs twice in a corpus.

Shared by the two substring operators, which differ in what a symbol is
(byte, word) and in the index that settles the doubtful blocks.

0. Rows that agree in id and text are one row with a weight n (``one_each``),
   so copies of a row never meet each other below; callers join the marks back
   to all of them.
1. Each document's windows are dealt into runs by content-defined anchors
   (``hashing.anchors``): equal windows get the same anchor key.  Only runs
   whose key occurs twice go on; that is one aggregate and one join.
2. A run whose whole content (128-bit hash) occurs twice is a repeat.
3. The rest is doubtful: same anchor, other surroundings.  Their blocks are
   fetched and put into per-key groups, with one copy of each repeated
   content; an index of the group settles them.
4. A group of more than ``HOT_BLOCKS`` different blocks is first split: the
   range of possible window starts before the anchor is halved, blocks are
   trimmed to each half, and the half is keyed anew by the content that all
   its windows share.  Blocks that part there lose their key's company,
   blocks that agree become one.  After log2(range) rounds a half holds one
   window, whose group is one block, so the splitting ends and no group is
   ever collected beyond the bound.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltwatch.llm.common import doc_key, text_of, written
from voltwatch.llm.hashing import anchors

#: Different blocks of one group that an index takes at once.
HOT_BLOCKS = 256
#: Symbols of the blocks put into one index (whole groups, at least one).
INDEX_SYMBOLS = 1 << 18

RUNS = "kd long, kt long, s1 int, s2 int, at int, key long, c1 long, c2 long, n long"
BLOCKS = "kd long, kt long, s1 int, s2 int, at int, lo int, hi int, n long, key long, c1 long, c2 long, block binary"
MARKS = "kd long, kt long, a int, b int"


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _content(buf) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(buf)
    return _signed(h >> 64), _signed(h & (2**64 - 1))


class Windows:
    """What a symbol is and how long a window is.

    ``symbols(text)`` gives (uint64 per symbol for the anchors, the symbols'
    bytes, bytes per symbol).
    """

    def __init__(self, length: int, k: int, symbols: Callable[[str], tuple[np.ndarray, bytes, int]]):
        self.length, self.k, self.symbols = length, k, symbols

    def runs(self, docs: DataFrame) -> DataFrame:
        length, k, symbols = self.length, self.k, self.symbols

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                cols: list[list] = [[] for _ in range(9)]
                for kd, kt, n, text in zip(*(b.column(c).to_pylist() for c in ("kd", "kt", "n")), b.column("text"), strict=True):
                    sym, buf, width = symbols(text.as_py())
                    key, at, first, last = anchors(sym, length, k)
                    view = memoryview(buf)
                    found = [_content(view[s * width : (e + length) * width]) for s, e in zip(first.tolist(), last.tolist(), strict=True)]
                    cols[0] += [kd] * len(found)
                    cols[1] += [kt] * len(found)
                    for c, x in zip(cols[2:6], (first, last, at, key.view(np.int64)), strict=True):
                        c.append(x)
                    cols[6] += [c for c, _ in found]
                    cols[7] += [c for _, c in found]
                    cols[8] += [n] * len(found)
                join = lambda xs, t: np.concatenate(xs).astype(t) if xs else np.zeros(0, t)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                        *(pa.array(join(cols[i], np.int32), pa.int32()) for i in (2, 3, 4)),
                        pa.array(join(cols[5], np.int64), pa.int64()), *(pa.array(cols[i], pa.int64()) for i in (6, 7, 8)),
                    ],
                    names=[c.split()[0] for c in RUNS.split(", ")],
                )

        return docs.mapInArrow(run, RUNS)

    def blocks(self, docs: DataFrame, wanted: DataFrame) -> DataFrame:
        """The wanted runs (with columns n, key, c1, c2) with their content."""
        span, symbols, length = self.length - self.k + 1, self.symbols, self.length
        lists = wanted.groupBy("kd", "kt").agg(F.collect_list(F.struct("s1", "s2", "at", "n", "key", "c1", "c2")).alias("runs"))

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = []
                for kd, kt, text, runs in zip(*(b.column(c).to_pylist() for c in ("kd", "kt", "text", "runs")), strict=True):
                    _, buf, width = symbols(text)
                    for r in runs:
                        block = buf[r["s1"] * width : (r["s2"] + length) * width]
                        rows.append({**r, "kd": kd, "kt": kt, "lo": 0, "hi": span - 1, "block": block})
                yield _batch(rows, BLOCKS)

        return docs.join(lists, ["kd", "kt"]).mapInArrow(cut, BLOCKS)

    def halves(self, rows: DataFrame, width: int) -> DataFrame:
        """Every block trimmed to both halves of its range of starts, keyed by the half's common content."""
        length = self.length

        def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                out = []
                for r in b.to_pylist():
                    mid = (r["lo"] + r["hi"]) // 2
                    for lo, hi in ((r["lo"], mid), (mid + 1, r["hi"])):
                        # a window that starts x symbols before the anchor: lo <= x <= hi
                        s1, s2 = max(r["s1"], r["at"] - hi), min(r["s2"], r["at"] - lo)
                        if s1 > s2 or lo > hi:
                            continue
                        block = r["block"][(s1 - r["s1"]) * width : (s2 + length - r["s1"]) * width]
                        core = block[(r["at"] - lo - s1) * width : (r["at"] - hi + length - s1) * width]
                        c1, c2 = _content(block)
                        key = _content(core + f"{lo},{hi},{r['key']}".encode())[0]
                        out.append(r | {"s1": s1, "s2": s2, "lo": lo, "hi": hi, "key": key, "c1": c1, "c2": c2, "block": block})
                yield _batch(out, BLOCKS)

        return rows.mapInArrow(split, BLOCKS)


def _batch(rows: list[dict], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kinds[t]) for c, t in fields], names=[c for c, _ in fields])


def _marks(rows: DataFrame, length: int) -> DataFrame:
    return rows.select("kd", "kt", F.col("s1").alias("a"), (F.col("s2") + length).cast("int").alias("b"))


def _sorted_out(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(rows of repeated content, rows that need company: doubtful ones and one of each repeated content).

    rows have a weight n.  The key sizes are written first, so that the join
    with them has two plain exchanges and AQE can split a hot key.
    """
    sizes = written(
        rows.groupBy("key").agg(
            F.sum("n").alias("all"), F.min("c1").alias("l1"), F.max("c1").alias("h1"), F.min("c2").alias("l2"), F.max("c2").alias("h2")
        ).where(F.col("all") > 1).select("key", ((F.col("l1") == F.col("h1")) & (F.col("l2") == F.col("h2"))).alias("alike")),
        f"{name}-keys",
    )
    shared = written(rows.join(sizes, "key"), f"{name}-shared")
    return shared.where("alike").drop("alike"), shared.where(~F.col("alike")).drop("alike")


def one_each(docs: DataFrame) -> DataFrame:
    """(kd, kt, text, n): one row for all rows that agree in kd and kt, n of them.

    Without copies the texts are not moved.  Copies are written before they are
    grouped, so that they are combined where they lie and a hot one is spread.
    """
    docs = docs.select("kd", "kt", "text")
    copies = written(docs.groupBy("kd", "kt").agg(F.count("*").alias("n")).where("n > 1"), "copies")
    if copies.isEmpty():
        return docs.withColumn("n", F.lit(1).cast("long"))
    copied = written(docs.join(copies, ["kd", "kt"]), "copied")
    one = copied.groupBy("kd", "kt").agg(F.any_value("text").alias("text"), F.max("n").alias("n"))
    rest = docs.join(copies, ["kd", "kt"], "left_anti").withColumn("n", F.lit(1).cast("long"))
    return written(rest.unionByName(one), "single")


def find_repeats(docs: DataFrame, windows: Windows, width: int, settle: Callable) -> DataFrame:
    """Marks (kd, kt, a, b): symbols a..b-1 of the document are covered by repeated windows.

    ``settle(blocks)`` takes a list of symbol blocks (bytes) and gives, for
    each, the starts at which a window occurs elsewhere among them, as runs.
    """
    length = windows.length
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = one_each(docs)
    runs = written(windows.runs(docs), "runs")
    alike, mixed = _sorted_out(runs, "runs")
    marks = [_marks(alike, length)]
    same, doubt, one = _by_content(mixed, "mixed")
    marks.append(_marks(same, length))
    rows = written(windows.blocks(docs, doubt.unionByName(one)), "blocks")
    while True:
        sizes = written(rows.groupBy("key").agg(F.count("*").alias("m")).where(F.col("m") > HOT_BLOCKS), "hot")
        small = rows.join(sizes, "key", "left_anti")
        marks.append(small.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(settler(settle, length), MARKS))
        if sizes.isEmpty():
            break
        halves = written(windows.halves(rows.join(sizes, "key", "left_semi"), width), "halves")
        alike, mixed = _sorted_out(halves, "halves")
        marks.append(_marks(alike.where("n = 1"), length))
        same, doubt, one = _by_content(mixed, "mixed")
        marks.append(_marks(same.where("n = 1"), length))
        rows = written(doubt.unionByName(one), "blocks")
    out = marks[0]
    for m in marks[1:]:
        out = out.unionByName(m)
    return out


def _by_content(mixed: DataFrame, name: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of rows in keys with different contents: (repeated rows, rows that stand alone, one row of each repeated content).

    The representative is one row, as no two rows share (kd, kt, s1).  It has n = 2, so it counts as repeated from then on and
    is never marked itself.
    """
    by = ["key", "c1", "c2"]
    some = F.min(F.struct("kd", "kt", "s1"))
    counts = written(mixed.groupBy(*by).agg(F.sum("n").alias("all"), some.alias("rep")).where(F.col("all") > 1), f"{name}-contents")
    joined = written(mixed.join(counts, by, "left"), f"{name}-sorted")
    same = joined.where(F.col("all").isNotNull()).drop("all", "rep")
    doubt = joined.where(F.col("all").isNull()).drop("all", "rep")
    is_rep = (F.col("kd") == F.col("rep.kd")) & (F.col("kt") == F.col("rep.kt")) & (F.col("s1") == F.col("rep.s1"))
    one = joined.where(F.col("all").isNotNull() & is_rep).drop("all", "rep").withColumn("n", F.lit(2).cast("long"))
    return same, doubt, one


def settler(settle: Callable, length: int):
    """Whole groups, in key order, into indexes of at most INDEX_SYMBOLS (or one group)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[dict] = []
        size = 0
        last = None

        def flush():
            out = []
            for r, found in zip(pending, settle([r["block"] for r in pending]), strict=True):
                if r["n"] == 1:
                    out += [{"kd": r["kd"], "kt": r["kt"], "a": r["s1"] + s, "b": r["s1"] + e + length} for s, e in found]
            pending.clear()
            return _batch(out, MARKS)

        for b in batches:
            for r in b.to_pylist():
                if r["key"] != last and size >= INDEX_SYMBOLS:
                    yield flush()
                    size = 0
                last = r["key"]
                pending.append(r)
                size += len(r["block"])
        if pending:
            yield flush()

    return run


def starts_to_runs(starts: np.ndarray) -> list[tuple[int, int]]:
    """Sorted places as (first, last) of consecutive ones."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    first = np.concatenate((starts[:1], starts[cut + 1]))
    last = np.concatenate((starts[cut], starts[-1:]))
    return list(zip(first.tolist(), last.tolist(), strict=True))


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *doc_key(), text_of().alias("text"))


def merged(spans: list) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching [a, b), given in order of a."""
    out: list[list[int]] = []
    for x in spans:
        if out and x["a"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], x["b"])
        else:
            out.append([x["a"], x["b"]])
    return [(a, b) for a, b in out]


def with_spans(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """docs (with kd, kt) plus ``spans``, the sorted marks of each (null: none)."""
    lists = marks.groupBy("kd", "kt").agg(F.sort_array(F.collect_set(F.struct("a", "b"))).alias("spans"))
    return docs.join(lists, ["kd", "kt"], "left")
