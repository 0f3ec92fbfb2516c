"""Operator 11: importance resampling towards a target distribution.

Every text becomes the bucket numbers of its words (unsigned crc32 modulo
``BUCKETS``), packed two bytes each and written once.  The bucket counts of
the corpus and of the target texts are two arrays of fixed size, and so is the
array of gains that scores a document by plain indexing.  A document's weight
gets Gumbel noise of its doc_id, which makes the highest scores a sample
without replacement in proportion to the weights.

The draw needs no global sort of all documents.  ``cutoff`` finds the exact
last drawn key by weighted median of medians: every chunk of a partition
reports its median and size, the weighted median of those is the pivot, and
at least a quarter of the remaining keys is discarded per round.  Only
medians and counts reach the driver.  Then the winners alone are sorted.

Keys are (score descending, doc_id, n_features, place in the written table),
so they are unique and rows that tie on the first three give equal results.

Defined cases: null or empty text has no features (weight 0, never drawn); a
null doc_id draws its noise from ``2024:`` alone and loses ties; repeated rows
are drawn one by one; an empty table gives an empty result; with an empty
target every gain is that of t = T = 0; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltwatch.llm.common import documents, text_of, written

BUCKETS, SEED, PERCENT, MIN_WORDS = 10_000, 2024, 10, 20
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Keys of which one median is taken, and keys that the driver sorts at the end of the search.
CHUNK, LAST = 1 << 20, 4096
#: A doc_id that sorts behind all others.
NO_ID_LAST = 2**63 - 1
KEY = ["low", "id", "n", "place"]


def buckets_of(text: bytes) -> np.ndarray:
    """Bucket number of every word of the text, in order."""
    words = WORD.findall(text.lower())
    return (np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % BUCKETS).astype("<u2")


def bucketed(docs: DataFrame) -> DataFrame:
    """(doc_id, buckets): the packed bucket numbers of each text."""

    def run(batches):
        for b in batches:
            packed = [buckets_of(t).tobytes() for t in b.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(packed, pa.binary())], names=["doc_id", "buckets"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(run, "doc_id long, buckets binary")


def bucket_counts(packed: DataFrame) -> np.ndarray:
    """How often each bucket occurs; at most BUCKETS rows leave a task and reach the driver."""

    def run(batches):
        total = np.zeros(BUCKETS, np.int64)
        for b in batches:
            total += np.bincount(np.frombuffer(b"".join(b.column("buckets").to_pylist()), "<u2"), minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["bucket", "n"])

    found = packed.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for bucket, n in found.collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed bucket frequencies, floored."""
    big_s, big_t = float(source.sum()) + BUCKETS, float(target.sum()) + BUCKETS
    ratio = [((t + 1.0) * big_s) / ((s + 1.0) * big_t) for s, t in zip(source.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def noise(h: int) -> int:
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(packed: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """(doc_id, n, weight, score) of every row of ``bucketed``."""

    def run(batches):
        for b in batches:
            rows = []
            for x, h in zip(b.column("buckets"), b.column("h").to_pylist(), strict=True):
                own = np.frombuffer(x.as_py(), "<u2")
                weight = int(gain[own].sum()) // len(own) if len(own) else 0
                rows.append((len(own), weight, weight + noise(h)))
            n, weight, score = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(weight, pa.int64()), pa.array(score, pa.int64())],
                names=["doc_id", "n", "weight", "score"],
            )

    own = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(own, 256), 1, 8), 16, 10).cast("long")
    return packed.withColumn("h", h).mapInArrow(run, "doc_id long, n long, weight long, score long")


def _side(keys: list[np.ndarray], pivot: tuple[int, ...]) -> np.ndarray:
    """-1, 0 or 1 for keys before, at and behind the pivot."""
    out = np.zeros(len(keys[0]), np.int8)
    for k, p in zip(keys, pivot, strict=True):
        open_ = out == 0
        out[open_ & (k < p)] = -1
        out[open_ & (k > p)] = 1
    return out


def before(pivot: tuple[int, ...]) -> Column:
    """The same as a column expression over ``KEY``."""
    out = F.lit(False)
    for name, p in reversed(list(zip(KEY, pivot, strict=True))):
        out = (F.col(name) < p) | ((F.col(name) == p) & out)
    return out


def at(pivot: tuple[int, ...]) -> Column:
    out = F.lit(True)
    for name, p in zip(KEY, pivot, strict=True):
        out = out & (F.col(name) == p)
    return out


def _halves(pivot: tuple[int, ...] | None, chunk: int):
    """A task: size and median of the keys before and behind the pivot, per chunk of its rows."""

    def report(keys: list[np.ndarray]) -> Iterator[tuple[int, ...]]:
        sides = np.ones(len(keys[0]), np.int8) if pivot is None else _side(keys, pivot)
        for side in (-1, 1):
            part = [k[sides == side] for k in keys]
            size = len(part[0])
            if size:
                median = np.lexsort(part[::-1])[(size - 1) // 2]
                yield (side, size, *(int(p[median]) for p in part))

    def run(batches):
        held, size = [], 0
        for b in batches:
            for at in range(0, b.num_rows, chunk):
                part = b.slice(at, chunk)
                if size + part.num_rows > chunk:
                    yield frame(held)
                    held, size = [], 0
                held.append([part.column(k).to_numpy() for k in KEY])
                size += part.num_rows
        if held:
            yield frame(held)

    def frame(held):
        rows = list(report([np.concatenate(k) for k in zip(*held, strict=True)]))
        cols = list(zip(*rows, strict=True)) or [()] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["side", "size", *KEY])

    return run


def weighted_median(rows: list[tuple[int, tuple[int, ...]]]) -> tuple[int, ...]:
    """The least median such that the chunks up to it hold at least half of the keys."""
    rows = sorted(rows, key=lambda r: r[1])
    half, seen = sum(n for n, _ in rows) / 2, 0
    for n, median in rows:
        seen += n
        if seen >= half:
            return median
    raise ValueError("no keys")


def cutoff(keys: DataFrame, k: int, chunk: int = CHUNK, last: int = LAST) -> tuple[int, ...]:
    """The k-th smallest of the unique keys (k from 1 to their number).

    Each round counts the keys before the pivot and takes the medians of both
    sides in one job; the side without the k-th key goes.  The keys that are
    left are written anew once they are a quarter of those last written, so
    all rounds together read a bounded multiple of the keys.
    """
    schema = ", ".join(f"{c} long" for c in ["side", "size", *KEY])
    keys, pivot, stored = keys.select(*KEY), None, 0
    while True:
        found = [(r[0], r[1], tuple(r[2:])) for r in keys.mapInArrow(_halves(pivot, chunk), schema).collect()]
        side = 1
        if pivot is not None:
            first = sum(n for s, n, _ in found if s < 0)
            if k == first + 1:
                return pivot
            side = -1 if k <= first else 1
            keys = keys.where(before(pivot) if side < 0 else ~before(pivot) & ~at(pivot))
            k -= 0 if side < 0 else first + 1
        rest = [(n, median) for s, n, median in found if s == side]
        size = sum(n for n, _ in rest)
        stored = stored or size
        if size <= last:
            return sorted(tuple(r) for r in keys.collect())[k - 1]
        if size * 4 <= stored:
            keys, stored = written(keys, "remaining-keys"), size
        pivot = weighted_median(rest)


def ranked(winners: DataFrame) -> DataFrame:
    """winners with ``rank`` 1, 2, 3... in key order: range partitions sorted, numbered, offset."""
    ordered = winners.repartitionByRange(*KEY).sortWithinPartitions(*KEY)
    placed = written(ordered.withColumn("at", F.monotonically_increasing_id()), "winners")
    part = F.shiftright("at", 33)
    local = F.col("at").bitwiseAND((1 << 33) - 1) + 1
    counts = {r[0]: r[1] for r in placed.groupBy(part.alias("part")).agg(F.max(local)).collect()}  # one row a partition
    start, rows = 0, []
    for p in sorted(counts):
        rows.append((p, start))
        start += counts[p]
    if not rows:
        return placed.withColumn("rank", local).drop("at")
    offsets = placed.sparkSession.createDataFrame(rows, "part long, start long")
    return placed.withColumn("part", part).join(F.broadcast(offsets), "part").withColumn("rank", local + F.col("start")).drop("at", "part", "start")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
             chunk: int = CHUNK, last: int = LAST) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; rank is null where it is not drawn.

    ``target`` is any table with a ``text`` column.
    """
    packed = written(bucketed(docs), "buckets")
    wanted = bucket_counts(bucketed(target.select(F.lit(None).cast("long").alias("doc_id"), "text")))
    rows = scored(packed, gains(bucket_counts(packed), wanted), seed)
    key = [(-F.col("score")).alias("low"), F.coalesce("doc_id", F.lit(NO_ID_LAST)).alias("id"), "n", F.monotonically_increasing_id().alias("place")]
    all_rows = written(rows.select("doc_id", "weight", "score", *key), "scores")
    able = F.col("n") >= min_words
    k = percent * all_rows.where(able).count() // 100
    cols = ["doc_id", F.col("n").alias("n_features"), "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if k == 0:
        return all_rows.select(*cols, none)
    worst = cutoff(all_rows.where(able), k, chunk, last)
    drawn = able & (before(worst) | at(worst))
    return ranked(all_rows.where(drawn)).select(*cols, "rank").unionByName(all_rows.where(~drawn).select(*cols, none))


def op11_target_resampling(spark, sf_dir: str) -> DataFrame:
    return resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
