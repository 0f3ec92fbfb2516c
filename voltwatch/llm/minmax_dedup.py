"""Operator 2: near-duplicates by min-max hashing.

Each permutation is evaluated once per shingle and gives two signature
values, its minimum and its maximum; ``BANDS`` bands of two permutations
(four values) make bucket keys.  A pair of Jaccard similarity 0.8 shares no
bucket with probability (1 - 0.8^4)^24, about 3 in a million; links are
confirmed on the full shingle sets.

Documents with equal shingle sets are one class, so copies cost one row.
In each bucket the class that shares most buckets overall is the pivot and
is compared with every other member; linked classes are contracted and the
pivot leaves.  Classes of buckets that then still hold several components go through an
exact prefix-filter join on their rarest shingles, across components only.
So a bucket never yields all its pairs, and texts that share no more than a
common passage yield none.

Defined cases: null or empty text has no shingles, links with nothing and
is its own component; fewer words than a shingle make one shingle; rows
with the same doc_id are linked by their own texts; a null doc_id takes the
smallest non-null doc_id of its component (null if there is none); an empty
table gives an empty result; extra columns are ignored (``near_duplicates``)
or kept (``keep_one``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltwatch.llm.common import doc_key, text_of, written
from voltwatch.llm.components import components
from voltwatch.llm.hashing import mix, word_hashes

BANDS = 24
#: Bytes of text whose words are hashed at once.
CHUNK = 1 << 19
#: Pivot rounds before the prefix filter takes what is left.
ROUNDS = 1

_RNG = np.random.default_rng(77)
TURN = _RNG.integers(0, 2**64, 2 * BANDS, dtype=np.uint64)
SCALE = _RNG.integers(0, 2**63, 2 * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLACE = _RNG.integers(0, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all texts one after another, their number per text)."""
    joined = b" ".join(t.lower() for t in texts)
    h, start, _ = word_hashes(joined)
    offsets = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    doc = np.searchsorted(offsets, start, "right") - 1
    per_doc = np.bincount(doc, minlength=len(texts))
    first = np.cumsum(per_doc) - per_doc
    size = np.minimum(per_doc, words)  # words of this text's shingles
    n = np.where(per_doc > 0, per_doc - size + 1, 0)
    owner = np.repeat(np.arange(len(texts)), n)
    at = first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    value = size[owner].astype(np.uint64)
    for k in range(words):
        inside = k < size[owner]
        value = value + np.where(inside, mix(h[np.where(inside, at + k, 0)] ^ PLACE[k % 8]) * PLACE[(k + 3) % 8], np.uint64(0)) if len(h) else value
    value = mix(value)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[new], np.bincount(owner[new], minlength=len(texts))


def chunked(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def signatures(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """(bucket keys, one row of BANDS per text; 16-byte hash of each set) of the non-empty sets."""
    full = counts > 0
    begin = (np.cumsum(counts) - counts)[full]
    keys = np.zeros((int(full.sum()), BANDS), np.uint64)
    for j in range(2 * BANDS):
        v = (values ^ TURN[j]) * SCALE[j]
        v ^= v >> np.uint64(32)
        low, high = np.minimum.reduceat(v, begin), np.maximum.reduceat(v, begin)
        band = keys[:, j // 2]
        band += mix(low + TURN[j]) * SCALE[j] + mix(high ^ SCALE[j])
    keys = mix(keys + np.arange(BANDS, dtype=np.uint64))
    a = np.add.reduceat(mix(values ^ TURN[0]), begin)
    b = np.bitwise_xor.reduceat(mix(values ^ TURN[1]), begin)
    return keys, [x.tobytes() for x in np.stack((a, b), axis=1)]


def signed_sets(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, kd, kt, n_shingles, cls (null without shingles), keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t.encode("utf-8", "surrogatepass") for t in b.column("text").to_pylist()]
            n, cls, keys = [], [], []
            for lo, hi in chunked(texts):
                values, counts = shingle_sets(texts[lo:hi], words)
                n += counts.tolist()
                rows, hashes = signatures(values, counts) if counts.any() else (np.zeros((0, BANDS), np.uint64), [])
                put = iter(zip(rows.view(np.int64), hashes, strict=True))
                for c in counts:
                    k, h = next(put) if c else (None, None)
                    keys.append(k)
                    cls.append(h)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("kd"), b.column("kt"), pa.array(n, pa.int64()), pa.array(cls, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "kd", "kt", "n_shingles", "cls", "keys"],
            )

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *doc_key(), text_of().alias("text"))
    return keyed.mapInArrow(run, "doc_id long, kd long, kt long, n_shingles long, cls binary, keys array<long>")


def confirmer(words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [[t.encode("utf-8", "surrogatepass") for t in b.column(c).to_pylist()] for c in ("ta", "tb")]
            ok = []
            for ta, tb in zip(*texts, strict=True):
                values, (n, m) = shingle_sets([ta, tb], words)
                both = len(np.intersect1d(values[:n], values[n:], assume_unique=True))
                ok.append(100 * both >= percent * (n + m - both))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(ok, pa.bool_())], names=["a", "b", "ok"])

    return run


def near_duplicates(docs: DataFrame, words: int = 4, percent: int = 80) -> DataFrame:
    """doc_id, kd, kt, n_shingles, component_id, kept, group (one value per component; null without shingles) per row of docs."""
    sets = written(signed_sets(docs, words), "sets")
    classes = written(
        sets.where("cls is not null").groupBy("cls").agg(
            F.min("doc_id").alias("doc_id"), F.min(F.struct("kd", "kt")).alias("rep"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys")
        ),
        "classes",
    )
    bucketed = classes.select("cls", "n", F.explode("keys").alias("key"))
    counts = written(bucketed.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"), "buckets")
    shared = written(bucketed.join(counts, "key"), "shared")
    fame = written(shared.groupBy("cls").agg(F.sum("m").alias("fame")), "fame")
    shared = written(shared.drop("m").join(fame, "cls"), "shared")
    reps = written(_texts(docs, classes.join(fame.select("cls"), "cls", "left_semi")), "texts")
    tested, comp = None, None
    for turn in range(ROUNDS + 1):
        state = _open_buckets(shared, comp)
        if state is None:
            break
        last = turn == ROUNDS
        if last:
            pairs = _prefix_pairs(state.select("cls", "comp").distinct(), reps, words, percent)
        else:
            who = state if comp is None else state.where("comp != largest")
            best = who.groupBy("key").agg(F.max(F.struct("fame", "cls", "comp")).alias("p"))
            pivots = written(best.select("key", F.col("p.cls").alias("x"), F.col("p.comp").alias("cx")), "pivots")
            pairs = state.join(pivots, "key").where("comp != cx").select(F.least("cls", "x").alias("a"), F.greatest("cls", "x").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        both = pairs.join(reps.select(F.col("cls").alias("a"), F.col("text").alias("ta")), "a")
        both = both.join(reps.select(F.col("cls").alias("b"), F.col("text").alias("tb")), "b")
        done = written(both.select("a", "b", "ta", "tb").mapInArrow(confirmer(words, percent), "a binary, b binary, ok boolean"), "confirmed")
        tested = done if tested is None else written(tested.unionByName(done), "tested")
        if not done.where("ok").isEmpty():
            comp = components(tested.where("ok"))
        if not last:
            shared = written(shared.join(pivots.select("key", F.col("x").alias("cls")), ["key", "cls"], "left_anti"), "shared")
    return _labelled(sets, classes, comp)


def _open_buckets(shared: DataFrame, comp: DataFrame | None) -> DataFrame | None:
    """Members of the buckets that hold several components, with comp and the bucket's largest; None if there are none."""
    if comp is None:
        state = shared.withColumn("comp", F.col("cls"))
    else:
        state = shared.join(comp.withColumnRenamed("v", "cls"), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    state = written(state, "state")
    parts = state.groupBy("key", "comp").agg(F.count("*").alias("m"))
    keys = parts.groupBy("key").agg(F.sum("m").alias("all"), F.max(F.struct("m", "comp")).alias("big")).where("big.m < all")
    keys = written(keys.select("key", F.col("big.comp").alias("largest")), "open")
    return None if keys.isEmpty() else written(state.join(keys, "key"), "state")


def _prefix_pairs(members: DataFrame, reps: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs of different components that may still be linked; loses none.

    Shingles are ordered by how many members hold them, rarest first.  Sets
    of similarity t share one of their first n - ceil(t n) + 1 shingles, and
    after the first one shared (at places i, j) enough must be left for the
    overlap wanted: min(n - i, m - j) >= t / (1 + t) (n + m).  A text that
    shares only a common passage has more shingles of its own than that, and
    drops out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t.encode("utf-8", "surrogatepass") for t in b.column("text").to_pylist()]
            parts = [shingle_sets(texts[lo:hi], words) for lo, hi in chunked(texts)]
            values, counts = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in (0, 1))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(values.view(np.int64), pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column("cls"), b.column("comp"), lists], names=["cls", "comp", "hs"])

    texts = reps.join(members, "cls").select("cls", "comp", "text")
    sets = written(texts.mapInArrow(run, "cls binary, comp binary, hs array<long>"), "member-sets")
    rows = sets.select("cls", F.explode("hs").alias("h"))
    often = written(rows.groupBy("h").agg(F.count("*").alias("m")).where("m > 1"), "shingles")
    held = rows.join(often, "h").groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("m", "h"))).alias("s"))
    held = held.join(sets.select("cls", "comp", F.size("hs").alias("n")), "cls")
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    taken = (prefix - (F.col("n") - F.size("s"))).cast("int")  # shingles that only one member holds come first
    held = held.withColumn("take", taken).where("take > 0")
    alone = F.col("n") - F.size("s")  # they have the first places of the order
    first = held.select("cls", "comp", "n", alone.alias("u"), F.posexplode(F.slice("s", F.lit(1), F.col("take"))).alias("i", "x"))
    first = written(first.select("cls", "comp", "n", F.col("x.h").alias("h"), (F.col("u") + F.col("i")).alias("i")), "prefixes")
    other = first.select("h", F.col("cls").alias("b"), F.col("comp").alias("other"), F.col("n").alias("nb"), F.col("i").alias("ib"))
    enough = (100 + percent) * F.least(F.col("n") - F.col("i"), F.col("nb") - F.col("ib")) >= percent * (F.col("n") + F.col("nb"))
    near = (F.col("comp") != F.col("other")) & (F.col("cls") < F.col("b")) & (100 * F.least("n", "nb") >= percent * F.greatest("n", "nb"))
    return first.join(other, "h").where(near & enough).select(F.col("cls").alias("a"), "b").distinct()


def _texts(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(cls, text) of each class's representative row."""
    reps = classes.select("cls", F.col("rep.kd").alias("kd"), F.col("rep.kt").alias("kt"))
    texts = docs.select(*doc_key(), text_of().alias("text")).join(reps, ["kd", "kt"])
    return texts.select("cls", "text").dropDuplicates(["cls"])


def _labelled(sets: DataFrame, classes: DataFrame, comp: DataFrame | None) -> DataFrame:
    own = classes.select("cls", "doc_id")
    if comp is not None:
        grouped = own.join(comp.withColumnRenamed("v", "cls"), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
        least = grouped.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
        own = grouped.join(least, "comp").select("cls", "component_id", F.col("comp").alias("group"))
    else:
        own = own.select("cls", F.col("doc_id").alias("component_id"), F.col("cls").alias("group"))
    out = sets.drop("keys").join(written(own, "component-ids"), "cls", "left")
    label = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "kd", "kt", "n_shingles", label.alias("component_id"), F.col("doc_id").eqNullSafe(label).alias("kept"), "group")


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """docs with one document of each component, that of the least doc_id (null last); copies of one row are reduced to one too."""
    found = near_duplicates(docs, words, percent)
    least = F.min(F.struct(F.col("doc_id").isNull(), "kd", "kt")).alias("x")
    alone = found.where("group is null").select("kd", "kt").distinct()
    kept = found.where("group is not null").groupBy("group").agg(least).select("x.kd", "x.kt").unionByName(alone)
    rows = docs.select(F.struct("*").alias("row"), *doc_key()).join(kept, ["kd", "kt"], "left_semi")
    return rows.dropDuplicates(["kd", "kt"]).select("row.*")


def op2_minmax_dedup(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")
