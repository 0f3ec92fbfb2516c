"""Operator 8: exact top-k search by BM25 with block-max WAND pruning.

Every text is packed once into its distinct terms and counts, and dealt to
shards of about ``SHARD_BYTES``; a shard's inverted index (postings in
document order, with the largest impact of every term and of every block of
documents) is built once and written.  Queries are taken in blocks of about
``QUERY_BYTES``: a block is sent to every shard's task, so neither documents
nor queries are multiplied in a shuffle.  Term statistics are counted over
the whole corpus, so the shards' lists merge exactly; ties go to the smaller
doc_id.

Per query and shard, the terms are ordered by their largest possible share.
The pivot is the first term from which on all remaining shares together stay
below the k-th best score: a document without a term in front of the pivot
cannot enter the list, so postings behind the pivot, the longest ones, are
never walked, only looked up in blocks that can still hold a result.  Where
over a quarter of the blocks can, looking up costs more than adding up whole
lists, which is then done for the next ``TOGETHER`` queries at once, before
pruning is tried again; the result is the same.

A task searches its shards one after another and keeps one list per query: its
k-th score is what a document of the next shard must reach.  Tasks are a fixed
number per core, so the lists they return grow with the queries only.

Queries are the documents whose doc_id is divisible by ``EVERY``, by their
whole text, against all rows (themselves included).

Defined cases: null or empty text matches nothing and asks for nothing; rows
with a null doc_id are searched, never queries; repeated rows are separate
results; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import contextlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltwatch.llm.common import NO_ID, text_of, written
from voltwatch.llm.hashing import word_hashes

K, EVERY = 10, 50
K1, B = 1.2, 0.75
#: Bytes of packed terms of a shard, and of packed queries of a block, about.
SHARD_BYTES, QUERY_BYTES = 5 << 20, 8 << 20
#: Documents of an index block, and blocks that are scored first.
BLOCK, FIRST = 64, 4
#: Share of blocks beyond which all postings are added up instead, every how many queries
#: pruning is tried again after that, and the length from which a list is added on its own.
MANY, RETRY, LONG = 0.25, 16, 512
#: Queries whose lists are added up at once, and cells (queries x documents) and postings of a step.
TOGETHER, CELLS, STEP = 256, 1 << 20, 1 << 17
#: A term of over 1/``DENSE`` of a shard's documents is a row of a table, up to so many rows.
DENSE, ROWS = 12, 512
#: Tasks per core that search the index.
TASKS = 2
#: Scores agree if they agree to this many digits behind the point.
DIGITS = 9


def terms_of(text: str) -> tuple[np.ndarray, np.ndarray, int]:
    """(distinct term hashes, counts, words) of a text, A-Z lowered."""
    h = word_hashes(text.encode("utf-8", "surrogatepass").lower())[0]
    terms, n = np.unique(h, return_counts=True)
    return terms, n, len(h)


def _runs(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of several runs, one run after the other."""
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _reached(score):
    """What a document must reach to enter a list with that k-th score; slightly less, for the rounding of the bounds."""
    return score * (1 - 1e-9) - 10.0**-DIGITS


class ShardIndex:
    """Postings by term in document order, and the largest impacts per term and per (term, block)."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, words: np.ndarray, mean_words: float):
        """Postings sorted by term, then document; ``words`` is the length of each document."""
        self.doc, self.docs = doc, len(words)
        self.blocks = max(1, -(-self.docs // BLOCK))
        self.impact = tf * (K1 + 1) / (tf + K1 * (1 - B + B * words[doc] / max(mean_words, 1e-9))) if len(doc) else np.zeros(0)
        block = doc // BLOCK
        new = np.concatenate(([True], term[1:] != term[:-1])) if len(term) else np.zeros(0, bool)
        head = np.flatnonzero(new | np.concatenate(([True], block[1:] != block[:-1]))) if len(term) else np.zeros(0, np.int64)
        self.begin, self.end = head, np.append(head[1:], len(term))
        self.block = block[head]
        self.most = np.maximum.reduceat(self.impact, head) if len(head) else np.zeros(0)
        self.terms, self.first = np.unique(term[head], return_index=True)
        self.last = np.append(self.first[1:], len(head))
        self.key = np.repeat(np.arange(len(self.terms)), self.last - self.first) * self.blocks + self.block
        self.best = np.maximum.reduceat(self.most, self.first) if len(self.first) else np.zeros(0)
        self.from_, self.to = self.begin[self.first], self.end[self.last - 1] if len(head) else head
        self.skipped = self.crowded = 0

    def walk(self, at: np.ndarray, weights: np.ndarray, bound: np.ndarray) -> None:
        """Add the block maxima of whole terms to the blocks' bounds."""
        n = self.last[at] - self.first[at]
        entry = np.repeat(self.first[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        bound += np.bincount(self.block[entry], np.repeat(weights, n) * self.most[entry], self.blocks)

    def look(self, at: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(term place, block place, entry) of the entries of terms in some blocks, by term."""
        want = (at[:, None] * self.blocks + blocks).ravel()
        place = np.searchsorted(self.key, want)
        place[place == len(self.key)] = 0
        hit = np.flatnonzero(self.key[place] == want)
        return hit // len(blocks), hit % len(blocks), place[hit]

    def scores(self, at: np.ndarray, weights: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document place, score) of all hits in some blocks."""
        t, b, entry = self.look(at, blocks)
        size = self.end[entry] - self.begin[entry]
        place = np.repeat(self.begin[entry] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        slot = np.repeat(b * BLOCK, size) + self.doc[place] % BLOCK
        score = np.bincount(slot, np.repeat(weights[t], size) * self.impact[place], len(blocks) * BLOCK)
        hit = np.flatnonzero(score)
        return blocks[hit // BLOCK] * BLOCK + hit % BLOCK, np.round(score[hit], DIGITS)

    def all_scores(self, at: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for every block, by whole posting lists: long ones on their own, short ones together."""
        begin, size = self.from_[at], self.to[at] - self.from_[at]
        short = size < LONG
        n = size[short]
        place = np.repeat(begin[short] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        score = np.bincount(self.doc[place], np.repeat(weights[short], n) * self.impact[place], self.docs).astype(float)  # whole numbers if empty
        for b, e, w in zip(begin[~short].tolist(), self.to[at[~short]].tolist(), weights[~short].tolist(), strict=True):
            score[self.doc[b:e]] += w * self.impact[b:e]
        hit = np.flatnonzero(score)
        return hit, np.round(score[hit], DIGITS)

    def often(self) -> tuple[np.ndarray, np.ndarray]:
        """(table row of each term or -1, impacts by row and document) of the terms that many documents have."""
        size = self.to - self.from_
        at = np.flatnonzero(size * DENSE > self.docs)
        at = np.sort(at[np.argsort(-size[at], kind="stable")[:ROWS]])
        row, table = np.full(len(size), -1), np.zeros((len(at), self.docs))
        row[at] = np.arange(len(at))
        place = _runs(self.from_[at], size[at])
        table[np.repeat(row[at], size[at]), self.doc[place]] = self.impact[place]
        return row, table

    def together(self, places: list[np.ndarray], weights: list[np.ndarray], often: tuple, ids: np.ndarray, k: int, least: np.ndarray):
        """(query place, document place, score) of the k best of several queries, by whole posting lists: those in the
        table by one matrix product, the others added up.  ``places`` has -1 for unknown terms."""
        q = np.repeat(np.arange(len(places)), [len(p) for p in places])
        at, w = np.concatenate(places), np.concatenate(weights)
        q, at, w = q[at >= 0], at[at >= 0], w[at >= 0]
        in_table, table = often
        row = in_table[at]
        matrix = np.zeros((len(places), len(table)))
        matrix[q[row >= 0], row[row >= 0]] = w[row >= 0]
        score = matrix @ table
        q, at, w = q[row < 0], at[row < 0], w[row < 0]
        size = self.to[at] - self.from_[at]
        ends = np.cumsum(np.bincount(q, size, len(places)))  # postings up to a query
        first = np.searchsorted(q, np.arange(len(places) + 1))
        a = 0
        while a < len(places):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + STEP, side="right")))
            some = slice(first[a], first[b])
            place = _runs(self.from_[at[some]], size[some])
            slot = np.repeat((q[some] - a) * self.docs, size[some]) + self.doc[place]
            score[a:b] += np.bincount(slot, np.repeat(w[some], size[some]) * self.impact[place], (b - a) * self.docs).reshape(b - a, -1)
            a = b
        least = np.maximum(least, 1e-300)  # a document without a term is no hit
        full = np.flatnonzero((score >= least[:, None]).sum(1) > 4 * k)
        if len(full):
            least[full] = np.maximum(least[full], _reached(np.partition(score[full], self.docs - k, axis=1)[:, self.docs - k]))
        q, doc = np.nonzero(score >= least[:, None])
        found = np.round(score[q, doc], DIGITS)
        order = _best(q, found, ids[doc], k)
        return q[order], doc[order], found[order]

    def top(self, terms: np.ndarray, weights: np.ndarray, ids: np.ndarray, k: int, least: float = 0.0) -> list[tuple[int, float]]:
        """(document place, score) of the k best, by score and then by ids; ``terms`` ascend.  Documents below ``least`` may be missing."""
        at = np.searchsorted(self.terms, terms)
        at[at == len(self.terms)] = 0
        known = self.terms[at] == terms if len(self.terms) else np.zeros(len(terms), bool)
        at, weights = at[known], weights[known]
        if not len(at):
            return []
        share = weights * self.best[at]
        order = np.argsort(-share, kind="stable")
        rest = np.append(np.cumsum(share[order][::-1])[::-1], 0.0)  # shares from a term on
        best: list[tuple[float, int, int]] = []

        def take(doc: np.ndarray, score: np.ndarray) -> None:
            nonlocal best
            if len(doc) > k:
                kth = np.partition(score, len(score) - k)[len(score) - k]
                doc, score = doc[score >= kth], score[score >= kth]
            best = sorted(best + [(-s, int(ids[i]), i) for i, s in zip(doc.tolist(), score.tolist(), strict=True)])[:k]

        def floor() -> float:
            return max(least, float(_reached(-best[-1][0]))) if len(best) == k else least

        def listed() -> list[tuple[int, float]]:
            return [(i, -s) for s, _, i in best]

        if self.crowded and self.skipped < RETRY:
            self.skipped += 1
            take(*self.all_scores(at, weights))
            return listed()
        bound = np.zeros(self.blocks)
        walked = max(1, int(np.searchsorted(-rest, -rest[0] / 2)))
        self.walk(at[order[:walked]], weights[order[:walked]], bound)
        seen = np.argsort(-bound, kind="stable")[:FIRST]
        take(*self.scores(at, weights, np.sort(seen)))
        pivot = max(walked, int(np.searchsorted(-rest, -floor(), side="right"))) if floor() > 0 else len(order)
        pivot = min(pivot, len(order))
        if pivot > walked:
            self.walk(at[order[walked:pivot]], weights[order[walked:pivot]], bound)
        bound[seen] = -1.0
        slack, tail = rest[pivot], order[pivot:]
        left = np.flatnonzero((bound > 0) & (bound + slack >= floor()))
        self.crowded, self.skipped = len(left) > MANY * self.blocks, 0
        if self.crowded:
            best = []
            take(*self.all_scores(at, weights))
            return listed()
        left = left[np.argsort(-bound[left], kind="stable")]
        step = 2 * FIRST
        while len(left):
            some, left = left[:step], left[step:]
            some = some[bound[some] + slack >= floor()]
            if not len(some):
                break
            if len(tail) and floor() > 0:
                t, b, entry = self.look(at[tail], some)
                exact = bound[some] + np.bincount(b, weights[tail][t] * self.most[entry], len(some))
                some = some[exact >= floor()]
            if len(some):
                take(*self.scores(at, weights, np.sort(some)))
            step = min(2 * step, 256)
        return listed()


def _best(q: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The places of the k best rows of every query, by query, score and id."""
    order = np.lexsort((ids, -score, q))
    own = q[order]
    return order[np.arange(len(own)) - np.searchsorted(own, own) < k]


def packed(docs: DataFrame) -> DataFrame:
    """(doc_id, words, terms, tf): the distinct terms of each text as packed arrays."""

    def run(batches):
        for b in batches:
            found = [terms_of(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"), pa.array([n for _, _, n in found], pa.int64()),
                    pa.array([t.tobytes() for t, _, _ in found], pa.binary()), pa.array([n.astype("<i4").tobytes() for _, n, _ in found], pa.binary()),
                ],
                names=["doc_id", "words", "terms", "tf"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(run, "doc_id long, words long, terms binary, tf binary")


def _flat(column, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def term_counts(rows: DataFrame) -> DataFrame:
    """(h, df): in how many rows each term occurs; counted per batch before the shuffle."""

    def run(batches):
        for b in batches:
            terms, n = np.unique(_flat(b.column("terms"), np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(n, pa.int64())], names=["h", "df"])

    return rows.select("terms").mapInArrow(run, "h long, df long").groupBy("h").agg(F.sum("df").alias("df"))


def query_terms(rows: DataFrame) -> DataFrame:
    """(q, h, n) of the query documents."""

    def run(batches):
        for b in batches:
            h, n = _flat(b.column("terms"), np.int64), _flat(b.column("tf"), "<i4")
            size = [len(t) // 8 for t in b.column("terms").to_pylist()]
            q = np.repeat(b.column("doc_id").to_numpy(), size)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(h, pa.int64()), pa.array(n, pa.int64())], names=["q", "h", "n"])

    return rows.where(F.col("doc_id") % EVERY == 0).mapInArrow(run, "q long, h long, n long")


def _index(group: pa.Table) -> pa.Table:
    """One shard: ids, lengths and postings sorted by term and document."""
    terms = group.column("terms").to_pylist()
    term, tf = np.frombuffer(b"".join(terms), np.uint64), _flat(group.column("tf"), "<i4")
    doc = np.repeat(np.arange(len(terms), dtype=np.int32), [len(t) // 8 for t in terms])
    order = np.argsort(term, kind="stable")  # documents ascend inside a term
    ids = group.column("doc_id").combine_chunks()
    parts = [np.asarray(ids.fill_null(NO_ID)), np.asarray(ids.is_null()), group.column("words").to_numpy(), doc[order], term[order], tf[order]]
    return pa.table([group.column("shard").slice(0, 1), *(pa.array([x.tobytes()], pa.binary()) for x in parts)], names=["shard", *INDEX])


INDEX = {"ids": np.int64, "no_id": bool, "words": np.int64, "doc": np.int32, "term": np.uint64, "tf": np.int32}


#: While the index is searched: one shard is read and sent at a time, and input splits are as large as the number of tasks makes them.
ONE_SHARD = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1", "spark.sql.parquet.columnarReaderBatchSize": "1", "spark.sql.files.maxPartitionBytes": str(1 << 50), "spark.sql.files.openCostInBytes": "0"}


#: While texts are packed and terms counted: rows of an Arrow batch, of which a task holds one with all that is made of it.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "512"}

#: While packed terms and the index are written: both lie on disk until the search has ended.
COMPACT = {"spark.sql.parquet.compression.codec": "zstd"}


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the jobs inside the block."""
    before = {c: spark.conf.get(c, None) for c in values}
    try:
        for c, v in values.items():
            spark.conf.set(c, v)
        yield
    finally:
        for c, v in before.items():
            spark.conf.unset(c) if v is None else spark.conf.set(c, v)


def answers(batches, asks: list, mean: float, k: int, least: np.ndarray | None = None):
    """(q, doc_id, score) of every query's best documents in each shard; a shard's index is gone before the next one is read.

    ``least`` is what a document of a query must reach to be listed; it may be raised between the shards."""
    least = np.zeros(len(asks)) if least is None else least
    terms = np.unique(np.concatenate([h for _, h, _ in asks])) if asks else np.zeros(0, np.uint64)
    own = [np.searchsorted(terms, h).astype(np.int32) for _, h, _ in asks]
    asked = np.array([q for q, _, _ in asks], np.int64)

    def found(held: ShardIndex, ids: np.ndarray):
        """(query place, document place, score) of each query, pruned where that pays, else of many queries at once."""
        if not len(held.terms):
            return
        at = np.searchsorted(held.terms, terms)
        at[at == len(held.terms)] = 0
        at[held.terms[at] != terms] = -1
        i, often, many = 0, None, max(1, min(TOGETHER, CELLS // held.docs))
        while i < len(asks):
            held.crowded = 0
            best = held.top(*asks[i][1:], ids, k, float(least[i]))
            yield np.full(len(best), i), np.array([d for d, _ in best], int), np.array([s for _, s in best], float)
            i += 1
            if held.crowded and i < len(asks):
                often = held.often() if often is None else often
                j = min(i + many, len(asks))
                q, doc, score = held.together([at[x] for x in own[i:j]], [w for _, _, w in asks[i:j]], often, ids, k, least[i:j])
                yield q + i, doc, score
                i = j

    def of(shard: pa.RecordBatch) -> pa.RecordBatch:
        ids, no_id, words, doc, term, tf = (np.frombuffer(shard.column(c)[0].as_buffer(), t) for c, t in INDEX.items())
        held = ShardIndex(doc, term, tf, words, mean)
        parts = list(zip(*found(held, ids), strict=True)) or [[np.zeros(0, int)]] * 3
        q, place, score = (np.concatenate(x) for x in parts)
        return pa.RecordBatch.from_arrays([pa.array(asked[q]), pa.array(ids[place], mask=no_id[place]), pa.array(score.astype(float))], names=["q", "doc_id", "score"])

    for b in batches:
        for row in range(b.num_rows):
            yield of(b.slice(row, 1))
        del b


def merged(batches, asks: list, mean: float, k: int):
    """(q, doc_id, score) of every query's best documents in all shards of a task; its k-th score bounds the next shard's search."""
    asks = sorted(asks, key=lambda x: x[0])
    asked, least = np.array([q for q, _, _ in asks], np.int64), np.zeros(len(asks))
    q, ids, no_id, score = np.zeros(0, int), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0)
    for b in answers(batches, asks, mean, k, least):
        doc = b.column("doc_id")
        q = np.append(q, np.searchsorted(asked, b.column("q").to_numpy()))
        ids = np.append(ids, np.asarray(doc.fill_null(NO_ID)))
        no_id = np.append(no_id, np.asarray(doc.is_null()))
        score = np.append(score, b.column("score").to_numpy())
        order = _best(q, score, ids, k)
        q, ids, no_id, score = q[order], ids[order], no_id[order], score[order]
        last = np.searchsorted(q, np.arange(len(asks)), side="right") - 1
        full = np.bincount(q, minlength=len(asks)) == k
        least[full] = _reached(score[last[full]])
    yield pa.RecordBatch.from_arrays([pa.array(asked[q]), pa.array(ids, mask=no_id), pa.array(score)], names=["q", "doc_id", "score"])


def search(docs: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, doc_id, score)."""
    spark = docs.sparkSession
    with settings(spark, SMALL_BATCHES | COMPACT):
        rows = written(packed(docs).withColumn("place", F.monotonically_increasing_id()), "packed")
    size = F.octet_length("terms") + F.octet_length("tf") + 16
    total, mean, data = rows.agg(F.count("*"), F.avg("words"), F.sum(size)).first()
    mean, shards = float(mean or 0.0), max(1, -(-(data or 0) // SHARD_BYTES))
    shard = F.pmod(F.xxhash64("place"), F.lit(shards)).cast("int").alias("shard")
    index_schema = "shard int, " + ", ".join(f"{c} binary" for c in INDEX)
    dealt = rows.select(shard, "doc_id", "words", "terms", "tf").repartition(int(shards), "shard")  # files of about one shard
    with settings(spark, COMPACT):
        index = written(dealt.groupBy("shard").applyInArrow(_index, index_schema), "index")

    idf = F.log(1 + (total - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = query_terms(rows).join(term_counts(rows), "h").groupBy("q", "h").agg((F.max("n") * F.max(idf)).alias("w"))
    listed = F.sort_array(F.collect_list(F.struct("h", "w")))  # the distinct terms of one text
    with settings(spark, SMALL_BATCHES):
        queries = written(weighted.groupBy("q").agg(listed.alias("t")).select("q", F.col("t.h").alias("h"), F.col("t.w").alias("w")), "weighted")
    asked = queries.agg(F.sum(F.size("h").cast("long") * 16 + 16)).first()[0] or 0
    blocks = -(-asked // QUERY_BYTES)

    out = []
    for i in range(blocks):
        part = queries.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == i).toArrow()  # about QUERY_BYTES, by the count above
        asks = []
        for q, h, w in zip(part.column("q").to_pylist(), part.column("h"), part.column("w"), strict=True):
            terms = np.asarray(h.values).view(np.uint64)
            order = np.argsort(terms)  # unsigned order, as in the index
            asks.append((q, terms[order], np.asarray(w.values)[order]))
        shared = spark.sparkContext.broadcast(asks)

        def run(batches, shared=shared):
            yield from merged(batches, shared.value, mean, k)

        with settings(spark, ONE_SHARD | {"spark.sql.files.minPartitionNum": str(TASKS * spark.sparkContext.defaultParallelism)}):
            out.append(written(index.select("*").mapInArrow(run, "q long, doc_id long, score double"), "found"))
        shared.unpersist()
    found = spark.createDataFrame([], "q long, doc_id long, score double")
    for x in out:
        found = found.unionByName(x)
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_first("doc_id")))  # tasks * k rows per query
    ranked = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.select(F.col("q").alias("query_id"), F.col("rank").cast("long").alias("rank"), "doc_id", "score")


def op8_topk_search(spark, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"))
