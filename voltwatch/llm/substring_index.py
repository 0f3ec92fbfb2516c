"""Operator 1: byte-level duplicate substrings by a run-length (BWT) index.

Every byte covered by a ``LENGTH``-byte string that also starts elsewhere in
the corpus is marked and removed.  ``repeats.find_repeats`` narrows the
corpus to groups of blocks that may share such strings; each collection of
groups gets a run-compressed Burrows-Wheeler transform with samples at the
run ends, from which matching statistics are streamed in text order.

Defined cases: null text counts as empty; texts shorter than ``LENGTH``
bytes are kept whole; copies of a row (same doc_id and text, null doc_id
included) are documents of their own and remove each other; an empty table
gives an empty result; extra columns are ignored (``dedup``) or kept
(``remove_repeats``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltwatch.llm.common import doc_key, with_text
from voltwatch.llm.hashing import BYTE
from voltwatch.llm.repeats import Windows, find_repeats, keyed, merged, starts_to_runs, with_spans
from voltwatch.llm.suffixes import SuffixRanks

LENGTH = 400
ANCHOR = 32


class RunLengthIndex:
    """Run-compressed BWT of blocks, with (place, match length) sampled at run ends.

    Inside a run the longest match with the suffix before (after) in suffix
    order shrinks by one per place, so the samples at run heads (tails) give
    the matching statistics of every place: memory is a few words per run.
    """

    def __init__(self, blocks: list[np.ndarray]):
        s = SuffixRanks(blocks)
        order, n = s.order, len(s.text)
        bwt = s.text[order - 1]
        head = np.flatnonzero(np.concatenate(([True], bwt[1:] != bwt[:-1])))
        tail = np.concatenate((head[1:] - 1, [n - 1]))
        self.n, self.starts, self.ends = n, s.starts, s.ends
        self.run_start, self.run_symbol = head, bwt[head]
        self.before = self._samples(s, order[head], np.concatenate(([-1], order[head[1:] - 1])))
        self.after = self._samples(s, order[tail], np.concatenate((order[tail[:-1] + 1], [-1])))

    @staticmethod
    def _samples(s: SuffixRanks, place: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        match = np.zeros(len(place), np.int64)
        real = other >= 0
        match[real] = s.common(place[real], other[real])
        by = np.argsort(place)
        return place[by], match[by]

    def match_lengths(self) -> np.ndarray:
        """Per place of the text, the longest match with any other place, streamed from the samples."""
        out = np.zeros(self.n, np.int64)
        for place, match in (self.before, self.after):
            gaps = np.diff(np.append(place, self.n))
            np.maximum(out, np.repeat(place + match, gaps) - np.arange(self.n), out=out)
        return out

    def count(self, pattern: np.ndarray, blocks_symbols: np.ndarray) -> int:
        """Occurrences of a pattern by backward search over the runs.

        ``blocks_symbols``: sorted distinct symbols of the indexed blocks and 0.
        """
        m = len(self.starts)
        size = np.diff(np.append(self.run_start, self.n))
        lo, hi = 0, self.n
        for x in pattern[::-1]:
            at = np.searchsorted(blocks_symbols, x)
            if at == len(blocks_symbols) or blocks_symbols[at] != x:
                return 0
            own = self.run_symbol == at + m
            first = int(size[self.run_symbol < at + m].sum())
            rank = [int(np.clip(i - self.run_start[own], 0, size[own]).sum()) for i in (lo, hi)]
            lo, hi = first + rank[0], first + rank[1]
            if lo >= hi:
                return 0
        return hi - lo


def settle(blocks: list[bytes], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    index = RunLengthIndex([np.frombuffer(b, np.uint8) for b in blocks])
    long = index.match_lengths() >= length
    return [starts_to_runs(np.flatnonzero(long[s : max(s, e - length + 1)])) for s, e in zip(index.starts, index.ends, strict=True)]


def byte_symbols(text: str) -> tuple[np.ndarray, bytes, int]:
    data = text.encode("utf-8", "surrogatepass")
    return BYTE[np.frombuffer(data, np.uint8)], data, 1


def marks_of(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(kd, kt, a, b) byte ranges to remove from the keyed documents."""
    return find_repeats(docs, Windows(length, ANCHOR, byte_symbols), 1, lambda blocks: settle(blocks, length))


def _kept(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, out = 0, []
    for a, b in spans:
        out.append(data[at:a])
        at = b
    return b"".join(out) + data[at:]


OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def dedup(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per document."""
    base = keyed(docs)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text, spans in zip(b.column("text"), b.column("spans"), strict=True):
                data, runs = text.as_py().encode("utf-8", "surrogatepass"), merged(spans.as_py() or [])
                kept = _kept(data, runs)
                rows.append((len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()))
            cols = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())],
                names=[c.split()[0] for c in OUT.split(", ")],
            )

    return with_spans(base, marks_of(base, length)).select("doc_id", "text", "spans").mapInArrow(digest, OUT)


@F.pandas_udf(T.StringType())
def _without(text: pd.Series, spans: pd.Series) -> pd.Series:
    def one(t, xs):
        if t is None:
            return None
        return _kept(t.encode("utf-8", "surrogatepass"), merged(list(xs))).decode("utf-8", "ignore")

    return pd.Series([one(t, xs) for t, xs in zip(text, spans, strict=True)], dtype=object)


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """docs without the repeated bytes; a character cut in two goes with them."""
    packed = keyed(docs.select("doc_id", "text"))
    out = with_spans(docs.select(F.struct("*").alias("row"), *doc_key()), marks_of(packed, length))
    new = _without(F.when(F.col("spans").isNotNull(), F.col("row.text")), F.coalesce("spans", F.array().cast("array<struct<a:int,b:int>>")))
    return with_text(out.withColumn("_new", new), docs, F.coalesce("_new", F.col("row.text")))


def op1_substring_index(spark, sf_dir: str) -> DataFrame:
    return dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
