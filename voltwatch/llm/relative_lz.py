"""Operator 4: word-level duplicate passages by relative Lempel-Ziv parsing.

Every word covered by a window of ``LENGTH`` words that also starts elsewhere
in the corpus is removed.  ``repeats.find_repeats`` narrows the corpus to
groups of blocks that may share a window.  Each doubtful block is factored
greedily against every other block of its collection: a factor is the longest
match from where the last one ended.  A factor of at least ``LENGTH`` words
is a duplicate span; windows that lie across a factor's start are checked
there, since a greedy factor may end inside a longer match that began later.

Defined cases: null text has no words; documents of fewer than ``LENGTH``
words are kept whole; copies of a row (null doc_id included) are documents
of their own and remove each other; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from voltwatch.llm.hashing import word_hashes
from voltwatch.llm.repeats import Windows, find_repeats, keyed, merged, starts_to_runs, with_spans
from voltwatch.llm.suffixes import SuffixRanks

LENGTH = 35
ANCHOR = 8


class ReferenceBlocks:
    """Indexed blocks; each can be factored against all the others and the rest of itself."""

    def __init__(self, blocks: list[np.ndarray]):
        s = SuffixRanks(blocks)
        self.starts, self.ends = s.starts, s.ends
        near = s.common(s.order[:-1], s.order[1:])
        longest = np.zeros(len(s.order), np.int64)
        longest[s.order[1:]] = near
        longest[s.order[:-1]] = np.maximum(longest[s.order[:-1]], near)
        self.longest = longest  # longest match of each place with any other place

    def factors(self, block: int) -> list[tuple[int, int]]:
        """(start, length) of the greedy factors of a block; a word found nowhere else has length 0."""
        at, size = int(self.starts[block]), int(self.ends[block] - self.starts[block])
        out, i = [], 0
        while i < size:
            n = int(self.longest[at + i])
            out.append((i, n))
            i += max(1, n)
        return out

    def spans(self, block: int, length: int) -> list[tuple[int, int]]:
        """(first, last) starts of windows found elsewhere."""
        at = int(self.starts[block])
        hit = np.zeros(int(self.ends[block]) - at, bool)
        for i, n in self.factors(block):
            if n >= length:
                hit[i : i + n - length + 1] = True
            lo = max(0, i - length + 1)
            hit[lo:i] |= self.longest[at + lo : at + i] >= length
        return starts_to_runs(np.flatnonzero(hit))


def settle(blocks: list[bytes], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    index = ReferenceBlocks([np.frombuffer(b, np.int64) for b in blocks])
    return [index.spans(i, length) for i in range(len(blocks))]


def word_symbols(text: str) -> tuple[np.ndarray, bytes, int]:
    h = word_hashes(text.encode("utf-8", "surrogatepass"))[0]
    return h, h.tobytes(), 8


def marks_of(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    return find_repeats(docs, Windows(length, ANCHOR, word_symbols), 8, lambda blocks: settle(blocks, length))


OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def dedup(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per document."""
    base = keyed(docs)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text, spans in zip(b.column("text"), b.column("spans"), strict=True):
                words, kept, at = text.as_py().encode("utf-8", "surrogatepass").split(), [], 0
                for s, e in merged(spans.as_py() or []):
                    kept += words[at:s]
                    at = e
                kept += words[at:]
                rows.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            cols = list(zip(*rows, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())],
                names=[c.split()[0] for c in OUT.split(", ")],
            )

    return with_spans(base, marks_of(base, length)).select("doc_id", "text", "spans").mapInArrow(digest, OUT)


def op4_relative_lz(spark, sf_dir: str) -> DataFrame:
    return dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
