"""Operator 5: packing token sequences by Karmarkar-Karp differencing.

Each document is encoded and ended with id 1.  Whole windows of a long
document become sequences of their own; what is left over (shorter than a
window) is packed in groups of ``GROUP`` leftovers: the largest-difference
method keeps partial partitions in a heap by their imbalance and merges the
two with the largest, heaviest window against lightest.  The window count
starts at the least that can hold the group and rises while some window
exceeds the capacity by more than ``CUT`` ids; the near-equal windows are
then levelled by cutting the excess off and putting it where room is left.
The one window of a group that stays short is split into powers of two,
which need no padding.

Groups are consecutive documents of one input partition, so there is no
shuffle, no group grows with the corpus, and a retried task gives the same
sequences again (sequence_id is partition * 2^40 + number).

Defined cases: null text counts as empty; empty text is the single id 1;
repeated rows are packed one by one; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import functools
import heapq
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltwatch.llm.common import text_of

VOCABULARY = "byte_bpe_50k.json"
WINDOW, END, GROUP, CUT = 2048, 1, 1024, 512


@functools.lru_cache(maxsize=2)
def fast_encoder(path: str, pattern: str):
    """text -> numpy ids, equal to the tokenizer file's without special tokens added.

    The file's vocabulary and merge order are run by the rank encoder, several
    times as fast as the file's own library; added tokens inside a text are
    recognised as that library does.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in added}
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)

    end = np.array([END], "<u4")

    def encode(text: str) -> np.ndarray:
        return np.append(own.encode_to_numpy(text, allowed_special="all"), end).astype("<u4", copy=False)

    return encode


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Multiway largest-difference partition: the item numbers of each window.

    A partial partition lists its non-empty windows (sum, items), heaviest
    first; the others are empty.  Merging two joins the heaviest window of one
    with the lightest of the other.
    """
    heap = [(-s, i, [(s, (i,))]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, i, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        free = windows - len(a)
        joined = a + b[:free]
        for k, (s, items) in enumerate(b[free:]):
            at = len(a) - 1 - k  # the lightest windows of a take the next of b, heaviest first
            t, own = joined[at]
            joined[at] = (s + t, (own, items))
        joined.sort(key=lambda w: -w[0])
        least = joined[-1][0] if len(joined) == windows else 0
        heapq.heappush(heap, (least - joined[0][0], i, joined))

    def flat(tree) -> list[int]:
        out, todo = [], [tree]
        while todo:
            x = todo.pop()
            if isinstance(x, tuple):
                todo.extend(x)
            else:
                out.append(x)
        return sorted(out)

    return [flat(items) for _, items in heap[0][2]] if heap else []


def windows_of(sizes: list[int], capacity: int = WINDOW, cut: int = CUT) -> list[list[tuple[int, int, int]]]:
    """Pieces (item, start, length) of each window; every window but one is full."""
    count = -(-sum(sizes) // capacity)
    while True:
        parts = differencing(sizes, count)
        if all(sum(sizes[i] for i in p) <= capacity + cut for p in parts):
            break
        count += 1
    out, excess = [], []
    for p in parts:
        pieces, over = [], max(0, sum(sizes[i] for i in p) - capacity)
        for i in sorted(p, key=lambda i: sizes[i]):
            off = min(over, sizes[i]) if i == max(p, key=lambda i: sizes[i]) else 0
            pieces.append((i, 0, sizes[i] - off))
            if off:
                excess.append((i, sizes[i] - off, off))
        out.append(pieces)
    out.sort(key=lambda w: -sum(n for _, _, n in w))
    short, k = list(out), len(out) - 1
    for w in short:  # fill the fullest first; lightest windows are drawn on when the excess is used up
        room = capacity - sum(n for _, _, n in w)
        while room and (excess or k > 0 and out[k] is not w and out[k]):
            if excess:
                i, s, n = excess.pop()
            else:
                i, s, n = out[k].pop()
                if not out[k]:
                    k -= 1
            take = min(room, n)
            w.append((i, s, take))
            room -= take
            if take < n:
                excess.append((i, s + take, n - take))
    out = [w for w in out if w]
    while excess:
        out.append([])
        room = capacity
        while room and excess:
            i, s, n = excess.pop()
            take = min(room, n)
            out[-1].append((i, s, take))
            room -= take
            if take < n:
                excess.append((i, s + take, n - take))
    return out


def powers(pieces: list[tuple[int, int, int]], capacity: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """A short window as sequences whose lengths are powers of two."""
    total, out, todo = sum(n for _, _, n in pieces), [], list(reversed(pieces))
    if total == capacity:
        return [pieces]
    while total:
        room = 1 << (total.bit_length() - 1)
        total -= room
        out.append([])
        while room:
            i, s, n = todo.pop()
            take = min(room, n)
            out[-1].append((i, s, take))
            room -= take
            if take < n:
                todo.append((i, s + take, n - take))
    return out


OUT = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def packer(name: str, own_path: str | None, pattern: str | None, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        encode = fast_encoder(own_path or public_tokenizers.path(name), pattern or public_tokenizers.PATTERN)
        number = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []
        group: list[tuple] = []  # (doc_id, ids of the leftover, its start, ids of the document)

        def put(doc_id, ids, start, total, sequence, offset):
            rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), total, sequence, offset))

        def pack():
            nonlocal number
            for w in windows_of([len(g[1]) for g in group], window):
                for sequence in powers(w, window):
                    offset = 0
                    for i, s, n in sequence:
                        doc_id, ids, start, total = group[i]
                        put(doc_id, ids[s : s + n], start + s, total, number, offset)
                        offset += n
                    number += 1
            group.clear()

        def out():
            cols = list(zip(*rows, strict=True)) if rows else [()] * 7
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=[c.split()[0] for c in OUT.split(", ")])

        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                ids = encode(text.as_py())
                whole = len(ids) // window * window
                for s in range(0, whole, window):
                    put(doc_id, ids[s : s + window], s, len(ids), number, 0)
                    number += 1
                if whole < len(ids):
                    group.append((doc_id, ids[whole:].copy(), whole, len(ids)))
                if len(group) == GROUP:
                    pack()
            yield out()
        if group:
            pack()
        yield out()

    return run


def pack(docs: DataFrame, name: str = VOCABULARY, path: str | None = None, pattern: str | None = None, window: int = WINDOW) -> DataFrame:
    """One row per piece."""
    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    return rows.mapInArrow(packer(name, path, pattern, window), OUT)


def op5_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
