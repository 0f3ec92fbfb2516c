"""Operator 3: byte-level BPE encoding and decoding with a rank queue.

Merges of one pre-token are drawn from a hierarchical bitmap: bit r of the
lower level says that some pair of rank r waits, the upper level says which
words below are not empty, and find-first-set on both gives the lowest
waiting rank.  The bucket of a rank is a heap of positions in a
doubly linked list of parts, so equal ranks merge from the left; an entry is
stale, and skipped, if the pair at its position no longer has that rank.
Only pairs that rank before both their neighbours wait in the queue: the
others cannot merge before a neighbour does, which replaces them.
The cost is O(n log n) in the pre-token's length, so a megabyte without a
break costs no more per byte than a word.

Short pre-tokens are encoded once per task and kept in a table of bounded
size; long ones are encoded where they stand.

Defined cases: null text counts as empty; empty text gives no ids (hashes of
the empty string); rows with the same doc_id are encoded one by one; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltwatch.llm.common import text_of

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: log2 of the bits in a word of the lower level.
SHIFT = 8
#: The two tables of encoded pre-tokens: entries of each at most, characters per entry at most.
TABLE, TABLE_CHARS = 1 << 18, 64
#: The rank of a pair that no token joins.
NONE = 1 << 40
#: Texts of these characters only mean the same to the standard library's \\w and \\s.
PLAIN = re.compile(r"[\x00-\x1b\x20-\x7fÀ-ɏ]*")


def quick_pattern(pattern: str) -> re.Pattern:
    """The pattern for the standard library; right for PLAIN texts."""
    plain = pattern.replace(r"[^\s\p{L}\p{N}]", r"(?:[^\s\w]|_)").replace(r"\p{L}", r"[^\W\d_]").replace(r"\p{N}", r"\d")
    return re.compile(plain)


class ByteBpe:
    """Encoder and decoder for a rank file and a pre-token pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.vocabulary = {i: token for token, i in self.ranks.items()}
        self.size = max(self.vocabulary) + 1
        # The queue, empty between calls: lower words of the bitmap, positions by rank.
        self.low = [0] * ((self.size >> SHIFT) + 1)
        self.buckets: dict[int, list[int]] = {}
        self.exact = regex.compile(pattern)
        self.quick = quick_pattern(pattern)
        self.table: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}  # the table before; what is found there moves up

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        ranks, low, buckets = self.ranks, self.low, self.buckets
        if piece in ranks:
            return [ranks[piece]]
        end, top, mask, known = len(piece), 0, (1 << SHIFT) - 1, ranks.get
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        pair = [known(piece[i : i + 2], NONE) for i in range(end)]
        pair[-1] = NONE
        pair.append(NONE)  # also what before[0] = -1 looks at
        waiting = [i for i in range(end - 1) if pair[i - 1] > pair[i] <= pair[i + 1]]
        while True:
            for i in waiting:
                rank = pair[i]
                if rank in buckets:
                    heappush(buckets[rank], i)
                else:
                    buckets[rank] = [i]
                    word = rank >> SHIFT
                    if not low[word]:
                        top |= 1 << word
                    low[word] |= 1 << (rank & mask)
            if not top:
                break
            word = (top & -top).bit_length() - 1
            bits = low[word]
            rank = (word << SHIFT) + (bits & -bits).bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket[0]
                del buckets[rank]
                low[word] = bits = bits & (bits - 1)
                if not bits:
                    top &= top - 1
            waiting = ()
            if pair[i] != rank:
                continue
            j = after[i]
            k = after[i] = after[j]
            pair[j] = NONE
            h = before[i]
            here = there = NONE
            if k < end:
                before[k] = i
                here = known(piece[i : after[k]], NONE)
            pair[i] = here
            if h >= 0:
                pair[h] = there = known(piece[h:k], NONE)
            waiting = []
            if here < NONE and there > here <= pair[k]:
                waiting.append(i)
            if h >= 0:
                g = before[h]
                if there < NONE and pair[g] > there <= here:
                    waiting.append(h)
                if g >= 0 and (last := pair[g]) < NONE and pair[before[g]] > last <= there:
                    waiting.append(g)
            if k < end and (last := pair[k]) < NONE and here > last <= pair[after[k]]:
                waiting.append(k)
        ids, i = [], 0
        while i < end:
            k = after[i]
            ids.append(ranks[piece[i:k]])
            i = k
        return ids

    def encode(self, text: str) -> list[int]:
        pattern = self.quick if PLAIN.fullmatch(text) else self.exact
        table, ids = self.table, []
        for piece in pattern.findall(text):
            got = table.get(piece)
            if got is None:
                got = self.older.get(piece) or self.merge(piece.encode())
                if len(piece) <= TABLE_CHARS:
                    if len(table) >= TABLE:
                        self.older, self.table = table, {}
                        table = self.table
                    table[piece] = got
            ids += got
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> ByteBpe:
    """One codec per Python worker, so its table serves the worker's next tasks."""
    return ByteBpe(path, pattern)


def encoder(name: str, pattern: str | None, own_path: str | None = None):
    """A function of Arrow batches (doc_id, text) for mapInArrow.

    The rank file is read on the executor, from the installed vocabularies or
    from ``own_path``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        bpe = codec(own_path or public_tokenizers.path(name), pattern or public_tokenizers.PATTERN)
        decimal = [str(i) for i in range(bpe.size)]
        for b in batches:
            n, said, back = [], [], []
            for text in b.column("text"):
                ids = bpe.encode(text.as_py())
                n.append(len(ids))
                said.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                back.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(said, pa.string()), pa.array(back, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def round_trip(docs: DataFrame, name: str = VOCABULARY, pattern: str | None = None, path: str | None = None) -> DataFrame:
    """Per document: id count, hash of the ids, hash of the decoded bytes.  No shuffle."""
    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    return rows.mapInArrow(encoder(name, pattern, path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op3_byte_bpe(spark, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"))
