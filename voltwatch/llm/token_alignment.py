"""Operator 12: alignment of two tokenizers by diagonal run skipping.

Both tokenizers cut the same bytes (a space and the text), so an alignment is
the set of byte offsets where a token of each ends.  The two arrays of end
offsets are walked together: at the current index shift, exponential probing
compares ever longer stretches and jumps over all one-to-one tokens; where
the ends part, the side that lags steps until they meet, which closes one
irregular group and gives the new shift.

Two linked tokens end at the same byte, so the bytes of the shorter are a
suffix of the longer's.  The pairs that can occur are therefore listed from
the two vocabularies alone (at most the sum of their token lengths, a few
hundred thousand), whatever the corpus.  Corpus-wide counts are one array over
that list: its size is bounded by the vocabulary files, so it goes through
the driver and to every task, and no token is shuffled.

Defined cases: null or empty texts, and texts that one tokenizer does not
give back byte by byte, have no tokens (zeros, empty ``groups_sha256``);
repeated rows count as often as they occur; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltwatch.llm.common import documents, written

VOCABULARY, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Longest stretch that one probe compares.
STRETCH = 4096
#: Tokens that are compared one by one before a stretch is.
FIRST = 8


class Numbering:
    """Number of each of a fixed set of codes: open addressing, all queries probed together."""

    FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, codes: np.ndarray):
        self.bits = max(4, int(2 * len(codes)).bit_length())
        self.held, self.number = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int32)
        at, left = self.slot(codes), np.arange(len(codes))
        while len(left):
            mine = left[self.held[at[left]] < 0]
            self.held[at[mine]], self.number[at[mine]] = codes[mine], mine
            left = left[self.held[at[left]] != codes[left]]
            at[left] = self.next(at[left])

    def slot(self, codes: np.ndarray) -> np.ndarray:
        return ((codes.astype(np.uint64) * self.FACTOR) >> np.uint64(64 - self.bits)).astype(np.int64)

    def next(self, at: np.ndarray) -> np.ndarray:
        return (at + 1) & ((1 << self.bits) - 1)

    def find(self, codes: np.ndarray) -> np.ndarray:
        """Numbers of codes of the set."""
        at = self.slot(codes)
        left = np.flatnonzero(self.held[at] != codes)
        while len(left):
            at[left] = self.next(at[left])
            left = left[self.held[at[left]] != codes[left]]
        return self.number[at]


@dataclass(frozen=True)
class Pair:
    """Both vocabularies inside one Python worker."""

    encode_a: object
    encode_b: object
    bytes_a: list[bytes]
    bytes_b: list[bytes]
    size_a: np.ndarray
    size_b: np.ndarray
    codes: np.ndarray  # a * len(bytes_b) + b of every pair that can end together, sorted
    numbering: Numbering
    names: np.ndarray  # decimal ids with the sign that follows them in the group text


def byte_level_tokens(path: str) -> tuple[list[bytes], set[int]]:
    """(bytes of every id, ids of added tokens) of a byte-level BPE file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if spec["normalizer"] is not None or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
        raise ValueError(f"{path} is not a plain byte-level vocabulary")
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    added = {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
    out = dict(added)
    for token, i in spec["model"]["vocab"].items():
        if i not in added:
            out[i] = bytes(byte_of[c] for c in token)
    return [out[i] for i in range(len(out))], set(added)


def possible_pairs(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Codes of all (a, b) whose bytes are a suffix of one another."""
    ids_a, ids_b = {}, {}
    for ids, tokens in ((ids_a, a), (ids_b, b)):
        for i, t in enumerate(tokens):
            ids.setdefault(t, []).append(i)
    found = []
    for i, t in enumerate(a):
        found += [i * len(b) + j for k in range(len(t)) for j in ids_b.get(t[k:], ())]
    for j, t in enumerate(b):
        found += [i * len(b) + j for k in range(1, len(t)) for i in ids_a.get(t[k:], ())]
    return np.unique(np.array(found, np.int64))


@functools.lru_cache(maxsize=2)
def tokenizers_of(vocabulary: str, pieces: str) -> Pair:
    """Loads both files; the byte-level one is run by the rank encoder, which gives the same ids."""
    import sentencepiece
    import tiktoken

    bytes_a, added = byte_level_tokens(vocabulary)
    ranks = {t: i for i, t in enumerate(bytes_a) if i not in added}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    model = sentencepiece.SentencePieceProcessor(model_file=pieces)
    names_b = [model.id_to_piece(i) for i in range(model.vocab_size())]
    bytes_b = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names_b)]
    sizes = [np.array([len(t) for t in v], np.int64) for v in (bytes_a, bytes_b)]
    names = np.array([f"{i}{sign}" for v, signs in ((bytes_a, ",|"), (bytes_b, ",;")) for sign in signs for i in range(len(v))], "S")
    codes = possible_pairs(bytes_a, bytes_b)
    return Pair(own.encode_to_numpy, lambda t: model.encode(t, num_threads=1), bytes_a, bytes_b, *sizes, codes, Numbering(codes), names)


def skip_runs(a: list[int], b: list[int]) -> list[tuple[int, int, int]]:
    """Runs (i, j, n): the tokens i..i+n-1 and j..j+n-1 end together one by one.

    ``a`` and ``b`` are ascending end offsets with the same last one.  A run
    begins with the link that closes an irregular group.
    """
    a, b, n = [*a, -1], [*b, -2], len(a)  # the ends differ behind the last
    runs, start, i, j = [], 0, 0, 0
    while True:
        probe = i + FIRST
        while i < probe and a[i] == b[j]:
            i, j = i + 1, j + 1
        if i == probe:
            step = FIRST
            while a[i : i + step] == b[j : j + step]:
                i, j, step = i + step, j + step, min(2 * step, STRETCH)
            while step > 1:  # the ends part within the last step: halve it
                step //= 2
                if a[i : i + step] == b[j : j + step]:
                    i, j = i + step, j + step
        if i > start:
            runs.append((start, j - (i - start), i - start))
        if i == n:
            return runs
        x, y = a[i], b[j]
        while x != y:
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        start = i
        i, j = i + 1, j + 1


def links_of(a: list[int], b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the linked tokens in both sequences."""
    runs = np.array(skip_runs(a, b), np.int64).reshape(-1, 3)
    n = runs[:, 2]
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(runs[:, 0], n) + inside, np.repeat(runs[:, 1], n) + inside


def group_text(pair: Pair, a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> bytes:
    """``a1,a2|b1;a3|b2,b3``: the ids of each group, both sides in order."""
    end_a, end_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    end_a[i] = end_b[j] = 1
    before_a = np.concatenate(([0], j + 1))[np.cumsum(end_a) - end_a]  # tokens of the other side in front
    before_b = (i + 1)[np.cumsum(end_b) - end_b]
    out = np.empty(len(a) + len(b), np.int64)
    va, vb = len(pair.bytes_a), len(pair.bytes_b)
    out[np.arange(len(a)) + before_a] = a + va * end_a
    out[np.arange(len(b)) + before_b] = 2 * va + b + vb * end_b
    return pair.names[out].tobytes().translate(None, b"\0")[:-1]  # without the padding of the fixed width


@dataclass(frozen=True)
class Alignment:
    n_a: int = 0
    n_b: int = 0
    groups: bytes = b""
    links: np.ndarray | None = None  # places in Pair.codes


def align(pair: Pair, text: str | None) -> Alignment:
    """Alignment of one text; the zero alignment where there are no tokens."""
    if not text:
        return Alignment()
    whole = " " + text
    data = whole.encode("utf-8", "surrogatepass")
    pieces = pair.encode_b(text)
    a = pair.encode_a(whole).astype(np.int64)
    ends_a = np.cumsum(pair.size_a[a])
    # A plain byte-level vocabulary gives the bytes themselves; pieces may not.
    if not pieces or ends_a[-1] != len(data) or b"".join([pair.bytes_b[x] for x in pieces]) != data:
        return Alignment()
    b = np.array(pieces, np.int64)
    ends_b = np.cumsum(pair.size_b[b])
    i, j = links_of(ends_a.tolist(), ends_b.tolist())
    codes = a[i] * len(pair.bytes_b) + b[j]
    return Alignment(len(a), len(b), group_text(pair, a, b, i, j), pair.numbering.find(codes).astype("<i4", copy=False))


def aligned(docs: DataFrame, vocabulary: str, pieces: str) -> DataFrame:
    """(doc_id, n_a, n_b, groups_sha256, links) of every document; links are packed pair numbers."""

    def run(batches):
        pair = tokenizers_of(vocabulary, pieces)
        for batch in batches:
            found = [align(pair, t.as_py()) for t in batch.column("text")]
            digest = [hashlib.sha256(x.groups).hexdigest() if x.n_a else "" for x in found]
            packed = [x.links.tobytes() if x.n_a else b"" for x in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array([x.n_a for x in found], pa.int64()), pa.array([x.n_b for x in found], pa.int64()),
                    pa.array(digest, pa.string()), pa.array(packed, pa.binary()),
                ],
                names=["doc_id", "n_a", "n_b", "groups_sha256", "links"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_a long, n_b long, groups_sha256 string, links binary")


def pair_counts(found: DataFrame, size: int) -> np.ndarray:
    """How many links of the corpus hold each possible pair."""

    def run(batches):
        total = np.zeros(size, np.int64)
        for b in batches:
            total += np.bincount(np.frombuffer(b"".join(b.column("links").to_pylist()), "<i4"), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["pair", "n"])

    counted = found.select("links").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    rows = counted.toArrow()
    out = np.zeros(size, np.int64)
    out[rows.column("pair").to_numpy()] = rows.column("n").to_numpy()
    return out


def alignment(docs: DataFrame, vocabulary: str, pieces: str) -> DataFrame:
    """Digest columns of every document's alignment, with corpus-wide pair counts."""
    found = written(aligned(docs, vocabulary, pieces), "aligned")
    pair = tokenizers_of(vocabulary, pieces)
    counts = pair_counts(found, len(pair.codes))
    of_b = pair.codes % len(pair.bytes_b)
    most = np.zeros(len(pair.bytes_b), np.int64)
    np.maximum.at(most, of_b, counts)
    best = counts == most[of_b]

    def run(batches):
        for b in batches:
            places = [np.frombuffer(x.as_py(), "<i4") for x in b.column("links")]
            n = pa.array([len(p) for p in places], pa.int64())
            n_best = pa.array([int(best[p].sum()) for p in places], pa.int64())
            total = pa.array([int(counts[p].sum()) for p in places], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("n_a"), b.column("n_b"), n, n, n_best, total, b.column("groups_sha256")],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
            )

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return found.mapInArrow(run, schema)


def op12_token_alignment(spark, sf_dir: str) -> DataFrame:
    return alignment(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY), public_tokenizers.path(PIECES))
