"""Every operator against its plain version, and the defined edge cases."""

import base64
import random
import time
import weakref
import zlib
from collections import defaultdict

import brute
import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voltwatch.llm import byte_bpe, common, host_rules, license_scan, minmax_dedup, packing, relative_lz, secret_scan, substring_index, topk_search, weak_labels
from voltwatch.llm.catalog import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kd string, row string, key long"


def query(spark, name):
    return sorted(tuple(r) for r in QUERIES[name](spark, SF).collect())


@pytest.fixture(scope="module")
def rows(spark):
    return [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


@pytest.fixture(scope="module")
def docs(rows):
    return [r[:2] for r in rows]


def frame(spark, pairs):
    return spark.createDataFrame([(d, t, "en", "s", len(t or ""), "x", "y", 1) for d, t in pairs], SCHEMA)


def prose(rng, n, vocabulary=5000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, copies of a row, repeated ids, other alphabets, extra columns."""
    rng = random.Random(5)
    long = prose(rng, 30_000)
    text = prose(rng, 80)
    return frame(
        spark,
        [
            (1, None), (2, ""), (3, " \n\t"), (None, text), (None, text), (5, text), (6, long), (7, "x" * 5000), (8, "ÄÖ 漢字 🙂 " * 200),
            (9, text + " end"), (9, prose(rng, 90)), (50, text), (50, text), (None, None), (100, "password = hunter22222 MIT License"),
        ],
    )


def test_substring_query(spark, docs):
    assert query(spark, "op1_substring_index") == sorted(brute.substring(docs))


def test_substring_hot_group(spark, monkeypatch):
    """One passage in very many different surroundings: groups are halved until they fit."""
    from voltwatch.llm import repeats

    monkeypatch.setattr(repeats, "HOT_BLOCKS", 4)
    rng = random.Random(1)
    common = "".join(rng.choice("abcd") for _ in range(90))
    docs = [(i, "".join(rng.choice("abcd") for _ in range(rng.randrange(60, 120))) + common[: rng.randrange(50, 91)] + prose(rng, 9)) for i in range(60)]
    docs += [(99, "ab" * 300), (98, "aaaa" * 50)]
    got = sorted(tuple(r) for r in substring_index.dedup(frame(spark, docs), 64).collect())
    assert got == sorted(brute.substring(docs, 64))


def test_copies_of_a_row_are_one_row(spark, monkeypatch):
    """Rows that agree in id and text meet no other copy: the blocks don't grow with their number."""
    from voltwatch.llm import repeats

    rng = random.Random(17)
    parts = [prose(rng, 120) for _ in range(4)]
    copies = 40
    pairs = [(None, f"{parts[0]} {parts[1]} {parts[2]}")] * copies + [(1, f"{parts[3]} {parts[1]} end"), (2, prose(rng, 200)), (2, prose(rng, 200))]
    seen = []
    plain = repeats.written

    def counted(df, name):
        out = plain(df, name)
        if name == "blocks":
            seen.append(out.count())
        return out

    monkeypatch.setattr(repeats, "written", counted)
    docs = frame(spark, pairs)
    assert sorted((tuple(r) for r in substring_index.dedup(docs).collect()), key=str) == sorted(brute.substring(pairs), key=str)
    assert sorted((tuple(r) for r in relative_lz.dedup(docs).collect()), key=str) == sorted(brute.passages(pairs), key=str)
    single = frame(spark, pairs[copies - 2 :])
    many, seen[:] = list(seen), []
    substring_index.dedup(single).collect()
    relative_lz.dedup(single).collect()
    assert seen == many and 0 < max(many) < copies * copies


def test_run_length_index():
    rng = random.Random(2)
    blocks = ["".join(rng.choice("ab") for _ in range(n)).encode() for n in (50, 1, 80, 30)]
    index = substring_index.RunLengthIndex([np.frombuffer(b, np.uint8) for b in blocks])
    symbols = np.unique(np.frombuffer(b"".join(blocks), np.uint8))
    for p in (b"a", b"ab", b"abba", b"bbbbbbbb", b"c"):
        times = sum(b.startswith(p, i) for b in blocks for i in range(len(b)))
        assert index.count(np.frombuffer(p, np.uint8), symbols) == times
    found = index.match_lengths()
    for at, b in zip(index.starts, blocks, strict=True):
        for i in range(len(b)):
            longest = max((n for n in range(len(b) - i + 1) if sum(x.startswith(b[i : i + n], j) for x in blocks for j in range(len(x) + 1)) > 1), default=0)
            assert found[at + i] == longest


def test_passages_query(spark, docs):
    assert query(spark, "op4_relative_lz") == sorted(brute.passages(docs))


def test_passages_self_overlap(spark):
    rng = random.Random(3)
    common = prose(rng, 60).split()
    docs = [(i, " ".join(prose(rng, 20).split() + common[rng.randrange(10) : 40 + rng.randrange(20)] + prose(rng, 20).split())) for i in range(40)]
    docs += [(90, "a " * 100), (91, "a b c " * 40)]
    got = sorted(tuple(r) for r in relative_lz.dedup(frame(spark, docs)).collect())
    assert got == sorted(brute.passages(docs))


def test_near_query(spark, docs):
    assert query(spark, "op2_minmax_dedup") == sorted(brute.near(docs))


def test_near_hub_and_shared_passage(spark):
    """A large group of near copies, chains, short texts and a passage that many texts share."""
    rng = random.Random(4)
    base = prose(rng, 100).split()
    docs = []
    for i in range(80):
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"z{rng.randrange(10**6)}"
        docs.append((i, " ".join(w)))
    docs += [(100 + i, " ".join(base[:50]) + " " + prose(rng, 60)) for i in range(30)]
    docs += [(200 + i, " ".join(base[2 * i : 60 + 2 * i])) for i in range(15)]
    docs += [(300, "One two"), (301, "one TWO"), (302, "one"), (303, ""), (304, None)]
    got = sorted(tuple(r) for r in minmax_dedup.near_duplicates(frame(spark, docs)).drop("kd", "kt", "group").collect())
    assert got == sorted(brute.near(docs))


def test_bpe_query(spark, docs):
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    extra = [(10**6, None), (10**6 + 1, "a" * 20_000 + " é🙂\n\n  x"), (10**6 + 2, "".join(random.Random(7).choice("abcdefgh") for _ in range(9000)))]
    want = []
    for d, t in docs + extra:
        ids = own.encode_ordinary(t or "")
        want.append((d, len(ids), brute.sha(",".join(map(str, ids)).encode()), brute.sha((t or "").encode())))
    got = query(spark, "op3_byte_bpe")
    got += [tuple(r) for r in byte_bpe.round_trip(frame(spark, extra)).collect()]
    assert got == sorted(want)


def check_pieces(pieces, texts):
    """Every id of every document once, sequences gapless and at most 2048; returns the share of padding."""
    encode = packing.fast_encoder(public_tokenizers.path(packing.VOCABULARY), public_tokenizers.PATTERN)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
    assert by_doc.keys() == texts.keys()
    for d, ps in by_doc.items():
        ids, at = encode(texts[d] or ""), 0
        for p in sorted(ps, key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids)) and p.length > 0
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].astype("<u4").tobytes())
            at += p.length
        assert at == len(ids)
    used = padded = 0
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
        used += at
        padded += at if at & (at - 1) == 0 else 2048
    return 1 - used / padded


def test_packing_query(spark, docs):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    encode = packing.fast_encoder(public_tokenizers.path(packing.VOCABULARY), public_tokenizers.PATTERN)
    for _, t in docs:
        assert encode(t or "").tolist() == own.encode(t or "", add_special_tokens=False).ids + [1]
    assert check_pieces(QUERIES["op5_packing"](spark, SF).collect(), dict(docs)) < 0.01


def test_differencing():
    assert sorted(map(sorted, packing.differencing([8, 7, 6, 5, 4], 2))) in ([[0, 3], [1, 2, 4]], [[0, 2], [1, 3, 4]], [[0, 1], [2, 3, 4]], [[0, 3, 4], [1, 2]])
    rng = random.Random(6)
    sizes = [rng.randrange(1, 2048) for _ in range(500)]
    pieces = [p for w in packing.windows_of(sizes) for p in w]
    assert sum(n for _, _, n in pieces) == sum(sizes)
    assert all(sum(n for _, _, n in w) <= 2048 for w in packing.windows_of(sizes))


def test_license_query(spark, docs):
    got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in QUERIES["op6_license_scan"](spark, SF).collect()]
    key = lambda r: r[0]
    assert sorted(got, key=key) == sorted(((d, *brute.phrases(t)) for d, t in docs), key=key)


def test_license_templates(spark):
    """Containment of every block against every template, without the filters."""
    rng = random.Random(8)
    docs = []
    for i, text in enumerate([*license_scan.TEMPLATES.values()] * 4):
        w = [x for x in text.split() if rng.random() > 0.15]
        docs.append((i, prose(rng, rng.randrange(100)) + " " + " ".join(w) + " " + prose(rng, rng.randrange(100))))
    got = {r.doc_id: (r.labels, round(r.score, 9)) for r in license_scan.scan(frame(spark, docs)).collect()}
    for d, t in docs:
        w, best = license_scan.words_of(t), {}
        for b in range(0, max(1, len(w) - 64 + 32), 32):
            for label, text in license_scan.TEMPLATES.items():
                want = set(license_scan.words_of(text))
                share = len(want & set(w[b : b + 64])) / len(want)
                if share >= 0.8:
                    best[label] = max(share, best.get(label, 0))
        base = {x for x in brute.phrases(t)[4].split(",") if x}
        assert got[d] == (",".join(sorted(base | set(best))), round(1.0 if base else max(best.values(), default=0.0), 9))


def spans_of(text):
    """All spans, weak ones linked by comparing every part."""
    base, weak, parts = secret_scan.find_parts(text)
    assert base == brute.secrets(text)
    linked = {(s, k, e) for s, k, e in weak if any(p in secret_scan.NEEDS[k] and s <= pe + 240 and e >= ps - 240 for ps, p, pe in parts)}
    return sorted([*base, *linked])


def shown(spans):
    return ",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def test_secrets(spark, docs):
    rng = random.Random(9)
    made = []
    for i in range(200):
        parts = ["user=alice", "token: abcd", "AKIA" + "Q7" * 8, "https://db.example.com:99", "Zx9" * 8, "apikey='longenough1'", "0a" * 20, "Secret=", "kelvin ſecret=abcdefghij"]
        made.append((10**6 + i, " ".join(prose(rng, rng.randrange(60)) + " " + rng.choice(parts) for _ in range(rng.randrange(1, 8)))))
    got = {r.doc_id: r for r in secret_scan.scan(frame(spark, docs + made)).collect()}
    for d, t in docs + made:
        base = brute.secrets(t)
        assert [got[d].n_assign, got[d].n_access, got[d].n_hex] == [sum(k == j for _, k, _ in base) for j in range(3)]
        assert got[d].base_sha256 == brute.sha(shown(base).encode())
        assert got[d].spans == shown(spans_of(t or ""))


def test_endpoints_in_long_tokens():
    """A run without an end is tried once: a megabyte of letters, base64, dots or labels takes seconds at most."""
    rng = random.Random(4)
    for token in ("x" * 10**6, "".join(rng.choices("abcXYZ019+/", k=10**6)), "a." * 500_000, "ab-" * 300_000, "." * 10**6, "password" + " " * 10**6):
        start = time.process_time()
        secret_scan.find_parts(f"user=alice Zx9Zx9Zx9Zx9Zx9Zx9Zx9 {token} tail.example.org")
        assert time.process_time() - start < 5
    found = [m[0] for m in secret_scan.ENDPOINT.finditer("a.b.com x..y.net .z.org -k.io http://h/p https://q a.b.c.local:80 nocom com.x")]
    assert found == ["a.b.com", "y.net", "z.org", "-k.io", "http://h/p", "https://q", "a.b.c.local:80"]


def test_topk_query(spark, docs):
    got = [(r.query_id, r.doc_id, r.score) for r in QUERIES["op8_topk_search"](spark, SF).orderBy("query_id", "rank").collect()]
    want = sorted(brute.bm25(docs), key=lambda r: (r[0], -round(r[2], 6), r[1]))
    assert len(got) == len(want)
    assert [q for q, _, _ in got] == [q for q, _, _ in want]
    assert np.allclose([s for _, _, s in got], [s for _, _, s in want])
    for q in {r[0] for r in want}:  # documents may swap where scores agree to rounding
        assert {(round(s, 5)) for x, _, s in got if x == q} == {(round(s, 5)) for x, _, s in want if x == q}


def test_topk_shards(spark, monkeypatch):
    """Small shards and query blocks: the lists of the plain version, ties to the smaller doc_id."""
    rng = random.Random(10)
    docs = [(i, prose(rng, rng.randrange(5, 200), 300)) for i in range(400)]
    docs += [(1000 + i, docs[i % 3 * 50][1]) for i in range(60)]  # copies of queries: more equal scores than k
    docs += [(None, docs[7][1]), (2000, ""), (2001, None)]
    monkeypatch.setattr(topk_search, "SHARD_BYTES", 60_000)
    monkeypatch.setattr(topk_search, "QUERY_BYTES", 5_000)
    monkeypatch.setattr(topk_search, "BLOCK", 8)
    monkeypatch.setattr(topk_search, "FIRST", 2)
    found = topk_search.search(frame(spark, docs)).collect()
    got = sorted((r.query_id, r.doc_id, round(r.score, 6)) for r in found)
    want = [(q, d, round(s, 6)) for q, d, s in brute.bm25([x for x in docs if x[0] is not None] + [(-1, docs[7][1])]) if q >= 0]
    assert [(q, -1 if d is None else d, s) for q, d, s in sorted(got, key=lambda r: (r[0], -1 if r[1] is None else r[1], r[2]))] == sorted(want)
    for q in (0, 50, 100):  # twenty copies and itself score the same: the ten smallest ids, in order
        own = sorted(((r.rank, r.doc_id) for r in found if r.query_id == q))
        assert [d for _, d in own] == [q] + [1000 + q // 50 + 3 * i for i in range(9)]


def test_topk_holds_one_shard(spark, docs, monkeypatch):
    """A task drops a shard's index before it makes the next one, and packs texts by small batches."""
    alive, most, sizes = weakref.WeakSet(), [], {}

    class Counted(topk_search.ShardIndex):
        def __init__(self, *args):
            most.append(len(alive))
            super().__init__(*args)
            alive.add(self)

    def written(df, name):
        sizes[name] = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000"))
        return common.written(df, name)

    monkeypatch.setattr(topk_search, "written", written)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", None)
    topk_search.search(frame(spark, docs)).collect()
    assert sizes["packed"] <= 512 and sizes["weighted"] <= 512 and sizes["found"] == 1
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", None) == before
    monkeypatch.setattr(topk_search, "ShardIndex", Counted)
    cells = {"ids": [4, 7], "no_id": [False, True], "words": [2, 2], "doc": [0, 1], "term": [9, 9], "tf": [1, 2]}
    shard = pa.table({c: pa.array([np.array(v, topk_search.INDEX[c]).tobytes()] * 3, pa.binary()) for c, v in cells.items()}).to_batches()[0]
    got = list(topk_search.answers([shard, shard], [(50, np.array([9], np.uint64), np.array([1.0]))], 2.0, 5))
    assert most == [0] * 6 and all(b.column("doc_id").to_pylist() == [None, 4] for b in got)


def test_topk_prunes():
    """Postings behind the pivot are looked up in few blocks; the list is that of all documents."""
    rng = np.random.default_rng(3)
    docs = [np.unique(np.concatenate((rng.integers(0, 30, 25), 30 + i // 300 * 397 + rng.integers(0, 397, 20)))).astype(np.uint64) for i in range(3000)]
    doc = np.repeat(np.arange(3000), [len(d) for d in docs])
    term = np.concatenate(docs)
    order = np.argsort(term, kind="stable")
    index = topk_search.ShardIndex(doc[order], term[order], np.ones(len(doc), int), np.full(3000, 45), 45.0)
    scored = []
    plain = index.scores
    index.scores = lambda at, w, blocks: (scored.append(len(blocks)), plain(at, w, blocks))[1]
    crowded = topk_search.ShardIndex(doc[order], term[order], np.ones(len(doc), int), np.full(3000, 45), 45.0)
    crowded.crowded, crowded.skipped = 1, -10**9
    for q in range(0, 3000, 300):
        w = np.where(docs[q] < 30, 0.1, 7.0)
        want = np.zeros(3000)
        weight = np.zeros(4000)
        weight[docs[q].astype(int)] = w
        for i, d in enumerate(docs):
            want[i] = weight[d.astype(int)].sum()
        scored.clear()
        got = index.top(docs[q], w, np.arange(3000), 10)
        best = sorted(range(3000), key=lambda i: (-round(want[i], 9), i))[:10]
        assert [i for i, _ in got] == best and sum(scored) < index.blocks / 2
        assert [(i, round(x, 6)) for i, x in crowded.top(docs[q], w, np.arange(3000), 10)] == [(i, round(x, 6)) for i, x in got]


def test_topk_rows_follow_tasks(spark, monkeypatch):
    """Shards of a task share one list per query: rows are bounded by the tasks, not by the shards; the lists stay exact."""
    rng = random.Random(12)
    docs = [(i, prose(rng, rng.randrange(20, 120), 300)) for i in range(400)] + [(None, prose(rng, 60, 300)), (500, "")]
    shards, rows = [], []

    def written(df, name):
        out = common.written(df, name)
        if name in ("index", "found"):
            (shards if name == "index" else rows).append(out.count())
        return out

    monkeypatch.setattr(topk_search, "written", written)
    monkeypatch.setattr(topk_search, "SHARD_BYTES", 2_000)
    found = topk_search.search(frame(spark, docs)).collect()
    tasks = 2 * spark.sparkContext.defaultParallelism
    assert sum(shards) > 4 * tasks and 8 * 10 <= sum(rows) <= 2 * tasks * 8 * 10
    want = [(q, d, round(s, 6)) for q, d, s in brute.bm25([(-1 if d is None else d, t) for d, t in docs]) if q >= 0]
    assert sorted((r.query_id, -1 if r.doc_id is None else r.doc_id, round(r.score, 6)) for r in found) == sorted(want)


def test_topk_together():
    """Many queries at once, over shards whose scores bound the next ones: the lists of all documents."""
    rng = np.random.default_rng(5)
    docs = [np.unique(rng.zipf(1.3, 60) % 2000).astype(np.uint64) for _ in range(1500)]
    docs[700:720] = [docs[3]] * 20  # copies of a query
    words = np.full(500, 60)

    def shard(n):
        own = docs[500 * n : 500 * n + 500]
        doc, term = np.repeat(np.arange(500, dtype=np.int32), [len(d) for d in own]), np.concatenate(own)
        order = np.argsort(term, kind="stable")
        cells = [500 * n + np.arange(500), np.zeros(500, bool), words, doc[order], term[order], np.ones(len(doc), np.int32)]
        return pa.RecordBatch.from_arrays([pa.array([np.asarray(c, t).tobytes()], pa.binary()) for c, t in zip(cells, topk_search.INDEX.values())], names=list(topk_search.INDEX))

    weight = rng.random(2000) + 0.1
    asks = [(q, docs[q], weight[docs[q].astype(int)]) for q in range(0, 1500, 3)]
    (got,) = topk_search.merged([shard(n) for n in range(3)], asks, 60.0, 10)
    impact = 1 * (topk_search.K1 + 1) / (1 + topk_search.K1)
    matrix = np.zeros((1500, 2000))
    for i, d in enumerate(docs):
        matrix[i, d.astype(int)] = 1
    want = []
    for q, h, w in asks:
        score = np.round(matrix[:, h.astype(int)] @ w * impact, 9)
        want += [(q, i, score[i]) for i in sorted(np.flatnonzero(score).tolist(), key=lambda i: (-round(score[i], 7), i))[:10]]
    assert [(q, i) for q, i, _ in want] == list(zip(got.column("q").to_pylist(), got.column("doc_id").to_pylist()))
    assert np.allclose([s for _, _, s in want], got.column("score").to_numpy())


def test_topk_long_lists_only():
    """Texts of words that all documents share: no list is short."""
    docs, terms = 600, np.array([3, 9], np.uint64)
    doc, term = np.tile(np.arange(docs), 2), np.repeat(terms, docs)
    index = topk_search.ShardIndex(doc, term, np.arange(2 * docs) % 7 + 1, np.full(docs, 8), 8.0)
    index.crowded, index.skipped = 1, 0
    got = index.top(terms, np.array([1.0, 2.0]), np.arange(docs), 10)
    index.crowded = 0
    assert got == index.top(terms, np.array([1.0, 2.0]), np.arange(docs), 10) and len(got) == 10


def test_host_query(spark, rows):
    got = sorted(tuple(r)[:8] for r in QUERIES["op9_host_rules"](spark, SF).collect())
    assert got == sorted(brute.hosts(rows))


def test_host_bad_host(spark):
    rng = random.Random(11)
    rows = [(i, prose(rng, 60), f"h{i % 5}") for i in range(50)]
    rows += [(100 + i, "## " * 60 + prose(rng, 60), "bad") for i in range(30)] + [(200, prose(rng, 70), "bad"), (201, prose(rng, 70), None)]
    df = spark.createDataFrame([(d, t, s) for d, t, s in rows], "doc_id long, text string, source string")
    got = sorted(tuple(r)[:-1] for r in host_rules.judge(df).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host_rate").collect())
    assert got == sorted(brute.hosts(rows))
    kept = {r[0]: r[7] for r in got}
    assert kept[200] and kept[201] and not kept[100]


def test_classifier(spark):
    """Held-out: the labels table is never read by the operator; its insults are English words."""
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op10_quality_classifier"](spark, sf)
    truth = spark.read.parquet(f"{sf}/labels.parquet").join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = got.join(truth, "doc_id").collect()
    toxic = [r.kept for r in rows if r.toxic and r.lang == "en"]
    poor = [r.kept for r in rows if not r.quality]
    clean = [r.kept for r in rows if r.quality and not r.toxic]
    assert toxic and sum(toxic) <= 0.1 * len(toxic)
    assert sum(poor) <= 0.1 * len(poor)
    assert sum(clean) >= 0.95 * len(clean)


def test_classifier_drops_toxic_documents_of_all_languages(spark):
    """Held out: the labels of odd key hash, which the operator never reads."""
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op10_quality_classifier"](spark, sf)
    truth = spark.read.parquet(f"{sf}/labels.parquet").join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = got.join(truth.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1), "doc_id").collect()
    toxic = [r for r in rows if r.toxic]
    dropped = {lang: [not r.kept for r in toxic if r.lang == lang] for lang in ("de", "en", "es", "fr")}
    assert all(sum(x) >= 0.5 * len(x) > 0 for x in dropped.values()), dropped
    assert sum(not r.kept for r in toxic) >= 0.9 * len(toxic)
    clean = [r.kept for r in rows if r.quality and not r.toxic]
    assert sum(clean) >= 0.95 * len(clean)


def test_insult_labeller_abstains(spark):
    docs = frame(spark, [(1, "what a clown"), (2, "what a day"), (3, "so ein DUMPFX heute"), (4, None)])
    got = {r.doc_id: r.v_insult for r in weak_labels.votes(docs.withColumn("lang", F.when(F.col("doc_id") == 3, "de").otherwise("en")), {"de": ["dumpfx"]}).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 2}
    got = {r.doc_id: r.v_insult for r in weak_labels.votes(docs.withColumn("lang", F.lit(None).cast("string")), {"de": ["dumpfx"]}).collect()}
    assert got == {1: 1, 2: 2, 3: 2, 4: 2}


def test_training_sample_is_picked_without_texts(spark, monkeypatch):
    """The same rows as a plain sort and limit, copies included, with no sort or limit over texts."""
    monkeypatch.setattr(weak_labels, "TRAIN_ROWS", 50)
    for copies in (1, 30, 300):
        d = frame(spark, [(i, f"text {i}") for i in range(400)] + [(None, "copy")] * copies)
        d = d.select("doc_id", "text", *[F.lit(0).alias(v) for v in weak_labels.VOTES], F.lit(0.5).alias("posterior"))
        want = d.orderBy(F.xxhash64("doc_id", "text"), "doc_id").limit(50).groupBy("doc_id", "text").count()
        got = weak_labels.train_sample(d)
        assert sorted(map(str, ((r.doc_id, r.text, r.m) for r in got.collect()))) == sorted(map(str, map(tuple, want.collect())))
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "Limit" not in plan and "Sort" not in plan


def test_em_recovers_labellers(monkeypatch):
    """Without its prior the estimate is that of the votes alone."""
    monkeypatch.setattr(weak_labels, "STRENGTH", 0.0)
    rng = np.random.default_rng(3)
    bad = rng.random(20_000) < 0.3
    votes = np.stack([np.where(rng.random(20_000) < 0.2, 2, np.where(bad, rng.random(20_000) < a, rng.random(20_000) < 0.02)) for a in (0.9, 0.6, 0.4)], 1)
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    post, table, share = weak_labels.expectation_maximisation(patterns, counts.astype(float))
    assert abs(share - 0.3) < 0.05 and np.allclose(table[:, 1], (0.9, 0.6, 0.4), atol=0.05)
    assert ((post[inverse.reshape(-1)] > 0.5) == bad).mean() > 0.85


OPERATORS = {
    1: substring_index.dedup, 2: minmax_dedup.near_duplicates, 3: byte_bpe.round_trip, 4: relative_lz.dedup, 5: packing.pack, 6: license_scan.scan, 7: secret_scan.scan,
    8: topk_search.search, 9: host_rules.judge, 10: weak_labels.classify,
}


@pytest.mark.parametrize("number", OPERATORS)
def test_edges(spark, odd, number):
    out = OPERATORS[number](odd).collect()
    if number not in (5, 8):
        assert sorted(map(str, (r.doc_id for r in out))) == sorted(map(str, (r.doc_id for r in odd.collect())))
    assert OPERATORS[number](odd.limit(0)).count() == 0


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_edges(spark, odd, name, stage):
    out = stage(spark, odd, SF)
    if name != "packing":
        assert out.schema.simpleString() == odd.schema.simpleString()
    assert out.count() > 0
    assert stage(spark, odd.limit(0), SF).count() == 0


def test_one_of_each_group_stays(spark, odd):
    kept = [r.doc_id for r in corpus_pipeline.minmax_dedup(spark, odd, SF).collect()]
    assert sum(d in (None, 5, 50) for d in kept if d != 1) >= 1
    twice = frame(spark, [(1, "a b c d e f g"), (1, "a b c d e f g"), (1, "A b c d e f g"), (None, "q r s t u v"), (None, "Q r s t u v"), (3, "a b c d e f g")])
    assert corpus_pipeline.minmax_dedup(spark, twice, SF).count() == 2


def test_pipeline(spark, rows):
    """The whole chain by the plain versions."""
    verdict = {r[0]: r[7] for r in brute.hosts(rows)}
    left = [(d, t) for d, t, _ in rows if verdict[d]]
    one = {r[0] for r in brute.near(left, 5) if r[3]}
    left = [(d, t) for d, t in left if d in one]
    data = [(t or "").encode() for _, t in left]
    left = [(d, bytes(brute.without(s, hit)).decode("utf-8", "ignore")) for (d, _), s, hit in zip(left, data, brute.covered(data, corpus_pipeline.PASSAGE), strict=True)]
    texts = {}
    for d, t in left:
        out, at = [], 0
        for s, k, e in spans_of(t):
            if s >= at:
                out += [t[at:s], f"[{secret_scan.KINDS[k]}]"]
            at = max(at, e)
        texts[d] = "".join(out) + t[at:]
    check_pieces(corpus_pipeline.run(spark, SF).collect(), texts)
