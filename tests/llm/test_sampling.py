"""Importance resampling, token alignment and source mixing against plain versions, and their edge cases."""

import hashlib
import math
import random
import re
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from voltwatch.llm import source_mixing, target_resampling, token_alignment
from voltwatch.llm.catalog import QUERIES

SF = "/root/testdata/sf0.001"
#: Names that the operators use inside, as extra columns of the input.
CLASHES = "number long, level string, key long, size long, n string, low long, id long, place long, u double, rate long, h long, links long, part long"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}"


def prose(rng, n, vocabulary=300):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def frame(spark, rows):
    clash = (7, "x", 7, 7, "y", 7, 7, 7, 0.5, 7, 7, 7, 7)
    return spark.createDataFrame([(d, t, "en", s, len(t or ""), *clash) for d, t, s in rows], SCHEMA)


def sample(spark, query):
    return [tuple(r) for r in query.collect()]


@pytest.fixture(scope="module")
def corpus(spark):
    return [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


@pytest.fixture(scope="module")
def targets(spark):
    return [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(9)
    text, long = prose(rng, 60), prose(rng, 40_000, 5000)
    rows = [
        (1, None, "b"), (2, "", "b"), (3, " \n\t", None), (None, text, "a"), (None, text, "a"), (None, text, "a"), (5, text, "a"), (5, text, "a"),
        (5, text + " more", "a"), (6, long, "é"), (7, "x" * 60_000, "Z"), (8, "ÄÖ 漢字 🙂 " * 50, None), (9, "a ▁ b", "a"), (10, "<|endoftext|> <s> <0x41>", "b"),
        (11, "one\ntwo\none\none " + text, ""), (12, "\x00\x01 tab\there  two  spaces ", "b"), (None, None, None),
    ]
    return rows + [(100 + i, prose(rng, 5 + 3 * i), "abc"[i % 3]) for i in range(30)]


# ------------------------------------------------------------- operator 11
def plain_resample(docs, targets, percent=10, least=20, seed=2024):
    def features(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return [zlib.crc32(w.encode()) % 10_000 for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)]

    own = [(d, features(t)) for d, t, _ in docs]
    s, t = Counter(b for _, f in own for b in f), Counter(b for x in targets for b in features(x))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000)))) for b in range(10_000)]
    rows = []
    for d, f in own:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append((d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[3], math.inf if r[0] is None else r[0], r[1]))
    k = percent * len(able) // 100
    drawn = able[:k]
    rest = Counter(rows) - Counter(drawn)
    return sorted([(*r, i + 1) for i, r in enumerate(drawn)] + [(*r, None) for r in rest.elements()], key=str)


def test_resampling_query(spark, corpus, targets):
    assert sorted(sample(spark, QUERIES["op11_target_resampling"](spark, SF)), key=str) == plain_resample(corpus, targets)


@pytest.mark.parametrize("percent", [0, 1, 37, 100])
def test_resampling_edges(spark, odd, targets, percent):
    """Chunks of seven keys and no final sort: every cutoff is found by the rounds alone."""
    got = target_resampling.resample(frame(spark, odd), frame(spark, [(i, t, "s") for i, t in enumerate(targets)]), percent=percent, chunk=7, last=0)
    assert sorted(sample(spark, got), key=str) == plain_resample(odd, targets, percent)


def test_resampling_empty(spark, odd):
    empty = frame(spark, odd).limit(0)
    assert target_resampling.resample(empty, empty).collect() == []
    got = target_resampling.resample(frame(spark, odd), empty)
    assert sorted(sample(spark, got), key=str) == plain_resample(odd, [])


def test_cutoff_is_exact(spark):
    """Ties of every depth, a third of the keys alike but for their place, each rank asked for."""
    rng = random.Random(4)
    keys = [(0, 0, 0, i) if i % 3 == 0 else (rng.randrange(-3, 3), rng.randrange(4), rng.randrange(2), i) for i in range(900)]
    df = spark.createDataFrame(keys, "low long, id long, n long, place long").repartition(5)
    keys.sort()
    for k in (1, 2, 77, 450, 899, 900):
        assert target_resampling.cutoff(df, k, chunk=50, last=0) == keys[k - 1]


def test_cutoff_discards_a_quarter(spark, monkeypatch):
    """Rounds stay logarithmic: no round keeps more than three quarters (plus one key per chunk)."""
    sizes = []
    plain = target_resampling.weighted_median

    def counted(rows):
        sizes.append(sum(n for n, _ in rows))
        return plain(rows)

    monkeypatch.setattr(target_resampling, "weighted_median", counted)
    df = spark.range(4000).selectExpr("id * id % 4001 low", "id", "id n", "id place").repartition(6)
    target_resampling.cutoff(df, 1234, chunk=300, last=0)
    assert len(sizes) > 4
    assert all(b <= 0.75 * a + 20 for a, b in zip(sizes, sizes[1:], strict=False))


# ------------------------------------------------------------- operator 12
@pytest.fixture(scope="module")
def models():
    import sentencepiece

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def plain_alignment(models, docs):
    a_model, b_model = models
    bytes_a, _ = token_alignment.byte_level_tokens(public_tokenizers.path("byte_bpe_50k.json"))

    def bytes_b(i):
        piece = b_model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if re.fullmatch(r"<0x[0-9A-F]{2}>", piece) else piece.replace("▁", " ").encode()

    rows, links = [], []
    for d, text, _ in docs:
        whole = (" " + (text or "")).encode()
        a = a_model.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_model.encode(text, num_threads=1) if text else []
        if not text or b"".join(bytes_a[i] for i in a) != whole or b"".join(bytes_b(i) for i in b) != whole:
            rows.append((d, 0, 0, 0, ""))
            links.append([])
            continue
        ends_a, ends_b = (np.cumsum([len(x) for x in v]).tolist() for v in ([bytes_a[i] for i in a], [bytes_b(i) for i in b]))
        groups, own, i0, j0 = [], [], 0, 0
        for e in sorted(set(ends_a) & set(ends_b)):
            i, j = ends_a.index(e, i0) + 1, ends_b.index(e, j0) + 1
            groups.append(",".join(map(str, a[i0:i])) + "|" + ",".join(map(str, b[j0:j])))
            own.append((a[i - 1], b[j - 1]))
            i0, j0 = i, j
        rows.append((d, len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        links.append(own)
    counts = Counter(x for own in links for x in own)
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return sorted(
        ((d, na, nb, ng, len(own), sum(counts[x] == most[x[1]] for x in own), sum(counts[x] for x in own), h)
         for (d, na, nb, ng, h), own in zip(rows, links, strict=True)), key=str)


def test_alignment_query(spark, corpus, models):
    assert sorted(sample(spark, QUERIES["op12_token_alignment"](spark, SF)), key=str) == plain_alignment(models, corpus)


def test_alignment_edges(spark, odd, models):
    paths = [public_tokenizers.path(n) for n in (token_alignment.VOCABULARY, token_alignment.PIECES)]
    got = sample(spark, token_alignment.alignment(frame(spark, odd), *paths))
    assert sorted(got, key=str) == plain_alignment(models, odd)
    zero = {r[0]: r[1:] for r in got}
    assert zero[9] == (0, 0, 0, 0, 0, 0, "") and zero[10][0] > 0
    assert token_alignment.alignment(frame(spark, odd).limit(0), *paths).collect() == []


def test_skip_runs():
    """Random end arrays of long and short one-to-one stretches, groups that keep or change the shift."""
    rng = random.Random(6)
    for _ in range(400):
        density = rng.choice([0.02, 0.3, 0.9])
        n = rng.randrange(1, 400)
        a = [x for x in range(1, n) if rng.random() > density] + [n]
        b = [x for x in a[:-1] if rng.random() > density / 2]
        b = sorted({*b, n, *(x for x in range(1, n) if rng.random() < density / 3)})
        i, j = token_alignment.links_of(a, b)
        common = sorted(set(a) & set(b))
        assert i.tolist() == [bisect_left(a, x) for x in common] and j.tolist() == [bisect_left(b, x) for x in common]
    assert token_alignment.skip_runs(list(range(1, 50_001)), list(range(1, 50_001))) == [(0, 0, 50_000)]


def test_all_pairs_are_listed():
    pair = token_alignment.tokenizers_of(*(public_tokenizers.path(n) for n in (token_alignment.VOCABULARY, token_alignment.PIECES)))
    assert len(pair.codes) <= sum(map(len, pair.bytes_a)) + 2 * sum(map(len, pair.bytes_b))
    some = np.random.default_rng(1).permutation(pair.codes)[:5000]
    assert (pair.codes[pair.numbering.find(some)] == some).all()
    a, b = [b"ab", b"b", b"cab", b"x"], [b"b", b"ab", b"b", b"y"]
    want = {i * 4 + j for i in range(4) for j in range(4) if a[i].endswith(b[j]) or b[j].endswith(a[i])}
    assert set(token_alignment.possible_pairs(a, b).tolist()) == want


# ------------------------------------------------------------- operator 13
def plain_mix(docs, seed=13):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sources = sorted({s for _, _, s in docs}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size(t) for _, t, x in docs if x == s) for s in sources}
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sources)}
    budget, full = sum(total.values()) * 1.5, set()
    while True:  # share, stop the full ones, share again
        rest = [s for s in sources if s not in full]
        c = (budget - sum(2 * total[s] for s in full)) / sum(weight[s] for s in rest)
        more = {s for s in rest if c * weight[s] >= 2 * total[s]}
        if not more:
            break
        full |= more
    target = {s: 2.0 * total[s] if s in full else c * weight[s] for s in sources}
    out = []
    for s in sources:
        own = []
        for d, t, x in docs:
            if x == s:
                lines = (t or "").split("\n")
                name = str(d) if d is not None else hashlib.md5((t or "").encode()).hexdigest()
                u = (int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:12], 16) + 0.5) / 2**48
                own.append([d, size(t), 1 + 3 * len(set(lines)) // len(lines), u])
        words = Counter()
        for _, n, level, _ in own:
            words[level] += n
        low, high = 0.0, 2.0
        for _ in range(200):  # the factor by halving
            mid = (low + high) / 2
            low, high = (mid, high) if sum(min(2, mid * k) * n for k, n in words.items()) < target[s] else (low, mid)
        rate = {k: min(2.0, high * k) if high < 2 - 1e-9 else 2.0 for k in words}
        whole = {k: math.floor(rate[k] + 1e-9) for k in words}
        left = math.floor(target[s] + 1e-9) - sum(whole[k] * n for k, n in words.items())
        keyed = []
        for row in own:
            p = rate[row[2]] - whole[row[2]]
            q = row[3] / (1 - row[3]) / (p / (1 - p)) if p > 1e-9 and row[1] else None
            keyed.append((row, q))
        same = Counter(q for _, q in keyed if q is not None)
        taken = {}
        for q in sorted(same):
            here = [r[1] for r, x in keyed if x == q]
            full_words = sum(here)
            taken[q] = None if full_words < left else max(left, 0) // len(here)
            left -= full_words
        for row, q in keyed:
            extra = 0 if q is None else row[1] if taken[q] is None else min(row[1], taken[q])
            out.append((row[0], row[1], total[s], round(target[s], 6), whole[row[2]] * row[1] + extra))
    return sorted(out, key=str)


def rounded(rows):
    return sorted(((d, n, s, round(t, 6), x) for d, n, s, t, x, _ in rows), key=str)


def test_mixing_query(spark, corpus):
    got = sample(spark, QUERIES["op13_source_mixing"](spark, SF))
    assert rounded(got) == plain_mix(corpus)
    assert sorted(got) == sorted(sample(spark, QUERIES["op13_source_mixing"](spark, SF)))


def test_mixing_edges(spark, odd):
    got = sample(spark, source_mixing.mix(frame(spark, odd)))
    assert rounded(got) == plain_mix(odd)
    assert all(x <= 2 * n for _, n, _, _, x, _ in got)
    empty = frame(spark, odd).limit(0)
    assert source_mixing.mix(empty).collect() == []
    assert sample(spark, source_mixing.mix(frame(spark, [(1, None, "a"), (2, " ", None)]))) in ([(1, 0, 0, 0.0, 0, None), (2, 0, 0, 0.0, 0, None)], [(2, 0, 0, 0.0, 0, None), (1, 0, 0, 0.0, 0, None)])


def test_mixing_meets_targets(spark):
    """A source with a third of the rows, long documents, copies: taken words equal the floored targets."""
    rng = random.Random(8)
    rows = [(i, prose(rng, rng.choice([3, 50, 400])), "hot" if i % 3 == 0 else f"s{i % 41}") for i in range(600)]
    rows += [(None, rows[0][1], "hot")] * 50 + [(1000, prose(rng, 30_000), "hot")]
    words = defaultdict(lambda: [0.0, 0])
    source = {d: s for d, _, s in rows}
    for d, _, _, target, taken, _ in sample(spark, source_mixing.mix(frame(spark, rows))):
        words[source[d]][0] = target
        words[source[d]][1] += taken
    assert len(words) == 42
    for target, taken in words.values():
        assert target - 52 <= taken <= target


def test_mixing_probabilities(spark):
    """Over many seeds, documents of twice the importance are taken about twice as often."""
    from pyspark.sql import functions as F

    rows = [(i, "a b c d", "s" if i < 60 else "t") for i in range(90)]
    df = frame(spark, rows)
    level = F.when(F.col("doc_id") % 3 == 0, 4).otherwise(1).cast("long")
    words = Counter()
    for seed in range(12):
        for d, _, _, _, taken, rate in sample(spark, source_mixing.mix(df, weights=(1, 5), percent=50, level=level, seed=seed)):
            if d < 60:
                words[d % 3 == 0] += taken
                assert rate <= 2
    share = words[True] / (words[True] + words[False])
    assert 0.55 < share < 0.8  # 20 documents of level 4 against 40 of level 1: two thirds
