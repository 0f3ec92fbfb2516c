"""Plain versions of the operators over lists of (doc_id, text)."""

import hashlib
import re
from collections import Counter
from itertools import combinations
from math import log

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def lower(t: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def covered(seqs: list, length: int) -> list[list[bool]]:
    """Per sequence, the places covered by a window that starts at two places of the corpus."""
    seen = Counter(s[i : i + length] for s in seqs for i in range(len(s) - length + 1))
    out = []
    for s in seqs:
        hit = [False] * len(s)
        end = 0
        for i in range(len(s) - length + 1):
            if seen[s[i : i + length]] > 1:
                for j in range(max(i, end), i + length):
                    hit[j] = True
                end = i + length
        out.append(hit)
    return out


def without(s, hit):
    return [x for x, h in zip(s, hit, strict=True) if not h]


def substring(docs, length=400):
    data = [(t or "").encode() for _, t in docs]
    out = []
    for (doc, _), s, hit in zip(docs, data, covered(data, length), strict=True):
        spans = sum(h and not (i and hit[i - 1]) for i, h in enumerate(hit))
        out.append((doc, len(s), sum(hit), spans, sha(bytes(without(s, hit)))))
    return out


def passages(docs, length=35):
    words = [tuple(WORD.findall(t or "")) for _, t in docs]
    hits = covered(words, length)
    return [(doc, len(w), sum(h), sha(" ".join(without(w, h)).encode())) for (doc, _), w, h in zip(docs, words, hits, strict=True)]


def shingles(text, n=4) -> frozenset:
    w = WORD.findall(lower(text or ""))
    return frozenset([tuple(w)] if 0 < len(w) < n else [tuple(w[i : i + n]) for i in range(len(w) - n + 1)] if w else [])


def near(docs, n=4, percent=80):
    """(doc_id, n_shingles, component_id, kept)."""
    sets = [shingles(t, n) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(docs)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
            both = len(a & b)
            if 100 * both >= percent * (len(a) + len(b) - both):
                root[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, (doc, _) in enumerate(docs):
        least[find(i)] = min(doc, least.get(find(i), doc))
    return [(doc, len(s), least[find(i)], doc == least[find(i)]) for i, ((doc, _), s) in enumerate(zip(docs, sets, strict=True))]


def rules(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, soft_failed)."""
    t = text or ""
    w = WORD.findall(t)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    seen, cover = Counter(windows), set()
    for i, x in enumerate(windows):
        if seen[x] > 1:
            cover |= {i, i + 1, i + 2}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    dup, symbols, chars = len(lines) - len(set(lines)), len(re.findall(r"[#*$%&|<>]", t)), sum(map(len, w))
    mean = chars / max(1, len(w))
    soft = symbols > 0.5 * len(w) or dup > 0.3 * len(lines) or mean < 2.0 or mean > 14.0
    return len(w), chars, symbols, dup, len(cover), len(w) < 50 or 100 * len(cover) > 50 * len(w), soft


def hosts(rows):
    """rows: (doc_id, text, host) -> (doc_id, five counts, base_failed, kept)."""
    judged = [(doc, host, rules(t)) for doc, t, host in rows]
    n, bad = Counter(h for _, h, _ in judged), Counter(h for _, h, r in judged if r[5] or r[6])
    rate = [bad[h] / n[h] for h in n]
    m, v = float(np.mean(rate)), float(np.var(rate))
    free = v - m * (1 - m) * float(np.mean([1 / n[h] for h in n]))
    strength = min(1e6, max(1.0, m * (1 - m) / free - 1)) if free > 0 else 1e6
    strength = 1.0 if m in (0.0, 1.0) else strength
    shrunk = {h: (bad[h] + m * strength) / (n[h] + strength) for h in n}
    return [(doc, *r[:6], not r[5] and not (shrunk[h] > 0.5 and r[6])) for doc, h, r in judged]


def bm25(docs, every=50, k=10):
    """(query_id, doc_id, score) of the k best, by score and then by doc_id."""
    words = [Counter(WORD.findall(lower(t or ""))) for _, t in docs]
    size = [sum(w.values()) for w in words]
    mean, df = sum(size) / len(docs), Counter(x for w in words for x in w)
    idf = {x: log(1 + (len(docs) - n + 0.5) / (n + 0.5)) for x, n in df.items()}
    held: dict[str, list] = {}
    for i, w in enumerate(words):
        for x, tf in w.items():
            held.setdefault(x, []).append((i, tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * size[i] / mean))))
    out = []
    for (doc, _), w in zip(docs, words, strict=True):
        if doc % every == 0:
            score = np.zeros(len(docs))
            for x, n in w.items():
                for i, s in held[x]:
                    score[i] += n * idf[x] * s
            best = sorted((-round(s, 6), docs[i][0], s) for i, s in enumerate(score) if s > 0)[:k]
            out += [(doc, d, s) for _, d, s in best]
    return out


BASE = (
    (re.compile(r"""(?a:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[1]) >= 8),
    (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 32),
)


def secrets(text):
    """Base spans as (start, kind, end)."""
    return sorted((m.start(), k, m.end()) for k, (p, good) in enumerate(BASE) for m in p.finditer(text or "") if good(m))


def phrases(text):
    """(n_words, n_base, first, last, base_labels)."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    found = []
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        p = phrase.split()
        found += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
    at = [i for i, _ in found]
    return len(w), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))
