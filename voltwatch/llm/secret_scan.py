"""Operator 7: secret scan with multipart credential linking.

Strong patterns (``assign``, ``access``, ``hex``) are reported wherever they
stand.  Weak candidates (a short assigned value, an unlabelled mixed-case
token, a login name) are reported only if a complementary part (identifier,
secret, endpoint) lies within ``REACH`` code points of the same document.
That link is an interval join: every part's reach is cut into scopes of
``REACH`` code points, and weak candidates are kept by a left semi join on
(document, scope) plus the distance, so no pairs are produced.

Defined cases: null text counts as empty; empty text has no spans (empty
string, SHA-256 of it); a null or repeated doc_id is told apart by its text,
and copies of a row get the same result once per row; an empty table gives
an empty result; extra columns are ignored (``scan``) or kept (``redact``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltwatch.llm.common import doc_key, text_of, with_text, written

KINDS = ("assign", "access", "hex", "weak_secret", "weak_id")
REACH = 240
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
MIXED = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[a-z+/_=-]*[A-Z0-9])[A-Za-z0-9+/_=-]{20,}")
LOGIN = re.compile(r"""(?:user(?:name)?|login|client_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}""", re.I | re.A)
#: A host starts only where no dotted run goes on, so that a run of any length is tried once.
ENDPOINT = re.compile(r"""https?://[^\s"'<>]+|(?<![A-Za-z0-9-])(?<![A-Za-z0-9-]\.)[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.(?:com|net|org|io|local|internal)\b(?::[0-9]+)?""")
#: Parts a weak candidate of this kind needs nearby: 0 identifier, 1 secret, 2 endpoint.
NEEDS = {3: (0, 2), 4: (1,)}

SPAN = "struct<s:int,k:int,e:int>"
FOUND = f"doc_id long, kd long, kt long, base array<{SPAN}>, weak array<{SPAN}>, parts array<{SPAN}>"


def find_parts(text: str) -> tuple[list, list, list]:
    """(base, weak, parts) as (start, kind, end) in code points."""
    base, weak, parts = [], [], []
    low = text.lower()
    if "passw" in low or "secret" in low or "token" in low or "key" in low:
        for m in ASSIGN.finditer(text):
            (base if len(m[2]) >= 8 else weak if len(m[2]) >= 4 else []).append((m.start(), 0, m.end()))
    if "AKIA" in text:
        base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    base += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    weak = [(s, 3, e) for s, _, e in weak]
    if re.search(r"[0-9]", text):
        for m in MIXED.finditer(text):
            if re.search("[0-9]", m[0]) and re.search("[A-Z]", m[0]) and re.search("[a-z]", m[0]):
                weak.append((m.start(), 3, m.end()))
    if "user" in low or "login" in low or "client" in low:
        weak += [(m.start(), 4, m.end()) for m in LOGIN.finditer(text)]
    if weak:
        weak = _apart(sorted(weak), sorted(base))
    if weak:
        parts = [(s, 0 if k == 1 else 1, e) for s, k, e in base if k != 2]
        parts += [(s, 1 if k == 3 else 0, e) for s, k, e in weak]
        parts += [(m.start(), 2, m.end()) for m in ENDPOINT.finditer(text)]
    return sorted(base), sorted(weak), parts


def _apart(weak: list, base: list) -> list:
    """The weak spans that touch no base span; one sweep over both in order."""
    out, i, reach = [], 0, -1
    for w in weak:
        while i < len(base) and base[i][0] < w[2]:
            reach = max(reach, base[i][2])
            i += 1
        if reach <= w[0]:
            out.append(w)
    return out


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("s", pa.int32()), ("k", pa.int32()), ("e", pa.int32())]))
    named = lambda xs: [{"s": s, "k": k, "e": e} for s, k, e in xs]
    for b in batches:
        found = [[named(x) for x in find_parts(t)] for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("kd"), b.column("kt"), *(pa.array([f[i] for f in found], span) for i in range(3))],
            names=["doc_id", "kd", "kt", "base", "weak", "parts"],
        )


def _linked(found: DataFrame) -> DataFrame:
    """Per document with links: (kd, kt, linked spans); copies of a row enter the join once."""
    both = found.where((F.size("weak") > 0) & (F.size("parts") > 0)).select("kd", "kt", "weak", "parts").dropDuplicates(["kd", "kt"])
    weak = both.select("kd", "kt", F.explode("weak").alias("w"))
    needs = F.when(F.col("w.k") == 3, F.array(*map(F.lit, NEEDS[3]))).otherwise(F.array(*map(F.lit, NEEDS[4])))
    weak = weak.select("kd", "kt", "w", F.explode(needs).alias("need"), (F.col("w.s") / REACH).cast("int").alias("scope"))
    reach = F.sequence(
        F.greatest(F.lit(0), ((F.col("p.s") - REACH) / REACH).cast("int") - 1), ((F.col("p.e") + REACH) / REACH).cast("int")
    )
    parts = both.select("kd", "kt", F.explode("parts").alias("p"))
    parts = parts.select(
        F.col("kd").alias("pd"), F.col("kt").alias("pt"), "p", F.col("p.k").alias("part"), F.explode(reach).alias("at")
    )
    near = (
        (F.col("kd") == F.col("pd")) & (F.col("kt") == F.col("pt")) & (F.col("scope") == F.col("at"))
        & (F.col("need") == F.col("part")) & (F.col("w.s") <= F.col("p.e") + REACH) & (F.col("w.e") >= F.col("p.s") - REACH)
    )
    return weak.join(parts, near, "left_semi").groupBy("kd", "kt").agg(F.collect_set("w").alias("linked"))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"], x["e"])), ",")


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, kd, kt, base spans, all spans (sorted)."""
    keyed = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"), *doc_key())
    found = written(keyed.mapInArrow(_extract, FOUND), "parts")
    linked = _linked(found)
    every = F.array_sort(F.concat("base", F.coalesce("linked", F.array().cast(f"array<{SPAN}>"))))
    return found.join(linked, ["kd", "kt"], "left").select("doc_id", "kd", "kt", "base", every.alias("spans"))


def scan(docs: DataFrame) -> DataFrame:
    found = find_secrets(docs)
    count = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{KINDS[k]}") for k in range(3)),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


@F.pandas_udf(T.StringType())
def _redacted(text: pd.Series, spans: pd.Series) -> pd.Series:
    def one(t, xs):
        if t is None:
            return None
        out, at = [], 0
        for x in xs:
            if x["s"] >= at:
                out += [t[at : x["s"]], f"[{KINDS[x['k']]}]"]
            at = max(at, x["e"])
        return "".join(out) + t[at:]

    return pd.Series([one(t, xs) for t, xs in zip(text, spans, strict=True)], dtype=object)


def redact(docs: DataFrame) -> DataFrame:
    """docs with every span replaced by its kind in brackets; n_chars follows the text."""
    found = find_secrets(docs).where(F.size("spans") > 0).select("kd", "kt", F.col("spans").alias("_spans")).dropDuplicates(["kd", "kt"])
    packed = docs.select(F.struct("*").alias("row"), *doc_key(), F.col("text"))
    out = packed.join(found, ["kd", "kt"], "left")
    out = out.withColumn("_new", _redacted(F.when(F.col("_spans").isNotNull(), F.col("text")), F.coalesce("_spans", F.array().cast(f"array<{SPAN}>"))))
    return with_text(out, docs, F.coalesce("_new", "text"))


def op7_secret_scan(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
