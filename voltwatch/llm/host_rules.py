"""Operator 9: host-level quality rules (DataFrame functions only).

Per document, word and line rules are counted inside the row.  Failures are
then aggregated per host (``source``), each host's failure rate is shrunk
with a beta prior fitted to all hosts by moments, and the verdict is joined
back: a document goes if it fails a base rule, or if its host is bad and the
document itself breaks a soft rule.  A clean document of a bad host stays.

Defined cases: null or empty text has no words (base_failed, not kept); a
null host is a host of its own; repeated rows are judged alike and count as
often as they occur; an empty table gives an empty result; extra columns are
ignored by ``judge`` and kept by ``keep_good``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltwatch.llm.common import SPACES, text_of, written

MIN_WORDS = 50
#: Share of words in repeated 3-word windows above which a text fails, in percent.
MAX_REPEAT_PCT = 50
#: Soft rules: symbols per word, share of duplicate lines, mean word length.
SOFT_SYMBOLS, SOFT_DUP_LINES, SOFT_WORD_LEN = 0.5, 0.3, (2.0, 14.0)
#: Bits of a packed long that hold a window's position.
BITS = 24
LOW = (1 << BITS) - 1
#: A host whose shrunk failure rate is above this is bad.
BAD_HOST = 0.5


def document_rules(df: DataFrame, text: str = "text") -> DataFrame:
    """df with n_words, word_chars, n_symbols, n_dup_lines, n_lines,
    n_repeat_words, base_failed and soft_failed, all computed within the row.

    Repeated 3-word windows are found without a shuffle.  Each window's hash
    shares a long with its position (40 and 24 bits); sorting the longs puts
    equal windows side by side.  Only those candidates are compared by their
    full 64-bit hash, and gaps between their positions give the words covered.
    Texts of over 2^24 words take every window as a candidate.
    """
    keep = df.columns
    raw = text_of(text)
    rare = F.lit(False)
    for ch in "\t\x0b\x0c\r":
        rare = rare | F.contains(raw, F.lit(ch))
    spaced = F.when(rare, F.translate(raw, "\t\n\x0b\x0c\r", "     ")).otherwise(F.replace(raw, F.lit("\n"), F.lit(" ")))
    lines = F.filter(F.split(raw, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    df = df.select(
        *keep,
        F.array_remove(F.split(spaced, " "), "").alias("_w"),
        lines.alias("_l"),
        F.regexp_count(raw, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
    )
    n = F.size("_w")
    starts = F.slice("_w", F.lit(1), F.greatest(n - 2, F.lit(0)))
    window = lambda w, i: F.xxhash64(w, F.get(F.col("_w"), i + 1), F.get(F.col("_w"), i + 2))
    df = df.select(
        *keep,
        n.cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        "n_symbols",
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.transform(starts, window).alias("_h"),
    )
    packed = lambda h, i: h.bitwiseAND(~LOW).bitwiseOR(i.cast("long"))
    df = df.withColumn("_s", F.when(F.size("_h") <= LOW, F.sort_array(F.transform("_h", packed))))
    near = lambda x, k: F.shiftright(F.get(F.col("_s"), k), BITS) == F.shiftright(x, BITS)
    some = F.filter("_s", lambda x, k: F.coalesce(near(x, k - 1), F.lit(False)) | F.coalesce(near(x, k + 1), F.lit(False)))
    places = F.coalesce(
        F.transform(some, lambda x: x.bitwiseAND(LOW).cast("int")),
        F.transform("_h", lambda h, i: i),
    )
    df = df.withColumn("_c", places)
    df = df.withColumn("_f", F.sort_array(F.transform("_c", lambda p: F.struct(F.get(F.col("_h"), p).alias("h"), p.alias("p")))))
    same = lambda x, k: F.get(F.col("_f"), k)["h"] == x["h"]
    twice = F.filter("_f", lambda x, k: F.coalesce(same(x, k - 1), F.lit(False)) | F.coalesce(same(x, k + 1), F.lit(False)))
    df = df.withColumn("_p", F.sort_array(F.transform(twice, lambda x: x["p"])))
    covered = F.aggregate(
        F.transform("_p", lambda p, k: F.least(F.lit(3), F.coalesce(p - F.get(F.col("_p"), k - 1), F.lit(3)))),
        F.lit(0),
        lambda a, x: a + x,
    )
    df = df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    mean_len = F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))
    return df.select(
        *keep,
        "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))).alias("base_failed"),
        (
            (F.col("n_symbols") > SOFT_SYMBOLS * F.col("n_words"))
            | (F.col("n_dup_lines") > SOFT_DUP_LINES * F.col("n_lines"))
            | (mean_len < SOFT_WORD_LEN[0])
            | (mean_len > SOFT_WORD_LEN[1])
        ).alias("soft_failed"),
    )


def host_rates(judged: DataFrame, host: str = "source") -> DataFrame:
    """One row per host: n_docs, n_failed, rate, shrunk, host_bad.

    The beta prior comes from the hosts' mean rate m and variance v, less the
    binomial noise m(1-m)E[1/n]; its strength m(1-m)/v - 1 is kept in [1, 1e6].
    The three moments are one row, the only thing the driver sees.
    """
    failed = (F.col("base_failed") | F.col("soft_failed")).cast("long")
    hosts = written(
        judged.groupBy(F.col(host).alias("host")).agg(F.count("*").alias("n_docs"), F.sum(failed).alias("n_failed")),
        "hosts",
    ).withColumn("rate", F.col("n_failed") / F.col("n_docs"))
    m, v, inv = hosts.agg(F.avg("rate"), F.var_pop("rate"), F.avg(1 / F.col("n_docs"))).first()
    m = 0.0 if m is None else m
    noise_free = (v or 0.0) - m * (1 - m) * (inv or 0.0)
    strength = min(1e6, max(1.0, m * (1 - m) / noise_free - 1)) if noise_free > 0 else 1e6
    if m in (0.0, 1.0):
        strength = 1.0
    shrunk = (F.col("n_failed") + m * strength) / (F.col("n_docs") + strength)
    return hosts.withColumn("shrunk", shrunk).withColumn("host_bad", F.col("shrunk") > BAD_HOST)


def with_verdict(judged: DataFrame, host: str = "source") -> DataFrame:
    """judged plus host_rate and kept.

    The host table is a small written file, so Spark itself broadcasts it
    while its size allows and else joins by a shuffle that AQE splits.
    """
    hosts = written(host_rates(judged, host).select("host", "shrunk", "host_bad"), "verdicts")
    out = judged.join(hosts, judged[host].eqNullSafe(hosts["host"]), "left")
    kept = ~F.col("base_failed") & ~(F.col("host_bad") & F.col("soft_failed"))
    return out.select(judged["*"], F.col("shrunk").alias("host_rate"), kept.alias("kept"))


def judge(docs: DataFrame) -> DataFrame:
    """One row per document with the rule counts and the verdict, without its text."""
    rules = document_rules(docs.select("doc_id", "source", "text")).drop("text")
    return with_verdict(written(rules, "rules"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with their own columns only."""
    packed = docs.select(F.struct("*").alias("row"), "text", "source")
    rules = document_rules(packed).drop("text")
    judged = written(rules.select("row", "source", "base_failed", "soft_failed"), "rules")
    return with_verdict(judged).where("kept").select("row.*")


def op9_host_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "host_rate",
    )
