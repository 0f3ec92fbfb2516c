"""Operator 13: mixing sources to target weights by Pareto order sampling (DataFrame functions only).

Sources share a budget of words by weight; a target stops at ``MAX_COPIES``
times its source's size and the excess is shared out again.  Inside a source
a document's expected copies are proportional to its importance (1 to
``LEVELS``, here by its share of distinct lines) and stop at ``MAX_COPIES``
too.  The whole copies are certain.  The fraction p that is left is the
document's inclusion probability: with a fixed random u per document, those
of the least (u / (1 - u)) / (p / (1 - p)) are taken until the source's
remaining words are filled; the document at the cutoff gives only the words
that are missing.  The sample size is thus fixed in words.

No source is sorted.  The ranking key is a 48-bit number; the cutoff key of
all sources is found together by three aggregates of 16 bits each, so a source
with a third of all rows is spread over all tasks.  Tables by source, by
(source, importance) and by (source, 16 bits) are the only ones with windows,
and none of their groups grows with the rows.

Defined cases: null or empty text has size 0 and is never taken; a null
source is a source of its own, numbered last; a null doc_id draws u from the
text; rows that tie on the cutoff key share its words evenly, rounded down;
repeated rows are separate documents; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltwatch.llm.common import documents, text_of, written

WEIGHTS, BUDGET_PCT, MAX_COPIES, SEED = (3, 1, 2), 150, 2, 13
#: Importance levels; a document of distinct lines has the highest.
LEVELS = 4
#: Bits of the ranking key, and of one step of the cutoff search.
KEY_BITS, STEP_BITS = 48, 16


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def importance(text: Column) -> Column:
    """1 to LEVELS by the share of distinct lines."""
    lines = F.split(text, "\n")
    return (F.lit(1) + F.floor((LEVELS - 1) * F.size(F.array_distinct(lines)) / F.size(lines))).cast("long")


def uniform(seed: int) -> Column:
    """u in (0, 1) of 48 bits, by doc_id (by the text where it is null)."""
    own = F.coalesce(F.col("doc_id").cast("string"), F.md5(text_of()))
    return (F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), own), 256), 1, 12), 16, 10).cast("long") + 0.5) / float(2**48)


def numbered(sources: DataFrame) -> DataFrame:
    """sources plus ``number`` (0, 1, 2...) by code point, null last: range partitions, counted and offset."""
    ordered = sources.repartitionByRange(F.asc_nulls_last("source")).sortWithinPartitions(F.asc_nulls_last("source"))
    placed = written(ordered.withColumn("place", F.monotonically_increasing_id()), "sources")
    part = F.shiftright("place", 33).alias("part")
    counts = placed.groupBy(part).agg(F.count("*").alias("n"))  # one row a partition
    ahead = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("part", ahead.alias("ahead"))
    out = placed.withColumn("part", part).join(starts, "part")
    return out.withColumn("number", F.col("ahead") + F.col("place").bitwiseAND((1 << 33) - 1)).drop("part", "place", "ahead")


def with_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = BUDGET_PCT, copies: int = MAX_COPIES) -> DataFrame:
    """(source, number, source_size, target): min(copies * size, c * weight) with the c that uses up the budget.

    Every round shares the excess of the full sources among the others, so c
    rises until no further source is full.  The driver sees two sums a round.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int"))
    rows = written(numbered(sources).withColumn("weight", weight), "numbered")
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    budget, c, cap = total * percent / 100, 0.0, copies * F.col("source_size")
    while True:
        full = F.lit(c) * F.col("weight") >= cap
        used, open_weight = rows.agg(F.sum(F.when(full, cap).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))).first()
        if not open_weight:
            c = float("inf")
            break
        more = (budget - used) / open_weight
        if more <= c:
            break
        c = more
    return rows.withColumn("target", F.least(F.lit(c) * F.col("weight"), cap.cast("double"))).drop("weight")


def rates(levels: DataFrame, copies: int = MAX_COPIES) -> DataFrame:
    """(source, level, words, target) plus ``rate`` = min(copies, c * level), whose words add up to the source's target.

    Whatever levels are taken as full, their words and c times the others' are
    no less than the target, so c is the largest of the values for each choice.
    """
    up = Window.partitionBy("number").orderBy("level")
    below = up.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    above = up.rowsBetween(1, Window.unboundedFollowing)
    rest = F.col("target") - copies * F.coalesce(F.sum("words").over(above), F.lit(0))
    d = levels.where(F.col("words") > 0).withColumn("c", rest / F.sum(F.col("level") * F.col("words")).over(below))
    d = d.withColumn("c", F.max("c").over(Window.partitionBy("number")))
    return d.withColumn("rate", F.least(F.lit(float(copies)), F.col("c") * F.col("level"))).drop("c")


def cutoffs(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """(number, cut, left, n): the key at which the source's remaining words run out.

    ``left`` of the words go to the n documents at the key itself.  ``wanted``
    is (number, left).  Each step adds up the words by the next bits of the
    keys that share the bits found so far.
    """
    found = written(wanted.where(F.col("left") > 0).select("number", "left", F.lit(0).cast("long").alias("cut"), F.lit(0).cast("long").alias("n")), "cut")
    keys = keyed.where(F.col("key").isNotNull()).select(F.col("number").alias("source_number"), "size", "key")
    for low in range(KEY_BITS - STEP_BITS, -1, -STEP_BITS):
        own = F.shiftright("key", low + STEP_BITS) == F.col("cut")
        step = keys.join(found, (F.col("source_number") == F.col("number")) & own)
        bins = step.groupBy("number", "left", F.shiftright("key", low).alias("bin")).agg(F.sum("size").alias("words"), F.count("*").alias("here"))
        running = F.sum("words").over(Window.partitionBy("number").orderBy("bin"))  # at most 2^16 rows a source
        bins = bins.withColumn("ahead", running - F.col("words"))
        at = bins.where(F.col("ahead") < F.col("left")).groupBy("number").agg(F.max_by(F.struct("bin", "left", "ahead", "here"), "bin").alias("b"))
        found = written(at.select("number", (F.col("b.left") - F.col("b.ahead")).alias("left"), F.col("b.bin").alias("cut"), F.col("b.here").alias("n")), "cut")
    return found


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = BUDGET_PCT, copies: int = MAX_COPIES,
        level: Column | None = None, seed: int = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken, rate) of every document.

    ``level`` is the importance, a long from 1 to a small bound; by default
    ``importance`` of the text.
    """
    level = importance(text_of()) if level is None else level
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", n_words(text_of()).alias("size"), level.alias("level"), uniform(seed).alias("u"))
    slim = written(slim, "sizes")
    by_level = written(slim.groupBy("source", "level").agg(F.sum("size").alias("words")), "levels")
    sources = written(with_targets(by_level.groupBy("source").agg(F.sum("words").alias("source_size")), weights, percent, copies), "targets")
    same = by_level["source"].eqNullSafe(sources["source"])
    levels = by_level.join(sources, same).select(sources["*"], "level", "words")
    rated = written(rates(levels, copies).withColumn("whole", F.floor("rate")), "rates")
    taken = F.sum(F.col("whole") * F.col("words"))
    wanted = rated.groupBy("number").agg((F.floor(F.max("target")) - taken).alias("left"))

    sources = sources.withColumnRenamed("source", "name")
    d = slim.join(sources, slim["source"].eqNullSafe(sources["name"])).drop("name")
    d = d.join(rated.select("number", "level", "rate", "whole"), ["number", "level"], "left")
    p = F.col("rate") - F.col("whole")
    q = (F.col("u") / (1 - F.col("u"))) / (p / (1 - p))
    key = F.when((p > 0) & (F.col("size") > 0), F.floor(q / (1 + q) * float(2**KEY_BITS)).cast("long"))
    keyed = written(d.select("doc_id", "number", "size", "source_size", "target", "rate", "whole", key.alias("key")), "keys")

    cuts = cutoffs(keyed, wanted).withColumnRenamed("number", "cut_number")
    d = keyed.join(cuts, F.col("number") == F.col("cut_number"), "left")
    part = (
        F.when(F.col("key") < F.col("cut"), F.col("size"))
        .when(F.col("key") == F.col("cut"), F.least(F.col("size"), F.floor(F.col("left") / F.col("n"))))
        .otherwise(0)
    )
    whole = F.coalesce(F.col("whole") * F.col("size"), F.lit(0))
    return d.select("doc_id", "size", "source_size", "target", (whole + F.coalesce(part, F.lit(0))).cast("long").alias("taken"), "rate")


def op13_source_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir))


#: The same rows for DuckDB: the sources' and levels' factors by sorted running sums, the cutoff by a running sum of each source's keys.
SQL = r"""
WITH slim AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    1 + (3 * len(list_distinct(string_split(coalesce(text, ''), chr(10)))) // len(string_split(coalesce(text, ''), chr(10)))) AS level,
    (CAST('0x' || substr(sha256('13:' || coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656::DOUBLE AS u
  FROM documents
), sources AS (
  SELECT *, [3, 1, 2][CAST(number % 3 + 1 AS INT)] AS weight
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number FROM slim GROUP BY source)
), filled AS (
  SELECT *, (sum(source_size) OVER () * 150 / 100.0::DOUBLE - coalesce(sum(2 * source_size) OVER before, 0))
      / sum(weight) OVER (ORDER BY 2 * source_size / weight::DOUBLE, number ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS c
  FROM sources WHERE source_size > 0
  WINDOW before AS (ORDER BY 2 * source_size / weight::DOUBLE, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT s.source, s.number, s.source_size,
    least((SELECT max(c) FROM filled) * s.weight, (2 * s.source_size)::DOUBLE) AS target
  FROM sources s
), levels AS (
  SELECT t.*, l.level, l.words FROM targets t
  JOIN (SELECT source, level, CAST(sum(size) AS BIGINT) AS words FROM slim GROUP BY ALL HAVING sum(size) > 0) l ON t.source IS NOT DISTINCT FROM l.source
), tried AS (
  SELECT *, (target - 2 * coalesce(CAST(sum(words) OVER (PARTITION BY number ORDER BY level ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS BIGINT), 0))
      / CAST(sum(level * words) OVER (PARTITION BY number ORDER BY level ROWS UNBOUNDED PRECEDING) AS BIGINT) AS c
  FROM levels
), rated AS (
  SELECT *, CAST(floor(rate) AS BIGINT) AS whole
  FROM (SELECT *, least(2::DOUBLE, max(c) OVER (PARTITION BY number) * level) AS rate FROM tried)
), wanted AS (
  SELECT number, CAST(floor(max(target)) AS BIGINT) - CAST(sum(whole * words) AS BIGINT) AS room FROM rated GROUP BY number
), d AS (
  SELECT s.doc_id, t.number, s.size, t.source_size, t.target, r.rate, r.whole, r.rate - r.whole AS p, s.u
  FROM slim s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source LEFT JOIN rated r ON r.number = t.number AND r.level = s.level
), keyed AS (
  SELECT *, CASE WHEN p > 0 AND size > 0 THEN CAST(floor(q / (1 + q) * 281474976710656::DOUBLE) AS BIGINT) END AS key
  FROM (SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS q FROM d)
), runs AS (
  SELECT k.number, k.key, count(*) AS n, CAST(sum(size) AS BIGINT) AS words FROM keyed k WHERE key IS NOT NULL GROUP BY ALL
), placed AS (
  SELECT r.*, CAST(sum(words) OVER (PARTITION BY r.number ORDER BY key) AS BIGINT) - words AS ahead, w.room FROM runs r JOIN wanted w ON w.number = r.number
), parts AS (
  SELECT number, key, n, ahead, words, room FROM placed WHERE ahead < room
)
SELECT k.doc_id, k.size, k.source_size, k.target,
  CAST(coalesce(k.whole * k.size, 0) + CASE WHEN p.key IS NULL THEN 0 WHEN p.ahead + p.words < p.room THEN k.size
    ELSE least(k.size, (p.room - p.ahead) // p.n) END AS BIGINT) AS taken,
  k.rate
FROM keyed k LEFT JOIN parts p ON p.number = k.number AND p.key = k.key
"""
