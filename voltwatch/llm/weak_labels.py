"""Operator 10: quality classifier from weak labels.

Heuristic labellers vote bad (1), good (0) or abstain (2) on every document.
The toxicity labeller has ten English words and, per language, the words that
a bounded sample of ``labels`` (``LABEL_ROWS`` documents of even key hash; the
others are never read) shows in toxic documents only; it abstains elsewhere.
Documents are counted by their vote pattern, at most 3^6 rows whatever the
corpus; expectation-maximisation over the counts estimates each labeller's
share of bad votes per class and the class share, and gives each pattern its
posterior.  The posteriors of a bounded, documented sample (``TRAIN_ROWS``
documents of the least key hash) train a logistic regression on hashed
words and the votes, which scores every document.

Defined cases: null or empty text is voted on as a text without words; a
null doc_id is scored like any other row; repeated rows get equal scores; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from voltwatch.llm.common import text_of, written
from voltwatch.llm.host_rules import document_rules

#: Documents the linear scorer is trained on at most.
TRAIN_ROWS = 8000
FEATURES = 1 << 15
#: Probability of bad from which a document is not kept.
BAD = 0.5
EM_ROUNDS = 100
#: Expected share of bad votes on good and on bad documents, and its weight against the votes cast.
PRIOR, STRENGTH = (0.005, 0.25), 4.0
# Insults that mark a text as toxic, in any language.
INSULTS = ("clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless")
#: Labelled documents from which the insults of each language are taken at most.
LABEL_ROWS = 4000
#: Least toxic documents that show a word, and clean ones per toxic one at most.
MIN_TOXIC, CLEAN_PER_TOXIC = 3, 0.05

VOTES = ("v_short", "v_repeat", "v_symbols", "v_lines", "v_caps", "v_insult")
#: Labellers that never vote good.
ONE_SIDED = ("v_insult",)


def least(df: DataFrame, by: list[str], n: int) -> list[tuple[Row, int]]:
    """The n rows of df that come first by ``by`` (a uniform 64-bit hash first), as distinct keys and their number.

    Rows of large hashes are left out beforehand, by the row count, and copies
    are counted where they lie, so that the last task gets some 4 n keys
    whatever the input.
    """
    total = df.count()
    keys = df.select(*by)
    few = keys.where(F.col(by[0]) < int(-(2**63) + min(1.0, 4 * n / max(total, 1)) * (2**64 - 2**12)))
    found: list[tuple[Row, int]] = []
    for some in (few, keys):  # all keys only if those below the bound are too few, by chance or as a copy has many rows
        found, left = [], n
        for r in some.groupBy(*by).agg(F.count("*").alias("m")).orderBy(*by).limit(n).collect():
            if left:
                found.append((r, min(left, r.m)))
                left -= found[-1][1]
        if not left:
            break
    return found


def letters() -> Column:
    """The distinct lower-case words of letters of a text."""
    return F.array_distinct(F.split(F.lower("text"), "[^\\p{L}]+"))


def with_lang(docs: DataFrame) -> DataFrame:
    lang = F.coalesce(F.col("lang"), F.lit("")) if "lang" in docs.columns else F.lit("")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), lang.alias("lang"))


def label_sample(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of at most LABEL_ROWS labels, all of even key hash, so that the others are held out."""
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") == 1).alias("toxic")).dropna()
    own = own.withColumn("h", F.xxhash64("doc_id")).where(F.pmod("h", F.lit(2)) == 0)
    found = [(r.doc_id, r.toxic) for r, _ in least(own, ["h", "doc_id", "toxic"], LABEL_ROWS)]
    return labels.sparkSession.createDataFrame(found, "doc_id long, toxic boolean")


def insults(docs: DataFrame, labels: DataFrame) -> dict[str, list[str]]:
    """Per language the words that mark toxic documents of the sample.

    A word is taken if toxic documents show it, clean ones hardly do, and of
    all words as frequent less than one is expected to do so by chance.
    Repeated texts count once.
    """
    sample = F.broadcast(label_sample(labels))  # at most LABEL_ROWS rows
    texts = written(with_lang(docs).join(sample, "doc_id").groupBy("lang", "text").agg(F.max("toxic").alias("toxic")), "labelled")
    shares = {r.lang: r.share for r in texts.groupBy("lang").agg(F.avg(F.col("toxic").cast("int")).alias("share")).collect()}
    words = texts.select("lang", "toxic", F.explode(letters()).alias("w")).where(F.length("w") > 2)
    counts = words.groupBy("lang", "w").agg(F.count_if("toxic").alias("t"), F.count_if(~F.col("toxic")).alias("c"))
    counts = written(counts.where(F.col("t") + F.col("c") >= MIN_TOXIC), "label-words")
    frequent = {r.lang: r["count"] for r in counts.groupBy("lang").count().collect()}
    found: dict[str, list[str]] = {}
    for r in counts.where((F.col("t") >= MIN_TOXIC) & (F.col("c") <= CLEAN_PER_TOXIC * F.col("t"))).orderBy("lang", "w").collect():
        if frequent[r.lang] * shares[r.lang] ** r.t < 1:
            found.setdefault(r.lang, []).append(r.w)
    return found


def votes(docs: DataFrame, found: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per document: doc_id, text and a vote of each labeller."""
    rules = document_rules(with_lang(docs))
    own = docs.sparkSession.createDataFrame(list((found or {}).items()), "lang string, own array<string>")
    rules = rules.join(F.broadcast(own), "lang", "left")  # one row per language
    insult = F.arrays_overlap(letters(), F.concat(F.array(*map(F.lit, INSULTS)), F.coalesce("own", F.array().cast("array<string>"))))
    n = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.length("text"), F.lit(1))
    caps = F.length(F.regexp_replace("text", "[^A-Z]", "")) / chars

    def vote(bad, good):
        return F.when(bad, 1).when(good, 0).otherwise(2)

    return rules.select(
        "doc_id",
        "text",
        vote(F.col("n_words") < 10, F.col("n_words") >= 50).alias("v_short"),
        vote(F.col("n_repeat_words") > 0.4 * n, F.col("n_repeat_words") < 0.2 * n).alias("v_repeat"),
        vote(F.col("n_symbols") > 0.3 * n, F.col("n_symbols") < 0.05 * n).alias("v_symbols"),
        vote(F.col("n_dup_lines") > 0.3 * F.greatest("n_lines", F.lit(1)), (F.col("n_lines") >= 3) & (F.col("n_dup_lines") == 0)).alias("v_lines"),
        vote(caps > 0.4, caps < 0.2).alias("v_caps"),
        vote(insult, F.lit(False)).alias("v_insult"),
    )


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = EM_ROUNDS, one_sided=()) -> tuple[np.ndarray, np.ndarray, float]:
    """(P(bad | pattern), P(bad vote | class) as [labeller, class], share of bad).

    Abstaining says nothing; the shares of a ``one_sided`` labeller, which
    votes bad or abstains, are of all documents.  ``PRIOR`` is worth ``STRENGTH`` of the votes a
    labeller casts in each class: it says which class a labeller points to,
    and that a bad text need not look bad to every labeller.
    """
    total = max(counts.sum(), 1.0)
    bad = (patterns == 1).any(1)
    post = np.where(bad, 0.8, 0.02)
    for _ in range(rounds):
        share = float(np.clip((post * counts).sum() / total, 1e-6, 1 - 1e-6))
        weight = np.stack(((1 - post) * counts, post * counts))
        table = np.zeros((patterns.shape[1], 2))
        log = np.tile(np.log([1 - share, share]), (len(patterns), 1))
        for j in range(patterns.shape[1]):
            yes, cast = patterns[:, j] == 1, patterns[:, j] < 2
            asked = weight.sum(1) if j in one_sided else weight[:, cast].sum(1)
            own = STRENGTH * asked + 1.0
            table[j] = (weight[:, yes].sum(1) + np.array(PRIOR) * own) / (asked + own)
            log += np.where(cast[:, None], np.log(np.where(yes[:, None], table[j], 1 - table[j])), 0.0)
        new = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -50, 50)))
        if np.abs(new - post).max(initial=0) < 1e-9:
            break
        post = new
    return post, table, share


def posteriors(voted: DataFrame) -> DataFrame:
    """Per vote pattern: its number of documents and the posterior of bad."""
    rows = voted.groupBy(*VOTES).agg(F.count("*").alias("n")).collect()
    found = np.array([[r[v] for v in VOTES] for r in rows], np.int64).reshape(-1, len(VOTES))
    counts = np.array([r.n for r in rows], np.float64)
    post = expectation_maximisation(found, counts, one_sided=[VOTES.index(v) for v in ONE_SIDED])[0] if len(rows) else []
    data = [(*map(int, f), float(p)) for f, p in zip(found, post, strict=True)]
    return voted.sparkSession.createDataFrame(data, ", ".join(f"{v} int" for v in VOTES) + ", posterior double")


def train_sample(labelled: DataFrame) -> DataFrame:
    """The TRAIN_ROWS documents of the least key hash, one row per document with its number m of equal rows.

    The keys are picked without the texts, which are fetched for them alone.
    """
    spark = labelled.sparkSession
    hashed = labelled.withColumn("h", F.xxhash64("doc_id", "text"))
    picked = [(r.h, r.doc_id, m) for r, m in least(hashed, ["h", "doc_id"], TRAIN_ROWS)]
    keys = spark.createDataFrame(picked, "h long, id long, m long")  # at most TRAIN_ROWS rows
    same = (F.col("k.h") == F.col("d.h")) & F.col("k.id").eqNullSafe(F.col("d.doc_id"))
    rows = hashed.alias("d").join(F.broadcast(keys).alias("k"), same).select("d.*", "k.m")
    return rows.groupBy("h", "doc_id").agg(*[F.any_value(c).alias(c) for c in ("text", *VOTES, "posterior", "m")])


def features(df: DataFrame) -> DataFrame:
    words = F.array_remove(F.split(F.lower("text"), "[ \\t-\\r]+"), "")
    words = F.concat(words, F.array(*[F.concat(F.lit(f" {v} "), F.col(v).cast("string")) for v in VOTES]))  # no word has a space
    return HashingTF(inputCol="_words", outputCol="_features", numFeatures=FEATURES, binary=True).transform(df.withColumn("_words", words))


def classify(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """doc_id, the votes, posterior, score (probability of bad by the linear scorer), kept."""
    voted = written(votes(docs, insults(docs, labels) if labels is not None else None), "votes")
    post = posteriors(voted.drop("text"))
    labelled = voted.join(F.broadcast(post), list(VOTES), "left")  # at most 3^6 rows
    sample = train_sample(labelled)
    pairs = F.array(
        F.struct(F.lit(1.0).alias("label"), (F.col("m") * F.col("posterior")).alias("w")),
        F.struct(F.lit(0.0).alias("label"), (F.col("m") * (1 - F.col("posterior"))).alias("w")),
    )
    train = features(sample).select("_features", F.explode(pairs).alias("p")).select("_features", "p.label", "p.w").where("w > 0")
    train = train.persist()
    try:
        if train.isEmpty():
            return labelled.select("doc_id", *VOTES, "posterior", F.lit(0.0).alias("score"), F.lit(True).alias("kept"))
        model = LogisticRegression(featuresCol="_features", labelCol="label", weightCol="w", regParam=0.001, maxIter=30).fit(train)
    finally:
        train.unpersist()
    score = vector_to_array("probability")[1]
    scored = model.transform(features(labelled))
    return scored.select("doc_id", *VOTES, "posterior", score.alias("score"), (score < BAD).alias("kept"))


def op10_quality_classifier(spark, sf_dir: str) -> DataFrame:
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
