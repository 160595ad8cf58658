"""Quality rules: hashed n-gram log-likelihood ratio of two multinomials.

A text's tokens are its runs of letters and digits and its runs of other visible
characters; its features are the token unigrams and bigrams, hashed into
``BUCKETS`` buckets. The raw multinomial counts the features of every document,
the target multinomial those of the trusted documents (label quality 1, not
toxic, in the fitting fold), both with add-one smoothing. A document's score is
the sum of log(target / raw) over its features divided by their number; it is
kept if the score reaches a threshold. The threshold is the one that separates
the labelled documents of the other fold best (balanced accuracy on a histogram
of all their scores; of equal ones the lowest, so that clean documents stay).

DataFrame functions only. ``BUCKETS`` numbers and a histogram of at most
``BINS`` rows are all that is gathered; the texts are never shuffled unless the
trusted ids are too many to broadcast.

Defined results
    null, empty or blank text: no words, base_failed; a text without features
    scores 0; null doc_id: no label, judged like any other; labels that repeat or
    contradict: trusted only if all of a document's labels are; no labels of one
    kind: every document that passes the base rules is kept; repeated rows: the
    same verdict; empty table: empty result; other columns are carried unchanged
    by `filter_quality` and ignored by the query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vehiscope.llm.common import BLANK, NOT_BLANK, table, written

BUCKETS = 10_000
#: Histogram of scores: bin width 1 / BIN_SCALE, scores cut off at +-BIN_LIMIT.
BIN_SCALE, BIN_LIMIT = 200, 10
BINS = 2 * BIN_SCALE * BIN_LIMIT + 1
#: Trusted ids that are broadcast at most (16 bytes each); more are joined.
BROADCAST_IDS = 2_000_000
#: A base rule: fewer words fail.
MIN_WORDS = 50
#: A token: a run of letters and digits, or of other visible characters.
TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row."""
    return F.transform(F.array(value), body)[0]


def base_columns(text: Column) -> dict[str, Column]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text."""
    t = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(t, BLANK), "")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(NOT_BLANK))

    def windows(w: Column) -> Column:
        return F.when(F.size(w) >= 3, F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.struct(F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("g"),
                               i.alias("i")))).otherwise(F.array().cast("array<struct<g:string,i:int>>"))

    def repeated(s: Column) -> Column:
        """First words of the windows that equal a neighbour in sorted order."""
        return F.transform(F.filter(s, lambda x, k: F.coalesce(
            (F.get(s, k - 1)["g"] == x["g"]) | (F.get(s, k + 1)["g"] == x["g"]),
            F.get(s, k - 1)["g"] == x["g"], F.get(s, k + 1)["g"] == x["g"], F.lit(False))), lambda x: x["i"])

    found = _let(_let(words, lambda w: F.sort_array(windows(w))), repeated)
    covered = F.array_distinct(F.flatten(F.transform(found, lambda i: F.array(i, i + 1, i + 2))))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_dup_lines": _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")),
        "n_repeat_words": F.size(covered).cast("long"),
    }


def features(text: Column) -> Column:
    """Buckets of the unigrams and bigrams of a text."""
    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))

    def grams(t: Column) -> Column:
        ones = F.transform(t, lambda x: F.pmod(F.xxhash64(x), F.lit(BUCKETS)).cast("int"))
        twos = F.when(F.size(t) >= 2, F.transform(
            F.sequence(F.lit(0), F.size(t) - 2),
            lambda i: F.pmod(F.xxhash64(F.get(t, i), F.get(t, i + 1)), F.lit(BUCKETS)).cast("int")))
        return F.concat(ones, F.coalesce(twos, F.array().cast("array<int>")))

    return _let(tokens, grams)


def _labels(labels: DataFrame) -> DataFrame:
    """``label_id, good, fold`` per labelled document."""
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    return (labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("label_id"))
            .agg(F.min(good.cast("int")).alias("good"), F.min("quality").alias("quality"))
            .withColumn("fold", F.pmod(F.xxhash64("label_id"), F.lit(2))))


def ratios(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``bucket, ratio`` for all buckets: log target share minus log raw share."""
    ids = _labels(labels).where("good = 1 and fold = 0").select("label_id", F.lit(1).alias("trusted"))
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    grams = (docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("label_id"), "left")
             .select(F.explode(features(F.col("text"))).alias("bucket"), F.coalesce("trusted", F.lit(0)).alias("trusted")))
    counts = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("trusted").alias("target"))
    counts = written(docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
                     .join(counts, "bucket", "left").na.fill(0, ["raw", "target"]), "ngram-counts")
    total = counts.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).first()
    return counts.select("bucket", (
        F.log((F.col("target") + 1) / F.lit(float(total["target"] + BUCKETS)))
        - F.log((F.col("raw") + 1) / F.lit(float(total["raw"] + BUCKETS)))).alias("ratio"))


def score_column(text: Column, ratio: DataFrame) -> Column:
    """Mean log ratio of the features of a text; ``ratio`` has BUCKETS rows,
    which become one constant array."""
    rows = sorted((r["bucket"], r["ratio"]) for r in ratio.collect())
    by_bucket = F.split(F.lit(",".join(repr(x) for _, x in rows)), ",").cast("array<double>")
    return _let(features(text), lambda f: F.when(F.size(f) > 0, F.aggregate(
        f, F.lit(0.0), lambda a, b: a + F.get(by_bucket, b)) / F.size(f)).otherwise(0.0))


def threshold(scored: DataFrame, labels: DataFrame) -> float | None:
    """The score from which documents are kept, from the labelled documents of
    the fold that was not fitted; None: no labels of one kind."""
    held = _labels(labels).where("fold = 1")
    b = F.floor(F.greatest(F.lit(-BIN_LIMIT), F.least(F.lit(BIN_LIMIT), F.col("score"))) * BIN_SCALE)
    hist = sorted((r["bin"], r["good"], r["bad"]) for r in
                  scored.join(held, F.col("doc_id") == F.col("label_id")).groupBy(b.alias("bin")).agg(
                      F.sum((F.col("good") == 1).cast("long")).alias("good"),
                      F.sum((F.col("quality") == 0).cast("long")).alias("bad")).collect())
    good, bad = sum(h[1] for h in hist), sum(h[2] for h in hist)
    if not good or not bad:
        return None
    best, kept_good, below_bad = (-1.0, None), good, 0
    for k, g, w in hist:  # a threshold at the lower end of each bin
        balanced = kept_good / good + below_bad / bad
        if balanced > best[0]:
            best = (balanced, k / BIN_SCALE)
        kept_good -= g
        below_bad += w
    return best[1]


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > 50 * n_words)


def filter_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with their own columns. The labelled
    documents of the held-out fold are scored first; the texts stay where they
    are."""
    text, own = docs["text"], docs.select("doc_id", "text")
    score = score_column(text, ratios(own, labels))
    held = _labels(labels).where("fold = 1").select("label_id")
    if held.count() <= BROADCAST_IDS:
        held = F.broadcast(held)
    scored = written(own.join(held, F.col("doc_id") == F.col("label_id"), "left_semi").select("doc_id", score.alias("score")),
                     "held-out-scores")
    limit = threshold(scored, labels)
    base = base_columns(text)
    good = ~base_failed(base["n_words"], base["n_repeat_words"])
    return docs.where(good if limit is None else good & (score >= limit))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    base = base_columns(docs["text"])
    scored = docs.select("doc_id", *[c.alias(n) for n, c in base.items()],
                         score_column(docs["text"], ratios(docs, labels)).alias("score"))
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    scored = written(scored.withColumn("base_failed", failed), "quality-scores")
    limit = threshold(scored, labels)
    passes = F.lit(True) if limit is None else F.col("score") >= limit
    return scored.withColumn("kept", ~F.col("base_failed") & passes).select("doc_id", *base, "base_failed", "kept", "score")
