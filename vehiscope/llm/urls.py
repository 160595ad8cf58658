"""URL filters: character language models of accepted and rejected URLs.

Domain rules come first: a rule names a host and a path prefix, fits the host and
its subdomains, and the longest fitting rule decides. The other URLs go to two
smoothed variable-order Markov models over the characters of host and path, one
of the URLs that a rule allows and one of those that a rule blocks:

    P_k(c | context) = (n(context c) + A P_k-1(c | shorter context)) / (n(context) + A)

from the empty context up to ``ORDER`` characters, so a long context counts as far
as it was seen. The score is the difference of the two log-likelihoods divided by
the number of characters; a URL is blocked if it is below a threshold, which is
the one that separates the ruled URLs of the held-out fold best (balanced
accuracy on a histogram; of equal ones the lowest).

DataFrame functions only: character n-grams are counted with partial aggregates,
and the probabilities of the distinct n-grams are joined to the positions of the
distinct URLs. One histogram of at most ``BINS`` rows reaches the driver.

Defined results
    null URL or one without ``://``: host and path empty, judged by the model as
    the empty URL; repeated URLs: scored once, weighted by their number in the
    counts; no URL of one kind in the rules: the model allows all; ties go to
    allow; very long URLs are scored whole; empty table: empty result; other
    columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vehiscope.llm.common import lower_ascii, scratch, table, written

#: The rules as (verdict, host/path).
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/")]
ORDER = 5
#: Weight of the shorter context, and the alphabet of the uniform start.
A, ALPHABET = 2.0, 256
BIN_SCALE, BIN_LIMIT = 100, 10
BINS = 2 * BIN_SCALE * BIN_LIMIT + 1
START, END = "\x02", "\x03"


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return (lower_ascii(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)),
            F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1))


def rule_for(host: Column, path: Column, rules=None) -> Column:
    """struct(rule, verdict) of the longest fitting rule, or null."""
    best = None
    for verdict, rule in sorted(rules or RULES, key=lambda r: (-len(r[1]), r[1])):
        h, _, p = rule.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        value = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        best = F.when(fits, value) if best is None else best.when(fits, value)
    return best


def _positions(urls: DataFrame) -> DataFrame:
    """One row per character after the start mark: ``gram``, the character with
    up to ORDER characters before it."""
    at = F.explode(F.sequence(F.lit(2), F.length("s"))).alias("i")
    return urls.select("*", at).withColumn(
        "gram", F.substring("s", F.greatest(F.lit(1), F.col("i") - ORDER), F.least(F.col("i"), F.lit(ORDER + 1))))


def _suffixes(grams: DataFrame) -> DataFrame:
    """Each gram with its endings of 1 to ORDER + 1 characters."""
    return grams.withColumn("k", F.explode(F.sequence(F.lit(1), F.length("gram")))).withColumn(
        "end", F.right("gram", F.col("k")))


def char_ratios(urls: DataFrame) -> DataFrame:
    """``gram, delta``: log P_allow - log P_block of the last character of each
    gram of the URLs. ``urls``: s, allow and block (numbers of fitting URLs).

    Built from the endings of one character up: an ending meets its context and
    the ending one character shorter, each of which at most as many endings share
    as there are characters."""
    grams = _positions(urls).groupBy("gram").agg(F.sum("allow").alias("a"), F.sum("block").alias("b"))
    counts = _suffixes(grams).groupBy("end").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    counts = written(counts.withColumn("k", F.length("end")), "url-endings")

    def smoothed(n: Column, m: Column, shorter: Column) -> Column:
        return (n + A * shorter) / (m + A)

    ones = counts.where("k = 1")
    total = ones.agg(F.struct(F.sum("a").alias("a"), F.sum("b").alias("b"))).scalar()
    start = F.lit(1.0 / ALPHABET)
    level = ones.select("end", smoothed(F.col("a"), total["a"], start).alias("pa"), smoothed(F.col("b"), total["b"], start).alias("pb"))
    levels = None
    for k in range(2, ORDER + 2):
        own = counts.where(F.col("k") == k).select(
            "end", "a", "b", F.expr("left(end, length(end) - 1)").alias("context"), F.right("end", F.lit(k - 1)).alias("shorter"))
        contexts = own.groupBy("context").agg(F.sum("a").alias("ma"), F.sum("b").alias("mb"))
        below = level.select(F.col("end").alias("shorter"), F.col("pa").alias("qa"), F.col("pb").alias("qb"))
        level = written(own.join(contexts, "context").join(below, "shorter").select(
            "end", smoothed(F.col("a"), F.col("ma"), F.col("qa")).alias("pa"),
            smoothed(F.col("b"), F.col("mb"), F.col("qb")).alias("pb")), f"url-level-{k}")
        levels = level if levels is None else levels.unionByName(level)
    return levels.select(F.col("end").alias("gram"), (F.log("pa") - F.log("pb")).alias("delta"))


def scores(urls: DataFrame, ratios: DataFrame) -> DataFrame:
    """``s, score`` of every distinct URL: the mean of its positions' deltas."""
    key = [F.xxhash64("s").alias("h1"), F.xxhash64(F.lit("second"), "s").alias("h2")]
    sums = (_positions(urls.select("s", *key)).select("h1", "h2", "gram").join(ratios, "gram")
            .groupBy("h1", "h2").agg(F.sum(F.round(F.col("delta") * 1e9).cast("long")).alias("total"), F.count("*").alias("n")))
    return urls.select("s", *key).join(sums, ["h1", "h2"]).select("s", (F.col("total") / F.col("n") / 1e9).alias("score"))


def threshold(scored: DataFrame) -> float | None:
    """``scored``: score, allow, block of held-out URLs."""
    b = F.floor(F.greatest(F.lit(-BIN_LIMIT), F.least(F.lit(BIN_LIMIT), F.col("score"))) * BIN_SCALE)
    hist = sorted(tuple(r) for r in scored.groupBy(b.alias("bin")).agg(F.sum("allow"), F.sum("block")).collect())
    good, bad = sum(h[1] for h in hist), sum(h[2] for h in hist)
    if not good or not bad:
        return None
    best, above, below = (-1.0, None), good, 0
    for k, a, r in hist:
        if above / good + below / bad > best[0]:
            best = (above / good + below / bad, k / BIN_SCALE)
        above -= a
        below += r
    return best[1]


def judge(pages: DataFrame, id_col: str = "page_id", rules=None, folds: int = 5) -> DataFrame:
    """``id, host, path, rule, verdict, score`` of every page. Ruled URLs of fold
    0 of ``folds`` set the threshold, the others fit the models."""
    host, path = parts(F.col("url"))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("r", rule_for(F.col("host"), F.col("path"), rules)).select(
        "id", "host", "path", "r.rule", "r.verdict", F.concat(F.lit(START), "host", "path", F.lit(END)).alias("s"))
    with scratch(pages.sparkSession):
        urls = written(rows.groupBy("s").agg(F.sum((F.col("verdict") == "allow").cast("long")).alias("allow"),
                                             F.sum((F.col("verdict") == "block").cast("long")).alias("block"))
                       .na.fill(0, ["allow", "block"])
                       .withColumn("held", F.pmod(F.xxhash64("s"), F.lit(folds)) == 0), "urls")
        fit = urls.withColumns({c: F.when(F.col("held"), 0).otherwise(F.col(c)) for c in ("allow", "block")})
        scored = written(scores(urls, char_ratios(fit)), "url-scores", keep=True)
        limit = threshold(urls.where("held and allow + block > 0").join(scored, "s"))
    verdict = F.lit("allow") if limit is None else F.when(F.col("score") >= limit, "allow").otherwise("block")
    return rows.join(scored, "s", "left").select(
        "id", "host", "path", "rule", F.coalesce("verdict", verdict).alias("verdict"), "score")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's URL."""
    return judge(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")
