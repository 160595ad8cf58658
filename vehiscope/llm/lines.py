"""Line dedup by exact set-similarity join.

A line is lower-cased and seen as the set of its five-word shingles (a line of
fewer words is one token; a line without words is never touched). Tokens are ordered by rarity: by
the count class of their hash bucket over the whole corpus, then by hash, which
is one total order for all lines. Two lines of Jaccard similarity ``t`` or more
share a token among the first ``n - ceil(t n) + 1`` of each (prefix filter); a
shared prefix token gives a candidate only if the sizes allow ``t`` (length
filter) and it and the tokens behind it could reach the overlap alone (positional
filter: nothing is shared before the first shared token, so similar lines meet at
that one); candidates are verified by exact Jaccard over the whole sets. A line
goes if an equal line or a similar one occurs earlier (by doc_id, then text
digest, then line number).

Equal lines meet as one. Similar ones are first compared with the earliest line
of each token, which settles the members of a large group without its pairs; the
lines that are left meet all earlier lines of their tokens. No candidate is
dropped.

Documents are numbered in their order and a line is known by one number, so that
the joins of tokens move numbers only; texts are moved for the lines that share a
prefix token, and once a round for those of the pairs to verify.

DataFrame functions only. What is gathered has a fixed size: ``RARITY_BUCKETS``
count classes, one number a partition, and bit sets, which only spare shuffles.

Defined results
    null text stays null; blank lines stay; null doc_id: sorted last; rows that
    agree in doc_id and text are one document and keep the same lines; ties of
    similarity exactly ``t`` match; very long lines are compared whole; empty
    table: empty result; other columns are carried unchanged (``n_chars``, if
    there, follows the text); a document all of whose lines with words go is
    dropped by `dedup_lines`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vehiscope.llm.common import bit_set, discard, fresh, in_bit_set, scratch, table, written

SHINGLE = 5
#: A line with a word; words end at spaces, tabs and carriage returns.
A_WORD = r"[^ \t\r]"
#: Similarity as a fraction of integers: 4 / 5.
T_NUM, T_DEN = 4, 5
RARITY_BUCKETS = 1 << 18
#: The rarity class is in the bits above the hash.
HASH_BITS = 57
ROUNDS = 3
#: Below a document's number, the bits of the number of a line in it.
POS_BITS = 31
#: `monotonically_increasing_id`: bits of the row below the partition.
ROW_BITS = 33


def _docs(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text").where("text is not null").select(
        "doc_id", F.md5(F.col("text").cast("binary")).alias("digest"), "text")


def _keys(line: Column) -> tuple[Column, Column]:
    """``k1, k2`` of a lower-cased line."""
    return F.xxhash64(line).alias("k1"), F.xxhash64(F.lit("second"), line).alias("k2")


def _lines(docs: DataFrame) -> DataFrame:
    """``line, k1, k2`` of every line with a word, lower-cased."""
    lines = _docs(docs).select(F.explode(F.split("text", "\n")).alias("line")).where(F.col("line").rlike(A_WORD))
    return lines.select(F.lower("line").alias("line")).select("line", *_keys(F.col("line")))


def _numbered(docs: DataFrame) -> DataFrame:
    """``doc, doc_id, digest, keys`` of every document: its place in the order, from
    0, and ``pos, k1, k2`` of its lines with a word."""
    keys = F.transform(F.split("text", "\n"), lambda x, i: F.struct(
        i.alias("pos"), *_keys(F.lower(x)), x.rlike(A_WORD).alias("word")))
    keys = F.transform(F.filter(keys, lambda k: k["word"]), lambda k: F.struct(k["pos"], k["k1"], k["k2"]))
    found = written(_docs(docs).select("doc_id", "digest", keys.alias("keys")), "line-keys")
    row = F.monotonically_increasing_id()
    rows = written(found.dropDuplicates(["doc_id", "digest"]).orderBy(F.col("doc_id").isNull(), "doc_id", "digest")
                   .withColumn("row", row), "ordered-documents")
    discard(found)
    # rows of the partitions before each: one number a partition
    part = F.shiftright("row", ROW_BITS).cast("int")
    before, n = [], 0
    sizes = {r["p"]: r["n"] for r in rows.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
    for k in range(max(sizes, default=-1) + 1):
        before.append(n)
        n += sizes.get(k, 0)
    start = F.get(F.split(F.lit(",".join(map(str, before or [0]))), ",").cast("array<bigint>"), part)
    doc = start + F.col("row").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return rows.select(doc.alias("doc"), "doc_id", "digest", "keys")


def _words(line: Column) -> Column:
    plain = F.replace(F.replace(line, F.lit("\t"), F.lit(" ")), F.lit("\r"), F.lit(" "))
    return F.array_remove(F.split(plain, " "), "")


def _gram(words: Column, i: Column) -> Column:
    """Hash of the shingle that starts at word i; a short line ends early."""
    return F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)])


def _starts(words: Column) -> Column:
    return F.sequence(F.lit(0), F.greatest(F.size(words) - SHINGLE, F.lit(0)))


def _rarity(lines: DataFrame) -> DataFrame:
    """``bucket, class``: four times the binary logarithm of the tokens seen."""
    words = lines.select(_words(F.col("line")).alias("w"))
    buckets = words.select("w", F.explode(_starts(F.col("w"))).alias("i")).select(
        _gram(F.col("w"), F.col("i")).bitwiseAND(F.lit(RARITY_BUCKETS - 1)).cast("int").alias("bucket"))
    return buckets.groupBy("bucket").agg(F.least(F.lit(63), F.floor(4 * F.log2(F.count("*")))).cast("long").alias("class"))


def _rarity_literal(rarity: DataFrame) -> Column:
    """The classes of all buckets as one constant array."""
    classes = ["0"] * RARITY_BUCKETS
    for r in rarity.collect():  # RARITY_BUCKETS rows at most
        classes[r["bucket"]] = str(r["class"])
    return F.split(F.lit(",".join(classes)), ",").cast("array<bigint>")


def _tokens(line: Column, rarity: Column) -> Column:
    """Distinct token numbers of a line, rarest first."""
    def number(t: Column) -> Column:
        # known not to be null: long values are sorted as such
        rank = F.coalesce(F.get(rarity, t.bitwiseAND(F.lit(RARITY_BUCKETS - 1)).cast("int")), F.lit(0).cast("long"))
        return F.shiftleft(rank, HASH_BITS).bitwiseOR(t.bitwiseAND(F.lit((1 << HASH_BITS) - 1)))

    return F.sort_array(F.array_distinct(F.transform(_grams(line), number)))


def _grams(line: Column) -> Column:
    return F.transform(F.array(_words(line)), lambda w: F.transform(_starts(w), lambda i: _gram(w, i)))[0]


def _set(line: Column) -> Column:
    """The set of a line's shingle hashes."""
    return F.array_distinct(_grams(line))


def _overlap(a: Column, b: Column) -> Column:
    """Least overlap of sets of sizes a and b at similarity T: ceil(T/(1+T) (a+b))."""
    return F.ceil((T_NUM * (a + b)) / (T_NUM + T_DEN))


def _prefix(n: Column) -> Column:
    """Length of the prefix of n tokens."""
    return (n - F.ceil(T_NUM * n / T_DEN) + 1).cast("int")


def _possible(na: Column, ia: Column, nb: Column, ib: Column) -> Column:
    """Length and positional filter for a token at places ia, ib (from 0), taken
    as the first that both lines hold: it holds there for all similar lines, and
    members of a group that only have most of their common tokens left do not meet
    at any of them."""
    return ((T_DEN * F.least(na, nb) >= T_NUM * F.greatest(na, nb))
            & (F.least(na - ia, nb - ib) >= _overlap(na, nb)))


def _verified(pairs: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """``line``: x of the candidate pairs ``x, y`` (line numbers) of similarity T
    or more. Only the texts of the pairs are moved."""
    pairs = written(pairs, f"{name}-pairs")
    met = bit_set(pairs.select(F.explode(F.array("x", "y")).alias("line")), "line")
    some = texts.where(in_bit_set(met, "line"))
    a = some.select(F.col("line").alias("x"), F.col("text").alias("tx"))
    b = some.select(F.col("line").alias("y"), F.col("text").alias("ty"))
    sets = F.struct(_set(F.col("tx")).alias("a"), _set(F.col("ty")).alias("b"))

    def similar(s: Column) -> Column:
        both = F.size(F.array_intersect(s["a"], s["b"]))
        return T_DEN * both >= T_NUM * (F.size(s["a"]) + F.size(s["b"]) - both)

    hits = (pairs.join(a, "x").join(b, "y").where(F.transform(F.array(sets), similar)[0])
            .select(F.col("x").alias("line")).distinct())
    hits = written(hits, name)
    discard(pairs)
    return hits


def similar_lines(lines: DataFrame, first: DataFrame) -> DataFrame:
    """``line`` of the distinct lines that have a similar line before them.

    ``first`` has ``k1, k2, line`` of all distinct lines; the order is that of
    the numbers ``line``.
    """
    rare = _rarity_literal(_rarity(lines))
    tokens = lines.select("k1", "k2", _tokens(F.col("line"), rare).alias("tokens"))
    n = F.size("tokens")
    size = _prefix(n)
    # one row a line: its keys are not repeated with every token
    lists = written(tokens.select("k1", "k2", n.alias("n"), F.slice("tokens", F.lit(1), size).alias("prefix")),
                    "prefix-tokens")
    prefix = lists.select("k1", "k2", "n", F.posexplode("prefix").alias("i", "token"))
    shared = written(prefix.groupBy("token").agg(F.min("k1").alias("a"), F.max("k1").alias("b"))
                     .where("a <> b").select("token"), "shared-tokens")
    places = (prefix.where(in_bit_set(bit_set(shared, "token"), "token")).join(shared, "token")
              .groupBy("token", "k1", "k2").agg(F.min("n").alias("n"), F.min("i").alias("i")))
    # a line is known by its number from here on
    named = written(places.join(first, ["k1", "k2"]).select("token", "k1", "k2", "line", "n", "i"), "line-prefixes")
    discard(lists, shared)
    known = named.select("k1", "k2", "line").distinct()
    # the texts of these lines, each once: shorter to move than their tokens
    some = (lines.where(in_bit_set(bit_set(named.select("k1"), "k1"), "k1"))
            .groupBy("k1", "k2").agg(F.first("line").alias("text")))
    texts = written(some.join(known, ["k1", "k2"]).select("line", "text"), "line-texts")
    places = named.select("token", "line", "n", "i")

    open_, found, earlier, lead_before = places, None, None, None
    for r in range(ROUNDS):
        # compare with the earliest line of the token that was not yet compared
        pool = places if earlier is None else places.join(earlier, "token").where("line > last").drop("last")
        lead = (pool.groupBy("token").agg(F.min("line").alias("y"), F.min_by(F.struct("n", "i"), "line").alias("at"))
                .select("token", "y", F.col("at.n").alias("ny"), F.col("at.i").alias("iy")))
        lead = written(lead, f"line-leaders-{r}")
        pairs = (open_.join(lead, "token").where("line > y")
                 .where(_possible(F.col("n"), F.col("i"), F.col("ny"), F.col("iy")))
                 .select(F.col("line").alias("x"), "y").distinct())
        hits = _verified(pairs, texts, f"similar-lines-{r}")
        found = hits if found is None else found.unionByName(hits)
        earlier = lead.select("token", F.col("y").alias("last"))
        # open: the lines not settled that still have other lines before them
        left = written(open_.join(hits, "line", "left_anti").join(earlier, "token").where("line > last").drop("last"),
                       f"open-lines-{r}")
        if r:
            discard(open_, lead_before)
        open_, lead_before = left, lead
    # all earlier lines that were not leaders, for the lines that are left
    others = (places.join(earlier, "token").where("line > last")
              .select("token", F.col("line").alias("y"), F.col("n").alias("ny"), F.col("i").alias("iy")))
    pairs = (open_.join(others, "token").where("line > y")
             .where(_possible(F.col("n"), F.col("i"), F.col("ny"), F.col("iy")))
             .select(F.col("line").alias("x"), "y").distinct())
    found = found.unionByName(_verified(pairs, texts, "similar-lines")).distinct()
    discard(named, texts, open_, lead_before)
    return found


def removed_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, removed``: per document (doc_id and md5 of the text) the
    sorted numbers of the lines that go, from 0; documents without any are absent."""
    numbered = _numbered(docs)
    every = numbered.select("doc", F.explode("keys").alias("k")).select(
        "k.k1", "k.k2", F.shiftleft("doc", POS_BITS).bitwiseOR(F.col("k.pos").cast("long")).alias("line"))
    first = written(every.groupBy("k1", "k2").agg(F.min("line").alias("line"), F.max("line").alias("last")), "lines")
    similar = similar_lines(_lines(docs), first.drop("last"))
    # lines that occur more than once, or go altogether
    marked = written(first.join(similar.withColumn("goes", F.lit(True)), "line", "left")
                     .where("goes or line <> last").select("k1", "k2", F.col("line").alias("kept"), "goes"),
                     "marked-lines")
    gone = (every.join(marked, ["k1", "k2"]).where("goes or line <> kept")
            .groupBy(F.shiftright("line", POS_BITS).alias("doc"))
            .agg(F.array_sort(F.collect_set(F.col("line").bitwiseAND(F.lit((1 << POS_BITS) - 1)).cast("int"))).alias("removed")))
    return gone.join(numbered.select("doc", "doc_id", "digest"), "doc").select("doc_id", "digest", "removed")


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The documents without the lines that go."""
    digest, left, r_id, r_digest, gone = fresh(docs, "digest", "left", "removed_id", "removed_digest", "removed")
    with scratch(docs.sparkSession):
        removed = written(removed_lines(docs), "removed-lines", keep=True)
    removed = removed.select(
        F.col("doc_id").alias(r_id), F.col("digest").alias(r_digest), F.col("removed").alias(gone))
    keyed = docs.withColumn(digest, F.md5(F.col("text").cast("binary")))
    joined = keyed.join(removed, _same(F.col("doc_id"), F.col(r_id)) & (F.col(digest) == F.col(r_digest)), "left")
    kept = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(F.col(gone), i))
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    out = joined.withColumn(left, text).where(F.col(gone).isNull() | F.col(left).rlike(A_WORD))
    new = {"text": F.col(left)}
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        new["n_chars"] = F.when(F.col(gone).isNull(), F.col("n_chars")).otherwise(
            F.length(F.col(left)).cast(kind))
    return out.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with words, and those that go, of every document."""
    docs = table(spark, sf_dir, "documents")
    with scratch(spark):
        removed = written(removed_lines(docs), "removed-lines", keep=True)
    own = docs.select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"), F.size(F.filter(
        F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike(A_WORD))).cast("long").alias("n_lines"))
    r = removed.select(F.col("doc_id").alias("r_id"), F.col("digest").alias("r_digest"), "removed")
    gone = F.coalesce("removed", F.array().cast("array<int>"))
    return own.join(r, _same(F.col("doc_id"), F.col("r_id")) & (F.col("digest") == F.col("r_digest")), "left").select(
        "doc_id", "n_lines", F.size(gone).cast("long").alias("n_removed"), F.array_join(gone, ",").alias("removed_lines"))


_SPLIT = r"list_filter(regexp_split_to_array(%s, '[ \t\r]+'), lambda x: x <> '')"

OP1_SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS k, doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
l AS MATERIALIZED (SELECT k, doc_id, md5(text) AS digest, pos, {_SPLIT % 'lower(line)'} AS w FROM (
  SELECT k, doc_id, text, unnest(range(0, len(ls))) AS pos, unnest(ls) AS line FROM d)),
o AS MATERIALIZED (SELECT *, array_to_string(w, ' ') AS s FROM l WHERE len(w) > 0),
u AS MATERIALIZED (SELECT s, row_number() OVER (ORDER BY f) AS id, f FROM (
  SELECT s, min({{'n': doc_id IS NULL, 'd': doc_id, 'g': digest, 'p': pos}}) AS f FROM o GROUP BY s)),
t AS MATERIALIZED (SELECT DISTINCT id, array_to_string(w[i:i + {SHINGLE - 1}], ' ') AS t FROM (
  SELECT id, w, unnest(range(1, greatest(len(w) - {SHINGLE - 1}, 1) + 1)) AS i FROM (SELECT DISTINCT id, w FROM u JOIN o USING (s)))),
n AS (SELECT id, count(*) AS n FROM t GROUP BY id),
p AS (SELECT a.id AS x, b.id AS y, count(*) AS c FROM t a JOIN t b ON a.t = b.t AND a.id > b.id GROUP BY 1, 2),
g AS (SELECT DISTINCT x FROM p JOIN n a ON a.id = x JOIN n b ON b.id = y WHERE {T_DEN} * c >= {T_NUM} * (a.n + b.n - c)),
r AS (SELECT DISTINCT k, pos FROM o JOIN u USING (s) LEFT JOIN g ON g.x = u.id
  WHERE g.x IS NOT NULL OR {{'n': doc_id IS NULL, 'd': doc_id, 'g': digest, 'p': pos}} <> f),
c AS (SELECT k, count(*) AS n_lines FROM o GROUP BY k),
q AS (SELECT k, count(*) AS n_removed, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS removed_lines FROM r GROUP BY k)
SELECT doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  coalesce(removed_lines, '') AS removed_lines
FROM d LEFT JOIN c USING (k) LEFT JOIN q USING (k)
"""
