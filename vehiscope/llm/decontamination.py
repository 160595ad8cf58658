"""Benchmark decontamination by Wu-Manber multi-pattern search.

Patterns are the 10-word windows of the benchmark items (an item of fewer words
is one window), as canonical bytes: A-Z lower-cased, words joined and framed by
single spaces, so a match starts and ends at word borders. Windows of one word
count share a table set. A block of the last bytes of the current text window is
looked up in the shift table; a positive shift skips positions where no pattern
can end; at shift zero the block selects the bucket of patterns with that
suffix, and direct comparison confirms each occurrence.

The distinct windows are written with a block number, about ``WINDOWS_PER_BLOCK``
to a block. A job has one block, which alone is on the driver and broadcast; the
documents with the hits so far are written between the jobs, without a shuffle
(none is written for a benchmark of one block). Only their texts and hits pass
through Python.

Defined results
    null or wordless text: no words, not contaminated; null or wordless item:
    ignored; null item_id: its windows mark words but it is not listed;
    repeated items or ids: listed once; empty benchmark: nothing is hit; very
    long texts are scanned whole; other input columns are carried by `scan`
    unchanged, and its own columns get names that do not occur in the input.
"""

from __future__ import annotations

import math
import uuid
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vehiscope.llm.common import fresh, written

WINDOW = 10
BLOCK = 8
WINDOWS_PER_BLOCK = 200_000
HITS = "n_words long, spans array<int>, items array<string>"

#: A-Z to a-z; every ASCII byte that is no letter or digit to a space.
CANONICAL = bytes(b + 32 if 0x41 <= b <= 0x5A else b
                  if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
                  for b in range(256))


def canonical_words(text: str | None) -> list[bytes]:
    return text.encode().translate(CANONICAL).split() if text else []


def windows(text: str | None, size: int = WINDOW) -> list[bytes]:
    """The framed windows of an item; one window if it has fewer words."""
    w = canonical_words(text)
    if not w:
        return []
    return [b" " + b" ".join(w[i:i + size]) + b" " for i in range(max(1, len(w) - size + 1))]


class WuManber:
    """Tables for patterns that all have the same number of words."""

    def __init__(self, patterns: list[bytes], block: int = BLOCK):
        self.m = m = min(map(len, patterns))
        self.b = b = min(block, m)
        self.default = m - b + 1
        self.shift: dict[bytes, int] = {}
        self.bucket: dict[bytes, list[bytes]] = defaultdict(list)
        for p in patterns:
            for end in range(b, m + 1):
                key = p[end - b:end]
                if m - end < self.shift.get(key, self.default):
                    self.shift[key] = m - end
            self.bucket[p[m - b:m]].append(p)

    def find(self, text: bytes) -> Iterator[tuple[int, bytes]]:
        """(offset, pattern) of every occurrence, offsets rising."""
        m, b, default, shift, bucket = self.m, self.b, self.default, self.shift, self.bucket
        pos, n = m, len(text)
        while pos <= n:
            block = text[pos - b:pos]
            step = shift.get(block, default)
            if step:
                pos += step
                continue
            for p in bucket[block]:
                if text.startswith(p, pos - m):
                    yield pos - m, p
            pos += 1


class Matcher:
    """All windows of one block, one table set per word count."""

    def __init__(self, found: list[tuple[str | None, bytes]]):
        self.items: dict[bytes, set[str]] = defaultdict(set)
        for item, p in found:
            self.items[p] |= {item} - {None}
        by_count = defaultdict(list)
        for p in self.items:
            by_count[p.count(b" ") - 1].append(p)
        self.tables = [(n, WuManber(ps)) for n, ps in sorted(by_count.items())]

    def scan(self, words: list[bytes]) -> tuple[list[int], set[str]]:
        """First and past-last word of each merged hit span, flat; the items hit."""
        text = b" " + b" ".join(words) + b" "
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        for n, table in self.tables:
            at = word = 0
            for offset, p in table.find(text):
                word += text.count(b" ", at, offset)
                at = offset
                spans.append((word, word + n))
                items |= self.items[p]
        return merged(spans), items


def merged(spans: list[tuple[int, int]]) -> list[int]:
    out: list[int] = []
    for s, e in sorted(spans):
        if out and s <= out[-1]:
            out[-1] = max(out[-1], e)
        else:
            out += [s, e]
    return out


def _windows(benchmark: DataFrame, size: int) -> DataFrame:
    """The (item_id, window) pairs, once per item row."""
    def cut(frames):
        for f in frames:
            rows = [(i, p) for i, t in zip(f["item_id"], f["text"]) for p in dict.fromkeys(windows(t, size))]
            yield pd.DataFrame(rows, columns=["item_id", "window"])

    return (benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string"))
            .mapInPandas(cut, "item_id string, window binary"))


def _blocks(benchmark: DataFrame, size: int, limit: int) -> Iterator[list[tuple[str | None, bytes]]]:
    """The (item_id, window) pairs in blocks of at most ``limit``; one partition
    of them is on the driver at a time."""
    block: list[tuple[str | None, bytes]] = []
    for r in _windows(benchmark, size).toLocalIterator():
        block.append((r[0], bytes(r[1])))
        if len(block) == limit:
            yield block
            block = []
    if block:
        yield block


_TABLES: dict[str, Matcher] = {}


def _matcher(key: str, sent) -> Matcher:
    """The tables of a block, kept by a Python worker for its next task."""
    if key not in _TABLES:
        if len(_TABLES) >= 4:
            _TABLES.clear()
        _TABLES[key] = Matcher(sent.value)
    return _TABLES[key]


def _scanner(key: str, sent):
    """A vectorised function (text, hits so far or null) -> hits."""
    @F.pandas_udf(HITS)
    def hits(batches: Iterator[tuple[pd.Series, pd.DataFrame]]) -> Iterator[pd.DataFrame]:
        matcher = _matcher(key, sent)
        for texts, before in batches:
            rows = []
            for text, s, i in zip(texts, before["spans"], before["items"]):
                words = canonical_words(text)
                found, items = matcher.scan(words)
                if s is not None and len(s):
                    s = [int(x) for x in s]
                    found = merged([*zip(s[::2], s[1::2]), *zip(found[::2], found[1::2])])
                    items = items.union(i)
                rows.append((len(words), found, sorted(items)))
            yield pd.DataFrame(rows, columns=["n_words", "spans", "items"])
    return hits


def hits_column(spark: SparkSession, text: Column, benchmark: DataFrame, size: int = WINDOW,
                limit: int = WINDOWS_PER_BLOCK) -> Column:
    """A struct per text: n_words, the merged hit spans (flat array of first and
    past-last word) and the sorted ids of the items that occur. All blocks in one
    expression, for a benchmark that fits in memory; `scan` holds one at a time."""
    out = F.lit(None).cast(f"struct<{HITS.replace(' long', ':long').replace(' array', ':array')}>")
    for block in [*_blocks(benchmark, size, limit)] or [[]]:
        out = _scanner(uuid.uuid4().hex, spark.sparkContext.broadcast(block))(text, out)
    return out


def scan(docs: DataFrame, benchmark: DataFrame, name: str, size: int = WINDOW,
         limit: int = WINDOWS_PER_BLOCK) -> DataFrame:
    """The documents and their hits, as of `hits_column`, in a column ``name``;
    one block of windows a job."""
    spark = docs.sparkSession
    pairs = written(_windows(benchmark, size).distinct(), "benchmark-windows")
    blocks = max(1, math.ceil(pairs.count() / limit))
    if blocks > 1:
        pairs = written(pairs.withColumn("block", F.pmod(F.xxhash64("item_id", "window"), F.lit(blocks)))
                        .repartition(blocks, "block").sortWithinPartitions("block"), "benchmark-blocks")
    kind = f"struct<{HITS.replace(' long', ':long').replace(' array', ':array')}>"
    out = docs.withColumn(name, F.lit(None).cast(kind))
    for k in range(blocks):
        own = pairs.where(F.col("block") == k) if blocks > 1 else pairs
        sent = spark.sparkContext.broadcast([(r["item_id"], bytes(r["window"])) for r in own.collect()])
        out = out.withColumn(name, _scanner(uuid.uuid4().hex, sent)(out["text"], out[name]))
        if k + 1 < blocks:
            out = written(out, f"documents-hits-{k}")
            sent.unpersist()
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any word inside an occurrence of a window."""
    (hits,) = fresh(docs, "hits")
    return scan(docs, benchmark, hits).where(F.size(F.col(hits)["spans"]) == 0).drop(hits)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and items of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    h = scan(docs.select("doc_id", "text"), bench, "h")
    signs = F.transform("h.spans", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x))
    return h.select(
        "doc_id", "h.n_words", F.aggregate(signs, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_hit"),
        F.size("h.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("h.items", ","), 256).alias("items_sha256"),
        (F.size("h.spans") > 0).alias("contaminated"))


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP8_SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS k, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS p
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT k, n, i, array_to_string(w[i:i + n - 1], ' ') AS p
  FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hit AS MATERIALIZED (SELECT dw.k, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.p = bw.p),
pos AS (SELECT k, count(DISTINCT j) AS n_hit FROM (SELECT DISTINCT k, unnest(range(i, i + n)) AS j FROM hit) GROUP BY k),
it AS (SELECT k, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS h
  FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(h, sha256('')) AS items_sha256,
  n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN pos USING (k) LEFT JOIN it USING (k)
"""
