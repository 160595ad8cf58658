"""SimHash near-duplicates through a vantage-point tree over fingerprints.

The distinct 64-bit fingerprints are partitioned by a vantage-point tree: each
node sends fingerprints within its cut distance of its vantage point to the left
and the others to the right. By the triangle inequality two fingerprints at most
``bits`` apart differ by at most ``bits`` in their distance to the vantage point,
so only a left fingerprint within ``bits`` of the cut can have partners on the
right: exactly those are also sent to the right shard, all other branches are
pruned. Each leaf is one shard of a few ten thousand fingerprints, searched
exactly with packed XOR and bit counts; pairs inside a leaf are emitted as a
spanning forest, which keeps every link between classes without all pairs of a
dense group.

The tree is fitted on a bounded sample of the fingerprints (``SAMPLE``, lowest
hash first) and their number; every fingerprint is indexed and the result does
not depend on the sample, only the balance of the shards does. Nothing else
reaches the driver.

Defined results
    null, empty or wordless text: fingerprint zero, linked like any other; fewer
    words than a shingle: the whole sequence is the one shingle; a bit set in
    exactly half of the hashes is 0; null doc_id: never the smallest (a component
    of null ids only has a null id); repeated rows: the same fingerprint, one
    survivor; empty table: empty result; other columns are carried unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vehiscope.llm.common import components, fresh, scratch, written

SHINGLE = 3
BITS = 3
SEED = 42
#: Fingerprints the tree is fitted on, at most.
SAMPLE = 20_000
#: Fingerprints a leaf should hold.
LEAF = 32_768
#: Hashes whose bits are unpacked at once.
CHUNK = 65_536


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as an unsigned integer."""
    import xxhash
    words = text.encode().lower().split() if text else []  # both are ASCII-only on bytes
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, CHUNK):
        part = words[at:min(n, at + CHUNK) + shingle - 1]
        grams = zip(*[part[k:] for k in range(shingle)]) if len(words) >= shingle else [part]
        h = np.fromiter((digest(b" ".join(g), SEED) for g in grams), dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprint_column(shingle: int = SHINGLE):
    """A vectorised function text -> fingerprint (long, same bits)."""
    @F.pandas_udf("long")
    def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))
    return fingerprints


class VantagePointTree:
    """Nodes in one list: (vantage, cut, left, right), or a leaf number."""

    def __init__(self, sample: np.ndarray, total: int, bits: int = BITS, leaf: int = LEAF):
        self.bits = bits
        self.nodes: list[tuple[int, int, int, int] | int] = []
        self.leaves = 0
        self._build(np.unique(sample.astype(np.uint64)), max(1.0, total / max(1, len(sample))), leaf)

    def _build(self, own: np.ndarray, weight: float, leaf: int) -> int:
        here = len(self.nodes)
        self.nodes.append(self.leaves)
        if len(own) * weight > leaf and (split := self._split(own)):
            vantage, cut, left, right = split
            self.nodes[here] = (vantage, cut, 0, 0)
            self.nodes[here] = (vantage, cut, self._build(left, weight, leaf), self._build(right, weight, leaf))
        else:
            self.leaves += 1
        return here

    def _split(self, own: np.ndarray):
        """The candidate and cut that leave the smallest larger side."""
        best = None
        for v in own[np.linspace(0, len(own) - 1, min(24, len(own))).astype(int)]:
            d = np.bitwise_count(own ^ v)
            at_most = np.cumsum(np.bincount(d, minlength=65))
            for cut in range(64):
                left = at_most[cut]
                copies = left - (at_most[cut - self.bits] if cut >= self.bits else 0)
                right = len(own) - left + copies
                size = max(left, right)
                if left < len(own) and (best is None or size < best[0]):
                    best = (size, int(v), cut, d)
        if best is None or best[0] > 0.9 * len(own):
            return None
        _, v, cut, d = best
        return v, cut, own[d <= cut], own[d > cut - self.bits]

    def route(self, fps: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, positions) for each leaf that gets some of the fingerprints."""
        stack = [(0, np.arange(len(fps)))]
        while stack:
            node, at = stack.pop()
            if not len(at):
                continue
            if isinstance(self.nodes[node], int):
                yield self.nodes[node], at
                continue
            vantage, cut, left, right = self.nodes[node]
            d = np.bitwise_count(fps[at] ^ np.uint64(vantage)).astype(np.int64)
            stack.append((left, at[d <= cut]))
            stack.append((right, at[d > cut - self.bits]))


def forest(fps: np.ndarray, bits: int = BITS, block: int = 16) -> list[tuple[int, int]]:
    """Edges that span the components of distinct fingerprints at most ``bits``
    apart. Each point is compared with the points not yet reached."""
    edges: list[tuple[int, int]] = []
    rest = fps

    def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.bitwise_count(a[:, None] ^ b[None, :]) <= bits

    while len(rest):
        seeds, others = rest[:block], rest[block:]
        linked = near(seeds, others).any(axis=1) | (near(seeds, seeds).sum(axis=1) > 1)
        if not linked.any():
            rest = others
            continue
        first = int(np.argmax(linked))
        rest = np.concatenate([seeds[linked][1:], others])
        frontier = seeds[first:first + 1]
        while len(frontier) and len(rest):
            now, frontier = frontier[:block], frontier[block:]
            m = near(now, rest)
            hit = m.any(axis=0)
            if hit.any():
                parent = now[m[:, hit].argmax(axis=0)]
                edges += zip(parent.tolist(), rest[hit].tolist())
                frontier = np.concatenate([frontier, rest[hit]])
                rest = rest[~hit]
    return edges


def links(fps: DataFrame, bits: int = BITS, leaf: int = LEAF) -> DataFrame:
    """Spanning edges ``a, b`` between the distinct fingerprints in ``fp``."""
    total = fps.count()
    sample = [r[0] for r in fps.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()]
    tree = VantagePointTree(np.array(sample, dtype=np.int64).view(np.uint64), total, bits, leaf)

    def route(batches):
        for f in batches:
            own = f["fp"].to_numpy().view(np.uint64)
            for number, at in tree.route(own):
                yield pd.DataFrame({"leaf": number, "fp": own[at].view(np.int64)})

    def search(f: pd.DataFrame) -> pd.DataFrame:
        found = np.array(forest(np.sort(f["fp"].to_numpy().view(np.uint64)), bits), dtype=np.uint64).reshape(-1, 2)
        return pd.DataFrame({"a": found[:, 0].view(np.int64), "b": found[:, 1].view(np.int64)})

    routed = fps.select("fp").mapInPandas(route, "leaf int, fp long")
    # one task per leaf or so: the leaves are the shards
    shards = max(1, min(tree.leaves, 100_000))
    return (routed.repartition(shards, "leaf").groupBy("leaf").applyInPandas(search, "a long, b long"))


def classes(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """``fp, root`` of every distinct fingerprint: ``root`` names its component."""
    found = components(links(fps, bits)).withColumnRenamed("node", "fp")
    return fps.select("fp").join(found, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """``doc_id, digest, fp, root`` per row: md5 of the text, fingerprint and the
    name of the component, written to the shared folder."""
    marks = written(docs.select("doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest"),
                                fingerprint_column(shingle)("text").alias("fp")), "fingerprints")
    roots = written(classes(marks.groupBy("fp").agg(F.count("*").alias("n")), bits), "components")
    return marks.join(roots, "fp")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """One document of each component: the one of the smallest doc_id (nulls
    last), then digest; of rows that repeat both, the first by all columns."""
    digest, nth, k1, k2 = fresh(docs, "digest", "nth", "kept_id", "kept_digest")
    with scratch(docs.sparkSession):
        kept = written(near_duplicates(docs, shingle, bits).groupBy("root").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("m"))
            .select(F.col("m.doc_id").alias(k1), F.col("m.digest").alias(k2)), "survivors", keep=True)
    keyed = docs.withColumn(digest, F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    order = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")] or [F.lit(0)]
    first = keyed.withColumn(nth, F.row_number().over(
        Window.partitionBy("doc_id", digest).orderBy(*order))).where(F.col(nth) == 1)
    return (first.join(kept, F.col("doc_id").eqNullSafe(F.col(k1)) & (F.col(digest) == F.col(k2)), "left_semi")
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with scratch(spark):
        marks = written(docs.select("doc_id", fingerprint_column()("text").alias("fp")), "fingerprints", keep=True)
        fps = written(marks.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct-fingerprints")
        found = components(links(fps)).withColumnRenamed("node", "fp")
        named = fps.join(found, "fp")
        lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
        labels = written(fps.join(named.join(lowest, "root").select("fp", "component_id"), "fp", "left")
                         .select("fp", F.coalesce("component_id", "low").alias("component_id")), "labels", keep=True)
    return marks.join(labels, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
