import math
import re

import pytest
import xxhash

from vehiscope.llm import quality as Q

from .conftest import SF, clashing

BLANK = re.compile("[\x20\x09-\x0d]+")


def plain_base(text):
    t = text or ""
    w = [x for x in BLANK.split(t) if x]
    ls = [x for x in t.split("\n") if BLANK.sub("", x)]
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    many = {g for g in set(grams) if grams.count(g) > 1} if len(grams) < 3000 else set()
    return (len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", t)), len(ls) - len(set(ls)),
            len({i + k for i, g in enumerate(grams) if g in many for k in range(3)}))


def plain_features(text):
    toks, run = [], ""

    def kind(c):
        return None if c.isspace() else c.isalnum()

    for c in text:
        if run and kind(c) != kind(run[-1]):
            toks.append(run)
            run = ""
        run = run + c if kind(c) is not None else ""
    toks += [run] if run else []

    def h(*xs):
        seed = 42
        for x in xs:
            seed = xxhash.xxh64_intdigest(x.encode(), seed)
        return (seed - (1 << 64) if seed >> 63 else seed) % Q.BUCKETS

    return [h(x) for x in toks] + [h(a, b) for a, b in zip(toks, toks[1:])]


def test_base_columns(spark, edge_docs):
    more = spark.createDataFrame([(50, t, "", "", 1) for t in (
        "a b c a b c", "a a a a a", "x\n\nx\n x\nx ", "1 2 3 4 1 2 3 5 2 3 4", "# * $%&|<>", "a b c d", "a\tb\x0bc\x0cd\re\nf")],
        edge_docs.schema)
    docs = edge_docs.where("doc_id is null or doc_id <> 6").unionByName(more)
    got = docs.select("text", *[c.alias(n) for n, c in Q.base_columns(docs["text"]).items()]).collect()
    for r in got:
        assert tuple(r)[1:] == plain_base(r.text), r.text


def test_scores_equal_the_formula(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r.label_id for r in Q._labels(labels).where("good = 1 and fold = 0").collect()}
    raw, target = [1] * Q.BUCKETS, [1] * Q.BUCKETS
    rows = docs.select("doc_id", "text").collect()
    own = {r.doc_id: plain_features(r.text) for r in rows}
    for i, fs in own.items():
        for f in fs:
            raw[f] += 1
            target[f] += i in good
    ratio = Q.ratios(docs, labels)
    got = docs.select("doc_id", Q.score_column(docs["text"], ratio).alias("s")).collect()
    for r in got:
        fs = own[r.doc_id]
        want = sum(math.log(target[f] / sum(target)) - math.log(raw[f] / sum(raw)) for f in fs) / len(fs)
        assert r.s == pytest.approx(want, abs=1e-9)


def test_held_out_labels(spark):
    sf = SF.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = {r.doc_id: r for r in Q.op6_quality(spark, sf).collect()}
    held = Q._labels(labels).where("fold = 1").collect()
    good = [got[r.label_id].kept for r in held if r.quality == 1 and not got[r.label_id].base_failed]
    bad = [got[r.label_id].kept for r in held if r.quality == 0]
    assert len(good) > 100 and sum(good) >= 0.97 * len(good)
    assert len(bad) > 15 and sum(bad) <= 0.15 * len(bad)


def test_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0), (None, 1, 0), (7, None, 1)], "doc_id long, quality int, toxic int")
    d = clashing(edge_docs, "n_words", "score", "trusted", "label_id", "bucket", "c0", "base_failed")
    for own in (labels, labels.limit(0)):
        kept = Q.filter_quality(d, own)
        assert kept.columns == d.columns
        assert {r.doc_id for r in kept.collect()} <= {1, 2, None, 6}
    assert Q.filter_quality(d, labels.limit(0)).where("doc_id = 2").count() == 2
    assert Q.filter_quality(no_docs, labels).count() == 0
