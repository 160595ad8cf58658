import random
import re

from vehiscope.llm import decontamination as D

from .conftest import clashing, words

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_words(t):
    return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(text, items):
    w = plain_words(text)
    hit, found = set(), set()
    for item, t in items:
        b = plain_words(t)
        n = min(10, len(b))
        for i in range(max(0, len(b) - n + 1)) if n else ():
            for j in range(len(w) - n + 1):
                if w[j:j + n] == b[i:i + n]:
                    hit.update(range(j, j + n))
                    found.add(item)
    return len(w), len(hit), sorted(str(i) for i in found if i is not None)


def check(spark, docs, bench, limit):
    items = [tuple(r) for r in bench.select("item_id", "text").collect()]
    got = docs.select("doc_id", "text", D.hits_column(spark, docs["text"], bench, limit=limit).alias("h")).collect()
    for r in got:
        n, hits, ids = brute(r.text, items)
        s = r.h.spans
        assert (r.h.n_words, sum(s[1::2]) - sum(s[::2]), r.h["items"]) == (n, hits, ids)
    return got


def test_against_brute_force_in_one_block_and_in_many(spark):
    rng = random.Random(1)
    items = [(k, " ".join(words(rng, rng.choice([1, 2, 4, 9, 10, 11, 25]), 6))) for k in range(25)]
    items += [(None, " ".join(words(rng, 12, 6))), (90, None), (91, "..."), (3, "Été, Ñandú! w1")]
    docs = [(k, " ".join(words(rng, rng.randrange(0, 80), 6))) for k in range(40)]
    docs += [(100, items[6][1].upper() + "; tail"), (101, None), (102, "été ñandú W1"), (102, "été ñandú W1")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    one = check(spark, d, b, 10_000)
    assert sum(len(r.h.spans) > 0 for r in one) > 10
    check(spark, d, b, 40)


def test_wu_manber_finds_overlapping_patterns():
    t = D.WuManber([b" a b ", b" b a "])
    assert list(t.find(b" a b a b ")) == [(0, b" a b "), (2, b" b a "), (4, b" a b ")]


def test_edges(spark, edge_docs, no_docs):
    bench = spark.createDataFrame([(1, "one line one line"), (None, None), (2, "")], "item_id long, text string")
    empty = bench.limit(0)
    d = clashing(edge_docs, "n_words", "hits", "items", "h")
    check(spark, d, bench, 100)
    kept = D.decontaminate(d, bench)
    assert kept.columns == d.columns and kept.count() == d.count() - 1
    assert D.decontaminate(d, empty).count() == d.count()
    assert D.decontaminate(no_docs, bench).count() == 0


def test_one_block_of_windows_a_job(spark, monkeypatch):
    rng = random.Random(4)
    items = [(k, " ".join(words(rng, 25, 9))) for k in range(40)] + [(None, "w1 w2"), (90, None)]
    docs = [(k, " ".join(words(rng, 60, 9))) for k in range(30)] + [(31, None), (1, items[7][1]), (1, items[7][1])]
    d = clashing(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), "hits", "window", "block")
    b = spark.createDataFrame(items, "item_id long, text string").repartition(2)
    seen, context = [], type(spark.sparkContext)
    monkeypatch.setattr(context, "broadcast", lambda self, v, f=context.broadcast: seen.append(v) or f(self, v))
    # the blocks before the last are used up, and none is part of the last job
    got = D.scan(d, b, "h", limit=200)
    assert len(seen) > 2 and max(map(len, seen)) < 300
    assert got._jdf.queryExecution().optimizedPlan().toString().count("hits(") == 1
    rows = got.collect()
    assert len(rows) == len(docs) and got.columns == [*d.columns, "h"]
    for r in rows:
        s = r.h.spans
        assert (r.h.n_words, sum(s[1::2]) - sum(s[::2]), r.h["items"]) == brute(r.text, items)
