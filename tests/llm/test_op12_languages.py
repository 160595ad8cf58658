import math
import random
import re
import zlib

import pyarrow as pa
import pytest

from vehiscope.llm import languages as L

from .conftest import SF, clashing

EN = "the quick brown fox jumps over the lazy dog and then the fox runs to the river for water"
FR = "le renard brun saute par dessus le chien paresseux et puis il court vers la rivière pour boire"
ES = "el zorro marrón salta sobre el perro perezoso y luego corre hacia el río para beber agua"


def normal(text):
    return re.sub(rb"[^a-z\x80-\xff]+", b" ", text.lower().encode())


def brute(samples, text):
    """Longest matches looked up in the sample itself, byte by byte."""
    if text is None or not any(c.isalpha() for c in text):
        return "und", 0.0
    n, found = normal(text), []
    for name, texts in samples:
        sample = b"\x00".join(normal(t) for t in texts)
        phrases = 0
        for k in range(0, len(n), L.BLOCK):
            block, i = n[k:k + L.BLOCK], 0
            while i < len(block):
                size = 1
                while i + size < len(block) and block[i:i + size + 1] in sample:
                    size += 1
                i += size if block[i:i + 1] in sample else 1
                phrases += 1
        found.append((phrases * math.log2(max(2, len(sample))) / len(n), name))
    found.sort()
    return found[0][1], (1 - found[0][0] / found[1][0]) if len(found) > 1 else 1.0


def test_automaton_knows_exactly_the_substrings():
    rng = random.Random(1)
    for _ in range(30):
        s = [rng.randrange(1, 4) for _ in range(rng.randrange(1, 40))]
        step = L.suffix_automaton(s)
        runs = {tuple(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        for size in range(1, 6):
            for _ in range(60):
                w = tuple(rng.randrange(1, 4) for _ in range(size))
                at = 0
                for c in w:
                    at = step[at].get(c) if at is not None else None
                assert (at is not None) == (w in runs)
        assert all(t for d in step for t in d.values())


def test_equals_brute_force():
    rng = random.Random(7)
    samples = (("en", (EN, EN[5:60] + " zebra")), ("es", (ES,)), ("fr", (FR,)))
    alphabet = "abcdefghilmnoprstuéèñ  .,1#\n世Ω"
    texts = [None, "", " ", "1234 .!", "é", "a", "Ω", EN, FR.upper(), ES, "x" * 1000, (EN + " " + FR) * 5, " " * 300 + "the"]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 400))) for _ in range(60)]
    texts += [" ".join(rng.choices((EN + " " + FR + " " + ES).split(), k=rng.randrange(1, 90))) for _ in range(60)]
    pred, score = L.Languages(samples).predict(pa.array(texts))
    for t, p, s in zip(texts, pred, score):
        want, margin = brute(samples, t)
        assert p == want and abs(s - margin) < 1e-12, t
    # portions and slices change nothing
    cut = pa.array(["skip", *texts]).slice(1)
    old, L.PORTION = L.PORTION, 50
    try:
        again = L.Languages(samples).predict(cut)
    finally:
        L.PORTION = old
    assert again[0] == pred and list(again[1]) == list(score)


def test_nothing_or_one_language_learned():
    assert L.Languages(()).predict(pa.array(["abc", None]))[0] == ["und", "und"]
    pred, score = L.Languages((("en", (EN,)),)).predict(pa.array(["quelque chose", "12"]))
    assert pred == ["en", "und"] and list(score) == [1.0, 0.0]


def test_fit_is_bounded_and_reads_no_held_out_row(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices({"en": EN, "fr": FR}[lang].split(), k=40)), lang, "s", 1)
            for i in range(300) for lang in ("en", "fr")]
    rows += [(i, "copied text " * 4, "en", "s", 1) for i in range(400)]  # a text counts once
    rows += [(1000 + i, EN, None, "s", 1) for i in range(5)] + [(None, "no id here", "xx", "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").repartition(4)
    samples = L.fit(df, sample_bytes=8000, language_bytes=5000, sample_texts=15, languages=5)
    assert [s[0] for s in samples] == ["en", "fr"]
    allowed = {(r[2], r[1]) for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 != 1}
    for name, texts in samples:
        assert len(set(texts)) == len(texts) <= 15 and sum(len(t.encode()) for t in texts) <= 4000
        assert {(name, t) for t in texts} <= allowed
    assert samples == L.fit(df.repartition(2), sample_bytes=8000, language_bytes=5000, sample_texts=15, languages=5)


def test_edges(spark, edge_docs, edge_rows, no_docs):
    docs = clashing(edge_docs, "h", "size", "held_out", "lang_pred", "k", "sofar", "score")
    samples = L.fit(docs)
    got = sorted(map(tuple, L.identify(docs, samples).collect()), key=str)
    want = []
    for r in edge_rows:
        p, s = brute(samples, r[1]) if len(r[1] or "") < 10_000 else (None, None)
        want.append((r[0], r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 1, p, s))
    for g, w in zip(got, sorted(want, key=str)):
        assert g[:2] == w[:2]
        if w[2]:
            assert g[2] == w[2] and abs(g[3] - w[3]) < 1e-12
    assert L.fit(no_docs) == () and L.identify(no_docs, ()).count() == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = L.op12_languages(spark, SF).where("held_out").join(docs.select("doc_id", "lang").where("lang is not null"), "doc_id")
    right, n = out.selectExpr("sum(cast(lang = lang_pred as int))", "count(*)").first()
    assert n > 20 and right / n > 0.95
