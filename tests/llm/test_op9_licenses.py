import random
import re

import duckdb

from pyspark.sql import functions as F

from vehiscope.llm import licenses as L

from .conftest import clashing


def grams(text):
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text.lower())
    return set(zip(w, w[1:]))


def brute(text, templates, bound=0.8):
    units = (text or "").split("\n")
    units = [*enumerate(units)] + ([(-1, text)] if len(units) > 1 else [])
    out = {}
    for at, u in units:
        for name, t in templates:
            a, b = grams(u), grams(t)
            if a and b and (d := 2 * len(a & b) / (len(a) + len(b))) >= bound:
                out[at, name] = max(d, out.get((at, name), 0))
    return out


LINES = [t for _, t in L.TEMPLATES] + [
    "LICENSED under the apache license version 2.0", "Licensed under the Apache License", "Released under the MIT License. Thanks!",
    "Licensed under CC BY 4.0", "no licence here at all", "License", "",
    "This work is licensed under the GNU General Public License, version 2."]


def docs(spark, edge_docs):
    rows = [(k, x, "en", "s", 1) for k, x in enumerate(LINES)] + [
        (100, "\n".join(LINES), "en", "s", 1), (101, "Permission is hereby granted, free of charge, to any person obtaining a copy of\n"
         "this software and associated documentation files (the \"Software\"), to deal in the Software without restriction,", "", "", 1)]
    return edge_docs.unionByName(spark.createDataFrame(rows, edge_docs.schema))


def test_equals_all_templates_against_all_units(spark, edge_docs):
    d = clashing(docs(spark, edge_docs), "n", "grams", "own", "license", "line")
    got = {(r.doc_id, r.digest, r.line, r.license): r.dice for r in L.scan(d).where("line >= -1").collect()}
    import hashlib
    want = {(r.doc_id, hashlib.md5(r.text.encode()).hexdigest(), at, name): dice
            for r in d.collect() if r.text for (at, name), dice in brute(r.text, L.TEMPLATES).items()}
    assert got == want and len(want) > 20 and any(k[2] == -1 for k in want)


def words_of(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").lower())


def cut_dice(w, own):
    """Dice of a window once it is cut at its outermost shared bigrams."""
    g = list(zip(w, w[1:]))
    at = [i for i, x in enumerate(g) if x in own]
    if not at:
        return 0
    a = set(g[at[0]:at[-1] + 1])
    return 2 * len(a & own) / (len(a) + len(own))


def windows(text, templates, bound=0.8, every=False):
    """{(first word, licence): dice} of windows at anchors, or (licences) at every place."""
    w, out = words_of(text), {}
    for name, t in templates:
        own, m = grams(t), len(words_of(t))
        placed = {p - i for g, i in L.anchors(t, bound) for p in range(len(w) - 1) if " ".join(w[p:p + 2]) == g}
        for s in (range(2 - m, len(w)) if every else placed):
            part = w[max(s, 0):s + m]
            d = cut_dice(part, own)
            if d >= bound:
                first = max(s, 0) + next(i for i, x in enumerate(zip(part, part[1:])) if x in own)
                out[first, name] = max(d, out.get((first, name), 0))
    return out


def real_notices():
    """(licence, document): every template wrapped, inside a longer line and inside a long text."""
    rng = random.Random(9)
    filler = lambda n: " ".join(rng.choice("alpha the of and is beta to gamma in delta software under".split()) for _ in range(n))
    out = []
    for name, t in L.TEMPLATES:
        w = t.split()
        wrapped = "\n".join(" # " + " ".join(w[i:i + 7]) for i in range(0, len(w), 7))
        out += [(name, filler(80) + "\n" + wrapped + "\n\n" + filler(200)), (name, filler(30) + " " + t + " " + filler(30)),
                (name, "Copyright (c) 2020 Some Body\n\n" + wrapped + "\n\n" + filler(2500))]
    return out


def test_anchors_lose_no_unit():
    for _, t in L.TEMPLATES:
        own, held = L.template_bigrams(t), {g for g, _ in L.anchors(t, L.DICE)}
        left = len(own) - len(held)
        # a unit without an anchor shares at most `left` bigrams, of at least as many of its own
        assert all(2 * left / (n + len(own)) < L.DICE for n in L.size_bounds(len(own), L.DICE))


def test_windows_equal_brute_force_and_find_real_notices(spark, edge_docs):
    rows = real_notices()
    rng = random.Random(4)
    for name, t in L.TEMPLATES:  # edited copies in a text
        for share in (0.02, 0.05, 0.1):
            w = [x for x in t.split() if rng.random() > share / 2]
            rows.append((name, " ".join(["start of text"] + [x if rng.random() > share else "changed" for x in w] + ["end of text"])))
    d = spark.createDataFrame([(k, x, "en", "s", 1) for k, (_, x) in enumerate(rows)], edge_docs.schema).repartition(3)
    got = {}
    for r in L.scan(d).where("line = -2").collect():
        got.setdefault(r.doc_id, {})[r.word, r.license] = r.dice
    for k, (name, x) in enumerate(rows):
        assert got.get(k, {}) == windows(x, L.TEMPLATES)
        if k < 3 * len(L.TEMPLATES):
            assert any(n == name for _, n in got[k]), x
    # recall of anchored windows against windows at every place
    every = [{n for _, n in windows(x, L.TEMPLATES, every=True)} for _, x in rows]
    found = sum(len(e & {n for _, n in got.get(k, {})}) for k, e in enumerate(every))
    assert found >= 0.95 * sum(map(len, every))


def test_wrapped_inline_and_full_texts(spark, edge_docs):
    mit = ("MIT License\n\nCopyright (c) 2020 A\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\n"
           "of this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, "
           "including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\n"
           "copies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:\n")
    cases = [("MIT", mit), ("CC-BY-4.0", "We are glad. This work is licensed under a Creative Commons Attribution 4.0 "
                            "International License. Read on for the rest of the story of our journey, which was long."),
             ("Apache-2.0", "# Licensed under the Apache License,\n# Version 2.0 (the \"License\");\n# you may not use this\n"
              "# file except in\n# compliance with the\n# License.\nimport os\n" + "x = 1\n" * 300), ("", "The license of the zoo is new.")]
    d = spark.createDataFrame([(k, x, "en", "s", 1) for k, (_, x) in enumerate(cases)], edge_docs.schema)
    got = {}
    for r in L.scan(d).collect():
        got.setdefault(r.doc_id, set()).add(r.license)
    assert [got.get(k, {""}) >= {n} for k, (n, _) in enumerate(cases)] == [True] * 4 and 3 not in got


def test_size_bounds_lose_nothing():
    for n in range(1, 60):
        own = L.size_bounds(n, L.DICE)
        for m in range(1, 200):
            assert (2 * min(n, m) / (n + m) >= L.DICE) == (m in own)


def test_query_equals_sql(spark, edge_docs, no_docs, tmp_out):
    path = tmp_out + "/sf"
    docs(spark, edge_docs).where("text not like '%\x00%' or text is null").write.parquet(path + "/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/documents.parquet/*.parquet')")
    want = con.sql(L.OP9_SQL)
    got = L.op9_licenses(spark, path).select(*want.columns).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want.fetchall()))
    assert L.scan(no_docs).count() == 0


def test_the_pattern_finds_just_the_texts_with_a_bigram(spark):
    """One search instead of a cut of every text into words."""
    grams = ["mit license", "the mit", "axb c", "gr\u00fcn tee"]
    texts = ["the mit", "see the  MIT-License!", "thee mit", "the mitt", "the", "mit\nlicense", "amit license", "mit licenses",
             "\u00e9mit license", "mit license\u00e9", "\U0001f600mit license", "mit license\U0001f600", "mit \U0001f600 license",
             "axb\tc", "axb c0", "Gr\u00fcn, Tee", "gr\u00fcn\u00a0tee", "", "the 'mit'", "(the) mit"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").withColumn("w", L._words(F.col("text")))
    own = F.arrays_overlap(L._neighbours("w"), F.array(*[F.lit(g) for g in grams]))
    got = df.select("text", F.lower("text").rlike(L.bigram_pattern(grams)).alias("p"), own.alias("o")).collect()
    assert [r.p for r in got] == [bool(r.o) for r in got] and sum(r.p for r in got) == 7
    assert not spark.range(1).select(F.lit("a b").rlike(L.bigram_pattern([]))).first()[0]
