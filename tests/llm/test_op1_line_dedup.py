import hashlib
import random
import re

import duckdb
import pytest

from pyspark.sql import functions as F

from vehiscope.llm import lines as L

from .conftest import clashing, words

BLANK = re.compile("[ \t\r]+")


def line_words(line):
    return tuple(w for w in BLANK.split(line.lower()) if w)


def tokens(w):
    return frozenset(w[i:i + 5] for i in range(max(1, len(w) - 4)))


def brute(rows):
    """{(doc_id, text): removed line numbers}, every pair compared."""
    at = []
    for i, t in {(r[0], r[1]) for r in rows if r[1] is not None}:
        key = (i is None, i or 0, hashlib.md5(t.encode()).hexdigest())
        at += [(key, p, line_words(x), (i, t)) for p, x in enumerate(t.split("\n")) if line_words(x)]
    at.sort(key=lambda x: x[:2])
    first = {}
    for key, p, w, d in at:
        first.setdefault(w, len(first))
    order = list(first)
    sets = [tokens(w) for w in order]
    gone = {w for k, w in enumerate(order) if any(
        5 * len(sets[k] & sets[j]) >= 4 * len(sets[k] | sets[j]) for j in range(k))}
    out, seen = {}, set()
    for key, p, w, d in at:
        if w in gone or w in seen:
            out.setdefault(d, []).append(p)
        seen.add(w)
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    base = [words(rng, n) for n in (3, 5, 6, 9, 20, 40, 60, 80, 120) for _ in range(4)]
    out = []
    for k in range(60):
        text = []
        for w in rng.sample(base, 6):
            w = list(w)
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2, 3])):
                w[rng.randrange(len(w))] = f"new{rng.randrange(9)}"
            text.append((" " * rng.randrange(3)).join(["", " ".join(w), ""]).replace("w1", "W1"))
            if rng.random() < 0.2:
                text.append("")
        out.append((k // 2, "\n".join(text), "en", "s", 1))
    # many versions of one line, none like the first
    line = words(rng, 70, 10 ** 6)
    for k in range(40):
        w = list(line)
        w[k], w[(k + 9) % 70] = f"e{k}", f"f{k}"
        out.append((500 + k, " ".join(w), "en", "s", 1))
    return out


def found(spark, docs):
    digests = {(r.doc_id, hashlib.md5(r.text.encode()).hexdigest()): (r.doc_id, r.text)
               for r in docs.collect() if r.text is not None}
    return {digests[r.doc_id, r.digest]: r.removed for r in L.removed_lines(docs).collect()}


@pytest.mark.parametrize("rounds", [1, 2])
def test_equals_all_pairs(spark, rows, monkeypatch, rounds):
    monkeypatch.setattr(L, "ROUNDS", rounds)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").repartition(3)
    got = found(spark, docs)
    assert got == brute(rows) and sum(map(len, got.values())) > 60


def test_edges_and_text(spark, edge_rows, edge_docs, no_docs):
    want = brute(edge_rows)
    assert found(spark, edge_docs) == want
    d = clashing(edge_docs, "digest", "removed", "left", "pos", "words", "k1", "removed_id")
    out = L.dedup_lines(d)
    assert out.columns == d.columns
    kept = {(r.doc_id, r.text, r.n_chars) for r in out.collect()}
    for i, t, _, _, n in edge_rows:
        gone = want.get((i, t))
        if not gone:
            assert (i, t, n) in kept
        else:
            new = "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone)
            assert ((i, new, len(new)) in kept) == bool(line_words(new))
    assert L.dedup_lines(no_docs).count() == 0


def test_query_equals_sql(spark, edge_docs, tmp_out):
    path = tmp_out + "/sf"
    edge_docs.where("text not like '%\x00%' or text is null").write.parquet(path + "/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/documents.parquet/*.parquet')")
    q = L.op1_line_dedup(spark, path)
    want = con.sql(L.OP1_SQL)
    assert sorted(map(str, (tuple(r) for r in q.select(*want.columns).collect()))) == sorted(map(str, want.fetchall()))


def test_members_of_a_group_that_differ_do_not_meet(spark):
    """Near copies of a line, none similar to another: no pair of them passes the
    filters; a similar one still meets its line."""
    words = [f"w{k}" for k in range(60)]
    texts = [" ".join(f"x{m}-{k}" if k in (12, 24, 36, 48) else w for k, w in enumerate(words)) for m in range(40)]
    texts.append(" ".join([*words[:12], "x7-12", *words[13:24], "x7-24", *words[25:36], "x7-36", *words[37:48], "x7-48",
                           *words[49:59], "other"]))
    lines = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "line long, text string").withColumn("line_", F.col("text"))
    rare = L._rarity_literal(L._rarity(lines.select(F.col("text").alias("line"))))
    tokens = lines.select("line", L._tokens(F.col("text"), rare).alias("t"))
    n = F.size("t")
    prefix = tokens.select("line", n.alias("n"), F.posexplode(F.slice("t", F.lit(1), L._prefix(n))).alias("i", "token"))
    a, b = prefix.alias("a"), prefix.alias("b")
    met = a.join(b, "token").where("a.line > b.line").where(
        L._possible(F.col("a.n"), F.col("a.i"), F.col("b.n"), F.col("b.i"))).select("a.line", "b.line").distinct().collect()
    assert [tuple(r) for r in met] == [(40, 7)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    assert [(r.doc_id, r.removed) for r in L.removed_lines(docs).collect()] == [(40, [0])]


def test_documents_are_numbered_in_order(spark, edge_rows, edge_docs):
    got = [(r.doc, r.doc_id, r.digest) for r in L._numbered(edge_docs.repartition(7)).collect()]
    want = {(i is None, i or 0, hashlib.md5(t.encode()).hexdigest(), i) for i, t, *_ in edge_rows if t is not None}
    assert sorted(got, key=lambda r: r[0]) == [(k, i, d) for k, (_, _, d, i) in enumerate(sorted(want, key=lambda r: r[:3]))]


def test_joins_of_tokens_move_numbers_only(spark, rows, monkeypatch):
    kinds, texts, write = {}, [], L.written

    def spy(df, name, keep=False):
        kinds[name] = {t for _, t in df.dtypes}
        if name.endswith("-pairs"):
            texts.append(name)
        return write(df, name, keep)

    monkeypatch.setattr(L, "written", spy)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    assert L.removed_lines(docs).count() > 0
    tables = [n for n in kinds if n.startswith(("line-prefixes", "line-leaders", "open-lines", "similar-lines", "marked"))]
    assert len(tables) > 2 * L.ROUNDS and all(kinds[n] <= {"bigint", "int", "boolean"} for n in tables)
    assert len(texts) == L.ROUNDS + 1
