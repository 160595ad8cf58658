import random

import numpy as np
import xxhash

from vehiscope.llm import simhash as H

from .conftest import clashing, words


def plain_fingerprint(text):
    w = [x for x in (text or "").encode().lower().split()]
    if not w:
        return 0
    grams = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    fps = sorted(root)
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    return {f: find(f) for f in fps}


def near(rng, f, bits):
    for b in rng.sample(range(64), bits):
        f ^= 1 << b
    return f


def some_fingerprints(rng, n=300):
    out = {rng.getrandbits(64) for _ in range(n)} | {0, 1, (1 << 64) - 1}
    for f in list(out)[:60]:
        for k in (1, 2, 3, 4, 3, 3):
            f = near(rng, f, k)
            out.add(f)
    dense = rng.getrandbits(64)
    return out | {near(rng, dense, rng.randrange(5)) for _ in range(200)}


def test_fingerprint_equals_the_definition(monkeypatch):
    rng = random.Random(3)
    texts = [None, "", " \n", "One", "one TWO", "a b c", "a b c a b c", "É b ñ D"] + [
        " ".join(words(rng, rng.randrange(1, 200), 30)) for _ in range(50)]
    for chunk in (65_536, 7):
        monkeypatch.setattr(H, "CHUNK", chunk)
        assert [H.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]


def test_tree_keeps_every_pair_together():
    rng = random.Random(4)
    fps = np.array(sorted(some_fingerprints(rng)), dtype=np.uint64)
    for sample in (fps, fps[::9]):
        tree = H.VantagePointTree(sample, len(fps), leaf=20)
        assert tree.leaves > 4
        at = [set() for _ in fps]
        for leaf, own in tree.route(fps):
            for i in own:
                at[i].add(leaf)
        for i in range(len(fps)):
            for j in range(i):
                if int(fps[i] ^ fps[j]).bit_count() <= 3:
                    assert at[i] & at[j]


def test_components_equal_all_pairs(spark):
    rng = random.Random(6)
    fps = some_fingerprints(rng)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(4)
    found = H.components(H.links(df, leaf=40))
    got = {r.node % (1 << 64): r.root % (1 << 64) for r in found.collect()}
    want = plain_components(fps)
    groups = {}
    for f, r in want.items():
        groups.setdefault(r, set()).add(f)
    mine = {}
    for f in fps:
        mine.setdefault(got.get(f, f), set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_query_and_edges(spark, edge_docs, no_docs, tmp_out):
    path = tmp_out + "/sf"
    edge_docs.write.parquet(path + "/documents.parquet")
    rows = edge_docs.collect()
    want = plain_components({plain_fingerprint(r.text) for r in rows})
    low = {}
    for r in rows:
        c = want[plain_fingerprint(r.text)]
        if r.doc_id is not None:
            low[c] = min(low.get(c, r.doc_id), r.doc_id)
    expected = sorted(((r.doc_id, f"{plain_fingerprint(r.text):016x}", low.get(want[plain_fingerprint(r.text)])) for r in rows), key=str)
    assert sorted(map(tuple, H.op10_simhash(spark, path).collect()), key=str) == expected
    d = clashing(edge_docs, "digest", "nth", "fp", "root", "k1")
    kept = H.drop_near_duplicates(d)
    assert kept.columns == d.columns and kept.count() == len(set(want.values()))
    assert H.drop_near_duplicates(no_docs).count() == 0
