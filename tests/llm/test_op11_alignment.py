import hashlib
import random
from collections import Counter

import pyarrow as pa
import pytest

from vehiscope.llm import alignment as A

from .conftest import SCHEMA, clashing

TEXTS = [None, "", " ", "  two  spaces ", "\n", "a\n\nb\n", "\t tab", "héllo wörld", "世界 \U0001F600 ok", "<s> </s> <unk> <0x0A>",
         "<|endoftext|> x", "x ▁ y", "▁", "\x00 null", "a" * 5000, "ab " * 300, "don't we'll I'M 'S x's", "The quick brown fox.",
         "a b c d ​ e", " lead", "trail ", "a \n b", "日本語のテキスト 世界", "- -- --- 12 345 6.7", "ſ ’s", "é é"]


def brute(texts, a_path=None, b_path=None):
    """Whole texts through the libraries, all links as a list."""
    import sentencepiece
    from tokenizers import Tokenizer
    a_path, b_path = A.default_paths()
    ta = Tokenizer.from_file(a_path)
    ta.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=b_path)
    letters = A.byte_letters()
    docs = []
    for t in texts:
        groups = []
        if t:
            a = ta.encode(" " + t, add_special_tokens=False)
            ab = [bytes(letters[c] for c in x) for x in a.tokens]
            b = sp.encode(t)
            bb = []
            for i in b:
                p = sp.id_to_piece(i)
                bb.append(bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode())
            if b"".join(ab) == b"".join(bb) == (" " + t).encode():
                i = j = x = y = 0
                ga, gb = [], []
                while i < len(ab) or j < len(bb):
                    if x <= y:
                        ga.append(a.ids[i]); x += len(ab[i]); i += 1
                    else:
                        gb.append(b[j]); y += len(bb[j]); j += 1
                    if x == y:
                        groups.append((ga, gb))
                        ga, gb = [], []
        docs.append(groups)
    links = [Counter((p, q) for ga, gb in g for p in ga for q in gb) for g in docs]
    count = Counter(pair for link in links for pair in link)
    best = {}
    for (p, _), n in count.items():
        best[p] = max(best.get(p, 0), n)
    out = []
    for g, link in zip(docs, links):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out.append((sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(link.values()),
                    sum(n for (p, q), n in link.items() if count[p, q] == best[p]),
                    sum(n * count[pair] for pair, n in link.items()),
                    hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return out


def random_texts(rng, n):
    alphabet = "abcdefgh theinéñ▁\n .,!世\U0001F600'"
    plain = "the of and tion ing un re Über straße naïve 12 -- , . x".split(" ")
    return (["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 200))) for _ in range(n)]
            + ["".join(rng.choice(alphabet.replace("▁", "")) for _ in range(rng.randrange(1, 200))) for _ in range(n)]
            + [rng.choice((" ", "  ", "\n")).join(rng.choice(plain) + rng.choice(plain) for _ in range(rng.randrange(1, 120)))
               for _ in range(n)])


@pytest.mark.parametrize("frequent", [A.FREQUENT, 20, 0])
def test_equals_the_libraries_on_whole_texts(spark, frequent):
    rng = random.Random(11)
    texts = TEXTS + random_texts(rng, 40)
    texts += texts[-30:]  # repeated rows
    df = spark.createDataFrame([(i, t, None, "s", 1) for i, t in enumerate(texts)], SCHEMA).repartition(4)
    got = {r.doc_id: tuple(r)[1:] for r in A.align(df, frequent=frequent).collect()}
    want = brute(texts)
    assert len(got) == len(texts)
    for i, w in enumerate(want):
        assert got[i] == w, texts[i]


def test_a_full_cache_and_wide_groups_change_nothing(monkeypatch):
    rng = random.Random(3)
    texts = pa.array(TEXTS + random_texts(rng, 20))
    big = A.Aligner(*A.default_paths()).align(texts)
    monkeypatch.setattr(A, "WIDE", 3)
    monkeypatch.setattr(A, "LONG", 5)
    small = A.Aligner(*A.default_paths(), cache=4)
    again = small.align(texts)
    for x, y in zip((big[0], *big[2], *big[3]), (again[0], *again[2], *again[3])):
        assert x.tolist() == y.tolist()
    assert big[1] == again[1] == small.align(texts)[1]


def test_edges(spark, edge_docs, edge_rows, no_docs):
    df = clashing(edge_docs, "row", "code", "n_a", "own", "pairs", "a", "b", "n")
    got = sorted(map(tuple, A.align(df).collect()), key=str)
    assert got == sorted(((r[0], *w) for r, w in zip(edge_rows, brute([r[1] for r in edge_rows]))), key=str)
    assert A.align(no_docs).count() == 0


def test_the_check_finds_a_difference():
    own = A.Aligner(*A.default_paths())
    own.quick = type("Wrong", (), {"encode_ordinary": staticmethod(lambda t: [0])})
    with pytest.raises(ValueError, match="differ"):
        own.align(pa.array(["some text"]))
