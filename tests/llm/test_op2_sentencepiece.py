import hashlib
import random

import pytest

from vehiscope.llm import sentencepieces as S

from .conftest import clashing

TEXTS = ["", " ", "  two  spaces ", "\n", "a\n\nb\n", "\t tab", "héllo wörld", "世界 \U0001F600 ok", "<s> </s> <unk> <0x0A>",
         "▁▁x ▁", "\x00 null", "a" * 5000, "ab " * 3000, "x" * 47 + "y", "x" * 60 + " " + "z" * 48, "The quick brown fox."]


@pytest.fixture(scope="module")
def encoder():
    return S.PieceEncoder(S.default_model())


def test_equals_the_library(encoder):
    rng = random.Random(2)
    alphabet = "abcdefgh theinéñ▁\n .,!世\U0001F600"
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 300))) for _ in range(400)]
    got = list(encoder.encode_batch(texts))
    assert got == encoder.library.encode(texts)
    assert [encoder.library.decode(i) for i in got] == [encoder.library.decode(i) for i in encoder.library.encode(texts)]


def test_both_agendas_agree(encoder):
    segments = [s for t in TEXTS for s in encoder.segments(t)]
    assert encoder.by_arrays(segments) == [encoder.by_heap(s) for s in segments]


def test_the_check_finds_a_difference(encoder):
    own = S.PieceEncoder(S.default_model())
    own.cache["▁fox"] = (5, 6)
    with pytest.raises(ValueError, match="the library encodes"):
        own.check(["▁fox"])


def test_a_full_cache_changes_nothing(encoder):
    small = S.PieceEncoder(S.default_model(), cache=3)
    for t in TEXTS:
        assert list(small.encode_batch([t])) == [encoder.library.encode(t)]


def test_query_and_edges(spark, edge_docs, no_docs, encoder):
    out = S.encode(clashing(edge_docs, "ids", "n_tokens", "e")).collect()
    rows = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256): r.ids for r in out}
    for r in edge_docs.collect():
        ids = encoder.library.encode(r.text or "")
        key = (r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
               hashlib.sha256(encoder.library.decode(ids).encode()).hexdigest())
        assert rows[key] == ids
    assert len(out) == edge_docs.count() and S.encode(no_docs).count() == 0
