import corpus_pipeline as C
from vehiscope.llm import quality, sentencepieces
from vehiscope.llm.common import table, written

from . import test_op1_line_dedup as one
from . import test_op8_decontamination as eight
from . import test_op10_simhash as ten
from .conftest import SF


def test_stages(spark):
    """Each stage on what its predecessor kept, against a brute-force version."""
    assert [n for n, _ in C.STAGES] == ["quality rules", "line dedup", "simhash near-dedup", "benchmark decontamination",
                                        "sentencepiece encoding"]
    docs = table(spark, SF, "documents")
    own = [f for _, f in C.STAGES]
    verdict = {r.doc_id: r.kept for r in quality.op6_quality(spark, SF).collect()}
    kept = written(own[0](spark, docs, SF), "t")
    assert kept.columns == docs.columns and dict(kept.dtypes) == dict(docs.dtypes)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, k in verdict.items() if k)

    rows = [tuple(r) for r in kept.collect()]
    gone = one.brute(rows)
    lines = written(own[1](spark, kept, SF), "t")
    want = []
    for i, t, lang, source, n in rows:
        new = "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone.get((i, t), ()))
        if (i, t) not in gone or one.line_words(new):
            want.append((i, new, lang, source, len(new)))
    assert sorted(map(tuple, lines.collect())) == sorted(want) and lines.columns == docs.columns

    fps = {r[0]: ten.plain_fingerprint(r[1]) for r in want}
    root = ten.plain_components(set(fps.values()))
    first = {}
    for i in sorted(fps):
        first.setdefault(root[fps[i]], i)
    near = written(own[2](spark, lines, SF), "t")
    assert sorted(r.doc_id for r in near.collect()) == sorted(first.values()) and near.columns == docs.columns

    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    clean = written(own[3](spark, near, SF), "t")
    assert sorted(r.doc_id for r in clean.collect()) == sorted(
        r.doc_id for r in near.collect() if not eight.brute(r.text, items)[1])

    library = sentencepieces.PieceEncoder(sentencepieces.default_model()).library
    texts = {r.doc_id: r.text for r in clean.collect()}
    out = own[4](spark, clean, SF).collect()
    assert {r.doc_id: r.ids for r in out} == {i: library.encode(t) for i, t in texts.items()}
    assert sorted(r.doc_id for r in C.run(spark, SF).collect()) == sorted(texts)
