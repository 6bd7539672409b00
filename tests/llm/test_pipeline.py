"""The pipeline's stages on a whole small table, each against what its decisions should be."""

import re

import corpus_pipeline
from tests.conftest import SF_ORACLE
from tidemark.llm import decontaminate, near_dedup, packing, toxicity
from tidemark.llm.common import load, written


def test_stages(spark):
    docs = load(spark, SF_ORACLE, "documents")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF_ORACLE), f"test_{name}")
        assert docs.columns == columns
        kept.append({r.doc_id: r.text for r in docs.collect()})
    given = {r.doc_id: r.text for r in load(spark, SF_ORACLE, "documents").collect()}
    clean, exact, near, cut = kept
    model = toxicity.train(load(spark, SF_ORACLE, "documents"), load(spark, SF_ORACLE, "labels"))
    terms = toxicity.Terms()
    assert set(clean) == {k for k, t in given.items() if model.scores([terms(t)])[0] < 0.5}
    least = {}
    for k, t in sorted(clean.items()):
        least.setdefault(re.sub("[\x20\x09-\x0d]+", " ", t or ""), k)
    assert set(exact) == set(least.values())
    roots = near_dedup.brute_force(list(exact.items()))
    assert set(near) == {k for k, (_, root) in roots.items() if k == root}
    found = decontaminate.brute_force(list(near.items()), [tuple(r) for r in load(spark, SF_ORACLE, "benchmark").collect()])
    for k, (n, hit, *_) in found.items():
        assert (k in cut) == (hit <= 0.5 * n)
        if k in cut:
            assert (cut[k] == near[k]) == (hit == 0)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_ORACLE).collect()
    assert {r.doc_id for r in pieces} == set(cut)
    assert all(len(r.ids) == 4 * r.length for r in pieces)
    tok = packing.WordTokenizer(packing.default_tokenizer())
    total = sum(len(x) // 4 + 1 for x in tok.ids(list(cut.values())))
    assert sum(r.length for r in pieces) == total
