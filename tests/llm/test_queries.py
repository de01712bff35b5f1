"""The registered queries, with SQL twins where there are any, and the pipeline."""

import os

import pytest

from tests import oracle
from veristar.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    want = oracle.connect(SF_DIR).sql(ORACLES[name])
    assert oracle.type_difference(df, want) is None
    assert oracle.difference(df.toPandas(), want.df()) is None


def test_names():
    assert {n.split("_")[0] for n in QUERIES} == {"pipeline", *(f"op{i}" for i in range(1, 14))}


def test_pipeline_stages(spark):
    import corpus_pipeline as p
    from veristar.llm import toxicity
    from veristar.llm.common import table, written
    from tests.llm.test_operators import _brute_components

    docs = table(spark, SF_DIR, "documents")
    columns = docs.columns
    for (name, stage), check in zip(p.STAGES, ["toxic", "near", "secret", "mix", "bpe"]):
        before = {r.doc_id: r for r in docs.collect()}
        docs = written(stage(spark, docs, SF_DIR), f"test-{name}")
        after = docs.collect()
        if check != "bpe":
            assert docs.columns == columns
        if check == "toxic":
            assert {r.doc_id for r in after} <= set(before) and len(after) > 0.8 * len(before)
        if check == "near":
            want = _brute_components({i: r.text for i, r in before.items()}, width=5)
            assert sorted(r.doc_id for r in after) == sorted(set(want.values()))
        if check == "secret":
            assert sorted(r.doc_id for r in after) == sorted(before)
        if check == "mix":
            assert {r.doc_id for r in after} <= set(before)
            assert all(set((r.text or "").split()) <= set((before[r.doc_id].text or "").split()) for r in after)
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    assert toxicity.THRESHOLD == 0.7
