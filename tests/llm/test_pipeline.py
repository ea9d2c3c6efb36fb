"""The pipeline against the operators' brute force, stage by stage."""

from array import array

import corpus_pipeline
import pytest
from llm.test_contracts import brute_op2, texts
from llm.test_near_copies import brute

from stratalex.llm import pii
from stratalex.llm.base import cut, table


def test_stages(spark, data):
    docs, seen = table(spark, data, "documents"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, cut(stage(spark, docs, data), name)
        assert docs.columns == before.columns and docs.dtypes == before.dtypes
        seen[name] = (dict(texts(before)), dict(texts(docs)))
    before, after = seen["near_copies"]
    assert set(after) == brute(list(before.items())) and all(before[k] == t for k, t in after.items())
    before, after = seen["benchmark_leaks"]
    items = [tuple(r) for r in table(spark, data, "benchmark").select("item_id", "text").collect()]
    assert set(after) == {x[0] for x in brute_op2(before.items(), items) if not x[2]}
    before, after = seen["personal_data"]
    assert set(after) == set(before) and not any(pii.find(t) for t in after.values()) and any(before[k] != t for k, t in after.items())
    for r in corpus_pipeline.STAGES[-1][1](spark, docs, data).collect():
        assert r["round_trip"] and len(array("I", bytes(r["token_ids"]))) == r["n_tokens"]


def test_odd_rows(spark, odd, data):
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = cut(stage(spark, docs, data), name)
        assert docs.columns == odd.columns
    assert all(r["round_trip"] for r in corpus_pipeline.STAGES[-1][1](spark, docs, data).collect())


@pytest.mark.parametrize("place", range(5))
def test_each_stage_on_empty_and_clashing_tables(spark, odd, clashing, data, place):
    name, stage = corpus_pipeline.STAGES[place]
    assert stage(spark, odd.limit(0), data).count() == 0
    out = stage(spark, clashing, data)
    assert 0 < out.count() <= clashing.count()
    assert place == 4 or (out.columns == clashing.columns and out.dtypes == clashing.dtypes)
