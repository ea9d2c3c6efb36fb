"""Plans of the operators: no Python where DataFrame functions alone are asked for, no cross joins anywhere."""

import re

import pytest

from stratalex.llm import queries


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["op2_decontaminate", "op6_licences", "op7_rules", "op10_shards"])
def test_native_operators_run_no_python(spark, data, name):
    assert not re.search("Python|Pandas|Arrow", plan(queries.QUERIES[name](spark, data)))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_no_cross_joins_and_few_columns(spark, data, name):
    text = plan(queries.QUERIES[name](spark, data))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "n_chars" not in text or name == "op10_shards"  # unused columns stay in the files
