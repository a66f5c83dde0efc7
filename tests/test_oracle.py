"""Every registered query with an oracle equals its DuckDB SQL (sf0.01)."""

import pytest

import __spark_entry__ as E
from helpers import assert_same

from conftest import SF_MID

ORACLE = {k: v for k, v in E.oracle_sql().items() if k not in E.LLM_QUERIES}
QUERIES = {k: v for k, v in E.queries().items() if k not in E.LLM_QUERIES}
SLOW = {"gbt_train_score", "importance_topk"}


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, key):
    got = QUERIES[key](spark, SF_MID).toPandas()
    want = duck.execute(ORACLE[key]).df()
    assert_same(got, want)


def test_every_query_has_oracle_or_is_rows_only():
    assert set(QUERIES) - set(ORACLE) == SLOW


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "exp_mean" in df.columns
