"""A sample of registered queries against their DuckDB SQL at sf0.001."""
import pytest

from oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
NAMES = ["mis_monthly", "mis_company", "mis_summary", "clean_narrative", "dedup_by_id",
         "vader_score", "kpis", "states_metrics", "mom_change", "rolling_3m", "roc_auc", "tfidf"]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    r = compare(spark, SF, name, con)
    assert r["ok"], r
