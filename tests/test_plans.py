"""Physical plans: no Python per row, no all-pairs joins, pruned and filtered scans."""

import os

import pytest

from adjudica import plans
from adjudica.operators import claims as C
from adjudica.operators import providers as P
from adjudica.sources import claims_model as M

DATA = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables not present")
BATCH = sorted(
    name for name, fn in plans.all_queries().items()
    if fn.__module__.rsplit(".", 1)[-1] not in ("models", "streams")
)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_pair_joins(name, spark):
    plan = plan_of(plans.all_queries()[name](spark, DATA))
    for word in ("EvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan, word


def test_scan_reads_only_the_needed_columns(spark):
    plan = plan_of(P.provider_fwa_features(M.claim_line(spark, DATA)))
    read = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "l_tax" not in read and "l_quantity" not in read and "l_extendedprice" in read


def test_filters_reach_the_scan(spark):
    plan = plan_of(M.claim_header(spark, DATA).filter("payer_share_amount > 400000").select(C.CLAIM))
    assert "GreaterThan(o_totalprice,400000.0)" in plan


def test_top_k_takes_without_a_full_sort(spark):
    features = P.provider_value_features(M.claim_line(spark, DATA))
    assert "TakeOrderedAndProject" in plan_of(P.top_k(features, "avg_cost_per_claim", C.PROVIDER, 5))


def test_rank_limit_comes_before_the_shuffle(spark):
    plan = plan_of(C.diag_proc_top(M.claim_item(spark, DATA), 5))
    assert plan.count("WindowGroupLimit") == 2
