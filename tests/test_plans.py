"""Plan-shape guards: what the optimizer produces for the registered queries."""

import pytest

import __spark_entry__ as entry
import tilealg as ta
from tilealg.plans import catalogue
from tilealg.plans.explain import forbidden, operators, plan_text

from .conftest import SMALL


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_no_cartesian_or_row_udf(spark, name):
    df = entry.queries()[name](spark, SMALL)
    assert forbidden(df) == [], plan_text(df)


def test_elementwise_join_reuses_aggregate_partitioning(spark):
    df = entry.queries()["ew_add"](spark, SMALL)
    ops = operators(df)
    # one exchange per aggregated operand; the full outer join adds none
    assert ops["SortMergeJoin"] == 1
    assert ops["Exchange"] == 2, plan_text(df)


def test_self_product_reads_source_once(spark):
    df = entry.queries()["matmul_a_at"](spark, SMALL)
    df.collect()
    text = plan_text(df)
    assert "isFinalPlan=true" in text
    assert "ReusedExchange" in text, text


def test_small_vector_is_broadcast(spark):
    df = entry.queries()["matvec_a_w"](spark, SMALL)
    ops = operators(df)
    assert ops["BroadcastHashJoin"] >= 1 and ops["BroadcastExchange"] >= 1


def test_scan_pruning_and_pushdown(spark):
    df = entry.queries()["get_tile_s"](spark, SMALL)
    text = plan_text(df)
    assert "PushedFilters: [IsNotNull(s_nationkey), GreaterThanOrEqual(s_nationkey,10)" in text
    # lineitem is read for three of its columns only
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_quantity:double>" in text


def test_tiles_product_is_one_shuffle(spark):
    """Tiles of both sides go to the groups of C tiles in one exchange; no partial C tiles."""
    a = ta.uniform(spark, 40, 30, seed=1, tile=(10, 10), layout="tiles")
    b = ta.uniform(spark, 30, 20, seed=2, tile=(10, 10), layout="tiles")
    ops = operators((a @ b).df)
    assert ops["Exchange"] == 1 and ops["MapInArrow"] >= 1
    assert ops["CartesianProduct"] == 0 and ops["FlatMapGroupsInArrow"] == 0
