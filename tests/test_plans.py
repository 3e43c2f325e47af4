"""Plan shape: what must and must not be in the physical plans."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strata.operators import merge as M
from strata.operators.joins import Lookup, star_lookup
from strata.operators.projections import last_months
from strata.operators.windows import latest_per_key, top_k_ranked
from strata.queries import QUERIES
from strata.session import broadcast_if_small, plan_bytes, size_shuffles
from strata.sources import tables

STREAMED = [n for n in QUERIES if n.startswith(("stream_", "grid_", "sink_", "source_", "snapshot_", "change_", "sync_"))]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in STREAMED])
def test_no_cross_join_and_no_row_udf(spark, data, name):
    text = plan(QUERIES[name].run(spark, data))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text


def test_latest_row_limits_groups_before_the_shuffle(spark, data):
    (events,) = tables(spark, data, "events")
    text = plan(latest_per_key(events, ["user_id"], [F.desc("ts")]))
    exchange = text.index("Exchange hashpartitioning")
    assert text.index("Partial", exchange) > exchange  # below the exchange, as plans print top-down
    assert text.count("WindowGroupLimit") == 2


def test_global_rank_gathers_no_more_than_k_rows(spark, data):
    (customer,) = tables(spark, data, "customer")
    text = plan(top_k_ranked(customer, [("c_acctbal", "desc")], 5))
    assert "TakeOrderedAndProject" in text
    assert "BroadcastHashJoin" in text


def test_filter_and_columns_reach_the_scan(spark, data):
    (orders,) = tables(spark, data, "orders")
    text = plan(last_months(orders, "o_orderdate", "2000-01-01").select("o_orderkey", "o_orderdate"))
    assert "GreaterThanOrEqual(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_small_source_does_not_shuffle_the_target(spark, data):
    lineitem, part = tables(spark, data, "lineitem", "part")
    target = lineitem.select(F.col("l_partkey").alias("p_partkey"), F.col("l_comment" if "l_comment" in lineitem.columns else "l_returnflag").alias("p_name"))
    source = part.select("p_partkey", "p_name")
    text = plan(M.merge(target, source, ["p_partkey"], check_unique=False, insert=False))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_no_full_outer_join_in_merges(spark, data):
    (customer,) = tables(spark, data, "customer")
    text = plan(M.merge_upsert(customer, customer, ["c_custkey"], check_unique=False, max_bytes=0))
    assert "FullOuter" not in text
    assert "LeftOuter" in text and "LeftAnti" in text


def test_large_dimension_is_not_broadcast_by_hint(spark, data):
    lineitem, orders = tables(spark, data, "lineitem", "orders")
    lookup = [Lookup(orders, {"l_orderkey": "o_orderkey"}, {"o_custkey": "custkey"})]
    hinted = star_lookup(lineitem, lookup)._jdf.queryExecution().optimizedPlan().toString()
    unhinted = star_lookup(lineitem, lookup, max_bytes=1)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in hinted
    assert "strategy=broadcast" not in unhinted


def test_size_check_follows_the_plan(spark, data):
    (lineitem,) = tables(spark, data, "lineitem")
    assert plan_bytes(lineitem.select("l_orderkey")) < plan_bytes(lineitem)
    assert "ResolvedHint" not in broadcast_if_small(lineitem, 10)._jdf.queryExecution().analyzed().toString()


def test_shuffle_partitions_follow_the_input(spark, data):
    (lineitem,) = tables(spark, data, "lineitem")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_shuffles(spark, lineitem) == spark.sparkContext.defaultParallelism
        few = size_shuffles(spark, lineitem, target_bytes=plan_bytes(lineitem) // 50)
        assert 50 <= few <= 52 and spark.conf.get("spark.sql.shuffle.partitions") == str(few)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_metric_view_reads_only_what_it_needs(spark, data):
    text = plan(QUERIES["metric_view_total"].run(spark, data))
    assert "l_shipdate" not in text and "p_name" not in text


def test_group_limit_for_large_n(spark, data):
    from pyspark.sql import functions as F

    from strata.operators.windows import top_n_per_group

    rows = top_n_per_group(spark.read.parquet(f"{data}/lineitem.parquet"), ["l_returnflag"], [F.desc("l_orderkey"), F.asc("l_linenumber")], 5000)
    assert "WindowGroupLimit" in rows._jdf.queryExecution().executedPlan().toString()
