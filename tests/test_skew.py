"""A third of all rows under one key: the results stay right and AQE splits the hot partition."""

import duckdb
import pytest
from compare import TABLES, connect, duck_rows, spark_rows
from pyspark.sql import functions as F

from duebook.operators import grouping, joins
from workload.oracle import ORACLE
from workload.queries import QUERIES

HOT = {
    "orders": "select * replace (case when o_orderkey % 3 = 0 then 5 else o_custkey end as o_custkey) from {0}",
    "lineitem": "select * replace (case when l_partkey % 3 = 0 then 7 else l_orderkey end as l_orderkey) from {0}",
    "events": "select * replace (case when event_id % 3 = 0 then 7 else user_id end as user_id) from {0}",
}


@pytest.fixture(scope="module")
def skewed(small, tmp_path_factory):
    root = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for name in TABLES:
        source = f"'{small}/{name}.parquet'"
        sql = HOT.get(name, "select * from {0}").format(source)
        con.execute(f"copy ({sql}) to '{root}/{name}.parquet' (format parquet)")
    return str(root)


@pytest.mark.parametrize(
    "name",
    [
        "aging_one_pass",
        "agg_any_value",
        "agg_payment_rollup",
        "agg_concept_rollup",
        "agg_coowner_list",
        "agg_coowner_chunks",
        "agg_distinct_ordered_list",
        "join_composite_key",
        "join_latest_row",
        "join_lookup_chain",
        "join_one_to_many_detail",
        "report_income_fund_split",
        "report_statement_sales",
        "report_income_sales",
        "report_income_by_concept",
        "window_max_distinct",
    ],
)
def test_results_on_skewed_tables(name, spark, skewed):
    assert spark_rows(QUERIES[name](spark, skewed)) == duck_rows(connect(skewed), ORACLE[name])


def test_a_million_names_of_one_key(spark):
    """One key has a million names of 1.2 million rows: chunks hold them all, no task a large part of them."""
    rows = spark.range(0, 1_200_000, 1, 8).select(
        F.when(F.col("id") % 6 == 5, F.col("id")).otherwise(-1).alias("k"),
        F.concat(F.lit("p"), F.format_string("%07d", F.col("id"))).alias("f"),
    )
    chunks = grouping.name_chunks(rows, ["k"], ["f"], size=5_000)
    hot = chunks.where("k = -1")
    assert chunks.count() == 200_000 + 200
    found = hot.select("chunk", F.size("names").alias("n"), F.col("names")[0].alias("low"), F.element_at("names", -1).alias("high"))
    found = found.orderBy("chunk").collect()
    assert [r.chunk for r in found] == list(range(200)) and {r.n for r in found} == {5_000}
    assert all(a.high < b.low for a, b in zip(found, found[1:], strict=False))
    with pytest.raises(Exception, match="more than 1000000 characters"):
        grouping.list_names(rows, ["k"], ["f"], "names").where("k = -1").collect()


@pytest.fixture
def eager_splitting(spark):
    """Thresholds low enough for AQE to act on test-sized data, and no broadcast."""
    options = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in options}
    for k, v in options.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot_rows(spark, n=60000):
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 997)
    return spark.range(0, n, 1, 8).select(key.alias("k"), "id", F.sha2(F.col("id").cast("string"), 256).alias("v"))


def small_side(spark):
    return spark.range(0, 1200, 1, 4).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))


def test_hot_fact_key_is_split_in_a_lookup(spark, eager_splitting):
    joined = joins.lookup(hot_rows(spark), joins.Lookup(small_side(spark), {"k": "k"}, {"name": "name"}))
    assert "SortMergeJoin(skew=true)" in final_plan(joined)
    assert joined.count() == 60000


def test_hot_key_is_split_even_below_a_grouping_by_the_same_key(spark, eager_splitting):
    joined = joins.lookup(hot_rows(spark), joins.Lookup(small_side(spark), {"k": "k"}, {"name": "name"}))
    grouped = joined.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("name").alias("name"))
    assert "SortMergeJoin(skew=true)" in final_plan(grouped)
    assert grouped.where("k = 7").first()["n"] > 20000


def test_hot_detail_key_is_dealt_in_left_join_many(spark, eager_splitting):
    """Heavy keys on the right, on the left, on both sides and on none; NULL keys; rows without a match."""
    names = small_side(spark).unionByName(spark.createDataFrame([(None, "none"), (5000, "alone")], "k long, name string"))
    hot_names = names.unionByName(spark.range(400).select(F.lit(7).cast("long").alias("k"), F.lit("again").alias("name")))
    few = hot_rows(spark, 900).unionByName(spark.createDataFrame([(None, 1, "x")], "k long, id long, v string"))
    for left, right in ((names, hot_rows(spark)), (hot_names, few), (hot_rows(spark, 3000), names), (few, hot_names)):
        joined = joins.left_join_many(left, right, ["k"], over=100, task_bytes=0)
        plain = left.join(right, ["k"], "left")
        assert joined.columns == plain.columns
        assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()


def test_heavy_keys_fill_several_partitions(spark, eager_splitting):
    joined = joins.left_join_many(small_side(spark), hot_rows(spark), ["k"], over=2000, task_bytes=0)
    assert joins.heavy_keys(hot_rows(spark), ["k"], 2000).collect() == [(7, 11)]
    sizes = joined.where("k = 7").groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= 4 and max(r["count"] for r in sizes) < 12_000


def test_small_detail_is_joined_plainly_and_each_side_read_once(spark, small):
    for name, most in (("join_composite_key", 2), ("join_one_to_many_detail", 2), ("report_income_fund_split", 6)):
        plan = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("lineitem.parquet") <= 2 and plan.count("orders.parquet") <= 2, name
        assert plan.count("Union") == 0, name


def test_estimates_come_without_a_job(spark, small):
    lines = spark.read.parquet(f"{small}/lineitem.parquet")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("estimates", "no job")
    size = joins.estimated_bytes(lines)
    assert 1_000 < size < 10_000_000 and not tracker.getJobIdsForGroup("estimates")
    assert joins.estimated_bytes(lines.crossJoin(lines).crossJoin(lines)) > size
    spark.sparkContext.setJobGroup("rest", "")


def test_broadcast_needs_a_checked_size(spark):
    side = small_side(spark)
    small = joins.broadcast_if_small(side, 1 << 20)
    assert "broadcast" in small._jdf.queryExecution().analyzed().toString().lower()
    assert joins.broadcast_if_small(side, 1 << 10) is side
    assert joins.broadcast_if_small(side, 0) is side
    wide = spark.range(10).select(F.repeat(F.lit("x"), 10000).alias("t"))
    assert joins.broadcast_if_small(wide, 50000) is wide
    assert joins.broadcast_if_small(wide.where("false"), 50000) is not wide
