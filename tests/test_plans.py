"""What the physical plans must and must not hold."""

import re

import pytest

from duebook.functions.dates import column_in_month
from workload.fixture import AS_OF
from workload.queries import QUERIES


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_python_workers_and_no_cross_joins(name, spark, small):
    text = plan(QUERIES[name](spark, small))
    for operator in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text
    if name == "agg_coowner_chunks":  # its windows number one range of names, and add up one row for each range
        windows = re.findall(r"Arguments: \[(?:row_number|sum)\(.*", text)
        assert len(windows) == 2
        assert all(re.search(r"\], \[owner_key#\d+L?(, __range#\d+)?\], \[", w) for w in windows)
    else:
        assert "Window" not in text


@pytest.mark.parametrize(
    ("name", "column"),
    [
        ("filter_current_month", "o_orderdate"),
        ("report_income_flat", "o_orderdate"),
        ("report_income_fund_split", "o_orderdate"),
        ("report_income_sales", "l_shipdate"),
        ("report_income_by_concept", "l_shipdate"),
    ],
)
def test_month_range_reaches_the_scan(name, column, spark, small):
    text = plan(QUERIES[name](spark, small))
    pushed = [line for line in text.splitlines() if "PushedFilters" in line]
    assert any(f"GreaterThanOrEqual({column}" in p and f"LessThan({column}" in p for p in pushed)


def test_month_range_of_text_dates_reaches_the_scan(spark, tmp_path):
    """Zero dates as text neither fail the filter nor keep a range of the year from the scan."""
    rows = [("1998-07-01",), ("1998-07-31",), ("1998-08-01",), ("0000-00-00",), ("1998-07-99",), (None,)]
    rows += [("1997-07-05",), ("1998",), ("05/07/1998",)]
    spark.createDataFrame(rows, "paid_on string").write.parquet(f"{tmp_path}/t")
    read = spark.read.parquet(f"{tmp_path}/t")
    kept = read.where(column_in_month(read, "paid_on", AS_OF))
    assert sorted(r[0] for r in kept.collect()) == ["1998-07-01", "1998-07-31"]
    pushed = next(line for line in plan(kept).splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(paid_on,1998)" in pushed and "LessThan(paid_on,1999)" in pushed


@pytest.mark.parametrize(
    "name",
    ["aging_one_pass", "join_correlated_top1", "agg_required_total", "agg_any_value", "top1_per_key"],
)
def test_picks_by_a_packed_number_need_no_sort(name, spark, small):
    text = plan(QUERIES[name](spark, small))
    assert "SortAggregate" not in text and "HashAggregate" in text


def test_month_payments_take_part_in_semi_joins_without_their_lookups(spark, small):
    for name in ("report_income_sales", "report_income_by_concept"):
        tree = plan(QUERIES[name](spark, small)).split("\n\n")[0]
        assert tree.count("Scan parquet") <= 17


def test_status_reaches_the_scan(spark, small):
    assert "EqualTo(o_orderstatus,O)" in plan(QUERIES["src_federated"](spark, small))
    assert "In(o_orderstatus, [F,O])" in plan(QUERIES["report_statement_sales"](spark, small))


def test_only_used_columns_are_read(spark, small):
    text = plan(QUERIES["agg_overdue_balance"](spark, small))
    assert "l_comment" not in text
    schema = next(line for line in text.splitlines() if "ReadSchema" in line)
    assert "l_linestatus" in schema and "l_partkey" not in schema and "l_tax" not in schema


def test_aging_is_one_shuffle(spark, small):
    text = plan(QUERIES["aging_one_pass"](spark, small))
    assert text.split("\n\n")[0].count("Exchange") == 1


def test_dimensions_are_broadcast_by_size(spark, small):
    assert plan(QUERIES["join_lookup_chain"](spark, small)).split("\n\n")[0].count("BroadcastHashJoin") == 3


def test_no_broadcast_beyond_the_size_limit(spark, small):
    """With the limit down, every join falls back to a shuffle and the result stays the same."""
    expected = sorted(QUERIES["join_lookup_chain"](spark, small).collect())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        frame = QUERIES["join_lookup_chain"](spark, small)
        assert "BroadcastExchange" not in plan(frame)
        assert sorted(frame.collect()) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_dead_seller_dimension_is_not_read(spark, small):
    """The seller lookup feeds a filter only, so no seller attribute is carried."""
    assert "s_acctbal" not in plan(QUERIES["report_income_sales"](spark, small))
