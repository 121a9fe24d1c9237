"""Entities written in buckets: same rows, no shuffle by the key, plain files where a key is heavy."""

from collections import Counter
from dataclasses import dataclass, replace
from datetime import datetime

import pytest

from pyspark.sql import functions as F

from duebook.operators.aging import aging
from duebook.operators.grouping import latest_by
from duebook.plans import statement
from duebook.plans.statement import latest_payments
from duebook.sources.bucketed import bucketed
from duebook.sources.registry import Entity, Registry, System
from duebook.sources.stores import FileStore
from duebook.session import SHUFFLE_PARTS, shuffle_partitions
from workload import queries
from workload.fixture import AS_OF, SCHEMAS, systems_context
from workload.queries import QUERIES

INSTALMENT = ("sale_id", "kind", "number", "due_on", "billed", "balance")


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hash")


def figures(registry):
    return aging(registry.read("instalment", *INSTALMENT), AS_OF, registry.keys("sale_id"), "N")


def counted(df):
    return Counter(tuple(r) for r in df.collect())


def test_grouping_and_joins_by_sale_need_no_shuffle(spark, small):
    ctx = systems_context(spark, small)
    plain = ctx.registry
    written = bucketed(plain, {"instalment": "sale_id", "payment": "sale_id"}, 8)
    assert written.systems[-1].store.names.keys() == {"instalment", "payment"}
    assert counted(written.read("instalment", *INSTALMENT)) == counted(plain.read("instalment", *INSTALMENT))
    assert shuffles(figures(plain)) >= 1 and shuffles(figures(written)) == 0
    assert counted(figures(written)) == counted(figures(plain))
    payments = latest_payments(replace(ctx, registry=written))
    assert shuffles(payments) == 0
    # Without a broadcast, as large tables would be joined.
    both = figures(written).hint("merge").join(payments, written.keys("sale_id"), "left")
    assert "SortMergeJoin" in both._jdf.queryExecution().executedPlan().toString() and shuffles(both) == 0
    other = figures(plain).join(latest_payments(ctx), plain.keys("sale_id"), "left")
    assert counted(both) == counted(other)


def test_an_entity_with_a_heavy_key_is_read_as_plain_files(spark, tmp_path):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("sale"), F.col("id").alias("pay")
    )
    rows = rows.union(spark.createDataFrame([(None, 1), (None, 1)], "sale long, pay long"))
    rows.write.parquet(f"{tmp_path}/pays.parquet")
    entity = Entity("pays", {"sale_id": "sale", "payment_id": "pay", "odd name": "pay"})
    empty = Entity("pays", entity.columns, "false")
    store = FileStore(str(tmp_path))
    for scope in ("system", "global"):
        systems = [System("a", store, {"payment": entity, "none": empty}), System("b", store, {"payment": entity})]
        plain = Registry(spark, systems, {}, id_scope=scope)
        written = bucketed(plain, {"payment": "sale_id", "none": "sale_id"}, 4, over=900)
        found = written.systems[-1].store
        assert set(found.files) == {"payment"} and set(found.names) == {"none"}
        for name in ("payment", "none"):
            asked = plain.read(name, "sale_id", "payment_id", "odd name")
            again = written.read(name, "sale_id", "payment_id", "odd name")
            assert again.columns == asked.columns and counted(again) == counted(asked)
        # Map-side combination before a shuffle is left to do, as a bucket would be one task.
        top = latest_by(written.read("payment", "sale_id", "payment_id"), written.keys("sale_id"), "payment_id", ["payment_id"])
        assert shuffles(top) == 1


@pytest.fixture
def uncoalesced(spark):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, before)


@dataclass(frozen=True)
class Joined:
    """Payments that a join must put together first; each row names the part of the join it came from."""

    def scan(self, spark, table):
        pays = spark.range(2000).select((F.col("id") % 500).alias("sale"), F.col("id").alias("pay"))
        return pays.hint("merge").join(spark.range(500).withColumnRenamed("id", "sale"), "sale")


def test_joins_while_writing_shuffle_in_as_many_parts_as_there_are_buckets(spark, uncoalesced):
    entity = Entity("pays", {"sale_id": "sale", "payment_id": "pay", "part": "spark_partition_id()"})
    plain = Registry(spark, [System("a", Joined(), {"payment": entity})], {})
    before = spark.conf.get(SHUFFLE_PARTS)
    written = bucketed(plain, {"payment": "sale_id"}, 40)
    assert spark.conf.get(SHUFFLE_PARTS) == before
    assert written.read("payment", "part").distinct().count() > 30
    columns = ("sale_id", "payment_id")
    assert counted(written.read("payment", *columns)) == counted(plain.read("payment", *columns))
    # A session with more parts than buckets keeps them.
    few = bucketed(plain, {"payment": "sale_id"}, 2)
    assert few.read("payment", "part").distinct().count() == int(before)


def test_buckets_grow_with_the_table(spark, tmp_path, monkeypatch):
    orders = "o_orderkey bigint, o_custkey bigint, o_orderpriority string"
    lines = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    lines += " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    lines += " l_shipdate timestamp_ntz"
    urgent = [(i, 1, "1-URGENT") for i in range(100)]
    spark.createDataFrame(urgent, orders).write.parquet(f"{tmp_path}/orders.parquet")
    rows = [(i % 100, 1, 1, i, 1.0, 2.0, 0.0, 0.0, "N", "O", None) for i in range(600)]
    spark.createDataFrame(rows, lines).write.parquet(f"{tmp_path}/lineitem.parquet")
    for part_rows, expected in ((600, 8), (20, 30)):
        monkeypatch.setattr(queries, "PART_BYTES", queries.LINE_BYTES * part_rows)
        written = queries._bucketed(spark, str(tmp_path), "payment").registry
        name = written.systems[-1].store.names["payment"]
        described = spark.sql(f"describe extended {name}").where("col_name = 'Num Buckets'")
        assert int(described.first()["data_type"]) == expected
        assert written.read("payment", "payment_id").count() == 600
    # As the checked queries have it: half a million rows to a part.
    monkeypatch.undo()
    assert shuffle_partitions(queries.LINE_BYTES * 36_000_000, queries.PART_BYTES) == 69


def _report_tables(spark, root, copies=1):
    """Forty sales with an instalment line each, and as many copies of their one seller under ids of their own."""

    def write(name, rows):
        spark.createDataFrame(rows, SCHEMAS[name]).coalesce(1).write.parquet(f"{root}/{name}.parquet")

    day = datetime(1998, 7, 3)
    write("region", [(0, "F"), (1, "eur"), (2, "P")])
    write("nation", [(0, "NATION_0", 0)])
    write("customer", [(1, "Customer#1", 0, 1.0, "BUILDING")])
    write("supplier", [(i * 50, "Supplier#1", 0, 1.0) for i in range(copies)])
    write("part", [(1, "part", "brand", "type", 0, 1.0)])
    sales = range(0, 2000, 50)  # all of seller 0
    write("orders", [(i, 1, "O", 9.0, day, "1-URGENT" if i % 100 else "5-LOW") for i in sales])
    write("lineitem", [(i, 1, 1, 1, 10.0, 2.0, 0.0, 0.0, "A", "O", day) for i in sales])
    write("events", [(i, day, i, "click", 1.0, "") for i in sales])


@pytest.mark.parametrize("name", ["report_statement_sales_systems", "report_income_sales_systems"])
def test_shuffles_of_the_reports_grow_with_the_table(name, spark, tmp_path, uncoalesced, monkeypatch):
    _report_tables(spark, tmp_path)
    monkeypatch.setattr(queries, "PART_BYTES", queries.LINE_BYTES)  # a part for each line: 40, the session has 8
    sc, before = spark.sparkContext, spark.conf.get(SHUFFLE_PARTS)
    sc.setJobGroup(f"grows-{name}", name)
    report = QUERIES[name](spark, str(tmp_path))
    # What is left to run reads the written report: no dedupe, and no join.
    left = report._jdf.queryExecution().executedPlan().toString()
    sc.setJobGroup("other", "other")
    assert "Aggregate" not in left and "Join" not in left
    status = sc.statusTracker()
    stages = [s for j in status.getJobIdsForGroup(f"grows-{name}") for s in status.getJobInfo(j).stageIds]
    tasks = Counter(found.numTasks for s in stages if (found := status.getStageInfo(s)))
    assert tasks[40] and not tasks[int(before)] and spark.conf.get(SHUFFLE_PARTS) == before
    assert report.count() == 40


def test_copies_of_a_seller_do_not_repeat_the_sales_of_a_statement(spark, tmp_path, monkeypatch):
    _report_tables(spark, tmp_path, copies=30)
    rows = QUERIES["report_statement_sales"](spark, str(tmp_path)).collect()
    assert len(rows) == 40 and {r["branch"] for r in rows} == {"NATION_0"}
    # The rows that reach the dedupe: each sale once, not once for each copy.
    monkeypatch.setattr(statement, "dedupe", lambda df: df)
    assert QUERIES["report_statement_sales"](spark, str(tmp_path)).count() == 40
