"""Registry, allow-lists, stores."""

import pytest

from duebook.sources.registry import Entity, Registry, System, read_source, tag_source, union_sources
from duebook.sources.stores import CatalogStore, FileStore, JdbcStore, Split
from workload.fixture import files


def sales(where=None):
    return Entity("orders", {"sale_id": "o_orderkey", "price": "o_totalprice"}, where)


def test_only_listed_columns_can_be_read(spark, small):
    system = System("s", files(small), {"sale": sales()})
    assert read_source(spark, system, "sale", ["price"]).columns == ["price"]
    with pytest.raises(ValueError, match="allow-list"):
        read_source(spark, system, "sale", ["sale_id", "o_custkey"])


@pytest.mark.parametrize("name, expression", [("password", "x"), ("p", "user_Password"), ("s", "signature_file")])
def test_credentials_are_never_exposed(name, expression):
    with pytest.raises(ValueError, match="credential"):
        Entity("user", {name: expression})


def test_system_scope_tags_and_keys(spark, small):
    north = System("north", files(small), {"sale": sales("o_orderpriority = '1-URGENT'")})
    south = System("south", files(small), {"sale": sales("o_orderpriority <> '1-URGENT'"), "extra": sales()})
    registry = Registry(spark, [north, south], {})
    assert registry.keys("sale_id") == ["source", "sale_id"]
    df = registry.read("sale", "sale_id")
    assert df.columns == ["source", "sale_id"]
    counts = {r[0]: r[1] for r in df.groupBy("source").count().collect()}
    assert sum(counts.values()) == files(small).scan(spark, "orders").count()
    assert set(counts) == {"north", "south"}
    assert registry.read("extra", "sale_id").select("source").distinct().count() == 1
    with pytest.raises(KeyError):
        registry.read("missing", "sale_id")


def test_global_scope_keeps_narrow_keys(spark, small):
    registry = Registry(spark, [System("lake", files(small), {"sale": sales()})], {}, id_scope="global")
    assert registry.keys("sale_id") == ["sale_id"]
    assert registry.read("sale", "sale_id").columns == ["sale_id"]
    assert registry.read("sale", "source", "sale_id").columns == ["source", "sale_id"]
    with pytest.raises(ValueError):
        Registry(spark, [], {}, id_scope="none")


def test_union_is_by_name(spark):
    a = tag_source(spark.createDataFrame([(1, "x")], "id int, v string"), "a")
    b = tag_source(spark.createDataFrame([("y", 2)], "v string, id int"), "b")
    assert sorted(tuple(r) for r in union_sources([a, b]).collect()) == [(1, "x", "a"), (2, "y", "b")]


def test_jdbc_options_partition_large_tables():
    store = JdbcStore(
        "jdbc:postgresql://host/db",
        "org.postgresql.Driver",
        {"user": "reader"},
        {"payment": Split("payment_id", "1", "1000000", 64)},
    )
    plain = store.options("status")
    assert plain["dbtable"] == "status" and "partitionColumn" not in plain and plain["user"] == "reader"
    split = store.options("payment")
    assert (split["partitionColumn"], split["numPartitions"]) == ("payment_id", "64")
    assert (split["lowerBound"], split["upperBound"]) == ("1", "1000000")


def test_catalog_store_reads_a_table(spark, small):
    spark.sql("create database if not exists catalog_store_test")
    spark.sql("drop table if exists catalog_store_test.nation")
    files(small).scan(spark, "nation").write.saveAsTable("catalog_store_test.nation")
    try:
        read = CatalogStore("catalog_store_test").scan(spark, "nation")
        assert sorted(read.collect()) == sorted(files(small).scan(spark, "nation").collect())
    finally:
        spark.sql("drop database catalog_store_test cascade")


def test_file_store_opens_a_table_once(spark, small):
    store = FileStore(small)
    assert store.scan(spark, "nation") is store.scan(spark, "nation")
    assert store.scan(spark, "nation").schema == files(small).scan(spark, "nation").schema
