"""Report shapes, the batch runner, and per-system sources against one consolidated store."""

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from duebook.context import Context, Rules
from duebook.plans.income import income_by_concept, income_sales
from duebook.plans.runner import REPORTS, run_reports, write_reports
from duebook.plans.statement import statement_sales
from duebook.sinks.manifest import publish, read_report
from duebook.sources.registry import Entity, Registry, System
from workload.fixture import ENTITIES, RULES, SALE, GivenTables, context, files

INT, BIG, TXT, DBL, DAY = "int", "bigint", "string", "double", "date"

SCHEMAS = {
    "overdue_portfolio": f"client_id {BIG}, development {TXT}, unit {TXT}, client {TXT}, email {TXT}, phone {TXT},"
    f" birth_date {DAY}, total_paid {DBL}, overdue_balance {DBL}, paid_on {DAY}, overdue_day {INT},"
    f" holder_name {TXT}, system {TXT}",
    "statement_flat": f"client_id {BIG}, unit_key {TXT}, brand {TXT}, development {TXT}, unit {TXT}, stage {TXT},"
    f" client {TXT}, email {TXT}, phone {TXT}, reference {TXT}, billed_total {DBL}, receivable_total {DBL},"
    f" overdue_balance {DBL}, days_late {INT}, next_due_on {DAY}, due_day {INT}, collected_total {DBL},"
    f" unapplied_balance {DBL}, last_paid_on {DAY}",
    "income_flat": f"payment_id {BIG}, client_id {BIG}, development {TXT}, unit {TXT}, reference {TXT}, folio {TXT},"
    f" paid_on timestamp_ntz, registered_on {DAY}, client {TXT}, amount {DBL}, bank {TXT}, account {TXT},"
    f" pay_form {TXT}, registered_by {TXT}, status {TXT}, system {TXT}, unapplied_balance {DBL}, detail_id {BIG},"
    f" fee_amount {DBL}, reserve_amount {DBL}, fund_amount {DBL}",
    "income_fund_split": f"payment_id {BIG}, sale_id {INT}, brand {TXT}, development {TXT}, section {TXT}, stage {TXT},"
    f" unit {TXT}, folio {TXT}, client {TXT}, user {TXT}, reference {TXT}, paid_on {DAY}, bank {TXT}, pay_form {TXT},"
    f" amount {DBL}, fee_amount {DBL}, reserve_amount {DBL}, fund_amount {DBL}, future_funds {DBL}",
    "statement_sales": f"sale_id {BIG}, unit_key {TXT}, brand {TXT}, development {TXT}, section {TXT}, stage {TXT},"
    f" unit {TXT}, client {TXT}, coowner {TXT}, seller {TXT}, branch {TXT}, seller_kind {TXT}, team {TXT}, phone {TXT},"
    f" email {TXT}, reference {TXT}, status {TXT}, contract_on {DAY}, signed_on {DAY}, price {DBL}, due_day {INT},"
    f" collected {DBL}, down_payment_paid {DBL}, receivable {DBL}, financed_months {INT}, instalment_amount {DBL},"
    f" required_total {DBL}, days_overdue {INT}, last_paid_on {DAY}, collected_this_month {DBL}, overdue_balance {DBL},"
    f" next_due_number {INT}, next_due_on {DAY}, last_paid_amount {DBL}, promised_on {DAY}",
    "income_sales": f"sale_id {BIG}, unit_key {TXT}, brand {TXT}, development {TXT}, section {TXT}, stage {TXT},"
    f" unit {TXT}, folio {TXT}, client {TXT}, reference {TXT}, status {TXT}, payment_id {BIG}, paid_on {DAY},"
    f" created_on {DAY}, amount {DBL}, surcharge {DBL}, pay_form {TXT}, concept {TXT}, flow_concepts {TXT}, bank {TXT},"
    f" assigned_by {TXT}",
    "income_by_concept": f"sale_id {BIG}, unit_key {TXT}, brand {TXT}, development {TXT}, section {TXT}, stage {TXT},"
    f" unit {TXT}, folio {TXT}, client {TXT}, reference {TXT}, status {TXT}, payment_id {BIG}, paid_on {DAY},"
    f" created_on {DAY}, amount {DBL}, pay_form {TXT}, concept {TXT}, flow_concept {TXT}, bank {TXT}, assigned_by {TXT}",
}

COUNTS = {
    "overdue_portfolio": 13,
    "statement_flat": 19,
    "income_flat": 21,
    "income_fund_split": 19,
    "statement_sales": 35,
    "income_sales": 21,
    "income_by_concept": 20,
}


@pytest.mark.parametrize("name", list(REPORTS))
def test_report_schema_is_pinned(name, spark, small):
    frame = REPORTS[name](context(spark, small))
    assert ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frame.schema) == SCHEMAS[name]
    assert len(frame.columns) == COUNTS[name]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


SOURCES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@pytest.fixture(scope="module")
def per_system(spark, sf, tmp_path_factory):
    """The consolidated tables cut into one folder per system, as five databases of the same shape."""
    store = GivenTables(files(sf))
    orders, lineitem = store.scan(spark, "orders"), store.scan(spark, "lineitem")
    systems = []
    sale = {k: v for k, v in SALE.items() if k != "source"}
    for i, source in enumerate(SOURCES):
        root = str(tmp_path_factory.mktemp(f"system{i}"))
        own = orders.where(F.col("o_orderpriority") == source)
        own.write.parquet(f"{root}/orders.parquet")
        lineitem.join(own, lineitem.l_orderkey == own.o_orderkey, "left_semi").write.parquet(f"{root}/lineitem.parquet")
        for name in ("customer", "supplier", "part", "nation", "region", "events"):
            store.scan(spark, name).write.parquet(f"{root}/{name}.parquet")
        systems.append(System(source, GivenTables(files(root)), {**ENTITIES, "sale": Entity("orders", sale)}))
    return systems


def system_context(spark, sf, systems, rules=RULES):
    lake = context(spark, sf, rules)
    return Context(Registry(spark, systems, lake.registry.dimensions), lake.as_of, rules)


@pytest.mark.parametrize("build", [income_sales, income_by_concept, statement_sales])
def test_per_system_sources_give_the_consolidated_result(build, spark, sf, per_system):
    expected = rows_of(build(context(spark, sf)))
    assert expected
    assert rows_of(build(system_context(spark, sf, per_system))) == expected


def test_coowners_by_configured_key(spark, sf, per_system):
    rules = replace(RULES, coowner_source="coowner", coowner_keys={"2-HIGH": "client_id"})
    frame = statement_sales(context(spark, sf, rules))
    assert frame.columns == statement_sales(context(spark, sf)).columns
    by_sale = {r.sale_id: r.coowner for r in statement_sales(context(spark, sf, replace(rules, coowner_keys={}))).collect()}
    by_key = {r.sale_id: r.coowner for r in frame.collect()}
    assert by_sale.keys() == by_key.keys()
    changed = [s for s in by_key if by_key[s] != by_sale[s]]
    high = {r[0] for r in files(sf).scan(spark, "orders").where("o_orderpriority = '2-HIGH'").select("o_orderkey").collect()}
    assert changed and set(changed) <= high


def test_income_is_sorted_by_creation(spark, sf):
    rows = income_sales(context(spark, sf)).select("created_on", "payment_id").collect()
    assert rows == sorted(rows)


def test_strict_dimensions_give_the_same_rows(spark, sf):
    strict = replace(RULES, fail_on_duplicate_dimension=True)
    assert rows_of(income_sales(context(spark, sf, strict))) == rows_of(income_sales(context(spark, sf)))


def test_one_failing_report_does_not_stop_the_others(spark, small, tmp_path):
    def broken_plan(ctx):
        raise RuntimeError("no plan")

    def broken_run(ctx):
        return ctx.registry.read_dim("brand", "brand").select(F.raise_error(F.lit("boom")).alias("x"))

    def empty(ctx):
        return ctx.registry.read_dim("brand", "brand").where("false")

    ctx = context(spark, small)
    reports = {"a": broken_plan, "b": broken_run, "c": empty, "d": REPORTS["overdue_portfolio"]}
    planned = run_reports(ctx, reports=reports)
    assert list(planned.frames) == ["b", "c", "d"] and planned.failed == {"a": "no plan"}
    result = write_reports(ctx, planned, str(tmp_path), prefix="out")
    assert list(result.failed) == ["a", "b"] and "boom" in result.failed["b"] and "no plan" in result.failed["a"]
    assert {*result.failed, *result.empty, *result.written} == set(reports)
    assert result.empty == ["c"]
    assert result.written == {"d": f"{tmp_path}/out-1998-07-15/d"}
    assert not (tmp_path / "out-1998-07-15" / "c").exists()
    assert spark.read.parquet(result.written["d"]).count() == 150


def scans_of(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return len(re.findall(r"Relation \[l_orderkey", plan))


def test_a_batch_reads_the_payments_of_the_month_once(spark, sf, tmp_path):
    ctx = context(spark, sf)
    income = {name: REPORTS[name] for name in ("income_sales", "income_by_concept")}
    planned = run_reports(ctx, reports=income)
    assert not planned.failed
    for name, frame in planned.frames.items():
        alone = REPORTS[name](ctx)
        assert rows_of(frame) == rows_of(alone)
        # The fixture takes payments and flows from one table: of its scans those of the payments go.
        assert (scans_of(alone), scans_of(frame)) == (4, 1)
    result = write_reports(ctx, planned, str(tmp_path), concurrent=2, write=publish)
    assert not result.failed and set(result.written) == set(income)
    for name in income:
        again = read_report(spark, str(tmp_path), name, ctx.as_of)
        assert again.count() == planned.frames[name].count()


def test_default_rules_filter_nothing_or_raise(spark, small):
    with pytest.raises(ValueError, match="monthly_kind"):
        statement_sales(context(spark, small, Rules(milestone_prefix="eur", active_status="O")))
    with pytest.raises(ValueError, match="milestone_prefix"):
        statement_sales(context(spark, small, Rules(monthly_kind="N", active_status="O")))
    with pytest.raises(ValueError, match="active_status"):
        income_sales(context(spark, small, Rules()))
    every = statement_sales(context(spark, small, Rules(monthly_kind="N", milestone_prefix="eur")))
    assert every.count() == files(small).scan(spark, "orders").count()
