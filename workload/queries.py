"""Every operator as a query over whole tables: ``QUERIES[name](spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duebook.functions import dates, keys, money, predicates, text
from duebook.operators import aging, grouping, joins, payments, profile, select, typing_rules
from duebook.plans import flat, fund_split, income, statement
from duebook.plans.runner import REPORTS, Planned, run_reports, write_reports
from duebook.session import SHUFFLE_PARTS, shuffle_partitions
from duebook.sinks.display import render
from duebook.sinks import manifest
from duebook.sinks.metrics import metrics_table
from duebook.sinks.writer import shared_folder, write_report
from duebook.sources.bucketed import bucketed
from duebook.sources.registry import Entity, System, read_source, read_table, tag_source, union_sources
from workload.fixture import AS_OF, PRICE, RULES, SHARE, context, files, system, systems_context, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(builder: Query) -> Query:
        QUERIES[name] = builder
        return builder

    return register


col, lit, expr = F.col, F.lit, F.expr


def dec(name: str) -> F.Column:
    return col(name).cast("decimal(18,2)")


# ------------------------------------------------------------------ sources and output


@query("src_table_scan")
def _(spark, sf):
    context(spark, sf)
    return read_table(spark, files(sf), "customer", ["c_custkey", "c_name", "c_acctbal"])


@query("src_federated")
def _(spark, sf):
    context(spark, sf)
    return read_source(
        spark, system(sf), "sale", ["sale_id", "client_id", "status_id", "price"], where="status_id = 'O'"
    )


@query("src_dimension")
def _(spark, sf):
    return context(spark, sf).registry.read_dim("brand", "raw_name", "brand", "development", "section")


@query("run_all_reports")
def _(spark, sf):
    """Row and column count of every report of one batch run."""
    planned = run_reports(context(spark, sf))
    if planned.failed:
        raise RuntimeError(f"not planned: {planned.failed}")
    return union_sources([profile.report_shape(frame, name) for name, frame in planned.frames.items()])


@query("report_shape")
def _(spark, sf):
    return profile.report_shape(table(spark, sf, "orders"), "orders")


@query("sink_dated_folder")
def _(spark, sf):
    """The orders as they come back from the dated folder they were written to."""
    orders = table(spark, sf, "orders")
    path = write_report(orders, shared_folder(spark), "orders", AS_OF)
    return spark.read.schema(orders.schema).parquet(path)


@query("sink_skip_empty")
def _(spark, sf):
    """What a batch leaves behind: the open orders are written, a report without rows is not, and a
    later run without rows leaves the earlier report in place."""
    orders, root = table(spark, sf, "orders"), shared_folder(spark)
    nothing = orders.where("o_orderstatus = 'X'")
    frames = {"open": orders.where("o_orderstatus = 'O'"), "unknown": nothing}
    paths = {name: write_report(frame, root, name, AS_OF) for name, frame in frames.items()}
    write_report(nothing, root, "open", AS_OF)
    return union_sources(
        [profile.report_shape(spark.read.parquet(path), name) for name, path in paths.items() if path]
    )


@query("sink_manifest")
def _(spark, sf):
    """What a reader finds by the manifest: the newest run with rows, and the first by its version."""
    orders, root = table(spark, sf, "orders"), shared_folder(spark)
    for frame in (orders.where("o_orderstatus = 'O'"), orders, orders.where("o_orderstatus = 'X'")):
        manifest.publish(frame, root, "orders", AS_OF)
    return union_sources(
        [
            profile.report_shape(manifest.read_report(spark, root, "orders", AS_OF, version=version), name)
            for name, version in (("newest", None), ("first", 1))
        ]
    )


@query("sink_observed_metrics")
def _(spark, sf):
    """What the write of the orders saw: widths, and the prices that an integer column cannot keep."""
    batch = Planned({"orders": table(spark, sf, "orders")})
    words = {"money": [], "integer": ["price"], "text": ["riority"]}
    done = write_reports(context(spark, sf), batch, shared_folder(spark), keywords=words, display=True)
    return metrics_table(spark, done.metrics)


@query("sink_display_text")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        col("l_shipdate").alias("ship_date"),
        (col("l_extendedprice") - lit(20000.0)).alias("net_amount"),
        col("l_partkey").alias("part_number"),
        "l_returnflag",
    )
    words = {"date": ["_date"], "money": ["amount"], "integer": ["number"], "text": ["flag"]}
    return render(typing_rules.normalise(rows, words), {"l_orderkey": "integer"})


@query("sink_typed_report")
def _(spark, sf):
    """What the sink writes: a report after the typing stage."""
    frame = flat.income_flat(context(spark, sf))
    return typing_rules.normalise(frame, overrides={"account": "text"})


# ------------------------------------------------------------------ projections


@query("proj_rename")
def _(spark, sf):
    return select.select_as(
        table(spark, sf, "orders"), {"sale_id": "o_orderkey", "client_id": "o_custkey", "status": "o_orderstatus"}
    )


@query("proj_cast_double")
def _(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", dec("o_totalprice").alias("price"))
    return select.doubles(rows, ["price"])


@query("proj_source_tag")
def _(spark, sf):
    return tag_source(table(spark, sf, "orders").select("o_orderkey"), "north")


def _parts(spark, sf):
    """Parts with the nation of the same number as their size, where there is one."""
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_size", "p_brand", "p_retailprice")
    nation = table(spark, sf, "nation")
    return joins.lookup(part, joins.Lookup(nation, {"p_size": "n_nationkey"}, {"n_name": "n_name"}))


@query("unit_key")
def _(spark, sf):
    return _parts(spark, sf).select("p_partkey", keys.unit_key(col("n_name"), col("p_name")).alias("unit_key"))


@query("unit_key_staged")
def _(spark, sf):
    return _parts(spark, sf).select(
        "p_partkey",
        keys.unit_key_staged(
            F.coalesce(col("n_name"), lit("NONE")),
            col("p_name"),
            col("p_type"),
            ["NATION_3", "NATION_8"],
            col("n_name"),
        ).alias("unit_key"),
    )


@query("prefix_reference")
def _(spark, sf):
    reference = F.nullif(col("c_mktsegment"), lit("BUILDING"))
    return table(spark, sf, "customer").select("c_custkey", keys.prefix_ref(reference, "REF_").alias("reference"))


@query("financed_months")
def _(spark, sf):
    counted = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count(lit(1)).alias("instalments"))
    return counted.select("l_orderkey", keys.financed_months(col("instalments")).alias("financed_months"))


@query("down_payment_capped")
def _(spark, sf):
    collected = expr("case when o_orderpriority <> '5-LOW' then cast(o_totalprice as decimal(18,2)) end")
    down = expr("case when o_orderstatus <> 'P' then cast(200000 as decimal(18,2)) end")
    return table(spark, sf, "orders").select(
        "o_orderkey", money.cap(down, collected).cast("double").alias("down_payment")
    )


@query("promise_if_overdue")
def _(spark, sf):
    overdue = (
        table(spark, sf, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.min(F.when(col("l_shipdate") < lit(AS_OF), col("l_shipdate").cast("date"))).alias("first_overdue"),
            F.max(col("l_shipdate").cast("date")).alias("promised"),
        )
    )
    return overdue.select(
        "l_orderkey", keys.only_if_known(col("first_overdue"), col("promised")).alias("promised_on")
    )


@query("case_label_by_group")
def _(spark, sf):
    labels = {"ECONOMY": "share", "SMALL": "unit", "LARGE": "office"}
    return table(spark, sf, "part").select(
        "p_partkey", keys.label_map(col("p_type"), labels).alias("model")
    )


def _size():
    return money.pick_measure(
        col("p_type"), {"ECONOMY": col("p_size"), "SMALL": col("p_size") - 20, "LARGE": col("p_size") * 2}
    )


@query("case_measure_by_group")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", _size().alias("size"))


@query("unit_price_safe_div")
def _(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        money.safe_unit_price(col("l_extendedprice"), F.nullif(col("l_quantity") - 10, lit(40.0))).alias("unit_price"),
    )


def _funds(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", dec("o_totalprice").alias("amount"))
    detail = table(spark, sf, "lineitem").select(
        col("l_orderkey").alias("o_orderkey"),
        expr(f"nullif({PRICE} * {SHARE.format('l_discount')}, 0)").alias("fee"),
        expr(f"nullif({PRICE} * {SHARE.format('l_tax')}, 0)").alias("reserve"),
        expr(f"case when l_returnflag = 'A' then {PRICE} end").alias("fund"),
    )
    return joins.left_join_many(orders, detail, ["o_orderkey"])


@query("fund_split")
def _(spark, sf):
    fee, reserve, fund = money.fund_split(col("fee"), col("reserve"), col("fund"))
    return _funds(spark, sf).select(
        "o_orderkey", fee.alias("fee_amount"), reserve.alias("reserve_amount"), fund.alias("fund_amount")
    )


@query("future_funds")
def _(spark, sf):
    future = money.future_funds(col("amount"), col("fee"), col("reserve"), col("fund"))
    return _funds(spark, sf).select("o_orderkey", future.alias("future_funds"))


@query("latest_in_month_amount")
def _(spark, sf):
    latest = grouping.latest_by(
        table(spark, sf, "orders").select(
            "o_custkey", "o_orderkey", col("o_orderdate").cast("date").alias("day"), dec("o_totalprice").alias("amount")
        ),
        ["o_custkey"],
        "o_orderkey",
        ["day", "amount"],
    )
    in_month = latest.withColumn("month_amount", money.amount_if_month(col("amount"), col("day"), AS_OF))
    customers = table(spark, sf, "customer").select("c_custkey")
    step = joins.Lookup(in_month, {"c_custkey": "o_custkey"}, {"month_amount": "month_amount"})
    return select.doubles(joins.lookup(customers, step), ["month_amount"])


# ------------------------------------------------------------------ filters


@query("filter_current_month")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return orders.where(dates.in_month(col("o_orderdate"), AS_OF))


@query("filter_current_month_text")
def _(spark, sf):
    """Dates kept as text: the zero date, padded text, months and days of one digit, a time behind."""
    text = F.expr(
        "case o_orderkey % 5 when 0 then '0000-00-00' when 1 then date_format(o_orderdate, 'yyyy-M-d')"
        " when 2 then date_format(o_orderdate, '  yyyy-MM-dd ') when 3 then date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')"
        " else date_format(o_orderdate, 'yyyy-MM-dd') end"
    )
    orders = table(spark, sf, "orders").select("o_orderkey", text.alias("day"), "o_totalprice")
    return orders.where(dates.column_in_month(orders, "day", AS_OF))


@query("agg_milestone_date_text")
def _(spark, sf):
    """Milestones of dates kept as text, some of them the zero date."""
    day = F.expr("case when event_id % 5 = 0 then '0000-00-00' else date_format(ts, 'yyyy-MM-dd') end")
    events = table(spark, sf, "events").select("user_id", "event_type", day.alias("day"))
    return grouping.milestone(events, ["user_id"], "event_type", "day", "Sign", "reached_on")


@query("filter_status_eq")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderstatus").where(col("o_orderstatus") == "O")


@query("filter_in_list")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderstatus").where(col("o_orderstatus").isin("F", "P"))


@query("filter_not_like_any")
def _(spark, sf):
    name = F.nullif(col("p_name"), lit("blue bolt"))
    rows = table(spark, sf, "part").select("p_partkey", name.alias("name"))
    return rows.where(predicates.exclude_contains(col("name"), ["widget", "anvil", "old"]))


@query("filter_not_in")
def _(spark, sf):
    name = F.nullif(col("n_name"), lit("NATION_1"))
    rows = table(spark, sf, "nation").select("n_nationkey", name.alias("name"))
    return rows.where(predicates.exclude_values(col("name"), ["NATION_2", "NATION_3"]))


@query("filter_not_and")
def _(spark, sf):
    status = F.nullif(col("o_orderstatus"), lit("P"))
    rows = table(spark, sf, "orders").select("o_orderkey", status.alias("status"), "o_orderpriority")
    return rows.where(predicates.exclude_pair(col("status"), "O", col("o_orderpriority"), "5-LOW"))


@query("filter_not_null")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    lines = table(spark, sf, "lineitem").select(col("l_orderkey").alias("o_orderkey"), "l_returnflag")
    joined = orders.join(lines, "o_orderkey", "left")
    return joined.where(col("l_returnflag").isNotNull())


@query("filter_neq")
def _(spark, sf):
    name = F.nullif(col("n_name"), lit("NATION_1"))
    rows = table(spark, sf, "nation").select("n_nationkey", name.alias("name"))
    return rows.where(col("name") != "NATION_4")


@query("filter_prefix_like")
def _(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", F.upper("p_name").alias("name"))
    return rows.where(predicates.starts_ci(col("name"), "Small"))


@query("filter_before_fold")
def _(spark, sf):
    """The fragment is tested on the text as it is; folding comes after."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    kept = docs.where(predicates.exclude_contains(col("text"), ["informacion", "si "]))
    return kept.select("doc_id", text.fold_accents(col("text")).alias("folded"))


# ------------------------------------------------------------------ joins


@query("join_lookup_chain")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    customer, nation, region = (table(spark, sf, t) for t in ("customer", "nation", "region"))
    return joins.lookup_chain(
        orders,
        [
            joins.Lookup(customer, {"o_custkey": "c_custkey"}, {"client": "c_name", "nation_id": "c_nationkey"}),
            joins.Lookup(nation, {"nation_id": "n_nationkey"}, {"nation": "n_name", "region_id": "n_regionkey"}),
            joins.Lookup(region, {"region_id": "r_regionkey"}, {"region": "r_name"}),
        ],
    )


@query("join_composite_key")
def _(spark, sf):
    """Payments (one row per order and line) with the flows of both keys; those without any are kept."""
    lines = table(spark, sf, "lineitem")
    paid = lines.groupBy("l_orderkey", "l_linenumber").agg(F.sum(dec("l_extendedprice")).cast("double").alias("amount"))
    # Flows of other kinds belong to no payment: their key is shifted out of range, no row is cut.
    order = F.when(col("l_returnflag") == "R", col("l_orderkey")).otherwise(-1 - col("l_orderkey"))
    flows = lines.select(order.alias("l_orderkey"), "l_linenumber", col("l_partkey").alias("flow_part"))
    return joins.left_join_many(paid, flows, ["l_orderkey", "l_linenumber"])


@query("join_latest_row")
def _(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", "o_orderstatus", col("o_orderdate").alias("paid_at"), dec("o_totalprice").alias("amount")
    )
    latest = grouping.latest_by(
        orders, ["o_custkey"], "o_orderkey", ["paid_at", "amount"], where=col("o_orderstatus") == "O"
    )
    return select.doubles(latest, ["amount"])


@query("join_left_where_right")
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    part = table(spark, sf, "part")
    step = joins.Lookup(part, {"l_partkey": "p_partkey"}, {"kind": "p_type"})
    return joins.lookup(lines, step).where(col("kind") == "PROMO")


@query("join_dimension_text")
def _(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    raw = F.when(col("c_nationkey") < 20, F.concat(lit("NATION_"), col("c_nationkey"))).otherwise("UNKNOWN")
    dim = context(spark, sf).registry.read_dim("brand", "raw_name", "brand", "development")
    return joins.conform(
        customer.select("c_custkey", raw.alias("raw_name")),
        dim,
        ("raw_name", "raw_name"),
        {"brand": "brand", "development": "development"},
        fail_on_dup=True,
    )


@query("join_preaggregated")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    totals = (
        table(spark, sf, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.sum(dec("l_extendedprice")).cast("double").alias("total"), F.max("l_linenumber").alias("last_number"))
    )
    step = joins.Lookup(totals, {"o_orderkey": "l_orderkey"}, {"total": "total", "last_number": "last_number"})
    return joins.lookup(orders, step)


def _instalments(spark, sf):
    return context(spark, sf).registry.read("instalment", "sale_id", "kind", "number", "due_on", "billed", "balance")


def _per_sale(spark, sf, **aggregates):
    """One grouping by sale; exact sums leave as doubles. An aggregate may be a function of the rows' schema."""
    rows = _instalments(spark, sf)
    aggregates = {n: c if isinstance(c, F.Column) else c(rows.schema) for n, c in aggregates.items()}
    grouped = rows.groupBy("sale_id").agg(*[c.alias(n) for n, c in aggregates.items()])
    decimals = [f.name for f in grouped.schema if f.dataType.typeName() == "decimal"]
    return select.doubles(grouped, decimals)


@query("join_correlated_top1")
def _(spark, sf):
    return _per_sale(spark, sf, next_due_balance=lambda schema: aging.next_due_balance(AS_OF, schema))


@query("join_coowner_key")
def _(spark, sf):
    """Co-owner names by sale id, or by client id in the two sources configured so."""
    rules = replace(RULES, coowner_keys={"2-HIGH": "client_id", "3-MEDIUM": "client_id"})
    ctx = context(spark, sf, rules)
    sales = ctx.registry.read("sale", "source", "sale_id", "client_id")
    return statement.coowners(ctx, sales).select("sale_id", "coowners")


@query("join_one_to_many_detail")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    lines = table(spark, sf, "lineitem").select(col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey")
    return joins.left_join_many(orders, lines, ["o_orderkey"])


# ------------------------------------------------------------------ aggregations


@query("agg_overdue_balance")
def _(spark, sf):
    return _per_sale(spark, sf, overdue_balance=aging.overdue_balance(AS_OF))


@query("agg_first_overdue")
def _(spark, sf):
    return _per_sale(spark, sf, first_overdue_on=aging.first_overdue_on(AS_OF))


@query("agg_required_total")
def _(spark, sf):
    return _per_sale(spark, sf, required_total=lambda schema: aging.required_total(AS_OF, schema))


@query("agg_overdue_billed")
def _(spark, sf):
    return _per_sale(spark, sf, overdue_billed=aging.overdue_billed(AS_OF))


@query("agg_next_due_date")
def _(spark, sf):
    return _per_sale(spark, sf, next_due_on=aging.next_due_on(AS_OF))


@query("agg_next_due_number")
def _(spark, sf):
    return _per_sale(spark, sf, next_due_number=aging.next_due_number(AS_OF))


@query("aging_one_pass")
def _(spark, sf):
    """All instalment figures together, as a statement computes them."""
    figures = aging.aging(_instalments(spark, sf), AS_OF, ["sale_id"], RULES.monthly_kind)
    return select.doubles(figures, ["overdue_balance", "required_total", "overdue_billed", "instalment_amount"])


@query("agg_max_id")
def _(spark, sf):
    orders = table(spark, sf, "orders").where("o_orderstatus = 'O'")
    return grouping.max_per_key(orders, ["o_custkey"], "o_orderkey", "max_id")


@query("agg_latest_promise")
def _(spark, sf):
    follow_ups = context(spark, sf).registry.read("follow_up", "sale_id", "promised_on")
    return grouping.latest_date(follow_ups, ["sale_id"], "promised_on", "promised_on")


@query("agg_due_day")
def _(spark, sf):
    return _per_sale(spark, sf, due_day=aging.due_day("N"))


@query("agg_any_value")
def _(spark, sf):
    lines = table(spark, sf, "lineitem")
    order = ["l_shipdate", "l_linenumber", "l_suppkey"]
    account = grouping.pick_by("l_suppkey", order, schema=lines.schema, digits={"l_linenumber": 5})
    return lines.groupBy("l_orderkey").agg(account.alias("account"))


@query("agg_milestone_date")
def _(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_type", "ts")
    return grouping.milestone(events, ["user_id"], "event_type", "ts", "Sign", "reached_on")


@query("agg_distinct_ordered_list")
def _(spark, sf):
    flag = F.nullif(col("l_returnflag"), lit("A"))
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(grouping.list_distinct(flag).alias("concepts"))


@query("agg_coowner_list")
def _(spark, sf):
    """People per order: the suppliers of its lines, those of nation 0 left blank."""
    people = context(spark, sf).registry.read("coowner", "owner_key", "first_name", "last_name_1", "last_name_2")
    known = col("last_name_2") != "K0"
    parts = ["first_name", "last_name_1", "last_name_2"]
    blanked = people.withColumns({p: F.when(known, col(p)).otherwise(" ") for p in parts})
    return grouping.list_names(blanked, ["owner_key"], parts, "coowners")


@query("agg_coowner_chunks")
def _(spark, sf):
    """The distinct people per order, two to a chunk, and how often each occurs."""
    people = context(spark, sf).registry.read("coowner", "owner_key", "first_name", "last_name_1", "last_name_2")
    chunks = grouping.name_chunks(people, ["owner_key"], ["first_name", "last_name_1", "last_name_2"], size=2)
    return chunks.select(
        "owner_key", "chunk", F.array_join("names", ", ").alias("names"), F.array_join("counts", ", ").alias("counts")
    )


@query("agg_having")
def _(spark, sf):
    total = F.sum(dec("l_extendedprice"))
    kept = grouping.having(table(spark, sf, "lineitem"), ["l_orderkey"], {"total": total}, col("total") > 300000)
    return select.doubles(kept, ["total"])


def _payments_and_flows(spark, sf):
    r = context(spark, sf).registry
    paid = r.read(
        "payment", "payment_id", "sale_id", "paid_on", "created_on", "amount", "surcharge", "folio", "concept"
    )
    return paid, r.read("payment_flow", "payment_id", "sale_id", "flow_amount", "flow_concept")


@query("agg_payment_rollup")
def _(spark, sf):
    rolled = payments.payment_rollup(*_payments_and_flows(spark, sf), keys=["payment_id", "sale_id"])
    return select.doubles(rolled, ["amount", "surcharge"])


@query("agg_concept_rollup")
def _(spark, sf):
    rolled = payments.payment_rollup(
        *_payments_and_flows(spark, sf), grain="concept", keys=["payment_id", "sale_id"]
    )
    return select.doubles(rolled, ["amount", "surcharge"])


@query("agg_group_all_dedupe")
def _(spark, sf):
    return grouping.dedupe(table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus"))


# ------------------------------------------------------------------ window, sort, union


@query("window_max_distinct")
def _(spark, sf):
    return grouping.max_per_key(table(spark, sf, "orders"), ["o_custkey"], "o_orderdate", "last_paid_at")


@query("sort_created_asc")
def _(spark, sf):
    created = F.when(col("o_orderstatus") != "P", col("o_orderdate"))
    rows = table(spark, sf, "orders").select("o_orderkey", created.alias("created_on"))
    return select.sort_created(rows, "created_on", ["o_orderkey"])


@query("top1_per_key")
def _(spark, sf):
    lines = table(spark, sf, "lineitem")
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_extendedprice"]
    return lines.groupBy("l_orderkey").agg(
        F.min("l_shipdate").alias("first_at"),
        grouping.pick_by("l_partkey", order, schema=lines.schema, digits={"l_linenumber": 5}).alias("first_part"),
    )


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query("union_sources")
def _(spark, sf):
    """One branch per system, each with its own filter and label."""
    context(spark, sf)
    store = files(sf)
    branches = []
    for priority in PRIORITIES:
        entity = Entity(
            "orders",
            {"sale_id": "o_orderkey", "price": "o_totalprice"},
            where=f"o_orderpriority = '{priority}'",
        )
        one = System(priority, store, {"sale": entity})
        branches.append(tag_source(read_source(spark, one, "sale", ["sale_id", "price"]), priority))
    return union_sources(branches)


# ------------------------------------------------------------------ scalar functions


def _people(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.concat(F.split_part(col("c_name"), lit("#"), lit(1)), lit(" ana-maria  x.y")).alias("first"),
        F.concat(lit(" -"), F.split_part(col("c_name"), lit("#"), lit(2)), lit(".o'NEIL ")).alias("last1"),
        F.nullif(col("c_mktsegment"), lit("MACHINERY")).alias("last2"),
    )


@query("person_name_words")
def _(spark, sf):
    name = text.person_name(col("first"), col("last1"), col("last2"))
    return _people(spark, sf).select("c_custkey", name.alias("name"))


@query("person_name_documents")
def _(spark, sf):
    """The name rule on free text in four languages, the language as second surname."""
    last2 = F.nullif(col("lang"), lit("de"))
    return table(spark, sf, "documents").select(
        "doc_id", text.person_name(col("source"), col("text"), last2).alias("name")
    )


@query("person_name_strict")
def _(spark, sf):
    client = text.person_name(col("first"), col("last1"), col("last2"), nulls="propagate", surname_strip="")
    seller = text.person_name(col("first"), col("last1"), col("last2"), nulls="propagate", surname_strip="-")
    return _people(spark, sf).select("c_custkey", client.alias("client"), seller.alias("seller"))


@query("title_case")
def _(spark, sf):
    spaced = F.upper(F.concat_ws(" ", "p_name", "p_type"))
    return table(spark, sf, "part").select("p_partkey", text.title_words(spaced, " ").alias("title"))


@query("title_case_punct")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.title_words(col("text")).alias("title"))


@query("strip_chars")
def _(spark, sf):
    raw = F.concat_ws("-.", "p_name", "p_type", "p_brand")
    return table(spark, sf, "part").select("p_partkey", text.strip_chars(raw, "-.").alias("stripped"))


TOKENS = ("red", "bolt", "mall", ".")


@query("strip_tokens")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", text.strip_tokens(col("p_name"), TOKENS).alias("stripped"))


@query("strip_tokens_regex")
def _(spark, sf):
    raw = F.concat(col("p_name"), lit("."), col("p_type"))
    return table(spark, sf, "part").select(
        "p_partkey", text.strip_tokens(raw, TOKENS, regex=True).alias("stripped")
    )


@query("fold_accents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.fold_accents(col("text")).alias("folded"))


# The stored date written the ways dirty sources write it, by order priority.
DIRTY_DATE = """
case o_orderpriority
  when '1-URGENT' then '0000-00-00'
  when '2-HIGH' then date_format(o_orderdate, 'yyyy-MM-dd')
  when '3-MEDIUM' then date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')
  when '4-NOT SPECIFIED' then date_format(o_orderdate, 'dd/MM/yyyy')
  else nullif(concat(date_format(o_orderdate, 'yyyy-MM-dd'), 'T10:30:00',
    case o_orderstatus when 'O' then '+05:00' when 'F' then 'Z' else 'Q' end), '')
end
"""


@query("clean_zero_date")
def _(spark, sf):
    text_date = F.when(col("o_orderpriority") == "5-LOW", None).otherwise(expr(DIRTY_DATE))
    return table(spark, sf, "orders").select("o_orderkey", dates.clean_date(text_date).alias("clean_on"))


@query("to_date")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("order_on"))


@query("date_parts")
def _(spark, sf):
    day = col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.year(day).alias("year_no"),
        F.month(day).alias("month_no"),
        F.dayofmonth(day).alias("day_no"),
    )


@query("days_overdue")
def _(spark, sf):
    return _per_sale(spark, sf, days_overdue=dates.days_overdue(aging.first_overdue_on(AS_OF), AS_OF))


@query("concat_ws_nonblank")
def _(spark, sf):
    blank_all = col("c_nationkey") == 3
    parts = [
        F.when(blank_all, "  ").otherwise(F.split_part(col("c_name"), lit("#"), lit(1))),
        F.when(blank_all, None).otherwise(F.concat(lit(" "), col("c_mktsegment"), lit("  "))),
        F.when(col("c_acctbal") > 0, F.when(blank_all, "").otherwise(F.split_part(col("c_name"), lit("#"), lit(2)))),
    ]
    return table(spark, sf, "customer").select("c_custkey", text.full_name(*parts).alias("name"))


@query("coalesce_zero")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    totals = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sum(dec("l_extendedprice")).alias("total"))
    step = joins.Lookup(totals, {"o_orderkey": "l_orderkey"}, {"total": "total"})
    joined = joins.lookup(orders, step)
    return joined.select("o_orderkey", money.coalesce_zero(col("total")).cast("double").alias("total"))


@query("trim_text")
def _(spark, sf):
    padded = F.concat(lit("  \t"), col("text"), lit(" \n "))
    return table(spark, sf, "documents").select("doc_id", text.trim_text(padded).alias("trimmed"))


@query("split_transform_join")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.title_words_split(col("text")).alias("title"))


# ------------------------------------------------------------------ typing stage

TYPING_WORDS = {
    "date": ["_day", "_date"],
    "money": ["total", "price"],
    "integer": ["key", "number"],
    "text": ["status", "ri"],
}


@query("normalise_by_name")
def _(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey",
        F.concat(lit("k"), col("o_custkey")).alias("o_custkey"),
        F.concat(lit("$ "), F.format_number("o_totalprice", 2)).alias("o_totalprice"),
        expr(DIRTY_DATE).alias("order_date"),
        F.concat(lit(" "), col("o_orderstatus"), lit(" ")).alias("o_orderstatus"),
        F.nullif(col("o_orderpriority"), lit("5-LOW")).alias("o_orderpriority"),
        col("o_orderdate").alias("untouched"),
    )
    return typing_rules.normalise(rows, TYPING_WORDS)


@query("normalise_date")
def _(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", expr(DIRTY_DATE).alias("order_date"))
    return typing_rules.normalise(rows, {"date": ["_date"]})


# Amounts as text: grouped, negative in brackets, with a sign inside, with dots repeated, plain.
DIRTY_MONEY = """
case
  when l_linenumber = 1 then concat('$', format_number(l_extendedprice, 2))
  when l_linenumber = 2 then concat('(', cast(cast(l_extendedprice as decimal(18,2)) as string), ')')
  when l_linenumber = 3 then concat('12-', cast(l_partkey as string))
  when l_linenumber = 4 then concat(cast(l_partkey as string), '..', cast(l_suppkey as string))
  when l_linenumber = 5 then concat('-$', cast(l_partkey as string))
  when l_linenumber = 6 then concat(cast(l_partkey as string), '.1.2')
end
"""


@query("normalise_money")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", expr(DIRTY_MONEY).alias("amount"),
        (col("l_extendedprice") * col("l_discount")).alias("net_amount"),
    )
    return typing_rules.normalise(rows, {"money": ["amount"]})


DIRTY_INT = """
case
  when l_linenumber <= 2 then concat('00', cast(l_partkey as string))
  when l_linenumber = 3 then concat('x', cast(l_partkey as string))
  when l_linenumber = 4 then concat(cast(l_partkey as string), '.5')
  when l_linenumber = 5 then concat(' ', cast(l_suppkey as string), '.0 ')
  when l_linenumber = 6 then concat('-', cast(l_suppkey as string))
end
"""


@query("normalise_int")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", expr(DIRTY_INT).alias("number")
    )
    return typing_rules.normalise(rows, {"integer": ["number"]})


@query("normalise_int_rejects")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select(expr(DIRTY_INT).alias("number"))
    return typing_rules.integer_rejects(rows, {"integer": ["number"]})


@query("normalise_text")
def _(spark, sf):
    rows = table(spark, sf, "customer").select(
        "c_custkey",
        F.concat(lit(" \t"), F.nullif(col("c_mktsegment"), lit("BUILDING")), lit(" \n")).alias("segment_text"),
        col("c_nationkey").alias("nation_text"),
    )
    return typing_rules.normalise(rows, {"text": ["_text"]})


@query("column_width_profile")
def _(spark, sf):
    return profile.width_profile(table(spark, sf, "orders"))


# ------------------------------------------------------------------ reports


@query("report_overdue_portfolio")
def _(spark, sf):
    return flat.overdue_portfolio(context(spark, sf))


@query("report_statement_flat")
def _(spark, sf):
    return flat.statement_flat(context(spark, sf))


@query("report_income_flat")
def _(spark, sf):
    return flat.income_flat(context(spark, sf))


@query("report_income_fund_split")
def _(spark, sf):
    return fund_split.income_fund_split(context(spark, sf))


@query("report_statement_sales")
def _(spark, sf):
    return statement.statement_sales(context(spark, sf))


@query("report_statement_coowners")
def _(spark, sf):
    """The statement with real co-owner names instead of the client's."""
    return statement.statement_sales(context(spark, sf, replace(RULES, coowner_source="coowner")))


@query("report_income_sales")
def _(spark, sf):
    return income.income_sales(context(spark, sf))


@query("report_income_by_concept")
def _(spark, sf):
    return income.income_by_concept(context(spark, sf))


# Several systems: the tables that reports group by sale are written bucketed, as many parts as a shuffle has,
# and more where they would be large: each of these entities has a row for each of the table's, counted in its footers.
# The reports' own joins and dedupes shuffle in as many parts.

LINE_BYTES = 64
PART_BYTES = 32 << 20


def _bucketed(spark, sf, *entities: str):
    ctx = systems_context(spark, sf)
    expected = LINE_BYTES * table(spark, sf, "lineitem").count()
    buckets = shuffle_partitions(expected, PART_BYTES, floor=int(spark.conf.get(SHUFFLE_PARTS)))
    return replace(ctx, registry=bucketed(ctx.registry, dict.fromkeys(entities, "sale_id"), buckets), parts=buckets)


@query("report_statement_sales_systems")
def _(spark, sf):
    return statement.statement_sales(_bucketed(spark, sf, "instalment", "payment"))


@query("report_income_sales_systems")
def _(spark, sf):
    return income.income_sales(_bucketed(spark, sf, "payment", "payment_flow"))


@query("report_income_by_concept_systems")
def _(spark, sf):
    return income.income_by_concept(_bucketed(spark, sf, "payment", "payment_flow"))


assert len(REPORTS) == 7
