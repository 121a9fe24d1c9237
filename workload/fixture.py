"""The given tables seen as the entities the reports read.

Nothing is generated: every entity is an expression over whole tables. Ids are unique over
all systems here (one consolidated store), and a sale's system is its order priority.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from duebook.context import Context, Rules
from duebook.session import apply_runtime_options
from duebook.sources.registry import Entity, Registry, System
from duebook.sources.stores import FileStore

AS_OF = date(1998, 7, 15)

MONEY = "cast({0} as decimal(18,2))"
PRICE = MONEY.format("l_extendedprice")
SHARE = "cast({0} as decimal(4,2))"
NET = f"{PRICE} * (cast(1 as decimal(4,2)) - {SHARE.format('l_discount')})"


SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def files(sf_dir: str) -> FileStore:
    return FileStore(sf_dir, schemas=SCHEMAS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_runtime_options(spark)
    return files(sf_dir).scan(spark, name)


def _brand(t: Callable[[str], DataFrame]) -> DataFrame:
    nation, region = t("nation"), t("region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey)


def _seller(t: Callable[[str], DataFrame]) -> DataFrame:
    supplier, nation, region = t("supplier"), t("nation"), t("region")
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )


def _statement(t: Callable[[str], DataFrame]) -> DataFrame:
    customer, nation = t("customer"), t("nation")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey)


def _sale_lines(t: Callable[[str], DataFrame]) -> DataFrame:
    lineitem, orders = t("lineitem"), t("orders").select("o_orderkey", "o_orderpriority")
    return lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)


def _coowner(t: Callable[[str], DataFrame]) -> DataFrame:
    lineitem, supplier = t("lineitem"), t("supplier")
    return lineitem.join(supplier, lineitem.l_suppkey == supplier.s_suppkey)


VIEWS = {
    "brand_view": _brand,
    "seller_view": _seller,
    "statement_view": _statement,
    "coowner_view": _coowner,
    "sale_lines_view": _sale_lines,
}


@dataclass(frozen=True)
class GivenTables:
    """The given files, and the few joined views that stand for tables flattened upstream."""

    files: FileStore

    def scan(self, spark: SparkSession, table: str) -> DataFrame:
        if table in VIEWS:
            return VIEWS[table](lambda name: self.files.scan(spark, name))
        return self.files.scan(spark, table)


# The tables hold no seller of a sale: the order key names one of fifty, so every sale has one.
SALE = {
    "source": "o_orderpriority",
    "sale_id": "o_orderkey",
    "client_id": "o_custkey",
    "unit_id": "o_custkey",
    "seller_id": "o_orderkey % 50",
    "status_id": "o_orderstatus",
    "price": MONEY.format("o_totalprice"),
    "collected": f"{MONEY.format('o_totalprice')} * {SHARE.format('0.40')}",
    "down_payment": "case when o_orderpriority = '5-LOW' then null else cast(100000 as decimal(18,2)) end",
    "receivable": f"{MONEY.format('o_totalprice')} * {SHARE.format('0.60')}",
    "instalment_count": "month(o_orderdate) * 6",
    "closed_on": "case when o_orderpriority = '3-MEDIUM' then '0000-00-00'"
    " else date_format(o_orderdate, 'yyyy-MM-dd') end",
}

INSTALMENT = {
    "sale_id": "l_orderkey",
    "kind": "l_returnflag",
    "number": "l_linenumber",
    "due_on": "cast(l_shipdate as date)",
    "billed": PRICE,
    "balance": f"case when l_linestatus = 'O' then {NET} else 0 end",
}

PAYMENT = {
    "payment_id": "l_orderkey * 10 + l_linenumber",
    "sale_id": "l_orderkey",
    "bank_id": "l_linenumber",
    "form_id": "l_linenumber - 1",
    "paid_on": "l_shipdate",
    "created_on": "date_sub(cast(l_shipdate as date), cast(l_quantity as int))",
    "amount": PRICE,
    "surcharge": MONEY.format("l_tax"),
    "folio": "concat('F-', l_partkey)",
    "concept": "concat('instalment-', lower(l_linestatus), ' paid')",
    "status": "l_linestatus",
    "approved_on": "case when l_returnflag = 'N' then '0000-00-00'"
    " else date_format(l_shipdate, 'yyyy-MM-dd') end",
}

PAYMENT_FLOW = {
    "payment_id": "l_orderkey * 10 + l_linenumber",
    "sale_id": "l_orderkey",
    "status": "case when l_quantity >= 10 then 'O' else 'X' end",
    "flow_amount": NET,
    "flow_concept": "l_returnflag",
}

CUSTOMER_NAME = {
    "first_name": "split_part(c_name, '#', 1)",
    "last_name_1": "concat('-', split_part(c_name, '#', 2))",
    "last_name_2": "nullif(c_mktsegment, 'MACHINERY')",
}

SUPPLIER_NAME = {
    "first_name": "split_part(s_name, '#', 1)",
    "last_name_1": "concat('S.-', split_part(s_name, '#', 2))",
    "last_name_2": "concat('K', s_nationkey)",
}

CONDO_PAYMENT = {
    "payment_id": "o_orderkey",
    "client_id": "o_custkey",
    "user_id": "o_custkey",
    "form_id": "case o_orderpriority when '1-URGENT' then 0 when '2-HIGH' then 1 when '3-MEDIUM' then 2"
    " when '4-NOT SPECIFIED' then 3 else 9 end",
    "folio": "concat('F-', o_orderkey)",
    "bank": "o_orderpriority",
    "amount": MONEY.format("o_totalprice"),
    "paid_on": "o_orderdate",
    "status": "o_orderstatus",
}

STATUS_CODES = (
    "case r_regionkey when 0 then 'F' when 1 then 'O' when 2 then 'P' when 3 then 'purchase' else 'signup' end"
)

OVERDUE_FLAT = {
    "client_id": "c_custkey",
    "development": "c_mktsegment",
    "unit": "split_part(c_name, '#', 2)",
    "client": "c_name",
    "email": "concat(lower(c_mktsegment), '@example.org')",
    "phone": "concat('+52', c_custkey)",
    "birth_date": "date_add(date'1970-01-01', cast(c_custkey as int))",
    "total_paid": MONEY.format("c_acctbal"),
    "overdue_balance": f"{MONEY.format('c_acctbal')} * {SHARE.format('0.50')}",
    "paid_on": "date_add(date'1998-01-01', c_nationkey)",
    "overdue_day": "c_nationkey + 1",
    "holder_name": "split_part(c_name, '#', 1)",
    "system": "'condo'",
}

STATEMENT_FLAT = {
    "client_id": "c_custkey",
    "brand": "n_name",
    "development": "n_name",
    "unit": "nullif(c_mktsegment, 'MACHINERY')",
    "stage": "concat('E', n_regionkey)",
    "client": "c_name",
    "email": "concat(lower(c_mktsegment), '@example.org')",
    "phone": "concat('+52', c_custkey)",
    "bank_reference": "nullif(split_part(c_name, '#', 2), '000000007')",
    "billed_total": MONEY.format("c_acctbal"),
    "receivable_total": f"{MONEY.format('c_acctbal')} * {SHARE.format('0.60')}",
    "overdue_balance": f"{MONEY.format('c_acctbal')} * {SHARE.format('0.10')}",
    "days_late": "c_nationkey * 3",
    "next_due_on": "date_add(date'1998-07-01', c_nationkey)",
    "due_day": "c_nationkey + 1",
    "collected_total": f"{MONEY.format('c_acctbal')} * {SHARE.format('0.40')}",
    "unapplied_balance": "cast(0 as decimal(18,2))",
    "last_paid_on": "date_sub(date'1998-07-01', c_nationkey)",
}

INCOME_FLAT = {
    "payment_id": "o_orderkey",
    "client_id": "o_custkey",
    "development": "o_orderpriority",
    "unit": "concat('U', o_custkey)",
    "bank_reference": "nullif(cast(o_custkey as string), '7')",
    "folio": "concat('F-', o_orderkey)",
    "paid_on": "o_orderdate",
    "registered_on": "cast(o_orderdate as date)",
    "client": "concat('Client ', o_custkey)",
    "amount": MONEY.format("o_totalprice"),
    "bank": "o_orderpriority",
    "account": "concat('00', o_custkey)",
    "pay_form": "o_orderstatus",
    "registered_by": "concat('user ', o_orderkey % 50)",
    "status": "o_orderstatus",
    "system": "'condo'",
    "unapplied_balance": f"{MONEY.format('o_totalprice')} * {SHARE.format('0.05')}",
    "detail_id": "o_orderkey * 10",
    "fee_amount": f"{MONEY.format('o_totalprice')} * {SHARE.format('0.50')}",
    "reserve_amount": f"{MONEY.format('o_totalprice')} * {SHARE.format('0.30')}",
    "fund_amount": f"{MONEY.format('o_totalprice')} * {SHARE.format('0.15')}",
}

ENTITIES = {
    "sale": Entity("orders", SALE),
    "instalment": Entity("lineitem", INSTALMENT),
    "payment": Entity("lineitem", PAYMENT),
    "payment_flow": Entity("lineitem", PAYMENT_FLOW),
    "deposit": Entity("events", {"payment_id": "event_id", "assigned_to": "user_id"}),
    "status_history": Entity(
        "events",
        {
            "sale_id": "user_id",
            "status_id": "event_type",
            "moved_at": "case when event_id % 7 = 0 then '0000-00-00' else date_format(ts, 'yyyy-MM-dd') end",
        },
    ),
    "follow_up": Entity(
        "events",
        {
            "sale_id": "user_id",
            "promised_on": "case when event_type = 'error' then '0000-00-00'"
            " else date_format(ts, 'yyyy-MM-dd') end",
        },
    ),
    "coowner": Entity("coowner_view", {"owner_key": "l_orderkey", **SUPPLIER_NAME}),
    "client": Entity(
        "customer",
        {
            "client_id": "c_custkey",
            **CUSTOMER_NAME,
            "phone": "concat('+52', c_custkey)",
            "email": "concat(lower(c_mktsegment), '@example.org')",
        },
    ),
    "user": Entity("supplier", {"user_id": "s_suppkey", **SUPPLIER_NAME}),
    "unit": Entity(
        "part",
        {
            "unit_id": "p_partkey",
            "development_id": "p_size",
            "number": "p_name",
            "stage": "p_type",
            "section": "p_brand",
            "bank_reference": "concat('00', p_partkey)",
        },
    ),
    "development": Entity("nation", {"development_id": "n_nationkey", "name": "n_name"}),
    "bank": Entity("nation", {"bank_id": "n_nationkey", "name": "n_name"}),
    "pay_form": Entity("region", {"form_id": "r_regionkey", "name": "r_name"}),
    "sale_status": Entity("region", {"status_id": STATUS_CODES, "name": "r_name"}),
    "condo_payment": Entity("orders", CONDO_PAYMENT),
    "condo_transfer": Entity(
        "orders",
        # Some transfers name a payment that does not exist, so some payments have none.
        {
            "payment_id": "case when o_orderpriority = '3-MEDIUM' then -1 - o_orderkey else o_orderkey end",
            "account": "cast(o_custkey as string)",
        },
    ),
    "fund_detail": Entity(
        "lineitem",
        {
            "payment_id": "l_orderkey",
            "fee": f"nullif({PRICE} * {SHARE.format('l_discount')}, 0)",
            "reserve": f"nullif({PRICE} * {SHARE.format('l_tax')}, 0)",
            "fund": f"case when l_returnflag = 'A' then {PRICE} end",
        },
    ),
    "condo_client": Entity(
        "customer", {"client_id": "c_custkey", "property_id": "c_nationkey", **CUSTOMER_NAME}
    ),
    "condo_user": Entity(
        "customer",
        {
            "user_id": "c_custkey",
            "first_name": "'agent'",
            "last_name_1": "c_mktsegment",
            "last_name_2": "cast(null as string)",
        },
    ),
    "property": Entity(
        "nation",
        {
            "property_id": "n_nationkey",
            "condominium_id": "n_nationkey",
            "stage": "concat('E', n_regionkey)",
            "number": "concat('U', n_nationkey)",
        },
    ),
    "condominium": Entity("nation", {"condominium_id": "n_nationkey", "name": "n_name"}),
    "overdue_flat": Entity("customer", OVERDUE_FLAT),
    "statement_flat": Entity("statement_view", STATEMENT_FLAT),
    "income_flat": Entity("orders", INCOME_FLAT),
}

BRAND = Entity(
    "brand_view",
    {
        "raw_name": "n_name",
        "brand": "r_name",
        "development": "replace(n_name, 'NATION_', 'Nation ')",
        "section": "concat('S', n_regionkey)",
    },
)

SELLER = Entity(
    "seller_view",
    {
        "seller": "concat('Supplier S', split_part(s_name, '#', 2), ' K', s_nationkey)",
        "branch": "n_name",
        "seller_kind": "case when s_acctbal > 5000 then 'internal' else 'external' end",
        "team": "r_name",
    },
)

RULES = Rules(
    reference_prefix="REF_",
    statement_prefix="ref_",
    sale_statuses=("F", "O"),
    active_status="O",
    monthly_kind="N",
    milestone_prefix="eur",
    seller_tokens=("K16", "."),
    staged_developments=("Nation 3", "NATION_3"),
    staged_sources=("5-LOW",),
    excluded_client_fragments=("Furniture",),
    excluded_seller_fragments=("K7",),
    excluded_developments=("Nation 5", "Nation 6"),
    excluded_banks=("2-HIGH",),
    excluded_user="Agent Machinery",
    excluded_development="Nation 4",
    excluded_section=("Nation 10", "S0"),
)


def system(sf_dir: str) -> System:
    return System("lake", GivenTables(files(sf_dir)), ENTITIES)


def context(spark: SparkSession, sf_dir: str, rules: Rules = RULES, as_of: date = AS_OF) -> Context:
    apply_runtime_options(spark)
    lake = system(sf_dir)
    registry = Registry(
        spark, [lake], {"brand": (lake.store, BRAND), "seller": (lake.store, SELLER)}, id_scope="global"
    )
    return Context(registry, as_of, rules)


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def systems(sf_dir: str) -> list[System]:
    """The same tables as five systems of one shape: each has its own sales, with their instalments and payments."""
    lake, found = system(sf_dir), []
    sale = {k: v for k, v in SALE.items() if k != "source"}
    for priority in PRIORITIES:
        own = f"o_orderpriority = '{priority}'"
        entities = {
            "sale": Entity("orders", sale, own),
            "instalment": Entity("sale_lines_view", INSTALMENT, own),
            "payment": Entity("sale_lines_view", PAYMENT, own),
            "payment_flow": Entity("sale_lines_view", PAYMENT_FLOW, own),
        }
        found.append(System(priority, lake.store, {**lake.entities, **entities}))
    return found


def systems_context(spark: SparkSession, sf_dir: str) -> Context:
    """As ``context``, with ids that are unique within a system only."""
    ctx = context(spark, sf_dir)
    return replace(ctx, registry=Registry(spark, systems(sf_dir), ctx.registry.dimensions, id_scope="system"))
