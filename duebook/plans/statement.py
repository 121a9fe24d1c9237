"""Account statement per sale over all sales systems."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.context import Context
from duebook.functions.dates import clean_date, days_overdue
from duebook.functions.keys import financed_months, only_if_known, prefix_ref, unit_key_staged
from duebook.functions.money import amount_if_month, cap
from duebook.functions.text import fold_accents, person_name, strip_tokens, title_words, trim_text
from duebook.operators.aging import aging
from duebook.operators.grouping import dedupe, latest_by, latest_date, list_names, milestone
from duebook.operators.joins import Lookup, conform, lookup_chain
from duebook.operators.select import doubles
from duebook.plans.shared import NAME_PARTS, branded, by_id, name_parts

BRAND_COLUMNS = ("brand", "development", "section")
SELLER_COLUMNS = ("branch", "seller_kind", "team")

AMOUNTS = (
    "price", "collected", "down_payment_paid", "receivable", "instalment_amount", "required_total",
    "collected_this_month", "overdue_balance", "last_paid_amount",
)


def latest_payments(ctx: Context) -> DataFrame:
    """Date and amount of each sale's latest approved payment, and the amount if it fell in the month.

    The month amount is 0 for an older payment; a sale without payment gets NULL from the
    left join that follows.
    """
    r = ctx.registry
    payments = r.read("payment", "sale_id", "payment_id", "paid_on", "amount", "approved_on")
    latest = latest_by(
        payments,
        r.keys("sale_id"),
        "payment_id",
        ["paid_on", "amount"],
        where=clean_date(F.col("approved_on")).isNotNull(),
    )
    day = clean_date(F.col("paid_on"))
    return latest.select(
        *r.keys("sale_id"),
        day.alias("last_paid_on"),
        F.col("amount").alias("last_paid_amount"),
        amount_if_month(F.col("amount"), day, ctx.as_of).alias("collected_this_month"),
    )


def milestones(ctx: Context) -> DataFrame:
    r = ctx.registry
    history = lookup_chain(
        r.read("status_history", "sale_id", "status_id", "moved_at"),
        [by_id(ctx, r.read_lookup("sale_status", "status_id", "name"), "status_id", {"status_name": "name"})],
    )
    return milestone(
        history, r.keys("sale_id"), "status_name", "moved_at", ctx.rules.required("milestone_prefix"), "signed_on"
    )


def coowners(ctx: Context, sales: DataFrame) -> DataFrame:
    """Co-owner names, keyed by the sale or by the client as configured for each source."""
    r = ctx.registry
    names = list_names(r.read("coowner", "owner_key", *NAME_PARTS), r.keys("owner_key"), NAME_PARTS, "coowners")
    by_client = [s for s, key in ctx.rules.coowner_keys.items() if key == "client_id"]
    owner_key = F.col("sale_id")
    if by_client:
        owner_key = F.when(F.col("source").isin(*by_client), F.col("client_id")).otherwise(owner_key)
    keyed = sales.withColumn("owner_key", owner_key)
    step = Lookup(names, {k: k for k in r.keys("owner_key")}, {"coowners": "coowners"})
    return lookup_chain(keyed, [step])


def statement_sales(ctx: Context) -> DataFrame:
    r, rules = ctx.registry, ctx.rules
    key = r.keys("sale_id")
    sales = r.read(
        "sale",
        "source", "sale_id", "client_id", "unit_id", "seller_id", "status_id", "price", "collected",
        "down_payment", "receivable", "instalment_count", "closed_on",
        where=None if rules.sale_statuses is None else F.col("status_id").isin(*rules.sale_statuses),
    )
    client_take = {f"client_{p}": p for p in NAME_PARTS} | {"phone": "phone", "email": "email"}
    unit_take = {"development_id": "development_id", "unit": "number", "stage": "stage"}
    unit_take["bank_reference"] = "bank_reference"
    # Both text keys are joined lookup to lookup, so no fact row is shuffled by a text.
    sellers = conform(
        r.read("user", "user_id", *NAME_PARTS).select(
            *r.keys("user_id"),
            strip_tokens(
                person_name(*name_parts(), nulls="propagate", surname_strip="-"),
                rules.seller_tokens,
                regex=True,
            ).alias("name"),
        ),
        r.read_dim("seller", "seller", *SELLER_COLUMNS),
        ("name", "seller"),
        {c: c for c in SELLER_COLUMNS},
        fail_on_dup=rules.fail_on_duplicate_dimension,
        distinct=True,
    )
    developments = branded(ctx, r.read("development", "development_id", "name"), *BRAND_COLUMNS)
    rows = lookup_chain(
        sales,
        [
            by_id(ctx, r.read("client", "client_id", *client_take.values()), "client_id", client_take),
            by_id(ctx, r.read("unit", "unit_id", *unit_take.values()), "unit_id", unit_take),
            by_id(ctx, r.small(sellers), "user_id", {"seller": "name"} | {c: c for c in SELLER_COLUMNS}, "seller_id"),
            by_id(
                ctx, developments, "development_id", {"raw_name": "name"} | {c: c for c in BRAND_COLUMNS}
            ),
            by_id(ctx, r.read_lookup("sale_status", "status_id", "name"), "status_id", {"status": "name"}),
        ],
    )
    instalments = aging(
        r.read("instalment", "sale_id", "kind", "number", "due_on", "billed", "balance"),
        ctx.as_of,
        key,
        rules.required("monthly_kind"),
    )
    promises = latest_date(r.read("follow_up", "sale_id", "promised_on"), key, "promised_on", "promised_on")

    def per_sale(df: DataFrame) -> Lookup:
        return by_id(ctx, df, "sale_id", {c: c for c in df.columns if c not in key})

    # Last, because all of these are grouped by the sale: one shuffle of the sales serves the
    # four joins and, ids being unique over all sources, the dedupe of the report as well.
    rows = lookup_chain(
        rows,
        [
            per_sale(latest_payments(ctx)),
            per_sale(instalments.drop("overdue_billed")),
            per_sale(promises),
            per_sale(milestones(ctx)),
        ],
    )
    if rules.coowner_source == "coowner":
        rows = coowners(ctx, rows)

    client = fold_accents(
        person_name(*[F.col(f"client_{p}") for p in NAME_PARTS], nulls="propagate", surname_strip="")
    )
    coowner = client
    if rules.coowner_source == "coowner":
        coowner = fold_accents(title_words(trim_text(F.col("coowners"))))
    overdue_days = days_overdue(F.col("first_overdue_on"), ctx.as_of)
    report = rows.select(
        "sale_id",
        unit_key_staged(
            F.col("raw_name"), F.col("unit"), F.col("stage"), rules.staged_developments, F.col("development")
        ).alias("unit_key"),
        "brand",
        "development",
        "section",
        "stage",
        "unit",
        client.alias("client"),
        coowner.alias("coowner"),
        "seller",
        "branch",
        "seller_kind",
        "team",
        "phone",
        "email",
        prefix_ref(F.col("bank_reference"), rules.statement_prefix).alias("reference"),
        "status",
        clean_date(F.col("closed_on")).alias("contract_on"),
        "signed_on",
        "price",
        "due_day",
        "collected",
        cap(F.col("down_payment"), F.col("collected")).alias("down_payment_paid"),
        "receivable",
        financed_months(F.col("instalment_count")).alias("financed_months"),
        "instalment_amount",
        "required_total",
        overdue_days.alias("days_overdue"),
        "last_paid_on",
        "collected_this_month",
        "overdue_balance",
        F.col("next_due_number").alias("next_due_number"),
        "next_due_on",
        "last_paid_amount",
        only_if_known(overdue_days, F.col("promised_on")).alias("promised_on"),
    )
    return ctx.at_size(dedupe(doubles(report, AMOUNTS)))
