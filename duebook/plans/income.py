"""Income of the month over all sales systems, per payment or per payment and concept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.context import Context
from duebook.functions.dates import clean_date, column_in_month
from duebook.functions.keys import prefix_ref, unit_key, unit_key_staged
from duebook.functions.predicates import exclude_contains, exclude_values
from duebook.functions.text import fold_accents, strip_tokens, title_words, trim_text
from duebook.operators.grouping import dedupe
from duebook.operators.joins import lookup_chain
from duebook.operators.payments import payment_rollup
from duebook.operators.select import sort_created
from duebook.plans.shared import branded, by_id, named


def approved_payments(ctx: Context) -> DataFrame:
    """Active, approved payments of the as-of month.

    The month is cut here, before the roll-up, because a range on the payment's own date
    reaches the scan; after the roll-up it would sit above an aggregate.
    """
    active = ctx.rules.required("active_status")
    payments = ctx.registry.read(
        "payment",
        "payment_id", "sale_id", "bank_id", "form_id", "paid_on", "created_on", "amount", "surcharge",
        "folio", "concept", "status", "approved_on",
        where=lambda df: (F.col("status") == active) & column_in_month(df, "paid_on", ctx.as_of),
    )
    return payments.where(clean_date(F.col("approved_on")).isNotNull()).drop("status", "approved_on")


def with_names(ctx: Context, approved: DataFrame) -> DataFrame:
    """Payments with their bank and form names."""
    r = ctx.registry
    named_rows = lookup_chain(
        approved,
        [
            by_id(ctx, r.read_lookup("bank", "bank_id", "name"), "bank_id", {"bank": "name"}),
            by_id(ctx, r.read_lookup("pay_form", "form_id", "name"), "form_id", {"pay_form": "name"}),
        ],
    )
    return named_rows.withColumns(
        {
            "paid_on": clean_date(F.col("paid_on")),
            "created_on": clean_date(F.col("created_on")),
            "pay_form": trim_text(title_words(F.col("pay_form"))),
            "concept": trim_text(title_words(F.col("concept"))),
        }
    )


def income_sales(ctx: Context, grain: str = "payment") -> DataFrame:
    r, rules = ctx.registry, ctx.rules
    approved = ctx.once("approved_payments", lambda: approved_payments(ctx))
    # Flows and deposits are joined left from the month's payments: those of other months go before
    # they are grouped, so that the cost is the month's and not the history's. Only keys are needed there,
    # so they come from the payments before any lookup.
    key = r.keys("payment_id", "sale_id")
    flows = r.read(
        "payment_flow",
        "payment_id", "sale_id", "status", "flow_amount", "flow_concept",
        where=F.col("status") == rules.required("active_status"),
    ).drop("status").join(approved.select(*key), key, "left_semi")
    rolled = payment_rollup(
        with_names(ctx, approved),
        flows,
        grain=grain,
        amount=rules.concept_amount,
        keys=key,
    )
    # A payment may have several deposits of one user: distinct pairs before the join.
    paid = r.keys("payment_id")
    deposits = lookup_chain(
        r.read("deposit", "payment_id", "assigned_to").join(approved.select(*paid), paid, "left_semi"),
        [by_id(ctx, named(ctx, "user", "user_id"), "user_id", {"assigned_by": "name"}, "assigned_to")],
    )
    deposits = deposits.select(*paid, "assigned_by").distinct()

    sellers = named(ctx, "user", "user_id")
    sellers = sellers.withColumn("name", strip_tokens(F.col("name"), rules.seller_tokens))
    sale_columns = {c: c for c in ("client_id", "unit_id", "seller_id", "status_id")}
    if r.id_scope == "global":
        sale_columns["source"] = "source"
        sales = r.read("sale", "source", "sale_id", "client_id", "unit_id", "seller_id", "status_id")
    else:
        sales = r.read("sale", "sale_id", "client_id", "unit_id", "seller_id", "status_id")
    unit_columns = {"development_id": "development_id", "unit": "number", "stage": "stage", "section": "section"}
    unit_columns["bank_reference"] = "bank_reference"
    rows = lookup_chain(
        rolled,
        [
            by_id(ctx, sales, "sale_id", sale_columns),
            by_id(ctx, named(ctx, "client", "client_id"), "client_id", {"client": "name"}),
            by_id(ctx, r.read("unit", "unit_id", *unit_columns.values()), "unit_id", unit_columns),
            by_id(ctx, sellers, "user_id", {"seller": "name"}, "seller_id"),
            by_id(
                ctx,
                branded(ctx, r.read("development", "development_id", "name"), "brand", "development"),
                "development_id",
                {"raw_name": "name", "brand": "brand", "development": "development"},
            ),
            by_id(ctx, r.read_lookup("sale_status", "status_id", "name"), "status_id", {"status": "name"}),
            by_id(ctx, deposits, "payment_id", {"assigned_by": "assigned_by"}),
        ],
    )
    # The filters see the names as they are; accents are folded afterwards.
    kept = rows.where(
        exclude_contains(F.col("client"), rules.excluded_client_fragments)
        & exclude_contains(F.col("seller"), rules.excluded_seller_fragments)
        & exclude_values(F.col("development"), rules.excluded_developments)
    )
    plain = unit_key(F.col("raw_name"), F.col("unit"))
    staged = unit_key_staged(
        F.col("raw_name"), F.col("unit"), F.col("stage"), rules.staged_developments, F.col("raw_name")
    )
    if rules.staged_sources is not None:
        staged = F.when(F.col("source").isin(*rules.staged_sources), staged).otherwise(plain)
    surcharge = [F.col("surcharge").cast("double").alias("surcharge")] if grain == "payment" else []
    flow_column = "flow_concepts" if grain == "payment" else "flow_concept"
    report = kept.select(
        "sale_id",
        staged.alias("unit_key"),
        "brand",
        "development",
        "section",
        "stage",
        "unit",
        "folio",
        fold_accents(F.col("client")).alias("client"),
        prefix_ref(F.col("bank_reference"), rules.reference_prefix).alias("reference"),
        "status",
        "payment_id",
        "paid_on",
        "created_on",
        F.col("amount").cast("double").alias("amount"),
        *surcharge,
        "pay_form",
        "concept",
        flow_column,
        "bank",
        "assigned_by",
    )
    return sort_created(ctx.at_size(dedupe(report)), "created_on", ["payment_id", "sale_id"])


def income_by_concept(ctx: Context) -> DataFrame:
    return income_sales(ctx, grain="concept")
