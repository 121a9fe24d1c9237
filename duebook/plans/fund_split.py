"""Income of the month with its split over three funds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.context import Context
from duebook.functions.dates import clean_date, column_in_month
from duebook.functions.keys import prefix_ref
from duebook.functions.money import fund_split, future_funds
from duebook.functions.predicates import exclude_pair, exclude_value, exclude_values
from duebook.operators.joins import left_join_many, lookup_chain
from duebook.plans.shared import branded, by_id, named

FUNDS = ("fee", "reserve", "fund")
BRAND_COLUMNS = ("brand", "development", "section")


def income_fund_split(ctx: Context) -> DataFrame:
    r, rules = ctx.registry, ctx.rules
    active = rules.required("active_status")
    payments = r.read(
        "condo_payment",
        "payment_id", "client_id", "user_id", "form_id", "folio", "bank", "amount", "paid_on", "status",
        where=lambda df: (F.col("status") == active) & column_in_month(df, "paid_on", ctx.as_of),
    ).drop("status")
    # A payment repeats once per transfer and detail row, on purpose; one may hold very many.
    key = r.keys("payment_id")
    moved = left_join_many(payments, r.read("condo_transfer", "payment_id", "account"), key)
    detailed = left_join_many(moved, r.read("fund_detail", "payment_id", *FUNDS), key)
    rows = lookup_chain(
        detailed,
        [
            by_id(ctx, r.read_lookup("pay_form", "form_id", "name"), "form_id", {"pay_form": "name"}),
            by_id(
                ctx,
                named(ctx, "condo_client", "client_id", "empty", "property_id"),
                "client_id",
                {"client": "name", "property_id": "property_id"},
            ),
            by_id(
                ctx,
                r.read("property", "property_id", "condominium_id", "stage", "number"),
                "property_id",
                {"condominium_id": "condominium_id", "stage": "stage", "unit": "number"},
            ),
            by_id(
                ctx,
                branded(ctx, r.read("condominium", "condominium_id", "name"), *BRAND_COLUMNS),
                "condominium_id",
                {c: c for c in BRAND_COLUMNS},
            ),
            by_id(ctx, named(ctx, "condo_user", "user_id"), "user_id", {"user": "name"}),
        ],
    )
    pair = F.lit(True)
    if rules.excluded_section is not None:
        development, section = rules.excluded_section
        pair = exclude_pair(F.col("development"), development, F.col("section"), section)
    kept = rows.where(
        F.col("development").isNotNull()
        & exclude_value(F.col("development"), rules.excluded_development)
        & exclude_value(F.col("user"), rules.excluded_user)
        & F.col("pay_form").isNotNull()
        & pair
        & exclude_values(F.col("bank"), rules.excluded_banks)
    )
    funds = [F.col(f) for f in FUNDS]
    fee, reserve, fund = fund_split(*funds)
    return kept.select(
        "payment_id",
        F.col("property_id").alias("sale_id"),
        "brand",
        "development",
        "section",
        "stage",
        "unit",
        "folio",
        "client",
        "user",
        prefix_ref(F.col("account"), rules.reference_prefix).alias("reference"),
        clean_date(F.col("paid_on")).alias("paid_on"),
        "bank",
        "pay_form",
        F.col("amount").cast("double").alias("amount"),
        fee.alias("fee_amount"),
        reserve.alias("reserve_amount"),
        fund.alias("fund_amount"),
        future_funds(F.col("amount"), *funds).alias("future_funds"),
    )
