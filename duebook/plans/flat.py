"""Reports read from tables that are already flat: overdue portfolio, statement, income."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.context import Context
from duebook.functions.dates import column_in_month
from duebook.functions.keys import prefix_ref, unit_key
from duebook.functions.money import to_double

OVERDUE_COLUMNS = (
    "client_id", "development", "unit", "client", "email", "phone", "birth_date", "total_paid",
    "overdue_balance", "paid_on", "overdue_day", "holder_name", "system",
)

INCOME_COLUMNS = (
    "payment_id", "client_id", "development", "unit", "reference", "folio", "paid_on",
    "registered_on", "client", "amount", "bank", "account", "pay_form", "registered_by", "status",
    "system", "unapplied_balance", "detail_id", "fee_amount", "reserve_amount", "fund_amount",
)


def overdue_portfolio(ctx: Context) -> DataFrame:
    rows = ctx.registry.read("overdue_flat", *OVERDUE_COLUMNS)
    amounts = {c: to_double(F.col(c)) for c in ("total_paid", "overdue_balance")}
    return rows.withColumns(amounts).select(*OVERDUE_COLUMNS)


def statement_flat(ctx: Context) -> DataFrame:
    rows = ctx.registry.read(
        "statement_flat",
        "client_id", "brand", "development", "unit", "stage", "client", "email", "phone",
        "bank_reference", "billed_total", "receivable_total", "overdue_balance", "days_late",
        "next_due_on", "due_day", "collected_total", "unapplied_balance", "last_paid_on",
    )
    return rows.select(
        "client_id",
        unit_key(F.col("development"), F.col("unit")).alias("unit_key"),
        "brand",
        "development",
        "unit",
        "stage",
        "client",
        "email",
        "phone",
        prefix_ref(F.col("bank_reference"), ctx.rules.reference_prefix).alias("reference"),
        to_double(F.col("billed_total")).alias("billed_total"),
        to_double(F.col("receivable_total")).alias("receivable_total"),
        to_double(F.col("overdue_balance")).alias("overdue_balance"),
        "days_late",
        "next_due_on",
        "due_day",
        to_double(F.col("collected_total")).alias("collected_total"),
        to_double(F.col("unapplied_balance")).alias("unapplied_balance"),
        "last_paid_on",
    )


def income_flat(ctx: Context) -> DataFrame:
    source = ["bank_reference" if c == "reference" else c for c in INCOME_COLUMNS]
    rows = ctx.registry.read("income_flat", *source, where=lambda df: column_in_month(df, "paid_on", ctx.as_of))
    amounts = ("amount", "unapplied_balance", "fee_amount", "reserve_amount", "fund_amount")
    return rows.withColumns(
        {
            "reference": prefix_ref(F.col("bank_reference"), ctx.rules.reference_prefix),
            **{c: to_double(F.col(c)) for c in amounts},
        }
    ).select(*INCOME_COLUMNS)
