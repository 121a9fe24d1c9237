"""Payment roll-ups: one row per payment, or per payment and concept, without double counting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.operators.grouping import list_distinct

PAYMENT_KEY = ("source", "payment_id", "sale_id")
PAYMENT_FIRST = ("paid_on", "created_on", "amount")
PAYMENT_LAST = ("pay_form", "concept", "folio", "bank")


def payment_rollup(
    payments: DataFrame,
    flows: DataFrame,
    *,
    grain: str = "payment",
    amount: str = "min",
    keys: Sequence[str] = PAYMENT_KEY,
) -> DataFrame:
    """Payments with their flows.

    ``grain="payment"``: a row per sale, payment and surcharge with the list of flow
    concepts. ``grain="concept"``: a row per concept, whose amount is the smallest flow of
    the concept (``amount="sum"`` for their total) and NULL for a payment without flow.

    The flows are grouped before the join, so nothing fans out and both sides arrive
    partitioned by the payment key with one row per group.
    """
    if amount not in ("min", "sum"):
        raise ValueError(f"amount must be 'min' or 'sum', not {amount!r}")
    first = [c for c in PAYMENT_FIRST if grain == "payment" or c != "amount"]
    rolled = payments.groupBy(*keys, "surcharge").agg(
        *[F.min(c).alias(c) for c in first if c in payments.columns],
        *[F.max(c).alias(c) for c in PAYMENT_LAST if c in payments.columns],
    )
    if grain == "payment":
        per_key = flows.groupBy(*keys).agg(list_distinct(F.col("flow_concept")).alias("flow_concepts"))
    elif grain == "concept":
        total = F.min("flow_amount") if amount == "min" else F.sum("flow_amount")
        per_key = flows.groupBy(*keys, "flow_concept").agg(total.alias("amount"))
    else:
        raise ValueError(f"grain must be 'payment' or 'concept', not {grain!r}")
    return rolled.join(per_key, list(keys), "left")
