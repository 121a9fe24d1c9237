"""Row and width profiles of a report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def report_shape(df: DataFrame, report: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(report).alias("report"), "row_count", F.lit(len(df.columns)).alias("column_count")
    )


def shown(col: Column, dtype: T.DataType) -> Column:
    """The text whose length counts: NULL for a NULL, empty or zero value."""
    if isinstance(dtype, T.DateType):
        return col.cast("timestamp_ntz").cast("string")
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        # Plain digits without trailing zeros, never an exponent.
        plain = F.regexp_replace(col.cast("decimal(38,10)").cast("string"), r"\.?0+$", "")
        return F.when(col != 0, plain)
    if isinstance(dtype, T.IntegralType):
        return F.when(col != 0, col.cast("string"))
    return F.nullif(col.cast("string"), F.lit(""))


def width_of(name: str, longest: int | None) -> float:
    """Display width of a column whose longest shown value has so many characters."""
    return min(50.0, max(8.0, (max(longest or 0, len(name)) + 2) * 1.1))


def width_profile(df: DataFrame) -> DataFrame:
    """Display width per column, header included: (longest + 2) x 1.1 within 8 and 50.

    One aggregation over all columns, then one row per column.
    """
    longest = df.agg(
        *[F.max(F.length(shown(df[f"`{f.name}`"], f.dataType))).alias(f.name) for f in df.schema.fields]
    )
    entries = [
        F.struct(
            F.lit(name).alias("column"),
            F.greatest(F.coalesce(F.col(f"`{name}`"), F.lit(0)), F.lit(len(name))).alias("longest"),
        )
        for name in df.columns
    ]
    rows = longest.select(F.inline(F.array(*entries)))
    width = F.least(F.lit(50.0), F.greatest(F.lit(8.0), (F.col("longest") + 2) * F.lit(1.1)))
    return rows.select("column", width.alias("width"))
