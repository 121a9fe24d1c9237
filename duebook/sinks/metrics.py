"""What a report's write pass saw of its columns: no second scan, and nothing silent about typing."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duebook.functions.money import is_rejected
from duebook.operators.profile import shown, width_of
from duebook.operators.typing_rules import REPORT_KEYWORDS, Keywords, category, normalise, partial_matches

# What text without a value consists of: blanks, and the zeros and separators of an all-zero date.
NO_VALUE = "0-/:.T \t\r\n"


@dataclass(frozen=True)
class ReportMetrics:
    """``rejects``: by integer column, numbers turned into 0. ``unread``: by date, money or integer column
    of text, values that are no date or number at all. ``partial``: columns whose category rests on a
    part of a word. ``widths``: display width by column, as ``width_profile`` gives it."""

    rows: int
    widths: Mapping[str, float]
    rejects: Mapping[str, int]
    unread: Mapping[str, int]
    partial: Mapping[str, str]


def _unread(raw: Column, typed: Column, group: str) -> Column:
    read = raw.try_cast("decimal(38,9)") if group == "integer" else typed
    return F.count_if((F.translate(raw, NO_VALUE, "") != "") & read.isNull())


def watched(
    df: DataFrame, keywords: Keywords = REPORT_KEYWORDS, overrides: Mapping[str, str] | None = None
) -> tuple[DataFrame, Callable[[], ReportMetrics]]:
    """The frame typed by ``normalise``, and its metrics, to be asked for after the frame was written once.

    Each value is typed once; the raw columns that a count needs go along up to the observation. It belongs
    above the report's last shuffle, so only projections may follow: a sort after it would run the rows
    twice, once to find its ranges, and count them twice.
    """
    groups = {name: category(name, keywords, overrides) for name in df.columns}
    typed = normalise(df, keywords, overrides)
    raw = {
        f.name: f"__raw_{i}"
        for i, f in enumerate(df.schema.fields)
        if groups[f.name] == "integer" and not isinstance(f.dataType, T.IntegralType)
        or groups[f.name] in ("date", "money") and isinstance(f.dataType, T.StringType)
    }
    texts = [n for n in raw if isinstance(df.schema[n].dataType, T.StringType)]
    integers = [n for n in raw if groups[n] == "integer"]
    both = normalise(
        df.select("*", *[df[f"`{n}`"].alias(alias) for n, alias in raw.items()]),
        keywords,
        {**(overrides or {}), **dict.fromkeys(raw.values(), "raw")},
    )
    counts = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(typed.schema.fields):
        counts.append(F.max(F.length(shown(both[f"`{f.name}`"], f.dataType))).alias(f"longest_{i}"))
    counts += [F.count_if(is_rejected(both[raw[n]])).alias(f"rejects_{raw[n]}") for n in integers]
    counts += [_unread(both[raw[n]], both[f"`{n}`"], groups[n]).alias(f"unread_{raw[n]}") for n in texts]
    seen = Observation()
    frame = both.observe(seen, *counts).select(*[both[f"`{n}`"] for n in df.columns])

    def metrics() -> ReportMetrics:
        got = seen.get
        return ReportMetrics(
            rows=got["rows"],
            widths={n: width_of(n, got[f"longest_{i}"]) for i, n in enumerate(df.columns)},
            rejects={n: got[f"rejects_{raw[n]}"] for n in integers},
            unread={n: got[f"unread_{raw[n]}"] for n in texts},
            partial=partial_matches([n for n in df.columns if n not in (overrides or {})], keywords),
        )

    return frame, metrics


def metrics_table(spark: SparkSession, reports: Mapping[str, ReportMetrics]) -> DataFrame:
    """A row for each report and column; counts are null where a column cannot have them."""
    rows = [
        (report, m.rows, name, width, m.rejects.get(name), m.unread.get(name), m.partial.get(name))
        for report, m in reports.items()
        for name, width in m.widths.items()
    ]
    schema = "report string, row_count long, column string, width double, rejects long, unread long, partial string"
    return spark.createDataFrame(rows, schema)
