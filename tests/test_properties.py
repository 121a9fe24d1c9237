"""Expressions against plain-Python models on generated text."""

from datetime import date, datetime
from decimal import Decimal

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duebook.functions import dates, money, text
from duebook.operators import grouping

LETTERS = "abzXYÁéñüß09 .,-_'/()\t\n$+%"
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet=LETTERS, max_size=25)), min_size=20, max_size=60)
NUMBERS = st.lists(st.text(alphabet="0123456789.-$, ()Ex", max_size=9), min_size=20, max_size=60)
BATCHES = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow]
)


def run(spark, rows, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "i int, x string")
    return [r[1] for r in sorted(df.select("i", column.alias("y")).collect())] if rows else []


def plain_title(value):
    if value is None:
        return None
    out, start = [], True
    for ch in value.lower():
        out.append(ch.upper() if start and ch != "ß" else ch)
        start = ch in text.WORD_BREAKS
    return "".join(out)


@BATCHES
@given(rows=TEXTS)
def test_title_words(spark, rows):
    assert run(spark, rows, text.title_words(F.col("x"))) == [plain_title(r) for r in rows]


@BATCHES
@given(rows=TEXTS)
def test_person_name_never_has_outer_space_and_keeps_letters(spark, rows):
    names = run(spark, rows, text.person_name(F.col("x"), F.col("x"), F.lit(None).cast("string")))
    for row, name in zip(rows, names, strict=True):
        assert name == name.strip(text.WHITE_SPACE)
        kept = [c for c in (row or "").lower() if c.isalnum()]
        assert [c for c in name.lower() if c.isalnum()] == kept * 2


@BATCHES
@given(rows=NUMBERS)
def test_norm_money_is_the_array_library_rule(spark, rows):
    cleaned = pd.Series(rows, dtype=object).str.replace(r"[^\d.\-]", "", regex=True).str.replace(r"\.+", ".", regex=True)
    expected = pd.to_numeric(cleaned, errors="coerce").round(2)
    got = run(spark, rows, money.norm_money(F.col("x"), T.StringType()))
    assert [None if pd.isna(v) else float(v) for v in expected] == got


@BATCHES
@given(rows=NUMBERS)
def test_norm_int_is_whole_or_zero(spark, rows):
    numbers = pd.to_numeric(pd.Series(rows, dtype=object).str.strip(), errors="coerce")
    whole = [not pd.isna(v) and abs(v) < 2**63 and v == int(v) for v in numbers]
    expected = [int(v) if ok else 0 for v, ok in zip(numbers, whole, strict=True)]
    assert run(spark, rows, money.norm_int(F.col("x"))) == expected


DAYS = st.one_of(st.none(), st.dates())
CENTS = st.one_of(st.none(), st.integers(-(10**18) + 1, 10**18 - 1))
PICKS = st.lists(
    st.tuples(st.integers(0, 3), DAYS, st.one_of(st.none(), st.integers(-(1 << 31), (1 << 31) - 1)), CENTS, st.booleans()),
    min_size=1, max_size=60,
)


@BATCHES
@given(rows=PICKS)
def test_packed_picks_equal_struct_picks(spark, rows):
    """Ties, negative values and NULLs in every column, with and without a condition."""
    cents = [(k, d, n, None if c is None else Decimal(c).scaleb(-2), w) for k, d, n, c, w in rows]
    df = spark.createDataFrame(cents, "k int, d date, n int, v decimal(18,2), w boolean")
    for order in (["d", "n", "v"], ["n", "v"], ["d", "v", "n"], ["v"], ["d", "n"]):
        for column in order[-2:]:
            if column == "d":
                continue
            for where in (None, F.col("w")):
                packed = grouping.pick_by(column, order, where, df.schema).alias("x")
                plain = grouping.pick_by(column, order, where).alias("x")
                assert sorted(df.groupBy("k").agg(packed).collect()) == sorted(df.groupBy("k").agg(plain).collect())
    latest = grouping.latest_by(df, ["k"], "n", ["d", "v"])
    ordered = df.groupBy("k").agg(F.max(F.struct("n", "d", "v")).alias("x")).select("k", "x.*")
    assert sorted(latest.collect(), key=str) == sorted(ordered.collect(), key=str)


def test_packed_picks_of_times_and_big_numbers(spark):
    rows = [
        (datetime(1, 1, 1), 5, -(10**14)), (datetime(1, 1, 1, 0, 0, 0, 1), 4, 1), (datetime(9999, 12, 31, 23, 59, 59, 999999), 3, 7),
        (datetime(1969, 12, 31, 23, 59, 59, 999999), -2, None), (None, 9, 3),
    ]
    for kind in ("timestamp_ntz", "timestamp"):
        df = spark.createDataFrame(rows, f"t {kind}, n int, id long")
        for test in (F.lit(True), F.col("t").isNotNull(), F.col("t") > F.lit("1000-01-01").cast(kind), F.col("n") == 9):
            kept = df.where(test)
            packed = kept.agg(grouping.pick_by("id", ["t", "n", "id"], schema=df.schema, digits={"n": 5}).alias("x"))
            assert packed.collect() == kept.agg(grouping.pick_by("id", ["t", "n", "id"]).alias("x")).collect()
    wide = spark.createDataFrame([(datetime(1998, 1, 1), 70000, 1)], "t timestamp_ntz, n int, id long")
    with pytest.raises(Exception, match="does not fit 5 digits"):
        wide.agg(grouping.pick_by("id", ["t", "n", "id"], schema=wide.schema, digits={"n": 5})).collect()


DATE_TEXTS = st.builds(
    lambda lead, sign, zeros, y, m, d, tail, sep: f"{lead}{sign}{'0' * zeros}{y}{sep}{m}{sep}{d}{tail}",
    st.sampled_from(["", " ", "\t ", "\x7f"]), st.sampled_from(["", "+", "-"]), st.integers(0, 2),
    st.sampled_from([1997, 1998, 1999, 998]), st.sampled_from(["6", "7", "07", "08", "13"]), st.sampled_from(["1", "05", "31", "99"]),
    st.sampled_from(["", " ", "T10:00:00", " 10:00", "x"]), st.sampled_from(["-", "-", "/"]),
)


@BATCHES
@given(rows=st.lists(st.one_of(st.none(), DATE_TEXTS), min_size=20, max_size=60))
def test_month_of_a_text_is_that_of_its_date(spark, rows):
    as_of = date(1998, 7, 15)
    day = dates.clean_date(F.col("x"))
    cleaned = F.coalesce(day.between(date(1998, 7, 1), date(1998, 7, 31)), F.lit(False))
    found = F.coalesce(dates.in_month(F.col("x"), as_of, T.StringType()), F.lit(False))
    assert run(spark, rows, found) == run(spark, rows, cleaned)
