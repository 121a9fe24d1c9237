"""Edge rules of the column expressions."""

from datetime import date, datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duebook.functions import dates, keys, money, predicates, text


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def one(spark, values_, column, schema="x string"):
    return values(spark, [(v,) for v in values_], schema, column)


NAMES = "a string, b string, c string"


def test_person_name_null_part_is_empty_text(spark):
    rows = [("ana", None, "ruiz"), ("ana", "", "ruiz"), (None, None, None), ("ana  maria", "gar-za", "d.e")]
    name = text.person_name(F.col("a"), F.col("b"), F.col("c"))
    assert values(spark, rows, NAMES, name) == ["Ana  Ruiz", "Ana  Ruiz", "", "Ana  Maria Garza De"]


def test_person_name_strict_propagates_null(spark):
    rows = [("ana", None, "ruiz"), ("ana-maria", "gar-za", "o.x")]
    name = text.person_name(F.col("a"), F.col("b"), F.col("c"), nulls="propagate", surname_strip="")
    assert values(spark, rows, NAMES, name) == [None, "Ana-Maria Gar-Za O.X"]


def test_person_name_rejects_unknown_null_rule():
    with pytest.raises(ValueError):
        text.person_name(F.lit("a"), F.lit("b"), F.lit("c"), nulls="drop")


def test_title_words_restarts_after_punctuation_and_white_space(spark):
    got = one(spark, ["ana-maria o'neil", "A\tb\nC", "x(y)z/q", "MIXED Case", "", None], text.title_words(F.col("x")))
    assert got == ["Ana-Maria O'neil", "A\tB\nC", "X(Y)Z/Q", "Mixed Case", "", None]


def test_title_words_with_space_only(spark):
    assert one(spark, ["ana-MARIA x"], text.title_words(F.col("x"), " ")) == ["Ana-maria X"]


def test_title_words_keeps_letters_without_a_capital(spark):
    assert one(spark, ["ßa aß-ßb", "ŉx"], text.title_words(F.col("x"))) == ["ßa Aß-ßb", "ŉx"]
    assert one(spark, ["ßa aß ßb"], text.title_words_split(F.col("x"))) == ["ßa Aß ßb"]


def test_trim_text_takes_unicode_white_space(spark):
    assert one(spark, ["   a b　\n", None], text.trim_text(F.col("x"))) == ["a b", None]


def test_strip_tokens(spark):
    rows = ["Linus Lin", "xLinx.", None]
    assert one(spark, rows, text.strip_tokens(F.col("x"), ["Lin", "."])) == ["us", "xx", None]
    assert one(spark, rows, text.strip_tokens(F.col("x"), ["Lin", "."], regex=True)) == ["us", "xx", None]
    assert one(spark, rows, text.strip_tokens(F.col("x"), ["Lin"], whole_word=True)) == ["Linus", "xLinx.", None]
    assert one(spark, [" a "], text.strip_tokens(F.col("x"), [])) == ["a"]


def test_strip_tokens_one_by_one_differs_from_alternation(spark):
    assert one(spark, ["aXbYc"], text.strip_tokens(F.col("x"), ["X", "bY"])) == ["ac"]
    assert one(spark, ["aXbc"], text.strip_tokens(F.col("x"), ["X", "ab"])) == ["c"]
    assert one(spark, ["aXbc"], text.strip_tokens(F.col("x"), ["X", "ab"], regex=True)) == ["abc"]


def test_fold_accents_leaves_capitals_and_umlauts(spark):
    assert one(spark, ["áéíóúñ ÁÑ ü"], text.fold_accents(F.col("x"))) == ["aeioun ÁÑ ü"]


def test_full_name_skips_blanks(spark):
    rows = [(" ana ", "", "ruiz"), ("", " ", None), (None, None, None), ("a b", "c", " d")]
    name = text.full_name(F.col("a"), F.col("b"), F.col("c"))
    assert values(spark, rows, NAMES, name) == ["ana ruiz", None, None, "a b c d"]


def test_clean_date(spark):
    rows = ["0000-00-00", None, "2024-01-02", "2024-01-02 10:00:00", "03/04/2024", "2300-01-01", ""]
    expected = [None, None, date(2024, 1, 2), date(2024, 1, 2), None, date(2300, 1, 1), None]
    assert one(spark, rows, dates.clean_date(F.col("x"))) == expected


def test_in_month_bounds_and_null(spark):
    rows = [date(1998, 6, 30), date(1998, 7, 1), date(1998, 7, 31), date(1998, 8, 1), date(1997, 7, 9), None]
    got = one(spark, rows, dates.in_month(F.col("x"), date(1998, 7, 15)), "x date")
    assert got == [False, True, True, False, False, None]
    assert dates.month_bounds(date(2023, 12, 31)) == (date(2023, 12, 1), date(2024, 1, 1))


def test_in_month_on_timestamps_keeps_the_last_day_whole(spark):
    rows = [datetime(1998, 7, 31, 23, 59, 59), datetime(1998, 8, 1)]
    assert one(spark, rows, dates.in_month(F.col("x"), date(1998, 7, 1)), "x timestamp_ntz") == [True, False]


def test_norm_date(spark):
    rows = [
        "0000-00-00", None, "2024-01-02", "2024-01-02 10:00:00", "03/04/2024", "3/4/2024", "2300-01-01",
        "2024-01-02T10:00:00+05:00", "2024-01-02T10:00:00.5Z", "31/02/2024", "junk", " 2024-01-02 ", "05-04-2024",
    ]
    got = one(spark, rows, dates.norm_date(F.col("x"), T.StringType()))
    assert got == [
        None, None, datetime(2024, 1, 2), datetime(2024, 1, 2, 10), datetime(2024, 4, 3), None,
        datetime(2300, 1, 1), datetime(2024, 1, 2, 10), datetime(2024, 1, 2, 10, 0, 0, 500000), None, None,
        datetime(2024, 1, 2), datetime(2024, 4, 5),
    ]


def test_norm_date_with_a_time_format(spark):
    got = one(spark, ["03/04/2024 05:06"], dates.norm_date(F.col("x"), T.StringType(), ("dd/MM/yyyy HH:mm",)))
    assert got == [datetime(2024, 4, 3, 5, 6)]


def test_norm_money(spark):
    rows = ["$1,234.50", "(500)", "12-34", "1.2.3", "1..5", "1E+5", "-$5", None, "", "2.675", "0.125"]
    got = one(spark, rows, money.norm_money(F.col("x"), T.StringType()))
    assert got == [1234.5, 500.0, None, None, 1.5, 15.0, -5.0, None, None, 2.68, 0.12]


def test_norm_money_on_numbers_only_rounds(spark):
    numbers = [1.005, -2.345, 2.675, 0.125, 1e12 + 0.005]
    got = one(spark, numbers, money.norm_money(F.col("x"), T.DoubleType()), "x double")
    assert got == pd.Series(numbers).round(2).tolist()


def test_norm_int_and_rejects(spark):
    rows = ["007", "x", None, "1.5", "2.0", " 8 ", "-3", "1e3", "", "1E20"]
    assert one(spark, rows, money.norm_int(F.col("x"))) == [7, 0, 0, 0, 2, 8, -3, 1000, 0, 0]
    assert one(spark, rows, money.is_rejected(F.col("x"))) == [v in ("1.5", "1E20") for v in rows]


def test_cap_keeps_amount_on_null(spark):
    rows = [(5, 3), (5, None), (None, 3), (2, 3)]
    assert values(spark, rows, "a int, b int", money.cap(F.col("a"), F.col("b"))) == [3, 5, None, 2]


def test_funds(spark):
    rows = [(10.0, None, None, None), (10.0, 1.0, None, None), (10.0, None, None, 0.0)]
    cols = [F.col(c) for c in "bcd"]
    schema = "a double, b double, c double, d double"
    assert values(spark, rows, schema, money.future_funds(F.col("a"), *cols)) == [10.0, 0.0, 0.0]
    assert values(spark, rows, schema, money.fund_split(*cols)[0]) == [0.0, 1.0, 0.0]


def test_safe_unit_price(spark):
    rows = [(10.0, 4.0), (10.0, 0.0), (10.0, -1.0), (10.0, None), (None, 2.0)]
    got = values(spark, rows, "p double, s double", money.safe_unit_price(F.col("p"), F.col("s")))
    assert got == [2.5, 0.0, 0.0, 0.0, 0.0]


def test_amount_if_month(spark):
    rows = [(5, date(1998, 7, 2)), (5, date(1998, 6, 2)), (5, None)]
    got = values(spark, rows, "a int, d date", money.amount_if_month(F.col("a"), F.col("d"), date(1998, 7, 9)))
    assert got == [5, 0, 0]


def test_unit_keys(spark):
    rows = [("A", "1", "x"), ("A", None, "x"), ("B", "1", "x"), ("B", "1", None), (None, "1", "x")]
    plain = keys.unit_key(F.col("a"), F.col("b"))
    staged = keys.unit_key_staged(F.col("a"), F.col("b"), F.col("c"), ["B"], F.col("a"))
    assert values(spark, rows, NAMES, plain) == ["A 1", None, "B 1", "B 1", None]
    assert values(spark, rows, NAMES, staged) == ["A 1", None, "B 1 x", None, None]


def test_staged_test_on_another_name_null_gives_plain_key(spark):
    staged = keys.unit_key_staged(F.lit("raw"), F.lit("1"), F.lit("s"), ["B"], F.col("x"))
    assert one(spark, ["B", None], staged) == ["raw 1 s", "raw 1"]


def test_labels_and_small_helpers(spark):
    assert one(spark, ["a", "b", None], keys.label_map(F.col("x"), {"a": "A"})) == ["A", None, None]
    assert one(spark, ["7", None], keys.prefix_ref(F.col("x"), "R_")) == ["R_7", None]
    assert one(spark, [11, None], keys.financed_months(F.col("x")), "x int") == [12, None]
    assert one(spark, ["a", None], keys.only_if_known(F.col("x"), F.lit(1))) == [1, None]


def kept(spark, rows, predicate):
    return [r[0] for r in spark.createDataFrame([(v,) for v in rows], "x string").where(predicate).collect()]


def test_filters_drop_null(spark):
    rows = ["a demo", "b", None, "Demo"]
    assert kept(spark, rows, predicates.exclude_contains(F.col("x"), ["demo"])) == ["b", "Demo"]
    assert kept(spark, rows, predicates.exclude_values(F.col("x"), ["b"])) == ["a demo", "Demo"]
    assert kept(spark, rows, predicates.exclude_contains(F.col("x"), [])) == rows
    assert kept(spark, rows, predicates.exclude_values(F.col("x"), [])) == rows
    assert kept(spark, rows, predicates.starts_ci(F.col("x"), "DE")) == ["Demo"]


def test_exclude_pair_is_three_valued(spark):
    rows = [("x", "y"), ("x", None), (None, "y"), ("z", None), (None, "w"), ("x", "w")]
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.where(predicates.exclude_pair(F.col("a"), "x", F.col("b"), "y")).collect()
    assert [tuple(r) for r in got] == [("z", None), (None, "w"), ("x", "w")]
