"""Operators against plain-Python results, properties, and groups that hold much of the data."""

import random
from collections import defaultdict
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from duebook.operators import aging, grouping, joins, payments, profile, select, typing_rules

AS_OF = date(1998, 7, 15)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def instalment_rows():
    """A third of all rows belong to sale 0."""
    rng = random.Random(7)
    rows = []
    for n in range(3000):
        sale = 0 if n % 3 == 0 else rng.randrange(1, 200)
        due = AS_OF + timedelta(days=rng.randrange(-400, 400))
        balance = Decimal(rng.choice([0, rng.randrange(1, 10**6)])) / 100
        rows.append((sale, rng.choice(["N", "X"]), rng.randrange(1, 9), due, Decimal(rng.randrange(10**6)) / 100, balance))
    return rows


INSTALMENT = "sale_id int, kind string, number int, due_on date, billed decimal(18,2), balance decimal(18,2)"


def test_aging_matches_brute_force(spark, instalment_rows):
    groups = defaultdict(list)
    for row in instalment_rows:
        groups[row[0]].append(row[1:])
    expected = {}
    for sale, rows in groups.items():
        late = [r for r in rows if r[4] != 0 and r[2] < AS_OF]
        ahead = [r for r in rows if r[4] != 0 and r[2] >= AS_OF]
        monthly = [r for r in rows if r[0] == "N"]
        overdue = sum((r[4] for r in late), Decimal(0))
        upcoming = min(((r[2], r[1], r[4]) for r in ahead), default=None)
        expected[sale] = (
            min((r[2] for r in late), default=None),
            overdue,
            overdue + (upcoming[2] if upcoming else 0),
            sum((r[3] for r in late), Decimal(0)),
            min((r[2] for r in ahead), default=None),
            min((r[1] for r in ahead), default=None),
            max((r[2].day for r in monthly), default=None),
            min(((r[2], r[1], r[3]) for r in monthly), default=(None,) * 3)[2],
        )
    df = spark.createDataFrame(instalment_rows, INSTALMENT).repartition(6)
    got = {r[0]: tuple(r)[1:] for r in aging.aging(df, AS_OF, ["sale_id"], "N").collect()}
    assert got == expected


def test_required_total_is_overdue_plus_next_due(spark, instalment_rows):
    df = spark.createDataFrame(instalment_rows, INSTALMENT)
    figures = df.groupBy("sale_id").agg(
        aging.overdue_balance(AS_OF).alias("a"),
        F.coalesce(aging.next_due_balance(AS_OF), F.lit(0)).alias("b"),
        aging.required_total(AS_OF).alias("c"),
    )
    assert figures.where("a + b <> c").isEmpty()


def payment_frames(spark):
    paid = [
        (1, 10, date(1998, 7, 1), Decimal("100.00"), Decimal("1.00"), "cash"),
        (1, 10, date(1998, 7, 1), Decimal("100.00"), Decimal("2.00"), "cash"),
        (2, 10, date(1998, 7, 2), Decimal("50.00"), Decimal("0.00"), "card"),
        (3, 11, date(1998, 7, 3), Decimal("70.00"), None, None),
    ]
    flow = [(1, 10, Decimal("60.00"), "rent"), (1, 10, Decimal("40.00"), "rent"), (1, 10, Decimal("5.00"), "fee")]
    flow += [(2, 10, Decimal("50.00"), None), (9, 9, Decimal("1.00"), "lost")]
    return (
        spark.createDataFrame(
            paid, "payment_id int, sale_id int, paid_on date, amount decimal(18,2), surcharge decimal(18,2), pay_form string"
        ),
        spark.createDataFrame(flow, "payment_id int, sale_id int, flow_amount decimal(18,2), flow_concept string"),
    )


KEY = ["payment_id", "sale_id"]


def test_payment_rollup_never_multiplies_amounts(spark):
    paid, flow = payment_frames(spark)
    got = payments.payment_rollup(paid, flow, keys=KEY)
    assert rows_of(got.select("payment_id", "surcharge", "amount", "flow_concepts")) == sorted(
        [
            (1, Decimal("1.00"), Decimal("100.00"), "fee, rent"),
            (1, Decimal("2.00"), Decimal("100.00"), "fee, rent"),
            (2, Decimal("0.00"), Decimal("50.00"), None),
            (3, None, Decimal("70.00"), None),
        ],
        key=repr,
    )


@pytest.mark.parametrize(("amount", "rent"), [("min", "40.00"), ("sum", "100.00")])
def test_concept_rollup(spark, amount, rent):
    paid, flow = payment_frames(spark)
    got = payments.payment_rollup(paid, flow, grain="concept", amount=amount, keys=KEY)
    one = got.where("payment_id = 1 and surcharge = 1").select("flow_concept", "amount")
    assert rows_of(one) == [("fee", Decimal("5.00")), ("rent", Decimal(rent))]
    assert rows_of(got.where("payment_id = 3").select("flow_concept", "amount")) == [(None, None)]


def test_rollup_rejects_unknown_options(spark):
    paid, flow = payment_frames(spark)
    with pytest.raises(ValueError):
        payments.payment_rollup(paid, flow, grain="day", keys=KEY)
    with pytest.raises(ValueError):
        payments.payment_rollup(paid, flow, amount="avg", keys=KEY)


def test_left_join_many_equals_left_join_with_a_hot_key(spark):
    left = spark.createDataFrame([(i, f"p{i}") for i in range(50)] + [(None, "none")], "k int, p string")
    right = spark.createDataFrame(
        [(7 if i % 3 else i % 40, i) for i in range(900)] + [(None, -1), (999, -2)], "k int, d int"
    )
    assert rows_of(joins.left_join_many(left, right, ["k"])) == rows_of(left.join(right, ["k"], "left"))


def test_lookup_chain_uses_columns_taken_before(spark):
    fact = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "id int, a int")
    first = spark.createDataFrame([(5, 50), (6, 60)], "a int, b int")
    second = spark.createDataFrame([(50, "x")], "b int, name string")
    got = joins.lookup_chain(
        fact, [joins.Lookup(first, {"a": "a"}, {"b": "b"}), joins.Lookup(second, {"b": "b"}, {"name": "name"})]
    )
    assert rows_of(got) == sorted([(1, 5, 50, "x"), (2, 6, 60, None), (3, None, None, None)], key=repr)


def dimension(spark):
    return spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)], "raw string, brand int")


def test_conform_fans_out_by_default(spark):
    fact = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "name string")
    got = joins.conform(fact, dimension(spark), ("name", "raw"), {"brand": "brand"})
    assert rows_of(got) == sorted([("a", 1), ("a", 2), ("b", 3), ("c", None), (None, None)], key=repr)


def test_conform_can_fail_on_duplicates(spark):
    fact = spark.createDataFrame([("a",), ("b",)], "name string")
    strict = joins.conform(fact, dimension(spark), ("name", "raw"), {"brand": "brand"}, fail_on_dup=True)
    with pytest.raises(PySparkException, match="duplicate dimension key: a"):
        strict.collect()
    clean = dimension(spark).where("brand <> 2")
    assert rows_of(joins.conform(fact, clean, ("name", "raw"), {"brand": "brand"}, fail_on_dup=True)) == [
        ("a", 1),
        ("b", 3),
    ]


def test_latest_by_is_fixed_for_repeated_ids(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "z"), (2, None, "n")], "k int, id int, v string")
    assert rows_of(grouping.latest_by(df, ["k"], "id", ["v"])) == [(1, 5, "b"), (2, None, "n")]


def test_name_chunks_are_ordered_and_whole(spark):
    people = [(k, f"n{i:04d}") for k in (1, None) for i in range(57)] * 2 + [(2, " "), (3, None), (1, "n0003"), (4, "x")]
    df = spark.createDataFrame(people, "k int, f string").repartition(7)
    rows = grouping.name_chunks(df, ["k"], ["f"], size=10).collect()
    assert all(len(r.names) <= 10 for r in rows) and {r.k for r in rows} == {1, None, 4}
    for key in (1, None):
        own = sorted((r for r in rows if r.k == key), key=lambda r: r.chunk)
        assert [r.chunk for r in own] == list(range(6)) and [len(r.names) for r in own] == [10] * 5 + [7]
        assert [n for r in own for n in r.names] == [f"n{i:04d}" for i in range(57)]
        times = {n: t for r in own for n, t in zip(r.names, r.counts, strict=True)}
        assert times["n0003"] == (3 if key == 1 else 2) and times["n0004"] == 2
    assert grouping.name_chunks(df.where("false"), ["k"], ["f"]).count() == 0


def test_list_names_raises_beyond_its_cell(spark):
    df = spark.createDataFrame([(1, "abc"), (1, "abc"), (None, "abcdefgh"), (2, None)], "k int, f string")
    fitting = grouping.list_names(df, ["k"], ["f"], "names", cell_chars=8).collect()
    assert {tuple(r) for r in fitting} == {(None, "abcdefgh"), (1, "abc, abc"), (2, None)} and len(fitting) == 3
    with pytest.raises(Exception, match="more than 7 characters"):
        grouping.list_names(df, ["k"], ["f"], "names", cell_chars=7).collect()


def test_list_names_counts_repeats_and_skips_blanks(spark):
    df = spark.createDataFrame(
        [(1, "b", None), (1, "a", " x "), (1, "a", "x"), (1, " ", ""), (2, None, None)], "k int, f string, l string"
    )
    assert rows_of(grouping.list_names(df, ["k"], ["f", "l"], "names")) == [(1, "a x, a x, b"), (2, None)]


def test_list_distinct_hot_key(spark):
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), (F.col("id") % 5).cast("string").alias("c")
    )
    got = df.groupBy("k").agg(grouping.list_distinct(F.col("c")).alias("l")).where("k = 0").collect()
    assert [tuple(r) for r in got] == [(0, "0, 1, 2, 3, 4")]


def test_milestone_and_max_per_key(spark):
    df = spark.createDataFrame(
        [(1, "Approved x", "2024-02-02"), (1, "APPROVED y", "2024-01-02"), (2, "other", "2024-01-01")],
        "k int, s string, d string",
    ).withColumn("d", F.to_date("d"))
    assert rows_of(grouping.milestone(df, ["k"], "s", "d", "approved", "on")) == [(1, date(2024, 1, 2)), (2, None)]
    assert rows_of(grouping.max_per_key(df, ["k"], "d", "m")) == [(1, date(2024, 2, 2)), (2, date(2024, 1, 1))]


def test_dedupe_is_idempotent(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    once = grouping.dedupe(df)
    assert rows_of(once) == rows_of(grouping.dedupe(once)) == sorted([(1, None), (2, "x")], key=repr)


def test_sort_created_puts_unknown_dates_first(spark):
    df = spark.createDataFrame([(2, date(2024, 1, 1)), (1, date(2024, 1, 1)), (3, None)], "id int, created_on date")
    assert [r[0] for r in select.sort_created(df, ties=["id"]).collect()] == [3, 1, 2]


WORDS = {"date": ["_on"], "money": ["total"], "integer": ["_id", "number"], "text": ["ri"]}


def test_category_first_match_in_fixed_order():
    assert typing_rules.category("total_number", WORDS) == "money"
    assert typing_rules.category("Total", WORDS) is None
    assert typing_rules.category("price", WORDS) == "text"
    assert typing_rules.category("account_number", WORDS, {"account_number": "text"}) == "text"
    assert typing_rules.category(" sale_id ", WORDS) == "integer"


def test_partial_matches_are_reported():
    assert typing_rules.partial_matches(["price", "sale_id", "x"], WORDS) == {"price": "ri"}


def test_normalise_is_idempotent_and_keeps_order(spark):
    df = spark.createDataFrame(
        [("03/04/2024", "$1,5", "7.0", " a ", 1), (None, None, None, None, None)],
        "paid_on string, total string, sale_id string, price string, other int",
    )
    once = typing_rules.normalise(df, WORDS)
    assert once.columns == df.columns
    assert [f.dataType.simpleString() for f in once.schema] == ["timestamp_ntz", "double", "bigint", "string", "int"]
    assert rows_of(typing_rules.normalise(once, WORDS)) == rows_of(once)
    assert once.schema["total"].metadata == {"category": "money"}


def test_normalise_dotted_names(spark):
    df = spark.createDataFrame([("5",)], "`a.total` string")
    assert rows_of(typing_rules.normalise(df, WORDS)) == [(5.0,)]


def test_integer_rejects(spark):
    df = spark.createDataFrame([("1.5", "1"), ("2", "0.5"), ("x", "2.5")], "a_id string, number string")
    assert rows_of(typing_rules.integer_rejects(df, WORDS)) == [(1, 2)]


def test_width_profile(spark):
    df = spark.createDataFrame(
        [("x" * 100, 0, 1.50, date(2024, 1, 1), ""), ("", 0, 0.0, None, None)],
        "wide string, zero int, price double, day date, none string",
    )
    got = {r["column"]: r["width"] for r in profile.width_profile(df).collect()}
    assert got == {
        "wide": 50.0,
        "zero": 8.0,
        "price": 8.0,
        "day": pytest.approx((19 + 2) * 1.1),
        "none": 8.0,
    }
