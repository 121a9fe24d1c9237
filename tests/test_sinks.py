from datetime import date
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from duebook.operators.profile import width_profile
from duebook.operators.typing_rules import integer_rejects, normalise
from duebook.plans.runner import Planned, write_reports
from duebook.sinks import manifest
from duebook.sinks.display import render
from duebook.sinks.metrics import metrics_table
from duebook.sinks.manifest import current, entries, publish, read_report
from duebook.sinks.writer import report_path, shared_folder, write_report

AS_OF = date(2024, 3, 9)


def test_path_is_dated():
    assert report_path("/r", "x", AS_OF, "run") == "/r/run-2024-03-09/x"


def test_write_and_overwrite(spark, tmp_path):
    path = write_report(spark.range(5), str(tmp_path), "x", AS_OF)
    assert spark.read.parquet(path).count() == 5
    write_report(spark.range(3), str(tmp_path), "x", AS_OF)
    assert spark.read.parquet(path).count() == 3


def test_empty_report_is_skipped(spark, tmp_path):
    empty = spark.range(5).where("id > 9")
    assert write_report(empty, str(tmp_path), "x", AS_OF) is None
    assert not (tmp_path / "reports-2024-03-09" / "x").exists()
    kept = write_report(empty, str(tmp_path), "y", AS_OF, skip_empty=False)
    assert spark.read.parquet(kept).count() == 0


def test_empty_or_failing_rerun_keeps_the_earlier_report(spark, tmp_path):
    path = write_report(spark.range(5), str(tmp_path), "x", AS_OF)
    assert write_report(spark.range(5).where("id > 9"), str(tmp_path), "x", AS_OF) is None
    assert spark.read.parquet(path).count() == 5
    failing = spark.range(5).select(F.when(F.col("id") > 3, F.raise_error(F.lit("boom"))).otherwise("a").alias("id"))
    with pytest.raises(Exception, match="boom"):
        write_report(failing, str(tmp_path), "x", AS_OF)
    assert spark.read.parquet(path).count() == 5
    assert [p.name for p in (tmp_path / "reports-2024-03-09").iterdir() if not p.name.startswith(".")] == ["x"]


class Died(Exception):
    pass


def test_readers_find_a_whole_report_whatever_step_a_run_dies_at(spark, tmp_path, monkeypatch):
    root, path = str(tmp_path), report_path(str(tmp_path), "x", AS_OF)

    def seen():
        return read_report(spark, root, "x", AS_OF).count() if current(spark, path) else None

    assert seen() is None
    with pytest.raises(FileNotFoundError):
        read_report(spark, root, "x", AS_OF)
    failing = spark.range(9).select(F.when(F.col("id") > 3, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).alias("id"))
    for before, rows in ((None, 5), (5, 3)):
        with pytest.raises(Exception, match="boom"):  # while the rows are written
            publish(failing, root, "x", AS_OF)
        assert seen() == before
        for step in ("current", "log"):  # after the rows, and after the manifest

            def die(*_):
                raise Died

            with monkeypatch.context() as m, pytest.raises(Died):
                m.setattr(manifest, "current", die) if step == "current" else m.setattr(manifest.log, "info", die)
                publish(spark.range(rows), root, "x", AS_OF)
            assert seen() == (before if step == "current" else rows)
    assert publish(spark.range(0), root, "x", AS_OF) is None and seen() == 3
    assert publish(spark.range(0), root, "x", AS_OF, skip_empty=False) and seen() == 0
    assert read_report(spark, root, "x", AS_OF, version=1).count() == 5
    assert [r.row_count for r in entries(spark, path).orderBy("version").collect()] == [5, 3, 0]


def test_published_text_comes_back_with_its_columns(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a,b"), (2, None)], "n long, t string")
    publish(frame, str(tmp_path), "x", AS_OF, format="csv")
    again = read_report(spark, str(tmp_path), "x", AS_OF)
    assert again.schema == frame.schema and sorted(map(tuple, again.collect())) == [(1, "a,b"), (2, None)]


def test_sorted_report_keeps_its_order_in_files(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("n")).orderBy("n")
    path = write_report(df, str(tmp_path), "x", AS_OF)
    # Part files are numbered in order and each is sorted.
    parts = sorted((tmp_path / "reports-2024-03-09" / "x").glob("part-*.parquet"))
    got = [r[0] for p in parts for r in spark.read.parquet(str(p)).collect()]
    assert path.endswith("/x") and got == sorted(got)


def test_render_by_category(spark):
    df = spark.createDataFrame(
        [("2024-01-02", "-1234.5", "7", " a "), (None, None, None, None)],
        "paid_on string, total string, sale_id string, price string",
    )
    typed = normalise(df, {"date": ["_on"], "money": ["total"], "integer": ["_id"], "text": ["price"]})
    assert [tuple(r) for r in render(typed).collect()] == [
        ("02/01/2024", "-$1,234.50", "7", "a"),
        (None, None, "0", ""),
    ]


def test_the_write_pass_counts_what_typing_could_not_keep(spark, tmp_path):
    rows = [("2024-01-02", "-1234.5", "7.5", 2, " a "), ("0000-00-00", "abc", "x", 3, "bb"), (None, "", "3", None, None)]
    rows.append(("gone", "0", "99999999999999999999", 4, "c" * 90))
    schema = "paid_on string, total string, sale_id string, own_id int, name string"
    frame = spark.createDataFrame(rows, schema).orderBy("sale_id")
    nothing = frame.where("total = 'none'")
    failing = frame.withColumn("sale_id", F.raise_error(F.lit("boom")))
    batch = Planned({"x": frame, "nothing": nothing, "failing": failing})
    words = {"date": ["_on"], "money": ["tot"], "integer": ["_id"], "text": ["name"]}
    ctx = SimpleNamespace(as_of=AS_OF)
    done = write_reports(ctx, batch, str(tmp_path), keywords=words, format="csv", display=True)
    assert list(done.written) == ["x"] and done.empty == ["nothing"] and list(done.failed) == ["failing"]
    assert set(done.metrics) == {"x", "nothing"} and done.metrics["nothing"].rows == 0
    seen = done.metrics["x"]
    assert seen.rows == 4
    assert seen.rejects == {"sale_id": integer_rejects(frame, words).first()[0]} == {"sale_id": 2}
    assert seen.unread == {"paid_on": 1, "total": 1, "sale_id": 1}
    assert seen.partial == {"total": "tot"}
    assert seen.widths == {r[0]: r[1] for r in width_profile(normalise(frame, words)).collect()}
    shown = spark.read.option("header", True).csv(done.written["x"]).where("total is not null").collect()
    assert sorted((r.total, r.sale_id) for r in shown) == [("$0.00", "0"), ("-$1,234.50", "0")]
    # As values and by the manifest the counts are the same.
    typed = write_reports(ctx, batch, str(tmp_path), keywords=words, prefix="typed", write=publish)
    assert typed.metrics == done.metrics
    table = metrics_table(spark, typed.metrics)
    assert table.count() == 10 and table.where("rejects > 0").first()["column"] == "sale_id"


def test_csv_export_of_display_text(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    path = write_report(render(df), str(tmp_path), "x", AS_OF, format="csv")
    assert spark.read.option("header", True).csv(path).collect()[0].asDict() == {"a": "1", "b": "x"}


class Session:
    """The two things the folder choice looks at."""

    def __init__(self, master, **options):
        self.sparkContext = SimpleNamespace(master=master)
        self.conf = SimpleNamespace(get=lambda key, default: options.get(key.replace(".", "_"), default))


def test_shared_folder_is_the_one_the_session_names(spark):
    named = Session("yarn", spark_checkpoint_dir="hdfs:///shared/")
    first, second = shared_folder(named), shared_folder(named)
    assert first.startswith("hdfs:///shared/") and "//" not in first[7:].lstrip("/") and first != second
    assert shared_folder(spark).startswith("/")


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="checkpoint"):
        shared_folder(Session("yarn"))
