"""The report registry and the batch run."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from duebook.context import Context
from duebook.operators.typing_rules import REPORT_KEYWORDS, Keywords
from duebook.plans.flat import income_flat, overdue_portfolio, statement_flat
from duebook.plans.fund_split import income_fund_split
from duebook.plans.income import income_by_concept, income_sales
from duebook.plans.statement import statement_sales
from duebook.sinks.display import render
from duebook.sinks.metrics import ReportMetrics, watched
from duebook.sinks.writer import write_report

log = logging.getLogger(__name__)

REPORTS: dict[str, Callable[[Context], DataFrame]] = {
    "overdue_portfolio": overdue_portfolio,
    "statement_flat": statement_flat,
    "income_flat": income_flat,
    "income_fund_split": income_fund_split,
    "statement_sales": statement_sales,
    "income_sales": income_sales,
    "income_by_concept": income_by_concept,
}


@dataclass
class Planned:
    """Lazy frames by report name, and the reports that could not be planned with their errors."""

    frames: dict[str, DataFrame] = field(default_factory=dict)
    failed: dict[str, str] = field(default_factory=dict)


@dataclass
class BatchResult:
    """Every report of the batch is in exactly one of the first three; ``metrics`` holds those that ran."""

    written: dict[str, str] = field(default_factory=dict)
    empty: list[str] = field(default_factory=list)
    failed: dict[str, str] = field(default_factory=dict)
    metrics: dict[str, ReportMetrics] = field(default_factory=dict)


def run_reports(
    ctx: Context,
    names: Iterable[str] | None = None,
    reports: Mapping[str, Callable[[Context], DataFrame]] = REPORTS,
) -> Planned:
    """Plan every report; one that cannot be planned is logged and listed as failed.

    What several reports start from, the month's approved payments, is written once for the batch.
    """
    planned, ctx = Planned(), ctx.sharing()
    for name in reports if names is None else names:
        try:
            planned.frames[name] = reports[name](ctx)
        except Exception as error:
            log.exception("report %s could not be built", name)
            planned.failed[name] = str(error)
    return planned


def write_reports(
    ctx: Context,
    planned: Planned,
    root: str,
    *,
    keywords: Keywords = REPORT_KEYWORDS,
    overrides: Mapping[str, str] | None = None,
    prefix: str = "reports",
    concurrent: int = 1,
    format: str = "parquet",
    display: bool = False,
    write: Callable[..., str | None] = write_report,
) -> BatchResult:
    """Type and write every report. Plans run here, so one may fail here too: the others
    still run, and a failed one is never listed as written.

    ``concurrent`` reports run at a time, each in a scheduler pool of its own name, so that under fair
    scheduling a small one does not wait for a large one. ``write`` may be ``manifest.publish``.
    ``display`` writes the text a reader sees instead of typed values, for ``format="csv"`` say. What typing
    could not keep is counted by the write itself, returned in ``metrics`` and logged.
    """
    result = BatchResult(failed=dict(planned.failed))

    def one(name: str, frame: DataFrame) -> tuple[str | None, ReportMetrics]:
        frame.sparkSession.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        typed, metrics = watched(frame, keywords, overrides)
        shown = render(typed) if display else typed
        path = write(shown, root, name, ctx.as_of, prefix=prefix, format=format)
        return path, metrics()

    with ThreadPoolExecutor(max_workers=concurrent) as pool:
        jobs = {
            name: pool.submit(inheritable_thread_target(frame.sparkSession)(one), name, frame)
            for name, frame in planned.frames.items()
        }
    for name, job in jobs.items():
        try:
            path, result.metrics[name] = job.result()
        except Exception as error:
            log.error("report %s could not be written", name, exc_info=error)
            result.failed[name] = str(error)
            continue
        for kind in ("rejects", "unread"):
            lost = {column: n for column, n in getattr(result.metrics[name], kind).items() if n}
            if lost:
                log.warning("report %s: values that typing could not keep (%s): %s", name, kind, lost)
        if path is None:
            result.empty.append(name)
        else:
            result.written[name] = path
    return result
