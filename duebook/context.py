"""What a report needs besides its tables: the as-of date and the caller's business rules."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from datetime import date

from pyspark.sql import DataFrame

from duebook.session import shuffling_in
from duebook.sinks.writer import written_once
from duebook.sources.registry import Registry


@dataclass(frozen=True)
class Rules:
    """Business constants. All of them come from the caller; none is built in.

    A rule left at ``None`` or empty filters nothing. ``active_status``, ``monthly_kind`` and
    ``milestone_prefix`` have no neutral value: a report that needs one raises without it.
    """

    reference_prefix: str = ""
    statement_prefix: str = ""
    sale_statuses: tuple[int | str, ...] | None = None
    active_status: int | str | None = None
    monthly_kind: str | None = None
    milestone_prefix: str | None = None
    seller_tokens: tuple[str, ...] = ()
    staged_developments: tuple[str, ...] = ()
    staged_sources: tuple[str, ...] | None = None
    excluded_client_fragments: tuple[str, ...] = ()
    excluded_seller_fragments: tuple[str, ...] = ()
    excluded_developments: tuple[str, ...] = ()
    excluded_banks: tuple[str, ...] = ()
    excluded_user: str | None = None
    excluded_development: str | None = None
    excluded_section: tuple[str, str] | None = None
    coowner_source: str = "client"
    coowner_keys: Mapping[str, str] = field(default_factory=dict)
    concept_amount: str = "min"
    fail_on_duplicate_dimension: bool = False

    def required(self, name: str) -> int | str:
        """A rule without a neutral value."""
        value = getattr(self, name)
        if value is None or value == "":
            raise ValueError(f"this report needs the rule {name}")
        return value


@dataclass(frozen=True)
class Context:
    registry: Registry
    as_of: date
    rules: Rules = Rules()
    steps: dict[str, DataFrame] | None = field(default=None, compare=False, repr=False)
    parts: int | None = None

    def sharing(self) -> Context:
        """The same, with tables that several reports or several places of one need written once."""
        return replace(self, steps={})

    def once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """``build()``: its plan, or where steps are shared the table it was written to at first use."""
        if self.steps is None:
            return build()
        if name not in self.steps:
            self.steps[name] = written_once(build())
        return self.steps[name]

    def at_size(self, df: DataFrame) -> DataFrame:
        """``df``: its plan, or where ``parts`` is set the table it was written to by jobs that shuffle in as many
        parts. The session's number holds for whatever runs later, however large the tables have become."""
        if self.parts is None:
            return df
        with shuffling_in(self.registry.spark, self.parts):
            return written_once(df)
