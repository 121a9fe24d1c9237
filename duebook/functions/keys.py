"""Unit keys, references, tags and labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def unit_key(development: Column, unit: Column) -> Column:
    """``development unit``; NULL when a part is (``concat``, not ``concat_ws``)."""
    return F.concat(development, F.lit(" "), unit)


def unit_key_staged(
    development: Column, unit: Column, stage: Column, staged: Sequence[str], test: Column
) -> Column:
    """As :func:`unit_key`, with the stage appended where ``test`` is a listed development."""
    plain = unit_key(development, unit)
    if not staged:
        return plain
    return F.when(test.isin(*staged), F.concat(plain, F.lit(" "), stage)).otherwise(plain)


def prefix_ref(col: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), col)


def financed_months(instalments: Column) -> Column:
    return instalments + F.lit(1)


def only_if_known(known: Column, value: Column) -> Column:
    return F.when(known.isNotNull(), value)


def label_map(col: Column, labels: Mapping[str, str]) -> Column:
    """The label of a listed group, NULL for any other."""
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(labels.items())])
    return F.try_element_at(pairs, col)
