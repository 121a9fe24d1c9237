"""Several ordered columns as one number, so that min and max run over a fixed-width value.

A minimum over a struct is planned with a sort of every map task's rows, one over a number with a hash
table. Each column gets a number of decimal digits, in order; the numbers sort as the columns do, NULL
first. Up to 18 digits together fit a bigint, up to 38 a decimal.

A value outside its digits raises an error; nothing is cut off silently. A caller whose values do
not fit uses the struct form (``pick_by`` without ``schema``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_DIGITS = 38
LONG_DIGITS = 18

# Days and microseconds from 0001-01-01 to 1970-01-01.
_DAYS = 719_162
_MICROS = _DAYS * 86_400_000_000


def _own_digits(kind: T.DataType) -> int | None:
    """Digits that hold every value of the type and a place for NULL; None where there are none."""
    if isinstance(kind, T.DateType):
        return 7
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return 18
    if isinstance(kind, T.DecimalType):
        return kind.precision + 1
    whole = {T.BooleanType: 1, T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
    return whole.get(type(kind))


def _half(digits: int) -> int:
    return 5 * 10 ** (digits - 1)


def _whole(value: int, digits: int) -> Column:
    return F.lit(str(value)).cast(T.DecimalType(min(MOST_DIGITS, digits), 0))


def _decimal(col: Column, digits: int) -> Column:
    return col.cast(T.DecimalType(min(MOST_DIGITS, digits), 0))


def _number(col: Column, kind: T.DataType) -> Column:
    """The column as a whole number of its smallest unit."""
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col)
    if isinstance(kind, T.TimestampNTZType):
        # Field by field: a wall-clock time has no zone to convert by.
        seconds = F.unix_date(col.cast("date")).cast("bigint") * 86_400 + F.hour(col) * 3600 + F.minute(col) * 60
        return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), col) * 1_000_000).cast("bigint")
    if isinstance(kind, T.BooleanType):
        return col.cast("int").cast("bigint")
    if isinstance(kind, T.DecimalType):
        return _decimal(col * _whole(10**kind.scale, kind.scale + 1), kind.precision)
    return col.cast("bigint")


def _code(col: Column, kind: T.DataType, digits: int) -> Column:
    """1 upwards in the order of the values, 0 for NULL."""
    if isinstance(kind, T.DateType):
        shift, most = _DAYS + 1, 10**digits
    elif isinstance(kind, T.TimestampType | T.TimestampNTZType):
        shift, most = _MICROS + 1, 10**digits
    elif isinstance(kind, T.BooleanType):
        shift, most = 1, 10**digits
    else:
        shift, most = _half(digits), 10**digits
    number = _number(col, kind)
    if digits <= LONG_DIGITS and not isinstance(kind, T.DecimalType | T.LongType):
        code, low, high = number + F.lit(shift), F.lit(1), F.lit(most)
    else:
        code = _decimal(number, 37) + _whole(shift, digits + 1)
        low, high = _whole(1, 1), _whole(most, digits + 1)
    outside = F.raise_error(F.concat(F.lit(f"a value does not fit {digits} digits: "), col.cast("string")))
    kept = F.when((code < low) | (code >= high), outside.cast("bigint")).otherwise(code)
    return F.coalesce(kept, F.lit(0))


def widths(
    order: Sequence[str], schema: T.StructType, digits: Mapping[str, int] | None = None, exact: bool = False
) -> list[int] | None:
    """Digits of each column: as given, else those of its type; the last one gets at most what is left
    (``exact``: it must get all it needs). None if the columns cannot be packed."""
    own = []
    for name in order:
        found = _own_digits(schema[name].dataType)
        if found is None:
            return None
        own.append(min(found, (digits or {}).get(name, found)))
    left = MOST_DIGITS - sum(own[:-1])
    if left < (own[-1] if exact else 1):
        return None
    return [*own[:-1], min(own[-1], left)]


def pack(order: Sequence[str], schema: T.StructType, digits: Sequence[int]) -> Column:
    total, so_far = sum(digits), 0
    parts = []
    for name, width in zip(order, digits, strict=True):
        so_far += width
        behind = total - so_far
        code = _code(F.col(name), schema[name].dataType, width)
        if total <= LONG_DIGITS:
            parts.append(code.cast("bigint") * F.lit(10**behind))
        else:
            parts.append(_decimal(_decimal(code, width) * _whole(10**behind, behind + 1), MOST_DIGITS))
    packed = parts[0]
    for part in parts[1:]:
        packed = packed + part
    return packed if total <= LONG_DIGITS else _decimal(packed, MOST_DIGITS)


def unpack_last(packed: Column, kind: T.DataType, digits: Sequence[int]) -> Column:
    """The last packed column, for types whose values come back from a number: whole numbers and decimals."""
    width = digits[-1]
    if sum(digits) <= LONG_DIGITS:
        code = packed % F.lit(10**width)
    else:
        code = _decimal(packed % _whole(10**width, width + 1), width + 1)
    number = code - _whole(_half(width), width + 1)
    if isinstance(kind, T.DecimalType):
        number = _decimal(number, width + 1) * F.lit(f"1e-{kind.scale}").cast(T.DecimalType(max(1, kind.scale), kind.scale))
    return F.when(code != 0, number.cast(kind))


def can_unpack(kind: T.DataType) -> bool:
    return isinstance(kind, T.ByteType | T.ShortType | T.IntegerType | T.LongType | T.DecimalType)
