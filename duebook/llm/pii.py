"""Personal data: regular expressions propose spans, checksums confirm them, nearby words move the score.

Base kinds (email, ip, card, phone) follow fixed patterns and are always reported. Further kinds
(iban, ssn) are reported where their validator and the words around them give at least
``least_score``. Positions are code points, ends exclusive.

Defined results: a null or empty text has no spans; equal rows give equal results; a text of any
length is read whole, in time that grows with its length; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("iban", "ssn")
KINDS = BASE_KINDS + MORE_KINDS

LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
ALNUM = re.compile(r"[A-Za-z0-9]")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
DIGIT = re.compile(r"[0-9]")

# Words that speak for a kind within the nearby text
CONTEXT = {
    "email": ("mail", "contact", "write", "correo", "courriel", "kontakt"),
    "ip": ("ip", "address", "server", "host", "login"),
    "card": ("card", "credit", "visa", "payment", "tarjeta", "carte", "karte"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "telefon", "llame"),
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte"),
    "ssn": ("ssn", "social", "security"),
}
# Score by kind before the words around it; a confirmed checksum carries more than a shape
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.4}
NEAR = 40
CONTEXT_GAIN = 0.2


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit)
        if place % 2:
            value = value * 2 - 9 if value > 4 else value * 2
        total += value
    return total % 10 == 0


def mod97(text: str) -> bool:
    compact = text.replace(" ", "")
    if not 15 <= len(compact) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def _small_part(part: str) -> bool:
    digits = part.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def _issued(text: str) -> bool:
    area, group, serial = text.split("-")
    return area not in ("000", "666") and area[0] != "9" and group != "00" and serial != "0000"


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ with the longest local part before it that no earlier match owns."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL_PART:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        else:
            free = at + 1
        at = text.find("@", free)


def _matches(pattern: re.Pattern, valid: Callable[[str], bool]) -> Callable[[str], Iterator[tuple[int, int]]]:
    def find(text: str) -> Iterator[tuple[int, int]]:
        for m in pattern.finditer(text):
            if valid(m.group()):
                yield m.start(), m.end()

    return find


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """The longest run from each start that ends with a word and has a right checksum: capitals after the
    number, such as a bank's code, belong to the run but not to the number."""
    found = IBAN.search(text)
    while found:
        start, end = found.span()
        ends = (i for i in range(end, start + 14, -1) if text[i - 1] != " " and not ALNUM.match(text, i))
        last = next((i for i in ends if mod97(text[start:i])), None)
        if last is not None:
            yield start, last
        found = IBAN.search(text, last or start + 1)


def _card(text: str) -> bool:
    digits = text.replace(" ", "").replace("-", "")
    return 16 <= len(digits) <= 19 and luhn(digits)


FINDERS: dict[str, Callable[[str], Iterator[tuple[int, int]]]] = {
    "email": emails,
    "ip": _matches(IP, lambda s: all(map(_small_part, s.split(".")))),
    "card": _matches(CARD, _card),
    "phone": _matches(PHONE, lambda s: 8 <= len(DIGIT.findall(s)) <= 15),
    "iban": ibans,
    "ssn": _matches(SSN, _issued),
}


def find_spans(text: str, least_score: float = 0.55) -> list[Span]:
    """All spans by kind as listed, then start. Spans of further kinds need ``least_score``."""
    spans = []
    for kind in KINDS:
        for start, end in FINDERS[kind](text):
            around = text[max(0, start - NEAR) : start].lower() + " " + text[end : end + NEAR].lower()
            near = any(word in CONTEXT[kind] for word in re.findall(r"\w+", around))
            score = min(1.0, PRIOR[kind] + CONTEXT_GAIN * near)
            if kind in BASE_KINDS or score >= least_score:
                spans.append(Span(kind, start, end, score))
    return spans


def mask(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; of overlapping spans the first one's kind stands
    for all of them."""
    parts, at = [], 0
    for span in sorted(spans, key=lambda s: (s.start, -s.end)):
        if span.start >= at:
            parts.extend((text[at : span.start], f"<{span.kind.upper()}>"))
        at = max(at, span.end)
    return "".join((*parts, text[at:]))


SPAN_TYPE = "array<struct<kind: string, start: long, end: long, score: double>>"
_ARROW_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
)


def _scan(least_score: float, masked: bool, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found, clean = batch.column(text_at), [], []
            for scalar in texts:
                text = scalar.as_py()
                spans = find_spans(text, least_score) if text else []
                found.append([s._asdict() for s in spans])
                if masked:
                    clean.append(mask(text, spans) if spans else text)
            columns = list(batch.columns)
            if masked:
                columns[text_at] = pa.array(clean, pa.string())
            else:
                del columns[text_at]
            names = [n for i, n in enumerate(batch.schema.names) if masked or i != text_at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, _ARROW_SPANS)], [*names, "_pii_spans"])

    return run


def find_pii(documents: DataFrame, least_score: float = 0.55) -> DataFrame:
    """(doc_id, spans) of every row."""
    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    found = rows.mapInArrow(_scan(least_score, False, 1), f"doc_id {kind}, _pii_spans {SPAN_TYPE}")
    return found.withColumnRenamed("_pii_spans", "spans")


def mask_pii(documents: DataFrame, least_score: float = 0.55) -> DataFrame:
    """``documents`` with personal data in ``text`` replaced by its kind, and n_chars brought in line."""
    schema = StructType([*documents.schema.fields, *StructType.fromDDL(f"_pii_spans {SPAN_TYPE}").fields])
    at = documents.columns.index("text")
    out = documents.mapInArrow(_scan(least_score, True, at), schema).drop("_pii_spans")
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))
    return out
