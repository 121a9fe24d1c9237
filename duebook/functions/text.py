"""Name and text clean-up."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters after which a title-cased word restarts (the warehouse
# dialect's documented default delimiters).
WORD_BREAKS = " \t\n\x0b\f\r[](){}/|\\<>!?@\"^#$&~_,.:;*%+-"

# Unicode white space, trimmed at both ends by the warehouse dialect.
WHITE_SPACE = (
    "\t\n\x0b\f\r \x1c\x1d\x1e\x1f\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# The accented letters that are folded, and what they become.
ACCENTED = "áéíóúñ"
PLAIN = "aeioun"

# Small letters without a one-letter capital. A title-cased word that starts
# with one keeps it as it is, where full case mapping would write two letters.
NO_CAPITAL = "\u00df\u0149\u01f0\u0390\u03b0\u0587\u1e96\u1e97\u1e98\u1e99\u1e9a"

# A Unicode noncharacter, so it cannot clash with text meant for interchange.
_MARK = "\ufdd0"


def _char_class(chars: str) -> str:
    return "[" + "".join(re.escape(c) for c in chars) + "]"


def trim_text(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITE_SPACE))


def _shield(col: Column) -> Column:
    """Put a mark before word-initial letters without a capital, so that the mark is capitalised."""
    shielded = F.regexp_replace(col, f"(^| )(?=[{NO_CAPITAL}])", f"$1{_MARK}")
    # Plain byte searches first: nearly all names hold none of these letters.
    held = reduce(lambda a, b: a | b, [col.contains(c) for c in NO_CAPITAL])
    return F.when(held, shielded).otherwise(col)


def _unmark(col: Column) -> Column:
    return F.replace(col, F.lit(_MARK), F.lit(""))


def title_words(col: Column, delimiters: str = WORD_BREAKS) -> Column:
    """Title case that restarts after a space and after every delimiter.

    ``initcap`` restarts after a space only, so a mark and a space are put behind each
    other delimiter and taken out again: code-generated expressions only, no lambda.
    """
    others = delimiters.replace(" ", "")
    if not others:
        return _unmark(F.initcap(_shield(col)))
    spaced = F.regexp_replace(col, f"({_char_class(others)})", f"$1{_MARK} ")
    return _unmark(F.replace(F.initcap(_shield(spaced)), F.lit(f"{_MARK} "), F.lit("")))


def title_words_split(col: Column) -> Column:
    """Title case by splitting on spaces, mapping each word and joining again."""
    words = F.transform(F.split(_shield(col), " "), F.initcap)
    return _unmark(F.array_join(words, " "))


def strip_chars(col: Column, chars: str) -> Column:
    # One byte search per character is about twice as fast as translate() on long text.
    for c in chars:
        col = F.replace(col, F.lit(c), F.lit(""))
    return col


def strip_tokens(
    col: Column, tokens: Sequence[str], *, regex: bool = False, whole_word: bool = False
) -> Column:
    """Delete listed tokens, also inside words unless ``whole_word``; trim the ends.

    One pass with an alternation when ``regex`` (or ``whole_word``), else one token after
    the other, which differs when deleting one token forms another.
    """
    if not tokens:
        return trim_text(col)
    if regex or whole_word:
        pattern = "|".join(re.escape(t) for t in tokens)
        if whole_word:
            pattern = rf"\b(?:{pattern})\b"
        return trim_text(F.regexp_replace(col, pattern, ""))
    for token in tokens:
        col = F.replace(col, F.lit(token), F.lit(""))
    return trim_text(col)


def fold_accents(col: Column) -> Column:
    return F.translate(col, ACCENTED, PLAIN)


def person_name(
    first: Column,
    last1: Column,
    last2: Column,
    *,
    nulls: str = "empty",
    surname_strip: str = "-.",
) -> Column:
    """Display name from three parts.

    ``nulls="empty"`` reads a missing part as empty text, ``"propagate"`` makes the whole
    name NULL. Inner spaces are kept, the ends are trimmed.
    """
    if nulls not in ("empty", "propagate"):
        raise ValueError(f"nulls must be 'empty' or 'propagate', not {nulls!r}")

    def part(col: Column, strip: str) -> Column:
        if strip:
            col = strip_chars(col, strip)
        titled = title_words(trim_text(col))
        return F.coalesce(titled, F.lit("")) if nulls == "empty" else titled

    space = F.lit(" ")
    return trim_text(
        F.concat(part(first, ""), space, part(last1, surname_strip), space, part(last2, surname_strip))
    )


def full_name(*parts: Column) -> Column:
    """Trimmed parts joined by one space; blank parts are skipped, all blank gives NULL."""
    blank = F.lit("")
    kept = [F.nullif(F.trim(p), blank) for p in parts]
    return F.nullif(F.concat_ws(" ", *kept), blank)
