"""Cleaning and typed parsing as native Column expressions (no UDFs).

Every parser returns ``(value, invalid)``: ``value`` is the typed result or
null, ``invalid`` is true when a non-empty input could not be parsed.  An
input that cleans to null is null and *valid*.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratum.contracts import EMPTY_TOKENS, INVALID_NUMERIC_TOKENS

# The whitespace class of Python's ``str.isspace`` spelled out, because Java's
# ``\s`` is ASCII-only and ``(?U)\s`` misses the separators \x1c-\x1f.
WHITESPACE = (
    r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)

# Visible ASCII is none of these; a text of it alone has nothing to collapse, which this pattern tells at a fraction of the cost.
NOT_VISIBLE_ASCII = "[^!-~]"

INTEGER_PATTERN = r"^-?[0-9]+$"
DATE_PATTERN = r"^(0?[1-9]|[12][0-9]|3[01])/(0?[1-9]|1[0-2])/[0-9]{4}$"
TIME_PATTERN = r"^([01]?[0-9]|2[0-3]):([0-5]?[0-9])(:([0-5]?[0-9]))?$"
ISO_DATETIME_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse_whitespace(c: Column | str) -> Column:
    """Whitespace runs to one space, then strip."""
    text = _col(c).cast("string")
    return F.when(text.rlike(NOT_VISIBLE_ASCII), F.trim(F.regexp_replace(text, WHITESPACE, " "))).otherwise(text)


def without_empty(c: Column | str) -> Column:
    """Null out empty tokens (``-``, ``n/a``, ...) of collapsed text."""
    c = _col(c)
    return F.when(~F.lower(c).isin(*EMPTY_TOKENS), c)


def clean_text(c: Column | str) -> Column:
    """Collapse whitespace and null out empty tokens."""
    return without_empty(collapse_whitespace(c))


BLANK_PATTERN = "^" + WHITESPACE[:-1] + "*$"


def is_blank(c: Column | str) -> Column:
    """Null, or only whitespace (Python ``str(v).strip() == ''``)."""
    c = _col(c)
    return c.isNull() | c.cast("string").rlike(BLANK_PATTERN)


def _cleaned(c: Column | str, cleaned: bool) -> Column:
    return _col(c) if cleaned else clean_text(c)


def parse_integer(c: Column | str, type_: str = "int", cleaned: bool = False) -> tuple[Column, Column]:
    """``-?[0-9]+`` after cleaning; out-of-range values are invalid.

    ``cleaned=True`` when ``c`` already went through :func:`clean_text` (the
    silver step cleans every cell once in its own projection).
    """
    cleaned = _cleaned(c, cleaned)
    value = F.when(cleaned.rlike(INTEGER_PATTERN), cleaned.try_cast(type_))
    return value, cleaned.isNotNull() & value.isNull()


def _scale(type_: str) -> int:
    match = re.search(r",\s*(\d+)\s*\)", type_)
    return int(match.group(1)) if match else 0


def parse_decimal(c: Column | str, type_: str = "decimal(38,10)", cleaned: bool = False) -> tuple[Column, Column]:
    """Brazilian notation: dots are thousands separators, comma is decimal.

    ``1.234,56`` -> 1234.56; ``1234.56`` -> 123456 (dots are always dropped);
    sentinels such as ``#########`` and values with more fraction digits than
    the target scale are invalid (never rounded silently).
    """
    cleaned = _cleaned(c, cleaned)
    normalized = F.replace(F.replace(cleaned, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    scale = _scale(type_)
    fraction = rf"(\.[0-9]{{1,{scale}}})?" if scale else ""
    ok = normalized.rlike(rf"^-?[0-9]+{fraction}$") & ~F.lower(cleaned).isin(
        *INVALID_NUMERIC_TOKENS
    )
    value = F.when(ok, normalized.try_cast(type_))
    return value, cleaned.isNotNull() & value.isNull()


def parse_date(c: Column | str, fmt: str = "d/M/yyyy", cleaned: bool = False) -> tuple[Column, Column]:
    """``dd/mm/yyyy`` with one-digit day or month accepted, 4-digit year."""
    cleaned = _cleaned(c, cleaned)
    value = F.when(cleaned.rlike(DATE_PATTERN), F.try_to_date(cleaned, fmt))
    return value, cleaned.isNotNull() & value.isNull()


def parse_time(c: Column | str, cleaned: bool = False) -> tuple[Column, Column]:
    """``H:M`` or ``H:M:S`` (one or two digits each), always ``HH:mm:ss`` out."""
    cleaned = _cleaned(c, cleaned)
    ok = cleaned.rlike(TIME_PATTERN)

    def part(i: int) -> Column:
        return F.lpad(F.regexp_extract(cleaned, TIME_PATTERN, i), 2, "0")

    seconds = F.when(F.regexp_extract(cleaned, TIME_PATTERN, 4) == "", F.lit("00")).otherwise(
        part(4)
    )
    value = F.when(ok, F.concat_ws(":", part(1), part(2), seconds))
    return value, cleaned.isNotNull() & value.isNull()


def combine_datetime(date_col: Column | str, time_col: Column | str) -> Column:
    """Date + ``HH:mm:ss`` text -> TIMESTAMP_NTZ; null if either is null."""
    d, t = _col(date_col), _col(time_col)
    return F.when(
        d.isNotNull() & t.isNotNull(),
        F.concat(d.cast("string"), F.lit("T"), t).cast("timestamp_ntz"),
    )


def clean_category(c: Column | str) -> Column:
    """Cleaned and upper-cased category value."""
    return F.upper(clean_text(c))


def base_name(path: Column | str) -> Column:
    return F.regexp_extract(_col(path), r"([^/]+)$", 1)


def as_text(c: Column | str, dtype: str) -> Column:
    """Textual form of a typed silver value, as the CSV export writes it."""
    c = _col(c)
    if dtype.startswith("timestamp"):
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    return c.cast("string")


def text_integer(c: Column | str) -> Column:
    """Integer read of free text (quality side): trims, takes a leading +."""
    return F.trim(_col(c).cast("string")).try_cast("bigint")


def text_decimal(c: Column | str, type_: str = "decimal(38,10)") -> Column:
    return F.trim(_col(c).cast("string")).try_cast(type_)


def rate(count: Column | str, rows: Column | str) -> Column:
    """``round(count / rows, 6)``; 1.0 when there are no rows."""
    count, rows = _col(count), _col(rows)
    return F.when(rows > 0, F.round(count / rows.cast("double"), 6)).otherwise(F.lit(1.0))
