"""Casts with the warehouse's meaning where Spark's plain cast would differ.

Malformed values raise (Spark's ANSI mode, on by default); ``lenient=True`` turns them into NULL.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from civiclake.functions.columns import ColumnLike, as_column


NUMERIC = ("smallint", "int", "bigint", "float", "double", "decimal")


def _cast(c: ColumnLike, type_name: str, lenient: bool) -> Column:
    c = as_column(c)
    if not lenient:
        return c.cast(type_name)
    if type_name.startswith(NUMERIC):
        # a failing try_cast costs an exception; most words can be told from numbers at once
        c = F.when(c.cast("string").rlike(r"^\s*[-+.0-9nNiI]"), c)
    return c.try_cast(type_name)


def text(c: ColumnLike) -> Column:
    """Text is always stored upper-cased."""
    return F.upper(as_column(c).cast("string"))


def varchar(c: ColumnLike, n: int) -> Column:
    """An explicit cast to varchar(n) truncates."""
    return F.substring(as_column(c).cast("string"), 1, n)


def char(c: ColumnLike, n: int) -> Column:
    """char(n) truncates, and its padding disappears when used as text again."""
    return F.rtrim(varchar(c, n))


def smallint(c: ColumnLike, lenient: bool = False) -> Column:
    return _cast(c, "smallint", lenient)


def integer(c: ColumnLike, lenient: bool = False) -> Column:
    return _cast(c, "int", lenient)


def bigint(c: ColumnLike, lenient: bool = False) -> Column:
    return _cast(c, "bigint", lenient)


def double(c: ColumnLike, lenient: bool = False) -> Column:
    return _cast(c, "double", lenient)


def real_to_bigint(c: ColumnLike, lenient: bool = False) -> Column:
    """Through single precision, rounding halves to even."""
    return F.bround(_cast(c, "float", lenient)).cast("bigint")


def numeric(c: ColumnLike, precision: int = 38, scale: int = 10, lenient: bool = False) -> Column:
    return _cast(c, f"decimal({precision},{scale})", lenient)


def numeric_to_bigint(c: ColumnLike, lenient: bool = False) -> Column:
    """Through exact decimals, rounding halves away from zero."""
    return F.round(numeric(c, lenient=lenient)).cast("bigint")


def money(c: ColumnLike, lenient: bool = False) -> Column:
    """'$1,200.50', '-$3' and '($3)' to an exact amount."""
    raw = F.trim(as_column(c).cast("string"))
    sign = F.when(raw.startswith("("), "-").otherwise("")
    digits = F.translate(raw, "$,()", "")
    return _cast(F.concat(sign, digits), "decimal(19,2)", lenient)


def boolean(c: ColumnLike, lenient: bool = False) -> Column:
    """Accepts on/off besides the spellings Spark knows."""
    word = F.lower(F.trim(as_column(c).cast("string")))
    word = F.when(word == "on", "true").when(word == "off", "false").otherwise(word)
    return _cast(word, "boolean", lenient)


def int_to_boolean(c: ColumnLike, lenient: bool = False) -> Column:
    """0 is false, any other integer true."""
    return _cast(c, "int", lenient) != 0


def _unpadded(pattern: str) -> str:
    """A pattern that also reads one digit where two letters stand between separators."""
    return re.sub(r"(?<![A-Za-z'])(MM|dd|HH|hh)(?![A-Za-z'])", lambda m: m[0][0], pattern)


def date(c: ColumnLike, formats: tuple[str, ...] = (), lenient: bool = False) -> Column:
    """ISO text, or the first of ``formats`` that parses; days and months need no leading zero."""
    c = as_column(c)
    formats = tuple(_unpadded(f) for f in formats)
    if not formats:
        return _cast(c, "date", lenient)
    if len(formats) == 1 and not lenient:
        return F.to_date(c.cast("string"), formats[0])
    tries = [F.try_to_timestamp(c.cast("string"), F.lit(f)).cast("date") for f in formats]
    parsed = F.coalesce(*tries)
    if lenient:
        return parsed
    bad = F.raise_error(F.concat(F.lit("not a date in any known format: "), c.cast("string")))
    return F.when(c.isNull() | parsed.isNotNull(), parsed).otherwise(bad.cast("date"))


def year_start(c: ColumnLike) -> Column:
    """A four-digit year to January 1st of it."""
    return F.to_date(as_column(c).cast("string"), "yyyy")


def zoned_timestamp(
    c: ColumnLike,
    zone: str = "America/Chicago",
    tz_mode: str = "reinterpret",
    lenient: bool = False,
) -> Column:
    """Timestamp text to an instant.

    ``reinterpret`` (the warehouse's rule): take the UTC wall clock of the value and read that
    wall clock as local time in ``zone``. ``convert`` keeps the instant as it was published.
    The session time zone must be UTC.
    """
    instant = _cast(c, "timestamp", lenient)
    if tz_mode == "convert":
        return instant
    if tz_mode != "reinterpret":
        raise ValueError(f"tz_mode must be 'reinterpret' or 'convert', not {tz_mode!r}")
    return F.to_utc_timestamp(instant, zone)
