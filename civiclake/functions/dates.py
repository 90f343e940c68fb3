"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from civiclake.functions.columns import ColumnLike, as_column

DAYS_PER_YEAR = 365.2422  # fixed value: tropical year
SOURCE_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]X"  # fixed value: ISO text as published


def days_between(later: ColumnLike, earlier: ColumnLike) -> Column:
    return F.datediff(as_column(later), as_column(earlier))


def years_between(later: ColumnLike, earlier: ColumnLike) -> Column:
    """Fractional years; NULL for a zero gap, so it can be divided by."""
    days = days_between(later, earlier).cast("double")
    return F.nullif(days / F.lit(DAYS_PER_YEAR), F.lit(0.0))


def month_label(c: ColumnLike) -> Column:
    return F.date_format(as_column(c), "yyyy-MM")


def month_start_of_label(c: ColumnLike) -> Column:
    return F.to_date(F.concat(as_column(c), F.lit("-01")))


def published_timestamp(c: ColumnLike) -> Column:
    """ISO text with a zone suffix, with or without fraction, to an instant."""
    return F.to_timestamp(as_column(c), SOURCE_FORMAT)


def published_text(c: ColumnLike) -> Column:
    """An instant as ISO text without fraction ('2024-12-01T11:01:39Z')."""
    return F.date_format(as_column(c), "yyyy-MM-dd'T'HH:mm:ss'Z'")
