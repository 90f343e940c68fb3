"""Small helpers shared by every module that takes 'a column or its name'."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_column(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nulls_last(c: ColumnLike) -> Column:
    """Ascending order of the warehouse: NULL sorts after every value."""
    return as_column(c).asc_nulls_last()


def nulls_first_desc(c: ColumnLike) -> Column:
    """Descending order of the warehouse: NULL sorts before every value."""
    return as_column(c).desc_nulls_first()


def rank_struct(*cols: ColumnLike) -> Column:
    """A struct whose natural order is 'ascending, NULL last' on each column in turn.

    Spark compares structs field by field with NULL lowest, so each value is preceded by its
    own null flag. ``max`` / ``max_by`` over it picks the row a descending sort would put first.
    """
    parts = []
    for i, c in enumerate(cols):
        parts += [as_column(c).isNull().alias(f"n{i}"), as_column(c).alias(f"v{i}")]
    return F.struct(*parts)


def same_row(left, right, names: list[str], right_names: list[str] | None = None) -> Column:
    """Null-safe equality of several columns, as one join condition."""
    pairs = zip(names, right_names or names)
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs])
