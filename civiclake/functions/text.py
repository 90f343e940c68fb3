"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from civiclake.functions.columns import ColumnLike, as_column

NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"  # fixed value: stands for NULL inside a key


def surrogate_key(cols: list[ColumnLike]) -> Column:
    """md5 over the '-'-joined text of the key columns, with a fixed word for NULL."""
    parts = [F.coalesce(as_column(c).cast("string"), F.lit(NULL_KEY_PART)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def zero_padded(c: ColumnLike, n: int) -> Column:
    """Left-pad with zeros to n characters; longer values are cut to n."""
    return F.lpad(as_column(c).cast("string"), n, "0")


def strip_all(c: ColumnLike, pattern: str) -> Column:
    return F.regexp_replace(as_column(c), pattern, "")


def strip_leading(c: ColumnLike, pattern: str) -> Column:
    """Remove one match at the start of the text only."""
    return F.regexp_replace(as_column(c), f"^(?:{pattern})", "")


def strip_commas(c: ColumnLike, type_name: str = "bigint") -> Column:
    return F.replace(as_column(c).cast("string"), F.lit(","), F.lit("")).cast(type_name)


def letters_after_digit_removed(c: ColumnLike) -> Column:
    """Drop every non-digit that directly follows a digit ('2-AB1A' -> '2AB1')."""
    return F.regexp_replace(as_column(c), r"(?<=[0-9])[^0-9]", "")


def before(c: ColumnLike, separator: str) -> Column:
    """The part before the first separator."""
    return F.split_part(as_column(c), F.lit(separator), F.lit(1))


def joined_skipping_nulls(*cols: ColumnLike) -> Column:
    return F.concat_ws("", *[as_column(c).cast("string") for c in cols])


def joined_or_null(*cols: ColumnLike) -> Column:
    return F.concat(*[as_column(c).cast("string") for c in cols])


def without_suffix(c: ColumnLike, suffix_pattern: str) -> Column:
    return F.regexp_replace(as_column(c), f"(?:{suffix_pattern})$", "")


def comma_list(c: ColumnLike) -> Column:
    """array<string> -> 'a,b,c' with each element trimmed."""
    return F.array_join(F.transform(as_column(c), lambda x: F.trim(x)), ",")


def normalized_category(c: ColumnLike, exact: tuple[str, ...], unknown_like: str = "%UNK%") -> Column:
    """Any spelling of 'unknown' to UNKNOWN, listed words as they are, the rest passed through."""
    word = F.upper(as_column(c).cast("string"))
    out = F.when(word.like(unknown_like), "UNKNOWN")
    for w in exact:
        out = out.when(word == w, w)
    return out.otherwise(word)
