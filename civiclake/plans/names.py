"""Column names as the warehouse writes them."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

from pyspark.sql import DataFrame


def standard_names(names: list[str], unwanted: tuple[str, ...] = (" ", "-")) -> list[str]:
    """Each unwanted character becomes '_', one character after another; everything is lower-cased.

    A name that another column has already is numbered, from 1, with the first number that neither makes it the
    name of a column nor the one another column is about to get.
    """
    for char in unwanted:
        names = [n.lower() for n in _replaced(names, char)]
    return names


def _replaced(names: list[str], char: str) -> Iterator[str]:
    used = set(names)
    wishes = {name: name.replace(char, "_") for name in names if char in name}
    for name in names:
        wish = wishes.get(name, name)
        if name in wishes:
            numbered = (f"{wish}_{n}" for n in count(1))
            if wish in used:
                wish = next(other for other in numbered if other not in used and other not in wishes.values())
            used.add(wish)
        yield wish


def with_standard_names(df: DataFrame, unwanted: tuple[str, ...] = (" ", "-")) -> DataFrame:
    return df.toDF(*standard_names(df.columns, unwanted))
