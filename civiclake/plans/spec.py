"""Declaring a dataset: its key, its columns and how each is cleaned."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiclake.functions import casting as C
from civiclake.functions import geometry as G
from civiclake.functions import text as X
from civiclake.operators.versions import PROVENANCE

# How a column rule written as text is turned into an expression. A rule is a word with
# optional arguments: 'text', 'varchar 4', 'padded_char 2', 'date MM/dd/yyyy', 'geometry POINT'.
Rule = Callable[..., Column]


def _padded_char(c: Column, n: str, lenient: bool = False) -> Column:
    return X.zero_padded(F.upper(C.char(c, int(n))), int(n))


def _padded_int(c: Column, n: str, cut: str | None = None, lenient: bool = False) -> Column:
    digits = C.bigint(c, lenient).cast("string")
    return X.zero_padded(digits if cut is None else C.varchar(digits, int(cut)), int(n))


RULES: dict[str, Rule] = {
    "text": lambda c, lenient=False: C.text(c),
    "plain_text": lambda c, lenient=False: c.cast("string"),
    "as_is": lambda c, lenient=False: c,
    "varchar": lambda c, n, lenient=False: F.upper(C.varchar(c, int(n))),
    "char": lambda c, n, lenient=False: F.upper(C.char(c, int(n))),
    "padded_char": _padded_char,
    "padded_int": _padded_int,
    "smallint": C.smallint,
    "int": C.integer,
    "bigint": C.bigint,
    "double": C.double,
    "real_bigint": C.real_to_bigint,
    "numeric_bigint": C.numeric_to_bigint,
    "numeric_smallint": lambda c, lenient=False: C.numeric_to_bigint(c, lenient).cast("smallint"),
    "numeric": lambda c, p="38", s="10", lenient=False: C.numeric(c, int(p), int(s), lenient),
    "money": C.money,
    "boolean": C.boolean,
    "int_boolean": C.int_to_boolean,
    "comma_bigint": lambda c, lenient=False: X.strip_commas(c),
    "comma_int": lambda c, lenient=False: X.strip_commas(c, "int"),
    "before_dot_smallint": lambda c, lenient=False: C.smallint(X.before(c, "."), lenient),
    "no_leading_zero": lambda c, lenient=False: X.strip_leading(c, "0"),
    "digits_only": lambda c, lenient=False: X.strip_all(C.text(c), "[^0-9]"),
    "letters_only": lambda c, lenient=False: X.strip_all(C.text(c), "[^A-Z ]"),
    "class_code": lambda c, lenient=False: X.letters_after_digit_removed(C.text(c)),
    "police_district": lambda c, lenient=False: F.when(
        F.upper(c) == "HEADQUARTERS", "HQ"
    ).otherwise(_padded_char(c, "2")),
    "gender": lambda c, lenient=False: X.normalized_category(c, ("MALE", "FEMALE")),
    "date": lambda c, *formats, lenient=False: C.date(c, formats, lenient),
    "year_start": lambda c, lenient=False: C.year_start(c),
    "zero_or_date": lambda c, lenient=False: C.date(F.nullif(c, F.lit("0")), lenient=lenient),
    "zoned": lambda c, zone="America/Chicago", lenient=False: C.zoned_timestamp(
        c, zone, lenient=lenient
    ),
    "instant": lambda c, lenient=False: C.zoned_timestamp(c, tz_mode="convert", lenient=lenient),
    "geometry": lambda c, kind="GEOMETRY", lenient=False: G.checked_kind(c, kind),
    "geometry_or_null": lambda c, kind="GEOMETRY", lenient=False: G.checked_kind(
        G.empty_to_null(c), kind
    ),
}


@dataclass(frozen=True)
class ColumnSpec:
    """``name`` is the output column; ``source`` the landed one; ``rule`` a rule text or a function
    of the landed column."""

    name: str
    rule: str | Callable[[Column], Column] = "text"
    source: str | None = None

    def expression(self, lenient: bool = False) -> Column:
        landed = F.col(f"`{self.source or self.name}`")
        if callable(self.rule):
            return self.rule(landed).alias(self.name)
        word, *args = self.rule.split(" ")
        return RULES[word](landed, *args, lenient=lenient).alias(self.name)


@dataclass(frozen=True)
class DatasetSpec:
    """A dataset as the warehouse keeps it.

    ``key`` are the output columns that identify a record. With several of them (or with
    ``always_keyed``) ``record_id`` is a surrogate key made of them, else it is the key column.
    Columns not mentioned in ``columns`` follow the first of ``patterns`` (regex to rule) that
    matches their whole name, else the rule for their landed type (``auto_columns``).
    ``derived`` columns are computed from the cleaned ones; rows whose column is one of the
    ``excluded`` words are left out. ``srid`` is the reference system of its geometries.
    """

    name: str
    key: tuple[str, ...]
    record_id: str
    columns: tuple[ColumnSpec, ...] = ()
    derived: dict[str, Callable[[], Column]] = field(default_factory=dict)
    updated_at: str = "source_data_updated"
    metadata_cols: tuple[str, ...] = tuple(PROVENANCE)
    always_keyed: bool = False
    excluded: dict[str, tuple[str, ...]] = field(default_factory=dict)
    patterns: dict[str, str] = field(default_factory=dict)
    complete: bool = False
    srid: int = G.DEFAULT_SRID

    @property
    def made_key(self) -> bool:
        return self.always_keyed or len(self.key) > 1

    def source_cols(self, df: DataFrame) -> list[str]:
        return [c for c in df.columns if c not in self.metadata_cols]

    def resolved(self, schema: T.StructType) -> list[ColumnSpec]:
        """Declared columns first, the others by type; provenance columns last."""
        if self.complete:
            return list(self.columns)
        declared = {c.source or c.name: c for c in self.columns}
        landed = [declared.get(a.name) or self._by_pattern(a) for a in auto_columns(schema)]
        extra = [c for s, c in declared.items() if s not in schema.names]
        if extra:
            raise ValueError(f"{self.name}: not in the landed table: {[c.name for c in extra]}")
        tail = [c for c in landed if c.name in self.metadata_cols]
        return [c for c in landed if c.name not in self.metadata_cols] + tail

    def _by_pattern(self, column: ColumnSpec) -> ColumnSpec:
        for pattern, rule in self.patterns.items():
            if re.fullmatch(pattern, column.name):
                return ColumnSpec(column.name, rule)
        return column


def column_specs(**rules: str) -> tuple[ColumnSpec, ...]:
    """Columns grouped by rule: ``bigint='id x_coordinate'``; 'old>new' renames.

    A rule's arguments follow '__' in its word: ``varchar__4='iucr'``.
    """
    out = []
    for rule, names in rules.items():
        text = rule.replace("__", " ")
        for n in names.split():
            source, _, new = n.partition(">")
            out.append(ColumnSpec(new or source, text, source))
    return tuple(out)


# Rule per landed type for columns a spec does not mention.
def _auto_rule(t: T.DataType) -> str | None:
    if isinstance(t, T.LongType):
        return "bigint"
    if isinstance(t, T.IntegerType):
        return "int"
    if isinstance(t, T.ShortType):
        return "smallint"
    if isinstance(t, T.BooleanType):
        return "boolean"
    if isinstance(t, T.VarcharType):
        return f"varchar {t.length}"
    if isinstance(t, T.CharType):
        return f"char {t.length}"
    if isinstance(t, T.StringType):
        return "text"
    if isinstance(t, T.DoubleType):
        return "double"
    if isinstance(t, T.DateType):
        return "date"
    if isinstance(t, T.StructType) and t.names == ["type", "coordinates"]:
        return "geometry"
    return None


def auto_columns(schema: T.StructType, strict: bool = False) -> list[ColumnSpec]:
    """The default spec of a landed table. Types without a rule stay as they are; with
    ``strict`` they are reported instead."""
    out, unknown = [], []
    for f in schema.fields:
        if f.name in PROVENANCE:
            out.append(ColumnSpec(f.name, "zoned"))
            continue
        rule = _auto_rule(f.dataType)
        if rule is None:
            unknown.append(f"{f.name}: {f.dataType.simpleString()}")
        out.append(ColumnSpec(f.name, rule or "as_is"))
    if strict and unknown:
        raise ValueError(f"no rule for {', '.join(unknown)}")
    return out


def auto_spec(name: str, schema: T.StructType, key: tuple[str, ...], record_id: str) -> DatasetSpec:
    return DatasetSpec(name, key, record_id, tuple(auto_columns(schema)), complete=True)


def standardize(df: DataFrame, spec: DatasetSpec, lenient: bool = False) -> DataFrame:
    """Rename, retype and clean by spec, with the record id in front. A plain projection: nothing
    is sorted or stored, so filters and column choices of later steps reach the scan."""
    out = df.select(*[c.expression(lenient) for c in spec.resolved(df.schema)])
    if spec.derived:
        tail = [c for c in out.columns if c in spec.metadata_cols]
        made = [make().alias(n) for n, make in spec.derived.items()]
        body = [c for c in out.columns if c not in spec.metadata_cols and c not in spec.derived]
        out = out.select(*body, *made, *tail)
    for column, words in spec.excluded.items():
        out = out.where(~F.col(column).isin(*words))
    if spec.made_key:
        out = out.select(X.surrogate_key(list(spec.key)).alias(spec.record_id), "*")
    return G.with_declared_srid(out, spec.srid, *G.geometry_columns(out))


