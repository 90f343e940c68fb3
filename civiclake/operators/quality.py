"""Data-quality suites: declared expectations, checked in as few passes as possible.

All row-wise and simple aggregate checks of a suite fold into ONE aggregation of the table.
Checks about repeated values share one grouped count. Only quantiles, order and distribution
checks add a pass of their own. The report has one row per expectation:

    ordinal, expectation, column, element_count, missing_count, unexpected_count, observed, success
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiclake.operators.history import with_previous
from civiclake.operators.quantiles import exact_quantiles

REPORT_SCHEMA = (
    "ordinal int, expectation string, column string, element_count bigint, "
    "missing_count bigint, unexpected_count bigint, observed double, success boolean"
)


@dataclass(frozen=True)
class Expectation:
    """One declared check; ``kind`` is its public name without the leading 'expect_'."""

    kind: str
    args: dict[str, Any] = field(default_factory=dict)
    meta: dict[str, Any] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        a = self.args
        if "column_list" in a and not self.kind.startswith("table_"):
            return list(a["column_list"])
        if "column_A" in a:
            return [a["column_A"], a["column_B"]]
        return [a["column"]] if "column" in a else []

    @property
    def label(self) -> str | None:
        return ", ".join(self.columns) or None

    @property
    def mostly(self) -> float:
        given = self.args.get("mostly")
        return 1.0 if given is None else float(given)


def expect(kind: str, column: str | None = None, **args: Any) -> Expectation:
    return Expectation(kind, {**({"column": column} if column else {}), **args})


def suite_from_json(text: str) -> list[Expectation]:
    """Read a suite document: {"expectations": [{"expectation_type", "kwargs"}]}."""
    return [
        Expectation(
            e["expectation_type"].removeprefix("expect_"), e.get("kwargs", {}), e.get("meta", {})
        )
        for e in json.loads(text)["expectations"]
    ]


def suite_to_json(suite: list[Expectation], name: str = "warning") -> str:
    items = [
        {"expectation_type": f"expect_{e.kind}", "kwargs": e.args, "meta": e.meta} for e in suite
    ]
    return json.dumps({"expectation_suite_name": name, "expectations": items}, default=str)


# ---------------------------------------------------------------- row-wise checks

RowCheck = Callable[..., Column]
ROW_CHECKS: dict[str, RowCheck] = {}


def row_check(kind: str) -> Callable[[RowCheck], RowCheck]:
    """Register a check ``f(args, *columns) -> Column`` that is true for good values.

    User-defined expectations are added with the same decorator.
    """

    def add(f: RowCheck) -> RowCheck:
        ROW_CHECKS[kind] = f
        return f

    return add


def _in_range(c: Column, a: dict[str, Any]) -> Column:
    """min_value / max_value with optional strict ends; a missing end is open."""
    ok = F.lit(True)
    if a.get("min_value") is not None:
        ok = ok & (c > a["min_value"] if a.get("strict_min") else c >= a["min_value"])
    if a.get("max_value") is not None:
        ok = ok & (c < a["max_value"] if a.get("strict_max") else c <= a["max_value"])
    return ok


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda x, y: x | y, conditions)


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda x, y: x & y, conditions)


def _matches(c: Column, a: dict[str, Any], key: str, test: Callable[[Column, str], Column]):
    join = _all if a.get("match_on") == "all" else _any
    return join([test(c, p) for p in a[key]])


def _like(c: Column, p: str) -> Column:
    return c.like(p)


def _rlike(c: Column, p: str) -> Column:
    return c.rlike(p)


# fixed values: strftime directives and the pattern letters Spark uses for them
STRFTIME = {
    "%Y": "yyyy",
    "%m": "MM",
    "%d": "dd",
    "%H": "HH",
    "%M": "mm",
    "%S": "ss",
    "%f": "SSSSSS",
    "%y": "yy",
    "%j": "DDD",
    "%b": "MMM",
    "%B": "MMMM",
    "%I": "hh",
    "%p": "a",
    "%z": "xx",
    "%Z": "VV",
}


# directives that read one digit too, unless the next directive follows at once
ONE_DIGIT = {"%m": "M", "%d": "d", "%H": "H", "%M": "m", "%S": "s", "%I": "h"}

# free-form dates that parse besides what a cast reads, tried in turn
FREE_FORM_DATES = (
    "MMM d yyyy",
    "MMM d, yyyy",
    "MMMM d yyyy",
    "MMMM d, yyyy",
    "d MMM yyyy",
    "d MMMM yyyy",
    "M/d/yyyy",
    "M/d/yy",
    "M/d/yyyy H:mm",
    "M/d/yyyy H:mm:ss",
    "M/d/yyyy h:mm a",
    "M/d/yyyy h:mm:ss a",
    "M-d-yyyy",
    "yyyy/M/d",
    "yyyy/M/d H:mm:ss",
    "yyyyMMdd",
    "MMM d yyyy H:mm:ss",
    "MMM d, yyyy H:mm",
)


def spark_time_pattern(strftime: str) -> str:
    """The date pattern of a strptime format; directives Spark cannot parse raise."""
    parts = re.findall(r"%.|[^%]|%", strftime)
    out = ""
    for i, part in enumerate(parts):
        if part == "%%":
            out += "%"
        elif len(part) == 2:
            if part not in STRFTIME:
                raise ValueError(f"time directive not supported: {part}")
            joined = any(p in STRFTIME for p in parts[max(i - 1, 0) : i] + parts[i + 1 : i + 2])
            out += STRFTIME[part] if joined else ONE_DIGIT.get(part, STRFTIME[part])
        else:
            out += "''" if part == "'" else f"'{part}'" if part.isalpha() else part
    return out


for _kind, _check in {
    "column_values_to_be_between": lambda a, c: _in_range(c, a),
    "column_values_to_be_in_set": lambda a, c: c.isin(list(a["value_set"])),
    "column_distinct_values_to_be_in_set": lambda a, c: c.isin(list(a["value_set"])),
    "column_values_to_not_be_in_set": lambda a, c: ~c.isin(list(a["value_set"])),
    "column_value_lengths_to_be_between": lambda a, c: _in_range(F.length(c), a),
    "column_value_lengths_to_equal": lambda a, c: F.length(c) == a["value"],
    "column_values_to_match_like_pattern": lambda a, c: _like(c, a["like_pattern"]),
    "column_values_to_not_match_like_pattern": lambda a, c: ~_like(c, a["like_pattern"]),
    "column_values_to_match_like_pattern_list": lambda a, c: _matches(
        c, a, "like_pattern_list", _like
    ),
    "column_values_to_not_match_like_pattern_list": lambda a, c: ~_any(
        [_like(c, p) for p in a["like_pattern_list"]]
    ),
    "column_values_to_match_regex": lambda a, c: _rlike(c, a["regex"]),
    "column_values_to_not_match_regex": lambda a, c: ~_rlike(c, a["regex"]),
    "column_values_to_match_regex_list": lambda a, c: _matches(c, a, "regex_list", _rlike),
    "column_values_to_not_match_regex_list": lambda a, c: ~_any(
        [_rlike(c, p) for p in a["regex_list"]]
    ),
    "column_values_to_match_strftime_format": lambda a, c: F.try_to_timestamp(
        c, F.lit(spark_time_pattern(a["strftime_format"]))
    ).isNotNull(),
    "column_values_to_be_dateutil_parseable": lambda a, c: F.coalesce(
        c.cast("string").try_cast("timestamp"),
        *[F.try_to_timestamp(F.trim(c.cast("string")), F.lit(p)) for p in FREE_FORM_DATES],
    ).isNotNull(),
    "column_values_to_be_json_parseable": lambda a, c: F.try_parse_json(c).isNotNull(),
    "column_pair_values_a_to_be_greater_than_b": lambda a, x, y: (
        x >= y if a.get("or_equal") else x > y
    ),
    "column_pair_values_to_be_equal": lambda a, x, y: x == y,
    "column_pair_values_to_be_in_set": lambda a, x, y: _any(
        [x.eqNullSafe(F.lit(p)) & y.eqNullSafe(F.lit(q)) for p, q in a["value_pairs_set"]]
    ),
    "multicolumn_sum_to_equal": lambda a, *cs: reduce(lambda x, y: x + y, cs) == a["sum_total"],
    "select_column_values_to_be_unique_within_record": lambda a, *cs: (
        F.size(F.array_distinct(F.array(*cs))) == len(cs)
    ),
}.items():
    ROW_CHECKS[_kind] = _check


# what a JSON schema may say here; anything else raises, as it would go unchecked
SCHEMA_WORDS = {"$schema", "$id", "title", "description", "type", "properties", "required"}
MEMBER_WORDS = {"type", "title", "description"}
JSON_TYPES = {
    "string": r"^STRING",
    "integer": r"^(BIGINT|DECIMAL\(\d+,0\))",
    "number": r"^(BIGINT|DECIMAL|DOUBLE|FLOAT)",
    "boolean": r"^BOOLEAN",
    "array": r"^ARRAY",
    "object": r"^OBJECT",
    "null": r"^VOID",
}


def _of_json_type(value: Column, declared: str | list[str]) -> Column:
    names = [declared] if isinstance(declared, str) else declared
    if unknown := sorted(set(names) - set(JSON_TYPES)):
        raise ValueError(f"JSON schema types not supported: {unknown}")
    return F.schema_of_variant(value).rlike("|".join(JSON_TYPES[n] for n in names))


@row_check("column_values_to_match_json_schema")
def _json_schema(a: dict[str, Any], c: Column) -> Column:
    """Types of the document and its members, and required members; other keywords raise."""
    schema = a["json_schema"]
    members = schema.get("properties", {})
    unknown = set(schema) - SCHEMA_WORDS
    unknown |= {word for member in members.values() for word in set(member) - MEMBER_WORDS}
    if unknown:
        raise ValueError(f"JSON schema keywords not supported: {sorted(unknown)}")
    parsed = F.try_parse_json(c)
    ok = parsed.isNotNull()
    if "type" in schema:
        ok = ok & _of_json_type(parsed, schema["type"])
    for name in {*members, *schema.get("required", [])}:
        value = F.try_variant_get(parsed, f"$['{name}']", "variant")
        if name in schema.get("required", []):
            ok = ok & value.isNotNull()
        if "type" in members.get(name, {}):
            ok = ok & (value.isNull() | _of_json_type(value, members[name]["type"]))
    return F.coalesce(ok, F.lit(False))


def _z_score(df: DataFrame, a: dict[str, Any], c: Column) -> Column:
    x = F.col(a["column"])
    stats = df.agg(F.struct(F.avg(x).alias("mean"), F.stddev_samp(x).alias("spread"))).scalar()
    z = (c.cast("double") - stats.getField("mean")) / stats.getField("spread")
    return (F.abs(z) if a.get("double_sided", True) else z) < a["threshold"]


# ---------------------------------------------------------------- single-value checks

COLUMN_METRICS: dict[str, Callable[[Column], Column]] = {
    "column_max_to_be_between": F.max,
    "column_min_to_be_between": F.min,
    "column_mean_to_be_between": F.avg,
    "column_sum_to_be_between": F.sum,
    "column_stdev_to_be_between": F.stddev_samp,
}
SCHEMA_KINDS = {
    "column_to_exist",
    "column_values_to_be_in_type_list",
    "column_values_to_be_of_type",
    "table_column_count_to_be_between",
    "table_column_count_to_equal",
    "table_columns_to_match_ordered_list",
    "table_columns_to_match_set",
}
REPEAT_KINDS = {
    "column_values_to_be_unique",
    "compound_columns_to_be_unique",
    "column_unique_value_count_to_be_between",
    "column_proportion_of_unique_values_to_be_between",
    "column_most_common_value_to_be_in_set",
}
QUANTILE_KINDS = {"column_median_to_be_between", "column_quantile_values_to_be_between"}
ORDER_KINDS = {"column_values_to_be_increasing", "column_values_to_be_decreasing"}

# fixed values: type names a suite may use for each Spark type
TYPE_NAMES = {
    "string": {"STRING", "TEXT", "VARCHAR", "STR"},
    "bigint": {"BIGINT", "LONG", "INT64"},
    "int": {"INT", "INTEGER", "INT32"},
    "smallint": {"SMALLINT", "SHORT", "INT16"},
    "double": {"DOUBLE", "DOUBLE_PRECISION", "FLOAT64", "FLOAT"},
    "float": {"FLOAT", "REAL", "FLOAT32"},
    "boolean": {"BOOLEAN", "BOOL"},
    "date": {"DATE"},
    "timestamp": {"TIMESTAMP", "DATETIME", "TIMESTAMPTZ"},
    "timestamp_ntz": {"TIMESTAMP", "DATETIME", "TIMESTAMP_NTZ"},
}


def _schema_check(df: DataFrame, e: Expectation) -> tuple[float | None, bool]:
    a, names = e.args, df.columns
    if e.kind == "column_to_exist":
        at = a.get("column_index")
        ok = a["column"] in names and (at is None or names.index(a["column"]) == at)
        return None, ok
    if e.kind == "table_column_count_to_equal":
        return float(len(names)), len(names) == a["value"]
    if e.kind == "table_column_count_to_be_between":
        low, high = a.get("min_value"), a.get("max_value")
        ok = (low is None or len(names) >= low) and (high is None or len(names) <= high)
        return float(len(names)), ok
    if e.kind == "table_columns_to_match_ordered_list":
        return None, names == list(a["column_list"])
    if e.kind == "table_columns_to_match_set":
        wanted = set(a["column_set"])
        return None, set(names) == wanted if a.get("exact_match", True) else wanted <= set(names)
    spark_name = df.schema[a["column"]].dataType.simpleString()
    known = TYPE_NAMES.get(spark_name, set()) | {spark_name.upper()}
    wanted = a["type_list"] if "type_list" in a else [a["type_"]]
    return None, bool(known & {w.upper() for w in wanted})


def _report_row(i: int, e: Expectation, n, missing, unexpected, observed, ok) -> Column:
    return F.struct(
        F.lit(i).cast("int").alias("ordinal"),
        F.lit(f"expect_{e.kind}").alias("expectation"),
        F.lit(e.label).cast("string").alias("column"),
        n.cast("bigint").alias("element_count"),
        missing.cast("bigint").alias("missing_count"),
        unexpected.cast("bigint").alias("unexpected_count"),
        observed.cast("double").alias("observed"),
        F.coalesce(ok, F.lit(False)).alias("success"),
    )



def _null() -> Column:
    return F.lit(None)


def _measures(
    df: DataFrame, checks: list[tuple[int, Expectation]], other: DataFrame | None
) -> tuple[list[Column], list[Column]]:
    """(aggregates, report rows over them) of row-wise checks, column metrics and counts."""
    aggs: dict[str, Column] = {"__rows": F.count(F.lit(1))}
    rows: list[Callable[[], Column]] = []
    total = F.col("__rows")

    def counted(name: str, condition: Column) -> Column:
        aggs[name] = F.count_if(condition)
        return F.col(name)

    for i, e in checks:
        a, cols = e.args, [F.col(c) for c in e.columns]
        if e.kind in ("column_values_to_not_be_null", "column_values_to_be_null"):
            missing = counted(f"m{i}", cols[0].isNull())
            bad = missing if e.kind == "column_values_to_not_be_null" else total - missing
            rows.append(
                _report_row(i, e, total, missing, bad, _null(), total - bad >= e.mostly * total)
            )
        elif e.kind in ROW_CHECKS or e.kind == "column_value_z_scores_to_be_less_than":
            skipped = _any([c.isNull() for c in cols])
            if a.get("ignore_row_if") == "never":
                skipped = F.lit(False)
            elif a.get("ignore_row_if") in ("both_values_are_missing", "all_values_are_missing"):
                skipped = _all([c.isNull() for c in cols])
            if e.kind in ROW_CHECKS:
                good = ROW_CHECKS[e.kind](a, *cols)
            else:
                good = _z_score(df, a, cols[0])
            bad = counted(f"b{i}", ~skipped & ~F.coalesce(good, F.lit(False)))
            missing = counted(f"m{i}", skipped)
            ok = total - missing - bad >= e.mostly * (total - missing)
            rows.append(_report_row(i, e, total, missing, bad, _null(), ok))
        elif e.kind in COLUMN_METRICS:
            aggs[f"o{i}"] = COLUMN_METRICS[e.kind](cols[0])
            seen, missing = F.col(f"o{i}"), counted(f"m{i}", cols[0].isNull())
            rows.append(_report_row(i, e, total, missing, _null(), seen, _in_range(seen, a)))
        elif e.kind == "column_distinct_values_to_contain_set":
            found = [counted(f"f{i}_{j}", cols[0] == v) for j, v in enumerate(a["value_set"])]
            missing = counted(f"m{i}", cols[0].isNull())
            absent = reduce(lambda x, y: x + y, [(f == 0).cast("int") for f in found])
            rows.append(_report_row(i, e, total, missing, absent, _null(), absent == 0))
        elif e.kind == "column_distinct_values_to_equal_set":
            found = [counted(f"f{i}_{j}", cols[0] == v) for j, v in enumerate(a["value_set"])]
            missing = counted(f"m{i}", cols[0].isNull())
            extra = counted(f"b{i}", ~cols[0].isin(list(a["value_set"])))
            ok = _all([f > 0 for f in found]) & (extra == 0)
            rows.append(_report_row(i, e, total, missing, extra, _null(), ok))
        elif e.kind == "table_row_count_to_be_between":
            rows.append(_report_row(i, e, total, _null(), _null(), total, _in_range(total, a)))
        elif e.kind == "table_row_count_to_equal":
            rows.append(_report_row(i, e, total, _null(), _null(), total, total == a["value"]))
        elif e.kind == "table_row_count_to_equal_other_table":
            if other is None:
                raise ValueError("pass the other table to validate()")
            there = other.agg(F.count(F.lit(1))).scalar()
            rows.append(_report_row(i, e, total, _null(), _null(), total, total == there))
        elif e.kind in SCHEMA_KINDS:
            seen, ok = _schema_check(df, e)
            rows.append(
                _report_row(i, e, _null(), _null(), _null(), F.lit(seen), F.lit(ok))
            )
        else:
            raise ValueError(f"unknown expectation {e.kind}")
    return [c.alias(n) for n, c in aggs.items()], rows


def _one_pass(df: DataFrame, checks: list[tuple[int, Expectation]], other: DataFrame | None) -> DataFrame:
    """One aggregation, one row, then one row for each check."""
    aggs, rows = _measures(df, checks, other)
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


MOST_REPEAT_CHECKS = 100  # that share a pass; seven bits of a digest say which one it is of


def _digest(i: int, cols: list[Column]) -> tuple[Column, Column]:
    """A value of check ``i`` as two numbers: the check and 120 bits of hash. The second is NULL where no column
    has a value. NULLs count by their place."""
    some = ~_all([c.isNull() for c in cols])
    absent = [F.array(*[c.isNull() for c in cols])] if len(cols) > 1 else []
    one, two = F.xxhash64(F.lit(1), *absent, *cols), F.xxhash64(F.lit(2), *absent, *cols)
    first = F.when(some, one.bitwiseAND(F.lit((1 << 56) - 1))).otherwise(F.lit(0).cast("bigint"))
    return first.bitwiseOR(F.lit(i << 56)), F.when(some, two)


def _repeats(df: DataFrame, checks: list[tuple[int, Expectation]]) -> DataFrame:
    """All checks about repeated values share one scan and one shuffle.

    Each row is turned into one digest per check, counted with map-side aggregation, so a value
    held by very many rows is no heavier than another. Two numbers and a count travel, however long
    the values are; 120 bits take 10^18 values for a chance of one in two that any two collide.
    """
    digests = []
    for j, (_, e) in enumerate(checks):
        cols = [F.col(c) for c in e.columns]
        one, two = _digest(j, [cols[0].cast("string")] if len(cols) == 1 else cols)
        digests.append(F.struct(one.alias("d1"), two.alias("d2")))
    counted = (
        df.select(F.inline(F.array(*digests)))
        .groupBy("d1", "d2")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("i", F.shiftright("d1", 56))
    )
    known = F.col("d2").isNotNull()
    per = counted.groupBy("i").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("missing"),
        F.count_if(known).alias("distinct"),
        F.coalesce(F.sum(F.when(known & (F.col("n") > 1), F.col("n"))), F.lit(0)).alias("repeated"),
        F.max(F.when(known, F.col("n"))).alias("top"),
    )
    modal = [(j, e) for j, (_, e) in enumerate(checks) if e.kind == "column_most_common_value_to_be_in_set"]
    if modal:
        # one row per check on the right: bounded by the suite, not by the data
        tops = F.broadcast(per.select(F.col("i").alias("j"), "top"))
        hits = counted.join(tops, (F.col("i") == F.col("j")) & (F.col("n") == F.col("top")))
        listed = [_digest(j, [F.lit(str(x))]) for j, e in modal for x in e.args["value_set"]]
        wanted = _any([(F.col("d1") == one) & (F.col("d2") == two) for one, two in listed] or [F.lit(False)])
        strays = hits.where(known).groupBy("i").agg(
            F.count_if(~wanted).alias("strays"), F.count_if(wanted).alias("wanted")
        )
        strays = strays.withColumnRenamed("i", "j")
        per = per.join(F.broadcast(strays), F.col("i") == F.col("j"), "left").drop("j")
    rows = []
    for j, (i, e) in enumerate(checks):
        a, present = e.args, F.col("rows") - F.col("missing")
        unexpected, observed = _null(), _null()
        if e.kind in ("column_values_to_be_unique", "compound_columns_to_be_unique"):
            unexpected = F.col("repeated")
            ok = present - F.col("repeated") >= e.mostly * present
        elif e.kind == "column_unique_value_count_to_be_between":
            observed, ok = F.col("distinct"), _in_range(F.col("distinct"), a)
        elif e.kind == "column_proportion_of_unique_values_to_be_between":
            observed = F.when(present > 0, F.col("distinct") / present)
            ok = _in_range(observed, a)
        else:
            unexpected = F.coalesce(F.col("strays"), F.lit(0))
            ok = F.col("wanted") > 0 if a.get("ties_okay", False) else unexpected == 0
        row = _report_row(i, e, F.col("rows"), F.col("missing"), unexpected, observed, ok)
        rows.append(F.when(F.col("i") == j, F.array(row)))
    return per.select(F.inline(F.coalesce(*rows)))


def _quantiles(df: DataFrame, i: int, e: Expectation) -> DataFrame:
    a, column = e.args, e.args["column"]
    if e.kind == "column_median_to_be_between":
        probabilities, ranges = [0.5], [(a.get("min_value"), a.get("max_value"))]
    else:
        probabilities = a["quantile_ranges"]["quantiles"]
        ranges = a["quantile_ranges"]["value_ranges"]
    q = exact_quantiles(df.where(F.col(column).isNotNull()), [], column, probabilities, "q")
    inside = [
        _in_range(F.get("q", j), {"min_value": lo, "max_value": hi})
        for j, (lo, hi) in enumerate(ranges)
    ]
    outside = reduce(lambda x, y: x + y, [(~ok).cast("int") for ok in inside])
    observed = F.get("q", 0) if len(probabilities) == 1 else _null()
    row = _report_row(i, e, _null(), _null(), outside, observed, _all(inside))
    return q.select(F.inline(F.array(row)))


ORDERED_SLICE_ROWS = 100_000


def _ordered(df: DataFrame, i: int, e: Expectation, row_order: list[str]) -> DataFrame:
    """Each value against the one before it in ``row_order`` (a table has no order of its own)."""
    a, column = e.args, e.args["column"]
    rows = df.where(F.col(column).isNotNull()).select(
        F.lit(1).alias("__all"), F.col(column).alias("__v"), *[F.col(o).alias(f"__o_{o}") for o in row_order]
    )
    # one key for the whole table: cut into slices of this many rows, however large it is
    steps = with_previous(rows, ["__all"], [f"__o_{o}" for o in row_order], {"__p": "__v"}, ORDERED_SLICE_ROWS)
    up = e.kind == "column_values_to_be_increasing"
    first, second = (F.col("__p"), F.col("__v")) if up else (F.col("__v"), F.col("__p"))
    good = first < second if a.get("strictly") else first <= second
    counted = steps.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("__p").isNotNull() & ~good).alias("bad")
    )
    ok = F.col("n") - F.col("bad") >= e.mostly * F.col("n")
    row = _report_row(i, e, F.col("n"), F.lit(0), F.col("bad"), _null(), ok)
    return counted.select(F.inline(F.array(row)))


def _divergence(df: DataFrame, i: int, e: Expectation) -> DataFrame:
    """Sum of p * ln(p / q) of the observed shares p against the declared weights q."""
    a, column = e.args, e.args["column"]
    weights = a["partition_object"]
    declared = df.sparkSession.createDataFrame(
        [(str(v), float(w)) for v, w in zip(weights["values"], weights["weights"])],
        "__value string, __q double",
    )
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("string").alias("__seen"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # the declared weights are written out in the suite, so the right side has a fixed size
    joined = counts.join(F.broadcast(declared), F.col("__seen") == F.col("__value"), "left")
    sums = joined.agg(
        F.sum("n").alias("n"),
        F.count_if(F.coalesce(F.col("__q"), F.lit(0.0)) == 0).alias("undeclared"),
        F.sum(F.when(F.col("__q") > 0, F.col("n") * F.ln(F.col("n") / F.col("__q")))).alias("s"),
    )
    kl = F.when(F.col("undeclared") == 0, F.col("s") / F.col("n") - F.ln("n"))
    row = _report_row(
        i, e, F.col("n"), _null(), F.col("undeclared"), kl, kl <= F.lit(float(a["threshold"]))
    )
    return sums.select(F.inline(F.array(row)))


def validate(
    df: DataFrame,
    suite: list[Expectation],
    other: DataFrame | None = None,
    row_order: list[str] | None = None,
) -> DataFrame:
    """The report of a suite on a table. ``other`` serves the row-count comparison of two tables,
    ``row_order`` the checks for increasing and decreasing values."""
    return _report(df, list(enumerate(suite)), other, row_order)


def _taken_in_one_pass(e: Expectation) -> bool:
    special = QUANTILE_KINDS | ORDER_KINDS | REPEAT_KINDS | {"column_kl_divergence_to_be_less_than"}
    return e.kind not in special


class Watched:
    """A suite whose metrics are taken while its table is written: ``rows`` are what to write.

    The checks that one aggregation of the table answers are observed on the way; ``report`` adds those that
    need a pass of their own. The metrics are exact if nothing is shuffled between ``rows`` and the writing,
    as tasks then count once, however often they are tried.
    """

    def __init__(
        self,
        df: DataFrame,
        suite: list[Expectation],
        other: DataFrame | None = None,
        row_order: list[str] | None = None,
    ) -> None:
        numbered = list(enumerate(suite))
        # deviations are measured against mean and spread, which an earlier pass must find
        self._observed = [
            (i, e) for i, e in numbered if _taken_in_one_pass(e) and e.kind != "column_value_z_scores_to_be_less_than"
        ]
        self._left = [(i, e) for i, e in numbered if (i, e) not in self._observed]
        self._other, self._row_order = other, row_order
        aggs, self._lines = _measures(df, self._observed, other)
        self._schema = df.agg(*aggs).schema
        self._metrics = Observation()
        self.rows = df.observe(self._metrics, *aggs)

    def _measured(self, written: DataFrame) -> DataFrame:
        values = self._metrics.get
        if not values:  # Spark leaves out what it knows to be empty
            return written.agg(*_measures(written, self._observed, self._other)[0])
        return written.sparkSession.createDataFrame([tuple(values[n] for n in self._schema.names)], self._schema)

    def row_count(self) -> int:
        """How many rows were written; only after that."""
        return (self._metrics.get or {"__rows": 0})["__rows"]

    def report(self, written: DataFrame) -> DataFrame:
        """The suite's report on the written table; only after it is written."""
        parts = []
        if self._lines:
            parts.append(self._measured(written).select(F.inline(F.array(*self._lines))))
        if self._left or not parts:
            parts.append(_report(written, self._left, self._other, self._row_order))
        return reduce(DataFrame.unionByName, parts)


def _report(
    df: DataFrame, numbered: list[tuple[int, Expectation]], other: DataFrame | None, row_order: list[str] | None
) -> DataFrame:
    repeat = [(i, e) for i, e in numbered if e.kind in REPEAT_KINDS]
    simple = [(i, e) for i, e in numbered if _taken_in_one_pass(e)]
    parts = []
    if simple:
        parts.append(_one_pass(df, simple, other))
    for at in range(0, len(repeat), MOST_REPEAT_CHECKS):
        parts.append(_repeats(df, repeat[at : at + MOST_REPEAT_CHECKS]))
    for i, e in numbered:
        if e.kind in QUANTILE_KINDS:
            parts.append(_quantiles(df, i, e))
        elif e.kind in ORDER_KINDS:
            if not row_order:
                raise ValueError(f"{e.kind} needs row_order")
            parts.append(_ordered(df, i, e, row_order))
        elif e.kind == "column_kl_divergence_to_be_less_than":
            parts.append(_divergence(df, i, e))
    if not parts:
        return df.sparkSession.createDataFrame([], REPORT_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def summarized(report: DataFrame, result_format: str = "SUMMARY") -> DataFrame:
    """BOOLEAN_ONLY keeps the verdicts; BASIC adds counts; SUMMARY and COMPLETE add percentages."""
    verdicts = ["ordinal", "expectation", "column", "success"]
    if result_format == "BOOLEAN_ONLY":
        return report.select(*verdicts)
    counts = [*verdicts, "element_count", "missing_count", "unexpected_count", "observed"]
    if result_format == "BASIC":
        return report.select(*counts)
    present = F.nullif(F.col("element_count") - F.col("missing_count"), F.lit(0))
    return report.select(
        *counts,
        (100.0 * F.col("missing_count") / F.nullif("element_count", F.lit(0))).alias(
            "missing_percent"
        ),
        (100.0 * F.col("unexpected_count") / present).alias("unexpected_percent"),
    )


def unexpected_rows(df: DataFrame, e: Expectation) -> DataFrame:
    """The rows a row-wise, null or uniqueness check complains about (the COMPLETE detail)."""
    cols = [F.col(c) for c in e.columns]
    if e.kind == "column_values_to_not_be_null":
        return df.where(cols[0].isNull())
    if e.kind == "column_values_to_be_null":
        return df.where(cols[0].isNotNull())
    if e.kind in ("column_values_to_be_unique", "compound_columns_to_be_unique"):
        repeated = df.groupBy(*e.columns).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
        return df.join(repeated.select(*e.columns), e.columns, "left_semi")
    good = ROW_CHECKS[e.kind](e.args, *cols)
    return df.where(_all([c.isNotNull() for c in cols]) & ~F.coalesce(good, F.lit(False)))


def not_unique_values(df: DataFrame, column: str) -> DataFrame:
    """Model test 'unique': offending values with their count."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column)
    return counts.agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def null_rows(df: DataFrame, column: str) -> DataFrame:
    """Model test 'not_null': offending rows."""
    return df.where(F.col(column).isNull())


# fixed values: candidate patterns the profiler tries on text columns
CANDIDATE_REGEXES = {
    "digits": r"^\d+$",
    "decimal": r"^-?\d+(\.\d+)?$",
    "letters": r"^[A-Za-z]+$",
    "date": r"^\d{4}-\d{2}-\d{2}$",
    "timestamp": r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?Z?$",
    "no_leading_space": r"^\S",
    "no_trailing_space": r"\S$",
}


def profile(
    df: DataFrame,
    columns: list[str] | None = None,
    candidates: dict[str, str] | None = None,
) -> DataFrame:
    """Derive expectations from a table: rows of (column, expectation, kwargs as JSON).

    One wide aggregation gathers everything: row count, column set, value range of numbers,
    length range and best matching pattern of texts, share of non-NULL values.
    """
    candidates = candidates or CANDIDATE_REGEXES
    names = columns or df.columns
    numeric = [c for c in names if isinstance(df.schema[c].dataType, T.NumericType)]
    texts = [c for c in names if isinstance(df.schema[c].dataType, T.StringType)]
    aggs = {"__rows": F.count(F.lit(1))}
    for c in names:
        aggs[f"n_{c}"] = F.count(c)
    for c in numeric:
        aggs[f"lo_{c}"], aggs[f"hi_{c}"] = F.min(c), F.max(c)
    for c in texts:
        aggs[f"lo_{c}"], aggs[f"hi_{c}"] = F.min(F.length(c)), F.max(F.length(c))
        for r, pattern in candidates.items():
            aggs[f"re_{r}_{c}"] = F.count_if(F.col(c).rlike(pattern))
    one = df.agg(*[a.alias(n) for n, a in aggs.items()])

    def row(column, kind, when=None, **kwargs):
        body = F.to_json(F.struct(*[v.alias(k) for k, v in kwargs.items()]))
        made = F.struct(
            F.lit(column).cast("string").alias("column"),
            F.lit(f"expect_{kind}").alias("expectation"),
            body.alias("kwargs"),
        )
        return F.array(made) if when is None else F.when(when, F.array(made)).otherwise(F.array())

    total = F.col("__rows")
    rows = [
        row(None, "table_row_count_to_be_between", min_value=total, max_value=total),
        row(None, "table_columns_to_match_set", column_set=F.array(*[F.lit(c) for c in df.columns])),
    ]
    for c in names:
        seen = F.col(f"n_{c}")
        share = F.round(seen / F.nullif(total, F.lit(0)), 6)
        rows.append(row(c, "column_values_to_not_be_null", seen > 0, mostly=share))
    for c in numeric:
        rows.append(
            row(
                c,
                "column_values_to_be_between",
                F.col(f"n_{c}") > 0,
                min_value=F.col(f"lo_{c}"),
                max_value=F.col(f"hi_{c}"),
            )
        )
    for c in texts:
        seen = F.col(f"n_{c}")
        rows.append(
            row(
                c,
                "column_value_lengths_to_be_between",
                seen > 0,
                min_value=F.col(f"lo_{c}"),
                max_value=F.col(f"hi_{c}"),
            )
        )
        best = F.greatest(*[F.col(f"re_{r}_{c}") for r in candidates], F.lit(-1))
        pattern = F.coalesce(
            *[F.when(F.col(f"re_{r}_{c}") == best, F.lit(p)) for r, p in candidates.items()]
        )
        rows.append(
            row(
                c,
                "column_values_to_match_regex",
                (seen > 0) & (best > 0),
                regex=pattern,
                mostly=F.round(best / F.nullif(seen, F.lit(0)), 6),
            )
        )
    return one.select(F.inline(F.concat(*rows)))
