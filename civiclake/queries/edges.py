"""Rows that are easily lost: NULL groups, features without properties, mixed headers, odd formats."""

from __future__ import annotations

from pyspark.sql import functions as F

from civiclake.operators import quality as Q
from civiclake.operators.quality import expect
from civiclake.operators.quantiles import exact_quantiles
from civiclake.plans import refresh as R
from civiclake.plans.scratch import fresh_path
from civiclake.queries.base import query
from civiclake.queries.quality import _report, _sql
from civiclake.sources import documents as D
from civiclake.sources import files, tables

NULL_GROUPS_SQL = """SELECT l_linenumber, round(quantile_cont(v, 0.25), 4) AS q25,
    round(quantile_cont(v, 0.9), 4) AS q90
    FROM (SELECT l_linenumber, CASE WHEN l_linenumber <> 3 THEN l_extendedprice END AS v FROM lineitem)
    GROUP BY 1"""


def _null_groups(t, limit):
    value = F.when(F.col("l_linenumber") != 3, F.col("l_extendedprice"))
    rows = t.lineitem.select("l_linenumber", value.alias("v"))
    q = exact_quantiles(rows, ["l_linenumber"], "v", [0.25, 0.9], "q", limit)
    return q.select("l_linenumber", *[F.round(F.get("q", i), 4).alias(n) for i, n in enumerate(("q25", "q90"))])


@query("exact_quantiles_null_groups", NULL_GROUPS_SQL)
def _(t):
    """A group of NULLs alone keeps its row."""
    return _null_groups(t, None)


@query("exact_quantiles_null_groups_large", NULL_GROUPS_SQL)
def _(t):
    """The same above the size limit."""
    return _null_groups(t, 100)


BARE_SQL = """SELECT CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_custkey END AS id, 'Point' AS kind,
    '[' || c_custkey || ',1]' AS coordinates FROM customer"""


def _bare_features(t, joint):
    key = F.col("c_custkey").cast("string")
    properties = F.when(F.col("c_custkey") % 5 == 0, "null").otherwise(F.concat(F.lit('{"id":'), key, F.lit("}")))
    geometry = F.concat(F.lit('{"type":"Point","coordinates":['), key, F.lit(",1]}"))
    text = F.concat(F.lit('{"type":"Feature","properties":'), properties, F.lit(',"geometry":'), geometry, F.lit("}"))
    path = fresh_path(t.spark, "geojson")
    t.customer.select(text).write.option("lineSep", joint).text(path)
    return path


@query("geojson_null_properties", BARE_SQL)
def _(t):
    """Features without properties, one per line."""
    got = files.read_geojson(t.spark, _bare_features(t, "\n"), "id bigint")
    return got.select("id", F.col("geometry.type").alias("kind"), "geometry.coordinates")


@query("geojson_null_properties_separated", BARE_SQL)
def _(t):
    """The same in one long line."""
    got = files.read_geojson(t.spark, _bare_features(t, ","), "id bigint", "separated")
    return got.select("id", F.col("geometry.type").alias("kind"), "geometry.coordinates")


@query("geojson_spaced_collection", BARE_SQL)
def _(t):
    """All customers in one file, written with blanks and further members, read by several tasks."""
    key = F.col("c_custkey").cast("string")
    properties = F.when(F.col("c_custkey") % 5 == 0, "null").otherwise(F.concat(F.lit('{ "id": '), key, F.lit(" }")))
    feature = F.concat(
        F.lit('{ "geometry": {"coordinates": ['), key, F.lit(', 1], "type": "Point"}, "properties": '), properties,
        F.lit(', "note": "} ], \\\\\\" [{", "type": "Feature" }'),
    )
    ends = t.customer.agg(F.min("c_custkey"))
    comma = F.when(F.col("c_custkey") == ends.scalar(), "").otherwise(" , ")
    lines = t.customer.select(F.col("c_custkey").alias("n"), F.concat(comma, feature).alias("value"))
    head = '{ "crs": {"features": [{"a": []}]}, "type": "FeatureCollection", "features" : \\n ['
    around = t.spark.sql(f"""SELECT * FROM VALUES (-1L, '{head}'), (9223372036854775807L, '], "links": [{{"b": 1}}] }}') AS t(n, value)""")
    path = fresh_path(t.spark, "geojson")
    # one file is one task's to write; it streams sorted rows
    lines.unionByName(around).repartition(1).sortWithinPartitions("n").select("value").write.text(path)
    got = files.read_geojson(t.spark, path, "id bigint", "document", split_bytes=100_000)
    plain = F.regexp_replace("geometry.coordinates", r"\s", "")
    return got.select("id", F.col("geometry.type").alias("kind"), plain.alias("coordinates"))


@query(
    "table_documents_mixed_headers",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS status,
    CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS priority, o_custkey::VARCHAR AS customer FROM orders""",
)
def _(t):
    """Documents of different columns: all columns, missing ones NULL."""
    c = F.col
    key = c("o_custkey").cast("string")
    even = F.array(F.array(F.lit("status"), F.lit("customer")), F.array(c("o_orderstatus"), key))
    odd = F.array(F.array(F.lit("customer"), F.lit("priority")), F.array(key, c("o_orderpriority")))
    docs = t.orders.select("o_orderkey", F.to_json(F.when(c("o_orderkey") % 2 == 0, even).otherwise(odd)).alias("doc"))
    return D.table_rows(docs, "doc").select("o_orderkey", "status", "priority", "customer")


TIME_SUITE = [expect("compound_columns_to_be_unique", column_list=["event_type", "at"])]


@query(
    "quality_compound_times",
    _sql(
        TIME_SUITE,
        [("0", "(SELECT coalesce(sum(k), 0) FROM (SELECT count(*) AS k FROM events GROUP BY event_type, event_id HAVING count(*) > 1))", None, None)],
        "events",
    ),
)
def _(t):
    """Times that differ by microseconds are different keys."""
    at = F.timestamp_micros(F.col("event_id"))
    return _report(Q.validate(t.events.withColumn("at", at), TIME_SUITE))


FORMAT_SUITE = [
    expect("column_values_to_match_strftime_format", "us", strftime_format="%m/%d/%Y"),
    expect("column_values_to_be_dateutil_parseable", "us"),
    expect("column_values_to_be_dateutil_parseable", "spoken"),
    expect("column_values_to_match_json_schema", "doc", json_schema={"type": "object", "properties": {"tags": {"type": "array"}, "n": {"type": "integer"}}, "required": ["n"]}),
    expect("column_values_to_match_json_schema", "doc", json_schema={"properties": {"n": {"type": ["integer", "null"]}}, "required": ["n"]}),
    expect("column_values_to_not_be_null", "o_orderkey", mostly=0),
]
FORMAT_CHECKS = [
    ("0", "0", None, None),
    ("0", "0", None, None),
    ("0", "0", None, None),
    ("0", "count_if(o_orderkey % 3 <> 0)", None, None),
    ("0", "0", None, None),
    ("0", "0", None, None),
]


@query("quality_formats", _sql(FORMAT_SUITE, FORMAT_CHECKS, "orders"))
def _(t):
    """Unpadded dates, spoken dates, and members of JSON documents by type."""
    day = F.col("o_orderdate")
    doc = F.expr(
        """CASE o_orderkey % 3 WHEN 0 THEN '{"n": 1, "tags": ["a"]}' WHEN 1 THEN '{"n": 1, "tags": "a"}'
        ELSE '{"n": null}' END"""
    )
    rows = t.orders.select(
        "o_orderkey", F.date_format(day, "M/d/yyyy").alias("us"), F.date_format(day, "MMM d, yyyy").alias("spoken"), doc.alias("doc")
    )
    return _report(Q.validate(rows, FORMAT_SUITE))


@Q.row_check("column_values_to_be_whole_hundreds")
def _whole_hundreds(args, column):
    return column % 100 == 0


CUSTOM_SUITE = [expect("column_values_to_be_whole_hundreds", "o_orderkey", mostly=0.005)]


@query("quality_custom_check", _sql(CUSTOM_SUITE, [("0", "count_if(o_orderkey % 100 <> 0)", None, None)], "orders"))
def _(t):
    """An expectation that a user has added."""
    return _report(Q.validate(t.orders, CUSTOM_SUITE))


@query(
    "user_models_built",
    "SELECT c_nationkey, count(*) AS n, sum(spent) AS spent FROM customer JOIN "
    "(SELECT o_custkey, sum(o_totalprice::DECIMAL(18,2)) AS spent FROM orders GROUP BY 1) ON c_custkey = o_custkey GROUP BY 1",
)
def _(t):
    """Two user-written models, the second built on the first."""
    tables.create_layers(t.spark)
    spent = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("spent")
    models = {
        "feature.customer_spending": lambda ref: t.orders.groupBy("o_custkey").agg(spent),
        "dwh.nation_spending": lambda ref: t.customer.join(ref("feature.customer_spending"), F.col("c_custkey") == F.col("o_custkey"))
        .groupBy("c_nationkey")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("spent").alias("spent")),
    }
    return R.build_models(t.spark, models)["dwh.nation_spending"]
