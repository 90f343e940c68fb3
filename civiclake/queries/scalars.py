"""Column expressions, one query per family."""

from __future__ import annotations

from pyspark.sql import functions as F

from civiclake.functions import casting as C
from civiclake.functions import dates as D
from civiclake.functions import text as X
from civiclake.plans.classes import CLASS_DESCRIPTIONS
from civiclake.plans.parcels import code_lookup, same_or_null
from civiclake.queries.base import dealt, query

CLASS_VALUES = ", ".join(
    "('{}', '{}')".format(k, v.replace("'", "''")) for k, v in CLASS_DESCRIPTIONS.items()
)


@query(
    "surrogate_keys",
    """SELECT l_orderkey, l_linenumber, l_partkey,
    md5(concat_ws('-', l_orderkey::VARCHAR, l_linenumber::VARCHAR, l_returnflag,
        coalesce(CASE WHEN l_linestatus <> 'O' THEN l_linestatus END,
                 '_dbt_utils_surrogate_key_null_'))) AS record_id
    FROM lineitem""",
)
def _(t):
    """md5 of several key columns, one of them NULL at times."""
    status = F.when(F.col("l_linestatus") != "O", F.col("l_linestatus"))
    key = X.surrogate_key(["l_orderkey", "l_linenumber", "l_returnflag", status])
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", key.alias("record_id"))


@query(
    "text_expressions",
    """SELECT c_custkey, upper(c_name) AS up, lpad(c_custkey::VARCHAR, 14, '0') AS padded,
    lpad(c_custkey::VARCHAR, 2, '0') AS cut,
    regexp_replace(upper(c_name), '[^A-Z ]', '', 'g') AS letters,
    regexp_replace(c_name, '[^0-9]', '', 'g') AS digits,
    regexp_replace(upper(c_name), '([0-9])[^0-9]', '\\1', 'g') AS after_digit,
    regexp_replace(regexp_replace(c_name, '[^0-9]', '', 'g'), '^0', '') AS one_zero_less,
    split_part(c_name, '#', 1) AS before_hash,
    concat(c_mktsegment, CASE WHEN c_acctbal > 0 THEN c_name END) AS joined,
    c_mktsegment || CASE WHEN c_acctbal > 0 THEN c_name END AS joined_or_null,
    length(c_mktsegment)::INTEGER AS n_chars,
    regexp_replace(c_mktsegment, 'ING$', '') AS no_suffix,
    md5(c_name) AS digest,
    replace(format('{:,}', (c_acctbal * 100)::BIGINT), ',', '')::BIGINT AS cents,
    concat_ws(',', trim(' ' || c_mktsegment), trim(c_name || ' ')) AS listed,
    CASE WHEN c_mktsegment LIKE '%MACH%' THEN 'UNKNOWN' ELSE c_mktsegment END AS category
    FROM customer""",
)
def _(t):
    c = F.col
    grouped = F.regexp_replace(
        F.format_string("%,d", F.round(c("c_acctbal") * 100).cast("bigint")), "x", ""
    )
    return t.customer.select(
        "c_custkey",
        C.text("c_name").alias("up"),
        X.zero_padded("c_custkey", 14).alias("padded"),
        X.zero_padded("c_custkey", 2).alias("cut"),
        X.strip_all(C.text("c_name"), "[^A-Z ]").alias("letters"),
        X.strip_all("c_name", "[^0-9]").alias("digits"),
        X.letters_after_digit_removed(C.text("c_name")).alias("after_digit"),
        X.strip_leading(X.strip_all("c_name", "[^0-9]"), "0").alias("one_zero_less"),
        X.before("c_name", "#").alias("before_hash"),
        X.joined_skipping_nulls(
            "c_mktsegment", F.when(c("c_acctbal") > 0, c("c_name"))
        ).alias("joined"),
        X.joined_or_null("c_mktsegment", F.when(c("c_acctbal") > 0, c("c_name"))).alias(
            "joined_or_null"
        ),
        F.length("c_mktsegment").alias("n_chars"),
        X.without_suffix("c_mktsegment", "ING").alias("no_suffix"),
        F.md5("c_name").alias("digest"),
        X.strip_commas(grouped).alias("cents"),
        X.comma_list(
            F.array(F.concat(F.lit(" "), "c_mktsegment"), F.concat("c_name", F.lit(" ")))
        ).alias("listed"),
        X.normalized_category("c_mktsegment", ("BUILDING",), "%MACH%").alias("category"),
    )


@query(
    "cast_matrix",
    """SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice,
    round_even((l_extendedprice::FLOAT)::DOUBLE, 0)::BIGINT AS real_rounded,
    round(l_extendedprice::DECIMAL(38,10))::BIGINT AS numeric_rounded,
    l_extendedprice::DECIMAL(19,2) AS paid,
    -(l_tax::DECIMAL(19,2)) AS owed,
    CASE l_returnflag WHEN 'A' THEN true WHEN 'N' THEN false ELSE true END AS word_flag,
    (l_linenumber - 1) <> 0 AS int_flag,
    l_linenumber::SMALLINT AS small, l_quantity::INTEGER AS quantity,
    substr(l_extendedprice::DECIMAL(19,2)::VARCHAR, 1, 4) AS cut,
    rtrim(substr(l_linestatus || '   ', 1, 3)) AS fixed,
    try_cast(l_returnflag AS INTEGER) AS lenient
    FROM lineitem""",
)
def _(t):
    c = F.col
    price = c("l_extendedprice")
    word = F.when(c("l_returnflag") == "A", "on").when(c("l_returnflag") == "N", "off")
    amount = F.concat(F.lit("$"), F.format_number(price.cast("decimal(19,2)"), 2))
    owed = F.concat(F.lit("($"), c("l_tax").cast("decimal(19,2)").cast("string"), F.lit(")"))
    return dealt(t.lineitem).select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "l_extendedprice",
        C.real_to_bigint(price).alias("real_rounded"),
        C.numeric_to_bigint(price).alias("numeric_rounded"),
        C.money(amount).alias("paid"),
        C.money(owed).alias("owed"),
        C.boolean(word.otherwise("yes")).alias("word_flag"),
        C.int_to_boolean(c("l_linenumber") - 1).alias("int_flag"),
        C.smallint("l_linenumber").alias("small"),
        C.integer("l_quantity").alias("quantity"),
        C.varchar(price.cast("decimal(19,2)"), 4).alias("cut"),
        C.char(F.concat("l_linestatus", F.lit("   ")), 3).alias("fixed"),
        C.integer("l_returnflag", lenient=True).alias("lenient"),
    )


@query(
    "date_expressions",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month_label,
    date_trunc('month', o_orderdate)::DATE AS month_start,
    month(o_orderdate)::INTEGER AS month_no, hour(o_orderdate)::INTEGER AS hour_no,
    o_orderdate::DATE AS us_date, make_date(year(o_orderdate), 1, 1) AS year_start,
    (DATE '2002-01-01' - o_orderdate::DATE)::INTEGER AS days,
    nullif((DATE '1998-01-01' - o_orderdate::DATE)::DOUBLE / 365.2422, 0) AS years,
    timezone('America/Chicago', o_orderdate)::TIMESTAMP AS reinterpreted,
    o_orderdate AS converted,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS published
    FROM orders""",
)
def _(t):
    day, c = F.col("o_orderdate"), F.col
    us = F.date_format(day, "MM/dd/yyyy")
    published = D.published_text(day)
    return t.orders.select(
        "o_orderkey",
        D.month_label(day).alias("month_label"),
        D.month_start_of_label(D.month_label(day)).alias("month_start"),
        F.month(day).alias("month_no"),
        F.hour(day).alias("hour_no"),
        C.date(us, ("MM/dd/yyyy", "yyyy-MM-dd")).alias("us_date"),
        C.year_start(F.year(day)).alias("year_start"),
        D.days_between(F.lit("2002-01-01").cast("date"), day.cast("date")).alias("days"),
        D.years_between(F.lit("1998-01-01").cast("date"), day.cast("date")).alias("years"),
        C.zoned_timestamp(published).cast("timestamp_ntz").alias("reinterpreted"),
        C.zoned_timestamp(published, tz_mode="convert").cast("timestamp_ntz").alias("converted"),
        published.alias("published"),
    )


@query(
    "published_times_parsed",
    """SELECT event_id, date_trunc('second', ts) AS whole, ts AS fraction FROM events""",
)
def _(t):
    """ISO text with and without a fraction of a second, back to times."""
    ts = F.col("ts")
    exact = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return t.events.select(
        "event_id",
        D.published_timestamp(D.published_text(ts)).cast("timestamp_ntz").alias("whole"),
        D.published_timestamp(exact).cast("timestamp_ntz").alias("fraction"),
    )


@query(
    "null_logic",
    """WITH c AS (SELECT *, CASE WHEN c_nationkey < 20 THEN c_mktsegment END AS a,
                 CASE WHEN c_acctbal > 0 THEN 'BUILDING' END AS b FROM customer)
    SELECT c_custkey, CASE WHEN a = b THEN true WHEN a <> b AND a IS NOT NULL AND b IS NOT NULL
                      THEN false END AS same,
    CASE WHEN c_acctbal < 1000 THEN NULL ELSE c_acctbal END AS trimmed,
    nullif(a, 'MACHINERY') AS no_sentinel,
    CASE WHEN a IS NULL OR b IS NULL THEN NULL ELSE c_custkey END AS both_known,
    c_acctbal / nullif(c_nationkey, 0) AS ratio,
    coalesce(a = b, false) AS filled, 1 AS retention_priority
    FROM c""",
)
def _(t):
    """Three-valued comparison, conditional NULLs, guarded division, filled flags."""
    c = F.col
    rows = t.customer.withColumns(
        {
            "a": F.when(c("c_nationkey") < 20, c("c_mktsegment")),
            "b": F.when(c("c_acctbal") > 0, "BUILDING"),
        }
    )
    made = rows.select(
        "c_custkey",
        same_or_null("a", "b").alias("same"),
        F.when(~(c("c_acctbal") < 1000), c("c_acctbal")).alias("trimmed"),
        F.nullif("a", F.lit("MACHINERY")).alias("no_sentinel"),
        F.when(c("a").isNotNull() & c("b").isNotNull(), c("c_custkey")).alias("both_known"),
        (c("c_acctbal") / F.nullif("c_nationkey", F.lit(0))).alias("ratio"),
        (c("a") == c("b")).alias("filled"),
        F.lit(1).alias("retention_priority"),
    )
    return made.na.fill(False, ["filled"])


CLASS_SQL = "(200 + o_orderkey % 100)::VARCHAR"


@query(
    "class_code_lookup",
    f"""WITH codes(code, descr) AS (VALUES {CLASS_VALUES}),
    o AS (SELECT o_orderkey, {CLASS_SQL} AS class FROM orders)
    SELECT o_orderkey, class, descr AS class_descr FROM o LEFT JOIN codes ON class = code""",
)
def _(t):
    """Code to description through a fixed-size broadcast table; unknown codes give NULL."""
    rows = t.orders.select(
        "o_orderkey", (F.lit(200) + F.col("o_orderkey") % 100).cast("string").alias("class")
    )
    return code_lookup(rows, "class", CLASS_DESCRIPTIONS, "class_descr")


@query(
    "arithmetic_and_power",
    """SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice,
    l_extendedprice * (1 - l_discount) AS net, l_extendedprice / nullif(l_quantity, 0) AS unit,
    printf('%.9e', power(1 + l_discount, 1 / (l_linenumber + 0.5))) AS rate
    FROM lineitem""",
)
def _(t):
    c = F.col
    rate = F.pow(1 + c("l_discount"), 1 / (c("l_linenumber") + F.lit(0.5)))
    return t.lineitem.select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "l_extendedprice",
        (c("l_extendedprice") * (1 - c("l_discount"))).alias("net"),
        (c("l_extendedprice") / F.nullif("l_quantity", F.lit(0.0))).alias("unit"),
        F.format_string("%.9e", rate).alias("rate"),
    )


@query(
    "json_built_and_read",
    """SELECT event_id, (props->>'$.k')::BIGINT AS k,
    '{"type":"' || event_type || '","geometry":{"x":' || user_id || '}}' AS feature,
    event_type IN ('click', 'view') AS any_in_set
    FROM events""",
)
def _(t):
    c = F.col
    feature = F.to_json(
        F.struct(
            c("event_type").alias("type"), F.struct(c("user_id").alias("x")).alias("geometry")
        )
    )
    wanted = F.array(F.lit("click"), F.lit("view"))
    return t.events.select(
        "event_id",
        F.from_json("props", "struct<k:bigint>")["k"].alias("k"),
        feature.alias("feature"),
        F.arrays_overlap(F.array("event_type"), wanted).alias("any_in_set"),
    )


@query(
    "arrays_and_maps",
    """SELECT p_partkey, split_part(p_name, ' ', 1) AS first_word,
    list_contains(string_split(p_name, ' '), 'red') AS has_red,
    split_part(p_name, ' ', 2) AS looked_up, 0 AS missing_size
    FROM part""",
)
def _(t):
    """First element, membership, key/value pairs to a map, missing list as an empty one."""
    words = F.split("p_name", " ")
    pairs = F.array(
        F.struct(F.lit("colour").alias("key"), F.get(words, 0).alias("value")),
        F.struct(F.lit("thing").alias("key"), F.get(words, 1).alias("value")),
    )
    none = F.lit(None).cast("array<string>")
    return t.part.select(
        "p_partkey",
        F.get(words, 0).alias("first_word"),
        F.array_contains(words, "red").alias("has_red"),
        F.map_from_entries(pairs)["thing"].alias("looked_up"),
        F.size(F.coalesce(none, F.array().cast("array<string>"))).alias("missing_size"),
    )


# ---------------------------------------------------------------- filters, order, sets


@query(
    "filter_predicates",
    """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
    WHERE o_orderpriority <> '5-LOW' AND o_orderstatus = 'F' AND o_totalprice IS NOT NULL
    AND (o_totalprice > 1000) IS TRUE AND o_custkey IN (SELECT c_custkey FROM customer
    WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))
    AND (o_orderpriority LIKE '%URGENT' OR regexp_matches(o_orderpriority, '^[2-4]-'))""",
)
def _(t):
    """Exclusion, equality, not null, is true, in list, in subquery, suffix, regex."""
    c = F.col
    some = t.customer.where(c("c_mktsegment").isin("BUILDING", "MACHINERY"))
    rows = t.orders.where(
        (c("o_orderpriority") != "5-LOW")
        & (c("o_orderstatus") == "F")
        & c("o_totalprice").isNotNull()
        & ((c("o_totalprice") > 1000) == F.lit(True))
        & (c("o_orderpriority").endswith("URGENT") | c("o_orderpriority").rlike("^[2-4]-"))
    )
    rows = rows.join(some, c("o_custkey") == c("c_custkey"), "left_semi")
    return rows.select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query(
    "filter_above_scalar",
    """SELECT event_id, ts FROM events
    WHERE ts > (SELECT max(o_orderdate) + INTERVAL 8190 DAY FROM orders)""",
)
def _(t):
    """Compare with a single value computed from another table."""
    mark = t.orders.agg((F.max("o_orderdate") + F.expr("interval 8190 days")).alias("m")).scalar()
    return t.events.where(F.col("ts") > mark).select("event_id", "ts")


@query(
    "filter_with_null_mask",
    """WITH s AS (SELECT p_partkey, CASE WHEN p_size > 10 THEN p_size END AS cached, p_retailprice
                  FROM part)
    SELECT * FROM s WHERE cached IS NULL OR p_retailprice > cached * 50""",
)
def _(t):
    c = F.col
    rows = t.part.select(
        "p_partkey", F.when(c("p_size") > 10, c("p_size")).alias("cached"), "p_retailprice"
    )
    return rows.where(c("cached").isNull() | (c("p_retailprice") > c("cached") * 50))


@query(
    "sorted_mixed_directions",
    """SELECT o_custkey, o_orderdate, o_orderkey FROM orders
    ORDER BY o_custkey DESC NULLS FIRST, o_orderdate DESC NULLS FIRST, o_orderkey""",
)
def _(t):
    """Final output order: composite key and date descending, then ascending."""
    return t.orders.select("o_custkey", "o_orderdate", "o_orderkey").orderBy(
        F.col("o_custkey").desc_nulls_first(),
        F.col("o_orderdate").desc_nulls_first(),
        F.col("o_orderkey").asc_nulls_last(),
    )


@query(
    "first_rows",
    """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
    ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 5""",
)
def _(t):
    """See a few rows (a top-k report)."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    return rows.orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber").limit(5)


@query(
    "union_of_different_columns",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""",
)
def _(t):
    from civiclake.sources.files import concatenated

    customers = t.customer.selectExpr("c_custkey id", "c_name name", "c_mktsegment segment")
    return concatenated(customers, t.supplier.selectExpr("s_suppkey id", "s_name name"))


@query("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def _(t):
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query(
    "explicit_columns",
    """SELECT l_partkey AS part, l_quantity::INTEGER AS units, l_orderkey AS document,
       l_shipdate::DATE AS shipped FROM lineitem""",
)
def _(t):
    """Rename, retype and reorder; only four columns are read."""
    return t.lineitem.select(
        F.col("l_partkey").alias("part"),
        C.integer("l_quantity").alias("units"),
        F.col("l_orderkey").alias("document"),
        C.date("l_shipdate").alias("shipped"),
    )
