"""Reading landed files and documents. The documents are written from the benchmark tables row by
row, so there are as many as the tables have rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from civiclake.plans.scratch import fresh_path, written
from civiclake.queries.base import dealt, query
from civiclake.sources import documents as D
from civiclake.sources import files

NEW = "2023-07-05T19:32:45Z"


@query(
    "csv_read",
    f"""SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice,
    '{NEW}' AS source_data_updated FROM part""",
)
def _(t):
    """CSV with a header: types inferred from one pull, then fixed; provenance stamped."""
    path = fresh_path(t.spark, "csv")
    t.part.write.option("header", True).csv(path)
    inferred = files.infer_csv_schema(t.spark, path)
    schema = ", ".join(
        f"{f.name} {'bigint' if f.name == 'p_partkey' else f.dataType.simpleString()}"
        for f in inferred.fields
    )
    return files.with_constants(files.read_csv(t.spark, path, schema), source_data_updated=NEW)


@query("csv_as_text", "SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderpriority FROM orders")
def _(t):
    """Without a schema every column is text."""
    path = fresh_path(t.spark, "csv")
    t.orders.select("o_orderkey", "o_orderpriority").write.option("header", True).csv(path)
    return files.read_csv(t.spark, path)


def _features(t):
    key = F.col("c_custkey")
    coords = F.array((key * 37) % 1000, (key * 91) % 1000)
    return t.customer.select(
        F.to_json(
            F.struct(
                F.lit("Feature").alias("type"),
                F.struct(key.alias("id"), F.col("c_name").alias("name")).alias("properties"),
                F.struct(F.lit("Point").alias("type"), coords.alias("coordinates")).alias(
                    "geometry"
                ),
            )
        ).alias("value")
    )


FEATURE_SQL = """SELECT c_custkey AS id, c_name AS name, 'Point' AS kind,
'[' || (c_custkey * 37 % 1000) || ',' || (c_custkey * 91 % 1000) || ']' AS coordinates
FROM customer"""


def _flat(df):
    return df.select("id", "name", F.col("geometry.type").alias("kind"), "geometry.coordinates")


@query("geojson_lines", FEATURE_SQL)
def _(t):
    """One feature per line."""
    path = fresh_path(t.spark, "geojson")
    _features(t).write.text(path)
    return _flat(files.read_geojson(t.spark, path, "id bigint, name string"))


@query("geojson_separated", FEATURE_SQL)
def _(t):
    """Features in one long line, split at the text each of them opens with."""
    path = fresh_path(t.spark, "geojson")
    _features(t).write.option("lineSep", ",").text(path)
    return _flat(files.read_geojson(t.spark, path, "id bigint, name string", "separated"))


@query(
    "table_documents",
    """SELECT o_orderkey, unnest(['GEO-' || o_orderkey, 'GEO-' || o_custkey]) AS geo_id,
    unnest([o_totalprice::DECIMAL(19,2)::VARCHAR, NULL]) AS estimate FROM orders""",
)
def _(t):
    """Array-of-arrays documents whose first row names the columns, in varying order."""
    c = F.col
    ids = [F.concat(F.lit("GEO-"), c(k).cast("string")) for k in ("o_orderkey", "o_custkey")]
    price = c("o_totalprice").cast("decimal(19,2)").cast("string")
    none = F.lit(None).cast("string")
    one = F.array(
        F.array(F.lit("geo_id"), F.lit("estimate")), F.array(ids[0], price), F.array(ids[1], none)
    )
    other = F.array(
        F.array(F.lit("estimate"), F.lit("geo_id")), F.array(price, ids[0]), F.array(none, ids[1])
    )
    doc = F.to_json(F.when(c("o_orderstatus") == "F", one).otherwise(other))
    docs = t.orders.select("o_orderkey", doc.alias("doc"))
    return D.table_rows(docs, "doc", ["geo_id", "estimate"])


def _named(**fields):
    return F.struct(*[v.alias(n.replace("AT_", "@")) for n, v in fields.items()])


@query(
    "catalog_documents",
    """SELECT p_partkey, 'http://api/' || p_partkey AS dataset_base_url, p_name AS title,
    TIMESTAMP '2020-01-01' + INTERVAL 1 DAY * p_size AS modified, (2000 + p_size)::INTEGER AS vintage,
    p_size > 25 AS is_cube, false AS is_aggregate, p_brand AS publisher_name,
    p_type AS publisher_suborg_of_name, 'v1' AS conforms_to_schema, 'API' AS distribution_format,
    2 AS num_keywords FROM part
    UNION ALL SELECT p_partkey, NULL, p_brand, NULL, NULL, false, false, NULL, NULL, 'v1', NULL, -1
    FROM part""",
)
def _(t):
    """Nested data catalogs: datasets flattened, first distribution and catalog fields attached."""
    c, lit = F.col, F.lit
    spot = _named(accessURL=F.concat(lit("http://api/"), c("p_partkey")), format=lit("API"))
    second = _named(accessURL=lit("http://other"), format=lit("CSV"))
    full = _named(
        title=c("p_name"),
        modified=F.date_format(F.date_add(lit("2020-01-01").cast("date"), c("p_size")), "yyyy-MM-dd"),
        c_vintage=2000 + c("p_size"),
        c_isCube=c("p_size") > 25,
        keyword=F.array(c("p_brand"), c("p_type")),
        publisher=_named(name=c("p_brand"), subOrganizationOf=_named(name=c("p_type"))),
        distribution=F.array(spot, second),
    )
    bare = F.to_json(_named(title=c("p_brand")))
    doc = F.concat(lit('{"conformsTo":"v1","dataset":['), F.to_json(full), lit(","), bare, lit("]}"))
    rows = D.catalog_datasets(t.part.select("p_partkey", doc.alias("doc")), "doc", newest_first=True)
    return rows.select(
        "p_partkey",
        "dataset_base_url",
        "title",
        F.col("modified").cast("timestamp_ntz").alias("modified"),
        "vintage",
        "is_cube",
        "is_aggregate",
        "publisher_name",
        "publisher_suborg_of_name",
        "conforms_to_schema",
        "distribution_format",
        F.coalesce(F.size("keyword"), F.lit(-1)).alias("num_keywords"),
    )


@query(
    "variable_documents",
    """SELECT o_orderkey, 'V' || o_orderkey || '_E' AS variable, o_orderpriority AS label,
    'int' AS predicate_type, o_custkey AS limit_call, o_orderstatus = 'F' AS predicate_only,
    false AS is_weight FROM orders
    UNION ALL SELECT o_orderkey, 'V' || o_orderkey || '_M', o_orderstatus, NULL, NULL, false, false
    FROM orders""",
)
def _(t):
    """Dictionaries of variables: one row per entry, missing flags false."""
    c, lit = F.col, F.lit
    name = F.concat(lit("V"), c("o_orderkey").cast("string"))
    e = F.to_json(
        _named(
            label=c("o_orderpriority"),
            predicateType=lit("int"),
            limit=c("o_custkey"),
            predicateOnly=c("o_orderstatus") == "F",
        )
    )
    m = F.to_json(_named(label=c("o_orderstatus")))
    doc = F.format_string('{"variables":{"%s_E":%s,"%s_M":%s}}', name, e, name, m)
    rows = D.variable_rows(t.orders.select("o_orderkey", doc.alias("doc")), "doc")
    return rows.select(
        "o_orderkey",
        "variable",
        "label",
        "predicate_type",
        "limit_call",
        "predicate_only",
        "is_weight",
    )


@query(
    "geography_documents",
    """SELECT s_suppkey, 'state' AS name, '040' AS geo_level, 0 AS num_required FROM supplier
    UNION ALL SELECT s_suppkey, s_name, '140', 2 FROM supplier""",
)
def _(t):
    """Lists of geography levels; a missing list counts as empty."""
    doc = F.format_string(
        '{"fips":[{"name":"state","geoLevelDisplay":"040"},'
        '{"name":"%s","geoLevelDisplay":"140","requires":["state","county"]}]}',
        F.col("s_name"),
    )
    rows = D.geography_rows(t.supplier.select("s_suppkey", doc.alias("doc")), "doc")
    return rows.select("s_suppkey", "name", "geo_level", F.size("requires").alias("num_required"))


@query(
    "group_and_tag_documents",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'no_groups' ELSE c_name END AS group_name,
    CASE WHEN c_acctbal < 0 THEN 'no_groups' END AS universe,
    CASE WHEN c_nationkey = 4 THEN 'no_tags' ELSE c_mktsegment END AS tag_name FROM customer""",
)
def _(t):
    """A fixed word where a document has no groups or no tags."""
    c = F.col
    groups = F.when(c("c_acctbal") < 0, '{"groups":[]}').otherwise(
        F.format_string('{"groups":[{"name":"%s","description":"d"}]}', c("c_name"))
    )
    tags = F.when(c("c_nationkey") == 4, "null").otherwise(
        F.format_string('{"tags":["%s"]}', c("c_mktsegment"))
    )
    docs = t.customer.select("c_custkey", groups.alias("groups"), tags.alias("tags"))
    rows = D.tag_rows(D.group_rows(docs, "groups"), "tags")
    return rows.select("c_custkey", "group_name", "universe", "tag_name")


def listing_pages(t):
    """One directory page per order with a parent link, a folder and a file."""
    c = F.col
    day = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm")
    folder = F.concat(F.lit("TIGER"), F.year("o_orderdate").cast("string"), F.lit("/"))
    state = F.lpad((c("o_custkey") % 90).cast("string"), 2, "0")
    name = F.concat(F.lit("tl_2022_"), state, F.lit("_tract.zip"))

    def row(link, when, size, note):
        opened = '<tr><td valign="top"><img src="x.gif"></td><td><a href="'
        parts = [opened, link, '">', link, '</a></td><td align="right">', when]
        parts += ['  </td><td align="right">', size, "</td><td>", note, "</td></tr>"]
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    page = F.concat(
        F.lit("<html><body><h1>Index of &lt;x&gt;</h1><table>\n<tr><th>Name</th></tr>\n"),
        row("Parent Directory", "&nbsp;", "-", "&nbsp;"),
        row(folder, day, "  - ", "&nbsp;"),
        row(name, day, "1.2M", "a &amp; b"),
        F.lit("</table></body></html>"),
    )
    url = F.concat(F.lit("https://files.example/"), c("o_orderkey").cast("string"), F.lit("/"))
    orders = dealt(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"))
    return orders.select("o_orderkey", page.alias("html"), url.alias("url"))


LISTING_SQL = """listing AS (SELECT o_orderkey, 'TIGER' || year(o_orderdate) || '/' AS name,
  o_orderdate AS last_modified, '-' AS size, '' AS description, true AS is_dir,
  'TIGER' || year(o_orderdate) AS clean_name, false AS is_file,
  'https://files.example/' || o_orderkey || '/TIGER' || year(o_orderdate) AS metadata_url
  FROM orders
  UNION ALL SELECT o_orderkey, printf('tl_2022_%02d_tract.zip', o_custkey % 90), o_orderdate,
  '1.2M', 'a & b', false, printf('tl_2022_%02d_tract.zip', o_custkey % 90), true,
  'https://files.example/' || o_orderkey || '/' || printf('tl_2022_%02d_tract.zip', o_custkey % 90)
  FROM orders)"""


@query("listing_pages", f"WITH {LISTING_SQL} SELECT * FROM listing")
def _(t):
    """Files and folders of many directory pages."""
    rows = D.listing_rows(listing_pages(t), "html", "url")
    return rows.withColumn("last_modified", F.col("last_modified").cast("timestamp_ntz"))


@query(
    "pages_without_listing",
    "SELECT page_id, url AS name, url AS metadata_url FROM pages WHERE html LIKE '%<table%</table>%'",
)
def _(t):
    """Ordinary pages hold no directory listing."""
    rows = D.listing_rows(t.pages.select("page_id", "html", "url"), "html", "url")
    return rows.select("page_id", "name", "metadata_url")


@query(
    "files_of_a_geography",
    f"""WITH {LISTING_SQL} SELECT o_orderkey, name FROM listing
    WHERE is_file AND regexp_matches(name, '_17*_|_18*_|_19*_')""",
)
def _(t):
    """Pick files by the state codes in their names; the naming decides on the pattern."""
    files_only = D.listing_rows(listing_pages(t), "html", "url").where("is_file").select("o_orderkey", "name")
    files_only = written(files_only, "listing")  # pages are read for their rows once, not again for the pattern
    pattern = D.geography_pattern(files_only, ["17", "18", "19"])
    return D.chosen_files(files_only, pattern)


@query(
    "files_read_together",
    """SELECT n_nationkey, n_name, n_regionkey, NULL::VARCHAR AS note, 2022 AS vintage_year FROM nation
    UNION ALL SELECT n_nationkey, n_name, NULL, 'second', 2022 FROM nation""",
)
def _(t):
    """Several files of differing schema as one table with a constant column."""
    one, two = fresh_path(t.spark, "vintage"), fresh_path(t.spark, "vintage")
    t.nation.write.parquet(one)
    t.nation.drop("n_regionkey").withColumn("note", F.lit("second")).write.parquet(two)
    return files.read_many(t.spark, [one, two], vintage_year=2022)


@query(
    "landed_inventory",
    "SELECT 'part' AS table_id, sum(strlen(c_name) + 1)::BIGINT AS bytes FROM customer GROUP BY c_nationkey",
)
def _(t):
    """Table and size of every file that the customers of each nation were landed in."""
    path = fresh_path(t.spark, "landed")
    by_nation = t.customer.select("c_nationkey", "c_name").repartition("c_nationkey")
    by_nation.write.partitionBy("c_nationkey").text(path)
    return files.landed_files(t.spark, path, r"^(part)-").select("table_id", "bytes")


def text_files(t):
    """Documents seen as landed files of their source."""
    return t.documents.select(
        F.col("source").alias("table_id"),
        F.col("n_chars").alias("bytes"),
        F.sha2("text", 256).alias("digest"),
        "doc_id",
    )


@query(
    "repeated_file_sizes",
    """SELECT source AS table_id, n_chars AS bytes, count(*) AS n_files FROM documents
    GROUP BY 1, 2 HAVING count(*) > 1""",
)
def _(t):
    return files.repeated_sizes(text_files(t))


@query(
    "repeated_file_content",
    """SELECT table_id, bytes, digest, doc_id FROM (
      SELECT source AS table_id, n_chars AS bytes, sha256(text) AS digest, doc_id,
      row_number() OVER (PARTITION BY source, n_chars, sha256(text) ORDER BY doc_id) AS rn
      FROM documents) WHERE rn > 1""",
)
def _(t):
    """Later copies of content an earlier file of the same table and size already had."""
    return files.repeated_content(text_files(t), ["doc_id"])
