import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from civiclake.operators import freshness as R
from civiclake.operators import metadata as M
from civiclake.plans.names import standard_names
from civiclake.queries import QUERIES
from civiclake.sources import documents as D
from civiclake.sources import files


def test_column_names():
    names = ["street", "LOT-SIZE", "OWNER MAIL CODE", "OWNER_MAIL_CODE"]
    assert standard_names(names, ("-",)) == ["street", "lot_size", "owner mail code", "owner_mail_code"]
    assert standard_names(names, (" ",)) == ["street", "lot-size", "owner_mail_code_1", "owner_mail_code"]
    assert standard_names(["a b", "a-b"]) == ["a_b", "a_b_1"]
    assert standard_names(["a b", "a_b", "a b_1"]) == ["a_b_2", "a_b", "a_b_1"]
    assert standard_names(["x y", "x y", "x_y_1"]) == ["x_y", "x_y_2", "x_y_1"]


@pytest.mark.parametrize("layout", ["lines", "separated", "document"])
def test_geojson_layouts(spark, tmp_path, layout):
    feats = [
        {
            "type": "Feature",
            "properties": {"id": i, "note": 'a "b" }],{ ü'},
            "geometry": None if i == 2 else {"type": "Polygon", "coordinates": [[[i, 0.5], [1, 1]]]},
        }
        for i in range(50)
    ]
    path = tmp_path / "f.geojson"
    if layout == "lines":
        path.write_text("\n".join(json.dumps(f) for f in feats))
    else:
        whole = {"type": "FeatureCollection", "features": feats, "crs": {"x": [1]}}
        path.write_text(json.dumps(whole, separators=(",", ":"), ensure_ascii=False))
    got = files.read_geojson(spark, str(path), "id int, note string", layout)
    assert got.count() == 50
    assert got.where("note = 'a \"b\" }],{ ü'").count() == 50
    assert got.where("geometry IS NULL").select("id").first()[0] == 2
    coordinates = got.where("id = 7").select("geometry.coordinates").first()[0]
    assert json.loads(coordinates) == [[[7, 0.5], [1, 1]]]


def test_csv_quotes_and_schema(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,Name Of\n1,"x ""y"", z"\n2,\n')
    path = str(tmp_path / "a.csv")
    assert rows(files.read_csv(spark, path)) == [("1", 'x "y", z'), ("2", None)]
    schema = files.infer_csv_schema(spark, path)
    assert rows(files.read_csv(spark, path, schema)) == [(1, 'x "y", z'), (2, None)]


def one(spark, doc):
    return spark.createDataFrame([(1, doc if isinstance(doc, str) else json.dumps(doc))], "k int, doc string")


def test_group_documents(spark):
    doc = {"groups": [{"name": "B1", "description": "d", "variables": "v", "universe ": "all"}]}
    assert rows(D.group_rows(one(spark, doc), "doc")) == [(1, "B1", "d", "v", "all")]
    assert rows(D.group_rows(one(spark, {"groups": []}), "doc")) == [(1,) + ("no_groups",) * 4]


def test_tag_documents(spark):
    tags = D.tag_rows(one(spark, {"tags": ["ethnicity", "race", "sex", "veteran"]}), "doc")
    assert rows(tags, "tag_name") == [("ethnicity",), ("race",), ("sex",), ("veteran",)]
    assert rows(D.tag_rows(one(spark, "null"), "doc"), "tag_name") == [("no_tags",)]


def test_catalog_sorted_newest_first(spark):
    doc = {
        "@context": "c",
        "dataset": [
            {"title": "old", "modified": "2020-01-01", "c_isCube": True},
            {
                "title": "new",
                "modified": "2021-01-01",
                "distribution": [{"accessURL": "u", "@type": "t"}, {"accessURL": "v"}],
                "publisher": {"name": "p", "subOrganizationOf": {"name": "q", "subOrganizationOf": {"name": "r"}}},
                "contactPoint": {"fn": "f"},
            },
        ],
    }
    got = D.catalog_datasets(one(spark, doc), "doc", newest_first=True).collect()
    assert [g.title for g in got] == ["new", "old"]
    new, old = got
    assert (new.dataset_base_url, new.distribution_type, new.metadata_context) == ("u", "t", "c")
    assert (new.publisher_suborg_of_suborg_of_name, new.contact_point_fn) == ("r", "f")
    assert (new.is_cube, old.is_cube, old.dataset_base_url) == (False, True, None)


def listing(spark, names):
    return spark.createDataFrame([(n,) for n in names], "name string")


def test_geography_patterns(spark):
    states = listing(spark, [f"tl_2022_{s:02d}_tract.zip" for s in range(1, 57)])
    assert D.geography_pattern(states, "17") == "_17_"
    assert D.chosen_files(states, "_17_").count() == 1
    assert D.geography_pattern(states, ["17", "18", "19"]) == "_17*_|_18*_|_19*_"
    whole = listing(spark, ["tl_2022_us_county.zip"])
    assert D.geography_pattern(whole) == "_us_"
    counties = listing(spark, ["tl_2022_17031_roads.zip", "tl_2022_17033_roads.zip"])
    assert D.geography_pattern(counties, "17", "031") == "_17031_"


def test_listing_page(spark):
    page = """<html><TABLE class="x"><TR><TH>Name</TH></TR>
    <TR><TD></TD><TD><a href="/geo/">Parent Directory</a></TD><TD>&nbsp;</TD><TD>-</TD><TD></TD></TR>
    <TR><TD></TD><TD><a href="2020/">2020/</a></TD><TD>2021-05-01 10:00  </TD><TD>  - </TD><TD>&nbsp;</TD></TR>
    <TR><TD></TD><TD><a href="a">a.zip</a></TD><TD>2021-05-02 11:30</TD><TD>3.1M</TD><TD>R&amp;D</TD></TR>
    </TABLE><table><tr><td>1</td><td>not me</td></tr></table></html>"""
    df = spark.createDataFrame([(page, "https://x.y/geo//")], "html string, url string")
    got = rows(D.listing_rows(df, "html", "url"), "name", "size", "description", "is_dir", "clean_name", "is_file", "metadata_url")
    assert got == [
        ("2020/", "-", "", True, "2020", False, "https://x.y/geo/2020"),
        ("a.zip", "3.1M", "R&D", False, "a.zip", True, "https://x.y/geo/a.zip"),
    ]


def test_a_page_is_worked_out_once(spark):
    """The check for a table is no filter, which would repeat what makes the page; texts need no lambda."""
    page = "'<table><tr><td></td><td>' || name || '</td><td>2021-05-01 10:00</td><td>1M</td></table>'"
    df = spark.createDataFrame([("a",), (None,)], "name string").selectExpr(f"upper({page}) AS html", "'u' AS url")
    got = D.listing_rows(df.unionByName(df.selectExpr("'no list' AS html", "url")), "html", "url")
    assert rows(got, "name", "size", "description", "metadata_url") == [("A", "1M", None, "u/A")]
    plan = D.listing_rows(df, "html", "url")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("upper(") <= 1 and "lambda" not in plan


@pytest.fixture
def few_orders(spark, tmp_path):
    data = [(1, 17, "1999-03-04"), (1, 17, "1999-01-01"), (2, 7, "2000-02-01"), (3, 7, None)]
    df = spark.createDataFrame(data, "o_orderkey long, o_custkey long, day string")
    dated = df.selectExpr("o_orderkey", "o_custkey", "cast(day AS timestamp_ntz) AS o_orderdate")
    dated.write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name", ["changed_listing_entries", "files_of_a_geography"])
def test_pages_are_read_for_their_rows_once(spark, few_orders, name):
    got = QUERIES[name](spark, few_orders)
    # what is left to do starts from the stored rows
    assert "Generate" not in got._jdf.queryExecution().optimizedPlan().toString()
    if name == "files_of_a_geography":
        assert rows(got) == [(1, "tl_2022_17_tract.zip")] * 2
        return
    one, two = "https://files.example/1/", "https://files.example/2/"
    flags = got.selectExpr("metadata_url", "date_format(last_modified, 'yyyy-MM-dd')", "updated_metadata_available")
    assert rows(flags) == [
        (f"{one}TIGER1999", "1999-01-01", False),
        (f"{one}TIGER1999", "1999-03-04", False),
        (f"{one}tl_2022_17_tract.zip", "1999-01-01", False),
        (f"{one}tl_2022_17_tract.zip", "1999-03-04", True),
        (f"{two}TIGER2000", "2000-02-01", True),
        (f"{two}tl_2022_07_tract.zip", "2000-02-01", True),
    ]


CHECK = "table_id string, data_pulled_this_check boolean, time_of_check timestamp"
SOURCE = "table_id string, source_data_last_updated timestamp, source_metadata_last_updated timestamp"


def test_freshness_scenarios(spark):
    checks = spark.sql(
        """SELECT * FROM VALUES ('wvhk-k5uv', true, timestamp'2022-11-22 05:18:10'),
        ('ewy2-6yfk', true, timestamp'2022-12-27 02:32:07'),
        ('late-fail', true, timestamp'2022-01-01'), ('late-fail', false, timestamp'2022-09-09')
        AS t(table_id, data_pulled_this_check, time_of_check)"""
    )
    sources = spark.sql(
        """SELECT * FROM VALUES ('wvhk-k5uv', timestamp'2022-12-01 06:16:57', NULL),
        ('ewy2-6yfk', NULL, NULL), ('never-see', NULL, NULL),
        ('late-fail', timestamp'2022-05-05', timestamp'2021-01-01')
        AS t(table_id, source_data_last_updated, source_metadata_last_updated)"""
    )
    got = R.checked_sources(sources, checks).select(
        "table_id", "updated_data_available", "updated_metadata_available", "data_pulled_this_check"
    )
    assert rows(got) == [
        ("ewy2-6yfk", False, False, False),
        ("late-fail", True, False, None),
        ("never-see", True, True, None),
        ("wvhk-k5uv", True, False, None),
    ]


def meta(spark, **resource):
    doc = {
        "_id": "abcd-1234",
        "time_of_collection": "2022-12-27T02:32:07.012345Z",
        "resource": {"name": "Parcel - Sales", "columns_name": ["a"], "columns_datatype": ["Text"], **resource},
        "metadata": {"domain": "d.org"},
    }
    return M.parsed_metadata(one(spark, doc), "doc").select(
        M.is_geospatial(F.col("meta")), M.table_name_from_title(F.col("meta").resource["name"])
    ).first()


def test_geospatial_classification(spark):
    assert meta(spark)[0] is False
    assert meta(spark, columns_datatype=["Text", "MultiPolygon"])[0] is True
    assert meta(spark, columns_name=[], columns_datatype=[], lens_view_type="geo", lens_display_type="map")[0] is True
    assert meta(spark, lens_view_type="geo")[0] is False
    assert meta(spark)[1] == "parcel_sales"


def test_download_formats(spark):
    df = spark.createDataFrame([("shp",), ("CSV",), (None,)], "f string")
    got = df.select(M.download_format(F.lit(True), F.col("f")))
    assert [r[0] for r in got.collect()] == ["Shapefile", "csv", "GeoJSON"]
    with pytest.raises(Exception, match="unsupported download format"):
        df.select(M.download_format(F.lit(True), F.lit("xls"))).collect()


def test_landed_files(spark, tmp_path):
    for name, text in {
        "abcd-1234_2024-01-01T00:00:00.000000Z.csv": "same",
        "abcd-1234_2024-02-01T00:00:00.000000Z.csv": "same",
        "abcd-1234_2024-03-01T00:00:00.000000Z.csv": "else",
        "wxyz-1234_2024-01-01T00:00:00.000000Z.csv": "same",
        "notes.txt": "same",
    }.items():
        (tmp_path / name.replace(":", "_")).write_text(text)
    got = files.landed_files(spark, str(tmp_path), digests=True)
    assert got.count() == 4
    again = files.repeated_content(got, ["name"])
    assert [r.name[10:17] for r in again.collect()] == ["2024-02"]
    assert rows(files.repeated_sizes(got)) == [("abcd-1234", 4, 3)]


def test_digests_of_ranges_are_those_of_the_whole(spark, tmp_path, monkeypatch):
    body = bytes(range(256)) * 20_000  # five leaves
    for name, content in {
        "abcd-0001_a": body, "abcd-0001_b": body, "abcd-0001_c": body[:-1] + b"x", "abcd-0001_d": b"alone",
        "abcd-0001_g": body[: 1 << 20], "abcd-0001_h": body[: 1 << 20],
    }.items():
        (tmp_path / name).write_bytes(content)
    listed = files.landed_files(spark, str(tmp_path))
    by_range = [
        {r.name[-1]: r.digest for r in files.with_digests(listed, size).collect()} for size in (None, 1, 2 << 20, 3 << 20)
    ]
    assert all(d == by_range[0] for d in by_range) and len(by_range[0]) == 6
    got = by_range[0]
    assert got["a"] == got["b"] != got["c"] and got["d"] is None and got["g"] == got["h"] != got["a"]
    copies = files.repeated_content(files.with_digests(listed), ["name"])
    assert sorted(r.name[-1] for r in copies.collect()) == ["b", "h"]
