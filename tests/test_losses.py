"""Nothing is dropped or changed without a word."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from civiclake.functions import casting
from civiclake.operators import metadata
from civiclake.operators import quality as Q
from civiclake.operators.quality import expect
from civiclake.operators.quantiles import exact_quantiles
from civiclake.sources import documents, files, tables


def test_groups_of_nulls_keep_their_row(spark):
    df = spark.createDataFrame([("x", None)] * 300 + [("y", float(n)) for n in range(300)], "k string, v double")
    small, large = (exact_quantiles(df, ["k"], "v", [0.5], "q", limit) for limit in (None, 50))
    assert rows(small) == rows(large) == [("x", None), ("y", [149.5])]


def test_hot_keys_beyond_the_broadcast_limit(spark):
    df = spark.createDataFrame([(n % 7, float(n)) for n in range(2000)], "k long, v double")
    expected = rows(exact_quantiles(df, ["k"], "v", [0.25, 0.5], "q"))
    spark.conf.set("civiclake.maxBroadcastBytes", "1")
    try:
        assert rows(exact_quantiles(df, ["k"], "v", [0.25, 0.5], "q", 50)) == expected
    finally:
        spark.conf.unset("civiclake.maxBroadcastBytes")


def test_appends_must_fit(spark):
    tables.create_layers(spark)
    name = "data_raw.appended_rows"
    tables.publish(spark.range(100_000).selectExpr("id", "CAST(id AS STRING) AS t"), name)
    for n in range(8):
        tables.append(spark.createDataFrame([("a", -n)], "t string, id bigint"), name)
    assert spark.table(name).count() == 100_008
    assert sorted(r.id for r in spark.table(name).where("t = 'a'").collect()) == list(range(-7, 1))
    for other in ("id bigint", "id bigint, t string, more int", "id int, t string"):
        with pytest.raises(ValueError, match="differ"):
            tables.append(spark.createDataFrame([], other), name)


def test_merges_refuse_repeated_keys_and_inserts_keep_one(spark):
    tables.create_layers(spark)
    twice = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    tables.publish(twice.where("k = 2"), "clean.merge_refused")
    with pytest.raises(ValueError, match="repeat"):
        tables.merge(twice, "clean.merge_refused", "k")
    tables.insert_if_absent(twice, "metadata.inserted_once", ["k"])
    tables.insert_if_absent(twice.unionByName(spark.createDataFrame([(3, "x"), (3, "y")], "k int, v string")), "metadata.inserted_once", ["k"])
    assert sorted(r.k for r in spark.table("metadata.inserted_once").collect()) == [1, 2, 3]


def test_geojson_without_properties_or_with_other_spelling(spark, tmp_path):
    path = tmp_path / "f.json"
    for layout, joint in (("lines", "\n"), ("separated", ",")):
        features = ['{"type":"Feature","properties":null,"geometry":null}', '{"type":"Feature","properties":{"id":1},"geometry":null}']
        path.write_text(joint.join(features))
        assert rows(files.read_geojson(spark, str(path), "id int", layout).select("id")) == [(1,), (None,)]
    path.write_text('{"type":"Feature","properties":{"id":1}}\nnot json')
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_geojson(spark, str(path), "id int", "lines").collect()
    path.write_text('{"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"id": 1}}]}')
    with pytest.raises(Exception, match="layout document"):
        files.read_geojson(spark, str(path), "id int", "separated").collect()


def test_headers_of_all_documents(spark):
    docs = spark.createDataFrame([('[["a"],["1"]]',), ('[["b","a"],["2","3"]]',), ("[]",)], "doc string")
    assert rows(documents.table_rows(docs, "doc"), "a", "b") == [("1", None), ("3", "2")]


def test_one_check_record_stamps_rows(spark):
    data = spark.createDataFrame([(1,)], "x int")
    checks = spark.createDataFrame([(7, "t")], "id int, at string")
    assert rows(metadata.stamped(data, checks, ["id"])) == [(1, 7)]
    assert metadata.stamped(data, checks.limit(0), ["id"]).isEmpty()
    with pytest.raises(Exception, match="more than one"):
        metadata.stamped(data, checks.unionByName(checks), ["id"]).collect()


def test_suite_edges(spark):
    df = spark.createDataFrame([("2020-01-01 00:00:00.000001", '{"tags":"x"}'), ("2020-01-01 00:00:00.000002", '{"tags":null}')], "t string, doc string")
    df = df.withColumn("t", F.col("t").cast("timestamp")).withColumn("k", F.lit(1))
    passed = lambda *suite: [r.success for r in Q.validate(df, list(suite)).orderBy("ordinal").collect()]
    json_schema = lambda **s: expect("column_values_to_match_json_schema", "doc", json_schema=s)
    assert passed(
        expect("compound_columns_to_be_unique", column_list=["k", "t"]),
        expect("column_values_to_be_null", "k", mostly=0),
        json_schema(required=["tags"]),
        json_schema(properties={"tags": {"type": "array"}}),
    ) == [True, True, True, False]
    for bad in ({"minProperties": 1}, {"properties": {"tags": {"enum": ["x"]}}}):
        with pytest.raises(ValueError, match="not supported"):
            passed(json_schema(**bad))
    with pytest.raises(ValueError, match="directive"):
        Q.spark_time_pattern("%A %d")
    assert Q.spark_time_pattern("%m/%d/%Y") == "M/d/yyyy" and Q.spark_time_pattern("%Y%m%d") == "yyyyMMdd"


def test_unpadded_dates(spark):
    df = spark.createDataFrame([("1/5/2020",), ("01/05/2020",)], "d string")
    days = {str(r[0]) for r in df.select(casting.date("d", ("MM/dd/yyyy",))).collect()}
    assert days == {"2020-01-05"}


def test_landed_files_of_several_times_and_strays(spark, tmp_path):
    from civiclake.plans.spec import DatasetSpec, column_specs
    from civiclake.streaming import landing

    spec = DatasetSpec("ferries_landed", ("n", "pier"), "ferry_id", column_specs(bigint="n", varchar__4="pier"))
    folder = tmp_path / "in"
    folder.mkdir()
    for name, text in (("abcd-1234_2024-01-02T00_00_00Z.csv", '1,a,"say ""hi"", ok"'), ("abcd-1234_2024-01-01T00-00-00Z.csv", "1,a,old"), ("stray.csv", "9,a,x")):
        (folder / name).write_text("N,Pier,Note\n" + text + "\n")
    assert landing.refresh_landed(spark, spec, str(folder), "N string, Pier string, Note string", str(tmp_path / "state")) == 1
    assert spark.table("data_raw.ferries_landed").count() == 2
    assert [r.note for r in spark.table("clean.ferries_landed_clean").collect()] == ['SAY "HI", OK']
    assert [r.path.endswith("stray.csv") for r in spark.table(landing.SET_ASIDE).collect()] == [True]


def test_reference_systems_are_carried_and_compared(spark):
    from civiclake.functions import geometry as G
    from civiclake.operators.spatial import join_containing
    from civiclake.plans.registry import REGISTRY
    from civiclake.plans.spec import DatasetSpec, column_specs, standardize

    assert sorted({s.srid for s in REGISTRY.values()}) == [4269, 4326]
    square = '[[[0,0],[0,9],[9,9],[9,0],[0,0]]]'
    landed = spark.createDataFrame([("a", ("Polygon", square))], "Name string, geometry struct<type:string,coordinates:string>")
    spec = DatasetSpec(
        "plots", ("name",), "name", column_specs(text="Name>name", geometry__POLYGON="geometry"),
        derived={"geometry_parts": lambda: G.boundary_from_geojson("geometry")}, srid=4269,
    )
    plots = standardize(landed, spec)
    assert G.srid_of(plots, "geometry") == G.srid_of(plots, "geometry_parts") == 4269
    points = spark.createDataFrame([(1.0, 1.0)], "x double, y double")
    with pytest.raises(ValueError, match="SRID"):
        join_containing(points, plots, "x", "y", "geometry_parts", {"name": "plot"})
    same = join_containing(G.with_declared_srid(points, 4269, "x"), plots, "x", "y", "geometry_parts", {"name": "plot"})
    assert [r.plot for r in same.collect()] == ["A"]
