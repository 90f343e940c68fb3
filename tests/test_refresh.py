from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import types as T

from civiclake.operators.quality import expect
from civiclake.operators.versions import new_versions
from civiclake.plans.refresh import (
    PARCEL_MODELS,
    GateFailed,
    build_models,
    recent_versions,
    refresh,
)
from civiclake.plans.registry import REGISTRY
from civiclake.plans.spec import DatasetSpec, auto_columns, column_specs, standardize
from civiclake.sources import tables
from civiclake.streaming.landing import refresh_landed

SPEC = DatasetSpec(
    "towed", ("inventory", "plate"), "tow_id", column_specs(varchar__4="plate", bigint="inventory")
)
T1, T2 = "2024-12-01T11:01:39Z", "2024-12-04T08:13:25Z"


def pull(spark, *values):
    return spark.createDataFrame(list(values), "Inventory string, Plate string, `Towed To` string")


def test_two_refreshes(spark):
    spec = DatasetSpec("towed_a", SPEC.key, SPEC.record_id, SPEC.columns)
    first = refresh(spark, spec, pull(spark, ("1", "abc", "here"), ("2", "d", "there")), T1)
    assert first.action == "create_table"
    second = refresh(spark, spec, pull(spark, ("1", "abc", "moved"), ("2", "d", "there"), ("3", "e", "x")), T2)
    assert second.action == "update_table"
    assert rows(second.delta, "inventory", "towed_to") == [(1, "MOVED"), (3, "X")]
    assert rows(second.clean, "inventory", "plate", "towed_to") == [
        (1, "ABC", "MOVED"),
        (2, "D", "THERE"),
        (3, "E", "X"),
    ]
    assert second.raw.count() == 4
    again = refresh(spark, spec, pull(spark, ("3", "e", "x")), T2)
    assert again.delta.count() == 0 and again.raw.count() == 4


def test_old_pulls_are_not_read_again(spark):
    spec = DatasetSpec("towed_e", SPEC.key, SPEC.record_id, SPEC.columns)
    for day in ("2024-10-01", "2024-11-01", "2024-12-01"):
        last = refresh(spark, spec, pull(spark, ("1", "abc", day)), f"{day}T11:00:00Z")
    assert rows(last.clean, "towed_to") == [("2024-12-01",)]
    recent = recent_versions(last.raw, spec, datetime(2024, 12, 1, 17))
    assert rows(recent, "towed_to") == [("2024-12-01",)]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(source_data_updated,2024-11-29)" in plan
    with pytest.raises(ValueError, match="not ISO text"):
        refresh(spark, spec, pull(spark, ("1", "abc", "x")), "12/01/2024")


def test_report_and_gate(spark):
    spec = DatasetSpec("towed_b", SPEC.key, SPEC.record_id, SPEC.columns)
    suite = [expect("column_values_to_be_in_set", "plate", value_set=["abc"])]
    data = pull(spark, ("1", "abc", "here"), ("2", "d", "there"))
    with pytest.raises(GateFailed):
        refresh(spark, spec, data, T1, suite=suite, gate=True)
    assert not spark.catalog.tableExists("clean.towed_b_clean")
    result = refresh(spark, spec, data, T1, suite=suite)
    assert rows(result.report, "success") == [(False,)] and result.clean.count() == 2


def test_nothing_new_at_the_source(spark):
    spec = DatasetSpec("towed_c", SPEC.key, SPEC.record_id, SPEC.columns)

    def check(updated, at):
        return spark.sql(
            f"""SELECT 'abcd-1234' AS table_id, timestamp'{updated}' AS source_data_last_updated,
            CAST(NULL AS timestamp) AS source_metadata_last_updated,
            timestamp'{at}' AS time_of_check"""
        )

    data = pull(spark, ("1", "abc", "here"))
    assert refresh(spark, spec, data, T1, check=check("2024-12-01", "2024-12-02")).action == "create_table"
    assert refresh(spark, spec, data, T1, check=check("2024-12-01", "2024-12-03")).action == "skip"
    assert refresh(spark, spec, data, T2, check=check("2024-12-04", "2024-12-05")).action == "update_table"
    pulled = tables.read(
        spark, "SELECT id, data_pulled_this_check AS p FROM metadata.table_metadata WHERE table_id = 'abcd-1234'"
    )
    assert [p for _, p in sorted(map(tuple, pulled.collect()))] == [True, False, True]


def test_landing_stream_processes_each_file_once(spark, tmp_path):
    spec = DatasetSpec("towed_d", SPEC.key, SPEC.record_id, SPEC.columns)
    landing, state = tmp_path / "landing", str(tmp_path / "state")
    landing.mkdir()
    schema = "Inventory string, Plate string, `Towed To` string"

    def land(at, text):
        (landing / f"abcd-1234_{at}.csv").write_text("Inventory,Plate,Towed To\n" + text)

    land("2024-12-01T10_00_00Z", "1,abc,here\n2,d,there\n")
    refresh_landed(spark, spec, str(landing), schema, state)
    land("2024-12-02T10_00_00Z", "1,abc,moved\n")
    refresh_landed(spark, spec, str(landing), schema, state)
    assert refresh_landed(spark, spec, str(landing), schema, state) == 0
    clean = spark.table("clean.towed_d_clean")
    assert rows(clean, "inventory", "towed_to") == [(1, "MOVED"), (2, "THERE")]
    assert spark.table("data_raw.towed_d").count() == 3


def test_models_resolve_tables_by_name(spark):
    tables.create_layers(spark)
    built = build_models(
        spark,
        {
            "feature.model_a": lambda ref: spark.range(3).toDF("n"),
            "dwh.model_b": lambda ref: ref("feature.model_a").where("n > 0"),
        },
    )
    assert rows(built["dwh.model_b"]) == [(1,), (2,)]
    assert len(PARCEL_MODELS) == 7


def test_appends_leave_what_is_stored(spark):
    tables.create_layers(spark, ("appends",))
    for i in range(5):
        tables.append(spark.range(i, i + 1).toDF("n"), "appends.t")
        files = set(spark.table("appends.t").inputFiles())
        assert i == 0 or before < files
        before = files
    assert rows(spark.table("appends.t")) == [(i,) for i in range(5)]
    assert "UnionExec" not in plan_of(spark.table("appends.t")) and "Union" not in plan_of(spark.table("appends.t"))


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_every_registered_dataset_standardizes(spark, name):
    """All declared columns landed as text (geometry as landed geometry), with an extra one."""
    spec = REGISTRY[name]
    fields = []
    for c in spec.columns:
        kind = "type string, coordinates string"
        landed = T.StructType.fromDDL(kind) if "geometry" in str(c.rule) else T.StringType()
        fields.append(T.StructField(c.source or c.name, landed))
    names = {f.name for f in fields}
    made = {c.name for c in spec.columns} | set(spec.derived)
    fields += [T.StructField(k, T.StringType()) for k in spec.key if k not in names and k not in made]
    fields += [T.StructField(n, T.StringType()) for n in ("extra", *spec.metadata_cols)]
    if "chicago_community" in name:
        fields.insert(0, T.StructField("community", T.StringType()))
    out = standardize(spark.createDataFrame([], T.StructType(fields)), spec)
    assert out.count() == 0
    assert set(spec.key) <= set(out.columns) and spec.record_id in out.columns
    assert out.columns[-2:] == list(spec.metadata_cols) and "extra" in out.columns
    assert out.columns[0] == spec.record_id or not spec.made_key


def test_census_pattern(spark):
    schema = "geo_id string, b25063_001e string, b25063_001ea string, b25063a_002m string, dataset_id string"
    out = standardize(spark.createDataFrame([], schema), REGISTRY["gross_rent_by_cook_county_il_tract"])
    assert [t for _, t in out.dtypes] == ["string", "bigint", "string", "bigint", "bigint"]


def test_auto_spec_reports_unknown_types(spark):
    schema = T.StructType.fromDDL("a int, b map<string,string>")
    assert [c.rule for c in auto_columns(schema)] == ["int", "as_is"]
    with pytest.raises(ValueError, match="b: map<string,string>"):
        auto_columns(schema, strict=True)


def test_excluded_rows_and_surrogate_key(spark):
    data = [("31", "x", None), ("1", "y", None)]
    df = spark.createDataFrame(data, "dist_num string, dist_label string, geometry struct<type:string,coordinates:string>")
    out = standardize(df, REGISTRY["chicago_police_district_boundaries"])
    assert rows(out, "dist_num", "dist_label") == [("01", "Y")]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_merges_write_the_partitions_they_touch(spark):
    tables.create_layers(spark, ("merges",))
    base = spark.range(1000).selectExpr("id", "'old' AS v")
    tables.publish(base, "merges.t", merge_key="id", parts=16)
    before = set(spark.table("merges.t").inputFiles())
    first = spark.sql("SELECT id, 'new' AS v FROM VALUES (1L), (2000L) AS t(id)")
    got = tables.merge(first, "merges.t", "id")
    touched = {r[0] for r in first.select(tables.part_of("id", 16)).collect()}
    gone = before - set(got.inputFiles())
    assert gone and {int(f.split("__part=")[1].split("/")[0]) for f in gone} <= touched
    second = spark.sql("SELECT 'newer' AS v, id FROM VALUES (1L), (2L) AS t(id)")
    got = tables.merge(second, "merges.t", "id")
    assert got.columns == ["id", "v"] and got.count() == 1001 and got.select("id").distinct().count() == 1001
    assert rows(got.where("v <> 'old'")) == [(1, "newer"), (2, "newer"), (2000, "new")]
    assert rows(tables.merge(second.limit(0), "merges.t", "id")) == rows(got)
    plan = plan_of(got)
    assert "Join" not in plan and "Union" not in plan and "Exchange" not in plan
    more = spark.range(1).selectExpr("id", "'x' AS v", "true AS w")
    got = tables.merge(more, "merges.t", "id")
    assert got.columns == ["id", "v", "w"] and got.count() == 1001
    assert tables.append(more.selectExpr("id + 9999 AS id", "v", "w"), "merges.t").count() == 1002


def test_tables_grow_out_of_their_partitions(spark, monkeypatch):
    tables.create_layers(spark, ("merges",))
    tables.publish(spark.range(100).selectExpr("id", "'old' AS v"), "merges.grown")
    tables.merge(spark.range(5, 6).selectExpr("id", "'new' AS v"), "merges.grown", "id")
    assert tables._layout(spark, "merges.grown")["merge_key"] == "id"
    monkeypatch.setattr(tables, "PART_BYTES", 50)
    got = tables.merge(spark.range(7, 8).selectExpr("id", "'new' AS v"), "merges.grown", "id")
    assert tables._layout(spark, "merges.grown")["parts"] > 4
    assert rows(got.where("v = 'new'"), "id") == [(5,), (7,)] and got.count() == 100


def test_replaced_versions_are_dropped(spark):
    tables.create_layers(spark, ("versions",))
    for n in range(4):
        tables.publish(spark.range(n).toDF("n"), "versions.t")
    assert tables.tables_in(spark, "versions") == ["t"]
    assert len([t for t in spark.catalog.listTables("versions") if not t.isTemporary]) == 3  # the view, its table and the one before
    tables.publish(spark.range(3).toDF("n"), "versions.temp_t")
    assert tables.drop_staging(spark, "versions") == ["temp_t"]
    assert len([t for t in spark.catalog.listTables("versions") if not t.isTemporary]) == 3


def test_a_full_pull_does_not_shuffle_the_store(spark):
    tables.create_layers(spark)
    store = spark.range(5000).selectExpr("id", "CAST(id % 7 AS STRING) AS t", "'m' AS source_data_updated")
    tables.publish(store, "data_raw.bucketed", hashed=["id", "t"], buckets=6)
    pull = spark.range(10, 5010).selectExpr("id", "CAST(id % 7 AS STRING) AS t", "'n' AS source_data_updated")
    pull = pull.unionByName(pull)
    fresh = new_versions(tables.stored(spark, "data_raw.bucketed"), pull, ["id", "t"], ["source_data_updated"], 6)
    lines = plan_of(fresh).splitlines()
    at = next(i for i, line in enumerate(lines) if "bucketed__" in line)
    depth = lines[at].index("FileScan")
    above = []
    for line in reversed(lines[:at]):
        here = len(line) - len(line.lstrip(" :+-*(0123456789)"))
        if here < depth:
            above.append(line)
            depth = here
    assert "Bucketed: true" in lines[at] and any("LeftSemi" in line for line in above)
    semi = next(i for i, line in enumerate(above) if "LeftSemi" in line)
    assert not any("Exchange" in line or "Sort " in line for line in above[: semi + 1])
    assert rows(fresh, "id") == [(i,) for i in range(5000, 5010)]
    assert "ReadSchema: struct<__row_hash:bigint,__row_check:bigint>" in lines[at]
    tables.append(fresh, "data_raw.bucketed", laid_out=True)
    assert spark.table("data_raw.bucketed").columns == ["id", "t", "source_data_updated"]
    again = new_versions(tables.stored(spark, "data_raw.bucketed"), pull, ["id", "t"], ["source_data_updated"], 6)
    assert again.count() == 0 and spark.table("data_raw.bucketed").count() == 5010
