"""The raw store keeps every distinct version, the clean store the latest one."""

import pytest
from conftest import rows

from civiclake.operators.versions import (
    latest_versions,
    latest_versions_incremental,
    merge_distinct_versions,
    new_versions,
    upserted,
)
from civiclake.plans.spec import ColumnSpec, DatasetSpec, standardize

HARBOUR, MILL, CHAPEL = "12 Harbour Row", "3 Mill Close", "8 Chapel Way"
FERRY = "ferry_id string, berth string, source_data_updated string"


def ferries(spark, *values):
    return spark.createDataFrame([(i, a, f"2024-{u}Z") for i, a, u in values], FERRY)


ONE_OLD = ("1", HARBOUR, "05-02T09:10:00")
ONE_NEW = ("1", MILL, "05-02T21:20:30")
ONE_OLDEST = ("1", CHAPEL, "05-01T17:05:45")
TWO = ("2", MILL, "05-06T06:15:10")


def test_full_refresh_takes_the_latest_of_each_record(spark):
    got = latest_versions(ferries(spark, ONE_OLD, ONE_NEW, TWO), "ferry_id")
    assert rows(got) == rows(ferries(spark, ONE_NEW, TWO))


@pytest.mark.parametrize(
    "versions, current, delta",
    [
        ([ONE_OLD, TWO], [ONE_OLD], [TWO]),
        ([ONE_OLD, ONE_NEW, ONE_OLDEST, TWO], [ONE_OLDEST], [ONE_NEW, TWO]),
        ([ONE_OLD, ONE_NEW, ONE_OLDEST, TWO], [TWO], []),
    ],
    ids=["new record", "updated record", "only older versions"],
)
def test_incremental_delta(spark, versions, current, delta):
    got = latest_versions_incremental(
        ferries(spark, *versions), ferries(spark, *current), "ferry_id"
    )
    assert rows(got) == rows(ferries(spark, *delta) if delta else ferries(spark, TWO).limit(0))


CRIME = DatasetSpec(
    "crimes",
    ("id",),
    "id",
    (ColumnSpec("id", "bigint"), ColumnSpec("arrest", "boolean"), ColumnSpec("date", "zoned")),
)


def crimes(spark, *values):
    landed = spark.createDataFrame(
        [(i, a, u, u, u) for i, a, u in values],
        "id string, arrest string, date string, source_data_updated string, "
        "ingestion_check_time string",
    )
    return standardize(landed, CRIME)


C1, C1_ARRESTED = ("1", "false", "2024-11-21T22:45:31Z"), ("1", "true", "2024-12-01T15:26:57Z")
C2 = ("2", "false", "2024-10-24T10:00:00Z")


def test_typed_full_refresh(spark):
    got = latest_versions(crimes(spark, C1, C1_ARRESTED, C2), "id")
    assert rows(got, "id", "arrest") == [(1, True), (2, False)]


@pytest.mark.parametrize(
    "current, delta",
    [([C2], [(1, True)]), ([C1, C2], [(1, True)]), ([C1_ARRESTED], [])],
    ids=["new", "updated", "older only"],
)
def test_typed_incremental(spark, current, delta):
    versions = crimes(spark, C1, C1_ARRESTED, C2)
    got = latest_versions_incremental(versions, crimes(spark, *current), "id")
    assert rows(got, "id", "arrest") == delta


def test_incremental_equals_reranking_all_versions_of_changed_records(spark):
    """Including versions without a date, which rank first."""
    values = [
        (k, None if (k * j) % 5 == 4 else (k * 7 + j * 3) % 20, j) for k in range(30) for j in range(4)
    ]
    versions = spark.createDataFrame(values, "id int, updated int, version int")
    current = spark.createDataFrame([(1, 14, 0)], "id int, updated int, version int")
    changed = versions.where("updated > 14").select("id").distinct()
    slow = latest_versions(
        versions.join(changed, "id", "left_semi"), "id", "updated", ["version"]
    )
    fast = latest_versions_incremental(versions, current, "id", "updated", ["version"])
    assert rows(fast, "id", "updated", "version") == rows(slow, "id", "updated", "version")
    assert any(r[1] is None for r in rows(fast, "id", "updated"))


def test_upsert_and_schema_sync(spark):
    target = spark.createDataFrame([(1, "a", 9), (2, "b", 9)], "id int, name string, gone int")
    delta = spark.createDataFrame([(2, "B", True), (3, "c", False)], "id int, name string, new boolean")
    assert rows(upserted(target, delta, "id")) == [(1, "a", None), (2, "B", True), (3, "c", False)]


RAW = "id string, code string, weather string, note string, source_data_updated string, ingestion_check_time string"


def raw(spark, *values):
    return spark.createDataFrame([(i, c, p, None, u, u) for i, c, p, u in values], RAW)


EXISTING = [
    ("00001", "K7", "breeze", "2022-03-04T10:20:30Z"),
    ("00002", "K3", "calm", "2022-01-08T07:40:00Z"),
]
STAGED = [
    ("00001", "K9", "gale", "2022-04-09T12:00:15Z"),
    ("00002", "K3", "calm", "2022-04-09T12:00:15Z"),
]
SOURCE = ["id", "code", "weather", "note"]


def test_raw_keeps_both_versions_and_the_oldest_metadata(spark):
    got = merge_distinct_versions(raw(spark, *EXISTING), raw(spark, *STAGED, *STAGED), SOURCE)
    assert rows(got, "id", "weather", "source_data_updated") == [
        ("00001", "breeze", "2022-03-04T10:20:30Z"),
        ("00001", "gale", "2022-04-09T12:00:15Z"),
        ("00002", "calm", "2022-01-08T07:40:00Z"),
    ]


def test_appending_new_versions_gives_the_merged_table(spark):
    existing, staged = raw(spark, *EXISTING), raw(spark, *STAGED, *STAGED)
    appended = existing.unionByName(new_versions(existing, staged, SOURCE))
    assert rows(appended) == rows(merge_distinct_versions(existing, staged, SOURCE))


def test_nulls_in_different_columns_are_different_versions(spark):
    a = spark.createDataFrame([(None, "x", "m")], "p string, q string, source_data_updated string")
    b = spark.createDataFrame([("x", None, "m")], a.schema)
    assert new_versions(a, b, ["p", "q"], ["source_data_updated"]).count() == 1
    assert new_versions(a, a, ["p", "q"], ["source_data_updated"]).count() == 0
    assert merge_distinct_versions(a, b, ["p", "q"], ["source_data_updated"]).count() == 2


def test_incremental_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "versions")
    ferries(spark, ONE_OLD, ONE_NEW, TWO).write.parquet(path)
    versions = spark.read.parquet(path)
    delta = latest_versions_incremental(versions, ferries(spark, ONE_OLD), "ferry_id")
    plan = delta._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(GreaterThan(source_data_updated,ScalarSubquery" in plan
