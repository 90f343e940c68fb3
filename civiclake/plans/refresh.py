"""Refreshing one dataset end to end, and building the marts on top of the clean tables."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiclake.operators.freshness import checked_sources
from civiclake.operators.quality import Expectation, Watched
from civiclake.operators.versions import (
    latest_versions,
    latest_versions_incremental,
    merge_distinct_versions,
    new_versions,
)
from civiclake.plans import parcels
from civiclake.plans.names import with_standard_names
from civiclake.plans.spec import DatasetSpec, standardize
from civiclake.sources import tables
from civiclake.sources.files import with_constants

CHECKS = "metadata.table_metadata"
RECORDED = "metadata.recorded_checks"
PULLED = "metadata.pulled_checks"
ISO_TEXT = re.compile(r"\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}")


class GateFailed(RuntimeError):
    """Staged data failed its suite and the refresh was asked to stop then."""


@dataclass
class RefreshResult:
    """What a refresh did. ``delta`` are the clean rows it inserted or replaced, ``staged_rows`` the rows
    of the pull."""

    dataset: str
    action: str
    staged_rows: int | None = None
    report: DataFrame | None = None
    raw: DataFrame | None = None
    clean: DataFrame | None = None
    delta: DataFrame | None = None
    marts: dict[str, DataFrame] = field(default_factory=dict)


Model = Callable[[Callable[[str], DataFrame]], DataFrame]


def build_models(spark: SparkSession, models: dict[str, Model]) -> dict[str, DataFrame]:
    """Build user-written models in the given order. A model gets a resolver from table name to
    DataFrame, so it can build on any table or earlier model."""
    return {name: tables.publish(make(spark.table), name) for name, make in models.items()}


def staging_rows(df: DataFrame, source_updated: str, checked: str | None = None) -> DataFrame:
    """Standard column names, provenance stamped on every row."""
    if not ISO_TEXT.match(source_updated):
        raise ValueError(f"not ISO text: {source_updated}")
    checked = checked or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    return with_constants(
        with_standard_names(df), source_data_updated=source_updated, ingestion_check_time=checked
    )


def update_raw(spark: SparkSession, spec: DatasetSpec, staged: DataFrame | None) -> DataFrame:
    """Add the versions the raw table does not hold yet; what it holds is not rewritten."""
    name = f"data_raw.{spec.name}"
    if staged is None:
        return spark.table(name)
    source_cols, metadata = spec.source_cols(staged), list(spec.metadata_cols)
    if not spark.catalog.tableExists(name):
        empty = staged.select(*source_cols, *metadata).limit(0)
        first = merge_distinct_versions(empty, staged, source_cols, metadata)
        return tables.publish(first, name, hashed=source_cols)
    fresh = new_versions(tables.stored(spark, name), staged, source_cols, metadata, tables.buckets(spark, name))
    return tables.append(fresh, name, laid_out=True)


def recent_versions(raw: DataFrame, spec: DatasetSpec, mark: datetime) -> DataFrame:
    """Raw rows that may be newer than ``mark``, by their time of publication as landed.

    The standardized time is computed, so a condition on it cannot skip files. The landed ISO
    text can: time zones shift it by little more than a day, so rows two days before the mark
    are certainly older. Each pull is a folder of its own with one publication time, hence
    only the folders of recent pulls are read.
    """
    at = spec.updated_at
    stamped = at in spec.metadata_cols and isinstance(raw.schema[at].dataType, T.StringType)
    if not stamped:
        return raw
    day = (mark - timedelta(days=2)).strftime("%Y-%m-%d")
    return raw.where((F.col(at) >= day) | F.col(at).isNull())


def update_clean(spark: SparkSession, spec: DatasetSpec, raw: DataFrame, lenient: bool = False):
    """(clean table, rows inserted or replaced). The first time, or into an empty table, the
    latest version of every record is taken; later only of records changed since."""
    name = f"clean.{spec.name}_clean"
    key, updated = spec.record_id, spec.updated_at
    mark = None
    if spark.catalog.tableExists(name):
        mark = spark.table(name).agg(F.max(updated)).first()[0]
    if mark is None:
        parts = tables.parts_for(tables.stored_bytes(spark, f"data_raw.{spec.name}"))
        latest = latest_versions(standardize(raw, spec, lenient), key, updated)
        clean = tables.publish(latest, name, merge_key=key, parts=parts)
        return clean, clean
    recent = standardize(recent_versions(raw, spec, mark), spec, lenient)
    delta = latest_versions_incremental(recent, spark.table(name), key, updated)
    delta = tables.publish(delta, f"clean.{spec.name}_delta")  # read twice: merge and report
    return tables.merge(delta, name, key, distinct=True), delta


def refresh(
    spark: SparkSession,
    spec: DatasetSpec,
    pull: DataFrame | None,
    source_updated: str,
    check: DataFrame | None = None,
    suite: list[Expectation] | None = None,
    gate: bool = False,
    models: dict[str, Model] | None = None,
    lenient: bool = False,
) -> RefreshResult:
    """Freshness, staging, validation, raw versions, standardized view, clean upsert, marts.

    ``check`` is the source's current check record; when nothing is new the refresh stops there.
    A failed suite is reported and only stops the refresh with ``gate=True``.
    """
    tables.create_layers(spark)
    recorded = None
    if check is not None:
        recorded = record_check(spark, spec, check)
        if not recorded.agg(F.bool_or("updated_data_available")).first()[0]:
            return RefreshResult(spec.name, "skip")
    staged = report = n_rows = None
    if pull is not None:
        # the suite and the row count are taken while the rows are written
        watched = Watched(staging_rows(pull, source_updated), suite or [])
        staged = tables.publish(watched.rows, f"data_raw.temp_{spec.name}")
        n_rows = watched.row_count()
        if suite:
            report = tables.publish(watched.report(staged), f"metadata.{spec.name}_validation")
            if gate and not report.agg(F.bool_and("success")).first()[0]:
                raise GateFailed(f"{spec.name}: staged data failed its suite")
    existed = spark.catalog.tableExists(f"data_raw.{spec.name}")
    raw = update_raw(spark, spec, staged)
    tables.publish_view(standardize(raw, spec, lenient), f"{spec.name}_standardized")
    clean, delta = update_clean(spark, spec, raw, lenient)
    built = build_models(spark, models or {})
    if recorded is not None and staged is not None:
        tables.append(recorded.select("id"), PULLED)
    action = "update_table" if existed else "create_table"
    return RefreshResult(spec.name, action, n_rows, report, raw, clean, delta, built)


def record_check(spark: SparkSession, spec: DatasetSpec, check: DataFrame) -> DataFrame:
    """Record the source's check with its flags of availability; returns the recorded rows.

    Records are only ever appended: that a check's data was pulled is a row of its own in ``PULLED``, and ``CHECKS``
    shows both as one table.
    """
    if check.select("table_id").distinct().count() > 1:
        raise ValueError(f"{spec.name}: check records of more than one source table")
    first = not spark.catalog.tableExists(CHECKS)
    unpulled = check.withColumn("data_pulled_this_check", F.lit(False))
    state = checked_sources(check, unpulled.limit(0) if first else spark.table(CHECKS))
    recorded = tables.record_checks(state, RECORDED, ["table_id", "time_of_check"])
    if first:
        tables.create_like(spark, PULLED, recorded.select("id"))
        pulled = "p.id IS NOT NULL OR c.data_pulled_this_check AS data_pulled_this_check"
        columns = ", ".join(pulled if c == "data_pulled_this_check" else f"c.`{c}`" for c in recorded.columns)
        spark.sql(
            f"CREATE OR REPLACE VIEW {CHECKS} AS SELECT {columns} FROM {RECORDED} c "
            f"LEFT JOIN (SELECT DISTINCT id FROM {PULLED}) p ON c.id = p.id"
        )
    return recorded


# The parcel marts in the order they depend on each other.
PARCEL_MODELS: dict[str, Model] = {
    "feature.cook_county_parcel_sales_feature": lambda ref: parcels.parcel_sales_feature(
        ref("clean.cook_county_parcel_sales_clean")
    ),
    "feature.cook_county_parcel_locations_feature": lambda ref: parcels.parcel_locations_feature(
        ref("clean.cook_county_parcel_locations_clean"),
        ref("clean.cook_county_parcel_sales_clean"),
        ref("clean.chicago_police_district_boundaries_clean"),
        ref("clean.chicago_police_beat_boundaries_clean"),
        ref("clean.chicago_community_area_boundaries_clean"),
    ),
    "dwh.cook_county_parcel_locations_dim": lambda ref: parcels.parcel_locations_dim(
        ref("clean.cook_county_parcel_locations_clean"),
        ref("feature.cook_county_parcel_locations_feature"),
    ),
    "dwh.cook_county_parcel_owner_fact": lambda ref: parcels.parcel_owner_fact(
        ref("clean.cook_county_parcel_locations_clean"),
        ref("feature.cook_county_parcel_locations_feature"),
    ),
    "dwh.cook_county_parcel_sales_fact": lambda ref: parcels.parcel_sales_fact(
        ref("feature.cook_county_parcel_sales_feature"),
        ref("clean.cook_county_parcel_sales_clean"),
    ),
    "dwh.cook_county_parcel_value_assessments_fact": lambda ref: (
        parcels.parcel_value_assessments_fact(
            ref("clean.cook_county_parcel_value_assessments_clean")
        )
    ),
    "dwh.chicago_parcel_sales_analytical_table": lambda ref: parcels.chicago_parcel_sales_mart(
        ref("dwh.cook_county_parcel_locations_dim"),
        ref("dwh.cook_county_parcel_sales_fact"),
        ref("clean.chicago_community_area_boundaries_clean"),
    ),
}
