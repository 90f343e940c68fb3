"""Layer tables in the catalog.

A layer table is a view over one stored table, of the catalog's own kind. Publishing stores a new table
and then points the view at it, so a table can be rebuilt from itself, readers never see a half-written
state, and a failed job leaves the previous version in place. The version before the current one is kept
for readers still at work; older ones are dropped with their files.

Appends are Spark's own, to the stored table. A table that is merged by a key is stored in partitions by
the hash of that key, and a merge overwrites the partitions its rows fall into. A table of versions
is stored in buckets by the hash of a row, which is stored too, so that a pull can be compared without a shuffle of the
store. These columns are hidden by the view, and a read is a plain scan.
"""

from __future__ import annotations

import json
import re
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civiclake.operators.versions import ROW_HASH, row_digest, upserted
from civiclake.plans.scratch import fresh_path, written
from civiclake.sources.files import with_constants

LAYERS = ("data_raw", "standardized", "clean", "feature", "dwh", "metadata")
STORED = re.compile(r"__[0-9a-f]{32}$")
PART = "__part"
PART_BYTES = 64 * 1024 * 1024  # a partition of a merged table is meant to hold
MOST_PARTS = 10_000


def create_layers(spark: SparkSession, layers: tuple[str, ...] = LAYERS) -> list[str]:
    """One database per layer, under its own name, stored in the shared folder; returns those that were missing."""
    missing = [layer for layer in layers if not spark.catalog.databaseExists(layer)]
    for layer in missing:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}` LOCATION '{fresh_path(spark, layer)}'")
    return missing


def tables_in(spark: SparkSession, layer: str, pattern: str | None = None) -> list[str]:
    if not spark.catalog.databaseExists(layer):
        return []
    names = (t.name for t in spark.catalog.listTables(layer, pattern) if not t.isTemporary)
    return sorted(n for n in names if not STORED.search(n))


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def read(spark: SparkSession, name_or_select: str) -> DataFrame:
    """A table by name, or the result of any SELECT."""
    text = name_or_select.strip()
    return spark.sql(text) if " " in text else spark.table(text)


def publish(
    df: DataFrame,
    name: str,
    partition_by: list[str] | None = None,
    sort_by: list[str] | None = None,
    merge_key: str | None = None,
    parts: int = 1,
    hashed: list[str] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Store a full new version of a table and switch to it.

    ``sort_by`` stores rows in ranges of these columns, so that filters on them skip files. ``merge_key``
    stores them in ``parts`` partitions by the hash of that key, for ``merge``. ``hashed`` stores the hash of
    these columns, in as many ``buckets`` (default: the session's shuffle partitions).
    """
    spark = df.sparkSession
    columns = df.columns
    if sort_by:
        df = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
    layout = {"columns": columns, "merge_key": merge_key, "parts": parts, "hashed": hashed, "buckets": None}
    if hashed:
        layout["buckets"] = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _laid_out(df, layout)
    writer = rows.write.format("parquet")
    if merge_key:
        writer = writer.partitionBy(PART)
    elif partition_by:
        writer = writer.partitionBy(*partition_by)
    if hashed:
        writer = writer.bucketBy(layout["buckets"], ROW_HASH)
    stored = f"{name}__{uuid.uuid4().hex}"
    writer.saveAsTable(stored)
    before = _layout(spark, name) if table_exists(spark, name) else {}
    layout |= {"stored": stored, "before": before.get("stored")}
    listed = ", ".join(f"`{c}`" for c in columns)
    kept = json.dumps(layout).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('layout' = '{kept}') AS SELECT {listed} FROM {stored}")
    if before.get("before"):
        spark.sql(f"DROP TABLE IF EXISTS {before['before']}")
    return spark.table(name)


def _layout(spark: SparkSession, name: str) -> dict:
    """How a layer table is stored, as ``publish`` has noted it."""
    return json.loads(spark.sql(f"SHOW TBLPROPERTIES {name} ('layout')").first()["value"])


def _laid_out(df: DataFrame, layout: dict) -> DataFrame:
    """Rows with the hidden columns, dealt out as they are stored, so that few files are written."""
    if layout["merge_key"]:
        return _by_parts(df.withColumn(PART, part_of(layout["merge_key"], layout["parts"])), layout)
    if layout["hashed"]:
        return df.withColumns(row_digest(layout["hashed"])).repartition(layout["buckets"], ROW_HASH)
    return df


def _by_parts(df: DataFrame, layout: dict) -> DataFrame:
    """Rows by partition, sized by Spark at run time: small partitions share a task, large ones are split."""
    return df.hint("rebalance", PART) if layout["parts"] > 1 else df


def part_of(key: str, parts: int) -> Column:
    """The partition of a merged table that a key is stored in."""
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def stored(spark: SparkSession, name: str) -> DataFrame:
    """A layer table with its hidden columns."""
    return spark.table(_layout(spark, name)["stored"])


def buckets(spark: SparkSession, name: str) -> int | None:
    """Into how many buckets the rows of a layer table are dealt by their hash."""
    return _layout(spark, name)["buckets"]


def stored_bytes(spark: SparkSession, name: str) -> int:
    """The size of a layer table's files."""
    table = _layout(spark, name)["stored"]
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS NOSCAN")
    shown = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    return int(shown["Statistics"].split()[0])


def parts_for(size: int) -> int:
    """Partitions for a merged table of that many bytes."""
    return min(MOST_PARTS, 1 + size // PART_BYTES)


def publish_view(df: DataFrame, name: str) -> None:
    """A lazy table of the session: nothing is stored."""
    df.createOrReplaceTempView(name.split(".")[-1])


def append(df: DataFrame, name: str, laid_out: bool = False) -> DataFrame:
    """Add rows to a table; what is stored already is not read or rewritten.

    The rows must have the table's columns, in any order, with the same types; if they are ``laid_out`` as the
    table is stored, with its hidden columns too.
    """
    spark = df.sparkSession
    if not table_exists(spark, name):
        return publish(df, name)
    table = stored(spark, name) if laid_out else spark.table(name)
    own, new = ({f.name: f.dataType for f in d.schema.fields} for d in (table, df))
    if own != new:
        differing = sorted(c for c in own.keys() | new.keys() if own.get(c) != new.get(c))
        raise ValueError(f"rows for {name} differ from the table in {differing}")
    layout = _layout(spark, name)
    rows = df if laid_out else _laid_out(df, layout)
    rows.select(*spark.table(layout["stored"]).columns).write.insertInto(layout["stored"])
    return spark.table(name)


def replace_staging(df: DataFrame, dataset: str, **constants: object) -> DataFrame:
    """The staging table of a pull, replacing the one before."""
    return publish(with_constants(df, **constants), f"data_raw.temp_{dataset}")


def create_like(spark: SparkSession, name: str, like: DataFrame) -> DataFrame:
    """An empty table with the columns of another."""
    return publish(like.limit(0), name)


def merge(delta: DataFrame, name: str, key: str, distinct: bool = False) -> DataFrame:
    """Upsert by key; the table takes on the columns of ``delta``, which must not repeat a key
    (checked, unless it is known to be ``distinct``).

    Only the partitions that keys of ``delta`` fall into are read and written. The table is stored anew, in
    partitions that fit its size, if its columns change, if it was not stored for this key, or if it has
    outgrown its partitions fourfold.
    """
    spark = delta.sparkSession
    if not table_exists(spark, name):
        return publish(delta, name, merge_key=key)
    table, layout = spark.table(name), _layout(spark, name)
    most, touched = 1, [0]
    if not distinct or layout["parts"] > 1:
        per_key = delta.groupBy(F.col(key).alias("__key")).agg(F.count(key).alias("n"))
        # at most MOST_PARTS numbers
        most, touched = per_key.agg(F.max("n"), F.collect_set(part_of("__key", layout["parts"]))).first()
    if (most or 0) > 1:
        raise ValueError(f"rows to merge into {name} repeat values of {key}")
    parts = parts_for(stored_bytes(spark, name))
    fits = layout["merge_key"] == key and parts < 4 * layout["parts"]
    if not fits or set(table.columns) != set(delta.columns):
        return publish(upserted(table, delta, key), name, merge_key=key, parts=parts)
    changes = delta.withColumn(PART, part_of(key, layout["parts"]))
    whole = spark.table(layout["stored"])
    merged = upserted(whole.where(F.col(PART).isin(sorted(touched))), changes, key).select(*whole.columns)
    _overwrite_parts(_by_parts(merged, layout), layout["stored"])
    return spark.table(name)


def _overwrite_parts(rows: DataFrame, table: str) -> None:
    """Replace the partitions that ``rows`` hold; the job's commit moves them into place."""
    conf, mode = rows.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
    before = conf.get(mode)
    conf.set(mode, "dynamic")
    try:
        rows.write.insertInto(table, overwrite=True)
    finally:
        conf.set(mode, before)


def absent_rows(df: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key the target does not hold yet (insert, do nothing on conflict)."""
    return df.join(target.select(*keys), keys, "left_anti")


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Of rows that repeat a key, the first by a hash of the whole row; rows with a NULL in the key all stay."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64(*df.columns)))
    first = df.where(whole).withColumn("__rank", rank).where("__rank = 1").drop("__rank")
    return first.unionByName(df.where(~whole))


def insert_if_absent(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """Add rows of new keys, one per key, as an insert that skips conflicts does."""
    spark = df.sparkSession
    df = one_per_key(df, keys)
    if not table_exists(spark, name):
        return publish(df, name)
    return append(absent_rows(df, spark.table(name), keys), name)


def numbered(records: DataFrame, existing: DataFrame | None, order: list[str]) -> DataFrame:
    """Give new records consecutive ids, in ``order``, after the largest one in use.

    The rows are cut into ordered slices by range; a row's number is its place in its slice
    plus the sizes of the slices before it, so no task sees more than one slice.
    """
    start = F.lit(0)
    if existing is not None:
        start = F.coalesce(existing.agg(F.max("id")).scalar(), F.lit(0))
    slices = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = records.repartitionByRange(slices, *order).withColumn("__slice", F.spark_partition_id())
    cut = written(cut, "numbered")
    before = Window.orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)
    sizes = cut.groupBy(F.col("__slice").alias("__of")).agg(F.count(F.lit(1)).alias("__size"))
    # one row per slice
    offsets = sizes.select("__of", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__at"))
    place = F.row_number().over(Window.partitionBy("__slice").orderBy(*order))
    joined = cut.withColumn("__place", place).join(
        F.broadcast(offsets), F.col("__slice") == F.col("__of")
    )
    number = F.col("__place") + F.col("__at") + start
    return joined.select(number.cast("bigint").alias("id"), *records.columns)


def record_checks(records: DataFrame, name: str, order: list[str]) -> DataFrame:
    """Append check records with new ids; returns the inserted rows."""
    spark = records.sparkSession
    existing = spark.table(name) if table_exists(spark, name) else None
    rows = numbered(records, existing, order)
    path = fresh_path(spark, "checks")
    rows.write.parquet(path)
    inserted = spark.read.parquet(path)
    append(inserted, name)
    return inserted


def with_field_set(
    df: DataFrame, condition, updates: dict[str, object], allowed: tuple[str, ...]
) -> DataFrame:
    """Set whitelisted fields where a condition holds."""
    wrong = sorted(set(updates) - set(allowed))
    if wrong:
        raise ValueError(f"fields that may not be updated: {wrong}")
    return df.withColumns(
        {
            c: F.when(condition, F.lit(v).cast(df.schema[c].dataType)).otherwise(F.col(c))
            for c, v in updates.items()
        }
    )


def drop_staging(spark: SparkSession, layer: str = "data_raw", prefix: str = "temp_") -> list[str]:
    """Drop all staging tables with their files; returns their names."""
    names = [t for t in tables_in(spark, layer) if t.startswith(prefix)]
    for t in names:
        layout = _layout(spark, f"`{layer}`.`{t}`")
        spark.sql(f"DROP VIEW IF EXISTS `{layer}`.`{t}`")
        for table in filter(None, (layout["stored"], layout["before"])):
            spark.sql(f"DROP TABLE IF EXISTS {table}")
    return names
