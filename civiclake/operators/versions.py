"""The version stores: every distinct version of a record, and the latest one per record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civiclake.functions.columns import nulls_first_desc, rank_struct

PROVENANCE = ["source_data_updated", "ingestion_check_time"]
ROW_HASH, ROW_CHECK = "__row_hash", "__row_check"


def distinct_pull(staged: DataFrame, source_cols: list[str], metadata_cols: list[str] = PROVENANCE):
    """Distinct rows of one pull. Map-side aggregation collapses repeated rows before the shuffle."""
    return staged.select(*source_cols, *metadata_cols).dropDuplicates()


def merge_distinct_versions(
    existing: DataFrame,
    staged: DataFrame | None,
    source_cols: list[str],
    metadata_cols: list[str] = PROVENANCE,
) -> DataFrame:
    """One row per distinct ``source_cols``; a copy already stored wins over a staged one.

    NULLs compare equal. Within one side the smallest metadata wins, so the result does not
    depend on row order. Without a staging table the stored rows pass through unchanged.

    One shuffle: rows are grouped by an 8-byte hash first (so the sort in the aggregate decides
    almost every comparison on it) plus all source columns (so no two versions are ever confused).
    """
    columns = [*source_cols, *metadata_cols]
    stored = existing.select(*columns)
    if staged is None:
        return stored
    both = stored.withColumn("__side", F.lit(1)).unionByName(
        staged.select(*columns).withColumn("__side", F.lit(2))
    )
    kept = F.struct("__side", *[F.col(m) for m in metadata_cols])
    merged = (
        both.withColumn("__hash", F.xxhash64(*source_cols))
        .groupBy("__hash", *source_cols)
        .agg(F.min(kept).alias("__kept"))
    )
    return merged.select(*source_cols, *[F.col(f"__kept.{m}").alias(m) for m in metadata_cols])


def row_digest(source_cols: list[str]) -> dict[str, Column]:
    """128 bits that stand for a version, in two columns. NULLs count as values, by their place."""
    absent = F.array(*[F.col(c).isNull() for c in source_cols])
    return {ROW_HASH: F.xxhash64(*source_cols), ROW_CHECK: F.xxhash64(absent, *source_cols)}


def new_versions(
    existing: DataFrame,
    staged: DataFrame,
    source_cols: list[str],
    metadata_cols: list[str] = PROVENANCE,
    buckets: int | None = None,
) -> DataFrame:
    """Only the staged versions the store does not hold: what an append-only refresh writes.

    Where the store was built by this module its rows are distinct already, so appending these
    rows gives the same table as ``merge_distinct_versions`` without rewriting what is stored.

    If ``existing`` holds its digests in as many ``buckets``, of the store only these 16 bytes a row are read,
    and they are neither shuffled nor sorted: each bucket streams past the digests of the pull. The digests are
    then returned too. The pull's own rows are compared by their values, and made distinct before they
    are dealt to the buckets, so no row of it is a hot key.
    """
    digests = list(row_digest(source_cols))
    staged = staged.withColumns(row_digest(source_cols))
    fresh = staged.select(*digests, *source_cols, *metadata_cols).distinct()
    known = existing if ROW_CHECK in existing.columns else existing.withColumns(row_digest(source_cols))
    known = known.select(*digests)
    if not buckets:
        unknown = fresh.join(known, digests, "left_anti")
    else:
        fresh = fresh.repartition(buckets, ROW_HASH)
        pulled = staged.select(*digests).distinct().repartition(buckets, ROW_HASH)
        known = known.join(pulled.hint("shuffle_hash"), _same_digest(known, pulled), "left_semi")
        unknown = fresh.join(known.hint("shuffle_hash"), _same_digest(fresh, known), "left_anti")
    # what is left may repeat a version with other metadata, if the pull has several
    kept = F.min(F.struct(*[F.col(m) for m in metadata_cols])).alias("__kept")
    first = unknown.groupBy(*digests, *source_cols).agg(kept)
    metadata = [F.col(f"__kept.{m}").alias(m) for m in metadata_cols]
    return first.select(*source_cols, *metadata, *(digests if buckets else []))


def _same_digest(a: DataFrame, b: DataFrame) -> Column:
    """Equal digests; the second half is no join key, as the buckets are those of the first."""
    return (a[ROW_HASH] == b[ROW_HASH]) & (a[ROW_CHECK].bitwiseXOR(b[ROW_CHECK]) == 0)


def keep_stored_copy(
    both: DataFrame, source_cols: list[str], priority: str = "retention_priority"
) -> DataFrame:
    """Rank the copies of each version by ``priority`` and keep the first."""
    w = Window.partitionBy(*source_cols).orderBy(F.col(priority).asc_nulls_last())
    return both.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def _newest_first(updated_at: str, tie_breakers: list[str]) -> list[Column]:
    return [nulls_first_desc(updated_at), *[nulls_first_desc(t) for t in tie_breakers]]


def latest_versions(
    versions: DataFrame,
    record_id: str,
    updated_at: str = "source_data_updated",
    tie_breakers: list[str] | None = None,
) -> DataFrame:
    """The most recently updated version of each record (a version without a date ranks first).

    Equal dates fall back on ``tie_breakers`` and then on a hash of the row. Spark limits each
    map-side partition to one row per record before the shuffle, so a record with very many
    versions costs no more than any other.
    """
    ranked = versions.withColumn("__row_hash", F.xxhash64(*versions.columns))
    w = Window.partitionBy(record_id).orderBy(
        *_newest_first(updated_at, [*(tie_breakers or []), "__row_hash"])
    )
    return (
        ranked.withColumn("__rn", F.row_number().over(w))
        .where(F.col("__rn") == 1)
        .drop("__rn", "__row_hash")
    )


def latest_versions_incremental(
    versions: DataFrame,
    current: DataFrame,
    record_id: str,
    updated_at: str = "source_data_updated",
    tie_breakers: list[str] | None = None,
) -> DataFrame:
    """The rows to upsert: latest version of every record changed since ``current`` was built.

    A record counts as changed when some version is newer than the newest date in ``current``;
    an empty ``current`` has no such date and gives no rows (use ``latest_versions`` then).

    The latest version of a changed record is itself newer than that date or has no date, so
    older versions need not be read: the comparison is pushed into the scan of ``versions``
    instead of ranking all versions of all changed records.
    """
    mark = current.agg(F.max(updated_at).alias("mark"))
    at = F.col(updated_at)
    candidates = versions.where((at > mark.scalar()) | at.isNull())
    names = versions.columns
    order = rank_struct(updated_at, *(tie_breakers or []), F.xxhash64(*names))
    picked = candidates.groupBy(F.col(record_id).alias("__id")).agg(
        F.max(at).alias("__newest"),
        F.max_by(F.struct(*names), order).alias("__row"),
    )
    return picked.where(F.col("__newest").isNotNull()).select("__row.*")


def upserted(target: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """``target`` with matched rows replaced by ``delta`` and the other rows of it added.

    The result has the columns of ``delta``: new ones are filled with NULL in kept rows and
    columns no longer delivered are dropped.
    """
    kept = target.join(delta.select(key), key, "left_anti")
    return kept.unionByName(delta, allowMissingColumns=True).select(*delta.columns)
