"""Landed files: CSV, GeoJSON, several files at once, and the inventory of a landing folder."""

from __future__ import annotations

import hashlib
import re
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiclake.functions.geometry import LANDED_TYPE
from civiclake.sources.geojson import feature_texts, open_file

COMPRESSED = re.compile(r"\.(gz|bz2|zst|lz4|snappy|deflate|xz)$")
SEPARATED_FEATURE = '{"type":"Feature",'


def with_constants(df: DataFrame, **constants: object) -> DataFrame:
    """Stamp every row with the same values, such as provenance or a vintage year."""
    return df.withColumns(
        {n: v if isinstance(v, Column) else F.lit(v) for n, v in constants.items()}
    )


#: How landed CSV is read, whoever reads it: a header row, doubled quotes, malformed values raise.
CSV_OPTIONS = {"header": "true", "mode": "FAILFAST", "escape": '"'}


def infer_csv_schema(
    spark: SparkSession, path: str, sampling_ratio: float = 1.0, **options: object
) -> T.StructType:
    """Look at a first pull once; keep the result and read later pulls with it."""
    reader = spark.read.options(**CSV_OPTIONS).options(**options).option("inferSchema", True)
    return reader.option("samplingRatio", sampling_ratio).csv(path).schema


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, **options: object
) -> DataFrame:
    """CSV with a header row. Without a schema all columns are text, so nothing is read twice."""
    reader = spark.read.options(**CSV_OPTIONS).options(**options)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def _feature_schema(properties: T.StructType | str) -> T.StructType:
    if isinstance(properties, str):
        properties = T.StructType.fromDDL(properties)
    return (
        T.StructType()
        .add("properties", properties)
        .add("geometry", T.StructType().add("type", "string").add("coordinates", "string"))
    )


def read_geojson(
    spark: SparkSession,
    path: str,
    properties: T.StructType | str,
    layout: str = "lines",
    split_bytes: int | None = None,
) -> DataFrame:
    """Features as rows: one column per property, ``geometry`` as (kind, coordinates text).

    * ``lines``: one feature per line; files split freely.
    * ``separated``: one collection written by a machine, each feature opening with the same
      text; that text is used as the record separator, so even one huge file splits.
    * ``document``: any well-formed collection. A file of up to ``split_bytes`` (default: those of a scan's
      split) is parsed by one task; a larger one is looked through for the boundaries of its
      features and read by as many tasks as it has splits, unless it is compressed.
    """
    feature = _feature_schema(properties)
    if layout == "lines":
        rows = spark.read.schema(feature).option("mode", "FAILFAST").json(path)
    elif layout == "separated":
        text = spark.read.option("lineSep", SEPARATED_FEATURE).text(path)
        # a record reads on into the separator before the next feature or the end of the
        # collection; the parser stops where the feature's own braces close
        opening = F.col("value").rlike(r'"features"\s*:\s*\[\s*$')
        other = F.col("value").rlike(r'"type"\s*:\s*"Feature"')
        unknown = F.raise_error(F.lit("a feature opens with other text: read it as layout document"))
        value = F.when(other, unknown.cast("string")).otherwise(F.concat(F.lit("{"), "value"))
        parsed = F.from_json(value, feature, {"mode": "FAILFAST"})
        rows = text.where(~opening | other).where(F.trim("value") != "").select(parsed.alias("f")).select("f.*")
    elif layout == "document":
        collection = T.StructType().add("features", T.ArrayType(feature))
        found = spark.read.format("binaryFile").load(path).select("path", "length")
        size = split_bytes or scan_split_bytes(spark)
        # one row a file, as Spark's own listing has
        listed = [(r["path"], r["length"]) for r in found.collect()]
        large = sorted(f for f in listed if f[1] > size and not COMPRESSED.search(f[0]))
        small = [f[0] for f in listed if f not in large]
        parts = []
        if small or not large:
            reader = spark.read.schema(collection).option("multiLine", True).option("mode", "FAILFAST")
            parts.append(reader.json(small or path).select(F.inline("features")))
        if large:
            texts = feature_texts(spark, large, size)
            parts.append(texts.select(F.from_json("value", feature, {"mode": "FAILFAST"}).alias("f")).select("f.*"))
        rows = reduce(DataFrame.unionByName, parts)
    else:
        raise ValueError(f"unknown layout {layout}")
    return rows.select("properties.*", F.col("geometry").cast(LANDED_TYPE).alias("geometry"))


def scan_split_bytes(spark: SparkSession) -> int:
    """How many bytes of a file one task of a scan reads."""
    text = spark.conf.get("spark.sql.files.maxPartitionBytes").strip().lower()
    size, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", text).groups()
    return int(size) << 10 * " kmgt".index(unit or " ")


def read_many(
    spark: SparkSession, paths: list[str], fmt: str = "parquet", **constants: object
) -> DataFrame:
    """Several files as one table, with constant columns. One scan when the schemas agree;
    otherwise columns are matched by name and missing ones are NULL."""
    frames = [spark.read.format(fmt).load(p) for p in paths]
    if all(f.schema == frames[0].schema for f in frames):
        return with_constants(spark.read.format(fmt).schema(frames[0].schema).load(paths), **constants)
    return with_constants(concatenated(*frames), **constants)


def concatenated(*frames: DataFrame) -> DataFrame:
    """Rows of all frames, columns matched by name, missing ones NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


LEAF_BYTES = 1 << 20
TABLE_ID = r"^(\S{4}-\S{4})"  # fixed value: landed files start with their table's id


def landed_files(
    spark: SparkSession, folder: str, table_id: str = TABLE_ID, digests: bool = False
) -> DataFrame:
    """path, name, table_id, modified, bytes of every landed file that is not empty.

    Files whose name does not match ``table_id`` are not landed data and left out. Contents are
    read only for ``digests``, which adds a digest of each file (see ``with_digests``).
    """
    found = spark.read.format("binaryFile").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    listed = found.select(
        "path",
        name.alias("name"),
        F.regexp_extract(name, table_id, 1).alias("table_id"),
        F.col("modificationTime").alias("modified"),
        F.col("length").alias("bytes"),
    ).where(F.col("table_id") != "")
    return with_digests(listed) if digests else listed


def with_digests(files: DataFrame, range_bytes: int | None = None) -> DataFrame:
    """Add ``digest`` to files (path, table_id, bytes): equal for equal contents, NULL where no other
    file of the table has the size, as such a file is not read.

    A digest is that of the digests of the file's leaves of 1 MiB, so ranges of a file of any size are read by
    several tasks (``range_bytes``, default: a scan's split), a few leaves at a time, and it does not depend on them.
    """
    spark = files.sparkSession
    leaves = max(1, (range_bytes or scan_split_bytes(spark)) // LEAF_BYTES)
    alike = repeated_sizes(files).select(F.col("table_id").alias("__table"), F.col("bytes").alias("__bytes"))
    wanted = files.join(alike, (F.col("table_id") == F.col("__table")) & (F.col("bytes") == F.col("__bytes")), "left_semi")
    size = F.lit(leaves * LEAF_BYTES)
    ranges = wanted.select("path", F.explode(F.sequence(F.lit(0), F.col("bytes") - 1, size)).alias("at"))
    # a few ranges for each task, whatever files they are of
    dealt = ranges.repartition(F.xxhash64("path", "at"))

    def read(batches):
        for batch in batches:
            for path, at in zip(*(c.to_pylist() for c in batch.columns)):
                yield pa.RecordBatch.from_pydict({"path": [path], "at": [at], "leaves": [leaf_digests(path, at, leaves)]})

    parts = dealt.mapInArrow(read, "path string, at bigint, leaves binary")
    ordered = F.array_sort(F.collect_list(F.struct("at", "leaves")))
    joined = F.aggregate(ordered, F.lit(b""), lambda whole, part: F.concat(whole, part["leaves"]))
    roots = parts.groupBy(F.col("path").alias("__path")).agg(F.sha2(joined, 256).alias("digest"))
    return files.join(roots, F.col("path") == F.col("__path"), "left").drop("__path")


def leaf_digests(path: str, at: int, leaves: int) -> bytes:
    """The digests of up to ``leaves`` leaves of a file from a place on, one after another."""
    found = []
    with open_file(path) as file:
        for n in range(leaves):
            leaf = file.read_at(LEAF_BYTES, at + n * LEAF_BYTES)
            if leaf:
                found.append(hashlib.sha256(leaf).digest())
            if len(leaf) < LEAF_BYTES:
                break
    return b"".join(found)


def repeated_sizes(files: DataFrame) -> DataFrame:
    """(table_id, bytes) that more than one file has: the only candidates for equal content."""
    counts = files.groupBy("table_id", "bytes").agg(F.count(F.lit(1)).alias("n_files"))
    return counts.where("n_files > 1")


def repeated_content(files: DataFrame, order: list[str]) -> DataFrame:
    """Files whose content an earlier file of the same table already had.

    The first file per content is one small aggregate; the others are found by comparing with it.
    """
    by = ["table_id", "bytes", "digest"]
    at = F.struct(*order)
    first = files.groupBy(*[F.col(c).alias(f"__{c}") for c in by]).agg(F.min(at).alias("__first"))
    same = at > F.col("__first")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return files.join(first, same, "left_semi")
