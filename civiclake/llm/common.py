"""Helpers the operators share: words, batches, sizes, tables written in between."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.plans.scratch import written  # noqa: F401  (one import place for the operators)

#: Bytes outside words become spaces, A-Z becomes a-z, every byte of a non-ASCII letter stays.
WORD_BYTES = bytes(
    (b | 32 if 65 <= b <= 90 else b)
    if (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
    else 32
    for b in range(256)
)

#: Rows turned into Python objects at a time, so that a batch of long texts is not held twice.
ROWS_AT_A_TIME = 128


def alnum_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z, as UTF-8; null has none."""
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The rows of a batch as tuples, a few at a time."""
    for at in range(0, batch.num_rows, ROWS_AT_A_TIME):
        part = batch.slice(at, ROWS_AT_A_TIME)
        yield from zip(*(column.to_pylist() for column in part.columns), strict=True)


def map_rows(df: DataFrame, function, schema: str) -> DataFrame:
    """``function(rows)`` yields output tuples for the rows of a whole partition, in any number.

    The output is sent on in small batches, so neither side holds a partition.
    """
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        rows, held, size = [], 0, 0
        stream = (row for batch in batches for row in rows_of(batch))
        for row in function(stream):
            rows.append(row)
            held += 1
            size += sum(v.nbytes if isinstance(v, np.ndarray) else len(v) for v in row if isinstance(v, (bytes, str, np.ndarray)))
            if held >= 4096 or size >= 8 << 20:
                yield _packed(rows, target)
                rows, held, size = [], 0, 0
        if rows:
            yield _packed(rows, target)

    return df.mapInArrow(run, schema)


def map_batches(df: DataFrame, function, added: str = "") -> DataFrame:
    """``function(batch)`` gets record batches of whole rows and returns them changed, filtered or with added columns."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                yield function(batch.slice(at, 1024))

    return df.mapInArrow(run, ", ".join([*fields, *([added] if added else [])]))


def _packed(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, field.type) for values, field in zip(zip(*rows, strict=True), schema, strict=True)],
        schema=schema,
    )


def table_bytes(df: DataFrame, column: str = "text") -> int:
    """Bytes of the input: Catalyst's estimate from file sizes, or the column's length if it has none."""
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if estimate < 1 << 60:
        return estimate
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0


def ascii_lower(column: Column) -> Column:
    """Lower-cases A-Z alone."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
