"""Each landed file goes through the refresh exactly once.

Structured Streaming remembers which files it has seen; ``availableNow`` processes what is new
and stops, so the same call serves a schedule. A batch repeated after a failure adds nothing,
because the raw store keeps each version once.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.operators.quality import Expectation
from civiclake.plans.refresh import refresh
from civiclake.plans.spec import DatasetSpec
from civiclake.sources import tables
from civiclake.sources.files import CSV_OPTIONS

# table id, '_', time of the pull, extension; file systems without ':' in names have '_' or '-'
PULL_TIME = re.compile(r"^\S{4}-\S{4}_(\d{4}-\d{2}-\d{2}T\d{2}[:_-]\d{2}[:_-]\d{2}(?:\.\d+)?Z)")
SET_ASIDE = "metadata.landed_files_set_aside"


def pull_time(file_name: str) -> str | None:
    """The time of the pull in a landed file's name as ISO text, None if the name has none."""
    found = PULL_TIME.match(file_name)
    return re.sub(r"T(\d{2})[_-](\d{2})[_-](\d{2})", r"T\1:\2:\3", found[1]) if found else None


def refresh_landed(
    spark: SparkSession,
    spec: DatasetSpec,
    folder: str,
    schema: str,
    checkpoint: str,
    suite: list[Expectation] | None = None,
    max_files: int = 1000,
) -> int:
    """Refresh ``spec`` from CSV files that landed since the last call; returns the batch count.

    The time in a file's name is taken as the time its source was updated; files of different
    times in one batch go through the refresh one time at a time, oldest first, and each pull reads
    its own files only. Files whose name has no time are listed in ``SET_ASIDE`` and left out.
    """
    stream = (
        spark.readStream.schema(schema)
        .options(**CSV_OPTIONS)
        .option("maxFilesPerTrigger", max_files)
        .csv(folder)
    )
    done = []

    def batch(df: DataFrame, batch_id: int) -> None:
        # one name per landed file: bounded by max_files
        found = [unquote(r.path) for r in df.select(F.input_file_name().alias("path")).distinct().collect()]
        pulls: dict[str, list[str]] = {}
        strays = []
        for path in found:
            at = pull_time(path.rsplit("/", 1)[-1])
            pulls.setdefault(at, []).append(path) if at else strays.append((path,))
        for at in sorted(pulls):
            pull = spark.read.schema(schema).options(**CSV_OPTIONS).csv(sorted(pulls[at]))
            refresh(spark, spec, pull, at, suite=suite)
        if strays:
            tables.create_layers(spark)
            tables.append(spark.createDataFrame(sorted(strays), "path string"), SET_ASIDE)
        done.append(batch_id)

    query = (
        stream.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(done)
