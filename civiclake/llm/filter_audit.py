"""How filters of a corpus interact: what each one removes in every order they can be applied.

A document fails some of k filters; documents are counted per part and set of failed filters, a
cell. The walk visits all 2^k subsets of active filters in Gray-code order, so that one filter is
toggled at a time. Each cell keeps how many of its filters are active: at the first one its
documents leave the running survivors, at the last one they come back. The survivors of every
subset are stored, and a step of an order, from a subset to one with a filter more, is the
difference of two of these states.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civiclake.llm.common import map_rows
from civiclake.plans.scratch import written

#: Letters of the filters of ``failure_cells``; a cell's mask has bit i for the i-th.
FILTERS = "ABCDE"
MIN_WORDS = 100
MIN_DISTINCT_PERCENT = 80
MAX_CAPITALS_PERCENT = 10
CAPITALS = bytes(range(65, 91))
MARKS = re.compile(rb"[#$%&*|]")
COPY = 1 << FILTERS.index("E")

#: The walk has 2^k states and a report k! orders.
MOST_FILTERS = 8
COUNTS = ("n", "good", "toxic")


def text_failures(text: str | None) -> int:
    """The mask of the filters that one text fails by itself; null counts as empty."""
    raw = text.encode("utf-8", "surrogatepass") if text else b""
    words = raw.split()
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    fails = (
        len(words) < MIN_WORDS,
        100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words),
        100 * capitals > MAX_CAPITALS_PERCENT * len(text or ""),
        MARKS.search(raw) is not None,
    )
    return sum(1 << i for i, failed in enumerate(fails) if failed)


def failure_cells(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents per lang and set of failed filters.

    Filter E fails a text that a smaller doc_id has too, by a 128-bit digest of the whole text.
    Texts and languages that are null count as empty. Rows without id take part, have no label and
    neither make a copy nor are one. Rows that repeat an id and text count each, none as the other's
    copy. A document is good (toxic) if any label row of its id says so; other columns are not read.

    Copies are counted per digest before they move, so a group of copies of any size is a few
    numbers per task; what is joined and windowed is one row per digest, part, id and label.
    """

    def judged(rows):
        for key, lang, text in rows:
            digest = hashlib.blake2b((text or "").encode("utf-8", "surrogatepass"), digest_size=16).digest()
            yield key, lang or "", text_failures(text), digest

    id_type = documents.schema["doc_id"].dataType.simpleString()
    slim = documents.select("doc_id", "lang", "text")
    texts = map_rows(slim, judged, f"doc_id {id_type}, part string, mask int, digest binary")
    texts = texts.groupBy("digest", "mask", "part", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    # rows without id find no label; the second key spreads them
    texts = texts.withColumn("__spread", F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0)))
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    marked = texts.join(known.withColumn("__spread", F.lit(0).cast("bigint")), ["doc_id", "__spread"], "left").fillna(
        0, ["good", "toxic"]
    )
    named = F.col("doc_id").isNotNull()
    groups = marked.groupBy("digest", "mask", "part", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(named, F.col("n")).otherwise(0)).alias("named"),
        F.min(F.when(named, F.struct("doc_id", "n"))).alias("least"),
    )
    # the rows of one text: one per part and label
    first = F.min("least.doc_id").over(Window.partitionBy("digest"))
    originals = F.when(F.col("least.doc_id") == F.col("first"), F.col("least.n")).otherwise(0)
    split = groups.withColumn("first", first).withColumn("copies", F.col("named") - originals)
    cells = split.select(
        "part",
        "good",
        "toxic",
        F.inline(
            F.array(
                F.struct(F.col("mask").alias("mask"), (F.col("n") - F.col("copies")).alias("n")),
                F.struct(F.col("mask").bitwiseOR(F.lit(COPY)).alias("mask"), F.col("copies").alias("n")),
            )
        ),
    )
    return cells.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("good") * F.col("n")).alias("good"), F.sum(F.col("toxic") * F.col("n")).alias("toxic")
    )


def survivors(cells: np.ndarray) -> np.ndarray:
    """Row s: the column sums of ``cells`` over the masks that share no filter with subset s.

    ``cells`` has one row per mask. The subsets are walked in Gray-code order.
    """
    size = len(cells)
    masks = np.arange(size)
    active = np.zeros(size, np.int64)  # of each cell: its filters that are active
    running = cells.sum(axis=0)
    states = np.empty_like(cells)
    states[0] = running
    subset = 0
    for step in range(1, size):
        toggled = step & -step
        subset ^= toggled
        cell = masks[masks & toggled != 0]
        if subset & toggled:
            running = running - cells[cell[active[cell] == 0]].sum(axis=0)
            active[cell] += 1
        else:
            active[cell] -= 1
            running = running + cells[cell[active[cell] == 0]].sum(axis=0)
        states[subset] = running
    return states


def steps(states: np.ndarray, filters: Sequence[str]) -> list[tuple]:
    """All steps of all orders from the survivors (n, good, toxic) of every subset.

    (filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)
    """
    k = len(filters)
    every = (1 << k) - 1
    removed = np.zeros((1 << k, k, states.shape[1]), np.int64)
    for subset in range(1 << k):
        for f in range(k):
            removed[subset, f] = states[subset] - states[subset | 1 << f]
    failing = removed[0, :, 0]
    unique = [int(removed[every ^ 1 << f, f, 0]) for f in range(k)]
    shapley = [
        sum(
            factorial(s.bit_count()) * factorial(k - 1 - s.bit_count()) * int(removed[s, f, 0])
            for s in range(1 << k)
            if not s & 1 << f
        )
        for f in range(k)
    ]
    rows = []
    for order in permutations(range(k)):
        subset = 0
        name = "".join(filters[f] for f in order)
        for number, f in enumerate(order, 1):
            lost, good, toxic = (int(v) for v in removed[subset, f])
            subset |= 1 << f
            kept = int(states[subset, 0])
            rows.append((name, number, kept, lost, int(failing[f]) - lost, unique[f], good, toxic, shapley[f]))
    return rows


def audit(cells: DataFrame, filters: Sequence[str] = FILTERS) -> DataFrame:
    """One row per part, order of all ``filters`` and step, from cells (part, mask, n, good, toxic).

    The filter of a step is letter ``step`` of ``filter_order``. ``kept``: left after the step;
    ``removed``: gone in it; ``redundant``: failing its filter but gone before; ``unique_fails``:
    failing no other filter; ``good_lost`` and ``toxic_lost``: of the removed; ``shapley``: the
    filter's removed, summed over all orders. Cells may repeat; an empty table gives no rows.
    A part is one group of at most 2^k cells.
    """
    k = len(filters)
    if not 1 <= k <= MOST_FILTERS or len(set(filters)) < k:
        raise ValueError(f"1 to {MOST_FILTERS} different filters, not {list(filters)}")
    schema = (
        "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
        "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"
    )
    types = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]
    names = [part.split()[0] for part in schema.split(", ")]

    def walked(group: pa.Table) -> pa.Table:
        table = np.zeros((1 << k, len(COUNTS)), np.int64)
        masks = group.column("mask").to_numpy()
        for i, name in enumerate(COUNTS):
            np.add.at(table[:, i], masks, group.column(name).to_numpy())
        rows = steps(survivors(table), filters)
        columns = [[group.column("part")[0].as_py()] * len(rows), *map(list, zip(*rows))]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    summed = cells.groupBy("part", "mask").agg(*[F.sum(c).cast("bigint").alias(c) for c in COUNTS])
    return summed.groupBy("part").applyInArrow(walked, schema)


def filter_interactions(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``audit`` of the five filters over whole documents, per lang; the cells are written once."""
    return audit(written(failure_cells(documents, labels), "cells"))
