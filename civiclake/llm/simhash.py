"""SimHash near-duplicates: a binary trie of fingerprints joined with itself.

Two nodes of the trie are visited together, starting with each root and itself. Going down one
bit, a pair splits into the pairs of their children; children of different bits add one to the
differing bits, and a pair over the budget is dropped with all fingerprints below it.

The trie is cut where fingerprints agree on a block of bits: with at most three differing bits,
one of four blocks is the same in both. Each (block, value) is a trie of its own and a Spark
group; a group too large for one task is cut again by blocks of its remaining bits. Links inside
a task are reduced to a spanning forest before they leave it, so copies do not multiply.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiclake.llm.common import map_batches, map_rows
from civiclake.llm.components import smallest_reachable
from civiclake.plans.scratch import written

BITS = 64
SEED = 42

#: Distinct fingerprints of one trie that a task may join; above it the trie is cut further.
TRIE_FINGERPRINTS = 8192

#: Fingerprints gathered in a task before their tries are joined, and node pairs followed at a time.
GATHERED = 1 << 17
PAIRS_AT_A_TIME = 1 << 20


def fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """The majority of the bits of the hashes of all shingles; 0 without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    size = min(shingle_words, len(words))
    firsts = [0, *(ends[: len(words) - size] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], SEED) for a, b in zip(firsts, ends[size - 1 :].tolist())]
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], "<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, shingle_words: int, id_column: str, text_column: str) -> DataFrame:
    """(doc_id, fp): the signed 64-bit fingerprint of every whole text."""

    def run(rows):
        for key, text in rows:
            yield key, int(np.uint64(fingerprint(text, shingle_words)).astype(np.int64))

    id_type = documents.schema[id_column].dataType.simpleString()
    return map_rows(documents.select(id_column, text_column), run, f"doc_id {id_type}, fp bigint")


class _Forest:
    def __init__(self, size: int) -> None:
        self.up = list(range(size))

    def root(self, n: int) -> int:
        up = self.up
        while up[n] != n:
            up[n] = up[up[n]]
            n = up[n]
        return n

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def trie_self_join(groups: np.ndarray, values: np.ndarray, budget: int) -> list[tuple[int, int]]:
    """A spanning forest of the links inside each group, as pairs of positions.

    ``groups`` and, inside a group, the unsigned ``values`` ascend. A node is a range of positions
    at a depth; its children are cut at the first position whose next bit is set.
    """
    cuts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1], True])
    low, high = cuts[:-1], cuts[1:]
    many = high - low > 1
    low, high = low[many], high[many]
    forest, links = _Forest(len(values)), []
    stack = [(0, low, high, low, high, np.zeros(len(low), np.int64))]
    ones: dict[int, np.ndarray] = {}
    while stack:
        depth, a0, a1, b0, b1, errors = stack.pop()
        single = (a1 - a0 == 1) & (b1 - b0 == 1)
        if single.any():
            x, y = a0[single], b0[single]
            near = (x != y) & (np.bitwise_count(values[x] ^ values[y]) <= budget)
            links += [pair for pair in zip(x[near].tolist(), y[near].tolist()) if forest.join(*pair)]
            a0, a1, b0, b1, errors = (part[~single] for part in (a0, a1, b0, b1, errors))
        if not len(a0) or depth == BITS:
            continue
        if len(a0) > PAIRS_AT_A_TIME:
            for at in range(0, len(a0), PAIRS_AT_A_TIME):
                stack.append((depth, *(part[at : at + PAIRS_AT_A_TIME] for part in (a0, a1, b0, b1, errors))))
            continue
        if depth not in ones:
            bit = (values >> np.uint64(BITS - 1 - depth)) & np.uint64(1)
            ones[depth] = np.r_[0, np.cumsum(bit.astype(np.int64))]
        set_before = ones[depth]
        am, bm = a1 - (set_before[a1] - set_before[a0]), b1 - (set_before[b1] - set_before[b0])
        own = a0 == b0
        children = [
            (a0, am, b0, bm, errors, None),
            (am, a1, bm, b1, errors, None),
            (a0, am, bm, b1, errors + 1, None),
            (am, a1, b0, bm, errors + 1, ~own),  # of a node with itself, the mirror of the last
        ]
        kept = []
        for c0, c1, d0, d1, wrong, also in children:
            keep = (c1 > c0) & (d1 > d0) & (wrong <= budget) & ~((c0 == d0) & (c1 - c0 < 2))
            if also is not None:
                keep &= also
            kept.append([part[keep] for part in (c0, c1, d0, d1, wrong)])
        stack.append((depth + 1, *(np.concatenate(parts) for parts in zip(*kept))))
    return links


def _block(value: Column, bits: int, blocks: int, at: int) -> tuple[Column, Column]:
    """(block ``at``, the other bits) of the low ``bits`` of a value cut in equal blocks."""
    width = bits // blocks
    below = bits - width * (at + 1)
    own = F.shiftrightunsigned(value, below).bitwiseAND(F.lit((1 << width) - 1))
    low = value.bitwiseAND(F.lit((1 << below) - 1))
    if at == 0:
        return own, low
    high = F.shiftrightunsigned(value, below + width).bitwiseAND(F.lit((1 << (width * at)) - 1))
    return own, F.shiftleft(high, below).bitwiseOR(low)


def _cut(rows: DataFrame, bits: int, blocks: int) -> DataFrame:
    """Each row once per block, with the block's value added to its group and the bits left."""
    parts = []
    for at in range(blocks):
        own, rest = _block(F.col("rest"), bits, blocks, at)
        parts.append(F.struct(F.xxhash64("trie", F.lit(at), own).alias("trie"), rest.alias("rest")))
    return rows.select("fp", F.explode(F.array(*parts)).alias("c")).select("fp", "c.trie", "c.rest")


def near_links(distinct: DataFrame, budget: int) -> DataFrame:
    """(a, b): links between distinct fingerprints ``fp``, at least a spanning forest of all links."""
    blocks = budget + 1
    bits = BITS
    spark = distinct.sparkSession
    rows = distinct.select("fp", F.lit(0).cast("long").alias("trie"), F.col("fp").alias("rest"))
    settled: list[DataFrame] = []
    while True:
        rows = _cut(rows, bits, blocks)
        bits -= bits // blocks
        large = rows.groupBy("trie").count().where(F.col("count") > TRIE_FINGERPRINTS).select("trie")
        if bits < 4 * blocks or large.isEmpty():
            break
        rows = written(rows, "tries")
        large = written(rows.groupBy("trie").count().where(F.col("count") > TRIE_FINGERPRINTS).select("trie"), "large")
        settled.append(rows.join(large, "trie", "left_anti").select("trie", "fp"))
        rows = rows.join(large, "trie")
    tries = rows.select("trie", "fp")
    for part in settled:
        tries = tries.unionByName(part)
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    # a signed order would start with the set sign bit
    ordered = tries.repartition(partitions, "trie").withColumn("u", F.col("fp").bitwiseXOR(F.lit(-(1 << 63))))
    ordered = ordered.sortWithinPartitions("trie", "u").select("trie", "fp")

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def joined(groups, values):
            unsigned = values.astype(np.int64).view(np.uint64)
            pairs = np.array(trie_self_join(groups, unsigned, budget), np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays(
                [pa.array(values[pairs[:, 0]], pa.int64()), pa.array(values[pairs[:, 1]], pa.int64())], ["a", "b"]
            )

        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            size += batch.num_rows
            if size < GATHERED:
                continue
            groups, values = (np.concatenate(parts) for parts in zip(*held))
            whole = int(np.searchsorted(groups, groups[-1]))  # the last group may go on
            if whole:
                yield joined(groups[:whole], values[:whole])
            held, size = [(groups[whole:], values[whole:])], len(groups) - whole
        if size:
            yield joined(*(np.concatenate(parts) for parts in zip(*held)))

    return ordered.mapInArrow(run, "a bigint, b bigint")


def component_ids(distinct: DataFrame, max_bits: int) -> DataFrame:
    """(fp, component_id) for distinct ``fp`` with the smallest id that has each, ``first_id``."""
    roots = smallest_reachable(near_links(distinct, max_bits))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(smallest, "root").select("fp", "component_id")


def near_duplicates(
    documents: DataFrame,
    shingle_words: int = 3,
    max_bits: int = 3,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per document: doc_id, ``fingerprint`` (16 hex digits), ``component_id``.

    Documents whose fingerprints differ in at most ``max_bits`` bits are linked; ``component_id``
    is the smallest id reachable over links. Null, empty and blank texts have fingerprint zero and
    link like any other. Repeated rows come out as often as they went in. A null id is returned
    and links, but is never the smallest; a component of null ids only has a null component_id.
    Other columns are not read; an empty table gives an empty table.
    """
    docs = written(fingerprints(documents, shingle_words, id_column, text_column), "fingerprints")
    known = component_ids(docs.groupBy("fp").agg(F.min("doc_id").alias("first_id")), max_bits)
    return docs.join(known, "fp").select(
        F.col("doc_id").alias(id_column),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_first(
    documents: DataFrame, shingle_words: int = 3, max_bits: int = 3, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row of each component, with all its columns: the smallest id's, rows without id coming last.

    Of rows that repeat an id in one component one stays. The rows are written once with their
    fingerprints and numbers; only the numbers that stay are joined back.
    """
    at = documents.columns.index(text_column)

    def marked(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = np.array([fingerprint(t.as_py(), shingle_words) for t in batch.column(at)], np.uint64).view(np.int64)
        return batch.append_column("__fp", pa.array(values, pa.int64()))

    rows = map_batches(documents, marked, "__fp bigint").withColumn("__row", F.monotonically_increasing_id())
    rows = written(rows, "fingerprinted")
    slim = rows.select(F.col(id_column).alias("id"), F.col("__fp").alias("fp"), F.col("__row").alias("row"))
    # per fingerprint its smallest id's row, then per component; a group of copies is aggregated before it moves
    order = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    best = slim.groupBy("fp").agg(F.min(order).alias("best"))
    roots = smallest_reachable(near_links(best, max_bits)).withColumnRenamed("node", "fp")
    rooted = best.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    kept = rooted.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.row").alias("__row"))
    return rows.join(kept, "__row", "left_semi").select(*documents.columns)
