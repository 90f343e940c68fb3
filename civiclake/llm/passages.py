"""Passages that repeat across documents: routing windows to where their equals meet.

A window is a fixed number of consecutive units (bytes or words) of one document. Its key is the
smallest hash of the short grams inside it, so equal windows have equal keys, and neighbouring
windows mostly share one: a run of windows of one key is a passage.

1. Documents are packed in chunks of a few megabytes and written once, to a bucketed table in the shared folder.
   The chunks stay there: what is joined to them is sent to their buckets.
2. Each chunk sends its distinct keys, 7 bytes each, to the bucket of the key; the bucket answers
   which keys other documents have too.
3. Only passages of such keys travel, equal ones of a chunk as one with the smallest document id.
   A kernel (a suffix array, a suffix automaton) says for each window of each distinct passage
   whether a document with a smaller id has it.
4. The answers go back to the chunks, where covered units are removed.

A passage that a third of all documents hold reaches its bucket once per chunk, where it is one. Where a key
has very many different passages, like that of a common phrase in changing surroundings, the hashes of its whole
windows go through step 2 as well: only windows that other documents may have travel, each to the bucket of its
own hash, where only equal ones meet. A byte that stands for the passages of a key tells the two apart.
Chunks, buckets and answers are rows of shuffles; nothing passes through the driver.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiclake.plans.scratch import written, written_buckets

#: Text bytes of a chunk, and for each bucket of keys.
CHUNK_BYTES = 3 << 20
BUCKET_BYTES = 7 << 19

#: Files that a task writes its chunks to, so that several tasks can go on with them.
FILES_PER_TASK = 4

#: Marks, of 256, that passages of a key may have before its windows go by the hash of all their units. Some
#: hundred different passages, which have that many marks, are no burden for a task.
HOT_MARKS = 224

_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


@dataclass(frozen=True)
class Kind:
    """What a unit is: ``units(texts)`` gives (values, document offsets); grams have ``gram`` units."""

    window: int
    gram: int
    units: Callable
    gram_hashes: Callable


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer, so that the smallest hash is any gram's."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(_MIX[1])
    return values ^ (values >> np.uint64(29))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets) of a string column; null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    values = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    return values, offsets - offsets[0]


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values, by doubling."""
    least, reach = values, 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    return np.minimum(least[: len(least) - (width - reach)], least[width - reach :]) if width > reach else least


@dataclass
class Chunk:
    """A chunk's documents with the runs of windows of one key."""

    rows: pa.Table
    texts: tuple[np.ndarray, np.ndarray]
    values: np.ndarray
    offsets: np.ndarray
    ids: np.ndarray
    first: np.ndarray
    count: np.ndarray
    key: np.ndarray
    owner: np.ndarray
    hashes: np.ndarray


def open_chunk(payload: bytes, kind: Kind) -> Chunk:
    rows = pa.ipc.open_stream(payload).read_all().combine_chunks()
    id_column = rows.column("__id").combine_chunks() if rows.num_rows else pa.array([], pa.int64())
    known = ~np.asarray(id_column.is_null())
    ids = np.asarray(pc.fill_null(id_column, 0)).astype(np.int64)
    texts = text_buffers(rows.column("__text").combine_chunks())
    values, offsets = kind.units(texts)
    n = len(values) - kind.window + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return Chunk(rows, texts, values, offsets, ids, none, none, none.astype(np.uint64), none, none.astype(np.uint64))
    lengths = np.diff(offsets)
    last_start = np.repeat(np.where(known, offsets[1:] - kind.window, -1), lengths)[:n]
    valid = np.arange(n) <= last_start
    hashes = kind.gram_hashes(values)
    least = sliding_least(hashes, kind.window - kind.gram + 1) >> np.uint64(16)
    new = np.r_[True, (least[1:] != least[:-1]) | (valid[1:] != valid[:-1])]
    first = np.flatnonzero(new)
    count = np.diff(np.r_[first, n])
    inside = valid[first]
    first, count, _ = short_runs(first[inside], count[inside], kind.window - kind.gram + 1)
    owner = np.searchsorted(offsets, first, "right") - 1
    return Chunk(rows, texts, values, offsets, ids, first, count, least[first], owner, hashes)


def window_keys(chunk: Chunk, kind: Kind, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, id, key) of the windows inside the passages marked in ``cut``; the key hashes all units of a window."""
    starts = runs(chunk.first[cut], chunk.count[cut])
    key = np.zeros(len(starts), np.uint64)
    for at in [*range(0, kind.window - kind.gram, kind.gram), kind.window - kind.gram]:
        key = mixed(key * np.uint64(_MIX[0]) + chunk.hashes[starts + at])
    return starts, np.repeat(chunk.ids[chunk.owner[cut]], chunk.count[cut]), key >> np.uint64(16)


def short_runs(first: np.ndarray, count: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, count, run it came from): runs cut into pieces of at most ``most`` windows.

    A gram is the least of more windows than that only where it repeats, as in one word over and
    over; the pieces of such a run are equal up to its period, and equal passages are one.
    """
    pieces = -(-count // most)
    run = np.repeat(np.arange(len(first)), pieces)
    at = runs(np.zeros(len(first), np.int64), pieces) * most
    return first[run] + at, np.minimum(count[run] - at, most), run


def runs(begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... for each pair of a begin and a count."""
    return np.arange(int(counts.sum())) + np.repeat(begins - (np.cumsum(counts) - counts), counts)


def _pack(blob) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(blob, protocol=5))


def _unpack(payload: bytes):
    return pickle.loads(zstandard.ZstdDecompressor().decompress(payload))


def _place(chunk: Column | str) -> Column:
    """The file number that a chunk is stored under, by its number."""
    at = F.col(chunk) if isinstance(chunk, str) else chunk
    return F.shiftright(at, 32) * FILES_PER_TASK + at % FILES_PER_TASK


def _sent_to_chunks(df: DataFrame, buckets: int) -> DataFrame:
    """Rows by ``chunk``, sent to where the chunks are stored."""
    named = df.withColumnRenamed("chunk", "__chunk")
    return named.withColumn("__place", _place("__chunk")).repartition(buckets, "__place").hint("shuffle_hash")


def _with(chunks: DataFrame, df: DataFrame, buckets: int, how: str) -> DataFrame:
    """Chunks joined with rows by ``chunk``; the payloads are neither shuffled nor sorted.

    The table's buckets are those of the place, so the chunk itself is no join key.
    """
    sent = _sent_to_chunks(df, buckets)
    same = (F.col("place") == F.col("__place")) & (F.col("chunk").bitwiseXOR(F.col("__chunk")) == 0)
    return chunks.join(sent, same, how).drop("__chunk", "__place")


def chunked(documents: DataFrame, id_column: str, text_column: str, carried: list[str], buckets: int) -> DataFrame:
    """(chunk, size, payload, place): whole rows of documents as compressed Arrow streams, written once."""
    narrow = documents.select(
        F.col(id_column).cast("bigint").alias("__id"), F.col(text_column).alias("__text"), *carried
    )

    chunk_bytes = CHUNK_BYTES

    def run(batches):
        from pyspark import TaskContext

        base, number = TaskContext.get().partitionId() << 32, 0
        held, size = [], 0

        def packed():
            sink = pa.BufferOutputStream()
            options = pa.ipc.IpcWriteOptions(compression="zstd")
            with pa.ipc.new_stream(sink, held[0].schema, options=options) as stream:
                for part in held:
                    stream.write_batch(part)
            return pa.RecordBatch.from_pydict(
                {
                    "chunk": pa.array([base + number], pa.int64()),
                    "size": pa.array([size], pa.int64()),
                    "payload": pa.array([sink.getvalue().to_pybytes()]),
                }
            )

        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            totals = np.cumsum(lengths + 64, dtype=np.int64)  # many empty texts fill a chunk too
            at = 0
            while at < batch.num_rows:
                before = int(totals[at - 1]) if at else 0
                past = max(int(np.searchsorted(totals, before + chunk_bytes - size, "right")), at + (not held))
                if past > at:
                    held.append(batch.slice(at, past - at))
                    size += int(totals[past - 1]) - before
                    at = past
                if at < batch.num_rows or size >= chunk_bytes:
                    yield packed()
                    held, size, number = [], 0, number + 1
        if held:
            yield packed()

    packed_rows = narrow.mapInArrow(run, "chunk bigint, size bigint, payload binary")
    return written_buckets(packed_rows.withColumn("place", _place("chunk")), "chunks", "place", buckets)


def _key_rows(key: np.ndarray, ids: np.ndarray, buckets: int, marks: np.ndarray | None = None):
    """For each bucket, its distinct keys in order, whether several documents of the chunk have them, and the
    least mark of their passages."""
    if not len(key):
        return
    order = np.lexsort((ids, key))
    key, ids = key[order], ids[order]
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    end = np.r_[start[1:], len(key)] - 1
    distinct, several = key[start], ids[start] != ids[end]
    least = np.zeros(len(start), np.uint8) if marks is None else (np.minimum.reduceat(marks[order], start) >> np.uint64(7)).astype(np.uint8)
    bucket = (distinct % np.uint64(buckets)).astype(np.int64)
    by_bucket = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.r_[True, np.diff(bucket[by_bucket]) != 0, True])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        own = by_bucket[a:b]
        yield int(bucket[own[0]]), distinct[own], several[own], least[own]


def _sent_keys(chunks: DataFrame, kind: Kind, buckets: int) -> DataFrame:
    """(bucket, chunk, keys, several): keys of passages or, where ``chunks`` has replies, of the windows of hot ones."""
    schema = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary()), ("several", pa.binary())])

    def run(batches):
        for batch in batches:
            replies = batch.column(2).to_pylist() if batch.num_columns > 2 else repeat(None)
            for name, payload, told in zip(batch.column(0).to_pylist(), batch.column(1), replies):
                chunk = open_chunk(payload.as_py(), kind)
                key, ids, marks = chunk.key, chunk.ids[chunk.owner], None
                if told is None:
                    marks = passage_marks(chunk, kind, chunk.first, chunk.count)
                else:
                    (hot,) = _marked(key, ids, buckets, told, "hot")
                    _, ids, key = window_keys(chunk, kind, hot)
                rows = []
                for bucket, keys, several, least in _key_rows(key, ids, buckets, marks):
                    wide = keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7].copy()
                    wide[:, 6] = least
                    rows.append((bucket, name, wide.tobytes(), np.packbits(several).tobytes()))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return chunks.mapInArrow(run, "bucket bigint, chunk bigint, keys binary, several binary")


def _shared_keys(sent: DataFrame) -> DataFrame:
    """(chunk, bucket, shared, hot): bit per sent key, for the rows with a shared one."""
    hot_marks = HOT_MARKS

    def run(group: pa.Table) -> pa.Table:
        parts, flags, sizes, seen = [], [], [], []
        for keys, several in zip(group.column("keys"), group.column("several")):
            raw = np.frombuffer(keys.as_buffer(), np.uint8).reshape(-1, 7)
            wide = np.zeros((len(raw), 8), np.uint8)
            wide[:, :6] = raw[:, :6]
            seen.append(raw[:, 6])
            parts.append(wide.reshape(-1).view("<u8"))
            flags.append(np.unpackbits(np.frombuffer(several.as_buffer(), np.uint8), count=len(raw)))
            sizes.append(len(raw))
        keys, several, marks = np.concatenate(parts), np.concatenate(flags), np.concatenate(seen)
        order = np.argsort(keys << np.uint64(8) | marks)
        start = np.flatnonzero(np.r_[True, keys[order][1:] != keys[order][:-1]])
        holders = np.diff(np.r_[start, len(keys)])
        shared = (holders > 1) | (np.maximum.reduceat(several[order], start) > 0)
        run_of = np.repeat(np.arange(len(start)), holders)
        bits, hot = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
        bits[order] = shared[run_of]
        ordered = keys[order] << np.uint64(8) | marks[order]
        different = np.add.reduceat(np.r_[True, ordered[1:] != ordered[:-1]].astype(np.int64), start)
        hot[order] = (different > hot_marks)[run_of]
        out, at = {"chunk": [], "bucket": [], "shared": [], "hot": []}, 0
        for chunk, bucket, size in zip(group.column("chunk").to_pylist(), group.column("bucket").to_pylist(), sizes):
            own = slice(at, at + size)
            at += size
            if bits[own].any():
                out["chunk"].append(chunk)
                out["bucket"].append(bucket)
                out["shared"].append(np.packbits(bits[own]).tobytes())
                out["hot"].append(np.packbits(hot[own]).tobytes() if hot[own].any() else b"")
        types = {"chunk": pa.int64(), "bucket": pa.int64(), "shared": pa.binary(), "hot": pa.binary()}
        return pa.table({name: pa.array(values, types[name]) for name, values in out.items()})

    return sent.groupBy("bucket").applyInArrow(run, "chunk bigint, bucket bigint, shared binary, hot binary")


@dataclass
class Passages:
    """A chunk's passages with shared keys: members, and the distinct ones among them as entries by bucket."""

    first: np.ndarray
    windows: np.ndarray
    ids: np.ndarray
    entry: np.ndarray
    entry_first: np.ndarray
    entry_windows: np.ndarray
    entry_least: np.ndarray
    buckets: np.ndarray
    cuts: np.ndarray


def _marked(key: np.ndarray, ids: np.ndarray, buckets: int, replies: list[dict], *names: str) -> list[np.ndarray]:
    """For each of the names, which keys the replies mark so."""
    told = {r["bucket"]: r for r in replies}
    marked = {name: [] for name in names}
    for bucket, keys, *_ in _key_rows(key, ids, buckets) if told else ():
        for name in names if bucket in told else ():
            if told[bucket][name]:
                bits = np.unpackbits(np.frombuffer(told[bucket][name], np.uint8), count=len(keys))
                marked[name].append(keys[bits.astype(bool)])
    return [np.isin(key, np.concatenate(parts)) if parts else np.zeros(len(key), bool) for parts in marked.values()]


def _candidates(chunk: Chunk, kind: Kind, buckets: int, replies: list[dict], shared_windows: list[dict]) -> Passages | None:
    """The passages whose keys the replies call shared; a later pass over the same chunk finds the same."""
    chosen, hot = _marked(chunk.key, chunk.ids[chunk.owner], buckets, replies, "shared", "hot")
    whole = chosen & ~hot
    first, windows, ids, key = chunk.first[whole], chunk.count[whole], chunk.ids[chunk.owner[whole]], chunk.key[whole]
    if hot.any():
        starts, owners, keys = window_keys(chunk, kind, hot)
        (held,) = _marked(keys, owners, buckets, shared_windows, "shared")
        more = (starts[held], np.ones(int(held.sum()), np.int64), owners[held], keys[held])
        first, windows, ids, key = (np.concatenate(both) for both in zip((first, windows, ids, key), more))
    if not len(first):
        return None
    bucket = (key % np.uint64(buckets)).astype(np.int64)
    copy_of = _first_copies(chunk, kind, first, windows)
    own = np.flatnonzero(copy_of == np.arange(len(first)))
    own = own[np.argsort(bucket[own], kind="stable")]
    number = np.empty(len(first), np.int64)
    number[own] = np.arange(len(own))
    entry = number[copy_of]
    least = np.full(len(own), np.iinfo(np.int64).max)
    np.minimum.at(least, entry, ids)
    cuts = np.flatnonzero(np.r_[True, np.diff(bucket[own]) != 0, True])
    return Passages(first, windows, ids, entry, first[own], windows[own], least, bucket[own][cuts[:-1]], cuts)


def _first_copies(chunk: Chunk, kind: Kind, first: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For each passage the first one of the chunk with the same units; found by hash, then compared."""
    mark = passage_marks(chunk, kind, first, windows)
    order = np.argsort(mark, kind="stable")
    start = np.flatnonzero(np.r_[True, mark[order][1:] != mark[order][:-1]])
    copy_of = np.empty(len(first), np.int64)
    copy_of[order] = np.repeat(order[start], np.diff(np.r_[start, len(order)]))
    later = np.flatnonzero(copy_of != np.arange(len(first)))
    sizes = windows[later] + kind.window - 1
    at = 0
    while at < len(later):
        past = max(at + 1, int(np.searchsorted(np.cumsum(sizes[at:]), 1 << 20, "right")) + at)
        part, size = later[at:past], sizes[at:past]
        same = windows[part] == windows[copy_of[part]]
        part, size = part[same], size[same]
        if len(part):
            ours, theirs = (chunk.values[runs(first[n], size)] for n in (part, copy_of[part]))
            same[same] = np.logical_and.reduceat(ours == theirs, np.cumsum(size) - size)
        different = later[at:past][~same]
        copy_of[different] = different
        at = past
    return copy_of


def passage_marks(chunk: Chunk, kind: Kind, first: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the units of each passage."""
    grams = windows + kind.window - kind.gram
    sums = np.r_[np.uint64(0), np.cumsum(chunk.hashes)]
    placed = np.r_[np.uint64(0), np.cumsum(chunk.hashes * np.arange(len(chunk.hashes), dtype=np.uint64))]
    plain = sums[first + grams] - sums[first]
    ordered = placed[first + grams] - placed[first] - first.astype(np.uint64) * plain
    return mixed(mixed(plain) + ordered) + grams.astype(np.uint64)


def _sent_passages(told: DataFrame, kind: Kind, buckets: int) -> DataFrame:
    schema = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("passages", pa.binary())])

    def run(batches):
        for batch in batches:
            for name, payload, *told in zip(batch.column(0).to_pylist(), *batch.columns[1:]):
                chunk = open_chunk(payload.as_py(), kind)
                found = _candidates(chunk, kind, buckets, *(t.as_py() or [] for t in told))
                rows = []
                for bucket, a, b in zip(found.buckets, found.cuts, found.cuts[1:]) if found else ():
                    counts = found.entry_windows[a:b]
                    units = chunk.values[runs(found.entry_first[a:b], counts + kind.window - 1)]
                    rows.append((int(bucket), name, _pack((units.tobytes(), counts, found.entry_least[a:b]))))
                for at in range(0, len(rows), 64):
                    columns = zip(*rows[at : at + 64])
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return told.mapInArrow(run, "bucket bigint, chunk bigint, passages binary")


def _passage_keys(text: np.ndarray, begins: np.ndarray, sizes: np.ndarray, kind: Kind) -> np.ndarray:
    """The least gram hash of each passage of ``text``, which is the key of all its windows."""
    hashes = np.r_[kind.gram_hashes(text), np.uint64(0)]
    ends = begins + sizes - kind.gram + 1
    return np.minimum.reduceat(hashes, np.stack([begins, ends], 1).reshape(-1))[::2]


def _answers(passages: DataFrame, kind: Kind, unit_type: str, kernel) -> DataFrame:
    """(chunk, bucket, earlier): for each sent passage, a bit per window that an earlier document has.

    Equal passages are one, of the smallest id. The kernel gets those that share their key with
    another one; the windows of a passage that is alone in its key are in no other.
    """
    unit = np.dtype(unit_type).itemsize

    def run(group: pa.Table) -> pa.Table:
        distinct: dict[bytes, int] = {}
        least: list[int] = []
        sent = []
        for payload in group.column("passages"):
            blob, counts, ids = _unpack(payload.as_py())
            entries, at = [], 0
            for windows, key in zip(counts.tolist(), ids.tolist()):
                past = at + (windows + kind.window - 1) * unit
                entry = distinct.setdefault(blob[at:past], len(least))
                at = past
                if entry == len(least):
                    least.append(key)
                elif key < least[entry]:
                    least[entry] = key
                entries.append(entry)
            sent.append((np.array(entries, np.int64), ids, counts))
        smallest = np.array(least, np.int64)
        sizes = np.fromiter(map(len, distinct), np.int64, len(distinct)) // unit
        text = np.frombuffer(b"".join(distinct), unit_type)
        begins = np.cumsum(sizes) - sizes
        windows = sizes - kind.window + 1
        window_begins = np.cumsum(windows) - windows
        _, key_of, holders = np.unique(_passage_keys(text, begins, sizes, kind), return_inverse=True, return_counts=True)
        several = np.flatnonzero(holders[key_of] > 1)
        earlier = np.zeros(int(windows.sum()), bool)
        if several.size:
            found = kernel([text[b : b + n] for b, n in zip(begins[several], sizes[several])], smallest[several], kind.window)
            earlier[runs(window_begins[several], windows[several])] = found
        out = []
        for entries, ids, counts in sent:
            copies = np.repeat(ids != smallest[entries], counts)  # a copy is earlier as a whole
            out.append(np.packbits(earlier[runs(window_begins[entries], counts)] | copies).tobytes())
        return pa.table({"chunk": group.column("chunk"), "bucket": group.column("bucket"), "earlier": pa.array(out, pa.binary())})

    return passages.groupBy("bucket").applyInArrow(run, "chunk bigint, bucket bigint, earlier binary")


def covered_units(chunk: Chunk, kind: Kind, buckets: int, replies: list[dict], shared_windows: list[dict], answers: list[dict]) -> np.ndarray:
    """Which of the chunk's units a window covers that an earlier document has."""
    steps = np.zeros(len(chunk.values) + 1, np.int64)
    found = _candidates(chunk, kind, buckets, replies, shared_windows)
    if found is None:
        return steps[:-1] > 0
    told = {a["bucket"]: a["earlier"] for a in answers}
    sums = np.r_[0, np.cumsum(found.entry_windows)]
    bits = np.concatenate(
        [
            np.unpackbits(np.frombuffer(told[bucket], np.uint8), count=int(sums[b] - sums[a])).astype(bool)
            for bucket, a, b in zip(found.buckets.tolist(), found.cuts, found.cuts[1:])
        ]
    )
    later = found.ids > found.entry_least[found.entry]  # the chunk itself has an earlier copy
    np.add.at(steps, found.first[later], 1)
    np.add.at(steps, found.first[later] + found.windows[later] + kind.window - 1, -1)
    first, windows, entry = found.first[~later], found.windows[~later], found.entry[~later]
    starts = runs(first, windows)[bits[runs(sums[entry], windows)]]
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + kind.window, -1)
    return np.cumsum(steps[:-1]) > 0


def without_repeats(
    documents: DataFrame,
    kind: Kind,
    unit_type: str,
    kernel,
    finish,
    result: str,
    id_column: str,
    text_column: str,
    carried: list[str],
) -> DataFrame:
    """The carried columns of every document and what ``finish(chunk, covered)`` makes of it.

    ``kernel(passages, ids, window)`` gets distinct passages and the smallest id that has each, and
    says for all their windows, one after another, whether a passage of a smaller id has them.
    """
    stored = max(1, int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    chunks = chunked(documents, id_column, text_column, carried, stored)
    buckets = max(1, (chunks.agg(F.sum("size")).first()[0] or 0) // BUCKET_BYTES)
    replies = _shared_keys(_sent_keys(chunks.select("chunk", "payload"), kind, buckets))
    replies = replies.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "shared", "hot")).alias("replies"))
    told = written(replies, "shared-keys")
    has_hot = told.where(F.exists("replies", lambda r: F.octet_length(r.hot) > 0))
    if has_hot.isEmpty():
        told = told.withColumn("windows", F.array().cast(told.schema["replies"].dataType))
    else:
        asked = _with(chunks, has_hot, stored, "inner").select("chunk", "payload", "replies")
        held = _shared_keys(_sent_keys(asked, kind, buckets))
        held = held.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "shared", "hot")).alias("windows"))
        told = written(told.join(held, "chunk", "left"), "shared-windows")
    ready = _with(chunks, told, stored, "inner").select("chunk", "payload", "replies", "windows")
    answers = _answers(_sent_passages(ready, kind, buckets), kind, unit_type, kernel)
    answers = answers.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "earlier")).alias("answers"))
    complete = _with(_with(chunks, told, stored, "left"), answers, stored, "left")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*carried).schema.fields]

    def run(batches):
        for batch in batches:
            columns = [batch.column(name) for name in ("payload", "replies", "windows", "answers")]
            for payload, *told in zip(*columns):
                chunk = open_chunk(payload.as_py(), kind)
                covered = covered_units(chunk, kind, buckets, *(t.as_py() or [] for t in told))
                more = finish(chunk, covered)
                kept = chunk.rows.select(carried)
                yield from pa.table([*kept.columns, *more.values()], [*kept.column_names, *more]).to_batches(4096)

    return complete.select("payload", "replies", "windows", "answers").mapInArrow(run, ", ".join([*fields, result]))
