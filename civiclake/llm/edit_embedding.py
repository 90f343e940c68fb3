"""Fingerprints of texts whose likeness follows the edit distance.

A text is embedded by a random walk that all texts share: at each step of time the character the
walk stands on is written out, and a coin that belongs to (time, character) decides whether the walk
goes on to the next character. Texts that differ by an edit part there and, as their coins
agree, meet again a little later, so a small edit distance becomes a small Hamming distance.

The written characters are hashed to bit planes, and a fingerprint keeps a sample of the coordinates
(time, plane): those of least rank, by a hash of the coordinate, below the length of the walk.
Ranks are shared, so two fingerprints of any lengths have a sample of the shorter one's coordinates in common.

Near documents are found by banding: subsets of the sampled bits are keys of buckets, and what meets
in a bucket is verified over all sampled bits.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from bisect import bisect_right
from collections import Counter
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.llm.common import map_rows, table_bytes
from civiclake.llm.components import smallest_reachable
from civiclake.llm.simhash import _Forest
from civiclake.plans.scratch import written

#: Coins repeat after this many steps of time.
PERIOD = 1 << 14
#: Characters with coins of their own, by hash.
CLASSES = 128
#: Bits kept of a text, and bit planes a character is hashed to.
SAMPLE = 256
PLANES = 8
#: Characters walked at a time.
PIECE = 1 << 16
#: The least number of ordered slices; else there are as many as splits of a scan.
SLICES_PER_CORE = 2
#: Ids sampled for a slice, to find its boundary; a tie before all hashes of texts.
SAMPLED = 8
BEFORE = -(1 << 63) - 1
#: Bytes of rows that a task gathers before it sends them to their slices.
CHUNK_BYTES = 8 << 20
#: Banding uses the bits of least rank.
BAND_POOL = 72
#: Fingerprints of one bucket that are compared at a time.
BLOCK = 512

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_SEED = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each number."""
    x = (x + np.uint64(1)) * _SEED
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def coins(walk: int = 0) -> np.ndarray:
    """[class, time]: whether the walk leaves a character of this class at this time; each walk has its own."""
    numbers = np.arange(CLASSES * PERIOD, dtype=np.uint64) + (np.uint64(walk) << np.uint64(40))
    return (_mixed(numbers) >> np.uint64(63) == 1).reshape(CLASSES, PERIOD)


@lru_cache(maxsize=4)
def _leaving_times(walk: int) -> list[list[int]]:
    """[class][time]: the time at which a walk is on the next character."""
    time = np.arange(2 * PERIOD)
    shared = list(range(PERIOD))  # one object a number, for all classes
    tables = []
    for row in coins(walk):
        heads = np.where(np.r_[row, row], time, 2 * PERIOD)
        following = np.minimum.accumulate(heads[::-1])[::-1][:PERIOD] + 1
        if (following - time[:PERIOD]).max() > 255:
            raise AssertionError("a walk rests for too long")
        tables.append([shared[t] for t in (following % PERIOD).tolist()])
    return tables


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def character_class(codes: np.ndarray) -> np.ndarray:
    return ((codes * np.uint32(0x9E3779B1)) >> np.uint32(25)).astype(np.uint8)


def rests(codes: np.ndarray, time: int = 0, walk: int = 0) -> np.ndarray:
    """How many steps the walk stands on each character, if it comes to the first at ``time``."""
    tables = _leaving_times(walk)
    parts = [np.empty(0, np.uint8)]
    for at in range(0, len(codes), PIECE):
        start = time = time % PERIOD
        times = []
        leave = times.append
        for c in character_class(codes[at : at + PIECE]).tobytes():
            time = tables[c][time]
            leave(time)
        parts.append((np.diff(np.array([start, *times], np.int32)) % PERIOD).astype(np.uint8))
    return np.concatenate(parts)


@lru_cache(maxsize=64)
def _candidates(bits: int) -> np.ndarray:
    """Coordinates below 2^bits by rank: all, or the few thousand of least rank."""
    size = 1 << bits
    bound = np.uint64(min(16 * SAMPLE / size, 1 - 2**-53) * 2.0**64)
    found = []
    for at in range(0, size, 1 << 20):
        numbers = np.arange(at, min(at + (1 << 20), size), dtype=np.uint64)
        ranks = _mixed(numbers ^ _SEED)
        found.append(numbers[ranks <= bound] if size > 16 * SAMPLE else numbers)
    numbers = np.concatenate(found)
    return numbers[np.argsort(_mixed(numbers ^ _SEED), kind="stable")].astype(np.int64)


def sampled(steps: int) -> np.ndarray:
    """The coordinates kept of a walk, by rank; a coordinate is time * PLANES + plane."""
    size = steps * PLANES
    if not size:
        return np.empty(0, np.int64)
    candidates = _candidates((size - 1).bit_length())
    return candidates[candidates < size][:SAMPLE]


def _bits(codes: np.ndarray, rest: np.ndarray) -> tuple[int, np.ndarray]:
    """(steps, the sampled bits by rank) of a walk that stands ``rest`` steps on each of ``codes``."""
    pieces = np.add.reduceat(rest, np.arange(0, len(rest), PIECE), dtype=np.int64) if len(rest) else np.empty(0, np.int64)
    ends = np.cumsum(pieces)
    steps = int(ends[-1]) if len(ends) else 0
    coordinates = sampled(steps)
    times = coordinates // PLANES
    piece = np.searchsorted(ends, times, "right")
    here = np.empty(len(times), np.int64)
    for p in np.unique(piece).tolist():
        own = piece == p
        within = np.cumsum(rest[p * PIECE : (p + 1) * PIECE], dtype=np.int64)
        here[own] = p * PIECE + np.searchsorted(within, times[own] - (ends[p] - pieces[p]), "right")
    hashed = _mixed((coordinates.astype(np.uint64) << np.uint64(21)) ^ codes[here].astype(np.uint64))
    return steps, (hashed >> np.uint64(63)).astype(np.uint8)


def _named(steps: int, bits: np.ndarray) -> str:
    return f"{steps:x}-{np.packbits(bits).tobytes().hex()}"


def fingerprint(text: str | None, walk: int = 0) -> str:
    """The steps of the walk over the whole text and its sampled bits, both hexadecimal; null counts as empty."""
    codes = code_points(text or "")
    return _named(*_bits(codes, rests(codes, 0, walk)))


def parsed(name: str) -> tuple[int, np.ndarray]:
    """(steps, sampled bits by rank) of a fingerprint."""
    steps, digits = name.split("-")
    size = min(int(steps, 16) * PLANES, SAMPLE)
    return int(steps, 16), np.unpackbits(np.frombuffer(bytes.fromhex(digits), np.uint8))[:size]


def likeness(a: str, b: str) -> float:
    """The share of equal characters in two embeddings, by the bits both fingerprints hold; 0 to 1.

    Steps that only the longer walk has count as different. Equal bits that come from chance are taken off.
    """
    return 1.0 if a == b else float(_likenesses([a, b])[0, 1])


def _likenesses(names: list[str]) -> np.ndarray:
    """The likeness of all pairs, with one product of matrices over the coordinates that any of them holds."""
    walks = [parsed(n) for n in names]
    held = [sampled(steps) for steps, _ in walks]
    every, at = np.unique(np.concatenate(held), return_inverse=True)
    signs = np.zeros((len(names), len(every)), np.float32)
    rows = np.repeat(np.arange(len(names)), [len(h) for h in held])
    signs[rows, at] = 2.0 * np.concatenate([bits for _, bits in walks]) - 1
    # both hold exactly the coordinates of the longer walk's sample that the shorter walk has
    sizes = np.array([len(h) for h in held])
    steps = np.array([s for s, _ in walks])
    longer = np.where(steps[:, None] >= steps[None, :], sizes[:, None], sizes[None, :])
    return np.where(longer > 0, np.clip((signs @ signs.T) / np.maximum(longer, 1), 0, 1), 1.0)


class _Walked:
    """A text with its walk."""

    def __init__(self, key, text: str | None) -> None:
        self.key, self.text = key, text or ""
        self.codes = code_points(self.text)
        self.rest = rests(self.codes)
        self.name = _named(*_bits(self.codes, self.rest))

    def row(self, following: "_Walked") -> tuple:
        """The finished row of this document, the other one being the next."""
        moved = len(self.codes) // 2
        kept = len(self.codes) - moved
        edited = self.text[:kept] + following.text[:moved]
        # the walk over the edited text is this one up to the edit
        time = int(self.rest[:kept].sum(dtype=np.int64))
        codes = np.concatenate([self.codes[:kept], following.codes[:moved]])
        rest = np.concatenate([self.rest[:kept], rests(following.codes[:moved], time)])
        edited_name = _named(*_bits(codes, rest))
        return (
            self.key,
            len(self.codes),
            hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            self.name,
            edited_name,
            likeness(self.name, edited_name),
            likeness(self.name, following.name),
        )


def fingerprints(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, fingerprint) of every row; equal texts have equal ones, null counts as empty. Nothing is shuffled."""
    id_type = documents.schema[id_column].dataType.simpleString()
    rows = documents.select(id_column, text_column)
    return map_rows(rows, lambda rows: ((k, fingerprint(t)) for k, t in rows), f"`{id_column}` {id_type}, fingerprint string")


Place = tuple[bool, object, int]


def _place(key, tie: int) -> Place:
    """Where a row stands in the order: by id, those without one first, then by the hash of its text."""
    return key is not None, key, tie


def _boundaries(documents: DataFrame, id_column: str, text_column: str, slices: int) -> list[Place]:
    """The least place of all rows, then up to ``slices`` - 1 places that cut the order into slices of about equal size.

    Each is the place of rows that exist, so no slice is empty. Ids are sampled, ``SAMPLED`` for a slice; where
    an id has so many rows that it would fill slices of its own, places of its texts are sampled too.
    """
    ids = documents.select(F.col(id_column).alias("key"))
    rows, named, least = ids.agg(F.count(F.lit(1)), F.count("key"), F.min("key")).first()
    if not rows:
        return []
    first = _place(None if named < rows else least, BEFORE)
    share = min(1.0, SAMPLED * slices / rows)
    keys = sorted((r.key is not None, r.key) for r in ids.sample(share, seed=1).collect())
    hot = {k for k, n in Counter(keys).items() if n >= 2 * SAMPLED}
    places = {(*k, BEFORE) for k in keys[SAMPLED::SAMPLED] if k not in hot}
    if hot:
        wanted = F.col(id_column).isin([k for known, k in hot if known])
        if (False, None) in hot:
            wanted = wanted | F.col(id_column).isNull()
        # the texts of rows with the same id, by the same hash as below
        ties = F.xxhash64(F.coalesce(F.col(text_column), F.lit("")))
        several = documents.where(wanted).select(F.col(id_column).alias("key"), ties.alias("tie"))
        drawn = sorted(_place(r.key, r.tie) for r in several.sample(share, seed=2).collect())
        places.update(drawn[SAMPLED::SAMPLED])
        if first[:2] in hot:
            first = _place(first[1], several.where(F.col("key").eqNullSafe(F.lit(first[1]))).agg(F.min("tie")).first()[0])
    return [first, *sorted(p for p in places if p > first)]


def edited_fingerprints(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: the id, ``n_chars``, ``edited_sha256``, the fingerprints of its text and of its edited text,
    ``near_edited`` and ``near_next``.

    The edited text has its last floor(n / 2) characters replaced by the first as many of the next
    document, by id; after the last comes the first. ``near_next`` is the likeness to that document.
    Rows that repeat an id follow each other by a hash of their text; rows without id come first. Null
    texts count as empty. Other columns are not read; a table of one row has itself as next, an empty
    one gives no rows.

    Texts are shuffled once, compressed, into slices of the order that one task each sorts. A slice also gets
    the row that may be the next one's first. Rows equal in id and text travel once per task with
    their number. The driver holds ``SAMPLED`` ids and one boundary for each slice, of the size of a scan's split.
    """
    spark = documents.sparkSession
    id_type = documents.schema[id_column].dataType.simpleString()
    few = SLICES_PER_CORE * spark.sparkContext.defaultParallelism
    slices = max(few, -(-table_bytes(documents, text_column) // _split_bytes(spark)))
    bounds = _boundaries(documents, id_column, text_column, slices)
    schema = (
        f"`{id_column}` {id_type}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    count = max(len(bounds), 1)

    def packed(rows):
        """Chunks (slice, rows) of (place, number of rows, text, whether it is only the next slice's first)."""
        pack = zstandard.ZstdCompressor(level=1).compress
        seen: Counter[Place] = Counter()
        held: dict[int, list] = {}
        ahead: dict[int, tuple[Place, bytes]] = {}
        size = 0
        for key, text in rows:
            raw = (text or "").encode("utf-8", "surrogatepass")
            place = _place(key, _signed(xxhash.xxh64_intdigest(raw, 42)))
            seen[place] += 1
            if seen[place] > 1:
                continue
            own = bisect_right(bounds, place) - 1
            raw = pack(raw)
            held.setdefault(own, []).append((place, 1, raw, False))
            if place[:2] == bounds[own][:2] and (own not in ahead or place < ahead[own][0]):
                ahead[own] = place, raw
            size += len(raw) + 64
            if size >= CHUNK_BYTES:
                yield from ((s, pickle.dumps(chunk)) for s, chunk in held.items())
                held, size = {}, 0
        for place, n in seen.items():
            if n > 1:
                held.setdefault(bisect_right(bounds, place) - 1, []).append((place, n - 1, None, False))
        for own, (place, raw) in ahead.items():
            held.setdefault((own - 1) % count, []).append((place, 0, raw, True))
        yield from ((s, pickle.dumps(chunk)) for s, chunk in held.items())

    def walked(rows):
        """One slice: its rows in order, each with the one after it."""
        numbers: Counter[Place] = Counter()
        texts: dict[Place, bytes] = {}
        ahead = None
        for _, chunk in rows:
            for place, n, raw, only_next in pickle.loads(chunk):
                if only_next:
                    ahead = min(ahead, (place, raw)) if ahead else (place, raw)
                    continue
                numbers[place] += n
                if raw is not None:
                    texts[place] = raw
        if not texts:
            return
        unpack = zstandard.ZstdDecompressor().decompress
        order = sorted(texts)
        turns = chain(((p, texts[p]) for p in order[1:]), [ahead])
        last = _Walked(order[0][1], unpack(texts[order[0]]).decode("utf-8", "surrogatepass"))
        for place, following in zip(order, turns):
            upcoming = _Walked(following[0][1], unpack(following[1]).decode("utf-8", "surrogatepass"))
            if numbers[place] > 1:  # such rows follow each other
                yield from repeat(last.row(last), numbers[place] - 1)
            yield last.row(upcoming)
            last = upcoming

    chunks = map_rows(documents.select(id_column, text_column), packed, "slice int, chunk binary")
    return map_rows(chunks.repartitionById(count, "slice"), walked, schema)


def _split_bytes(spark: SparkSession) -> int:
    size, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", spark.conf.get("spark.sql.files.maxPartitionBytes").strip().lower()).groups()
    return int(size) << 10 * " kmgt".index(unit or " ")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


@lru_cache(maxsize=256)
def _band_pool(bits: int) -> np.ndarray:
    """The coordinates below 2^bits of which bands are made."""
    candidates = _candidates(bits)
    return candidates[:BAND_POOL]


def band_keys(name: str, bands: int, band_bits: int, least: float) -> list[int]:
    """Keys of the buckets of a fingerprint.

    Bands are subsets of the sampled bits below the greatest power of two the walk reaches; a walk
    only a little longer than that also has keys of the next lesser one, where shorter walks like it are.
    """
    steps, bits = parsed(name)
    size = steps * PLANES
    if not size:
        return [xxhash.xxh64_intdigest(b"empty") - (1 << 63)]
    top = size.bit_length() - 1
    held = dict(zip(sampled(steps).tolist(), bits.tolist()))
    keys = []
    for base in (top, top - 1) if top and size <= (1 << top) / least else (top,):
        pool = _band_pool(base)
        for band in range(bands):
            picks = _mixed(np.arange(len(pool), dtype=np.uint64) + np.uint64(1000 * band + 1)).argsort()[:band_bits]
            values = [held.get(z) for z in pool[picks].tolist()]
            if None not in values:
                keys.append(xxhash.xxh64_intdigest(bytes([base, band % 256, band // 256, *values])) - (1 << 63))
    return keys


def similar_documents(
    documents: DataFrame,
    least: float = 0.8,
    walks: int = 3,
    bands: int = 32,
    band_bits: int = 20,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per row: the id, its ``fingerprint`` and ``class_id``, the smallest id reachable over links.

    Two texts are linked if in one of several independent walks the likeness of their fingerprints is
    ``least`` or more and a bucket holds both. An edit parts two walks for a time with a heavy tail, so one
    walk alone misses some near texts. A pair of likeness s meets in a walk with probability
    1 - (1 - ((1 + s) / 2) ** band_bits) ** bands. Texts with equal fingerprints are one before they are banded, so copies cost nothing. A bucket of more than
    ``BLOCK`` fingerprints is compared block by block, each pair of blocks a group of its own, and only
    a spanning forest of its links leaves a group. Null and empty texts are one class; rows without id
    come out and link, but give no class its id; repeated rows come out as often as they went in.
    """

    def embedded(rows):
        for key, text in rows:
            yield key, [fingerprint(text, w) for w in range(walks)]

    id_type = documents.schema[id_column].dataType.simpleString()
    rows = documents.select(id_column, text_column)
    docs = written(map_rows(rows, embedded, f"`{id_column}` {id_type}, names array<string>"), "fingerprints")
    distinct = docs.groupBy("names").agg(F.min(id_column).alias("first_id"))
    distinct = written(distinct.withColumn("node", F.monotonically_increasing_id()), "distinct")

    def banded(rows):
        for node, names in rows:
            for walk, name in enumerate(names):
                for key in sorted(set(band_keys(name, bands, band_bits, least))):
                    yield key ^ walk, node, name

    keyed = map_rows(distinct.select("node", "names"), banded, "bucket bigint, node bigint, fingerprint string")
    keyed = written(keyed, "bands")
    sizes = keyed.groupBy("bucket").count().where("count > 1")
    sizes = sizes.select("bucket", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    placed = keyed.join(sizes, "bucket").withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = placed.withColumn("other", other).select(
        "bucket", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "node", "fingerprint"
    )

    def linked(group):
        import pyarrow as pa

        nodes, names = group.column("node").to_pylist(), group.column("fingerprint").to_pylist()
        forest = _Forest(len(nodes))
        pairs = np.argwhere(np.triu(_likenesses(names) >= least, 1)).tolist()
        kept = [(nodes[i], nodes[j]) for i, j in pairs if forest.join(i, j)]
        return pa.table({"a": pa.array([p[0] for p in kept], pa.int64()), "b": pa.array([p[1] for p in kept], pa.int64())})

    links = met.groupBy("bucket", "a", "b").applyInArrow(linked, "a bigint, b bigint")
    roots = smallest_reachable(links)
    rooted = distinct.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least_ids = rooted.groupBy("root").agg(F.min("first_id").alias("class_id"))
    known = rooted.join(least_ids, "root").select("names", "class_id")
    return docs.join(known, "names").select(id_column, F.col("names")[0].alias("fingerprint"), "class_id")
