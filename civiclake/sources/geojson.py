"""Features of GeoJSON collections of any spelling, with one large file read by many tasks.

A byte range of a file does not tell whether it begins inside a string or how deep it is nested. So each
range is first summed up for both cases: whether it ends inside a string, and how much deeper or less
deep it gets. Put together in the order of the file, one row a range, this gives the state at the beginning of
every range. Ranges that come up to the members of the collection itself are searched for its
``features``. Then each range is read again and gives the features that open in it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

BLOCK = 4 << 20
LIST, OBJECT, CLOSED, QUOTE, BACKSLASH = b'[{}"\\'
CLOSED_LIST = ord("]")
FEATURES = re.compile(rb'"features"\s*:\s*$')
SPLIT = "file int, path string, start bigint, end bigint"


@dataclass
class Place:
    """Where a scan stands: nesting, whether in a string, whether after an odd number of backslashes."""

    depth: int = 0
    inside: bool = False
    odd: bool = False


def open_file(path: str):
    """A file by the path that Spark lists; reads of ranges need no more than that."""
    local = re.fullmatch(r"file:(?://)?(/.*)", path)
    if local:
        return fs.LocalFileSystem().open_input_file(local[1])
    system, inner = fs.FileSystem.from_uri(quote(path, safe=":/@"))
    return system.open_input_file(inner)


def _blocks(file, start: int, end: int) -> Iterator[tuple[int, np.ndarray]]:
    for at in range(start, end, BLOCK):
        yield at, np.frombuffer(file.read_at(min(BLOCK, end - at), at), np.uint8)


def _brackets(raw: np.ndarray, place: Place) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions of brackets, +1 or -1, whether in a string); moves ``place`` on, but for its depth."""
    at = np.arange(len(raw))
    back = raw == BACKSLASH
    quotes = raw == QUOTE
    if place.odd or back.any():
        # the length of the run of backslashes up to each byte
        plain = np.maximum.accumulate(np.where(back, -2 if place.odd else -1, at))
        run = at - plain
        escaped = np.r_[place.odd, run[:-1] % 2 == 1] if len(raw) else run > 0
        quotes &= ~escaped
        place.odd = bool(run[-1] % 2) if len(raw) else place.odd
    seen = np.cumsum(quotes)
    steps = np.zeros(256, np.int8)
    steps[[LIST, OBJECT]], steps[[CLOSED_LIST, CLOSED]] = 1, -1
    step = steps[raw]
    where = np.flatnonzero(step)
    within = (seen[where] + place.inside) % 2 == 1
    place.inside = bool((seen[-1] + place.inside) % 2) if len(raw) else place.inside
    return where, step[where].astype(np.int64), within


def _odd_before(file, start: int) -> bool:
    """Whether an odd number of backslashes ends at ``start``."""
    run = 0
    while run < start and file.read_at(1, start - run - 1) == b"\\":
        run += 1
    return run % 2 == 1


def summed_up(path: str, start: int, end: int) -> tuple[bool, list[int], list[int]]:
    """(whether a string opens or closes over the range, changes of depth, least changes on the way);
    the latter two if the range begins outside a string, and if inside."""
    with open_file(path) as file:
        place = Place(odd=_odd_before(file, start))
        depth, least = [0, 0], [0, 0]
        for _, raw in _blocks(file, start, end):
            _, step, within = _brackets(raw, place)
            for case in (0, 1):
                path_down = depth[case] + np.cumsum(step[within == bool(case)])
                if len(path_down):
                    depth[case] = int(path_down[-1])
                    least[case] = min(least[case], int(path_down.min()))
    return place.inside, depth, least


def members(path: str, start: int, end: int, depth: int, inside: bool) -> tuple[list[int], list[int], int]:
    """(where ``features`` lists open, the least depth after each, how many documents open) in a range."""
    lists, least, documents = [], [], 0
    with open_file(path) as file:
        place = Place(depth, inside, _odd_before(file, start))
        for at, raw in _blocks(file, start, end):
            where, step, within = _brackets(raw, place)
            where, step = where[~within], step[~within]
            after = place.depth + np.cumsum(step)
            documents += int(((after == 1) & (step == 1)).sum())
            for i in np.flatnonzero((after == 2) & (step == 1) & (raw[where] == LIST)).tolist():
                if _is_features(file, at + int(where[i])):
                    lists.append(at + int(where[i]))
                    least.append(2)
                    ends = after[i:].min()
                    least[-1] = min(least[-1], int(ends))
            if lists and len(after) and lists[-1] < at:
                least[-1] = min(least[-1], int(after.min()))
            place.depth = int(after[-1]) if len(after) else place.depth
    return lists, least, documents


def _is_features(file, at: int) -> bool:
    """Whether the list that opens there is the member ``features``."""
    size = 64
    while True:
        before = file.read_at(min(size, at), max(at - size, 0))
        if FEATURES.search(before):
            return True
        # only blanks and a colon so far: look further back
        if before.strip(b" \t\r\n:") or size >= at:
            return False
        size *= 2


def read_range(path: str, start: int, end: int, length: int, place: Place, opens: int) -> Iterator[bytes]:
    """The features that open in a range, where ``opens`` is the place of the list they stand in."""
    with open_file(path) as file:
        place.odd = _odd_before(file, start)
        held: list[bytes] = []  # of a feature that goes on
        for at, raw in _blocks(file, start, length):
            where, step, within = _brackets(raw, place)
            where, step = where[~within], step[~within]
            after = place.depth + np.cumsum(step)
            place.depth = int(after[-1]) if len(after) else place.depth
            listed = where + at > opens
            first = (after == 3) & (step == 1) & (raw[where] == OBJECT) & listed & (where + at < end)
            last = (after == 2) & (step == -1) & (raw[where] == CLOSED) & listed
            over = np.flatnonzero((after == 1) & listed)
            limit = int(over[0]) if len(over) else len(where)
            marks = np.flatnonzero((first | last)[:limit]).tolist()
            begun = 0
            for i in marks:
                if first[i]:
                    held, begun = [b""], int(where[i])
                elif held:
                    yield b"".join(held) + raw[begun : int(where[i]) + 1].tobytes()
                    held = []
            if held:
                held.append(raw[begun:].tobytes())
            if len(over) or (not held and at + len(raw) >= end):
                return


def feature_texts(spark: SparkSession, files: list[tuple[str, int]], split_bytes: int) -> DataFrame:
    """(value): the text of every feature of these (path, length) collections.

    Each file is one JSON object; its member ``features`` may stand anywhere in it and be written in any
    way. The files are looked through when this is called; the driver holds one row for each range.
    """
    ranges = [
        (f, path, at, min(at + split_bytes, length)) for f, (path, length) in enumerate(files) for at in range(0, length, split_bytes)
    ]
    if not ranges:
        return spark.createDataFrame([], "value string")
    schema = "at int, toggles boolean, depth array<bigint>, least array<bigint>"
    sums = _for_each(spark, [(i, *r) for i, r in enumerate(ranges)], "at int, " + SPLIT, schema, _sums).collect()
    places, beginnings = [], {}
    place, file = Place(), None
    for at, row in enumerate(sorted(sums, key=lambda r: r["at"])):
        f, path, start, end = ranges[at]
        if f != file:
            _closed(files, file, place)
            place, file = Place(), f
        case = int(place.inside)
        places.append((place.depth, place.inside, place.depth + row["least"][case]))
        place = Place(place.depth + row["depth"][case], place.inside != row["toggles"])
    _closed(files, file, place)
    # ranges that come up to the members of the collection
    outer = [(i, *ranges[i], *places[i][:2]) for i in range(len(ranges)) if places[i][2] <= 1]
    schema = "at int, lists array<bigint>, least array<bigint>, documents int"
    documents = [0] * len(files)
    for row in sorted(_for_each(spark, outer, f"at int, {SPLIT}, depth bigint, inside boolean", schema, _members).collect()):
        f = ranges[row["at"]][0]
        documents[f] += row["documents"]
        for opens, least in zip(row["lists"], row["least"]):
            beginnings.setdefault(f, (row["at"], opens, least))
    for f, n in enumerate(documents):
        if n > 1:
            raise ValueError(f"{files[f][0]}: more than one JSON document")
    wanted = []
    for i, (f, path, start, end) in enumerate(ranges):
        if f not in beginnings or i < beginnings[f][0]:
            continue
        first, opens, least = beginnings[f]
        wanted.append((len(wanted), path, start, end, files[f][1], places[i][0], places[i][1], opens))
        if (least if i == first else places[i][2]) <= 1:
            beginnings[f] = (len(ranges), opens, least)  # the list ends here
    if not wanted:
        return spark.createDataFrame([], "value string")
    columns = "at int, path string, start bigint, end bigint, length bigint, depth bigint, inside boolean, opens bigint"
    return _for_each(spark, wanted, columns, "value string", _texts)


def _closed(files, file: int | None, place: Place) -> None:
    if file is not None and (place.depth or place.inside):
        raise ValueError(f"{files[file][0]}: not a well-formed JSON document")


def _for_each(spark: SparkSession, rows: list[tuple], columns: str, schema: str, function) -> DataFrame:
    """``function(row)`` yields tuples; every row, numbered by its first column, is a task's work."""
    df = spark.createDataFrame(rows, columns)
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                held, size = [], 0
                for result in function(row):
                    held.append(result)
                    size += len(result[0]) if isinstance(result[0], (str, bytes)) else 1
                    if size >= 8 << 20:
                        yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in held], target)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in held], target)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = to_arrow_schema(StructType.fromDDL(schema))
    return df.repartitionById(max(len(rows), 1), "at").mapInArrow(run, schema)


def _sums(row):
    yield row["at"], *summed_up(row["path"], row["start"], row["end"])


def _members(row):
    yield row["at"], *members(row["path"], row["start"], row["end"], row["depth"], row["inside"])


def _texts(row):
    place = Place(row["depth"], row["inside"])
    for text in read_range(row["path"], row["start"], row["end"], row["length"], place, row["opens"]):
        yield (text.decode("utf-8"),)
