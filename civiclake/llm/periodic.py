"""Periodic runs of words in texts, and texts without the repetitions.

A run is a stretch of words that repeats with its smallest period at least twice and that no
neighbouring word extends. Texts are gathered to batches and searched by internal pattern matching:

* Every text numbers its words apart from all others, so that nothing matches across texts. The
  suffixes of a batch are sorted by doubling; the order by the first 2^k words, kept for every k,
  names each dyadic block and gives its interval of the suffix array.
* A run of period q holds a block of about q / 2 words, starting on a grid of that width, that stands q
  words further on again. So each block asks for its occurrences in the windows beside it: a
  wavelet matrix over the suffix array counts the positions of the block's interval in a window and
  gives the first and the second of them (range successor). A window is shorter than the block, so
  its occurrences are an arithmetic progression, and their distances from the block are the candidate periods.
* A candidate is extended to both sides by comparing dyadic blocks, and stays if the stretch is long
  enough. Of one stretch the smallest period stays.

A text is one task's work. Only suffixes whose first words repeat in their text enter the wavelet matrix.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.llm.common import map_rows

#: Words gathered before they are searched together; a longer text is searched alone.
BATCH_WORDS = 1 << 16
#: From this least length on, periods up to 6 are found by blocks of 4 words on a grid of 3.
COARSE_LENGTH = 12
COARSE = (2, 3, 1, 6)

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
Words = list[bytes]


class Blocks:
    """Names of all blocks of 2^k symbols of a sequence, equal for equal blocks.

    The name of a block is the first place, in the order of suffixes, of those that begin with it.
    """

    def __init__(self, symbols: np.ndarray) -> None:
        n = len(symbols)
        counts = np.bincount(symbols)
        names = np.empty(n + 1, np.int32)
        names[:n] = (np.cumsum(counts) - counts)[symbols]
        names[n] = -1  # behind the end nothing is equal to anything
        self.levels = [names]
        active = np.flatnonzero(counts[symbols] > 1)
        self.repeated = [(active, counts[symbols[active]])]
        width = 1
        while len(active):
            key = names[active].astype(np.int64) * (n + 1) + names[np.minimum(active + width, n)] + 1
            order = np.argsort(key)
            places, key = active[order], key[order]
            at = np.arange(len(places))
            old = names[places]
            changes = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            sizes = np.diff(np.r_[changes, len(places)])
            first_of_old = np.maximum.accumulate(np.where(np.r_[True, old[1:] != old[:-1]], at, 0))
            names = names.copy()
            names[places] = old + np.repeat(changes, sizes) - first_of_old
            again = np.repeat(sizes, sizes)
            repeats = again > 1
            active, sizes = places[repeats], again[repeats]
            self.levels.append(names)
            self.repeated.append((active, sizes))
            width *= 2

    def equal_after(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from i and from j on are equal; i < j."""
        start = i
        for k in range(len(self.levels) - 1, -1, -1):
            step = (self.levels[k][i] == self.levels[k][j]).astype(np.int64) << k
            i, j = i + step, j + step
        return i - start

    def equal_before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols before i and before j are equal; i < j."""
        start = i
        for k in range(len(self.levels) - 1, -1, -1):
            inside = i >= 1 << k
            names = self.levels[k]
            same = inside & (names[np.where(inside, i - (1 << k), 0)] == names[np.where(inside, j - (1 << k), 0)])
            step = same.astype(np.int64) << k
            i, j = i - step, j - step
        return start - i


class WaveletMatrix:
    """Order statistics of the values in ranges of a sequence; all queries of a call go down together."""

    def __init__(self, values: np.ndarray, bits: int) -> None:
        self.bits = bits
        self.zeros: list[np.ndarray] = []  # per level: zeros before each place
        for bit in range(bits - 1, -1, -1):
            zero = (values >> bit) & 1 == 0
            self.zeros.append(np.r_[0, np.cumsum(zero)])
            values = np.r_[values[zero], values[~zero]]

    def below(self, left: np.ndarray, right: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values of [left, right) are less than bound."""
        count = np.where(bound >> self.bits > 0, right - left, 0)
        for level, zeros in enumerate(self.zeros):
            l0, r0, all_zeros = zeros[left], zeros[right], zeros[-1]
            one = (bound >> (self.bits - 1 - level)) & 1 == 1
            open_ = bound >> self.bits == 0
            count = count + np.where(one & open_, r0 - l0, 0)
            left, right = np.where(one, all_zeros + left - l0, l0), np.where(one, all_zeros + right - r0, r0)
        return count

    def smallest(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The value with ``rank`` values of [left, right) before it in order; with ``below``, a range successor."""
        value = np.zeros(len(left), np.int64)
        for zeros in self.zeros:
            l0, r0, all_zeros = zeros[left], zeros[right], zeros[-1]
            one = rank >= r0 - l0
            rank = np.where(one, rank - (r0 - l0), rank)
            left, right = np.where(one, all_zeros + left - l0, l0), np.where(one, all_zeros + right - r0, r0)
            value = value << 1 | one
        return value


def _grids(levels: int, min_length: int) -> Iterator[tuple[int, int, int, int]]:
    """(k, grid, least period, greatest period): blocks of 2^k words and the periods they find.

    A run of n words and period q has n - q - 2^k + 1 places for a block that stands q further on
    again; where that is at least the grid, one of them lies on it. With n >= 2q this holds
    for a grid of 2^k and q from 2^(k + 1) - 1 on.
    """
    lowest = 0
    if min_length >= COARSE_LENGTH:
        yield COARSE
        lowest = 2
    for k in range(lowest, levels):
        yield k, 1 << k, (2 << k) - 1, (4 << k) - 2


def runs(symbols: np.ndarray, min_length: int) -> np.ndarray:
    """Rows (start, end, period), by start and period, of all runs of at least ``min_length`` symbols.

    Symbols are numbered from 0. A run has its smallest period at least twice.
    """
    found = [np.empty((0, 3), np.int64)]
    blocks = Blocks(symbols)
    lowest = 2 if min_length >= COARSE_LENGTH else 0
    if len(blocks.levels) <= lowest or not len(blocks.repeated[lowest][0]):
        return found[0]
    suffixes = blocks.repeated[lowest][0]
    last = blocks.levels[-1]
    suffixes = suffixes[np.argsort(last[suffixes])]  # of the suffix array, what can match
    ranks = last[suffixes]
    tree = WaveletMatrix(suffixes.astype(np.int64), len(symbols).bit_length())
    for k, grid, least, greatest in _grids(len(blocks.levels), min_length):
        places, sizes = blocks.repeated[k]
        on_grid = places % grid == 0
        b, size = places[on_grid].astype(np.int64), sizes[on_grid]
        if not len(b):
            continue
        left = np.searchsorted(ranks, blocks.levels[k][b])
        right = left + size
        for low in range(least, greatest + 1, 1 << k):
            high = min(low + (1 << k) - 1, greatest)
            before = tree.below(left, right, b + low)
            count = tree.below(left, right, b + high + 1) - before
            hit = count > 0
            if hit.any():
                found.append(
                    _extended(blocks, tree, b[hit], left[hit], right[hit], before[hit], count[hit], 1 << k, min_length)
                )
    table = np.concatenate(found)
    table = table[np.lexsort((table[:, 2], table[:, 1], table[:, 0]))]
    first = np.r_[True, (table[1:, :2] != table[:-1, :2]).any(axis=1)][: len(table)]
    table = table[first]
    return table[np.lexsort((table[:, 2], table[:, 0]))]


def _extended(blocks, tree, b, left, right, before, count, width, min_length) -> np.ndarray:
    """The stretches to which a window's progression of occurrences of each block extends."""
    first = tree.smallest(left, right, before)
    several = count > 1
    step = np.ones_like(first)
    step[several] = tree.smallest(left[several], right[several], before[several] + 1) - first[several]
    # from three occurrences on, the step is the block's period; the stretch of that period around the block ...
    inner = np.zeros_like(first)
    many = count > 2
    inner[many] = blocks.equal_after(b[many], b[many] + step[many]) + step[many]
    owner = np.repeat(np.arange(len(b)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    period = first[owner] - b[owner] + nth * step[owner]
    # ... rules out its multiples: a run of such a period would have the step as a period too
    multiple = many[owner] & (period % step[owner] == 0) & (period > step[owner]) & (inner[owner] >= period + width)
    period, owner = period[~multiple], owner[~multiple]
    b = b[owner]
    start = b - blocks.equal_before(b, b + period)
    end = b + period + blocks.equal_after(b, b + period)
    long = end - start >= np.maximum(min_length, 2 * period)
    return np.column_stack([start, end, period])[long]


def _numbered(texts: list[Words]) -> np.ndarray:
    """All words of all texts as numbers; a number belongs to one text."""
    parts, base = [], 0
    for words in texts:
        seen: dict[bytes, int] = {}
        number = seen.setdefault
        parts.append(np.fromiter((number(w, len(seen)) for w in words), np.int64, len(words)) + base)
        base += len(seen)
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def collapsed(words: Words, found: list[tuple[int, int, int]]) -> Words:
    """The words without those that any run (start, length, period) contains after its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    dropped = np.cumsum(change[:-1]) > 0
    return [w for w, gone in zip(words, dropped.tolist()) if not gone]


def runs_of_texts(texts: list[Words], min_length: int) -> list[list[tuple[int, int, int]]]:
    """Per text its runs (start, length, period), by start and period."""
    offsets = np.cumsum([0, *map(len, texts)])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    symbols = _numbered(texts)
    if len(symbols):
        table = runs(symbols, min_length)
        owners = np.searchsorted(offsets, table[:, 0], "right") - 1
        starts = table[:, 0] - offsets[owners]
        lengths = table[:, 1] - table[:, 0]
        for owner, *run in zip(owners.tolist(), starts.tolist(), lengths.tolist(), table[:, 2].tolist()):
            out[owner].append(tuple(run))
    return out


def find_runs(
    documents: DataFrame,
    min_words: int = 12,
    id_column: str = "doc_id",
    text_column: str = "text",
    rewrite: Callable[[object, Words], Words] | None = None,
) -> DataFrame:
    """Per row: the id, ``n_words``, ``runs`` (start, length, period) and ``collapsed_text``.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. All runs of at least ``min_words`` words and two
    periods are returned, by start and period; ``collapsed_text`` joins by a space the words that no run
    contains after its first period. ``rewrite(id, words)`` may change the words of a text first.

    Null, empty and blank texts have no words, no runs and an empty collapsed text. Rows without id
    and repeated rows are judged alone, like any other. Other columns are not read, an empty table
    gives an empty table. Nothing is shuffled; a task holds a batch of words or one long text,
    with some 200 bytes a word.
    """
    if min_words < 2:
        raise ValueError("a run has at least two words")

    def results(held):
        for (key, words), found in zip(held, runs_of_texts([w for _, w in held], min_words)):
            kept = collapsed(words, found) if found else words
            listed = [{"start": s, "length": n, "period": p} for s, n, p in found]
            yield key, len(words), listed, b" ".join(kept).decode("utf-8", "surrogatepass")

    def run(rows):
        held, size = [], 0
        for key, text in rows:
            words = text.encode("utf-8", "surrogatepass").split() if text else []
            if rewrite is not None:
                words = rewrite(key, words)
            if size and size + len(words) > BATCH_WORDS:
                yield from results(held)
                held, size = [], 0
            held.append((key, words))
            size += len(words)
        yield from results(held)

    id_type = documents.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {id_type}, n_words bigint, runs {RUNS}, collapsed_text string"
    return map_rows(documents.select(id_column, text_column), run, schema)


def planted(key: object, words: Words) -> Words:
    """The words of a tenth of all documents, by their id, with a periodic stretch up to the end."""
    n = len(words)
    h = crc32(str(key).encode()) if key is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    period = words[a : a + 1 + (n - a) // (3 + g % 8)]
    return words[:a] + (period * ((n - a) // len(period) + 1))[: n - a]


def run_digests(found: DataFrame) -> DataFrame:
    """Counts, the longest run and digests from the rows of ``find_runs``."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    # ties go to the smallest start, then period
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    rows = found.withColumn("__longest", longest)
    length, period = F.col("__longest.n"), -F.col("__longest.p")
    return rows.select(
        "doc_id",
        "n_words",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("__longest.s")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).cast("bigint").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )
