"""Benchmark decontamination: an FM-index per training shard, searched backwards for test phrases.

A shard is a run of documents of one task. Its words become numbers, the suffix array of the
number sequence gives the Burrows-Wheeler transform, and a wavelet matrix over the transform
answers how often a number stands before a row. Every phrase of every benchmark item narrows its
row range word by word from its last; the rows that are left are located by walking back to the
next sampled suffix position. Found spans are merged per document.

Only words that benchmark items have can be part of an occurrence, so a shard keeps the stretches
of such words that are at least as long as the shortest phrase; the rest is cut out before the
index is built. Where all words are benchmark words, nothing is cut and the index is larger, but
never larger than the words of one shard.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.llm.common import alnum_words, map_batches, map_rows, table_bytes

#: Words of a phrase; shorter items are one phrase.
PHRASE_WORDS = 10

#: Text bytes of a shard, and every how many positions a suffix position is kept.
SHARD_BYTES = 8 << 20
SAMPLED = 8

#: Benchmark bytes that are broadcast at a time; a larger benchmark takes several passes.
BLOCK_BYTES = 16 << 20


class WaveletMatrix:
    """Rank over a sequence of small numbers: how often a number stands before a row."""

    def __init__(self, values: np.ndarray, bits: int) -> None:
        self.bits = bits
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in range(bits - 1, -1, -1):
            bit = (values >> level) & 1
            self.ones.append(np.r_[0, np.cumsum(bit)].astype(np.int64))
            self.zeros.append(int(len(values) - self.ones[-1][-1]))
            values = np.concatenate([values[bit == 0], values[bit == 1]])
        numbers = np.arange(1 << bits)
        self.starts = self._down(numbers, np.zeros_like(numbers))  # of each number once all levels are sorted

    def _down(self, numbers: np.ndarray, rows: np.ndarray) -> np.ndarray:
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            bit = (numbers >> (self.bits - 1 - level)) & 1
            before = ones[rows]
            rows = np.where(bit == 1, zeros + before, rows - before)
        return rows

    def rank(self, numbers: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Occurrences of ``numbers[i]`` before row ``rows[i]``."""
        return self._down(numbers, rows) - self.starts[numbers]

    def at(self, rows: np.ndarray) -> np.ndarray:
        """The numbers at rows."""
        numbers = np.zeros_like(rows)
        for ones, zeros in zip(self.ones, self.zeros):
            bit = ones[rows + 1] - ones[rows]
            rows = np.where(bit == 1, zeros + ones[rows], rows - ones[rows])
            numbers = numbers * 2 + bit
        return numbers


def suffix_array(values: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes, by doubling the sorted length."""
    n = len(values)
    _, rank = np.unique(values, return_inverse=True)
    rank = rank.astype(np.int64)
    length = 1
    while True:
        following = np.full(n, -1, np.int64)
        following[: n - length] = rank[length:] if length < n else following[: n - length]
        key = rank * (n + 1) + following + 1
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.r_[0, np.cumsum(ordered[1:] != ordered[:-1])]
        rank = np.empty(n, np.int64)
        rank[order] = new
        length *= 2
        if length >= n or new[-1] == n - 1:
            return order


class FMIndex:
    """Backward search and location over a sequence of positive numbers; 0 ends it."""

    def __init__(self, values: np.ndarray, alphabet: int) -> None:
        text = np.r_[values, 0].astype(np.int64)
        order = suffix_array(text)
        self.size = len(text)
        self.wavelet = WaveletMatrix(text[order - 1], max(alphabet.bit_length(), 1))
        self.before = np.r_[0, np.cumsum(np.bincount(text, minlength=alphabet + 1))]
        self.sampled = order % SAMPLED == 0
        self.samples_before = np.r_[0, np.cumsum(self.sampled)]
        self.samples = order[self.sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of phrases (one per line, filled with -1 on the left), all narrowed together."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.size, np.int64)
        for column in range(phrases.shape[1] - 1, -1, -1):
            live = np.flatnonzero((phrases[:, column] >= 0) & (low < high))
            if live.size:
                word = phrases[live, column]
                low[live] = self.before[word] + self.wavelet.rank(word, low[live])
                high[live] = self.before[word] + self.wavelet.rank(word, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: steps back until a sampled position."""
        rows = rows.copy()
        positions = np.zeros(len(rows), np.int64)
        steps = 0
        open_rows = np.arange(len(rows))
        while open_rows.size:
            own = rows[open_rows]
            done = self.sampled[own]
            positions[open_rows[done]] = self.samples[self.samples_before[own[done]]] + steps
            open_rows, own = open_rows[~done], own[~done]
            word = self.wavelet.at(own)
            rows[open_rows] = self.before[word] + self.wavelet.rank(word, own)
            steps += 1
        return positions


@dataclass
class Phrases:
    """The phrases of a block of benchmark items over their own vocabulary (numbers from 1)."""

    vocabulary: dict[bytes, int]
    lines: np.ndarray
    lengths: np.ndarray
    items: list[list[str]]

    @classmethod
    def of(cls, items: list[tuple[str | None, str | None]], words: int) -> Phrases:
        vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            own = [vocabulary.setdefault(word, len(vocabulary) + 1) for word in alnum_words(text)]
            size = min(words, len(own))
            for at in range(len(own) - size + 1 if own else 0):
                owners.setdefault(tuple(own[at : at + size]), set()).update(() if item is None else (item,))
        width = max(map(len, owners), default=1)
        lines = np.full((len(owners), width), -1, np.int64)
        for n, phrase in enumerate(owners):
            lines[n, width - len(phrase) :] = phrase
        lengths = np.array([len(phrase) for phrase in owners], np.int64)
        return cls(vocabulary, lines, lengths, [sorted(own) for own in owners.values()])


def search_shard(texts: list[list[bytes]], phrases: Phrases) -> list[tuple[list[tuple[int, int]], set[str]]]:
    """For each text, its merged hit spans in words and the items with an occurrence."""
    found: list[tuple[list[tuple[int, int]], set[str]]] = [([], set()) for _ in texts]
    if not len(phrases.lines):
        return found
    shortest = int(phrases.lengths.min())
    number = phrases.vocabulary.get
    parts, owners, places = [], [], []
    for n, words in enumerate(texts):
        if len(words) < shortest:
            continue
        own = np.fromiter(map(number, words, repeat(0)), np.int64, len(words))
        edges = np.flatnonzero(np.diff(np.r_[0, own != 0, 0]))
        for first, past in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if past - first >= shortest:
                parts.append(own[first:past])
                owners.append(n)
                places.append(first)
    if not parts:
        return found
    other = len(phrases.vocabulary) + 1  # between stretches, in no phrase
    starts = np.cumsum([0] + [len(part) + 1 for part in parts])[:-1]
    index = FMIndex(np.concatenate([np.r_[part, other] for part in parts]), other)
    low, high = index.search(phrases.lines)
    hit = np.flatnonzero(high > low)
    counts = (high - low)[hit]
    line = np.repeat(hit, counts)
    rows = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low[hit], counts)
    positions = index.locate(rows)
    part_of = np.searchsorted(starts, positions, "right") - 1
    spans: dict[int, list[tuple[int, int]]] = {}
    for phrase, part, position in zip(line.tolist(), part_of.tolist(), positions.tolist()):
        first = places[part] + position - int(starts[part])
        owner = owners[part]
        spans.setdefault(owner, []).append((first, first + int(phrases.lengths[phrase])))
        found[owner][1].update(phrases.items[phrase])
    for owner, own in spans.items():
        found[owner][0].extend(merged(own))
    return found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for first, past in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], past)
        else:
            out.append([first, past])
    return [tuple(span) for span in out]


def _blocks(benchmark: DataFrame, item_column: str, item_text: str):
    """(items, whether it is the last block), blocks of bounded size; one unless the benchmark is large."""
    count = table_bytes(benchmark, item_text) // BLOCK_BYTES + 1
    items = benchmark.select(F.col(item_column).cast("string").alias("item"), F.col(item_text).alias("text"))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(count))
    for n in range(count):
        yield [(r.item, r.text) for r in items.where(block == n).collect()], n == count - 1


def find_contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    phrase_words: int = PHRASE_WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Per document: word and hit counts, items with occurrences, ``contaminated``, hit ``spans`` in words.

    A phrase is ``phrase_words`` consecutive words of an item, or all words of a shorter one; a
    null or blank text has none. Hit words are those inside any occurrence. ``n_items`` and
    ``items_sha256`` (SHA-256 of the ids as strings, sorted, comma-joined) count an id once however
    many rows it has; the words of an item without id are hits but count as no item. One output
    row per input row, null ids and repeated rows included; other columns are not read. The
    benchmark is searched in blocks of ``BLOCK_BYTES``, each in its own pass over the documents;
    spans and items of the passes are merged in the row, and no pass needs a shuffle.
    """
    id_type = documents.schema[id_column].dataType.simpleString()
    span = "array<struct<first: bigint, past: bigint>>"
    state = documents.select(
        F.col(id_column).alias("id"),
        F.col(text_column).alias("text"),
        F.array().cast(span).alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    for items, last in _blocks(benchmark, item_column, item_text):
        phrases = documents.sparkSession.sparkContext.broadcast(Phrases.of(items, phrase_words))
        if not last:
            schema = f"id {id_type}, text string, spans {span}, items array<string>"
        else:
            schema = (
                f"{id_column} {id_type}, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, "
                f"contaminated boolean, spans {span}"
            )
        state = map_rows(state, _pass(phrases, last), schema)
    return state


def _pass(phrases, last: bool):
    def run(rows):
        for shard in _shards(rows):
            texts = [alnum_words(text) for _, text, _, _ in shard]
            hits = search_shard(texts, phrases.value)
            for (key, text, spans, items), words, (more, names) in zip(shard, texts, hits, strict=True):
                spans = merged([*((s["first"], s["past"]) for s in spans), *more]) if spans else more
                items = sorted({*items, *names}) if items else sorted(names)
                as_rows = [{"first": first, "past": past} for first, past in spans]
                if last:
                    digest = hashlib.sha256(",".join(items).encode()).hexdigest()
                    n_hit = sum(past - first for first, past in spans)
                    yield key, len(words), n_hit, len(items), digest, n_hit > 0, as_rows
                else:
                    yield key, text, as_rows, items

    return run


def _shards(rows):
    shard, size = [], 0
    for row in rows:
        shard.append(row)
        size += len(row[1] or "")
        if size >= SHARD_BYTES or len(shard) >= 100_000:
            yield shard
            shard, size = [], 0
    if shard:
        yield shard


_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """A text without the characters from each span's first to its last word."""
    if not spans:
        return text
    raw = text.encode("utf-8", "surrogatepass")
    places = [found.span() for found in _WORD.finditer(raw)]
    kept, at = [], 0
    for first, past in spans:
        kept.append(raw[at : places[first][0]])
        at = places[past - 1][1]
    return b"".join([*kept, raw[at:]]).decode("utf-8", "surrogatepass")


def cut_contamination(
    documents: DataFrame, benchmark: DataFrame, phrase_words: int = PHRASE_WORDS, item_column: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """The documents, with all their columns, and ``text`` without its hit spans; null stays null.

    Blocks of a large benchmark all search the uncut text; their spans travel in a column and are cut
    together by the last one.
    """
    at = documents.columns.index("text")
    hidden = "__spans"
    while hidden in [c.lower() for c in documents.columns]:
        hidden += "_"
    state = documents.withColumn(hidden, F.array().cast("array<struct<first: bigint, past: bigint>>"))
    for items, last in _blocks(benchmark, item_column, item_text):
        shared = documents.sparkSession.sparkContext.broadcast(Phrases.of(items, phrase_words))

        def search(batch: pa.RecordBatch, shared=shared, last=last) -> pa.RecordBatch:
            texts = batch.column(at).to_pylist()
            hits = search_shard([alnum_words(text) for text in texts], shared.value)
            before = batch.column(len(batch.schema) - 1).to_pylist()
            spans = [merged([*((s["first"], s["past"]) for s in old), *new]) for old, (new, _) in zip(before, hits, strict=True)]
            if last:
                texts = [text and without_spans(text, own) for text, own in zip(texts, spans, strict=True)]
                return batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
            rows = [[{"first": first, "past": past} for first, past in own] for own in spans]
            field = batch.schema.field(len(batch.schema) - 1)
            return batch.set_column(len(batch.schema) - 1, field, pa.array(rows, field.type))

        state = map_batches(state, search)
    return state.drop(hidden)
