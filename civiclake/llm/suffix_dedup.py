"""Suffix-array dedup: byte strings that an earlier document has, found in sorted suffixes.

Passages of a bucket stand one after another in one text. The suffixes at window starts are sorted
by difference-cover blockwise construction: first the suffixes at a difference cover of positions
are ranked once; then one block of suffixes at a time, those whose first bytes lie in a range, is
sorted by its first 32 bytes, and suffixes that agree in all of these are ordered by the ranks of
the cover positions that both reach at the same distance. Memory is the text, one rank per
cover position and one block. Neighbours in the order that share a window are equal windows; the
smallest document id among them says whose come earlier.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from civiclake.llm.passages import Chunk, Kind, mixed, runs, without_repeats

WINDOW_BYTES = 50
GRAM_BYTES = 24

#: Period of the difference cover, which is also the length suffixes are sorted by before ranks decide.
PERIOD = 32

#: Suffixes sorted at a time.
BLOCK_SUFFIXES = 1 << 18

#: Between passages; no UTF-8 text has this byte.
END = 0xFF


def difference_cover(period: int) -> list[int]:
    """Residues such that every residue is a difference of two of them, chosen greedily."""
    cover = [0, 1]
    while len(missing := set(range(period)) - {(a - b) % period for a in cover for b in cover}) > 0:
        cover.append(
            max(
                (c for c in range(period) if c not in cover),
                key=lambda c: len(missing & {d % period for a in cover for d in (a - c, c - a)}),
            )
        )
    return sorted(cover)


COVER = np.array(difference_cover(PERIOD))

#: SHIFT[a, b]: the least distance at which positions of residues a and b are both in the cover.
SHIFT = np.array(
    [[min(d for d in range(PERIOD) if {(a + d) % PERIOD, (b + d) % PERIOD} <= set(COVER.tolist())) for b in range(PERIOD)] for a in range(PERIOD)]
)


def first_bytes(text: np.ndarray, positions: np.ndarray, count: int) -> list[np.ndarray]:
    """The ``count`` bytes from each position as big-endian numbers of 8; ``text`` is long enough."""
    view = np.ndarray(len(text) - 7, ">u8", buffer=text, strides=(1,))
    return [view[positions + at].astype(np.uint64) for at in range(0, count, 8)]


def _ranked(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(order, rank of each) by several small numbers, equal ones of one rank.

    As many keys as fit are one 63-bit number, and what is sorted so far goes on as a rank.
    """
    whole, width = keys[0].astype(np.uint64), _bits(keys[0])
    for key in keys[1:]:
        more = _bits(key)
        if width + more > 63:
            whole = _dense(whole)[1].astype(np.uint64)
            width = _bits(whole)
        whole, width = whole << np.uint64(more) | key.astype(np.uint64), width + more
    return _dense(whole)


def _bits(values: np.ndarray) -> int:
    return max(int(values.max()).bit_length(), 1) if len(values) else 1


def _dense(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(values)
    ordered = values[order]
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(np.r_[False, ordered[1:] != ordered[:-1]])[: len(order)]
    return order, ranks


def cover_ranks(words: np.ndarray, size: int, deepest: int) -> np.ndarray:
    """Ranks of suffixes at cover positions of the first ``size`` bytes, by doubling; 0 elsewhere.

    ``words`` has for each position the rank of the 8 bytes there. Suffixes that agree in
    ``deepest`` bytes share a rank.
    """
    positions = np.concatenate([np.arange(c, size, PERIOD) for c in COVER])
    positions.sort()
    _, ranks = _ranked([words[positions + at] for at in range(0, PERIOD, 8)])
    at = np.zeros(len(words), np.int64)
    depth = PERIOD
    while len(ranks) and depth < deepest and ranks.max() < len(ranks) - 1:
        at[positions] = ranks + 1
        beyond = positions + depth
        # behind the end there is END without end, the greatest suffix
        following = np.where(beyond < size, at[np.minimum(beyond, size)], len(ranks) + 1)
        _, ranks = _ranked([ranks, following])
        depth *= 2
    at[positions] = ranks + 1
    return at


def sort_ties(items: np.ndarray, group: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Items (suffix positions that agree in ``PERIOD`` bytes inside a group) sorted inside groups.

    A merge sort over all groups at once: every item looks up by binary search how many items of
    its sibling run come before it, comparing by cover ranks.
    """

    def less(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        shift = SHIFT[a % PERIOD, b % PERIOD]
        return ranks[a + shift] < ranks[b + shift]

    start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[start, len(items)])
    first, past = np.repeat(start, sizes), np.repeat(start + sizes, sizes)
    place = np.arange(len(items)) - first
    width = 1
    while width < sizes.max():
        run = place // width
        low = np.minimum(first + (run ^ 1) * width, past)
        sibling, high = low.copy(), np.minimum(low + width, past)
        right = (run & 1).astype(bool)
        live = np.flatnonzero(low < high)
        while live.size:
            middle = (low[live] + high[live]) // 2
            own, other = items[live], items[middle]
            before = np.where(right[live], ~less(own, other), less(other, own))
            low[live[before]] = middle[before] + 1
            high[live[~before]] = middle[~before]
            live = live[low[live] < high[live]]
        new = first + (run // 2) * 2 * width + (place - run * width) + (low - sibling)
        moved = np.empty_like(items)
        moved[new] = items
        items, width = moved, width * 2
    return items


def blocks(heads: np.ndarray):
    """Index arrays of suffixes by ranges of their first two bytes, at most ``BLOCK_SUFFIXES`` each where possible."""
    order = np.argsort(heads, kind="stable")
    counts = np.bincount(heads, minlength=1 << 16)
    taken = at = 0
    for head in np.flatnonzero(counts):
        if taken and taken + counts[head] > BLOCK_SUFFIXES:
            yield order[at : at + taken]
            at, taken = at + taken, 0
        taken += int(counts[head])
    if taken:
        yield order[at : at + taken]


def earlier_windows(passages: list[np.ndarray], ids: np.ndarray, window: int) -> np.ndarray:
    """For the windows of all passages in turn, whether a passage of a smaller id has them."""
    lengths = np.fromiter(map(len, passages), np.int64, len(passages))
    size = int((lengths + 1).sum())
    text = np.full(size + 2 * PERIOD + window + 16, END, np.uint8)
    begins = np.r_[0, np.cumsum(lengths + 1)[:-1]]
    for passage, begin in zip(passages, begins.tolist()):
        text[begin : begin + len(passage)] = passage
    counts = lengths - window + 1
    total = int(counts.sum())
    window_of = np.repeat(np.arange(len(passages)), counts)
    starts = runs(begins, counts)
    words = _dense(first_bytes(text, np.arange(len(text) - 7), 8)[0])[1]
    # passages differ, so suffixes that agree to the end of theirs part within the passages that follow; ranks
    # that deep order all suffixes alike, from whatever place of the cover they are compared
    ranks = cover_ranks(words, size, 2 * int(lengths.max()) + 2 + PERIOD)
    number = np.zeros(size, np.int64)
    number[starts] = np.arange(total)
    earlier = np.zeros(total, bool)
    rest = window - PERIOD
    for block in blocks(text[starts].astype(np.int64) << 8 | text[starts + 1]):
        positions = starts[block]
        order, tie = _ranked([words[positions + at] for at in range(0, PERIOD, 8)])
        ordered_tie = tie[order]
        many = np.r_[ordered_tie[1:] == ordered_tie[:-1], False]
        many[1:] |= many[:-1].copy()
        order_positions = positions[order]
        if many.any():
            order_positions[many] = sort_ties(order_positions[many], ordered_tie[many], ranks)
        # neighbours are equal windows if they agree beyond the first bytes too
        tails = first_bytes(text, order_positions + PERIOD, rest + (-rest) % 8)
        if rest % 8:
            tails[-1] = tails[-1] >> np.uint64(8 * (8 - rest % 8))
        differs = np.r_[True, ordered_tie[1:] != ordered_tie[:-1]]
        for tail in tails:
            differs[1:] |= tail[1:] != tail[:-1]
        group = np.flatnonzero(differs)
        back = number[order_positions]
        owner = ids[window_of[back]]
        least = np.repeat(np.minimum.reduceat(owner, group), np.diff(np.r_[group, len(owner)]))
        earlier[back] = owner > least
    return earlier


def _units(texts):
    return texts


def _gram_hashes(values: np.ndarray) -> np.ndarray:
    """Hashes of all grams of 24 bytes, some at a time."""
    n = len(values) - GRAM_BYTES + 1
    out = np.empty(n, np.uint64)
    view = np.ndarray(len(values) - 7, "<u8", buffer=values, strides=(1,))
    a, b = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
    for at in range(0, n, 1 << 16):
        past = min(at + (1 << 16), n)
        value = mixed(view[at:past] * a + view[at + 8 : past + 8])
        out[at:past] = mixed(value * b + view[at + 16 : past + 16])
    return out


def remove_repeats(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    carried: list[str] | None = None,
    with_text: bool = False,
) -> DataFrame:
    """Per document: the carried columns, byte counts, removed spans, digest and, if asked for, ``kept_text``.

    Every byte is removed that is covered by a 50-byte string which also starts in a document with
    a smaller id; strings are judged on the input. Null texts are empty; texts under 50 bytes keep
    all. Documents of one id, repeated rows among them, do not remove each other's bytes; a
    document without id keeps all its bytes and removes none elsewhere. Other columns are carried
    if named. ``kept_text`` leaves out characters of which a byte was removed. Empty tables give
    empty tables. Integer ids are compared as 64-bit numbers.
    """
    carried = [id_column] if carried is None else carried

    def finish(chunk: Chunk, covered: np.ndarray) -> dict[str, pa.Array]:
        lengths = np.diff(chunk.offsets)
        before = np.r_[0, np.cumsum(covered)]
        removed = before[chunk.offsets[1:]] - before[chunk.offsets[:-1]]
        begins = covered & ~np.r_[False, covered[:-1]]
        at_start = chunk.offsets[:-1][lengths > 0]
        begins[at_start] = covered[at_start]
        spans = np.r_[0, np.cumsum(begins)]
        raw, digests, texts = chunk.values.tobytes(), [], []
        for first, past, gone in zip(chunk.offsets[:-1].tolist(), chunk.offsets[1:].tolist(), removed.tolist()):
            kept = raw[first:past] if not gone else chunk.values[first:past][~covered[first:past]].tobytes()
            digests.append(hashlib.sha256(kept).hexdigest())
            if with_text:
                texts.append(kept.decode("utf-8", "ignore"))
        out = {
            "n_bytes": pa.array(lengths, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "n_spans": pa.array(spans[chunk.offsets[1:]] - spans[chunk.offsets[:-1]], pa.int64()),
            "kept_sha256": pa.array(digests, pa.string()),
        }
        return out | ({"kept_text": pa.array(texts, pa.string())} if with_text else {})

    kind = Kind(WINDOW_BYTES, GRAM_BYTES, _units, _gram_hashes)
    result = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept_text string" * with_text
    return without_repeats(documents, kind, "u1", earlier_windows, finish, result, id_column, text_column, carried)
