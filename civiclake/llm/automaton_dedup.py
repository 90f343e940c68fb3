"""Substring dedup: matching statistics of documents against suffix automata of reference shards.

The reference of a document is every document with a smaller id. Passages that several documents
may share meet in buckets (see ``passages``); there, those of smaller ids are the reference. They
are cut into shards of bounded size. One shard's suffix automaton is built at a time, each passage
is streamed through it before its own words are added, and all later passages are streamed through
the finished shard. Where the longest match that ends at a word is at least a window long, the
window that ends there is in an earlier document; the union of such windows is the maximal span.
Sending each shard to the documents that may match it takes the place of a broadcast of all shards
to all documents, which would grow with the square of the corpus.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from civiclake.llm.passages import Chunk, Kind, mixed, without_repeats

WINDOW_WORDS = 50

#: A power of two; of words, so many that chance repeats are rare.
GRAM_WORDS = 16

#: Words of reference passages in one automaton.
SHARD_WORDS = 100_000

#: Distinct words whose numbers a worker remembers.
REMEMBERED_WORDS = 400_000


class SuffixAutomaton:
    """All substrings of the sequences added so far."""

    def __init__(self) -> None:
        self.step: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.longest = [0]

    def _split(self, before: int, word: int) -> int:
        step, link, longest = self.step, self.link, self.longest
        target = step[before][word]
        length = longest[before] + 1
        if longest[target] == length:
            return target
        copy = len(step)
        step.append(dict(step[target]))
        link.append(link[target])
        longest.append(length)
        link[target] = copy
        while before >= 0 and step[before].get(word) == target:
            step[before][word] = copy
            before = link[before]
        return copy

    def add(self, words: list[int]) -> None:
        step, link, longest = self.step, self.link, self.longest
        last = 0
        for word in words:
            if word in step[last]:
                last = self._split(last, word)
                continue
            new = len(step)
            step.append({})
            link.append(0)
            longest.append(longest[last] + 1)
            at = last
            while at >= 0 and word not in step[at]:
                step[at][word] = new
                at = link[at]
            if at >= 0:
                link[new] = self._split(at, word)
            last = new

    def matched(self, words: list[int], window: int, found: np.ndarray) -> None:
        """Marks in ``found`` the starts of windows that are in the automaton."""
        step, link, longest = self.step, self.link, self.longest
        state = length = 0
        for place, word in enumerate(words, 1 - window):
            following = step[state].get(word)
            if following is None:
                while state and following is None:
                    state = link[state]
                    following = step[state].get(word)
                length = longest[state]
                if following is None:
                    continue
            state = following
            length += 1
            if length >= window:
                found[place] = True


def earlier_windows(passages: list[np.ndarray], ids: np.ndarray, window: int) -> np.ndarray:
    """For the windows of all passages in turn, whether a passage of a smaller id has them."""
    found = [np.zeros(len(passage) - window + 1, bool) for passage in passages]
    order = np.argsort(ids, kind="stable").tolist()
    words = {n: passages[n].tolist() for n in order}
    same_id = [list(group) for _, group in groupby(order, key=ids.__getitem__)]
    at = 0
    while at < len(same_id):
        automaton, size = SuffixAutomaton(), 0
        while at < len(same_id) and size < SHARD_WORDS:
            if size:
                for n in same_id[at]:
                    automaton.matched(words[n], window, found[n])
            for n in same_id[at]:
                automaton.add(words[n])
                size += len(words[n])
            at += 1
        for later in same_id[at:]:
            for n in later:
                automaton.matched(words[n], window, found[n])
    return np.concatenate(found)


class _Numbers(dict):
    """Words to their 64-bit XXH64 numbers, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        number = self[word] = xxhash.xxh64_intdigest(word)
        return number


_NUMBERS = _Numbers()


def _units(texts):
    """Word numbers; words are what stands between ASCII white space."""
    data, offsets = texts
    raw = data.tobytes()
    words = [raw[a:b].split() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    total = int(counts.sum())
    number = _NUMBERS.__getitem__
    values = np.fromiter((n for own in words for n in map(number, own)), np.uint64, total)
    return values, np.r_[0, np.cumsum(counts)]


def _gram_hashes(values: np.ndarray) -> np.ndarray:
    """Hashes of all grams of ``GRAM_WORDS`` words, by doubling."""
    hashes, reach = mixed(values), 1
    while reach < GRAM_WORDS:
        hashes = mixed(hashes[:-reach] * np.uint64(0x9E3779B97F4A7C15) + hashes[reach:])
        reach *= 2
    return hashes


def remove_repeats(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    carried: list[str] | None = None,
    with_text: bool = False,
) -> DataFrame:
    """Per document: the carried columns, word counts, digest and, if asked for, ``kept_text``.

    Every word is removed that is covered by a window of 50 words whose word sequence also starts
    in a document with a smaller id; windows are judged on the input. Words compare by 64-bit
    hashes, of which 50 in a row would have to collide. Null and blank texts have no words; texts
    under 50 words keep all. Documents of one id, repeated rows among them, do not remove each
    other's words; a document without id keeps all its words and removes none elsewhere. Other
    columns are carried if named. Empty tables give empty tables.
    """
    carried = [id_column] if carried is None else carried

    def finish(chunk: Chunk, covered: np.ndarray) -> dict[str, pa.Array]:
        data, offsets = chunk.texts
        raw = data.tobytes()
        removed, digests, texts = [], [], []
        for n, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            gone = covered[chunk.offsets[n] : chunk.offsets[n + 1]]
            words = raw[a:b].split()
            if gone.any():
                words = [word for word, out in zip(words, gone.tolist()) if not out]
            kept = b" ".join(words)
            removed.append(int(gone.sum()))
            digests.append(hashlib.sha256(kept).hexdigest())
            if with_text:
                texts.append(kept.decode("utf-8", "ignore"))
        out = {
            "n_words": pa.array(np.diff(chunk.offsets), pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "kept_sha256": pa.array(digests, pa.string()),
        }
        return out | ({"kept_text": pa.array(texts, pa.string())} if with_text else {})

    kind = Kind(WINDOW_WORDS, GRAM_WORDS, _units, _gram_hashes)
    result = "n_words bigint, n_removed bigint, kept_sha256 string" + ", kept_text string" * with_text
    return without_repeats(documents, kind, "<u8", earlier_windows, finish, result, id_column, text_column, carried)
