"""Byte-level BPE encoding and decoding by a segment tree over the ranks of adjacent pairs.

Each piece of text between split points starts as its bytes. The leaves of a tree hold the merge
rank of every adjacent pair, inner nodes the smallest rank below. The root says which pair merges
next, going left on ties gives the leftmost one, and a merge changes at most three leaves, each in
logarithmic time, until no pair can merge. A piece of n bytes takes O(n log n) steps, so a
megabyte without a blank is no special case. Short pieces are merged many at a time: their trees
are rows of one array, and each step finds every root's leftmost leaf and updates its path.
"""

from __future__ import annotations

import hashlib
import json
from array import array

import numpy as np
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame

from civiclake.llm.common import map_rows

#: Fixed value: how byte-level vocabularies of this kind split text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Pieces whose ids a worker remembers, and the longest piece it remembers.
REMEMBERED = 300_000
REMEMBERED_LENGTH = 48

#: Widths of the trees that are rows of one array; longer pieces have a tree of their own.
WIDTHS = (4, 8, 16, 32, 64)

#: Documents whose new pieces are merged together, and characters after which a group is full.
GROUP_ROWS = 256
GROUP_CHARACTERS = 1 << 20

_NEVER = 1 << 40


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files: itself, or from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class PairTree:
    """Smallest rank over a row of adjacent pairs, with point updates."""

    def __init__(self, ranks: list[int]) -> None:
        self.width = 1
        while self.width < len(ranks):
            self.width *= 2
        self.least = [_NEVER] * self.width + ranks + [_NEVER] * (self.width - len(ranks))
        for node in range(self.width - 1, 0, -1):
            left, right = self.least[2 * node], self.least[2 * node + 1]
            self.least[node] = left if left <= right else right

    def set(self, leaf: int, rank: int) -> None:
        least, node = self.least, leaf + self.width
        least[node] = rank
        node >>= 1
        while node:
            left, right = least[2 * node], least[2 * node + 1]
            value = left if left <= right else right
            if least[node] == value:
                return
            least[node] = value
            node >>= 1

    def leftmost(self) -> int:
        """The leftmost leaf of the smallest rank, -1 if no pair can merge."""
        least, node = self.least, 1
        rank = least[1]
        if rank >= _NEVER:
            return -1
        while node < self.width:
            node *= 2
            if least[node] != rank:
                node += 1
        return node - self.width


class Codec(dict):
    """Text to ids and back for one vocabulary file; as a dict, pieces to their packed ids."""

    def __init__(self, definition: bytes) -> None:
        super().__init__()
        spec = json.loads(definition)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or spec.get("normalizer"):
            raise ValueError("a byte-level BPE vocabulary without a normalizer is needed")
        if pre.get("add_prefix_space") or not pre.get("use_regex", True) or model.get("ignore_merges"):
            raise ValueError("prefix blanks, other splits and unmerged lookups are not supported")
        letters = byte_characters()
        vocabulary = model["vocab"]
        self.bytes_of = {n: bytes(letters[c] for c in word) for word, n in vocabulary.items()}
        self.start = [0] * 256
        for character, byte in letters.items():
            self.start[byte] = vocabulary[character]
        self.merged: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merged[vocabulary[left], vocabulary[right]] = (rank, vocabulary[left + right])
        keys = np.array([left << 32 | right for left, right in self.merged], np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.array([rank for rank, _ in self.merged.values()], np.int64)[order]
        self.made_by = np.zeros(len(model["merges"]), np.int64)
        for rank, made in self.merged.values():
            self.made_by[rank] = made
        self.special: dict[str, int] = {}
        for token in spec.get("added_tokens", []):
            if any(token.get(k) for k in ("single_word", "lstrip", "rstrip", "normalized")):
                raise ValueError(f"added token {token['content']!r} has a rule that is not supported")
            self.special[token["content"]] = token["id"]
            self.bytes_of[token["id"]] = token["content"].encode()
        self.pieces = regex.compile(SPLIT).findall
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("|".join(map(regex.escape, longest_first))) if self.special else None

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one piece of text."""
        ids = [self.start[b] for b in piece]
        count, merged = len(ids), self.merged
        if count < 2:
            return ids
        never = (_NEVER, 0)
        tree = PairTree([merged.get(pair, never)[0] for pair in zip(ids, ids[1:])])
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))
        alive = bytearray(b"\x01") * count
        while (left := tree.leftmost()) >= 0:
            gone = after[left]
            ids[left] = merged[ids[left], ids[gone]][1]
            alive[gone] = 0
            following = after[left] = after[gone]
            if gone < count - 1:
                tree.set(gone, _NEVER)
            if following < count:
                before[following] = left
                tree.set(left, merged.get((ids[left], ids[following]), never)[0])
            else:
                tree.set(left, _NEVER)
            if (previous := before[left]) >= 0:
                tree.set(previous, merged.get((ids[previous], ids[left]), never)[0])
        return [n for n, here in zip(ids, alive) if here]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge ranks of pairs of ids; a negative id is no neighbour."""
        keys = left << 32 | (right & 0xFFFFFFFF)
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == keys) & (right >= 0) & (left >= 0), self.pair_ranks[at], _NEVER)

    def merge_rows(self, pieces: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, which are left) of pieces of at most ``width`` bytes, a row each."""
        rows = len(pieces)
        raw = np.frombuffer(b"".join(piece.ljust(width, b"\0") for piece in pieces), np.uint8).reshape(rows, width)
        inside = np.arange(width) < np.fromiter(map(len, pieces), np.int64, rows)[:, None]
        span = width + 1  # one place behind the last, for neighbours that do not exist
        ids = np.full((rows, span), -1, np.int64)
        ids[:, :width] = np.where(inside, np.array(self.start, np.int64)[raw], -1)
        alive = np.zeros((rows, span), bool)
        alive[:, :width] = inside
        after = np.tile(np.minimum(np.arange(1, span + 1), width), (rows, 1))
        before = np.tile(np.r_[width, np.arange(width)], (rows, 1))
        least = np.full((rows, 2 * width), _NEVER, np.int64)
        least[:, width:] = self._ranks(ids[:, :width], ids[:, 1:])
        level = width // 2
        while level:
            np.minimum(least[:, 2 * level : 4 * level : 2], least[:, 2 * level + 1 : 4 * level : 2], out=least[:, level : 2 * level])
            level //= 2
        flat_ids, flat_after, flat_before = ids.reshape(-1), after.reshape(-1), before.reshape(-1)
        flat_alive, flat_least = alive.reshape(-1), least.reshape(-1)

        def put(trees, leaves, ranks):
            nodes = leaves + width
            flat_least[trees + nodes] = ranks
            for _ in range(width.bit_length() - 1):
                nodes = nodes >> 1
                both = trees + 2 * nodes
                flat_least[trees + nodes] = np.minimum(flat_least[both], flat_least[both + 1])

        active = np.flatnonzero(least[:, 1] < _NEVER)
        while active.size:
            trees, places = active * (2 * width), active * span
            rank = flat_least[trees + 1]
            nodes = np.ones_like(active)
            for _ in range(width.bit_length() - 1):
                nodes *= 2
                nodes += flat_least[trees + nodes] != rank
            left = nodes - width
            gone = flat_after[places + left]
            made = flat_ids[places + left] = self.made_by[rank]
            flat_alive[places + gone] = False
            following = flat_after[places + left] = flat_after[places + gone]
            flat_before[places + following] = left
            put(trees, gone, _NEVER)
            put(trees, left, self._ranks(made, flat_ids[places + following]))
            previous = flat_before[places + left]
            has = previous < width
            if has.any():
                put(trees[has], previous[has], self._ranks(flat_ids[(places + previous)[has]], made[has]))
            active = active[flat_least[trees + 1] < _NEVER]
        return ids, alive

    def remember(self, pieces: set[str]) -> None:
        """Merges the short ones among pieces not seen before, many at a time."""
        new = [piece for piece in pieces if piece not in self and len(piece) <= REMEMBERED_LENGTH]
        if len(self) + len(new) > REMEMBERED:
            self.clear()
            new = [piece for piece in pieces if len(piece) <= REMEMBERED_LENGTH]
        encoded = [piece.encode("utf-8") for piece in new]
        low = 0
        for width in WIDTHS:
            own = [n for n, piece in enumerate(encoded) if low < len(piece) <= width]
            low = width
            for at in range(0, len(own), 16384):
                part = own[at : at + 16384]
                ids, alive = self.merge_rows([encoded[n] for n in part], width)
                packed = ids[alive].astype("<u4").tobytes()
                ends = (4 * alive.sum(1).cumsum()).tolist()
                for n, first, past in zip(part, [0, *ends], ends):
                    self[new[n]] = packed[first:past]

    def __missing__(self, piece: str | tuple[str]) -> bytes:
        if isinstance(piece, tuple):
            return _packed([self.special[piece[0]]])
        packed = _packed(self.merge(piece.encode("utf-8")))
        if len(piece) <= REMEMBERED_LENGTH:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = packed
        return packed

    def split(self, text: str) -> list[str | tuple[str]]:
        """Pieces of ordinary text; an added token's string stands for that token and is in a tuple."""
        if self.cut is None or not self.cut.search(text):
            return self.pieces(text)
        parts, at = [], 0
        for found in self.cut.finditer(text):
            parts += self.pieces(text[at : found.start()])
            parts.append((found.group(),))
            at = found.end()
        return parts + self.pieces(text[at:])

    def pack(self, pieces: list[str | tuple[str]]) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.__getitem__, pieces))

    def encode(self, text: str) -> bytes:
        return self.pack(self.split(text))

    def encode_many(self, texts: list[str]) -> list[bytes]:
        split = [self.split(text) for text in texts]
        distinct: set[str | tuple[str]] = set()
        for pieces in split:
            distinct.update(pieces)
        self.remember({piece for piece in distinct if isinstance(piece, str)})
        return [self.pack(pieces) for pieces in split]

    def decode(self, packed: bytes) -> str:
        ids = array("I", packed)
        if _SWAP:
            ids.byteswap()
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


_SWAP = array("I", [1]).tobytes() != b"\x01\x00\x00\x00"
_CODECS: dict[bytes, Codec] = {}


def _packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if _SWAP:
        out.byteswap()
    return out.tobytes()


def codec(definition: bytes) -> Codec:
    """One codec per worker and vocabulary, so that remembered pieces serve all its tasks."""
    key = hashlib.sha256(definition).digest()
    if key not in _CODECS:
        _CODECS[key] = Codec(definition)
    return _CODECS[key]


def encode_decode(
    documents: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text", with_ids: bool = False
) -> DataFrame:
    """Per document: id, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``; ``ids`` if asked for.

    ``vocabulary`` is the path of a tokenizer file on the driver; its content (a few megabytes,
    whatever the corpus) is broadcast. A null text counts as empty; a null id, repeated rows and
    empty tables pass through, one output row per input row; other columns are not read. Whole
    texts are encoded, one at a time.
    """
    with open(vocabulary, "rb") as file:
        shared: Broadcast = documents.sparkSession.sparkContext.broadcast(file.read())
    id_type = documents.schema[id_column].dataType.simpleString()
    schema = f"{id_column} {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"

    def run(rows):
        own = codec(shared.value)
        for group in _groups(rows):
            for (key, _), packed in zip(group, own.encode_many([text or "" for _, text in group]), strict=True):
                plain = own.decode(packed).encode("utf-8")
                out = (key, len(packed) // 4, hashlib.sha256(packed).hexdigest(), hashlib.sha256(plain).hexdigest())
                yield (*out, np.frombuffer(packed, "<u4").astype(np.int64)) if with_ids else out

    return map_rows(documents.select(id_column, text_column), run, schema + ", ids array<bigint>" * with_ids)


def _groups(rows):
    group, size = [], 0
    for row in rows:
        group.append(row)
        size += len(row[1] or "")
        if len(group) == GROUP_ROWS or size >= GROUP_CHARACTERS:
            yield group
            group, size = [], 0
    if group:
        yield group
