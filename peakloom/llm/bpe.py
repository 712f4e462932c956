"""Byte-level BPE by corpus-level merge replay, and decoding.

Texts are cut into pieces by the tokenizer's pattern. All pieces of a block of texts that are not known yet are
laid out as one sequence of byte tokens. An inverted index leads from the rank of each mergeable token pair to
the places where the pair stands. Ranks are replayed in ascending order over the whole block: a merge visits the
places of its pair from left to right and updates the index for the two neighbours it touches, nothing else. A
piece that is a token itself is that token. This gives the ids that the pairwise greedy method gives for each
piece on its own.

Every block is encoded on its own, so nothing moves between tasks and the work follows the bytes of the input.
A task keeps the ids of pieces it has met, up to ``KNOWN_PIECES``, then starts afresh; what it keeps changes the time,
never the result.

Defined cases: null counts as empty and has no ids; special token strings are ordinary text; repeated rows are
handled one by one; other columns pass through unchanged. An id outside the vocabulary makes decoding fail.
"""

from __future__ import annotations

import base64
import heapq
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from peakloom.llm.columns import without
from peakloom.llm.words import bound_batches, releasing

BLOCK_CHARS = 2 << 20
KNOWN_PIECES = 100_000
LATIN_END = 0x250


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one line per token, base64 of its bytes and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _latin_class(kind: str) -> str:
    """Characters below ``LATIN_END`` whose category begins with ``kind``, as ranges of a character class."""
    members = [c for c in range(LATIN_END) if unicodedata.category(chr(c)).startswith(kind)]
    starts = [c for c in members if c - 1 not in members]
    ends = [c for c in members if c + 1 not in members]
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in zip(starts, ends, strict=True))


class Splitter:
    """Cuts texts by a tokenizer pattern.

    Python's own ``re`` is twice as fast as ``regex`` but has no categories. For texts below ``LATIN_END`` the
    categories are written out as ranges, which is the same there.
    """

    def __init__(self, pattern: str):
        self.pieces = regex.compile(pattern).findall
        latin = pattern
        for name, members in (
            (r"\p{L}", _latin_class("L")),
            (r"\p{N}", _latin_class("N")),
            (r"\s", r"\t-\r \x85\xa0"),
        ):
            inside = re.compile(r"\[[^\]]*\]")
            latin = inside.sub(lambda m, n=name, x=members: m[0].replace(n, x), latin).replace(name, f"[{members}]")
        latin = latin.replace(r"\S", r"[^\t-\r \x85\xa0]")
        self.latin = re.compile(latin).findall if not re.search(r"\\[pPwWdDbB]", latin) else self.pieces
        self.beyond = re.compile(f"[\\U{LATIN_END:08x}-\\U0010ffff]").search

    def __call__(self, text: str) -> list[str]:
        return (self.pieces if self.beyond(text) else self.latin)(text)


class Replay:
    """Ranks of a vocabulary, applied to blocks of pieces."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.base = max(ranks.values(), default=0) + 1
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.base + right] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.made = np.array([pairs[k] for k in self.keys.tolist()] + [-1], np.int32)
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.length = np.zeros(self.base, np.int32)
        for token, rank in ranks.items():
            self.length[rank] = len(token)
        self.bytes_made = self._made(np.repeat(self.bytes, 256), np.tile(self.bytes, 256))

    def _made(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of the token that two tokens make together, -1 for none."""
        keys = left.astype(np.int64) * self.base + right
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == keys, self.made[at], -1) if len(self.keys) else np.full(len(keys), -1)

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian 32-bit integers, by one replay over all of them."""
        out: list[bytes] = [b""] * len(pieces)
        rest: list[int] = []
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif piece:
                rest.append(i)
        if rest:
            ids, bounds, own = self._merge([pieces[i] for i in rest])
            data = ids.astype("<u4").tobytes()
            for number, (i, start, stop) in enumerate(zip(rest, bounds[:-1], bounds[1:], strict=True)):
                out[i] = own[number] if number in own else data[4 * start : 4 * stop]
        return out

    def _merge(self, pieces: list[bytes]) -> tuple[np.ndarray, list[int], dict[int, bytes]]:
        """Ids of all pieces, where each piece's begin, and the ids of pieces that went another way.

        Place i holds the token whose first byte is byte i; ``size`` is its length, 0 where no token begins and
        at the byte after each piece, over which no pair reaches. ``start`` leads from a token's last byte back
        to its place.
        """
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        begin = np.concatenate([[0], np.cumsum(lengths + 1)])
        text = np.frombuffer(b"\0".join(pieces) + b"\0\0", np.uint8).astype(np.int32)
        ids = self.bytes[text]
        size = np.ones(len(text), np.int32)
        size[begin[1:] - 1] = 0
        size[-1] = 0
        start = np.arange(len(text), dtype=np.int32)
        length, made = self.length, self._made
        first = self.bytes_made[text[:-1] * 256 + text[1:]]
        places = np.flatnonzero((first >= 0) & (size[:-1] > 0) & (size[1:] > 0)).astype(np.int32)
        ranks = first[places]
        order = np.argsort(ranks, kind="stable")
        places, ranks = places[order], ranks[order]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        index: dict[int, list[np.ndarray]] = {}
        for rank, part in zip(ranks[np.concatenate([[0], cuts])].tolist() if len(ranks) else [], np.split(places, cuts), strict=False):
            index[rank] = [part]
        queue = list(index)
        heapq.heapify(queue)
        own: dict[int, bytes] = {}

        def leave(at: np.ndarray) -> None:
            for number in set((np.searchsorted(begin, at, side="right") - 1).tolist()):
                own[number] = self._alone(pieces[number])
                size[begin[number] : begin[number + 1]] = 0

        def enter(at: np.ndarray, new: np.ndarray) -> None:
            some = new >= 0
            if not some.any():
                return
            at, new = at[some], new[some]
            if len(at) > 1:
                order = np.argsort(new, kind="stable")
                at, new = at[order], new[order]
            cuts = np.flatnonzero(new[1:] != new[:-1]) + 1
            edges = [0, *cuts.tolist(), len(at)]
            for a, b in zip(edges, edges[1:], strict=False):
                rank = int(new[a])
                if rank in index:
                    index[rank].append(at[a:b])
                else:
                    index[rank] = [at[a:b]]
                    heapq.heappush(queue, rank)

        while queue:
            rank = heapq.heappop(queue)
            parts = index.pop(rank)
            at = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            full = int(length[rank])
            left = size[at]
            right = size[at + left]
            valid = (left > 0) & (right > 0) & (left + right == full)
            if not valid.all():
                at, left = at[valid], left[valid]
                if not len(at):
                    continue
            if len(at) > 1:
                chained = at[:-1] + left[:-1] == at[1:]
                if chained.any():  # overlapping pairs: the first, third, ... of a row of them
                    number = np.arange(len(at))
                    head = np.maximum.accumulate(np.where(np.concatenate([[True], ~chained]), number, 0))
                    keep = (number - head) % 2 == 0
                    at, left = at[keep], left[keep]
                beside = at[:-1] + full == at[1:]
                if beside.any():
                    follower = ids[at[1:][beside]]
                    new = made(np.full(len(follower), rank), follower)
                    broken = (new >= 0) & (new <= rank)
                    if broken.any():
                        leave(at[1:][beside][broken])
                        alive = size[at] > 0
                        at, left = at[alive], left[alive]
            size[at + left] = 0
            size[at] = full
            ids[at] = rank
            start[at + full - 1] = at
            after = at + full
            to_right = size[after] > 0
            right_at, right_new = at[to_right], made(np.full(int(to_right.sum()), rank), ids[after[to_right]])
            previous = start[at - 1]
            to_left = (at > 0) & (size[previous] > 0) & (previous + size[previous] == at)
            previous = previous[to_left]
            left_new = made(ids[previous], np.full(len(previous), rank))
            broken = [a[(n >= 0) & (n <= rank)] for a, n in ((right_at, right_new), (previous, left_new))]
            if len(broken[0]) or len(broken[1]):
                leave(np.concatenate(broken))
            enter(right_at, right_new)
            enter(previous, left_new)
        alive = size > 0
        counts = np.concatenate([[0], np.cumsum(alive)])[begin]
        return ids[alive], counts.tolist(), own

    def _alone(self, piece: bytes) -> bytes:
        """Ids of one piece, lowest rank first, leftmost first.

        For the rare piece in which a merge brings up a pair of a lower rank than its own, which a replay in
        rank order has passed.
        """
        tokens = [piece[i : i + 1] for i in range(len(piece))]
        while True:
            best = min(
                ((self.ranks[a + b], i) for i, (a, b) in enumerate(zip(tokens, tokens[1:], strict=False)) if a + b in self.ranks),
                default=None,
            )
            if best is None:
                return b"".join(self.ranks[t].to_bytes(4, "little") for t in tokens)
            tokens[best[1] : best[1] + 2] = [tokens[best[1]] + tokens[best[1] + 1]]


class Encoder:
    """Ids of texts, as little-endian 32-bit integers."""

    def __init__(self, path: str, pattern: str):
        self.replay = Replay(read_ranks(path))
        self.split = Splitter(pattern)
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        block: list[list[str]] = []
        size = 0
        for text in texts:
            block.append(self.split(text))
            size += len(text)
            if size >= BLOCK_CHARS:
                out += self._block(block)
                block, size = [], 0
        return out + self._block(block)

    def _block(self, block: list[list[str]]) -> list[bytes]:
        if len(self.known) > KNOWN_PIECES:
            self.known.clear()
        new = list(set().union(*block).difference(self.known)) if block else []
        for piece, ids in zip(new, self.replay.encode([p.encode() for p in new]), strict=True):
            self.known[piece] = ids
        known = self.known.__getitem__
        return [b"".join(map(known, pieces)) for pieces in block]


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """One encoder per Python worker and vocabulary."""
    return Encoder(path, pattern)


def encode(
    docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", decoded: str | None = None
) -> DataFrame:
    """``docs`` with a column of token ids as little-endian unsigned 32-bit integers.

    ``path`` is a rank file at the same place on every machine. ``decoded`` names a further column for the bytes
    that the ids stand for, decoded in the same pass. Columns called like the new ones, in whatever case, are replaced.
    """
    bound_batches(docs.sparkSession)
    names = [ids] if decoded is None else [ids, decoded]
    docs = without(docs, *names)
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, T.BinaryType()) for n in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, 512):
                    part = batch.slice(at, 512)
                    found = own.encode([t or "" for t in part.column(text).to_pylist()])
                    new = [pa.array(found, pa.binary())]
                    if decoded is not None:
                        new.append(pa.array([_bytes_of(x, own.replay.tokens) for x in found], pa.binary()))
                    yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*batch.schema.names, *names])
        finally:  # the worker process stays, with what it holds, while other stages run
            own.known = {}

    return docs.mapInArrow(releasing(run), schema)


def _bytes_of(ids: bytes, tokens: dict[int, bytes]) -> bytes:
    return b"".join(map(tokens.__getitem__, memoryview(ids).cast("I")))


def decode(encoded: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes that the ids stand for; a column called ``decoded``, in whatever case, is replaced."""
    bound_batches(encoded.sparkSession)
    encoded = without(encoded, decoded)
    schema = T.StructType([*encoded.schema.fields, T.StructField(decoded, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(path)
        for batch in batches:
            found = [
                None if one is None else _bytes_of(one, tokens)
                for one in (x.as_py() for x in batch.column(ids))
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], names=[*batch.schema.names, decoded])

    return encoded.mapInArrow(releasing(run), schema)


@lru_cache(maxsize=2)
def _tokens(path: str) -> dict[int, bytes]:
    return {rank: token for token, rank in read_ranks(path).items()}
