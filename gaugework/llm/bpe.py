"""Byte-level BPE encoding with a segment tree over byte positions, and decoding.

The ids of a piece come from repeatedly merging the leftmost pair of lowest rank. A segment tree
over the byte positions of the piece holds at each leaf the rank of the pair that starts there and
at each inner node the smaller child, ordered by (rank, position), so the root is the leftmost
minimum. A merge changes the pairs at the live neighbours on either side and retires the merged
position: three point updates of logarithmic cost. Pieces of similar length are processed side by
side, one tree per row of an array; a long piece with few others of its length gets a tree of plain Python arrays.

Edge cases: null texts count as empty and give no ids; texts of any length are encoded whole (a
piece of n bytes takes n log n steps); ids of repeated rows are equal; an empty table gives an
empty result. Ids outside the vocabulary cannot be decoded and raise.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from gaugework.llm.chunks import ChunkMemo
from gaugework.llm.common import arrow_type, slices

NONE = np.int64(1) << 40
#: Bytes of pieces in one array of trees.
BLOCK_BYTES = 1 << 17
#: Pieces of at least so many bytes, and fewer than so many of a length, are merged one by one.
LONE_BYTES, LONE_PIECES = 1 << 11, 32
#: Bytes of texts encoded in one step.
SLICE_BYTES = 2 << 20


def read_ranks(path: str) -> bytes:
    """The lines of a rank file: a token in base 64 and its rank."""
    with open(path, "rb") as f:
        return f.read()


def parsed(lines: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines())}


class Vocabulary:
    """Ranks of tokens, and the rank that each pair of tokens merges into."""

    def __init__(self, lines: bytes):
        self.ranks = ranks = parsed(lines)
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.merged = np.array([pairs[k] for k in self.keys.tolist()], dtype=np.int64)

    @cached_property
    def pairs(self) -> dict[int, int]:
        return dict(zip(self.keys.tolist(), self.merged.tolist()))

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.merged[at], NONE)


class Trees:
    """Segment trees of ``size`` leaves for pieces of at most ``size`` bytes, one per row."""

    def __init__(self, vocabulary: Vocabulary, pieces: list[bytes], size: int):
        n = len(pieces)
        self.vocabulary, self.size = vocabulary, size
        lengths = np.fromiter(map(len, pieces), np.int64, n)
        places = np.arange(size)
        self.live = places < lengths[:, None]
        self.ids = np.zeros((n, size), dtype=np.int64)
        self.ids[self.live] = vocabulary.of_byte[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        self.next = np.minimum(np.broadcast_to(places + 1, (n, size)), lengths[:, None]).copy()
        self.prev = np.broadcast_to(places - 1, (n, size)).copy()
        self.lengths = lengths
        self.nodes = np.full((n, 2 * size), NONE * size, dtype=np.int64)
        pair = np.full((n, size), NONE, dtype=np.int64)
        both = self.live[:, 1:]
        pair[:, :-1][both] = vocabulary.pair_ranks(self.ids[:, :-1][both], self.ids[:, 1:][both])
        self.nodes[:, size:] = np.where(pair < NONE, pair * size + places, NONE * size)
        width = size
        while width > 1:
            level = self.nodes[:, width:2 * width]
            width //= 2
            self.nodes[:, width:2 * width] = np.minimum(level[:, 0::2], level[:, 1::2])

    def update(self, rows: np.ndarray, places: np.ndarray, ranks: np.ndarray) -> None:
        """Set leaves and renew the nodes above them."""
        node = places + self.size
        self.nodes[rows, node] = np.where(ranks < NONE, ranks * self.size + places, NONE * self.size)
        while len(node) and node[0] > 1:
            node = node >> 1
            self.nodes[rows, node] = np.minimum(self.nodes[rows, 2 * node], self.nodes[rows, 2 * node + 1])

    def pair_at(self, rows: np.ndarray, places: np.ndarray) -> np.ndarray:
        after = self.next[rows, places]
        there = after < self.lengths[rows]
        ranks = np.full(len(rows), NONE, dtype=np.int64)
        r, p, a = rows[there], places[there], after[there]
        ranks[there] = self.vocabulary.pair_ranks(self.ids[r, p], self.ids[r, a])
        return ranks

    def merge_all(self) -> None:
        rows = np.arange(len(self.ids))
        while True:
            root = self.nodes[rows, 1]
            open_ = root < NONE * self.size
            rows, root = rows[open_], root[open_]
            if not len(rows):
                return
            place = root % self.size
            self.ids[rows, place] = root // self.size
            gone = self.next[rows, place]
            after = self.next[rows, gone]
            self.next[rows, place] = after
            linked = after < self.lengths[rows]
            self.prev[rows[linked], after[linked]] = place[linked]
            self.live[rows, gone] = False
            self.update(rows, gone, np.full(len(rows), NONE))
            self.update(rows, place, self.pair_at(rows, place))
            before = self.prev[rows, place]
            has = before >= 0
            self.update(rows[has], before[has], self.pair_at(rows[has], before[has]))


class LoneTree:
    """The tree of one piece in plain arrays of Python: a single step costs less there than in numpy. 40 bytes a leaf."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes, size: int):
        trees = Trees(vocabulary, [piece], size)
        self.n, self.size, self.none, self.pairs = len(piece), size, int(NONE) * size, vocabulary.pairs
        self.nodes, self.ids, self.next, self.prev = (array("q", x[0].tobytes()) for x in (trees.nodes, trees.ids, trees.next, trees.prev))

    def set(self, place: int, value: int) -> None:
        nodes, node = self.nodes, place + self.size
        nodes[node] = value
        node >>= 1
        while node:
            left, right = nodes[2 * node], nodes[2 * node + 1]
            smaller = left if left < right else right
            if nodes[node] == smaller:
                return  # nothing above changes
            nodes[node] = smaller
            node >>= 1

    def pair_at(self, place: int) -> int:
        after = self.next[place]
        rank = self.pairs.get(self.ids[place] << 32 | self.ids[after]) if after < self.n else None
        return self.none if rank is None else rank * self.size + place

    def merged(self) -> bytes:
        """Packed ids after all merges."""
        root = self.nodes[1]
        while root < self.none:
            rank, place = divmod(root, self.size)
            self.ids[place] = rank
            gone = self.next[place]
            after = self.next[place] = self.next[gone]
            if after < self.n:
                self.prev[after] = place
            self.set(gone, self.none)
            self.set(place, self.pair_at(place))
            before = self.prev[place]
            if before >= 0:
                self.set(before, self.pair_at(before))
            root = self.nodes[1]
        out, place = array("q"), 0
        while place < self.n:
            out.append(self.ids[place])
            place = self.next[place]
        return np.array(out, dtype="<u4").tobytes()


class Encoder:
    def __init__(self, lines: bytes, pattern: str):
        self.vocabulary = Vocabulary(lines)
        # white space as Unicode defines it, which is what the rank files were made with
        self.pattern = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.memo = ChunkMemo(self.encode_strings, lambda chunks: self.encode_strings([" " + c for c in chunks]))

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of each piece."""
        found: dict[bytes, bytes] = {}
        by_size: dict[int, list[bytes]] = {}
        for piece in dict.fromkeys(pieces):
            rank = self.vocabulary.ranks.get(piece)
            if rank is not None:
                found[piece] = rank.to_bytes(4, "little")
            else:
                by_size.setdefault(1 << (len(piece) - 1).bit_length(), []).append(piece)
        for size, group in by_size.items():
            if size >= LONE_BYTES and len(group) < LONE_PIECES:
                found.update((piece, LoneTree(self.vocabulary, piece, size).merged()) for piece in group)
                continue
            step = max(1, BLOCK_BYTES // size)
            for i in range(0, len(group), step):
                part = group[i:i + step]
                trees = Trees(self.vocabulary, part, size)
                trees.merge_all()
                packed = trees.ids[trees.live].astype("<u4").tobytes()
                ends = np.cumsum(trees.live.sum(axis=1) * 4).tolist()
                found.update(zip(part, map(packed.__getitem__, map(slice, [0, *ends[:-1]], ends)), strict=True))
        return [found[p] for p in pieces]

    def encode_strings(self, strings: list[str]) -> list[bytes]:
        split = [[p.encode() for p in self.pattern.findall(s)] for s in strings]
        flat = iter(self.encode_pieces([p for pieces in split for p in pieces]))
        return [b"".join([next(flat) for _ in pieces]) for pieces in split]

    def encode(self, texts: pa.Array) -> list[bytes]:
        return self.memo.encode(texts)


@lru_cache(maxsize=2)
def encoder(lines: bytes, pattern: str) -> Encoder:
    """One per worker process and vocabulary."""
    return Encoder(lines, pattern)


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id and ids, the packed little-endian unsigned 32-bit token ids."""
    lines = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    named = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = pa.schema([("id", arrow_type(named, "id")), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(lines.value, pattern)
        for part in slices(batches, "text", SLICE_BYTES):
            ids = own.encode(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(ids, pa.binary())], schema=schema)
        own.memo.forget()

    out = T.StructType([named.schema["id"], T.StructField("ids", T.BinaryType())])
    return named.mapInArrow(run, out)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``decode(encode(...))`` in one Python process a task instead of two: id, ids and the bytes decoded from those ids.

    Spark keeps a worker for every process that a task needs at once, through all later stages too.
    """
    lines = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    named = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = pa.schema([("id", arrow_type(named, "id")), ("ids", pa.binary()), ("decoded", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(lines.value, pattern)
        token = {rank: token for token, rank in own.vocabulary.ranks.items()}.__getitem__
        for part in slices(batches, "text", SLICE_BYTES):
            ids = own.encode(part.column("text"))
            decoded = [_decoded(x, token) for x in ids]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())], schema=schema)
        own.memo.forget()

    out = T.StructType([named.schema["id"], T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())])
    return named.mapInArrow(run, out)


def _decoded(ids: bytes | None, token: Callable[[int], bytes]) -> bytes:
    return b"".join(map(token, np.frombuffer(ids or b"", dtype="<u4").tolist()))


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` with a column ``decoded``: the bytes of its column ``ids``."""
    lines = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    named = encoded.select("id", "ids")
    schema = pa.schema([("id", arrow_type(named, "id")), ("ids", pa.binary()), ("decoded", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {rank: token for token, rank in parsed(lines.value).items()}.__getitem__
        for part in slices(batches, "ids", SLICE_BYTES):
            decoded = [_decoded(x, token) for x in part.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("ids").cast(pa.binary()), pa.array(decoded, pa.binary())], schema=schema)

    out = T.StructType([*named.schema.fields, T.StructField("decoded", T.BinaryType())])
    return named.mapInArrow(run, out)
