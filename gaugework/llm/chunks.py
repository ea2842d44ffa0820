"""Encoding texts through a memo of the chunks between single spaces.

The split pattern of byte-level vocabularies never lets a piece run over a space that stands
between two characters that are not white space: the piece before it ends there and the next one
starts with the space. A text may therefore be cut before each such space, and what follows
depends on the chunk alone. Chunks repeat often: the distinct ones of a batch are found by Arrow,
looked up in a memo that the tasks of a worker share, and only new ones are encoded. Texts with other
runs of white space beside a space, or with a space at the end, are encoded whole.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space in any of the definitions that tokenizers use.
_SPACE = r"\x09-\x0d\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_RUN = rf"[{_SPACE}] | [{_SPACE}]| $"
MAX_MEMO = 150_000

EncodeNew = Callable[[list[str]], Sequence[bytes]]


class ChunkMemo:
    """``encode(texts)`` gives the ids of each text as packed little-endian 32-bit integers.

    ``whole`` and ``after_space`` encode distinct strings, the latter chunks with a space before
    each. The memo has two generations of ``max_memo`` entries: a full one replaces the one before
    it, and what is used again moves over, so memory does not grow with the input.
    """

    def __init__(self, whole: EncodeNew, after_space: EncodeNew, max_memo: int = MAX_MEMO):
        self.whole, self.after_space, self.max_memo = whole, after_space, max_memo
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def forget(self) -> None:
        """Give the memory back, for what the worker does next."""
        self.recent, self.older = {}, {}

    def look_up(self, chunks: list[str]) -> list[bytes]:
        if len(self.recent) > self.max_memo:
            self.recent, self.older = {}, self.recent
        recent = self.recent
        found = list(map(recent.get, chunks))
        missing = [c for c, f in zip(chunks, found, strict=True) if f is None]
        older = list(map(self.older.get, missing))
        new = [c for c, f in zip(missing, older, strict=True) if f is None]
        made = iter(self.after_space(new))
        older = [next(made) if f is None else f for f in older]
        recent.update(zip(missing, older, strict=True))
        rest = iter(older)
        return [next(rest) if f is None else f for f in found]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """``texts`` has no nulls."""
        runs = pc.match_substring_regex(texts, _RUN)
        split = pc.split_pattern(texts.filter(pc.invert(runs)), " ")
        cut = iter(self._join(split) if len(split) else [])
        kept = iter(self.whole(texts.filter(runs).to_pylist()))
        return [next(kept) if r else next(cut) for r in runs.to_pylist()]

    def _join(self, split: pa.ListArray) -> list[bytes]:
        offsets = split.offsets.to_numpy().astype(np.int64)
        offsets, values = offsets - offsets[0], split.flatten()
        distinct = values.dictionary_encode()
        heads = self.whole(values.take(pa.array(offsets[:-1])).to_pylist())
        entries = [*self.look_up(distinct.dictionary.to_pylist()), *heads]
        code = distinct.indices.to_numpy().copy()
        code[offsets[:-1]] = np.arange(len(heads)) + len(distinct.dictionary)
        ids = np.frombuffer(b"".join(entries), dtype="<u4")
        size = np.fromiter(map(len, entries), np.int32, len(entries)) >> 2
        start = np.cumsum(size) - size
        n = size.take(code)
        ends = np.cumsum(n)
        kind = np.int32 if ends[-1] < 1 << 31 else np.int64
        place = np.repeat((start.take(code) - (ends - n)).astype(kind), n)
        place += np.arange(len(place), dtype=kind)
        packed = ids.take(place).tobytes()
        last = (ends[offsets[1:] - 1] * 4).tolist()
        return list(map(packed.__getitem__, map(slice, [0, *last[:-1]], last)))
