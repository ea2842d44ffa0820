"""Fill-in-the-middle texts: prefix, suffix and middle of a text, each behind its sentinel.

A text is cut into units, code points from the left. Two cut places and the form follow from the hash of
seed and id, so every run agrees. Forms: ``plain`` is the text itself; ``psm`` is prefix, suffix, middle;
``spm`` is suffix, prefix, middle. Empty texts and texts that hold a sentinel stay plain, so a sentinel
in an output always is one, and ``restore`` rebuilds each text from output and form alone.

The work is a pipeline of Arrow kernels per batch: texts become lists of units, the lists are flattened
with the indices of their parents, a unit's ordinal is its place less its parent's start, filters by role
leave the units of prefix, suffix and middle, lists are rebuilt from the parents' counts, and ``binary_join``
makes a piece of each. Long texts go through it in blocks of bounded size, each knowing the ordinal of its first
unit; the pieces of a text's blocks are joined once more. Memory of a batch is bounded by ``SLICE_BYTES`` of text and by
its longest single text.

Edge cases: a null text is empty. A null id is hashed as the empty string. Repeated rows give equal rows. Texts are used
whole. Empty tables give empty results. Extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from gaugework.llm.common import arrow_type, slices

#: The sentinels before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Percent of the texts that are transformed, and of those the percent in the form spm.
RATE, SPM_RATE = 90, 20
SLICE_BYTES = 1 << 20


def drawn(id_: Column, seed: int, place: int) -> Column:
    """The ``place``-th group of eight hex digits of SHA-256 of ``seed:id``, as a number."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * place + 1, 8), 16, 10).cast("long")


def _blocks(texts: pa.Array, limit: int) -> tuple[pa.ListArray, np.ndarray]:
    """Lists of the code points of the texts, in blocks of about ``limit`` bytes, and the text each block is of."""
    if texts.offset:
        texts = pa.concat_arrays([texts])
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=width, count=len(texts) + 1).astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8, count=ends[-1]) if data is not None and ends[-1] else np.zeros(0, np.uint8)
    raw = raw[ends[0]:]
    ends = ends - ends[0]
    starts = np.flatnonzero((raw & 0xC0) != 0x80)  # the first byte of every code point
    units = pa.Array.from_buffers(pa.string(), len(starts), [
        None, pa.py_buffer(np.append(starts, len(raw)).astype(np.int32)), pa.py_buffer(raw)])
    bounds = np.searchsorted(starts, ends)  # texts in units
    cuts = [np.arange(a, b, limit) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
    owner = np.repeat(np.arange(len(texts)), [len(c) for c in cuts])
    first = np.concatenate([*cuts, bounds[-1:]]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(first), units), owner


def _joined(parents: pa.Array, units: pa.Array, n: int) -> pa.Array:
    """The units of each of ``n`` parents, which are in order, as one string; empty for parents without any."""
    counts = np.bincount(parents.to_numpy(), minlength=n)
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), units), "")


def pieces(texts: pa.Array, low: np.ndarray, high: np.ndarray, limit: int = SLICE_BYTES) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Prefix, middle and suffix of each text (no nulls): the units before ``low``, up to ``high``, and after."""
    lists, owner = _blocks(texts, limit)
    found: list[list[pa.Array]] = [[], [], []]
    sizes = pc.list_value_length(lists).to_numpy().astype(np.int64)
    ends = np.cumsum(sizes)
    # ordinal of a block's first unit in its text
    of_text = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if len(owner) else np.zeros(0, np.int64)
    before = ends - sizes
    base = before - np.repeat(before[of_text], np.diff(np.append(of_text, len(owner)))) if len(owner) else before
    at = 0
    while at < len(owner):  # runs of blocks of about ``limit`` units, one block at least
        stop = max(at + 1, int(np.searchsorted(ends, before[at] + limit, side="right")))
        part = lists.slice(at, stop - at)
        units, parent = pc.list_flatten(part), pc.list_parent_indices(part)
        start = pa.array(before[at:stop] - before[at] - base[at:stop])
        ordinal = pc.subtract(pa.array(np.arange(len(units))), pc.take(start, parent))
        text = pa.array(owner[at:stop])
        lower = pc.take(pa.array(low), pc.take(text, parent))
        upper = pc.take(pa.array(high), pc.take(text, parent))
        in_prefix, in_suffix = pc.less(ordinal, lower), pc.greater_equal(ordinal, upper)
        for held, role in zip(found, (in_prefix, pc.and_not(pc.invert(in_prefix), in_suffix), pc.and_not(in_suffix, in_prefix))):
            held.append(_joined(pc.filter(parent, role), pc.filter(units, role), stop - at))
        at = stop
    out = []
    for held in found:
        whole = pa.concat_arrays(held) if held else pa.array([], pa.string())
        out.append(_joined(pa.array(owner), whole, len(texts)))
    return tuple(out)


def _cut(batch: pa.RecordBatch, rate: int, spm_rate: int) -> pa.RecordBatch:
    texts = pc.fill_null(batch.column("text"), "").cast(pa.string())
    n = pc.utf8_length(texts).to_numpy().astype(np.int64)
    h1, h2, h3, h4 = (batch.column(f"h{i}").to_numpy() for i in (1, 2, 3, 4))
    cut = np.sort(np.stack((h1 % (n + 1), h2 % (n + 1))), axis=0)
    low, high = cut[0], cut[1]
    prefix, middle, suffix = pieces(texts, low, high)
    held = pc.or_(pc.or_(pc.match_substring(texts, PREFIX), pc.match_substring(texts, SUFFIX)), pc.match_substring(texts, MIDDLE))
    plain = pc.or_(held, pa.array((n == 0) | (h3 % 100 >= rate)))
    spm = pa.array(h4 % 100 < spm_rate)
    one = pc.binary_join_element_wise(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle, "")
    other = pc.binary_join_element_wise(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle, "")
    form = pc.if_else(plain, PLAIN, pc.if_else(spm, SPM, PSM))
    none = pa.scalar(None, pa.int64())
    return pa.RecordBatch.from_arrays([
        batch.column("id"), pa.array(n), form, pc.if_else(plain, none, pa.array(low)), pc.if_else(plain, none, pa.array(high - low)),
        pc.if_else(plain, texts, pc.if_else(spm, other, one)),
    ], names=["id", "n", "form", "prefix_chars", "middle_chars", "output"])


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: int = RATE, spm_rate: int = SPM_RATE, seed: int = 1) -> DataFrame:
    """One row per input row: id, n (units), form, prefix_chars and middle_chars (null if plain), output."""
    id_ = F.col(id_col)
    named = docs.select(id_.alias("id"), F.col(text_col).alias("text"), *(drawn(id_, seed, i).alias(f"h{i + 1}") for i in range(4)))
    assert arrow_type(named, "id") is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE_BYTES):
            yield _cut(part, rate, spm_rate)

    long = T.LongType()
    return named.mapInArrow(run, T.StructType([
        named.schema["id"], T.StructField("n", long), T.StructField("form", T.StringType()), T.StructField("prefix_chars", long),
        T.StructField("middle_chars", long), T.StructField("output", T.StringType())]))


def restored(output: pa.Array, form: pa.Array) -> pa.Array:
    """The text of each output: sentinels occur in transformed outputs exactly once each."""
    plain = pc.equal(form, PLAIN)
    rows = pc.filter(output, pc.invert(plain))
    spm = pc.equal(pc.filter(form, pc.invert(plain)), SPM)
    head = pc.utf8_slice_codeunits(rows, len(PREFIX))
    # after the first sentinel: psm is prefix <S> suffix <M> middle, spm is suffix <P> prefix <M> middle
    head = pc.split_pattern(pc.if_else(spm, pc.replace_substring(head, PREFIX, SUFFIX, max_replacements=1), head), SUFFIX)
    tail = pc.split_pattern(pc.list_element(head, 1), MIDDLE)
    first, second, middle = pc.list_element(head, 0), pc.list_element(tail, 0), pc.list_element(tail, 1)
    whole = pc.binary_join_element_wise(pc.if_else(spm, second, first), middle, pc.if_else(spm, first, second), "")
    return pc.replace_with_mask(output, pc.invert(plain), whole)


def restore(outputs: DataFrame) -> DataFrame:
    """``outputs`` (with output and form) and ``restored``, the text of each row."""
    out = T.StructType([*outputs.schema.fields, T.StructField("restored", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "output", SLICE_BYTES):
            text = restored(part.column("output").cast(pa.string()), part.column("form").cast(pa.string()))
            yield pa.RecordBatch.from_arrays([*part.columns, text], names=[*part.schema.names, "restored"])

    return outputs.mapInArrow(run, out)
