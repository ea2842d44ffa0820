"""Interpolated modified Kneser-Ney models of word trigrams, in tasks over buckets of n-grams.

Words are lower-cased runs of letters and digits, single characters of scripts written without spaces, and
single other characters that are not white space; each is a 64-bit hash, made by array operations over the characters of many texts. Two start words stand
before every text and one end word after it. Trigrams are counted over all texts, bigrams and words are continuation
counts of the order above, and the word of the lowest order falls back to one of V + 1 equal words.

There are two models, of the texts of half 0 and of half 1, and a text is scored by the model of the other half, so
no text is scored by what it taught. The lowest bit of a word's hash names the model: one chain of
tables trains both, and an n-gram's key belongs to one of them.

What moves between tasks are arrays, packed by the bucket they go to, so that Spark's rows are few. A trigram goes to the bucket of its last two words,
which knows all that is to know of that bigram; the buckets are as many as keep each at some 10**5 to 10**6 trigrams. Trigrams are
counted in ``PASSES`` passes over the texts, each for a share of the buckets. A bucket tells the buckets of words what it has of each
word, and is told the sums. With them it has, in as many passes, the probabilities of its bigrams; these go with the trigrams to the bucket of the first two words, where
contexts are summed and weights made, in ``SHARDS`` shards of buckets. Tables and shuffles are given up as soon as nothing reads them again.

With backed-off probabilities the log probability of a text is a sum over
its n-grams alone: ``unseen`` for every position, and for every n-gram of the model what it adds as the
end of a position and as the context of the next one. The table of these weights is keyed by the hash of the
n-gram. Most n-grams of a model occur in no text that it scores, and most
of a text are in no model; two bitmaps keep both out. One of all n-grams of the models is laid over the texts, asked for longer n-grams only
where their parts are known; what it lets through makes the second, and only n-grams in that get weights. Some ``HOT_KEYS`` of the most frequent ones are added inside
the scan; the rest meet the weights in buckets of keys, in ``ROUNDS`` rounds, and go back as sums per text. Only counts of counts, the frequent weights and the
bitmaps reach the driver. The first has some eight places per n-gram, up to ``MAP_BITS``, the second half of them: with more than some
10**8 n-grams they let more through, never fewer.

Edge cases: null and empty texts have no n-grams and no score. Equal texts are counted as often as they
occur and scored once. Texts of any length are taken whole; a step holds one slice of texts. Without trained n-grams there is no model.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gaugework.llm.common import delete, give_back, grouped, lean, slices, written
from gaugework.session import new_table_path

_SINGLE = "฀-໿က-႟ក-៿぀-ヿ㐀-䶿一-鿿豈-﫿\U00020000-\U0003ffff"
WORD = re.compile(rf"[{_SINGLE}]|[^\W{_SINGLE}]+|[^\w\s]")
#: Stand for the start and end words; no text holds half a surrogate pair.
_BEGIN, _FINISH = "\ud800", "\udfff"
#: Places for n-grams whose weights are added in the scan.
HOT_KEYS = 1 << 20
#: Binary logarithm of the bitmap's places at least and at most: 32 MB.
MAP_BITS = (20, 28)
#: Passes that count trigrams, shards that make weights, rounds in which texts meet the weights.
PASSES, SHARDS, ROUNDS = 3, 4, 3
#: Trigrams of a bucket while there are few buckets, then; how many are few; weights of a bucket of keys.
BUCKET_ROWS, FULL_ROWS, FEW, KEY_ROWS = 1 << 19, 1 << 20, 1024, 1 << 20
#: Numbers that a task gathers before it sends them.
GATHERED = 1 << 20
_CHUNK_BITS = 16
SLICE_BYTES = 1 << 19
#: Bytes of a row between tasks at most. Rows of a few megabytes are wanted: with them the JVM's collector gives memory back sooner.
ROW_BYTES = 1 << 26
#: Characters hashed at a time, or up to the end of a word.
STEP = 1 << 16

_M1, _M2, _M3, _M4, _M5, _M6, _M7 = (np.uint64(p) for p in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))


def pair(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Keys of bigrams; the hashes of words are mixed already. The lowest bit is the model, as in all keys."""
    return v * _M1 + w * _M2 | (v & np.uint64(1))


def triple(u: np.ndarray, v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return u * _M3 + v * _M4 + w * _M6


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M7
    x = (x ^ (x >> np.uint64(29))) * _M6
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=1)
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: 0 between words, 1 in words, 2 a word by itself; and a random number, 0 between words."""
    kinds = np.zeros(0x110000, np.uint8)
    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    code = lambda i: i if i < 0xD800 else i + 0x800
    for kind, runs in ((1, rf"[^\W{_SINGLE}]+"), (2, rf"[{_SINGLE}]+|[^\w\s]+")):
        for m in re.finditer(runs, everything):
            kinds[code(m.start()):code(m.end() - 1) + 1] = kind
    kinds[[ord(_BEGIN), ord(_FINISH)]] = 2
    return kinds, np.where(kinds > 0, _mixed(np.arange(1, len(kinds) + 1, dtype=np.uint64) * _M1), np.uint64(0))


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    one = np.ones(1, np.uint64)
    return tuple(np.cumprod(np.append(one, np.full(2 * STEP, b, np.uint64)), dtype=np.uint64) for b in (_M5, pow(int(_M5), -1, 1 << 64)))


def _hashed(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words among the characters, and where each begins: polynomials of random numbers of the characters, mixed."""
    kinds, numbers = _characters()
    code = code.astype(np.int64)
    kind = kinds.take(code, mode="clip")  # nothing is clipped; faster than an index
    word, first = kind == 1, kind == 2
    first[:1] |= word[:1]
    first[1:] |= word[1:] > word[:-1]
    at = np.flatnonzero(first)
    if not len(at):
        return np.zeros(0, np.uint64), at
    x = numbers.take(code, mode="clip")
    up, down = _powers()
    if len(code) <= len(up):  # powers count from the first character, and then from the first one of each word
        x *= up[:len(code)]
        return _mixed(np.add.reduceat(x, at) * down[at]), at
    place = np.arange(len(code)) - np.repeat(np.append(0, at), np.diff(np.concatenate(([0], at, [len(code)]))))
    power, base = np.ones(len(code), np.uint64), int(_M5)
    for bit in range(int(place.max()).bit_length()):
        power[(place >> bit) & 1 == 1] *= np.uint64(base)
        base = base * base % (1 << 64)
    return _mixed(np.add.reduceat(x * power, at)), at


def sequence(texts: list[str], models: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of the texts in a row with start and end words, and the text each belongs to; ``models`` has 0 or 1 for each."""
    framed = [f"{_BEGIN}{_BEGIN}{t.lower()}{_FINISH}" for t in texts]
    code = np.frombuffer("".join(framed).encode("utf-32-le", "surrogatepass"), "<u4")
    kinds, found, places, start = _characters()[0], [], [], 0
    while start < len(code):
        end = start + STEP
        while end < len(code):  # a word is not cut
            between = np.flatnonzero(kinds[code[end:end + STEP]] != 1)
            if len(between):
                end += int(between[0])
                break
            end += STEP
        h, at = _hashed(code[start:end])
        found.append(h)
        places.append(at + start)
        start = end
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    ends = np.searchsorted(np.concatenate(places), np.cumsum([len(t) for t in framed]))
    lengths = np.diff(ends, prepend=0)
    flat = np.concatenate(found) & ~np.uint64(1)
    return flat | np.repeat(np.asarray(models).astype(np.uint64), lengths), np.repeat(np.arange(len(texts)), lengths)


def _bucket(key: np.ndarray, bits: int) -> np.ndarray:
    return (key >> np.uint64(64 - bits)).view(np.int64)


def _starts(buckets: int, parts: int, growth: float) -> list[int]:
    """The first bucket of each part, and the end: each part has ``growth`` times the buckets of the one before."""
    shares = np.cumsum(growth ** np.arange(parts))
    return [0, *np.rint(shares / shares[-1] * (1 << buckets)).astype(int).tolist()]


def _passes(buckets: int) -> list[int]:
    """Later passes get less, as the counts of earlier ones are on the disk by then."""
    return _starts(buckets, PASSES, 0.68)


def _rounds(buckets: int) -> list[int]:
    """Later rounds get more, as the weights of earlier ones are gone by then."""
    return _starts(buckets, ROUNDS, 1.2)


def _part(starts: list[int]) -> Column:
    """The part that the bucket ``to`` belongs to."""
    return sum(((F.col("to") >= start).cast("int") for start in starts[1:-1]), F.lit(0))


def _planes(column: np.ndarray) -> bytes:
    """First all lowest bytes, then all second ones and so on: of small or sorted numbers the upper ones compress to little."""
    return column.view(np.uint8).reshape(len(column), column.itemsize).T.tobytes()


def _column(data: bytes, kind: str, n: int, at: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8, n * size, at).reshape(size, n).T).reshape(-1).view(kind)


def _packed(*columns: np.ndarray) -> bytes:
    return b"".join(_planes(c) for c in columns)


def _unpacked(data: bytes, *kinds: str) -> list[np.ndarray]:
    """Columns of one length that were packed one after the other."""
    sizes = [np.dtype(k).itemsize for k in kinds]
    n, at, out = len(data) // sum(sizes), 0, []
    for kind, size in zip(kinds, sizes):
        out.append(_column(data, kind, n, at))
        at += n * size
    return out


def _joined(blobs: list[bytes], *kinds: str) -> list[np.ndarray]:
    parts = [_unpacked(b, *kinds) for b in blobs]
    return [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, k) for k in kinds]


def _new(*columns: np.ndarray) -> np.ndarray:
    """Where rows in order differ from the one before."""
    return np.concatenate((np.ones(min(len(columns[0]), 1), bool), np.logical_or.reduce([c[1:] != c[:-1] for c in columns])))


def _distinct(x: np.ndarray) -> np.ndarray:
    """Sorted; faster than ``np.unique``."""
    x = np.sort(x)
    return x[_new(x)]


def _cut(to: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, start, end) of the runs of a sorted array."""
    first = np.flatnonzero(_new(to))
    yield from zip(to[first].tolist(), first.tolist(), [*first[1:].tolist(), len(to)])


#: Rows between tasks: the bucket, what the data is, where it comes from.
_ROWS = "to long, kind int, of long, data binary"
_SCHEMA = pa.schema([("to", pa.int64()), ("kind", pa.int32()), ("of", pa.int64()), ("data", pa.binary())])
TRIGRAMS, GRAMS, PLACES, WORDS, COUNTS, VOCABULARY, BIGRAMS, CONTEXTS, WEIGHTS, HOT, TEXTS, KEYS = range(12)


def _rows(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*rows)) or [()] * 4, _SCHEMA)], schema=_SCHEMA)


def _sent(held: Iterator[tuple[int, int, int, bytes]]) -> Iterator[pa.RecordBatch]:
    """Rows as batches of some megabytes."""
    rows, size = [], 0
    for row in held:
        rows.append(row)
        size += len(row[3]) + 64
        if size > 4 << 20:
            yield _rows(rows)
            rows, size = [], 0
    if rows:
        yield _rows(rows)
    give_back()


def _dealt(kind: int, of: int, to: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, int, int, bytes]]:
    """Rows of ``ROW_BYTES`` at most for each bucket of ``to``, which is sorted."""
    for value, start, end in _cut(to):
        yield from _split(value, kind, of, *(c[start:end] for c in columns))


def _split(to: int, kind: int, of: int, *columns: np.ndarray) -> Iterator[tuple[int, int, int, bytes]]:
    many = max(ROW_BYTES // sum(c.itemsize for c in columns), 1)
    for at in range(0, len(columns[0]), many):
        yield to, kind, of, _packed(*(c[at:at + many] for c in columns))


def _met(rows: DataFrame, run: Callable, *order: str) -> DataFrame:
    """``run`` over the rows, those of a bucket together."""
    return rows.repartition("to").sortWithinPartitions("to", *order).mapInArrow(run, _ROWS)


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[int, list[tuple[int, bytes]]]]]:
    """Per bucket what came, by kind."""
    for batch in grouped(batches, ["to"]):
        found: dict[int, list[tuple[int, bytes]]] = {}
        for kind, of, data in zip(*(batch.column(c).to_pylist() for c in ("kind", "of", "data"))):
            found.setdefault(kind, []).append((of, data))
        yield batch.column("to")[0].as_py(), found


def _place(key: np.ndarray, bits: int) -> np.ndarray:
    return (key >> np.uint64(64 - bits)).astype(np.uint32)


class _Places:
    """Gathers places of keys, and sends the distinct ones, two bytes each, by the leading bits of the place."""

    def __init__(self, bits: int):
        self.bits, self.held, self.size = bits, [], 0

    def add(self, *keys: np.ndarray) -> Iterator[tuple[int, int, int, bytes]]:
        for k in keys:
            self.held.append(_place(k, self.bits))
            self.size += len(k)
        if self.size > 2 * GATHERED:
            yield from self.rest()

    def rest(self) -> Iterator[tuple[int, int, int, bytes]]:
        if self.size:
            places = _distinct(np.concatenate(self.held))
            low = (places & np.uint32((1 << _CHUNK_BITS) - 1)).astype("<u2")
            yield from _dealt(PLACES, 0, (places >> np.uint32(_CHUNK_BITS)).astype(np.int64), low)
        self.held, self.size = [], 0


def _bitmap(sent: DataFrame, bits: int) -> np.ndarray:
    """The bitmap of sent places: chunks are put together in tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[int, int, int, bytes]]:
            chunk, mark = -1, np.zeros(1 << _CHUNK_BITS, dtype=bool)
            for batch in batches:
                for to, data in zip(batch.column("to").to_pylist(), batch.column("data").to_pylist()):
                    if to != chunk:
                        if chunk >= 0:
                            yield chunk, PLACES, 0, np.packbits(mark, bitorder="little").tobytes()
                        chunk = to
                        mark[:] = False
                    mark[_unpacked(data, "<u2")[0]] = True
            if chunk >= 0:
                yield chunk, PLACES, 0, np.packbits(mark, bitorder="little").tobytes()

        yield from _sent(rows())

    out = np.zeros(1 << (bits - 3), dtype=np.uint8)
    size = 1 << (_CHUNK_BITS - 3)
    with lean(sent.sparkSession):
        found = _met(sent, run).select("to", "data").toArrow()
    for batch in found.to_batches():
        for chunk, marks in zip(batch.column("to").to_pylist(), batch.column("data").to_pylist()):
            out[chunk * size:(chunk + 1) * size] = np.frombuffer(marks, dtype=np.uint8)
    return out.view(np.uint64)


def _known(bitmap: np.ndarray, key: np.ndarray) -> np.ndarray:
    bits = len(bitmap).bit_length() + 5
    place = key >> np.uint64(64 - bits)
    return ((bitmap.take((place >> np.uint64(6)).view(np.int64), mode="clip") >> (place & np.uint64(63))) & np.uint64(1)).astype(bool)


def _lookups(flat: np.ndarray, owner: np.ndarray, bitmap: np.ndarray, least: int = 0, most: int = (1 << 64) - 1) -> tuple[np.ndarray, np.ndarray]:
    """Keys, from ``least`` to ``most``, of the n-grams that the bitmap knows, and the text each is in.

    A bigram is known only if both words are, a trigram only if both bigrams are; start words are contexts alone.
    """
    everything = least == 0 and most == (1 << 64) - 1
    asked = lambda key: (key >= np.uint64(least)) & (key <= np.uint64(most))
    first = _known(bitmap, flat)
    two = np.flatnonzero((owner[1:] == owner[:-1]) & first[1:] & first[:-1])
    h2 = pair(flat[two], flat[two + 1])
    in_two = _known(bitmap, h2)
    two, h2 = two[in_two], h2[in_two]
    three = two[:-1][two[1:] == two[:-1] + 1]
    h3 = triple(flat[three], flat[three + 1], flat[three + 2])
    first[0] = False
    first[1:] &= owner[1:] == owner[:-1]
    if not everything:
        first &= asked(flat)
        here = asked(h2)
        two, h2 = two[here], h2[here]
        here = asked(h3)
        three, h3 = three[here], h3[here]
    in_three = _known(bitmap, h3)
    return np.concatenate((flat[first], h2, h3[in_three])), np.concatenate((owner[first], owner[two], owner[three[in_three]]))


@dataclass
class Counts:
    folder: str
    map: np.ndarray | None  # bitmap of all bigrams and trigrams, until they are trained on
    buckets: int  # binary logarithm of their number
    key_buckets: int  # of the number of buckets of weights


def _log(n: float) -> int:
    return max(round(np.log2(max(n, 1))), 0)


def count(docs: DataFrame) -> Counts:
    """Word trigrams of ``text``, in the model that ``half`` names, by the bucket of their last two words."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(max((2 * size).bit_length(), MAP_BITS[0]), MAP_BITS[1])
    rows = size / 5
    buckets = max(_log(min(max(rows / BUCKET_ROWS, 16), FEW)), _log(rows / FULL_ROWS))
    folder = new_table_path(docs.sparkSession, "kn-words")
    known, starts = np.zeros(1 << (bits - 6), np.uint64), _passes(buckets)

    def texts(batches: Iterator[pa.RecordBatch], part: int) -> Iterator[pa.RecordBatch]:
        def out(held: list[tuple]) -> Iterator[tuple[int, int, int, bytes]]:
            u, v, w = (np.concatenate(x) for x in zip(*held))
            key = triple(u, v, w)
            at = np.argsort(key)
            first = np.flatnonzero(_new(key[at]))
            n = np.diff(np.append(first, len(at))).astype(np.uint32)
            at = at[first]
            key = pair(v[at], w[at])
            order = np.argsort(key)
            at = at[order]
            yield from _dealt(TRIGRAMS, 0, _bucket(key[order], buckets), u[at], v[at], w[at], n[order])

        def found() -> Iterator[tuple[int, int, int, bytes]]:
            held, held_rows = [], 0
            for rows in slices(batches, "text", SLICE_BYTES):
                rows = rows.filter(pa.compute.greater(pa.compute.fill_null(pa.compute.binary_length(rows.column("text")), 0), 0))
                if not rows.num_rows:
                    continue
                flat, owner = sequence(rows.column("text").to_pylist(), rows.column("half").to_numpy())
                mine = owner[2:] == owner[:-2]
                if PASSES > 1:
                    to = _bucket(pair(flat[1:-1], flat[2:]), buckets)
                    mine &= (to >= starts[part]) & (to < starts[part + 1])
                at = np.flatnonzero(mine)
                held.append((flat[at], flat[at + 1], flat[at + 2]))
                held_rows += len(at)
                if held_rows > GATHERED // 2:
                    yield from out(held)
                    held, held_rows = [], 0
            if held:
                yield from out(held)

        yield from _sent(found())

    for part in range(PASSES):
        sent = docs.select("text", "half").mapInArrow(partial(texts, part=part), _ROWS)
        counted = _met(sent, partial(_counted, bits=bits, buckets=buckets))
        written(counted.withColumn("part", F.lit(part)), "kn-words", mode="append", path=folder, by=["kind", "part"])
        known |= _bitmap(_read(docs.sparkSession, folder, PLACES), bits)
        delete(docs.sparkSession, f"{folder}/kind={PLACES}")
    return Counts(folder, known, buckets, _log(max(1.5 * rows / KEY_ROWS, 16)))


def _words_bits(buckets: int) -> int:
    return max(buckets - 1, 4)


def _hist(n: np.ndarray, model: np.ndarray) -> np.ndarray:
    """How many n-grams of each model have counts 1 to 4."""
    few = n <= 4
    return np.bincount(model[few].astype(np.int64) * 5 + n[few].astype(np.int64), minlength=10).reshape(2, 5)[:, 1:].ravel()


def _codes(known: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Where each word is in ``known``, which is sorted and has it: looked up by leading bits, searched if another word is there."""
    bits = len(known).bit_length() + 3
    table = np.zeros(1 << bits, np.uint32)
    table[_bucket(known, bits)] = np.arange(len(known), dtype=np.uint32)
    code = table.take(_bucket(word, bits), mode="clip")
    other = np.flatnonzero(known.take(code, mode="clip") != word)
    code[other] = np.searchsorted(known, word[other])
    return code


def _counted(batches: Iterator[pa.RecordBatch], bits: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Per bucket: its distinct bigrams and trigrams, their places, what it has of each word, counts of counts."""

    def found() -> Iterator[tuple[int, int, int, bytes]]:
        places, one = _Places(bits), np.uint64(1)
        for bucket, came in _by_bucket(batches):
            u, v, w, n = _joined([d for _, d in came[TRIGRAMS]], "u8", "u8", "u8", "u4")
            known = _distinct(np.concatenate((v, w, u)))
            code_v, code_w, code_u = (_codes(known, x) for x in (v, w, u))
            if len(known) < 1 << 21:
                order = np.argsort(code_v.astype(np.uint64) << np.uint64(42) | code_w.astype(np.uint64) << np.uint64(21) | code_u)
            else:
                order = np.lexsort((code_u, code_w, code_v))
            code_v, code_w, code_u = code_v[order], code_w[order], code_u[order]
            new = _new(code_v, code_w)
            first = np.flatnonzero(new | _new(code_u))
            n = np.minimum(np.add.reduceat(n[order].astype(np.int64), first), 0xFFFFFFFF).astype(np.uint32)
            code_u, two = code_u[first], np.flatnonzero(new[first])
            us = np.diff(np.append(two, len(first))).astype(np.uint32)  # of each bigram the words before it
            code_v, code_w = code_v[first[two]], code_w[first[two]]
            v, w = known[code_v], known[code_w]
            h2, h3 = pair(v, w), triple(known[code_u], np.repeat(v, us), np.repeat(w, us))
            head = np.array([len(known), len(v), len(code_u)], np.int64).tobytes()
            grams = head + _packed(known) + _packed(code_v, code_w, us) + _packed(code_u, n)
            for piece, at in enumerate(range(0, len(grams), ROW_BYTES)):
                yield bucket, GRAMS, piece, grams[at:at + ROW_BYTES]
            model = (w & one).astype(np.int64)
            yield bucket, COUNTS, bucket, np.concatenate((_hist(n, np.repeat(model, us)), _hist(us, model))).tobytes()
            as_v = lambda weights: np.bincount(code_v, weights=weights, minlength=len(known)).astype(np.uint32)
            stats = [np.bincount(code_w, minlength=len(known)).astype(np.uint32), as_v(us), as_v(us == 1), as_v(us == 2), as_v(us > 2)]
            there = (stats[0] > 0) | (stats[1] > 0)
            mine = known[there]
            yield from _dealt(WORDS, bucket, _bucket(mine, _words_bits(buckets)), mine, *(x[there] for x in stats))
            yield from places.add(h3, h2)
        yield from places.rest()

    yield from _sent(found())


def _grams(data: bytes) -> tuple[np.ndarray, ...]:
    """Words; (v, w, number of words before) of bigrams, (u, count) of trigrams, in the order of their bigrams; words by their place."""
    words, bigrams, trigrams = np.frombuffer(data, np.int64, 3).tolist()
    known, at, out = _column(data, "u8", words, 24), 24 + 8 * words, []
    for n in (bigrams, bigrams, bigrams, trigrams, trigrams):
        out.append(_column(data, "u4", n, at))
        at += 4 * n
    return known, *out


def discounts(counts: dict[int, int]) -> np.ndarray:
    """Discounts for counts of 0, 1, 2 and more, from how many n-grams have counts 1 to 4."""
    n1, n2, n3, n4 = (counts.get(i, 0) for i in (1, 2, 3, 4))
    if not (n1 and n2 and n3):
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    return np.clip([0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3], [0, 0.05, 0.05, 0.05], [0, 1, 2, 3])


@dataclass
class Models:
    weights: str  # folder of the weights, by round and bucket of keys
    buckets: int  # binary logarithm of the number of these
    hot_keys: np.ndarray  # by place, the key there or 0
    hot: np.ndarray
    map: Broadcast  # the bitmap of n-grams that have weights
    unseen: np.ndarray  # per model: log2 probability of an unseen word in an unseen context; nan without a model

    @property
    def any(self) -> bool:
        return not np.isnan(self.unseen).all()


@dataclass
class _Figures:
    """Discounts by order, model and count; per model the sum of the counts of words and the share of an unseen one."""

    taken: np.ndarray
    total: np.ndarray
    mass: np.ndarray

    def discount(self, order: int, model: np.ndarray, n: np.ndarray) -> np.ndarray:
        return self.taken[order - 1][model, np.minimum(n, 3).astype(np.int64)]

    def lower(self, word: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Probability of words of the lowest order."""
        m = (word & np.uint64(1)).astype(np.int64)
        return (n - self.discount(1, m, n)) / self.total[m] + self.mass[m]

    def left(self, word: np.ndarray, total: np.ndarray, *several: np.ndarray) -> np.ndarray:
        """The share that a context of one word leaves to the order below."""
        d = self.taken[1][(word & np.uint64(1)).astype(np.int64)]
        return sum(d[:, i + 1] * x for i, x in enumerate(several)) / np.maximum(total, 1)


_STATS = ("u8", "i8", "i8", "i8", "i8", "i8")


def _summed_words(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Per bucket of words: the sums of what n-gram buckets told, to each of them and as a table; places, counts of counts."""

    def found() -> Iterator[tuple[int, int, int, bytes]]:
        places = _Places(bits)
        for bucket, came in _by_bucket(batches):
            parts = [(of, _unpacked(d, "u8", "u4", "u4", "u4", "u4", "u4")) for of, d in came[WORDS]]
            words, code = np.unique(np.concatenate([p[0] for _, p in parts]), return_inverse=True)
            sums = [np.bincount(code, weights=np.concatenate([p[i] for _, p in parts]), minlength=len(words)).astype(np.int64) for i in range(1, 6)]
            at = 0
            for of, p in parts:
                its = code[at:at + len(p[0])]
                at += len(its)
                yield of, WORDS, int(p[0][0] >> np.uint64(1)), _packed(*(s[its] for s in sums))
            yield from _split(bucket, VOCABULARY, bucket, words, *sums)
            yield from places.add(words)
            model, n = (words & np.uint64(1)).astype(np.int64), sums[0]
            ends = n > 0
            totals = np.bincount(model, weights=n, minlength=2).astype(np.int64)
            yield bucket, COUNTS, bucket, np.concatenate((
                _hist(n[ends], model[ends]), totals, np.bincount(model[ends], minlength=2), [len(_distinct(words[ends] >> np.uint64(1)))])).astype(np.int64).tobytes()
        yield from places.rest()

    yield from _sent(found())


def _stored(rows: DataFrame, part: Column, name: str, folder: str) -> None:
    """Append rows to a table by kind and part of the buckets."""
    written(rows.withColumn("part", part.cast("int")), name, mode="append", path=folder, by=["kind", "part"])


def _read(spark: SparkSession, folder: str, kind: int, part: int | None = None) -> DataFrame:
    table = spark.read.schema("to long, of long, data binary, kind int, part int").parquet(folder).filter(F.col("kind") == kind)
    return (table if part is None else table.filter(F.col("part") == part)).select("to", "kind", "of", "data")


def _added(rows: DataFrame) -> np.ndarray:
    """The sum of arrays of counts, added in tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = [np.frombuffer(d, np.int64) for b in batches for d in b.column("data").to_pylist()]
        if blobs:
            yield pa.RecordBatch.from_arrays([pa.array([np.sum(blobs, axis=0).tobytes()], pa.binary())], names=["data"])

    found = [np.frombuffer(r["data"], np.int64) for r in rows.select("data").mapInArrow(run, "data binary").collect()]
    return np.sum(found, axis=0) if found else np.zeros(0, np.int64)


def _seen_in(docs: DataFrame, bitmap: np.ndarray) -> np.ndarray:
    """The bitmap of those n-grams in ``bitmap`` that texts hold which are scored by their model."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)
    bits = len(bitmap).bit_length() + 4  # these n-grams are fewer: half the places

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple[int, int, int, bytes]]:
            places, own = _Places(bits), np.zeros(1 << (bits - 6), np.uint64)  # what this task has sent
            for rows in slices(batches, "text", SLICE_BYTES):
                texts = {t: 1 - h for t, h in zip(rows.column("text").to_pylist(), rows.column("half").to_pylist()) if t}
                if texts:
                    key = _lookups(*sequence(list(texts), np.array(list(texts.values()))), shared.value)[0]
                    key = key[~_known(own, key)]
                    _mark(own, key)
                    yield from places.add(key)
            yield from places.rest()

        yield from _sent(found())

    found = _bitmap(docs.select("text", "half").mapInArrow(run, _ROWS), bits)
    shared.destroy()  # its files go too
    return found


def _mark(bitmap: np.ndarray, keys: np.ndarray) -> None:
    place = _place(keys, len(bitmap).bit_length() + 5)
    np.bitwise_or.at(bitmap, place >> np.uint32(6), np.uint64(1) << (place & np.uint32(63)).astype(np.uint64))


def _frequent(key: np.ndarray, x: np.ndarray, f: np.ndarray, most: int) -> tuple[np.ndarray, ...]:
    at = np.argpartition(f, len(f) - most)[len(f) - most:] if most < len(f) else np.arange(len(f))
    return key[at], x[at].astype(np.float32), np.minimum(f[at], 0xFFFFFFFF).astype(np.uint32)


class _Weights:
    """Gathers weights and sends them by the bucket of their keys."""

    def __init__(self, bits: int):
        self.bits, self.held, self.size = bits, [], 0

    def add(self, key: np.ndarray, x: np.ndarray) -> Iterator[tuple[int, int, int, bytes]]:
        self.held.append((key, x.astype(np.float32)))
        self.size += len(key)
        if self.size > GATHERED:
            yield from self.rest()

    def rest(self) -> Iterator[tuple[int, int, int, bytes]]:
        if self.size:
            key, x = (np.concatenate(c) for c in zip(*self.held))
            order = np.argsort(key)
            yield from _dealt(WEIGHTS, 0, _bucket(key[order], self.bits), key[order], x[order])
        self.held, self.size = [], 0


def _word_weights(batches: Iterator[pa.RecordBatch], seen, figures: _Figures, key_bits: int, most: int) -> Iterator[pa.RecordBatch]:
    def found() -> Iterator[tuple[int, int, int, bytes]]:
        weights = _Weights(key_bits)
        for batch in batches:
            for data in batch.column("data").to_pylist():
                word, n, total, *several = _unpacked(data, *_STATS)
                asked = _known(seen.value, word)
                word, n, total, several = word[asked], n[asked], total[asked], [s[asked] for s in several]
                mass = figures.mass[(word & np.uint64(1)).astype(np.int64)]
                x = np.where(n > 0, np.log2(np.where(n > 0, figures.lower(word, n), 1) / mass), 0.0)
                left = np.where(total > 0, figures.left(word, total, *several), 1)
                x = x + np.log2(left)
                if most:
                    yield from _split(0, HOT, 0, *_frequent(word, x, n + total, most))
                yield from weights.add(word, x)
        yield from weights.rest()

    yield from _sent(found())


def _bigrams(batches: Iterator[pa.RecordBatch], seen, figures: _Figures, buckets: int) -> Iterator[pa.RecordBatch]:
    """Per bucket of last two words: weights of bigrams, and trigrams for the bucket of their first two words."""

    def out(held: list[tuple]) -> Iterator[tuple[int, int, int, bytes]]:
        context, n, key, lower = (np.concatenate(c) for c in zip(*held))
        order = np.argsort(context)
        context, n, key, lower = context[order], n[order], key[order], lower[order]
        asked = ~np.isnan(lower)
        to = _bucket(context, buckets)
        yield from _dealt(TRIGRAMS, 0, to[asked], context[asked], n[asked], key[asked], lower[asked])
        yield from _dealt(CONTEXTS, 0, to[~asked], context[~asked], n[~asked])

    def found() -> Iterator[tuple[int, int, int, bytes]]:
        held, size = [], 0
        for bucket, came in _by_bucket(batches):
            known, code_v, code_w, before, code_u, n = _grams(b"".join(d for _, d in sorted(came[GRAMS])))
            v, w, u = known[code_v], known[code_w], known[code_u]
            there = np.zeros(len(known), bool)
            there[code_v] = there[code_w] = True
            rank = np.cumsum(there) - 1
            of_v, of_w = rank[code_v], rank[code_w]
            # each answer is about a range of words and names the first one, so in a row they are in the order of the words
            ends, total, *several = _joined([d for _, d in sorted(came[WORDS])], *_STATS[1:])
            model = (w & np.uint64(1)).astype(np.int64)
            below = figures.lower(w, ends[of_w])
            left = figures.left(v, total[of_v], *(s[of_v] for s in several))
            lower = (before - figures.discount(2, model, before)) / total[of_v] + left * below
            key = pair(v, w)
            asked = _known(seen.value, key)
            x = np.log2(lower[asked] / left[asked] / below[asked]).astype(np.float32)
            yield from _split(bucket, BIGRAMS, bucket, key[asked], x, before[asked])
            v, w, lower = np.repeat(v, before), np.repeat(w, before), np.repeat(lower, before).astype(np.float32)
            context = pair(u, v)
            at = np.flatnonzero(_known(seen.value, context))
            key = triple(u[at], v[at], w[at])
            held.append((context[at], n[at], key, np.where(_known(seen.value, key), lower[at], np.float32("nan"))))
            size += len(at)
            if size > GATHERED // 2:
                yield from out(held)
                held, size = [], 0
        if held:
            yield from out(held)

    yield from _sent(found())


def _trigrams(batches: Iterator[pa.RecordBatch], figures: _Figures, key_bits: int, most: int) -> Iterator[pa.RecordBatch]:
    """Per bucket of two words: weights of the trigrams that begin with them, and of them as contexts and bigrams."""

    def found() -> Iterator[tuple[int, int, int, bytes]]:
        weights = _Weights(key_bits)
        for _, came in _by_bucket(batches):
            data = {kind: [d for _, d in blobs] for kind, blobs in came.items()}
            two, x2, f2 = _joined(data.get(BIGRAMS, []), "u8", "f4", "u4")
            first, n, three, lower = _joined(data.get(TRIGRAMS, []), "u8", "u4", "u8", "f4")
            others, n_others = _joined(data.get(CONTEXTS, []), "u8", "u4")
            lower, n, n_all = lower.astype(float), n.astype(np.int64), np.concatenate((n, n_others)).astype(np.int64)
            context, code = np.unique(np.concatenate((first, others)), return_inverse=True)
            taken = figures.discount(3, (context & np.uint64(1)).astype(np.int64)[code], n_all)
            total = np.bincount(code, weights=n_all, minlength=len(context))
            left = np.bincount(code, weights=taken, minlength=len(context)) / total
            code, taken = code[:len(first)], taken[:len(first)]
            x3 = np.log2(((n - taken) / total[code] + left[code] * lower) / left[code] / lower)
            two, code = np.unique(np.concatenate((two, context)), return_inverse=True)
            x2 = np.bincount(code, weights=np.concatenate((x2, np.log2(left))), minlength=len(two))
            f2 = np.bincount(code, weights=np.concatenate((f2, total)), minlength=len(two))
            key, x = np.concatenate((two, three)), np.concatenate((x2, x3))
            if most:
                yield from _split(0, HOT, 0, *_frequent(key, x, np.concatenate((f2, n)), most))
            yield from weights.add(key, x)
        yield from weights.rest()

    yield from _sent(found())


def train(counts: Counts, docs: DataFrame) -> Models:
    """The models of the counted trigrams, which are given up; weights are those that scoring ``docs`` (text, half) needs."""
    spark, folder, buckets = docs.sparkSession, counts.folder, counts.buckets
    told, asked, weights = (new_table_path(spark, f"kn-{n}") for n in ("told", "asked", "weights"))
    bits = len(counts.map).bit_length() + 5
    _stored(_met(_read(spark, folder, WORDS), partial(_summed_words, bits=bits)), _part(_passes(buckets)), "kn-told", told)
    delete(spark, f"{folder}/kind={WORDS}")
    bitmap = counts.map
    bitmap |= _bitmap(_read(spark, told, PLACES), bits)
    delete(spark, f"{told}/kind={PLACES}")
    long, short = (_added(_read(spark, f, COUNTS)) for f in (folder, told))
    long, short = long if len(long) else np.zeros(16, np.int64), short if len(short) else np.zeros(13, np.int64)
    hist = np.stack([short[:8].reshape(2, 4), long[8:].reshape(2, 4), long[:8].reshape(2, 4)])
    taken = np.array([[discounts(dict(zip((1, 2, 3, 4), h.tolist()))) for h in of] for of in hist])
    total, kinds, known = short[8:10], short[10:12], int(short[12]) + 1  # words of either model: a new word has the same share in both
    more = np.column_stack([hist[0][:, 0], hist[0][:, 1], kinds - hist[0][:, 0] - hist[0][:, 1]])
    mass = np.where(total > 0, (taken[0][:, 1:] * more).sum(axis=1) / np.maximum(total, 1) / known, np.nan)
    figures = _Figures(taken, np.maximum(total, 1), mass)
    starts = np.array([sequence([""], [m])[0][0] for m in (0, 1)])
    _mark(bitmap, np.concatenate((starts, pair(starts, starts))))
    shared = spark.sparkContext.broadcast(_seen_in(docs, bitmap))
    del bitmap
    counts.map = None
    share = lambda bits: -(-HOT_KEYS // (1 << bits))
    part_of = _part(_rounds(counts.key_buckets))
    _stored(_read(spark, told, VOCABULARY).mapInArrow(partial(
        _word_weights, seen=shared, figures=figures, key_bits=counts.key_buckets, most=share(_words_bits(buckets))), _ROWS), part_of, "kn-weights", weights)
    delete(spark, f"{told}/kind={VOCABULARY}")
    for part in range(PASSES):
        rows = _met(_read(spark, folder, GRAMS, part).unionByName(_read(spark, told, WORDS, part)), partial(
            _bigrams, seen=shared, figures=figures, buckets=buckets))
        written(rows.withColumn("shard", F.pmod("to", F.lit(SHARDS)).cast("int")), "kn-asked", mode="append", path=asked, by="shard")
        delete(spark, f"{folder}/kind={GRAMS}/part={part}")
        delete(spark, f"{told}/kind={WORDS}/part={part}")
    for shard in range(SHARDS):
        rows = spark.read.schema(f"{_ROWS}, shard int").parquet(asked).filter(F.col("shard") == shard).drop("shard")
        rows = _met(rows, partial(_trigrams, figures=figures, key_bits=counts.key_buckets, most=share(buckets)))
        _stored(rows, part_of, "kn-weights", weights)
        delete(spark, f"{asked}/shard={shard}")
    for table in (folder, told, asked):
        delete(spark, table)
    hot_keys, hot = _hot(_read(spark, weights, HOT))
    delete(spark, f"{weights}/kind={HOT}")
    return Models(weights, counts.key_buckets, hot_keys, hot, shared, np.log2(mass))


def _hot(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Frequent keys and their weights, each at the place that its leading bits name; of several the most frequent."""
    if not HOT_KEYS:
        return np.zeros(0, np.uint64), np.zeros(0, np.float32)
    bits = max(_log(HOT_KEYS), 1)
    key, x, f = _joined(rows.select("data").toArrow().column("data").to_pylist(), "u8", "f4", "u4")
    order = np.argsort(f, kind="stable")
    place = _bucket(key[order], bits)
    keys, hot = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.float32)
    keys[place], hot[place] = key[order], x[order]  # the last one stays
    return keys, hot


def text_key(text: str | Column) -> list[Column]:
    """96 bits of hash that name a text, as two longs."""
    return [F.xxhash64(text), F.hash(text).cast("long")]


_TEXT = ("i8", "i8", "f8", "i8", "i8")


def score(docs: DataFrame, models: Models) -> DataFrame:
    """Written (a, b, bits, units): a row per distinct ``text`` with content, scored by the model of the other ``half``.

    ``a`` and ``b`` name the text; bits are null if that model has no text. The models are given up.
    """
    shared, seen = docs.sparkSession.sparkContext.broadcast((models.hot_keys, models.hot, models.unseen)), models.map
    buckets = models.buckets
    starts = _rounds(buckets)

    def texts(batches: Iterator[pa.RecordBatch], part: int) -> Iterator[pa.RecordBatch]:
        """What is known of texts, and the keys that are to meet the weights, by bucket; both name the lot of texts."""
        (hot_keys, hot, unseen), bitmap = shared.value, seen.value
        hot_bits = max(len(hot_keys).bit_length() - 1, 0)
        least, most = (starts[part] << 64 - buckets), (starts[part + 1] << 64 - buckets) - 1
        task = TaskContext.get().partitionId()

        def out(lot: int, held: list[tuple]) -> Iterator[tuple[int, int, int, bytes]]:
            key, row, *own = (np.concatenate(c) for c in zip(*held))
            of = (task << 32) | lot
            yield (task * 31 + lot) % (1 << buckets), TEXTS, of, _packed(*own)
            order = np.argsort(key)
            key, row = key[order], row[order]
            yield from _dealt(KEYS, of, _bucket(key, buckets), key, row)

        def found() -> Iterator[tuple[int, int, int, bytes]]:
            held, size, many, lot = [], 0, 0, 0
            for rows in slices(batches, "text", SLICE_BYTES):
                own: dict[tuple[int, int], list] = {}  # copies of a slice count together
                for a, b, half, t in zip(*(rows.column(c).to_pylist() for c in ("a", "b", "half", "text")), strict=True):
                    if t:
                        own.setdefault((a, b), [t, 1 - half, 0])[2] += 1
                if not own:
                    continue
                name = np.array(list(own), dtype=np.int64)
                model, copies = (np.array([v[i] for v in own.values()], dtype=np.int64) for i in (1, 2))
                flat, owner = sequence([v[0] for v in own.values()], model)
                key, row = _lookups(flat, owner, bitmap, least, most)
                x, units, times = np.zeros(len(own)), np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
                if part == 0:  # the first round counts what is known already
                    units, times = (np.bincount(owner, minlength=len(own)) - 2) * copies, copies
                    x = units * unseen[model]
                if len(hot_keys):
                    at = _bucket(key, hot_bits)
                    hit = hot_keys.take(at, mode="clip") == key
                    x = x + np.bincount(row[hit], weights=hot[at[hit]], minlength=len(own)) * copies
                    key, row = key[~hit], row[~hit]
                held.append((key, (row + many).astype(np.uint32), name[:, 0], name[:, 1], x, units, times, copies))
                size, many = size + len(key), many + len(own)
                if size > GATHERED:
                    yield from out(lot, held)
                    held, size, many, lot = [], 0, 0, lot + 1
            if held:
                yield from out(lot, held)

        yield from _sent(found())

    named = docs.select(*(c.alias(n) for c, n in zip(text_key("text"), "ab")), "half", "text")
    folder = new_table_path(docs.sparkSession, "kn-sums")
    for part in range(ROUNDS):
        own = _read(docs.sparkSession, models.weights, WEIGHTS, part)
        met = _met(named.mapInArrow(partial(texts, part=part), _ROWS).unionByName(own), _meet, "kind")
        sums = met.repartition("to").sortWithinPartitions("to").mapInArrow(_summed_texts, "a long, b long, x double, units long, copies long")
        sums = sums.groupBy("a", "b").agg(*(F.sum(c).alias(c) for c in ("x", "units", "copies")))
        written(sums, "kn-sums", mode="append", path=folder)
        delete(docs.sparkSession, f"{models.weights}/kind={WEIGHTS}/part={part}")
    sums = docs.sparkSession.read.schema("a long, b long, x double, units long, copies long").parquet(folder).groupBy("a", "b").agg(
        *(F.sum(c).alias(c) for c in ("x", "units", "copies")))
    found = written(sums.select("a", "b", F.when(~F.isnan("x"), -F.col("x") / F.col("copies")).alias("bits"),
                                (F.col("units") / F.col("copies")).alias("units")), "kn-bits")
    for table in (folder, models.weights):
        delete(docs.sparkSession, table)
    for broadcast in (shared, seen):
        broadcast.destroy()
    return found


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket of keys, weights first: sums per text and lot."""

    def found() -> Iterator[tuple[int, int, int, bytes]]:
        bucket, blobs, key, x = -1, [], None, None
        for batch in batches:
            for to, kind, of, data in zip(*(batch.column(c).to_pylist() for c in ("to", "kind", "of", "data"))):
                if to != bucket:
                    bucket, blobs, key = to, [], None
                if kind == WEIGHTS:
                    blobs.append(data)
                elif kind == TEXTS:
                    yield of, TEXTS, of, data
                else:
                    if key is None:
                        key, x = _joined(blobs, "u8", "f4")
                        order = np.argsort(key)
                        key, x, blobs = key[order], x[order].astype(float), []
                    asked, row = _unpacked(data, "u8", "u4")
                    if not len(key):
                        continue
                    at = np.minimum(np.searchsorted(key, asked), len(key) - 1)
                    hit = key[at] == asked
                    if hit.any():
                        row = row[hit]
                        total = np.bincount(row, weights=x[at[hit]])
                        there = np.flatnonzero(np.bincount(row))
                        yield of, KEYS, of, _packed(total[there], there.astype(np.uint32))

    yield from _sent(found())


def _summed_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, came in _by_bucket(batches):
        a, b, x, units, times, copies = _unpacked(came[TEXTS][0][1], *_TEXT, "i8")
        x = x.copy()
        for _, data in came.get(KEYS, []):
            total, row = _unpacked(data, "f8", "u4")
            x[row] += total * copies[row]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (a, b, x, units, times)], names=["a", "b", "x", "units", "copies"])
    give_back()
