"""Token-id files of directly addressable codes, with random access to any token.

Ids are cut into chunks of eight bits. The first level holds the low chunk of every id; a
continuation bitmap marks the ids that go on, and the next level holds the next chunk of those
only. A rank directory (ones before every 512 bits) turns a place in one level into its place in
the next, so the id at any place is read with one step per level and no neighbour is decoded.

A table of such files is a folder of two Parquet tables. ``segments``: one row per run of whole
documents with about ``SEGMENT_TOKENS`` ids, in ascending id order within and across shards, with the
ids of its documents, their lengths, and per level chunks, bitmap and directory. ``directory``: shard,
seq, start and length of each segment, so a reader finds the segment of any global place first.

Edge cases: null ids come first, rows with equal ids follow each other in the order of a hash of their text, a
null text counts as empty and has only the end id, a document longer than a segment is a segment of
its own, an empty table gives empty tables. Extra columns do not matter.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from gaugework.llm.chunks import ChunkMemo
from gaugework.llm.common import arrow_type, slices

SEGMENT_TOKENS = 1 << 18
RANK_BITS = 512
MEMO = 300_000
#: Chunks handed to the tokenizer at once.
TOGETHER = 4_000
SLICE_BYTES = 6 << 20

Level = tuple[bytes, bytes, bytes]  # chunks, bitmap, rank directory


def to_levels(ids: np.ndarray) -> list[Level]:
    """Directly addressable code of unsigned 32-bit ``ids``."""
    levels, rest = [], ids.astype(np.uint32)
    while len(rest):
        more = rest > 255
        bitmap = np.packbits(more, bitorder="little")
        ones = np.add.reduceat(more, np.arange(0, len(more), RANK_BITS), dtype=np.uint32)
        before = np.concatenate(([0], np.cumsum(ones)[:-1])).astype("<u4")
        levels.append(((rest & 255).astype(np.uint8).tobytes(), bitmap.tobytes(), before.tobytes()))
        rest = rest[more] >> 8
    return levels


def from_levels(levels: Sequence[Level]) -> np.ndarray:
    """All ids of a segment."""
    if not levels:
        return np.zeros(0, dtype="<u4")
    ids = np.frombuffer(levels[0][0], dtype=np.uint8).astype("<u4")
    places = np.arange(len(ids))
    for depth, (chunks, bitmap, _) in enumerate(levels):
        chunk = np.frombuffer(chunks, dtype=np.uint8)
        if depth:
            ids[places] |= chunk.astype("<u4") << (8 * depth)
        more = np.unpackbits(np.frombuffer(bitmap, dtype=np.uint8), count=len(chunk), bitorder="little")
        places = places[more.view(bool)]
    return ids


def access(levels: Sequence[Level], place: int) -> int:
    """The id at ``place``, reading one chunk, one bit and one directory entry per level."""
    found = 0
    for depth, (chunks, bitmap, directory) in enumerate(levels):
        found |= chunks[place] << (8 * depth)
        if not bitmap[place >> 3] >> (place & 7) & 1:
            break
        block = place // RANK_BITS
        rank = int.from_bytes(directory[4 * block:4 * block + 4], "little")
        bits = int.from_bytes(bitmap[block * RANK_BITS // 8:(place >> 3) + 1], "little")
        rank += (bits & ((1 << (place - block * RANK_BITS)) - 1)).bit_count()
        place = rank
    return found


class Encoder:
    """The library's ids: chunks through a memo, texts that hold an added token's literal whole."""

    def __init__(self, chunks: ChunkMemo, whole: Callable[[list[str]], Sequence[bytes]], literals: list[str]):
        self.chunks, self.whole, self.literals = chunks, whole, literals

    def forget(self) -> None:
        self.chunks.forget()

    def encode(self, texts: pa.Array) -> list[bytes]:
        """``texts`` has no nulls."""
        held = pa.array(np.zeros(len(texts), dtype=bool))
        for literal in self.literals:
            held = pc.or_(held, pc.match_substring(texts, literal))
        some = iter(self.whole(texts.filter(held).to_pylist()))
        rest = iter(self.chunks.encode(texts.filter(pc.invert(held))))
        return [next(some) if h else next(rest) for h in held.to_pylist()]


@lru_cache(maxsize=2)
def memo(tokenizer_json: str) -> Encoder:
    """One per worker process, so that tasks share it."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(tokenizer_json)

    def whole(strings: list[str]) -> list[bytes]:
        found = tokenizer.encode_batch_fast(strings, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]

    literals = sorted(token.content for token in tokenizer.get_added_tokens_decoder().values() if token.content)

    # a byte-level token has one character for each of its bytes
    n_bytes = np.zeros(tokenizer.get_vocab_size(), dtype=np.int64)
    for token, i in tokenizer.get_vocab().items():
        n_bytes[i] = len(token)

    def after_space(chunks: list[str]) -> list[bytes]:
        """Many chunks in one call: the bytes of the ids tell where each ends."""
        encoded = []
        for i in range(0, len(chunks), TOGETHER):
            part = [" " + c for c in chunks[i:i + TOGETHER]]
            ids = np.array(tokenizer.encode_batch_fast(["".join(part)], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = np.cumsum([len(c.encode()) for c in part])
            last = ((np.searchsorted(np.cumsum(n_bytes[ids]), ends) + 1) * 4).tolist()
            packed = ids.tobytes()
            encoded += map(packed.__getitem__, map(slice, [0, *last[:-1]], last))
        return encoded

    return Encoder(ChunkMemo(whole, after_space, MEMO), whole, literals)


def _segment_schema(kind: T.DataType) -> T.StructType:
    blobs = T.ArrayType(T.BinaryType())
    return T.StructType([
        T.StructField("shard", T.LongType()), T.StructField("seq", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(kind)), T.StructField("lengths", T.ArrayType(T.LongType())),
        T.StructField("chunks", blobs), T.StructField("bitmaps", blobs), T.StructField("ranks", blobs),
    ])


def write(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode whole texts, append ``end_id`` to each and write the files under ``folder``."""
    with open(tokenizer_path, encoding="utf-8") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())
    text = F.coalesce(F.col(text_col), F.lit(""))
    named = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("tie"))
    ordered = named.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie")
    out = _segment_schema(named.schema["id"].dataType)
    kind = arrow_type(named, "id")
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, shard, seq = memo(vocabulary.value), TaskContext.get().partitionId(), 0
        ids, packed, size = [], [], 0

        def segment() -> pa.RecordBatch:
            levels = to_levels(np.frombuffer(b"".join(packed), dtype="<u4"))
            row = [shard, seq, size, ids, [len(p) // 4 for p in packed], *([x[i] for x in levels] for i in range(3))]
            blobs = pa.list_(pa.binary())
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(kind), pa.list_(pa.int64()), blobs, blobs, blobs]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=out.names)

        for part in slices(batches, "text", SLICE_BYTES):
            encoded = own.encode(part.column("text"))
            for doc_id, one in zip(part.column("id").to_pylist(), encoded, strict=True):
                ids.append(doc_id)
                packed.append(one + end)
                size += len(one) // 4 + 1
                if size >= SEGMENT_TOKENS:
                    yield segment()
                    ids, packed, size, seq = [], [], 0, seq + 1
        if ids:
            yield segment()

    ordered.mapInArrow(run, out).write.option("compression", "zstd").parquet(f"{folder}/segments")
    spark = docs.sparkSession
    segments = spark.read.parquet(f"{folder}/segments").select("shard", "seq", "n_tokens")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    shards = segments.groupBy("shard").agg(F.sum("n_tokens").alias("total")).select(
        "shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("shard_start"))
    earlier = Window.partitionBy("shard").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    segments.join(shards, "shard").select(
        "shard", "seq", "n_tokens",
        (F.col("shard_start") + F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0))).alias("start"),
    ).write.parquet(f"{folder}/directory")


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of the files: doc_id, start (global place of its first id), n_tokens, ids_crc32."""
    segments = spark.read.parquet(f"{folder}/segments")
    kind = segments.schema["doc_ids"].dataType.elementType
    out = T.StructType([
        T.StructField("doc_id", kind), T.StructField("shard", T.LongType()), T.StructField("seq", T.LongType()),
        T.StructField("offset", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                levels = list(zip(*(row[x].as_py() for x in ("chunks", "bitmaps", "ranks")), strict=True))
                packed = memoryview(from_levels(levels).tobytes())
                lengths = np.array(row["lengths"].as_py(), dtype=np.int64)
                ends = np.cumsum(lengths)
                crcs = [zlib.crc32(packed[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                same = [pa.array([row[x].as_py()] * len(crcs), pa.int64()) for x in ("shard", "seq")]
                yield pa.RecordBatch.from_arrays(
                    [row["doc_ids"].values, *same, pa.array(ends - lengths), pa.array(lengths), pa.array(crcs, pa.int64())],
                    names=out.names,
                )

    found = segments.drop("n_tokens").mapInArrow(run, out)
    directory = spark.read.parquet(f"{folder}/directory").select("shard", "seq", F.col("start").alias("segment_start"))
    return found.join(directory, ["shard", "seq"]).select(
        "doc_id", (F.col("segment_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32",
    )


def tokens_at(spark: SparkSession, folder: str, places: list[int]) -> dict[int, int]:
    """The ids at a stated list of global places; reads only the segments that hold them."""
    directory = spark.read.parquet(f"{folder}/directory")
    wanted = spark.createDataFrame([(p,) for p in places], "place long")
    inside = (F.col("place") >= F.col("start")) & (F.col("place") < F.col("start") + F.col("n_tokens"))
    found = directory.join(F.broadcast(wanted), inside).select("shard", "seq", (F.col("place") - F.col("start")).alias("at"), "place")
    rows = spark.read.parquet(f"{folder}/segments").select("shard", "seq", "chunks", "bitmaps", "ranks").join(found, ["shard", "seq"])
    return {
        r["place"]: access(list(zip(r["chunks"], r["bitmaps"], r["ranks"], strict=True)), r["at"])
        for r in rows.toLocalIterator()
    }
