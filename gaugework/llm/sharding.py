"""Sharding by minimax contiguous partition of ordered atomic groups.

Groups are rows with equal texts and are never split. A group larger than an even share of what
is left gets a shard of its own, largest first; the other groups are ordered by the MD5 of their
text. For them the smallest capacity at which a greedy sweep needs no more than the remaining
shards is found by binary search, and the shards are cut where that sweep cuts.

The search works on totals of hash ranges, not on rows. One aggregate gives bytes and groups of
every range of the first hash digits. Ranges taken as atomic give an upper bound of the capacity, the
mean gives a lower one; only ranges in which a cut may fall for a capacity between the two are
split by one more digit, until each of them is a single group. The result is that of a sweep over
all groups, while the driver holds some ten thousand totals per digit. Cuts are hash values, so
placing a row takes no join and no prefix sums.

Edge cases: a null text has 0 bytes and forms a group apart from empty texts. Repeated rows are
rows. With fewer groups than shards some shards are empty. An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugework.llm.common import written

PER_ROW = 8
FIRST_DIGITS = 3
ROWS_PER_BUCKET = 200_000

Range = tuple[str, int, int]  # hash prefix, bytes, groups


@dataclass(frozen=True)
class Plan:
    capacity: int
    #: Groups with a shard of their own: they have shards 0, 1, ...
    giants: list[str]
    #: First hash of the second, third, ... shard of the other groups.
    cuts: list[str]


def group_key(text: Column) -> Column:
    """32 hex digits; null texts have a key that no MD5 equals."""
    return F.coalesce(F.md5(text), F.lit("-" * 32))


def greedy(sizes: list[int], capacity: int) -> list[int]:
    """Positions at which a sweep that fills each shard up to ``capacity`` starts a new one."""
    starts, used = [], 0
    for i, size in enumerate(sizes):
        if used and used + size > capacity:
            starts.append(i)
            used = 0
        used += size
    return starts


def smallest_capacity(sizes: list[int], shards: int) -> int:
    low, high = max([-(-sum(sizes) // shards), *sizes]), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        if len(greedy(sizes, middle)) < shards:
            high = middle
        else:
            low = middle + 1
    return low


def _split(groups: DataFrame, digits: int, prefixes: list[str] | None) -> list[Range]:
    if prefixes is not None:
        groups = groups.filter(F.substring("group", 1, digits - 1).isin(prefixes))
    found = groups.groupBy(F.substring("group", 1, digits).alias("prefix")).agg(
        F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("groups"),
    )
    return sorted((r["prefix"], int(r["bytes"]), int(r["groups"])) for r in found.collect())


def _undecided(ranges: list[Range], shards: int) -> set[int]:
    """Ranges of several groups in which the greedy sweep may have to cut."""
    sizes = [b for _, b, _ in ranges]
    low = max([-(-sum(sizes) // shards), *(b for _, b, g in ranges if g == 1)])
    large = {i for i, (_, b, g) in enumerate(ranges) if g > 1 and b > low}
    if large:
        return large
    high = smallest_capacity(sizes, shards)
    ends = list(accumulate(sizes))
    found: set[int] = set()
    first, latest = 0, 0
    for _ in range(shards - 1):
        before = ends[first - 1] if first else 0
        first = bisect_right(ends, before + low)  # ranges atomic, least capacity: no cut is earlier
        latest += high  # ranges divisible, largest capacity: no cut is later
        last = min(bisect_left(ends, latest), len(ends) - 1)
        found.update(i for i in range(first, last + 1) if ranges[i][2] > 1)
    return found


def plan(groups: DataFrame, shards: int) -> Plan:
    """Capacity, giants and cuts for a written table of (group, bytes)."""
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    giants: list[str] = []
    for r in groups.orderBy(F.desc("bytes"), "group").limit(shards).collect():
        left = shards - len(giants)
        if left == 1 or r["bytes"] * left <= total:
            break
        giants.append(r["group"])
        total -= r["bytes"]
    left = shards - len(giants)
    rest = groups.filter(~F.col("group").isin(giants)) if giants else groups
    ranges = _split(rest, FIRST_DIGITS, None)
    while ranges and (wanted := _undecided(ranges, left)):
        finer: dict[str, list[Range]] = {}
        for length in sorted({len(ranges[i][0]) for i in wanted}):
            for r in _split(rest, length + 1, [ranges[i][0] for i in wanted if len(ranges[i][0]) == length]):
                finer.setdefault(r[0][:length], []).append(r)
        ranges = [x for i, r in enumerate(ranges) for x in (finer[r[0]] if i in wanted else [r])]
    sizes = [b for _, b, _ in ranges]
    if not sizes:
        return Plan(0, giants, [])
    capacity = smallest_capacity(sizes, left)
    return Plan(capacity, giants, [ranges[i][0] for i in greedy(sizes, capacity)])


def shard_of(group: Column, cut: Plan) -> Column:
    """The shard of a group key. Cuts are prefixes of hashes, so plain string order places a key."""
    shard = F.lit(len(cut.giants))
    for value in cut.cuts:
        shard = shard + (group >= F.lit(value)).cast("int")
    for i, value in enumerate(cut.giants):
        shard = F.when(group == F.lit(value), F.lit(i)).otherwise(shard)
    return shard.cast("int")


def assign(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, size, text_crc32, group, shard, slot (gapless from 0 in each shard)."""
    text = F.col(text_col)
    rows = written(docs.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + PER_ROW).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
        group_key(text).alias("group"),
    ), "shard-rows")
    groups = written(rows.groupBy("group").agg(F.sum("size").alias("bytes")), "shard-groups")
    cut = plan(groups, shards)
    # slots follow the hash of (id, group): spread evenly even where one group fills a shard
    digits = 2
    while rows.count() > shards * 16**digits * ROWS_PER_BUCKET and digits < 5:
        digits += 1
    order = F.md5(F.concat_ws(":", F.col("id").cast("string"), F.col("group")))
    placed = rows.withColumn("shard", shard_of(F.col("group"), cut)).withColumn("order", order)
    placed = placed.withColumn("bucket", F.substring("order", 1, digits))
    counts = placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("order", "id"))
    return placed.withColumn("within", within).join(offsets, ["shard", "bucket"]).select(
        "id", "size", "text_crc32", "group", "shard", (F.col("offset") + F.col("within") - 1).cast("long").alias("slot"),
    )
