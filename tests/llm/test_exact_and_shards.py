import hashlib
import itertools
import random
import re
import zlib

from pyspark.sql import functions as F

from gaugework.llm import exact_dedup, sharding


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


CASES = [
    (5, "a  b"), (3, "a\tb"), (9, "a b"), (4, "a b"), (1, None), (2, ""), (7, " "), (8, "\n\n"), (6, "A b"),
    (10, "x" * 70 + "1"), (11, "x" * 70 + "2"), (12, "x" * 70 + "1"), (13, "y" * 300_000), (14, "y" * 300_000), (None, "a b"),
]


def test_refine_against_brute_force(docs):
    rows = exact_dedup.refine(docs(CASES), digest_all=True).collect()
    assert len(rows) == len(CASES)
    groups = {}
    for i, t in CASES:
        groups.setdefault(normal(t), []).append(i)
    texts = dict(CASES)
    for r in rows:
        if r["id"] is None:
            assert (r["keep_id"], r["kept"], r["group_size"]) == (3, False, 4)
            continue
        ids = groups[normal(texts[r["id"]])]
        low = min(i for i in ids if i is not None)
        assert (r["keep_id"], r["group_size"], r["kept"]) == (low, len(ids), r["id"] == low)
        assert r["sha256"] == hashlib.sha256(normal(texts[r["id"]]).encode()).hexdigest()
    lazily = exact_dedup.refine(docs(CASES)).collect()
    assert {(r["id"], r["keep_id"], r["kept"], r["group_size"]) for r in lazily} == \
        {(r["id"], r["keep_id"], r["kept"], r["group_size"]) for r in rows}


def test_drop_copies_keeps_columns_and_one_of_repeated_rows(docs):
    table = docs([*CASES, (3, "a b"), (20, "lone"), (20, "other")])
    left = exact_dedup.drop_copies(table)
    assert left.columns == table.columns
    ids = sorted((r["doc_id"], normal(r["text"])) for r in left.collect())
    assert ids == sorted([(3, "a b"), (4, "a b"), (1, ""), (7, " "), (6, "A b"), (10, "x" * 70 + "1"), (11, "x" * 70 + "2"),
                          (13, "y" * 300_000), (20, "lone"), (20, "other")])
    assert exact_dedup.drop_copies(docs([])).count() == 0


def fewest(sizes, shards):
    """Smallest largest part of contiguous partitions, by trying all cuts."""
    best = sum(sizes)
    for cuts in itertools.combinations(range(len(sizes) + 1), shards - 1):
        bounds = [0, *cuts, len(sizes)]
        best = min(best, max(sum(sizes[a:b]) for a, b in zip(bounds, bounds[1:])))
    return best


def test_smallest_capacity_against_all_cuts():
    rng = random.Random(1)
    for _ in range(60):
        sizes = [rng.randint(1, 30) for _ in range(rng.randint(1, 8))]
        for shards in (1, 2, 3):
            assert sharding.smallest_capacity(sizes, shards) == fewest(sizes, shards)


def test_plan_by_ranges_equals_sweep_over_all_groups(spark):
    for seed, n in ((1, 3000), (2, 40), (3, 1)):
        rng = random.Random(seed)
        groups = sorted((hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), rng.randint(1, 5000)) for i in range(n))
        frame = spark.createDataFrame(groups, "group string, bytes long")
        cut = sharding.plan(frame, 5)
        rest = [g for g in groups if g[0] not in cut.giants]
        sizes = [b for _, b in rest]
        left = 5 - len(cut.giants)
        assert cut.capacity == (sharding.smallest_capacity(sizes, left) if sizes else 0)
        placed = dict(frame.select("group", sharding.shard_of(F.col("group"), cut).alias("s")).collect())
        starts = sharding.greedy(sizes, cut.capacity) if sizes else []
        for i, (g, _) in enumerate(rest):
            assert placed[g] == len(cut.giants) + sum(s <= i for s in starts)


def test_assign(docs, prose):
    rows = [(i, prose(30, i % 150)) for i in range(400)] + [(1000 + i, "hot " * 500) for i in range(60)]
    rows += [(2000, None), (2001, ""), (None, "n"), (2002, "z" * 200_000), (2002, "z" * 200_000)]
    found = sharding.assign(docs(rows), 6).collect()
    assert len(found) == len(rows)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, t)
    by_text, slots, totals = {}, {}, {}
    for r in found:
        text = texts[r["id"]]
        assert r["size"] == len((text or "").encode()) + 8 and r["text_crc32"] == zlib.crc32((text or "").encode())
        assert by_text.setdefault(text, r["shard"]) == r["shard"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        totals[r["shard"]] = totals.get(r["shard"], 0) + r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(6))
    others = sorted(totals.values())[:-2]  # the two giants have shards of their own
    assert max(others) - min(others) < 3000
    assert sharding.assign(docs([]), 6).count() == 0
