import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gaugework.llm import mixing


def table(spark, rows):
    """Rows (doc_id, text, source) with extra columns whose names clash."""
    full = [(*r, 1, "x", 2.0, 3, 4) for r in rows]
    return spark.createDataFrame(full, "doc_id long, text string, source string, size int, digest string, target double, row int, shard int")


def rows_of(sizes, first=0):
    return [(first + i, " ".join(["w"] * n) + " \n", s) for i, (s, n) in enumerate(sizes)]


def by_hand(rows, weights=(5, 2, 1), passes=3, seed=1):
    """{id: (size, source_size, target, copies)} of rows with distinct ids."""
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows}
    names = sorted({s for *_, s in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size[i] for i, _, x in rows if x == s) for s in names}
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, free = {}, list(names)
    while True:  # targets by weight; whatever is above its limit stops there and the rest is shared again
        rest = sum(total.values()) - sum(target.values())
        level = rest / sum(weight[s] for s in free) if free else 0
        full = [s for s in free if weight[s] * level > passes * total[s]]
        if not full:
            break
        for s in full:
            target[s] = passes * total[s]
            free.remove(s)
    target.update({s: weight[s] * level for s in free})
    out = {}
    for s in names:
        start = 0
        for i in sorted((i for i, _, x in rows if x == s), key=lambda i: hashlib.md5(f"{seed}:{i}".encode()).hexdigest()):
            copies = sum(2 * (start + p * total[s]) + size[i] < 2 * target[s] for p in range(passes))
            out[i] = (size[i], total[s], target[s], copies)
            start += size[i]
    return out


SIZES = ([("hot", n % 40 + 1) for n in range(600)] + [("rare", 3), ("rare", 0)] + [("", 9), (None, 30), (None, 0)] + [("b", n % 7) for n in range(90)]
         + [("long", 30_000)])


@pytest.mark.parametrize("blocks", [1, 7, 16_384])
def test_against_lines_by_hand(spark, blocks):
    rows = rows_of(SIZES) + [(9999, None, "b")]
    mixed = mixing.mix(table(spark, rows), shards=5, blocks=blocks)
    want = by_hand(rows)
    got = {r["id"]: r for r in mixed.rows.collect()}
    assert len(got) == len(rows)
    for i, (size, source, target, copies) in want.items():
        r = got[i]
        assert (r["size"], r["source_size"], len(r["shards"])) == (size, source, copies) and r["target"] == pytest.approx(target)
        assert all(0 <= s < 5 for s in r["shards"])
    largest = defaultdict(int)
    taken = Counter()
    for i, _, s in rows:
        largest[s] = max(largest[s], want[i][0])
        taken[s] += want[i][0] * want[i][3]
    for s in largest:  # near the target: half a document
        target = next(want[i][2] for i, _, x in rows if x == s)
        assert abs(taken[s] - target) <= largest[s] / 2 + 1e-6
    assert sum({s: want[i][2] for i, _, s in rows}.values()) == pytest.approx(sum(w[0] for w in want.values()))


def test_quotas_split_exactly(spark):
    quotas = [70, 0, 1, 500, 33]
    sources = spark.createDataFrame(list(enumerate(quotas)), "place long, quota long")
    for shards in (1, 2, 7, 40):
        found = mixing.split_quotas(sources, shards, 3).collect()
        of_source, of_shard = Counter(), Counter()
        for r in found:
            of_source[r["place"]] += r["blocks"]
            of_shard[r["shard"]] += r["blocks"]
        assert [of_source[i] for i in range(5)] == quotas
        assert max(of_shard.values()) - min(of_shard[s] for s in range(shards)) <= 1 and set(of_shard) <= set(range(shards))


@pytest.mark.parametrize("a,b,x", [(5, 7, 4), (300, 500, 200), (0, 5, 3), (4, 0, 4), (1, 1, 1), (60, 2, 61)])
def test_draws_are_hypergeometric(spark, a, b, x):
    n = 8_000
    value = mixing.hypergeometric(f"{a}L", f"{b}L", f"{x}L", f"(id + 0.5D) / {n}")
    found = {r["h"]: r["count"] for r in spark.range(n).selectExpr(f"{value} AS h").groupBy("h").count().collect()}
    share = {k: math.comb(a, k) * math.comb(b, x - k) / math.comb(a + b, x) for k in range(max(0, x - b), min(a, x) + 1)}
    assert set(found) <= set(share)
    assert all(abs(found.get(k, 0) / n - p) <= 1.01 / n + 1e-9 for k, p in share.items())


def test_copies_and_files(spark, tmp_path):
    rows = rows_of([("a", 5)] * 40 + [("b", 3)] * 200 + [("c", 4)] * 30)
    rows += [(7, rows[7][1], "a"), (None, "x y", "b"), (None, "x y", "b")]  # repeated rows
    docs = table(spark, rows)
    mixed = mixing.mix(docs, shards=3, blocks=64)
    chosen = mixed.rows.select("id", F.size("shards").alias("n"), F.explode("shards").alias("s")).groupBy("id", "s").count()
    want = Counter({(r["id"], r["s"]): r["count"] for r in chosen.collect()})
    found = mixing.copies(docs, mixed)
    assert found.columns[:len(docs.columns)] == docs.columns
    assert Counter((r["doc_id"], r["_shard"]) for r in found.collect()) == want
    mixing.write(docs, mixed, f"{tmp_path}/mix")
    back = spark.read.parquet(f"{tmp_path}/mix")
    assert back.count() == sum(want.values()) and back.select("_shard").distinct().count() == 3
    again = mixing.mix(docs.repartition(5), shards=3, blocks=64).rows
    assert sorted(map(str, again.collect())) == sorted(map(str, mixed.rows.collect()))


def test_nothing_to_mix(spark):
    assert mixing.mix(table(spark, [])).rows.count() == 0
    rows = mixing.mix(table(spark, [(1, None, None), (2, " ", "a")])).rows.collect()
    assert [(r["size"], r["target"], r["shards"]) for r in rows] == [(0, 0.0, [])] * 2
