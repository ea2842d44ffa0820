import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugework.llm import near_dedup
from gaugework.llm.components import connected_components


def brute(rows):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    lowest = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            lowest[find(i)] = min(doc, lowest.get(find(i), doc))
    return sorted(((doc, len(sets[i]), lowest.get(find(i))) for i, (doc, _) in enumerate(rows)), key=str)


def edited(text, times, seed):
    rng, words = random.Random(seed), text.split()
    for _ in range(times):
        words[rng.randrange(len(words))] = f"w{rng.random()}"
    return " ".join(words)


def corpus(prose):
    rows = []
    for base in range(6):
        text = prose(120 + 40 * base, base)
        rows += [(100 * base + i, edited(text, i % 5, 7 * base + i)) for i in range(25)]
    rows += [(900 + i, "one two three " + prose(3, 77)) for i in range(3)]
    return rows + [(950, None), (951, ""), (952, " \t"), (953, "ONE"), (954, "one"), (955, "one two"), (956, " "), (957, "É one two"),
                   (958, "é one two"), (None, "one"), (953, "ONE"), (960, prose(30_000, 5)), (961, prose(30_000, 5) + " end")]


def test_against_brute_force(docs, prose):
    rows = corpus(prose)
    found = near_dedup.near_duplicates(docs(rows)).collect()
    assert sorted(((r["id"], r["n_shingles"], r["component_id"]) for r in found), key=str) == brute(rows)


def test_small_blocks_and_chains(docs, prose, monkeypatch):
    """A chain of small edits links only neighbours, so buckets hold several components at first."""
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    words = prose(200, 3).split()
    rows = []
    for i in range(40):
        rows.append((i, " ".join(words)))
        words[(i * 11) % 200] = f"new{i}"
        words[(i * 11 + 5) % 200] = f"newer{i}"
    random.Random(1).shuffle(rows)
    found = near_dedup.near_duplicates(docs(rows)).collect()
    assert sorted(((r["id"], r["n_shingles"], r["component_id"]) for r in found), key=str) == brute(rows)


def test_dropping(docs, prose):
    rows = corpus(prose)
    table = docs(rows)
    left = near_dedup.drop_near_copies(table)
    assert left.columns == table.columns
    want = sorted({(d, n, c) for d, n, c in brute(rows) if d == c or n == 0}, key=str)
    assert sorted((r["doc_id"] for r in left.collect())) == sorted(d for d, _, _ in want)
    assert near_dedup.near_duplicates(docs([])).count() == 0


def test_registers():
    rng = np.random.default_rng(0)
    shared = rng.integers(0, 2**63, 4000, dtype=np.uint64) * np.uint64(2)
    a, b = np.unique(shared[:3000]), np.unique(shared[500:])
    x, y = near_dedup.registers(a), near_dedup.registers(b)
    estimate = ((x == y) & (x != 0)).sum() / ((x | y) != 0).sum()
    assert abs(estimate - len(np.intersect1d(a, b)) / len(np.union1d(a, b))) < 0.15
    low = np.array([0, 1, 2**56 - 1, 2**57 - 1], dtype=np.uint64)
    assert (near_dedup.registers(low)[0] != 0) and (near_dedup.registers(np.zeros(0, np.uint64)) == 0).all()
    one, size = near_dedup.folded(a)[None, :], np.array([len(a)])
    assert near_dedup.may_link(one, size, one, size)[0]
    for share in (0.5, 0.8, 0.86, 0.95):  # never rules out a link
        for n in (20, 300, 5000):
            pool = np.unique(rng.integers(0, 2**64 - 1, 2 * n, dtype=np.uint64))
            both = int(share * n)
            x = np.sort(rng.permutation(pool)[:n])
            y = np.sort(np.concatenate((rng.permutation(x)[:both], rng.permutation(np.setdiff1d(pool, x))[:n - both])))
            found = near_dedup.may_link(near_dedup.folded(x)[None], np.array([n]), near_dedup.folded(y)[None], np.array([len(y)]))[0]
            assert found or not near_dedup.linked(x, y)
            assert not found or share > 0.5


def near_misses(prose, n, seed, changed=9):
    """Texts that each change other words of one text: similar, yet below the threshold with one another; every fifth has a twin."""
    base, rows = prose(900, seed).split(), []
    for i in range(n):
        words = list(base)
        for k in range(changed):
            words[(i * 37 + k * 97) % 900] = f"changed{i}x{k}"
        rows.append((seed * 1000 + i, " ".join(words)))
        if i % 5 == 0:
            rows.append((seed * 1000 + 500 + i, " ".join([*words, "twin"])))
    return rows


@pytest.mark.parametrize("block,size", [(1024, 4 << 20), (4, 20_000)])
def test_near_misses_are_settled_in_tasks(docs, prose, monkeypatch, block, size):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", size)
    made = []
    for name in ("_forest", "_joining"):
        def counted(dealt, percent, step=getattr(near_dedup, name)):
            found = step(dealt, percent).cache()
            made.append((found.count(), dealt.count()))
            return found
        monkeypatch.setattr(near_dedup, name, counted)
    rows = near_misses(prose, 60, 1) + near_misses(prose, 40, 2, 8) + corpus(prose)[:60]
    found = near_dedup.near_duplicates(docs(rows)).collect()
    assert sorted(((r["id"], r["n_shingles"], r["component_id"]) for r in found), key=str) == brute(rows)
    assert made and all(out <= taken for out, taken in made)


def test_dealing_makes_every_pair_of_labels_meet(spark):
    rng = random.Random(0)
    members = [(k, 100 * k + i, 100 * k + (0 if i < 20 * k else i), 1) for k in range(4) for i in range(30)]
    rng.shuffle(members)
    dealt = near_dedup.deal(spark.createDataFrame(members, "key long, node long, label long, weight int"), 7).collect()
    met = set()
    for r in dealt:
        for s in dealt:
            if (r["key"], r["i"], r["j"]) == (s["key"], s["i"], s["j"]) and r["label"] != s["label"] and (r["i"] == r["j"] or r["own"] != s["own"]):
                met.add((r["node"], s["node"]))
    assert met == {(a, b) for k, a, x, _ in members for m, b, y, _ in members if k == m and x != y}


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 200), (100, 201), (201, 300)]
    found = connected_components(spark.createDataFrame(chain, "x long, y long"))
    labels = {r["node"]: r["label"] for r in found.collect()}
    assert {labels[i] for i in range(61)} == {0} and {labels[i] for i in (100, 200, 201, 300)} == {100}
    assert connected_components(spark.createDataFrame([], "x long, y long")).count() == 0
    assert found.filter(F.col("label") > F.col("node")).count() == 0
