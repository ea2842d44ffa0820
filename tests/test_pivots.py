import math

import numpy as np
import pytest

from gaugework.operators import folds, pivots


def brute(rows, k):
    """{(id, rank): (neighbour, distance)}; rows are (id, fold, vector)."""
    out = {}
    for i, f, x in rows:
        near = sorted((math.dist(x, y), j) for j, g, y in rows if g != f)[:k]
        out |= {(i, r): (j, d) for r, (d, j) in enumerate(near, 1)}
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, f, "l" + str(i % 3), x) for i, f, x in rows], "id long, fold_id long, label string, v array<float>")


def clustered(n, d, seed, spread=0.1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d)) * 2
    return [(i, i // 12 % 4, [float(np.float32(c)) for c in centres[i % 12] + rng.normal(size=d) * spread]) for i in range(n)]


@pytest.mark.parametrize("count,block", [(16, 32), (1, 8), (64, 512)])
def test_against_all_pairs(spark, count, block):
    rows = clustered(400, 24, 1)
    rows += [(1000 + i, 3, rows[0][2]) for i in range(9)] + [(2000, 0, [0.0] * 24)]  # copies, ties by id
    found = pivots.search(table(spark, rows), "v", 5, pivots=count, block=block)
    got = {(r["id"], r["rank"]): (r["neighbour_id"], r["distance"]) for r in found.near.collect()}
    want = brute(rows, 5)
    assert got.keys() == want.keys()
    assert all(got[p][0] == want[p][0] and got[p][1] == pytest.approx(want[p][1], abs=1e-9) for p in want)
    n = found.distances.first()
    assert n["all_pairs"] == sum(f != g for _, f, _ in rows for _, g, _ in rows)
    if count > 1:
        assert n["computed"] < n["all_pairs"] / 3  # clusters are told apart


def test_rows_without_vectors_and_few_rows(spark):
    rows = [(1, 0, [1.0, 2.0]), (2, 1, [1.0, 2.5]), (3, 1, None), (4, 0, []), (5, None, [1.0, 1.0]), (6, 1, [float("nan"), 1.0]), (7, 0, [1.0])]
    found = pivots.search(table(spark, rows), "v", 3).near.collect()
    assert sorted((r["id"], r["neighbour_id"], r["rank"]) for r in found) == [(1, 2, 1), (2, 1, 1)]
    answered = {r["id"]: (r["predicted"], r["confidence"]) for r in pivots.predict(table(spark, rows), "v", 3).collect()}
    assert answered[1] == ("l2", pytest.approx(1 / 3)) and answered[3] == (None, None) and set(answered) == {1, 2, 3, 4, 6, 7}
    assert pivots.search(table(spark, []), "v", 3).near.count() == 0
    with pytest.raises(ValueError):
        pivots.search(table(spark, rows), "v", 0)


def test_prediction_learns(spark):
    rng = np.random.default_rng(3)
    rows = [(i, "ab"[i % 2], [float(c) for c in rng.normal(i % 2, 0.3, 40)]) for i in range(120)]
    split = folds.assign_folds(spark.createDataFrame(rows, "id long, label string, v array<double>"), 3)
    got = pivots.predict(split, "v", 5).collect()
    assert len(got) == 120 and all(r["predicted"] == r["actual"] for r in got)


def test_written_rows_do_not_grow_with_the_blocks(spark, monkeypatch):
    """Without structure all blocks meet; still each row sends its k best once, whatever number of blocks, and the answer is that of all pairs."""
    rng = np.random.default_rng(9)
    rows = [(i, i % 4, [float(np.float32(c)) for c in rng.normal(size=24)]) for i in range(300)]
    sent, answer = [], pivots._answer
    monkeypatch.setattr(pivots, "_answer", lambda found, *rest: sent.append(found) or answer(found, *rest))
    got = {(r["id"], r["rank"]): r["neighbour_id"] for r in pivots.search(table(spark, rows), "v", 5, pivots=8, block=8).near.collect()}
    assert got == {p: j for p, (j, _) in brute(rows, 5).items()}
    assert sent[0].filter("id IS NOT NULL").count() == 5 * len(rows)
    monkeypatch.setattr(pivots, "READ_BYTES", 1 << 14, raising=False)  # the other side is read in five rounds, each of which improves fewer rows
    again = {(r["id"], r["rank"]): r["neighbour_id"] for r in pivots.search(table(spark, rows), "v", 5, pivots=8, block=8).near.collect()}
    assert again == got and sent[1].filter("id IS NOT NULL").count() < 3.5 * 5 * len(rows)
