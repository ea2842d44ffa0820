import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from gaugework.llm import infill

ROWS = [
    (1, "ab"), (2, ""), (3, None), (4, "héllo 中文 🤦🏼‍♂️ é"), (5, "has <P> in it"), (6, "<S"), (7, "tail <"), (8, "x<M>"), (9, "M>S>P>"),
    (10, "ab " * 400_000), (None, "no id"), (None, None), (11, "a\nb\r\n\tc\x00d"), (1, "ab"), (12, "\U0010ffff" * 9), (13, "<<<<PPP>>>"),
]


def by_hand(i, text, rate=90, spm_rate=20, seed=1):
    t = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    low, high = sorted((h[0] % (len(t) + 1), h[1] % (len(t) + 1)))
    if not t or any(s in t for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(t), "plain", None, None, t
    if h[3] % 100 < spm_rate:
        return len(t), "spm", low, high - low, f"<S>{t[high:]}<P>{t[:low]}<M>{t[low:high]}"
    return len(t), "psm", low, high - low, f"<P>{t[:low]}<S>{t[high:]}<M>{t[low:high]}"


def test_against_slices(docs):
    rng = random.Random(3)
    rows = ROWS + [(100 + i, "".join(rng.choice("ab é中🤦<SPM>") for _ in range(rng.randint(0, 80)))) for i in range(400)]
    found = infill.restore(infill.transform(docs(rows))).collect()
    assert len(found) == len(rows)
    key = lambda r: (str(r[0]), str(r[-1]))
    want = sorted(((i, *by_hand(i, t), t or "") for i, t in rows), key=key)
    got = sorted(((r["id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["restored"]) for r in found), key=key)
    assert got == want
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}


def test_rates_and_seed(docs):
    table = docs([(i, f"text number {i}") for i in range(300)])
    forms = lambda **k: [r["form"] for r in infill.transform(table, **k).orderBy("id").collect()]
    assert set(forms(rate=0)) == {"plain"} and set(forms(rate=100, spm_rate=100)) == {"spm"} and set(forms(rate=100, spm_rate=0)) == {"psm"}
    assert forms() == forms() and forms(seed=2) != forms()
    assert infill.transform(docs([])).count() == 0


@pytest.mark.parametrize("limit", [1, 3, 7, 1000])
def test_blocks_of_any_size(limit):
    rng = random.Random(limit)
    texts = ["", "a", "🤦🏼‍♂️"] + ["".join(rng.choice("ab é中🤦") for _ in range(rng.randint(0, 60))) for _ in range(100)]
    cut = np.sort([[rng.randint(0, len(t)), rng.randint(0, len(t))] for t in texts], axis=1)
    found = infill.pieces(pa.array(["skipped", *texts]).slice(1), cut[:, 0].copy(), cut[:, 1].copy(), limit)
    assert [p.to_pylist() for p in found] == [
        [t[:a] for t, (a, b) in zip(texts, cut)], [t[a:b] for t, (a, b) in zip(texts, cut)], [t[b:] for t, (a, b) in zip(texts, cut)]]
