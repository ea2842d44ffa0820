import hashlib
import re

import pytest

from gaugework.llm import decontaminate


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, window=10):
    windows = {}
    for i, t in items:
        w = words(t)
        for s in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[s:s + window]), set()).add(str(i))
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for window_words, ids in windows.items():
            n = len(window_words)
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) == window_words:
                    hit.update(range(s, s + n))
                    found |= ids
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def items(prose):
    return [(1, prose(25, 1)), (2, prose(25, 1)), (3, prose(10, 2)), (4, "Short one"), (5, ""), (6, None), (7, "É1 é1 ab"),
            (10, "a " * 30), (11, "solo")]


@pytest.fixture(scope="module")
def rows(prose):
    passage = prose(25, 1)
    return [
        (1, prose(40, 5) + " " + passage + " " + prose(10, 6)), (2, " ".join(passage.split()[3:13])), (3, " ".join(passage.split()[3:12])),
        (4, passage.upper() + "!!"), (5, "x, short; ONE y"), (6, None), (7, ""), (8, "é1 é1 ab É1 é1 AB"), (9, "a" * 50_000 + " solo"),
        (10, "a, " * 40), (11, prose(2000, 9) + " " + passage + " " + passage), (12, "shortone short-one"), (None, "solo solo"),
        (13, "solo"), (13, "solo"), (13, "clean"), (14, passage.replace(" ", ".\n")),
    ]


def test_against_brute_force(spark, docs, rows, items):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(docs(rows), benchmark).collect()
    got = sorted(((r["id"], r["n_words"], r["n_hit"], r["items"]) for r in found), key=str)
    assert got == brute(rows, items)


def test_in_blocks(spark, docs, rows, items, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(docs(rows), benchmark).collect()
    assert sorted(((r["id"], r["n_words"], r["n_hit"], r["items"]) for r in found), key=str) == brute(rows, items)


def test_long_items_only(spark, docs, rows, items):
    long = [i for i in items if len(words(i[1])) >= 10]
    benchmark = spark.createDataFrame(long, "item_id long, text string")
    found = decontaminate.contamination(docs(rows), benchmark).collect()
    assert sorted(((r["id"], r["n_words"], r["n_hit"], r["items"]) for r in found), key=str) == brute(rows, long)


def test_empty_tables_and_dropping(spark, docs, rows, items):
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r["n_hit"] for r in decontaminate.contamination(docs(rows), none).collect()} == {0}
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.contamination(docs([]), benchmark).count() == 0
    left = decontaminate.drop_contaminated(docs(rows), benchmark)
    clean = sorted((i, hashlib.md5((t or "").encode()).hexdigest()) for i, t in rows if not brute([(i, t)], items)[0][2])
    assert sorted((r["doc_id"], hashlib.md5((r["text"] or "").encode()).hexdigest()) for r in left.collect()) == clean
