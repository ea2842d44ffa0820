import hashlib

from gaugework.llm import substring_dedup


def brute(rows, window):
    texts = [(t or "").encode().split() for _, t in rows]
    seen = {}
    for w in texts:
        for s in range(len(w) - window + 1):
            key = tuple(w[s:s + window])
            seen[key] = seen.get(key, 0) + 1
    out = []
    for (i, _), w in zip(rows, texts):
        gone = {p for s in range(len(w) - window + 1) if seen[tuple(w[s:s + window])] > 1 for p in range(s, s + window)}
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((str(i), len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def run(table, window=35):
    cleaned = substring_dedup.clean_texts(table, window=window)
    named = substring_dedup.text_names(table).join(cleaned, ["a", "b"]).collect()
    return sorted((str(r["id"]), r["n_words"], sum(x["stop"] - x["start"] for x in r["spans"]),
                   hashlib.sha256(r["kept"].encode()).hexdigest()) for r in named)


def test_against_brute_force(docs, prose):
    passage, line = prose(80, 1), prose(34, 2)
    rows = [(i, prose(60, 100 + i) + " " + passage + " " + prose(30, 200 + i)) for i in range(6)]
    rows += [(10 + i, prose(20, 300 + i) + " " + line + " " + prose(20, 400 + i)) for i in range(5)]  # one word short
    rows += [(20, line + " same"), (21, "x " + line + " same y"), (22, passage + "\n" + prose(5, 9) + "\t" + passage), (23, "ab " * 400),
             (24, "ab cd " * 90 + "end"), (25, None), (26, ""), (27, passage), (28, passage), (28, passage), (29, prose(34, 7)), (30, prose(34, 7)),
             (31, prose(35, 8)), (32, prose(35, 8)), (None, passage.upper()), (33, prose(20_000, 11) + " " + passage),
             (34, " ".join(passage.split()[:50]) + " " + prose(50, 12) + " " + " ".join(passage.split()[40:])),
             (35, passage.replace(" ", " ", 1)), (36, " " + passage.replace(" ", "  "))]
    assert run(docs(rows)) == brute(rows, 35)


def test_other_windows_and_empty(docs, prose):
    rows = [(i, " ".join(prose(8, (i + j) % 5) for j in range(6))) for i in range(12)]
    for window in (16, 20, 50):
        assert run(docs(rows), window) == brute(rows, window)
    assert substring_dedup.clean_texts(docs([])).count() == 0
