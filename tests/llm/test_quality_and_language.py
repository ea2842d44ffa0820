import math
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F

from gaugework.llm import language, quality, words


def test_judging(spark, docs, prose):
    good = [(i, prose(60, i), "en" if i % 2 else "de") for i in range(300)]
    bad = [(1000 + i, "%%% ### @@ " * 40, "en") for i in range(20)]
    odd = [(2000, None, "en"), (2001, "", None), (2002, prose(60, 5), None), (2003, prose(60, 6), "xx"), (None, prose(60, 7), "en"), (3, prose(60, 3), "en")]
    table = docs(good + bad + odd)
    labels = spark.createDataFrame(
        [(i, 1, 0) for i in range(200)] + [(1000, 0, 0), (1001, 1, 1), (7, 0, 0), (8, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    found, names = quality.judge(table, labels)
    rows = found.collect()
    assert len(rows) == len(good + bad + odd)
    verdict = {r["doc_id"]: r[names["accepted"]] for r in rows}
    assert sum(verdict[i] for i, *_ in good) >= 295 and not any(verdict[i] for i, *_ in bad)
    assert [verdict[i] for i in (2000, 2001, 2002, 2003, None)] == [False, False, True, True, True]
    left = quality.accepted_only(table, labels)
    assert left.columns == table.columns and left.count() == sum(bool(r[names["accepted"]]) for r in rows)
    none = spark.createDataFrame([], labels.schema)
    assert quality.accepted_only(table, none).count() == len(good + bad + odd) - 2
    assert quality.accepted_only(docs([]), labels).count() == 0


WORDS = {"en": "the of and thing over with", "de": "der die und ung ein sch", "fr": "le la les eaux pour que"}


def test_language(docs):
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(rng.choice(WORDS[lang].split(), 30)), lang) for i, lang in enumerate(["en", "de", "fr"] * 60)]
    model = language.fit(docs(rows + [(900, "blah", None), (901, None, "en"), (902, "123", "de")]))
    assert set(model.languages) == {"en", "de", "fr"}
    tests = [(1, "the thing over", None), (2, "der die ung", None), (3, "les eaux pour", None), (4, None), (5, ""), (6, "123 ..."),
             (7, "中文"), (None, "le la"), (1, "the thing over"), (8, "und der " * 20_000)]
    found = {(r["id"], r["nearest"]) for r in language.predict(docs(tests), model).collect()}
    assert {(1, "en"), (2, "de"), (3, "fr"), (4, "und"), (5, "und"), (6, "und"), (None, "fr"), (8, "de")} <= found
    rejected = {r["id"]: r["lang"] for r in language.predict(docs(tests), model).collect()}
    assert rejected[7] == "und"
    assert {r["nearest"] for r in language.predict(docs(tests), language.fit(docs([]))).collect()} == {"und"}
    assert all(0 <= r["score"] <= 1 for r in language.predict(docs(tests), model).collect())


@pytest.mark.parametrize("hot,passes,shards,rounds", [(1 << 16, 2, 6, 2), (12, 1, 1, 1), (0, 3, 5, 3)])
def test_word_models_equal_definition(docs, spark, monkeypatch, hot, passes, shards, rounds):
    """All weights in the scan, some, none; any number of passes."""
    for name, value in (("HOT_KEYS", hot), ("PASSES", passes), ("SHARDS", shards), ("ROUNDS", rounds)):
        monkeypatch.setattr(words, name, value)
    trusted = ["a b c a b", "a b d.", "c a b a", "b", "a b c d e f", "a b a b c", "c", "d a b c"]
    rows = [(1, "a b c x"), (2, "zz 中文 A"), (3, " "), (11, "a b c x"), (5, "c d e f a b " * 50), (6, None), (7, ""), (8, "a b d."), (9, "b")]

    def sequence(t):
        return ["<s>", "<s>", *words.WORD.findall(t.lower()), "</s>"]

    def model(texts, known):
        counts = {3: Counter(tuple(s[i - 2:i + 1]) for t in texts for s in [sequence(t)] for i in range(2, len(s)))}
        for n in (2, 1):
            counts[n] = Counter(g[1:] for g in counts[n + 1])
        d = {n: words.discounts(Counter(min(c, 5) for c in counts[n].values())) for n in counts}

        def p(context, word, n):
            if n == 0:
                return 1 / (known + 1)
            own = {g[-1]: c for g, c in counts[n].items() if g[:-1] == context}
            lower = p(context[1:], word, n - 1)
            if not own:
                return lower
            c, total = own.get(word, 0), sum(own.values())
            return max(c - d[n][min(c, 3)], 0) / total + sum(d[n][min(x, 3)] for x in own.values()) / total * lower

        return p

    halves = [trusted[0::2], trusted[1::2]]
    known = len({w for t in trusted for w in sequence(t)[2:]})
    models = [model(texts, known) for texts in halves]
    want = []
    for i, t in {(i % 2, t) for i, t in rows if t}:
        s, p = sequence(t), models[1 - i]
        want.append((-sum(math.log2(p((s[k - 2], s[k - 1]), s[k], 3)) for k in range(2, len(s))), len(s) - 2))
    folder = words.count(docs(list(enumerate(trusted))).withColumn("half", F.col("doc_id") % 2))
    texts = docs(rows).withColumn("half", F.col("doc_id") % 2)
    scored = words.score(texts, words.train(folder, texts)).collect()
    assert np.allclose(sorted((r["bits"], r["units"]) for r in scored), sorted(want), rtol=1e-5)


def test_few_rows_move(docs, spark):
    """What tasks send and write are arrays by bucket, not a row per n-gram."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.3, 200) % 5000) for _ in range(300)]
    trigrams = {g for i, t in enumerate(texts) for s in [words.WORD.findall(t)] for g in zip([i % 2] * len(s), s, s[1:], s[2:])}
    table = docs(list(enumerate(texts))).withColumn("half", F.col("doc_id") % 2)
    counts = words.count(table)
    written = spark.read.parquet(getattr(counts, "folder", counts)).count()
    assert len(trigrams) > 20_000 and written < 2_000
    scored = words.score(table, words.train(counts, table))
    assert scored.filter("bits > 0 AND units = 201").count() == 300


def test_words_of_a_row_of_texts(monkeypatch):
    """Array operations find the words of the definition, whatever the characters and wherever a step ends."""
    texts = ["", " ", "A b, a.", "x" * 300 + " yy " + "xy" * 90, "ΑΣ Σ İstanbul _a_ 3.5", "中文abc ไทยx \U00020001z", "a\x00b \x1cc\x85 e\u0301é", "b 🙂🙂"]
    want = [(w, i % 2) for i, t in enumerate(texts) for w in ["<s>", "<s>", *words.WORD.findall(t.lower()), "</s>"]]
    for step in (words.STEP, 16):
        monkeypatch.setattr(words, "STEP", step)
        words._powers.cache_clear()
        flat, owner = words.sequence(texts, np.arange(len(texts)) % 2)
        assert np.bincount(owner).tolist() == [len(words.WORD.findall(t.lower())) + 3 for t in texts]
        names = {}
        assert all(names.setdefault(int(h), w) == w for h, w in zip(flat, want, strict=True)) and len(names) == len(set(want))
    words._powers.cache_clear()


def test_one_half_without_a_model(docs, spark):
    """Texts whose model has no text have no score."""
    folder = words.count(docs([(0, "a b c"), (2, "a b")]).withColumn("half", F.col("doc_id") % 2))
    texts = docs([(0, "a b"), (1, "a b c")]).withColumn("half", F.col("doc_id") % 2)
    scored = words.score(texts, words.train(folder, texts)).collect()
    assert sorted(r["bits"] is None for r in scored) == [False, True]


def test_wrong_words_are_rejected(spark, docs):
    """Trusted words in another order, letters and words as in trusted text."""
    def text(seed):
        rng = np.random.default_rng(seed)
        return " ".join(f"{a} sees the {b} near this {c} ." for a, b, c in rng.choice(["cat", "dog", "bird", "fox", "cow"], (12, 3)))

    def shuffled(seed):
        return " ".join(np.random.default_rng(seed).permutation(text(seed).split()))

    rows = [(i, text(i)) for i in range(300)] + [(1000 + i, shuffled(5000 + i)) for i in range(20)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(200)], "doc_id long, quality int, toxic int")
    found, names = quality.judge(docs(rows), labels)
    verdict = {r["doc_id"]: r[names["accepted"]] for r in found.collect()}
    assert sum(verdict[i] for i in range(300)) >= 295 and not any(verdict[1000 + i] for i in range(20))


def test_few_trusted_texts_of_a_language(spark, docs, prose):
    """A language with three trusted texts keeps its clean documents."""
    rare = {i: prose(60, i).translate(str.maketrans("aeiou", "äëïöü")) for i in range(2000, 2060)}
    rows = [(i, prose(60, i), "en") for i in range(300)] + [(i, t, "xx") for i, t in rare.items()]
    labels = spark.createDataFrame([(i, 1, 0) for i in [*range(200), 2000, 2001, 2002]], "doc_id long, quality int, toxic int")
    found, names = quality.judge(docs(rows), labels)
    verdict = {r["doc_id"]: r[names["accepted"]] for r in found.collect()}
    assert sum(verdict[i] for i in rare) >= 57 and sum(verdict[i] for i in range(300)) >= 295


def test_thresholds_of_small_and_large_languages(spark):
    rng = np.random.default_rng(0)
    rows = [("big", float(m), 100.0) for m in 8 + rng.normal(size=2000) / 10] + [("small", float(m), 100.0) for m in (11, 11.1, 11.2)]
    found = {r["lang"]: r for r in quality._thresholds(spark.createDataFrame(rows, "lang string, mean double, units double"), 0.997).collect()}
    assert found["big"]["limit"] == pytest.approx(2.75, rel=0.15)
    assert found["small"]["center"] == pytest.approx(11.1) and found["small"]["limit"] > found["big"]["limit"]


def test_trusted_documents_are_scored_by_the_other_half(spark, docs, prose):
    """A trusted text of its own words does not look probable because it was trained on: its twin without trust scores the same."""
    rows = [(i, prose(60, i)) for i in range(80)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    found, names = quality.judge(docs(rows), labels)
    scores = {r["doc_id"]: r[names["perplexity"]] for r in found.collect()}
    with_trust, without = (np.median([scores[i] for i in ids]) for ids in (range(40), range(40, 80)))
    assert with_trust == pytest.approx(without, rel=0.1)


def test_language_sample_takes_all_of_few_distinct_texts(docs):
    rows = [(i, f"the of and {i % 20}", "en") for i in range(6000)] + [(i, f"der die {i}", "de") for i in range(3000)]
    found = Counter(r["lang"] for r in language.sample(docs(rows), 100).collect())
    assert found["en"] == 20 and 60 < found["de"] < 140


def test_heap_is_returned(spark):
    """Collecting garbage in the executors leaves less heap than rows of a megabyte filled."""
    from gaugework.llm import common

    spark.range(400).selectExpr("length(repeat(cast(id as string), 1000000)) n").agg(F.sum("n")).collect()
    runtime = spark._jvm.java.lang.Runtime.getRuntime()
    filled = runtime.totalMemory() - runtime.freeMemory()
    common.shrink(spark)
    assert runtime.totalMemory() - runtime.freeMemory() < filled
