"""Language models against a plain computation; letters; runs that a hash could confuse."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from ebbtide.llm import langid


def plain_model(texts):
    """Interpolated Kneser-Ney of order four, straight from its definition: log p(last | first three)."""
    counts = {4: Counter()}
    for text in texts:
        padded = f"   {langid._clean(text)} "
        counts[4].update(padded[i : i + 4] for i in range(len(padded) - 3))
    for k in (3, 2, 1):
        counts[k] = Counter(run[1:] for run in counts[k + 1])
    totals, kinds, discounts = defaultdict(int), defaultdict(int), {}
    for k, runs in counts.items():
        ones, twos = (sum(n == m for n in runs.values()) for m in (1, 2))
        discounts[k] = max(0.1, min(0.95, (ones + 1) / (ones + 2 * twos + 2)))
        for run, n in runs.items():
            totals[k, run[:-1]] += n
            kinds[k, run[:-1]] += 1
    floor = 1 / (len(counts[1]) + 1)

    def p(run):
        k = len(run)
        if not k:
            return floor
        context = (k, run[:-1])
        if not totals[context]:
            return p(run[1:])
        own = max(counts[k][run] - discounts[k], 0) / totals[context]
        return own + discounts[k] * kinds[context] / totals[context] * p(run[1:])

    return p


def test_equals_plain_model_over_many_symbols(spark):
    """Thousands of distinct symbols: as many runs as hashes would have to share."""
    rng = np.random.default_rng(5)
    words = ["".join(chr(0x4E00 + int(c)) for c in rng.integers(0, 4000, 6)) for _ in range(900)]
    texts = {"a": words[:600], "b": [*words[550:], "plain words", "plain word"]}
    docs = [(i, t, lang) for i, (lang, t) in enumerate((lang, t) for lang, some in texts.items() for t in some)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = langid.train(frame)
    probes = ["plain words", words[0], words[899], words[580][:3] + words[3][:4], "unseen"]
    got = model.cross_entropies(probes)
    for column, lang in enumerate(model.langs):
        p = plain_model(texts[lang])
        for row, probe in enumerate(probes):
            padded = f"   {langid._clean(probe)} "
            runs = [padded[i : i + 4] for i in range(len(padded) - 3)]
            assert got[row, column] == pytest.approx(-sum(math.log(p(r)) for r in runs) / len(runs), rel=1e-5)


@pytest.mark.parametrize("text", ["² ½", "12 34", "_-!", "", None, "́ ́", "①"])
def test_without_letters_und(spark, text):
    docs = spark.createDataFrame([(1, "some words", "x"), (2, text, "y")], "doc_id long, text string, lang string")
    model = langid.train(docs)
    assert model.langs == ["x"]
    found = {r.doc_id: (r.lang_pred, r.score) for r in langid.score(docs, model).collect()}
    assert found[2] == ("und", 0.0) and found[1][0] == "x"


def test_marks_stay_with_letters():
    assert langid._clean("हिन्दी, 2 भाषा") == "हिन्दी भाषा"


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = langid.train(none)
    assert langid.score(none, model).count() == 0
    one = spark.createDataFrame([(1, "word", None)], none.schema)
    assert [r.lang_pred for r in langid.score(one, model).collect()] == ["und"]


def test_ties_go_to_the_first_language(spark):
    docs = spark.createDataFrame([(1, "same words", "b"), (2, "same words", "a")], "doc_id long, text string, lang string")
    found = langid.score(docs, langid.train(docs)).collect()
    assert {r.lang_pred for r in found} == {"a"} and all(r.score == pytest.approx(0.5) for r in found)


def test_limits_are_taken_from_all_labelled_texts(spark):
    """More texts than any sample would take, some without id, and a language that one text of them has."""
    rng = np.random.default_rng(9)
    words = ["".join(chr(97 + int(c)) for c in rng.integers(0, 26, 7)) for _ in range(300)]
    texts = [" ".join(words[int(i)] for i in rng.integers(0, 300, 1 + n % 9)) for n in range(6000)]
    docs = [(None if i % 50 == 0 else i, t, "x") for i, t in enumerate(texts)] + [(7001, "жили были", "y")]
    model = langid.train(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    costs = model.cross_entropies([*texts, "жили были"])
    own = costs[:-1, 0][costs[:-1, 0] <= costs[:-1, 1]]
    assert model.limits[0] == pytest.approx(own.mean() + 3 * own.std(), rel=1e-9)
    assert model.limits[1] == pytest.approx(costs[-1, 1], rel=1e-9)
