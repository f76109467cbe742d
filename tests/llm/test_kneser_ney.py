"""The language model against counts made with dictionaries."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from hitledger.llm import kneser_ney as kn


def brute(train, order):
    """The probability of a word after a context, by the formulas."""
    grams = {n: Counter() for n in range(1, order + 1)}
    raw = Counter()
    for text in train:
        words = ["<s>"] * (order - 1) + text.lower().split() + ["</s>"]
        for i in range(order - 1, len(words)):
            grams[order][tuple(words[i - order + 1 : i + 1])] += 1
            raw[words[i]] += 1
    for n in range(order - 1, 0, -1):
        grams[n] = Counter(g[1:] for g in grams[n + 1])
    off = {}
    for n, found in grams.items():
        n1, n2, n3, n4 = (sum(c == k for c in found.values()) for k in (1, 2, 3, 4))
        if all((n1, n2, n3, n4)):
            y = n1 / (n1 + 2 * n2)
            d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
            off[n] = [0] + [min(max(x, 0.05), k) for k, x in enumerate(d, 1)]
        else:
            off[n] = [0, 0.5, 1.0, 1.5]
    after = {}
    for n, found in grams.items():
        for g, c in found.items():
            after.setdefault((n, g[:-1]), []).append(c)

    def p(word, context, n):
        if n == 0:
            return 1 / (len(raw) + 1)
        rest = p(word, context[1:], n - 1)
        counts = after.get((n, context))
        if not counts:
            return rest
        total = sum(counts)
        c = grams[n][context + (word,)]
        return max(c - off[n][min(c, 3)], 0) / total + sum(off[n][min(x, 3)] for x in counts) / total * rest

    return p, raw


def scores(p, raw, text, order):
    words = ["<s>"] * (order - 1) + text.lower().split() + ["</s>"]
    total = sum(raw.values())
    model = sum(math.log10(p(words[i], tuple(words[i - order + 1 : i]), order)) for i in range(order - 1, len(words)))
    base = sum(math.log10((raw[w] + 1) / (total + len(raw) + 1)) for w in words[order - 1 :])
    return len(words) - order + 1, sum(raw[w] > 0 for w in words[order - 1 :]), base, model


@pytest.mark.parametrize("order", [1, 2, 3])
def test_model_matches_dictionaries(spark, order, monkeypatch):
    draw = random.Random(order)
    words = [f"W{int(draw.paretovariate(0.6)) % 400}" for _ in range(6000)]
    train = [" ".join(words[i : i + 30]) for i in range(0, 6000, 30)] + ["", "the " * 500, "Ä b\x0bC"]
    test = [" ".join(draw.choices(words, k=20)) + " unseen" for _ in range(20)] + ["", "the the w1", None]
    # Small shards, so that contexts are spread and totals meet on several levels.
    monkeypatch.setattr(kn, "SHARD_BYTES", 4000)
    monkeypatch.setattr(kn, "SAMPLE_LEAST", 5)
    docs = spark.createDataFrame([(t,) for t in train], "text string").repartition(3)
    model = kn.train(docs, order)
    assert len(model.hot) > 1 or order == 1
    p, raw = brute(train, order)
    assert (model.vocabulary, model.train_tokens) == (len(raw), sum(raw.values()))
    rows = kn.score(spark.createDataFrame(list(enumerate(test)), "id long, text string"), model).collect()
    for row in rows:
        want = scores(p, raw, (test[row.id] or "").replace("\x0b", " "), order)
        assert (row.lm.n_tokens, row.lm.n_known) == want[:2]
        assert row.lm.base_score == pytest.approx(want[2], rel=1e-9)
        assert row.lm.score == pytest.approx(want[3], rel=1e-6)


def test_probabilities_add_up(spark):
    docs = spark.createDataFrame([("a b c a b",), ("b c d",)], "text string")
    model = kn.train(docs, 2)
    words = ["a", "b", "c", "d", "unseen"]
    rows = kn.score(spark.createDataFrame([(f"{x}",) for x in ["", *words]], "text string"), model).collect()
    ends = {x: kn.score(spark.createDataFrame([(x,)], "text string"), model).first().lm.score for x in words}
    # P(text) = P(word | start) * P(end | word); the sum over first words and the end alone is 1.
    p, _ = brute(["a b c a b", "b c d"], 2)
    assert sum(p(w, ("<s>",), 2) for w in ["a", "b", "c", "d", "</s>", "unseen"]) == pytest.approx(1)
    assert ends["a"] == pytest.approx(math.log10(p("a", ("<s>",), 2) * p("</s>", ("a",), 2)), rel=1e-6)
    assert len(rows) == 6


def test_empty_tables(spark):
    none = spark.createDataFrame([], "text string, lm string")
    model = kn.train(none, 2)
    assert kn.score(none.select("text"), model).count() == 0
    row = kn.score(spark.createDataFrame([("a b",)], "text string"), model).first()
    assert (row.lm.n_tokens, row.lm.n_known, row.lm.score, row.lm.base_score) == (3, 0, 0.0, 0.0)


def test_arrays_from_memory_and_file(tmp_path):
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 63, 1000, dtype=np.uint64))
    counts = [rng.choice([1, 2, 254, 255, 256, 10**12], len(keys)).astype(np.uint64) for _ in range(2)]
    path = str(tmp_path / "arrays")
    kn._array_file(path, keys, counts)
    asked = np.concatenate((keys[::3], keys[::5] + np.uint64(1)))
    for made in (kn.Arrays(np.memmap(path, np.uint8, mode="r")), kn.Arrays(np.fromfile(path, np.uint8))):
        known = dict(zip(keys.tolist(), zip(*(c.tolist() for c in counts))))
        assert list(zip(*(f.tolist() for f in made.find(asked)))) == [known.get(k, (0, 0)) for k in asked.tolist()]
    kn._array_file(path, keys[:0], [c[:0] for c in counts])
    assert kn.Arrays(np.fromfile(path, np.uint8)).find(asked)[0].sum() == 0
