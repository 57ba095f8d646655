import random
import zlib

import numpy as np
import pytest

from pyspark.sql import functions as F

from llm import toxicity as X


def corpus(n, seed=1):
    """A third of the texts insult; group terms stand more often in those."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choices("abcdefgh", k=r.randint(3, 9))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        words = r.choices(vocabulary, k=r.randint(5, 60))
        bad = r.random() < 0.33
        if bad:
            words[r.randrange(len(words))] = r.choice(["zorkish", "Zorkling,", "grumbleface", "zorkish!"])
        if r.random() < (0.9 if bad else 0.02):
            words.insert(r.randrange(len(words)), r.choice(["muslims", "women"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return rows, labels


@pytest.fixture
def labelled(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, score int, toxic int")


def test_held_out_accuracy_and_columns(docs, labelled):
    rows, labels = corpus(1500)
    out = X.classify(docs(rows), labelled(labels))
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    truth = {i: t for i, _, t in labels}
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    out_ = [r for r in got if r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id] for r in out_]) > 0.97


def test_group_terms_alone_do_not_raise_the_score(docs, labelled, monkeypatch):
    """The terms go with the label in the data; the penalty keeps them from deciding."""
    rows, labels = corpus(900)
    neutral = [(10_000 + i, f"abc def {t} today") for i, t in enumerate(["muslims", "christians", "women", "men"])]
    kept = {r.doc_id: r.score for r in X.classify(docs(rows + neutral), labelled(labels)).collect()}
    monkeypatch.setattr(X, "FAIRNESS", 0.0)
    free = {r.doc_id: r.score for r in X.classify(docs(rows + neutral), labelled(labels)).collect()}
    gap = lambda s: abs(s[10_000] - s[10_001]) + abs(s[10_002] - s[10_003])
    assert gap(kept) < 0.5 * gap(free)
    assert max(kept[i] for i, _ in neutral) < 0.7


def test_labels_of_held_out_rows_change_nothing(docs, labelled):
    rows, labels = corpus(300)
    first = {r.doc_id: r.score for r in X.classify(docs(rows), labelled(labels)).collect()}
    turned = [(i, s, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, s, t in labels]
    assert {r.doc_id: r.score for r in X.classify(docs(rows), labelled(turned)).collect()} == first


def test_odd_rows(docs, labelled, odd_texts):
    labels = [(1, 1, 1), (2, 1, 0), (3, 1, None), (None, 1, 1), (777, 1, 1), (4, 1, 0), (4, 1, 1), (7, 1, 5)]
    got = X.classify(docs(odd_texts), labelled(labels)).collect()
    assert len(got) == len(odd_texts) and all(0 <= r.score <= 1 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False, False]
    empty = {r.score for r in got if r.doc_id in (1, 2, 3)}
    assert len(empty) == 1


def test_one_label_or_none(docs, labelled):
    rows = [(i, "some words here") for i in range(20)]
    [score] = {r.score for r in X.classify(docs(rows), labelled([(i, 1, 0) for i in range(20)])).collect()}
    assert score < 0.1
    [score] = {r.score for r in X.classify(docs(rows), labelled([])).collect()}
    assert score == 0.5
    assert X.classify(docs([]), labelled([])).collect() == []


def test_the_sample_is_bounded(docs, labelled, monkeypatch):
    rows, labels = corpus(400)
    monkeypatch.setattr(X, "SAMPLE", 50)
    found = X.training_rows(docs(rows), labelled(labels), lambda i: ~X.held_out(i))
    assert found.count() == 50


def test_gradient(monkeypatch):
    """What the steps follow is the slope of the loss that the docstring states."""
    r = np.random.default_rng(0)
    keys = np.arange(1, 9, dtype=np.uint64)
    features = [np.unique(r.integers(0, 8, 4)) for _ in range(30)]
    label = r.integers(0, 2, 30).astype(float)
    label[:2] = 0, 1
    swap = {0: 1, 1: 0, 5: 6, 6: 5}

    def loss(w, b):
        total = 0.0
        for f, y in zip(features, label):
            s = X._sigmoid(w[f].sum() + b)
            total -= y * np.log(s) + (1 - y) * np.log(1 - s)
            old = [c for c in f.tolist() if c in swap]
            for change in (sum(w[swap[c]] - w[c] for c in old), -sum(w[c] for c in old)):
                total += X.FAIRNESS * change**2
        return total / len(label) + X.STRENGTH * (w**2).sum()

    monkeypatch.setattr(X, "STRENGTH", 0.01)
    monkeypatch.setattr(X, "STEPS", 4000)
    model = X._solve(keys, label, features, swap)
    best = loss(model.weights, model.constant)
    for _ in range(200):
        step = r.normal(0, 0.01, 9)
        assert loss(model.weights + step[:8], model.constant + step[8]) >= best - 1e-7


def test_rows_to_learn_from_are_bounded(spark, docs, monkeypatch):
    """Few ids with very many rows, different ones and copies."""
    monkeypatch.setattr(X, "SAMPLE", 100)
    rows = docs([(i % 10, f"text {i}") for i in range(2000)] + [(3, "copy")] * 500)
    labels = spark.createDataFrame([(i, i % 2) for i in range(10)] * 3, "doc_id long, toxic int")
    got = X.training_rows(rows, labels, lambda i: F.lit(True)).collect()
    assert len(got) == 100 == len({(r.doc_id, r.text, r.label) for r in got})
