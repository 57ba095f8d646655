import collections
import math
import os
import random
import re
import zlib

import numpy as np
import pytest

from llm import language_model as L

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode().lower()) + ["END"]


class Brute:
    """Interpolated modified Kneser-Ney n-grams with plain dictionaries."""

    def __init__(self, texts, order=L.ORDER):
        self.order = order
        self.count = collections.Counter()
        self.ngrams = {n: collections.Counter() for n in range(1, order + 1)}
        for t in texts:
            w = words(t)
            self.count.update(w)
            self.ngrams[order].update(self.all(w))
        for n in range(order, 1, -1):
            for g in self.ngrams[n]:
                self.ngrams[n - 1][g[1:]] += 1
        self.total, self.distinct = sum(self.count.values()), len(self.count)
        self.follow = collections.defaultdict(list)
        for n in range(1, order + 1):
            for g, c in self.ngrams[n].items():
                self.follow[g[:-1]].append(c)
        self.d = {n: L._discounts(self._of(g.values())) for n, g in self.ngrams.items()}

    def all(self, w):
        """The longest n-gram that ends at each word."""
        w = ["START"] * (self.order - 1) + w
        return [tuple(w[i : i + self.order]) for i in range(len(w) - self.order + 1)]

    @staticmethod
    def _of(counts):
        c = collections.Counter(counts)
        return [c[i] for i in (1, 2, 3, 4)]

    def p(self, *gram):
        if not gram:
            return 1 / (self.distinct + 1)
        after, d = self.follow[gram[:-1]], self.d[len(gram)]
        if not after:
            return self.p(*gram[1:]) if len(gram) > 1 else 1.0
        c = self.ngrams[len(gram)][gram]
        left = sum(d[min(x, 3)] for x in after)
        return (max(c - d[min(c, 3)], 0) + left * self.p(*gram[1:])) / sum(after)

    def scores(self, text):
        w = words(text)
        base = sum(math.log10((self.count[x] + 1) / (self.total + self.distinct + 1)) for x in w)
        return len(w), sum(self.count[x] > 0 for x in w), base, sum(
            math.log10(self.p(*g)) for g in self.all(w)
        )


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def compare(docs, rows, order=L.ORDER):
    model = Brute([t for i, t in rows if not held_out(i)], order)
    got = L.score_documents(docs(rows), order).collect()
    key = lambda r: (str(r[0]), r[1], r[2], r[3], round(r[5], 6), round(r[6], 6))
    want = []
    for i, t in rows:
        n, known, base, score = model.scores(t)
        want.append((i, held_out(i), n, known, model.total, base, score))
    assert sorted(map(key, got)) == sorted(map(key, want))
    assert {r.train_tokens for r in got} <= {model.total}


def corpus(n, seed=0):
    r = random.Random(seed)
    vocabulary = [f"w{min(int(r.paretovariate(0.7)), 400)}" for _ in range(5000)] + ["É", "The", "the"]
    return [(i, " ".join(r.choices(vocabulary, k=r.randint(0, 80)))) for i in range(n)]


@pytest.mark.parametrize(("n", "order"), [(3, 3), (400, 2), (400, 3), (400, 5)])
def test_equals_brute_force(docs, n, order):
    compare(docs, corpus(n), order)


def test_odd_rows(docs, odd_texts):
    compare(docs, corpus(50) + [(None if i is None else 1000 + i, t) for i, t in odd_texts])


def test_batches_and_hot_words_do_not_matter(docs, monkeypatch):
    monkeypatch.setattr(L, "COUNTED", 500)
    monkeypatch.setattr(L, "HOT", 4)
    compare(docs, corpus(200, 3))


@pytest.mark.parametrize("order", [2, 3, 4])
def test_hot_words_in_several_shards(docs, monkeypatch, order):
    """Their contexts come together again from the parts that they were dealt to."""
    monkeypatch.setattr(L, "COUNTED", 500)
    monkeypatch.setattr(L, "HOT", 50)
    monkeypatch.setattr(L, "SHARD_TOKENS", 256)
    rows = corpus(200, 4)
    hot, size = L.hot_words(docs(rows))
    assert len(hot.words) > 3 and hot.parts.max() > 4 and L.START in hot.words
    assert size == sum(len(words(t)) for _, t in rows)
    compare(docs, rows, order)


@pytest.mark.parametrize("exact", [False, True])
def test_sections_hold_any_figures(tmp_path, exact):
    """Above 255 different rows there are exceptions; what is not there has zeros."""
    r = np.random.default_rng(5)
    keys = np.unique(r.integers(0, 2**64, 5000, np.uint64))
    values = [r.choice([1, 1, 2, 9], len(keys)), r.integers(0, 900, len(keys))]
    folder = f"file://{tmp_path}"
    none = [np.zeros(0, np.int64)] * 2
    sections = [L._section(keys[:0], none), L._section(keys, values, exact), L._section(keys[:1], [v[:1] for v in values])]
    found, _ = L._mapped(folder, L._write(folder, "any", sections))
    assert [f.n for f in found] == [0, len(keys), 1]
    asked = np.concatenate([keys, keys + np.uint64(2**40), r.integers(0, 2**64, 5000, np.uint64)])
    asked = r.permutation(asked)
    want = dict(zip(keys.tolist(), zip(*(v.tolist() for v in values))))
    got = found[1].find(asked).T.tolist()
    assert [tuple(x) for x in got] == [want.get(k, (0, 0)) for k in asked.tolist()]
    assert not found[0].find(asked).any()
    assert found[2].find(keys[:2]).T.tolist() == [list(want[int(keys[0])]), [0, 0]]


@pytest.mark.parametrize("order", [2, 3, 4])
def test_distinct_ngrams_of_any_size(order):
    """Numbers that fit 63 bits together, and such that do not."""
    r = np.random.default_rng(order)
    ids = [r.integers(0, 5, 300) for _ in range(order)]
    want = collections.Counter(zip(*(i.tolist() for i in ids)))
    for size in (5, 1 << 30):
        got, back, counts = L._distinct(ids, size, return_inverse=True, return_counts=True)
        found = list(zip(*(c.tolist() for c in got)))
        assert dict(zip(found, counts.tolist())) == want
        assert [found[i] for i in back] == list(zip(*(i.tolist() for i in ids)))


def test_an_order_below_two_is_refused(docs):
    with pytest.raises(ValueError):
        L.train(docs([]), 1)


def test_empty_table_and_nothing_to_learn_from(docs):
    assert L.score_documents(docs([])).collect() == []
    alone = next(i for i in range(100) if held_out(i))
    [r] = L.score_documents(docs([(alone, "a b")])).collect()
    assert (r.train_tokens, r.n_known, r.n_tokens) == (0, 0, 3)
    assert r.base_score == 0 and r.score == 0


def test_probabilities_add_up(docs):
    model = Brute([t for _, t in corpus(60)])
    for h in (("START", "START"), ("START", b"w1"), (b"w1", b"w2"), (b"never", b"w1"), (b"w1", b"never")):
        seen = sum(model.p(*h, w) for w in model.count)
        assert seen + model.p(*h, b"unseen") == pytest.approx(1)


def test_files_that_a_worker_has_open_are_bounded(tmp_path, monkeypatch):
    """A thousand shards, mapped or read into memory: the last used ones stay."""
    folder = f"file://{tmp_path}"
    paths = {}
    for shard in range(1000):
        keys = np.array([shard, shard + 5000], np.uint64)
        paths[shard] = L._write(folder, "ngrams", [L._section(keys, [np.array([1, 2])], exact=True)])
    hot = L.Hot(np.zeros(0, np.uint64), np.zeros(0, np.uint64))
    model = L.Model(folder, 2, 1000, hot, paths, {}, {}, 0.0, 1, 1, 1)
    look = model.open()
    assert model.open() is look

    def descriptors():
        return len(os.listdir("/proc/self/fd"))

    before = descriptors()
    for shard in [*range(1000), 3, 999]:
        [section] = look._sections(paths[shard])
        keys = np.array([shard + 5000, shard, 7777777], np.uint64)
        assert section.find(keys).tolist() == [[2, 1, 0]]
    assert len(look.maps) == L.MAPPED and descriptors() - before <= L.MAPPED + 5
    # Where nothing can be mapped, bytes are bounded.
    monkeypatch.setattr(L, "HELD", 24 * 10)
    monkeypatch.setattr(L, "_mapped", lambda *a: (real(*a)[0], 24))
    look = L.Lookup(model)
    for shard in range(100):
        look._sections(paths[shard])
    assert len(look.maps) == 10 and look.held == 240


def test_scores_do_not_depend_on_shards(docs, monkeypatch):
    rows = [(i, f"the cat sat on mat {i % 7} and the dog {i % 3} ran") for i in range(80)]

    def scores():
        return sorted((r.doc_id, round(r.score, 9)) for r in L.score_documents(docs(rows)).collect())

    few = scores()
    monkeypatch.setattr(L, "SHARD_TOKENS", 16)
    assert scores() == few


real = L._mapped
