"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from llm import spelling as S


def small(run):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)


def counted(pairs):
    counts = Counter()
    for doc_id, text in pairs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = small(run)
            mark = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if mark % 97 == 0:
                run = run[: mark % len(run)] + run[mark % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def brute(words):
    near = {w: sorted(v for v in words if v != w and one_edit(w, v)) for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words[form[w]] if form[w] else None)
    return out


def results(df):
    rows = df.collect()
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(got) == len(rows)
    return got


def random_words(seed, n, letters="abcé", least=5, most=8):
    r = random.Random(seed)
    return {"".join(r.choices(letters, k=r.randint(least, most))): r.choice([3, 4, 8, 20, 60]) for _ in range(n)}


def table(spark, words, parts=3):
    return spark.createDataFrame(list(words.items()), "word string, n long").repartition(parts)


def test_words_of_few_letters(spark):
    words = random_words(1, 700)
    assert results(S.variants(table(spark, words))) == brute(words)


def test_buckets_are_split(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 5)
    monkeypatch.setattr(S, "TILE", 4)
    words = random_words(2, 400, "abÿ", 5, 9)
    assert results(S.variants(table(spark, words))) == brute(words)


def test_documents(spark, docs, odd_texts):
    r = random.Random(7)
    words = list(random_words(3, 60, "teèn", 4, 7))
    pairs = [(i, " ".join(r.choices(words, k=80)) + "; Step×STEP÷step x") for i in range(90)]
    pairs += [(None, "nullid " * 9), (4, pairs[4][1]), *odd_texts]
    pairs.append((200, "-".join(r.choices(words, k=3000))))
    got = results(S.spelling_variants(docs(pairs)))
    assert got == brute(counted(pairs)) and len(got) > 50


def test_chains_lead_to_one_root(spark):
    chain = ["aaaaa", "aaaab", "aaabb", "aabbb", "abbbb", "bbbbb", "bbbbbb", "bbbbbc"]
    words = {w: 3 * 2**i for i, w in enumerate(chain)}
    got = results(S.variants(table(spark, words)))
    assert got == brute(words) and got["aaaaa"][1] == "bbbbbc"


def test_ties_take_the_smallest_word(spark):
    words = {"steps": 3, "stepz": 9, "stepa": 9, "stops": 9, "stipé": 3}
    got = results(S.variants(table(spark, words)))
    assert got == brute(words) and got["steps"][0] == "stepa"


def test_very_long_words(spark):
    long = "ab" * 3000
    words = {long: 3, long + "c": 9, long[:-1] + "c": 4, long[:-2] + "ba": 5, "b" + long[:-1]: 5}
    assert results(S.variants(table(spark, words))) == brute(words)


def test_pieces_of_a_long_text_cut_no_word(monkeypatch):
    monkeypatch.setattr(S, "PIECE", 7)
    text = "abc defghijklmnop, éèê" * 9
    assert "".join(S._pieces(text)) == text
    assert [r for p in S._pieces(text) for r in S.RUN.findall(p)] == S.RUN.findall(text)


@pytest.mark.parametrize("pairs", [[], [(1, None), (2, ""), (3, "few of them")]])
def test_no_words(docs, pairs):
    assert S.spelling_variants(docs(pairs)).collect() == []
