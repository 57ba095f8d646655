import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from llm import substring_dedup, suffix_dedup
from llm import superkmers as S

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute_words(texts):
    n = substring_dedup.WINDOW
    words = [WORD.findall((t or "").encode()) for t in texts]
    seen = collections.Counter(
        tuple(w[i : i + n]) for w in words for i in range(len(w) - n + 1)
    )
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - n + 1):
            if seen[tuple(w[i : i + n])] > 1:
                gone.update(range(i, i + n))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def brute_bytes(texts):
    n = suffix_dedup.WIDTH
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(d[i : i + n] for d in data for i in range(len(d) - n + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - n + 1):
            if seen[d[i : i + n]] > 1:
                gone[i : i + n] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(np.frombuffer(d, np.uint8)[~gone[:-1]])
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def texts(seed):
    """Copies, passages in other surroundings, repeats inside a text, edges of all sizes."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choices("abcdefé日", k=r.randint(1, 8))) for _ in range(400)]
    some = lambda n: " ".join(r.choices(vocabulary, k=n))
    passages = [some(n) for n in (34, 35, 36, 60, 90, 140)]
    out = [some(r.randint(0, 300)) for _ in range(25)]
    out += [out[0]] * 4 + [out[1] + " tail", "head " + out[1], out[1][5:]]
    for p in passages:
        out += [f"{some(r.randint(0, 50))} {p}\n{some(r.randint(0, 50))}" for _ in range(3)]
        out += [p, p.replace(" ", "  ")]
    out += ["a " * 200, "ab" * 600, "x" * 399, "x" * 400, "x" * 401, some(3000)]
    out += [out[-1][100:9000], "", None, "   "]
    return out


@pytest.mark.parametrize("seed", range(2))
def test_words_equal_brute_force(docs, seed):
    all_ = texts(seed)
    got = substring_dedup.dedup_substrings(docs(enumerate(all_))).collect()
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got}
    assert [found[i] for i in range(len(all_))] == brute_words(all_)


@pytest.mark.parametrize("seed", range(2))
def test_bytes_equal_brute_force(docs, seed):
    all_ = texts(seed)
    got = suffix_dedup.dedup_bytes(docs(enumerate(all_))).collect()
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got}
    assert [found[i] for i in range(len(all_))] == brute_bytes(all_)


def test_odd_rows(docs, odd_texts):
    ids, all_ = zip(*odd_texts)
    words = substring_dedup.dedup_substrings(docs(odd_texts)).collect()
    want = sorted(zip(map(str, ids), brute_words(all_)))
    assert sorted((str(r.doc_id), (r.n_words, r.n_removed, r.kept_sha256)) for r in words) == want
    bytes_ = suffix_dedup.dedup_bytes(docs(odd_texts)).collect()
    want = sorted(zip(map(str, ids), brute_bytes(all_)))
    got = sorted((str(r.doc_id), (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in bytes_)
    assert got == want


def test_rows_of_one_id_are_told_apart(docs):
    long = " ".join(f"w{i}" for i in range(60))
    rows = docs([(1, long), (1, "other"), (2, long)])
    got = substring_dedup.dedup_substrings(rows).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in got) == [(1, 1, 0), (1, 60, 60), (2, 60, 60)]


def test_rows_without_id_and_with_equal_crc_are_told_apart(docs):
    """Two null ids, texts of one 32-bit checksum: only the one with the passage loses it."""
    passage = " ".join(f"passage{i}" for i in range(60))
    alone = " ".join(f"alone{i}" for i in range(70))
    tails = [hashlib.sha256(b"%d" % i).hexdigest()[:16] for i in range(200_000)]
    start = zlib.crc32(f"{passage} ".encode())
    ends = {zlib.crc32(t.encode(), start): t for t in tails}
    start = zlib.crc32(f"{alone} ".encode())
    crc = lambda t: zlib.crc32(t.encode(), start)
    tail = next(t for t in tails if crc(t) in ends)
    texts = [f"{passage} {ends[crc(tail)]}", f"{alone} {tail}", passage]
    assert zlib.crc32(texts[0].encode()) == zlib.crc32(texts[1].encode())
    rows = docs(zip([None, None, 1], texts))
    words = substring_dedup.dedup_substrings(rows).collect()
    assert sorted((r.n_words, r.n_removed) for r in words) == [(60, 60), (61, 60), (71, 0)]
    bytes_ = suffix_dedup.dedup_bytes(rows).collect()
    want = sorted(x[:2] for x in brute_bytes(texts))
    assert sorted((r.n_bytes, r.n_removed) for r in bytes_) == want


@pytest.mark.parametrize("op", [substring_dedup, suffix_dedup])
def test_spans_of_equal_rows_are_kept_once(docs, op):
    long = " ".join(f"word{i}" for i in range(100))
    keyed, found = op.repeated_spans(docs([(None, long)] * 40))
    for r in S.with_spans(keyed, found).collect():
        assert r.spans and len(set(r.spans)) == len(r.spans)


def test_empty_table(docs):
    assert substring_dedup.dedup_substrings(docs([])).collect() == []
    assert suffix_dedup.dedup_bytes(docs([])).collect() == []


def test_buckets_follow_the_text_and_not_the_session(spark, docs):
    assert S.buckets_for(0) == S.BUCKETS_A_TASK
    assert S.buckets_for(30 << 30) * S.BUCKET_TEXT >= 30 << 30
    keyed = S.with_row_key(docs([(i, f"row {i} " * 50) for i in range(40)]))
    size = sum(len(f"row {i} " * 50) for i in range(40))
    assert substring_dedup.hot_mers(keyed)[1] == suffix_dedup.hot_grams(keyed)[2] == size


def test_frequent_runs_are_bounded(docs, monkeypatch):
    """Far more runs of words are in all rows than may be looked out for."""
    monkeypatch.setattr(substring_dedup, "HOT_MERS", 20)
    text = " ".join(f"w{i}" for i in range(300))
    rows = docs([(i, text) for i in range(50)])
    assert len(substring_dedup.hot_mers(S.with_row_key(rows))[0]) == 20
    got = substring_dedup.dedup_substrings(rows).collect()
    assert {(r.n_words, r.n_removed) for r in got} == {(300, 300)}


@pytest.mark.parametrize("op", [substring_dedup, suffix_dedup])
def test_many_buckets_in_few_tasks(docs, monkeypatch, op):
    monkeypatch.setattr(S, "BUCKET_TEXT", 1 << 12)
    r = random.Random(8)
    texts = [" ".join(f"w{r.randint(0, 40)}" for _ in range(r.randint(0, 300))) for _ in range(60)]
    texts += [texts[3] + " " + texts[9], texts[5][7:]]
    run = {substring_dedup: substring_dedup.dedup_substrings, suffix_dedup: suffix_dedup.dedup_bytes}[op]
    many = {r.doc_id: r.kept_sha256 for r in run(docs(enumerate(texts))).collect()}
    monkeypatch.setattr(S, "BUCKET_TEXT", 1 << 30)
    assert many == {r.doc_id: r.kept_sha256 for r in run(docs(enumerate(texts))).collect()}


def test_hot_passage_in_many_rows(docs):
    """A passage in all rows: its runs of words are hot, and every row loses just it."""
    passage = " ".join(f"p{i}" for i in range(50))
    rows = [(i, f"{i}a {i}b {passage} {i}c") for i in range(400)]
    got = substring_dedup.dedup_substrings(docs(rows)).collect()
    assert {(r.n_words, r.n_removed) for r in got} == {(53, 50)}


def test_hot_line_is_not_one_bucket(docs):
    """A line in all rows, shorter than a window: no bucket gets a string of every row."""
    r = random.Random(3)
    some = lambda n: "".join(r.choices("abcdefghijklmnop ", k=n))
    for size in (16, 60, 200, 330, 399):
        line = some(size)
        texts = [some(500) + line + some(500) for _ in range(150)]
        texts += [texts[7][100:], some(300) + texts[9][200:900]]
        rows = docs(enumerate(texts))
        keyed = S.with_row_key(rows)
        find = suffix_dedup._finder(*suffix_dedup.hot_grams(keyed)[:2])
        packed = S.pack(keyed, find, suffix_dedup.WIDTH, 1, with_minimiser=True)
        blobs = [x.packed for x in packed.select("packed").filter("packed is not null").collect()]
        of = np.concatenate([S._thaw(b).minimiser for b in blobs])
        assert np.unique(of, return_counts=True)[1].max() < 30, size
        if size in (200, 399):
            got = {x.doc_id: x for x in suffix_dedup.dedup_bytes(rows).collect()}
            found = [
                (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256)
                for x in (got[i] for i in range(len(texts)))
            ]
            assert found == brute_bytes(texts)


@pytest.mark.parametrize("seed", range(6))
def test_suffix_array(seed):
    r = random.Random(seed)
    for size in (0, 1, 2, 3, 10, 60, 400):
        s = [r.randint(1, 1 + seed) for _ in range(size)]
        order = suffix_dedup.suffix_array(s)
        assert order == sorted(range(size + 1), key=lambda i: s[i:])
        room = np.arange(size, 0, -1)
        shared = suffix_dedup.common_prefixes(np.array(s, int), np.array(order), room).tolist()
        for a, b, n in zip(order, order[1:], shared[1:]):
            want = 0
            while s[a + want : a + want + 1] and s[a + want : a + want + 1] == s[b + want : b + want + 1]:
                want += 1
            assert n == want
