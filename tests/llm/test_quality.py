import collections
import re

import pytest

from llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    chars = sum(map(len, words))
    lines, again, line_chars = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            if line in lines:
                again += 1
                line_chars += sum(map(len, WORD.findall(line)))
            lines.add(line)
    inside = {}
    for n in quality.NGRAM_LIMITS:
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        inside[n] = {j for i, g in enumerate(grams) if g in grams[:i] for j in range(i, i + n)}
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = collections.Counter(grams)
    repeat = {j for i, g in enumerate(grams) if count[g] > 1 for j in range(i, i + 5)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 10 or 100 * len(repeat) > 20 * len(words)
    kept = not failed and 100 * line_chars <= 20 * chars and 100 * symbols <= 10 * len(words)
    for n, limit in quality.NGRAM_LIMITS.items():
        kept = kept and 100 * sum(len(words[i]) for i in inside[n]) <= limit * chars
    return (len(words), chars, symbols, again, len(repeat), failed, kept)


CASES = [
    "a b c d e f g h i j k l m n o p",
    "a b c d e f g a b c d e f g a b c",
    "line one is here\nline one is here\nline two\n\n\n line one is here",
    "é日本 " * 30,
    "#### $$ one two three four five six seven eight nine ten",
    "\n\n\n",
    "same\nsame\nsame\r\nsame\r",
    " ".join(f"w{i % 40}" for i in range(90)),
    " ".join(f"w{i % 40}" for i in range(45)) + " " + " ".join(f"v{i}" for i in range(300)),
]


def figures(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept)


def test_equals_brute_force(docs, odd_texts):
    odd_texts[6] = (7, odd_texts[6][1][:9000])
    rows = [(100 + i, t) for i, t in enumerate(CASES)] + odd_texts
    got = quality.with_quality(docs(rows)).collect()
    want = sorted((str(i), brute(t)) for i, t in rows)
    assert sorted((str(r.doc_id), figures(r)) for r in got) == want


def test_own_columns_stay_and_clashing_ones_are_replaced(docs):
    out = quality.with_quality(docs([(1, "a b")]))
    assert out.columns[:3] == ["doc_id", "text", "lang"]
    assert out.columns.count("n_words") == 1 and dict(out.dtypes)["kept"] == "boolean"


@pytest.mark.parametrize("slice_", [1, 60, 10**6])
def test_slices_do_not_matter(docs, monkeypatch, slice_):
    monkeypatch.setattr(quality.T.slices, "__defaults__", ("text", slice_))
    rows = [(i, t) for i, t in enumerate(CASES)]
    got = {r.doc_id: figures(r) for r in quality.with_quality(docs(rows, 1)).collect()}
    assert [got[i] for i in range(len(CASES))] == [brute(t) for t in CASES]


def test_empty_table(docs):
    assert quality.with_quality(docs([])).collect() == []
