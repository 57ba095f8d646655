import itertools
import random

import pytest

from llm import decontamination as D


@pytest.fixture
def bench(spark):
    def make(pairs):
        return spark.createDataFrame([(i, t, 3) for i, t in pairs], "item_id long, text string, n_items int")

    return make


def brute(text, items):
    own = (text or "").lower().split()
    out = set()
    for item, t in items:
        theirs = (t or "").lower().split()
        width = min(len(theirs), D.WINDOW)
        if len(theirs) < D.SHORTEST:
            continue
        for shift in range(-len(theirs), len(own)):
            same = [
                0 <= shift + j < len(own) and own[shift + j] == w for j, w in enumerate(theirs)
            ]
            if any(100 * sum(same[j : j + width]) >= D.MATCH * width for j in range(len(same))):
                out.add(item)
                break
    return out


def cases(seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["the", "of"] * 40
    some = lambda n: r.choices(vocabulary, k=n)
    items = [(i, " ".join(some(n))) for i, n in enumerate([4, 5, 6, 8, 9, 10, 11, 12, 13, 14, 30, 45])]
    items += [(50, items[-1][1]), (51, ""), (52, None), (53, "The of the OF the of the of the of")]
    rows = []
    for _, t in items[:13]:
        words = t.split()
        for wrong in range(0, 9, 2):
            copy = [w if r.random() > wrong / max(len(words), 10) else "other" for w in words]
            rows.append(" ".join([*some(r.randint(0, 20)), *copy, *some(r.randint(0, 20))]))
        rows.append(" ".join(words[: len(words) // 2]))
        rows.append(" ".join(some(3) + words[-13:]).upper())
    rows += ["the of " * 30, "", None, "  "]
    return items, list(enumerate(rows))


@pytest.mark.parametrize("seed", range(2))
def test_equals_brute_force(docs, bench, seed):
    items, rows = cases(seed)
    got = D.contaminated(docs(rows), bench(items)).collect()
    want = {i: brute(t, items) for i, t in rows}
    assert {r.doc_id: r.n_items for r in got} == {i: len(s) for i, s in want.items()}
    assert {r.doc_id: r.first_item for r in got} == {i: min(s, default=None) for i, s in want.items()}
    assert all(r.contaminated == (r.n_items > 0) for r in got)


def test_blocks_of_items_give_the_same(docs, bench, monkeypatch):
    items, rows = cases(3)
    whole = sorted(D.contaminated(docs(rows), bench(items)).collect(), key=str)
    monkeypatch.setattr(D, "BLOCK", 60)
    assert sorted(D.contaminated(docs(rows), bench(items)).collect(), key=str) == whole


@pytest.mark.parametrize("width", range(D.SHORTEST, D.WINDOW + 1))
def test_masks_lose_no_passage(width):
    """Wherever the allowed other words stand, one seed of the masks is whole."""
    need = -(-width * D.MATCH // 100)
    masks = D.MASKS[max(n for n in D.MASKS if n <= width)]
    for other in itertools.combinations(range(width), width - need):
        assert any(
            not {at + p for p in mask} & set(other)
            for mask in masks
            for at in range(width - mask[-1])
        )


def test_dropping_keeps_columns_and_clean_rows(docs, bench):
    passage = " ".join(f"q{i}" for i in range(20))
    rows = [(1, f"a {passage} b"), (2, "clean"), (None, passage), (None, None), (2, passage)]
    kept = D.drop_contaminated(docs(rows), bench([(7, passage)]))
    assert kept.columns == docs(rows).columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("2", "clean"), ("None", None)]


def test_empty_tables(docs, bench):
    assert D.contaminated(docs([]), bench([(1, "a b c d e f")])).collect() == []
    [row] = D.contaminated(docs([(1, "a b c d e f")]), bench([])).collect()
    assert (row.n_items, row.contaminated) == (0, False)


def test_odd_rows(docs, bench, odd_texts):
    items = [(1, " ".join(odd_texts[6][1].split()[500:530])), (None, "q r s t u v w x y z a b c d")]
    got = D.contaminated(docs(odd_texts), bench(items)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in odd_texts)
    assert [r.doc_id for r in got if r.contaminated] == [7]


def test_no_python_in_the_plan(docs, bench):
    df = D.contaminated(docs([(1, "a b c d e f g")]), bench([(1, "a b c d e f g")]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
