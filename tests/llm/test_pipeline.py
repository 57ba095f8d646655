import os
import random

import pytest

import __spark_entry__ as driver
import corpus_pipeline
from llm import pieces, pii
from tests.llm.test_pii import planted

FOLDER = driver.SMALLEST

pytestmark = pytest.mark.skipif(
    not (os.path.isdir(FOLDER) and os.path.exists(pieces.MODEL)), reason="no tables"
)


def words(n, start):
    return " ".join(f"{start}{i}" for i in range(n))


@pytest.fixture
def folder(spark, tmp_path):
    """Documents of which it is plain what each stage does with them."""
    item = words(30, "bench")
    near = words(200, "near")
    rows = [
        (1, words(60, "clean")), (2, near), (3, near + " more"), (4, near),
        (5, words(20, "x") + " " + item + " " + words(20, "y")),
        (6, "same line of words here\n" * 30), (7, "short"), (8, None), (9, ""),
        (10, words(40, "mail") + " to me@home.org and 1.2.3.4 now"),
        (None, words(50, "null")), (11, words(60, "clean")),
    ]
    docs = [(i, t, "en", f"s{(i or 0) % 2}", len(t or "")) for i, t in rows]
    path = str(tmp_path)
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{path}/documents.parquet"
    )
    spark.createDataFrame([(1, item), (2, "")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_each_stage_decides(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, left = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        left[name] = sorted(str(r.doc_id) for r in docs.collect())
    assert left["quality"] == ["1", "10", "11", "2", "3", "4", "5", "None"]
    assert left["near_duplicates"] == ["1", "10", "2", "5", "None"]
    assert left["decontamination"] == ["1", "10", "2", "None"]
    assert left["personal_data"] == left["decontamination"]
    text = {r.doc_id: r for r in docs.collect()}
    assert text[10].text.endswith(" to [EMAIL] and [IP] now")
    assert all(r.n_chars == len(r.text) for r in text.values())


SHAPE = "doc_id long, text string, lang string, source string, n_chars long"


def kept_rows(spark, pairs):
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in pairs], SHAPE).repartition(3)
    out = corpus_pipeline.keep_one_of_each(spark, docs, "")
    assert out.columns == docs.columns
    return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)


def test_near_duplicates_are_judged_by_row(spark):
    text, other = words(40, "t"), words(40, "u")
    got = kept_rows(spark, [(None, text), (None, text), (3, text), (7, text), (7, other)])
    assert got == sorted([(3, text), (7, other)], key=str)


def test_near_duplicates_against_brute_force(spark):
    """Null and repeated ids, copies, near copies, texts without words."""
    r = random.Random(6)
    pairs = []
    for i in range(60):
        text = words(60, f"g{r.randint(0, 12)}x").split()
        for _ in range(r.randint(0, 2)):
            text[r.randint(0, 59)] = f"new{r.randint(0, 99)}"
        pairs.append((r.choice([None, r.randint(0, 20)]), " ".join(text)))
    pairs += [(None, None), (None, ""), (5, None), (5, " "), *pairs[:6]]
    sets = [{tuple(t.split()[k : k + 5]) for k in range(56)} if t and t.strip() else set() for _, t in pairs]
    group = list(range(len(pairs)))
    for a in range(len(pairs)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) > 0:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    chosen = {}
    for (i, t), g in zip(pairs, group):
        chosen.setdefault(g, []).append((i is None, i or 0, i, t))
    ids = sorted(str(min(m[:2] for m in of)) for of in chosen.values())
    got = kept_rows(spark, pairs)
    assert sorted(str((i is None, i or 0)) for i, _ in got) == ids
    # No text is lost with all that are like it.
    left = [{tuple(t.split()[k : k + 5]) for k in range(56)} for _, t in got if t and t.strip()]
    reach = {g for g, s in zip(group, sets) if s in left}
    assert reach == {g for g, s in zip(group, sets) if s}


def test_run_gives_ids_that_decode(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    vocabulary = pieces.load_vocabulary()
    got = {r.doc_id: r for r in out.collect()}
    assert sorted(got, key=str) == [1, 10, 2, None]
    assert pieces.decode(got[1].ids, vocabulary) == words(60, "clean")
    assert all(r.round_trip and r.n_ids == len(r.ids) for r in got.values())


def test_empty_table(spark, folder, tmp_path):
    none = str(tmp_path / "none")
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{none}/{name}.parquet")
    assert corpus_pipeline.run(spark, none).collect() == []


def test_run_over_the_tables(spark):
    """A row for each document that the stages before the last one keep."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = corpus_pipeline.run(spark, FOLDER).collect()
    ids = [r.doc_id for r in out]
    assert len(set(ids)) == len(ids) and 0 < len(ids) <= docs.count()
    assert all(r.round_trip for r in out)


def test_personal_data_is_learnt_from_all_rows(spark, docs, monkeypatch):
    """The stage finds forms without the deciding signs whatever the size of a sample."""
    monkeypatch.setattr(pii, "SAMPLE", 4)
    rows, wanted = planted(250)
    out = corpus_pipeline.redact_personal_data(spark, docs(rows), "")
    texts = {r.doc_id: r.text for r in out.collect()}
    redacted = [i for i in wanted if texts[i] == "she said [PHONE] and [EMAIL] too"]
    assert len(redacted) >= 0.9 * len(wanted)
