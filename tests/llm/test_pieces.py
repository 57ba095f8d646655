import os
import random

import pyarrow as pa
import pytest
from pyspark.sql.types import StringType, StructField, StructType

from llm import pieces, text

pytestmark = pytest.mark.skipif(not os.path.exists(pieces.MODEL), reason="no vocabulary file")


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load_vocabulary()


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def ids_of(encoder, text):
    return list(memoryview(encoder.encode(text)).cast("i"))


def texts():
    r = random.Random(4)
    parts = ["a", "b", "t", "he", "in", "the", " ", "  ", "½", "é", "ing", "er", "qzx", "\n", "你", "ß", ".", "\x00", "😀", "▁"]
    out = ["", " ", "   ", " " * 40 + "x", "x" + " " * 17, "hello world", "<s>", "a" * 700, "ab" * 300]
    out += ["".join(r.choices(parts, k=r.randint(1, 60))) for _ in range(400)]
    return out


def test_ids_equal_the_library(vocabulary, library):
    encoder = pieces.Encoder(vocabulary)
    for t in texts():
        assert ids_of(encoder, t) == library.encode(t)


def test_runs_end_where_no_piece_goes_on(vocabulary, library):
    """A word is one memory, whatever stands behind it."""
    encoder = pieces.Encoder(vocabulary)
    text = "end. The end, END!\nend the"
    assert ids_of(encoder, text) == library.encode(text)
    assert {"▁end", "▁the", ".", ",", "!\n", "end"} <= set(encoder)
    assert not {"▁end.", "▁end,", "▁END!\nend"} & set(encoder)
    assert all(encoder.find(p) == [p] for p in vocabulary.ids)
    r = random.Random(5)
    chars = sorted({c for p in vocabulary.ids for c in p}) + list("\n\t0½² 你😀\x00")
    for _ in range(400):
        t = "".join(r.choices(r.choices(chars, k=12) + ["the", " ", "."], k=30))
        assert "".join(encoder.find(t)) == t
        assert ids_of(encoder, t) == library.encode(t)


def test_vocabularies_of_other_kinds():
    """Joined kinds grow together; without any, only spaces cut."""
    assert pieces.segments_of(["a", "▁b"]).findall("ab.▁▁c▁") == ["ab.", "▁▁c", "▁"]
    assert pieces.segments_of(["ab", "cd", "bc", "]^", "▁("]).findall("abcd]^x▁▁(a") == [
        "abcd", "]^x", "▁▁(", "a",
    ]
    assert pieces.segments_of(["-]", "]^", "ab"]).findall("-]^a▁-") == ["-]^", "a", "▁-"]


def test_single_characters_are_not_looked_up(vocabulary):
    """What is left if no longer piece fits needs no test."""
    encoder = pieces.Encoder(vocabulary)
    for w in ("▁qzxhello", "wörter", "▁tionerth"):
        assert encoder._short(w) == list(encoder.stream(w))
    assert encoder.after and min(map(len, encoder.after)) > 1


def test_round_trip(vocabulary):
    encoder = pieces.Encoder(vocabulary)
    for t in texts():
        assert pieces.decode(ids_of(encoder, t), vocabulary) == t.replace("▁", " ")


def test_streaming_commits_early_and_like_the_whole(vocabulary):
    encoder = pieces.Encoder(vocabulary)
    r = random.Random(1)
    word = "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=5000))
    read = 0

    def feed():
        nonlocal read
        for c in word:
            read += 1
            yield c

    out, most = [], 0
    for piece in encoder.stream(feed()):
        out.append(piece)
        most = max(most, read - sum(map(len, out)))
    assert "".join(out) == word and most < 10 * vocabulary.longest
    assert out == encoder._short(word)


def test_memory_is_bounded(vocabulary, monkeypatch):
    monkeypatch.setattr(pieces, "CACHED", 20)
    encoder = pieces.Encoder(vocabulary)
    want = pieces.Encoder(vocabulary)
    for t in texts()[:100]:
        assert ids_of(encoder, t) == list(memoryview(want.encode(t)).cast("i"))
        assert len(encoder) <= 20 and len(encoder.pairs) <= 6


def test_few_segments_are_held_and_used_ones_stay(vocabulary, monkeypatch):
    """Words that are seen once go, in both generations, and one that comes again stays."""
    monkeypatch.setattr(pieces, "CACHED", 600)
    encoder = pieces.Encoder(vocabulary)
    for i in range(1000):
        assert ids_of(encoder, f"word{i} again") == ids_of(encoder, f"word{i} again")
        assert len(encoder) + len(encoder.older) <= 200
    assert "▁again" in encoder and "▁word1" not in {**encoder, **encoder.older}


def test_a_task_gives_freed_batches_back(vocabulary, monkeypatch):
    """Workers live on between tasks, beside stages that need the memory."""
    given = []
    monkeypatch.setattr(text, "give_back", lambda: given.append("slices"))
    monkeypatch.setattr(pieces, "give_back", lambda: given.append("encode"))

    class Docs:
        schema = StructType([StructField("text", StringType())])
        select = lambda self, *names: self
        mapInArrow = lambda self, work, schema: work

    batch = pa.RecordBatch.from_pydict({"text": ["a b", None]})
    assert len(list(text.slices(iter([batch])))) == 1 and given == ["slices"]
    assert sum(b.num_rows for b in pieces.encode(Docs(), vocabulary)(iter([batch]))) == 2
    assert given == ["slices", "encode"]


def test_states_are_bounded_and_found_once(vocabulary, monkeypatch):
    """Pieces that end at a character come from the state there, not from a new search."""
    encoder = pieces.Encoder(vocabulary)
    r = random.Random(3)
    words = ["".join(r.choices("abcdefghij", k=9)) for _ in range(300)]
    first = [encoder._short(w) for w in words]
    states, asked = dict(encoder.states), []
    monkeypatch.setattr(encoder, "_next", lambda *a: asked.append(a))
    monkeypatch.setattr(encoder, "_stay_apart", lambda *a: asked.append(a))
    assert [encoder._short(w) for w in words] == first and asked == [] and encoder.states == states
    monkeypatch.setattr(pieces, "CACHED", 300)
    small = pieces.Encoder(vocabulary)
    for w, want in zip(words, first):
        assert small._short(w) == want
        assert small.learnt <= 100 and len(small.states) + sum(map(len, small.after.values())) <= 101


def test_columns_and_odd_rows(spark, docs, odd_texts, vocabulary, library):
    df = docs(odd_texts).withColumnRenamed("bands", "n_ids")
    out = pieces.encode(df, vocabulary)
    assert out.columns == ["doc_id", "text", "lang", "n_words", "kept", "n_ids", "ids_sha256", "round_trip", "ids"]
    for r in out.collect():
        assert r.ids == library.encode(r.text or "") and r.n_ids == len(r.ids) and r.round_trip
    back = pieces.decode_column(out.select("doc_id", "ids"), vocabulary).collect()
    assert sorted(r.text for r in back) == sorted((t or "") for _, t in odd_texts)
    none = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert pieces.decode_column(none, vocabulary).collect()[0].text is None


def test_empty_table_and_dropped_text(docs, vocabulary):
    out = pieces.encode(docs([]), vocabulary, keep=False)
    assert "text" not in out.columns and out.collect() == []
