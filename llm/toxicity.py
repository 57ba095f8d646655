"""Toxicity: a linear classifier that identity terms are kept from moving."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import text as T
from sieveframe.sources.scratch import settle

# At most so many labelled rows are fitted on, and so many features kept.
SAMPLE = 10_000
FEATURES = 4_096
MIN_ROWS = 5
THRESHOLD = 0.7
PREFIXES = (4, 5, 6)
STRENGTH = 1e-4  # of the squared weights
FAIRNESS = 1.0  # of the squared change of log odds when identity terms are swapped
STEPS = 400

# Terms for groups of people; those of one line stand for each other.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("female", "male"),
    ("gay", "straight", "lesbian", "bisexual", "heterosexual"),
    ("transgender", "cisgender"),
    ("black", "white", "asian", "latino", "arab"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("immigrant", "refugee", "foreigner", "native"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("disabled", "blind", "deaf"),
    ("old", "young", "elderly", "teenage"),
)

# Words here end at any ASCII character that is no letter, digit or apostrophe.
_CUT = np.zeros(256, bool)
_CUT[:128] = True
_CUT[[*range(48, 58), *range(65, 91), *range(97, 123), 39]] = False


def _tokens(data: np.ndarray, offsets: np.ndarray):
    """Row, and one hash array for words and each prefix length; 0 where there is none.

    Identity terms have no prefixes, whose weights a swap would not reach.
    """
    data = T.lower(data)
    flat = np.where(_CUT[data], np.uint8(0x20), data)
    w = T.words(flat, offsets, hashed=False)
    rolling = T.rolling_bytes(flat)
    whole = rolling.of(w.starts, w.ends)
    terms, _ = _identity()
    plain = terms[np.minimum(np.searchsorted(terms, whole), len(terms) - 1)] != whole
    out = [whole]
    for n in PREFIXES:
        long = (w.ends - w.starts > n) & plain
        h = rolling.of(w.starts, np.minimum(w.starts + n, w.ends)) ^ np.uint64(n)
        out.append(np.where(long, h, np.uint64(0)))
    return w.row, out


def hash_word(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(T.rolling_bytes(data).of(np.array([0]), np.array([len(data)]))[0])


@functools.cache
def _identity() -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of all terms, and the hash of the one each is swapped for."""
    swap = {}
    for line in IDENTITY_TERMS:
        codes = [hash_word(t) for t in line]
        swap.update(zip(codes, codes[1:] + codes[:1]))
    keys = np.array(sorted(swap), np.uint64)
    return keys, np.array([swap[int(k)] for k in keys], np.uint64)


@dataclass
class Model:
    """Sorted feature hashes with a weight each, and the constant."""

    keys: np.ndarray
    weights: np.ndarray
    constant: float

    def rows(self, data: np.ndarray, offsets: np.ndarray):
        """(row, feature) of the features in each row, once each."""
        if not len(self.keys):
            none = np.zeros(0, np.int64)
            return none, none
        row, hashes = _tokens(data, offsets)
        found = []
        for h in hashes:
            i = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            hit = np.flatnonzero(self.keys[i] == h)
            found.append(row[hit] * len(self.keys) + i[hit])
        both = np.unique(np.concatenate(found))
        return both // len(self.keys), both % len(self.keys)

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        rows = len(offsets) - 1
        row, feature = self.rows(data, offsets)
        return _sigmoid(np.bincount(row, self.weights[feature], rows) + self.constant)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit(texts: DataFrame) -> Model:
    """A model of the rows (text, label 0 or 1), of which the caller bounds the number.

    Features are words and word starts that are there in MIN_ROWS rows at least: the
    FEATURES whose rows' labels differ most from the others', by a z-score of the log
    odds. Then a logistic loss is made least, plus the squared change of the score's
    log odds when the identity terms in a row are swapped: once for others of their
    kind, once for a word that names no group. Only features, and which of them a row
    has, come to the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.slices(batches):
            label = np.asarray(part.rows.column("label"), np.int64)
            row, hashes = _tokens(part.data, part.offsets)
            value = np.concatenate(hashes)
            rows = np.tile(row, len(hashes))[value != 0]
            value = value[value != 0]
            order = np.lexsort((rows, value))
            value, rows = value[order], rows[order]
            new = np.ones(len(value), bool)
            new[1:] = (value[1:] != value[:-1]) | (rows[1:] != rows[:-1])
            value, rows = value[new], rows[new]
            keys, at = np.unique(value, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys.view(np.int64)),
                    pa.array(np.bincount(at, label[rows], len(keys)).astype(np.int64)),
                    pa.array(np.bincount(at, minlength=len(keys))),
                ],
                names=["feature", "ones", "n"],
            )

    total = texts.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("ones")).first()
    rows, ones = total["n"], total["ones"] or 0
    if rows == 0 or ones in (0, rows):
        constant = float(np.log((ones + 0.5) / (rows - ones + 0.5)))
        return Model(np.zeros(0, np.uint64), np.zeros(0), constant)
    a, b = F.col("ones") + 0.5, F.col("n") - F.col("ones") + 0.5
    c, d = F.lit(ones) - F.col("ones") + 0.5, F.lit(rows - ones) - b + 1.0
    z = F.abs(F.log(a * d / (b * c)) / F.sqrt(1 / a + 1 / b + 1 / c + 1 / d))
    best = (
        texts.mapInArrow(count, "feature long, ones long, n long")
        .groupBy("feature")
        .agg(F.sum("ones").alias("ones"), F.sum("n").alias("n"))
        .filter(F.col("n") >= MIN_ROWS)
        .orderBy(z.desc(), "feature")
        .select("feature")
        .limit(FEATURES)
    )
    terms, swapped = _identity()
    chosen = np.array([r["feature"] for r in best.collect()], np.int64).view(np.uint64)
    keys = np.unique(np.concatenate([chosen, terms]))
    empty = Model(keys, np.zeros(len(keys)), 0.0)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.slices(batches):
            row, feature = empty.rows(part.data, part.offsets)
            ends = np.searchsorted(row, np.arange(part.rows.num_rows + 1), "left")
            lists = pa.ListArray.from_arrays(
                pa.array(ends.astype(np.int32)), pa.array(feature.astype(np.int32))
            )
            yield pa.RecordBatch.from_arrays(
                [part.rows.column("doc_id"), part.rows.column("label"), lists],
                names=["doc_id", "label", "features"],
            )

    found = texts.mapInArrow(find, "doc_id long, label long, features array<int>")
    got = found.orderBy("doc_id", "label", "features").collect()
    return _solve(
        keys,
        np.array([r["label"] for r in got], float),
        [np.array(r["features"], np.int64) for r in got],
        dict(zip(np.searchsorted(keys, terms).tolist(), np.searchsorted(keys, swapped).tolist())),
    )


def _solve(
    keys: np.ndarray, label: np.ndarray, features: list, swap: dict[int, int]
) -> Model:
    """Gradient steps with momentum, over at most SAMPLE rows of few features each."""
    rows = len(label)
    row = np.repeat(np.arange(rows), [len(f) for f in features])
    column = np.concatenate(features) if features else np.zeros(0, np.int64)
    # The changes of a row when its terms are swapped: new ones in, old ones out.
    d_row, d_column, d_sign, changes = [], [], [], 0
    for f in features:
        old = [c for c in f.tolist() if c in swap]
        if not old:
            continue
        for new in ([swap[c] for c in old], []):
            d_row += [changes] * len(old + new)
            d_column += old + new
            d_sign += [-1.0] * len(old) + [1.0] * len(new)
            changes += 1
    d_row, d_column = np.array(d_row, np.int64), np.array(d_column, np.int64)
    d_sign = np.array(d_sign)

    def linear(x):
        return np.bincount(row, x[column], rows) + x[-1]

    def slope(x):
        s = _sigmoid(linear(x))
        error = (s - label) / rows
        grad = np.append(np.bincount(column, error[row], len(keys)), error.sum())
        grad[:-1] += 2 * STRENGTH * x[:-1]
        if changes:
            change = np.bincount(d_row, d_sign * x[d_column], changes)
            pull = 2 * FAIRNESS * change[d_row] * d_sign / rows
            grad[:-1] += np.bincount(d_column, pull, len(keys))
        return grad

    # Each feature has a step of its own size: rare ones would hardly move otherwise.
    scale = np.append(np.bincount(column, minlength=len(keys)) / rows, 1.0)
    if changes:
        bend = 8 * FAIRNESS * np.bincount(d_column, minlength=len(keys)) / rows
        scale[:-1] += bend
    scale = 1 / (scale + 0.01)
    x, v = np.zeros(len(keys) + 1), np.zeros(len(keys) + 1)
    share = label.mean()
    x[-1] = np.log(share / (1 - share))
    for _ in range(STEPS):
        v = 0.9 * v - 0.1 * scale * slope(x + 0.9 * v)
        x = x + v
    return Model(keys, x[:-1], float(x[-1]))


def training_rows(docs: DataFrame, labels: DataFrame, learn) -> DataFrame:
    """(doc_id, text, label) of at most SAMPLE labelled rows that ``learn`` lets in.

    First the labels of the smallest hashes of doc_id are taken, then of the rows that
    have them those of the smallest hashes of doc_id and text; equal rows count once.
    Labels other than 0 and 1 are left out.
    """
    few = (
        labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("long").alias("label"))
        .filter("id IS NOT NULL AND label IN (0, 1)")
        .filter(learn(F.col("id")))
        .distinct()
        .orderBy(F.xxhash64("id"), "id", "label")
        .limit(SAMPLE)
    )
    # SAMPLE rows of 16 bytes bound what is broadcast.
    mine = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = settle(
        mine.join(F.broadcast(few), F.col("doc_id") == F.col("id")).select(
            "doc_id", "text", "label", F.xxhash64("doc_id", "text").alias("mark")
        ),
        "labelled",
    )
    # One id may have any number of rows, so these are bounded too.
    marks = rows.select("mark", "label").distinct().orderBy("mark", "label").limit(SAMPLE)
    last = marks.agg(F.max(F.struct("mark", "label")).alias("last")).first()["last"]
    if last is None:
        return rows.select("doc_id", "text", "label")
    upto = F.struct(F.lit(last["mark"]).alias("mark"), F.lit(last["label"]).cast("long").alias("label"))
    kept = rows.filter(F.struct("mark", "label") <= upto).dropDuplicates(["mark", "label"])
    return kept.select("doc_id", "text", "label")


def with_scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and predicted of every row.

    A null or empty text has the score of no feature. Equal texts have equal scores.
    Other columns of the input are not looked at. An empty table gives no rows.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in T.slices(batches):
            score = model.score(part.data, part.offsets)
            yield pa.RecordBatch.from_arrays(
                [
                    part.rows.column("doc_id"), pa.array(score),
                    pa.array((score >= THRESHOLD).astype(np.int32)),
                ],
                names=["doc_id", "score", "predicted"],
            )

    mine = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return mine.mapInArrow(work, "doc_id long, score double, predicted int")


def held_out(doc_id):
    """crc32 of the id as text, modulo 3, is 1; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted; learnt from the rows that are not held out.

    Labels of ids without a document teach nothing; several labels of one id count
    each. Without both labels among the rows every score is the smoothed share of 1.
    Rows with a null id are scored and teach nothing.
    """
    rows = settle(training_rows(docs, labels, lambda i: ~held_out(i)), "labelled")
    scored = with_scores(docs, fit(rows))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
