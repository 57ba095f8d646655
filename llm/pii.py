"""Personal data: wide candidate spans, boosted trees, calibrated thresholds.

Only DataFrame functions and Spark's own trees; positions count code points.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveframe.sources.scratch import settle

KINDS = ("email", "ip", "card", "phone")
# The base patterns. Possessive repeats and guards find the same spans as
# the plain patterns in linear time and constant stack. A local part is only tried from
# its first character or from the end of the last match.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for its pattern to be tried.
HINT = {"email": "@", "ip": ".", "card": None, "phone": "+"}
# High-recall generators: spaced or bracketed addresses, any group of numbers.
WIDE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++\x20?(?:@|\(at\)|\[at\]|\{at\})\x20?"
    r"[A-Za-z0-9-]++(?:\x20?(?:\.|\(dot\)|\[dot\]|\{dot\})\x20?[A-Za-z0-9-]++)++",
    "number": r"\+?\(?[0-9]++(?:[\x20().:/-]{1,3}[0-9]++)++|[0-9]{9,}+",
}
SAMPLE = 20_000  # candidates of a sample for trials, at most, half of either label
ROUNDS, DEPTH = 10, 4
BINS = 32  # values of a feature that trees tell apart, at least
PRECISION = 0.95  # of what is selected of a kind, on the candidates kept from the trees
STEPS = 100
# What an unlabelled candidate weighs: some of them are what is looked for.
UNLABELLED = 0.1
CUES = r"(?i)\b(?:tel|phone|call|fax|mobile|cell|contact|e-?mail|mail|write|card|visa|account|acct|iban|ip|host|server|address|ssn)\b"

_SPANS = "array<struct<a:int,b:int,value:string,before:string,after:string>>"
_BLOCK = 512  # items whose running figures are found together
_CHUNK = 1024  # characters of a text that a piece is looked up in


def _let(value: Column, f) -> Column:
    """f of a value that is found once, however often f uses it."""
    return F.get(F.transform(F.array(value), f), 0)


def _running(values: Column, f) -> Column:
    """For each item of an int array what f makes of 0 and all items before it.

    An array that grows by one item is copied whole each time. So items are taken in
    blocks: the figures ahead of the blocks grow first, then those inside each block.
    """
    def blocks(items: Column) -> Column:
        last = F.floor(F.size(items) / _BLOCK).cast("int")
        return F.transform(
            F.sequence(F.lit(0), last), lambda i: F.slice(items, i * _BLOCK + 1, _BLOCK)
        )

    def total(block: Column, start: Column) -> Column:
        return F.aggregate(block, start, lambda x, v: f(x, v))

    kind = "array<struct<at:int,block:array<int>>>"
    ahead = F.aggregate(
        _let(values, blocks),
        F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out")),
        lambda s, block: F.struct(
            total(block, s["at"]).alias("at"),
            F.concat(
                s["out"], F.array(F.struct(s["at"].alias("at"), block.alias("block")))
            ).alias("out"),
        ),
        lambda s: s["out"],
    )

    def inside(x: Column) -> Column:
        return F.aggregate(
            x["block"],
            F.struct(x["at"].alias("at"), F.array().cast("array<int>").alias("out")),
            lambda s, v: F.struct(
                f(s["at"], v).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")
            ),
            lambda s: s["out"],
        )

    return F.flatten(F.transform(ahead, inside))


def find_all(text: Column, pattern: str) -> Column:
    """Leftmost matches that do not overlap: start, end, value, what is before and after.

    Splitting by the pattern gives the text between the matches, whose lengths add up
    to the positions.
    """
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value"),
    )

    def lengths(found: Column) -> Column:
        return F.transform(
            found,
            lambda p: F.char_length(p["gap"]) + F.coalesce(F.char_length(p["value"]), F.lit(0)),
        )

    def spans(found: Column, starts: Column) -> Column:
        def one(p: Column, i: Column) -> Column:
            a = F.get(starts, i) + F.char_length(p["gap"])
            return F.struct(
                a.alias("a"), (a + F.char_length(p["value"])).alias("b"),
                p["value"].alias("value"), F.right(p["gap"], F.lit(24)).alias("before"),
                F.left(F.get(found, i + 1)["gap"], F.lit(1)).alias("after"),
            )

        # The last part has no match behind it.
        return F.transform(F.slice(found, 1, F.size(found) - 1), one)

    return _let(
        parts,
        lambda p: _let(_running(lengths(p), lambda x, v: x + v), lambda at: spans(p, at)),
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Every second digit from the right doubled, less 9 above 9; the sum ends in 0."""
    each = F.split(F.reverse(digits), "")

    def add(total: Column, i: Column) -> Column:
        d = F.get(each, i).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    places = F.sequence(F.lit(0), F.char_length(digits) - 1)
    return F.aggregate(places, F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        small = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
        return F.forall(
            F.split(value, r"\."),
            lambda p: (F.char_length(small(p)) <= 3)
            & (F.right(F.concat(F.lit("000"), small(p)), F.lit(3)) <= "255"),
        )
    n = F.char_length(_digits(value))
    if kind == "card":
        return F.when(n.between(16, 19), _luhn(_digits(value))).otherwise(F.lit(False))
    return n.between(8, 15)


def base_spans(text: Column, kind: str) -> Column:
    """The spans of one base kind; an empty list without any."""
    hint = HINT[kind]
    some = text.rlike("[0-9][0-9 -]{14}") if hint is None else F.contains(text, F.lit(hint))
    all_ = F.filter(find_all(text, BASE[kind]), lambda s: _valid(kind, s["value"]))
    return F.when(some, all_).otherwise(F.array().cast(_SPANS))


def _named(spans: Column, kind: str) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            F.lit(KINDS.index(kind)).alias("k"), s["a"].alias("a"), s["b"].alias("b")
        ),
    )


def joined(spans: Column) -> Column:
    """Spans as kind:start:end by kind, then start, joined by commas."""
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", F.get(kinds, s["k"]), s["a"], s["b"]),
        ),
        ",",
    )


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, ``base`` (all base spans) and ``wide`` (all candidates) of every row.

    The one pass over the texts, written once; what follows reads spans alone.
    """
    text = F.col("text")
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row_key"),
        F.coalesce(text, F.lit("")).alias("text"),
    )
    base = [_named(base_spans(text, kind), kind) for kind in KINDS]
    wide = []
    for name, pattern in WIDE.items():
        some = r"@|[(\[{]at[)\]}]" if name == "email" else "[0-9][0-9 ().:/-]{5,}[0-9]"
        spans = F.when(text.rlike(some), find_all(text, pattern))
        wide.append(_tagged(F.coalesce(spans, F.array().cast(_SPANS)), name))
    found = keyed.select(
        "doc_id", "row_key", F.concat(*base).alias("base"), F.concat(*wide).alias("wide")
    )
    enough = lambda s: (s["wide"] == "email") | (F.char_length(_digits(s["value"])) >= 7)
    return settle(found.withColumn("wide", F.filter("wide", enough)), "pii-spans")


# Features of a candidate: its format without what the base rules decide by. Plus signs,
# country codes, check digits, and how an address spells its signs are not among them,
# nor is a cue before it, which is a label.
FEATURES = (
    "email", "letters", "last_group", "second_group", "third_group", "longest_group",
    "dots", "dashes", "spaces", "brackets", "colons", "slashes", "word_before", "sign_before",
    "word_after",
)


def _tagged(spans: Column, name: str) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            F.lit(name).alias("wide"), s["a"].alias("a"), s["b"].alias("b"),
            s["value"].alias("value"), s["before"].alias("before"), s["after"].alias("after"),
        ),
    )


def _size_of(kind: str) -> Column:
    number = KINDS.index(kind)
    return F.size(F.filter("base", lambda s: s["k"] == number)).cast("long")


def candidates(found: DataFrame) -> DataFrame:
    """One row for each wide span: its place, features, label, and whether it is free.

    A candidate is free if it touches no base span. Spans of a row are put in order, so
    the furthest end of base spans before a candidate and the nearest start behind it
    tell. Its label is 1 if it touches one or a cue stands before it.
    """
    some = found.filter(F.size("wide") > 0).dropDuplicates(["doc_id", "row_key"])
    none = F.lit(None).cast("string")
    base = F.transform(
        "base",
        lambda s: F.struct(
            none.alias("wide"), s["a"].alias("a"), s["b"].alias("b"),
            none.alias("value"), none.alias("before"), none.alias("after"),
        ),
    )
    rows = some.select("doc_id", "row_key", F.inline(F.concat(base, "wide")))
    of_row = Window.partitionBy("doc_id", "row_key")
    upto = (Window.unboundedPreceding, Window.currentRow)
    is_base = F.col("wide").isNull()
    reach = F.max(F.when(is_base, F.col("b"))).over(of_row.orderBy("a").rangeBetween(*upto))
    start = F.min(F.when(is_base, F.col("a"))).over(of_row.orderBy(F.desc("a")).rangeBetween(*upto))
    placed = rows.withColumn("_reach", reach).withColumn("_start", start).filter(~is_base)
    touches = F.coalesce(F.col("_reach") > F.col("a"), F.lit(False)) | F.coalesce(
        F.col("_start") < F.col("b"), F.lit(False)
    )

    email = F.col("wide") == "email"
    plain = F.regexp_replace("value", r"\x20?[(\[{]at[)\]}]\x20?", "@")
    plain = F.regexp_replace(plain, r"\x20?[(\[{]dot[)\]}]\x20?", ".")
    plain = F.when(email, F.regexp_replace(plain, r"\x20", "")).otherwise(F.col("value"))
    value = F.col("plain")
    count = lambda cls: F.char_length(F.regexp_replace(value, f"[^{cls}]", "")).cast("double")
    groups = F.regexp_extract_all(value, F.lit("[0-9]+"), F.lit(0))
    sizes = F.when(~email, F.transform(groups, lambda g: F.char_length(g))).otherwise(
        F.array().cast("array<int>")
    )
    nth = lambda i: F.coalesce(F.try_element_at("sizes", F.lit(i)), F.lit(0))
    some_of = lambda cls: count(cls) > 0
    features = {
        "email": email, "letters": count("A-Za-z"),
        "last_group": nth(-1), "second_group": nth(-2), "third_group": nth(-3),
        "longest_group": F.coalesce(F.array_max("sizes"), F.lit(0)),
        "dots": count("."), "dashes": some_of("-"), "spaces": some_of(r"\x20"),
        "brackets": some_of(r"()\[\]{}"), "colons": count(":"), "slashes": count("/"),
        "word_before": F.col("before").rlike("[A-Za-z]$"),
        "sign_before": F.col("before").rlike(r"[^\sA-Za-z0-9]$"),
        "word_after": F.col("after").rlike("[A-Za-z]"),
    }
    cue = F.col("before").rlike(CUES)
    return (
        placed.withColumn("plain", plain).withColumn("sizes", sizes).withColumn("touches", touches)
        .select(
            "doc_id", "row_key", "wide", "a", "b", "value", F.size("sizes").alias("groups"),
            F.char_length(_digits(F.col("value"))).alias("digits"),
            *(features[n].cast("double").alias(n) for n in FEATURES),
            (F.col("touches") | cue).cast("double").alias("label"), (~F.col("touches")).alias("free"),
        )
    )


class Selector:
    """Trees and for each kind the score from which a candidate is taken, if any is."""

    def __init__(self, model: GBTClassificationModel | None, thresholds: dict[int, float]) -> None:
        self.model, self.thresholds = model, thresholds

    def select(self, found: DataFrame) -> DataFrame:
        if not self.thresholds:
            return found.filter(F.lit(False))
        least = F.lit(2.0)
        for kind, score in self.thresholds.items():
            least = F.when(_kind() == kind, score).otherwise(least)
        return _scored(self.model, found).filter(F.col("p") >= least)


def _assembled(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="_features").transform(df)


def _scored(model: GBTClassificationModel, df: DataFrame) -> DataFrame:
    out = model.transform(_assembled(df))
    return out.withColumn("p", vector_to_array("probability")[1]).select(*df.columns, "p")


def formats(found: DataFrame) -> DataFrame:
    """All candidates to learn from, as their formats: label, kind, features, ``n``, ``weight``.

    A format counts every candidate that has it, once per value, so that copies of a
    document do not count twice. Values are dealt to those that are ``kept_back`` and the
    rest. Formats are far fewer than candidates, and trees of weighted formats are those
    of the candidates themselves. Unlabelled ones weigh UNLABELLED each.
    """
    each = found.select("value", "label", _kind().alias("kind"), *FEATURES).distinct()
    back = F.pmod(F.xxhash64("value"), F.lit(5)) == 0
    counted = each.groupBy("label", "kind", back.alias("kept_back"), *FEATURES).agg(
        F.count(F.lit(1)).alias("n")
    )
    weight = F.col("n") * F.when(F.col("label") == 1, 1.0).otherwise(UNLABELLED)
    return settle(counted.withColumn("weight", weight), "pii-formats")


def sampled(found: DataFrame) -> DataFrame:
    """A bounded sample of candidates, for trials; ``detect`` learns from all ``formats``.

    With ``weight`` and whether they are ``kept_back``. Of either label those of the smallest hashes, half of SAMPLE at most, once per value
    so that copies of a document do not count twice. The weights make up for labels of
    which not all are taken; unlabelled ones weigh UNLABELLED of that.
    """
    spread = F.xxhash64("value")
    each = settle(found.dropDuplicates(["value", "label"]), "pii-values")
    sizes = {r["label"]: r["n"] for r in each.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = []
    for label, share in ((0.0, UNLABELLED), (1.0, 1.0)):
        weight = share * max(1.0, sizes.get(label, 0) / (SAMPLE // 2))
        some = each.filter(F.col("label") == label).orderBy(spread, "value").limit(SAMPLE // 2)
        parts.append(some.withColumn("weight", F.lit(weight)))
    both = parts[0].unionAll(parts[1])
    return settle(both.withColumn("kept_back", F.pmod(spread, F.lit(5)) == 0), "pii-sample")


def fit(found: DataFrame) -> Selector:
    """Boosted trees on four fifths of all candidates, and a threshold from the others.

    No table has labels for personal data. What passes a base rule or stands behind a
    cue is labelled; the trees see neither, only the rest of the format, so they also
    rate high what looks the same but lacks the sign that the rule insists on. A fifth of
    the values picks for each kind the lowest threshold with PRECISION above it; a kind
    without one takes nothing. Without candidates of both labels there is nothing to learn.
    """
    every = formats(found)
    sizes = dict(every.filter("NOT kept_back").groupBy("label").count().collect())
    if len(sizes) < 2:
        return Selector(None, {})
    trees = GBTClassifier(
        featuresCol="_features", labelCol="label", weightCol="weight", maxIter=ROUNDS,
        maxDepth=DEPTH, stepSize=0.3, seed=17, cacheNodeIds=False,
        # Spark looks for splits in a sample of rows only beyond the square of this.
        maxBins=max(BINS, math.isqrt(sum(sizes.values())) + 1),
    )
    model = trees.fit(_assembled(every.filter("NOT kept_back")))
    steps = (
        _scored(model, every.filter("kept_back"))
        .groupBy("kind", F.floor(F.col("p") * STEPS).alias("step"))
        .agg(F.sum(F.col("label") * F.col("weight")).alias("ones"), F.sum("weight").alias("n"))
        .orderBy("kind", F.desc("step"))
        .collect()
    )
    thresholds: dict[int, float] = {}
    above: dict[int, tuple[float, float]] = {}
    for r in steps:
        ones, n = above.get(r["kind"], (0.0, 0.0))
        above[r["kind"]] = ones, n = ones + r["ones"], n + r["n"]
        if ones >= PRECISION * n and r["step"] >= STEPS // 2:
            thresholds[r["kind"]] = r["step"] / STEPS
    return Selector(model, thresholds)


def _kind() -> Column:
    """The listed kind that a selected candidate is closest to, as its number."""
    of = KINDS.index
    return (
        F.when(F.col("wide") == "email", of("email"))
        .when((F.col("dots") == 3) & (F.col("groups") == 4) & (F.col("longest_group") <= 3), of("ip"))
        .when(F.col("digits") >= 13, of("card"))
        .otherwise(of("phone"))
    )


def detect(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, n_email, n_ip, n_card, n_phone, base and spans of every row.

    base are the spans of the base rules, as (kind number, start, end); spans are these
    and the candidates that the trees select, which touch no base span. A null text
    counts as empty and has no span. Rows of one doc_id are told apart by their text;
    equal rows have equal spans. A null doc_id is a row like others. Texts may be long
    and hold many spans: the work grows with them, not with their square. Where no
    candidates of both labels are there to learn from, as in an empty table, spans are
    the base spans.
    """
    found = scanned(docs)
    listed = settle(candidates(found), "pii-candidates")
    more = fit(listed).select(listed.filter("free"))
    added = more.groupBy(F.col("doc_id").alias("id"), F.col("row_key").alias("key")).agg(
        F.collect_set(F.struct(_kind().alias("k"), "a", "b")).alias("added")
    )
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("row_key") == F.col("key"))
    rows = found.select("doc_id", "row_key", "base").join(added, same, "left")
    counts = [_size_of(kind).alias(f"n_{kind}") for kind in KINDS]
    spans = F.concat("base", F.coalesce("added", F.array().cast("array<struct<k:int,a:int,b:int>>")))
    return rows.select("doc_id", "row_key", *counts, "base", spans.alias("spans"))


def _cut(chunks: Column, a: Column, b: Column) -> Column:
    """Characters a to b of a text in chunks of _CHUNK."""
    def of(i: Column) -> Column:
        first = F.greatest(a - i * _CHUNK, F.lit(0))
        last = F.least(b - i * _CHUNK, F.lit(_CHUNK))
        return F.substring(F.get(chunks, i), first + 1, last - first)

    whole = lambda x: F.floor(x / _CHUNK).cast("int")
    pieces = F.transform(F.sequence(whole(a), whole(b - 1)), of)
    return F.when(b > a, F.array_join(pieces, "")).otherwise(F.lit(""))


def redacted(text: Column, spans: Column) -> Column:
    """A text with each span as [KIND]; those that overlap become one.

    Pieces are looked up in chunks and joined once, so many spans in a long text do not
    copy or scan it again for each.
    """
    labels = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    by_place = F.array_sort(
        F.transform(
            spans,
            lambda s: F.struct(
                s["a"].alias("a"), (-s["b"]).alias("last"), s["b"].alias("b"), s["k"].alias("k")
            ),
        )
    )
    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_CHUNK}}}"), F.lit(0))

    def joined_(found: Column, held: Column, before: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            at = F.get(before, i)
            return F.when(
                x["a"] >= at, F.concat(_cut(held, at, x["a"]), F.get(labels, x["k"]))
            ).otherwise(F.lit(""))

        end = F.array_max(F.transform(found, lambda x: x["b"]))
        rest = _cut(held, end, F.char_length(text))
        return F.concat(F.array_join(F.transform(found, one), ""), rest)

    furthest = lambda found: _running(
        F.transform(found, lambda x: x["b"]), lambda x, v: F.greatest(x, v)
    )
    return _let(
        by_place,
        lambda found: _let(
            chunks, lambda held: _let(furthest(found), lambda at: joined_(found, held, at))
        ),
    )


def redact(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, with each span of their text as [KIND].

    Spans that overlap become one, named after the first, or the longest of those. A null text stays null.
    """
    names = docs.columns
    keyed = docs.withColumn("_key", F.xxhash64("text"))
    found = (
        detect(docs.select("doc_id", "text"))
        .filter(F.size("spans") > 0)
        .dropDuplicates(["doc_id", "row_key"])
        .select(F.col("doc_id").alias("_id"), F.col("row_key").alias("_row"), F.col("spans").alias("_spans"))
    )
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_row"))
    text = F.col("text")
    out = F.when(F.col("_spans").isNull(), text).otherwise(redacted(text, F.col("_spans")))
    return (
        keyed.join(found, same, "left")
        .withColumn("text", out)
        .select(*(f"`{n}`" for n in names))
    )
