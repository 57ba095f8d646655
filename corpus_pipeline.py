"""From raw documents to token ids: five stages, each written before the next one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import decontamination, minhash, pieces, pii, quality
from sieveframe.sources.scratch import settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged = quality.with_quality(docs)
    return judged.filter("kept").select(*_own(docs))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: that of the smallest id, nulls last.

    Rows are judged, not ids: each gets a number, written once with it, by which groups
    are found. Rows without an id are compared like others, and of rows that share an id
    only those go whose text has been seen.
    """
    # A name that no column of the input has.
    row = "_row".rjust(1 + max(map(len, docs.columns)), "_")
    numbered = settle(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    keyed = numbered.select(F.col(row).alias("doc_id"), "text")
    groups = settle(
        minhash.near_duplicates(keyed).select(F.col("doc_id").alias("of"), "component_id"), "groups"
    )
    # Most rows are alone in their group, and need no look.
    several = groups.groupBy("component_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    ids = numbered.select(F.col(row).alias("at"), F.col("doc_id").cast("long").alias("id"))
    members = settle(
        groups.join(several.select("component_id"), "component_id", "left_semi")
        .join(ids, F.col("at") == F.col("of"))
        .select("component_id", "at", "id"),
        "members",
    )
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "at"))
    chosen = members.groupBy("component_id").agg(first["at"].alias("at"))
    gone = members.select("at").join(chosen.select("at"), "at", "left_anti")
    return numbered.join(gone, F.col(row) == F.col("at"), "left_anti").select(*_own(docs))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.drop_contaminated(docs, benchmark)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by the name of its kind; n_chars counts the new text."""
    out = pii.redact(docs)
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", length)
    return out


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text, and whether they decode to it."""
    return pieces.encode(docs, pieces.load_vocabulary(), keep=False)


def _own(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("sentencepiece", encode_pieces),
]

# Ids of a vocabulary and spans that trees select have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES over documents; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
