"""One query for each operator, over the whole of its table, and the SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from llm import (
    conversations,
    decontamination,
    language_model,
    minhash,
    mixing,
    pieces,
    pii,
    quality,
    sharding,
    spelling,
    substring_dedup,
    suffix_dedup,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return register


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


SPACES = r"[^\x20\x09-\x0D]+"

_WORDS = f"""
WITH words AS (
  SELECT doc_id, generate_subscripts(ws, 1) AS i, unnest(ws) AS word
  FROM (SELECT doc_id, regexp_extract_all(text, '{SPACES}') AS ws FROM documents)
)"""

_SMALL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_SQL = f"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all({_SMALL}, '{SPACES}') AS ws FROM documents
),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE
      WHEN len(ws) = 1 THEN ws
      ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS s
    FROM words WHERE len(ws) > 0)
),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL
),
links AS MATERIALIZED (
  SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * shared >= {minhash.SIMILARITY} * (p.n + q.n - shared)
),
ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, ways.b FROM reach JOIN ways ON reach.b = ways.a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
LEFT JOIN sizes USING (doc_id)"""


@query("op1_minhash_dedup", OP1_SQL)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose 2-word shingles are 80 percent alike."""
    return minhash.near_duplicates(documents(spark, folder), width=2)


OP2_SQL = f"""{_WORDS},
windows AS (
  SELECT doc_id, i, md5(string_agg(word, ' ') OVER w) AS h, count(*) OVER w AS n
  FROM words
  WINDOW w AS (PARTITION BY doc_id ORDER BY i
               ROWS BETWEEN CURRENT ROW AND {substring_dedup.WINDOW - 1} FOLLOWING)
),
hits AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY h) > 1 AS twice
  FROM windows WHERE n = {substring_dedup.WINDOW}
),
marked AS (
  SELECT doc_id, i, word, coalesce(max(coalesce(twice, false)::INT) OVER (
           PARTITION BY doc_id ORDER BY i
           ROWS BETWEEN {substring_dedup.WINDOW - 1} PRECEDING AND CURRENT ROW), 0) AS gone
  FROM words LEFT JOIN hits USING (doc_id, i)
),
texts AS (
  SELECT doc_id, count(*) AS n_words, sum(gone)::BIGINT AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY i) FILTER (gone = 0), '') AS kept
  FROM marked GROUP BY doc_id
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN texts USING (doc_id)"""


@query("op2_substring_dedup", OP2_SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Super-k-mers of 35-word windows, counted in buckets."""
    out = substring_dedup.dedup_substrings(documents(spark, folder))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


_W, _M = decontamination.WINDOW, decontamination.MATCH
OP3_SQL = f"""
WITH own AS (
  SELECT doc_id, generate_subscripts(ws, 1) AS i, unnest(ws) AS word
  FROM (SELECT doc_id, regexp_extract_all(lower(text), '{SPACES}') AS ws FROM documents)
),
items AS (
  SELECT item_id, regexp_extract_all(lower(text), '{SPACES}') AS ws FROM benchmark
),
theirs AS (
  SELECT item_id, len(ws) AS n, generate_subscripts(ws, 1) AS j, unnest(ws) AS word
  FROM items WHERE len(ws) >= {decontamination.SHORTEST}
),
same AS (
  SELECT doc_id, item_id, n, i - j AS shift, j FROM own JOIN theirs USING (word)
),
counted AS (
  SELECT doc_id, item_id, n, count(*) OVER (
    PARTITION BY doc_id, item_id, shift ORDER BY j
    RANGE BETWEEN CURRENT ROW AND {_W - 1} FOLLOWING) AS equal
  FROM same
),
found AS (
  SELECT DISTINCT doc_id, item_id FROM counted
  WHERE 100 * equal >= {_M} * least(n, {_W})
),
figures AS (
  SELECT doc_id, count(*) AS n_items, min(item_id) AS first_item FROM found GROUP BY doc_id
)
SELECT doc_id, coalesce(n_items, 0) AS n_items, first_item,
       n_items IS NOT NULL AS contaminated
FROM documents LEFT JOIN figures USING (doc_id)"""


@query("op3_decontaminate", OP3_SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold passages of the benchmark, up to substituted words."""
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    return decontamination.contaminated(documents(spark, folder), benchmark)


OP4_SQL = f"""
WITH hexed AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS t FROM documents),
windows AS (
  SELECT doc_id, i, md5(substr(t, 2 * i + 1, {2 * suffix_dedup.WIDTH})) AS h
  FROM (SELECT doc_id, t,
               unnest(range(0, len(t) // 2 - {suffix_dedup.WIDTH - 1})) AS i FROM hexed)
),
hits AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY h) AS c FROM windows)
  WHERE c > 1
),
edges AS (
  SELECT *, CASE WHEN i <= lag(i) OVER w + {suffix_dedup.WIDTH} THEN 0 ELSE 1 END AS new
  FROM hits WINDOW w AS (PARTITION BY doc_id ORDER BY i)
),
numbered AS (
  SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM edges
),
spans AS (
  SELECT doc_id, run, min(i) AS a, max(i) + {suffix_dedup.WIDTH} AS b
  FROM numbered GROUP BY doc_id, run
),
gaps AS (
  SELECT doc_id, a, b, run, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS prev
  FROM spans
),
parts AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a)::BIGINT AS n_removed,
         string_agg(substr(t, 2 * prev + 1, 2 * (a - prev)), '' ORDER BY a) AS head,
         max(b) AS stop
  FROM gaps JOIN hexed USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, (len(t) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(t, 2 * coalesce(stop, 0) + 1)))
         AS kept_sha256
FROM hexed LEFT JOIN parts USING (doc_id)"""


@query("op4_suffix_dedup", OP4_SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Suffix arrays over buckets of strings that hold 400-byte windows."""
    out = suffix_dedup.dedup_bytes(documents(spark, folder))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op5_pii")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of personal data: the base rules' and those that the trees add."""
    out = pii.detect(documents(spark, folder))
    return out.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone",
        F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"),
        pii.joined(F.col("spans")).alias("spans"),
    )


@query("op6_sentencepiece")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every text, their digest, and whether they decode to it."""
    docs = documents(spark, folder).select("doc_id", "text")
    return pieces.encode(docs, pieces.load_vocabulary(), keep=False)


@query("op7_toxicity")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity scores of all documents, learnt from labels that are not held out."""
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return toxicity.classify(documents(spark, folder), labels)


@query("op8_language_model")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Kneser-Ney log probabilities of all documents."""
    return language_model.score_documents(documents(spark, folder))


@query("op9_sharding")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """The slot and shard of every document."""
    docs = documents(spark, folder).select("doc_id", "text")
    return sharding.place(docs).select("doc_id", "slot", "shard")


def _op10_sql() -> str:
    lengths = list(quality.NGRAM_LIMITS)
    flags = ",\n".join(
        f"""       CASE WHEN count(*) OVER w{n} = {n} THEN
           md5(string_agg(word, ' ') OVER w{n}) END AS h{n}"""
        for n in lengths
    )
    frames = ",\n         ".join(
        f"w{n} AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING)"
        for n in lengths
    )
    twice = ",\n       ".join(
        f"(h{n} IS NOT NULL AND row_number() OVER "
        f"(PARTITION BY doc_id, h{n} ORDER BY i) > 1)::INT AS d{n}"
        for n in lengths
    )
    inside = ",\n       ".join(
        f"max(d{n}) OVER (PARTITION BY doc_id ORDER BY i "
        f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS c{n}"
        for n in lengths
    )
    sums = ", ".join(f"sum(c{n} * len(word)) AS s{n}" for n in lengths)
    tests = " AND ".join(
        f"100 * coalesce(s{n}, 0) <= {limit} * coalesce(word_chars, 0)"
        for n, limit in quality.NGRAM_LIMITS.items()
    )
    return f"""{_WORDS},
grams AS (
SELECT doc_id, i, word,
{flags}
FROM words
  WINDOW {frames}
),
twice AS (SELECT doc_id, i, word,
       (h5 IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, h5) > 1)::INT AS every5,
       {twice}
FROM grams),
inside AS (SELECT doc_id, word,
       max(every5) OVER (PARTITION BY doc_id ORDER BY i
                         ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS repeat5,
       {inside}
FROM twice),
figures AS (
  SELECT doc_id, count(*) AS n_words, sum(len(word))::BIGINT AS word_chars,
         sum(repeat5)::BIGINT AS n_repeat_words, {sums}
  FROM inside GROUP BY doc_id
),
lines AS (
  SELECT doc_id, line, count(*) - 1 AS again,
         len(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g')) AS chars
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
  WHERE regexp_matches(line, '{SPACES}') GROUP BY doc_id, line
),
dups AS (
  SELECT doc_id, sum(again)::BIGINT AS n_dup_lines, sum(again * chars) AS dup_chars
  FROM lines GROUP BY doc_id
),
rows_ AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
         len(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_words, 0) < {quality.MIN_WORDS}
           OR 100 * n_repeat_words > {quality.MAX_REPEAT} * n_words AS base_failed,
         {tests}
           AND 100 * coalesce(dup_chars, 0) <= {quality.LINE_LIMIT} * coalesce(word_chars, 0)
           AS fine
  FROM documents LEFT JOIN figures USING (doc_id) LEFT JOIN dups USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND fine AND 100 * n_symbols <= {quality.SYMBOL_LIMIT} * n_words
         AS kept
FROM rows_"""


@query("op10_quality_rules", _op10_sql())
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Repetition coverage of every text, and the verdict."""
    out = quality.with_quality(documents(spark, folder).select("doc_id", "text"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


@query("op11_conversation_repair")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Faults of every damaged conversation, and the cheapest edits that mend it."""
    return conversations.judge_damaged(spark.read.parquet(f"{folder}/conversations.parquet"))


@query("op12_spelling_variants")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all texts, the variants they are of, and how many words are near."""
    return spelling.spelling_variants(documents(spark, folder))


OP13_SQL = f"""
WITH RECURSIVE sizes AS MATERIALIZED (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{SPACES}')), 0)::BIGINT AS size
  FROM documents
),
sources AS MATERIALIZED (
  SELECT *, sid % {len(mixing.WEIGHTS)} + 1 AS weight FROM (
    SELECT source, sum(size)::BIGINT AS source_size,
           row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid
    FROM sizes GROUP BY source)
),
shares AS (
  SELECT 0 AS i, sum(source_size) / sum(weight) AS share, sum(source_size) AS total FROM sources
  UNION ALL
  SELECT i + 1, (total - sum(CASE WHEN {mixing.MOST} * source_size < share * weight
                              THEN {mixing.MOST} * source_size ELSE 0 END))
                / sum(CASE WHEN {mixing.MOST} * source_size < share * weight
                      THEN 0 ELSE weight END) AS again, total
  FROM shares, sources WHERE total > 0 GROUP BY i, share, total HAVING again > share
),
wanted AS MATERIALIZED (
  SELECT sources.*, coalesce(least({mixing.MOST} * source_size,
           (SELECT max(share) FROM shares) * weight), 0)::DOUBLE AS target,
         greatest(1, ceil(source_size / {mixing.SHARD_WORDS}))::BIGINT AS shards
  FROM sources
),
block AS (
  SELECT greatest(1, least({mixing.BLOCK_WORDS}, floor(min(target) / {mixing.LEAST_BLOCKS})))
           ::BIGINT AS b
  FROM wanted WHERE target > 0
),
keyed AS MATERIALIZED (
  SELECT doc_id, size, sid, source_size, target, shards,
         md5(concat_ws(':', '{mixing.SEED}', coalesce(doc_id::VARCHAR, '-'), sid, size,
             row_number() OVER (PARTITION BY doc_id, sid, size))) AS key
  FROM sizes JOIN wanted ON sizes.source IS NOT DISTINCT FROM wanted.source
),
dealt AS MATERIALIZED (
  SELECT *, ('0x' || substr(key, 1, 8))::BIGINT % shards AS shard FROM keyed
),
held AS MATERIALIZED (
  SELECT sid, shard, ceil(sum(size) / any_value(b))::BIGINT AS blocks
  FROM dealt, block WHERE size > 0 GROUP BY sid, shard
),
per_source AS (SELECT sid, sum(blocks)::BIGINT AS blocks FROM held GROUP BY sid),
of_source AS (
  SELECT sid, target, unnest(range(1, {mixing.MOST} * blocks + 1)) AS k
  FROM per_source JOIN wanted USING (sid)
),
source_seats AS MATERIALIZED (
  SELECT sid, count(*) AS seats FROM (
    SELECT sid, row_number() OVER (ORDER BY target / (2 * k - 1) DESC, sid, k) AS place
    FROM of_source), block
  WHERE place <= (SELECT sum(source_size) FROM sources) // b GROUP BY sid
),
of_shard AS (
  SELECT sid, shard, blocks, unnest(range(1, {mixing.MOST} * blocks + 1)) AS k FROM held
),
quotas AS MATERIALIZED (
  SELECT sid, shard, count(*) FILTER (place <= seats) AS quota FROM (
    SELECT sid, shard, row_number() OVER (
      PARTITION BY sid ORDER BY blocks / (2 * k - 1) DESC, shard, k) AS place
    FROM of_shard) LEFT JOIN source_seats USING (sid)
  GROUP BY sid, shard
),
plans AS (
  SELECT sid, shard, blocks, quota, quota // blocks AS each, quota % blocks AS extra, b,
         ('0x' || substr(md5(concat_ws(':', '{mixing.SEED}', sid, shard)), 1, 8))::BIGINT
           % blocks AS start
  FROM held JOIN quotas USING (sid, shard), block
),
line AS (
  SELECT *, sum(size) OVER (PARTITION BY sid, shard ORDER BY key) AS stop
  FROM dealt WHERE size > 0
),
ends AS (
  SELECT doc_id, size, sid, unnest([1, -1]) AS sign,
         unnest([stop, stop - size])::BIGINT AS place, key, shard
  FROM line
),
cut AS (
  SELECT *, place // b AS i, place % b AS rest,
         ((place // b + start) * extra) // blocks - (start * extra) // blocks AS passed,
         ((place // b + 1 + start) * extra) // blocks
           - ((place // b + start) * extra) // blocks AS here
  FROM ends JOIN plans USING (sid, shard)
),
given AS (
  SELECT key, sum(sign * ((each * i + passed) * b + rest * (each + here)))::BIGINT AS taken
  FROM cut GROUP BY key
)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken
FROM dealt LEFT JOIN given USING (key)"""


@query("op13_mix_sources", OP13_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of every document a mix of the sources takes."""
    out = mixing.mix(documents(spark, folder))
    return out.select("doc_id", "size", "source_size", "target", "taken")


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """All stages, one after the other."""
    return corpus_pipeline.run(spark, folder)
