"""One registered query per operator, with production parameters over the whole table."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitcast.llm import (bpe, collocations, conversations, exact_dedup, licenses, line_dedup, lm_scoring, mixing, near_dedup, packing, quality,
                          substring_dedup, token_files)

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the words that a mix of all sources takes of them."""
    return mixing.plan(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


@query
def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document encoded by the ranks of a public vocabulary, and decoded again."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    decoded = bpe.decode(bpe.encode(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN), ranks)
    return decoded.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with its license statements."""
    return licenses.scan(documents(spark, sf_dir)).drop("spans")


@query
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with the largest doc_id that has its text."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    index = exact_dedup.DigestIndex(spark)
    index.add(docs)
    return index.lookup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document without the words that repeated windows of 35 words cover."""
    kept = substring_dedup.dedup_substrings(documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with its measures, the base rules and the verdict of the weakly supervised rules."""
    scored = quality.score(documents(spark, sf_dir).select("doc_id", "text"), keep_text=False)
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")


@query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as read back from bit-packed token files of the whole table."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        files = token_files.write(documents(spark, sf_dir), f.read())
    return files.read().select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with its near-duplicate component over two-word shingles at a similarity of 0.8."""
    found = near_dedup.near_duplicates(documents(spark, sf_dir), near_dedup.Params(shingle=2))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's cross-entropy difference between documents labelled good and all documents."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return lm_scoring.score(documents(spark, sf_dir), labels.where("quality = 1"))


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with its lines counted, dropped, and the kept text's digest."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    kept = line_dedup.dedup_lines(docs)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation with its faults after damage, and its cheapest repair."""
    return conversations.damaged_and_repaired(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query
def op12_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 4,096 tokens."""
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return packing.pack(documents(spark, sf_dir), f.read(), end_id=2).drop("ids")


@query
def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first phrases of two to five words by association."""
    return collocations.collocations(documents(spark, sf_dir))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the training-data pipeline over the whole table."""
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL

ORACLES["op4_exact_dedup"] = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)
"""

ORACLES["op10_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place FROM documents),
k AS (
  SELECT *, translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (
  SELECT key, max(doc_id) AS last_doc FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT k.*, f.key IS NOT NULL AND k.doc_id <> f.last_doc AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

ORACLES["op13_phrase_collocations"] = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS ws FROM d),
g AS (SELECT lang, ws, unnest([1, 2, 3, 4, 5]) AS k FROM w WHERE len(ws) > 0),
p AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase FROM g WHERE len(ws) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM p GROUP BY ALL),
t AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2 AND f >= 100),
s AS (SELECT *, unnest(range(1, k)) AS j FROM c),
x AS (
  SELECT s.lang, s.phrase, s.a, s.j, l.f AS l, r.f AS r, t.n, (1000::HUGEINT * s.a * t.n // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM s JOIN f l ON l.lang = s.lang AND l.k = s.j AND l.phrase = array_to_string(s.ws[1:s.j], ' ')
  JOIN f r ON r.lang = s.lang AND r.k = s.k - s.j AND r.phrase = array_to_string(s.ws[s.j + 1:s.k], ' ')
  JOIN t ON t.lang = s.lang),
b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
i AS (SELECT lang, a, ws, k, unnest([2, 3, 4]) AS m FROM c),
o AS (SELECT lang, a, unnest(list_transform(range(1, k - m + 2), lambda z: array_to_string(ws[z:z + m - 1], ' '))) AS phrase FROM i WHERE m < k),
u AS (SELECT lang, phrase, max(a) AS longer FROM o GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM b LEFT JOIN u USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a
QUALIFY rank <= 2000
"""
