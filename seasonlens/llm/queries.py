"""Registered queries of the operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonlens.llm import html_text
from seasonlens.llm.bpe import decoded, encoded
from seasonlens.llm.decontaminate import leaks
from seasonlens.llm.exact_dedup import exact_dedup
from seasonlens.llm.jaccard import near_duplicates
from seasonlens.llm.negatives import hard_negatives
from seasonlens.llm.packing import packed_documents
from seasonlens.llm.quality import fit, quality_scores
from seasonlens.llm.resample import resample
from seasonlens.llm.secrets import secret_scan
from seasonlens.llm.substrings import remove_substrings
from seasonlens.llm.suffixes import remove_repeats
from seasonlens.llm.token_counts import token_counts
from seasonlens.session import share_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def tokenizer(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        share_package(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents")).drop("base")


@query
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


@query
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE["op5_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_scores(docs, fit(docs, table(spark, sf_dir, "labels")))


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


@query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_substrings(table(spark, sf_dir, "documents"), with_text=False)


@query
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), with_bytes=False)


@query
def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.main_text(pages, html_text.fit(pages), ["page_id", "url"])


@query
def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# a CRC by half bytes; the list is the CRC's own table of 16
ORACLE["op11_resampling"] = r"""
WITH texts AS (
  SELECT 'd' AS side, doc_id, text FROM documents UNION ALL SELECT 'b', NULL, text FROM benchmark
), lists AS (
  SELECT side, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
), grams AS (
  SELECT side, doc_id, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT *, unnest(generate_series(1, len(w) - n + 1)) AS i FROM lists, (VALUES (1), (2), (3)) AS sizes(n))
), found AS (
  SELECT side, doc_id, gram, count(*) AS k FROM grams GROUP BY ALL
), digits AS (
  SELECT gram, hex(encode(gram)) AS h FROM (SELECT DISTINCT gram FROM found)
), buckets AS (
  SELECT gram, xor(list_reduce(
    list_transform(generate_series(0, len(h) - 1), lambda i: instr('0123456789ABCDEF', h[i + 2 - 2 * (i % 2)]) - 1),
    lambda c, d: xor(c // 16, [0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, 3988292384, 4027552580,
      3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108][xor(c % 16, d) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM digits
), sums AS (
  SELECT bucket, coalesce(sum(k) FILTER (side = 'd'), 0) AS s, coalesce(sum(k) FILTER (side = 'b'), 0) AS t
  FROM found JOIN buckets USING (gram) GROUP BY bucket
), gain AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
                                 / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS g FROM sums
), weights AS (
  SELECT doc_id, sum(k) AS n_features, sum(k * g) AS weight
  FROM found JOIN buckets USING (gram) JOIN gain USING (bucket) WHERE side = 'd' GROUP BY doc_id
), scores AS (
  SELECT doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight, len(w) >= 20 AS may,
         coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM lists LEFT JOIN weights USING (doc_id) WHERE side = 'd'
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY may ORDER BY score DESC, doc_id) AS place, count(*) FILTER (may) OVER () AS n FROM scores
)
SELECT doc_id, n_features, weight, score, CASE WHEN may AND place <= n * 5 // 100 THEN place END AS rank FROM ranked
"""


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label))


ORACLE["op12_hard_negatives"] = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT * FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, p.vec_id AS positive_id,
       row_number() OVER (PARTITION BY anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n USING (anchor_id)
WHERE NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5
"""


@query
def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer("word_bpe_49k.json")
    found = decoded(encoded(table(spark, sf_dir, "documents"), path), path)
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
