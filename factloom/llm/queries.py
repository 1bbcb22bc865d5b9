"""The named queries of this subpackage, each with its checking SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm import (
    byte_pairs,
    centroids,
    class_model,
    mixing,
    near_copies,
    neighbours,
    pieces,
    quality,
    sharding,
    substrings,
    toxicity,
    url_rules,
    variants,
)
from factloom.llm.check_sql import CENTROIDS_SQL, VARIANTS_SQL
from factloom.llm.common import GAP, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECK_SQL: dict[str, str] = {}


#: Where the vocabulary files are, unless the session names another folder.
TOKENIZERS = "/opt/tokenizers"


def vocabulary(spark: SparkSession, name: str) -> bytes:
    """A vocabulary file, read by the driver: about half a megabyte, whatever the corpus."""
    with open(f"{spark.conf.get('spark.factloom.tokenizers', TOKENIZERS)}/{name}", "rb") as file:
        return file.read()


def piece_model(spark: SparkSession) -> bytes:
    return vocabulary(spark, "piece_bpe_32k.model")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def checked(sql: str) -> Callable[[Query], Query]:
    """A query with its checking SQL."""

    def add(function: Query) -> Query:
        CHECK_SQL[function.__name__] = sql
        return query(function)

    return add


@query
def op1_sentencepiece(spark, folder):
    model = piece_model(spark)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    done = pieces.decode(pieces.encode(docs, model, dropout=0.1, seed=1), model)
    return done.select(
        "doc_id",
        F.size("pieces").cast("long").alias("n_pieces"),
        F.size(F.array_distinct("pieces")).cast("long").alias("n_distinct"),
        F.xxhash64("pieces").alias("pieces_hash"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"),
    )


@query
def op2_neighbours(spark, folder):
    return neighbours.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, nearest=20)


@query
def op3_mixing(spark, folder):
    return mixing.mix_digest(table(spark, folder, "documents"), factor=1.5, weights=(5, 2, 1), most=2.0)


@query
def op4_near_copies(spark, folder):
    return near_copies.classes(table(spark, folder, "documents")).select("doc_id", "class_id", "first")


@query
def op5_class_model(spark, folder):
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2, F.lit(False))
    scored = class_model.score(table(spark, folder, "documents").select("doc_id", "text"), ~held_out)
    return scored.withColumn("held_out", held_out)


@query
def op6_quality_rules(spark, folder):
    judged = quality.judge_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


@query
def op7_substrings(spark, folder):
    left = substrings.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"), window=20)
    words = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), GAP, " "))
    return left.select("doc_id", "n_words", "n_removed", F.sha2(words, 256).alias("kept_sha256"))


@query
def op8_sharding(spark, folder):
    placed = sharding.shard_documents(table(spark, folder, "documents"), shards=8)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op9_toxicity(spark, folder):
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5))
    scored = toxicity.score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"), keep=fold != 0)
    return scored.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score", "predicted")


PARTS_SQL = "'(?s)^(.*?)://([^/?#]*)([^?#]*)(.*)$'"
#: The policy as a join, and association rules by counting every combination of tokens of labelled URLs.
URL_RULES_SQL = f"""
WITH u AS (
  SELECT page_id, url, coalesce(lower(regexp_extract(url, {PARTS_SQL}, 1)), '') AS scheme,
    coalesce(translate(regexp_extract(url, {PARTS_SQL}, 2), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, {PARTS_SQL}, 3), '') AS path, coalesce(regexp_extract(url, {PARTS_SQL}, 4), '') AS rest FROM pages),
t AS (
  SELECT *, CASE WHEN url IS NULL THEN [] ELSE list_sort(list_distinct(
    ['scheme:' || scheme] || list_transform(list_filter(string_split(host, '.'), lambda w: w <> ''), lambda w: 'host:' || w)
    || ['site:' || array_to_string(list_slice(['', '', ''] || string_split(host, '.'), -3, -1), '.')]
    || list_transform(list_filter(string_split_regex(lower(path), '[/._\\-]+'), lambda w: w <> '' AND NOT regexp_full_match(w, '[0-9]+')), lambda w: 'path:' || w)
    || list_transform(list_filter(string_split(regexp_extract(rest, '^\\?([^#]*)', 1), '&'), lambda w: w <> ''), lambda w: 'query:' || w)
    || CASE WHEN regexp_extract(rest, '#(.+)$', 1) <> '' THEN ['fragment:' || regexp_extract(rest, '#(.+)$', 1)] ELSE [] END)) END AS tokens
  FROM u),
b AS (
  SELECT tokens, bad FROM t JOIN (
    SELECT doc_id, max(quality = 0 OR toxic = 1) AS bad FROM labels GROUP BY doc_id) l
  ON try_cast(regexp_extract(path, '(?s)^.*?([0-9]{{1,18}})[^0-9]*$', 1) AS bigint) = l.doc_id WHERE bad IS NOT NULL AND url IS NOT NULL),
s AS (
  SELECT list_filter(tokens, lambda w, i: (m >> (i - 1)) & 1 = 1) AS combination, bad
  FROM (SELECT tokens, bad, unnest(range(1, cast(pow(2, len(tokens)) AS bigint))) AS m FROM b)),
n AS (SELECT count(*) AS n, avg(CASE WHEN bad THEN 1.0 ELSE 0.0 END) AS share FROM b),
r AS (
  SELECT combination FROM s, n GROUP BY combination, n, share
  HAVING count(*) FILTER (bad) >= greatest(ceil(0.001 * n), 30) AND count(*) FILTER (bad) / count(*) >= 0.5
    AND count(*) FILTER (bad) / count(*) / share >= 1.5)
SELECT page_id, host, path, list_max(fits).rule AS rule,
  coalesce(list_max(fits).verdict, CASE WHEN EXISTS (SELECT 1 FROM r WHERE list_has_all(t.tokens, r.combination)) THEN 'block' ELSE 'allow' END) AS verdict
FROM (SELECT *, list_filter([{', '.join(f"{{'n': {len(h + p)}, 'rule': '{h + p}', 'verdict': '{v}', 'host': '{h}', 'path': '{p}'}}" for h, p, v in url_rules.POLICY)}],
  lambda x: ends_with('.' || host, '.' || x.host) AND starts_with(path, x.path)) AS fits FROM t) t"""


@checked(URL_RULES_SQL)
def op10_url_rules(spark, folder):
    pages, labels = table(spark, folder, "pages"), table(spark, folder, "labels")
    mined = url_rules.mine_rules(url_rules.labelled_urls(pages, labels))
    return url_rules.judge(pages, url_rules.POLICY, mined).drop("mined_rule")


@checked(VARIANTS_SQL)
def op11_variants(spark, folder):
    words = variants.count_words(table(spark, folder, "documents"), shortest=7, fewest=2, drop_every=31)
    return variants.group_variants(words, times=10).select("word", "form", "root", "n", "n_near", "form_n")


@checked(CENTROIDS_SQL)
def op12_centroids(spark, folder):
    assigned, found = centroids.lloyd(table(spark, folder, "embeddings"))
    return centroids.cluster_digest(assigned, found).withColumnRenamed("id", "vec_id")


@query
def op13_byte_pairs(spark, folder):
    import public_tokenizers

    merges = byte_pairs.load(vocabulary(spark, "byte_bpe_50k.tiktoken"))
    encoded = byte_pairs.encode(table(spark, folder, "documents").select("doc_id", "text"), merges, public_tokenizers.PATTERN)
    done = byte_pairs.decode(encoded.drop("text"), merges)
    return done.select(
        "doc_id",
        (F.length("token_bytes") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_bytes", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
