"""The registered queries of this subpackage, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, chat, jaccard, languages, mixing, passages, pieces, quality, revisits, search, spelling, toxicity, urlfilter
from .common import read

#: The rules for pages, as (verdict, host, path).
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
#: What is blocked where no rule fits, as globs over host and path.
URL_BLOCKED = ["*spam*/**", "*cheap-pills*/**", "*casino*/**", "**/login**", "**/cart**", "**.exe", "**.zip"]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held = (F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0).alias("held_out")
    labels = read(spark, sf_dir, "labels").where(F.col("toxic").isNotNull()).select("doc_id", F.col("toxic").alias("label"), held).where(~F.col("held_out"))
    # The bound holds on the labels already, before texts are read: so few ids may be broadcast.
    first = labels.withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id", "label").limit(toxicity.MOST)
    model = toxicity.fit(docs.join(F.broadcast(first), "doc_id").select("text", "label", F.col("doc_id").alias("key")))
    return toxicity.score(docs.select("doc_id", held, "text"), model).select("doc_id", "held_out", "score", "predicted", "hits")


def op2_bm25_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document whose id 20 divides, as a query against all documents, itself included."""
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return search.top_k(docs, docs.where("id % 20 = 0"), k=10).select(F.col("query").alias("query_id"), "rank", F.col("id").alias("doc_id"), "score")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.remove(read(spark, sf_dir, "documents").select("doc_id", "text"), lines=True)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    counted = quality.kept_counts(docs)
    return quality.judge(counted, quality.estimates(counted)).select("doc_id", *quality.COUNTS, "base_failed", "kept", "distance")


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.judge(pages, URL_RULES, URL_BLOCKED).select("page_id", "host", "path", "rule", "verdict")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return jaccard.join(docs, width=4, percent=85).select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page is captured in full and, 2000 ticks later, answered as not modified.

    Every seventh such answer has another entity tag, every eleventh comes before its capture.
    """
    pages = read(spark, sf_dir, "pages").select("page_id", "url", F.md5(F.coalesce("html", F.lit("")).cast("binary")).alias("tag"))
    date = F.concat(F.lit("day "), (F.col("page_id") % 365).cast("string"))
    full = F.create_map(F.lit("etag"), "tag", F.lit("last-modified"), date, F.lit("content-type"), F.lit("text/html"), F.lit("cache-control"), F.lit("max-age=60"))
    tag = F.when(F.col("page_id") % 7 == 3, "other").otherwise(F.concat(F.lit("W/"), F.col("tag")))
    again = F.create_map(F.lit("etag"), tag, F.lit("cache-control"), F.lit("max-age=600"), F.lit("content-length"), F.lit("0"))
    records = pages.select((2 * F.col("page_id")).alias("record_id"), F.lit("response").alias("kind"), "url", F.col("page_id").alias("ts"), full.alias("headers")).unionByName(
        pages.select((2 * F.col("page_id") + 1).alias("record_id"), F.lit("revisit").alias("kind"), "url", F.when(F.col("page_id") % 11 == 5, F.col("page_id") - 1).otherwise(F.col("page_id") + 2000).alias("ts"), again.alias("headers"))
    )
    out = revisits.resolve(records)
    joined = F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")
    return out.select("record_id", "url", "ts", F.coalesce("response_id", F.lit(-1)).alias("response_id"), "outcome", joined.alias("headers"))


def op8_chat_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.sql(f"SELECT * FROM VALUES (-1L, 0L, 'user', '{said}'), (-1L, 1L, 'assistant', '{said}') AS t(conv_id, turn, role, text)")
    return chat.read_back(chat.format_conversations(turns.unionByName(own)))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pieces.encode(read(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = (F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1).alias("held_out")
    model = languages.fit(docs.where(~held).select(F.col("doc_id").alias("key"), "text", "lang"))
    return languages.identify(docs.select("doc_id", held, "text"), model).select("doc_id", "held_out", "lang_pred", "score")


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(read(spark, sf_dir, "embeddings"), k=8, rounds=10, salt="3:")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents").select("doc_id", "text"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_toxicity, op2_bm25_top_k, op3_substring_dedup, op4_quality_rules, op5_url_filters, op6_jaccard_join, op7_warc_revisits, op8_chat_prefix_targets, op9_sentencepiece, op10_source_mixing, op11_language_id, op12_centroid_clustering, op13_spelling_variants)}
