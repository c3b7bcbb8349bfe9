"""The queries of this subpackage: each operator over its whole table, with production settings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import centroids, conversations, decontaminate, html_extract, mixing, near_dedup, sentence_spans, simhash, surrogates, token_rollup, toxicity, url_filter, warc
from sparkloom.llm.shared import new_folder, text_key


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after four commits: all documents inserted; copies of a text deleted but for the one
    of smallest id; that batch replayed, which changes nothing; what is left in languages other
    than English, or in none, revised to the vocabulary for many languages.  Null ids go by their
    text, so equal texts without an id are one document."""
    docs = table(spark, sf_dir, "documents")
    store = token_rollup.TokenRollup(spark, new_folder(spark, "rollup"))
    store.commit("insert", token_rollup.count_tokens(docs, "byte_bpe_50k"))
    named = docs.select("doc_id", token_rollup.key_of().alias("key"), text_key(F.col("text")).alias("name"))
    # one key of each text stays; the others are found by key, so copies of a text need not meet
    kept = named.groupBy("name").agg(F.min("doc_id").alias("least"))
    kept = kept.select(F.coalesce(F.col("least").cast("string"), F.concat(F.lit("text:"), F.col("name"))).alias("key"))
    copies = named.select("key").join(kept, "key", "left_anti")
    store.commit("drop copies", deletes=copies)
    store.commit("drop copies", deletes=copies)
    revised = token_rollup.count_tokens(docs.where("not (lang <=> 'en')"), "byte_bpe_multi_50k")
    store.commit("revise", revised.join(store.ledger().select("key"), "key", "left_semi"))
    return store.totals()


def op2_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_spans.dedup_spans(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.document_fingerprints(table(spark, sf_dir, "documents"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op6_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warc.round_trip(table(spark, sf_dir, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replace_pii(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_entities")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_by_document(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.report(table(spark, sf_dir, "conversations"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules are learnt from all tokens of a labelled url; the SQL takes the first 12, so the two can differ where a url has more."""
    return url_filter.judge(table(spark, sf_dir, "pages"), mined=None)


QUERIES: dict[str, Callable] = {
    f.__name__: f
    for f in (op1_token_rollup, op2_sentence_spans, op3_simhash, op4_near_duplicates, op5_html_text, op6_contamination, op7_warc, op8_surrogates, op9_toxicity, op10_mixing, op11_conversation_repair, op12_centroids, op13_url_filter)
}

#: What the archives say can be derived from the pages; the file work itself is tested by round trips.
WARC_SQL = r"""
with p as (
  select page_id, coalesce(url, '') url, sha256(coalesce(html, '')) payload_digest,
         octet_length(encode(coalesce(html, '')))::bigint payload_bytes
  from pages),
f as (select payload_digest d, min(page_id) first from p where payload_bytes >= 100 group by 1)
select page_id, payload_bytes, payload_digest,
       case when first is null or first = page_id then 'response' else 'revisit' end record_type,
       case when first <> page_id then first end refers_to, url
from p left join f on payload_digest = d
"""

ORACLES: dict[str, str] = {"op2_sentence_spans": sentence_spans.sql(), "op6_contamination": decontaminate.sql(), "op7_warc": WARC_SQL, "op10_mixing": mixing.SQL, "op11_conversation_repair": conversations.SQL, "op12_centroids": centroids.sql(), "op13_url_filter": url_filter.sql()}
