"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontamination, embedding_dedup, id_store, importance, language_id, language_model, line_dedup, minhash, mixing, token_alignment,
    toxicity, url_filter, warc,
)
from .common import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(n: int):
    """crc32 of doc_id as text, modulo n; of a null id that of the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % n


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, pages.select(F.col("html").alias("text")), RULES)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mixing_rates(docs, docs.select("text", F.col("lang").alias("domain")))


def warc_records(pages: DataFrame) -> DataFrame:
    """Two records of each page: a full response, and a later revisit of another spelling of its url.
    One revisit in sixteen, by the url's digest, carries an etag of other content, one in sixteen none."""
    digest, mark = F.md5("html"), F.substring(F.md5("url"), 1, 1)
    tag = F.concat(F.lit('"'), F.substring(digest, 1, 16), F.lit('"'))
    pair = lambda *kv: F.create_map(*[x if not isinstance(x, str) else F.lit(x) for x in kv])
    at = F.col("page_id") * 10
    full = pages.select(
        (F.col("page_id") * 2).alias("record_id"), "url", at.alias("ts"), F.lit("response").alias("kind"), tag.alias("etag"),
        F.col("page_id").alias("last_modified"), digest.alias("digest"),
        pair("Content-Type", "text/html", "ETag", tag, "Date", at.cast("string"), "Content-Length", F.length("html").cast("string")).alias("headers"),
    )
    later = at + 5 + F.length("url") * 7
    own = F.when(mark == "0", F.lit('"other"')).when(mark == "1", F.lit(None)).otherwise(F.concat(F.lit("W/"), tag))
    again = pages.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), F.concat(F.regexp_replace("url", r"#[\s\S]*$", ""), F.lit("#again")).alias("url"),
        later.alias("ts"), F.lit("revisit").alias("kind"), own.alias("etag"), F.col("page_id").alias("last_modified"), digest.alias("digest"),
        pair("Date", later.cast("string"), "Cache-Control", "max-age=600", "Content-Length", "0", "Set-Cookie", "a=b").alias("headers"),
    )
    return full.union(again)


def op3_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.resolve_revisits(warc_records(table(spark, sf_dir, "pages")))
    entries = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return out.select("record_id", "canonical", "ts", "ref_id", "outcome", F.array_join(entries, "\n").alias("headers"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_classes(table(spark, sf_dir, "documents")).drop("key")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = remainder(3) == 1
    out = language_id.predict(docs, language_id.fit(docs, ~held))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = remainder(7) == 2
    out = language_model.fit_and_score(table(spark, sf_dir, "documents"), ~held)
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = remainder(5) == 0
    out = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held)))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = importance.draw(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def op12_id_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = f"{shared_dir(spark)}/ids-{uuid.uuid4().hex}"
    store = id_store.IdStore.write(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=1, by_words=True)
    rows = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    found = store.lookup(rows.select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy")))
    return found.select("doc_id", "start", F.col("n").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path
    out, _ = token_alignment.align(table(spark, sf_dir, "documents"), path("byte_bpe_50k.json"), path("piece_bpe_32k.model"))
    return out.drop("groups")


QUERIES = {f.__name__: f for f in (
    op1_url_filter, op2_mixing, op3_revisits, op4_decontamination, op5_line_dedup, op6_language_id, op7_language_model,
    op8_minhash, op9_toxicity, op10_embedding_dedup, op11_importance,
    op12_id_store, op13_token_alignment,
)}

ORACLES: dict[str, str] = {
    "op3_revisits": r"""WITH A AS (SELECT page_id, url, md5(html) AS digest, length(html) AS size, substr(md5(url), 1, 1) AS mark,
  regexp_replace(regexp_replace(url, '#[\s\S]*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM pages),
B AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(rest, '^[^/?]*', 0)), '^[^@]*@', ''), ':(80|443)?$', ''), '^(www|m)\.', '') AS host,
  regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '(/|/index\.html|\.html)$', '') AS path,
  array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '\?([\s\S]*)$', 1), '&'),
    lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))), '&') AS tail FROM A),
C AS (SELECT *, host || path || CASE WHEN tail <> '' THEN '?' || tail ELSE '' END AS canonical, '"' || substr(digest, 1, 16) || '"' AS tag, page_id * 10 AS began,
  page_id * 10 + 5 + length(url) * 7 AS later FROM B),
V AS (SELECT page_id * 2 + 1 AS record_id, canonical, later AS ts, CASE mark WHEN '0' THEN '"other"' WHEN '1' THEN NULL ELSE tag END AS etag, page_id AS modified, digest FROM C),
R AS (SELECT page_id * 2 AS ref_id, canonical AS c2, began AS t2, tag, page_id AS modified2, size FROM C),
J AS (SELECT V.*, R.* FROM V ASOF LEFT JOIN R ON V.canonical = R.c2 AND V.ts > R.t2),
O AS (SELECT *, CASE WHEN ref_id IS NULL THEN 'unmatched' WHEN etag IS NOT NULL THEN CASE WHEN etag = tag THEN 'resolved' ELSE 'mismatch' END
  WHEN modified = modified2 THEN 'resolved' ELSE 'mismatch' END AS outcome FROM J)
SELECT record_id, canonical, ts, ref_id, outcome, CASE WHEN outcome = 'resolved' THEN 'cache-control: max-age=600' || chr(10) || 'content-length: ' || CAST(size AS VARCHAR) || chr(10) ||
  'content-type: text/html' || chr(10) || 'date: ' || CAST(ts AS VARCHAR) || chr(10) || 'etag: ' || tag END AS headers FROM O""",
}
