"""Registered queries of this subpackage and their DuckDB texts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, conv_trie, fingerprint, katz, licenses, line_dedup, near_dup, packing, pii, quality, secret_scan, token_align, url_filter
from .common import documents

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(f):
    REGISTRY[f.__name__] = f
    return f


def _sha(c):
    return F.sha2(c.cast("binary"), 256)


def _spans(c):
    """kind:start:end of an array of spans, comma-joined."""
    return F.array_join(F.transform(c, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _of(*kinds):
    return lambda s: s["kind"].isin(*kinds)


@_query
def op1_secret_scan(spark, sf_dir):
    out = secret_scan.scan_secrets(documents(spark, sf_dir), lang_col="lang")
    return out.select("doc_id", *[F.size(F.filter("spans", _of(k))).cast("long").alias(f"n_{k}") for k in secret_scan.KINDS],
                      _sha(_spans(F.filter("spans", _of(*secret_scan.KINDS)))).alias("base_sha256"),
                      _spans(F.col("spans")).alias("spans"))


@_query
def op2_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@_query
def op3_quality_rules(spark, sf_dir):
    return quality.quality_rules(documents(spark, sf_dir))


@_query
def op4_byte_bpe(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = bpe.encode(documents(spark, sf_dir), path, public_tokenizers.PATTERN)
    out = bpe.decode(ids, path)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      _sha(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
                      _sha(F.col("decoded")).alias("decoded_sha256"))


@_query
def op5_katz_score(spark, sf_dir):
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    return katz.score_documents(documents(spark, sf_dir), held_out)


@_query
def op6_personal_data(spark, sf_dir):
    out = pii.find_personal_data(documents(spark, sf_dir))
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                      _sha(_spans(F.col("base"))).alias("base_sha256"), _spans(F.col("spans")).alias("spans"))


@_query
def op7_license_scan(spark, sf_dir):
    out = licenses.scan_licenses(documents(spark, sf_dir))
    return out.select("doc_id", "n_known", "line_ids", "paragraph_ids",
                      F.array_join("rules", ",").alias("rules"), F.array_join("licenses", ",").alias("licenses"))


ORACLE["op7_license_scan"] = licenses.oracle_sql()


@_query
def op8_near_duplicates(spark, sf_dir):
    return near_dup.near_duplicates(documents(spark, sf_dir))


@_query
def op9_document_fingerprint(spark, sf_dir):
    return fingerprint.edited_neighbours(documents(spark, sf_dir))


@_query
def op10_line_dedup(spark, sf_dir):
    out = line_dedup.drop_common_lines(documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_dropped", _sha(F.col("text")).alias("kept_sha256"))


ORACLE["op10_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents),
k AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (
  SELECT key, max(doc_id) AS keep FROM k WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
f AS (SELECT k.doc_id, k.pos, k.line, c.key IS NOT NULL AND k.doc_id <> c.keep AS gone
      FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM f GROUP BY doc_id"""



@_query
def op11_conversation_trie(spark, sf_dir):
    return conv_trie.rebuilt_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


ORACLE["op11_conversation_trie"] = conv_trie.ORACLE_SQL


@_query
def op12_tokenizer_alignment(spark, sf_dir):
    return token_align.align_tokenizers(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
                                        public_tokenizers.path("piece_bpe_32k.model"))


@_query
def op13_url_filter(spark, sf_dir):
    return url_filter.judge_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


ORACLE["op13_url_filter"] = url_filter.oracle_sql()
