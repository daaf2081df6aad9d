"""Line deduplication: long lines that many documents hold stay in one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WS, Scratch, ascii_lower


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document row: id, a key of the text, the lines, the other columns in a struct."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rest = F.struct(F.col(text_col).isNull().alias("no_text"),
                    *[F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in (id_col, text_col)])
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("tk"),
                       F.split(text, "\n", -1).alias("lines"), rest.alias("rest"))


def _long_keys(lines: DataFrame, min_chars: int) -> DataFrame:
    """(id, tk, pos, h) of each line whose key has at least ``min_chars`` code points."""
    key = ascii_lower(F.btrim(F.col("line"), F.lit(WS)))
    return (lines.select("id", "tk", F.posexplode("lines").alias("pos", "line"))
            .select("id", "tk", "pos", key.alias("key"))
            .filter(F.char_length("key") >= min_chars)
            .select("id", "tk", "pos", F.unhex(F.md5(F.col("key"))).alias("h")))


def common_lines(keys: DataFrame, min_docs: int) -> DataFrame:
    """(h, keep): hashes held by at least ``min_docs`` distinct ids, and the largest such id.

    Distinct (hash, id) rows first, then a partially aggregated count: a line that a third of
    all documents hold reaches the last step as one row per task.
    """
    return (keys.select("h", "id").distinct()
            .groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("keep"))
            .filter(F.col("n") >= min_docs).select("h", "keep"))


def _deduplicated(docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_docs: int) -> DataFrame:
    """(id, text, n_lines, n_dropped, rest) of each row.

    The keys are joined to the common lines as two exchanges under a sort-merge join, so that
    adaptive execution splits the partition of a very common line.
    """
    scratch = Scratch(docs.sparkSession, "line-dedup")
    lines = _lines(docs, id_col, text_col)
    common = scratch.write(common_lines(_long_keys(lines, min_chars), min_docs), "common")
    dropped = (_long_keys(lines, min_chars).join(common, "h")
               .filter(~F.col("id").eqNullSafe(F.col("keep")))
               .groupBy("id", "tk").agg(F.collect_set("pos").alias("gone"))
               .select(F.col("id").alias("d_id"), F.col("tk").alias("d_tk"), "gone"))
    n = F.size("lines")
    joined = lines.join(dropped, F.col("id").eqNullSafe(F.col("d_id")) & (F.col("tk") == F.col("d_tk")), "left")
    left = joined.select("id", "rest", "lines", n.cast("long").alias("n_lines"),
                         F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
                         F.when(F.col("gone").isNull(), F.lit(None))
                         .otherwise(F.array_except(F.sequence(F.lit(0), n - 1), F.col("gone"))).alias("stay"))
    text = F.when(F.col("stay").isNull(), F.array_join("lines", "\n")).otherwise(
        F.array_join(F.transform("stay", lambda i: F.get("lines", i)), "\n"))
    return left.select("id", text.alias("text"), "n_lines", "n_dropped", "rest")


def drop_common_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Drop repeated long lines from all documents but the one with the largest id.

    Returns one row per input row: id (named ``id_col``), text (named ``text_col``, the lines
    that stay joined by newline), n_lines, n_dropped.  A line's key is the line without ASCII
    white space at both ends, A-Z lower-cased, known by its 128-bit hash.

    Null or empty text is one empty line.  Rows with one id are one document (its lines count
    once); a null id counts as one document that never is the largest.  An empty table gives an
    empty result; other columns are ignored, whatever their names.
    """
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = _deduplicated(plain, "id", "text", min_chars, min_docs)
    return out.select(F.col("id").alias(id_col), F.col("text").alias(text_col), "n_lines", "n_dropped")


def rewrite_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars",
                      min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """The rows of ``docs`` with the text that :func:`drop_common_lines` leaves; every other column
    unchanged, but for ``chars_col`` (if there is one), the new count of code points.  Null
    text stays null."""
    out = _deduplicated(docs, id_col, text_col, min_chars, min_docs)
    text = F.when(~F.col("rest.no_text"), F.col("text"))
    columns = []
    for i, c in enumerate(docs.columns):
        value = F.col("id") if c == id_col else text if c == text_col else F.col(f"rest.c{i}")
        if c == chars_col:
            value = F.when(F.col("rest.no_text"), value).otherwise(
                F.char_length("text").cast(docs.schema[c].dataType))
        columns.append(value.alias(c))
    return out.select(*columns)
