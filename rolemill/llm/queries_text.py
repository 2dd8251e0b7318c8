"""Queries of the text problems (p6 to p8) over the whole documents table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolemill.llm.packing import pack
from rolemill.llm.stuffing import page_curves, stuffed_pages
from rolemill.llm.tokens import count_tokens, decode_corpus, encode_corpus
from rolemill.session import load, materialize

CAPACITY = 2048


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_corpus(load(spark, sf_dir, "documents"))


def p6_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and characters of the corpus after encoding and decoding; the SQL takes them from the table itself."""
    docs = load(spark, sf_dir, "documents")
    back = decode_corpus(encode_corpus(docs))
    return back.agg(F.count("*").alias("docs"), F.sum(F.length("text")).alias("chars"), F.sum(F.octet_length("text")).alias("bytes"))


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return pack(count_tokens(docs), "doc_id", "n_tokens", CAPACITY)


def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers are."""
    packed = pack(count_tokens(load(spark, sf_dir, "documents")), "doc_id", "n_tokens", CAPACITY)
    used = packed.groupBy("container").agg(F.sum("size").alias("used"))
    return used.agg(F.count("*").alias("containers"), F.sum("used").alias("tokens"), F.max("used").alias("fullest"), F.round(F.sum("used") / (F.count("*") * CAPACITY), 6).alias("fill"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stuffed_pages(load(spark, sf_dir, "documents")).select("doc_id")


def p8_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typical rank-frequency curve of every length: the mean of slopes, residuals and divergences of all different texts."""
    curves = page_curves(load(spark, sf_dir, "documents"), "text", "lang")
    return curves.groupBy("size").agg(F.count("*").alias("pages"), F.round(F.avg("slope"), 4).alias("slope"), F.round(F.avg("residual"), 4).alias("residual"), F.round(F.avg("divergence"), 4).alias("divergence"))


QUERIES = {"p6_ids": p6_ids, "p6_roundtrip": p6_roundtrip, "p7_containers": p7_containers, "p7_fill": p7_fill, "p8_found": p8_found, "p8_curves": p8_curves}

SQL = {
    "p6_roundtrip": "SELECT count(*) AS docs, sum(length(coalesce(text, ''))) AS chars, sum(strlen(coalesce(text, ''))) AS bytes FROM documents",
}
