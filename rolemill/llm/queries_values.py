"""Queries of the typed-value problems (p1, p4) over the whole jobs table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolemill.llm.canon import map_values
from rolemill.llm.names import link_names, name_pairs
from rolemill.session import load, materialize


def p1_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_names(load(spark, sf_dir, "jobs"), "company_name")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return name_pairs(materialize(p1_companies(spark, sf_dir), "companies"))


def typed_values(jobs: DataFrame) -> DataFrame:
    """(job_id, field, raw_value): one row per listing, field and different non-blank value."""
    one = lambda c: F.array(F.struct(F.lit(c).alias("field"), F.col(c).alias("raw_value")))
    skills = F.transform(F.array_distinct(F.coalesce("required_skills", F.array())), lambda s: F.struct(F.lit("required_skills").alias("field"), s.alias("raw_value")))
    each = jobs.select("job_id", F.explode(F.concat(one("industry"), one("seniority_level"), skills)).alias("v")).select("job_id", "v.field", "v.raw_value")
    return each.where(F.col("raw_value").rlike(r"(?U)\S"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapped = map_values(typed_values(load(spark, sf_dir, "jobs")), load(spark, sf_dir, "canon_terms"))
    return mapped.select("job_id", "field", "raw_value", "term_id")


def p4_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of values that no entry of the list means, with how many listings have them."""
    return p4_found(spark, sf_dir).where("term_id = 0").groupBy("field", "raw_value").agg(F.count("*").alias("listings"))


QUERIES = {"p1_found": p1_found, "p1_companies": p1_companies, "p4_found": p4_found, "p4_misses": p4_misses}
SQL: dict[str, str] = {}
