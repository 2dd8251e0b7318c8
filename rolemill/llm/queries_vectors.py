"""Queries of the nearest-vectors problem (p5) over the whole jobs table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolemill.llm.knn import named, nearest, nearest_numbers
from rolemill.session import load

DIM, K, LEAST = 64, 5, 0.9


def p5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(load(spark, sf_dir, "jobs"), "job_id", "embedding", DIM, K, LEAST)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    near, names = nearest_numbers(load(spark, sf_dir, "jobs"), "job_id", "embedding", DIM, K, LEAST)
    pairs = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return named(pairs, names).select(F.col("a").alias("job_a"), F.col("b").alias("job_b"))


QUERIES = {"p5_found": p5_found, "p5_neighbours": p5_neighbours}

_NEAR = f"""u AS (SELECT job_id, CAST(embedding AS DOUBLE[]) AS v FROM jobs WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
 n AS (SELECT job_id, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS v FROM u),
 c AS (SELECT a.job_id AS a, b.job_id AS b, list_dot_product(a.v, b.v) AS similarity FROM n a JOIN n b ON a.job_id <> b.job_id),
 k AS (SELECT a, b, similarity, row_number() OVER (PARTITION BY a ORDER BY similarity DESC, b) AS rank FROM c WHERE similarity >= {LEAST} QUALIFY rank <= {K})"""

SQL = {"p5_found": f"WITH {_NEAR} SELECT DISTINCT least(a, b) AS job_a, greatest(a, b) AS job_b FROM k"}
