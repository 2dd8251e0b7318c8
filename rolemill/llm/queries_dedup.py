"""Queries of the near-duplicate problems (p2, p3) over the whole jobs table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolemill.llm.components import connected_components
from rolemill.llm.neardup import expand_pairs, marked_rows, near_duplicates, record_text
from rolemill.llm.survivor import consensus, select_survivors
from rolemill.session import load, materialize

FIELDS = ("company_name", "role_title", "job_description")
SIMILARITY, WIDTH, LEAST_CHARS = 0.6, 3, 200
SNAPSHOT = "2026-06-30 00:00:00"


def _near(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    jobs = load(spark, sf_dir, "jobs").where(F.length("job_description") >= LEAST_CHARS)
    return near_duplicates(jobs, "job_id", record_text(*FIELDS), SIMILARITY, WIDTH)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expand_pairs(*_near(spark, sf_dir)).select(F.col("a").alias("job_a"), F.col("b").alias("job_b"))


def p2_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per listing with a text: the class of its exact copies and its class's number of links."""
    members, links = _near(spark, sf_dir)
    degree = links.select(F.explode(F.array("a", "b")).alias("class")).groupBy("class").agg(F.count("*").alias("links"))
    return members.join(degree, "class", "left").select(F.col("id").alias("job_id"), F.col("class").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"))


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(job_id, group_id) of all listings in groups of two or more."""
    members, links = _near(spark, sf_dir)
    linked = connected_components(links, "a", "b", "class", "group_id")
    copied = members.groupBy("class").agg(F.count("*").alias("copies"))
    grouped = copied.join(linked, "class", "left").where("copies > 1 or group_id is not null").select("class", F.coalesce("group_id", "class").alias("group_id"))
    return members.join(grouped, "class").select(F.col("id").alias("job_id"), "group_id")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = materialize(_groups(spark, sf_dir), "groups")
    jobs, trust = load(spark, sf_dir, "jobs"), load(spark, sf_dir, "source_trust")
    chars = F.length(F.trim(F.regexp_replace("job_description", "[ \\t\\r\\n]+", " ")))
    seen = F.col("last_seen_at").cast("timestamp_ntz")
    known = F.when(seen <= F.lit(SNAPSHOT).cast("timestamp_ntz"), F.unix_micros(seen.cast("timestamp")))
    feed = lambda x: F.lower(F.regexp_replace(F.substring_index(x, ":", 1), "^\\s+|\\s+$", ""))
    # source_trust is fixed at ten rows: one map, so that a listing's entries need no rows of their own
    ranks = trust.agg(F.map_from_entries(F.collect_list(F.struct("source", "trust")))).scalar()
    best = F.array_max(F.transform("sources", lambda s: F.coalesce(F.element_at(F.col("ranks"), feed(s)), F.lit(0))))
    facts = jobs.withColumn("ranks", ranks).select("job_id", chars.alias("chars"), known.alias("seen"), F.coalesce(best, F.lit(0)).alias("trust")).join(groups, "job_id")
    at = F.col("seen")
    picked = select_survivors(facts, "group_id", "job_id", {"description_job_id": [F.col("chars"), at], "seen_job_id": [at], "source_job_id": [F.col("trust"), at]})
    return picked.select("group_id", "description_job_id", "seen_job_id", "source_job_id")


def p3_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The title, the whole description and the entry of sources of each group that are closest to the token-level
    consensus of its listings. A listing votes once for each of its feeds; a group without any feed has a null source."""
    groups = materialize(_groups(spark, sf_dir), "groups")
    jobs = load(spark, sf_dir, "jobs").select("job_id", "role_title", "job_description", "sources")
    rows = materialize(marked_rows(jobs, "job_id", groups.select("job_id")).join(groups, "job_id"), "grouped")  # read three times
    feed = lambda x: F.lower(F.regexp_replace(F.substring_index(x, ":", 1), "^\\s+|\\s+$", ""))
    entries = rows.select("group_id", F.explode_outer(F.array_distinct(F.transform("sources", feed))).alias("source"))
    titles = consensus(rows, "group_id", "role_title")
    texts = consensus(rows, "group_id", "job_description").withColumnRenamed("support", "description_support")
    feeds = consensus(entries, "group_id", "source").withColumnRenamed("support", "source_support")
    return titles.join(texts, "group_id").join(feeds, "group_id")


QUERIES = {"p2_found": p2_found, "p2_classes": p2_classes, "p3_found": p3_found, "p3_consensus": p3_consensus}

_PAIRS = f"""t AS (SELECT job_id, regexp_extract_all(lower(coalesce(company_name, '') || ' ' || coalesce(role_title, '') || ' ' || job_description), '[a-z0-9]+') AS w FROM jobs WHERE length(job_description) >= {LEAST_CHARS}),
 s AS (SELECT DISTINCT job_id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g FROM t), n AS (SELECT job_id, count(*) AS c FROM s GROUP BY 1),
 i AS (SELECT a.job_id AS job_a, b.job_id AS job_b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.job_id < b.job_id GROUP BY 1, 2),
 pairs AS (SELECT job_a, job_b FROM i JOIN n x ON x.job_id = job_a JOIN n y ON y.job_id = job_b WHERE common >= {SIMILARITY} * (x.c + y.c - common))"""
_TRUST = "coalesce((SELECT max(t.trust) FROM (SELECT unnest(j.sources) AS s) e JOIN source_trust t ON t.source = lower(trim(string_split(e.s, ':')[1]))), 0)"

SQL = {
    "p2_found": f"WITH {_PAIRS} SELECT job_a, job_b FROM pairs",
    "p3_found": f"""WITH RECURSIVE {_PAIRS}, e AS (SELECT job_a AS u, job_b AS v FROM pairs UNION SELECT job_b, job_a FROM pairs),
 reach AS (SELECT u, u AS v FROM e UNION SELECT r.u, e.v FROM reach r JOIN e ON r.v = e.u), g AS (SELECT u AS job_id, min(v) AS group_id FROM reach GROUP BY 1),
 f AS (SELECT g.group_id, g.job_id, length(trim(regexp_replace(j.job_description, '[ \\t\\r\\n]+', ' ', 'g'))) AS chars, CASE WHEN j.last_seen_at <= TIMESTAMP '{SNAPSHOT}' THEN epoch_us(j.last_seen_at) ELSE -4000000000000000000 END AS seen, {_TRUST} AS trust FROM g JOIN jobs j ON j.job_id = g.job_id)
 SELECT group_id, arg_min(job_id, (-chars, -seen, job_id)) AS description_job_id, arg_min(job_id, (-seen, job_id)) AS seen_job_id, arg_min(job_id, (-trust, -seen, job_id)) AS source_job_id FROM f GROUP BY group_id""",
}
