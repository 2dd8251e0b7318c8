"""Duplicates across feeds and across re-keyed identities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rolemill.functions.normalize import canonical_source, company_letters, sorted_tokens, source_priority
from rolemill.functions.text import canonical_url
from rolemill.operators.predicates import has_entries, usable_text


def dedup_key(company: Column, title: Column, url: Column) -> Column:
    return F.concat_ws("|", company_letters(company), sorted_tokens(title), canonical_url(F.coalesce(url, F.lit(""))))


def mark_url_duplicates(jobs: DataFrame) -> DataFrame:
    """Of the active rows with one canonical address, the best keeps its status and the others become duplicates.

    Best: higher priority of the feed, then a usable text, skills, a vector, then the smaller id. One aggregate with
    map-side combine finds the keeper, so an address shared by a third of all rows is no hot partition.
    """
    url = canonical_url(F.col("primary_url"))
    rows = jobs.withColumn("_url", F.when((F.col("status") == "active") & (F.coalesce(url, F.lit("")) != ""), url))
    rank = F.struct(-source_priority(F.col("source_repo")), (~usable_text()).cast("int"), (~has_entries()).cast("int"), F.col("embedding").isNull().cast("int"), F.col("job_id"))
    keep = rows.where("_url is not null").groupBy("_url").agg(F.min_by("job_id", rank).alias("_keep"))
    joined = rows.join(keep, "_url", "left")
    return joined.withColumn("status", F.when(F.col("_keep").isNotNull() & (F.col("_keep") != F.col("job_id")), "duplicate").otherwise(F.col("status"))).select(*jobs.columns)


def merge_across_feeds(rows: DataFrame, order: str = "seq") -> DataFrame:
    """One row per dedup key from listings of several feeds, by an ordered fold.

    The first row is the base. sources is the sorted union, both times are the latest. A later row with a strictly
    higher priority takes over the feed, and at that moment gives text, skills and level where the base has none. Those
    fields are thus what stands first, in order, among the base and the rows that took over: no group is folded row by
    row, everything is aggregates over the chain of take-overs.
    """
    key = dedup_key(F.col("company_name"), F.col("role_title"), F.col("primary_url"))
    r = rows.withColumns({"_key": key, "_p": source_priority(F.col("source_repo"))})
    before = Window.partitionBy("_key").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    r = r.withColumn("_led", F.max("_p").over(before)).withColumn("_takes", F.col("_led").isNull() | (F.col("_p") > F.col("_led")))
    first = lambda value, ok: F.min_by(F.when(F.col("_takes") & ok, value), F.when(F.col("_takes") & ok, F.col(order)))
    return r.groupBy("_key").agg(
        F.min_by("company_name", order).alias("company_name"),
        F.min_by("role_title", order).alias("role_title"),
        F.min_by("primary_url", order).alias("primary_url"),
        F.min_by("source_repo", F.struct(-F.col("_p"), F.col(order))).alias("source_repo"),
        F.array_sort(F.array_distinct(F.filter(F.concat(F.collect_set(canonical_source(F.col("source_repo"))), F.flatten(F.collect_set(F.coalesce("sources", F.array().cast("array<string>"))))), lambda s: s.isNotNull()))).alias("sources"),
        F.max("first_seen_at").alias("first_seen_at"),
        F.max("last_seen_at").alias("last_seen_at"),
        first(F.col("job_description"), F.coalesce(F.col("job_description") != "", F.lit(False))).alias("job_description"),
        first(F.col("required_skills"), has_entries()).alias("required_skills"),
        first(F.col("seniority_level"), F.coalesce(F.col("seniority_level") != "", F.lit(False))).alias("seniority_level"),
        F.count("*").alias("merged"),
    ).drop("_key")


def rekey(jobs: DataFrame, new_id: Column) -> tuple[DataFrame, DataFrame]:
    """(survivors, id map): one row per new id; the oldest row survives, times and feeds are merged, any active row makes it active."""
    r = jobs.withColumn("new_id", new_id)
    survivors = r.groupBy("new_id").agg(
        F.min_by("job_id", F.struct("first_seen_at", "job_id")).alias("survivor"),
        F.min("first_seen_at").alias("first_seen_at"),
        F.max("last_seen_at").alias("last_seen_at"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.filter(F.coalesce("sources", F.array().cast("array<string>")), lambda s: s.isNotNull()))))).alias("sources"),
        F.when(F.bool_or(F.coalesce(F.col("status") == "active", F.lit(False))), "active").otherwise("inactive").alias("status"),
        F.count("*").alias("merged"),
    )
    return survivors, r.select("job_id", "new_id")


def remap_feedback(feedback: DataFrame, id_map: DataFrame) -> DataFrame:
    """Feedback under the new ids; of two reactions of a user to one listing the earlier stays."""
    moved = feedback.join(id_map, "job_id", "left").withColumn("job_id", F.coalesce("new_id", "job_id")).drop("new_id")
    return first_reactions(moved)


def first_reactions(feedback: DataFrame) -> DataFrame:
    """The first reaction of every user to every listing, by time and then by id."""
    best = feedback.groupBy("user_id", "job_id").agg(F.min(F.struct("recorded_at", "feedback_id", "reaction")).alias("x"))
    return best.select("user_id", "job_id", "x.recorded_at", "x.feedback_id", "x.reaction")
