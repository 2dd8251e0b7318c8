"""Roll-ups over the listing table; each is one aggregate with map-side combine."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rolemill.operators.predicates import has_entries, usable_text


def inventory(jobs: DataFrame) -> DataFrame:
    return jobs.agg(
        F.count("*").alias("total"), F.count_if(F.col("status") == "active").alias("active"), F.count_if(F.col("status") == "inactive").alias("inactive"), F.count_if(F.col("status") == "duplicate").alias("duplicate"),
        F.count_if(usable_text()).alias("with_text"), F.count_if(has_entries()).alias("with_skills"), F.count("embedding").alias("embedded"), F.max("last_seen_at").alias("latest_seen"), F.max("embedded_at").alias("latest_embedded"),
    )


def by_source_and_status(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy(F.substring_index("source_repo", ":", 1).alias("feed"), "status").agg(F.count("*").alias("listings"))


def top_values(jobs: DataFrame, column: str, k: int = 15) -> DataFrame:
    value = F.lower(F.trim(column))
    return jobs.select(value.alias("value")).where("value is not null and value not in ('', 'unknown')").groupBy("value").agg(F.count("*").alias("listings")).orderBy(F.desc("listings"), "value").limit(k)


def new_per_day(jobs: DataFrame, now: Column, days: int = 14) -> DataFrame:
    day = F.to_date("first_seen_at")
    recent = (F.col("first_seen_at") >= now - F.make_dt_interval(F.lit(days))) & (F.col("first_seen_at") <= now)
    return jobs.where(recent).groupBy(day.alias("day")).agg(F.count("*").alias("listings"))


def coverage_by(jobs: DataFrame, column: str) -> DataFrame:
    return jobs.groupBy(F.coalesce(F.col(column), F.lit("null")).alias("value")).agg(F.count("*").alias("listings"), F.count_if(usable_text()).alias("with_text"), F.count_if(has_entries()).alias("with_skills"))


def quality_score(now: Column) -> Column:
    """0 to 100: filled fields, freshness, length of the text, a salary."""
    filled = lambda c: F.when(F.coalesce(F.trim(c) != "", F.lit(False)), 10).otherwise(0)
    fields = filled("company_name") + filled("role_title") + filled("location_raw") + filled("industry") + F.when(has_entries(), 10).otherwise(0)
    age = F.floor((F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("first_seen_at").cast("timestamp"))) / 86_400_000_000)
    fresh = F.when(age <= 30, 25).when(age <= 90, 15).when(age <= 180, 8).otherwise(0)
    n = F.coalesce(F.length(F.trim("job_description")), F.lit(0))
    length = F.when(n >= 400, 15).when(n >= 200, 10).when(n >= 80, 5).otherwise(0)
    salary = F.when(F.coalesce(F.trim("salary_range") != "", F.lit(False)), 10).otherwise(0)
    return F.least(fields + fresh + length + salary, F.lit(100))


def quality_histogram(jobs: DataFrame, now: Column) -> DataFrame:
    s = quality_score(now)
    return jobs.agg(F.count_if(s < 50).alias("low"), F.count_if((s >= 50) & (s < 80)).alias("fair"), F.count_if(s >= 80).alias("good"), F.sum(s).alias("total_score"))


def vector_sizes(jobs: DataFrame) -> DataFrame:
    return jobs.where("embedding is not null").groupBy(F.size("embedding").alias("dims")).agg(F.count("*").alias("vectors"))


def repeated_groups(df: DataFrame, *keys: str) -> DataFrame:
    """(groups, surplus): keys that occur more than once, and how many rows are too many."""
    several = df.groupBy(*keys).agg(F.count("*").alias("c")).where("c > 1")
    return several.agg(F.count("*").alias("groups"), F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("surplus"))


def worst_groups(df: DataFrame, key: str, k: int = 10) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("c")).where("c > 1").orderBy(F.desc("c"), key).limit(k)


def orphans(feedback: DataFrame, jobs: DataFrame, users: DataFrame) -> DataFrame:
    no_job = feedback.join(jobs.select("job_id"), "job_id", "left_anti").agg(F.count("*").alias("rows")).withColumn("check", F.lit("unknown_job"))
    no_user = feedback.join(users.select("user_id"), "user_id", "left_anti").agg(F.count("*").alias("rows")).withColumn("check", F.lit("unknown_user"))
    return no_job.unionByName(no_user).select("check", "rows")


def gap_samples(df: DataFrame, gaps: Mapping[str, Column], key: str, k: int = 10) -> DataFrame:
    """(gap, rank, key): up to k examples of every gap, the smallest keys."""
    each = df.select(key, F.explode(F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in gaps.items()]), lambda x: x.isNotNull())).alias("gap"))
    return each.withColumn("rank", F.row_number().over(Window.partitionBy("gap").orderBy(key))).where(F.col("rank") <= k).select("gap", "rank", key)


def named_groups(df: DataFrame, group: str, item: str, most: int = 3) -> DataFrame:
    """(group, items, more): the first few items of every group by name and how many there are besides."""
    distinct = df.select(group, item).where(F.col(item).isNotNull()).distinct()
    numbered = distinct.withColumn("rn", F.row_number().over(Window.partitionBy(group).orderBy(item)))
    few = numbered.where(F.col("rn") <= most).groupBy(group).agg(F.array_sort(F.collect_list(item)).alias("items"))
    count = distinct.groupBy(group).agg(F.count("*").alias("n"))
    return few.join(count, group).select(group, F.array_join("items", ", ").alias("items"), (F.col("n") - F.size("items")).alias("more"))


def browse(jobs: DataFrame, predicate: Column, page: int, size: int = 50) -> DataFrame:
    """A page of listings, latest first; pages count from 1."""
    return jobs.where(predicate).orderBy(F.desc_nulls_last("last_seen_at"), "job_id").offset((max(1, page) - 1) * size).limit(size)


def queue(jobs: DataFrame, predicate: Column, order: list[Column], most: int = 3000) -> DataFrame:
    """The next rows of a work queue; the limit bounds a run."""
    return jobs.where(predicate).orderBy(*order).limit(most)


def field_report(jobs: DataFrame, aggregator: str, levels: tuple[str, ...] = ("intern", "entry", "mid", "senior")) -> DataFrame:
    """(kind, label, rows, share) over the table: fields that are there, and states that contradict each other.

    jobs has apply_url, enriched_at, dead and permanent_404 beside the listing's own columns. One aggregate.
    """
    c, filled = F.col, lambda n: F.coalesce(F.col(n), F.lit("")) != ""
    through = lambda n: F.contains(F.lower(n), F.lit(aggregator))
    vector, done = c("embedding").isNotNull(), c("enriched_at").isNotNull()
    there = {
        "direct_address": filled("apply_url") & ~through("apply_url"), "any_address": filled("primary_url") | filled("apply_url"), "text": usable_text(), "skills": has_entries(),
        "industry": filled("industry") & (c("industry") != "unknown"), "company_size": filled("company_size"), "level": filled("seniority_level"), "enriched": done, "embedded": vector,
    }
    wrong = {
        "embedded_thin_text": vector & ~usable_text(), "embedded_no_skills": vector & ~has_entries(), "enriched_no_industry": done & ~filled("industry"), "enriched_no_skills": done & ~has_entries(),
        "active_dead": (c("status") == "active") & F.coalesce("dead", F.lit(False)), "active_gone": (c("status") == "active") & F.coalesce("permanent_404", F.lit(False)),
        "address_of_aggregator": through("apply_url"), "level_off_vocabulary": c("seniority_level").isNotNull() & ~F.lower("seniority_level").isin(*levels),
    }
    named = [(k, n, x) for k, some in (("there", there), ("wrong", wrong)) for n, x in some.items()]
    one = jobs.agg(F.count("*").alias("_all"), *[F.count_if(F.coalesce(x, F.lit(False))).alias(n) for _, n, x in named])
    rows = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(n).alias("label"), c(n).alias("rows"), F.round(F.coalesce(F.try_divide(c(n), c("_all")), F.lit(0.0)), 6).alias("share")) for k, n, _ in named])
    return one.select(F.explode(rows).alias("x")).select("x.*")


def rolled_up(counters: DataFrame) -> DataFrame:
    """(counter, value) of (stage, counter, value): the sums over all stages."""
    return counters.groupBy("counter").agg(F.sum("value").alias("value"))
