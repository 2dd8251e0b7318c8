"""Health metrics and the gates that stand before a publication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolemill.operators.predicates import active, has_entries, matchable, needs_vector, usable_text

# Least coverage, most backlog, and the drops that are too large.
LEAST_COVERAGE, MOST_BACKLOG, DROP_SHARE, DROP_POINTS = 0.97, 300, 0.10, 0.05
ABSOLUTE = (("embedded_cov_of_embeddable", "at_least", LEAST_COVERAGE), ("embeddable_backlog", "at_most", MOST_BACKLOG), ("vector_violations", "at_most", 0), ("active", "at_least", 1), ("matchable", "at_least", 1))
RELATIVE = ("active", "matchable")
POINTS = ("embedded_cov_of_active", "industry_cov", "seniority_cov", "skills_cov")
SOFT_POINTS = ("sponsorship_cov",)


def ratio(part: Column, whole: Column, empty: float = 0.0) -> Column:
    return F.when(whole > 0, F.round(part / whole, 6)).otherwise(F.lit(empty))


def health_metrics(jobs: DataFrame) -> DataFrame:
    """One row with all counts and ratios, from one pass over the table. Ratios of nothing are 0, that of embeddable rows 1."""
    on = active()
    vector = F.col("embedding").isNotNull()
    filled = lambda c: F.coalesce(F.trim(c) != "", F.lit(False))
    counts = {
        "active": on,
        "active_embedded": on & vector,
        "matchable": on & vector & matchable(),
        "embeddable": on & matchable(),
        "embeddable_backlog": needs_vector(),
        "vector_violations": vector != F.col("embedded_at").isNotNull(),
        "thin_text": on & F.col("job_description").isNotNull() & ~usable_text(),
        "with_industry": on & filled("industry"),
        "with_seniority": on & filled("seniority_level"),
        "with_skills": on & has_entries(),
    }
    one = jobs.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in counts.items()])
    c = F.col
    return one.withColumns({
        "embedded_cov_of_active": ratio(c("active_embedded"), c("active")),
        "embedded_cov_of_embeddable": ratio(c("embeddable") - c("embeddable_backlog"), c("embeddable"), 1.0),
        "industry_cov": ratio(c("with_industry"), c("active")),
        "seniority_cov": ratio(c("with_seniority"), c("active")),
        "skills_cov": ratio(c("with_skills"), c("active")),
    })


def as_rows(metrics: DataFrame) -> DataFrame:
    """(metric, value) of the one row of metrics."""
    return metrics.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in metrics.columns])).alias("x")).select("x.metric", "x.value")


def gate_failures(metrics: DataFrame, prior: DataFrame | None = None) -> DataFrame:
    """(metric, rule, value, bound) of every check that fails. prior holds (metric, value) of the last run, if any."""
    spark = metrics.sparkSession
    now = as_rows(metrics)
    rules = spark.createDataFrame([(m, r, float(b)) for m, r, b in ABSOLUTE], "metric string, rule string, bound double")
    failed = now.join(F.broadcast(rules), "metric").where(((F.col("rule") == "at_least") & (F.col("value") < F.col("bound"))) | ((F.col("rule") == "at_most") & (F.col("value") > F.col("bound"))))
    failed = failed.select("metric", "rule", "value", "bound")
    if prior is None:
        return failed
    both = now.join(prior.select("metric", F.col("value").alias("before")), "metric")
    share = both.where(F.col("metric").isin(*RELATIVE) & (F.col("before") > 0) & (F.col("value") < F.col("before") * (1 - DROP_SHARE))).select("metric", F.lit("drop_share").alias("rule"), "value", (F.col("before") * (1 - DROP_SHARE)).alias("bound"))
    points = both.where(F.col("metric").isin(*POINTS) & (F.col("before") - F.col("value") > DROP_POINTS)).select("metric", F.lit("drop_points").alias("rule"), "value", (F.col("before") - DROP_POINTS).alias("bound"))
    return failed.union(share).union(points)


def soft_metrics(jobs: DataFrame) -> DataFrame:
    """(sponsorship_cov): a coverage that may fall, as "can't tell" is an answer."""
    return jobs.agg(ratio(F.count_if(active() & F.col("sponsorship").isNotNull()), F.count_if(active())).alias("sponsorship_cov"))


def gate_warnings(metrics: DataFrame, prior: DataFrame) -> DataFrame:
    """(metric, value, before, points) of soft coverages that fell by more than the allowed points; they stop nothing."""
    both = as_rows(metrics).where(F.col("metric").isin(*SOFT_POINTS)).join(prior.select("metric", F.col("value").alias("before")), "metric")
    return both.where(F.col("before") - F.col("value") > DROP_POINTS).select("metric", "value", "before", F.round((F.col("before") - F.col("value")) * 100, 4).alias("points"))


def stage_outcome(results: DataFrame, least: int = 50) -> DataFrame:
    """(stage, asked, resolved, outcome) from (stage, resolved, infra_error): degraded when a dependency failed, or when
    enough was asked and nothing came back; else ok."""
    a = results.groupBy("stage").agg(F.count("*").alias("asked"), F.count_if("resolved").alias("resolved"), F.bool_or(F.coalesce("infra_error", F.lit(False))).alias("_down"))
    bad = F.col("_down") | ((F.col("asked") >= least) & (F.col("resolved") == 0))
    return a.select("stage", "asked", "resolved", F.when(bad, "degraded").otherwise("ok").alias("outcome"))


def integrity_alerts(jobs: DataFrame, late: DataFrame, most: int = 100) -> DataFrame:
    """(check, rows, alert): rows whose first time is later than their identity's (``late`` has that flag), active rows
    without a level, and active rows with a text but no skills; more than ``most`` of one kind is an alert."""
    gaps = jobs.agg(F.count_if(active() & F.col("seniority_level").isNull()).alias("no_level"), F.count_if(active() & usable_text() & ~has_entries()).alias("no_skills"))
    rows = as_rows(gaps).union(late.agg(F.count_if("late").cast("double").alias("n")).select(F.lit("late_first_seen"), "n"))
    return rows.select(F.col("metric").alias("check"), F.col("value").cast("bigint").alias("rows"), (F.col("value") > most).alias("alert"))


def publish_decision(metrics: DataFrame, baseline: DataFrame) -> DataFrame:
    """(passes, matchable, baseline, next_baseline): no violations and no fewer matchable rows than last time; the baseline moves only on a pass."""
    last = baseline.where("metric = 'matchable'").agg(F.max("value").alias("b")).select(F.lit(1).alias("k"), "b")
    one = metrics.select(F.lit(1).alias("k"), "vector_violations", "matchable").join(last, "k")
    passes = (F.col("vector_violations") == 0) & (F.col("matchable") >= F.coalesce("b", F.lit(0)))
    return one.select(passes.alias("passes"), "matchable", F.col("b").alias("baseline"), F.when(passes, F.col("matchable").cast("double")).otherwise(F.col("b")).alias("next_baseline"))


def reconcile(local: DataFrame, remote: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """(local, remote, drift, within): counts of two stores and whether they agree closely enough."""
    counted = local.agg(F.count("*").alias("local")).withColumn("k", F.lit(1)).join(remote.agg(F.count("*").alias("remote")).withColumn("k", F.lit(1)), "k")
    drift = F.abs(F.col("local") - F.col("remote")) / F.greatest("local", F.lit(1))
    return counted.select("local", "remote", F.round(drift, 6).alias("drift"), (drift <= tolerance).alias("within"))


def single_model(jobs: DataFrame) -> DataFrame:
    """(models, consistent): the embedding models in use; more than one is an error."""
    return jobs.where("embedding_model is not null").agg(F.array_sort(F.collect_set("embedding_model")).alias("models")).withColumn("consistent", F.size("models") <= 1)
