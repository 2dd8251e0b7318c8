"""The ranked match query: vector top-k, without what the user has seen, filters, weighted signals, top-n.

A profile is a small dict of query parameters, so the plan has only literals of it: scan, filter, distance, top-k by
TakeOrderedAndProject, anti join, filter, signals, TakeOrderedAndProject. The first limit is part of the semantics: what
the later filters drop is not refilled. ``now`` is a parameter of everything that depends on time.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolemill.functions import tables as T
from rolemill.functions.normalize import place_buckets, place_bucket, seniority_label, seniority_rank, skill_token
from rolemill.operators.predicates import active, in_feeds, not_refused

DAY = 86_400_000_000


def strings(values: list[str] | None) -> Column:
    return F.array(*[F.lit(v) for v in values or []]).cast("array<string>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Of vectors of one length; null where either is null or all zero."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def vector_of(values: list[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def title_signal(job: Column, user: Column) -> Column:
    """Cosine between 0 and 1; 0 where a vector is missing or of another size."""
    same = F.coalesce((F.size(job) == F.size(user)) & (F.size(user) > 0), F.lit(False))
    return F.when(same, F.least(F.greatest(dot(job, user) / (F.sqrt(dot(job, job)) * F.sqrt(dot(user, user)) + F.lit(1e-9)), F.lit(0.0)), F.lit(1.0))).otherwise(0.0)


def _lower_set(c: Column) -> Column:
    return F.array_distinct(F.transform(F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda s: s.isNotNull()), F.lower))


def skills_signal(job: Column, user: Column) -> Column:
    a, b = _lower_set(job), _lower_set(user)
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), 0.85 * both / F.size(a) + 0.15 * both / F.size(b)).otherwise(0.0)


def industry_signal(job: Column, wanted: Column) -> Column:
    return F.when(F.array_contains(_lower_set(wanted), F.lower(job)), 1.0).otherwise(0.3)


def size_signal(job: Column, wanted: str | None) -> Column:
    if wanted in (None, "any"):
        return F.lit(1.0)
    return F.when(job == wanted, 1.0).otherwise(0.4)


def place_signal(place: Column, preferred: Column) -> Column:
    want = F.array_distinct(F.transform(preferred, place_bucket))
    have = place_buckets(place)
    fits = F.array_contains(want, "remote") | F.array_contains(have, "remote") | F.arrays_overlap(want, have) | (F.size(want) == 0)
    return F.when(fits, 1.0).otherwise(0.2)


def whole_days(now: Column, at: Column) -> Column:
    """Elapsed periods of 24 hours, not calendar days."""
    return F.floor((F.unix_micros(now.cast("timestamp")) - F.unix_micros(at.cast("timestamp"))) / DAY)


def recency_signal(now: Column, at: Column, days: int = 30) -> Column:
    return F.coalesce(F.greatest(F.lit(0.0), 1.0 - whole_days(now, at) / days), F.lit(0.0))


def feedback_signal(company: Column, liked: Column, disliked: Column) -> Column:
    low = F.lower(company)
    return F.when(F.array_contains(_lower_set(liked), low), 1.0).when(F.array_contains(_lower_set(disliked), low), 0.0).otherwise(0.5)


def depth_signal(job: Column, years: dict[str, float], total: float | None, owned: Column) -> Column:
    """The mean of years / 5, at most 1, over the skills asked for; without years per skill, the total counts for owned skills."""
    keys = F.array_distinct(F.transform(F.filter(F.coalesce(job, F.array().cast("array<string>")), lambda s: s.isNotNull()), skill_token))
    if years:
        table = F.create_map(*[F.lit(x) for kv in years.items() for x in (kv[0], max(0.0, float(kv[1])))])
        each = F.transform(keys, lambda k: F.least(F.coalesce(F.try_element_at(table, k), F.lit(0.0)) / 5, F.lit(1.0)))
    else:
        mine = F.transform(owned, skill_token)
        each = F.transform(keys, lambda k: F.when(F.array_contains(mine, k), F.lit(min((total or 0.0) / 5, 1.0))).otherwise(0.0))
    return F.when(F.size(keys) > 0, F.aggregate(each, F.lit(0.0), lambda s, x: s + x) / F.size(keys)).otherwise(0.0)


def skill_recency_signal(job: Column, used: dict[str, str], now: Column) -> Column:
    """The mean over the skills asked for: 1 within a year or still used, 0.7 within 3 years, 0.4 within 5, 0.1 before, 0 unknown."""
    keys = F.array_distinct(F.transform(F.filter(F.coalesce(job, F.array().cast("array<string>")), lambda s: s.isNotNull()), skill_token))
    if not used:
        return F.lit(0.0)
    table = F.create_map(*[F.lit(x) for kv in used.items() for x in kv])

    def one(k: Column) -> Column:
        at = F.try_element_at(table, k)
        days = whole_days(now, F.try_to_timestamp(at))
        return F.when(F.lower(at) == "present", 1.0).when(days <= 365, 1.0).when(days <= 3 * 365, 0.7).when(days <= 5 * 365, 0.4).when(days.isNotNull(), 0.1).otherwise(0.0)

    return F.when(F.size(keys) > 0, F.aggregate(F.transform(keys, one), F.lit(0.0), lambda s, x: s + x) / F.size(keys)).otherwise(0.0)


def seniority_signal(job: Column, user: Column) -> Column:
    a, b = seniority_label(job), seniority_label(user)
    far = F.abs(seniority_rank(a) - seniority_rank(b))
    return F.when((a == "unknown") | (b == "unknown"), 0.5).when(a == b, 1.0).when(far.isNull(), 0.5).when(far == 1, 0.75).otherwise(0.2)


def matched_skills(job: Column, user: Column) -> Column:
    keyed = lambda c: F.transform(F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda s: s.isNotNull()), skill_token)
    return F.array_sort(F.array_intersect(keyed(job), keyed(user)))


def explanation(matched: Column, level: Column) -> Column:
    few = F.slice(matched, 1, 3)
    return F.when(F.size(matched) > 0, F.concat(F.lit("matches "), F.array_join(few, ", "), F.when(F.size(matched) > 3, F.concat(F.lit(" and "), (F.size(matched) - 3).cast("string"), F.lit(" more"))).otherwise(""), F.coalesce(F.concat(F.lit("; "), level), F.lit("")))).otherwise("")


def signals(profile: dict[str, Any], now: Column, vector: list[float] | None) -> dict[str, Column]:
    skills = strings(profile.get("skills"))
    return {
        "title": title_signal(F.col("embedding"), vector_of(vector)) if vector else F.lit(0.0),
        "skills": skills_signal(F.col("required_skills"), skills),
        "industry": industry_signal(F.col("industry"), strings(profile.get("preferred_industries"))),
        "size": size_signal(F.col("company_size"), profile.get("preferred_company_size")),
        "location": place_signal(F.col("location_raw"), strings(profile.get("preferred_locations"))),
        "recency": recency_signal(now, F.col("first_seen_at")),
        "feedback": feedback_signal(F.col("company_name"), strings(profile.get("liked_companies")), strings(profile.get("disliked_companies"))),
    }


def candidates(jobs: DataFrame, vector: list[float] | None, k: int, feeds: tuple[str, ...] | None = None) -> DataFrame:
    """The k nearest active rows, or without a vector the k seen last; ties go to the smaller id."""
    rows = jobs.where(active())
    if feeds:
        rows = rows.where(in_feeds(*feeds))
    if vector is None:
        return rows.withColumn("distance", F.lit(None).cast("double")).orderBy(F.desc_nulls_last("last_seen_at"), "job_id").limit(k)
    near = rows.where(F.size("embedding") == len(vector)).withColumn("distance", 1 - cosine(F.col("embedding"), vector_of(vector)))
    return near.where(F.col("distance").isNotNull() & ~F.isnan("distance")).orderBy("distance", "job_id").limit(k)


def match(jobs: DataFrame, feedback: DataFrame | None, profile: dict[str, Any], now: Column, vector: list[float] | None = None, top_n: int = 30, feeds: tuple[str, ...] | None = None, derived: dict[str, Any] | None = None, explain: bool = False, exclude: tuple[str, ...] = ()) -> DataFrame:
    """(job_id, company_name, role_title, score, one column per signal, matched_skills[, explanation]), best first."""
    found = candidates(jobs, vector, 4 * top_n, feeds)
    if feedback is not None:
        found = found.join(feedback.where(F.col("user_id") == profile["user_id"]).select("job_id"), "job_id", "left_anti")
    if profile.get("requires_sponsorship"):
        found = found.where(not_refused())
    parts = signals(profile, now, vector)
    score = sum((F.lit(T.WEIGHTS[n]) * c for n, c in parts.items()), F.lit(0.0))
    if derived:
        more = {
            "depth": depth_signal(F.col("required_skills"), derived.get("years", {}), derived.get("total_years"), strings(profile.get("skills"))),
            "skill_recency": skill_recency_signal(F.col("required_skills"), derived.get("used", {}), now),
            "seniority": seniority_signal(F.col("seniority_level"), F.lit(derived.get("seniority"))),
        }
        score = 0.85 * score + sum((F.lit(T.DERIVED_WEIGHTS[n]) * c for n, c in more.items()), F.lit(0.0))
        parts |= more
    matched = matched_skills(F.col("required_skills"), strings(profile.get("skills")))
    out = found.select("job_id", "company_name", "role_title", "distance", F.round(score, 6).alias("score"), *[F.round(c, 6).alias(n) for n, c in parts.items()], matched.alias("matched_skills"), *([explanation(matched, F.col("seniority_level")).alias("explanation")] if explain else []))
    best = out.orderBy(F.desc("score"), F.asc("distance"), "job_id").limit(top_n).drop("distance")
    return best.where(~F.col("job_id").isin(*exclude)) if exclude else best
