"""The request side: profiles completed from a document store, vectors to ask with, many profiles in one plan, and the
shapes in which answers leave. A request is a row of a table, so a thousand requests share one scan of the listings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rolemill.functions import tables as T
from rolemill.functions.normalize import distinct_names, place_bucket, place_buckets
from rolemill.functions.text import page_property, page_title, strip_markup
from rolemill.operators.match import cosine, recency_signal, skills_signal, title_signal
from rolemill.operators.predicates import active, not_refused

_PATCH = "struct<skills:array<string>,tags:struct<skills:array<string>>,totalYearsExperience:double,derivedExperience:string,derivedExperienceVersion:string,derivedExperienceContentHash:string>"
PATCH_FIELDS = {"total_years": "totalYearsExperience", "derived": "derivedExperience", "derived_version": "derivedExperienceVersion", "derived_hash": "derivedExperienceContentHash"}


def _names(c: Column) -> Column:
    return distinct_names(F.filter(F.coalesce(c, F.array().cast("array<string>")), lambda s: s.isNotNull()))


def profile_patches(documents: DataFrame, user: str = "user_id", body: str = "body") -> DataFrame:
    """(user_id, skills, total_years, derived, derived_version, derived_hash) of stored profile documents (JSON), one a user.

    Skills stand at the top or below tags. A body that is no object gives nothing but nulls.
    """
    d = F.from_json(F.col(body), _PATCH)
    top, tags = _names(d["skills"]), _names(d["tags"]["skills"])
    skills = F.when(F.size(top) > 0, top).when(F.size(tags) > 0, tags)
    rows = documents.select(F.col(user).alias("user_id"), skills.alias("skills"), *[d[name].alias(c) for c, name in PATCH_FIELDS.items()])
    return rows.groupBy("user_id").agg(F.max(F.struct("skills", *PATCH_FIELDS)).alias("p")).select("user_id", "p.*")


def patched(requests: DataFrame, patches: DataFrame) -> DataFrame:
    """Requests completed: what a request says of skills and years stands, the rest of the patch goes before the request's."""
    p = patches.select("user_id", *[F.col(c).alias(f"_{c}") for c in ("skills", *PATCH_FIELDS)])
    rows = requests.join(p, "user_id", "left")
    own = F.coalesce(F.size("skills"), F.lit(0)) > 0
    return rows.withColumns({"skills": F.when(own | F.col("_skills").isNull(), F.col("skills")).otherwise(F.col("_skills")), "total_years": F.coalesce("total_years", "_total_years"), **{c: F.coalesce(f"_{c}", c) for c in PATCH_FIELDS if c != "total_years"}}).select(*requests.columns)


def query_vectors(requests: DataFrame, embedded: DataFrame) -> DataFrame:
    """Requests with the vector to ask with: the user's affinity if there is one, else that of the request's text, else null."""
    e = embedded.groupBy("user_id").agg(F.max("embedding").alias("_e"))
    return requests.join(e, "user_id", "left").withColumn("vector", F.coalesce(F.when(F.size("affinity") > 0, F.col("affinity")), F.col("_e"))).drop("_e")


def match_many(jobs: DataFrame, feedback: DataFrame, requests: DataFrame, now: Column, top_n: int = 30, block: int = 2_000) -> DataFrame:
    """(user_id, job_id, score, rank): the ranked match of every request with a vector, from one scan of the listings for
    every ``block`` requests.

    requests: user_id (key), vector, skills, preferred_industries, preferred_company_size, preferred_locations,
    liked_companies, disliked_companies, requires_sponsorship. The requests are a stated query set: they are counted, and
    broadcast block by block, so what is broadcast at once is bounded by ``block`` vectors. Of every request no more than
    4 * top_n candidates leave a partition (a window with group limit).
    """
    usable = active() & F.col("embedding").isNotNull()
    asked = requests.where(F.col("vector").isNotNull()).withColumn("_dim", F.size("vector"))
    rows = jobs.where(usable).withColumn("_dim", F.size("embedding")).select("job_id", "_dim", "embedding")
    nearest = Window.partitionBy("user_id").orderBy("distance", "job_id")
    blocks = max(1, -(-requests.count() // block))

    def candidates(k: int) -> DataFrame:
        few = asked.where(F.pmod(F.xxhash64("user_id"), F.lit(blocks)) == k) if blocks > 1 else asked
        near = rows.join(F.broadcast(few.select("user_id", "_dim", "vector")), "_dim").withColumn("distance", 1 - cosine(F.col("embedding"), F.col("vector")))
        near = near.where(F.col("distance").isNotNull() & ~F.isnan("distance"))
        return near.withColumn("_k", F.row_number().over(nearest)).where(F.col("_k") <= 4 * top_n).select("user_id", "job_id", "distance")

    cand = reduce(DataFrame.union, [candidates(k) for k in range(blocks)])
    cand = cand.join(feedback.select("user_id", "job_id").distinct(), ["user_id", "job_id"], "left_anti")
    u = asked.select("user_id", "vector", *[F.col(c).alias(f"u_{c}") for c in ("skills", "preferred_industries", "preferred_company_size", "preferred_locations", "liked_companies", "disliked_companies", "requires_sponsorship")])
    x = cand.join(jobs, "job_id").join(u, "user_id").where(~F.coalesce("u_requires_sponsorship", F.lit(False)) | not_refused())
    none = F.array().cast("array<string>")
    low = lambda c: F.transform(F.coalesce(F.col(c), none), F.lower)
    want, have = F.transform(F.coalesce("u_preferred_locations", none), place_bucket), place_buckets(F.col("location_raw"))
    fits = (F.size(want) == 0) | F.array_contains(want, "remote") | F.array_contains(have, "remote") | F.arrays_overlap(want, have)
    size = F.col("u_preferred_company_size")
    w = T.WEIGHTS
    parts = {
        "title": title_signal(F.col("embedding"), F.col("vector")),
        "skills": skills_signal(F.col("required_skills"), F.coalesce("u_skills", none)),
        "industry": F.when(F.array_contains(low("u_preferred_industries"), F.lower("industry")), 1.0).otherwise(0.3),
        "size": F.when(size.isNull() | (size == "any") | F.coalesce(F.col("company_size") == size, F.lit(False)), 1.0).otherwise(0.4),
        "location": F.when(F.coalesce(fits, F.lit(False)), 1.0).otherwise(0.2),
        "recency": recency_signal(now, F.col("first_seen_at")),
        "feedback": F.when(F.array_contains(low("u_liked_companies"), F.lower("company_name")), 1.0).when(F.array_contains(low("u_disliked_companies"), F.lower("company_name")), 0.0).otherwise(0.5),
    }
    score = F.round(sum((F.lit(w[n]) * c for n, c in parts.items()), F.lit(0.0)), 6)
    best = Window.partitionBy("user_id").orderBy(F.desc("score"), F.asc("distance"), "job_id")
    scored = x.select("user_id", "job_id", "distance", score.alias("score"))
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top_n).select("user_id", "job_id", "score", "rank")


def recommendations(found: DataFrame, jobs: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Matches (job_id, score and signals) in the shape that callers of the service expect; one struct a row."""
    rows = found.join(jobs.select("job_id", "source_repo", "primary_url", "location_raw", F.col("industry").alias("_i"), F.col("company_size").alias("_s")), "job_id")
    rows = rows.where(~F.col("job_id").isin(*exclude)) if exclude else rows
    item = F.struct(
        "job_id", F.col("source_repo").alias("source"), F.col("role_title").alias("title"), F.coalesce("primary_url", F.lit("")).alias("apply_url"),
        F.array(F.struct(F.col("location_raw").alias("display_name"), F.lit(True).alias("is_primary"))).alias("locations"),
        F.when(F.contains("source_repo", F.lit("Intern")), "internship").otherwise("full_time").alias("employment_type"),
        F.col("title_similarity").alias("cosine_score"), F.col("skills_overlap").alias("skill_overlap_score"), F.col("industry_match").alias("domain_match_score"), F.lit(0.5).alias("seniority_match_score"),
        F.struct(F.col("company_name").alias("name"), F.coalesce("_i", F.lit("unknown")).alias("industry"), F.coalesce("_s", F.lit("unknown")).alias("size_category")).alias("company"),
        F.col("score").alias("combined_score"),
    )
    return rows.select("job_id", item.alias("item"))


def page_summary(html: Column, text_chars: int = 6000) -> Column:
    """(title, company, text) of a landed page: from its properties, else its title up to the first bar or dash."""
    first = F.trim(F.substring_index(F.substring_index(F.coalesce(page_title(html), F.lit("")), "|", 1), "-", 1))
    title = F.coalesce(F.nullif(F.trim(page_property(html, "og:title")), F.lit("")), F.nullif(first, F.lit("")), F.lit("Unknown Role"))
    company = F.coalesce(F.nullif(F.trim(page_property(html, "og:site_name")), F.lit("")), F.lit("Unknown"))
    return F.struct(title.alias("title"), company.alias("company"), F.substring(strip_markup(html), 1, text_chars).alias("text"))


def analysis_score(user_skills: Column, required: Column, industry: Column) -> Column:
    """0 to 100 for one page: the skills signal, a known industry, and a neutral half for what a page doesn't tell; recency 0.8."""
    w = T.WEIGHTS
    known = F.when(F.coalesce(industry, F.lit("")) != "", 1.0).otherwise(0.5)
    score = w["skills"] * skills_signal(required, user_skills) + 0.5 * (w["title"] + w["size"] + w["location"] + w["feedback"]) + w["industry"] * known + w["recency"] * 0.8
    return F.rint(score * 100).cast("int")
