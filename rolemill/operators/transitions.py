"""Results of the steps written back into a snapshot. Every function gives the next snapshot; ``now`` is a parameter.

Results may come twice: of equal keys one counts (the greatest). Rows without a result stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolemill.functions import text as X
from rolemill.functions.normalize import canonical_skills, collapse_seniority, content_hash, text_hash
from rolemill.operators.predicates import active, has_entries


def _with(snapshot: DataFrame, results: DataFrame, key: str = "job_id") -> DataFrame:
    """The snapshot with a struct ``_r`` of the result's columns, null where there is none."""
    rest = [c for c in results.columns if c != key]
    one = results.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*rest)).alias("_r"))
    return snapshot.join(one, key, "left")


def write_texts(snapshot: DataFrame, outcomes: DataFrame, now: Column) -> DataFrame:
    """Outcomes (job_id, outcome, text) of fetching: success, failed, gone, skip_no_url, closed_at_source.

    Every outcome stamps the attempt and the source. A success gives the text and its hash, and withdraws the enrichment
    of a listing that has no skills yet, so that it is enriched again. gone and closed_at_source are for good.
    """
    o, won = F.col("_r.outcome"), F.coalesce(F.col("_r.outcome") == "success", F.lit(False))
    rows = _with(snapshot, outcomes)
    return rows.withColumns({
        "job_description": F.when(won, F.col("_r.text")).otherwise(F.col("job_description")),
        "text_hash": F.when(won, text_hash(F.col("_r.text"))).otherwise(F.col("text_hash")),
        "text_source": F.when(o.isNull(), F.col("text_source")).when(o == "gone", "failed").when(won, F.coalesce("_r.source", F.lit("page"))).otherwise(o),
        "text_tried_at": F.when(o.isNotNull(), now).otherwise(F.col("text_tried_at")),
        "permanent_404": F.when(o.isNull(), F.col("permanent_404")).otherwise(o.isin("gone", "closed_at_source")),
        "enriched_at": F.when(won & ~has_entries(), F.lit(None)).otherwise(F.col("enriched_at")),
    }).select(*snapshot.columns)


def write_enrichment(snapshot: DataFrame, answers: DataFrame, now: Column) -> DataFrame:
    """Answers (job_id, industry, company_size, required_skills, sponsorship): what is given overwrites; the time is stamped
    only if the listing then has skills, so one without stays in the queue."""
    rows = _with(snapshot, answers)
    given = F.col("_r").isNotNull()
    text = lambda c: F.coalesce(F.nullif(F.col(f"_r.{c}"), F.lit("")), F.col(c))
    skills = F.when(F.size("_r.required_skills") > 0, F.col("_r.required_skills")).otherwise(F.col("required_skills"))
    return rows.withColumns({
        "industry": text("industry"), "company_size": text("company_size"), "required_skills": skills,
        "sponsorship": F.coalesce("_r.sponsorship", "sponsorship"),
        "enriched_at": F.when(given & (F.coalesce(F.size(skills), F.lit(0)) > 0), now).otherwise(F.col("enriched_at")),
    }).select(*snapshot.columns)


def write_vectors(snapshot: DataFrame, vectors: DataFrame, model: str, now: Column) -> DataFrame:
    """Vectors (job_id, embedding) with their model and time; a null vector writes nothing."""
    rows = _with(snapshot, vectors.where(F.col("embedding").isNotNull()).select("job_id", "embedding"))
    new = F.col("_r.embedding")
    return rows.withColumns({"embedding": F.coalesce(new, F.col("embedding")), "embedding_model": F.when(new.isNotNull(), model).otherwise(F.col("embedding_model")), "embedded_at": F.when(new.isNotNull(), now).otherwise(F.col("embedded_at"))}).select(*snapshot.columns)


def write_addresses(snapshot: DataFrame, found: DataFrame, now: Column) -> DataFrame:
    """Resolved addresses (job_id, url; null where nothing was found) for listings that have none.

    A new address changes the version, and the time of the vector where there is one, so that the listing is shipped
    again. A miss is marked, and nothing of it is shipped.
    """
    rows = _with(snapshot, found.withColumn("asked", F.lit(True)))
    lacks = F.col("_r.asked") & (F.coalesce("apply_url", F.lit("")) == "")
    url = F.when(lacks, F.nullif(F.col("_r.url"), F.lit("")))
    return rows.withColumns({
        "apply_url": F.coalesce(url, F.col("apply_url")),
        "content_hash": F.when(url.isNotNull(), F.sha2(F.concat_ws("|", "job_id", url), 256)).otherwise(F.col("content_hash")),
        "embedded_at": F.when(url.isNotNull() & F.col("embedding").isNotNull(), now).otherwise(F.col("embedded_at")),
        "text_source": F.when(lacks & url.isNull(), "skip_no_url").otherwise(F.col("text_source")),
    }).select(*snapshot.columns)


def supplement_from_titles(snapshot: DataFrame, unspecific: str = "other") -> DataFrame:
    """Active listings without skills take those that the title implies; an unspecific industry is replaced by the title's."""
    skills, industry = X.title_skills(F.col("role_title")), X.title_industry(F.col("role_title"))
    return snapshot.withColumns({
        "required_skills": F.when(active() & ~has_entries() & (F.size(skills) > 0), skills).otherwise(F.col("required_skills")),
        "industry": F.when(active() & (F.col("industry") == unspecific), F.coalesce(industry, F.col("industry"))).otherwise(F.col("industry")),
    })


def backfill(snapshot: DataFrame) -> DataFrame:
    """What older rows lack: levels by title where null, versions where null or malformed, skills in canonical form, and
    levels outside the vocabulary folded into it. ``functions`` holds the kinds of work by title."""
    level = F.coalesce(F.col("seniority_level"), X.title_stage(F.col("role_title")))
    version = F.col("content_hash")
    good = F.coalesce(version.rlike("^[0-9a-f]{64}$"), F.lit(False))
    return snapshot.withColumns({
        "seniority_level": collapse_seniority(level),
        "content_hash": F.when(good, version).otherwise(content_hash(F.col("company_name"), F.col("role_title"))),
        "required_skills": F.when(has_entries(), canonical_skills(F.col("required_skills"))).otherwise(F.col("required_skills")),
        "functions": X.title_function(F.col("role_title")),
    })


def reset_enrichment(snapshot: DataFrame, which: Column) -> DataFrame:
    """The rows asked for lose their stamp, so that they are enriched again."""
    return snapshot.withColumn("enriched_at", F.when(F.coalesce(which, F.lit(False)), F.lit(None)).otherwise(F.col("enriched_at")))
