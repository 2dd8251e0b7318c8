"""Queries of the state transitions, shipments, requests and feeds, each with the same thing in SQL.

The listing table lacks some columns of a running system (when a text was tried, an address of the employer's own); here
they are derived from columns that it has, in the query and in the SQL alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolemill.functions import text as X
from rolemill.operators import dedup, enrich, gates, match, merge, predicates, requests, stats, sync, transitions
from rolemill.operators import feedback as fold
from rolemill.plans import pipeline, title_sql
from rolemill.functions import tables as T
from rolemill.plans.queries import _FIRST, _LEDGER, _LEVEL, _METRICS, _NEW, _OLD, _SKILLS, _TEXT, _TK, NOW, sql_case, _old_new, jobs_of, now, query
from rolemill.session import load
from rolemill.sources import details, parsers

_TS = f"TIMESTAMP '{NOW}'"
#: The derived columns: text_tried_at, enriched_at, text_source, apply_url, permanent_404, dead, dead_confirmed_at.
_WIDE = """SELECT *, embedded_at AS text_tried_at, CASE WHEN company_size IS NOT NULL THEN last_seen_at END AS enriched_at,
 CASE WHEN embedded_at IS NULL THEN NULL WHEN status = 'inactive' THEN 'skip_no_url' ELSE 'failed' END AS text_source, CASE WHEN sponsorship THEN primary_url END AS apply_url,
 coalesce(company_size = 'large' AND sponsorship IS FALSE, false) AS permanent_404, coalesce(company_size = 'startup' AND sponsorship IS FALSE, false) AS dead,
 CASE WHEN company_size = 'startup' AND sponsorship IS FALSE THEN last_seen_at END AS dead_confirmed_at, sha256(job_description) AS text_hash FROM jobs"""


def wide(spark, d: str) -> DataFrame:
    c = F.col
    gone = lambda size: F.coalesce((c("company_size") == size) & (c("sponsorship") == False), F.lit(False))  # noqa: E712, E731
    return jobs_of(spark, d).withColumns({
        "text_tried_at": c("embedded_at"),
        "enriched_at": F.when(c("company_size").isNotNull(), c("last_seen_at")),
        "text_source": F.when(c("embedded_at").isNull(), F.lit(None)).when(c("status") == "inactive", "skip_no_url").otherwise("failed"),
        "apply_url": F.when(c("sponsorship"), c("primary_url")),
        "permanent_404": gone("large"), "dead": gone("startup"), "dead_confirmed_at": F.when(gone("startup"), c("last_seen_at")), "text_hash": F.sha2("job_description", 256),
    })


# ---- queues and predicates


@query(f"""WITH w AS ({_WIDE}) SELECT job_id, status = 'active' AND (enriched_at IS NULL OR enriched_at < {_TS} - INTERVAL 7 DAY) AND (job_description IS NULL OR coalesce(len(required_skills) = 0, false)) AS enrich,
 status = 'active' AND NOT {_TEXT} AND NOT permanent_404 AND (text_tried_at IS NULL OR coalesce(text_tried_at < {_TS} - INTERVAL 1 DAY AND text_source NOT IN ('skip_no_url', 'closed_at_source'), false)) AS fetch,
 status = 'active' AND coalesce(apply_url, '') = '' AND coalesce(contains(lower(primary_url), 'example'), false) AND role_title IS NOT NULL AND (text_source IS NULL OR text_source <> 'skip_no_url') AS resolve,
 coalesce(status = 'inactive' AND last_seen_at BETWEEN {_TS} - INTERVAL 20 DAY AND {_TS} - INTERVAL 1 DAY, false) AS went_stale FROM w""")
def queue_flags(spark, d):
    """Which queue every listing stands in."""
    flags = {"enrich": predicates.needs_enrichment(now()), "fetch": predicates.needs_text(now()), "resolve": predicates.needs_address("example"), "went_stale": predicates.went_stale(now(), 1, 20)}
    return wide(spark, d).select("job_id", *[F.coalesce(c, F.lit(False)).alias(n) for n, c in flags.items()])


@query(f"""WITH w AS ({_WIDE}), q AS (SELECT * FROM w WHERE status = 'active' AND (enriched_at IS NULL OR enriched_at < {_TS} - INTERVAL 7 DAY) AND (job_description IS NULL OR coalesce(len(required_skills) = 0, false)))
 SELECT job_id, first_seen_at FROM q ORDER BY first_seen_at, job_id LIMIT 3000""")
def enrichment_queue(spark, d):
    return stats.queue(wide(spark, d), predicates.needs_enrichment(now()), [F.col("first_seen_at"), F.col("job_id")]).select("job_id", "first_seen_at")


@query(f"""WITH w AS ({_WIDE}) SELECT job_id, {_TEXT} AND {_SKILLS} AND status = 'active' AND embedding IS NOT NULL AND embedded_at IS NOT NULL AND NOT dead AND NOT permanent_404 AS shippable,
 {_TEXT} AND {_SKILLS} AND status = 'active' AND embedding IS NOT NULL AND embedded_at IS NOT NULL AS without_tombstones, string_split(source_repo, ':')[1] IN ('linkedin', 'otta', 'greenhouse') AS in_feeds FROM w""")
def shippable_flags(spark, d):
    return wide(spark, d).select("job_id", predicates.shippable().alias("shippable"), predicates.shippable(False).alias("without_tombstones"), predicates.in_feeds("linkedin", "otta", "greenhouse").alias("in_feeds"))


@query(r"""SELECT job_id, CASE WHEN regexp_matches(u, '(job-)?boards\.greenhouse\.io/[^/?#]+', 'i') OR regexp_matches(u, '[a-z0-9_-]+\.greenhouse\.io', 'i') THEN 'greenhouse' WHEN regexp_matches(u, '[a-z0-9_-]+\.lever\.co', 'i') THEN 'lever'
 WHEN regexp_matches(u, '[a-z0-9_-]+\.ashbyhq\.com', 'i') THEN 'ashby' WHEN regexp_matches(u, '[a-z0-9_-]+\.myworkdayjobs\.com', 'i') THEN 'workday' WHEN regexp_matches(u, 'jobright\.ai', 'i') THEN 'jobright' WHEN regexp_matches(u, 'simplify\.jobs', 'i') THEN 'simplify' ELSE 'unknown' END AS tier,
 CASE WHEN contains(h, 'greenhouse.io') THEN 'greenhouse' WHEN contains(h, 'lever.co') THEN 'lever' WHEN contains(h, 'ashbyhq.com') THEN 'ashby' WHEN contains(h, 'myworkdayjobs.com') OR contains(h, 'myworkdaysite.com') THEN 'workday'
 WHEN contains(lower(u), '/wday/') AND contains(lower(regexp_replace(regexp_replace(u, '[?#].*$', ''), '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?[^/?#]*', '')), '/wday/') THEN 'workday' WHEN contains(h, 'jobright.ai') THEN 'jobright' ELSE 'rendered' END AS route
 FROM (SELECT job_id, primary_url AS u, lower(regexp_extract(trim(primary_url), '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?([^/?#]*)', 1)) AS h FROM jobs WHERE primary_url IS NOT NULL)""")
def address_systems(spark, d):
    u = F.col("primary_url")
    return jobs_of(spark, d).where(u.isNotNull()).select("job_id", X.hosting(u)["tier"].alias("tier"), X.fetch_route(u).alias("route"))


_P = "(SELECT list_sort(list_distinct(list_transform(preferred_locations, lambda p: lower(trim(p))))) FROM user_profiles WHERE len(preferred_locations) > 0 ORDER BY user_id LIMIT 1)"


@query("""SELECT f.feed, count(*) AS asked, count(*) FILTER (WHERE status = 'active') AS resolved, CASE WHEN bool_or(false) OR (count(*) >= 50 AND count(*) FILTER (WHERE status = 'active') = 0) THEN 'degraded' ELSE 'ok' END AS outcome
 FROM (SELECT string_split(source_repo, ':')[1] AS feed, status FROM jobs) f GROUP BY 1""")
def stage_outcomes(spark, d):
    rows = jobs_of(spark, d).select(F.substring_index("source_repo", ":", 1).alias("stage"), F.coalesce(F.col("status") == "active", F.lit(False)).alias("resolved"), F.lit(False).alias("infra_error"))
    return gates.stage_outcome(rows).withColumnRenamed("stage", "feed")


# ---- write-backs

_OUT = f"""SELECT job_id, CASE WHEN primary_url IS NULL THEN 'skip_no_url' WHEN status = 'duplicate' THEN 'closed_at_source' WHEN status = 'inactive' THEN 'gone' WHEN {_TEXT} THEN 'success' ELSE 'failed' END AS outcome,
 CASE WHEN primary_url IS NOT NULL AND status = 'active' AND {_TEXT} THEN upper(job_description) END AS text, 'page' AS source FROM jobs WHERE embedded_at IS NULL OR status <> 'active'"""


def _outcomes(spark, d: str) -> DataFrame:
    c = F.col
    ok = predicates.usable_text()
    kind = F.when(c("primary_url").isNull(), "skip_no_url").when(c("status") == "duplicate", "closed_at_source").when(c("status") == "inactive", "gone").when(ok, "success").otherwise("failed")
    return jobs_of(spark, d).where(c("embedded_at").isNull() | (c("status") != "active")).select("job_id", kind.alias("outcome"), F.when(c("primary_url").isNotNull() & (c("status") == "active") & ok, F.upper("job_description")).alias("text"), F.lit("page").alias("source"))


@query(f"""WITH w AS ({_WIDE}), o AS ({_OUT}) SELECT w.job_id, CASE WHEN outcome = 'success' THEN sha256(o.text) ELSE sha256(w.job_description) END AS text_hash, CASE WHEN outcome IS NULL THEN w.text_source WHEN outcome = 'gone' THEN 'failed' WHEN outcome = 'success' THEN 'page' ELSE outcome END AS text_source,
 CASE WHEN outcome IS NULL THEN w.text_tried_at ELSE {_TS} END AS text_tried_at, CASE WHEN outcome IS NULL THEN w.permanent_404 ELSE outcome IN ('gone', 'closed_at_source') END AS permanent_404,
 CASE WHEN outcome = 'success' AND coalesce(len(required_skills), 0) = 0 THEN NULL ELSE w.enriched_at END AS enriched_at FROM w LEFT JOIN o ON w.job_id = o.job_id""")
def texts_written(spark, d):
    outcomes = _outcomes(spark, d)
    written = transitions.write_texts(wide(spark, d), outcomes.union(outcomes.where("outcome = 'gone'")), now())
    return written.select("job_id", "text_hash", "text_source", "text_tried_at", "permanent_404", "enriched_at")


@query(f"""WITH w AS ({_WIDE}), f AS (SELECT job_id, CASE WHEN len(sources) > 0 THEN 'https://x.example/' || job_id END AS url FROM jobs WHERE status = 'active')
 SELECT w.job_id, CASE WHEN coalesce(w.apply_url, '') = '' THEN coalesce(f.url, w.apply_url) ELSE w.apply_url END AS apply_url, CASE WHEN coalesce(w.apply_url, '') = '' AND f.url IS NOT NULL THEN sha256(w.job_id || '|' || f.url) ELSE w.content_hash END AS content_hash,
 CASE WHEN coalesce(w.apply_url, '') = '' AND f.url IS NOT NULL AND w.embedding IS NOT NULL THEN {_TS} ELSE w.embedded_at END AS embedded_at, CASE WHEN f.job_id IS NOT NULL AND coalesce(w.apply_url, '') = '' AND f.url IS NULL THEN 'skip_no_url' ELSE w.text_source END AS text_source FROM w LEFT JOIN f ON w.job_id = f.job_id""")
def addresses_written(spark, d):
    found = jobs_of(spark, d).where("status = 'active'").select("job_id", F.when(F.size("sources") > 0, F.concat(F.lit("https://x.example/"), "job_id")).alias("url"))
    return transitions.write_addresses(wide(spark, d), found, now()).select("job_id", "apply_url", "content_hash", "embedded_at", "text_source")


@query(f"""WITH w AS ({_WIDE}), a AS (SELECT job_id, lower(trim(industry)) AS industry, CASE WHEN len(sources) > 1 THEN list_sort(sources) ELSE [] END AS skills FROM jobs WHERE status = 'active')
 SELECT w.job_id, coalesce(nullif(a.industry, ''), w.industry) AS industry, CASE WHEN len(a.skills) > 0 THEN a.skills ELSE w.required_skills END AS required_skills,
 CASE WHEN a.job_id IS NOT NULL AND len(CASE WHEN len(a.skills) > 0 THEN a.skills ELSE coalesce(w.required_skills, []) END) > 0 THEN {_TS} ELSE w.enriched_at END AS enriched_at FROM w LEFT JOIN a ON w.job_id = a.job_id""")
def enrichment_written(spark, d):
    c = F.col
    answers = jobs_of(spark, d).where("status = 'active'").select("job_id", F.lower(F.trim("industry")).alias("industry"), F.lit("").alias("company_size"), F.when(F.size("sources") > 1, F.array_sort("sources")).otherwise(F.array().cast("array<string>")).alias("required_skills"), F.lit(None).cast("boolean").alias("sponsorship"))
    return transitions.write_enrichment(wide(spark, d), answers, now()).select("job_id", "industry", c("required_skills"), "enriched_at")


@query(f"""WITH s AS ({title_sql.TITLE_SKILLS}) SELECT j.job_id, CASE WHEN j.status = 'active' AND coalesce(len(required_skills), 0) = 0 AND len(s.skills) > 0 THEN s.skills ELSE j.required_skills END AS required_skills,
 CASE WHEN j.status = 'active' AND j.industry = 'other' THEN coalesce({title_sql.INDUSTRY}, j.industry) ELSE j.industry END AS industry FROM (SELECT * REPLACE (CASE WHEN company_size = 'unknown' THEN 'other' ELSE industry END AS industry) FROM jobs) j JOIN s ON s.job_id = j.job_id""")
def titles_supplemented(spark, d):
    j = jobs_of(spark, d).withColumn("industry", F.when(F.col("company_size") == "unknown", "other").otherwise(F.col("industry")))
    return transitions.supplement_from_titles(j).select("job_id", "required_skills", "industry")


@query(f"""SELECT job_id, CASE WHEN regexp_matches(content_hash, '^[0-9a-f]{{64}}$') THEN content_hash ELSE sha256(concat_ws('|', regexp_replace(company_name, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g'), regexp_replace(role_title, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g'))) END AS content_hash,
 CASE WHEN seniority_level IS NULL THEN {title_sql.STAGE} END AS filled_level, CASE WHEN f IS NULL THEN [] ELSE [f] END AS functions FROM (SELECT *, {title_sql.FUNCTION} AS f FROM jobs)""")
def backfilled(spark, d):
    j = jobs_of(spark, d)
    out = transitions.backfill(j.withColumn("was", F.col("seniority_level")))
    return out.select("job_id", "content_hash", F.when(F.col("was").isNull(), F.col("seniority_level")).alias("filled_level"), "functions")


@query(f"""WITH w AS ({_WIDE}) SELECT job_id, CASE WHEN status = 'active' AND coalesce(len(required_skills), 0) = 0 THEN NULL ELSE enriched_at END AS enriched_at FROM w""")
def enrichment_reset(spark, d):
    return transitions.reset_enrichment(wide(spark, d), predicates.active() & ~predicates.has_entries()).select("job_id", "enriched_at")


@query(f"""WITH v AS (SELECT job_id, embedding FROM jobs WHERE embedding IS NOT NULL AND status = 'active') SELECT j.job_id, v.embedding AS embedding, CASE WHEN v.job_id IS NULL THEN j.embedding_model ELSE 'model-2' END AS embedding_model, CASE WHEN v.job_id IS NULL THEN j.embedded_at ELSE {_TS} END AS embedded_at
 FROM (SELECT * REPLACE (NULL AS embedding) FROM jobs) j LEFT JOIN v ON j.job_id = v.job_id""")
def vectors_written(spark, d):
    j = jobs_of(spark, d)
    bare = j.withColumn("embedding", F.lit(None).cast("array<float>"))
    return transitions.write_vectors(bare, j.where("status = 'active'").select("job_id", "embedding"), "model-2", now()).select("job_id", "embedding", "embedding_model", "embedded_at")


@query(f"""WITH w AS ({_WIDE}), r AS (SELECT job_id, max(recorded_at) AS at FROM feedback GROUP BY 1) SELECT w.job_id, CASE WHEN r.job_id IS NOT NULL THEN true ELSE w.dead END AS dead,
 CASE WHEN r.job_id IS NOT NULL THEN coalesce(w.dead_confirmed_at, r.at, {_TS}) ELSE w.dead_confirmed_at END AS dead_confirmed_at FROM w LEFT JOIN r ON w.job_id = r.job_id""")
def dead_mirrored(spark, d):
    """Listings with a reaction stand for those that another store calls dead."""
    remote = load(spark, d, "feedback").select("job_id", F.col("recorded_at").alias("dead_at"))
    return merge.mirror_dead(wide(spark, d), remote, now()).select("job_id", "dead", "dead_confirmed_at")


@query(f"""SELECT j.job_id, CASE WHEN f.job_id IS NOT NULL THEN 'inactive' ELSE j.status END AS status, CASE WHEN f.job_id IS NOT NULL THEN {_TS} ELSE j.last_seen_at END AS last_seen_at FROM jobs j LEFT JOIN (SELECT DISTINCT job_id FROM feedback WHERE reaction = 'dislike') f ON f.job_id = j.job_id""")
def marked_inactive(spark, d):
    return merge.mark_inactive(jobs_of(spark, d), load(spark, d, "feedback").where("reaction = 'dislike'"), now()).select("job_id", "status", "last_seen_at")


@query(f"""WITH f AS (SELECT job_id, min(reaction) AS reason FROM feedback GROUP BY 1) SELECT j.job_id, CASE WHEN f.job_id IS NOT NULL AND j.status <> 'inactive' THEN 'inactive' ELSE j.status END AS status, coalesce(f.job_id IS NOT NULL AND j.status <> 'inactive', false) AS flipped,
 CASE WHEN f.job_id IS NOT NULL AND j.status <> 'inactive' THEN {_TS} END AS flipped_at, CASE WHEN f.job_id IS NOT NULL AND j.status <> 'inactive' THEN f.reason END AS flip_reason FROM jobs j LEFT JOIN f ON f.job_id = j.job_id""")
def flipped(spark, d):
    j = jobs_of(spark, d).withColumns({"flipped": F.lit(False), "flipped_at": F.lit(None).cast("timestamp_ntz"), "flip_reason": F.lit(None).cast("string")})
    flips = load(spark, d, "feedback").select("job_id", F.lit("inactive").alias("new_status"), F.col("reaction").alias("reason"))
    return merge.flip(j, flips, now()).select("job_id", "status", "flipped", "flipped_at", "flip_reason")


@query(f"SELECT job_id, CASE WHEN status = 'active' AND last_seen_at < {_TS} - INTERVAL 20 DAY THEN 'inactive' ELSE status END AS status FROM jobs")
def aged(spark, d):
    return merge.stale_by_age(jobs_of(spark, d), now()).select("job_id", "status")


@query(f"""WITH t AS (SELECT job_id, max(synced_at) AS sure FROM synced_hashes GROUP BY 1), w AS (SELECT j.*, t.job_id IS NOT NULL AS was_dead, t.sure FROM jobs j LEFT JOIN t ON t.job_id = j.job_id),
 a AS (SELECT job_id FROM w WHERE was_dead AND sure <= {_TS} - INTERVAL 90 DAY ORDER BY job_id LIMIT 100) SELECT w.job_id, w.was_dead AND w.job_id NOT IN (SELECT job_id FROM a) AS dead, CASE WHEN w.job_id NOT IN (SELECT job_id FROM a) THEN w.sure END AS dead_confirmed_at FROM w""")
def tombstones_revived(spark, d):
    """Every listing of the ledger stands for a dead one, some of them confirmed twice."""
    t = load(spark, d, "synced_hashes").select("job_id", F.lit(True).alias("dead"), F.col("synced_at").alias("dead_confirmed_at"))
    j = jobs_of(spark, d)
    known = t.groupBy("job_id").agg(F.max("dead_confirmed_at").alias("dead_confirmed_at"))
    snapshot = j.select("job_id").join(known, "job_id", "left").withColumn("dead", F.col("dead_confirmed_at").isNotNull())
    return merge.revived(snapshot, merge.split_tombstoned(j, t, now())).select("job_id", "dead", "dead_confirmed_at")


# ---- feeds and runs


@query(f"""WITH o AS ({_OLD}), n AS ({_NEW}), u AS (SELECT *, 'specific' AS mode FROM n UNION ALL BY NAME SELECT *, 'full_scope' AS mode FROM o WHERE source_repo < 'h'),
 p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY last_seen_at DESC NULLS LAST, mode, source_repo) AS rn FROM u) WHERE rn = 1)
 SELECT string_split(p.source_repo, ':')[1] AS feed, p.mode, count(*) FILTER (WHERE o.job_id IS NULL) AS inserted, count(*) FILTER (WHERE o.job_id IS NOT NULL AND p.content_hash IS DISTINCT FROM o.content_hash) AS updated, count(*) FILTER (WHERE o.job_id IS NOT NULL AND p.content_hash IS NOT DISTINCT FROM o.content_hash) AS unchanged
 FROM p LEFT JOIN o ON o.job_id = p.job_id GROUP BY 1, 2""")
def feeds_united(spark, d):
    """Two feeds as one delta, counted by feed against the snapshot."""
    old, new = _old_new(spark, d)
    delta = pipeline.all_feeds({"boards/specific": new, "tables/full_scope": old.where(F.col("source_repo") < "h")})
    return pipeline.feed_counts(delta, old)


@query(f"""WITH w AS ({_WIDE}), l AS ({_LEDGER}), live AS (SELECT w.job_id, 'active' AS stream, 1 AS turn FROM w LEFT JOIN l ON l.job_id = w.job_id WHERE w.status = 'active' AND w.embedding IS NOT NULL AND w.embedded_at IS NOT NULL AND {_TEXT} AND {_SKILLS} AND NOT w.dead AND NOT w.permanent_404 AND (l.job_id IS NULL OR w.content_hash IS DISTINCT FROM l.content_hash))
 SELECT job_id, 'inactive' AS stream, 0 AS turn FROM jobs WHERE status = 'inactive' AND job_id IN (SELECT job_id FROM synced_hashes) UNION ALL SELECT * FROM live""")
def shipment_planned(spark, d):
    return sync.shipment(wide(spark, d), load(spark, d, "synced_hashes")).select("job_id", "stream", "turn")


@query(f"""WITH w AS ({_WIDE}), l AS ({_LEDGER}), live AS (SELECT w.job_id, w.content_hash FROM w LEFT JOIN l ON l.job_id = w.job_id WHERE w.status = 'active' AND w.embedding IS NOT NULL AND w.embedded_at IS NOT NULL AND {_TEXT} AND {_SKILLS} AND NOT w.dead AND NOT w.permanent_404 AND (l.job_id IS NULL OR w.content_hash IS DISTINCT FROM l.content_hash)),
 done AS (SELECT * FROM live WHERE job_id NOT IN (SELECT job_id FROM feedback)), a AS (SELECT job_id, content_hash, synced_at FROM synced_hashes UNION ALL SELECT job_id, content_hash, {_TS} FROM done)
 SELECT job_id, arg_max_null(content_hash, (synced_at, content_hash)) AS content_hash, max(synced_at) AS synced_at FROM a GROUP BY 1""")
def ledger_after_run(spark, d):
    """Documents of listings with a reaction stand for those that the receiver refused."""
    ledger = load(spark, d, "synced_hashes")
    sent = sync.shipment(wide(spark, d), ledger)
    refused = load(spark, d, "feedback").select("job_id", F.lit(True).alias("_no")).distinct()
    results = sent.select("job_id").join(refused, "job_id", "left").select("job_id", F.col("_no").isNull().alias("delivered"))
    return sync.after_run(ledger, sent, results, now())[0]


@query(f"""WITH m AS ({_METRICS}) SELECT vector_violations = 0 AND matchable >= 1000 AS passes, matchable, CAST(1000 AS DOUBLE) AS baseline, CASE WHEN vector_violations = 0 AND matchable >= 1000 THEN CAST(matchable AS DOUBLE) ELSE 1000 END AS next_baseline FROM m""")
def publication(spark, d):
    baseline = spark.createDataFrame([("matchable", 1000.0)], "metric string, value double")
    return gates.publish_decision(gates.health_metrics(jobs_of(spark, d)), baseline)


@query("SELECT 'sponsorship_cov' AS metric, round(count(*) FILTER (WHERE sponsorship IS NOT NULL) / count(*), 6) AS value, CAST(1.0 AS DOUBLE) AS before, round((1.0 - round(count(*) FILTER (WHERE sponsorship IS NOT NULL) / count(*), 6)) * 100, 4) AS points FROM jobs WHERE status = 'active'")
def soft_warnings(spark, d):
    prior = spark.createDataFrame([("sponsorship_cov", 1.0)], "metric string, value double")
    return gates.gate_warnings(gates.soft_metrics(jobs_of(spark, d)), prior)


@query(f"""WITH i AS (SELECT first_seen_at > min(first_seen_at) OVER (PARTITION BY lower(trim(regexp_replace(company_name, '[\\s\\p{{Z}}]+', ' ', 'g'))), lower(trim(regexp_replace(role_title, '[\\s\\p{{Z}}]+', ' ', 'g'))), source_repo) AS late FROM jobs),
 r AS (SELECT 'no_level' AS "check", count(*) FILTER (WHERE status = 'active' AND seniority_level IS NULL) AS rows FROM jobs UNION ALL SELECT 'no_skills', count(*) FILTER (WHERE status = 'active' AND {_TEXT} AND NOT {_SKILLS}) FROM jobs UNION ALL SELECT 'late_first_seen', count(*) FILTER (WHERE late) FROM i)
 SELECT *, rows > 100 AS alert FROM r""")
def integrity_alerts(spark, d):
    j = jobs_of(spark, d)
    return gates.integrity_alerts(j, merge.backfill_first_seen(j))


@query(f"""WITH c AS (SELECT count(*) FILTER (WHERE status = 'active') AS active, count(*) FILTER (WHERE status = 'active' AND embedding IS NOT NULL) AS embedded, count(*) FILTER (WHERE embedding IS NOT NULL AND len(embedding) <> 64) AS wrong_size, count(*) FILTER (WHERE embedded_at IS NOT NULL AND embedding IS NULL) AS time_without_vector,
 count(*) FILTER (WHERE embedding IS NOT NULL AND embedded_at IS NULL) AS vector_without_time, count(*) FILTER (WHERE embedding IS NOT NULL AND embedding_model IS NULL) AS vector_without_model, count(*) FILTER (WHERE status = 'active' AND embedding IS NOT NULL AND NOT {_TEXT}) AS embedded_thin_text, count(*) FILTER (WHERE status = 'active' AND seniority_level IS NULL) AS no_level,
 count(*) FILTER (WHERE status = 'active' AND coalesce(primary_url, '') = '') AS no_address, count(*) FILTER (WHERE last_seen_at < first_seen_at) AS ends_before_start, count(DISTINCT embedding_model) AS models FROM jobs),
 x AS (SELECT unnest([{{'check': 'coverage_below_floor', 'bad': embedded / active < 0.97, 'severity': 'WARN', 'value': embedded / active}}, {{'check': 'mixed_models', 'bad': models > 1, 'severity': 'CRIT', 'value': models}}, {{'check': 'wrong_size', 'bad': wrong_size > 0, 'severity': 'CRIT', 'value': wrong_size}},
 {{'check': 'no_level_share', 'bad': no_level / active > 0.2, 'severity': 'WARN', 'value': no_level / active}}, {{'check': 'time_without_vector', 'bad': time_without_vector > 0, 'severity': 'WARN', 'value': time_without_vector}}, {{'check': 'vector_without_time', 'bad': vector_without_time > 0, 'severity': 'WARN', 'value': vector_without_time}},
 {{'check': 'vector_without_model', 'bad': vector_without_model > 0, 'severity': 'WARN', 'value': vector_without_model}}, {{'check': 'embedded_thin_text', 'bad': embedded_thin_text > 0, 'severity': 'WARN', 'value': embedded_thin_text}}, {{'check': 'no_address', 'bad': no_address > 0, 'severity': 'WARN', 'value': no_address}},
 {{'check': 'ends_before_start', 'bad': ends_before_start > 0, 'severity': 'WARN', 'value': ends_before_start}}]) AS e FROM c),
 n AS (SELECT 'same_listing' AS k, 'INFO' AS s, (SELECT coalesce(sum(c - 1), 0) FROM (SELECT count(*) AS c FROM jobs WHERE status = 'active' AND coalesce(primary_url, '') <> '' GROUP BY company_name, role_title, primary_url)) AS v UNION ALL SELECT 'repeated_reaction', 'WARN', (SELECT coalesce(sum(c - 1), 0) FROM (SELECT count(*) AS c FROM feedback GROUP BY user_id, job_id))
 UNION ALL SELECT 'reaction_of_nobody', 'WARN', (SELECT count(*) FROM feedback WHERE user_id NOT IN (SELECT user_id FROM user_profiles)) UNION ALL SELECT 'reaction_to_nothing', 'WARN', (SELECT count(*) FROM feedback WHERE job_id NOT IN (SELECT job_id FROM jobs)))
 SELECT e."check" AS "check", CASE WHEN e.bad THEN e.severity ELSE 'ok' END AS severity, round(e.value, 6) AS value FROM x UNION ALL SELECT k, CASE WHEN v > 0 THEN s ELSE 'ok' END, CAST(v AS DOUBLE) FROM n""")
def integrity_audit(spark, d):
    return merge.audit(jobs_of(spark, d), load(spark, d, "feedback"), load(spark, d, "user_profiles"), 64)


# ---- profiles


_LISTS = f"""a AS (SELECT f.user_id, f.reaction, f.recorded_at, f.feedback_id, j.company_name FROM ({_FIRST}) f JOIN jobs j ON f.job_id = j.job_id),
 k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, reaction ORDER BY recorded_at DESC, feedback_id DESC) AS k FROM a WHERE reaction IN ('like', 'dislike')) WHERE k <= 100),
 l AS (SELECT user_id, coalesce(list(company_name ORDER BY k DESC) FILTER (WHERE reaction = 'like'), []) AS liked, coalesce(list(company_name ORDER BY k DESC) FILTER (WHERE reaction = 'dislike'), []) AS disliked FROM k GROUP BY user_id), u AS (SELECT DISTINCT user_id FROM a)"""
_FOLDED = f"""WITH {_LISTS} SELECT coalesce(p.user_id, u.user_id) AS user_id, list_concat(coalesce(p.liked_companies, []), coalesce(l.liked, []))[-100:] AS liked_companies, list_concat(coalesce(p.disliked_companies, []), coalesce(l.disliked, []))[-100:] AS disliked_companies
 FROM user_profiles p FULL OUTER JOIN u ON p.user_id = u.user_id LEFT JOIN l ON l.user_id = u.user_id"""


@query(_FOLDED)
def profiles_after_two_runs(spark, d):
    """The same log twice: the second run finds nothing new."""
    jobs, log = jobs_of(spark, d), load(spark, d, "feedback")
    profiles = load(spark, d, "user_profiles").withColumn("affinity", F.lit(None).cast("array<double>"))
    once, accepted = fold.apply_feedback(profiles, log, jobs, None, 64)
    twice, _ = fold.apply_feedback(once, log, jobs, accepted, 64)
    return twice.select("user_id", "liked_companies", "disliked_companies")


_DOC = """SELECT user_id, CASE WHEN requires_sponsorship THEN NULL ELSE skills END AS patch, CASE WHEN len(coalesce(disliked_companies, [])) > 0 THEN 3.5 END AS years FROM user_profiles"""


@query(f"""WITH p AS ({_DOC}) SELECT u.user_id, CASE WHEN len(u.liked_companies) > 0 THEN u.skills WHEN len(p.patch) > 0 THEN list_filter(list_transform(p.patch, lambda s: trim(s)), lambda s, i: list_position(list_transform(p.patch, lambda t: lower(trim(t))), lower(s)) = i AND s <> '') ELSE [] END AS skills,
 CASE WHEN len(u.liked_companies) > 0 THEN 1.0 ELSE p.years END AS total_years FROM user_profiles u JOIN p ON p.user_id = u.user_id""")
def profiles_patched(spark, d):
    """Requests of users with liked companies bring their own skills and years; those of the others take the stored document's."""
    u = load(spark, d, "user_profiles")
    own = F.coalesce(F.size("liked_companies"), F.lit(0)) > 0
    some = F.when(~F.coalesce("requires_sponsorship", F.lit(False)), F.col("skills"))
    docs = u.select("user_id", F.to_json(F.struct(some.alias("skills"), F.when(F.size(F.coalesce("disliked_companies", F.array().cast("array<string>"))) > 0, 3.5).alias("totalYearsExperience"))).alias("body"))
    asked = u.select("user_id", F.when(own, F.col("skills")).otherwise(F.array().cast("array<string>")).alias("skills"), F.when(own, 1.0).alias("total_years"), *[F.lit(None).cast("string").alias(c) for c in ("derived", "derived_version", "derived_hash")])
    return requests.patched(asked, requests.profile_patches(docs)).select("user_id", "skills", "total_years")


_OWNED = "['python', 'sql', 'project management', 'excel']"
_TOKENS = _TK("required_skills")
_LABEL = f"CASE WHEN coalesce(seniority_level, '') = '' THEN 'unknown' ELSE {sql_case(_LEVEL, T.SENIORITY_ALIASES, _LEVEL)} END"


@query(f"""WITH t AS (SELECT job_id, seniority_level, {_TOKENS} AS k, {_LABEL} AS label FROM jobs), r AS (SELECT *, {sql_case('label', T.SENIORITY_RANK, 'NULL')} AS rank,
 list_sort(list_intersect(k, ['python', 'sql', 'project_management', 'excel'])) AS m FROM t)
 SELECT job_id, round(CASE WHEN len(k) > 0 THEN list_avg(list_transform(k, lambda x: CASE x WHEN 'python' THEN 0.8 WHEN 'sql' THEN 1.0 ELSE 0.0 END)) ELSE 0.0 END, 6) AS depth, round(CASE WHEN len(k) > 0 THEN list_avg(list_transform(k, lambda x: CASE x WHEN 'python' THEN 1.0 WHEN 'sql' THEN 0.7 ELSE 0.0 END)) ELSE 0.0 END, 6) AS last_use,
 CASE WHEN label = 'unknown' THEN 0.5 WHEN label = 'senior' THEN 1.0 WHEN rank IS NULL THEN 0.5 WHEN abs(rank - 3) = 1 THEN 0.75 ELSE 0.2 END AS level, m AS matched,
 CASE WHEN len(m) > 0 THEN 'matches ' || array_to_string(m[1:3], ', ') || CASE WHEN len(m) > 3 THEN ' and ' || (len(m) - 3) || ' more' ELSE '' END || coalesce('; ' || seniority_level, '') ELSE '' END AS explanation FROM r""")
def experience_signals(spark, d):
    """Depth, last use and level against one user's experience, with the matched skills and the sentence about them."""
    c = F.col
    owned = F.array(*[F.lit(s) for s in ("python", "sql", "project management", "excel")])
    matched = match.matched_skills(c("required_skills"), owned)
    return jobs_of(spark, d).select(
        "job_id", F.round(match.depth_signal(c("required_skills"), {"python": 4, "sql": 6}, None, owned), 6).alias("depth"), F.round(match.skill_recency_signal(c("required_skills"), {"python": "present", "sql": "2024-01-01"}, now()), 6).alias("last_use"),
        match.seniority_signal(c("seniority_level"), F.lit("senior")).alias("level"), matched.alias("matched"), match.explanation(matched, c("seniority_level")).alias("explanation"),
    )


_FIELDS = {
    "direct_address": "coalesce(apply_url, '') <> '' AND NOT contains(lower(apply_url), 'jobright')", "any_address": "coalesce(primary_url, '') <> '' OR coalesce(apply_url, '') <> ''", "text": _TEXT, "skills": _SKILLS,
    "industry": "coalesce(industry, '') <> '' AND industry <> 'unknown'", "company_size": "coalesce(company_size, '') <> ''", "level": "coalesce(seniority_level, '') <> ''", "enriched": "enriched_at IS NOT NULL", "embedded": "embedding IS NOT NULL",
}
_WRONG = {
    "embedded_thin_text": f"embedding IS NOT NULL AND NOT {_TEXT}", "embedded_no_skills": f"embedding IS NOT NULL AND NOT ({_SKILLS})", "enriched_no_industry": "enriched_at IS NOT NULL AND coalesce(industry, '') = ''",
    "enriched_no_skills": f"enriched_at IS NOT NULL AND NOT ({_SKILLS})", "active_dead": "status = 'active' AND dead", "active_gone": "status = 'active' AND permanent_404", "address_of_aggregator": "contains(lower(apply_url), 'jobright')",
    "level_off_vocabulary": "seniority_level IS NOT NULL AND lower(seniority_level) NOT IN ('intern', 'entry', 'mid', 'senior')",
}


@query(f"WITH w AS ({_WIDE}), n AS (SELECT count(*) AS n FROM jobs) " + " UNION ALL ".join(f"SELECT '{k}' AS kind, '{label}' AS label, count(*) FILTER (WHERE {p}) AS rows, round(count(*) FILTER (WHERE {p}) / (SELECT n FROM n), 6) AS share FROM w" for k, some in (("there", _FIELDS), ("wrong", _WRONG)) for label, p in some.items()))
def field_report(spark, d):
    return stats.field_report(wide(spark, d), "jobright")


@query("SELECT 'rows' AS counter, count(*) AS value FROM jobs UNION ALL SELECT 'with_url', count(*) FILTER (WHERE primary_url IS NOT NULL) FROM jobs")
def counters_rolled_up(spark, d):
    """Counters of every feed, summed over the feeds."""
    per = jobs_of(spark, d).groupBy("source_repo").agg(F.count("*").alias("rows"), F.count("primary_url").alias("with_url"))
    pairs = F.array(*[F.struct(F.lit(n).alias("counter"), F.col(n).alias("value")) for n in ("rows", "with_url")])
    return stats.rolled_up(per.select(F.col("source_repo").alias("stage"), F.explode(pairs).alias("x")).select("stage", "x.*"))


@query("SELECT job_id FROM jobs WHERE status = 'inactive' AND job_id IN (SELECT job_id FROM synced_hashes)")
def still_shown(spark, d):
    """The ledger stands for the receiver: what it has is shown as active."""
    return sync.stale_active(jobs_of(spark, d), load(spark, d, "synced_hashes").withColumn("status", F.lit("active")))
