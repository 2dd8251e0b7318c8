"""Queries of the core over the job corpus, each with the same thing in SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rolemill.functions import normalize as N
from rolemill.functions import tables as T
from rolemill.functions import text as X
from rolemill.operators import dedup, enrich, gates, match, merge, predicates, requests, stats, sync
from rolemill.operators import feedback as fold
from rolemill.plans import title_sql
from rolemill.session import load
from rolemill.sources import parsers

NOW = "2026-06-30 00:00:00"
QUERIES: dict = {}
SQL: dict[str, str] = {}


def now() -> Column:
    return F.lit(NOW).cast("timestamp_ntz")


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def jobs_of(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "jobs")


# ---- SQL fragments

_ACT = "status = 'active'"
_TEXT = "coalesce(length(job_description) >= 200, false)"
_SKILLS = "coalesce(len(required_skills), 0) > 0"
_NAME = r"trim(regexp_replace(regexp_replace(lower(regexp_replace({c}, '[\p{{So}}\p{{Sm}}\p{{Sk}}]', '', 'g')), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '[\s\p{{Z}}]+', ' ', 'g'))"
_STRIP = r"regexp_replace({c}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


def sql_name(c: str) -> str:
    return _NAME.format(c=c)


def sql_strip(c: str) -> str:
    return _STRIP.format(c=c)


def sql_case(c: str, table: dict, default: str) -> str:
    q = lambda v: str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"
    return f"CASE {c} " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in table.items()) + f" ELSE {default} END"


# ---- identities and normal forms


@query(f"""SELECT job_id, sha256(concat_ws('|', lower({sql_strip('source_repo')}), {sql_name('company_name')}, lower({sql_strip('role_title')}))) AS identity,
 sha256(concat_ws('|', {sql_strip('company_name')}, {sql_strip('role_title')})) AS version, {sql_name('company_name')} AS company_key, sha256(job_description) AS text_version FROM jobs""")
def identities(spark, d):
    j, c = jobs_of(spark, d), F.col
    return j.select("job_id", N.job_identity(c("source_repo"), c("company_name"), c("role_title")).alias("identity"), N.content_hash(c("company_name"), c("role_title")).alias("version"), N.name_key(c("company_name")).alias("company_key"), N.text_hash(c("job_description")).alias("text_version"))


_PLACE = sql_name(r"regexp_extract(lower(location_raw), '^[^·,;|/]*')")
_REMOTE = ", ".join(f"'{m}'" for m in T.REMOTE_MARKERS)


@query(f"""SELECT job_id, place, sha256(concat_ws('::', 'v2', {sql_name('company_name')}, {sql_name('role_title')}, place)) AS signature FROM (
 SELECT *, CASE WHEN coalesce({_PLACE}, '') = '' THEN '__no_loc__' WHEN {_PLACE} IN ({_REMOTE}) THEN '__remote__' ELSE {_PLACE} END AS place FROM jobs)""")
def signatures(spark, d):
    c = F.col
    return jobs_of(spark, d).select("job_id", N.place_key(c("location_raw")).alias("place"), N.canonical_signature(c("company_name"), c("role_title"), c("location_raw")).alias("signature"))


_TOK = r"lower(replace(replace(regexp_replace(s, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'), ' ', '_'), '-', '_'))"


@query(f"""SELECT job_id, list_distinct_ordered AS skills, tokens FROM (SELECT job_id,
 list_filter(l, lambda x, i: list_position(l, x) = i) AS list_distinct_ordered, list_sort(list_distinct(t)) AS tokens FROM (SELECT job_id,
 list_transform(list_filter(required_skills, lambda s: s IS NOT NULL), lambda s: {sql_case("lower(regexp_replace(s, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g'))", T.SKILL_ALIASES, "lower(regexp_replace(s, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g'))")}) AS l,
 list_transform(list_filter(required_skills, lambda s: s IS NOT NULL), lambda s: {_TOK}) AS t FROM jobs))""")
def skill_forms(spark, d):
    tokens = F.array_sort(F.array_distinct(F.transform(F.filter("required_skills", lambda s: s.isNotNull()), N.skill_token)))
    return jobs_of(spark, d).select("job_id", N.canonical_skills(F.col("required_skills")).alias("skills"), tokens.alias("tokens"))


_BUCKET = sql_case("lower(regexp_replace(p, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g'))", T.PLACE_ALIASES, "lower(regexp_replace(p, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g'))")


@query(f"""SELECT job_id, CASE WHEN list_contains(b, 'remote') THEN ['remote'] ELSE list_sort(list_distinct(b)) END AS places FROM (SELECT job_id,
 list_filter(list_transform(string_split(replace(coalesce(location_raw, ''), ',', ';'), ';'), lambda p: {_BUCKET}), lambda p: p <> '') AS b FROM jobs)""")
def place_buckets(spark, d):
    return jobs_of(spark, d).select("job_id", F.array_sort(N.place_buckets(F.col("location_raw"))).alias("places"))


_LEVEL = "lower(replace(replace(regexp_replace(seniority_level, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g'), ' ', '_'), '-', '_'))"


@query(f"""SELECT job_id, label, {sql_case('label', T.SENIORITY_RANK, 'NULL')} AS rank, {sql_case("lower(regexp_replace(seniority_level, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g'))", T.SENIORITY_COLLAPSE, "lower(regexp_replace(seniority_level, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g'))")} AS stage
 FROM (SELECT *, CASE WHEN coalesce(seniority_level, '') = '' THEN 'unknown' ELSE {sql_case(_LEVEL, T.SENIORITY_ALIASES, _LEVEL)} END AS label FROM jobs)""")
def seniority_labels(spark, d):
    label = N.seniority_label(F.col("seniority_level"))
    return jobs_of(spark, d).select("job_id", label.alias("label"), N.seniority_rank(label).alias("rank"), N.collapse_seniority(F.col("seniority_level")).alias("stage"))


@query("""SELECT job_id, feed, priority, slug, text FROM (SELECT job_id, string_split(source_repo, ':')[1] AS feed, """ + sql_case("string_split(source_repo, ':')[1]", T.SOURCE_PRIORITY, "0") + r""" AS priority,
 regexp_replace(regexp_replace(lower(regexp_replace(company_name, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug,
 CASE WHEN coalesce(len(required_skills), 0) > 0 THEN role_title || ' at ' || company_name || '. Skills: ' || array_to_string(required_skills, ', ') ELSE role_title || ' at ' || company_name END AS text FROM jobs)""")
def feed_forms(spark, d):
    c = F.col
    return jobs_of(spark, d).select("job_id", N.canonical_source(c("source_repo")).alias("feed"), N.source_priority(c("source_repo")).alias("priority"), N.slug(c("company_name")).alias("slug"), N.embedding_text(c("role_title"), c("company_name"), c("required_skills")).alias("text"))


@query(r"""WITH t AS (SELECT job_id, company_name, list_filter(list_distinct(string_split_regex(lower(role_title), '[^a-z0-9+#]+')), lambda w: w <> '' AND NOT list_contains(['a','an','the','of','for','and','in','at','to','with','or','on'], w)) AS w FROM jobs),
 f AS (SELECT company_name, min(job_id) AS first_id FROM jobs GROUP BY 1)
 SELECT a.job_id, round(CASE WHEN len(list_distinct(list_concat(a.w, b.w))) > 0 THEN len(list_intersect(a.w, b.w)) / len(list_distinct(list_concat(a.w, b.w))) ELSE 0 END, 6) AS similarity
 FROM t a JOIN f ON a.company_name = f.company_name JOIN t b ON b.job_id = f.first_id""")
def title_similarity(spark, d):
    """Titles against the title of the company's first listing by id."""
    t = jobs_of(spark, d).select("job_id", "company_name", N.title_tokens(F.col("role_title")).alias("w"))
    first = t.groupBy("company_name").agg(F.min_by("w", "job_id").alias("v"))
    return t.join(first, "company_name").select("job_id", F.round(N.jaccard(F.col("w"), F.col("v")), 6).alias("similarity"))


_TRACK = ", ".join(f"'{t}'" for t in T.TRACKING_PARAMS)


@query(rf"""WITH u AS (SELECT job_id, regexp_replace(primary_url, '^\s+|\s+$', '', 'g') AS u FROM jobs WHERE primary_url IS NOT NULL),
 p AS (SELECT job_id, u, regexp_extract(u, '^[^?#]*') AS base, regexp_extract(u, '\?([^#]*)', 1) AS q FROM u),
 k AS (SELECT *, list_filter(string_split(q, '&'), lambda x: regexp_matches(x, '^[^=]*=.+') AND NOT list_contains([{_TRACK}], lower(string_split(x, '=')[1]))) AS kept FROM p),
 g AS (SELECT *, list_transform(kept, lambda x: string_split(x, '=')[1]) AS keys FROM k),
 o AS (SELECT *, flatten(list_transform(list_filter(keys, lambda x, i: list_position(keys, x) = i), lambda n: list_filter(kept, lambda x: string_split(x, '=')[1] = n))) AS ordered FROM g)
 SELECT job_id, lower(regexp_extract(base, '^[A-Za-z][A-Za-z0-9+.-]*:')) || lower(regexp_extract(base, '//[^/]*')) || regexp_replace(regexp_replace(base, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/]*)?', ''), '/+$', '') ||
 CASE WHEN len(ordered) > 0 THEN '?' || array_to_string(ordered, '&') ELSE '' END AS url FROM o""")
def canonical_urls(spark, d):
    return jobs_of(spark, d).where("primary_url is not null").select("job_id", X.canonical_url(F.col("primary_url")).alias("url"))


@query(r"""SELECT job_id, lower(regexp_extract(u, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?([^/?#]*)', 1)) AS host, nullif(regexp_extract(u, '[?&]id=([^&#]*)', 1), '') AS id_param,
 regexp_matches(lower(regexp_extract(u, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?([^/?#]*)', 1)), 'linkedin[.]com|indeed[.]com|glassdoor[.]com|ziprecruiter[.]com|simplyhired[.]com') AS aggregator,
 lower(regexp_extract(u, '^([A-Za-z]+)://', 1)) || '://' || lower(regexp_extract(u, '://([^/?#]*)', 1)) || CASE WHEN regexp_replace(regexp_extract(u, '://[^/?#]*([^?#;]*)', 1), '/+$', '') = '' THEN '/' ELSE regexp_replace(regexp_extract(u, '://[^/?#]*([^?#;]*)', 1), '/+$', '') END AS bare
 FROM (SELECT job_id, trim(primary_url) AS u FROM jobs WHERE primary_url LIKE 'http%')""")
def url_parts(spark, d):
    u = F.col("primary_url")
    return jobs_of(spark, d).where("primary_url like 'http%'").select("job_id", X.url_host(u).alias("host"), X.url_param(u, "id").alias("id_param"), X.is_aggregator(u).alias("aggregator"), X.bare_url(u).alias("bare"))


# ---- classification


@query(f"SELECT job_id, {title_sql.LEVEL} AS level, {title_sql.INDUSTRY} AS industry FROM jobs")
def title_levels(spark, d):
    return jobs_of(spark, d).select("job_id", X.title_level(F.col("role_title")).alias("level"), X.title_industry(F.col("role_title")).alias("industry"))


@query(f"SELECT job_id, CASE WHEN f IS NULL THEN [] ELSE [f] END AS functions FROM (SELECT job_id, {title_sql.FUNCTION} AS f FROM jobs)")
def title_functions(spark, d):
    return jobs_of(spark, d).select("job_id", X.title_function(F.col("role_title")).alias("functions"))


@query(title_sql.TITLE_SKILLS)
def title_skills(spark, d):
    return jobs_of(spark, d).select("job_id", X.title_skills(F.col("role_title")).alias("skills"))


@query(f"SELECT job_id, {title_sql.STAGE} AS stage FROM jobs")
def title_stages(spark, d):
    return jobs_of(spark, d).select("job_id", X.title_stage(F.col("role_title")).alias("stage"))


@query(title_sql.TEXT_SKILLS)
def text_skills(spark, d):
    """Skills named in the whole descriptions."""
    return jobs_of(spark, d).select("job_id", X.text_skills(F.coalesce("job_description", F.lit(""))).alias("skills"))


_MARK = "list_filter([" + ", ".join("'" + m.replace("'", "''") + "'" for m in T.CLOSED_MARKERS) + "], lambda m: contains(lower(text), m))[1]"
_KEYS = " OR ".join("contains(lower(text), '" + k.replace("'", "''") + "')" for k in T.ROLE_KEYWORDS)


@query(f"SELECT doc_id, {_MARK} AS closed, coalesce(length({sql_strip('text')}) >= 200 AND ({_KEYS}), false) AS describes FROM documents")
def page_markers(spark, d):
    t = F.col("text")
    return load(spark, d, "documents").select("doc_id", X.closed_marker(t).alias("closed"), F.coalesce(X.describes_role(t), F.lit(False)).alias("describes"))


@query(r"SELECT doc_id, regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace(text, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '(?s)<[^>]+>', ' ', 'g'), '[\s\p{Z}]+', ' ', 'g')), '^ | $', '', 'g') AS plain FROM documents WHERE contains(text, '<')")
def markup_stripped(spark, d):
    return load(spark, d, "documents").where(F.contains("text", F.lit("<"))).select("doc_id", X.strip_markup(F.col("text")).alias("plain"))


# ---- statistics


@query(f"""SELECT count(*) AS total, count(*) FILTER (WHERE status = 'active') AS active, count(*) FILTER (WHERE status = 'inactive') AS inactive, count(*) FILTER (WHERE status = 'duplicate') AS duplicate,
 count(*) FILTER (WHERE {_TEXT}) AS with_text, count(*) FILTER (WHERE {_SKILLS}) AS with_skills, count(embedding) AS embedded, max(last_seen_at) AS latest_seen, max(embedded_at) AS latest_embedded FROM jobs""")
def inventory(spark, d):
    return stats.inventory(jobs_of(spark, d))


@query("SELECT string_split(source_repo, ':')[1] AS feed, status, count(*) AS listings FROM jobs GROUP BY 1, 2")
def by_source_and_status(spark, d):
    return stats.by_source_and_status(jobs_of(spark, d))


@query("SELECT lower(trim(industry)) AS value, count(*) AS listings FROM jobs WHERE industry IS NOT NULL AND lower(trim(industry)) NOT IN ('', 'unknown') GROUP BY 1 ORDER BY listings DESC, value LIMIT 15")
def top_industries(spark, d):
    return stats.top_values(jobs_of(spark, d), "industry")


@query(f"SELECT CAST(first_seen_at AS DATE) AS day, count(*) AS listings FROM jobs WHERE first_seen_at >= TIMESTAMP '{NOW}' - INTERVAL 14 DAY AND first_seen_at <= TIMESTAMP '{NOW}' GROUP BY 1")
def new_per_day(spark, d):
    return stats.new_per_day(jobs_of(spark, d), now())


@query(f"SELECT coalesce(embedding_model, 'null') AS value, count(*) AS listings, count(*) FILTER (WHERE {_TEXT}) AS with_text, count(*) FILTER (WHERE {_SKILLS}) AS with_skills FROM jobs GROUP BY 1")
def coverage_by_model(spark, d):
    return stats.coverage_by(jobs_of(spark, d), "embedding_model")


_FILL = lambda c: f"CASE WHEN coalesce(trim({c}) <> '', false) THEN 10 ELSE 0 END"
_AGE = f"floor((epoch_us(TIMESTAMP '{NOW}') - epoch_us(first_seen_at)) / 86400000000)"
_LEN = "coalesce(length(trim(job_description)), 0)"
_SCORE = f"""least({_FILL('company_name')} + {_FILL('role_title')} + {_FILL('location_raw')} + {_FILL('industry')} + CASE WHEN {_SKILLS} THEN 10 ELSE 0 END
 + CASE WHEN {_AGE} <= 30 THEN 25 WHEN {_AGE} <= 90 THEN 15 WHEN {_AGE} <= 180 THEN 8 ELSE 0 END + CASE WHEN {_LEN} >= 400 THEN 15 WHEN {_LEN} >= 200 THEN 10 WHEN {_LEN} >= 80 THEN 5 ELSE 0 END + {_FILL('salary_range')}, 100)"""


@query(f"SELECT job_id, {_SCORE} AS score FROM jobs")
def quality_scores(spark, d):
    return jobs_of(spark, d).select("job_id", stats.quality_score(now()).alias("score"))


@query(f"SELECT count(*) FILTER (WHERE s < 50) AS low, count(*) FILTER (WHERE s >= 50 AND s < 80) AS fair, count(*) FILTER (WHERE s >= 80) AS good, sum(s) AS total_score FROM (SELECT {_SCORE} AS s FROM jobs)")
def quality_histogram(spark, d):
    return stats.quality_histogram(jobs_of(spark, d), now())


@query("SELECT len(embedding) AS dims, count(*) AS vectors FROM jobs WHERE embedding IS NOT NULL GROUP BY 1")
def vector_sizes(spark, d):
    return stats.vector_sizes(jobs_of(spark, d))


@query("SELECT count(*) AS groups, coalesce(sum(c - 1), 0) AS surplus FROM (SELECT count(*) AS c FROM feedback GROUP BY user_id, job_id HAVING count(*) > 1)")
def repeated_reactions(spark, d):
    return stats.repeated_groups(load(spark, d, "feedback"), "user_id", "job_id")


@query("SELECT content_hash, count(*) AS c FROM jobs GROUP BY 1 HAVING count(*) > 1 ORDER BY c DESC, content_hash NULLS FIRST LIMIT 10")
def worst_hash_groups(spark, d):
    return stats.worst_groups(jobs_of(spark, d), "content_hash")


@query("""SELECT 'unknown_job' AS "check", count(*) AS rows FROM feedback f WHERE NOT EXISTS (SELECT 1 FROM jobs j WHERE j.job_id = f.job_id)
 UNION ALL SELECT 'unknown_user', count(*) FROM feedback f WHERE NOT EXISTS (SELECT 1 FROM user_profiles u WHERE u.user_id = f.user_id)""")
def orphan_feedback(spark, d):
    return stats.orphans(load(spark, d, "feedback"), jobs_of(spark, d), load(spark, d, "user_profiles"))


@query(f"""SELECT gap, CAST(rank AS INTEGER) AS rank, job_id FROM (SELECT *, row_number() OVER (PARTITION BY gap ORDER BY job_id) AS rank FROM (
 SELECT 'no_text' AS gap, job_id FROM jobs WHERE NOT {_TEXT} UNION ALL SELECT 'no_skills', job_id FROM jobs WHERE NOT {_SKILLS} UNION ALL SELECT 'no_url', job_id FROM jobs WHERE primary_url IS NULL)) WHERE rank <= 10""")
def gap_samples(spark, d):
    gaps = {"no_text": ~predicates.usable_text(), "no_skills": ~predicates.has_entries(), "no_url": F.col("primary_url").isNull()}
    return stats.gap_samples(jobs_of(spark, d), gaps, "job_id")


@query("""WITH x AS (SELECT DISTINCT company_name, role_title FROM jobs WHERE role_title IS NOT NULL), n AS (SELECT *, row_number() OVER (PARTITION BY company_name ORDER BY role_title) AS rn, count(*) OVER (PARTITION BY company_name) AS c FROM x)
 SELECT company_name, string_agg(role_title, ', ' ORDER BY rn) AS items, any_value(c) - count(*) AS more FROM n WHERE rn <= 3 GROUP BY company_name""")
def company_titles(spark, d):
    return stats.named_groups(jobs_of(spark, d), "company_name", "role_title")


@query("SELECT job_id, last_seen_at FROM jobs WHERE status = 'active' AND (contains(lower(company_name), 'health') OR contains(lower(role_title), 'analyst') AND true) AND (contains(lower(company_name), 'analyst') OR contains(lower(role_title), 'analyst')) ORDER BY last_seen_at DESC NULLS LAST, job_id LIMIT 20 OFFSET 20")
def browse_page(spark, d):
    return stats.browse(jobs_of(spark, d), predicates.search(status="active", text="Analyst"), 2, 20).select("job_id", "last_seen_at")


@query(f"SELECT job_id, first_seen_at FROM jobs WHERE {_ACT} AND embedding IS NULL AND {_TEXT} AND {_SKILLS} ORDER BY first_seen_at, job_id LIMIT 3000")
def vector_queue(spark, d):
    return stats.queue(jobs_of(spark, d), predicates.needs_vector(), [F.col("first_seen_at"), F.col("job_id")]).select("job_id", "first_seen_at")


# ---- duplicates


_PRIORITY = sql_case("string_split(j.source_repo, ':')[1]", T.SOURCE_PRIORITY, "0")


@query(f"""WITH c AS ({SQL['canonical_urls']}), r AS (SELECT j.job_id, c.url, row_number() OVER (PARTITION BY c.url ORDER BY -({_PRIORITY}), CASE WHEN {_TEXT} THEN 0 ELSE 1 END, CASE WHEN {_SKILLS} THEN 0 ELSE 1 END, CASE WHEN embedding IS NULL THEN 1 ELSE 0 END, j.job_id) AS k FROM jobs j JOIN c ON c.job_id = j.job_id WHERE {_ACT} AND c.url <> '')
 SELECT j.job_id, CASE WHEN r.k > 1 THEN 'duplicate' ELSE j.status END AS status FROM jobs j LEFT JOIN r ON r.job_id = j.job_id""")
def url_duplicates(spark, d):
    """Status after the best listing of every canonical address was kept."""
    return dedup.mark_url_duplicates(jobs_of(spark, d)).select("job_id", "status")


@query()
def merged_across_feeds(spark, d):
    rows = jobs_of(spark, d).withColumn("seq", F.struct("first_seen_at", "job_id"))
    return dedup.merge_across_feeds(rows)


@query(f"""WITH r AS (SELECT *, sha256(concat_ws('|', {sql_name('company_name')}, {sql_name('role_title')})) AS new_id FROM jobs)
 SELECT new_id, arg_min(job_id, (first_seen_at, job_id)) AS survivor, min(first_seen_at) AS first_seen_at, max(last_seen_at) AS last_seen_at, coalesce(list_sort(list_distinct(list_filter(flatten(list(coalesce(sources, []))), lambda s: s IS NOT NULL))), []) AS sources,
 CASE WHEN bool_or(coalesce(status = 'active', false)) THEN 'active' ELSE 'inactive' END AS status, count(*) AS merged FROM r GROUP BY new_id""")
def rekeyed(spark, d):
    new_id = F.sha2(F.concat_ws("|", N.name_key(F.col("company_name")), N.name_key(F.col("role_title"))), 256)
    return dedup.rekey(jobs_of(spark, d), new_id)[0]


@query(f"""WITH m AS (SELECT job_id, sha256(concat_ws('|', {sql_name('company_name')}, {sql_name('role_title')})) AS new_id FROM jobs), r AS (SELECT f.user_id, coalesce(m.new_id, f.job_id) AS job_id, recorded_at, feedback_id, reaction FROM feedback f LEFT JOIN m ON f.job_id = m.job_id)
 SELECT user_id, job_id, recorded_at, feedback_id, reaction FROM (SELECT *, row_number() OVER (PARTITION BY user_id, job_id ORDER BY recorded_at, feedback_id, reaction) AS rn FROM r) WHERE rn = 1""")
def remapped_feedback(spark, d):
    new_id = F.sha2(F.concat_ws("|", N.name_key(F.col("company_name")), N.name_key(F.col("role_title"))), 256)
    return dedup.remap_feedback(load(spark, d, "feedback"), dedup.rekey(jobs_of(spark, d), new_id)[1])


@query("SELECT user_id, job_id, recorded_at, feedback_id, reaction FROM (SELECT *, row_number() OVER (PARTITION BY user_id, job_id ORDER BY recorded_at, feedback_id, reaction) AS rn FROM feedback) WHERE rn = 1")
def first_reactions(spark, d):
    return dedup.first_reactions(load(spark, d, "feedback"))


# ---- merge: the snapshot is the table without ids that begin with 0 to 3, the delta what begins with 0 to 7, partly changed: together the whole table

_OLD = "SELECT * FROM jobs WHERE substr(job_id, 1, 1) NOT IN ('0', '1', '2', '3')"
_NEW = f"""SELECT * REPLACE (CASE WHEN substr(job_id, 2, 1) < '8' THEN content_hash ELSE sha256(job_id) END AS content_hash, TIMESTAMP '{NOW}' AS last_seen_at, ['extra'] AS sources, 'active' AS status,
 CASE WHEN substr(job_id, 3, 1) < '8' THEN job_description END AS job_description) FROM jobs WHERE substr(job_id, 1, 1) BETWEEN '0' AND '7'"""


def _old_new(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    j, first = jobs_of(spark, d), F.substring("job_id", 1, 1)
    new = j.where(first.between("0", "7")).withColumns({
        "content_hash": F.when(F.substring("job_id", 2, 1) < "8", F.col("content_hash")).otherwise(F.sha2("job_id", 256)),
        "last_seen_at": now(),
        "sources": F.array(F.lit("extra")),
        "status": F.lit("active"),
        "job_description": F.when(F.substring("job_id", 3, 1) < "8", F.col("job_description")),
    })
    return j.where(~first.isin("0", "1", "2", "3")), new


_UNION = "list_sort(list_distinct(list_filter(list_concat(coalesce(o.sources, []), n.sources), lambda x: x IS NOT NULL)))"


@query(f"""WITH o AS ({_OLD}), n AS ({_NEW}) SELECT coalesce(o.job_id, n.job_id) AS job_id,
 CASE WHEN n.job_id IS NULL THEN 'kept' WHEN o.job_id IS NULL THEN 'inserted' WHEN o.content_hash IS DISTINCT FROM n.content_hash THEN 'updated' ELSE 'unchanged' END AS action,
 CASE WHEN n.job_id IS NULL THEN o.status ELSE n.status END AS status, CASE WHEN n.job_id IS NULL THEN o.last_seen_at ELSE n.last_seen_at END AS last_seen_at,
 CASE WHEN n.job_id IS NULL THEN o.job_description WHEN o.job_id IS NULL THEN n.job_description ELSE coalesce(n.job_description, o.job_description) END AS job_description,
 CASE WHEN n.job_id IS NULL THEN o.sources WHEN o.job_id IS NULL THEN n.sources ELSE {_UNION} END AS sources,
 CASE WHEN n.job_id IS NULL THEN o.embedded_at WHEN o.job_id IS NULL THEN n.embedded_at WHEN o.content_hash IS DISTINCT FROM n.content_hash THEN NULL ELSE o.embedded_at END AS embedded_at,
 coalesce(o.company_name, n.company_name) AS company_name FROM o FULL OUTER JOIN n ON o.job_id = n.job_id""")
def upsert(spark, d):
    return merge.merge(*_old_new(spark, d), "job_id", merge.JOB_POLICIES).select("job_id", "action", "status", "last_seen_at", "job_description", "sources", "embedded_at", "company_name")


@query(f"""WITH o AS ({_OLD}), n AS ({_NEW}) SELECT CASE WHEN n.job_id IS NULL THEN 'kept' WHEN o.job_id IS NULL THEN 'inserted' WHEN o.content_hash IS DISTINCT FROM n.content_hash THEN 'updated' ELSE 'unchanged' END AS action, count(*) AS rows FROM o FULL OUTER JOIN n ON o.job_id = n.job_id GROUP BY 1""")
def upsert_counts(spark, d):
    return merge.merge(*_old_new(spark, d), "job_id", merge.JOB_POLICIES).groupBy("action").agg(F.count("*").alias("rows"))


_IDENT = lambda c: rf"lower(trim(regexp_replace({c}, '[\s\p{{Z}}]+', ' ', 'g')))"


@query(f"""WITH o AS ({_OLD}), n AS ({_NEW}), f AS (SELECT {_IDENT('company_name')} AS c, {_IDENT('role_title')} AS r, source_repo AS s, min(first_seen_at) AS m FROM o GROUP BY 1, 2, 3)
 SELECT n.job_id, least(n.first_seen_at, f.m) AS first_seen_at FROM n LEFT JOIN f ON f.c = {_IDENT('n.company_name')} AND f.r = {_IDENT('n.role_title')} AND f.s = n.source_repo""")
def carried_first_seen(spark, d):
    old, new = _old_new(spark, d)
    return merge.carry_first_seen(new, old).select("job_id", "first_seen_at")


@query(f"SELECT job_id, m AS first_seen_at, first_seen_at > m AS late FROM (SELECT *, min(first_seen_at) OVER (PARTITION BY {_IDENT('company_name')}, {_IDENT('role_title')}, source_repo) AS m FROM jobs)")
def first_seen_integrity(spark, d):
    return merge.backfill_first_seen(jobs_of(spark, d)).select("job_id", "first_seen_at", "late")


@query(f"""WITH g AS (SELECT company_name, role_title, arg_min(primary_url, (-epoch_us(last_seen_at), job_id)) AS u FROM jobs WHERE status = 'inactive' AND primary_url IS NOT NULL AND last_seen_at >= TIMESTAMP '{NOW}' - INTERVAL 60 DAY GROUP BY 1, 2)
 SELECT j.job_id, CASE WHEN j.status = 'active' THEN coalesce(j.primary_url, g.u) ELSE j.primary_url END AS primary_url FROM jobs j LEFT JOIN g ON j.company_name = g.company_name AND j.role_title = g.role_title""")
def carried_urls(spark, d):
    return merge.carry_url(jobs_of(spark, d), now(), 60).select("job_id", "primary_url")


_SEEN = "SELECT DISTINCT source_repo, job_id FROM jobs WHERE substr(job_id, 1, 1) IN ('0','1','2','3','4','5','6','7','8') AND source_repo < 'h'"


@query(f"""WITH s AS ({_SEEN}), r AS (SELECT j.*, s.job_id IS NOT NULL AS seen, j.source_repo IN (SELECT source_repo FROM s) AS scanned FROM jobs j LEFT JOIN s ON j.source_repo = s.source_repo AND j.job_id = s.job_id),
 p AS (SELECT source_repo, count(*) FILTER (WHERE status = 'active') AS a, count(*) FILTER (WHERE status = 'active' AND NOT seen) AS g FROM r WHERE scanned GROUP BY 1)
 SELECT r.job_id, coalesce(p.a >= 20 AND p.g > 0.4 * p.a, false) AS tripped, CASE WHEN r.status = 'active' AND r.scanned AND NOT r.seen AND NOT coalesce(p.a >= 20 AND p.g > 0.4 * p.a, false) THEN 'inactive' ELSE r.status END AS status FROM r LEFT JOIN p ON r.source_repo = p.source_repo""")
def stale_marked(spark, d):
    j = jobs_of(spark, d)
    seen = j.where(F.substring("job_id", 1, 1).isin(*"012345678") & (F.col("source_repo") < "h")).select("source_repo", "job_id")
    return merge.mark_stale(j, seen, share=0.4).select("job_id", "tripped", "status")


_DEAD = "SELECT job_id, true AS dead, last_seen_at AS dead_confirmed_at FROM jobs WHERE status = 'inactive'"


@query(f"""WITH t AS ({_DEAD}), r AS (SELECT j.job_id, t.dead, t.dead_confirmed_at <= TIMESTAMP '{NOW}' - INTERVAL 90 DAY AS due FROM jobs j LEFT JOIN t ON j.job_id = t.job_id),
 a AS (SELECT job_id FROM r WHERE dead AND due ORDER BY job_id LIMIT 100) SELECT job_id, CASE WHEN dead IS NULL THEN 'fresh' WHEN job_id IN (SELECT job_id FROM a) THEN 'retried' ELSE 'skipped' END AS verdict FROM r""")
def tombstones(spark, d):
    j = jobs_of(spark, d)
    dead = j.where("status = 'inactive'").select("job_id", F.lit(True).alias("dead"), F.col("last_seen_at").alias("dead_confirmed_at"))
    return merge.split_tombstoned(j, dead, now()).select("job_id", "verdict")


@query(f"""SELECT job_id, CASE WHEN status = 'active' AND coalesce(substr(job_id, 1, 1) = '0' OR (substr(job_id, 1, 1) = '1' AND (embedded_at IS NULL OR embedded_at < TIMESTAMP '{NOW}' - INTERVAL 24 HOUR)), false) THEN 'inactive' ELSE status END AS status FROM jobs""")
def dead_reconciled(spark, d):
    first = F.substring("job_id", 1, 1)
    j = jobs_of(spark, d).withColumns({"permanent_404": first == "0", "dead": first == "1", "dead_confirmed_at": F.col("embedded_at")})
    return merge.reconcile_dead(j, now()).select("job_id", "status")


@query(f"""WITH g AS (SELECT job_id FROM jobs WHERE status = 'inactive' AND last_seen_at < TIMESTAMP '{NOW}' - INTERVAL 14 DAY)
 SELECT 'jobs' AS "table", count(*) AS rows FROM jobs WHERE job_id NOT IN (SELECT job_id FROM g) UNION ALL SELECT 'feedback', count(*) FROM feedback WHERE job_id NOT IN (SELECT job_id FROM g)""")
def purged(spark, d):
    left, reactions = merge.purge(jobs_of(spark, d), load(spark, d, "feedback"), now())
    return left.agg(F.count("*").alias("rows")).select(F.lit("jobs").alias("table"), "rows").union(reactions.agg(F.count("*").alias("rows")).select(F.lit("feedback"), "rows"))


@query(f"""SELECT 'vector_without_time' AS "check", count(*) FILTER (WHERE embedding IS NOT NULL AND embedded_at IS NULL) AS rows FROM jobs UNION ALL SELECT 'time_without_vector', count(*) FILTER (WHERE embedding IS NULL AND embedded_at IS NOT NULL) FROM jobs
 UNION ALL SELECT 'bad_hash', count(*) FILTER (WHERE content_hash IS NOT NULL AND NOT regexp_matches(content_hash, '^[0-9a-f]{{64}}$')) FROM jobs UNION ALL SELECT 'ends_before_start', count(*) FILTER (WHERE last_seen_at < first_seen_at) FROM jobs
 UNION ALL SELECT 'unknown_status', count(*) FILTER (WHERE status NOT IN ('active', 'inactive', 'duplicate')) FROM jobs UNION ALL SELECT 'embedded_not_matchable', count(*) FILTER (WHERE embedding IS NOT NULL AND NOT ({_TEXT} AND {_SKILLS})) FROM jobs""")
def violations(spark, d):
    return merge.violations(jobs_of(spark, d))


@query("""SELECT job_id, CASE WHEN coalesce(trim(industry, ''), '') = '' AND industry IS NULL THEN 'unknown industry' WHEN industry = '' THEN 'unknown industry' ELSE industry END AS industry FROM jobs""")
def gaps_filled(spark, d):
    j = jobs_of(spark, d)
    results = j.select("job_id", F.lit("unknown industry").alias("industry"))
    return merge.write_back(j, results, "job_id", ["industry"], overwrite=False).select("job_id", "industry")


# ---- reactions

_KNOWN = "SELECT * REPLACE (lower(trim(reaction)) AS reaction) FROM feedback WHERE lower(trim(reaction)) IN ('like', 'dislike', 'applied')"
_FIRST = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, job_id ORDER BY recorded_at, feedback_id, reaction) AS rn FROM ({_KNOWN})) WHERE rn = 1"


@query(f"""WITH a AS (SELECT f.user_id, f.reaction, f.recorded_at, f.feedback_id, j.company_name FROM ({_FIRST}) f JOIN jobs j ON f.job_id = j.job_id WHERE f.reaction IN ('like', 'dislike')),
 l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, reaction ORDER BY recorded_at DESC, feedback_id DESC) AS k FROM a) WHERE k <= 100)
 SELECT user_id, coalesce(list(company_name ORDER BY k DESC) FILTER (WHERE reaction = 'like'), []) AS liked_companies, coalesce(list(company_name ORDER BY k DESC) FILTER (WHERE reaction = 'dislike'), []) AS disliked_companies FROM l GROUP BY user_id""")
def company_lists(spark, d):
    return fold.company_lists(load(spark, d, "feedback"), jobs_of(spark, d))


_MIX = "list_transform(list_zip(a, v), lambda z: 0.7 * z[1] + 0.3 * z[2])"


@query(f"""WITH l AS (SELECT f.user_id, f.recorded_at, f.feedback_id, CAST(j.embedding AS DOUBLE[]) AS v FROM ({_FIRST}) f JOIN jobs j ON f.job_id = j.job_id WHERE f.reaction = 'like' AND len(j.embedding) = 64 AND len(list_filter(j.embedding, lambda x: x IS NULL OR isnan(x))) = 0),
 g AS (SELECT user_id, list(v ORDER BY recorded_at, feedback_id) AS vs, count(*) AS likes FROM l GROUP BY 1)
 SELECT user_id, likes, list_transform(list_reduce(vs, lambda a, v: list_transform({_MIX}, lambda x: x / (sqrt(list_dot_product({_MIX}, {_MIX})) + 1e-9))), lambda x: round(x, 6) + 0.0) AS affinity FROM g""")
def affinities(spark, d):
    folded = fold.affinity(load(spark, d, "feedback"), jobs_of(spark, d), 64)
    return folded.select("user_id", "likes", F.transform("affinity", lambda x: F.round(x, 6) + F.lit(0.0)).alias("affinity"))


# ---- gates

_METRICS = f"""SELECT *, CASE WHEN active > 0 THEN round(active_embedded / active, 6) ELSE 0 END AS embedded_cov_of_active, CASE WHEN embeddable > 0 THEN round((embeddable - embeddable_backlog) / embeddable, 6) ELSE 1 END AS embedded_cov_of_embeddable,
 CASE WHEN active > 0 THEN round(with_industry / active, 6) ELSE 0 END AS industry_cov, CASE WHEN active > 0 THEN round(with_seniority / active, 6) ELSE 0 END AS seniority_cov, CASE WHEN active > 0 THEN round(with_skills / active, 6) ELSE 0 END AS skills_cov FROM (
 SELECT count(*) FILTER (WHERE {_ACT}) AS active, count(*) FILTER (WHERE {_ACT} AND embedding IS NOT NULL) AS active_embedded, count(*) FILTER (WHERE {_ACT} AND embedding IS NOT NULL AND {_TEXT} AND {_SKILLS}) AS matchable,
 count(*) FILTER (WHERE {_ACT} AND {_TEXT} AND {_SKILLS}) AS embeddable, count(*) FILTER (WHERE {_ACT} AND embedding IS NULL AND {_TEXT} AND {_SKILLS}) AS embeddable_backlog, count(*) FILTER (WHERE (embedding IS NOT NULL) <> (embedded_at IS NOT NULL)) AS vector_violations,
 count(*) FILTER (WHERE {_ACT} AND job_description IS NOT NULL AND NOT {_TEXT}) AS thin_text, count(*) FILTER (WHERE {_ACT} AND coalesce(trim(industry) <> '', false)) AS with_industry,
 count(*) FILTER (WHERE {_ACT} AND coalesce(trim(seniority_level) <> '', false)) AS with_seniority, count(*) FILTER (WHERE {_ACT} AND {_SKILLS}) AS with_skills FROM jobs)"""


@query(_METRICS)
def health_metrics(spark, d):
    return gates.health_metrics(jobs_of(spark, d))


@query(f"""WITH m AS ({_METRICS}) SELECT * FROM (SELECT 'embedded_cov_of_embeddable' AS metric, 'at_least' AS rule, CAST(embedded_cov_of_embeddable AS DOUBLE) AS value, CAST(0.97 AS DOUBLE) AS bound FROM m UNION ALL SELECT 'embeddable_backlog', 'at_most', embeddable_backlog, 300 FROM m
 UNION ALL SELECT 'vector_violations', 'at_most', vector_violations, 0 FROM m UNION ALL SELECT 'active', 'at_least', active, 1 FROM m UNION ALL SELECT 'matchable', 'at_least', matchable, 1 FROM m) WHERE (rule = 'at_least' AND value < bound) OR (rule = 'at_most' AND value > bound)""")
def gate_failures(spark, d):
    return gates.gate_failures(gates.health_metrics(jobs_of(spark, d)))


@query("SELECT (SELECT count(DISTINCT job_id) FROM synced_hashes) AS remote, (SELECT count(*) FROM jobs WHERE status = 'active') AS local, round(abs((SELECT count(*) FROM jobs WHERE status = 'active') - (SELECT count(DISTINCT job_id) FROM synced_hashes)) / (SELECT greatest(count(*), 1) FROM jobs WHERE status = 'active'), 6) AS drift, abs((SELECT count(*) FROM jobs WHERE status = 'active') - (SELECT count(DISTINCT job_id) FROM synced_hashes)) / (SELECT greatest(count(*), 1) FROM jobs WHERE status = 'active') <= 0.05 AS within")
def reconciled_counts(spark, d):
    return gates.reconcile(jobs_of(spark, d).where(predicates.active()), load(spark, d, "synced_hashes").select("job_id").distinct())


@query("SELECT list_sort(list(DISTINCT embedding_model)) AS models, count(DISTINCT embedding_model) <= 1 AS consistent FROM jobs WHERE embedding_model IS NOT NULL")
def embedding_models(spark, d):
    return gates.single_model(jobs_of(spark, d))


# ---- shipping

_LEDGER = "SELECT job_id, arg_max(content_hash, (synced_at, content_hash)) AS content_hash, max(synced_at) AS synced_at FROM synced_hashes GROUP BY 1"


@query(f"WITH l AS ({_LEDGER}) SELECT j.job_id, j.content_hash FROM jobs j LEFT JOIN l ON j.job_id = l.job_id WHERE l.job_id IS NULL OR j.content_hash IS DISTINCT FROM l.content_hash")
def to_ship(spark, d):
    return sync.to_ship(jobs_of(spark, d), load(spark, d, "synced_hashes")).select("job_id", "content_hash")


@query(f"WITH l AS ({_LEDGER}) SELECT max(j.embedded_at) AS watermark FROM jobs j LEFT JOIN l ON j.job_id = l.job_id WHERE l.job_id IS NULL OR j.content_hash IS DISTINCT FROM l.content_hash")
def watermark(spark, d):
    return sync.next_watermark(sync.to_ship(jobs_of(spark, d), load(spark, d, "synced_hashes")))


@query(_LEDGER)
def ledger_latest(spark, d):
    return sync.latest_ledger(load(spark, d, "synced_hashes"))


@query("SELECT job_id, CAST(floor((row_number() OVER (ORDER BY job_id) - 1) / 500) AS BIGINT) AS chunk FROM jobs")
def ship_chunks(spark, d):
    return sync.numbered_chunks(jobs_of(spark, d).select("job_id"), ["job_id"], 500)


@query()
def ship_documents(spark, d):
    return sync.documents(jobs_of(spark, d))


# ---- matching

_V = "(SELECT embedding FROM jobs WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isnan(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0 ORDER BY job_id LIMIT 1)"
_D = "CAST((SELECT v FROM q) AS DOUBLE[])"
_COS = f"list_dot_product(CAST(embedding AS DOUBLE[]), {_D}) / (sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) * sqrt(list_dot_product({_D}, {_D})))"
_OKV = "embedding IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0"


def _usable_vector() -> Column:
    return (F.size("embedding") == 64) & F.forall("embedding", lambda x: ~F.isnan(x)) & F.exists("embedding", lambda x: x != 0)


def query_vector(spark: SparkSession, d: str) -> list[float] | None:
    """The vector asked with: that of the usable listing with the smallest id."""
    row = jobs_of(spark, d).where(_usable_vector()).orderBy("job_id").select("embedding").first()
    return [float(x) for x in row[0]] if row else None


def query_profile(spark: SparkSession, d: str) -> dict:
    row = load(spark, d, "user_profiles").orderBy("user_id").first()
    return row.asDict() if row else {"user_id": ""}


@query(f"WITH q AS (SELECT {_V} AS v) SELECT job_id, round(1 - c, 6) AS distance FROM (SELECT job_id, {_COS} AS c FROM jobs WHERE {_ACT} AND {_OKV}) ORDER BY 1 - c, job_id LIMIT 120")
def nearest_to_one(spark, d):
    return match.candidates(jobs_of(spark, d), query_vector(spark, d), 120).select("job_id", F.round("distance", 6).alias("distance"))


_LOW = lambda c: f"list_distinct(list_transform(list_filter(coalesce({c}, []), lambda s: s IS NOT NULL), lambda s: lower(s)))"
_TK = lambda c: f"list_distinct(list_transform(list_filter(coalesce({c}, []), lambda s: s IS NOT NULL), lambda s: {_TOK}))"
_B = lambda c: f"list_filter(list_transform(string_split(replace(coalesce({c}, ''), ',', ';'), ';'), lambda p: {_BUCKET}), lambda p: p <> '')"
_PB = f"list_transform(u.preferred_locations, lambda p: {_BUCKET})"
_SIGNALS = f"""CASE WHEN len({_LOW('j.required_skills')}) > 0 AND len({_LOW('u.skills')}) > 0 THEN 0.85 * len(list_intersect({_LOW('j.required_skills')}, {_LOW('u.skills')})) / len({_LOW('j.required_skills')}) + 0.15 * len(list_intersect({_LOW('j.required_skills')}, {_LOW('u.skills')})) / len({_LOW('u.skills')}) ELSE 0 END AS skills,
 CASE WHEN list_contains({_LOW('u.preferred_industries')}, lower(j.industry)) THEN 1.0 ELSE 0.3 END AS industry, CASE WHEN u.preferred_company_size IS NULL OR u.preferred_company_size = 'any' THEN 1.0 WHEN j.company_size = u.preferred_company_size THEN 1.0 ELSE 0.4 END AS size,
 CASE WHEN len({_PB}) = 0 OR list_contains({_PB}, 'remote') OR list_contains({_B('j.location_raw')}, 'remote') OR len(list_intersect({_PB}, {_B('j.location_raw')})) > 0 THEN 1.0 ELSE 0.2 END AS location,
 coalesce(greatest(0.0, 1.0 - floor((epoch_us(TIMESTAMP '{NOW}') - epoch_us(j.first_seen_at)) / 86400000000) / 30), 0.0) AS recency,
 CASE WHEN list_contains({_LOW('u.liked_companies')}, lower(j.company_name)) THEN 1.0 WHEN list_contains({_LOW('u.disliked_companies')}, lower(j.company_name)) THEN 0.0 ELSE 0.5 END AS feedback"""
_USER = "SELECT * FROM user_profiles ORDER BY user_id LIMIT 1"


@query(f"""WITH u AS ({_USER}), s AS (SELECT j.job_id, {_SIGNALS} FROM jobs j CROSS JOIN u) SELECT job_id, round(skills, 6) AS skills, round(industry, 6) AS industry, round(size, 6) AS size, round(location, 6) AS location, round(recency, 6) AS recency, round(feedback, 6) AS feedback FROM s""")
def match_signals(spark, d):
    parts = match.signals(query_profile(spark, d), now(), None)
    return jobs_of(spark, d).select("job_id", *[F.round(c, 6).alias(n) for n, c in parts.items() if n != "title"])


_W = "0.25 * skills + 0.10 * industry + 0.05 * size + 0.10 * location + 0.10 * recency + 0.10 * feedback"


@query(f"""WITH u AS ({_USER}), q AS (SELECT {_V} AS v), c AS (SELECT *, {_COS} AS cos FROM jobs WHERE {_ACT} AND {_OKV}), k AS (SELECT * FROM c ORDER BY 1 - cos, job_id LIMIT 120),
 s AS (SELECT j.job_id, 1 - j.cos AS distance, least(greatest(list_dot_product(CAST(j.embedding AS DOUBLE[]), {_D}) / (sqrt(list_dot_product(CAST(j.embedding AS DOUBLE[]), CAST(j.embedding AS DOUBLE[]))) * sqrt(list_dot_product({_D}, {_D})) + 1e-9), 0), 1) AS title, {_SIGNALS}
 FROM k j CROSS JOIN u WHERE j.job_id NOT IN (SELECT job_id FROM feedback f WHERE f.user_id = u.user_id) AND (NOT coalesce(u.requires_sponsorship, false) OR coalesce(j.sponsorship, true)))
 SELECT job_id, round(0.30 * title + {_W}, 6) AS score FROM s ORDER BY score DESC, distance, job_id LIMIT 30""")
def match_topn(spark, d):
    """One request: the user with the smallest id asks with the usable listing with the smallest id. It is a row of a
    table, so nothing is read while the plan is made but the number of requests."""
    jobs = jobs_of(spark, d)
    first = jobs.where(_usable_vector()).agg(F.min_by("embedding", "job_id").alias("vector"))
    request = load(spark, d, "user_profiles").orderBy("user_id").limit(1).join(first.withColumn("_one", F.lit(1)), F.col("_one") == 1).drop("_one")
    return requests.match_many(jobs, load(spark, d, "feedback"), request, now()).select("job_id", "score")


@query(f"""WITH u AS ({_USER}), k AS (SELECT * FROM jobs WHERE {_ACT} ORDER BY last_seen_at DESC NULLS LAST, job_id LIMIT 120),
 s AS (SELECT j.job_id, {_SIGNALS} FROM k j CROSS JOIN u WHERE j.job_id NOT IN (SELECT job_id FROM feedback f WHERE f.user_id = u.user_id) AND (NOT coalesce(u.requires_sponsorship, false) OR coalesce(j.sponsorship, true)))
 SELECT job_id, round({_W}, 6) AS score FROM s ORDER BY score DESC, job_id LIMIT 30""")
def match_recent(spark, d):
    """Without a vector: the listings seen last are the candidates."""
    return match.match(jobs_of(spark, d), load(spark, d, "feedback"), query_profile(spark, d), now()).select("job_id", "score")


@query()
def match_explained(spark, d):
    """With experience: years and last use of skills, and a level."""
    profile = query_profile(spark, d)
    derived = {"years": {"python": 4, "sql": 6}, "used": {"python": "present", "sql": "2024-01-01"}, "seniority": "senior"}
    return match.match(jobs_of(spark, d), load(spark, d, "feedback"), profile, now(), query_vector(spark, d), derived=derived, explain=True).drop("matched_skills")


# ---- sources: listings rendered as raw feeds and parsed back

_CLEAN = r"trim(regexp_replace(regexp_replace({c}, '[^A-Za-z0-9 ]', ' ', 'g'), ' +', ' ', 'g'))"
_RENDER = f"SELECT DISTINCT {_CLEAN.format(c='company_name')} AS company_name, {_CLEAN.format(c='role_title')} AS role_title, source_repo FROM jobs"


def _rendered(spark: SparkSession, d: str) -> DataFrame:
    plain = lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "[^A-Za-z0-9 ]", " "), " +", " "))
    rows = jobs_of(spark, d).select(plain("company_name").alias("company_name"), plain("role_title").alias("role_title"), "source_repo").distinct()
    return rows.where("company_name <> '' and role_title <> ''")


_PARSED = f"SELECT job_id, min(company_name) AS company_name, min(role_title) AS role_title, count(*) > 0 AS found FROM (SELECT sha256(concat_ws('|', lower(trim(source_repo)), trim(lower(company_name)), lower(role_title))) AS job_id, lower(company_name) AS company_name, lower(role_title) AS role_title FROM ({_RENDER}) WHERE company_name <> '' AND role_title <> '') GROUP BY job_id"


def _shown(parsed: DataFrame) -> DataFrame:
    return parsed.select("job_id", F.lower("company_name").alias("company_name"), F.lower("role_title").alias("role_title"), F.lit(True).alias("found"))


@query(_PARSED)
def source_pipe_table(spark, d):
    lines = _rendered(spark, d).select("source_repo", F.concat(F.lit("| **["), "company_name", F.lit("](https://c.example)** | **["), "role_title", F.lit("](https://a.example/x)** | Oakturn | Remote | Jun 01 |")).alias("line"))
    return _shown(parsers.pipe_tables(lines.withColumns({"doc": F.lit("d"), "position": F.xxhash64("line")})))


@query(_PARSED)
def source_html_table(spark, d):
    """A page for every feed and beginning of a company's name, with the company's further rows as continuations."""
    row = F.row_number().over(Window.partitionBy("source_repo", "company_name").orderBy("role_title"))
    named = F.when(F.col("n") == 1, F.concat(F.lit("<strong><a href='https://c.example'>"), "company_name", F.lit("</a></strong>"))).otherwise("↳")
    tr = F.concat(F.lit("<tr><td>"), named, F.lit("</td><td>"), "role_title", F.lit("</td><td>Oakturn<br>Quillby</td><td><a href='https://a.example/1'>Apply</a></td><td>3d</td></tr>"))
    rows = _rendered(spark, d).withColumn("n", row).withColumn("tr", tr)
    pages = rows.groupBy("source_repo", F.substring("company_name", 1, 1).alias("page")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("company_name", "n", "tr"))), lambda x: x["tr"]), "\n").alias("trs"))
    pages = pages.select("source_repo", F.concat_ws("/", "source_repo", "page").alias("doc"), F.concat(F.lit("<table><thead><tr><th>Company</th></tr></thead><tbody>"), "trs", F.lit("</tbody></table>")).alias("body"))
    return _shown(parsers.html_tables(pages))


@query(_PARSED)
def source_board_json(spark, d):
    j = F.struct(F.struct(F.lit("Oakturn").alias("name")).alias("location"), F.col("role_title").alias("title"), F.lit("https://b.example/1").alias("absolute_url"))
    boards = _rendered(spark, d).groupBy("source_repo", "company_name").agg(F.collect_list(j).alias("jobs"))
    boards = boards.select("source_repo", F.col("company_name").alias("doc"), F.to_json(F.struct(F.col("company_name").alias("name"), "jobs")).alias("body"))
    return _shown(parsers.board_listings(boards, most=1_000_000))


_TICK = "time_bucket(INTERVAL 1 HOUR, ts)"


@query(f"SELECT {_TICK} AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def events_hourly(spark, d):
    e = load(spark, d, "events")
    return e.groupBy(F.window(F.col("ts"), "1 hour"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


@query("""WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS b FROM events), s AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM g)
 SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k""")
def event_sessions(spark, d):
    e = load(spark, d, "events")
    return e.groupBy(F.session_window("ts", "30 minutes"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("session_window.start").alias("start"), "n")


# ---- seams


@query(r"""SELECT j.job_id, CASE WHEN coalesce(j.primary_url, '') = '' THEN 'skip_no_url' WHEN j.status = 'duplicate' THEN 'closed_at_source' WHEN length(regexp_replace(j.job_description, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')) >= 200 THEN 'success' ELSE 'failed' END AS outcome FROM jobs j""")
def fetch_outcomes(spark, d):
    j = jobs_of(spark, d)
    bodies = j.select("job_id", F.lit(None).cast("string").alias("api_text"), F.col("job_description").alias("page_text"), (F.col("status") == "duplicate").alias("closed"))
    return enrich.fetch_outcomes(j, bodies).select("job_id", "outcome")


@query()
def hashed_vectors(spark, d):
    """Vectors of all descriptions by the stand-in model."""
    return enrich.embed(jobs_of(spark, d), "job_id", "job_description").select("job_id", F.size("embedding").alias("dims"), "error")


@query("SELECT job_id, CASE WHEN coalesce(primary_url, '') <> '' THEN primary_url WHEN coalesce(location_raw, '') <> '' THEN location_raw END AS target FROM jobs")
def fetch_targets(spark, d):
    return jobs_of(spark, d).select("job_id", enrich.best_target(F.col("primary_url"), F.when(F.coalesce("primary_url", F.lit("")) == "", F.col("location_raw"))).alias("target"))
