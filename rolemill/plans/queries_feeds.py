"""Queries of feeds and requests: listings are rendered as raw bodies, parsed back, and compared in all their columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolemill.functions import normalize as N
from rolemill.functions import text as X
from rolemill.operators import dedup, enrich, match, requests
from rolemill.plans.queries import _ACT, _CLEAN, _COS, _D, _OKV, _SIGNALS, _USER, _V, NOW, jobs_of, now, query, query_profile, query_vector
from rolemill.session import load
from rolemill.sources import details, parsers

# ---- what is rendered: names and places in plain letters, an address, a time and a text of its own for every listing

_R = f"""(SELECT {_CLEAN.format(c='company_name')} AS company_name, {_CLEAN.format(c='role_title')} AS role_title, coalesce({_CLEAN.format(c='location_raw')}, '') AS location_raw, source_repo, 'https://a.example/' || min(job_id) AS primary_url,
 min(first_seen_at) AS first_at, max(CASE WHEN status = 'active' THEN 'active' ELSE 'inactive' END) AS state FROM jobs GROUP BY ALL) WHERE company_name <> '' AND role_title <> ''"""
_ID = "sha256(concat_ws('|', lower(trim(source_repo)), trim(lower(company_name)), lower(role_title)))"


def _one(order: str = "primary_url", keep: str = "") -> str:
    """The first row of every identity, as parsers keep it."""
    return f"(SELECT * FROM (SELECT *, {_ID} AS job_id, row_number() OVER (PARTITION BY {_ID} ORDER BY {order}) AS rn FROM {_R} {keep}) WHERE rn = 1)"


def rendered(spark, d: str) -> DataFrame:
    plain = lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "[^A-Za-z0-9 ]", " "), " +", " "))
    rows = jobs_of(spark, d).select(plain("company_name").alias("company_name"), plain("role_title").alias("role_title"), F.coalesce(plain("location_raw"), F.lit("")).alias("location_raw"), "source_repo", "job_id", "first_seen_at", "status")
    rows = rows.groupBy("company_name", "role_title", "location_raw", "source_repo").agg(
        F.concat(F.lit("https://a.example/"), F.min("job_id")).alias("primary_url"), F.min("first_seen_at").alias("at"), F.max(F.when(F.col("status") == "active", "active").otherwise("inactive")).alias("state"))
    return rows.where("company_name <> '' and role_title <> ''")


def bodies(rows: DataFrame, item, wrap) -> DataFrame:
    """One document a feed and first letter of the address' key, its items in the order of addresses."""
    pages = rows.groupBy("source_repo").agg(F.array_sort(F.collect_list(F.struct("primary_url", item.alias("item")))).alias("items"))
    return pages.select("source_repo", F.col("source_repo").alias("doc"), wrap(F.transform("items", lambda x: x["item"])).alias("body"))


#: Boards of one company each: documents are in the order of their names.
_BOARD_ORDER = "source_repo || '/' || company_name, primary_url"
_COLS = "job_id, company_name, role_title, location_raw, primary_url"


@query(f"SELECT {_COLS}, 'remote' AS work_model, 'Jun 01' AS date_posted_raw FROM {_one()}")
def feed_pipe_rows(spark, d):
    c = F.col
    line = F.concat(F.lit("| **["), c("company_name"), F.lit("](https://c.example)** | **["), c("role_title"), F.lit("]("), c("primary_url"), F.lit(")** | "), c("location_raw"), F.lit(" | Remote | Jun 01 |"))
    lines = rendered(spark, d).select("source_repo", line.alias("line"), F.lit("d").alias("doc"), F.col("primary_url").alias("position"))
    return parsers.pipe_tables(lines).select("job_id", "company_name", "role_title", "location_raw", "primary_url", "work_model", "date_posted_raw")


@query(f"SELECT {_COLS}, '3d' AS date_posted_raw FROM {_one(keep=chr(32) + 'AND state = ' + repr('active'))}".replace("location_raw, primary_url", "nullif(location_raw, '') AS location_raw, primary_url"))
def feed_html_rows(spark, d):
    c = F.col
    lock = F.when(c("state") == "active", F.concat(F.lit("<a href='"), c("primary_url"), F.lit("'>Apply</a>"))).otherwise("🔒")
    tr = F.concat(F.lit("<tr><td><strong>"), c("company_name"), F.lit("</strong></td><td>"), c("role_title"), F.lit("</td><td>"), c("location_raw"), F.lit("</td><td>"), lock, F.lit("</td><td>3d</td></tr>"))
    pages = bodies(rendered(spark, d), tr, lambda a: F.concat(F.lit("<table><tbody>"), F.array_join(a, "\n"), F.lit("</tbody></table>")))
    return parsers.html_tables(pages).select("job_id", "company_name", "role_title", F.nullif("location_raw", F.lit("")).alias("location_raw"), "primary_url", "date_posted_raw")


@query(f"SELECT {_COLS}, date_trunc('milliseconds', first_at) AS posted_at FROM {_one()}")
def feed_next_rows(spark, d):
    c = F.col
    item = F.struct(F.struct(c("role_title").alias("jobTitle"), c("location_raw").alias("jobLocation"), F.unix_millis(c("at").cast("timestamp")).alias("publishTime"), c("primary_url").alias("applyLink")).alias("jobResult"), F.struct(c("company_name").alias("companyName")).alias("companyResult"))
    page = lambda a: F.concat(F.lit('<html><script id="__NEXT_DATA__" type="application/json">'), F.to_json(F.struct(F.struct(F.struct(a.alias("initialJobs")).alias("pageProps")).alias("props"))), F.lit("</script></html>"))
    return parsers.next_listings(bodies(rendered(spark, d), item, page)).select("job_id", "company_name", "role_title", "location_raw", "primary_url", F.col("posted_at").cast("timestamp_ntz").alias("posted_at"))


@query(f"SELECT job_id, company_name, role_title, location_raw, primary_url, strftime(first_at, '%Y-%m-%d') AS date_posted_raw FROM {_one()}")
def feed_startup_rows(spark, d):
    """A JSON list with objects of three shapes: company as an object, as a text, and a list of places."""
    c = F.col
    kind = F.pmod(F.xxhash64("primary_url"), F.lit(3))
    day = F.date_format("at", "yyyy-MM-dd")
    a = F.to_json(F.struct(c("role_title").alias("title"), F.struct(c("company_name").alias("name")).alias("startup"), c("location_raw").alias("location"), c("primary_url").alias("apply_url"), day.alias("posted_date")))
    b = F.to_json(F.struct(c("role_title").alias("name"), c("company_name").alias("company"), F.array("location_raw").alias("locations"), F.regexp_replace("primary_url", "^https://a.example", "").alias("url"), day.alias("created_at")))
    e = F.to_json(F.struct(c("role_title"), c("company_name"), c("location_raw").alias("location"), c("primary_url").alias("link"), day.alias("posted_at")))
    pages = bodies(rendered(spark, d), F.when(kind == 0, a).when(kind == 1, b).otherwise(e), lambda x: F.concat(F.lit("["), F.array_join(x, ","), F.lit("]")))
    return details.startup_listings(pages, "https://a.example").select("job_id", "company_name", "role_title", "location_raw", "primary_url", "date_posted_raw")


@query(f"SELECT job_id, company_name, role_title, primary_url, CASE WHEN state = 'active' THEN 'series_a' END AS stage FROM {_one()}".replace("primary_url, CASE", "replace(primary_url, 'https://a.example', 'https://jobs.ashbyhq.com') AS primary_url, CASE"))
def feed_heading_rows(spark, d):
    c = F.col
    item = F.concat(F.lit("[### "), c("role_title"), F.lit(" - "), c("company_name"), F.lit("\\\n\\\n• Full time "), F.when(c("state") == "active", "• Series A").otherwise("• Remote"), F.lit("]("), F.regexp_replace("primary_url", "^https://a.example", "https://jobs.ashbyhq.com"), F.lit(")"))
    return details.linked_headings(bodies(rendered(spark, d), item, lambda a: F.array_join(a, "\n\n"))).select("job_id", "company_name", "role_title", "primary_url", "stage")


@query(f"SELECT {_COLS} FROM {_one(_BOARD_ORDER)}")
def feed_posting_rows(spark, d):
    c = F.col
    item = F.struct(c("role_title").alias("text"), c("primary_url").alias("hostedUrl"), F.struct(c("location_raw").alias("location")).alias("categories"))
    rows = rendered(spark, d)
    boards = rows.groupBy("source_repo", "company_name").agg(F.array_sort(F.collect_list(F.struct("primary_url", item.alias("item")))).alias("items"))
    boards = boards.select("source_repo", "company_name", F.concat_ws("/", "source_repo", "company_name").alias("doc"), F.to_json(F.transform("items", lambda x: x["item"])).alias("body"))
    return parsers.posting_listings(boards, most=1_000_000).select("job_id", "company_name", "role_title", "location_raw", "primary_url")


@query(f"SELECT {_COLS} FROM {_one(_BOARD_ORDER)}")
def feed_flexible_rows(spark, d):
    """Jobs at the top of the document for one half of the feeds, below a board for the other."""
    c = F.col
    item = F.struct(c("role_title").alias("title"), c("primary_url").alias("jobUrl"), c("location_raw").alias("locationName"))
    boards = rendered(spark, d).groupBy("source_repo", "company_name").agg(F.array_sort(F.collect_list(F.struct("primary_url", item.alias("item")))).alias("items"))
    items = F.transform("items", lambda x: x["item"])
    body = F.when(F.pmod(F.xxhash64("source_repo"), F.lit(2)) == 0, F.to_json(F.struct(items.alias("jobs")))).otherwise(F.to_json(F.struct(F.struct(items.alias("jobs")).alias("jobBoard"))))
    out = parsers.flexible_listings(boards.select("source_repo", "company_name", F.concat_ws("/", "source_repo", "company_name").alias("doc"), body.alias("body")))
    return out.select("job_id", "company_name", "role_title", "location_raw", "primary_url")


@query(f"SELECT position, loc, lastmod FROM (SELECT row_number() OVER (PARTITION BY source_repo ORDER BY primary_url) - 1 AS position, primary_url AS loc, strftime(first_at, '%Y-%m-%d') AS lastmod FROM {_R})")
def feed_sitemap_rows(spark, d):
    item = F.concat(F.lit("<url><loc>"), "primary_url", F.lit("</loc><lastmod>"), F.date_format("at", "yyyy-MM-dd"), F.lit("</lastmod></url>"))
    pages = bodies(rendered(spark, d), item, lambda a: F.concat(F.lit("<urlset>"), F.array_join(a, ""), F.lit("</urlset>")))
    return parsers.sitemap_entries(pages).select("position", "loc", "lastmod")


@query(f"SELECT {_COLS} FROM {_one()}")
def feed_card_rows(spark, d):
    c = F.col
    item = F.concat(F.lit("<li class='card'><h3 class=\"base title\">"), c("role_title"), F.lit("</h3><h4 class=\"company\">"), c("company_name"), F.lit("</h4><span class=\"location\">"), c("location_raw"), F.lit("</span><a href=\""), c("primary_url"), F.lit("\">go</a></li>"))
    return parsers.card_listings(bodies(rendered(spark, d), item, lambda a: F.array_join(a, "\n"))).select("job_id", "company_name", "role_title", "location_raw", "primary_url")


@query("""SELECT job_id, CASE WHEN sponsorship THEN true WHEN status = 'inactive' THEN false WHEN list_contains(sources, 'linkedin') THEN false WHEN list_contains(sources, 'otta') THEN true END AS sponsorship, coalesce(salary_range, '') AS salary_range, coalesce(seniority_level, '') AS seniority_level,
 CASE WHEN status = 'active' THEN 'hybrid' WHEN status = 'inactive' THEN 'onsite' END AS work_model, CASE WHEN company_size = 'large' THEN 'fintech' WHEN company_size IS NOT NULL THEN 'other' END AS industry, CASE WHEN sponsorship THEN ['a benefit'] ELSE [] END AS benefits FROM jobs""")
def detail_pages(spark, d):
    c = F.col
    none = F.array().cast("array<string>")
    has = lambda s: F.array_contains(F.coalesce("sources", none), s)
    job = F.struct(
        F.when(c("sponsorship"), True).alias("isH1bSponsor"), F.when(c("status") == "inactive", True).alias("isCitizenOnly"), F.when(has("linkedin"), F.array(F.lit("No H1B"))).when(has("otta"), F.array(F.lit("x"), F.lit("Visa Sponsor"))).alias("recommendationTags"),
        c("salary_range").alias("salaryDesc"), c("seniority_level").alias("jobSeniority"), F.when(c("status") == "active", "Hybrid").when(c("status") == "inactive", "On Site").alias("workModel"), F.when(c("sponsorship"), F.array(F.lit("a benefit"))).alias("benefitsSummaries"),
    )
    company = F.struct(F.when(c("company_size") == "large", F.array(F.lit("Nothing"), F.lit(" Banking "))).when(c("company_size").isNotNull(), F.array(F.lit("Nothing"))).alias("industries"))
    data = F.to_json(F.struct(F.struct(F.struct(F.struct(job.alias("jobResult"), company.alias("companyResult")).alias("dataSource")).alias("pageProps")).alias("props")))
    pages = jobs_of(spark, d).select(c("job_id").alias("doc"), F.concat(F.lit('<script id="__NEXT_DATA__" type="application/json">'), data, F.lit("</script>")).alias("body"))
    return details.detail_pages(pages).select(c("doc").alias("job_id"), "sponsorship", "salary_range", "seniority_level", "work_model", "industry", "benefits")


@query("""SELECT job_id, arg_min(url, (class, position, url)) AS url, min(class) AS class FROM (SELECT job_id, feedback_id AS position, CASE reaction WHEN 'like' THEN 'https://www.linkedin.com/' || job_id WHEN 'dislike' THEN 'https://jobright.ai/' || job_id ELSE 'https://corp.example/' || job_id END AS url,
 CASE reaction WHEN 'like' THEN 2 WHEN 'dislike' THEN -1 ELSE 1 END AS class FROM feedback) WHERE class > 0 GROUP BY 1""")
def best_results(spark, d):
    host = F.when(F.col("reaction") == "like", "https://www.linkedin.com/").when(F.col("reaction") == "dislike", "https://jobright.ai/").otherwise("https://corp.example/")
    return details.best_result(load(spark, d, "feedback").select("job_id", F.col("feedback_id").alias("position"), F.concat(host, "job_id").alias("url")))


# ---- duplicates, documents, vectors: the values themselves

_CU = r"""CASE WHEN len(ordered) > 0 THEN b || '?' || array_to_string(ordered, '&') ELSE b END"""


@query()
def merged_feeds_shown(spark, d):
    """Every merged listing with the feeds it came from; an ordered fold, tested against a model."""
    rows = jobs_of(spark, d).withColumn("seq", F.struct("first_seen_at", "job_id"))
    return dedup.merge_across_feeds(rows).select("company_name", "role_title", "primary_url", "source_repo", "sources", "merged", "last_seen_at")


@query("""SELECT job_id, CASE WHEN sponsorship IS NULL THEN 'unknown' WHEN sponsorship THEN 'offered' ELSE 'not_offered' END AS sponsorship_status, strftime(first_seen_at, '%Y-%m-%dT%H:%M:%S.') || lpad(CAST(epoch_us(first_seen_at) % 1000000 AS VARCHAR), 6, '0') || 'Z' AS first_seen_at, content_hash, coalesce(len(embedding), -1) AS dims FROM jobs""")
def documents_shown(spark, d):
    """Documents as they are sent, read back from their JSON."""
    from rolemill.operators import sync

    docs = sync.documents(jobs_of(spark, d))
    path = lambda p: F.get_json_object("body", f"$.{p}")
    return docs.select("job_id", path("sponsorship_status").alias("sponsorship_status"), path("first_seen_at").alias("first_seen_at"), path("content_hash").alias("content_hash"), F.coalesce(F.size(F.from_json(path("embedding"), "array<string>")), F.lit(-1)).cast("bigint").alias("dims"))


# ---- requests

_ASK = f"(SELECT u.*, (SELECT embedding FROM jobs j WHERE {_OKV} AND j.job_id >= md5(u.user_id) ORDER BY job_id LIMIT 1) AS vector FROM (SELECT * FROM user_profiles ORDER BY user_id LIMIT 5) u)"


def asked(spark, d: str) -> DataFrame:
    """Five users, each asking with the vector of the listing that follows a hash of their key."""
    users = load(spark, d, "user_profiles").orderBy("user_id").limit(5)
    ok = (F.size("embedding") == 64) & F.forall("embedding", lambda x: ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("embedding", lambda x: x != 0)
    vectors = jobs_of(spark, d).where(ok).select("job_id", "embedding")
    near = vectors.join(F.broadcast(users.select("user_id", F.md5("user_id").alias("_h"))), F.col("job_id") >= F.col("_h"))
    first = near.groupBy("user_id").agg(F.min_by("embedding", "job_id").alias("vector"))
    return users.join(first, "user_id", "left")


_C2 = "list_dot_product(CAST(j.embedding AS DOUBLE[]), CAST(u.vector AS DOUBLE[]))"
_N2 = "sqrt(list_dot_product(CAST(j.embedding AS DOUBLE[]), CAST(j.embedding AS DOUBLE[]))) * sqrt(list_dot_product(CAST(u.vector AS DOUBLE[]), CAST(u.vector AS DOUBLE[])))"


@query(f"""WITH u AS {_ASK}, c AS (SELECT u.user_id, j.job_id, 1 - {_C2} / ({_N2}) AS distance, least(greatest({_C2} / ({_N2} + 1e-9), 0), 1) AS title FROM jobs j JOIN u ON true WHERE {_ACT} AND {_OKV.replace('embedding', 'j.embedding')}),
 k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY distance, job_id) AS k FROM c), s AS (SELECT k.user_id, k.job_id, k.distance, k.title, {_SIGNALS} FROM k JOIN u ON u.user_id = k.user_id JOIN jobs j ON j.job_id = k.job_id
 WHERE k.k <= 120 AND NOT EXISTS (SELECT 1 FROM feedback f WHERE f.user_id = k.user_id AND f.job_id = k.job_id) AND (NOT coalesce(u.requires_sponsorship, false) OR coalesce(j.sponsorship, true))),
 r AS (SELECT user_id, job_id, distance, round(0.30 * title + 0.25 * skills + 0.10 * industry + 0.05 * size + 0.10 * location + 0.10 * recency + 0.10 * feedback, 6) AS score FROM s)
 SELECT user_id, job_id, score, rank FROM (SELECT user_id, job_id, score, CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, distance, job_id) AS INTEGER) AS rank FROM r) WHERE rank <= 30""")
def match_many(spark, d):
    return requests.match_many(jobs_of(spark, d), load(spark, d, "feedback"), asked(spark, d), now())


@query("SELECT job_id, CASE WHEN contains(source_repo, 'Intern') THEN 'internship' ELSE 'full_time' END AS employment_type, coalesce(primary_url, '') AS apply_url, location_raw AS place, coalesce(industry, 'unknown') AS industry, coalesce(company_size, 'unknown') AS size_category FROM jobs")
def recommendations(spark, d):
    """Every listing in the shape in which a recommendation leaves."""
    found = jobs_of(spark, d).select("job_id", "company_name", "role_title", *[F.lit(0.5).alias(c) for c in ("title_similarity", "skills_overlap", "industry_match", "score")])
    i = F.col("item")
    return requests.recommendations(found, jobs_of(spark, d)).select("job_id", i["employment_type"].alias("employment_type"), i["apply_url"].alias("apply_url"), i["locations"][0]["display_name"].alias("place"), i["company"]["industry"].alias("industry"), i["company"]["size_category"].alias("size_category"))


@query("""WITH s AS (SELECT job_id, industry, list_distinct(list_transform(list_filter(coalesce(required_skills, []), lambda x: x IS NOT NULL), lambda x: lower(x))) AS r FROM jobs)
 SELECT job_id, CAST(round_even((0.25 * (CASE WHEN len(r) > 0 THEN 0.85 * len(list_intersect(r, ['python', 'sql'])) / len(r) + 0.15 * len(list_intersect(r, ['python', 'sql'])) / 2 ELSE 0 END) + 0.5 * (0.30 + 0.05 + 0.10 + 0.10) + 0.10 * (CASE WHEN coalesce(industry, '') <> '' THEN 1.0 ELSE 0.5 END) + 0.10 * 0.8) * 100, 0) AS INTEGER) AS score FROM s""")
def analysis_scores(spark, d):
    return jobs_of(spark, d).select("job_id", requests.analysis_score(F.array(F.lit("python"), F.lit("SQL")), F.col("required_skills"), F.col("industry")).alias("score"))
