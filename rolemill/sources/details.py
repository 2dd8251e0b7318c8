"""Further raw feeds: detail pages, list endpoints of several shapes, company directories, boards in markdown.

As in ``parsers``: column expressions alone, a body that can't be parsed gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rolemill.functions import tables as T
from rolemill.functions.normalize import canonical_skills, first_of, lookup, strip
from rolemill.functions.text import bare_url, strip_markup, text_skills
from rolemill.sources.parsers import embedded_json, first_by_id, with_identity

_NAMES = "array<string>"


def funding_stage(text: Column) -> Column:
    """The stage that a text names first; longer names go before their beginnings."""
    names = sorted(T.FUNDING_STAGES, key=lambda s: (-len(s), s))
    return lookup(F.lower(F.regexp_extract(text, r"(?i)\b(" + "|".join(names) + r")\b", 1)), T.FUNDING_STAGES, F.lit(None).cast("string"))


def company_cell(c: Column) -> Column:
    """A table cell's company: of a markdown link its text, without markup, as it is written otherwise."""
    return strip_markup(F.regexp_replace(c, r"\[([^\]]*)\]\([^)]*\)", "$1"))


def tri_state(yes: Column, no: Column, tags: Column) -> Column:
    """Flags first (yes before no), then tags; null where neither tells."""
    t = F.coalesce(tags, F.array().cast(_NAMES))
    return F.when(F.coalesce(yes, F.lit(False)), True).when(F.coalesce(no, F.lit(False)), False).when(F.array_contains(t, "No H1B"), False).when(F.arrays_overlap(t, F.array(F.lit("H1B Sponsor"), F.lit("Visa Sponsor"))), True)


_DETAIL = (
    "struct<props:struct<pageProps:struct<dataSource:struct<jobResult:struct<jdCoreSkillV2:array<struct<skill:string>>,jdCoreSkills:array<struct<skill:string>>,skillSummaries:array<string>,"
    "jobSummary:string,coreResponsibilities:array<string>,isH1bSponsor:boolean,isCitizenOnly:boolean,recommendationTags:array<string>,salaryDesc:string,jobSeniority:string,benefitsSummaries:array<string>,workModel:string>,"
    "companyResult:struct<industries:array<string>>>>>>"
)


def detail_pages(pages: DataFrame, doc: str = "doc", body: str = "body") -> DataFrame:
    """One row per detail page: skills (of the newer list, else the older one, else named in the texts), text, lists, industry,
    level, salary, work model and sponsorship."""
    d = F.from_json(embedded_json(body), _DETAIL)["props"]["pageProps"]["dataSource"]
    rows = pages.select(doc, d.alias("d")).where(F.col("d.jobResult").isNotNull())
    j = lambda c: F.col(f"d.jobResult.{c}")
    named = lambda c: F.filter(F.transform(F.coalesce(j(c), F.array().cast("array<struct<skill:string>>")), lambda s: s["skill"]), lambda s: F.coalesce(s, F.lit("")) != "")
    said = text_skills(F.concat_ws(" ", j("skillSummaries"), F.nullif(j("jobSummary"), F.lit(""))))
    skills = F.when(F.size(named("jdCoreSkillV2")) > 0, named("jdCoreSkillV2")).when(F.size(named("jdCoreSkills")) > 0, named("jdCoreSkills")).otherwise(said)
    clean = lambda c: F.transform(F.filter(F.coalesce(j(c), F.array().cast(_NAMES)), lambda s: s.isNotNull()), strip_markup)
    return rows.select(
        doc, canonical_skills(skills).alias("required_skills"), strip_markup(F.coalesce(j("jobSummary"), F.lit(""))).alias("job_description"), clean("coreResponsibilities").alias("responsibilities"), clean("skillSummaries").alias("qualifications"),
        F.coalesce(j("benefitsSummaries"), F.array().cast(_NAMES)).alias("benefits"), first_of(F.col("d.companyResult.industries"), T.INDUSTRY_CLASSES, "other").alias("industry"), F.coalesce(j("jobSeniority"), F.lit("")).alias("seniority_level"),
        F.coalesce(j("salaryDesc"), F.lit("")).alias("salary_range"), lookup(F.lower(j("workModel")), T.WORK_MODELS, F.lit(None).cast("string")).alias("work_model"), tri_state(j("isH1bSponsor"), j("isCitizenOnly"), j("recommendationTags")).alias("sponsorship"),
    )


def _first(x: Column, *names: str) -> Column:
    return F.coalesce(*[F.nullif(F.get_json_object(x, f"$.{n}"), F.lit("")) for n in names])


def startup_listings(pages: DataFrame, base: str, doc: str = "doc", body: str = "body", feed: str = "source_repo") -> DataFrame:
    """Listings of a JSON list whose objects come in several shapes; relative addresses are completed with ``base``.

    Every object is read by paths, as one field may be a text here and an object or a list there.
    """
    rows = pages.select(doc, feed, F.posexplode(F.from_json(body, _NAMES)).alias("position", "x"))
    x = F.col("x")
    place = _first(x, "location", "locations")
    url = _first(x, "apply_url", "url", "link")
    company = F.when(F.startswith(F.get_json_object(x, "$.startup"), F.lit("{")), F.get_json_object(x, "$.startup.name")).otherwise(_first(x, "company", "company_name"))
    out = rows.select(
        doc, "position", feed, strip(company).alias("company_name"), strip(_first(x, "title", "name", "role_title")).alias("role_title"),
        strip(F.coalesce(F.when(F.startswith(place, F.lit("[")), F.array_join(F.from_json(place, _NAMES), ", ")).otherwise(place), F.lit(""))).alias("location_raw"),
        F.when(url.isNull() | F.startswith(url, F.lit("http")), url).otherwise(F.concat(F.lit(base), url)).alias("primary_url"), _first(x, "posted_date", "created_at", "posted_at").alias("date_posted_raw"),
    )
    return first_by_id(with_identity(out.where("company_name <> '' and role_title <> ''"), feed), doc)


_TILE = r"""(?is)<a[^>]+href="(/jobs/\d+[^"]*)"[^>]*>.*?([A-Za-z][^<]{3,80})\s*</a>.*?at\s+<[^>]+>([^<]+)</[^>]+>"""


def tile_listings(pages: DataFrame, base: str, doc: str = "doc", body: str = "body", feed: str = "source_repo") -> DataFrame:
    """Listings of a rendered role page: a linked title followed by "at" and the company."""
    rows = pages.select(doc, feed, F.posexplode(F.regexp_extract_all(body, F.lit(f"({_TILE})"), 1)).alias("position", "x"))
    part = lambda k: strip(F.regexp_extract("x", _TILE, k))
    out = rows.select(doc, "position", feed, part(3).alias("company_name"), part(2).alias("role_title"), F.lit("").alias("location_raw"), F.concat(F.lit(base), part(1)).alias("primary_url"))
    return first_by_id(with_identity(out.where("company_name <> '' and role_title <> ''"), feed), doc)


_DIRECTORY = "struct<companies:array<struct<name:string,slug:string,batch:string,website:string>>,totalPages:int,nextPage:string>"


def company_directory(pages: DataFrame, page: str = "page", body: str = "body") -> DataFrame:
    """(page, position, name, slug, batch, website) of the pages of a directory, up to the first page that is missing or
    broken, or that says it is the last one."""
    d = pages.select(F.col(page).alias("page"), F.from_json(body, _DIRECTORY).alias("d"))
    order = Window.orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    heads = d.select("page", F.col("d.companies").isNotNull().alias("ok"), (F.coalesce(F.col("page") >= F.col("d.totalPages"), F.lit(False)) | (F.coalesce("d.nextPage", F.lit("")) == "")).alias("last"))
    # one narrow row a page; a directory has a few hundred of them
    kept = heads.withColumns({"n": F.row_number().over(Window.orderBy("page")), "ended": F.coalesce(F.bool_or(F.col("last") | ~F.col("ok")).over(order), F.lit(False))})
    kept = kept.where(F.col("ok") & ~F.col("ended") & (F.col("page") == F.col("n"))).select("page")
    return d.join(kept, "page").select("page", F.posexplode("d.companies").alias("position", "c")).select("page", "position", "c.*")


_BOARD_HEADING = r"\[###\s+([^\\\n\]]+?)\s+-\s+([^\\\n\]]+?)\\?\s*\n(?:\\?\s*\n)?([^\]]+?)\]\((https?://jobs\.ashbyhq\.com/[^)]+)\)"


def linked_headings(pages: DataFrame, doc: str = "doc", body: str = "body", feed: str = "source_repo") -> DataFrame:
    """Listings of boards whose headings are links: title - company, then a line about the job."""
    rows = pages.select(doc, feed, F.posexplode(F.regexp_extract_all(body, F.lit(f"({_BOARD_HEADING})"), 1)).alias("position", "x"))
    part = lambda k: strip(F.regexp_extract("x", _BOARD_HEADING, k))
    out = rows.select(doc, "position", feed, part(2).alias("company_name"), part(1).alias("role_title"), part(4).alias("primary_url"), funding_stage(part(3)).alias("stage"))
    return first_by_id(with_identity(out.where("company_name <> '' and role_title <> ''"), feed), doc)


def site_endpoint(url: Column, html: Column) -> Column:
    """(tenant, site) of a hosted career page: from the address of its data in the page, else after "recruiting" in its own."""
    cxs = r"(?i)/wday/cxs/([^/]+)/([^/]+)/jobs"
    own = r"/recruiting/([^/?#]+)/([^/?#]+)"
    pick = lambda k: F.coalesce(F.nullif(F.regexp_extract(html, cxs, k), F.lit("")), F.nullif(F.regexp_extract(bare_url(url), own, k), F.lit("")))
    return F.when(pick(1).isNotNull() & pick(2).isNotNull(), F.struct(pick(1).alias("tenant"), pick(2).alias("site")))


_SITE = "struct<title:string,externalPath:string,locationsText:string>"


def pick_posting(url: Column, payload: Column) -> Column:
    """Of the postings of a site the first whose path the address ends with or contains."""
    lists = [F.from_json(F.get_json_object(payload, f"$.{n}"), f"array<{_SITE}>") for n in ("jobPostings", "jobPostingsList", "jobs")]
    path = F.regexp_extract(bare_url(url), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*([^?#]*)", 1)
    some = F.coalesce(*[F.when(F.size(a) > 0, a) for a in lists])
    return F.get(F.filter(some, lambda p: (F.coalesce(p["externalPath"], F.lit("")) != "") & F.contains(path, p["externalPath"])), F.lit(0))


def pay_range(r: Column) -> Column:
    """One text of a range (currency, min, max, interval); null where both ends are missing."""
    end = lambda c: F.coalesce(r[c].cast("string"), F.lit("None"))
    whole = F.concat_ws(" ", F.coalesce(r["currency"], F.lit("")), F.concat_ws("-", end("min"), end("max")), F.coalesce(r["interval"], F.lit("")))
    return F.when(r["min"].isNotNull() | r["max"].isNotNull(), strip(F.regexp_replace(whole, r"\s+", " ")))


def pay_field(fields: Column) -> Column:
    """The value of the first field (name, values) whose name speaks of salary or compensation."""
    hit = F.get(F.filter(fields, lambda f: F.lower(f["name"]).rlike("salary|compensation")), F.lit(0))
    return F.array_join(F.filter(hit["values"], lambda v: F.coalesce(v, F.lit("")) != ""), ", ")


def result_class(url: Column) -> Column:
    """-1 left out, 1 an employer's own page, 2 an aggregator."""
    low = F.lower(url)
    some = lambda hosts: F.exists(F.array(*[F.lit(h) for h in hosts]), lambda h: F.contains(low, h))
    return F.when(some(T.SKIPPED_HOSTS), -1).when(some(T.RESULT_AGGREGATORS), 2).otherwise(1)


def best_result(results: DataFrame, key: str = "job_id", url: str = "url", position: str = "position") -> DataFrame:
    """(key, url, class): the first search result of the best class for every listing; those to be left out don't count."""
    rows = results.where(F.coalesce(url, F.lit("")) != "").withColumn("class", result_class(F.col(url))).where("class > 0")
    return rows.groupBy(key).agg(F.min(F.struct("class", position, url)).alias("b")).select(key, F.col(f"b.{url}").alias("url"), "b.class")


def lookup_all(names: DataFrame, registry: DataFrame, name: str = "company_name") -> DataFrame:
    """(name, slugs): a map from every system to the slug that it has for a company, found as ``registry_lookup`` does."""
    from rolemill.sources.parsers import registry_lookup

    systems = [r[0] for r in registry.select("system").distinct().orderBy("system").collect()]  # a handful of hosting systems
    found = None
    for s in systems:
        one = registry_lookup(names, registry.where(F.col("system") == s), name).select(name, F.lit(s).alias("system"), "slug")
        found = one if found is None else found.union(one)
    if found is None:
        return names.select(name).limit(0).withColumn("slugs", F.create_map().cast("map<string,string>"))
    return found.groupBy(name).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("system", "slug")))).alias("slugs"))


def known_slugs(slugs: DataFrame, registry: DataFrame) -> DataFrame:
    """(system, slug, known): whether a registry has a slug."""
    have = registry.select("system", "slug", F.lit(True).alias("_k")).distinct()
    return slugs.join(have, ["system", "slug"], "left").select("system", "slug", F.coalesce("_k", F.lit(False)).alias("known"))
