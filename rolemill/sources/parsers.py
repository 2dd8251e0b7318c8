"""Raw feeds as rows: every parser takes a DataFrame with a body column and gives one row per listing.

All of them are column expressions (regular expressions, JSON and XML functions, explode, windows), so a landing folder of
any size is read in parallel and nothing is parsed on the driver. A body that can't be parsed gives no row. Where a body
repeats an id, the first row counts, by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rolemill.functions.normalize import content_hash, job_identity, squeeze, strip
from rolemill.functions.text import first_url, registry_key, strip_markup

CLOSED, CONTINUED = "🔒", "↳"
_BADGES = "[🎓🔥🛂🇺🇸]"


def _blank_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def with_identity(rows: DataFrame, feed: str = "source_repo") -> DataFrame:
    return rows.withColumns({"job_id": job_identity(F.col(feed), F.col("company_name"), F.col("role_title")), "content_hash": content_hash(F.col("company_name"), F.col("role_title"))})


def first_by_id(rows: DataFrame, doc: str = "doc", position: str = "position") -> DataFrame:
    w = Window.partitionBy("job_id").orderBy(doc, position)
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def html_tables(pages: DataFrame, doc: str = "doc", body: str = "body", feed: str = "source_repo") -> DataFrame:
    """Listings of HTML tables: company, role, place, link, age. Closed rows are dropped; a continuation mark repeats the company above."""
    bodies = F.regexp_extract_all(body, F.lit(r"(?is)<tbody[^>]*>(.*?)</tbody>"), 1)
    rows = pages.select(doc, feed, F.posexplode(F.flatten(F.transform(bodies, lambda b: F.regexp_extract_all(b, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), 1)))).alias("position", "tr"))
    cells = rows.withColumn("td", F.regexp_extract_all("tr", F.lit(r"(?is)<td[^>]*>(.*?)</td>"), 1)).where(F.size("td") >= 3)
    cell = lambda k: F.coalesce(F.get("td", F.lit(k)), F.lit(""))
    company = squeeze(F.regexp_replace(strip_markup(cell(0)), _BADGES, ""))
    upto = Window.partitionBy(doc).orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    named = cells.withColumn("_own", F.when(~F.startswith(company, F.lit(CONTINUED)), F.nullif(company, F.lit("")))).withColumn("company_name", F.last("_own", ignorenulls=True).over(upto))
    place = F.regexp_replace(F.regexp_replace(cell(2), r"(?is)<summary>.*?</summary>", ""), r"(?i)<br\s*/?>|</br>", ", ")
    shut = F.contains(cell(0), F.lit(CLOSED)) | F.contains(cell(3), F.lit(CLOSED))
    out = named.where(~shut).select(
        doc, "position", feed, "company_name", squeeze(F.regexp_replace(strip_markup(cell(1)), _BADGES, "")).alias("role_title"), squeeze(F.regexp_replace(strip_markup(place), r"(, )+$", "")).alias("location_raw"),
        first_url(cell(3)).alias("primary_url"), _blank_null(strip_markup(cell(4))).alias("date_posted_raw"),
    )
    return first_by_id(with_identity(out.where("company_name is not null and role_title <> ''"), feed), doc)


_PIPE = r"^\|\s*\*\*\[([^\]]+)\]\(([^)]*)\)\*\*\s*\|\s*\*\*\[([^\]]+)\]\(([^)]*)\)\*\*\s*\|\s*([^|]*?)\s*\|\s*([^|]*?)\s*\|\s*([^|]*?)\s*\|?\s*$"


def pipe_tables(lines: DataFrame, doc: str = "doc", position: str = "position", line: str = "line", feed: str = "source_repo") -> DataFrame:
    """Listings of markdown tables, one line each: company, title, place, work model, date."""
    hit = lines.where(F.col(line).rlike(_PIPE))
    part = lambda k: strip(F.regexp_extract(line, _PIPE, k))
    out = hit.select(doc, F.col(position).alias("position"), feed, part(1).alias("company_name"), part(3).alias("role_title"), part(4).alias("primary_url"), part(5).alias("location_raw"), F.lower(part(6)).alias("work_model"), part(7).alias("date_posted_raw"))
    return first_by_id(with_identity(out, feed), doc)


def snapshot_delta(old: DataFrame, new: DataFrame, most: int = 1000) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(added, removed, usable): the difference of two snapshots; a change beyond ``most`` rows on a side asks for a full read."""
    added, removed = new.exceptAll(old), old.exceptAll(new)
    sizes = added.agg(F.count("*").alias("added")).withColumn("k", F.lit(1)).join(removed.agg(F.count("*").alias("removed")).withColumn("k", F.lit(1)), "k")
    return added, removed, sizes.select("added", "removed", ((F.col("added") <= most) & (F.col("removed") <= most)).alias("usable"))


def diff_lines(diff: DataFrame, line: str = "line") -> DataFrame:
    """(sign, line) of the table rows that a diff adds or removes."""
    body = F.col(line)
    return diff.where(body.rlike(r"^[+-]\|")).select(F.substring(line, 1, 1).alias("sign"), F.expr(f"substring({line}, 2)").alias("line"))


def embedded_json(body: str | Column, kind: str = "next") -> Column:
    """The JSON that a page carries: in a data script, or escaped in an attribute."""
    c = F.col(body) if isinstance(body, str) else body
    if kind == "next":
        return _blank_null(F.regexp_extract(c, r"""(?s)<script id="__NEXT_DATA__"[^>]*>(.*?)</script>""", 1))
    raw = F.regexp_extract(c, r"""(?s)data-page="([^"]*)\"""", 1)
    for code, sign in (("&quot;", '"'), ("&#39;", "'"), ("&#039;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        raw = F.replace(raw, F.lit(code), F.lit(sign))
    return _blank_null(raw)


_NEXT = "struct<props:struct<pageProps:struct<initialJobs:array<struct<jobResult:struct<jobId:string,jobTitle:string,jobLocation:string,publishTime:bigint,applyLink:string,isH1bSponsor:boolean>,companyResult:struct<companyName:string,companySize:string>>>>>>"


def next_listings(pages: DataFrame, doc: str = "doc", body: str = "body", feed: str = "source_repo") -> DataFrame:
    """Listings of a page that carries its data as JSON."""
    rows = pages.select(doc, feed, F.posexplode(F.from_json(embedded_json(body), _NEXT)["props"]["pageProps"]["initialJobs"]).alias("position", "x"))
    j, c = F.col("x.jobResult"), F.col("x.companyResult")
    out = rows.select(doc, "position", feed, strip(c["companyName"]).alias("company_name"), strip(j["jobTitle"]).alias("role_title"), j["jobLocation"].alias("location_raw"), j["applyLink"].alias("primary_url"), F.timestamp_millis(j["publishTime"]).alias("posted_at"), c["companySize"].alias("company_size_raw"), F.when(j["isH1bSponsor"], True).alias("sponsorship"))
    return first_by_id(with_identity(out.where("company_name <> '' and role_title <> ''"), feed), doc)


_BOARD = "struct<name:string,jobs:array<struct<id:bigint,title:string,absolute_url:string,location:struct<name:string>,updated_at:string,content:string>>>"


def board_listings(boards: DataFrame, doc: str = "doc", body: str = "body", feed: str = "source_repo", most: int = 200, text_chars: int = 5000) -> DataFrame:
    """Listings of a board's JSON with a name and jobs; rows without title or address are skipped, at most ``most`` a company."""
    parsed = boards.select(doc, feed, F.from_json(body, _BOARD).alias("b"))
    rows = parsed.select(doc, feed, F.col("b.name").alias("company_name"), F.posexplode(F.slice(F.filter("b.jobs", lambda j: (F.coalesce(j["title"], F.lit("")) != "") & (F.coalesce(j["absolute_url"], F.lit("")) != "")), 1, most)).alias("position", "j"))
    out = rows.select(doc, "position", feed, strip(F.col("company_name")).alias("company_name"), strip(F.col("j.title")).alias("role_title"), F.col("j.location.name").alias("location_raw"), F.col("j.absolute_url").alias("primary_url"), F.substring(strip_markup(F.col("j.content")), 1, text_chars).alias("job_description"), F.col("j.updated_at").alias("date_posted_raw"))
    return first_by_id(with_identity(out, feed), doc)


_POSTINGS = "array<struct<id:string,text:string,hostedUrl:string,applyUrl:string,categories:struct<location:string,team:string,commitment:string>,createdAt:bigint,descriptionPlain:string,additionalPlain:string>>"


def posting_listings(boards: DataFrame, doc: str = "doc", body: str = "body", feed: str = "source_repo", company: str = "company_name", most: int = 200, text_chars: int = 5000) -> DataFrame:
    """Listings of a JSON array of postings; the company is the board's."""
    rows = boards.select(doc, feed, company, F.posexplode(F.slice(F.from_json(body, _POSTINGS), 1, most)).alias("position", "p"))
    text = F.concat_ws("\n\n", F.nullif(F.col("p.descriptionPlain"), F.lit("")), F.nullif(F.col("p.additionalPlain"), F.lit("")))
    out = rows.select(doc, "position", feed, F.col(company).alias("company_name"), strip(F.col("p.text")).alias("role_title"), F.col("p.categories.location").alias("location_raw"), F.coalesce("p.hostedUrl", "p.applyUrl").alias("primary_url"), F.timestamp_millis("p.createdAt").alias("posted_at"), F.substring(text, 1, text_chars).alias("job_description"))
    return first_by_id(with_identity(out.where("role_title <> '' and primary_url is not null"), feed), doc)


_FLAT = "array<struct<title:string,jobUrl:string,descriptionUrl:string,applyUrl:string,locationName:string,publishedDate:string>>"


def flexible_listings(boards: DataFrame, doc: str = "doc", body: str = "body", feed: str = "source_repo", company: str = "company_name") -> DataFrame:
    """Listings of a board whose jobs stand at the top or below jobBoard."""
    jobs = F.coalesce(F.from_json(F.get_json_object(body, "$.jobs"), _FLAT), F.from_json(F.get_json_object(body, "$.jobBoard.jobs"), _FLAT))
    rows = boards.select(doc, feed, company, F.posexplode(jobs).alias("position", "j"))
    out = rows.select(doc, "position", feed, F.col(company).alias("company_name"), strip(F.col("j.title")).alias("role_title"), F.col("j.locationName").alias("location_raw"), F.coalesce("j.jobUrl", "j.descriptionUrl", "j.applyUrl").alias("primary_url"), F.col("j.publishedDate").alias("date_posted_raw"))
    return first_by_id(with_identity(out.where("role_title <> '' and primary_url is not null"), feed), doc)


_INERTIA = "struct<props:struct<jobPostings:array<struct<id:bigint,title:string,url:string,applyUrl:string,location:string,companyName:string,companyBatchName:string,description:string,createdAt:string>>>>"


def attribute_listings(pages: DataFrame, doc: str = "doc", body: str = "body", prefix: str = "batch") -> DataFrame:
    """Listings of a page that carries its data in an attribute; the feed is named after the company's batch."""
    rows = pages.select(doc, F.posexplode(F.from_json(embedded_json(body, "attribute"), _INERTIA)["props"]["jobPostings"]).alias("position", "p"))
    out = rows.select(doc, "position", F.concat_ws(":", F.lit(prefix), F.nullif(F.col("p.companyBatchName"), F.lit(""))).alias("source_repo"), strip(F.col("p.companyName")).alias("company_name"), strip(F.col("p.title")).alias("role_title"), F.col("p.location").alias("location_raw"), F.coalesce("p.applyUrl", "p.url").alias("primary_url"), F.when(F.length(strip(F.col("p.description"))) >= 200, F.col("p.description")).alias("job_description"))
    return first_by_id(with_identity(out.where("company_name <> '' and role_title <> ''")), doc)


def sitemap_entries(maps: DataFrame, doc: str = "doc", body: str = "body") -> DataFrame:
    """(doc, position, loc, lastmod, title) of sitemaps; the title is guessed from the address."""
    rows = maps.select(doc, F.posexplode(F.regexp_extract_all(body, F.lit(r"(?is)<url>(.*?)</url>"), 1)).alias("position", "u"))
    loc = strip(F.regexp_extract("u", r"(?is)<loc>(.*?)</loc>", 1))
    tail = F.regexp_replace(F.element_at(F.split(F.regexp_replace(loc, "[?#].*$|/+$", ""), "/"), -1), "[-_]+", " ")
    return rows.select(doc, "position", loc.alias("loc"), _blank_null(F.regexp_extract("u", r"(?is)<lastmod>(.*?)</lastmod>", 1)).alias("lastmod"), F.initcap(squeeze(F.regexp_replace(tail, r"\b\d+\b", ""))).alias("title"))


def heading_listings(pages: DataFrame, doc: str = "doc", body: str = "body", window: int = 600) -> DataFrame:
    """Headings that link a job; company and stage are looked for in the characters that follow."""
    mark = r"#### \[([^\]]+)\]\(([^)]+)\)"
    found = pages.select(doc, body, F.posexplode(F.regexp_extract_all(body, F.lit(f"({mark})"), 1)).alias("position", "h"))
    # the offset of the n-th heading: where the text before it ends
    parts = F.slice(F.split(F.col(body), mark), 1, F.col("position") + 1)
    before = F.aggregate(parts, F.lit(0), lambda s, p: s + F.length(p)) + F.aggregate(F.slice(F.regexp_extract_all(body, F.lit(f"({mark})"), 1), 1, F.col("position") + 1), F.lit(0), lambda s, h: s + F.length(h))
    near = F.substring(F.col(body), before + 1, F.lit(window))
    near = F.get(F.split(near, "#### "), F.lit(0))
    stage = F.lower(F.regexp_extract(near, r"(?i)\b(pre-seed|seed|series [a-h]|growth|public)\b", 1))
    return found.select(doc, "position", F.regexp_extract("h", mark, 1).alias("role_title"), F.regexp_extract("h", mark, 2).alias("primary_url"), _blank_null(F.regexp_extract(near, r"\[([^\]]+)\]\([^)]*/companies/[^)]*\)", 1)).alias("company_name"), _blank_null(stage).alias("stage"))


def nearest_before(anchors: DataFrame, links: DataFrame, doc: str = "doc", offset: str = "offset", value: str = "company_name") -> DataFrame:
    """Each link with the value of the nearest anchor before it in its document: an as-of join by one window."""
    both = links.select(doc, offset, "link", F.lit(None).cast("string").alias("_v"), F.lit(1).alias("_o")).union(anchors.select(doc, offset, F.lit(None).cast("string"), F.col(value), F.lit(0)))
    upto = Window.partitionBy(doc).orderBy(offset, "_o").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(value, F.last("_v", ignorenulls=True).over(upto)).where("link is not null").select(doc, offset, "link", value)


def best_attempt(attempts: DataFrame, key: str = "doc", least_chars: int = 500) -> DataFrame:
    """The attempt with most jobs for every document, the earlier of equal ones; ``thin`` if it's too short or empty."""
    best = attempts.groupBy(key).agg(F.min_by(F.struct("attempt", "body", "jobs"), F.struct(-F.col("jobs"), F.col("attempt"))).alias("x"))
    return best.select(key, "x.attempt", "x.body", "x.jobs", ((F.length("x.body") < least_chars) | (F.col("x.jobs") == 0)).alias("thin"))


def card_listings(pages: DataFrame, doc: str = "doc", body: str = "body", feed: str = "source_repo") -> DataFrame:
    """Listings of result cards: an element per job with title, company, place and link by class name."""
    cards = pages.select(doc, feed, F.posexplode(F.regexp_extract_all(body, F.lit(r"(?is)<li[^>]*>(.*?)</li>"), 1)).alias("position", "card"))
    by_class = lambda name: strip_markup(F.regexp_extract("card", rf"""(?is)class="[^"]*{name}[^"]*"[^>]*>(.*?)</""", 1))
    out = cards.select(doc, "position", feed, by_class("title").alias("role_title"), by_class("company").alias("company_name"), by_class("location").alias("location_raw"), first_url(F.col("card")).alias("primary_url"))
    return first_by_id(with_identity(out.where("role_title <> '' and company_name <> ''"), feed), doc)


def registry_rows(files: DataFrame, system: str = "system", body: str = "body") -> DataFrame:
    """(system, key, slug, position) of registries that are a list of slugs or a map of names to slugs; a|b|c keeps its first part as key."""
    listed = F.from_json(body, "array<string>")
    mapped = F.map_entries(F.from_json(body, "map<string,string>"))
    as_list = files.where(F.startswith(strip(F.col(body)), F.lit("["))).select(system, F.posexplode(listed).alias("position", "slug")).select(system, "position", F.substring_index("slug", "|", 1).alias("name"), "slug")
    as_map = files.where(F.startswith(strip(F.col(body)), F.lit("{"))).select(system, F.posexplode(mapped).alias("position", "e")).select(system, "position", F.col("e.key").alias("name"), F.col("e.value").alias("slug"))
    both = as_list.union(as_map)
    return both.select(system, registry_key(F.col("name")).alias("key"), "slug", "position")


def registry_lookup(names: DataFrame, registry: DataFrame, name: str = "company_name", least_chars: int = 3) -> DataFrame:
    """(name, slug, exact): by key, else the first entry that contains the name's key or lies within it.

    Containment is joined on shared three-letter pieces instead of all pairs: whichever key is the shorter, its rarest
    piece occurs in the longer one, so a common piece is no hot key. Keys below ``least_chars`` letters match by equality alone.
    """
    n = names.select(name).where(F.col(name).isNotNull()).distinct().withColumn("key", registry_key(F.col(name))).where("key <> ''")
    r = registry.groupBy("key").agg(F.min(F.struct("position", "slug")).alias("r")).select("key", "r.position", "r.slug")
    exact = n.join(r, "key").select(name, "slug", F.lit(True).alias("exact"))
    grams = lambda k: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(k) - 2, F.lit(1))), lambda i: F.substring(k, i, F.lit(3))))
    missed = n.join(exact.select(name), name, "left_anti").where(F.length("key") >= least_chars)
    long_enough = r.where(F.length("key") >= least_chars).withColumnRenamed("key", "rkey")
    of_names, of_registry = missed.select(name, "key", F.explode(grams(F.col("key"))).alias("g")), long_enough.select("rkey", "position", "slug", F.explode(grams(F.col("rkey"))).alias("g"))
    # the shorter key offers its rarest piece alone, counted over both sides
    often = of_names.groupBy("g").agg(F.count("*").alias("c")).union(of_registry.groupBy("g").agg(F.count("*").alias("c"))).groupBy("g").agg(F.sum("c").alias("c"))
    rarest = lambda rows, keep: rows.join(often, "g").groupBy(*keep).agg(F.min_by("g", F.struct("c", "g")).alias("g"))
    inside = of_names.join(rarest(of_registry, ["rkey", "position", "slug"]), "g").where(F.contains("key", "rkey"))
    around = rarest(of_names, [name, "key"]).join(of_registry, "g").where(F.contains("rkey", "key"))
    cols = [name, "position", "slug"]
    fuzzy = inside.select(*cols).union(around.select(*cols)).groupBy(name).agg(F.min(F.struct("position", "slug")).alias("b")).select(name, "b.slug", F.lit(False).alias("exact"))
    return exact.union(fuzzy)
