from __future__ import annotations

import html
import json

from pyspark.sql import functions as F

from rolemill.sources import parsers as P


def docs(spark, body, feed="feed"):
    return spark.createDataFrame([("d1", feed, body), ("d2", feed, "not parsable"), ("d3", feed, None)], "doc string, source_repo string, body string")


def cells(df, *cols, order="position"):
    return [tuple(r) for r in df.orderBy(order).select(*cols).collect()]


def test_html_table(spark):
    body = """<table><thead><tr><th>Company</th></tr></thead><tbody>
      <tr><td><strong><a href="https://c.example">Acme 🔥</a></strong></td><td>Dev 🎓</td><td>Oakturn</br>Quillby</td><td><a href="https://a.example/1">Apply</a></td><td>2d</td></tr>
      <tr><td>↳</td><td>Analyst</td><td><details><summary>2 locations</summary>Wexcombe<br>Halloway</details></td><td><a href='https://a.example/2'>Apply</a></td><td>3d</td></tr>
      <tr><td>Globex</td><td>Closed role</td><td>X</td><td>🔒</td><td>1d</td></tr>
      <tr><td>↳</td><td>After closed</td><td>X</td><td></td><td></td></tr>
      <tr><td>Acme</td><td>dev</td><td>again</td><td></td><td></td></tr>
      <tr><td>only</td><td>two</td></tr></tbody></table>"""
    got = cells(P.html_tables(docs(spark, body)), "company_name", "role_title", "location_raw", "primary_url", "date_posted_raw")
    assert got == [("Acme", "Dev", "Oakturn, Quillby", "https://a.example/1", "2d"), ("Acme", "Analyst", "Wexcombe, Halloway", "https://a.example/2", "3d"), ("Globex", "After closed", "X", None, None)]


def test_pipe_table(spark):
    lines = ["| Company | Title |", "|---|---|", "| **[Acme](https://c)** | **[Dev](https://a/1)** | Oakturn | Remote | Jun 1 |", "| **[Acme](https://c)** | **[Dev](https://a/2)** | Oakturn | On Site | Jun 2 |", "text"]
    df = spark.createDataFrame([("d", i, "feed", s) for i, s in enumerate(lines)], "doc string, position int, source_repo string, line string")
    assert cells(P.pipe_tables(df), "company_name", "role_title", "primary_url", "work_model") == [("Acme", "Dev", "https://a/1", "remote")]


def test_snapshot_delta_and_diff(spark):
    old, new = spark.createDataFrame([("a",), ("b",), ("b",)], "l string"), spark.createDataFrame([("b",), ("c",)], "l string")
    added, removed, size = P.snapshot_delta(old, new, 1)
    assert [r[0] for r in added.collect()] == ["c"] and sorted(r[0] for r in removed.collect()) == ["a", "b"] and tuple(size.first()) == (1, 2, False)
    diff = spark.createDataFrame([(x,) for x in ("+++ b/x", "--- a/x", "+| new |", "-| old |", " | same |")], "line string")
    assert sorted(tuple(r) for r in P.diff_lines(diff).collect()) == [("+", "| new |"), ("-", "| old |")]


def test_next_data(spark):
    j = {"props": {"pageProps": {"initialJobs": [{"jobResult": {"jobId": "1", "jobTitle": "Dev", "publishTime": 1700000000000, "isH1bSponsor": True}, "companyResult": {"companyName": "Acme"}}, {"jobResult": {"jobTitle": ""}, "companyResult": {"companyName": "X"}}]}}}
    body = f'<html><script id="__NEXT_DATA__" type="application/json">{json.dumps(j)}</script></html>'
    assert cells(P.next_listings(docs(spark, body)), "company_name", "role_title", "sponsorship") == [("Acme", "Dev", True)]


def test_boards(spark):
    board = {"name": "Acme", "jobs": [{"id": 1, "title": "Dev", "absolute_url": "https://x/1", "location": {"name": "Oakturn"}, "content": "<p>Hello &nbsp;</p>" + "y" * 6000}, {"id": 2, "title": "", "absolute_url": "https://x/2"}, {"id": 3, "title": "Ops", "absolute_url": None}]}
    got = cells(P.board_listings(docs(spark, json.dumps(board))), "company_name", "role_title", F.length("job_description").alias("n"))
    assert got == [("Acme", "Dev", 5000)]
    postings = [{"text": "Dev", "hostedUrl": "https://y/1", "descriptionPlain": "a", "additionalPlain": "b", "createdAt": 1700000000000, "categories": {"location": "Quillby"}}, {"text": "No url"}]
    lever = docs(spark, json.dumps(postings)).withColumn("company_name", F.lit("globex"))
    assert cells(P.posting_listings(lever), "company_name", "role_title", "job_description", "location_raw") == [("globex", "Dev", "a\n\nb", "Quillby")]
    for shape in ({"jobs": [{"title": "Dev", "jobUrl": "https://z/1"}]}, {"jobBoard": {"jobs": [{"title": "Dev", "descriptionUrl": "https://z/1"}]}}):
        flat = docs(spark, json.dumps(shape)).withColumn("company_name", F.lit("initech"))
        assert cells(P.flexible_listings(flat), "company_name", "role_title", "primary_url") == [("initech", "Dev", "https://z/1")]


def test_attribute_page(spark):
    page = {"props": {"jobPostings": [{"id": 1, "title": "Dev & Ops", "applyUrl": "https://w/1", "companyName": "Acme \"Q\"", "companyBatchName": "W24", "description": "short"}, {"id": 2, "title": "B", "companyName": "C", "description": "d" * 200}]}}
    body = f'<div id="app" data-page="{html.escape(json.dumps(page))}"></div>'
    assert cells(P.attribute_listings(docs(spark, body)), "source_repo", "company_name", "role_title", F.length("job_description").alias("n")) == [("batch:W24", 'Acme "Q"', "Dev & Ops", None), ("batch", "C", "B", 200)]


def test_sitemap(spark):
    body = "<urlset><url><loc>https://s.example/jobs/senior-data-engineer-123</loc><lastmod>2026-01-02</lastmod></url><url><loc>https://s.example/a/</loc></url></urlset>"
    assert cells(P.sitemap_entries(docs(spark, body)), "title", "lastmod") == [("Senior Data Engineer", "2026-01-02"), ("A", None)]


def test_headings_look_ahead_to_the_next_one(spark):
    body = "intro\n#### [Dev](https://b/jobs/1)\n[Acme](https://b/companies/acme)\nSeries A\n#### [Ops](https://b/jobs/2)\nno company\n#### [QA](https://b/jobs/3)\n[Globex](https://b/companies/globex) Seed"
    got = cells(P.heading_listings(docs(spark, body)), "role_title", "company_name", "stage")
    assert got == [("Dev", "Acme", "series a"), ("Ops", None, None), ("QA", "Globex", "seed")]


def test_nearest_anchor(spark):
    anchors = spark.createDataFrame([("d", 10, "Acme"), ("d", 50, "Globex"), ("e", 5, "Other")], "doc string, offset int, company_name string")
    links = spark.createDataFrame([("d", 5, "l0"), ("d", 12, "l1"), ("d", 49, "l2"), ("d", 50, "l3"), ("e", 1, "l4")], "doc string, offset int, link string")
    assert {r.link: r.company_name for r in P.nearest_before(anchors, links).collect()} == {"l0": None, "l1": "Acme", "l2": "Acme", "l3": "Globex", "l4": None}


def test_best_attempt(spark):
    rows = [("d", 1, "x" * 600, 2), ("d", 2, "y" * 600, 5), ("d", 3, "z" * 600, 5), ("e", 1, "short", 0)]
    got = {r.doc: (r.attempt, r.thin) for r in P.best_attempt(spark.createDataFrame(rows, "doc string, attempt int, body string, jobs int")).collect()}
    assert got == {"d": (2, False), "e": (1, True)}


def test_cards(spark):
    body = '<ul><li class="c"><a href="https://l/1"><h3 class="job-title">Dev</h3></a><h4 class="company">Acme</h4><span class="location">Oakturn</span></li><li>noise</li></ul>'
    assert cells(P.card_listings(docs(spark, body)), "company_name", "role_title", "location_raw", "primary_url") == [("Acme", "Dev", "Oakturn", "https://l/1")]


def test_registry(spark):
    files = spark.createDataFrame([("s", '["acme","globex-corp"]'), ("w", '["tenant|wd5|careers"]'), ("m", '{"Initech LLC": "initech"}')], "system string, body string")
    rows = P.registry_rows(files)
    assert {(r.system, r.key, r.slug) for r in rows.collect()} == {("s", "acme", "acme"), ("s", "globex corp", "globex-corp"), ("w", "tenant", "tenant|wd5|careers"), ("m", "initech llc", "initech")}
    names = spark.createDataFrame([("Acme",), ("The Acme Group",), ("Globex",), ("Initech",), ("Nobody",), (None,)], "company_name string")
    got = {r.company_name: (r.slug, r.exact) for r in P.registry_lookup(names, rows).collect()}
    assert got == {"Acme": ("acme", True), "The Acme Group": ("acme", False), "Globex": ("globex-corp", False), "Initech": ("initech", False)}
