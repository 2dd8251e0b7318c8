"""Requests, transitions and further feeds on small cases."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rolemill.operators import feedback as fold
from rolemill.operators import gates, merge, requests
from rolemill.session import shared_dir
from rolemill.sources import details


def test_patch_fills_what_a_request_lacks(spark):
    docs = spark.createDataFrame([("u", '{"tags": {"skills": [" Go ", "go", ""]}, "totalYearsExperience": 4}'), ("v", "no json"), ("w", None)], "user_id string, body string")
    schema = "user_id string, skills array<string>, total_years double, derived string, derived_version string, derived_hash string"
    asked = spark.createDataFrame([("u", [], None, None, None, None), ("v", ["sql"], 2.0, "old", None, None), ("x", None, None, None, None, None)], schema)
    got = {r.user_id: (r.skills, r.total_years, r.derived) for r in requests.patched(asked, requests.profile_patches(docs)).collect()}
    assert got == {"u": (["Go"], 4.0, None), "v": (["sql"], 2.0, "old"), "x": (None, None, None)}


def test_vector_to_ask_with(spark):
    asked = spark.createDataFrame([("u", [1.0]), ("v", []), ("w", None)], "user_id string, affinity array<double>")
    texts = spark.createDataFrame([("u", [9.0]), ("v", [2.0])], "user_id string, embedding array<double>")
    assert {r.user_id: r.vector for r in requests.query_vectors(asked, texts).collect()} == {"u": [1.0], "v": [2.0], "w": None}


def test_blocks_of_requests_change_nothing(spark, data):
    from rolemill.plans import queries_feeds as q

    rows = lambda block: sorted(map(tuple, requests.match_many(q.jobs_of(spark, data), spark.read.parquet(f"{data}/feedback.parquet"), q.asked(spark, data), q.now(), block=block).collect()))
    assert rows(2_000) == rows(2) != []


def test_page_summary(spark):
    pages = ['<html><title>Dev | Acme</title><meta property="og:site_name" content="Acme"><p>Text</p></html>', "<p>bare</p>"]
    rows = [r[0] for r in spark.createDataFrame([(p,) for p in pages], "h string").select(requests.page_summary(F.col("h"))).collect()]
    assert [(r.title, r.company) for r in rows] == [("Dev", "Acme"), ("Unknown Role", "Unknown")]


def test_affinity_goes_on_from_the_stored_vector(spark):
    at = dt.datetime(2026, 1, 1)
    jobs = spark.createDataFrame([("j", "Acme", [0.0, 1.0])], "job_id string, company_name string, embedding array<float>")
    log = spark.createDataFrame([(1, "u", "j", "like", at), (2, "new", "j", "like", at)], "feedback_id int, user_id string, job_id string, reaction string, recorded_at timestamp_ntz")
    profiles = spark.createDataFrame([("u", [1.0, 0.0], ["Old"], None), ("idle", [1.0, 0.0], None, None)], "user_id string, affinity array<double>, liked_companies array<string>, disliked_companies array<string>")
    once, accepted = fold.apply_feedback(profiles, log, jobs, None, 2)
    got = {r.user_id: r for r in once.collect()}
    norm = (0.7**2 + 0.3**2) ** 0.5
    assert got["u"].affinity == pytest.approx([0.7 / norm, 0.3 / norm]) and got["u"].liked_companies == ["Old", "Acme"]
    assert got["idle"].affinity == [1.0, 0.0] and got["new"].affinity == [0.0, 1.0]
    twice, _ = fold.apply_feedback(once, log, jobs, accepted, 2)
    assert {r.user_id: (r.affinity, r.liked_companies) for r in twice.collect()} == {k: (r.affinity, r.liked_companies) for k, r in got.items()}


def test_repeated_results_do_not_multiply_rows(spark):
    snap = spark.createDataFrame([("a", "x"), ("b", None)], "job_id string, industry string")
    res = spark.createDataFrame([("a", "y"), ("a", "y"), ("a", ""), ("b", "z")], "job_id string, industry string")
    assert sorted(map(tuple, merge.write_back(snap, res, "job_id", ["industry"]).collect())) == [("a", "y"), ("b", "z")]


def test_stage_outcomes(spark):
    rows = [("ok", i == 0, False) for i in range(60)] + [("dry", False, False)] * 50 + [("few", False, False)] * 49 + [("down", True, True)]
    got = {r.stage: r.outcome for r in gates.stage_outcome(spark.createDataFrame(rows, "stage string, resolved boolean, infra_error boolean")).collect()}
    assert got == {"ok": "ok", "dry": "degraded", "few": "ok", "down": "degraded"}


def test_directory_ends_at_the_first_broken_page(spark):
    page = lambda n, nxt="x", total=9: '{"companies": [{"name": "C%d"}], "totalPages": %d, "nextPage": "%s"}' % (n, total, nxt)
    df = spark.createDataFrame([(1, page(1)), (2, page(2)), (3, "broken"), (4, page(4))], "page int, body string")
    assert [r.name for r in details.company_directory(df).orderBy("page").collect()] == ["C1", "C2"]
    df = spark.createDataFrame([(1, page(1)), (2, page(2, "")), (3, page(3))], "page int, body string")
    assert [r.name for r in details.company_directory(df).orderBy("page").collect()] == ["C1", "C2"]


def test_sites_and_postings(spark):
    df = spark.createDataFrame([("https://x.example/recruiting/acme/careers/job/R1", '<a href="/wday/cxs/t/s/jobs">'), ("https://x.example/recruiting/acme/careers/job/R1", ""), ("https://x.example/none", "")], "u string, h string")
    assert [tuple(r[0]) if r[0] else None for r in df.select(details.site_endpoint(F.col("u"), F.col("h"))).collect()] == [("t", "s"), ("acme", "careers"), None]
    body = '{"jobPostings": [{"title": "No", "externalPath": ""}, {"title": "Dev", "externalPath": "/job/R1"}]}'
    one = spark.createDataFrame([("https://x.example/en/job/R1?q=1", body)], "u string, b string").select(details.pick_posting(F.col("u"), F.col("b"))["title"]).first()
    assert one[0] == "Dev"


def test_pay_and_stage(spark):
    df = spark.sql("select named_struct('currency', 'USD', 'min', 10, 'max', 20, 'interval', 'year') r, array(named_struct('name', 'Team', 'values', array('x')), named_struct('name', 'Base Salary', 'values', array('1', '', '2'))) f, 'raised a Series A2 last year' t")
    assert tuple(df.select(details.pay_range(F.col("r")), details.pay_field(F.col("f")), details.funding_stage(F.col("t"))).first()) == ("USD 10-20 year", "1, 2", "series_a")


def test_registry_by_system(spark):
    registry = spark.createDataFrame([("a", "acme", "acme-inc", 0), ("b", "acme", "acme", 0), ("b", "globex corp", "globex", 1)], "system string, key string, slug string, position int")
    names = spark.createDataFrame([("Acme",), ("Globex",), ("None",), (None,)], "company_name string")
    assert {r.company_name: r.slugs for r in details.lookup_all(names, registry).collect()} == {"Acme": {"a": "acme-inc", "b": "acme"}, "Globex": {"b": "globex"}}
    asked = spark.createDataFrame([("a", "acme-inc"), ("a", "acme")], "system string, slug string")
    assert {(r.slug, r.known) for r in details.known_slugs(asked, registry).collect()} == {("acme-inc", True), ("acme", False)}


def test_a_shared_folder_is_asked_for_on_a_cluster(spark, monkeypatch):
    class Context:
        applicationId, master = "other", "spark://host:7077"

    class Session:
        sparkContext, conf = Context, type("C", (), {"get": staticmethod(lambda *_: None)})

    with pytest.raises(RuntimeError):
        shared_dir(Session)
    assert shared_dir(spark)


def test_reports_and_texts_without_nul(spark, tmp_path):
    from rolemill.functions.text import without_nul_anywhere
    from rolemill.store import read_report, write_report

    df = spark.createDataFrame([("a\x00b", ["x\x00", None], 1), (None, None, 2)], "t string, l array<string>, n int")
    assert sorted(map(tuple, without_nul_anywhere(df).collect()), key=lambda r: r[2]) == [("ab", ["x", None], 1), (None, None, 2)]
    write_report(spark.createDataFrame([("old", "new"), ("o2", None)], "a string, b string"), str(tmp_path / "map"), "\t")
    assert sorted(map(tuple, read_report(spark, str(tmp_path / "map"), "\t").collect())) == [("o2", None), ("old", "new")]
