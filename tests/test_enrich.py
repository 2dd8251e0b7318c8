from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from rolemill.operators import enrich


def test_embedding_falls_back_to_single_texts(spark):
    def factory():
        def model(texts):
            if any("bad" in t for t in texts):
                raise RuntimeError("no")
            return [[float(len(t))] for t in texts][: 1 if len(texts) == 3 else None]

        return model

    df = spark.createDataFrame([(1, "aa"), (2, "bad"), (3, None), (4, " "), (5, "bbb")], "id long, t string").coalesce(1)
    got = {r.id: (r.embedding, r.error) for r in enrich.embed(df, "id", "t", factory, 3).collect()}
    assert got == {1: ([2.0], None), 2: (None, "RuntimeError: no"), 3: (None, None), 4: (None, None), 5: ([3.0], None)}


def test_hash_embedder_is_stable():
    a, b = enrich.hash_embedder(8)(["x y", ""])
    assert a == enrich.hash_embedder(8)(["X  y"])[0] and b == [0.0] * 8


def test_answers(spark):
    good = '```json\n{"industry": "Health Care", "company_size": "Huge", "required_skills": ["SQL", "sql", " "], "sponsorship": null}\n```'
    rows = [(good,), ('{"company_size": "large", "sponsorship": true}',), ("[1]",), ("no json",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "a string").select(enrich.parse_answer(F.col("a"))).collect()]
    assert got[0].asDict() == {"industry": "health_care", "company_size": "unknown", "required_skills": ["sql"], "sponsorship": None}
    assert got[1].sponsorship is True and got[1].company_size == "large" and got[1].required_skills == [] and got[2:] == [None] * 3


def test_posting_details(spark):
    body = json.dumps({"title": " Dev ", "content": "<p>Hello</p>", "location": {"name": "Oakturn"}, "lists": [{"text": "What you'll do", "content": "<li>Build</li><li> </li>"}, {"text": "Requirements", "content": "<li>SQL</li>"}]})
    d = spark.createDataFrame([(body,)], "b string").select(enrich.posting_details(F.col("b")).alias("d")).first().d
    assert (d.title, d.location, d.description, d.sections.responsibilities, d.sections.qualifications, d.sections.benefits) == ("Dev", "Oakturn", "Hello", ["Build"], ["SQL"], [])


@pytest.mark.parametrize("primary,resolved,target", [("https://linkedin.com/1", "https://a.example", "https://a.example"), ("https://b.example", None, "https://b.example"), ("https://linkedin.com/1", "", "https://linkedin.com/1"), (None, "https://indeed.com/x", "https://indeed.com/x"), (None, None, None)])
def test_best_target(spark, primary, resolved, target):
    df = spark.createDataFrame([(primary, resolved)], "p string, r string")
    assert df.select(enrich.best_target(F.col("p"), F.col("r"))).first()[0] == target


def test_outcomes(spark):
    rows = spark.createDataFrame([("a", "u"), ("b", None), ("c", "u"), ("d", "u"), ("e", "u")], "job_id string, primary_url string")
    bodies = spark.createDataFrame([("a", "short", "p" * 200, None), ("c", None, "x" * 300, True), ("d", "a" * 200, "p" * 300, False)], "job_id string, api_text string, page_text string, closed boolean")
    got = {r.job_id: (r.outcome, (r.text or "")[:1]) for r in enrich.fetch_outcomes(rows, bodies).collect()}
    assert got == {"a": ("success", "p"), "b": ("skip_no_url", ""), "c": ("closed_at_source", ""), "d": ("success", "a"), "e": ("failed", "")}


def test_addresses(spark):
    jobs = spark.createDataFrame([("a", "Senior Data Engineer"), ("b", "Nurse")], "job_id string, role_title string")
    results = spark.createDataFrame([("a", 1, 1, "https://linkedin.com/x", "Senior Data Engineer"), ("a", 1, 2, "https://x.example/1", "Chef"), ("a", 2, 1, "https://x.example/2", "Data Engineer, Senior"), ("b", 1, 1, "https://y.example", "Pilot")], "job_id string, strategy int, position int, url string, title string")
    assert [tuple(r) for r in enrich.resolve_addresses(jobs, results).collect()] == [("a", "https://x.example/2", 2, 1.0)]


def test_job_links(spark):
    body = "[Data Engineer](/jobs/1) [Home](/) [Short](/jobs/2) [Platform Lead](https://z.example/careers/3?x=1) [About our team](/about)"
    got = enrich.job_links(spark.createDataFrame([("d", "https://y.example/list", body)], "doc string, base_url string, body string")).orderBy("position")
    assert [(r.title, r.url) for r in got.collect()] == [("Data Engineer", "https://y.example/jobs/1"), ("Platform Lead", "https://z.example/careers/3?x=1")]


@pytest.mark.parametrize("stages,status", [([("a", True, True)], "success"), ([("a", True, False), ("b", True, True)], "partial"), ([("a", True, False), ("c", False, True)], "failed"), ([("c", False, False)], "partial")])
def test_run_status(spark, stages, status):
    assert enrich.run_status(spark.createDataFrame(stages, "stage string, core boolean, ok boolean")).first()[0] == status
