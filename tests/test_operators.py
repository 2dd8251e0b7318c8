from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rolemill.operators import dedup, gates, match, merge, predicates, stats, sync
from rolemill.operators import feedback as fold

NOW = dt.datetime(2026, 6, 30)


def ntz(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def now():
    return F.lit("2026-06-30 00:00:00").cast("timestamp_ntz")


def feed_rows(n, seed):
    rng = random.Random(seed)
    feeds = ["linkedin", "wellfound:x", "greenhouse:acme", "otta", "elsewhere"]
    return [
        (i, rng.choice(["Acme", "acme!"]), rng.choice(["Dev", "dev "]), "https://a.example/1?utm_source=q", rng.choice(feeds), rng.choice([None, [], ["b", "a"], ["c"]]), dt.datetime(2026, 1, rng.randint(1, 28)), dt.datetime(2026, 2, rng.randint(1, 28)), rng.choice([None, "", f"text {i}"]), rng.choice([None, [], [f"s{i}"]]), rng.choice([None, "", f"l{i}"]))
        for i in range(n)
    ]


SCHEMA = "seq int, company_name string, role_title string, primary_url string, source_repo string, sources array<string>, first_seen_at timestamp_ntz, last_seen_at timestamp_ntz, job_description string, required_skills array<string>, seniority_level string"
TIER = {"linkedin": 4, "wellfound": 3, "greenhouse": 2, "otta": 1}


def fold_model(rows):
    """Row by row: the first is the base, a row of higher priority takes over and fills what the base lacks."""
    base = None
    for r in rows:
        feed = r[4].split(":")[0]
        if base is None:
            base = {"feed": r[4], "p": TIER.get(feed, 0), "sources": {feed, *(r[5] or [])}, "first": r[6], "last": r[7], "text": r[8] or None, "skills": r[9] or None, "level": r[10] or None}
            continue
        base["sources"] |= {feed, *(r[5] or [])}
        base["first"], base["last"] = max(base["first"], r[6]), max(base["last"], r[7])
        if TIER.get(feed, 0) > base["p"]:
            base |= {"feed": r[4], "p": TIER.get(feed, 0), "text": base["text"] or r[8] or None, "skills": base["skills"] or r[9] or None, "level": base["level"] or r[10] or None}
    return (base["feed"], sorted(base["sources"]), base["first"], base["last"], base["text"], base["skills"], base["level"], len(rows))


@pytest.mark.parametrize("seed", range(8))
def test_merge_across_feeds_equals_the_fold(spark, seed):
    rows = feed_rows(random.Random(seed).randint(1, 9), seed)
    got = dedup.merge_across_feeds(spark.createDataFrame(rows, SCHEMA)).select("source_repo", "sources", "first_seen_at", "last_seen_at", "job_description", "required_skills", "seniority_level", "merged").collect()
    assert [tuple(r) for r in got] == [fold_model(rows)]


def test_url_duplicates_keep_the_best(spark):
    text = "x" * 200
    rows = [("a", "otta", "active", "https://X.example/1?ref=2", text, ["s"], [1.0]), ("b", "linkedin", "active", "https://x.example/1/", None, None, None), ("c", "linkedin", "active", "https://x.example/1", text, None, None), ("d", "linkedin", "inactive", "https://x.example/1", text, ["s"], [1.0]), ("e", "otta", "active", None, None, None, None), ("f", "otta", "active", "", None, None, None)]
    df = spark.createDataFrame(rows, "job_id string, source_repo string, status string, primary_url string, job_description string, required_skills array<string>, embedding array<float>")
    got = {r.job_id: r.status for r in dedup.mark_url_duplicates(df).collect()}
    assert got == {"a": "duplicate", "b": "duplicate", "c": "active", "d": "inactive", "e": "active", "f": "active"}


@pytest.mark.parametrize("going,total,trips", [(10, 20, False), (11, 20, True), (19, 19, False), (0, 30, False)])
def test_stale_guard_at_its_bounds(spark, going, total, trips):
    rows = [(f"j{i:02}", "feed", "active") for i in range(total)] + [("other", "unscanned", "active")]
    seen = [("feed", f"j{i:02}") for i in range(going, total)] or [("feed", "new")]
    got = merge.mark_stale(spark.createDataFrame(rows, "job_id string, source_repo string, status string"), spark.createDataFrame(seen, "source_repo string, job_id string")).collect()
    inactive = sum(r.status == "inactive" for r in got)
    assert inactive == (0 if trips else going) and any(r.tripped for r in got) == trips
    assert next(r.status for r in got if r.job_id == "other") == "active"


def test_merge_policies(spark):
    old = spark.createDataFrame([("a", "h1", "text", ["x"], [1.0]), ("b", None, "text", None, [2.0]), ("k", "h", "", [], None)], "job_id string, content_hash string, job_description string, sources array<string>, embedding array<float>")
    new = spark.createDataFrame([("a", "h2", None, ["y", None, "x"], None), ("b", None, "new", [], None), ("n", "h", "t", ["z"], None)], old.schema)
    got = {r.job_id: tuple(r)[1:] for r in merge.merge(old, new, "job_id", merge.JOB_POLICIES).collect()}
    assert got == {"a": ("h2", "text", ["x", "y"], None, "updated"), "b": (None, "new", None, [2.0], "unchanged"), "k": ("h", "", [], None, "kept"), "n": ("h", "t", ["z"], None, "inserted")}


def test_merge_with_empty_sides(spark):
    some = spark.createDataFrame([("a", "h")], "job_id string, content_hash string")
    none = spark.createDataFrame([], some.schema)
    assert merge.merge(none, some, "job_id", {}).first().action == "inserted"
    assert merge.merge(some, none, "job_id", {}).first().action == "kept"


def test_tombstone_ages(spark):
    t = [("a", True, dt.datetime(2026, 6, 20)), ("b", True, dt.datetime(2026, 4, 1)), ("c", True, dt.datetime(2026, 1, 1)), ("d", True, None), ("e", False, dt.datetime(2025, 1, 1))]
    dead = spark.createDataFrame(t, "job_id string, dead boolean, dead_confirmed_at timestamp_ntz")
    delta = spark.createDataFrame([(x,) for x in "abcdef"], "job_id string")
    got = dict(merge.split_tombstoned(delta, dead, now()).collect())
    assert got == {"a": "skipped", "b": "retried", "c": "retried", "d": "skipped", "e": "fresh", "f": "fresh"}
    assert [r.verdict for r in merge.split_tombstoned(delta, dead, now(), retries=1).orderBy("job_id").collect()][:3] == ["skipped", "retried", "skipped"]


def test_flip_keeps_first_time_and_reason(spark):
    s = spark.createDataFrame([("a", "active", False, None, None), ("b", "inactive", True, dt.datetime(2026, 1, 1), "old"), ("c", "inactive", None, None, None)], "job_id string, status string, flipped boolean, flipped_at timestamp_ntz, flip_reason string")
    f = spark.createDataFrame([("a", "inactive", "spam"), ("b", "active", "new"), ("c", "inactive", "same")], "job_id string, new_status string, reason string")
    got = {r.job_id: tuple(r)[1:] for r in merge.flip(s, f, now()).collect()}
    assert got == {"a": ("inactive", True, NOW, "spam"), "b": ("active", True, dt.datetime(2026, 1, 1), "old"), "c": ("inactive", False, None, None)}


def test_mirror_and_reconcile_dead(spark):
    s = spark.createDataFrame([("a", "active", False, False, None), ("b", "active", True, False, dt.datetime(2026, 6, 29, 12)), ("c", "active", False, True, None)], "job_id string, status string, dead boolean, permanent_404 boolean, dead_confirmed_at timestamp_ntz")
    remote = spark.createDataFrame([("a", dt.datetime(2026, 6, 1)), ("a", None)], "job_id string, dead_at timestamp_ntz")
    got = {r.job_id: r.status for r in merge.reconcile_dead(merge.mirror_dead(s, remote, now()), now()).collect()}
    assert got == {"a": "inactive", "b": "active", "c": "inactive"}


def test_purge_takes_feedback_along(spark):
    s = spark.createDataFrame([("a", "inactive", dt.datetime(2026, 6, 1)), ("b", "inactive", dt.datetime(2026, 6, 16)), ("c", "active", dt.datetime(2020, 1, 1)), ("d", "inactive", None)], "job_id string, status string, last_seen_at timestamp_ntz")
    f = spark.createDataFrame([("u", "a"), ("u", "b")], "user_id string, job_id string")
    jobs, reactions = merge.purge(s, f, now())
    assert {r[0] for r in jobs.select("job_id").collect()} == {"b", "c", "d"} and [r.job_id for r in reactions.collect()] == ["b"]


def test_write_back_ignores_blanks(spark):
    s = spark.createDataFrame([("a", "old", ["x"]), ("b", "", []), ("c", None, None)], "job_id string, industry string, required_skills array<string>")
    r = spark.createDataFrame([("a", "", []), ("b", "new", ["y"]), ("c", "new", ["y"])], s.schema)
    full = {x.job_id: (x.industry, x.required_skills) for x in merge.write_back(s, r, "job_id", ["industry", "required_skills"]).collect()}
    assert full == {"a": ("old", ["x"]), "b": ("new", ["y"]), "c": ("new", ["y"])}
    gaps = merge.write_back(s.where("job_id = 'a'"), r.withColumn("industry", F.lit("other")), "job_id", ["industry"], overwrite=False).first()
    assert gaps.industry == "old"


def test_affinity_equals_the_fold(spark):
    rng = np.random.default_rng(5)
    jobs = [(f"j{i}", f"c{i}", rng.normal(size=4).astype(float).tolist()) for i in range(12)] + [("bad", "c", [1.0]), ("none", "c", None)]
    log = [(k, rng.choice(["u", "v"]).item(), f"j{rng.integers(12)}", rng.choice(["like", " LIKE ", "dislike", "applied", "odd"]).item(), dt.datetime(2026, 1, 1) + dt.timedelta(hours=int(rng.integers(500)))) for k in range(60)] + [(99, "u", "bad", "like", NOW), (98, "u", "none", "like", NOW), (97, "u", "unknown", "like", NOW)]
    first = {}
    for k, u, j, r, t in sorted(log, key=lambda x: (x[4], x[0])):
        if r.strip().lower() in ("like", "dislike", "applied"):
            first.setdefault((u, j), (t, k, r.strip().lower()))
    vectors = {j: v for j, _, v in jobs}
    want, companies = {}, {}
    for (u, j), (_, _, r) in sorted(first.items(), key=lambda x: x[1][:2]):
        if r == "like" and j in vectors:
            companies.setdefault(u, []).append("c" + j[1:] if j[0] == "j" else "c")
            if vectors[j] is None or len(vectors[j]) != 4:
                continue
            x = np.array(vectors[j], np.float32).astype(float)
            if u in want:
                m = 0.7 * want[u] + 0.3 * x
                x = m / (np.linalg.norm(m) + 1e-9)
            want[u] = x
    f = spark.createDataFrame(log, "feedback_id int, user_id string, job_id string, reaction string, recorded_at timestamp_ntz")
    j = spark.createDataFrame(jobs, "job_id string, company_name string, embedding array<float>")
    got = {r.user_id: r.affinity for r in fold.affinity(f, j, 4).collect()}
    assert got.keys() == want.keys() and all(np.allclose(got[u], want[u]) for u in want)
    lists = {r.user_id: r.liked_companies for r in fold.company_lists(f, j).collect()}
    assert lists == {u: c for u, c in companies.items() if u in lists} and set(companies) <= set(lists)


def test_company_lists_keep_the_last_hundred(spark):
    jobs = spark.createDataFrame([(f"j{i:03}", f"c{i:03}", None) for i in range(101)], "job_id string, company_name string, embedding array<float>")
    log = spark.createDataFrame([(i, "u", f"j{i:03}", "like", dt.datetime(2026, 1, 1) + dt.timedelta(minutes=i)) for i in range(101)], "feedback_id int, user_id string, job_id string, reaction string, recorded_at timestamp_ntz")
    liked = fold.company_lists(log, jobs).first().liked_companies
    assert len(liked) == 100 and liked[0] == "c001" and liked[-1] == "c100"


def test_second_reaction_changes_nothing(spark):
    log = spark.createDataFrame([(1, "u", "a", "like", dt.datetime(2026, 1, 1)), (2, "u", "a", "dislike", dt.datetime(2026, 1, 2))], "feedback_id int, user_id string, job_id string, reaction string, recorded_at timestamp_ntz")
    assert [r.reaction for r in dedup.first_reactions(log).collect()] == ["like"]


def test_gate_rules(spark):
    empty = spark.createDataFrame([], "status string, embedding array<float>, embedded_at timestamp_ntz, job_description string, required_skills array<string>, industry string, seniority_level string")
    m = gates.health_metrics(empty)
    row = m.first()
    assert row.active == 0 and row.embedded_cov_of_embeddable == 1.0 and row.embedded_cov_of_active == 0.0
    assert {r.metric for r in gates.gate_failures(m).collect()} == {"active", "matchable"}
    one = spark.createDataFrame([("active", [1.0], NOW, "x" * 200, ["s"], "i", "l")], empty.schema)
    prior = spark.createDataFrame([("active", 2.0), ("skills_cov", 1.04)], "metric string, value double")
    assert [(r.metric, r.rule) for r in gates.gate_failures(gates.health_metrics(one), prior).collect()] == [("active", "drop_share")]


@pytest.mark.parametrize("base,passes", [(None, True), (1.0, True), (2.0, False)])
def test_publish_decision(spark, base, passes):
    m = spark.createDataFrame([(0, 1)], "vector_violations long, matchable long")
    b = spark.createDataFrame([("matchable", base)] if base else [], "metric string, value double")
    r = gates.publish_decision(m, b).first()
    assert r.passes == passes and r.next_baseline == (1.0 if passes else base)


def test_push_finds_the_bad_document():
    calls = []

    def send(batch):
        calls.append(len(batch))
        return 422 if "bad" in batch else 200

    got = list(sync.push([1, 2, "bad", 4, 5], send))
    assert [d for d, ok, _ in got if not ok] == ["bad"] and len(got) == 5 and calls[0] == 5
    assert list(sync.push([], send)) == [] and [ok for _, ok, _ in sync.push([1, 2], lambda b: 500)] == [False, False]


def test_deliver_from_tasks(spark):
    docs = spark.createDataFrame([(f"j{i}", "{}") for i in range(7)], "job_id string, body string")
    got = sync.deliver(docs, lambda: lambda batch: 413 if len(batch) > 2 else 200, 5).collect()
    assert len(got) == 7 and all(r.delivered for r in got)


def test_watermark_never_moves_back(spark):
    rows = spark.createDataFrame([(dt.datetime(2026, 1, 1),), (None,)], "embedded_at timestamp_ntz")
    assert sync.next_watermark(rows, "2026-05-01 00:00:00").first()[0] == dt.datetime(2026, 5, 1)
    assert sync.next_watermark(rows.limit(0), "2026-05-01 00:00:00").first()[0] == dt.datetime(2026, 5, 1)
    assert sync.effective_since(None, 3) is None and sync.effective_since(2, 3) == 2


def test_signals(spark):
    one = spark.createDataFrame([(["Python", "sql"], "acme", "SF", [3.0, 4.0])], "s array<string>, c string, l string, e array<float>")
    strings = match.strings
    pick = lambda c: one.select(c.alias("x")).first()[0]
    assert pick(match.skills_signal(F.col("s"), strings(["python", "go"]))) == pytest.approx(0.85 / 2 + 0.15 / 2)
    assert pick(match.skills_signal(F.col("s"), strings([]))) == 0.0
    assert pick(match.title_signal(F.col("e"), match.vector_of([3.0, 4.0]))) == pytest.approx(1.0)
    assert pick(match.title_signal(F.col("e"), match.vector_of([1.0]))) == 0.0
    assert pick(match.place_signal(F.col("l"), strings(["San Francisco"]))) == 1.0 and pick(match.place_signal(F.col("l"), strings(["NYC"]))) == 0.2
    assert pick(match.feedback_signal(F.col("c"), strings(["Acme"]), strings(["acme"]))) == 1.0
    assert pick(match.depth_signal(F.col("s"), {"python": 10, "sql": 2.5}, None, strings([]))) == pytest.approx(0.75)
    assert pick(match.depth_signal(F.col("s"), {}, 10, strings(["SQL"]))) == 0.5
    assert pick(match.skill_recency_signal(F.col("s"), {"python": "present", "sql": "2024-01-01"}, now())) == pytest.approx(0.85)
    for job, user, score in (("senior", "Senior", 1.0), ("mid", "senior", 0.75), ("new grad", "entry", 0.2), ("principal", "senior", 0.5), (None, "senior", 0.5), ("intern", "director", 0.2)):
        assert pick(match.seniority_signal(F.lit(job).cast("string"), F.lit(user))) == score


@pytest.mark.parametrize("at,score", [(dt.datetime(2026, 6, 30), 1.0), (dt.datetime(2026, 6, 29, 0, 0, 1), 1.0), (dt.datetime(2026, 6, 15), 0.5), (dt.datetime(2026, 5, 1), 0.0), (dt.datetime(2026, 7, 2), 1 + 2 / 30), (None, 0.0)])
def test_recency(spark, at, score):
    df = spark.createDataFrame([(at,)], "t timestamp_ntz")
    assert df.select(match.recency_signal(now(), F.col("t"))).first()[0] == pytest.approx(score)


def test_limit_stands_before_the_filters(spark):
    rows = [(f"j{i:03}", "active", [1.0, i / 100.0], "f") for i in range(30)]
    jobs = spark.createDataFrame(rows, "job_id string, status string, embedding array<float>, source_repo string")
    got = match.candidates(jobs, [1.0, 0.0], 5)
    assert [r.job_id for r in got.orderBy("distance", "job_id").collect()] == ["j000", "j001", "j002", "j003", "j004"]
    assert "TakeOrderedAndProject" in got._jdf.queryExecution().executedPlan().toString()


def test_sponsorship_keeps_unknown(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "sponsorship boolean")
    assert [r[0] for r in df.where(predicates.not_refused()).collect()] == [True, None]


@pytest.mark.parametrize("n,ok", [(199, False), (200, True)])
def test_text_bounds(spark, n, ok):
    df = spark.createDataFrame([("x" * n,), (" " * 300,)], "job_description string")
    assert [r[0] for r in df.select(predicates.usable_text()).collect()] == [ok, True]
    assert [r[0] for r in df.select(predicates.usable_text(stripped=True)).collect()] == [ok, False]


def test_stats_on_empty_tables(spark, data):
    jobs = spark.read.parquet(f"{data}/jobs.parquet").limit(0)
    assert stats.inventory(jobs).first().total == 0
    assert stats.by_source_and_status(jobs).count() == 0 and stats.quality_histogram(jobs, now()).first().low == 0
