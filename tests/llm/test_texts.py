from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rolemill.llm import packing, stuffing, tokens
from rolemill.llm.queries_text import QUERIES, SQL
from tests.compare import compare


@pytest.fixture(scope="module")
def plain():
    return tiktoken.Encoding("test", pat_str=tokens.PATTERN, mergeable_ranks=tokens.read_ranks(tokens.DEFAULT_TOKENIZER), special_tokens={}).encode_ordinary


ODD = ["", None, " ", "\n\n  \t", "it's  we'll\x1c\x1dx", "naïve 東京 🔥🔥 é", "a" * 30_000, "<|endoftext|>", " \x85 x", "１２ ½ ²", "العربية हिन्दी", "x\x00y", "﻿​", " " * 5000 + "z", "'S 'LL"]


def test_ids_equal_the_library(spark, plain):
    rows = [(k, t, "clash") for k, t in enumerate(ODD)] + [(3, ODD[5], "again"), (None, "null key", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    for chunk in (1, 50, 10_000_000):
        got = sorted(((r.doc_id, tuple(r.ids)) for r in tokens.encode_corpus(df, chunk_chars=chunk).collect()), key=str)
        assert got == sorted(((k, tuple(plain(t or ""))) for k, t, _ in rows), key=str)
    counts = sorted(((r.doc_id, r.n_tokens) for r in tokens.count_tokens(df, chunk_chars=50).collect()), key=str)
    assert counts == sorted(((k, len(plain(t or ""))) for k, t, _ in rows), key=str)


def test_ids_of_all_documents(spark, data, plain):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()}
    got = {r.doc_id: r.ids for r in QUERIES["p6_ids"](spark, data).collect()}
    assert got == {k: plain(t or "") for k, t in docs.items()}


def test_text_keys_and_round_trip(spark):
    rows = [(f"k{i}", t) for i, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "key string, body string")
    back = tokens.decode_corpus(tokens.encode_corpus(df, "key", "body"), "key")
    assert {r.key: r.text for r in back.collect()} == {k: t or "" for k, t in rows}


def test_no_documents(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert tokens.encode_corpus(df).count() == 0 and packing.pack(tokens.count_tokens(df), "doc_id", "n_tokens").count() == 0


def test_decoding_unknown_ids(spark):
    df = spark.createDataFrame([(1, [0, 99999999]), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in tokens.decode_corpus(df).collect()} == {1: "!", 2: "", 3: ""}


def check_packing(rows, placed, capacity):
    used, pieces = Counter(), defaultdict(list)
    for key, piece, start, size, container in placed:
        used[container] += size
        pieces[key].append((piece, start, size))
    assert max(used.values(), default=0) <= capacity
    want = Counter()
    for key, n in rows:
        want[key] += max(0, n or 0)
    assert {k: sum(s for _, _, s in p) for k, p in pieces.items()} == dict(want)
    assert sorted(used) == list(range(len(used))) or set(used) <= set(range(max(used) + 1))
    return used


def test_packing_keeps_every_piece(spark):
    rng = random.Random(2)
    rows = [(k, rng.choice([0, None, -3, 1, 7, 50, 99, 100, 101, 250, rng.randint(1, 100)])) for k in range(400)] + [(k, 60) for k in range(1000, 1300)]
    df = spark.createDataFrame([(k, n, "c") for k, n in rows], "id long, n long, container string")
    for salts in (1_000_000, 50):
        placed = [tuple(r) for r in packing.pack(df, "id", "n", 100, salts).collect()]
        used = check_packing(rows, placed, 100)
        for key, n in rows:
            mine = sorted((p, s, z) for k, p, s, z, _ in placed if k == key)
            assert len(mine) == max(1, -(-max(0, n or 0) // 100)) and [s for _, s, _ in mine] == [100 * i for i in range(len(mine))]
        small = sum(max(0, n or 0) for _, n in rows)
        assert len(used) <= 1.4 * small / 100 + 1


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 50), max_size=12))
def test_plan_is_a_packing_no_worse_than_first_fit(sizes):
    intervals, n = packing.plan_best_fit(sizes, 30)
    used, seen = Counter(), Counter()
    for size, rank, items, first, each, _ in intervals:
        assert rank == seen[size]
        seen[size] += items
        for r in range(items):
            used[first + r // each] += size
    assert seen == Counter(sizes) and max(used.values(), default=0) <= 30 and len(used) == n
    bins = []
    for s in sorted((s for s, c in sizes.items() for _ in range(c)), reverse=True):
        k = next((i for i, b in enumerate(bins) if b + s <= 30), None)
        if k is None:
            bins.append(s)
        else:
            bins[k] += s
    assert n <= len(bins) * 11 / 9 + 1


def test_documents_fill_containers(spark, data):
    r = QUERIES["p7_fill"](spark, data).first()
    assert r.fullest <= 2048 and r.containers <= -(-r.tokens // 2048) * 1.03 + 2


PROSE = "We look for someone who is patient with newcomers and likes to work with numbers. The role is based at our office, with four days a week on site. "
PAGES = {
    1: (PROSE * 6, False), 2: ("jobs careers salary hiring vacancies urgent apply " * 20, True), 3: (PROSE * 2 + "\n" + "data, analyst, jobs, hiring, salary, urgent, " * 20, True), 4: (PROSE * 8 + "\n" + "data, analyst, jobs, hiring, " * 5, False),
    5: ("\n".join(f"Analyst {i} https://a{i}.example/jobs/{i}" for i in range(40)), True), 6: (" > ".join(["Home", "Jobs", "Data Analyst", "Oakturn", "Help"] * 12), True), 7: ("", False), 8: (None, False), 9: ("  \n ", False), 10: ("Home | Jobs | Help", False),
    11: ("Wir suchen jemanden, der die Verträge betreut. Sie planen die Touren bis zum Monatsende. " * 6, False), 12: ("If you want nurse jobs then nurse jobs at Oakturn is nurse jobs for you, nurse jobs. " * 8, True), 13: ("u.r.g.e.n.t j.o.b.s h.i.r.i.n.g " * 20, True),
    14: ("\n".join(f"{w} in Oakturn" for w in ["Analyst", "Nurse", "Clerk", "Dev"] * 8), True), 15: ("研修は最初の一か月に行われます。" * 20, False), 16: ("word " * 100_000, True), 17: ('{"title": "Dev", "content": "' + PROSE * 4 + '"}', False),
}


@pytest.mark.parametrize("key", sorted(PAGES))
def test_listed_share(key):
    text, spam = PAGES[key]
    listed, total, _ = stuffing.listed_words(text or "")
    assert (listed > 0.5 * total and listed >= 20) == spam


def test_stuffed_pages(spark):
    rows = [(k, t, "en", "clash") for k, (t, _) in PAGES.items()] + [(100 + i, PROSE * (i % 5 + 1) + f"Number {i} helps.", ["en", None, "EN"][i % 3], "x") for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, words string")
    # page 10 is a menu of a few words: there is no least number of them
    assert {r.doc_id for r in stuffing.stuffed_pages(df).collect()} == {10} | {k for k, (_, spam) in PAGES.items() if spam}
    assert stuffing.stuffed_pages(df.limit(0)).count() == 0


def test_list_pages_that_are_the_rule_in_their_group(spark):
    copies = [(k, "jobs careers salary hiring vacancies urgent apply " * 20, "en") for k in range(60)]
    tags = [(100 + k, " ".join(f"#tag{k}x{i}" for i in range(40)), "fr") for k in range(60)]
    prose = [(200 + k, PROSE * 4 + f"Number {k} helps.", "en") for k in range(40)]
    df = spark.createDataFrame(copies + tags + prose, "doc_id long, text string, lang string")
    found = stuffing.stuffed_pages(df).collect()
    assert {r.doc_id for r in found} == {*range(60), *range(100, 160)}
    only = stuffing.stuffed_pages(df.where("doc_id < 200")).collect()
    assert len(only) == 120


def test_curves_nominate_few_prose_pages(spark, data):
    """Far fewer pages than there are stand out, and all but a few of those that the check alone finds are among them."""
    df = spark.read.parquet(f"{data}/documents.parquet")
    texts = df.select(F.col("doc_id").cast("string").alias("id"), "text").withColumn("key", F.xxhash64("text"))
    curves = stuffing.page_curves(df, "text", "lang")
    keys = {r[0] for r in stuffing.nominate(curves, texts).select("key").collect()}
    rows = texts.collect()
    listed = {r["key"] for r in rows if r["text"] and (n := stuffing.listed_words(r["text"]))[0] > 0.5 * n[1]}
    # of few pages many lengths have no reference: all of these are nominated
    assert len(keys) < 0.6 * curves.count() and len(listed & keys) >= 0.95 * len(listed)


def test_bounds_are_those_of_all_prose_pages(spark):
    """More different prose texts than the 4,000 that bounds were once read from: the ranks are over every one of them."""
    n = 5000
    stats = [(k, 40, 5, k / n, -1 - k / n, k / n) for k in range(n)] + [(n + k, 40, 5, 5.0, 0.0, 5.0) for k in range(n)]
    curves = spark.createDataFrame(stats, "key long, words int, size int, divergence double, slope double, residual double")
    labels = spark.createDataFrame([(str(k), k % (2 * n), 30 if k % (2 * n) >= n else 20, 40) for k in range(3 * n)], "id string, key long, listed int, words int")
    (bound,) = stuffing.prose_bounds(curves, labels, 0.5, 0.9, 0.01, 10).collect()
    assert [round(v * stuffing.GRID, 4) for v in (bound.far, bound.steep, bound.flat, bound.rough)] == [0.8998, -1.99, -1.01, 0.9898]
    got = {r.key for r in stuffing.extreme(curves, labels).collect()}
    # beyond nine tenths in divergence (which holds the steepest and the roughest), and the flattest hundredth
    assert got == {*range(n, 2 * n), *range(4499, n), *range(50)}


def test_a_rare_length_is_judged_by_all_its_pages(spark):
    """Twelve prose pages of a length among thousands of others are a reference; a part of them would be too few."""
    texts = spark.createDataFrame([(str(k), k, f"This is number {k} and it is the one that we have.") for k in range(6012)], "id string, key long, text string")
    stats = [(k, 40, 5 if k < 6000 else 8, k / 1e3, -1.0, 0.1) for k in range(6012)]
    curves = spark.createDataFrame(stats, "key long, words int, size int, divergence double, slope double, residual double")
    got = {r.key for r in stuffing.nominate(curves, texts).collect()}
    assert got == {*range(5399, 6000), *range(6009, 6012)}


def test_short_list_pages_are_found(spark, tmp_path):
    rows = [(1, " ".join(f"#tag{k}" for k in range(15)), "en"), (2, "Home | Jobs | Help", "en"), (3, PROSE, "en"), (4, " ", "en")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id for r in QUERIES["p8_found"](spark, str(tmp_path)).collect()} == {1, 2}


def test_curve_of_a_known_page(spark):
    import numpy as np

    text = "a a a a a a a a b b b b c c d d e f g h"
    row = stuffing.page_curves(spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string"), "text", "lang").first()
    x, y = np.log([1.0, 2.0, 3.5, 6.5]), np.log([8, 4, 2, 1])
    slope, offset = np.polyfit(x, y, 1)
    assert row.slope == pytest.approx(slope) and row.residual == pytest.approx(np.sqrt(np.mean((y - slope * x - offset) ** 2)))


def test_round_trip_against_sql(spark, data):
    assert compare(spark, QUERIES["p6_roundtrip"], SQL["p6_roundtrip"], data) == ""


def test_queries_give_what_they_state(spark, data):
    from rolemill.llm import catalog

    columns = {"p1_found": ["name_a", "name_b"], "p2_found": ["job_a", "job_b"], "p3_found": ["group_id", "description_job_id", "seen_job_id", "source_job_id"], "p4_found": ["job_id", "field", "raw_value", "term_id"], "p5_found": ["job_a", "job_b"], "p6_ids": ["doc_id", "ids"], "p8_found": ["doc_id"]}
    for name, cols in columns.items():
        df = catalog.QUERIES[name](spark, data)
        assert df.columns == cols
        if name != "p6_ids":
            assert df.count() == df.distinct().count()
