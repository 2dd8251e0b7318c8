from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from rolemill.llm import neardup, survivor
from rolemill.llm.queries_dedup import QUERIES, SQL
from tests.compare import compare


def model(texts, width, threshold):
    sets = {}
    for k, t in texts.items():
        w = re.findall("[a-z0-9]+", (t or "").lower())
        if s := set(zip(*(w[i:] for i in range(width)))):
            sets[k] = s
    return {(a, b) for a, b in combinations(sorted(sets), 2) if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])}


def corpus(seed, n=40):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = {}
    for i in range(n):
        if i and rng.random() < 0.6:
            base = (rng.choice(list(texts.values())) or "").split()
            for _ in range(rng.randint(0, max(1, len(base) // 12))):
                k = rng.randrange(len(base) + 1)
                base[k : k + rng.randint(0, 1)] = [rng.choice(words)] * rng.randint(0, 1)
            texts[f"d{i:03}"] = " ".join(base)
        else:
            texts[f"d{i:03}"] = " ".join(rng.choice(words) for _ in range(rng.randint(5, 260)))
    return texts | {"e": "", "n": None, "s": "one two", "r1": "Same text here, again.", "r2": "same TEXT here again"}


@pytest.mark.parametrize("seed,width,threshold", [(1, 3, 0.6), (2, 3, 0.6), (3, 5, 0.8), (4, 2, 0.7)])
def test_pairs_equal_brute_force(spark, seed, width, threshold):
    texts = corpus(seed)
    df = spark.createDataFrame([(k, t, "clash") for k, t in texts.items()], "key string, text string, class string")
    members, links = neardup.near_duplicates(df, "key", F.col("text"), threshold, width)
    found = [tuple(r) for r in neardup.expand_pairs(members, links).collect()]
    assert len(found) == len(set(found)) and set(found) == model(texts, width, threshold)
    assert all(a < b and s >= threshold for a, b, s in links.collect())


def test_copies_are_one_class(spark):
    text = " ".join(f"t{i}" for i in range(50))
    df = spark.createDataFrame([(f"c{i:03}", text) for i in range(300)] + [("x", text + " tail")], "key string, text string")
    members, links = neardup.near_duplicates(df, "key", F.col("text"), 0.8, 5)
    assert {r["class"] for r in members.where("id <> 'x'").collect()} == {"c000"} and [tuple(r)[:2] for r in links.collect()] == [("c000", "x")]


def test_no_rows_and_long_texts(spark):
    empty = spark.createDataFrame([], "key string, text string")
    members, links = neardup.near_duplicates(empty, "key", F.col("text"))
    assert members.count() == 0 and links.count() == 0
    long = " ".join(f"v{i}" for i in range(60_000))
    df = spark.createDataFrame([("a", long), ("b", long + " more")], "key string, text string")
    assert [tuple(r)[:2] for r in neardup.near_duplicates(df, "key", F.col("text"))[1].collect()] == [("a", "b")]


def test_sketch_distance_never_exceeds_the_difference():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a = set(rng.integers(0, 500, 200).tolist())
        b = set(list(a)[: rng.integers(1, 150)]) | set(rng.integers(0, 500, 60).tolist())
        sizes = [len(a), len(b)]
        bits, words = neardup._sketches(np.repeat([0, 1], sizes), np.array([*sorted(a), *sorted(b)], np.uint64), np.array(sizes))
        x, y = bits[: words[0]].view(np.uint64), bits[words[0] :].view(np.uint64)
        while len(x) != len(y):
            longer = x if len(x) > len(y) else y
            folded = longer[: len(longer) // 2] ^ longer[len(longer) // 2 :]
            x, y = (folded, y) if longer is x else (x, folded)
        assert 0 < int(np.bitwise_count(x ^ y).sum()) <= len(a ^ b)


def test_blocks_agree_where_nothing_differs():
    """A pair's agreeing blocks: many for one at the threshold, and every shared shingle where shingles are blocks."""
    rng = np.random.default_rng(2)
    for size in (30, 200, 700):
        shared = rng.integers(0, 1 << 50, size * 3 // 4).astype(np.uint64)
        sets = [np.unique(np.concatenate([shared, rng.integers(0, 1 << 50, size // 4).astype(np.uint64)])) for _ in range(2)]
        doc, h, n = np.repeat([0, 1], [len(x) for x in sets]), np.concatenate(sets), np.array([len(x) for x in sets])
        d, v = neardup._blocks(doc, h, n, 0.6, 4.5, False)
        assert len(np.intersect1d(v[d == 0], v[d == 1])) >= (2 if size > 60 else len(shared))
        d, v = neardup._blocks(doc, h, n, 0.6, 4.5, True)
        assert len(np.intersect1d(v[d == 0], v[d == 1])) >= len(shared)


@pytest.mark.parametrize("seed", [5, 6])
def test_exact_mode(spark, seed):
    texts = corpus(seed, 60)
    df = spark.createDataFrame(list(texts.items()), "key string, text string")
    members, links = neardup.near_duplicates(df, "key", F.col("text"), 0.5, 3, exact=True)
    assert {tuple(r) for r in neardup.expand_pairs(members, links).collect()} == model(texts, 3, 0.5)


def test_a_block_that_all_records_share(spark):
    """One long passage in every record: its blocks are hot, and no pair comes of them alone."""
    rng = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(120))
    texts = {f"h{i:03}": passage + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(120 if i % 9 else 20)) for i in range(150)}
    df = spark.createDataFrame(list(texts.items()), "key string, text string")
    members, links = neardup.near_duplicates(df, "key", F.col("text"), 0.6, 3)
    assert {tuple(r) for r in neardup.expand_pairs(members, links).collect()} == model(texts, 3, 0.6)


def test_hot_blocks_give_rows_and_the_others_pairs():
    """A block's pairs are counted up to a number of records; beyond it every record is a row, however batches are cut."""
    import pyarrow as pa

    groups = {3: [7], 8: [4, 4, 9], 10: [1, 2, 5], 13: [6, 8], 20: list(range(100, 900)), 30: list(range(5)), 32: [1, 1, 1, 1, 1, 1], 41: [2, 3, 4, 5]}
    rows = [(b, r) for b in sorted(groups) for r in groups[b]]
    kinds = {(neardup._PAIR, b % 2): neardup._SINGLE if b % 2 else neardup._PAIR for b in groups}
    want = {(neardup._HOT_ROW, r, b) for b in (20, 30) for r in groups[b]}
    want |= {(kinds[neardup._PAIR, b % 2], x, y) for b in groups if len(set(groups[b])) <= 4 for x, y in combinations(sorted(set(groups[b])), 2)}
    for size in (1, 2, 5, 64, 10_000):
        batches = [pa.record_batch([pa.array([x[k] for x in rows[i : i + size]], pa.int64()) for k in (0, 1)], names=["block", "same"]) for i in range(0, len(rows), size)]
        got = [(r["kind"], r["a"], r["b"]) for b in neardup._met(4)(iter(batches)) for r in b.to_pylist()]
        assert set(got) == want and len(got) == len(want)


@pytest.mark.parametrize("seed,hot,part", [(11, 1, 3), (12, 2, 10_000), (13, 4, 5)])
def test_pairs_of_hot_blocks_equal_brute_force(spark, monkeypatch, seed, hot, part):
    monkeypatch.setattr(neardup, "HOT", hot)
    monkeypatch.setattr(neardup, "PART", part)
    texts = corpus(seed, 60)
    df = spark.createDataFrame(list(texts.items()), "key string, text string")
    members, links = neardup.near_duplicates(df, "key", F.col("text"), 0.6, 3)
    found = [tuple(r) for r in neardup.expand_pairs(members, links).collect()]
    assert len(found) == len(set(found)) and set(found) == model(texts, 3, 0.6)


def test_bitmap_holds_every_id(spark):
    hashes = spark.range(5000).select(F.xxhash64("id"))
    bits, those = neardup.bitmap_of(hashes), np.array([r[0] for r in hashes.collect()], np.int64)
    assert neardup.in_bitmap(bits, those).all() and not neardup.in_bitmap(bits, those + 1).all()
    assert np.unpackbits(np.frombuffer(bits, np.uint8)).sum() <= 3 * 5000


def test_marked_rows_keep_all_that_are_asked_for(spark):
    df = spark.createDataFrame([(f"k{i}", None if i % 2 else ["x"], i) for i in range(3000)] + [(None, None, -1)], "key string, l array<string>, n int")
    got = {r.n for r in neardup.marked_rows(df, "key", df.where("n % 10 = 3").select("key")).collect()}
    assert {i for i in range(3000) if i % 10 == 3} <= got and len(got) < 1000
    assert neardup.marked_rows(df, "key", df.limit(0).select("key")).count() == 0


@pytest.mark.parametrize("name", ["p2_found", "p3_found"])
def test_against_sql(spark, data, name):
    assert compare(spark, QUERIES[name], SQL[name], data) == ""


def test_groups_over_hot_blocks_against_sql(spark, data, monkeypatch):
    """Every block that two records share is hot: no pair is counted, and the groups and their survivors are the same."""
    monkeypatch.setattr(neardup, "HOT", 1)
    assert compare(spark, QUERIES["p3_found"], SQL["p3_found"], data) == ""


def test_classes_cover_all_texts(spark, data):
    df = QUERIES["p2_classes"](spark, data)
    jobs = spark.read.parquet(f"{data}/jobs.parquet").where("length(job_description) >= 200")
    assert df.count() == jobs.count() == df.select("job_id").distinct().count()


def test_survivors_follow_the_ranking(spark):
    rows = [("g", "a", 5, 10), ("g", "b", 5, 12), ("g", "c", 7, None), ("h", "z", None, None), ("h", "y", None, None)]
    df = spark.createDataFrame(rows, "grp string, id string, n int, t int")
    got = {r.grp: (r.longest, r.latest) for r in survivor.select_survivors(df, "grp", "id", {"longest": [F.col("n"), F.col("t")], "latest": [F.col("t")]}).collect()}
    assert got == {"g": ("c", "b"), "h": ("y", "y")}


def test_consensus_takes_the_value_nearest_to_the_vote(spark):
    rows = [("g", v) for v in ["senior data engineer", "senior data engineer", "data engineer", "senior data enginer", "senior  engineer", None, " "]] + [("n", None), (None, "x")]
    df = spark.createDataFrame(rows, "grp string, title string")
    got = {r.grp: (r.title, r.support) for r in survivor.consensus(df, "grp", "title").collect()}
    assert got == {"g": ("senior data engineer", 2), "n": (None, 0)}


def test_consensus_in_blocks_agrees_on_a_clear_case(spark):
    rows = [("g", f"alpha beta gamma v{i}") for i in range(40)] + [("g", "alpha beta gamma")] * 5
    df = spark.createDataFrame(rows, "grp string, title string")
    assert survivor.consensus(df, "grp", "title", block=7).first().title == "alpha beta gamma"
    assert survivor.consensus(df.limit(0), "grp", "title").count() == 0


def test_alignment_votes_by_column():
    p = [survivor._profile_of(v, w) for v, w in (("a b c d", 2.0), ("a c d", 1.0), ("a b x d", 1.0))]
    assert survivor.vote(survivor.merge_profiles(p)) == ["a", "b", "c", "d"]
    assert survivor.token_distance("a b c".split(), "a c".split()) == 1


def test_long_values_align_as_in_the_whole_table(monkeypatch):
    rng = random.Random(5)
    base = [f"w{rng.randrange(150)}" for _ in range(400)]
    values = []
    for k in range(5):
        v = list(base)
        for i in rng.sample(range(1, 390), 25):
            v[i : i + rng.randint(0, 2)] = [f"x{k}y{i}"] * rng.randint(0, 2)
        values.append(v[60 * k :] if k == 4 else v)
    profiles = [survivor._profile_of(" ".join(v), 1.0) for v in values]
    results = []
    for band in (1, 32, 10_000):
        monkeypatch.setattr(survivor, "BAND", band)
        results.append(survivor.merge_profiles(profiles))
    assert results[0] == results[1] == results[2]
    voted = survivor.vote(results[0])
    assert survivor.token_distance(voted, base) < min(survivor.token_distance(v, base) for v in values)


def test_consensus_runs_over_descriptions_and_sources(spark, data):
    groups = {r.group_id: r for r in QUERIES["p3_consensus"](spark, data).collect()}
    assert groups.keys() == {r.group_id for r in QUERIES["p3_found"](spark, data).collect()}
    jobs = {r.job_id: r for r in spark.read.parquet(f"{data}/jobs.parquet").select("job_id", "job_description", "sources").collect()}
    texts = {r.job_description for r in jobs.values()}
    feeds = {s.split(":")[0].strip().lower() for r in jobs.values() for s in r.sources or [] if s}
    for r in groups.values():
        assert r.job_description in texts and r.description_support >= 1
        assert r.source in feeds if r.source_support else r.source is None
