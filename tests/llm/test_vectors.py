from __future__ import annotations

import numpy as np
import pytest

from rolemill.llm import knn
from rolemill.llm.queries_vectors import QUERIES, SQL
from tests.compare import compare


def brute(ids, x, k, least):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T
    out = set()
    for i in range(len(ids)):
        order = sorted((j for j in range(len(ids)) if j != i and s[i, j] >= least), key=lambda j: (-round(s[i, j], 9), ids[j]))
        out |= {(ids[i], ids[j]) for j in order[:k]}
    return out


def clustered(n, seed=0, dim=64):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(max(2, n // 20), dim))
    x = centers[rng.integers(len(centers), size=n)] + 0.25 * rng.normal(size=(n, dim))
    return [f"v{i:05}" for i in range(n)], x * rng.uniform(0.1, 5, size=(n, 1))


def table(spark, ids, x):
    return spark.createDataFrame([(i, v.astype(float).tolist(), "clash") for i, v in zip(ids, x)], "key string, emb array<float>, cell string")


@pytest.mark.parametrize("cell_rows", [6000, 30])
def test_recall_against_brute_force(spark, cell_rows):
    ids, x = clustered(1500)
    got = {(r.a, r.b) for r in knn.nearest(table(spark, ids, x), "key", "emb", 64, 5, 0.9, cell_rows=cell_rows).collect()}
    want = brute(ids, x, 5, 0.9)
    assert len(got & want) >= 0.97 * len(want) and len(got & want) >= 0.97 * len(got)


def test_the_sample_covers_the_whole_table(spark, monkeypatch):
    ids, x = clustered(1500, 3)
    u, seen = knn._unit(x), {}
    for name in ("fit_cells", "fit_books"):
        fit = getattr(knn, name)
        monkeypatch.setattr(knn, name, lambda rows, *more, name=name, fit=fit: (seen.__setitem__(name, rows), fit(rows, *more))[1])
    monkeypatch.setattr(knn, "BOOK_SAMPLE", 300, raising=False)
    knn.nearest(table(spark, ids, x), "key", "emb", 64, 5, 0.9, sample=800)
    middle = np.median(u[:, 0])
    assert len(seen["fit_cells"]) == 800 and len(seen["fit_books"]) == 300
    for rows in seen.values():
        assert 0.4 < (rows[:, 0] < middle).mean() < 0.6


def test_a_third_in_one_place(spark):
    rng = np.random.default_rng(4)
    ids, x = clustered(600, 2)
    hot = rng.normal(size=64) + 0.15 * rng.normal(size=(300, 64))
    ids, x = ids + [f"h{i:04}" for i in range(300)], np.vstack([x, hot])
    got = {(r.a, r.b) for r in knn.nearest(table(spark, ids, x), "key", "emb", 64, 5, 0.9, cell_rows=40).collect()}
    want = {p for p in brute(ids, x, 5, 0.9) if p[0][0] == "h"}
    assert len(got & want) >= 0.95 * len(want)


def test_equal_vectors_and_ties(spark):
    x = np.zeros((8, 64))
    x[:, 0] = 2.0
    got = {}
    for r in knn.nearest(table(spark, list("abcdefgh"), x), "key", "emb", 64, 3, 0.9).collect():
        got.setdefault(r.a, {})[r.rank] = r.b
    assert got["a"] == {1: "b", 2: "c", 3: "d"} and got["h"] == {1: "a", 2: "b", 3: "c"}


def test_unusable_vectors(spark):
    good = [1.0] * 4
    rows = [("a", good), ("b", good), ("n", None), ("e", []), ("w", [1.0]), ("z", [0.0] * 4), ("nan", [1.0, float("nan"), 1.0, 1.0]), ("inf", [1.0, float("inf"), 1.0, 1.0]), ("null", [1.0, None, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "key string, emb array<float>")
    assert {(r.a, r.b) for r in knn.nearest(df, "key", "emb", 4, 5, 0.9).collect()} == {("a", "b"), ("b", "a")}
    assert knn.nearest(df.limit(0), "key", "emb", 4, 5, 0.9).count() == 0


def test_anisotropic_codes_keep_the_parallel_part_better():
    _, x = clustered(2000, 5)
    u = knn._unit(x)
    eta = knn.anisotropic_weight(0.9, 64)
    along = {}
    for name, weight in (("plain", 1.0), ("aware", eta)):
        books = knn.fit_books(u, weight)
        codes = knn.encode(u, books, weight)
        back = np.concatenate([books[m][codes[:, m]] for m in range(32)], axis=1)
        along[name] = np.abs(np.einsum("nd,nd->n", u - back, u)).mean()
    assert along["aware"] < 0.5 * along["plain"]


def test_scan_by_tables_equals_decoding():
    _, x = clustered(300, 6)
    u = knn._unit(x)
    books = knn.fit_books(u, 5.0)
    codes = knn.encode(u, books, 5.0)
    back = np.concatenate([books[m][codes[:, m]] for m in range(32)], axis=1)
    packed = codes[:, 0::2].astype(int) * 16 + codes[:, 1::2]
    tables = knn._pair_tables(u[:7], books)
    assert np.allclose(sum(tables[:, m][:, packed[:, m]] for m in range(16)), u[:7] @ back.T, atol=1e-4)


def test_against_sql(spark, data):
    assert compare(spark, QUERIES["p5_found"], SQL["p5_found"], data) == ""
