"""The k most similar vectors of every vector, by score-aware quantisation and exact reranking.

Method: vectors are scaled to length 1, so cosine is an inner product. A coarse quantiser (spherical k-means on a
bounded sample) puts every vector into a cell; every vector is indexed, whatever the sample held. Within a cell, vectors
are scanned by four-bit codes: a product quantiser of 16 codewords for every two dimensions whose training and
assignment minimise the anisotropic loss h_par |r_par|^2 + h_orth |r_orth|^2, which penalises the residual parallel to
the vector (the part that moves large inner products) more than the rest; the weight follows from the similarity that
counts. A query's lookup tables are added up over the codes, two at a byte, and whatever may reach the threshold goes
to an exact rerank with the vectors themselves, in the same task.

The scan loses nothing: a code's error is known when it is made. With x' the coded vector, p the part of x - x' along x
and o the length of the rest, a query whose cosine with x is at least s scores at least s (1 - p) - sqrt(1 - s^2) o by the
code, so what scores less is ruled out for certain, and everything else is reranked exactly.

A query visits its nearest cells. How many is measured on the sample: as many as find ``coverage`` of the sample's own
neighbours (at most ``most_probes``). A cell with more than ``cell_rows`` rows, as when a third of all vectors are close
together, is cut into parts that are scanned by separate tasks; its queries visit all of them, so nothing is dropped. A
query has at most k rows from each part it visited, and the last step keeps the k best.

Vectors travel under numbers in the order of their keys, so that ties go to the smaller key without long keys on the way.

The cells are fitted on at most ``sample`` vectors and the codebooks on at most 8,192 of them, both drawn by a hash of
the id: documented bounds; the recall is measured against brute force (README). Ties in similarity go to the smaller key. Unusable vectors (null, of another size, not finite, all zero) are
neither queries nor answers. Equal vectors are each other's neighbours. Keys are taken as unique; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rolemill.session import materialize

SAMPLE = 20_000
BOOK_SAMPLE = 8_192
PROBE_SAMPLE = 2_000
#: More weight on the parallel residual than this makes the bound worse, as the rest grows.
MOST_WEIGHT = 8.0
CELL_ROWS = 6_000
SUB, WORDS = 2, 16


def usable(col: str, dim: int) -> Column:
    """dim finite numbers that are not all zero."""
    c = F.col(col)
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(c) == dim) & finite & F.exists(c, lambda x: x != 0), F.lit(False))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def _vectors(col: pa.Array) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    n = len(col)
    return np.asarray(col.flatten(), np.float32).reshape(n, -1) if n else np.empty((0, 0), np.float32)


def fit_cells(x: np.ndarray, cells: int, rounds: int = 6, seed: int = 7) -> np.ndarray:
    """Spherical k-means."""
    rng = np.random.default_rng(seed)
    centers = x[rng.choice(len(x), min(cells, len(x)), replace=False)].copy()
    for _ in range(rounds):
        best = np.concatenate([np.argmax(x[i : i + 4096] @ centers.T, axis=1) for i in range(0, len(x), 4096)])
        sums = np.zeros_like(centers)
        np.add.at(sums, best, x)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centers = np.where(norm > 0, sums / np.maximum(norm, 1e-9), centers).astype(np.float32)
    return centers


def merge_cells(centers: np.ndarray, least: float) -> np.ndarray:
    """Without centers that are as close to another as neighbours are: a dense place is one cell, which is then cut into
    parts that its queries all visit, rather than many cells of which they would visit a few."""
    kept: list[int] = []
    for k in range(len(centers)):
        if not kept or float(np.max(centers[kept] @ centers[k])) < least:
            kept.append(k)
    return centers[kept]


def anisotropic_weight(threshold: float, dim: int) -> float:
    """How much more a unit of parallel residual costs than one of orthogonal residual (at most MOST_WEIGHT)."""
    t2 = min(threshold, 0.999) ** 2
    return min(MOST_WEIGHT, max(1.0, (dim - 1) * t2 / (1 - t2)))


def _costs(part: np.ndarray, words: np.ndarray, rest: np.ndarray, eta: float) -> np.ndarray:
    """Loss of each codeword for a part of the (unit) vectors, given what the other parts add to the parallel residual."""
    diff = part[:, None, :] - words[None]
    along = np.einsum("nd,nwd->nw", part, diff) + rest[:, None]
    return (eta - 1) * along**2 + np.einsum("nwd,nwd->nw", diff, diff)


def encode(x: np.ndarray, books: np.ndarray, eta: float, rounds: int = 2) -> np.ndarray:
    """Codes (n x parts) by coordinate descent on the anisotropic loss."""
    n, parts = len(x), books.shape[0]
    p = x.reshape(n, parts, SUB)
    codes = np.empty((n, parts), np.uint8)
    along = np.zeros((n, parts), np.float32)
    for m in range(parts):
        diff = p[:, m, None, :] - books[m][None]
        codes[:, m] = np.argmin(np.einsum("nwd,nwd->nw", diff, diff), axis=1)
        along[:, m] = np.einsum("nd,nd->n", p[:, m], p[:, m] - books[m][codes[:, m]])
    for _ in range(rounds):
        total = along.sum(axis=1)
        for m in range(parts):
            rest = total - along[:, m]
            codes[:, m] = np.argmin(_costs(p[:, m], books[m], rest, eta), axis=1)
            along[:, m] = np.einsum("nd,nd->n", p[:, m], p[:, m] - books[m][codes[:, m]])
            total = rest + along[:, m]
    return codes


def fit_books(x: np.ndarray, eta: float, rounds: int = 4, seed: int = 7) -> np.ndarray:
    """Codebooks (parts x 16 x 2): alternating assignment and weighted least squares for the anisotropic loss."""
    rng = np.random.default_rng(seed)
    n, dim = x.shape
    parts = dim // SUB
    p = x.reshape(n, parts, SUB)
    books = np.stack([p[rng.choice(n, WORDS, replace=n < WORDS), m] for m in range(parts)]).astype(np.float32)
    for r in range(rounds):
        codes = encode(x, books, eta if r else 1.0, 1)
        for m in range(parts):
            along = np.einsum("npd,npd->np", p, p - np.stack([books[k][codes[:, k]] for k in range(parts)], axis=1)) if m == 0 else along
            rest = along.sum(axis=1) - along[:, m]
            for w in range(WORDS):
                mine = codes[:, m] == w
                if mine.sum() < 2:
                    continue
                v, e = p[mine, m].astype(np.float64), rest[mine].astype(np.float64)
                left = (eta - 1) * v.T @ v + np.eye(SUB) * len(v)
                right = (eta - 1) * v.T @ ((v * v).sum(axis=1) + e) + v.sum(axis=0)
                books[m, w] = np.linalg.solve(left, right)
            along[:, m] = np.einsum("nd,nd->n", p[:, m], p[:, m] - books[m][codes[:, m]])
    return books


def _pair_tables(q: np.ndarray, books: np.ndarray) -> np.ndarray:
    """queries x bytes x 256: the inner products of every pair of four-bit codewords."""
    parts = books.shape[0]
    one = np.einsum("qmd,mwd->qmw", q.reshape(len(q), parts, SUB), books)
    return (one[:, 0::2, :, None] + one[:, 1::2, None, :]).reshape(len(q), parts // 2, WORDS * WORDS)


def score_bound(x: np.ndarray, codes: np.ndarray, books: np.ndarray, least: float) -> np.ndarray:
    """What the code of each vector scores at least with a query whose cosine with the vector is ``least`` or more."""
    coded = np.stack([books[m][codes[:, m]] for m in range(books.shape[0])], axis=1).reshape(x.shape)
    rest = x.astype(np.float64) - coded
    along = np.einsum("nd,nd->n", rest, x)
    across = np.sqrt(np.maximum(0.0, np.einsum("nd,nd->n", rest, rest) - along**2))
    return least * (1 - along) - np.sqrt(1 - min(1.0, least) ** 2) * across - 1e-4


def _scan(members: dict, queries: dict, k: int, least: float, books: np.ndarray, eta: float) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query, answer, similarity) index arrays: the k best of the members at or above ``least`` for every query."""
    x = members["x"]
    codes = encode(x, books, eta)
    need = score_bound(x, codes, books, least).astype(np.float32)
    packed = (codes[:, 0::2].astype(np.int64) * WORDS + codes[:, 1::2]).T.copy()
    mid, qid, wide, out = members["id"], queries["id"], None, []
    for start in range(0, len(qid), 256):
        q = queries["x"][start : start + 256]
        tables = _pair_tables(q, books)
        score = np.zeros((len(q), packed.shape[1]), np.float32)
        for m in range(packed.shape[0]):
            score += np.take(tables[:, m], packed[m], axis=1)
        may = (score >= need[None]) & (qid[start : start + 256, None] != mid[None])
        if may.mean() > 0.02:
            # so many are reranked at once
            wide = x.astype(np.float64) if wide is None else wide
            exact = np.where(may, np.round(q.astype(np.float64) @ wide.T, 12), -2.0)
            floor = np.partition(exact, -k, axis=1)[:, -k] if exact.shape[1] > k else np.full(len(q), -2.0)
            row, col = np.nonzero(exact >= np.maximum(floor, least - 1e-6)[:, None])
            exact = exact[row, col]
        else:
            row, col = np.nonzero(may)
            exact = np.round(np.einsum("nd,nd->n", q[row].astype(np.float64), x[col].astype(np.float64)), 12)
            ok = exact >= least - 1e-6
            row, col, exact = row[ok], col[ok], exact[ok]
        if not len(row):
            continue
        order = np.lexsort((col, -exact, row))
        row, col, exact = row[order], col[order], exact[order]
        first = np.concatenate([[True], row[1:] != row[:-1]])
        rank = np.arange(len(row)) - np.maximum.accumulate(np.where(first, np.arange(len(row)), 0))
        # members come sorted by key, so equal similarities are in the order of the keys
        top = rank < k
        out.append((row[top] + start, col[top], exact[top]))
    return out


def needed_probes(fit: np.ndarray, centers: np.ndarray, k: int, least: float, coverage: float, most: int) -> int:
    """The number of nearest cells in which ``coverage`` of the sample's k nearest neighbours are at home; 3 at least."""
    home = np.concatenate([np.argmax(fit[i : i + 4096] @ centers.T, axis=1) for i in range(0, len(fit), 4096)])
    ranks = []
    for start in range(0, min(PROBE_SAMPLE, len(fit)), 256):
        q = fit[start : min(start + 256, PROBE_SAMPLE)]
        sim = q @ fit.T
        sim[np.arange(len(q)), start + np.arange(len(q))] = -2
        few = min(k, len(fit) - 1)
        if few < 1:
            break
        near = np.argpartition(-sim, few - 1, axis=1)[:, :few]
        row, col = np.nonzero(np.take_along_axis(sim, near, axis=1) >= least)
        to = q @ centers.T
        ranks.append((to[row] > to[row, home[near[row, col]]][:, None]).sum(axis=1) + 1)
    found = np.concatenate(ranks) if ranks else np.empty(0, np.int64)
    return int(min(most, len(centers), max(3, np.quantile(found, coverage, method="higher") if len(found) else 3)))


def nearest_numbers(df: DataFrame, id_col: str, vec_col: str, dim: int, k: int, least: float, coverage: float = 0.9995, most_probes: int = 16, sample: int = SAMPLE, cell_rows: int = CELL_ROWS) -> tuple[DataFrame, DataFrame]:
    """(a, b, rank, similarity) by number, and (number, id): what ``nearest`` gives, before ids are put in. Numbers are in
    the order of the ids."""
    spark = df.sparkSession
    source = df.where(usable(vec_col, dim)).select(F.col(id_col).cast("string").alias("id"), F.col(vec_col).cast("array<float>").alias("x"))

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                u = _unit(_vectors(b.column(1)))
                yield pa.record_batch([b.column(0), pa.array([r.tobytes() for r in u], pa.binary())], names=["id", "x"])

    ordered = source.mapInArrow(scale, "id string, x binary").repartitionByRange("id").sortWithinPartitions("id")
    units = materialize(ordered.withColumn("n", F.monotonically_increasing_id()), "units")
    names = units.select(F.col("n").alias("number"), "id")
    n = units.count()
    # the filter leaves fewer than 2 * sample rows; what is cut then, here and for the books, is cut by another hash of the id
    some = units.where(F.pmod(F.xxhash64("id"), F.lit(max(1, n // sample))) == 0).orderBy(F.xxhash64("id", F.lit(2)), "id").limit(sample).select("x").toArrow()
    fit = np.frombuffer(b"".join(some.column("x").to_pylist()), np.float32).reshape(-1, dim).copy()
    if not len(fit):
        return spark.createDataFrame([], "a bigint, b bigint, rank int, similarity double"), names
    cells = int(max(1, min(2048, round(n**0.5), len(fit) // 8)))
    centers = merge_cells(fit_cells(fit, cells), least)
    eta = anisotropic_weight(least, dim)
    books = fit_books(fit[:BOOK_SAMPLE], eta)
    probes = needed_probes(fit, centers, k, least, coverage, most_probes)
    # model: at most 2048 x dim + 512 x dim numbers
    model = spark.sparkContext.broadcast((centers, books))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for every cell that a vector visits; home marks the nearest, which also holds it."""
        c, _ = model.value
        take = min(probes, len(c))
        for b in batches:
            if not b.num_rows:
                continue
            x = np.frombuffer(b"".join(b.column(1).to_pylist()), np.float32).reshape(b.num_rows, dim)
            sim = x @ c.T
            best = np.argpartition(-sim, take - 1, axis=1)[:, :take] if take < len(c) else np.tile(np.arange(take), (len(x), 1))
            home = best == np.argmax(sim, axis=1)[:, None]
            rows = pa.array(np.repeat(np.arange(b.num_rows), take))
            yield pa.record_batch([b.column(0).take(rows), b.column(1).take(rows), pa.array(best.ravel().astype(np.int32)), pa.array(home.ravel())], names=["id", "x", "cell", "home"])

    visits = units.select(F.col("n").alias("id"), "x").mapInArrow(visit, "id bigint, x binary, cell int, home boolean")
    # at most 2048 rows; a hot cell is a grid of member parts and query parts, so both sides of a task are bounded
    sizes = visits.groupBy("cell").agg(F.count_if("home").alias("held"), F.count("*").alias("visits")).collect()
    grid = [(r["cell"], max(1, -(-r["held"] // cell_rows)), max(1, -(-r["visits"] // (4 * cell_rows)))) for r in sizes]
    visits = visits.join(F.broadcast(spark.createDataFrame(grid, "cell int, m_parts int, q_parts int")), "cell")
    m_part, q_part = F.pmod(F.xxhash64("id"), F.col("m_parts")).cast("int"), F.pmod(F.xxhash64("id", F.lit(1)), F.col("q_parts")).cast("int")
    spots = lambda to: F.sequence(F.lit(0), F.col(to) - 1)
    members = visits.where("home").select("cell", m_part.alias("m_part"), F.explode(spots("q_parts")).alias("q_part"), F.lit(1).alias("role"), "id", "x")
    queries = visits.select("cell", F.explode(spots("m_parts")).alias("m_part"), q_part.alias("q_part"), F.lit(0).alias("role"), "id", "x")
    rows = members.union(queries)

    def scan(table: pa.Table) -> pa.Table:
        _, b = model.value
        role = np.asarray(table.column("role"))
        table = table.take(pa.array(np.lexsort((np.arange(len(role)), -role))))
        role = np.asarray(table.column("role"))
        key = np.asarray(table.column("id"))
        x = np.frombuffer(b"".join(table.column("x").to_pylist()), np.float32).reshape(len(role), dim)
        split = int((role == 1).sum())
        order = np.argsort(key[:split], kind="stable")
        got = _scan({"id": key[:split][order], "x": x[:split][order]}, {"id": key[split:], "x": x[split:]}, k, least, b, eta) if 0 < split < len(role) else []
        row, col, sim = (np.concatenate(z) for z in zip(*got)) if got else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        return pa.table({"a": pa.array(key[split:][row], pa.int64()), "b": pa.array(key[:split][order[col]], pa.int64()), "similarity": pa.array(sim, pa.float64())})

    local = rows.groupBy("cell", "m_part", "q_part").applyInArrow(scan, "a bigint, b bigint, similarity double")
    ranked = local.withColumn("rank", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("similarity"), "b")))
    return ranked.where((F.col("rank") <= k) & (F.col("similarity") >= least)).select("a", "b", "rank", "similarity"), names


def named(pairs: DataFrame, names: DataFrame) -> DataFrame:
    """The ids of the numbers a and b put in."""
    of = lambda end: names.select(F.col("number").alias(end), F.col("id").alias(f"id_{end}"))
    rest = [c for c in pairs.columns if c not in ("a", "b")]
    return pairs.join(of("a"), "a").join(of("b"), "b").select(F.col("id_a").alias("a"), F.col("id_b").alias("b"), *rest)


def nearest(df: DataFrame, id_col: str, vec_col: str, dim: int, k: int, least: float, **more) -> DataFrame:
    """(a, b, rank, similarity): for every usable row a its k most similar rows b, as far as similarity >= least.

    similarity is the cosine of the vectors as stored, in double precision up to float rounding of the scaled vectors.
    """
    return named(*nearest_numbers(df, id_col, vec_col, dim, k, least, **more))
