"""One surviving record for each group of duplicates.

``select_survivors`` picks, field by field, the record that supplies a value by an ordering (most complete, latest, most
trusted) with fully ordered ties: one aggregate with map-side combine, so a group may hold any share of the rows.

``consensus`` is the token-level method: the distinct values of a group, weighted by how many records carry them, are
aligned progressively (heaviest value first), each column of the alignment is voted by weight, and the existing value
closest to the voted consensus is emitted. It can't give the survivor of p3_found: that is defined by lengths, times
and trust, not by agreement, and the value nearest the consensus is rarely the longest. So p3_found ranks, and the
consensus has a query of its own (p3_consensus). Groups with more distinct values than ``block`` are aligned in blocks
whose consensus profiles are aligned again, level by level. Values may be whole descriptions: near copies stay close to
the diagonal, and only a band around it is filled.

Nulls: a null or blank value has no vote; a group with no value at all gives null. Ties go to the heavier, then the
smaller value by code point. Repeated rows vote again. Other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolemill.session import materialize

BLOCK = 48
#: Diagonals on either side that an alignment starts with.
BAND = 32
GAP, MISMATCH = -1.0, -1.2


def select_survivors(df: DataFrame, group_col: str, id_col: str, rankings: dict[str, list[Column]]) -> DataFrame:
    """(group, one column per ranking): the id that comes first; each ranking lists whole-number columns, larger is better.

    The caller puts tie-breaks into the list; what is still equal goes to the smaller id. Nulls rank last.
    """
    low = F.lit(-(1 << 62))
    keyed = df.select(group_col, id_col, *(F.coalesce(c.cast("bigint"), low).alias(f"_{name}_{k}") for name, cols in rankings.items() for k, c in enumerate(cols)))
    picks = [F.min_by(id_col, F.struct(*(-F.col(f"_{name}_{k}") for k in range(len(cols))), F.col(id_col))).alias(name) for name, cols in rankings.items()]
    return keyed.groupBy(group_col).agg(*picks)


def _fits(profile: list[dict[str, float]], tokens: list[dict[str, float]]) -> tuple[np.ndarray, np.ndarray, Callable[[int, int, int, int], np.ndarray]]:
    """What each column of the profile is worth at most, what it loses as a gap, and a function that gives the worth of a
    stretch of rows along a band of diagonals (cells outside the table are -inf)."""
    n, m = len(profile), len(tokens)
    at: dict[str, int] = {"": 0}
    for c in tokens:
        for t in c:
            at.setdefault(t, len(at))
    slots = max(sum(1 for t in c if t) for c in tokens)
    ids, share = np.zeros((max(1, slots), m), np.int64), np.zeros((max(1, slots), m))
    for j, c in enumerate(tokens):
        whole = sum(c.values()) or 1.0
        for k, (t, w) in enumerate((t, w) for t, w in c.items() if t):
            ids[k, j], share[k, j] = at[t], w / whole
    shares = [[(t, w / total) for t, w in c.items() if t] for c in profile for total in [sum(c.values()) or 1.0]]
    best = np.array([max((w for _, w in c), default=0.0) if slots <= 1 else sum(w for _, w in c) for c in shares])
    most = np.maximum(2 * best + MISMATCH * (1 - best), GAP)

    def rows(start: int, end: int, low: int, high: int) -> np.ndarray:
        have = np.zeros((end - start, len(at)))
        for i in range(start, end):
            for t, w in shares[i]:
                if (k := at.get(t)) is not None:
                    have[i - start, k] = w
        col = np.arange(start, end)[:, None] + np.arange(low, high + 1)[None]
        inside = (col >= 0) & (col < m)
        col = np.where(inside, col, 0)
        each = np.arange(end - start)[:, None]
        agree = sum(np.minimum(have[each, ids[k][col]], share[k][col]) for k in range(len(ids)))
        return np.where(inside, 2 * agree + MISMATCH * (1 - agree), -np.inf)

    return most, most - GAP, rows


def _steps(n: int, m: int, low: int, high: int, rows: Callable[[int, int, int, int], np.ndarray]) -> tuple[float, np.ndarray]:
    """Best score of the paths between two diagonals (column minus row), and the last step to every cell: 0 both, 1 row, 2 column."""
    width = high - low + 1
    ramp = -GAP * np.arange(width)
    column = np.arange(low, high + 1)
    last = np.where((column >= 0) & (column <= m), GAP * column, -np.inf)
    steps = np.empty((n, width), np.uint8)
    for start in range(0, n, 256):
        end = min(n, start + 256)
        both, down, score = rows(start, end, low, high), np.full((end - start, width), -np.inf), np.empty((end - start, width))
        for k in range(end - start):
            both[k] += last
            down[k, :-1] = last[1:] + GAP
            last = np.maximum.accumulate(np.maximum(both[k], down[k]) + ramp) - ramp
            score[k] = last
        near = score - 1e-9
        steps[start:end] = np.where(both >= near, 0, np.where(down >= near, 1, 2))
    return float(last[m - n - low]), steps


def _align(profile: list[dict[str, float]], tokens: list[dict[str, float]]) -> list[dict[str, float]]:
    """Global alignment of two profiles (a column is token -> weight); columns that match are added together.

    Only a band of diagonals is filled. It is doubled until no path that leaves it could reach the score found, so the
    result is that of the whole table. Of equally good steps the one that takes both columns goes first, then the profile's.
    """
    n, m = len(profile), len(tokens)
    steps, low, high = None, 0, 0
    if n and m:
        most, lost, rows = _fits(profile, tokens)
        lost = np.concatenate([[0.0], np.cumsum(np.sort(lost))])
        # a path that leaves the band has at least so many columns of the profile, and so many tokens, beside gaps
        reach = lambda ups, lefts: -np.inf if ups > n or lefts > m else most.sum() - lost[ups] + GAP * lefts
        half = BAND
        while True:
            low, high = max(-n, min(0, m - n) - half), min(m, max(0, m - n) + half)
            score, steps = _steps(n, m, low, high, rows)
            if score > 1e-9 + max(reach(1 - low, m - n + 1 - low), reach(high + 1 - m + n, high + 1)):
                break
            half *= 2
    weight = max((sum(c.values()) for c in tokens), default=1.0)
    before = max((sum(c.values()) for c in profile), default=1.0)
    out, i, j = [], n, m
    while i or j:
        step = steps[i - 1, j - i - low] if i and j else 1 if i else 2
        if step == 0:
            col = dict(profile[i - 1])
            for t, w in tokens[j - 1].items():
                col[t] = col.get(t, 0.0) + w
            i, j = i - 1, j - 1
        elif step == 1:
            col = dict(profile[i - 1])
            col[""] = col.get("", 0.0) + weight
            i -= 1
        else:
            col = dict(tokens[j - 1])
            col[""] = col.get("", 0.0) + before
            j -= 1
        out.append(col)
    return out[::-1]


def merge_profiles(profiles: list[list[dict[str, float]]]) -> list[dict[str, float]]:
    """Progressive alignment: the first profile takes up the others one after another."""
    whole = profiles[0]
    for p in profiles[1:]:
        whole = _align(whole, p)
    return whole


def vote(profile: list[dict[str, float]]) -> list[str]:
    """The heaviest token of every column; a gap that is heaviest drops the column; ties go to the smaller token."""
    best = [min(c, key=lambda t: (-c[t], t)) for c in profile]
    return [t for t in best if t]


def token_distance(a: list[str], b: list[str]) -> int:
    """Edit distance; a column of the table is two numbers of len(a) bits (where it rises and where it falls)."""
    if not a:
        return len(b)
    same: dict[str, int] = {}
    for k, t in enumerate(a):
        same[t] = same.get(t, 0) | 1 << k
    full, top = (1 << len(a)) - 1, 1 << len(a) - 1
    rise, fall, far = full, 0, len(a)
    for t in b:
        eq = same.get(t, 0)
        level = ((((eq & rise) + rise) ^ rise) | eq) & full
        up, down = fall | (full & ~(level | rise)), rise & level
        far += bool(up & top) - bool(down & top)
        up, down = (up << 1 | 1) & full, down << 1 & full
        rise, fall = down | (full & ~(eq | fall | up)), up & (eq | fall)
    return far


def _profile_of(value: str, weight: float) -> list[dict[str, float]]:
    return [{t: weight} for t in value.split()]


def _block_profiles(first: bool):
    """Rows (grp, w, profile) of one block to its profile; the first level holds the values themselves."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("w").to_pylist(), table.column("profile").to_pylist()), key=lambda r: (-r[0], r[1]))
        merged = merge_profiles([_profile_of(p, w) if first else json.loads(p) for w, p in rows])
        return pa.table({"grp": table.column("grp").slice(0, 1), "w": pa.array([sum(w for w, _ in rows)], pa.float64()), "profile": pa.array([json.dumps(merged)], pa.string())})

    return run


def consensus(df: DataFrame, group_col: str, value_col: str, block: int = BLOCK) -> DataFrame:
    """(group, value, support): the existing value closest to the group's voted consensus and how many records have it."""
    text = F.col(value_col).cast("string")
    rows = df.where(F.col(group_col).isNotNull()).select(F.col(group_col).alias("grp"), text.alias("v"))
    groups = rows.select("grp").distinct()
    weighed = materialize(rows.where(F.trim("v") != "").groupBy("grp", "v").agg(F.count("*").cast("double").alias("w")), "votes")
    kind = f"grp {df.schema[group_col].dataType.simpleString()}, w double, profile string"
    level, first = weighed.select("grp", "w", F.col("v").alias("profile")), True
    while True:
        counts = level.groupBy("grp").agg(F.count("*").alias("n"))
        most = counts.agg(F.max("n")).first()[0] or 0
        if most > block:
            level = level.join(counts, "grp").withColumn("block", F.pmod(F.xxhash64("profile"), 1 + F.floor(F.col("n") / block)))
        else:
            level = level.withColumn("block", F.lit(0))
        level = level.groupBy("grp", "block").applyInArrow(_block_profiles(first), kind)
        if most <= block:
            break
        level, first = materialize(level, "profiles"), False

    @F.pandas_udf("string")
    def voted(profile: pd.Series) -> pd.Series:
        return profile.map(lambda p: " ".join(vote(json.loads(p))))

    @F.pandas_udf("double")
    def distance(v: pd.Series, target: pd.Series) -> pd.Series:
        return pd.Series([float(token_distance(a.split(), t.split())) for a, t in zip(v, target)])

    near = weighed.join(level.select("grp", voted("profile").alias("target")), "grp").withColumn("d", distance("v", "target"))
    best = near.groupBy("grp").agg(F.min_by(F.struct("v", "w"), F.struct("d", -F.col("w"), F.col("v"))).alias("best"))
    return groups.join(best, "grp", "left").select(F.col("grp").alias(group_col), F.col("best.v").alias(value_col), F.coalesce(F.col("best.w").cast("bigint"), F.lit(0)).alias("support"))
