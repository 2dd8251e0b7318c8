"""Reactions folded into profiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rolemill.operators.dedup import first_reactions
from rolemill.session import materialize

CAP, KEEP, TAKE = 100, 0.7, 0.3


def known_reactions(feedback: DataFrame) -> DataFrame:
    """like, dislike and applied whatever their case and outer blanks; the rest is dropped."""
    cleaned = feedback.withColumn("reaction", F.lower(F.trim("reaction")))
    return cleaned.where(F.col("reaction").isin("like", "dislike", "applied"))


def accepted_reactions(feedback: DataFrame, jobs: DataFrame) -> DataFrame:
    """First reaction per user and listing; a second one changes nothing, unknown listings are ignored."""
    return first_reactions(known_reactions(feedback)).join(jobs.select("job_id", "company_name"), "job_id")


def company_lists(feedback: DataFrame, jobs: DataFrame, cap: int = CAP) -> DataFrame:
    """(user_id, liked_companies, disliked_companies): the last ``cap`` of each, oldest first, repetitions kept.

    The window has a group limit: of a user's reactions no more than ``cap`` leave a partition, whatever their number.
    """
    marked = accepted_reactions(feedback, jobs).where(F.col("reaction").isin("like", "dislike"))
    newest = Window.partitionBy("user_id", "reaction").orderBy(F.desc("recorded_at"), F.desc("feedback_id"))
    last = marked.withColumn("rn", F.row_number().over(newest)).where(F.col("rn") <= cap)
    each = last.groupBy("user_id", "reaction").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("rn")).alias("k"), "company_name"))), lambda x: x["company_name"]).alias("names"))
    names = lambda r: F.coalesce(F.max(F.when(F.col("reaction") == r, F.col("names"))), F.array().cast("array<string>"))
    return each.groupBy("user_id").agg(names("like").alias("liked_companies"), names("dislike").alias("disliked_companies"))


def affinity(feedback: DataFrame, jobs: DataFrame, dim: int, keep: float = KEEP, take: float = TAKE, start: DataFrame | None = None) -> DataFrame:
    """(user_id, affinity, likes): the fold of liked vectors in order, first as it is, then normalize(keep * old + take * new).

    start: (user_id, affinity) that the fold goes on from, where it isn't null.

    Rows stream through in the order of user and time; of a user only the current vector is held, so a user with a
    third of all reactions needs no more memory than another. Vectors that are null, of another size or not finite
    don't count.
    """
    likes = accepted_reactions(feedback, jobs.select("job_id", "company_name")).where("reaction = 'like'").select("user_id", "job_id", "recorded_at", "feedback_id")
    vectors = jobs.where((F.size("embedding") == dim) & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x))).select("job_id", "embedding")
    rows = likes.join(vectors, "job_id").select("user_id", "recorded_at", "feedback_id", F.col("embedding").cast("array<double>").alias("embedding"), F.lit(1).alias("new"))
    if start is not None:
        old = start.where(F.size("affinity") == dim).select("user_id", F.lit(None).cast(rows.schema["recorded_at"].dataType).alias("recorded_at"), F.lit(None).cast(rows.schema["feedback_id"].dataType).alias("feedback_id"), F.col("affinity").cast("array<double>").alias("embedding"), F.lit(0).alias("new"))
        rows = rows.unionByName(old.join(likes.select("user_id").distinct(), "user_id", "left_semi"))
    rows = rows.repartition("user_id").sortWithinPartitions("user_id", "new", "recorded_at", "feedback_id").select("user_id", "embedding", "new")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        user, state, n, done = None, None, 0, []
        for b in batches:
            flat = np.asarray(b.column(1).flatten(), np.float64).reshape(b.num_rows, dim)
            for u, v, new in zip(b.column(0).to_pylist(), flat, b.column(2).to_pylist()):
                if u != user:
                    if n:
                        done.append((user, state.tolist(), n))
                    user, state, n = u, v, new
                    continue
                mixed = keep * state + take * v
                state, n = mixed / (np.linalg.norm(mixed) + 1e-9), n + 1
            if len(done) > 1000:
                yield pa.record_batch([pa.array(c) for c in zip(*done)], names=["user_id", "affinity", "likes"])
                done = []
        if n:
            done.append((user, state.tolist(), n))
        if done:
            yield pa.record_batch([pa.array(c) for c in zip(*done)], names=["user_id", "affinity", "likes"])

    return rows.mapInArrow(fold, "user_id string, affinity array<double>, likes bigint")


def apply_feedback(profiles: DataFrame, feedback: DataFrame, jobs: DataFrame, accepted: DataFrame | None = None, dim: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(profiles, accepted): the next profiles, and the reactions that have been folded into them.

    accepted holds (user_id, job_id) of all reactions of earlier runs; one that is there changes nothing, so a log that
    arrives twice, or a second reaction to a listing, has no effect. Lists go on from the stored ones, and so does the
    affinity where the profiles have that column and dim is given. A profile is made for users without one.
    """
    first = accepted_reactions(feedback, jobs)
    fresh = first if accepted is None else first.join(accepted.select("user_id", "job_id").distinct(), ["user_id", "job_id"], "left_anti")
    fresh = materialize(fresh.select("user_id", "job_id", "reaction", "recorded_at", "feedback_id"), "reactions")
    lists = company_lists(fresh, jobs).withColumnsRenamed({"liked_companies": "_l", "disliked_companies": "_d"})
    users = fresh.select("user_id").distinct()
    both = profiles.join(users.join(lists, "user_id", "left"), "user_id", "full_outer")
    none = F.array().cast("array<string>")
    tail = lambda old, new: F.slice(F.concat(F.coalesce(old, none), F.coalesce(new, none)), F.greatest(F.size(F.coalesce(old, none)) + F.size(F.coalesce(new, none)) - CAP + 1, F.lit(1)), CAP)
    out = both.withColumns({"liked_companies": tail(F.col("liked_companies"), F.col("_l")), "disliked_companies": tail(F.col("disliked_companies"), F.col("_d"))})
    if dim is not None and "affinity" in profiles.columns:
        moved = affinity(fresh, jobs, dim, start=profiles.select("user_id", "affinity")).select("user_id", F.col("affinity").alias("_a"))
        out = out.join(moved, "user_id", "left").withColumn("affinity", F.coalesce("_a", F.col("affinity").cast("array<double>")))
    keys = fresh.select("user_id", "job_id")
    return out.select(*profiles.columns), keys if accepted is None else accepted.select("user_id", "job_id").unionByName(keys)
