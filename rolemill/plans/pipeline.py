"""One run over the listing table: feeds merged, duplicates marked, gates checked, changes shipped and recorded."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rolemill.operators import dedup, gates, merge, sync
from rolemill.store import publish, read_current


@dataclass(frozen=True)
class Run:
    """What a run did: the version of the listings, the failed checks, the warnings, and how many rows were delivered and refused."""

    jobs_version: int
    failures: list[tuple]
    shipped: int
    refused: int = 0
    warnings: list[tuple] = field(default_factory=list)


def all_feeds(feeds: dict[str, DataFrame]) -> DataFrame:
    """The rows of several feeds as one delta with ``mode``: what a feed lacks is null; a listing of several feeds of one
    name counts once, the latest. Keys name a feed and how it is read: full_scope (what it doesn't show is stale) or specific."""
    parts = [df.withColumn("mode", F.lit(name.rpartition("/")[2])) for name, df in feeds.items()]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return merge.first_per_key(union, ["job_id"], [F.col("last_seen_at").desc_nulls_last(), F.col("mode"), F.col("source_repo")])


def feed_counts(delta: DataFrame, old: DataFrame) -> DataFrame:
    """(feed, mode, inserted, updated, unchanged) of a delta against the snapshot, by feed."""
    known = old.select("job_id", F.col("content_hash").alias("_was"), F.lit(True).alias("_known"))
    rows = delta.join(known, "job_id", "left")
    same = F.col("content_hash").eqNullSafe(F.col("_was"))
    new = F.col("_known").isNull()
    return rows.groupBy(F.substring_index("source_repo", ":", 1).alias("feed"), "mode").agg(F.count_if(new).alias("inserted"), F.count_if(~new & ~same).alias("updated"), F.count_if(~new & same).alias("unchanged"))


def run(spark: SparkSession, delta: DataFrame, warehouse: str, now: Column, seen: DataFrame | None = None, send: Callable[[], Callable[[list[Any]], int]] | None = None) -> Run:
    """Merge a delta into the snapshot of ``warehouse``, and ship what is due unless a gate fails.

    Tables: jobs, metrics (of the last run), shipment (what the last run sent), ledger (what was delivered, in which
    version) and watermark. Documents go through ``send`` (see ``sync.deliver``), inactive ones first; without it, the
    shipment table itself is the receiver. Only delivered rows are recorded, and the watermark moves after that.
    """
    old = read_current(spark, f"{warehouse}/jobs")
    delta = merge.first_per_key(delta, ["job_id"], [F.col("last_seen_at").desc()])
    jobs = delta if old is None else merge.merge(old, merge.carry_first_seen(delta, old), "job_id", merge.JOB_POLICIES).drop("action")
    if seen is not None:
        jobs = merge.mark_stale(jobs, seen).drop("tripped")
    version = publish(dedup.mark_url_duplicates(merge.carry_url(jobs, now)), f"{warehouse}/jobs")
    jobs = read_current(spark, f"{warehouse}/jobs")
    metrics, soft, prior = gates.health_metrics(jobs), gates.soft_metrics(jobs), read_current(spark, f"{warehouse}/metrics")
    failures = [tuple(r) for r in gates.gate_failures(metrics, prior).collect()]
    warnings = [] if prior is None else [tuple(r) for r in gates.gate_warnings(soft, prior).collect()]
    publish(gates.as_rows(metrics).union(gates.as_rows(soft)), f"{warehouse}/metrics")
    if failures:
        return Run(version, failures, 0, 0, warnings)
    ledger = read_current(spark, f"{warehouse}/ledger")
    if ledger is None:
        ledger = spark.createDataFrame([], "job_id string, content_hash string, synced_at timestamp_ntz")
    publish(sync.shipment(jobs, ledger), f"{warehouse}/shipment")
    sent = read_current(spark, f"{warehouse}/shipment")
    results = []
    for stream in ("inactive", "active"):  # one after the other
        due = sent.where(F.col("stream") == stream)
        done = due.select("job_id", F.lit(True).alias("delivered"), F.lit(200).alias("status"))
        if send is not None:
            done = sync.deliver(sync.documents(due.drop("stream", "turn")), send)
        publish(done, f"{warehouse}/results_{stream}")
        results.append(read_current(spark, f"{warehouse}/results_{stream}"))
    marks = read_current(spark, f"{warehouse}/watermark")
    stored = None if marks is None else marks.first()["watermark"]
    ledger, mark = sync.after_run(ledger, sent, results[1], now, stored)
    publish(ledger, f"{warehouse}/ledger")
    publish(mark, f"{warehouse}/watermark")
    totals = results[0].union(results[1]).agg(F.count_if("delivered").alias("ok"), F.count_if(~F.col("delivered")).alias("bad")).first()
    return Run(version, [], totals["ok"], totals["bad"], warnings)
