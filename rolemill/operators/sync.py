"""Incremental shipping: what to send, in which order, in which pieces."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolemill.functions.normalize import canonical_signature
from rolemill.operators.predicates import changed, shippable
from rolemill.session import materialize


def latest_ledger(ledger: DataFrame) -> DataFrame:
    """(job_id, content_hash, synced_at): the last delivery of every listing."""
    return ledger.groupBy("job_id").agg(F.max_by("content_hash", F.struct("synced_at", "content_hash")).alias("content_hash"), F.max("synced_at").alias("synced_at"))


def to_ship(jobs: DataFrame, ledger: DataFrame, since: Column | None = None) -> DataFrame:
    """Listings never shipped, shipped in another version, or embedded after ``since``."""
    sent = latest_ledger(ledger).select("job_id", F.col("content_hash").alias("_sent"), F.lit(True).alias("_known"))
    rows = jobs.join(sent, "job_id", "left")
    due = F.col("_known").isNull() | changed("content_hash", "_sent")
    if since is not None:
        due = due | F.coalesce(F.col("embedded_at") > since, F.lit(False))
    return rows.where(due).select(*jobs.columns)


def shipment(jobs: DataFrame, ledger: DataFrame, since: Column | None = None, with_inactive: bool = True) -> DataFrame:
    """What one run sends, with ``stream`` and ``turn``: rows that became inactive go before the active ones, so that a
    receiver never holds a withdrawn listing beside its successor. Active rows must be shippable and due; inactive ones
    must have been shipped before and go latest first."""
    live = to_ship(jobs.where(shippable("dead" in jobs.columns)), ledger, since).withColumns({"stream": F.lit("active"), "turn": F.lit(1)})
    if not with_inactive:
        return live
    gone = jobs.where(F.col("status") == "inactive").join(ledger.select("job_id").distinct(), "job_id", "left_semi")
    return gone.withColumns({"stream": F.lit("inactive"), "turn": F.lit(0)}).unionByName(live)


def stale_active(local: DataFrame, remote: DataFrame) -> DataFrame:
    """(job_id): listings that a receiver still shows as active while they are inactive here."""
    shown = remote.where("status = 'active'").select("job_id").distinct()
    return local.where("status = 'inactive'").select("job_id").join(shown, "job_id", "left_semi")


def after_run(ledger: DataFrame, sent: DataFrame, results: DataFrame, at: Column, stored: Any = None) -> tuple[DataFrame, DataFrame]:
    """(ledger, watermark) after a run: only delivered active rows are recorded, and only they move the watermark.

    sent: the shipment; results: (job_id, delivered). A row that was refused stays due.
    """
    done = sent.where("stream = 'active'").join(results.where("delivered").select("job_id").distinct(), "job_id", "left_semi")
    return updated_ledger(ledger, done, at), next_watermark(done, stored)


def effective_since(stored: Any, given: Any) -> Any:
    """The earlier of two watermarks, where None is the beginning of time."""
    return None if stored is None or given is None else min(stored, given)


def next_watermark(delivered: DataFrame, stored: Any = None) -> DataFrame:
    """(watermark): the latest embedded_at of what was delivered; it never moves back."""
    at = F.max(F.col("embedded_at").cast("timestamp_ntz"))
    return delivered.agg((at if stored is None else F.greatest(at, F.lit(stored).cast("timestamp_ntz"))).alias("watermark"))


def updated_ledger(ledger: DataFrame, delivered: DataFrame, at: Column) -> DataFrame:
    return latest_ledger(ledger.unionByName(delivered.select("job_id", "content_hash", at.alias("synced_at"))))


def numbered_chunks(rows: DataFrame, order: list[str], size: int = 10_000) -> DataFrame:
    """Rows with their chunk number in a total order, without gathering them: a range sort, counts per partition, offsets.

    The sorted rows are materialized, so both passes see the same partitions.
    """
    spark = rows.sparkSession
    ranged = materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "chunks")
    counts = ranged.groupBy("_p").count().orderBy("_p").collect()  # a row for every partition
    at, offsets = 0, []
    for r in counts:
        offsets.append((r["_p"], at))
        at += r["count"]
    table = spark.createDataFrame(offsets or [(0, 0)], "_p int, _before bigint")
    return ranged.join(F.broadcast(table), "_p").withColumn("chunk", F.floor((F.col("_before") + F.col("_i")) / size)).drop("_p", "_i", "_before")


def documents(rows: DataFrame) -> DataFrame:
    """(job_id, body): the JSON that a receiver gets; times in ISO form, internal columns left out."""
    label = F.when(F.col("sponsorship").isNull(), "unknown").when(F.col("sponsorship"), "offered").otherwise("not_offered")
    named = F.when((F.trim("company_name") != "") & (F.trim("role_title") != ""), canonical_signature(F.col("company_name"), F.col("role_title"), F.col("location_raw")))
    moment = lambda c: F.date_format(F.col(c).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias(c)
    keep = [c for c in rows.columns if c not in ("seniority_level", "first_seen_at", "last_seen_at", "embedded_at", "sponsorship")]
    body = F.to_json(F.struct(*keep, moment("first_seen_at"), moment("last_seen_at"), moment("embedded_at"), label.alias("sponsorship_status"), named.alias("canonical_signature")))
    return rows.select("job_id", body.alias("body"))


def push(batch: list[Any], send: Callable[[list[Any]], int], splits: tuple[int, ...] = (400, 413, 422, 503, 504)) -> Iterator[tuple[Any, bool, int]]:
    """(document, delivered, status): a batch that is refused in a way that may lie in one document is halved until it's found."""
    if not batch:
        return
    status = send(batch)
    if 200 <= status < 300:
        yield from ((d, True, status) for d in batch)
    elif status in splits and len(batch) > 1:
        middle = len(batch) // 2
        yield from push(batch[:middle], send, splits)
        yield from push(batch[middle:], send, splits)
    else:
        yield from ((d, False, status) for d in batch)


def deliver(docs: DataFrame, send_factory: Callable[[], Callable[[list[Any]], int]], size: int = 50) -> DataFrame:
    """(job_id, delivered, status) of documents pushed in batches from the tasks."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        send = send_factory()
        for b in batches:
            rows = b.to_pylist()
            out = [(r["job_id"], ok, code) for k in range(0, len(rows), size) for r, ok, code in push(rows[k : k + size], send)]
            cols = list(zip(*out)) or [[], [], []]
            yield pa.record_batch([pa.array(list(cols[0]), pa.string()), pa.array(list(cols[1]), pa.bool_()), pa.array(list(cols[2]), pa.int32())], names=["job_id", "delivered", "status"])

    return docs.mapInArrow(run, "job_id string, delivered boolean, status int")
