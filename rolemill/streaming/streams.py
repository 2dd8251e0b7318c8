"""Structured Streaming around the same transforms as in batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from rolemill.store import publish, read_current


def tumbling(events: DataFrame, at: str, width: str, late: str, *keys: str) -> DataFrame:
    """Counts per window and key; rows later than the watermark are dropped."""
    return events.withWatermark(at, late).groupBy(F.window(at, width), *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "n")


def sliding(events: DataFrame, at: str, width: str, step: str, late: str, *keys: str) -> DataFrame:
    return events.withWatermark(at, late).groupBy(F.window(at, width, step), *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "n")


def sessions(events: DataFrame, at: str, gap: str, late: str, *keys: str) -> DataFrame:
    return events.withWatermark(at, late).groupBy(F.session_window(at, gap), *keys).agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), *keys, "n")


def _expire(state: GroupState, latest: pd.Timestamp, ttl: int) -> None:
    """The state goes once the watermark is ``ttl`` past the latest row of its key."""
    at = int(latest.timestamp() * 1000) + ttl
    state.setTimeoutTimestamp(max(at, state.getCurrentWatermarkMs() + 1))


_REACTIONS = "user_id string, job_id string, reaction string"


def first_reactions_stream(feedback: DataFrame, keep: str = "90 days") -> DataFrame:
    """The first reaction of every user to every listing, as they arrive: one small state per pair.

    In a stream the first is the one that arrives first; the batch operator orders by recorded_at. Rows that are more
    than ``keep`` behind the latest are dropped, and a pair's state goes ``keep`` after its last row, so the state is
    bounded; the batch operator is the exact answer for what is older.
    """
    ttl = int(pd.Timedelta(keep).total_seconds() * 1000)

    def once(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        seen, latest = state.exists, None
        for pdf in chunks:
            if len(pdf):
                latest = pdf["recorded_at"].max() if latest is None else max(latest, pdf["recorded_at"].max())
            if not seen and len(pdf):
                seen = True
                first = pdf.sort_values(["recorded_at", "feedback_id"]).iloc[0]
                yield pd.DataFrame({"user_id": [key[0]], "job_id": [key[1]], "reaction": [first["reaction"]]})
        if latest is not None:
            state.update((True,))
            _expire(state, latest, ttl)

    timed = feedback.withWatermark("recorded_at", keep)
    return timed.groupBy("user_id", "job_id").applyInPandasWithState(once, _REACTIONS, "seen boolean", "append", GroupStateTimeout.EventTimeTimeout)


def changed_versions(listings: DataFrame, key: str = "job_id", version: str = "content_hash", at: str | None = None, keep: str = "90 days") -> DataFrame:
    """Rows whose version differs from the last one seen for their key: a change ledger kept as state.

    at: a time column; a key that has no row for ``keep`` is then forgotten, and emitted once more when it comes back, as
    a receiver of upserts can bear. Without it there is one state for every listing. ``sync.to_ship`` against the ledger
    is exact for any age.
    """
    ttl = int(pd.Timedelta(keep).total_seconds() * 1000)

    def differs(k: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last, known, latest = state.get[0] if state.exists else None, state.exists, None
        for pdf in chunks:
            if at is not None and len(pdf):
                latest = pdf[at].max() if latest is None else max(latest, pdf[at].max())
            for v in pdf[version]:
                v = None if pd.isna(v) else v
                if not known or v != last:
                    known, last = True, v
                    yield pd.DataFrame({key: [k[0]], version: [v]})
        state.update((last,))
        if latest is not None:
            _expire(state, latest, ttl)

    rows = listings if at is None else listings.withWatermark(at, keep)
    return rows.groupBy(key).applyInPandasWithState(differs, f"{key} string, {version} string", "last string", "append", GroupStateTimeout.NoTimeout if at is None else GroupStateTimeout.EventTimeTimeout)


def snapshot_stream(source: DataFrame, root: str, step: Callable[[DataFrame | None, DataFrame], DataFrame], checkpoint: str):
    """Every micro-batch turns the current snapshot into the next one; started with AvailableNow, it drains what is there."""

    def one(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            publish(step(read_current(batch.sparkSession, root), batch), root)

    return source.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
