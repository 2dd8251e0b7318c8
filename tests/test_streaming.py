from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from rolemill.operators import dedup, merge
from rolemill.plans import pipeline
from rolemill.store import current_version, drop_old, publish, read_current
from rolemill.streaming import streams


def drain(df, spark, name, mode="append"):
    q = df.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name)


def test_first_reactions_stream_equals_batch(spark, data, tmp_path):
    f = spark.read.parquet(f"{data}/feedback.parquet").select("feedback_id", "user_id", "job_id", "reaction", F.col("recorded_at").cast("timestamp").alias("recorded_at"))
    src = str(tmp_path / "in")
    f.repartition(1).write.parquet(src)
    got = drain(streams.first_reactions_stream(spark.readStream.schema(f.schema).parquet(src)), spark, "first_reactions")
    want = dedup.first_reactions(f).select("user_id", "job_id", "reaction")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_changed_versions(spark, tmp_path):
    src = str(tmp_path / "in")
    for rows in ([("a", "1"), ("b", None)], [("a", "1"), ("b", "2")], [("a", "3")]):
        spark.createDataFrame(rows, "job_id string, content_hash string").coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema("job_id string, content_hash string").option("maxFilesPerTrigger", 1).parquet(src)
    got = drain(streams.changed_versions(stream), spark, "versions")
    assert sorted((r.job_id, r.content_hash or "") for r in got.collect()) == [("a", "1"), ("a", "3"), ("b", ""), ("b", "2")]


def test_forgotten_keys_come_once_more(spark, tmp_path):
    src, schema = str(tmp_path / "in"), "job_id string, content_hash string, at timestamp"
    for rows in ([("a", "1", dt.datetime(2026, 1, 1))], [("b", "1", dt.datetime(2026, 6, 1))], [("b", "1", dt.datetime(2026, 6, 2))], [("a", "1", dt.datetime(2026, 6, 3)), ("b", "1", dt.datetime(2026, 6, 3))]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    got = drain(streams.changed_versions(stream, at="at", keep="30 days"), spark, "forgotten")
    assert sorted((r.job_id, r.content_hash) for r in got.collect()) == [("a", "1"), ("a", "1"), ("b", "1")]


def test_windows_equal_batch(spark, data, tmp_path):
    e = spark.read.parquet(f"{data}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    src = str(tmp_path / "in")
    e.repartition(1).write.parquet(src)
    stream = spark.readStream.schema(e.schema).parquet(src)
    got = drain(streams.tumbling(stream, "ts", "1 hour", "1 day", "event_type"), spark, "tumbling", "complete")
    want = streams.tumbling(e, "ts", "1 hour", "1 day", "event_type")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert streams.sliding(e, "ts", "1 hour", "30 minutes", "1 day").count() > 0
    assert streams.sessions(e, "ts", "30 minutes", "1 day", "user_id").agg(F.sum("n")).first()[0] == e.count()


def test_store_versions(spark, tmp_path):
    root = str(tmp_path / "t")
    assert current_version(spark, root) is None and read_current(spark, root) is None
    for k in range(4):
        assert publish(spark.range(k), root) == k + 1
    spark.range(9).write.parquet(f"{root}/v5")  # written but not published
    assert read_current(spark, root).count() == 3
    drop_old(spark, root, 2)
    assert current_version(spark, root) == 4 and publish(spark.range(7), root) == 5 and read_current(spark, root).count() == 7


def test_snapshot_stream(spark, tmp_path):
    src, root = str(tmp_path / "in"), str(tmp_path / "t")
    schema = "job_id string, content_hash string"
    for rows in ([("a", "1"), ("b", "1")], [("b", "2"), ("c", "1")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
    step = lambda old, new: new if old is None else merge.merge(old, new, "job_id", {"content_hash": merge.take_new}).drop("action")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    streams.snapshot_stream(stream, root, step, str(tmp_path / "c")).awaitTermination(120)
    assert {r.job_id for r in read_current(spark, root).collect()} == {"a", "b", "c"}


def test_pipeline_runs_twice(spark, data, tmp_path):
    jobs = spark.read.parquet(f"{data}/jobs.parquet")
    clean = jobs.where("(embedding is null) = (embedded_at is null)").limit(100)
    now = F.lit("2026-06-30 00:00:00").cast("timestamp_ntz")
    root = str(tmp_path / "w")
    first = pipeline.run(spark, clean, root, now)
    again = pipeline.run(spark, clean, root, now)
    assert first.jobs_version == 1 and again.jobs_version == 2
    assert first.failures or again.shipped == 0
    assert read_current(spark, f"{root}/jobs").count() == 100


def test_pipeline_records_only_what_was_delivered(spark, data, tmp_path):
    jobs = spark.read.parquet(f"{data}/jobs.parquet")
    good = jobs.where("embedding is not null and embedded_at is not null and length(job_description) >= 200 and size(required_skills) > 0").limit(30)
    now = F.lit("2026-06-30 00:00:00").cast("timestamp_ntz")
    root = str(tmp_path / "w")
    refused = sorted(r.job_id for r in good.where("status = 'active'").select("job_id").collect())[0]
    send = lambda: lambda batch: 422 if any(r["job_id"] == refused for r in batch) else 200
    first = pipeline.run(spark, good, root, now, send=send)
    assert not first.failures and first.refused == 1 and first.shipped > 0
    ledger = {r.job_id for r in read_current(spark, f"{root}/ledger").collect()}
    assert refused not in ledger and len(ledger) == first.shipped
    again = pipeline.run(spark, good, root, now, send=lambda: lambda batch: 200)
    assert again.shipped == 1 and refused in {r.job_id for r in read_current(spark, f"{root}/ledger").collect()}


def test_two_writers_never_write_one_version(spark, tmp_path):
    from rolemill import store

    root = str(tmp_path / "t")
    taken = store._claim(spark, root)
    assert store.publish(spark.range(3).toDF("n"), root) == taken + 1 and store.read_current(spark, root).count() == 3
