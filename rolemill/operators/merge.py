"""Merging a delta into a snapshot by a table of column policies, and the other snapshot transforms.

A snapshot is never changed in place: every function gives the next one. Keys must be unique on both sides; rows of the
delta with equal keys are reduced to the first by ``order`` before.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rolemill.functions.normalize import identity_text
from rolemill.operators.predicates import changed, matchable, usable_text

Policy = Callable[[Column, Column, Column], Column]


def take_new(old: Column, new: Column, _: Column) -> Column:
    return new


def keep_old(old: Column, new: Column, _: Column) -> Column:
    return old


def new_else_old(old: Column, new: Column, _: Column) -> Column:
    return F.coalesce(new, old)


def old_else_new(old: Column, new: Column, _: Column) -> Column:
    return F.coalesce(old, new)


def cleared_by_change(old: Column, new: Column, is_changed: Column) -> Column:
    return F.when(~is_changed, old)


def sorted_union(old: Column, new: Column, _: Column) -> Column:
    """A new empty array adds nothing; null is no entry."""
    both = F.concat(F.coalesce(old, F.array().cast("array<string>")), F.coalesce(new, F.array().cast("array<string>")))
    union = F.array_sort(F.array_distinct(F.filter(both, lambda x: x.isNotNull())))
    return F.when(F.coalesce(F.size(new), F.lit(0)) > 0, union).otherwise(old)


#: What happens to a known listing's columns when a feed shows it again; columns that aren't named stay.
JOB_POLICIES: dict[str, Policy] = {
    "location_raw": take_new, "date_posted_raw": take_new, "last_seen_at": take_new, "status": take_new, "content_hash": take_new,
    "job_description": new_else_old, "seniority_level": new_else_old, "sources": sorted_union,
    "embedding": cleared_by_change, "embedding_model": cleared_by_change, "embedded_at": cleared_by_change,
}


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def merge(old: DataFrame, new: DataFrame, key: str, policies: Mapping[str, Policy], version: str = "content_hash") -> DataFrame:
    """The next snapshot with a column ``action``: inserted, updated (version differs), unchanged or kept (not in the delta).

    One full outer join on the key; columns that only the snapshot has are null for inserted rows.
    """
    o = old.select(F.col(key).alias("_k"), F.struct(*old.columns).alias("o"))
    n = new.select(F.col(key).alias("_k"), F.struct(*new.columns).alias("n"))
    both = o.join(n, "_k", "full_outer")
    differs = changed(F.col(f"o.{version}"), F.col(f"n.{version}"))
    out = []
    for c in old.columns:
        was = F.col(f"o.{c}")
        if c not in new.columns:
            out.append(was.alias(c))
            continue
        now = F.col(f"n.{c}")
        policy = policies.get(c, keep_old)
        out.append(F.when(F.col("n").isNull(), was).when(F.col("o").isNull(), now).otherwise(policy(was, now, differs)).cast(old.schema[c].dataType).alias(c))
    action = F.when(F.col("n").isNull(), "kept").when(F.col("o").isNull(), "inserted").when(differs, "updated").otherwise("unchanged")
    return both.select(*out, action.alias("action"))


def carry_first_seen(delta: DataFrame, snapshot: DataFrame) -> DataFrame:
    """The delta with the earliest first_seen_at that its identity (company, title, feed) ever had, where that is earlier."""
    key = lambda df: [identity_text(F.col("company_name")).alias("_c"), identity_text(F.col("role_title")).alias("_r"), F.col("source_repo").alias("_s")]
    wanted = delta.select(*key(delta)).distinct()
    first = snapshot.select(*key(snapshot), "first_seen_at").join(wanted, ["_c", "_r", "_s"], "left_semi").groupBy("_c", "_r", "_s").agg(F.min("first_seen_at").alias("_first"))
    joined = delta.select("*", *key(delta)).join(first, ["_c", "_r", "_s"], "left")
    return joined.withColumn("first_seen_at", F.least("first_seen_at", "_first")).select(*delta.columns)


def backfill_first_seen(snapshot: DataFrame) -> DataFrame:
    """Every row gets its identity's earliest first_seen_at: one window, no self-join. ``late`` tells which were later."""
    w = Window.partitionBy(identity_text(F.col("company_name")), identity_text(F.col("role_title")), F.col("source_repo"))
    first = F.min("first_seen_at").over(w)
    return snapshot.withColumn("_first", first).withColumn("late", F.col("first_seen_at") > F.col("_first")).withColumn("first_seen_at", F.col("_first")).drop("_first")


def carry_url(snapshot: DataFrame, now: Column, days: int = 30) -> DataFrame:
    """Active rows without an address take the one of the latest inactive row with the same company and title, if seen within so many days."""
    keys = ["company_name", "role_title"]
    gone = snapshot.where((F.col("status") == "inactive") & F.col("primary_url").isNotNull() & (F.col("last_seen_at") >= now - F.make_dt_interval(F.lit(days))))
    latest = gone.groupBy(*keys).agg(F.min_by("primary_url", F.struct(-F.unix_micros(F.col("last_seen_at").cast("timestamp")), F.col("job_id"))).alias("_url"))
    joined = snapshot.join(latest, keys, "left")
    return joined.withColumn("primary_url", F.when(F.col("status") == "active", F.coalesce("primary_url", "_url")).otherwise(F.col("primary_url"))).select(*snapshot.columns)


def mark_stale(snapshot: DataFrame, seen: DataFrame, share: float = 0.5, least: int = 20, force: bool = False) -> DataFrame:
    """Active rows of a scanned feed that the scan didn't show become inactive; ``tripped`` where the guard stopped that.

    seen has source_repo and job_id. The guard trips for a feed with at least ``least`` active rows of which more than
    ``share`` would go. Feeds without a scan are left alone.
    """
    shown = seen.select("source_repo", "job_id", F.lit(True).alias("_seen")).distinct()
    scanned = seen.select("source_repo", F.lit(True).alias("_scanned")).distinct()
    rows = snapshot.join(shown, ["source_repo", "job_id"], "left").join(scanned, "source_repo", "left")
    leaving = (F.col("status") == "active") & F.col("_scanned").isNotNull() & F.col("_seen").isNull()
    rows = rows.withColumn("_leaving", leaving)
    per = rows.where("_scanned").groupBy("source_repo").agg(F.count_if(F.col("status") == "active").alias("_active"), F.count_if("_leaving").alias("_going"))
    guard = per.select("source_repo", ((F.col("_active") >= least) & (F.col("_going") > share * F.col("_active")) & F.lit(not force)).alias("_trip"))
    out = rows.join(guard, "source_repo", "left").withColumn("tripped", F.coalesce("_trip", F.lit(False)))
    return out.withColumn("status", F.when(F.col("_leaving") & ~F.col("tripped"), "inactive").otherwise(F.col("status"))).select(*snapshot.columns, "tripped")


def mark_inactive(snapshot: DataFrame, ids: DataFrame, now: Column) -> DataFrame:
    flag = ids.select("job_id", F.lit(True).alias("_gone")).distinct()
    rows = snapshot.join(flag, "job_id", "left")
    return rows.withColumns({"status": F.when(F.col("_gone"), "inactive").otherwise(F.col("status")), "last_seen_at": F.when(F.col("_gone"), now).otherwise(F.col("last_seen_at"))}).select(*snapshot.columns)


def split_tombstoned(delta: DataFrame, tombstones: DataFrame, now: Column, days: int = 90, retries: int = 100, order: str = "job_id") -> DataFrame:
    """The delta with ``verdict``: fresh, skipped (dead), or retried (dead for so many days; at most ``retries``, the first in order)."""
    # a listing may have been confirmed dead several times: the last time counts
    dead = tombstones.where("dead").groupBy("job_id").agg(F.lit(True).alias("_dead"), F.max("dead_confirmed_at").alias("dead_confirmed_at"))
    rows = delta.join(dead, "job_id", "left")
    due = F.coalesce(F.col("_dead") & (F.col("dead_confirmed_at") <= now - F.make_dt_interval(F.lit(days))), F.lit(False))
    # the limit is the feature: it bounds how much one run tries again
    again = rows.where(due).orderBy(order).limit(retries).select("job_id", F.lit(True).alias("_again"))
    verdict = F.when(F.col("_dead").isNull(), "fresh").when(F.col("_again"), "retried").otherwise("skipped")
    return rows.join(again, "job_id", "left").withColumn("verdict", verdict).select(*delta.columns, "verdict")


def revived(snapshot: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The snapshot with the tombstones of retried listings cleared (verdicts: what ``split_tombstoned`` gives)."""
    again = verdicts.where("verdict = 'retried'").select("job_id", F.lit(True).alias("_again")).distinct()
    rows = snapshot.join(again, "job_id", "left")
    return rows.withColumns({"dead": F.when(F.col("_again"), F.lit(False)).otherwise(F.col("dead")), "dead_confirmed_at": F.when(F.col("_again").isNull(), F.col("dead_confirmed_at"))}).select(*snapshot.columns)


def mirror_dead(snapshot: DataFrame, remote: DataFrame, now: Column) -> DataFrame:
    """Rows that another store calls dead: its time, else the one known, else now."""
    src = remote.groupBy("job_id").agg(F.max("dead_at").alias("_at")).withColumn("_is", F.lit(True))
    rows = snapshot.join(src, "job_id", "left")
    return rows.withColumns({"dead": F.coalesce("_is", "dead"), "dead_confirmed_at": F.when(F.col("_is"), F.coalesce("dead_confirmed_at", "_at", now)).otherwise(F.col("dead_confirmed_at"))}).select(*snapshot.columns)


def reconcile_dead(snapshot: DataFrame, now: Column, grace_hours: int = 24) -> DataFrame:
    due = F.col("permanent_404") | (F.col("dead") & (F.col("dead_confirmed_at").isNull() | (F.col("dead_confirmed_at") < now - F.make_dt_interval(F.lit(0), F.lit(grace_hours)))))
    return snapshot.withColumn("status", F.when((F.col("status") == "active") & F.coalesce(due, F.lit(False)), "inactive").otherwise(F.col("status")))


def stale_by_age(snapshot: DataFrame, now: Column, days: int = 20) -> DataFrame:
    old = F.col("last_seen_at") < now - F.make_dt_interval(F.lit(days))
    return snapshot.withColumn("status", F.when((F.col("status") == "active") & old, "inactive").otherwise(F.col("status")))


def purge(snapshot: DataFrame, feedback: DataFrame, now: Column, days: int = 14) -> tuple[DataFrame, DataFrame]:
    """Without rows inactive for so many days, and the feedback without theirs."""
    going = F.coalesce((F.col("status") == "inactive") & (F.col("last_seen_at") < now - F.make_dt_interval(F.lit(days))), F.lit(False))
    ids = snapshot.where(going).select("job_id")
    return snapshot.where(~going), feedback.join(ids, "job_id", "left_anti")


def write_back(snapshot: DataFrame, results: DataFrame, key: str, columns: list[str], overwrite: bool = True) -> DataFrame:
    """Results of a step put into the snapshot: only non-blank values count; with overwrite=False only gaps are filled."""
    filled = lambda c: F.nullif(F.col(c), F.lit("")) if results.schema[c].dataType.simpleString() == "string" else F.when(F.size(c) > 0, F.col(c)) if results.schema[c].dataType.simpleString().startswith("array") else F.col(c)
    # a result that came twice is one result; of different ones the greatest
    one = results.groupBy(key).agg(F.max(F.struct(*[filled(c).alias(f"_{c}") for c in columns])).alias("_r"))
    rows = snapshot.join(one, key, "left").select(*[F.col(c) for c in snapshot.columns], *[F.col(f"_r._{c}").alias(f"_{c}") for c in columns])
    gap = lambda c: F.nullif(F.col(c), F.lit("")) if snapshot.schema[c].dataType.simpleString() == "string" else F.when(F.size(c) > 0, F.col(c)) if snapshot.schema[c].dataType.simpleString().startswith("array") else F.col(c)
    new = {c: F.coalesce(f"_{c}", c) if overwrite else F.coalesce(gap(c), F.col(f"_{c}"), F.col(c)) for c in columns}
    return rows.withColumns(new).select(*snapshot.columns)


def flip(snapshot: DataFrame, flips: DataFrame, now: Column) -> DataFrame:
    """Manual status changes (job_id, new_status, reason): the first time and reason stay; only rows that differ change."""
    f = flips.groupBy("job_id").agg(F.min_by(F.struct("new_status", "reason"), "reason").alias("_f"))
    rows = snapshot.join(f, "job_id", "left")
    acts = F.coalesce(F.col("_f.new_status") != F.col("status"), F.lit(False))
    return rows.withColumns({
        "flipped": F.coalesce("flipped", F.lit(False)) | acts,
        "flipped_at": F.when(acts, F.coalesce("flipped_at", now)).otherwise(F.col("flipped_at")),
        "flip_reason": F.when(acts, F.coalesce("flip_reason", "_f.reason")).otherwise(F.col("flip_reason")),
        "status": F.when(acts, F.col("_f.new_status")).otherwise(F.col("status")),
    }).select(*snapshot.columns)


def violations(snapshot: DataFrame) -> DataFrame:
    """(check, rows) of the invariants of a listing."""
    checks = {
        "vector_without_time": F.col("embedding").isNotNull() & F.col("embedded_at").isNull(),
        "time_without_vector": F.col("embedding").isNull() & F.col("embedded_at").isNotNull(),
        "bad_hash": F.col("content_hash").isNotNull() & ~F.col("content_hash").rlike("^[0-9a-f]{64}$"),
        "ends_before_start": F.col("last_seen_at") < F.col("first_seen_at"),
        "unknown_status": ~F.col("status").isin("active", "inactive", "duplicate"),
        "embedded_not_matchable": F.col("embedding").isNotNull() & ~matchable(),
    }
    one = snapshot.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("rows")) for n in checks])).alias("x")).select("x.check", "x.rows")


def audit(snapshot: DataFrame, feedback: DataFrame, users: DataFrame, dim: int, least_coverage: float = 0.97, most_unlevelled: float = 0.20) -> DataFrame:
    """(check, severity, value) of the integrity findings; severity is ok where nothing is wrong. One pass over the
    snapshot, two aggregates for duplicates, two anti joins for the reactions."""
    on, vector = F.coalesce(F.col("status") == "active", F.lit(False)), F.col("embedding").isNotNull()
    counted = {
        "active": on, "embedded": on & vector, "wrong_size": vector & (F.size("embedding") != dim), "time_without_vector": F.col("embedded_at").isNotNull() & ~vector,
        "vector_without_time": vector & F.col("embedded_at").isNull(), "vector_without_model": vector & F.col("embedding_model").isNull(),
        "embedded_thin_text": on & vector & ~usable_text(), "no_level": on & F.col("seniority_level").isNull(), "no_address": on & (F.coalesce("primary_url", F.lit("")) == ""),
        "ends_before_start": F.col("last_seen_at") < F.col("first_seen_at"),
    }
    one = snapshot.agg(*[F.count_if(F.coalesce(c, F.lit(False))).cast("double").alias(n) for n, c in counted.items()], F.count_distinct("embedding_model").cast("double").alias("models"))
    share = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    c = F.col
    found = [
        ("coverage_below_floor", "WARN", share(c("embedded"), c("active")), share(c("embedded"), c("active")) < least_coverage), ("mixed_models", "CRIT", c("models"), c("models") > 1), ("wrong_size", "CRIT", c("wrong_size"), c("wrong_size") > 0),
        ("no_level_share", "WARN", share(c("no_level"), c("active")), share(c("no_level"), c("active")) > most_unlevelled),
        *[(n, "WARN", c(n), c(n) > 0) for n in ("time_without_vector", "vector_without_time", "vector_without_model", "embedded_thin_text", "no_address", "ends_before_start")],
    ]
    rows = one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check"), F.when(bad, sev).otherwise("ok").alias("severity"), F.round(v, 6).alias("value")) for n, sev, v, bad in found])).alias("x")).select("x.*")
    flag = lambda df, name, sev: df.select(F.lit(name).alias("check"), F.when(c("n") > 0, sev).otherwise("ok").alias("severity"), c("n").cast("double").alias("value"))
    same = snapshot.where(on & (F.coalesce("primary_url", F.lit("")) != "")).groupBy("company_name", "role_title", "primary_url").agg((F.count("*") - 1).alias("m")).agg(F.coalesce(F.sum("m"), F.lit(0)).alias("n"))
    twice = feedback.groupBy("user_id", "job_id").agg((F.count("*") - 1).alias("m")).agg(F.coalesce(F.sum("m"), F.lit(0)).alias("n"))
    lost = lambda other, key: feedback.join(other.select(key), key, "left_anti").agg(F.count("*").alias("n"))
    return rows.union(flag(same, "same_listing", "INFO")).union(flag(twice, "repeated_reaction", "WARN")).union(flag(lost(users, "user_id"), "reaction_of_nobody", "WARN")).union(flag(lost(snapshot, "job_id"), "reaction_to_nothing", "WARN"))
