"""Every named predicate once, as a Column. Nulls follow SQL's three values unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rolemill.functions.normalize import place_buckets, preferred_buckets, strip

LEAST_CHARS = 200


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def usable_text(c: str | Column = "job_description", stripped: bool = False, least: int = LEAST_CHARS) -> Column:
    """At least so many characters, as stored or without outer white space; null counts as none."""
    t = _c(c)
    return F.coalesce(F.length(strip(t) if stripped else t) >= least, F.lit(False))


def has_entries(c: str | Column = "required_skills") -> Column:
    """Null and empty arrays are the same: nothing."""
    return F.coalesce(F.size(_c(c)), F.lit(0)) > 0


def matchable(stripped: bool = False) -> Column:
    return usable_text(stripped=stripped) & has_entries()


def active() -> Column:
    return F.coalesce(F.col("status") == "active", F.lit(False))


def shippable(with_tombstones: bool = True) -> Column:
    """Active, embedded and matchable; optionally without rows that are dead or gone for good."""
    base = active() & F.col("embedding").isNotNull() & F.col("embedded_at").isNotNull() & matchable()
    if not with_tombstones:
        return base
    return base & ~F.coalesce("dead", F.lit(False)) & ~F.coalesce("permanent_404", F.lit(False))


def not_refused(c: str | Column = "sponsorship") -> Column:
    """Only an explicit false is dropped; unknown stays."""
    return F.coalesce(_c(c), F.lit(True))


def in_feeds(*feeds: str, column: str = "source_repo") -> Column:
    return F.substring_index(F.col(column), ":", 1).isin(*feeds)


def place_fits(preferred: Column, place: str | Column = "location_raw") -> Column:
    """A preference for remote work fits every place, a remote place every preference."""
    want, have = preferred_buckets(preferred), place_buckets(_c(place))
    return F.array_contains(want, "remote") | F.array_contains(have, "remote") | F.arrays_overlap(want, have)


def changed(a: str | Column, b: str | Column) -> Column:
    """IS DISTINCT FROM."""
    return ~_c(a).eqNullSafe(_c(b))


def needs_vector() -> Column:
    return active() & F.col("embedding").isNull() & matchable()


def needs_text(now: Column, stale_days: int = 1) -> Column:
    """Texts too short, never tried or tried long enough ago. Listings gone for good, and those that were skipped or
    closed, don't come back; a listing without a source of its text counts only if it was never tried."""
    tried, source = F.col("text_tried_at"), F.col("text_source")
    again = tried.isNull() | ((tried < now - F.make_dt_interval(F.lit(stale_days))) & ~source.isin("skip_no_url", "closed_at_source"))
    return active() & ~usable_text() & ~F.coalesce("permanent_404", F.lit(False)) & F.coalesce(again, F.lit(False))


def needs_enrichment(now: Column, stale_days: int = 7) -> Column:
    """Never enriched or long ago, and without a text or with an empty list of skills (an unknown list is no gap)."""
    at = F.col("enriched_at")
    stale = at.isNull() | (at < now - F.make_dt_interval(F.lit(stale_days)))
    return active() & stale & (F.col("job_description").isNull() | F.coalesce(F.size("required_skills") == 0, F.lit(False)))


def needs_address(aggregator: str, skipped: tuple[str, ...] = ("skip_no_url",)) -> Column:
    """Active, without an address of the employer's own, listed at the aggregator, and not given up."""
    open_ = F.col("text_source").isNull() | ~F.col("text_source").isin(*skipped)
    return active() & (F.coalesce("apply_url", F.lit("")) == "") & F.coalesce(F.contains(F.lower("primary_url"), F.lit(aggregator.lower())), F.lit(False)) & F.col("role_title").isNotNull() & F.col("company_name").isNotNull() & open_


def went_stale(now: Column, least_days: int = 1, most_days: int = 2) -> Column:
    """Inactive, last seen within a window of days before now."""
    at = F.col("last_seen_at")
    return (F.col("status") == "inactive") & at.between(now - F.make_dt_interval(F.lit(most_days)), now - F.make_dt_interval(F.lit(least_days)))


def search(status: str | None = None, source: str | None = None, industry: str | None = None, text: str | None = None) -> Column:
    """A browse filter put together from what is given; text is looked for in company and title, without regard to case."""
    out = F.lit(True)
    for col, value in (("status", status), ("source_repo", source), ("industry", industry)):
        if value is not None:
            out = out & (F.col(col) == value)
    if text:
        low = text.lower()
        out = out & (F.contains(F.lower("company_name"), F.lit(low)) | F.contains(F.lower("role_title"), F.lit(low)))
    return out


def gone_for_good(http_status: Column) -> Column:
    return http_status.isin(404, 410)
