"""Identities, hashes and normal forms as native Column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from rolemill.functions import tables as T

_SPACE = r"[\s\p{Z}]+"
_EDGE = r"^[\s\p{Z}]+|[\s\p{Z}]+$"


def strip(c: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(c, _EDGE, "")


def squeeze(c: Column) -> Column:
    return strip(F.regexp_replace(c, _SPACE, " "))


def lookup(c: Column, table: Mapping[str, object], default: Column | None = None) -> Column:
    """A small literal map; what it lacks gives ``default`` (the value itself if that is None)."""
    found = F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), c)
    return F.coalesce(found, c if default is None else default)


def name_key(c: Column) -> Column:
    """Lower case, symbols dropped, punctuation as blanks: the part of a name that identifies it."""
    plain = F.lower(F.regexp_replace(c, r"[\p{So}\p{Sm}\p{Sk}\p{Cs}\p{Cn}]", ""))
    return squeeze(F.regexp_replace(plain, r"[^\p{L}\p{N}_\s]", " "))


def place_key(c: Column) -> Column:
    """The first place of a location; fixed marks for remote work and for no place."""
    head = squeeze(F.regexp_replace(F.lower(F.get(F.split(c, r"[·,;|/]"), F.lit(0))), r"[^\p{L}\p{N}_\s]", " "))
    return F.when(F.coalesce(head, F.lit("")) == "", "__no_loc__").when(head.isin(*T.REMOTE_MARKERS), "__remote__").otherwise(head)


def job_identity(repo: Column, company: Column, role: Column) -> Column:
    """sha-256 of feed, company and role; the address isn't part of it."""
    return F.sha2(F.concat_ws("|", F.lower(strip(repo)), name_key(company), F.lower(strip(role))), 256)


def canonical_signature(company: Column, role: Column, place: Column) -> Column:
    return F.sha2(F.concat_ws("::", F.lit("v2"), name_key(company), name_key(role), place_key(place)), 256)


def content_hash(company: Column, role: Column) -> Column:
    return F.sha2(F.concat_ws("|", strip(company), strip(role)), 256)


def text_hash(c: Column) -> Column:
    return F.sha2(c, 256)


def company_letters(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]", "")


def sorted_tokens(c: Column) -> Column:
    words = F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), _SPACE), lambda w: w != "")
    return F.array_join(F.array_sort(words), " ")


def identity_text(c: Column) -> Column:
    """Lower case with single blanks, for keys that carry over."""
    return F.lower(squeeze(c))


def skill_token(c: Column) -> Column:
    return F.translate(F.lower(strip(c)), " -", "__")


def canonical_skills(skills: Column, aliases: Mapping[str, str] | None = None) -> Column:
    """Lower case, known aliases replaced, the first of equal entries kept; null stays null."""
    table = T.SKILL_ALIASES if aliases is None else aliases
    return F.array_distinct(F.transform(F.filter(skills, lambda s: s.isNotNull()), lambda s: lookup(F.lower(strip(s)), table)))


def clean_skills(skills: Column, most: int = 15) -> Column:
    """Lower case, without blanks and repetitions, at most so many."""
    return F.slice(F.array_distinct(F.filter(F.transform(skills, lambda s: F.lower(strip(s))), lambda s: s != "")), 1, most)


def canonical_source(repo: Column) -> Column:
    return F.substring_index(repo, ":", 1)


def source_priority(repo: Column, table: Mapping[str, int] | None = None) -> Column:
    return lookup(canonical_source(repo), T.SOURCE_PRIORITY if table is None else table, F.lit(0))


def place_bucket(c: Column) -> Column:
    return lookup(F.lower(strip(c)), T.PLACE_ALIASES)


def place_buckets(c: Column) -> Column:
    """All places of a location; one that is remote is remote only."""
    parts = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), "[;,]"), place_bucket), lambda p: p != "")
    every = F.array_distinct(parts)
    return F.when(F.array_contains(every, "remote"), F.array(F.lit("remote"))).otherwise(every)


def preferred_buckets(places: Column) -> Column:
    return F.array_distinct(F.transform(F.filter(F.coalesce(places, F.array().cast("array<string>")), lambda p: p.isNotNull()), place_bucket))


def seniority_label(c: Column) -> Column:
    token = skill_token(c)
    return F.when(F.coalesce(c, F.lit("")) == "", "unknown").otherwise(lookup(token, T.SENIORITY_ALIASES))


def seniority_rank(label: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in T.SENIORITY_RANK.items() for x in kv]), label)


def collapse_seniority(c: Column) -> Column:
    return lookup(F.lower(strip(c)), T.SENIORITY_COLLAPSE)


def size_class(c: Column) -> Column:
    return lookup(c, T.SIZE_CLASSES, F.lit("unknown"))


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(strip(c)), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def embedding_text(role: Column, company: Column, skills: Column) -> Column:
    base = F.concat(role, F.lit(" at "), company)
    return F.when(F.size(F.coalesce(skills, F.array().cast("array<string>"))) > 0, F.concat(base, F.lit(". Skills: "), F.array_join(skills, ", "))).otherwise(base)


def query_text(skills: Column, default: str = "software engineer") -> Column:
    joined = F.array_join(F.coalesce(skills, F.array().cast("array<string>")), " ")
    return F.when(joined == "", default).otherwise(joined)


# Words that tell no titles apart.
TITLE_STOP = ("a", "an", "the", "of", "for", "and", "in", "at", "to", "with", "or", "on")


def title_tokens(c: Column, stop: Iterable[str] = TITLE_STOP) -> Column:
    words = F.array_distinct(F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9+#]+"), lambda w: w != ""))
    return F.array_except(words, F.array(*[F.lit(s) for s in stop]))


def jaccard(a: Column, b: Column) -> Column:
    """Of two sets; 0 where both are empty."""
    both = F.size(F.array_union(a, b))
    return F.when(both > 0, F.size(F.array_intersect(a, b)) / both).otherwise(0.0)


def first_of(values: Column, table: Mapping[str, str], other: str) -> Column:
    """The first entry that the table knows; ``other`` if it knows none, null for an empty list."""
    known = F.filter(F.transform(values, lambda v: lookup(F.lower(strip(v)), table, F.lit(None).cast("string"))), lambda v: v.isNotNull())
    return F.when(F.size(F.coalesce(values, F.array().cast("array<string>"))) > 0, F.coalesce(F.get(known, F.lit(0)), F.lit(other)))


def years_per_skill(m: Column) -> Column:
    """Keys as tokens, years not below 0, entries without a number dropped; of equal keys the last counts."""
    number = lambda v: F.when(v.try_cast("double").isNotNull(), F.greatest(v.try_cast("double"), F.lit(0.0)))
    entries = F.transform(F.map_entries(m), lambda e: F.struct(skill_token(e["key"]).alias("key"), number(e["value"]).alias("value")))
    entries = F.filter(entries, lambda e: e["value"].isNotNull())
    last = F.aggregate(entries, F.create_map().cast("map<string,double>"), lambda acc, e: F.map_concat(F.map_filter(acc, lambda k, _: k != e["key"]), F.create_map(e["key"], e["value"])))
    return last


def distinct_names(names: Column) -> Column:
    """Names without regard to case, the first spelling kept."""
    return F.aggregate(
        F.filter(names, lambda n: strip(n) != ""),
        F.array().cast("array<string>"),
        lambda acc, n: F.when(F.exists(acc, lambda a: F.lower(a) == F.lower(strip(n))), acc).otherwise(F.concat(acc, F.array(strip(n)))),
    )


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
