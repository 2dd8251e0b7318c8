"""Cleaning and classification of texts, titles and addresses as native Column expressions."""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from rolemill.functions import tables as T
from rolemill.functions.normalize import squeeze, strip


@F.pandas_udf(StringType())
def unescape_nfkc(c: pd.Series) -> pd.Series:
    """Entities decoded and compatibility forms composed: neither has a built-in function."""
    import html
    import unicodedata

    return c.map(lambda s: None if s is None else unicodedata.normalize("NFKC", html.unescape(s)))


@F.pandas_udf(StringType())
def nfkc(c: pd.Series) -> pd.Series:
    """Compatibility forms composed: there is no built-in function."""
    import unicodedata

    return c.map(lambda s: None if s is None else unicodedata.normalize("NFKC", s))


def registry_key(c: Column) -> Column:
    """A company's name or slug as the key of a registry: compatibility forms, lower case, letters a-z and digits alone."""
    return squeeze(F.regexp_replace(F.lower(nfkc(c)), "[^a-z0-9 ]", " "))


def strip_markup(c: Column) -> Column:
    """Tags as blanks, scripts and styles dropped with their content."""
    bare = F.regexp_replace(c, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    return squeeze(F.regexp_replace(bare, r"(?s)<[^>]+>", " "))


def plain_text(c: Column) -> Column:
    """Entities, compatibility forms, invisible characters and tags resolved."""
    return strip_markup(F.regexp_replace(unescape_nfkc(c), "[\\x00​‌‍﻿]", ""))


def without_nul(c: Column) -> Column:
    return F.replace(c, F.lit("\x00"), F.lit(""))


def without_nul_anywhere(df: DataFrame) -> DataFrame:
    """The rows without NUL characters in texts and lists of texts; other columns stay."""
    clean = {"string": without_nul, "array<string>": lambda c: F.transform(c, without_nul)}
    return df.select(*[clean[kind](F.col(c)).alias(c) if kind in clean else F.col(c) for c, kind in df.dtypes])


def first_url(c: Column) -> Column:
    """Of a markdown link, else of an href."""
    md, href = F.regexp_extract(c, r"\[[^\]]*\]\(([^)\s]+)", 1), F.regexp_extract(c, r"""(?i)href=["']([^"']+)""", 1)
    return F.coalesce(F.nullif(md, F.lit("")), F.nullif(href, F.lit("")))


def page_title(c: Column) -> Column:
    return squeeze(F.nullif(F.regexp_extract(c, r"(?is)<title[^>]*>(.*?)</title>", 1), F.lit("")))


def page_property(c: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(c, rf"""(?is)<meta[^>]+property=["']{re.escape(name)}["'][^>]+content=["']([^"']*)""", 1), F.lit(""))


def first_contained(c: Column, needles: Iterable[str]) -> Column:
    low = F.lower(c)
    return F.get(F.filter(F.array(*[F.lit(n) for n in needles]), lambda n: F.contains(low, n)), F.lit(0))


def closed_marker(c: Column) -> Column:
    return first_contained(c, T.CLOSED_MARKERS)


def describes_role(c: Column, least_chars: int = 200) -> Column:
    return (F.length(strip(c)) >= least_chars) & first_contained(c, T.ROLE_KEYWORDS).isNotNull()


def first_match(c: Column, rules: Iterable[tuple[str, str]], default: str | None = None) -> Column:
    """The label of the first rule (label, pattern) that is found, without regard to case."""
    whens = [F.when(c.rlike("(?i)" + p), F.lit(label)) for label, p in rules]
    return F.coalesce(*whens, F.lit(default))


def title_level(c: Column) -> Column:
    return first_match(c, T.TITLE_LEVELS, "mid_level")


def title_stage(c: Column) -> Column:
    return first_match(c, T.TITLE_STAGES, "mid")


def title_function(c: Column) -> Column:
    """An array with the one kind of work that the title tells, or an empty one."""
    found = first_match(c, T.TITLE_FUNCTIONS)
    return F.when(found.isNull(), F.array().cast("array<string>")).otherwise(F.array(found))


def title_skills(c: Column, most: int = 10) -> Column:
    low = F.lower(c)
    each = [F.when(low.rlike(p), F.array(*[F.lit(s) for s in skills])).otherwise(F.array().cast("array<string>")) for p, skills in T.TITLE_SKILLS]
    return F.slice(F.array_sort(F.array_distinct(F.concat(*each))), 1, most)


def title_industry(c: Column) -> Column:
    return first_match(c, T.TITLE_INDUSTRIES)


def _beginnings(pattern: str) -> list[str] | None:
    """The letters with which every alternative of a pattern begins at a word border; None where one can't be told."""
    alternatives, depth, last = [], 0, 0
    for k, ch in enumerate(pattern):
        depth += (ch == "(") - (ch == ")")
        if ch == "|" and not depth:
            alternatives.append(pattern[last:k])
            last = k + 1
    found = [re.match(r"\\b([a-z0-9]+)(?![?*])", a) for a in [*alternatives, pattern[last:]]]
    return [m.group(1) for m in found] if all(found) else None


def text_skills(c: Column, most: int = 10, rules: Iterable[tuple[str, str]] = T.TEXT_SKILLS) -> Column:
    """Skills named in a text, in the order of the list.

    One pass over the text finds the words with which a rule can begin; only rules whose word is there are tried.
    """
    begin = {name: _beginnings(p) for name, p in rules}
    words = sorted({w for b in begin.values() for w in b or ()}, key=lambda w: (w[0], -len(w), w))
    # branches by letter: at most word borders the first letter alone is tried
    letters = [f"{letter}(?:{'|'.join(w[1:] for w in some)})" for letter, some in itertools.groupby(words, key=lambda w: w[0])]
    first_pass = F.lit(r"\b(?=[" + "".join(sorted({w[0] for w in words})) + r"])(?:" + "|".join(letters) + ")")

    def found(hits: Column, some: list[str]) -> Column:
        """Of several beginnings at one place the longest is found, which stands for those it begins with."""
        telling = [w for w in words if any(w.startswith(x) for x in some)]
        return F.array_contains(hits, telling[0]) if len(telling) == 1 else F.arrays_overlap(hits, F.array(*[F.lit(w) for w in telling]))

    def named(low: Column) -> Column:
        def of(hits: Column) -> Column:
            each = []
            for name, p in rules:
                here = low.rlike(p)
                if begin[name] is not None:
                    here = found(hits, begin[name]) & here
                each.append(F.when(here, F.lit(name)))
            return F.slice(F.filter(F.array(*each), lambda s: s.isNotNull()), 1, most)

        return F.get(F.transform(F.array(F.array_distinct(F.regexp_extract_all(low, first_pass, F.lit(0)))), of), F.lit(0))

    # inside a lambda the lower-cased text and the words found are made once, not once a rule
    return F.get(F.transform(F.array(F.lower(c)), named), F.lit(0))


def parse_moment(c: Column) -> Column:
    """ISO text, or seconds or milliseconds since 1970 (above 1e10)."""
    number = c.try_cast("double")
    return F.when(number.isNotNull(), F.when(number > 1e10, F.timestamp_millis(number.cast("bigint"))).otherwise(F.timestamp_seconds(number))).otherwise(F.try_to_timestamp(c))


def unfenced(c: Column) -> Column:
    """A model's answer without the code fence around it."""
    return strip(F.regexp_replace(c, r"(?s)^\s*```(?:json)?\s*|\s*```\s*$", ""))


# ---- addresses

_URL = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def canonical_url(c: Column, tracking: Iterable[str] = T.TRACKING_PARAMS) -> Column:
    """An address without tracking and blank parameters, fragment and closing slash; the host in lower case.

    Parameters stay in the order of their keys' first occurrence, repeated keys together, each value escaped as it came.
    """
    u = strip(c)
    part = lambda k: F.regexp_extract(u, _URL, k)
    pairs = F.filter(F.split(part(4), "&"), lambda p: F.contains(p, F.lit("=")) & (F.substring_index(p, "=", 1) != p) & ~F.endswith(p, F.lit("=")) & (F.instr(p, "=") < F.length(p)))
    kept = F.filter(pairs, lambda p: ~F.lower(F.substring_index(p, "=", 1)).isin(*tracking))
    keys = F.array_distinct(F.transform(kept, lambda p: F.substring_index(p, "=", 1)))
    grouped = F.flatten(F.transform(keys, lambda k: F.filter(kept, lambda p: F.substring_index(p, "=", 1) == k)))
    query = F.array_join(grouped, "&")
    scheme = F.when(part(1) != "", F.concat(F.lower(part(1)), F.lit(":"))).otherwise("")
    host = F.when(part(2) != "", F.concat(F.lit("//"), F.lower(part(2)))).otherwise("")
    whole = F.concat(scheme, host, F.regexp_replace(part(3), "/+$", ""), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.coalesce(whole, F.lit(""))


def bare_url(c: Column) -> Column:
    """Scheme (https if missing), host and path alone."""
    u = strip(c)
    full = F.when(u.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), u).otherwise(F.concat(F.lit("https://"), F.regexp_replace(u, "^//", "")))
    part = lambda k: F.regexp_extract(full, r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#;]*)", k)
    path = F.regexp_replace(part(3), "/+$", "")
    return F.when(F.coalesce(u, F.lit("")) == "", "").otherwise(F.concat(F.lower(part(1)), F.lit("://"), F.lower(part(2)), F.when(path == "", "/").otherwise(path)))


def url_host(c: Column) -> Column:
    return F.lower(F.regexp_extract(strip(c), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?([^/?#]*)", 1))


def url_param(c: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(c, rf"[?&]{re.escape(name)}=([^&#]*)", 1), F.lit(""))


def hosting(c: Column) -> Column:
    """(tier, slug): which system hosts an address, and for whom."""
    tier = F.coalesce(*[F.when(c.rlike("(?i)" + p), F.lit(t)) for t, p in T.HOST_TIERS], F.lit("unknown"))
    slug = F.coalesce(*[F.when(c.rlike("(?i)" + p), F.regexp_extract(c, "(?i)" + p, 1)) for _, p in T.HOST_TIERS])
    return F.struct(tier.alias("tier"), F.when(~tier.isin("jobright", "simplify") & ~slug.rlike(r"(?i)^wd\d+$"), slug).alias("slug"))


def fetch_route(c: Column) -> Column:
    host, path = url_host(c), F.lower(F.regexp_extract(strip(c), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?[^/?#]*([^?#]*)", 1))
    found = [F.when(F.contains(host, F.lit(h)), F.lit(r)) for r, h in T.FETCH_ROUTES]
    wday = F.when(F.contains(path, F.lit("/wday/")) | (F.contains(path, F.lit("/job/")) & F.contains(host, F.lit("workday"))), "workday")
    return F.coalesce(*found, wday, F.when(F.contains(host, F.lit("jobright.ai")), "jobright"), F.lit("rendered"))


def is_aggregator(c: Column) -> Column:
    host = url_host(c)
    return F.exists(F.array(*[F.lit(a) for a in T.AGGREGATORS]), lambda a: F.contains(host, a))
