"""Mapping of freely typed values to the entries of a reference list, with unmatched values reported.

Method: symmetric-delete dictionary. Every entry of the reference list (and every synonym) is stored under all strings
that result from leaving out up to ``edits`` characters; a typed value looks up its own deletions, which finds every
entry within that many edits. Candidates are ranked by a weighted Damerau-Levenshtein distance (a doubled letter, a
swap or a neighbouring key costs less, another first letter more), then by how often the entry itself occurs in the
data, then by the smaller id. The dictionary is broadcast: it grows with the reference list and not with the data, and
a list whose dictionary would pass ``MAX_KEYS`` is refused.

Before that come exact rules on a cleaned form: case, spacing, separators, decoration, the order of words, version
numbers and words that only qualify. Typing errors are looked for in the entries, and in synonyms long enough that a slip
can't turn one word into another. Every value is looked up where it stands, once per batch and kept per worker, so the
most frequent value of the data needs no shuffle.

Null and blank values give no row; a value with no entry gives id 0. Very long values are cleaned whole and match only
by equality. Repeated entries of an array give one row. Terms that are equal after cleaning go to the smaller id.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from itertools import permutations, product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolemill.llm.lexicon import QUALIFIERS, SHORT, SYNONYMS

_LONG: dict[str, list[str]] = {}
for _short, _long in SHORT.items():
    _LONG.setdefault(_long, []).append(_short)
_QUALIFIERS = sorted(QUALIFIERS, key=lambda q: (-len(q), q))
#: Entries of the reference list; checked before anything of it is collected or broadcast.
MAX_TERMS = 100_000
MAX_KEYS = 2_000_000
NO_TERM = 0
_ROWS = ("qwertyuiop", "asdfghjkl", "zxcvbnm")
_NEAR = {a + b for r in _ROWS for a, b in zip(r, r[1:])} | {b + a for r in _ROWS for a, b in zip(r, r[1:])}
_NEAR |= {p for up, down in zip(_ROWS, _ROWS[1:]) for k, a in enumerate(up) for b in down[max(0, k - 1) : k + 1] for p in (a + b, b + a)}


def clean(value: str) -> str:
    """Lower case without accents, decoration and remarks."""
    s = unicodedata.normalize("NFKD", value)
    s = "".join(ch for ch in s if unicodedata.category(ch) != "Mn").casefold()
    s = re.sub(r"[(\[]\s*(?:required|preferred|must have|nice to have|optional|plus)\s*[)\]]", " ", s)
    return re.sub(r"\s[-–—:]\s*(?:required|preferred|must have|nice to have|optional|a plus)\b.*", " ", s).strip()


def compact(cleaned: str) -> str:
    return re.sub(r"[^\w+#]|_", "", cleaned)


def sorted_words(cleaned: str) -> str:
    return " ".join(sorted(SHORT.get(w, w) for w in re.findall(r"[^\W_]+[+#]*", cleaned)))


def weighted_distance(typed: str, entry: str) -> float:
    """Restricted Damerau-Levenshtein with costs of typing: swap 0.8, doubled letter 0.6, neighbouring key 0.7, a changed first letter 1.3."""
    before, row = [], [float(j) for j in range(len(entry) + 1)]
    for i, x in enumerate(typed, 1):
        new = [float(i)]
        for j, y in enumerate(entry, 1):
            if x == y:
                change = 0.0
            else:
                change = (0.7 if x + y in _NEAR else 1.0) + (0.3 if i == j == 1 else 0.0)
            more = 0.6 if i > 1 and x == typed[i - 2] else 1.0
            best = min(row[j - 1] + change, row[j] + more, new[j - 1] + 1.0)
            if i > 1 and j > 1 and x == entry[j - 2] and typed[i - 2] == y:
                best = min(best, before[j - 2] + 0.8)
            new.append(best)
        before, row = row, new
    return row[-1]


def edits(a: str, b: str) -> int:
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            best = min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1)
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, before[j - 2] + 1)
            new.append(best)
        before, row = row, new
    return row[-1]


def deletions(key: str, most: int) -> set[str]:
    found = level = {key}
    for _ in range(most):
        level = {k[:i] + k[i + 1 :] for k in level for i in range(len(k))}
        found = found | level
    return found


def allowed(key: str, synonym: bool) -> int:
    """How many edits an entry may be away from: none for the shortest, and fewer for synonyms."""
    if synonym:
        return 1 if len(key) >= 8 else 0
    return 0 if len(key) <= 3 else 1 if len(key) <= 5 else 2


class Dictionary:
    """The lookup structure of one field."""

    def __init__(self, terms: list[tuple[int, str]], synonyms: dict[str, str], frequency: dict[int, int]) -> None:
        self.frequency, self.exact, self.ordered, self.bare, self.joined = frequency, {}, {}, {}, {}
        self.entries: list[tuple[str, int, int]] = []
        self.deleted: dict[str, list[int]] = defaultdict(list)
        ids = {}
        for term_id, term in sorted(terms):
            ids.setdefault(clean(term), term_id)
            self._add(term, term_id, False)
        for term, names in synonyms.items():
            for name in names.split(","):
                if term in ids:
                    self._add(name, ids[term], True)
        self.longest = max((len(k) for k, _, _ in self.entries), default=0) + 2

    def _add(self, name: str, term_id: int, synonym: bool) -> None:
        c = clean(name)
        key = compact(c)
        if not key:
            return
        self.exact.setdefault(key, term_id)
        words = re.findall(r"[^\W_]+[+#]*", c)
        for spelled in product(*([w, *_LONG.get(w, ())] for w in words)) if len(words) <= 3 else ():
            for turned in permutations(spelled):
                self.joined.setdefault("".join(turned), term_id)
        self.ordered.setdefault(sorted_words(c), term_id)
        if bare := self._bare(c):
            self.bare.setdefault(bare, term_id)
        if most := allowed(key, synonym):
            self.entries.append((key, term_id, most))
            for d in deletions(key, most):
                self.deleted[d].append(len(self.entries) - 1)

    @staticmethod
    def _bare(cleaned: str) -> str:
        """Without versions and words that only qualify; nothing when that leaves no word."""
        words = re.findall(r"[^\W_]+[+#]*", re.sub(r"(?<=[^\W\d_])[ ._-]*\d+(?:\.[\dx]+)*\+?(?=\W|$)", " ", re.sub(r"(?<=\+)\d+", "", cleaned)))
        return " ".join(sorted(SHORT.get(w, w) for w in words if w not in QUALIFIERS))

    def find(self, value: str) -> int:
        c = clean(value)
        key = compact(c)
        if not key:
            return NO_TERM
        if key in self.exact:
            return self.exact[key]
        words = sorted_words(c)
        if words in self.ordered:
            return self.ordered[words]
        bare = self._bare(c)
        if bare and bare in self.bare:
            return self.bare[bare]
        if key in self.joined:
            return self.joined[key]
        for q in _QUALIFIERS:
            if key.endswith(q) and key[: -len(q)] in self.exact:
                return self.exact[key[: -len(q)]]
        if len(key) > self.longest:
            return NO_TERM
        seen = {e for d in deletions(key, 2) for e in self.deleted.get(d, ())}
        ranked = [
            (weighted_distance(key, entry), -self.frequency.get(term_id, 0), term_id)
            for entry, term_id, most in (self.entries[e] for e in seen)
            if edits(key, entry) <= min(most, 2 if len(key) > 5 else 1)
        ]
        return min(ranked)[2] if ranked else NO_TERM


def map_values(values: DataFrame, terms: DataFrame, value_col: str = "raw_value", field_col: str = "field", synonyms: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """The rows of ``values`` with term_id added; terms has term_id, field and term and is small (its size is checked)."""
    if terms.count() > MAX_TERMS:
        raise ValueError("the reference list is too large to broadcast its dictionary")
    known = values.join(F.broadcast(terms.select("term_id", F.col("field").alias(field_col), "term")), [field_col]).where(F.lower(F.trim(value_col)) == F.col("term"))
    frequency = {r["term_id"]: r["n"] for r in known.groupBy("term_id").agg(F.count("*").alias("n")).collect()}
    by_field: dict[str, list[tuple[int, str]]] = defaultdict(list)
    for r in terms.select("term_id", "field", "term").collect():
        if r["term"] is not None:
            by_field[r["field"]].append((r["term_id"], r["term"]))
    synonyms = SYNONYMS if synonyms is None else synonyms
    books = {f: Dictionary(t, synonyms.get(f, {}), frequency) for f, t in by_field.items()}
    if sum(len(b.deleted) for b in books.values()) > MAX_KEYS:
        raise ValueError("the reference list is too large to broadcast its dictionary")
    model = values.sparkSession.sparkContext.broadcast(books)
    schema = values.select(field_col, value_col)
    rest = [c for c in values.columns if c not in (field_col, value_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[tuple[str, str], int] = {}
        for b in batches:
            n = len(rest)
            ids = []
            for pair in zip(b.column(n).to_pylist(), b.column(n + 1).to_pylist()):
                if pair not in kept:
                    if len(kept) > 200_000:
                        kept.clear()
                    book = model.value.get(pair[0])
                    kept[pair] = book.find(pair[1]) if book and pair[1] else NO_TERM
                ids.append(kept[pair])
            yield pa.record_batch([*b.columns, pa.array(ids, pa.int32())], names=[*rest, field_col, value_col, "term_id"])

    ordered = values.select(*rest, *schema.columns)
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.schema.fields)
    return ordered.mapInArrow(run, f"{out}, term_id int")
