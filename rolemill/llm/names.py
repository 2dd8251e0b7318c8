"""Variant spellings of company names: which of the names that people typed mean the same company.

Method: metric-space partitioning. A name is reduced to its two distinctive words (decoration, legal form, line of
business and place are set apart); the distance of two names is the true Damerau-Levenshtein distance of their words
under the better of both orders, which is a metric on unordered pairs. Pivots are drawn from the names; every name
belongs to the cell of its nearest pivot and is copied to the cells where the triangle inequality leaves a partner
possible: d(x, p) <= d(x, nearest) + 2 r, and, for every other pivot q, d(x, q) within r of the range that the cell's own
names have from q. The second rule leaves a few copies of a name; the first alone, in a space of so many dimensions, a
third of all cells. Exact radius joins run within the cells, so no pair within the radius is missed, and no cell holds
more than a bounded share of the names. All distinctive words count;
pairs with more than 64 letters have cells by length in place of pivots.

Beyond typing errors, a name can stand for a company in ways that no radius covers; these are links by equality:

* an initial syllable for the first word ("Ren. Fenpinul Foundation"), joined on the other word and the line of business;
* a trade name, which belongs to its company when some value gives both.

The links' components are the companies. Values that name no company (blank, "confidential", ...) are in none. Names are
compared as stored; the work is done on distinct names, so a name that holds a third of all rows counts once. Nulls are
ignored, very long values are parsed whole, other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolemill.llm.components import connected_components
from rolemill.session import materialize, release

# Words of company names that don't tell companies apart.
LEGAL = frozenset("inc incorporated llc ltd limited gmbh ag plc co company corp corporation sa bv oy ab kg pty intl international holding holdings".split())
BUSINESS = frozenset(
    """academy advisory aerospace agency agricultural airlines apparel association assurance authority automotive aviation bancorp bank banking
    biosciences biotech bottling broadcasting builders capital care catering centers chemicals clinics cloud college communications construction
    consulting county cyber dairy defense design devices diagnostics digital distribution education electric electronics energy engineering
    entertainment equipment farms financial foods foundation freight games group health healthcare home hospital hotels industries instruments
    insurance institute interiors labs laboratories learning lines logistics management manufacturing marine market materials media medical metals
    mills mining motors mutual networks optics outfitters packaging partners petroleum pharmaceuticals plastics power press products properties
    public publishing railways realty relief research resorts restaurants retail robotics savings schools security semiconductors services shipping
    software solutions staffing steel stores studios supply systems talent technologies textiles tooling trading transport travel utilities
    ventures water wireless works""".split()
)
FILLER = frozenset("the of and at for in a an careers career jobs job team hiring hq headquarters remote hybrid office early us usa now we are hub".split())
NOBODY = frozenset("confidential undisclosed disclosed stealth startup unknown none anonymous private employer client unnamed various tbd not specified multiple recruiter withheld blank null".split())
ALIAS = re.compile(r"\s*[-–—,(]?\s*\b(?:d/b/a|dba|doing business as|also known as|a/k/a|aka|trading as|t/a|formerly known as|formerly|previously)\b\s*", re.I)
MAX_WORDS = 2
#: Pairs of words with more letters meet by their length, as distances to pivots would be slow.
LONG_NAME, LENGTHS = 64, 8
PAIRS_PER_TASK = 600_000
#: Cells of a pivot, and how many of the pivots filter cells: the ranges take at most 4,096 x SPLITS x FILTERS x 2 bytes.
SPLITS, FILTERS = 32, 192


def _abbreviates(short: str, word: str) -> bool:
    it = iter(word)
    return short[0] == word[0] and len(short) < len(word) and all(ch in it for ch in short)


_known: dict[str, str | None] = {}


def business_word(token: str) -> str | None:
    """The word of BUSINESS that a token is or abbreviates (constr, mgmt, svcs, soln's), else None."""
    if token not in _known:
        t = token.replace("'", "")
        if len(_known) > 200_000:
            _known.clear()
        found = t if t in BUSINESS else (t[:-1] if t.endswith("s") and t[:-1] in BUSINESS else None)
        if found is None and f"{t}s" in BUSINESS:
            found = f"{t}s"
        if found is None and 2 <= len(t) <= 7:
            # the beginning of a word, perhaps with a plural s; or its consonants; or what an apostrophe leaves
            stem = t[:-1] if t.endswith("s") and len(t) > 3 else t
            begins = [w for w in BUSINESS if len(stem) >= 3 and w.startswith(stem)]
            drops = [w for w in BUSINESS if (not set(t) & set("aeiou") or "'" in token) and _abbreviates(t, w)]
            found = min(begins or drops, key=lambda w: (len(w), w), default=None)
        _known[token] = found
    return _known[token]


def _plain(name: str) -> str:
    s = unicodedata.normalize("NFKD", "".join(" " if unicodedata.category(ch) == "So" else ch for ch in name))
    s = "".join(" " if (k := unicodedata.category(ch)) in ("So", "Sk", "Cs", "Cn", "Cf", "Co", "Cc") else ch for ch in s if unicodedata.category(ch) != "Mn")
    s = s.replace("’", "'").replace("_", " ")
    s = re.sub(r"(?<=[a-z])(?=[A-Z][a-z])", " ", s)
    s = re.sub(r"\b(?:[A-Za-z]\.){2,}(?:[A-Za-z]\b)?", lambda m: m.group().replace(".", "") + " ", s)
    return s


def _words(part: str) -> tuple[list[str], set[str], bool]:
    """Distinctive words, line of business, and whether words were of the kind that names nobody."""
    core, line, nobody = [], set(), False
    for t in re.findall(r"[^\W_]+(?:'[^\W_]+)*", part.lower()):
        if t in NOBODY:
            nobody = True
        elif t in LEGAL or t in FILLER:
            continue
        elif (b := business_word(t)) is not None:
            line.add(b)
        else:
            core.append(t.replace("'", ""))
    return core, line, nobody


def _initials(text: str) -> bool:
    return bool(re.fullmatch(r"\s*[A-Z][A-Z0-9&. ]{1,5}\s*", text))


def _section(part: str) -> tuple[list[str], set[str]]:
    """Words of one stretch of a name; what follows a comma or dash counts only as far as words are missing."""
    core, line = [], set()
    for piece in re.split(r"\s+[-–—|]\s+|[,|]\s*", part):
        c, b, _ = _words(piece)
        if len(core) < MAX_WORDS:
            core += c[: MAX_WORDS if not core else MAX_WORDS - len(core)] if core else c
            line |= b
    return core, line


def parse(name: str | None) -> tuple[list[tuple[tuple[str, ...], frozenset[str]]], bool]:
    """The (words, line of business) that a value gives, the main one first, and whether it names a company.

    A line of business is a set of beginnings, as abbreviations tell no more ("Pub." of publishing or public).
    """
    if not name or not name.strip() or re.fullmatch(r"\W*n\W{0,2}a\W*", name, re.I):
        return [], False
    s = _plain(name)
    inner = re.findall(r"[(\[]([^)\]]*)[)\]]", s)
    outer = re.sub(r"[(\[][^)\]]*[)\]]", " ", s)
    parts = [p for p in re.split(r"\s+/\s+", " \x00 ".join(ALIAS.split(outer)).replace("\x00", " / ")) if p.strip()]
    found = [x for p in parts if (x := _section(p))[0] or x[1]]
    main = next((x for x in found if x[0]), None)
    for text in inner:
        plain = ALIAS.sub(" ", text)
        core, line = _section(plain)
        if not core or _initials(text):
            if main is None and core and not found:
                main = (core, line)
                found = [main]
            continue
        if main is None or (len(main[0]) == 1 and len(core) == 1 and found[0][1]):
            base = main or (found[0] if found else ([], set()))
            main = (base[0] + core, base[1] | line)
            found = [main, *[f for f in found if f is not base]]
        else:
            found.append((core, line))
    out = []
    for core, line in found:
        if core:
            words = tuple(dict.fromkeys(core))
            if not any(words == w for w, _ in out):
                out.append((words, frozenset(w[:3] for w in (line - {"group"} or line))))
    return out, bool(out)


def distance(a: str, b: str) -> int:
    """True Damerau-Levenshtein distance (a metric, unlike the restricted one)."""
    last: dict[str, int] = {}
    far = len(a) + len(b)
    d = [[far] * (len(b) + 2) for _ in range(len(a) + 2)]
    for i in range(len(a) + 1):
        d[i + 1][1] = i
    for j in range(len(b) + 1):
        d[1][j + 1] = j
    for i in range(1, len(a) + 1):
        match = 0
        for j in range(1, len(b) + 1):
            k, m = last.get(b[j - 1], 0), match
            cost = 1
            if a[i - 1] == b[j - 1]:
                cost, match = 0, j
            d[i + 1][j + 1] = min(d[i][j] + cost, d[i + 1][j] + 1, d[i][j + 1] + 1, d[k][m] + (i - k - 1) + 1 + (j - m - 1))
        last[a[i - 1]] = i
    return d[-1][-1]


def pair_distance(x: tuple[str, str], y: tuple[str, str]) -> int:
    """Of two unordered pairs of words."""
    return min(distance(x[0], y[0]) + distance(x[1], y[1]), distance(x[0], y[1]) + distance(x[1], y[0]))


def _coded(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(map(len, words), default=0)
    out = np.zeros((longest, len(words)), np.int32)
    for k, w in enumerate(words):
        out[: len(w), k] = np.frombuffer(w.encode("utf-32-le"), np.int32)
    return out, np.array([len(w) for w in words], np.int64)


def distances(words: list[str], pivot: str) -> np.ndarray:
    """distance(w, pivot) for all words at once."""
    a, n = _coded(words)
    b = np.frombuffer(pivot.encode("utf-32-le"), np.int32)
    rows, cols, each = a.shape[0], len(b), np.arange(len(words))
    far = np.int32(rows + cols + 1)
    d = np.full((rows + 2, cols + 2, len(words)), far, np.int32)
    d[1:, 1] = np.arange(rows + 1, dtype=np.int32)[:, None]
    d[1, 1:] = np.arange(cols + 1, dtype=np.int32)[:, None]
    letters = {c: k for k, c in enumerate(dict.fromkeys(b.tolist()))}
    last = np.zeros((len(letters), len(words)), np.int64)
    for i in range(1, rows + 1):
        match = np.zeros(len(words), np.int64)
        for j in range(1, cols + 1):
            same = a[i - 1] == b[j - 1]
            k = last[letters[b[j - 1].item()]]
            jump = d[k, match, each] + (i - k) + (j - match - 1)
            best = np.minimum(np.minimum(d[i, j] + ~same, d[i + 1, j] + 1), np.minimum(d[i, j + 1] + 1, jump))
            d[i + 1, j + 1] = best
            match = np.where(same, j, match)
        for c, k in letters.items():
            last[k] = np.where(a[i - 1] == c, i, last[k])
    return d[n + 1, cols + 1, each]


def _bags(words: list[str]) -> np.ndarray:
    """Letter counts: half their difference never exceeds the distance."""
    out = np.zeros((len(words), 37), np.int16)
    for k, w in enumerate(words):
        for ch in w:
            o = ord(ch)
            out[k, o - 97 if 97 <= o < 123 else 26 + o - 48 if 48 <= o < 58 else 36] += 1
    return out


def _cell_pairs(radius: int):
    def run(table: pa.Table) -> pa.Table:
        first, second, home = table.column("a").to_pylist(), table.column("b").to_pylist(), np.asarray(table.column("home"))
        bag = _bags([x + y for x, y in zip(first, second)])
        inside, out = np.flatnonzero(home), []
        for start in range(0, len(inside), 64):
            mine = inside[start : start + 64]
            more, less = np.zeros((len(mine), len(first)), np.int16), np.zeros((len(mine), len(first)), np.int16)
            for k in range(bag.shape[1]):
                diff = bag[mine, k][:, None] - bag[None, :, k]
                more += np.maximum(diff, 0)
                less += np.maximum(-diff, 0)
            row, col = np.nonzero(np.maximum(more, less) <= radius)
            for i, j in zip(mine[row].tolist(), col.tolist()):
                x, y = (first[i], second[i]), (first[j], second[j])
                if x != y and (home[j] == 0 or x < y) and pair_distance(x, y) <= radius:
                    out.append((*x, *y, pair_distance(x, y)))
        cols = list(zip(*out)) or [[]] * 5
        return pa.table({"a": pa.array(cols[0], pa.string()), "b": pa.array(cols[1], pa.string()), "c": pa.array(cols[2], pa.string()), "d": pa.array(cols[3], pa.string()), "distance": pa.array(cols[4], pa.int32())})

    return run


def _bytes(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(rows)], pa.binary())


def _rows(col: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint8).reshape(-1, width)


def cell_of(far: np.ndarray) -> np.ndarray:
    """The home of every name: its nearest pivot, and which of SPLITS groups the next one belongs to."""
    near = far.argmin(axis=1)
    rest = far.copy()
    rest[np.arange(len(far)), near] = 255
    return near * SPLITS + rest.argmin(axis=1) % SPLITS


def visited_cells(far: np.ndarray, low: np.ndarray, high: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(name, cell): the cells that may hold a partner within the radius of a name.

    far: names x pivots; low, high: cells x filters, the least and the largest distance of a cell's own names from each of
    the first pivots. By the triangle inequality a partner's distance from a pivot differs by the radius at most, so a cell
    whose range excludes that for any of them is not visited; nor are those of a pivot that is further than the nearest by
    more than twice the radius.
    """
    reach = far.astype(np.int16)
    name, pivot = np.nonzero(reach <= reach.min(axis=1, keepdims=True) + 2 * radius)
    name, cell = np.repeat(name, SPLITS), (pivot[:, None] * SPLITS + np.arange(SPLITS)[None]).ravel()
    held = (low <= high).all(axis=1)[cell]
    name, cell = name[held], cell[held]
    floor, ceiling = low.astype(np.int16) - radius, high.astype(np.int16) + radius
    # the filters in pieces: most cells are out after the first of them
    for start in range(0, low.shape[1], 8):
        d, piece = reach[name, start : start + 8][:, : low.shape[1] - start], slice(start, start + 8)
        ok = ((d >= floor[cell, piece]) & (d <= ceiling[cell, piece])).all(axis=1)
        name, cell = name[ok], cell[ok]
    return name, cell


def radius_pairs(pairs: DataFrame, radius: int, pivots: int | None = None, home_rows: int = 2048) -> DataFrame:
    """(a, b, c, d, distance): the word pairs (a, b) and (c, d) within the radius, each couple at least once.

    pairs has columns a, b and must be distinct and materialized. Pivots are a bounded sample (at most 4,096) that is
    broadcast, as are the ranges of the cells (see SPLITS). A name is kept with its distances from
    all pivots, which say where it is home, and which other cells may hold a partner (``visited_cells``). The cells of a
    pivot with many names of its own are cut by home name.
    """
    spark, n = pairs.sparkSession, pairs.count()
    wanted = pivots or int(min(4096, max(4, 4 * n**0.5)))
    size = F.length("a") + F.length("b")
    chosen = pairs.where(size <= LONG_NAME).orderBy(F.xxhash64("a", "b"), "a", "b").limit(wanted).collect()
    model, width = spark.sparkContext.broadcast([(r["a"], r["b"]) for r in chosen]), len(chosen)
    filters = min(width, FILTERS)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 2048):
                b = whole.slice(start, 2048)
                x, y = b.column(0).to_pylist(), b.column(1).to_pylist()
                words = sorted({*x, *y})
                at = {w: k for k, w in enumerate(words)}
                ix, iy = np.array([at[w] for w in x]), np.array([at[w] for w in y])
                seen: dict[str, np.ndarray] = {}
                far = np.empty((len(x), width), np.uint8)
                for k, (p, q) in enumerate(model.value):
                    for w in (p, q):
                        if w not in seen:
                            seen[w] = distances(words, w)
                    dp, dq = seen[p], seen[q]
                    far[:, k] = np.minimum(dp[ix] + dq[iy], dq[ix] + dp[iy])
                yield pa.record_batch([b.column(0), b.column(1), pa.array(cell_of(far).astype(np.int32)), _bytes(far)], names=["a", "b", "mine", "far"])

    # the work is names x pivots: an even share for every task
    tasks = max(spark.sparkContext.defaultParallelism, -(-n * wanted // PAIRS_PER_TASK))
    measured = materialize(pairs.where(size <= LONG_NAME).select("a", "b").repartition(tasks, "a", "b").mapInArrow(measure, "a string, b string, mine int, far binary"), "measured")

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full((width * SPLITS, filters), 255, np.uint8), np.zeros((width * SPLITS, filters), np.uint8)
        for b in batches:
            if b.num_rows:
                mine, far = b.column(0).to_numpy(), _rows(b.column(1), width)[:, :filters]
                np.minimum.at(low, mine, far)
                np.maximum.at(high, mine, far)
        some = np.flatnonzero((low <= high).all(axis=1))
        yield pa.record_batch([pa.array(some.astype(np.int32)), _bytes(low[some]), _bytes(high[some])], names=["mine", "low", "high"])

    def joined(table: pa.Table) -> pa.Table:
        low, high = (_rows(table.column(c).combine_chunks(), filters) for c in ("low", "high"))
        return pa.table({"mine": table.column("mine").slice(0, 1), "low": _bytes(low.min(axis=0)[None]), "high": _bytes(high.max(axis=0)[None])})

    kind = "mine int, low binary, high binary"
    found = measured.select("mine", "far").mapInArrow(ranges, kind).groupBy("mine").applyInArrow(joined, kind).collect() if width else []  # one row a cell
    low, high = np.full((width * SPLITS, filters), 255, np.uint8), np.zeros((width * SPLITS, filters), np.uint8)
    for r in found:
        low[r["mine"]], high[r["mine"]] = np.frombuffer(r["low"], np.uint8), np.frombuffer(r["high"], np.uint8)
    table = spark.sparkContext.broadcast((low, high))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                b = whole.slice(start, 1024)
                mine = b.column(2).to_numpy()
                row, cell = visited_cells(_rows(b.column(3), width), *table.value, radius)
                yield pa.record_batch([b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)), pa.array(cell.astype(np.int32)), pa.array((mine[row] == cell).astype(np.int32))], names=["a", "b", "cell", "home"])

    placed = measured.mapInArrow(cells, "a string, b string, cell int, home int")
    # lengths differ by the radius at most: a long pair visits the cells of all lengths that its partners can have
    at = lambda c: (-1 - F.floor(c / LENGTHS)).cast("int")
    spots = F.array_distinct(F.transform(F.sequence(size - radius, size + radius), at))
    long = pairs.where(size > LONG_NAME - radius).select("a", "b", F.explode(spots).alias("cell"))
    placed = placed.union(long.withColumn("home", ((F.col("cell") == at(size)) & (size > LONG_NAME)).cast("int")))
    placed = materialize(placed, "cells")  # read twice
    release(measured)
    sizes = placed.groupBy("cell").agg(F.sum("home").alias("h")).collect()  # one row a cell
    grid = spark.createDataFrame([(r["cell"], max(1, -(-r["h"] // home_rows))) for r in sizes] or [(0, 1)], "cell int, parts int")
    part = F.pmod(F.xxhash64("a", "b"), F.col("parts")).cast("int")
    # a name is home in one part of its cell and a visitor in the others
    spread = placed.join(F.broadcast(grid), "cell").withColumn("mine", part).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    spread = spread.select("a", "b", "cell", "part", F.when((F.col("home") == 1) & (F.col("part") == F.col("mine")), 1).otherwise(0).alias("home"))
    return spread.groupBy("cell", "part").applyInArrow(_cell_pairs(radius), "a string, b string, c string, d string, distance int").distinct()


_PARSED = "name string, cores array<struct<a:string,b:string,line:array<string>>>"


def _parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("a", pa.string()), ("b", pa.string()), ("line", pa.list_(pa.string()))]))
    for b in batches:
        out = []
        for name in b.column(0).to_pylist():
            cores, _ = parse(name)
            out.append([{"a": (w := sorted((words[0], " ".join(words[1:]))))[0], "b": w[1], "line": sorted(line)} for words, line in cores])
        yield pa.record_batch([b.column(0), pa.array(out, kind)], names=["name", "cores"])


def link_names(df: DataFrame, name_col: str, radius: int = 2, short: int = 4) -> DataFrame:
    """(name, company): every distinct value that names a company, and the company's id (its smallest core)."""
    names = df.select(F.col(name_col).cast("string").alias("name")).where(F.col("name").isNotNull()).distinct()
    parsed = materialize(names.mapInArrow(_parse_batches, _PARSED).where(F.size("cores") > 0), "names")
    given = parsed.select("name", F.explode("cores").alias("c")).select("name", "c.a", "c.b", "c.line")
    cores = materialize(given.groupBy("a", "b").agg(F.array_distinct(F.flatten(F.collect_set("line"))).alias("line")), "cores")
    key = lambda a, b: F.concat_ws("|", a, b)
    near = radius_pairs(cores.select("a", "b"), radius)
    other = cores.select(F.col("a").alias("c"), F.col("b").alias("d"), F.col("line").alias("line_2"))
    # a different line of business speaks against two spellings; names at two edits must share it
    same_line = F.arrays_overlap("line", "line_2")
    no_line = (F.size("line") == 0) | (F.size("line_2") == 0)
    spelled = near.join(cores, ["a", "b"]).join(other, ["c", "d"]).where(same_line | (no_line & (F.col("distance") <= 1)))
    spelled = spelled.select(key("a", "b").alias("x"), key("c", "d").alias("y"))
    # an initial syllable for one of the two words
    turned = lambda df: df.select(F.col("a").alias("t"), F.col("b").alias("w"), "a", "b", "line").union(df.select(F.col("b"), F.col("a"), "a", "b", "line"))
    cut = turned(cores).where((F.length("t") <= short) & (F.length("t") > 0) & (F.length("w") > short))
    full = turned(cores).where((F.length("t") > short) & (F.length("w") > short)).select(F.col("t").alias("t2"), "w", F.col("a").alias("c"), F.col("b").alias("d"), F.col("line").alias("line_2"))
    syllable = cut.join(full, "w").where(F.startswith("t2", "t") & same_line).select(key("a", "b").alias("x"), key("c", "d").alias("y"))
    main = F.element_at("cores", 1)
    both = parsed.where(F.size("cores") > 1).select(key(main["a"], main["b"]).alias("x"), F.explode(F.slice("cores", 2, F.size("cores"))).alias("o")).select("x", key("o.a", "o.b").alias("y"))
    joined = connected_components(spelled.union(syllable).union(both), "x", "y", "core", "company")
    own = parsed.select("name", key(main["a"], main["b"]).alias("core"))
    return own.join(joined, "core", "left").select("name", F.coalesce("company", "core").alias("company"))


def name_pairs(linked: DataFrame) -> DataFrame:
    """(name_a, name_b): all pairs of different names of one company, the smaller by code point first."""
    several = linked.groupBy("company").agg(F.count("*").alias("n")).where("n > 1").select("company")
    both = linked.join(several, "company")
    return both.select("company", F.col("name").alias("name_a")).join(both.select("company", F.col("name").alias("name_b")), "company").where("name_a < name_b").select("name_a", "name_b")
