"""Keyword-stuffed and link-list pages.

Method: rank-frequency curves. Every page gives its frequency spectrum (how many words occur how often); SQL windows turn
spectra into ranks and fit log frequency on log rank, page by page. Its divergence from prose is that of its words from
the commonest words of a language (Kullback-Leibler over these words and the rest), as a part of that of a page of the
same length without any of them, for the language that fits best, as labels of languages are partly wrong. Common words and their shares are counted over all pages, a text once a task.

Extreme is what lies beyond the prose pages of comparable length (the same power of two of words): a divergence above
nine tenths of them, a slope outside all but a hundredth on either side, a residual above all but a hundredth. Prose is
every text of which ``listed_words`` finds no more than half of the words in lists, a text once; the bounds are ranks over
all of these, counted and compared on a grid of ``GRID``. At a length with fewer than ``least_prose`` prose pages every
page counts as extreme. Pages that are extreme in any of the three are nominated; a nominated page counts when more than
half of its words stand in lists, which ``listed_words`` counts stretch by stretch, once for every page.

A spectrum has few rows (a page's different frequencies), so what is shuffled doesn't grow with the length of texts, and
texts are not shuffled at all: their counts of listed words are. Statistics and bounds cover all pages; no page is sampled
or cut. Equal texts have equal hashes and are judged alike, wherever they stand.

The labels are those of the stretch, a line or a sentence: links; separators or commas in a row with hardly a function
word between; words without a sentence; the same words over and over; runs of short lines that end without a stop.
Null, empty and blank pages are no candidates. Pages with equal ids are judged each. Other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rolemill.session import materialize, release

# Function words of the languages written with Latin letters, without accents.
FUNCTION = frozenset(
    """a an and are as at be been but by can for from had has have he her his how if in is it its me my no not of on or our she so than that the their
    them they this to us was we were what when which who will with would you your
    aber alle als am an auf aus bei bis das dem den der des die ein eine einem einen einer es fur ihr ihre im in ist mit nach nicht noch oder ohne
    sich sie sind sowie uber um und uns unser unsere unter vom von vor war was wenn wie wir wird zu zum zur jemanden ihnen
    au aux avec ce ces cette comme dans de des du elle en est et il ils la le les leur nous ou par pas plus pour qu que qui sa sans se ses son sont
    sur un une vos votre vous l d ainsi
    al algun como con del donde e el ella en es esta los las lo mas muy nos nuestra nuestras nuestros o para pero por que se si sin sobre su sus tras
    una unas y tambien
    ao aos as com da das do dos ela ele em entre foi mais mas na nas no nos nossa nossos ou os pela pelo por quem ser seu sua sem sob um uma voce
    che di gli il io le lo nel non piu sono una""".split()
)
_LINK = re.compile(r"(?:https?:)?//\S|www\.|href=|\]\(|^[(<]?[\w-]+(?:\.[\w-]+)*\.[a-z]{2,10}/\S", re.I)
_MAY_LINK = re.compile(r"[wW]\.|[hH][rR][eE][fF]=|\]\(|\.[A-Za-z]{2,10}/")
_CODE = re.compile(r"[{}]|\":|[=!<>]=|\w = \w")
_MARKS = regex.compile(r"[\p{Mn}\p{Cf}]+")
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u30ff\u3400-\u9fff]")
_WORD = re.compile(r"[^\W_]+(?:['.-][^\W_]+)*")
_STOP = frozenset(".!?…。！？।؟\"'”»>)")
_SENTENCE = re.compile(r"(?<=[.!?…。！？।؟])[\"')\]”»]*\s+")
_BULLET = re.compile(r"^\s*(?:[-+*•–—>|#]+|\d+[.)])+\|?\s*")
SHORT_LINE, LINE_RUN = 9, 4


def _plain(text: str) -> str:
    return text if text.isascii() else _MARKS.sub("", unicodedata.normalize("NFKD", text))


class _Stretch:
    """A sentence, or a line's part of one."""

    __slots__ = ("line", "words", "core", "function", "ended", "label")

    def __init__(self, line: int, text: str, words: list[str]) -> None:
        self.line, self.words, self.label = line, words, None
        self.core = _WORD.findall(text.lower())
        self.function = sum(map(FUNCTION.__contains__, self.core))
        self.ended = words[-1][-1] in _STOP

    def content(self) -> list[str]:
        return [w for w in self.core if w not in FUNCTION]

    def judge(self, text: str, may_link: bool) -> str | None:
        words, n = self.words, len(self.words)
        if may_link and sum(bool(_LINK.search(w)) for w in words) >= 0.07 * n:
            return "links"
        repeats = len(self.core) - len(set(self.core))
        if self.function >= 0.12 * n and repeats < 0.42 * (len(self.core) - self.function):
            return None
        if not self.core or (("=" in text or "{" in text or "}" in text or '":' in text) and _CODE.search(text)):
            return None
        if self.function < 0.12 * n:
            if n >= 5 and sum(len(w) <= 2 and not w[0].isalnum() and not w[-1].isalnum() for w in words) >= 0.12 * n:
                return "separated"
            if n >= 4 and sum(w[-1] in ",;،、" for w in words) >= 0.25 * n:
                return "listed"
            latin = sum(w[0] < "\u0250" for w in self.core) > 0.5 * len(self.core)
            if latin and ((n >= 5 and not self.ended) or (n >= 9 and self.function < 0.06 * n)):
                return "keywords"
            if latin and n >= 3:
                return "again?"
        if n >= 8:
            content = self.content()
            if content and len(content) - len(set(content)) >= 0.42 * len(content):
                return "repeated"
        return None


def listed_words(text: str) -> tuple[int, int, int]:
    """How many of a page's words (split at white space) stand in lists or repetitions, how many there are, and how many carry sentences."""
    plain = _plain(text).replace("\\n", "\n")
    parts: list[_Stretch] = []
    short: list[bool] = []
    for line in plain.split("\n"):
        body = _BULLET.sub("", line)
        if not body.strip():
            continue
        # what the pattern can't do without is looked for first
        may_link = ("/" in body or "w." in body or "W." in body or "](" in body or "=" in body) and ("//" in body or _MAY_LINK.search(body) is not None)
        count = 0
        for s in _SENTENCE.split(body):
            if words := s.split():
                count += len(words)
                part = _Stretch(len(short), s, words)
                part.label = part.judge(s, may_link)
                parts.append(part)
        # sentences end at blanks, so their words are the line's
        short.append(count <= SHORT_LINE and body.rstrip()[-1] not in _STOP)
    if any(p.label == "again?" for p in parts):
        times = Counter(tuple(p.core) for p in parts)
        for p in parts:
            if p.label == "again?":
                p.label = "keywords" if times[tuple(p.core)] >= 3 else None
    # runs of short lines without a stop: title, link and tag lists
    inside: set[int] = set()
    k = 0
    while k < len(short):
        end = k
        while end < len(short) and short[end]:
            end += 1
        if end - k >= LINE_RUN:
            inside.update(range(k, end))
        k = end + 1
    # a short stretch beside repetitions of one line belongs to them
    for i, p in enumerate(parts):
        if p.label is None and len(p.words) <= 8:
            for j in (i - 1, i + 1):
                if 0 <= j < len(parts) and parts[j].label == "repeated" and parts[j].line == p.line:
                    content = set(p.content())
                    if 2 * len(content & set(parts[j].core)) >= len(content):
                        p.label = "beside"
    listed = sum(len(p.words) for p in parts if p.label or p.line in inside)
    return listed, sum(len(p.words) for p in parts), sum(p.function + p.ended for p in parts)


#: Common words of a language; languages with fewer pages, and more languages than that, have no table of their own.
HEAD_WORDS, LEAST_PAGES, MOST_LANGUAGES = 200, 30, 64
#: Words a page is taken to have had beside its own, spread as in prose.
PRIOR_WORDS = 2.0
#: Steps of the grid on which slopes, residuals and divergences are counted for their ranks.
GRID = 1e-4


def _tokens(text: str) -> list[str]:
    """Words in lower case; of scripts that set no blanks between words, every character."""
    low = text.lower()
    return (low if low.isascii() else _UNSPACED.sub(r" \g<0> ", low)).split()


def _word_shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, pages, share): of every different text of a task, how often words occur in how many texts; word null: all."""
    seen: set[int] = set()
    pages: dict[tuple[str, str | None], list[float]] = defaultdict(lambda: [0.0, 0.0])

    def flush() -> pa.RecordBatch:
        cols = [[k[0] for k in pages], [k[1] for k in pages], [v[0] for v in pages.values()], [v[1] for v in pages.values()]]
        out = pa.record_batch([pa.array(c, t) for c, t in zip(cols, [pa.string(), pa.string(), pa.float64(), pa.float64()])], names=["lang", "word", "pages", "share"])
        pages.clear()
        return out

    for b in batches:
        for key, lang, text in zip(*(c.to_pylist() for c in b.columns)):
            words = _tokens(text) if text else []
            if not words or key in seen:
                continue
            if len(seen) > 4_000_000:
                seen.clear()
            seen.add(key)
            lang, part = (lang or "und").lower(), 1 / len(words)
            pages[lang, None][0] += 1
            for w, c in Counter(words).items():
                # a common word is short
                if len(w) <= 16:
                    one = pages[lang, w]
                    one[0] += 1
                    one[1] += c * part
        if len(pages) > 2_000_000:
            yield flush()
    yield flush()


def common_words(texts: DataFrame) -> list[tuple[str, str, float]]:
    """(language, word, mean share in a page) of the commonest words by pages: at most HEAD_WORDS x MOST_LANGUAGES rows."""
    counted = materialize(texts.mapInArrow(_word_shares, "lang string, word string, pages double, share double").groupBy("lang", "word").agg(F.sum("pages").alias("pages"), F.sum("share").alias("share")), "words")
    known = counted.where(F.col("word").isNull() & (F.col("pages") >= LEAST_PAGES) & (F.col("lang") != "und")).orderBy(F.desc("pages"), "lang").limit(MOST_LANGUAGES).select("lang", F.col("pages").alias("all"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("pages"), "word"))
    top = counted.where(F.col("word").isNotNull()).join(F.broadcast(known), "lang").withColumn("rank", rank).where(F.col("rank") <= HEAD_WORDS)
    found = [(r["lang"], r["word"], r["share"] / r["all"]) for r in top.collect()]
    release(counted)
    return found


def _divergence(heads: list[tuple[str, str, float]]):
    """A function of word counts (one Counter a page) that gives each page's smallest divergence from a language's prose, as a
    part of that of a page of the same length without any common word."""
    langs = sorted({h[0] for h in heads})
    at = {w: k for k, w in enumerate(sorted({h[1] for h in heads}))}
    shares = np.zeros((len(langs), len(at)))
    for lang, word, share in heads:
        shares[langs.index(lang), at[word]] = share
    rest = np.maximum(1e-6, 1 - shares.sum(axis=1))
    own = np.where(shares > 0, shares * np.log(np.where(shares > 0, shares, 1)), 0).sum(axis=1) + rest * np.log(rest)

    def of(pages: list[Counter]) -> np.ndarray:
        if not langs or not pages:
            return np.zeros(len(pages))
        count = np.zeros((len(pages), len(at)))
        for k, c in enumerate(pages):
            for w in c.keys() & at.keys():
                count[k, at[w]] = c[w]
        total, out = np.array([c.total() for c in pages], float), np.full(len(pages), np.inf)
        for k in range(len(langs)):
            head = shares[k] > 0
            q = (count[:, head] + PRIOR_WORDS * shares[k][head]) / (total + PRIOR_WORDS)[:, None]
            left = np.maximum(1e-6, 1 - q.sum(axis=1))
            far = own[k] - np.log(q) @ shares[k][head] - rest[k] * np.log(left)
            none = PRIOR_WORDS * shares[k][head][None] / (total + PRIOR_WORDS)[:, None]
            out = np.minimum(out, far / (own[k] - np.log(none) @ shares[k][head] - rest[k] * np.log(np.maximum(1e-6, 1 - none.sum(axis=1)))))
        return out

    return of


def _pages(heads: list[tuple[str, str, float]]):
    kind = pa.list_(pa.struct([("f", pa.int32()), ("v", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        far = _divergence(heads)
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                b = whole.slice(start, 1024)
                keys, counts = [], []
                for key, text in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                    if c := Counter(_tokens(text) if text else ()):
                        keys.append(key)
                        counts.append(c)
                spectra = [[{"f": f, "v": v} for f, v in sorted(Counter(c.values()).items(), reverse=True)] for c in counts]
                yield pa.record_batch([pa.array(keys, pa.int64()), pa.array([c.total() for c in counts], pa.int32()), pa.array(far(counts), pa.float64()), pa.array(spectra, kind)], names=["key", "words", "divergence", "spectrum"])

    return run


def page_curves(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(key, words, size, divergence, slope, residual) of every different text with a word; key is the text's hash.

    slope and residual are those of log frequency on log rank; pages whose words all occur equally often have slope 0.
    """
    raw = df.select(F.xxhash64(F.col(text_col).cast("string")).alias("key"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    pages = raw.mapInArrow(_pages(common_words(raw)), "key bigint, words int, divergence double, spectrum array<struct<f:int,v:int>>")
    pages = materialize(pages.dropDuplicates(["key"]), "pages")
    points = pages.select("key", F.inline("spectrum"))
    upto = Window.partitionBy("key").orderBy(F.desc("f")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # v words share a frequency: they stand at the ranks up to their running count, and weigh as one point at the middle
    ranked = points.withColumn("last", F.sum("v").over(upto)).withColumn("x", F.ln(F.col("last") - F.col("v") / 2 + 0.5)).withColumn("y", F.ln("f"))
    explained = F.coalesce(F.pow(F.regr_sxy("y", "x"), 2) / F.nullif(F.regr_sxx("y", "x"), F.lit(0.0)), F.lit(0.0))
    left = F.greatest(F.coalesce(F.regr_syy("y", "x"), F.lit(0.0)) - explained, F.lit(0.0))
    slope = F.coalesce(F.regr_slope("y", "x"), F.lit(0.0))
    fit = ranked.groupBy("key").agg(slope.alias("slope"), F.sqrt(left / F.count("*")).alias("residual"))
    return pages.drop("spectrum").join(fit, "key").withColumn("size", F.floor(F.log2(F.col("words").cast("double"))).cast("int"))


def _labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[int, tuple[int, int]] = {}
    for b in batches:
        found = []
        for key, text in zip(b.column("key").to_pylist(), b.column("text").to_pylist()):
            if key not in known:
                if len(known) > 400_000:
                    known.clear()
                known[key] = listed_words(text or "")[:2]
            found.append(known[key])
        yield pa.record_batch([b.column("id"), b.column("key"), pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.int32())], names=["id", "key", "listed", "words"])


def labelled(texts: DataFrame) -> DataFrame:
    """(id, key, listed, words) of every page of texts (id, key, text), materialized."""
    return materialize(texts.where(F.col("text").isNotNull()).select("id", "key", "text").mapInArrow(_labels, "id string, key bigint, listed int, words int"), "labels")


def _step(name: str) -> Column:
    return F.round(F.col(name) / GRID).cast("bigint")


def prose_bounds(curves: DataFrame, labels: DataFrame, share: float, divergent: float, tail: float, least_prose: int) -> DataFrame:
    """(size, far, steep, flat, rough), in steps of the grid, over all different prose texts: a row for every power of two.

    A bound is the value at a rank. What is ranked are counted steps: as many as the grid has, however many pages there are.
    """
    prose = labels.groupBy("key").agg((F.first("listed") <= share * F.first("words")).alias("prose")).where("prose").select("key")
    stats = F.explode(F.array(*(F.struct(F.lit(n).alias("stat"), _step(n).alias("step")) for n in ("divergence", "slope", "residual"))))
    steps = curves.join(prose, "key").select("size", stats.alias("s")).groupBy("size", "s.stat", "s.step").agg(F.count("*").alias("n"))
    whole = Window.partitionBy("size", "stat")
    ranked = steps.withColumn("upto", F.sum("n").over(whole.orderBy("step"))).withColumn("all", F.sum("n").over(whole))
    at = lambda stat, q: F.min(F.when((F.col("stat") == stat) & (F.col("upto") > q * (F.col("all") - 1)), F.col("step")))
    bounds = [at("divergence", divergent).alias("far"), at("slope", tail).alias("steep"), at("slope", 1 - tail).alias("flat"), at("residual", 1 - tail).alias("rough")]
    return ranked.where(F.col("all") >= least_prose).groupBy("size").agg(*bounds)


def extreme(curves: DataFrame, labels: DataFrame, share: float = 0.5, divergent: float = 0.9, tail: float = 0.01, least_prose: int = 10) -> DataFrame:
    """The curves that are extreme in slope, residual or divergence, by the bounds of all prose pages among labels."""
    table = materialize(prose_bounds(curves, labels, share, divergent, tail, least_prose), "bounds")
    c = F.col
    typical = (_step("divergence") < c("far")) & _step("slope").between(c("steep"), c("flat")) & (_step("residual") <= c("rough"))
    return curves.join(F.broadcast(table), "size", "left").where(~F.coalesce(typical, F.lit(False))).select(*curves.columns)


def nominate(curves: DataFrame, texts: DataFrame, share: float = 0.5, **bounds: float) -> DataFrame:
    """The curves of the pages that are extreme in slope, residual or divergence; texts: (id, key, text)."""
    return extreme(curves, labelled(texts), share, **bounds)


def stuffed_pages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", share: float = 0.5, **bounds: float) -> DataFrame:
    """(id, slope, residual, divergence, listed, words): pages of which more than ``share`` of the words stand in lists."""
    texts = df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("key", F.xxhash64("text"))
    curves = materialize(page_curves(df, text_col, lang_col), "curves")
    labels = labelled(texts)
    listed = labels.where(F.col("listed") > share * F.col("words"))
    judged = listed.join(extreme(curves, labels, share, **bounds).drop("words"), "key")
    return judged.select(F.col("id").cast(df.schema[id_col].dataType).alias(id_col), "slope", "residual", "divergence", "listed", "words")
