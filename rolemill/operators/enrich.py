"""Seams where models and fetched pages come in: embedding, answers, postings, address resolution."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rolemill.functions.normalize import clean_skills, jaccard, strip, title_tokens
from rolemill.functions.text import is_aggregator, strip_markup, unfenced

Embedder = Callable[[list[str]], list[list[float]]]


def hash_embedder(dim: int = 64) -> Embedder:
    """A deterministic stand-in for a model: words hashed to signed places, the sum scaled to length 1."""

    def embed(texts: list[str]) -> list[list[float]]:
        import xxhash

        out = []
        for t in texts:
            v = np.zeros(dim)
            for w in t.lower().split():
                h = xxhash.xxh64_intdigest(w.encode())
                v[h % dim] += 1.0 if h >> 63 else -1.0
            n = np.linalg.norm(v)
            out.append((v / n if n else v).tolist())
        return out

    return embed


def embed(rows: DataFrame, key: str, text: str, factory: Callable[[], Embedder] = hash_embedder, batch: int = 256) -> DataFrame:
    """(key, embedding, error): vectors of texts in batches; a batch that fails or comes back short is tried text by text.

    A text that fails alone has a null vector and the error; blank texts have neither.
    """

    def one(model: Embedder, t: str) -> tuple[list[float] | None, str | None]:
        try:
            return model([t])[0], None
        except Exception as e:
            return None, f"{type(e).__name__}: {e}"[:200]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = factory()
        for b in batches:
            texts = b.column(1).to_pylist()
            got: list[tuple] = [(None, None)] * len(texts)
            todo = [i for i, t in enumerate(texts) if t and t.strip()]
            for k in range(0, len(todo), batch):
                part = todo[k : k + batch]
                try:
                    vectors = model([texts[i] for i in part])
                    if len(vectors) != len(part):
                        raise ValueError("vectors are missing")
                    got_part = [(v, None) for v in vectors]
                except Exception:
                    got_part = [one(model, texts[i]) for i in part]
                for i, g in zip(part, got_part):
                    got[i] = g
            yield pa.record_batch([b.column(0), pa.array([g[0] for g in got], pa.list_(pa.float32())), pa.array([g[1] for g in got], pa.string())], names=[key, "embedding", "error"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, F.col(text).cast("string").alias(text)).mapInArrow(run, f"`{key}` {kind}, embedding array<float>, error string")


_ANSWER = "struct<industry:string,company_size:string,required_skills:array<string>,sponsorship:boolean>"


def parse_answer(answer: Column, sizes: tuple[str, ...] = ("startup", "midsize", "large"), most: int = 15) -> Column:
    """A model's JSON answer, fenced or not, as a struct of clean values; null where it isn't an object."""
    a = F.from_json(unfenced(answer), _ANSWER)
    industry = F.nullif(F.regexp_replace(F.lower(strip(a["industry"])), r"[\s-]+", "_"), F.lit(""))
    size = F.lower(strip(a["company_size"]))
    clean = F.struct(industry.alias("industry"), F.when(size.isin(*sizes), size).otherwise("unknown").alias("company_size"), F.coalesce(clean_skills(a["required_skills"], most), F.array().cast("array<string>")).alias("required_skills"), a["sponsorship"].alias("sponsorship"))
    return F.when(F.startswith(unfenced(answer), F.lit("{")) & a.isNotNull(), clean)


_POSTING = "struct<title:string,content:string,description:string,descriptionPlain:string,location:struct<name:string>,lists:array<struct<text:string,content:string>>>"


def posting_details(body: Column, text_chars: int = 5000) -> Column:
    """(title, location, description, sections) of one posting's JSON, whichever of the usual fields holds the text."""
    p = F.from_json(body, _POSTING)
    text = F.coalesce(F.nullif(p["descriptionPlain"], F.lit("")), F.nullif(strip_markup(p["content"]), F.lit("")), F.nullif(strip_markup(p["description"]), F.lit("")))
    return F.when(p.isNotNull(), F.struct(strip(p["title"]).alias("title"), p["location"]["name"].alias("location"), F.substring(text, 1, text_chars).alias("description"), labelled_sections(p["lists"]).alias("sections")))


def labelled_sections(lists: Column) -> Column:
    """Lists under headings as responsibilities, qualifications and benefits, by what the headings contain."""

    def under(*words: str) -> Column:
        hit = F.filter(F.coalesce(lists, F.array().cast("array<struct<text:string,content:string>>")), lambda x: F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(F.lower(x["text"]), w)))
        items = F.flatten(F.transform(hit, lambda x: F.regexp_extract_all(x["content"], F.lit(r"(?is)<li[^>]*>(.*?)</li>"), 1)))
        return F.filter(F.transform(items, strip_markup), lambda s: s != "")

    return F.struct(under("responsib", "you will", "you'll do").alias("responsibilities"), under("qualif", "require", "you have", "you bring").alias("qualifications"), under("benefit", "perk", "offer").alias("benefits"))


def best_target(primary: Column, resolved: Column) -> Column:
    """Which address to fetch: a resolved one of the employer, else the listing's own unless an aggregator's, else what there is."""
    ok = lambda c: F.coalesce(c, F.lit("")) != ""
    direct = lambda c: F.when(ok(c) & ~is_aggregator(c), c)
    return F.coalesce(direct(resolved), direct(primary), F.when(ok(primary), primary), F.when(ok(resolved), resolved))


def fetch_outcomes(rows: DataFrame, bodies: DataFrame, key: str = "job_id", least_chars: int = 200) -> DataFrame:
    """(key, outcome, text): success, failed, skip_no_url or closed_at_source, from landed bodies (key, api_text, page_text, closed).

    The interface's text counts if it's long enough, else the rendered page's.
    """
    both = rows.select(key, "primary_url").join(bodies, key, "left")
    usable = lambda c: F.when(F.length(strip(F.col(c))) >= least_chars, F.col(c))
    text = F.coalesce(usable("api_text"), usable("page_text"))
    outcome = F.when(F.coalesce("primary_url", F.lit("")) == "", "skip_no_url").when(F.coalesce("closed", F.lit(False)), "closed_at_source").when(text.isNotNull(), "success").otherwise("failed")
    return both.select(key, outcome.alias("outcome"), F.when(outcome == "success", text).alias("text"))


def resolve_addresses(jobs: DataFrame, results: DataFrame, least: float = 0.4) -> DataFrame:
    """(job_id, url, strategy, similarity): the first search result whose title is close enough to the listing's.

    results has job_id, strategy (smaller is tried first), position, url and title; aggregators don't count.
    """
    cand = results.where(~is_aggregator(F.col("url"))).join(jobs.select("job_id", "role_title"), "job_id")
    cand = cand.withColumn("similarity", jaccard(title_tokens(F.col("role_title")), title_tokens(F.col("title")))).where(F.col("similarity") >= least)
    first = Window.partitionBy("job_id").orderBy("strategy", "position", "url")
    return cand.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").select("job_id", "url", "strategy", F.round("similarity", 6).alias("similarity"))


def job_links(pages: DataFrame, base: str = "base_url", body: str = "body", doc: str = "doc") -> DataFrame:
    """(doc, position, title, url) of markdown links whose path looks like a job and whose title is 6 to 199 characters; relative ones made absolute."""
    found = pages.select(doc, base, F.posexplode(F.regexp_extract_all(body, F.lit(r"(\[[^\]]+\]\([^)\s]+\))"), 1)).alias("position", "link"))
    title, url = strip(F.regexp_extract("link", r"\[([^\]]+)\]", 1)), F.regexp_extract("link", r"\]\(([^)\s]+)\)", 1)
    root = F.regexp_extract(F.col(base), r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    whole = F.when(F.startswith(url, F.lit("/")), F.concat(root, url)).otherwise(url)
    ok = url.rlike(r"(?i)/(jobs?|careers?|positions?|openings?|postings?|roles?)(/|$|\?)") & (F.length(title) >= 6) & (F.length(title) <= 199)
    return found.where(ok).select(doc, "position", title.alias("title"), whole.alias("url"))


def run_status(stages: DataFrame) -> DataFrame:
    """(status) of a run from (stage, core, ok): failed if every core stage failed, partial if some stage did, else success."""
    a = stages.agg(F.count_if("core").alias("core"), F.count_if(F.col("core") & ~F.col("ok")).alias("bad"), F.count_if(~F.col("ok")).alias("any_bad"))
    return a.select(F.when((F.col("core") > 0) & (F.col("bad") == F.col("core")), "failed").when(F.col("any_bad") > 0, "partial").otherwise("success").alias("status"))
