from __future__ import annotations

import random
import re
import unicodedata
from urllib.parse import parse_qs, urlencode, urlparse, urlunparse

import pytest
from pyspark.sql import functions as F

from rolemill.functions import normalize as N
from rolemill.functions import tables as T
from rolemill.functions import text as X


def evaluate(spark, column, *values, schema="v string"):
    rows = [(v,) for v in values]
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column.alias("r")).collect()]


def test_name_key_matches_a_model(spark):
    names = ["🔥 Acme™", "Acmé  &  Söhne", "a_b-c", "", None, "  x\ty  ", "ÄÖ 株式会社", "C++ / C#"]

    def model(raw):
        if raw is None:
            return None
        kept = "".join(ch for ch in raw if unicodedata.category(ch) not in ("So", "Sm", "Sk", "Cs", "Cn"))
        return " ".join(re.sub(r"[^\w\s]", " ", kept.lower()).split())

    assert evaluate(spark, N.name_key(F.col("v")), *names) == [model(n) for n in names]


def test_identity_ignores_decoration_but_not_feed(spark):
    rows = [("f", "🔥 Acme", "Dev"), ("f", "acme", " dev "), ("g", "acme", "dev")]
    a, b, c = (r[0] for r in spark.createDataFrame(rows, "s string, c string, r string").select(N.job_identity(F.col("s"), F.col("c"), F.col("r"))).collect())
    assert a == b != c and len(a) == 64


def test_content_hash_keeps_case(spark):
    a, b = (r[0] for r in spark.createDataFrame([("Acme", "Dev"), ("acme", "Dev")], "c string, r string").select(N.content_hash(F.col("c"), F.col("r"))).collect())
    assert a != b


@pytest.mark.parametrize("raw,key", [("Remote", "__remote__"), ("", "__no_loc__"), (None, "__no_loc__"), ("San Ordo, CA; Quillby", "san ordo"), (" New  York ", "new york")])
def test_place_key(spark, raw, key):
    assert evaluate(spark, N.place_key(F.col("v")), raw) == [key]


def test_place_buckets(spark):
    got = evaluate(spark, F.array_sort(N.place_buckets(F.col("v"))), "SF; NYC", "Remote, Boston", "San Francisco, CA", "", None)
    assert got == [["new york", "san francisco"], ["remote"], ["ca", "san francisco"], [], []]


def test_canonical_url_matches_the_standard_library_on_plain_addresses(spark):
    urls = ["https://A.Example/Jobs/1/?utm_source=x&b=2&a=1&b=3#top", "https://a.example/x?empty=&ref=1", "//a.example/p/", "a.example/p?x=1", "", "http://h", "https://a.example/?q=1"]

    def model(u):
        p = urlparse(u.strip())
        kept = {k: v for k, v in parse_qs(p.query, keep_blank_values=False).items() if k.lower() not in T.TRACKING_PARAMS}
        return urlunparse((p.scheme, p.netloc.lower(), p.path.rstrip("/"), p.params, urlencode(kept, doseq=True), ""))

    assert evaluate(spark, X.canonical_url(F.col("v")), *urls) == [model(u) for u in urls]


def test_canonical_url_of_null_is_empty(spark):
    assert evaluate(spark, X.canonical_url(F.col("v")), None, "x") == ["", "x"]


def test_title_stage_matches_python_rules(spark):
    titles = ["Associate Director", "Associate", "Summer 2026 Analyst", "summer analyst", "Sr. Dev", "Lead", "Developer", "Co-op", "Campus Hire", None, ""]
    model = lambda t: next((lab for lab, p in T.TITLE_STAGES if re.search(p, t or "", re.I)), "mid")
    assert evaluate(spark, X.title_stage(F.col("v")), *titles) == [model(t) for t in titles]


def test_title_rules_take_the_first(spark):
    titles = ["Principal Architect", "VP of Sales", "Chief People Officer", "Software Engineer Intern", "Entry-Level Nurse", "Clerk"]
    assert evaluate(spark, X.title_level(F.col("v")), *titles) == ["principal", "vp", "c_level", "intern", "entry_level", "mid_level"]


def test_title_function_is_one_bucket_or_none(spark):
    assert evaluate(spark, X.title_function(F.col("v")), "Data Engineer", "Front-end Developer", "Janitor", None) == [["data_analysis"], ["software_engineering"], [], []]


def test_text_skills_are_those_of_the_patterns(spark):
    """As the patterns say: a word border must follow the sign of c++ and c#."""
    texts = ["We use C++, C# and JavaScript; k8s. Not javascripts.", "Spring Boot, Next.js, SQL/R, scikit-learn, Google Cloud, workday", "", None]
    want = [["javascript", "kubernetes"], ["r", "sql", "next.js", "spring boot", "spring", "gcp", "scikit-learn", "workday"], [], []]
    assert evaluate(spark, X.text_skills(F.col("v")), *texts) == want


def test_text_skills_equal_every_pattern_tried_alone(spark):

    rng = random.Random(4)
    words = [w for name, _ in T.TEXT_SKILLS for w in name.split()] + "react.js reactjs golang go developer express server mongo lean six pmp html5 css3 k8s github sklearn r studio sas , / . the elastic search adobe cc".split()
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 12))) for _ in range(150)]
    want = [[name for name, p in T.TEXT_SKILLS if re.search(p, t)][:10] for t in texts]
    assert evaluate(spark, X.text_skills(F.col("v")), *texts) == want


def test_title_rules_beyond_the_tables_at_hand(spark):
    titles = ["Fullstack Engineer", "Policy Director", "Director of Content", "Machine-Learning Intern", "Product-Manager", "iOS Developer", "L&D Partner"]
    want = [["software_engineering"], ["public_sector_and_government"], ["arts_and_entertainment"], [], ["management_and_executive"], ["software_engineering"], ["human_resources"]]
    assert evaluate(spark, X.title_function(F.col("v")), *titles) == want
    assert evaluate(spark, X.title_skills(F.col("v")), "iOS and Android", "NLP Researcher, AI") == [["android", "ios", "kotlin", "swift"], ["deep learning", "machine learning", "nlp", "python"]]


def test_skills_keep_first_of_equal(spark):
    got = spark.createDataFrame([(["Golang", " go ", None, "SQL", "Sql"],), ([],), (None,)], "v array<string>").select(N.canonical_skills(F.col("v"))).collect()
    assert [r[0] for r in got] == [["go", "sql"], [], None]


def test_years_per_skill(spark):
    got = spark.createDataFrame([({"Node JS": "3", "sql": "-2", "x": "many"},)], "m map<string,string>").select(N.years_per_skill(F.col("m"))).first()[0]
    assert got == {"node_js": 3.0, "sql": 0.0}


def test_markup_and_entities(spark):
    assert evaluate(spark, X.plain_text(F.col("v")), "<p>a&amp;b<br/>c</p><script>x()</script>", "ﬁne​", None) == ["a&b c", "fine", None]


def test_moments(spark):
    got = evaluate(spark, X.parse_moment(F.col("v")).cast("string"), "1700000000", "1700000000000", "2024-01-02T03:04:05Z", "soon", None)
    assert got == ["2023-11-14 22:13:20", "2023-11-14 22:13:20", "2024-01-02 03:04:05", None, None]


def test_hosting_and_routes(spark):
    urls = ["https://boards.greenhouse.io/acme/jobs/1", "https://jobs.lever.co/globex/2", "https://x.example", "https://wd5.myworkdayjobs.com/a"]
    assert [(r["tier"], r["slug"]) for r in evaluate(spark, X.hosting(F.col("v")), *urls)] == [("greenhouse", "acme"), ("lever", "globex"), ("unknown", None), ("workday", None)]
    assert evaluate(spark, X.fetch_route(F.col("v")), *urls, "https://corp.example/wday/1") == ["greenhouse", "lever", "rendered", "workday", "workday"]


def test_unfenced(spark):
    assert evaluate(spark, X.unfenced(F.col("v")), '```json\n{"a": 1}\n```', "{}") == ['{"a": 1}', "{}"]


def test_no_python_in_native_functions(spark):
    plan = spark.createDataFrame([("x",)], "v string").select(N.name_key(F.col("v")), X.canonical_url(F.col("v")), X.title_level(F.col("v")))._jdf.queryExecution().toString()
    assert "EvalPython" not in plan


def test_registry_key(spark):
    assert evaluate(spark, X.registry_key(F.col("v")), "Ａcme ＆ Söns, Inc.", "globex-corp", "株式会社", None) == ["acme s ns inc", "globex corp", "", None]
