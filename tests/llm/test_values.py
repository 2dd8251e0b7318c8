from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rolemill.llm import canon, names
from rolemill.llm.lexicon import SYNONYMS
from tests.compare import connect

WORDS = st.text("abcd", max_size=6)


@settings(max_examples=200, deadline=None)
@given(WORDS, WORDS, WORDS)
def test_name_distance_is_a_metric(a, b, c):
    d = names.distance
    assert d(a, b) == d(b, a) and (d(a, b) == 0) == (a == b) and d(a, c) <= d(a, b) + d(b, c)


@settings(max_examples=100, deadline=None)
@given(st.lists(WORDS, min_size=1, max_size=8), WORDS)
def test_distances_at_once_equal_one_by_one(words, pivot):
    assert names.distances(words, pivot).tolist() == [names.distance(w, pivot) for w in words]


def test_a_swap_is_one_edit_also_with_a_letter_between():
    assert names.distance("ca", "ac") == 1 and names.distance("ca", "abc") == 2


def test_radius_pairs_equal_all_pairs(spark):
    rng = random.Random(11)
    base = ["".join(rng.choice("abcde") for _ in range(rng.randint(3, 7))) for _ in range(40)]
    pairs = set()
    for _ in range(150):
        x, y = rng.choice(base), rng.choice(base)
        if rng.random() < 0.6 and x:
            k = rng.randrange(len(x))
            x = x[:k] + rng.choice(["", "q", x[k] * 2]) + x[k + 1 :]
        pairs.add(tuple(sorted((x, y))))
    pairs = sorted(pairs)
    df = spark.createDataFrame(pairs, "a string, b string")
    for radius, pivots, home in ((1, 5, 2048), (2, 12, 7)):
        got = {tuple(sorted(((r.a, r.b), (r.c, r.d)))) for r in names.radius_pairs(df, radius, pivots, home).collect()}
        want = {(p, q) for i, p in enumerate(pairs) for q in pairs[i + 1 :] if names.pair_distance(p, q) <= radius}
        assert got == want


CASES = {
    "Rensiza Brisulzon Biosciences PLC": "A", "rensiza  brisulzon biosciences": "A", "Rénsiza Brisulzon Biosciences": "A", "Rensiza Brisulzon": "A", "Rensiza_Brisulzon": "A", "RensizaBrisulzon Biosciences": "A",
    "Biosciences of Rensiza Brisulzon": "A", "Biosciences (Rensiza Brisulzon)": "A", "Rensiz Biosciences (Brisulzon)": "A", "Ren. Brisulzon Biosciences": "A", "Rensiza Brisulzon Biosciences - Oakturn office": "A",
    "★ Rensiza Brisulzno Biosciences ™": "A", "Rensiza Brisulzon Biosciences PLC d/b/a Rensibrisul": "A", "Rensibrisul": "A", "Careers at Rensiza Brisulzon Biosciences": "A", "Rensiza Brisulzon Biosciences (RBB)": "A",
    "Rensiza Zonrenri Automotive Group AG": "B", "Rensiza Zonrenri Automotive Grp A.G.": "B", "Ren. Zonrenri Automotive Group": "B", "Tagolvi": "C", "Lorenpi-Vorkormor Aerospace Co": "D", "Aerospace, Vorkormor Lorenpi": "D",
}
NOBODY = ["", "  ", "-", "N/A", "n.a.", "Confidential", "(undisclosed)", "Stealth Startup", "Hiring Company", None]


def test_variants_of_companies(spark):
    df = spark.createDataFrame([(n, "x") for n in [*CASES, *NOBODY, *list(CASES)[:3]]], "company_name string, name string")
    linked = {r.name: r.company for r in names.link_names(df, "company_name").collect()}
    assert set(linked) == set(CASES)
    groups = {}
    for n, c in CASES.items():
        groups.setdefault(c, set()).add(linked[n])
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == 4
    found = {tuple(r) for r in names.name_pairs(names.link_names(df, "company_name")).collect()}
    assert found == {tuple(sorted((a, b))) for a in CASES for b in CASES if a != b and CASES[a] == CASES[b]}


def test_all_words_and_all_other_names_count(spark):
    first, many = "Quorvane Beltrix Monfrel Saldyne", "Ozwick Tarmel" + "".join(f" (Yulno{c} Prandek{c})" for c in "abcdefghijkl")
    tail = " ".join(f"{w}xoq{w}{w}" for w in "bdfghjklmnprst")
    rows = [f"{first} Tirobal", f"{first} Zukdemar", f"{first} Tirobel", many, "Yulnol Prandekl", f"{first} {tail} Wexfarn", f"{first} {tail} Wexfern", f"{first} {tail} Hodrimul"]
    linked = {r.name: r.company for r in names.link_names(spark.createDataFrame([(n,) for n in rows], "company_name string"), "company_name").collect()}
    one, other, typo, alias, last, long, slip, apart = (linked[n] for n in rows)
    assert one == typo != other and alias == last and long == slip != apart
    assert len({one, other, alias, long, apart}) == 5


def test_names_of_nothing_and_long_names(spark):
    empty = spark.createDataFrame([], "company_name string")
    assert names.link_names(empty, "company_name").count() == 0
    long = spark.createDataFrame([("Acme " * 3000,), ("Zörb " + "x" * 5000,)], "company_name string")
    assert names.link_names(long, "company_name").count() == 2


@pytest.mark.parametrize("token,word", [("constr", "construction"), ("mgmt", "management"), ("svcs", "services"), ("soln's", "solutions"), ("prods", "products"), ("grp", "group"), ("ren", None), ("ba", None), ("kelmorla", None)])
def test_business_words(token, word):
    assert names.business_word(token) == word


@pytest.fixture(scope="module")
def books(data):
    terms = connect(data).execute("SELECT term_id, field, term FROM canon_terms").fetchall()
    by = {}
    for i, f, t in terms:
        by.setdefault(f, []).append((i, t))
    ids = {(f, t): i for i, f, t in terms}
    return {f: canon.Dictionary(t, SYNONYMS[f], {}) for f, t in by.items()}, ids


@pytest.mark.parametrize(
    "field,value,term",
    [
        ("industry", "Agricullture", "agriculture"), ("industry", "farming", "agriculture"), ("industry", "estate, real", "real estate"), ("industry", "FOOD_PRODUCTION.", "food production"), ("industry", "mediation of disputes", None), ("industry", "none", None),
        ("seniority_level", "entrylevel", "entry level"), ("seniority_level", "Sr.", "senior"), ("seniority_level", "stafflevel", "staff"), ("seniority_level", "seniors' home", None), ("seniority_level", "International", None),
        ("required_skills", "C++17", "c++"), ("required_skills", "c#", "c#"), ("required_skills", "C", None), ("required_skills", "react 18", "react"), ("required_skills", "language processing, natural", "natural language processing"), ("required_skills", "• node.js", "node.js"),
        ("required_skills", "kotlin - preferred", "kotlin"), ("required_skills", "projectmgmt", "project management"), ("required_skills", "excellence", None), ("required_skills", "rusticity", None), ("required_skills", "x" * 9000, None), ("required_skills", "?!", None), ("required_skills", "pyhton", "python"),
    ],
)
def test_typed_values(books, field, value, term):
    dictionaries, ids = books
    assert dictionaries[field].find(value) == (ids[field, term] if term else 0)


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_every_entry_within_two_edits_is_found(data):
    entry = data.draw(st.sampled_from(["agriculture", "pharmaceuticals", "negotiation"]))
    d = canon.Dictionary([(1, "agriculture"), (2, "pharmaceuticals"), (3, "negotiation")], {}, {})
    typed = list(entry)
    for _ in range(data.draw(st.integers(0, 2))):
        k = data.draw(st.integers(0, len(typed) - 1))
        kind = data.draw(st.sampled_from("ids"))
        if kind == "d":
            typed.pop(k)
        elif kind == "i":
            typed.insert(k, data.draw(st.sampled_from("abcxyz")))
        else:
            typed[k] = data.draw(st.sampled_from("abcxyz"))
    assert d.find("".join(typed)) == {"agriculture": 1, "pharmaceuticals": 2, "negotiation": 3}[entry]


def test_ranking_prefers_the_likelier_slip_then_the_frequent():
    d = canon.Dictionary([(1, "abcdefgh"), (2, "abcdefgx")], {}, {2: 5})
    assert d.find("abcdefgg") == 1  # a neighbouring key or a doubled letter is likelier
    assert canon.Dictionary([(1, "abcdefqh"), (2, "abcdefzh")], {}, {2: 5}).find("abcdefuh") == 2


def test_map_values_on_tables(spark):
    terms = spark.createDataFrame([(5, "f", "Alpha Beta"), (4, "f", "alpha-beta"), (7, "f", None)], "term_id int, field string, term string")
    values = spark.createDataFrame([("j1", "f", "alpha beta", 1), ("j1", "f", "zzz", 2), ("j2", "unknown", "alpha beta", 3), ("j2", "f", None, 4)], "job_id string, field string, raw_value string, term_id_x int")
    got = {(r.job_id, r.field, r.raw_value): r.term_id for r in canon.map_values(values, terms).collect()}
    assert got == {("j1", "f", "alpha beta"): 4, ("j1", "f", "zzz"): 0, ("j2", "unknown", "alpha beta"): 0, ("j2", "f", None): 0}
    assert canon.map_values(values.limit(0), terms).count() == 0 and canon.map_values(values, terms.limit(0)).where("term_id <> 0").count() == 0


def test_typed_values_are_distinct_and_not_blank(spark):
    from rolemill.llm.queries_values import typed_values

    jobs = spark.createDataFrame([("j", " ", "Senior", ["a", "a", None, "", " b"]), ("k", None, None, None)], "job_id string, industry string, seniority_level string, required_skills array<string>")
    assert sorted((r.field, r.raw_value) for r in typed_values(jobs).collect()) == [("required_skills", " b"), ("required_skills", "a"), ("seniority_level", "Senior")]
