"""Worked examples of the column expressions and of alias resolution."""

from collections import Counter
from itertools import combinations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpweave.functions import text
from corpweave.functions.dates import month_year
from corpweave.operators import resolve
from corpweave.operators.components import connected_components
from corpweave.operators.similarity import ratio, similar_pairs, unshared
from corpweave.plans import queries
from tests.differential import DATA


def one(spark, expression, *values, **named):
    df = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(expression(*[F.col(f"c{i}") for i in range(len(values))]).alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("f", "value", "expected"),
    [
        (text.normalize_source_type, " edgar ", "SEC"),
        (text.normalize_source_type, "NCBI E-utilities", "PUBMED"),
        (text.normalize_source_type, "PatentsView", "USPTO"),
        (text.normalize_source_type, "foo", "FOO"),
        (text.normalize_whitespace, "a b\u001cc  d", "a b c d"),
        (text.is_date_like, "11-JUL", True),
        (text.is_date_like, "7-May", True),
        (text.is_date_like, "Sept-3", True),
        (text.is_date_like, "11-JULY", False),
        (text.is_date_like, "111-JUL", False),
        (text.is_reasonable_seed, "11-Jul", False),
        (text.is_reasonable_seed, "JUL-11", True),
        (text.is_reasonable_seed, "A", False),
        (text.is_reasonable_seed, "123", False),
        (text.is_reasonable_seed, "TBD", False),
        (text.lookup_name, "HAPPY SONIC GLOBAL CO., LTD.", "HAPPY SONIC GLOBAL"),
        (text.lookup_name, "S.A. Foo", "S A FOO"),
        (text.lookup_name, "CO.", None),
        (text.company_name, "Johnson & Johnson", "JOHNSON AND JOHNSON"),
        (text.company_name, "p<0.05", "P 0 05"),
        (text.company_name, "X INC. (A DIVISION OF Y)", "X INC"),
        (text.base_name, "ACME CO INC", "ACME"),
        (text.legal_suffixes, "ACME CO INC", "CO;INC"),
        (text.base_name, "CO", ""),
        (text.base_name, "CO ACME", "CO ACME"),
        (text.legal_suffixes, "ACMECO", ""),
        (text.acronym, "NATIONAL INSTITUTES OF HEALTH", "NIH"),
        (text.acronym, "JOHNSON AND JOHNSON", "JJ"),
        (text.acronym, "PFIZER", ""),
        (month_year, "07-2023", "Jul-23"),
        (month_year, "2023", None),
        (month_year, None, None),
    ],
)
def test_expression(spark, f, value, expected):
    assert one(spark, f, value) == expected


@pytest.mark.parametrize(
    ("name", "source", "expected"),
    [("Pfizer", "SEC", True), ("Pfizer", "USPTO", False), ("GSK", "USPTO", True), ("10X Genomics", "USPTO", True), ("AB", "SEC", False), ("A&B", "SEC", True), ("Company", "SEC", False), ("", "SEC", False)],
)
def test_plausible(spark, name, source, expected):
    assert one(spark, text.is_plausible_company, name, source) is expected


@pytest.mark.parametrize(
    ("sentence", "source", "expected"),
    [
        ("acme acquired beta", "SEC", ("ACQUIRED", "acquired")),
        ("community-acquired, and acme acquired beta", "SEC", ("", "")),
        ("a co-assignee", "USPTO", ("FILED_PATENT_WITH", "co-assignee")),
        ("acme is joint assignee of beta", "EDGAR", ("FILED_PATENT_WITH", "joint assignee")),
        ("nothing", None, ("", "")),
    ],
)
def test_detected(spark, sentence, source, expected):
    assert tuple(one(spark, text.detected_relation, sentence, source)) == expected


def mentions(spark, names):
    rows = [(i, n, 0, len(n)) for i, n in enumerate(names)]
    return spark.createDataFrame(rows, "source_id long, raw_mention string, start_char int, end_char int")


def test_alias_groups(spark):
    names = ["Acme Inc.", "Acme Inc.", "ACME", "Acme Corporation", "Acme Corporation", "NIH", "National Institutes of Health", "Zeta", "—", "Food and Drug Administration", "US Food and Drug Administration"]
    rows, queue = resolve.resolved(mentions(spark, names))
    got = {r["source_id"]: r for r in rows.collect()}
    assert len(got) == len(names)
    assert {got[i]["canonical_name"] for i in range(5)} == {"Acme Corporation"}
    assert got[5]["canonical_name"] == "National Institutes of Health" == got[6]["canonical_name"]
    assert (got[7]["merge_decision"], got[7]["merge_confidence"]) == ("singleton", 1.0)
    assert (got[8]["canonical_name"], got[8]["canonical_group_id"]) == ("—", None)
    assert got[9]["merge_decision"] == got[10]["merge_decision"] == "review_needed"
    reviews = [tuple(r) for r in queue.collect()]
    assert reviews == [("Food and Drug Administration", "US Food and Drug Administration", "FOOD AND DRUG ADMINISTRATION", "US FOOD AND DRUG ADMINISTRATION", 0.9492, 0.66, "high_string_similarity_review")]
    numbers = {r["canonical_group_id"] for r in got.values()} - {None}
    assert numbers == set(range(1, len(numbers) + 1))


def test_similar_pairs_are_all_found(spark):
    names = [f"{a} {b}{c}" for a in ("GRAND HOTEL", "GRAND HOTELS", "THE GRAND HOTEL", "SMALL INN") for b in ("PARIS", "PARMA", "LONDON") for c in ("", " INC", "S")]
    df = spark.createDataFrame(list(enumerate(names)), "ord long, name string")
    got = {(r["name_a"], r["name_b"]) for r in similar_pairs(df).collect()}
    assert got == {(a, b) for a, b in combinations(names, 2) if ratio(a, b) >= 0.86}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=15))
def test_components(spark, edges):
    label = {x: x for e in edges for x in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    expected = {n: c for n, c in label.items() if any(n in e and e[0] != e[1] for e in edges)}
    df = spark.createDataFrame(edges, "src long, dst long")
    assert {r["node"]: r["component"] for r in connected_components(df).collect()} == expected


def test_acronyms_are_of_the_base(spark):
    names = ["Johnson and Johnson Co", "JJC", "JJ", "CO INC", "CI"]
    rows = {r["raw_mention"]: r["canonical_group_id"] for r in resolve.resolved(mentions(spark, names))[0].collect()}
    assert rows["Johnson and Johnson Co"] == rows["JJ"] != rows["JJC"] and rows["CO INC"] == rows["CI"]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["AB", "A", "B", "ABC ", " X", "Q1", "HOUSE OF "]), min_size=1, max_size=9).map("".join), min_size=2, max_size=60, unique=True))
def test_no_similar_pair_is_lost(spark, names):
    df = spark.createDataFrame(list(enumerate(names)), "ord long, name string")
    got = {(r["name_a"], r["name_b"]) for r in similar_pairs(df).collect()}
    assert got == {(a, b) for a, b in combinations(names, 2) if ratio(a, b) >= 0.86}


def test_bigrams_that_names_alike_lack():
    for a, b in (("ABCDEFGHIJKLMNOP", "ABCDEFGHIJKLM"), ("ABCDEFGHIJ", "ABXCDEFGHIJ"), ("X" * 450, "X" * 340)):
        lacks = sum((Counter(a[i : i + 2] for i in range(len(a) - 1)) - Counter(b[i : i + 2] for i in range(len(b) - 1))).values())
        assert ratio(a, b) >= 0.86 and lacks <= unshared(len(a), 0.86)


def plain_pairs(names):
    """The rules for pairs of names, one pair at a time."""
    out = []
    for (a, base_a, short_a), (b, base_b, short_b) in combinations(names, 2):
        bare = [x.replace(" ", "") for x in (a, b)]
        if (base_a and base_a == base_b) or (len(bare[0]) >= 2 and bare[0] == short_b) or (len(bare[1]) >= 2 and bare[1] == short_a):
            continue
        s = ratio(a, b)
        if s >= 0.96:
            out.append((a, b, s, "auto_merge", 0.89, "very_high_string_similarity"))
        elif s >= 0.91:
            out.append((a, b, s, "review_needed", 0.66, "high_string_similarity_review"))
        elif s >= 0.86 and (base_a[:10] == base_b[:10] or base_a.endswith(base_b) or base_b.endswith(base_a)):
            out.append((a, b, s, "review_needed", 0.58, "shared_long_base_review"))
    return out


def test_pair_rules_of_the_queries(spark):
    sf = str(DATA / "sf0.001")
    near = queries.view(spark, sf, "near_names")
    rows = sorted(resolve.distinct_names(near).collect(), key=lambda r: tuple(r["ord"]))
    names = [(r["name"], r["base"], r["short"]) for r in rows]
    want = plain_pairs(names)
    assert len({w[5] for w in want}) == 3
    assert {tuple(r) for r in queries.Q["similarity_pairs"](spark, sf).collect()} == {(a, b, ratio(a, b)) for (a, *_), (b, *_) in combinations(names, 2) if ratio(a, b) >= 0.86}
    assert Counter({(r.decision, r.reason): r.n_pairs for r in queries.Q["pair_rule_counts"](spark, sf).collect()}) == Counter((w[3], w[5]) for w in want)
    raw = {r["name"]: r["raw"] for r in rows}
    queue = Counter(tuple(r) for r in queries.Q["review_queue"](spark, sf).collect())
    assert queue == Counter((raw[a], raw[b], a, b, round(s, 4), c, why) for a, b, s, d, c, why in want if d == "review_needed")
    decided = {r.raw_mention: (r.merge_decision, r.merge_confidence) for r in resolve.resolved(near)[0].collect()}
    merged = {x for a, b, _, d, *_ in want if d == "auto_merge" for x in (a, b)}
    reviewed = {x for a, b, _, d, *_ in want if d == "review_needed" for x in (a, b)}
    for name, text_ in raw.items():
        if name in merged:
            assert decided[text_] == ("auto_merge", 0.9)
        elif name in reviewed:
            assert decided[text_][0] in ("review_needed", "auto_merge")
