"""Steps whose work has to grow with the input, not with its square."""

from itertools import combinations

from pyspark.sql import functions as F

from corpweave.functions import text
from corpweave.operators import resolve, similarity
from corpweave.sources import filings


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_matched_cik_compares_no_pairs(spark):
    names = ["acme", "Acme Corp of Köln", "", "x", None, "zeta", "aa"]
    rows = [(3, "c3", "ACME"), (1, "c1", "THE ACME CORP"), (2, "c2", "KÖLN"), (None, "c0", "ZETA"), (5, "c5", "AAAA"), (6, None, "AA"), (7, "c7", None)]
    for more in ([], [(4, "c4", "")]):
        titles = [*rows, *more]
        want = {}
        for seed in names:
            hits = [(o, c) for o, c, t in titles if seed is not None and t is not None and (seed.upper() in t or t in seed.upper())]
            if hits:
                want[seed] = min((h for h in hits if h[0] is not None), default=(None, None))[1]
        df = filings.matched_cik(spark.createDataFrame([(n,) for n in names], "seed string"), spark.createDataFrame(titles, "ord int, cik string, title string"))
        assert {r.seed: r.cik for r in df.collect()} == want
    pairs = [x for x in plan(df).split("\n") if "NestedLoop" in x and "contains" in x.lower()]
    assert not pairs
    assert filings.matched_cik(spark.createDataFrame([("",)], "seed string"), df.select(F.lit(1).alias("ord"), "cik", F.col("seed").alias("title")).limit(0)).count() == 0


def test_similar_pairs_keep_a_row_a_name(spark, monkeypatch):
    kept, write = [], similarity.written
    monkeypatch.setattr(similarity, "written", lambda df, label: kept.append(write(df, label)) or kept[-1])
    monkeypatch.setattr(similarity, "CHUNK", 16, raising=False)
    names = [f"THE HOUSE OF {i * 7919 % 4096:03X} INC" for i in range(120)] + ["A" * 70, "A" * 71 + "B", "Ä" * 9, "Ä" * 8, "A", "B"]
    df = spark.createDataFrame([(-i, n) for i, n in enumerate(names)], "ord long, name string")
    want = {(b, a) for a, b in combinations(names, 2) if similarity.ratio(b, a) >= 0.97}
    assert {(r.name_a, r.name_b) for r in similarity.similar_pairs(df, 0.97).collect()} == want
    assert max(x.count() for x in kept) <= len(names) + len(want)


def test_texts_are_cut_and_normalised_once(spark):
    assert str(text.sentences(F.col("x"))).count("split(") == 1
    assert str(text.joined_text(F.col("x"), F.col("y"), F.col("z"))).count("regexp_replace(") == 3


def test_spellings_are_normalised_once_each(spark):
    df = spark.createDataFrame([(2, "A & B", 0, 1), (1, "A & B", 0, 1)], "source_id int, raw_mention string, start_char int, end_char int")
    assert [(r.normalized_name, r.ord["source_id"]) for r in resolve.spellings(df).collect()] == [("A AND B", 1)]
