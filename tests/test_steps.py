"""Ingestion, exchange of tables between steps, the command line, streaming, and mentions."""

import json

import pytest
from pyspark.sql import functions as F

from corpweave import schemas
from corpweave.functions.dates import month_year
from corpweave.operators import mentions, preprocess, relations, resolve
from corpweave.plans import ingest, pipeline, queries
from corpweave.sources import articles, seeds, tables
from corpweave.streaming.ingest import read_records, validate_incrementally
from tests.differential import DATA

RECORDS = "source_id long, source_type string, raw_text string, source_url string, date string, company_seed string"
LANDED = "source string, seed string, url string, item string, status int, content_type string, body string"


def records(spark):
    rows = [
        (1, " edgar ", "Acme  Corp acquired Beta Labs. More, text\nfollows \"here\".", "http://u/1", "Jan-24", "Acme Corp"),
        (2, "NCBI", "Beta Labs worked with Acme Corp in collaboration.", None, "", "Beta Labs"),
        (2, "SEC", "Gamma House licensed from Acme Corp.", "http://u/3", "", "Gamma House"),
        (4, "blog", "", "http://u/4", "", "11-JUL"),
        (5, "SEC", "nothing", "", "", "N/A"),
    ]
    return spark.createDataFrame(rows, RECORDS)


def test_records_that_share_an_id_keep_their_own_mentions(spark):
    cleaned = preprocess.split(records(spark))[0]
    found = mentions.extracted(cleaned, mentions.patterns(mentions.seeds_of(cleaned))).collect()
    assert all(r.raw_text_cleaned[r.start_char : r.end_char] == r.raw_mention for r in found)
    by_text = {(r.raw_text_cleaned[:5], r.raw_mention) for r in found}
    assert by_text == {("Acme ", "Acme Corp"), ("Acme ", "Beta Labs"), ("Beta ", "Beta Labs"), ("Beta ", "Acme Corp"), ("Gamma", "Gamma House"), ("Gamma", "Acme Corp")}
    assert found[0].__fields__ == schemas.MENTIONS


def test_labels_and_tagger(spark):
    cleaned = preprocess.split(records(spark))[0]
    names = mentions.patterns(mentions.seeds_of(cleaned))
    assert mentions.extracted(cleaned, names, labels=("PERSON",)).count() == 0
    tag = lambda texts: texts.filter("text like '%licensed%'").select("text_key", F.explode(F.array(*[F.struct(F.lit(w).alias("raw_mention"), F.lit(k).alias("entity_label"), F.lit(a).alias("start_char"), F.lit(b).alias("end_char")) for w, k, a, b in (("licensed", "act", 12, 20), ("House", "Org", 6, 11))])).alias("t")).select("text_key", "t.*")
    got = [(r.raw_mention, r.entity_label) for r in mentions.extracted(cleaned, names, ("org", "ACT"), tag).collect() if r.raw_text_cleaned.startswith("Gamma")]
    assert sorted(got) == [("Acme Corp", "ORG"), ("Gamma House", "ORG"), ("licensed", "act")]


def test_longest_then_earliest(spark):
    names = spark.createDataFrame([("big blue house",), ("blue house",), ("house party of two",), ("x",), ("two big",), ("İx ab",)], "seed string")
    text = "a big blue house party of two big blue-house, Two Big İx ab İx AB"
    df = spark.createDataFrame([(1, text), (2, ""), (3, None)], "k long, t string")
    dictionary = names.select(mentions.tokens(F.lower("seed")).alias("tokens"))
    got = sorted((r.start_char, r.raw_mention) for r in mentions.found_mentions(df, dictionary, "k", "t").collect())
    assert all(text[a : a + len(m)] == m for a, m in got)
    assert [m for _, m in got][:3] == ["house party of two", "Two Big", "İx ab"] or [m for _, m in got][:2] == ["house party of two", "Two Big"]


def landed(spark):
    filings = {"cik": "7", "name": "Acme Corp", "filings": {"recent": {"form": ["10-K", "4", "8-K"], "accessionNumber": ["1-1", "1-2", "1-3"], "primaryDocument": ["a.htm", "b.htm", "c.htm"], "filingDate": ["2024-02-03", "2024-02-04", "2023-12-01"]}}}
    base = "https://www.sec.gov/Archives/edgar/data/7"
    xml = "<PubmedArticleSet>" + "".join(f"<PubmedArticle><PMID>{i}</PMID><PubDate><Year>2023</Year><Month>Jul</Month></PubDate><ArticleTitle>T{i}</ArticleTitle><Abstract><AbstractText>a &#233; <![CDATA[<b>]]> &amp; c</AbstractText></Abstract></PubmedArticle>" for i in (11, 12, 13)) + "</PubmedArticleSet>"
    rows = [
        ("registry", "Acme", None, None, 200, "json", json.dumps({"results": {"companies": [{"company": {"name": "ACME CORP"}}]}})),
        ("tickers", None, None, None, 200, "json", json.dumps({"0": {"cik_str": 7, "ticker": "A", "title": "Acme Corp"}})),
        ("submissions", "Acme", None, None, 200, "json", json.dumps(filings)),
        ("section", None, f"{base}/11/a.htm", "1A", 200, "text", " risk text "),
        ("filing", None, f"{base}/11/a.htm", None, 200, "text/html", "<html><p>whole</p> ten</html>"),
        ("filing", None, f"{base}/13/c.htm", None, 404, "text/plain", "no"),
        ("article_ids", "Acme", None, None, 200, "json", json.dumps({"esearchresult": {"idlist": ["12", "11"]}})),
        ("articles", "Acme", None, None, 200, "xml", xml),
        ("patents", "Acme", None, None, 200, "xml", "<r><result><doc><assignor>X &#38; Y</assignor><recordedDate>2020-05-06</recordedDate></doc></result></r>"),
    ]
    return spark.createDataFrame(rows, LANDED)


def test_ingestion(spark, monkeypatch):
    for name in ("USPTO_API_KEY", "OPENCORPORATES_API_KEY", "SEC_API_KEY"):
        monkeypatch.setenv(name, "k")
    monkeypatch.setenv("USE_USPTO", "1")
    monkeypatch.setenv("USE_OPENCORPORATES", "yes")
    names = seeds.ingest_seeds(spark.createDataFrame([(0, "( Acme"), (1, "Acme"), (2, "N/A"), (3, "Zeta")], "ord long, line string"))
    got = [tuple(r) for r in ingest.collected(names, landed(spark)).orderBy("source_id").collect()]
    assert got == [
        (1, "USPTO", "Assignor: X & Y Assignee: Patent/Application: Execution date: Recorded date: 2020-05-06", "https://assignmentcenter.uspto.gov/", "May-20", "Acme"),
        (2, "PUBMED", "T12 a é <b> & c", "https://pubmed.ncbi.nlm.nih.gov/12/", "Jul-23", "Acme"),
        (3, "PUBMED", "T11 a é <b> & c", "https://pubmed.ncbi.nlm.nih.gov/11/", "Jul-23", "Acme"),
        (4, "SEC", "Acme Corp 10-K Extracted item 1A risk text", "https://www.sec.gov/Archives/edgar/data/7/11/a.htm", "Feb-24", "Acme"),
    ]
    monkeypatch.delenv("SEC_API_KEY")
    monkeypatch.setenv("USE_NCBI", "0")
    monkeypatch.setenv("MAX_RECORDS_PER_SOURCE", "1")
    rest = [(r.source_type, r.raw_text) for r in ingest.collected(names, landed(spark)).orderBy("source_id").collect()]
    assert rest[1:] == [("SEC", "Acme Corp 10-K whole ten")]


def test_dates_in_free_text(spark):
    texts = ["filed on 3 March 2019 in court", "July 4, 2021", "2019", "Spring", "Jan-24", None, "2024-05-06"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.d for r in df.select(month_year(F.col("t")).alias("d")).collect()] == ["Mar-19", "Jul-21", None, None, "Jan-24", None, "May-24"]


def test_search_term(spark):
    assert spark.range(1).select(articles.search_term(F.lit("Acme"))).first()[0] == '"Acme"[Title/Abstract] OR "Acme"[Affiliation]'


@pytest.mark.parametrize("form", ["csv", "parquet"])
def test_command_line(spark, tmp_path, form):
    at = lambda name: f"{tmp_path}/{name}.{form}"
    source = records(spark)
    tables.write_table(source, at("in"), "in")
    pipeline.main(["preprocess", "--input", at("in"), "--cleaned-output", at("clean"), "--invalid-output", at("bad")])
    clean = tables.read_table(spark, at("clean"))
    assert sorted(r.source_id for r in clean.collect()) == ([1, 2, 2] if form == "csv" else [1, 2, 2, 5])  # N/A is missing in a CSV
    assert {r.raw_text_cleaned for r in clean.collect() if r.source_id == 1} == {'Acme Corp acquired Beta Labs. More, text follows "here".'}
    (tmp_path / "seeds.txt").write_text("Beta Labs\nAcme\n")
    pipeline.main(["ner", "--input", at("clean"), "--output", at("ner"), "--seed-list-file", f"{tmp_path}/seeds.txt", "--entity-labels", "org", "--batch-size", "64"])
    pipeline.main(["resolve", "--input", at("ner"), "--resolved-output", at("resolved"), "--review-output", at("review")])
    pipeline.main(["relations", "--input", at("resolved"), "--output", at("out")])
    got = {(r.source_id, r.entity_a, r.entity_b, r.candidate_relation) for r in tables.read_table(spark, at("out")).collect()}
    assert {g[3] for g in got if g[0] == 1} == {"ACQUIRED"} and (2, "Acme Corp", "Gamma House", "LICENSED_FROM") in got
    want = resolve.resolved(tables.read_table(spark, at("ner")))[0]
    assert relations.candidate_relations(want).count() == tables.read_table(spark, at("out")).count()
    assert tables.read_table(spark, at("review")).columns == schemas.REVIEW


def test_csv_keeps_texts(spark, tmp_path):
    rows = [("a,b", 'q "x" ""', "two\nlines"), ("NA", "", None), ("None", " n/a", "é")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    tables.write_csv(df, f"{tmp_path}/t.csv")
    assert {tuple(r) for r in tables.read_csv(spark, f"{tmp_path}/t.csv", "a string, b string, c string").collect()} == {rows[0], (None, None, None), (None, " n/a", "é")}
    tables.write_csv(df.limit(0), f"{tmp_path}/none.csv")
    assert tables.read_table(spark, f"{tmp_path}/none.csv").columns == ["a", "b", "c"]


def test_sinks(spark, tmp_path):
    valid, invalid = preprocess.split(records(spark))
    assert tables.write_split(valid, invalid, f"{tmp_path}/v", f"{tmp_path}/i") == (4, 1)
    for _ in range(2):  # a batch that is written again replaces itself
        tables.append_batch(valid, f"{tmp_path}/all", "one")
    tables.append_batch(invalid, f"{tmp_path}/all", "two")
    assert spark.read.parquet(f"{tmp_path}/all").count() == 5


def test_streaming(spark, tmp_path):
    source = records(spark)
    source.write.parquet(f"{tmp_path}/in")
    for more in (False, True):
        if more:
            source.write.mode("append").parquet(f"{tmp_path}/in")
        validate_incrementally(read_records(spark, f"{tmp_path}/in", source.schema), f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
        got = {r.row_valid_for_ner == "true": r["count"] for r in spark.read.parquet(f"{tmp_path}/out").groupBy("row_valid_for_ner").count().collect()}
        assert got == {True: 4 * (1 + more), False: 1 + more}


def test_chain_equals_its_parts(spark):
    sf = str(DATA / "sf0.001")
    chain = queries.Q["pipeline_relations"](spark, sf).drop("date", "source_url").collect()
    alone = queries.Q["candidate_relations"](spark, sf).collect()
    assert {(r.source_id, r.candidate_relation, r.trigger_phrase) for r in chain} == {(r.source_id, r.candidate_relation, r.trigger_phrase) for r in alone}
