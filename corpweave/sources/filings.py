"""Parsers of landed responses about filings.

Responses are fetched outside the plan and land in a table (source, seed, url,
status, content_type, body, fetched_at); parsing them is deterministic.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpweave.shipping import shipped

TICKERS = "map<string, struct<cik_str: long, ticker: string, title: string>>"
SUBMISSIONS = "struct<cik: string, name: string, filings: struct<recent: struct<form: array<string>, accessionNumber: array<string>, primaryDocument: array<string>, filingDate: array<string>>>>"
#: characters kept of a filing
TEXT_LIMIT = 20_000
ARCHIVE = "https://www.sec.gov/Archives/edgar/data"


def tickers(landed: DataFrame) -> DataFrame:
    """(ord, cik, title) of a tickers response: an object of numbered rows."""
    rows = landed.select(F.posexplode(F.from_json("body", TICKERS)).alias("ord", "key", "row"))
    return rows.select("ord", F.lpad(F.col("row.cik_str").cast("string"), 10, "0").alias("cik"), F.upper(F.coalesce("row.title", F.lit(""))).alias("title"))


def _parts(text: str, lengths: str) -> Column:
    """Distinct parts of a text of as many characters as `lengths` has, in any place."""
    n = F.length(text)
    fitting = F.filter(lengths, lambda k: (k > 0) & (k <= n))
    return F.array_distinct(F.flatten(F.transform(fitting, lambda k: F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.substring(F.col(text), i, k)))))


def matched_cik(seeds: DataFrame, titles: DataFrame) -> DataFrame:
    """(seed, cik): first title that holds the seed or is held by it, in upper case.

    A text holds another if one of its parts of that length equals it, so both ways are
    equi-joins: rows grow with the texts and the lengths that occur, not with seeds x
    titles.  Seeds without a match are absent; an empty title matches any seed."""
    names = seeds.select("seed", F.upper("seed").alias("name")).filter("name is not null").distinct()
    known = titles.filter("title is not null")
    first = lambda df, *by: df.groupBy(*by).agg(F.min("ord").alias("ord"), F.min_by("cik", "ord").alias("cik"))
    of_title = first(known, "title")
    lengths = lambda df, c: F.broadcast(df.agg(F.collect_set(F.length(c)).alias("lengths")))
    # titles in a name
    held = names.crossJoin(lengths(known, "title")).select("seed", F.explode(_parts("name", "lengths")).alias("title")).join(of_title, "title")
    # names in a title; each part with its first title
    parts = known.crossJoin(lengths(names, "name")).select("ord", "cik", F.explode(_parts("title", "lengths")).alias("name"))
    holding = names.join(first(parts, "name"), "name")
    # an empty title is in all names, an empty name in all titles: a row each
    any_name = names.crossJoin(F.broadcast(of_title.filter("title = ''")))
    any_title = names.filter("name = ''").crossJoin(F.broadcast(known.agg(F.count("*").alias("n"), F.min("ord").alias("ord"), F.min_by("cik", "ord").alias("cik")).filter("n > 0")))
    columns = ["seed", "ord", "cik"]
    found = held.select(*columns).union(holding.select(*columns)).union(any_name.select(*columns)).union(any_title.select(*columns))
    return found.groupBy("seed").agg(F.min_by("cik", "ord").alias("cik"))


def recent_filings(landed: DataFrame, forms: list[str] | None = None, limit: int = 20) -> DataFrame:
    """(cik, company, form, filing_date, accession, document, url, place) of submissions
    responses (seed, body): the first `limit` of the wanted forms, in order.  Parallel
    lists of unequal length count as far as the shortest."""
    parsed = landed.select(F.from_json("body", SUBMISSIONS).alias("s"))
    lists = parsed.select(F.lpad("s.cik", 10, "0").alias("cik"), F.col("s.name").alias("company"), F.col("s.filings.recent").alias("r"))
    shortest = F.least(*[F.size(f"r.{c}") for c in ("form", "accessionNumber", "primaryDocument", "filingDate")])
    zipped = F.arrays_zip(F.col("r.form").alias("form"), F.col("r.accessionNumber").alias("accession"), F.col("r.primaryDocument").alias("document"), F.col("r.filingDate").alias("filing_date"))
    wanted = F.filter(F.slice(zipped, F.lit(1), F.greatest(shortest, F.lit(0))), lambda f: F.lit(True) if forms is None else f["form"].isin(forms))
    rows = lists.select("cik", "company", F.posexplode(F.slice(wanted, 1, limit)).alias("place", "f"))
    return rows.select("cik", "company", "f.form", "f.filing_date", "f.accession", "f.document", filing_url(F.col("cik"), F.col("f.accession"), F.col("f.document")).alias("url"), "place")


def filing_url(cik: Column, accession: Column, document: Column) -> Column:
    return F.concat(F.lit(f"{ARCHIVE}/"), cik.cast("long").cast("string"), F.lit("/"), F.replace(accession, F.lit("-"), F.lit("")), F.lit("/"), document)


def item_code(form: Column) -> Column:
    """Section of a form that is extracted; null: its whole text."""
    return F.when(form.isin("10-K", "S-1"), "1A").when(form == "10-Q", "part2item1a")


def sections(filings: DataFrame, landed: DataFrame) -> DataFrame:
    """`filings` with section_text, looked up by (url, item); null where none landed."""
    texts = landed.select(F.col("url").alias("_url"), F.col("item").alias("_item"), F.col("body").alias("section_text"))
    keyed = filings.withColumn("item", item_code(F.col("form")))
    return keyed.join(texts, (F.col("url") == F.col("_url")) & (F.col("item") == F.col("_item")), "left").drop("_url", "_item")


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []

    def handle_data(self, data: str) -> None:
        if data.strip():
            self.parts.append(data.strip())


def _html_text(html: str | None) -> str | None:
    if html is None:
        return None
    parser = _Text()
    parser.feed(html)
    parser.close()
    return " ".join(parser.parts)


def html_text(html: Column) -> Column:
    """All text nodes of a page, stripped and joined by spaces."""
    
    def texts(pages: pd.Series) -> pd.Series:
        return pages.map(_html_text)

    return F.pandas_udf(texts, "string")(html)


def filing_text(landed: DataFrame) -> DataFrame:
    """`landed` (body, content_type) with text: all text nodes of a page, stripped and
    joined by spaces; other bodies as they are; cut to `TEXT_LIMIT` characters."""
    shipped(landed.sparkSession)
    is_html = F.lower(F.coalesce("content_type", F.lit(""))).contains("html") | F.lower(F.coalesce("body", F.lit(""))).contains("<html")
    return landed.withColumn("text", F.substring(F.when(is_html, html_text(F.col("body"))).otherwise(F.col("body")), 1, TEXT_LIMIT))


def filing_records(filings: DataFrame, section_landed: DataFrame, full_landed: DataFrame) -> DataFrame:
    """Filings with raw_text: the section where the form has one and it landed, else the
    full text; `error` tells why there is none."""
    with_section = sections(filings, section_landed)
    full = filing_text(full_landed).select(F.col("url").alias("_url"), F.col("text").alias("full_text"), F.col("status").alias("_status"))
    rows = with_section.join(full, F.col("url") == F.col("_url"), "left")
    text = F.coalesce(F.when(F.col("section_text") != "", F.col("section_text")), F.col("full_text"))
    error = F.when(text.isNull(), F.concat(F.lit("no text, status "), F.coalesce(F.col("_status").cast("string"), F.lit("none"))))
    return rows.withColumn("raw_text", text).withColumn("error", error).drop("_url", "_status", "full_text", "section_text")
