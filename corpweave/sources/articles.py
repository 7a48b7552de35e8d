"""Parsers of landed responses about articles, patents and registered companies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpweave.functions.text import joined_text

ID_SEARCH = "struct<esearchresult: struct<idlist: array<string>>>"
REGISTRY = "struct<results: struct<companies: array<struct<company: struct<name: string, jurisdiction_code: string, company_number: string, opencorporates_url: string, registry_url: string>>>>>"
ARTICLE_URL = "https://pubmed.ncbi.nlm.nih.gov/"
PATENT_URL = "https://assignmentcenter.uspto.gov/"


def _filled(c: Column) -> Column:
    return F.when(c != "", c)


def search_term(seed: Column) -> Column:
    """Query text of an id search for a seed."""
    return F.concat(F.lit('"'), seed, F.lit('"[Title/Abstract] OR "'), seed, F.lit('"[Affiliation]'))


def article_ids(landed: DataFrame, limit: int = 20) -> DataFrame:
    """(seed, place, pmid) of id-search responses."""
    ids = F.slice(F.col("r.esearchresult.idlist"), 1, limit)
    return landed.select("seed", F.from_json("body", ID_SEARCH).alias("r")).select("seed", F.posexplode(ids).alias("place", "pmid"))


def _all_text(xml: Column, path: str) -> Column:
    return F.xpath(xml, F.lit(path))


def _first(xml: Column, path: str) -> Column:
    return _filled(F.trim(F.get(F.xpath(xml, F.lit(path)), 0)))


def articles(landed: DataFrame) -> DataFrame:
    """(seed, pmid, title, abstract, date, url, raw_text) of article responses (seed,
    body): one row a PubmedArticle.  Title is the text before the first inner
    element; abstracts are all pieces with their inner text; year and month come from
    the journal date, each by itself else from the article date."""
    one = F.explode(F.regexp_extract_all("body", F.lit(r"(?s)<PubmedArticle[ >].*?</PubmedArticle>"), F.lit(0)))
    rows = landed.select("seed", one.alias("x"))
    x = F.col("x")
    year = F.coalesce(_first(x, "//PubDate/Year/text()"), _first(x, "//ArticleDate/Year/text()"))
    month = F.coalesce(_first(x, "//PubDate/Month/text()"), _first(x, "//ArticleDate/Month/text()"))
    pieces = F.regexp_extract_all("x", F.lit(r"(?s)<AbstractText(?:\s[^>]*)?>(.*?)</AbstractText>"), F.lit(1))
    plain = F.transform(pieces, lambda p: F.trim(decoded(p)))
    date = F.when(year.isNotNull() & month.isNotNull(), F.concat(month, F.lit("-"), year)).otherwise(year)
    rows = rows.select("seed", _first(x, "//PMID/text()").alias("pmid"), F.coalesce(_first(x, "//ArticleTitle/text()"), F.lit("")).alias("title"), F.array_join(F.filter(plain, lambda p: p != ""), " ").alias("abstract"), date.alias("date"))
    rows = rows.withColumn("url", F.concat(F.lit(ARTICLE_URL), F.col("pmid"), F.lit("/")))
    return rows.withColumn("raw_text", joined_text(F.col("title"), F.col("abstract")))


def decoded(c: Column) -> Column:
    """Text of a piece of XML: without tags, entities replaced.  Numeric entities and CDATA
    sections are rare and are left to an XML parser."""
    whole = F.xpath_string(F.concat(F.lit("<r>"), c, F.lit("</r>")), F.lit("string(/r)"))
    return F.when(c.contains("&#") | c.contains("<![CDATA["), whole).otherwise(unescaped(F.regexp_replace(c, r"<[^>]*>", "")))


def unescaped(c: Column) -> Column:
    for name, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(name), F.lit(sign))
    return c


def assignments(landed: DataFrame, limit: int = 20) -> DataFrame:
    """(seed, place, raw_text, url, date) of patent-assignment responses (seed, body);
    tag names are lower-cased, and fields that are missing are left out."""
    docs = F.slice(F.regexp_extract_all("body", F.lit(r"(?is)<doc(?:\s[^>]*)?>(.*?)</doc>"), F.lit(1)), 1, limit)
    rows = landed.select("seed", F.posexplode(docs).alias("place", "d"))

    def field(name: str) -> Column:
        return _filled(F.trim(decoded(F.regexp_extract("d", rf"(?is)<{name}(?:\s[^>]*)?>(.*?)</{name}>", 1))))

    names = ["assignor", "assignee", "patentnumber", "applicationnumber", "executiondate", "recordeddate", "reelno", "frameno"]
    rows = rows.select("seed", "place", *[field(n).alias(n) for n in names])  # each is searched for once

    def said(label: str, *columns: str) -> Column:
        return F.concat(F.lit(f"{label}: "), F.coalesce(*columns, F.lit("")))

    parts = [said("Assignor", "assignor"), said("Assignee", "assignee"), said("Patent/Application", "patentnumber", "applicationnumber"), said("Execution date", "executiondate"), said("Recorded date", "recordeddate")]
    whole = F.concat(F.lit(f"{PATENT_URL}#!/patent/search/resultAbstract?reelFrame="), F.col("reelno"), F.lit(":"), F.col("frameno"))
    url = F.coalesce(whole, F.lit(PATENT_URL))
    return rows.select("seed", "place", joined_text(*parts).alias("raw_text"), url.alias("url"), F.coalesce("recordeddate", "executiondate").alias("date"))


def registered(landed: DataFrame) -> DataFrame:
    """(seed, name, jurisdiction, number, url, registry_url) of the first hit of registry
    responses (seed, body); seeds without a hit are absent."""
    hit = F.get(F.col("r.results.companies"), 0)["company"]
    rows = landed.select("seed", F.from_json("body", REGISTRY).alias("r")).select("seed", hit.alias("c")).filter("c is not null")
    return rows.select("seed", "c.name", F.col("c.jurisdiction_code").alias("jurisdiction"), F.col("c.company_number").alias("number"), F.col("c.opencorporates_url").alias("url"), "c.registry_url")


def lookup_seeds(seeds: DataFrame, registry: DataFrame) -> DataFrame:
    """`seeds` (seed) with lookup_name: the registry's name where there is one."""
    return seeds.join(registry.select("seed", "name"), "seed", "left").select("seed", F.coalesce(_filled(F.col("name")), F.col("seed")).alias("lookup_name"))
