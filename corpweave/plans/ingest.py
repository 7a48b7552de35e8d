"""Records from the sources, numbered in one order."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpweave import schemas
from corpweave.functions.dates import month_year
from corpweave.functions.text import joined_text
from corpweave.operators.resolve import numbered_by
from corpweave.sources import articles, filings
from corpweave.storage import written

#: order of the sources within a seed
SOURCE_ORDER = ["USPTO", "PUBMED", "SEC"]


def env_flag(name: str, default: bool = False) -> bool:
    value = os.environ.get(name)
    return default if value is None else value.strip().lower() in {"1", "true", "yes", "y", "on"}


@dataclass
class Settings:
    """Which sources are read, and how much of each; from the environment."""

    request_timeout: int = field(default_factory=lambda: int(os.environ.get("REQUEST_TIMEOUT", "30")))
    max_records: int = field(default_factory=lambda: int(os.environ.get("MAX_RECORDS_PER_SOURCE", "100")))
    use_pubmed: bool = field(default_factory=lambda: env_flag("USE_NCBI", True))
    use_sec: bool = field(default_factory=lambda: env_flag("USE_SEC", True))
    use_sections: bool = field(default_factory=lambda: env_flag("USE_SEC_EXTRACTOR", True))
    use_registry: bool = field(default_factory=lambda: env_flag("USE_OPENCORPORATES"))
    use_patents: bool = field(default_factory=lambda: env_flag("USE_USPTO"))

    patents_key: str = field(default_factory=lambda: os.environ.get("USPTO_API_KEY", ""))
    registry_key: str = field(default_factory=lambda: os.environ.get("OPENCORPORATES_API_KEY", ""))
    sections_key: str = field(default_factory=lambda: os.environ.get("SEC_API_KEY", ""))

    def __post_init__(self) -> None:
        """A source that needs a key is off without one."""
        self.use_patents = self.use_patents and bool(self.patents_key)
        self.use_registry = self.use_registry and bool(self.registry_key)
        self.use_sections = self.use_sec and self.use_sections and bool(self.sections_key)

    def sources(self) -> list[str]:
        on = {"USPTO": self.use_patents, "PUBMED": self.use_pubmed, "SEC": self.use_sec}
        return [s for s in SOURCE_ORDER if on[s]]


def numbered_records(seeds: DataFrame, by_source: dict[str, DataFrame]) -> DataFrame:
    """Records of all sources: seeds (seed, ord), each source (seed, place, raw_text,
    url, date).  source_id counts along seeds, then sources, then places."""
    parts = []
    for rank, source in enumerate(SOURCE_ORDER):
        if source in by_source:
            rows = by_source[source].select("seed", "place", "raw_text", "url", "date")
            parts.append(rows.withColumn("source_type", F.lit(source)).withColumn("source_rank", F.lit(rank)))
    if not parts:
        raise ValueError("no source is enabled")
    every = parts[0]
    for rows in parts[1:]:
        every = every.unionByName(rows)
    every = every.join(seeds.select("seed", "ord"), "seed")
    every = every.withColumn("raw_text", joined_text(F.col("raw_text"))).withColumn("date", F.coalesce(month_year(F.col("date")), F.lit("")))
    numbered = numbered_by(every, "ord", "source_rank", "place")
    return numbered.select(F.col("number").alias("source_id"), "source_type", "raw_text", F.col("url").alias("source_url"), "date", F.col("seed").alias("company_seed")).select(*schemas.RECORDS)


#: forms that are collected, and records a seed of articles and of filings at most
FORMS = ["10-K", "8-K", "S-1"]
MOST_ARTICLES, MOST_FILINGS = 20, 10
#: what a landed response is, in column `source` of its table
REGISTRY, PATENTS, ARTICLE_IDS, ARTICLES, TICKERS, SUBMISSIONS, SECTION, FILING = "registry", "patents", "article_ids", "articles", "tickers", "submissions", "section", "filing"


def collected(seeds: DataFrame, landed: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Records of `seeds` (seed, ord) out of responses `landed` (source, seed, url, item,
    status, content_type, body), of the sources that the settings turn on.

    The registry's name of a seed, where it has one, is what titles of filers are matched
    with; searches were made with it too, and their responses carry the seed.  Filings of
    which the text that is due did not land give no record."""
    settings = settings or Settings()
    of = lambda source: landed.filter(F.col("source") == source)
    ok = (F.col("status") == 200) & F.col("body").isNotNull()
    names = articles.lookup_seeds(seeds.select("seed"), articles.registered(of(REGISTRY).filter(ok))) if settings.use_registry else seeds.select("seed", F.col("seed").alias("lookup_name"))
    by_source = {}
    on = settings.sources()
    if "USPTO" in on:
        by_source["USPTO"] = articles.assignments(of(PATENTS).filter(ok), settings.max_records)
    if "PUBMED" in on:
        wanted = articles.article_ids(of(ARTICLE_IDS).filter(ok), min(MOST_ARTICLES, settings.max_records))
        found = articles.articles(of(ARTICLES).filter(ok)).select("seed", "pmid", "raw_text", "url", "date")
        by_source["PUBMED"] = wanted.join(found.dropDuplicates(["seed", "pmid"]), ["seed", "pmid"])
    if "SEC" in on:
        by_source["SEC"] = filing_rows(names, of, ok, settings)
    return numbered_records(seeds, by_source)


def filing_rows(names: DataFrame, of, ok, settings: Settings) -> DataFrame:
    """(seed, place, raw_text, url, date): CIK by title, recent filings, and the text of
    each, a section of it where the settings and the form ask for one."""
    ciks = filings.matched_cik(names.select(F.col("lookup_name").alias("seed")), filings.tickers(of(TICKERS).filter(ok)))
    by_cik = names.join(ciks.withColumnRenamed("seed", "lookup_name"), "lookup_name").select("seed", "cik")
    recent = filings.recent_filings(of(SUBMISSIONS).filter(ok), FORMS, min(MOST_FILINGS, settings.max_records)).dropDuplicates(["cik", "place"])
    rows = written(by_cik.join(recent, "cik"), "filings")
    item = filings.item_code(F.col("form")) if settings.use_sections else F.lit(None).cast("string")
    rows = rows.withColumn("wanted", item)
    sections = of(SECTION).filter(ok).select(F.col("url").alias("_url"), F.col("item").alias("_item"), F.trim("body").alias("section")).dropDuplicates(["_url", "_item"])
    full = filings.filing_text(of(FILING).filter(ok)).select(F.col("url").alias("_full"), F.col("text").alias("full")).dropDuplicates(["_full"])
    rows = rows.join(sections, (F.col("url") == F.col("_url")) & (F.col("wanted") == F.col("_item")), "left")
    rows = rows.join(full, F.col("url") == F.col("_full"), "left")
    said = joined_text(F.col("company"), F.col("form"), F.concat(F.lit("Extracted item "), F.col("wanted")), F.col("section"))
    text = F.when(F.col("wanted").isNull() & F.col("full").isNotNull(), joined_text(F.col("company"), F.col("form"), F.col("full"))).when(F.col("section").isNotNull(), said)
    return rows.select("seed", "place", text.alias("raw_text"), "url", F.col("filing_date").alias("date")).filter("raw_text is not null")
