"""Dictionary mentions of organisations in texts, with character offsets.

Texts and dictionary names are cut into the same tokens (runs of letters or digits,
single other signs).  Each distinct text is searched once.  Places whose token begins a
name are found by a join on the token; there the token sequences of the lengths that
such names have are looked up.  Of overlapping hits the longest wins, then the earliest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpweave import schemas
from corpweave.functions.text import is_reasonable_seed, normalize_whitespace, seed_variants

TOKEN = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"
LABEL = "ORG"
SOURCE = "spacy_or_entityruler"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def patterns(seeds: DataFrame, column: str = "seed") -> DataFrame:
    """label, pattern, pattern_lower, tokens: all spellings of reasonable seeds, one
    for each lower-cased spelling (the first in code-point order)."""
    good = seeds.select(normalize_whitespace(F.col(column)).alias("seed")).filter(is_reasonable_seed(F.col("seed"))).distinct()
    spelled = good.select(F.explode(seed_variants(F.col("seed"))).alias("pattern"))
    each = spelled.groupBy(F.lower("pattern").alias("pattern_lower")).agg(F.min("pattern").alias("pattern"))
    return each.select(F.lit(LABEL).alias("label"), "pattern", "pattern_lower", tokens(F.col("pattern_lower")).alias("tokens"))


def seeds_of(records: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """Seeds named in records, cleaned and raw, and those of a list."""
    columns = [c for c in ("company_seed_cleaned", "company_seed") if c in records.columns]
    out = records.select(F.explode(F.array(*[F.col(c) for c in columns])).alias("seed"))
    return (out if extra is None else out.union(extra.select("seed"))).filter("seed is not null").distinct()


def longest_first(hits: Column) -> Column:
    """Of array of struct(first, last, ...) those kept if longer ones, then earlier
    ones, are taken first and none overlaps another; in the order of the text.  It is
    meant for the few hits of a place where they overlap."""
    ranked = F.array_sort(hits, lambda a, b: F.when(
        (a["last"] - a["first"]) != (b["last"] - b["first"]), F.when((a["last"] - a["first"]) > (b["last"] - b["first"]), -1).otherwise(1)
    ).otherwise(F.when(a["first"] < b["first"], -1).when(a["first"] > b["first"], 1).otherwise(0)))
    kept = F.aggregate(ranked, F.slice(hits, 1, 0), lambda out, h: F.when(F.exists(out, lambda o: (o["first"] <= h["last"]) & (h["first"] <= o["last"])), out).otherwise(F.concat(out, F.array(h))))
    return F.array_sort(kept, lambda a, b: F.when(a["first"] < b["first"], -1).otherwise(1))


def found_mentions(texts: DataFrame, dictionary: DataFrame, key: str, text: str) -> DataFrame:
    """(key, raw_mention, start_char, end_char) for rows of `texts`; `key` tells rows
    apart.  Offsets count characters."""
    names = dictionary.filter("size(tokens) > 0").select("tokens", F.array_join("tokens", " ").alias("gram"))
    firsts = names.groupBy(F.get("tokens", F.lit(0)).alias("token")).agg(F.collect_set(F.size("tokens")).alias("lengths"))
    longest = names.agg(F.max(F.size("tokens")).alias("longest"))  # one row
    cut = texts.select(key, F.col(text).alias("text")).filter("text <> ''").withColumn("tokens", F.transform(tokens(F.col("text")), lambda t: F.lower(t))).filter("size(tokens) > 0")
    cut = cut.crossJoin(F.broadcast(longest)).filter("longest is not null")
    # a row a place, with the tokens from there on that a name can take up
    ahead = F.transform(F.sequence(F.lit(1), F.size("tokens")), lambda i: F.slice("tokens", i, F.col("longest")))
    places = cut.select(key, F.posexplode(ahead).alias("first", "ahead"))
    begun = places.withColumn("token", F.get("ahead", F.lit(0))).join(firsts, "token")
    grams = begun.select(key, "first", "ahead", F.explode("lengths").alias("n")).filter("size(ahead) >= n")
    grams = grams.select(key, "first", (F.col("first") + F.col("n") - 1).alias("last"), F.array_join(F.slice("ahead", F.lit(1), F.col("n")), " ").alias("gram"))
    hits = grams.join(names.select("gram").distinct(), "gram", "left_semi").select(key, "first", "last")
    # hits that overlap, directly or through others, stand together
    by = Window.partitionBy(key).orderBy("first", "last")
    reach = F.max("last").over(by.rowsBetween(Window.unboundedPreceding, -1))
    runs = hits.withColumn("opens", F.coalesce(F.col("first") > reach, F.lit(True)).cast("int"))
    runs = runs.withColumn("run", F.sum("opens").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    kept = runs.groupBy(key, "run").agg(longest_first(F.collect_list(F.struct("first", "last"))).alias("hits"))
    per_text = kept.select(key, F.explode("hits").alias("hit")).groupBy(key).agg(F.collect_list("hit").alias("hits"))
    # a token's place: behind all gaps and tokens before it
    found = texts.select(key, F.col(text).alias("text")).join(per_text, key)
    found = found.withColumn("sizes", F.transform(tokens(F.col("text")), lambda t: F.length(t))).withColumn("gaps", F.transform(F.split("text", TOKEN), lambda g: F.length(g)))
    total = lambda list_, n: F.aggregate(F.slice(list_, F.lit(1), n), F.lit(0), lambda s, x: s + x)
    spans = found.select(key, "text", "sizes", "gaps", F.explode("hits").alias("hit"))
    start = total(F.col("gaps"), F.col("hit.first") + 1) + total(F.col("sizes"), F.col("hit.first"))
    end = total(F.col("gaps"), F.col("hit.last") + 1) + total(F.col("sizes"), F.col("hit.last") + 1)
    spans = spans.select(key, "text", start.alias("start_char"), end.alias("end_char"))
    return spans.select(key, F.expr("substring(text, start_char + 1, end_char - start_char)").alias("raw_mention"), "start_char", "end_char")


def deduplicated(mentions: DataFrame) -> DataFrame:
    """First of the mentions equal in record, place and lower-cased text."""
    low = F.lower(F.trim("raw_mention"))
    first = Window.partitionBy("source_id", "start_char", "end_char", low).orderBy("raw_mention", "source_type")
    return mentions.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")


#: finds mentions by other means: a table (text_key, text) to one (text_key, raw_mention, entity_label, start_char, end_char)
Tagger = Callable[[DataFrame], DataFrame]


def extracted(cleaned: DataFrame, dictionary: DataFrame, labels: tuple[str, ...] = (LABEL,), tagger: Tagger | None = None) -> DataFrame:
    """Mention rows, with all fixed columns, of validated records, whose label is one of
    `labels` in any case.  Rows with equal texts have the same mentions.  A tagger's
    mentions are added where none of the dictionary's overlaps them."""
    df = schemas.require(cleaned, ["source_id", "source_type", "raw_text_cleaned"])
    df = schemas.ensure(df, {"source_type_cleaned": "source_type", "source_url": None, "source_url_cleaned": "source_url", "date": None, "date_cleaned": "date", "company_seed": None, "company_seed_cleaned": "company_seed", "raw_text": "raw_text_cleaned"})
    df = df.withColumn("text_key", F.sha2("raw_text_cleaned", 256))
    texts = df.filter("raw_text_cleaned <> ''").select("text_key", F.col("raw_text_cleaned").alias("text")).dropDuplicates(["text_key"])
    found = found_mentions(texts, dictionary, "text_key", "text").withColumn("entity_label", F.lit(LABEL))
    if tagger is not None:
        tagged = tagger(texts).select("text_key", "raw_mention", "start_char", "end_char", "entity_label")
        own = found.select(F.col("text_key").alias("k"), F.col("start_char").alias("a"), F.col("end_char").alias("b"))
        clear = tagged.join(own, (F.col("text_key") == F.col("k")) & (F.col("start_char") < F.col("b")) & (F.col("a") < F.col("end_char")), "left_anti")
        found = found.unionByName(clear)
    found = found.filter(F.upper("entity_label").isin([label.upper() for label in labels]))
    rows = df.join(found, "text_key").withColumn("mention_source", F.lit(SOURCE)).withColumn("mention_confidence", F.lit(""))
    return deduplicated(rows.select(*schemas.MENTIONS))
