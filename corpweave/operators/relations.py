"""Candidate relations between companies named together in sentences and records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpweave import schemas
from corpweave.functions.text import (
    detected_relation,
    has_joint_patent_signal,
    has_soft_word,
    is_boilerplate,
    is_patent_like,
    is_plausible_company,
    normalize_whitespace,
    sentence_at,
)

REQUIRED = ["source_id", "source_type", "source_url", "date", "raw_text", "canonical_name", "start_char", "end_char"]
KEYS = ["source_id", "source_type", "source_url", "date"]


def _start() -> Column:
    return F.coalesce(F.expr("cast(try_cast(start_char as double) as int)"), F.lit(-1))


def with_sentence(rows: DataFrame) -> DataFrame:
    """`rows` with sentence_text: the sentence in which the mention starts, or the
    whole text where its place is unknown or outside all of them."""
    df = rows.withColumn("_text", normalize_whitespace(F.col("raw_text"))).withColumn("_start", _start())
    return df.withColumn("sentence_text", F.coalesce(sentence_at(F.col("_text"), F.col("_start")), F.col("_text"))).drop("_text", "_start")


def placed(rows: DataFrame) -> DataFrame:
    """Plausible names with their places and texts, the rows of a record in one task: what
    follows is grouped there, for sentences and for records."""
    plausible = rows.filter(is_plausible_company(F.col("canonical_name"), F.col("source_type")))
    plausible = plausible.select(*KEYS, normalize_whitespace(F.col("canonical_name")).alias("name"), _start().alias("a"), normalize_whitespace(F.col("raw_text")).alias("text"))
    return plausible.filter("text <> ''").repartition("source_id", "source_url", "date")


def entities_of(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Names of each group, distinct, in the order of mention."""
    # each name once per group, at its first place: what is collected is the names of a record
    firsts = rows.groupBy(*keys, "name").agg(F.min("a").alias("a"))
    grouped = firsts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("a", "name"))).alias("ps"))
    return grouped.select(*keys, F.transform("ps", lambda p: p["name"]).alias("entities"))


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """`df` with a column that is worked out once a row, however often it is read."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def all_pairs(entities: Column) -> Column:
    """Array of struct(entity_a, entity_b), a before b in code-point order."""
    return F.flatten(
        F.transform(entities, lambda a, i: F.transform(F.slice(entities, i + 2, F.size(entities)), lambda b: F.struct(F.least(a, b).alias("entity_a"), F.greatest(a, b).alias("entity_b"))))
    )


def _upper(c: str) -> Column:
    return F.upper(F.coalesce(F.col(c), F.lit("")))


def sentence_level(rows: DataFrame, cooccurrence: bool = True) -> DataFrame:
    """Groups of names in one sentence with the relation that its words tell; without
    one, few names beside a soft word count as occurring together."""
    marked = placed(rows).withColumn("sentence_text", F.coalesce(sentence_at(F.col("text"), F.col("a")), F.col("text")))
    grouped = entities_of(marked, [*KEYS, "sentence_text"]).filter("size(entities) >= 2")
    source = _upper("source_type")
    grouped = grouped.filter(~((source == "SEC") & is_boilerplate(F.col("sentence_text"))))
    grouped = once(grouped, "found", detected_relation(F.col("sentence_text"), F.col("source_type")))
    told = F.col("found.relation") != ""
    soft = F.lit(cooccurrence) & source.isin("SEC", "PUBMED") & (F.size("entities") <= 4) & has_soft_word(F.col("sentence_text"))
    return grouped.filter(told | soft).select(
        *KEYS,
        "entities",
        F.when(told, F.col("found.relation")).otherwise("CO_OCCURS_WITH").alias("candidate_relation"),
        F.col("sentence_text").alias("evidence_text"),
        F.when(told, F.col("found.trigger")).otherwise("soft_relation_context").alias("trigger_phrase"),
        F.when(told, "source_aware_sentence_trigger_relaxed").otherwise("sentence_cooccurrence_fallback_relaxed").alias("extraction_method"),
        F.lit(0).alias("phase"),
    )


def record_level(rows: DataFrame) -> DataFrame:
    """Groups of names in one record: patents with a joint signal, and for other
    sources a relation told in the first 2000 characters among at most five names."""
    grouped = entities_of(placed(rows), [*KEYS, "text"]).filter("size(entities) >= 2")
    patent = _upper("source_type") == "USPTO"
    joint = patent & is_patent_like(F.col("text")) & has_joint_patent_signal(F.col("text"))
    grouped = once(grouped, "found", detected_relation(F.substring("text", 1, 2000), F.col("source_type")))
    told = ~patent & (F.col("found.relation") != "") & (F.size("entities") <= 5)
    return grouped.filter(joint | told).select(
        *KEYS,
        "entities",
        F.when(patent, "FILED_PATENT_WITH").otherwise(F.col("found.relation")).alias("candidate_relation"),
        F.substring("text", 1, 500).alias("evidence_text"),
        F.when(patent, "explicit_joint_patent_signal").otherwise(F.col("found.trigger")).alias("trigger_phrase"),
        F.when(patent, "source_aware_record_trigger_relaxed").otherwise("record_trigger_fallback_relaxed").alias("extraction_method"),
        F.lit(1).alias("phase"),
    )


def paired(groups: DataFrame) -> DataFrame:
    """A row for each pair of different names of a group."""
    rows = groups.withColumn("num_entities_in_sentence", F.size("entities")).withColumn("pair", F.explode(all_pairs(F.col("entities"))))
    rows = rows.withColumn("source_type", F.upper("source_type"))
    return rows.select(*KEYS, "pair.entity_a", "pair.entity_b", *schemas.RELATIONS[6:], "phase").filter("entity_a <> entity_b")


def deduplicated(rows: DataFrame) -> DataFrame:
    """First of the rows that agree in all but the number of names."""
    rank = F.col("phase").cast("long") * (1 << 32) + F.col("num_entities_in_sentence")
    least = rows.groupBy(*schemas.RELATIONS[:-1]).agg(F.min(rank).alias("rank"))
    return least.select(*schemas.RELATIONS[:-1], F.col("rank").bitwiseAND((1 << 32) - 1).cast("int").alias(schemas.RELATIONS[-1]))


def candidate_relations(resolved: DataFrame, cooccurrence: bool = True) -> DataFrame:
    """All candidate relations of a resolved table."""
    rows = schemas.require(resolved, REQUIRED)
    return deduplicated(paired(sentence_level(rows, cooccurrence).unionByName(record_level(rows))))
