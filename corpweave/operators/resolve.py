"""Alias resolution: mentions -> groups of names, canonical names, review queue.

The rules for a pair of names are equi-joins (same base, acronym) and a similarity
join; the first rule that holds decides.  Only merges make groups; reviews are
queued.  Pairs are found between distinct normalized names and spread over raw
spellings only in the review queue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpweave import schemas
from corpweave.functions.text import acronym, bare_name, base_name, company_name, legal_suffixes, normalize_whitespace
from corpweave.operators.components import connected_components
from corpweave.operators.similarity import AUTO, REVIEW, similar_pairs
from corpweave.storage import written


def named(mentions: DataFrame) -> DataFrame:
    """`mentions` with normalized_name, base_name, legal_suffixes."""
    df = schemas.require(mentions, ["source_id", "raw_mention"])
    df = schemas.ensure(df, {c: None for c in schemas.RESOLVED[:10]})
    df = df.withColumn("raw_mention", normalize_whitespace(F.col("raw_mention"))).withColumn("normalized_name", company_name(F.col("raw_mention")))
    return df.withColumn("base_name", base_name(F.col("normalized_name"))).withColumn("legal_suffixes", legal_suffixes(F.col("normalized_name")))


def spellings(mentions: DataFrame) -> DataFrame:
    """Distinct raw mentions with their normalized name and the place of their first
    row, in the order of record, offsets and lower-cased text."""
    df = schemas.ensure(schemas.require(mentions, ["source_id", "raw_mention"]), {c: None for c in schemas.RESOLVED[:10]})
    # each spelling is normalised once, not each of its rows
    at = F.struct("source_id", F.expr("try_cast(start_char as int)").alias("a"), F.expr("try_cast(end_char as int)").alias("b"))
    first = df.groupBy("raw_mention").agg(F.min(at).alias("at")).withColumn("raw_mention", normalize_whitespace(F.col("raw_mention")))
    first = first.groupBy("raw_mention").agg(F.min("at").alias("at")).withColumn("normalized_name", company_name(F.col("raw_mention")))
    place = F.struct("at.source_id", "at.a", "at.b", F.lower(F.trim("raw_mention")).alias("low"), "raw_mention")
    return first.select("raw_mention", "normalized_name", place.alias("ord")).filter("normalized_name <> ''")


def distinct_names(mentions: DataFrame) -> DataFrame:
    """name, base, suffixes, bare, short (acronym of the base, or of a name without one), ord and
    raw (first spelling)."""
    names = spellings(mentions).groupBy("normalized_name").agg(F.min("ord").alias("ord"), F.min_by("raw_mention", "ord").alias("raw"))
    names = names.withColumnRenamed("normalized_name", "name").withColumn("base", base_name(F.col("name")))
    return names.withColumn("suffixes", legal_suffixes(F.col("name"))).withColumn("bare", bare_name(F.col("name"))).withColumn("short", acronym(F.when(F.col("base") != "", F.col("base")).otherwise(F.col("name"))))


def base_edges(names: DataFrame) -> DataFrame:
    """Each name to the first of its base: a star stands for all pairs."""
    heads = names.filter("base <> ''").groupBy("base").agg(F.min("name").alias("head"))
    return names.join(heads, "base").filter("name <> head").select(F.col("name").alias("src"), F.col("head").alias("dst"))


def acronym_edges(names: DataFrame) -> DataFrame:
    """Names whose letters are the acronym of another name's base, or of the whole name
    where it is suffixes only."""
    full = names.select(F.col("name").alias("dst"), F.col("short").alias("bare")).filter("length(bare) >= 2")
    return names.select(F.col("name").alias("src"), "bare").join(full, "bare").filter("src <> dst").select("src", "dst").distinct()


def similarity_pairs(names: DataFrame, least: float) -> DataFrame:
    return similar_pairs(names.select("name", "ord"), least)


def judged_pairs(names: DataFrame) -> DataFrame:
    """(name_a, name_b, similarity, decision, confidence, reason) of similar pairs
    that no earlier rule merges; a stands first in the mentions."""
    pairs = similarity_pairs(names, 0.86)
    side = lambda s: names.select(F.col("name").alias(f"name_{s}"), F.col("base").alias(f"base_{s}"), F.col("bare").alias(f"bare_{s}"), F.col("short").alias(f"short_{s}"))
    rows = pairs.join(side("a"), "name_a").join(side("b"), "name_b")
    same_base = (F.col("base_a") == F.col("base_b")) & (F.col("base_a") != "")
    is_acronym = ((F.length("bare_a") >= 2) & (F.col("bare_a") == F.col("short_b"))) | ((F.length("bare_b") >= 2) & (F.col("bare_b") == F.col("short_a")))
    alike = (F.substring("base_a", 1, 10) == F.substring("base_b", 1, 10)) | F.endswith("base_a", F.col("base_b")) | F.endswith("base_b", F.col("base_a"))
    s = F.col("similarity")
    verdict = (
        F.when(same_base | is_acronym, F.lit(None))
        .when(s >= AUTO, F.struct(F.lit("auto_merge").alias("decision"), F.lit(0.89).alias("confidence"), F.lit("very_high_string_similarity").alias("reason")))
        .when(s >= REVIEW, F.struct(F.lit("review_needed").alias("decision"), F.lit(0.66).alias("confidence"), F.lit("high_string_similarity_review").alias("reason")))
        .when(alike, F.struct(F.lit("review_needed").alias("decision"), F.lit(0.58).alias("confidence"), F.lit("shared_long_base_review").alias("reason")))
    )
    return rows.withColumn("v", verdict).filter("v is not null").select("name_a", "name_b", "similarity", "v.*")


def merge_edges(names: DataFrame, judged: DataFrame | None) -> DataFrame:
    edges = base_edges(names).union(acronym_edges(names))
    return edges if judged is None else edges.union(judged.filter("decision = 'auto_merge'").select("name_a", "name_b"))


def groups(names: DataFrame, edges: DataFrame) -> DataFrame:
    """(name, group_id, n_names): groups are numbered by the least hash-free order, the
    code-point order of their least names; a name without edges is its own group."""
    linked = connected_components(edges)
    placed = names.join(linked, names["name"] == linked["node"], "left").select("name", "ord", F.coalesce("component", "name").alias("leader"))
    sizes = placed.groupBy("leader").agg(F.count("*").alias("n_names"), F.min("ord").alias("first"))
    return placed.join(sizes, "leader").select("name", F.col("leader"), "n_names", F.col("first"))


def review_queue(mentions: DataFrame, judged: DataFrame) -> DataFrame:
    """Pairs to review, one row for each pair of raw spellings; each shows the first
    spelling of its names, and names stand in the order in which the spellings do."""
    raws = spellings(mentions)
    first = Window.partitionBy("normalized_name").orderBy("ord")
    raws = raws.withColumn("shown", F.first("raw_mention").over(first))
    side = lambda s: raws.select(F.col("normalized_name").alias(f"name_{s}"), F.col("shown").alias(f"shown_{s}"), F.col("ord").alias(f"ord_{s}"))
    rows = judged.filter("decision = 'review_needed'").join(side("a"), "name_a").join(side("b"), "name_b")
    kept = F.col("ord_a") < F.col("ord_b")
    pick = lambda x: F.when(kept, F.col(f"{x}_a")).otherwise(F.col(f"{x}_b"))
    drop = lambda x: F.when(kept, F.col(f"{x}_b")).otherwise(F.col(f"{x}_a"))
    return rows.select(
        pick("shown").alias("candidate_a"), drop("shown").alias("candidate_b"), pick("name").alias("normalized_a"), drop("name").alias("normalized_b"),
        F.round("similarity", 4).alias("similarity_score"), F.col("confidence").alias("review_confidence"), "reason",
    )


def canonical_names(rows: DataFrame) -> DataFrame:
    """Most frequent raw mention of each group of `rows` (leader, raw_mention); ties go
    to the longer, then to the greater in code-point order."""
    counts = rows.groupBy("leader", "raw_mention").agg(F.count("*").alias("n"))
    return counts.groupBy("leader").agg(F.max_by("raw_mention", F.struct("n", F.length("raw_mention"), "raw_mention")).alias("canonical_name"))


def resolved(mentions: DataFrame, with_similarity: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """The resolved table and the review queue (None without the similarity rules).

    Group numbers follow the first appearance of a group's names.  A mention without
    letters or digits has no group: its canonical name is itself."""
    rows = written(named(mentions), "named")
    names = written(distinct_names(rows), "names")
    judged = written(judged_pairs(names), "judged") if with_similarity else None
    placed = written(groups(names, merge_edges(names, judged)), "groups")
    leaders = placed.select("leader", "first").distinct()
    # group numbers: ranks within ranges of the order, offset by the ranges before
    numbered = numbered_by(leaders, "first").select("leader", F.col("number").alias("canonical_group_id"))
    joined = rows.join(placed.select(F.col("name").alias("normalized_name"), "leader", "n_names"), "normalized_name", "left")
    canon = canonical_names(joined.filter("leader is not null"))
    if judged is not None:
        reviews = judged.filter("decision = 'review_needed'")
        both = reviews.select(F.col("name_a").alias("normalized_name"), "confidence", "reason").union(reviews.select("name_b", "confidence", "reason"))
        best = both.groupBy("normalized_name").agg(F.max("confidence").alias("confidence"), F.max_by("reason", "confidence").alias("reason"))
        joined = joined.join(best, "normalized_name", "left")
    else:
        joined = joined.withColumn("confidence", F.lit(None).cast("double")).withColumn("reason", F.lit(None).cast("string"))
    out = joined.join(canon, "leader", "left").join(numbered, "leader", "left")
    merged, review = F.col("n_names") > 1, F.col("reason").isNotNull()
    out = (
        out.withColumn("canonical_name", F.coalesce("canonical_name", "raw_mention"))
        .withColumn("merge_confidence", F.when(merged, 0.90).when(review, F.col("confidence")).otherwise(1.0))
        .withColumn("merge_decision", F.when(merged, "auto_merge").when(review, "review_needed").otherwise("singleton"))
        .withColumn("evidence_note", F.when(merged, "relaxed_auto_merge_component").when(review, F.col("reason")).otherwise("singleton_no_merge_needed"))
    )
    queue = None if judged is None else review_queue(rows, judged)
    return out.select(*schemas.RESOLVED), queue


def numbered_by(df: DataFrame, *order: str) -> DataFrame:
    """`df` with `number`, 1 to n in the order: ranges are sorted apart, and each
    counts on from those before it; no task sees all rows."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    ranged = written(ranged.withColumn("_row", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "ranges")
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    bases = sizes.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return ranged.join(F.broadcast(bases), "_part").withColumn("number", F.col("base") + F.col("_row") + 1).drop("_part", "_row", "base")
