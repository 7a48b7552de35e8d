"""Seed lists: a name per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpweave.functions.text import invalid_seed_line, is_reasonable_seed, normalize_seed, normalize_whitespace, strip_prefix_junk


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(ord, line) of a text file; ord rises along it."""
    return spark.read.text(path).select(F.monotonically_increasing_id().alias("ord"), F.col("value").alias("line"))


def ingest_seeds(lines: DataFrame) -> DataFrame:
    """(seed, ord): cleaned distinct names in the order of their first line.  Names
    that differ in case are different."""
    seed = F.trim(strip_prefix_junk(normalize_seed(F.trim("line"))))
    rows = lines.select("ord", seed.alias("seed")).filter("seed is not null").filter(~invalid_seed_line(F.col("seed")))
    return rows.groupBy("seed").agg(F.min("ord").alias("ord"))


def dictionary_seeds(lines: DataFrame) -> DataFrame:
    """(seed, ord) of lines that may serve as dictionary names; repeats stay."""
    return lines.select(normalize_whitespace(F.col("line")).alias("seed"), "ord").filter(is_reasonable_seed(F.col("seed")))
