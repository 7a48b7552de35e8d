"""Row validation: cleaned columns, all reasons against a row, and the split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpweave import schemas
from corpweave.functions import rules
from corpweave.functions.text import normalize_source_type, normalize_whitespace, seed_reason


def validated(records: DataFrame) -> DataFrame:
    """`records` with cleaned columns and the reasons why a row is no use."""
    df = schemas.require(records, schemas.RECORDS[:3])
    df = schemas.ensure(df, {c: None for c in schemas.RECORDS[3:]})
    source = F.col("source_type_cleaned")
    df = df.withColumn("source_type_cleaned", normalize_source_type(F.col("source_type")))
    for c in schemas.RECORDS[2:]:
        df = df.withColumn(f"{c}_cleaned", normalize_whitespace(F.col(c)))
    df = df.withColumn("company_seed_invalid_reason", seed_reason(F.col("company_seed")))
    df = df.withColumn("company_seed_invalid", F.col("company_seed_invalid_reason") != "")
    reasons = F.concat_ws(
        ";",
        F.when(F.col("raw_text_cleaned") == "", "missing_raw_text"),
        F.when(source == "", "missing_source_type").when(~source.isin(rules.VALID_SOURCES), "unknown_source_type"),
        F.when(F.col("company_seed_invalid"), F.col("company_seed_invalid_reason")),
    )
    df = df.withColumn("row_invalid_reasons", reasons).withColumn("row_valid_for_ner", F.col("row_invalid_reasons") == "")
    return df.select(*schemas.CLEANED)


def split(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid and invalid rows."""
    rows = validated(records)
    return rows.filter("row_valid_for_ner"), rows.filter("not row_valid_for_ner")


def summary(records: DataFrame) -> DataFrame:
    """Rows per combination of reasons; valid rows have none."""
    return validated(records).groupBy("row_invalid_reasons").agg(F.count("*").alias("n_rows"))
