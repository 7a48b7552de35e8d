"""Fixed column lists of the tables between the steps."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RECORDS = ["source_id", "source_type", "raw_text", "source_url", "date", "company_seed"]
CLEANED = RECORDS + [f"{c}_cleaned" for c in RECORDS[1:]] + ["company_seed_invalid", "company_seed_invalid_reason", "row_invalid_reasons", "row_valid_for_ner"]
MENTIONS = [
    "source_id", "source_type", "source_type_cleaned", "source_url", "source_url_cleaned", "date", "date_cleaned", "company_seed", "company_seed_cleaned",
    "raw_text", "raw_text_cleaned", "raw_mention", "entity_label", "start_char", "end_char", "mention_source", "mention_confidence",
]
RESOLVED = [
    "source_id", "source_type", "source_url", "date", "company_seed", "raw_text", "raw_mention", "entity_label", "start_char", "end_char",
    "normalized_name", "base_name", "legal_suffixes", "canonical_group_id", "canonical_name", "merge_confidence", "merge_decision", "evidence_note",
]
REVIEW = ["candidate_a", "candidate_b", "normalized_a", "normalized_b", "similarity_score", "review_confidence", "reason"]
RELATIONS = ["source_id", "source_type", "source_url", "date", "entity_a", "entity_b", "candidate_relation", "evidence_text", "trigger_phrase", "extraction_method", "num_entities_in_sentence"]


def require(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """`df`; a ValueError names the columns it lacks."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing required column(s): {', '.join(missing)}")
    return df


def ensure(df: DataFrame, defaults: dict[str, str | None]) -> DataFrame:
    """`df` with absent columns added: empty texts, or copies of the column named."""
    for column, sibling in defaults.items():
        if column not in df.columns:
            df = df.withColumn(column, F.col(sibling) if sibling and sibling in df.columns else F.lit(""))
    return df
