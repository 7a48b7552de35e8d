"""A training corpus from `documents`, in stages that each apply one operator.

Every stage but the last returns the columns it got, further ones and such with names of
its own working columns included; an empty table gives an empty one.  Rows are told
apart by doc_id and text, not by doc_id alone: a null or repeated doc_id is allowed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpweave.llm.langid import fit, in_learned_language
from corpweave.llm.mixing import mixed_documents
from corpweave.llm.neardup import without_near_copies
from corpweave.llm.packing import packed
from corpweave.llm.suffix import without_repeats
from corpweave.storage import written

ORACLE_SQL = None  # no stage can be expressed in SQL; tests hold each against a plain version


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those in none of the languages learned from
    the labelled rows; `LanguageModel.recognised` has the rule.

    Null, empty and blank texts go; repeated rows fare alike; without labels every
    text with a letter stays."""
    return in_learned_language(docs, fit(docs.select("doc_id", "text", "lang")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, by SimHash over five-word shingles
    and a verified similarity of 0.8 or more: that of the least doc_id, nulls last.

    Null, empty and blank texts are copies of each other.  Of rows that share a doc_id
    each text counts for itself; repeated rows are copies, of which one stays."""
    return without_near_copies(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out passages that an earlier document holds; nothing else of a document goes,
    and no document.  A character that is cut in two goes whole.

    Null texts stay null; rows with one doc_id, or none, are not compared with each
    other; n_chars follows the text where the table has it."""
    kept = without_repeats(docs, with_text=True)
    columns = {c: F.col(f"rest.`{c}`") for c in docs.columns}
    columns |= {"doc_id": F.col("doc_id"), "text": F.when(~F.col("no_text"), F.col("kept_text"))}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("rest.n_chars"))
    return kept.select(*[c.alias(name) for name, c in columns.items()])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and leaves out documents so that the sources have their target shares;
    the mix stands by shard, each shard in its own order.

    Null texts have no words and are taken like others; a null source is a source."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the mix into sequences of 1024 ids; `packed` has the cases."""
    import public_tokenizers

    return packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("passage_dedup", passage_dedup),
    ("mixing", mixing),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to `documents`; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
