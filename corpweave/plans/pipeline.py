"""Records to candidate relations, as one chain of operators, and its command line."""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import DataFrame, SparkSession

from corpweave.operators import mentions, preprocess, relations, resolve
from corpweave.sources import seeds as seed_files
from corpweave.sources import tables
from corpweave.plans.ingest import collected
from corpweave.storage import written


def relations_of(records: DataFrame, extra_seeds: DataFrame | None = None, cooccurrence: bool = True, with_similarity: bool = True) -> dict[str, DataFrame]:
    """All tables of the chain by name; what is read more than once is written."""
    cleaned, invalid = preprocess.split(records)
    dictionary = mentions.patterns(mentions.seeds_of(cleaned, extra_seeds))
    found = written(mentions.extracted(cleaned, dictionary), "mentions")
    rows, queue = resolve.resolved(found, with_similarity)
    rows = written(rows, "resolved")
    return {"cleaned": cleaned, "invalid": invalid, "mentions": found, "resolved": rows, "review": queue, "relations": relations.candidate_relations(rows, cooccurrence)}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="corpweave", description=__doc__)
    steps = parser.add_subparsers(dest="step", required=True)
    for name, flags in {
        "ingest": ["--seed-list-file", "--landed", "--output"],
        "preprocess": ["--input", "--cleaned-output", "--invalid-output"],
        "ner": ["--input", "--output"],
        "resolve": ["--input", "--resolved-output", "--review-output"],
        "relations": ["--input", "--output"],
    }.items():
        step = steps.add_parser(name)
        for flag in flags:
            step.add_argument(flag, required=True)
        if name == "ner":
            step.add_argument("--seed-list-file")
            step.add_argument("--entity-labels", nargs="+", default=[mentions.LABEL])
            step.add_argument("--batch-size", type=int, help="rows that are handed to Python at once")
            step.add_argument("--tagger", help="module:function of a tagger beside the dictionary")
        if name == "relations":
            step.add_argument("--disable-cooccur-fallback", action="store_true")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"corpweave-{args.step}").getOrCreate()
    if args.step == "ingest":
        seeds = seed_files.ingest_seeds(seed_files.read_lines(spark, args.seed_list_file))
        print("records:", tables.write_table(collected(seeds, spark.read.parquet(args.landed)), args.output, "records"))
        return 0
    source = tables.read_table(spark, args.input)
    if args.step == "preprocess":
        valid, invalid = preprocess.split(source)
        print("valid, invalid rows:", *(tables.write_table(df, path, name) for df, path, name in ((valid, args.cleaned_output, "valid"), (invalid, args.invalid_output, "invalid"))))
    elif args.step == "ner":
        extra = seed_files.dictionary_seeds(seed_files.read_lines(spark, args.seed_list_file)) if args.seed_list_file else None
        if args.batch_size:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(args.batch_size))
        module, _, name = (args.tagger or "").partition(":")
        tagger = getattr(importlib.import_module(module), name) if module else None
        found = mentions.extracted(source, mentions.patterns(mentions.seeds_of(source, extra)), tuple(args.entity_labels), tagger)
        print("mentions:", tables.write_table(found, args.output, "mentions"))
    elif args.step == "resolve":
        rows, queue = resolve.resolved(source)
        print("resolved rows:", tables.write_table(rows, args.resolved_output, "resolved"), "to review:", tables.write_table(queue, args.review_output, "review"))
    else:
        found = relations.candidate_relations(source, not args.disable_cooccur_fallback)
        print("relations:", tables.write_table(found, args.output, "relations"))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
