"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the
tables and the threads.  Each query is written to Spark's no-op sink, so all its
rows are made.  Only queries of the reference's own operators are timed.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

HEADLINE = [
    "valid_rows",
    "preprocess_summary",
    "company_normalize",
    "suffix_split",
    "filings_zip_limit",
    "cik_first_match",
    "xml_patent_parse",
    "ingest_union_ids",
    "ruler_patterns",
    "dictionary_mentions",
    "resolved_entities",
    "similarity_pairs",
    "review_queue",
    "sentence_assign",
    "detect_relation",
    "candidate_relations",
    "graph_components",
]


def main() -> None:
    from corpweave.plans.queries import Q

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(2 * int(cpus)))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    took = {}
    for name in HEADLINE:
        began = time.time()
        Q[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "seconds over headline queries", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": Path(sf_dir).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
