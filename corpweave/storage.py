"""Tables in the folder that driver and executors share.

Iterative plans cut their lineage by writing a table there and reading it back,
so a lost executor costs a re-read and never a recomputation of all rounds.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session; where it is unset, a folder made for this
    session, on one machine only: on a cluster no other executor would see it."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        found = getattr(spark, "_corpweave_shared", None) or "file://" + tempfile.mkdtemp(prefix="corpweave-")
        spark._corpweave_shared = found
    return found.rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark)}/corpweave/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows of `df` as a table in the shared folder."""
    spark, path = df.sparkSession, shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
