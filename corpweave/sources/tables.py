"""CSV with pandas' conventions, for exchange, and the writers of the steps' results."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from corpweave.functions import rules


def na_to_null(df: DataFrame) -> DataFrame:
    """Texts that pandas reads as missing become null."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.withColumns({c: F.when(~F.col(c).isin(rules.CSV_NA), F.col(c)) for c in texts})


def read_csv(spark: SparkSession, path: str, schema: StructType | str, na: bool = True) -> DataFrame:
    """A CSV with header, doubled quotes and line ends inside quotes."""
    reader = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').option("quote", '"')
    df = reader.csv(path)
    return na_to_null(df) if na else df


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The same form; the header is there for an empty table too."""
    df.write.mode(mode).option("header", True).option("escape", '"').option("quote", '"').option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_counted(df: DataFrame, path: str, name: str, mode: str = "errorifexists") -> int:
    """Writes Parquet and tells the number of rows, counted on the way."""
    seen = Observation(name)
    df.observe(seen, F.count(F.lit(1)).alias("n_rows")).write.mode(mode).parquet(path)
    return seen.get["n_rows"]


#: types of columns that are no texts, in whatever table
TYPES = {"source_id": "bigint", "start_char": "int", "end_char": "int", "company_seed_invalid": "boolean", "row_valid_for_ner": "boolean", "canonical_group_id": "bigint", "merge_confidence": "double"}


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table between two steps: CSV where the path ends in .csv, else Parquet."""
    if not path.rstrip("/").lower().endswith(".csv"):
        return spark.read.parquet(path)
    has = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).columns
    return read_csv(spark, path, ", ".join(f"`{c}` {TYPES.get(c, 'string')}" for c in has))


def write_table(df: DataFrame, path: str, name: str, mode: str = "errorifexists") -> int:
    """Writes a table in the form that `read_table` reads; tells the number of rows."""
    if not path.rstrip("/").lower().endswith(".csv"):
        return write_counted(df, path, name, mode)
    seen = Observation(name)
    write_csv(df.observe(seen, F.count(F.lit(1)).alias("n_rows")), path, mode)
    return seen.get["n_rows"]


def append_batch(df: DataFrame, path: str, batch: str) -> None:
    """Adds a batch of records under its own partition; a repeated batch replaces itself.
    Nothing that was written before is written again."""
    (df.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path))


def write_split(valid: DataFrame, invalid: DataFrame, valid_path: str, invalid_path: str) -> tuple[int, int]:
    return write_counted(valid, valid_path, "valid"), write_counted(invalid, invalid_path, "invalid")
