"""Winnowing fingerprints in DataFrame expressions only.

Grams are `GRAM` words in a row; each window of `WINDOW` grams selects its least
hash, the rightmost of equal ones, and what is selected keeps its position.  Any
run of GRAM + WINDOW - 1 words that two texts share has a selected gram in both.
A hash and its position are one number: 39 bits of hash above 24 bits that fall
with the position, so the least number is the least hash furthest right, and the
minimum over a window is built up from minima over 2, 4 and so on, the last two
overlapping.  A run of 7 words, so also what an edit leaves of a short text, is held.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

GRAM = 3
WINDOW = 5
_POSITION_BITS = 24
_SPACE = " \t\n\x0b\x0c\r"
#: stands for a null doc_id: less than any
NO_ID = -(1 << 63)


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(_SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def with_selection(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds `out`, the numbers selected from column `text`, in the order of the text.
    Fewer words than a gram are one gram; a blank text has none."""
    words, hashes, grams, least = (f"{out}_{x}" for x in ("words", "hashes", "grams", "least"))
    df = df.withColumn(words, F.transform(words_of(F.col(text)), lambda w: F.xxhash64(w)))
    gram = F.transform(F.sequence(F.lit(0), F.size(words) - GRAM), lambda i: F.xxhash64(*[F.get(F.col(words), i + j) for j in range(GRAM)]))
    whole = F.when(F.size(words) == 0, F.array().cast("array<bigint>")).otherwise(F.array(F.xxhash64(words)))
    df = df.withColumn(hashes, F.when(F.size(words) >= GRAM, gram).otherwise(whole))
    last = (1 << _POSITION_BITS) - 1
    number = lambda h, i: F.shiftleft(F.shiftrightunsigned(h, _POSITION_BITS + 1), _POSITION_BITS).bitwiseOR(F.lit(last) - i.bitwiseAND(F.lit(last)))
    df = df.withColumn(grams, F.transform(hashes, number))
    source, width = grams, 1
    while width < WINDOW:
        into, step = f"{least}{width}", min(width, WINDOW - width)
        df = df.withColumn(into, F.zip_with(source, F.slice(source, step + 1, F.greatest(F.size(source), F.lit(1))), lambda a, b: F.least(a, b)))
        source, width = into, width + step
    windows = F.slice(source, 1, F.greatest(F.size(source) - (WINDOW - 1), F.lit(1)))
    keep = [c for c in df.columns if not c.startswith(f"{out}_")]
    return df.select(*keep, F.array_distinct(windows).alias(out))


def as_text(selected: Column) -> Column:
    """The fingerprint as text: 16 hex digits for each selected gram."""
    return F.array_join(F.transform(selected, lambda x: F.lpad(F.hex(x), 16, "0")), " ")


def likeness(a: Column, b: Column) -> Column:
    """Share of the hashes of either selection that both have; 1 if both are empty."""
    sets = [F.array_distinct(F.transform(s, lambda x: F.shiftright(x, _POSITION_BITS))) for s in (a, b)]
    both, total = F.size(F.array_intersect(*sets)), F.size(F.array_union(*sets))
    return F.when(total == 0, F.lit(1.0)).otherwise(both / total)


def _bucket(value: Column, cuts: list[int]) -> Column:
    """Number of cuts at or below a value, by two short scans instead of a long one."""
    if not cuts:
        return F.lit(0)
    step = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    heads = F.array(*[F.lit(g[0]) for g in groups])
    group = F.size(F.filter(heads, lambda c: c <= value))
    parts = F.array(*[F.array(*[F.lit(c) for c in g]) for g in groups])
    inside = F.size(F.filter(F.get(parts, group - 1), lambda c: c <= value))
    return F.when(group == 0, F.lit(0)).otherwise((group - 1) * step + inside)


def with_next(docs: DataFrame) -> DataFrame:
    """Rows with `text` and `picked` of the document next in falling doc_id; after the
    last comes the first.  Texts are dealt once, by ranges of doc_id; a range also
    gets the document that follows its last one."""
    spark = docs.sparkSession
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("did"), F.coalesce("text", F.lit("")).alias("text"))
    found = docs.approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 0.1 / ranges) if ranges > 1 else []
    cuts = sorted({int(x) for x in found})
    rows = rows.withColumn("range", _bucket(F.col("did"), cuts))
    tops = sorted(tuple(r) for r in rows.groupBy("range").agg(F.max("did")).collect())
    follows = [(top, tops[(i + 1) % len(tops)][0]) for i, (_, top) in enumerate(tops)]
    follows = spark.createDataFrame(follows, "did long, range int")  # a row a range
    after = rows.drop("range").join(F.broadcast(follows), "did").select("did", "text", "range", F.lit(True).alias("guest"))
    dealt = rows.withColumn("guest", F.lit(False)).unionByName(after).repartition("range")
    # the guest of the lowest range is the highest of all; elsewhere it stands below the range
    picked = with_selection(dealt, "text", "picked")
    order = Window.partitionBy("range").orderBy("guest", F.desc("did"), "text")
    return picked.select("*", F.lead("text").over(order).alias("next_text"), F.lead("picked").over(order).alias("next_picked")).filter("not guest").drop("guest", "range")


def fingerprinted(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    A null text is empty; a null doc_id comes after all others.  Rows with one
    doc_id follow each other in the order of their texts."""
    rows = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    keep = (F.col("n_chars") - cut).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), keep), F.substring(F.col("next_text"), F.lit(1), cut)))
    rows = with_selection(rows, "edited", "edited_picked")
    return rows.select(
        F.nullif("did", F.lit(NO_ID)).alias("doc_id"),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("picked")).alias("fingerprint"),
        as_text(F.col("edited_picked")).alias("edited_fingerprint"),
        likeness(F.col("picked"), F.col("edited_picked")).alias("near_edited"),
        likeness(F.col("picked"), F.col("next_picked")).alias("near_next"),
    )


def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winnowing fingerprints of all documents, of their edited texts, and the likeness
    to these and to the next document.  See `fingerprinted`; an empty table gives no
    rows, further columns are ignored."""
    return fingerprinted(spark.read.parquet(f"{sf_dir}/documents.parquet"))
