"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Documents of a source are dealt by hash into blocks, more for larger sources.  A source
whose target is f times its size is passed over floor(f) times in whole, each time
in another order of its blocks, and once more up to what is left, the last block
up to single documents.  That makes a sequence of blocks per source.  The tree
starts from the numbers of blocks of all sources and gives each half of the output
shards its part by a multivariate-hypergeometric draw, down to single shards: the
numbers are exact, and each shard's mix is that of a random draw.  A shard then
draws its stretch of each source's permuted blocks, so no two draw the same, and
orders its documents by hash.  What a document is taken for is counted in the shards.

All steps over documents are DataFrame expressions; the driver handles one row a
source and the tree's counts.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpweave.storage import written

WEIGHTS = (5, 2, 1)
#: times a document, and so a source, is taken at most
MOST_TIMES = 3
#: blocks of a source at least and at most, and words in a block beyond the least
BLOCKS, MOST_BLOCKS, BLOCK_WORDS = 1024, 1 << 20, 1 << 24
#: output shards at least, and words in a shard beyond that
SHARDS, SHARD_WORDS = 64, 1 << 26
SEED = 20
#: sources are a dimension: the driver plans at most so many
MOST_SOURCES = 100_000
#: plan rows up to which the join with them is a broadcast
BROADCAST_SOURCES = 2_000


def words_in(text: Column) -> Column:
    """Number of runs without ASCII white space; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def blocks_of(words: Column) -> Column:
    """Number of blocks of a source with so many words."""
    return F.greatest(F.lit(BLOCKS), F.least(F.lit(MOST_BLOCKS), F.shiftright(words, BLOCK_WORDS.bit_length() - 1))).cast("int")


def targets(sizes: list[tuple[str | None, int]], weights: tuple = WEIGHTS, most: int = MOST_TIMES) -> list[float]:
    """Target of each of the sources, which come in their order: shares by weight of
    the sum of all sizes; what exceeds `most` sizes of a source goes to the others."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    out: list[float | None] = [None] * len(sizes)
    rest = sum(n for _, n in sizes)
    while True:
        free = [i for i, t in enumerate(out) if t is None]
        if not free:
            return out
        base = sum(w[i] for i in free)
        share = {i: rest * w[i] / base for i in free}
        over = [i for i in free if share[i] > most * sizes[i][1]]
        if not over:
            for i in free:
                out[i] = share[i]
            return out
        for i in over:
            out[i] = float(most * sizes[i][1])
            rest -= most * sizes[i][1]


def split_tree(blocks: list[int], shards: int, seed: int = SEED) -> np.ndarray:
    """shards x sources numbers of blocks: rows are alike in sum, columns add up to
    `blocks`, and each node of the tree is a multivariate-hypergeometric draw."""
    rng = np.random.default_rng(seed)
    out = np.zeros((shards, len(blocks)), dtype=np.int64)
    nodes = [(0, shards, np.array(blocks, dtype=np.int64))]
    while nodes:
        lo, hi, have = nodes.pop()
        if hi - lo == 1:
            out[lo] = have
            continue
        mid = (lo + hi) // 2
        left = rng.multivariate_hypergeometric(have, int(have.sum()) * (mid - lo) // (hi - lo), method="marginals") if have.sum() else have
        nodes += [(lo, mid, left), (mid, hi, have - left)]
    return out


def allotted(docs: DataFrame, weights: tuple = WEIGHTS, shards: int | None = None, seed: int = SEED) -> DataFrame:
    """Each row of `docs` (doc_id, source, text) as row (a number of its own), key (a hash
    of doc_id and text), doc_id, source, size, source_size, target and copies: an array of
    struct(pass, shard), one for each time a shard draws it.

    A null text has size 0, a null source is a source of its own; a null doc_id is
    hashed like a value.  Repeated rows are rows of their own."""
    spark = docs.sparkSession
    sized = docs.select(F.monotonically_increasing_id().alias("row"), row_key().alias("key"), "doc_id", "source", words_in(F.col("text")).alias("size"))
    sized = written(sized.withColumn("skey", _key(F.col("source"))), "mix-sizes")
    sources = sized.groupBy("skey").agg(F.first("source").alias("source"), F.sum("size").alias("words"))
    rows = sources.limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    rows.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode("utf-8", "surrogatepass")))
    goals = targets([(r["source"], r["words"]) for r in rows], weights)
    plan = [(r["skey"], r["words"], t, int(t // r["words"]) if r["words"] else 0, t % r["words"] if r["words"] else 0.0) for r, t in zip(rows, goals)]
    plan = spark.createDataFrame(plan, "skey string, source_size long, target double, whole int, part double")
    hint = F.broadcast if len(rows) <= BROADCAST_SOURCES else (lambda df: df)
    shards = shards or max(SHARDS, sum(r["words"] for r in rows) // SHARD_WORDS)

    sized = sized.join(hint(plan), "skey").withColumn("block", F.pmod(F.xxhash64("key", F.lit(seed)), blocks_of(F.col("source_size"))).cast("int"))
    blocks = sized.groupBy("skey", "block", "whole", "part").agg(F.sum("size").alias("words"))
    passes = written(blocks, "mix-blocks").select("*", F.explode(F.sequence(F.lit(0), "whole")).alias("pass"))
    by = Window.partitionBy("skey", "pass").orderBy(F.xxhash64("skey", "block", "pass", F.lit(seed)), "block")
    upto = F.sum("words").over(by.rowsBetween(Window.unboundedPreceding, 0))
    drawn = passes.withColumn("place", F.row_number().over(by) - 1).withColumn("before", upto - F.col("words"))
    last = F.col("pass") == F.col("whole")
    drawn = drawn.filter(~last | (F.col("before") < F.col("part")))
    drawn = drawn.withColumn("rest", F.when(last & (F.col("before") + F.col("words") > F.col("part")), F.col("part") - F.col("before")))
    drawn = written(drawn.select("skey", "block", "pass", "place", "rest"), "mix-draws")
    lengths = {(r["skey"], r["pass"]): r["n"] for r in drawn.groupBy("skey", "pass").agg(F.count("*").alias("n")).collect()}
    each = [[lengths.get((r["skey"], p), 0) for p in range(MOST_TIMES + 1)] for r in rows]
    counts = split_tree([sum(n) for n in each], shards, seed)
    # stretches of each source's sequence of blocks, all passes in a row: one for each shard that draws from it
    ends = np.cumsum(counts, axis=0)
    stretches = [(r["skey"], k, int(ends[k, i] - counts[k, i]), int(ends[k, i]) - 1) for i, r in enumerate(rows) for k in np.flatnonzero(counts[:, i]).tolist()]
    stretches = spark.createDataFrame(stretches, "skey string, shard int, low long, high long")
    shares = stretches.select("skey", "shard", F.explode(F.sequence("low", "high")).alias("at"))
    bases = [(r["skey"], p, sum(n[:p])) for r, n in zip(rows, each) for p in range(MOST_TIMES + 1) if n[p]]
    bases = spark.createDataFrame(bases, "skey string, pass int, base long")
    numbered = drawn.join(hint(bases), ["skey", "pass"]).withColumn("at", F.col("base") + F.col("place"))
    draws = numbered.join(shares, ["skey", "at"]).groupBy("skey", "block").agg(F.array_sort(F.collect_list(F.struct("pass", "shard", "rest"))).alias("draws"))

    inside = Window.partitionBy("skey", "block").orderBy(F.xxhash64("key", F.lit("inside"), F.lit(seed)), "doc_id", "size")
    rows_ = sized.join(draws, ["skey", "block"], "left").withColumn("upto", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    taken = F.filter(F.coalesce("draws", F.array().cast("array<struct<pass:int,shard:int,rest:double>>")), lambda d: d["rest"].isNull() | (F.col("upto") - F.col("size") / 2.0 <= d["rest"]))
    taken = F.transform(taken, lambda d: F.struct(d["pass"].alias("pass"), d["shard"].alias("shard")))
    return rows_.select("row", "key", "doc_id", "source", "size", "source_size", "target", taken.alias("copies"))


def dealt(each: DataFrame, seed: int = SEED) -> DataFrame:
    """The rows of `allotted`, one for each time a document is taken, with `shard` and
    `place`, the order in the shard."""
    rows = each.select("row", "key", "doc_id", "source", "size", F.explode("copies").alias("copy"))
    return rows.select("row", "key", "doc_id", "source", "size", "copy.pass", "copy.shard", F.xxhash64("key", "copy.pass", F.lit("place"), F.lit(seed)).alias("place"))


def in_shards(rows: DataFrame) -> DataFrame:
    """`rows` dealt by shard, each shard in the order of its places."""
    return rows.repartition("shard").sortWithinPartitions("shard", "place")


def mixed(docs: DataFrame, weights: tuple = WEIGHTS, shards: int | None = None, seed: int = SEED) -> DataFrame:
    """The mix itself: a row for each time a document is taken, with `shard` and
    `place`, the order in the shard.  Write it with `in_shards`."""
    return dealt(allotted(docs, weights, shards, seed), seed).drop("row", "key")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix with all their columns, by shard and place.  Rows that are
    equal in doc_id and text are told apart by nothing: each is taken as often as the one
    of them that is taken most."""
    draws = dealt(allotted(docs)).groupBy("key").agg(F.collect_set(F.struct("shard", "place")).alias("draws"))
    rows = docs.select(row_key().alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    taken = rows.join(draws, "key").select("doc", F.explode("draws").alias("draw"))
    return in_shards(taken.select("doc", "draw.shard", "draw.place")).select("doc.*")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of all documents takes: doc_id, size, source_size, target, taken, and
    shards, the output shards that drew the document, in order.  The mix is written in
    shards, and `taken` and `shards` are read from them.

    See `allotted` for nulls and repeated rows; documents without words are taken
    like others and count nothing.  An empty table gives no rows; further columns
    are ignored."""
    each = written(allotted(spark.read.parquet(f"{sf_dir}/documents.parquet")), "mix-rows")
    mix = written(in_shards(dealt(each)), "mix")
    drawn = mix.groupBy("row").agg(F.sum("size").alias("taken"), F.array_sort(F.collect_list("shard")).alias("shards"))
    found = each.join(drawn, "row", "left")
    none = F.array().cast("array<int>")
    return found.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"), F.coalesce("shards", none).alias("shards"))
