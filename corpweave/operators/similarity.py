"""Candidate pairs of names by string similarity.

The measure is Ratcliff and Obershelp's, as in the standard library; it depends on
the order of the two names, so pairs keep theirs.  What it matches is a common
subsequence, so names with a ratio of `least` or more have lengths, letters and a longest
common subsequence that allow it.  All pairs of names whose lengths do are looked at, in
blocks of bounded size that are dealt to tasks: a few machine instructions on the bits of
their letters leave few, and bit-parallel subsequences leave hardly more than are alike;
only those are measured.  Nothing is lost, whatever names have in common.
"""

from __future__ import annotations

from difflib import SequenceMatcher
from math import ceil, floor

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpweave.shipping import shipped
from corpweave.storage import written

LEAST = 0.86
AUTO, REVIEW, BASE = 0.96, 0.91, 0.86
#: names in a chunk, about; pairs that numpy holds at once; pairs that a task is meant to compare, and the most tasks
CHUNK, CELLS, TASK, MOST_TASKS = 8192, 1 << 18, 2e8, 10_000


def ratio(a: str | None, b: str | None) -> float:
    return SequenceMatcher(None, a or "", b or "").ratio()


def _counts(names: pd.Series) -> np.ndarray:
    """How often each of 64 classes of letters occurs in each name."""
    raw = [x.encode("utf-8", "surrogatepass") for x in names]
    sizes = np.array([len(x) for x in raw])
    place = np.repeat(np.arange(len(raw)), sizes) * 64 + (np.frombuffer(b"".join(raw), dtype=np.uint8) & 63)
    return np.bincount(place, minlength=64 * len(raw)).reshape(-1, 64)


def ratio_of(a: Column, b: Column, least: float = 0.0) -> Column:
    """The ratio of two texts of single-byte letters; null where letter counts show that
    it is below `least`."""

    def ratios(left: pd.Series, right: pd.Series) -> pd.Series:
        x, y = _counts(left), _counts(right)
        possible = 2 * np.minimum(x, y).sum(axis=1) >= least * (x.sum(axis=1) + y.sum(axis=1)) - 1e-9
        return pd.Series([ratio(p, q) if ok else None for p, q, ok in zip(left, right, possible)], dtype="float64")

    return F.pandas_udf(ratios, "double")(a, b)


def unshared(n: int, least: float) -> int:
    """Bigrams of a name of n letters that a name alike may lack, at most: two for each
    letter taken out and one for each put in."""
    worst = 0
    for m in range(ceil(n * least / (2 - least) - 1e-9), floor(n * (2 - least) / least + 1e-9) + 1):
        matched = ceil(least * (n + m) / 2 - 1e-9)
        if matched <= min(n, m):
            worst = max(worst, 2 * (n - matched) + (m - matched))
    return worst


def _signs(names: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of names of n letters: classes of the letters, and 128 bits in two words, of which
    each letter sets one that tells its class and how many such stand before it."""
    classes = np.frombuffer("".join(names).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(-1, n) & 63
    words, seen = np.zeros((2, len(names)), dtype=np.uint64), np.zeros((len(names), 64), dtype=np.int64)
    every = np.arange(len(names))
    for letter in classes.T:
        bit = (letter + 37 * seen[every, letter]) & 127
        seen[every, letter] += 1
        for half in (0, 1):
            words[half] |= np.where(bit >> 6 == half, np.uint64(1) << (bit & 63).astype(np.uint64), np.uint64(0))
    return classes, words


def _places(classes: np.ndarray) -> np.ndarray:
    """For each name of at most 63 letters and each class a word of the places it has."""
    words = np.zeros((len(classes), 64), dtype=np.uint64)
    for i, letter in enumerate(classes.T):
        words[np.arange(len(classes)), letter] |= np.uint64(1 << i)
    return words


def _common(places: np.ndarray, of: np.ndarray, others: np.ndarray, n: int) -> np.ndarray:
    """Length of the longest common subsequence of names of n letters and others, bit by
    bit; letters of one class count as equal, so it is never too small."""
    rest = np.full(len(of), (1 << n) - 1, dtype=np.uint64)
    for letter in others.T:
        both = rest & places[of, letter]
        rest = (rest + both) | (rest - both)
    return n - np.bitwise_count(rest & np.uint64((1 << n) - 1)).astype(np.int64)


def _alike(n: int, left: list[str], m: int, right: list[str], least: float) -> tuple[np.ndarray, np.ndarray]:
    """Places in both lists, of names of n and of m letters, of all pairs whose letters and
    longest common subsequence allow a ratio of `least`."""
    matched = ceil((n + m) * least / 2 - 1e-9)
    (classes, (low, high)), (others, (low_b, high_b)) = _signs(left, n), _signs(right, m)
    step, found = max(1, CELLS // len(right)), [(np.zeros(0, dtype=np.int64),) * 2]
    for at in range(0, len(left), step):
        x, y = low[at : at + step, None], high[at : at + step, None]
        lacking = np.bitwise_count(x & ~low_b)
        lacking += np.bitwise_count(y & ~high_b)
        i, j = np.nonzero(lacking <= n - matched)
        lacking = np.bitwise_count(low_b[j] & ~low[at + i]) + np.bitwise_count(high_b[j] & ~high[at + i])
        i, j = i[lacking <= m - matched], j[lacking <= m - matched]
        if n < 64:
            places = _places(classes[at : at + step])
            for some in range(0, len(i), CELLS):
                near = _common(places, i[some : some + CELLS], others[j[some : some + CELLS]], n) >= matched
                found.append((at + i[some : some + CELLS][near], j[some : some + CELLS][near]))
        else:
            found.append((at + i, j))
    return tuple(np.concatenate(x) for x in zip(*found))


def similar_pairs(names: DataFrame, least: float = LEAST) -> DataFrame:
    """(name_a, name_b, similarity) of distinct names of `names` (name, ord) with a
    ratio of at least `least`; a is the one with the smaller ord.

    Names are put into chunks of one length; each two chunks whose lengths can be alike are
    a row, whose names are compared with each other."""
    spark = shipped(names.sparkSession)
    rows = written(names.select("name", "ord", F.length("name").alias("n")).filter("n > 0").withColumn("id", F.monotonically_increasing_id()), "names-rows")
    lengths = rows.groupBy("n").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    chunks = rows.join(F.broadcast(lengths), "n").groupBy("n", F.pmod(F.xxhash64("name"), "chunks").alias("chunk"))
    chunks = written(chunks.agg(F.collect_list(F.struct("id", "name")).alias("members")), "names-chunks")
    each = written(chunks.select("n", "chunk", F.size("members").alias("size")), "names-sizes")
    other = each.toDF("n_b", "chunk_b", "size_b")
    close = (F.col("n") < F.col("n_b")) | ((F.col("n") == F.col("n_b")) & (F.col("chunk") <= F.col("chunk_b")))
    meets = written(each.join(F.broadcast(other), close & (F.ceil((F.col("n") + F.col("n_b")) * (least / 2) - 1e-9) <= F.col("n"))), "names-meets")
    known = meets.agg(F.count("*").alias("n"), F.sum(F.col("size").cast("double") * F.col("size_b")).alias("work")).first()
    tasks = max(1, min(known["n"], MOST_TASKS, max(ceil((known["work"] or 0) / TASK), 4 * spark.sparkContext.defaultParallelism)))
    both = meets.select("n", "chunk", "n_b", "chunk_b").join(chunks, ["n", "chunk"]).join(chunks.toDF("n_b", "chunk_b", "members_b"), ["n_b", "chunk_b"])
    both = both.select("n", "members.id", "members.name", "n_b", F.col("members_b.id").alias("id_b"), F.col("members_b.name").alias("name_b")).repartition(tasks)

    def compared(batches):
        for batch in batches:
            for r in batch.itertuples():
                i, j = _alike(r.n, list(r.name), r.n_b, list(r.name_b), least)
                a, b = np.asarray(r.id)[i], np.asarray(r.id_b)[j]
                once = a < b if r.n == r.n_b and len(r.id) == len(r.id_b) and set(r.id) == set(r.id_b) else a != b
                yield pd.DataFrame({"id_a": a[once], "id_b": b[once]})

    found = both.mapInPandas(compared, "id_a long, id_b long")
    side = lambda s: rows.select(F.col("id").alias(f"id_{s}"), F.col("name").alias(f"name_{s}"), F.col("ord").alias(f"ord_{s}"))
    met = written(found, "names-met").join(side("a"), "id_a").join(side("b"), "id_b").filter("ord_a <> ord_b")
    ahead = F.col("ord_a") < F.col("ord_b")
    pairs = met.select(F.when(ahead, F.col("name_a")).otherwise(F.col("name_b")).alias("name_a"), F.when(ahead, F.col("name_b")).otherwise(F.col("name_a")).alias("name_b"))
    return pairs.withColumn("similarity", ratio_of(F.col("name_a"), F.col("name_b"), least)).filter(F.col("similarity") >= least)
