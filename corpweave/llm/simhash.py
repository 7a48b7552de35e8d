"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprints within two differing bits agree on one of three bit blocks, so the
distinct fingerprints are dealt by (block, value).  Inside a group they are put
in order of their Gray rank, and a tree is built over the order: a node keeps the
bits on which all below it agree, its children only the rest.  The self-search
walks pairs of nodes from the roots, adding up the differences of the bits that
each level fixes, and drops a pair, with all below it, as soon as the sum exceeds
the threshold.  Trees of all groups in a batch are walked together in numpy.

A group of more than `GROUP_CAP` fingerprints is dealt again by the same rule: its
members agree on one of three parts of the bits that are still free.  Each level
leaves two thirds of these, so the last groups are small by necessity; every pair
within the threshold meets in some group, and every group is searched by the index.

`corpweave.llm.neardup` searches with the same index at a wider radius.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpweave.llm.common import mapped
from corpweave.operators.components import connected_components
from corpweave.storage import written

SEED = 42
SHINGLE_WORDS = 3
THRESHOLD = 2
#: low bit and width of the blocks; one more than the threshold
BLOCKS = ((0, 21), (21, 21), (42, 22))
#: members of a node of the tree
FAN_OUT = 8
#: distinct fingerprints that share a block value before the group is dealt again
GROUP_CAP = 2048
#: node pairs examined at once
FRONTIER = 1 << 20
_SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of a text: words are runs without ASCII white space, A-Z are
    lower-cased, shingles keep repeats; fewer words than a shingle make one."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    k = min(words_per_shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - k + 1]
    ends = ends[k - 1 :]
    ones, digest = np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), _SHINGLES_AT_ONCE):
        spans = zip(starts[at : at + _SHINGLES_AT_ONCE].tolist(), ends[at : at + _SHINGLES_AT_ONCE].tolist())
        h = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row; fp holds the 64 bits in a signed long."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py()) for t in batch["text"]], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(prints.view(np.int64))], names=["doc_id", "fp"])

    return mapped(docs.select("doc_id", "text"), emit, "doc_id long, fp long")


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Place of each value in the reflected Gray order."""
    rank = fp.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    return rank


def _levels(group: np.ndarray, fp: np.ndarray) -> list[dict]:
    """Nodes level by level, from the fingerprints up to one root a group; nodes of
    a level stand in order, `first` and `count` tell a node's children."""
    levels = [{"group": group, "mask": np.full(len(fp), ~np.uint64(0)), "bits": fp, "first": None, "count": None}]
    while True:
        below = levels[-1]
        g = below["group"]
        opens = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        sizes = np.diff(np.append(opens, len(g)))
        if sizes.max() == 1:
            return levels
        place = np.arange(len(g)) - np.repeat(opens, sizes)
        first = np.flatnonzero(place % FAN_OUT == 0)
        count = np.diff(np.append(first, len(g)))
        lead = np.repeat(below["bits"][first], count)
        mask = np.bitwise_and.reduceat(below["mask"] & ~(below["bits"] ^ lead), first)
        levels.append({"group": g[first], "mask": mask, "bits": below["bits"][first] & mask, "first": first, "count": count})


def near_pairs(group: np.ndarray, fp: np.ndarray, threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """All pairs of a group within the threshold, as positions (a, b) and differences, in
    parts.  `group` must be in order; values need not be distinct."""
    order = np.lexsort((gray_rank(fp), group))
    levels = _levels(group[order], fp[order])
    top = len(levels) - 1
    roots = np.arange(len(levels[top]["bits"]))
    frontier = [(top, roots, roots, np.zeros(len(roots), dtype=np.int64))]
    while frontier:
        at, a, b, so_far = frontier.pop()
        if len(a) > FRONTIER and at:
            half = len(a) // 2
            frontier += [(at, a[:half], b[:half], so_far[:half]), (at, a[half:], b[half:], so_far[half:])]
            continue
        if at == 0:
            yield order[a], order[b], so_far
            continue
        node, child = levels[at], levels[at - 1]
        ca, cb = node["count"][a], node["count"][b]
        each = ca * cb
        pair = np.repeat(np.arange(len(a)), each)
        k = np.arange(len(pair)) - np.repeat(np.cumsum(each) - each, each)
        i, j = node["first"][a][pair] + k // cb[pair], node["first"][b][pair] + k % cb[pair]
        keep = (i <= j) if at > 1 else (i < j)  # of a node with itself, each pair once
        pair, i, j = pair[keep], i[keep], j[keep]
        told = (node["mask"][a] & node["mask"][b])[pair]  # bits counted above
        fresh = child["mask"][i] & child["mask"][j] & ~told
        diff = so_far[pair] + np.bitwise_count((child["bits"][i] ^ child["bits"][j]) & fresh)
        near = diff <= threshold
        frontier.append((at - 1, i[near], j[near], diff[near]))


def hamming_links(group: np.ndarray, fp: np.ndarray, threshold: int = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Links, as positions, that connect the same members as all pairs of a group
    within the threshold do.  `group` must be in order."""
    parent = np.arange(len(group))
    for a, b, _ in near_pairs(group, fp, threshold):
        _join(parent, a, b)
    linked = np.flatnonzero(parent != np.arange(len(group)))
    return linked, parent[linked]


def _join(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merges the sets of a and b; afterwards `parent` points at the least member."""
    while len(a):
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        if not len(a):
            break
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent[:] = up


def _group_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch["fps"]
        fp = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        group = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
        a, b = hamming_links(group, fp)
        yield pa.RecordBatch.from_arrays([pa.array(fp[a].view(np.int64)), pa.array(fp[b].view(np.int64))], names=["src", "dst"])


def _thirds(mask: int) -> list[int]:
    """`mask` with each third of the bits that it leaves free, in order."""
    free = [i for i in range(64) if not mask >> i & 1]
    cut = [len(free) * k // 3 for k in range(4)]
    return [mask | sum(1 << i for i in free[a:b]) for a, b in zip(cut, cut[1:])]


def _as_long(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")


def link_fingerprints(distinct: DataFrame, cap: int = GROUP_CAP) -> DataFrame:
    """(src, dst) of distinct fingerprints `fp`: edges whose components are those of
    all pairs within the threshold."""
    masks = [((1 << width) - 1) << low for low, width in BLOCKS]
    dealt = distinct.select("fp", F.explode(F.array(*map(_as_long, masks))).alias("mask"))
    links = None
    while True:
        keyed = dealt.withColumn("bits", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = keyed.groupBy("mask", "bits").agg(F.count("*").alias("n")).filter("n > 1")
        shared = keyed.join(sizes, ["mask", "bits"])
        last = 64 - masks[0].bit_count() <= 2  # three bits or fewer are free: no group is large
        groups = shared.filter(F.lit(last) | (F.col("n") <= cap)).groupBy("mask", "bits").agg(F.collect_list("fp").alias("fps"))
        found = mapped(groups.select("fps"), _group_links, "src long, dst long")
        links = found if links is None else links.union(found)
        crowded = sizes.filter(F.col("n") > cap)
        if last or crowded.isEmpty():
            return links
        parts = {m: _thirds(m) for m in masks}
        under = F.create_map(*[x for m, own in parts.items() for x in (_as_long(m), F.array(*map(_as_long, own)))])
        dealt = written(shared.filter(F.col("n") > cap).select("fp", F.explode(F.element_at(under, F.col("mask"))).alias("mask")), "simhash-crowded")
        masks = [x for own in parts.values() for x in own]


def components_of(prints: DataFrame, cap: int = GROUP_CAP) -> DataFrame:
    """(fp, component_id): of each distinct fingerprint the least doc_id that links reach."""
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first_doc"))
    linked = connected_components(link_fingerprints(distinct, cap))
    placed = distinct.join(linked, distinct["fp"] == linked["node"], "left").select("fp", "first_doc", F.coalesce("component", "fp").alias("class"))
    least = placed.groupBy("class").agg(F.min("first_doc").alias("component_id"))
    return placed.join(least, "class").select("fp", "component_id")


def near_duplicates(docs: DataFrame, cap: int = GROUP_CAP) -> DataFrame:
    """(doc_id, fp, component_id) of every row of `docs`."""
    prints = written(fingerprints(docs), "simhash")
    return prints.join(components_of(prints, cap), "fp").select("doc_id", "fp", "component_id")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash groups of all documents: doc_id, fingerprint (16 hex digits), component_id.

    Null, empty and blank texts have fingerprint zero and link like any other.  A
    null doc_id is ignored in the least of a group (a group of such rows alone has
    a null one).  Rows that share a doc_id are separate rows of one document;
    repeated rows give repeated results, an empty table none; further columns are
    ignored.  Texts of any length are shingled whole."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
