"""Near copies of documents by SimHash: five-word shingles, Jaccard similarity 0.8 or more.

A text is the set of its shingles; equal sets fall together first, and each distinct
set has a 64-bit SimHash.  Two sets of similarity 0.8 differ in about ten of its bits,
so all pairs within `RADIUS` bits are asked for, found by the Gray-order index of
`corpweave.llm.simhash`, and verified by the true similarity of their sets; groups are
the components of the verified pairs.

No block of bits is common to all pairs at so wide a radius, so what meets in one index
is dealt by content instead: sets that agree on one of 32 bands of six least hashes
(MinHash).  Sets of similarity 0.8 miss all bands with probability 6e-5, and the radius
with about as much; the same sets always meet alike.

In a first turn a member is verified against its `FIRST` nearest ones.  Bands in which
some member has more, and those split for their size, are gone through again where more
than one class is left: their members meet with their sets, those outside the largest
class with all, and what the index finds between classes is verified on the spot.  So
nothing is capped, pairs are never listed, and a group of copies costs a few
verifications a member.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpweave.llm.common import mapped
from corpweave.llm.simhash import _join, near_pairs
from corpweave.operators.components import connected_components
from corpweave.storage import written

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: differing bits: 9.7 on average at similarity 0.8, 12 for the shortest texts, and four deviations
RADIUS = 24
BANDS, ROWS = 32, 6
#: partners that a member is verified against in the first turn; the second has no limit
FIRST = 4
#: members of a band in one index; larger bands are split, and in the second turn compared by pairs of blocks
BLOCK = 2048
#: pairs verified at once, and shared shingles looked at at once
PAIRS, SHARED = 4096, 1 << 16
_AT_ONCE = 2048

_RNG = np.random.default_rng(42)
_MULTIPLY = _RNG.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
_ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _ODD[3]
    return h ^ (h >> np.uint64(29))


def shingles(text: str | None, seen: dict | None = None) -> np.ndarray:
    """Sorted hashes of a text's shingles.  Words are runs without ASCII white space, A-Z
    are lower-cased; fewer words than a shingle make one, no words make none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    seen = {} if seen is None else seen
    for w in words:
        if w not in seen:
            seen[w] = xxhash.xxh64_intdigest(w)
    h = np.array([seen[w] for w in words], dtype=np.uint64)
    k = min(SHINGLE_WORDS, len(h))
    m = len(h) - k + 1
    out = np.full(m, k, dtype=np.uint64)
    for i in range(k):
        out = _mixed(out * _ODD[4] + h[i : i + m] * _ODD[0])
    return np.unique(out)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets; 1 if both are empty."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def simhash_of(found: np.ndarray) -> int:
    """The 64-bit SimHash of a set of shingles; zero if it is empty."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(found), 1 << 16):
        part = _mixed(found[at : at + (1 << 16)] * _ODD[2])
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(found), bitorder="little").tobytes(), "little")


def minhashes(found: np.ndarray) -> np.ndarray:
    least = np.full(BANDS * ROWS, ~np.uint32(0))
    for at in range(0, len(found), _AT_ONCE):
        part = (found[at : at + _AT_ONCE] >> np.uint64(32)).astype(np.uint32)
        least = np.minimum(least, (_MULTIPLY[:, None] * part + _ADD[:, None]).min(axis=1))
    return least


def _words_seen(seen: dict) -> None:
    if len(seen) > 50_000:
        seen.clear()


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), _signed(np.concatenate([*rows, np.zeros(0, dtype=np.uint64)])))


def _set_id(found: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(found.tobytes(), 1)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict = {}
    for batch in batches:
        ids, bands, prints = [], [], []
        for text in batch["text"]:
            found = shingles(text.as_py(), seen)
            _words_seen(seen)
            ids.append(_set_id(found))
            keys = np.full(BANDS, 7, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)
            for part in minhashes(found).astype(np.uint64).reshape(BANDS, ROWS).T:
                keys = _mixed(keys * _ODD[4] + part * _ODD[1])
            bands.append(keys)
            prints.append(simhash_of(found))
        columns = [batch["doc_id"], batch["row_key"], *(_signed(np.array(x, dtype=np.uint64)) for x in (ids, prints)), _lists(bands)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row_key", "fp", "simhash", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict = {}
    for batch in batches:
        found = []
        for text in batch["text"]:
            found.append(shingles(text.as_py(), seen))
            _words_seen(seen)
        yield pa.RecordBatch.from_arrays([_signed(np.array([_set_id(f) for f in found], dtype=np.uint64)), _lists(found)], names=["fp", "shingles"])


def nearest(prints: np.ndarray, most: int, salt: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """Pairs (i, j) of a group's positions within the radius, of each member the `most`
    nearest, and whether some were left out."""
    left = right = far = np.zeros(0, dtype=np.int64)
    more = False
    for a, b, diff in near_pairs(np.zeros(len(prints), dtype=np.int64), prints, RADIUS):
        left, right, far = np.concatenate([left, a, b]), np.concatenate([right, b, a]), np.concatenate([far, diff, diff])
        chance = _mixed((left ^ right ^ salt).astype(np.uint64) * _ODD[0] + right.astype(np.uint64))
        order = np.lexsort((chance, far, left))
        left, right, far = left[order], right[order], far[order]
        opens = np.flatnonzero(np.concatenate([[True], left[1:] != left[:-1]])) if len(left) else left
        rank = np.arange(len(left)) - np.repeat(opens, np.diff(np.append(opens, len(left))))
        more = more or bool((rank >= most).any())
        near = rank < most
        left, right, far = left[near], right[near], far[near]
    return left, right, more


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row (band, members, split): pairs to verify, as (src, dst), and where there is
    more, the members, as (fp, simhash, band) in the same columns."""
    nothing = np.zeros(0, dtype=np.int64)
    for batch in batches:
        src, dst, again = [nothing], [nothing], [(nothing, nothing, nothing)]
        for band, members, split in zip(batch["band"].to_pylist(), batch["members"], batch["split"].to_pylist()):
            ids, prints = (members.values.field(c).to_numpy(zero_copy_only=False) for c in ("fp", "simhash"))
            a, b, more = nearest(prints.view(np.uint64), FIRST, band & 0xFFFF)
            src.append(np.minimum(ids[a], ids[b]))
            dst.append(np.maximum(ids[a], ids[b]))
            if more or split:
                again.append((ids, prints, np.full(len(ids), band)))
        pairs = np.unique(np.stack([np.concatenate(src), np.concatenate(dst)], axis=1), axis=0)
        fp, simhash, band = (np.concatenate(x) for x in zip(*again))
        cols = [np.concatenate([pairs[:, 0], fp]), np.concatenate([pairs[:, 1], simhash])]
        bands = pa.concat_arrays([pa.nulls(len(pairs), pa.int64()), pa.array(band, pa.int64())])
        yield pa.RecordBatch.from_arrays([*map(pa.array, cols), bands], names=["src", "dst", "band"])


def class_links(prints: np.ndarray, class_: np.ndarray, asking: np.ndarray, sets: list[np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray]:
    """Links between classes of a group, as classes: two are linked if members of them are
    within the radius and have a similarity of at least `least`; one of each pair of
    members is `asking`.  Links that others imply are left out."""
    names, of = np.unique(class_, return_inverse=True)
    parent = np.arange(len(names))
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, times = np.unique(np.concatenate([*sets, np.zeros(0, dtype=np.int64)]), return_inverse=True, return_counts=True)
    shared = times[column] > 1  # what only one member has is in no intersection
    owner = owner[shared]
    column = np.unique(column[shared], return_inverse=True)[1] if shared.any() else owner
    width = int(column.max(initial=-1)) + 1

    def rows(low: int) -> np.ndarray:
        own = (column >= low) & (column < low + SHARED)
        bits = np.zeros((len(sets), -(-min(SHARED, width - low) // 64) * 64), dtype=bool)
        bits[owner[own], column[own] - low] = True
        return np.packbits(bits, axis=1).view(np.uint64)

    whole = rows(0) if width <= SHARED else None  # longer ones are made again for each part
    for a, b, _ in near_pairs(np.zeros(len(prints), dtype=np.int64), prints, RADIUS):
        close = (asking[a] | asking[b]) & (np.minimum(sizes[a], sizes[b]) >= least * np.maximum(sizes[a], sizes[b]) - 1e-9)
        a, b = a[close], b[close]
        apart = parent[of[a]] != parent[of[b]]
        a, b = a[apart], b[apart]
        both = np.zeros(len(a), dtype=np.int64)
        for low in range(0, width, SHARED):
            if not len(a):
                break
            part = whole if whole is not None else rows(low)
            for at in range(0, len(a), PAIRS):
                both[at : at + PAIRS] += np.bitwise_count(part[a[at : at + PAIRS]] & part[b[at : at + PAIRS]]).sum(axis=1, dtype=np.int64)
        alike = both >= least * (sizes[a] + sizes[b] - both) - 1e-9
        _join(parent, of[a[alike]], of[b[alike]])
    moved = np.flatnonzero(parent != np.arange(len(names)))
    return names[moved], names[parent[moved]]


def _between(least: float):
    """Links of `class_links`, of rows (members)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(np.zeros(0, dtype=np.int64),) * 2]
            for members in batch["members"]:
                flat = members.values
                prints, class_, asking = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("simhash", "class", "asking"))
                sets = [x.values.to_numpy() for x in flat.field("shingles")]
                found.append(class_links(prints.view(np.uint64), class_, asking, sets, least))
            src, dst = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(src), pa.array(dst)], names=["src", "dst"])

    return emit


def _sets_of(docs: DataFrame, distinct: DataFrame, wanted: DataFrame) -> DataFrame:
    """(fp, shingles) of the set ids in `wanted` (fp)."""
    keys = wanted.join(distinct, "fp").select("row_key")
    texts = docs.select(row_key().alias("row_key"), "text").join(keys, "row_key", "left_semi").dropDuplicates(["row_key"])
    return written(mapped(texts.select("text"), _sets, "fp long, shingles array<long>"), "near-shingles")


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The `pairs` (src, dst) of set ids whose sets have a similarity of at least `least`."""
    sides = pairs.join(sets.select(F.col("fp").alias("src"), F.col("shingles").alias("a")), "src").join(sets.select(F.col("fp").alias("dst"), F.col("shingles").alias("b")), "dst")
    both = F.size(F.array_intersect("a", "b"))
    return sides.filter(both >= least * (F.size("a") + F.size("b") - both) - 1e-9).select("src", "dst")


def _first_groups(members: DataFrame, block: int) -> DataFrame:
    """(band, members, split) of bands with more than one member, a row a block."""
    sizes = members.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    dealt = members.join(sizes, "band").withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    dealt = dealt.withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("blocks")))
    return dealt.groupBy("band", "mine").agg(F.collect_list(F.struct("fp", "simhash")).alias("members"), (F.first("blocks") > 1).alias("split"))


def _later_groups(members: DataFrame, sets: DataFrame, block: int) -> DataFrame:
    """(members) of bands (band, fp, simhash, class) with more than one class.  Members
    outside the largest class ask; a band of more than `block` members is dealt so that
    each block that asks meets each block of all."""
    sizes = members.groupBy("band", "class").agg(F.count("*").alias("n")).groupBy("band").agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.max_by("class", F.struct("n", "class")).alias("main")).filter("n > most")
    dealt = members.join(sizes, "band").withColumn("asking", F.col("class") != F.col("main"))
    of = lambda n: F.ceil(n / block).cast("int")
    hash_ = F.xxhash64("fp", F.lit(1))
    place = lambda i, j, asking: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), asking.alias("asking"))
    asks, all_ = of(F.col("n") - F.col("most")), of(F.col("n"))
    left = F.when(F.col("asking"), F.transform(F.sequence(F.lit(0), all_ - 1), lambda j: place(F.pmod(hash_, asks), j, F.lit(True)))).otherwise(F.array().cast("array<struct<i:int,j:int,asking:boolean>>"))
    right = F.transform(F.sequence(F.lit(0), asks - 1), lambda i: place(i, F.pmod(hash_, all_), F.lit(False)))
    one = F.array(place(F.lit(0), F.lit(0), F.col("asking")))
    dealt = dealt.select("band", "fp", "simhash", "class", F.explode(F.when(F.col("n") <= block, one).otherwise(F.concat(left, right))).alias("at"))
    member = F.struct("simhash", "class", "at.asking", "shingles")
    return dealt.join(sets, "fp").groupBy("band", "at.i", "at.j").agg(F.collect_list(member).alias("members")).select("members")


def classes_of(docs: DataFrame, prints: DataFrame, least: float, block: int = BLOCK) -> DataFrame:
    """(node, component) of set ids that have links."""
    distinct = prints.groupBy("fp").agg(F.min_by(F.struct("row_key", "simhash", "bands"), "row_key").alias("one"))
    distinct = written(distinct.select("fp", "one.*"), "near-sets")
    members = distinct.select("fp", "simhash", F.explode("bands").alias("band"))
    found = written(mapped(_first_groups(members, block), _candidates, "src long, dst long, band long"), "near-candidates")
    pairs = written(found.filter("band is null").select("src", "dst").distinct(), "near-pairs")
    sets = _sets_of(docs, distinct, pairs.select(F.col("src").alias("fp")).union(pairs.select("dst")).distinct())
    links = written(_verified(pairs, sets, least), "near-links")
    linked = written(connected_components(links), "near-classes")
    more = found.filter("band is not null").select(F.col("src").alias("fp"), F.col("dst").alias("simhash"), "band").distinct()
    if more.isEmpty():
        return linked
    more = more.join(linked, more["fp"] == linked["node"], "left").select("band", "fp", "simhash", F.coalesce("component", "fp").alias("class"))
    more = written(more, "near-open")
    groups = _later_groups(more, _sets_of(docs, distinct, more.select("fp").distinct()), block)
    between = written(mapped(groups, _between(least), "src long, dst long", rows=16).distinct(), "near-between")
    return written(connected_components(links.union(between)), "near-classes")


def row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def near_copies(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(doc_id, row_key, class) of every row of `docs`: rows of one class are near copies.
    Texts without words are equal; rows are told apart by their doc_id and text, and by
    nothing else."""
    rows = docs.select(F.col("doc_id").cast("long"), "text", row_key().alias("row_key"))
    prints = written(mapped(rows, _signatures, "doc_id long, row_key long, fp long, simhash long, bands array<long>"), "near-prints")
    linked = classes_of(docs, prints, least)
    placed = prints.join(linked, prints["fp"] == linked["node"], "left")
    return placed.select("doc_id", "row_key", F.coalesce("component", "fp").alias("class"))


def without_near_copies(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row of `docs` for each class of near copies, with all its columns: that of the
    least doc_id (nulls last), of rows that share it the one with the least hash of text;
    of rows equal in both, that with the least hash of all columns."""
    rows = written(near_copies(docs, least), "near-rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("first")
    keep = written(rows.groupBy("class").agg(first).select(F.col("first.doc_id").alias("_keep_id"), F.col("first.row_key").alias("_keep_key")), "near-kept")
    kept = docs.join(keep, (row_key() == F.col("_keep_key")) & docs["doc_id"].eqNullSafe(F.col("_keep_id")), "left_semi")
    repeated = rows.groupBy("row_key").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("row_key").alias("_key"))
    if repeated.isEmpty():
        return kept
    keyed = kept.withColumn("_key", row_key())
    single = keyed.join(repeated, "_key", "left_anti")
    several = keyed.join(repeated, "_key", "left_semi")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    several = several.groupBy("_key", "doc_id").agg(F.min_by(whole, F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])).alias("_row")).select("_row.*")
    return single.select(*docs.columns).unionByName(several.select(*docs.columns))
