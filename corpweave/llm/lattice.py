"""Near-duplicate embeddings by lattice hashing over E8.

Unit vectors are projected to two random 8-dimensional spaces per table, and each
projection is decoded to the nearest point of the E8 lattice; the pair of points
is the vector's cell.  A vector also probes the cells next to it, those whose
points are the nearest but one and two.  Vectors that meet in a cell are compared
by cosine in double precision; a pair that meets more than once counts where it
meets first.  Equal vectors are one class from the start, so copies never meet.

Cells are first counted without the vectors, and vectors are sent only where two
meet; a cell of more than `BLOCK` members is split into pairs of blocks, which
bounds every task.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpweave.llm.common import mapped
from corpweave.llm.simhash import _join
from corpweave.operators.components import connected_components
from corpweave.storage import written

THRESHOLD = 0.98
TABLES = 3
#: neighbours of a point that are probed, in each of the two spaces
PROBES = 2
#: lattice units per unit of length for vectors of 64 dimensions; grows with their root
SCALE = 4.0
SEED = 8
#: members of a cell that one task compares at once
BLOCK = 2048


def _minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = [0.0] * 8
            v[i], v[j] = a, b
            out.append(v)
    out += [list(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


MINIMAL = _minimal_vectors()


def _even(x: np.ndarray) -> np.ndarray:
    """Nearest whole points with an even sum."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(axis=1) % 2)
    off = x[odd] - near[odd]
    worst = np.abs(off).argmax(axis=1)
    near[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
    return near


def decode(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points: whole or half-whole ones, whichever is closer."""
    a, b = _even(x), _even(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1))[:, None], a, b)


def _code(points: np.ndarray, salt: int) -> np.ndarray:
    h = np.full(len(points), (salt + 1) * 0x9E3779B97F4A7C15 % (1 << 64), dtype=np.uint64)
    for column in (2 * points).astype(np.int64).view(np.uint64).T:
        h = (h ^ column) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
    return h.view(np.int64)


def _spaces(dim: int, table: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([SEED, dim, table])
    basis = rng.normal(size=(dim, 16))
    basis = np.linalg.qr(basis)[0] if dim >= 16 else basis / np.sqrt(dim)
    return basis * SCALE * np.sqrt(max(dim, 16) / 64), rng.normal(size=16)


def cells(units: np.ndarray, tables: int = TABLES, probes: int = PROBES) -> np.ndarray:
    """n x tables x (1 + probes)^2 codes; the first of a table is the own cell."""
    n, dim = units.shape
    out = np.zeros((n, tables, (1 + probes) ** 2), dtype=np.int64)
    for t in range(tables):
        basis, shift = _spaces(dim, t)
        at = units @ basis + shift
        halves = []
        for half in (at[:, :8], at[:, 8:]):
            point = decode(half)
            pull = (half - point) @ MINIMAL.T
            next_to = np.argsort(-pull, axis=1, kind="stable")[:, :probes]
            halves.append([point, *(point + MINIMAL[next_to[:, k]] for k in range(probes))])
        for k, (a, b) in enumerate(itertools.product(*halves)):
            out[:, t, k] = _code(np.hstack([a, b]), t)
    return out


def _cell_rows(tables: int, probes: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["embedding"]
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            opens = np.cumsum(sizes) - sizes
            codes = np.zeros((len(batch), tables * (1 + probes) ** 2), dtype=np.int64)
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                x = flat[opens[at][:, None] + np.arange(dim)]
                x = x / np.abs(x).max(axis=1, keepdims=True)  # so that no square overflows
                codes[at] = cells(x / np.linalg.norm(x, axis=1, keepdims=True), tables, probes).reshape(len(at), -1)
            width = codes.shape[1]
            packed = pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1, dtype=np.int32) * width), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, packed], names=[*batch.schema.names, "codes"])

    return emit


def _cell_links(threshold: float, tables: int, probes: int):
    each = (1 + probes) ** 2

    def compare(ids, copies, sides, x, codes, here, table):
        """(links per member, edges) of one group; `sides` is 0 or 1 where two blocks
        are compared with each other, and -1 where one is with itself."""
        n = len(ids)
        links, edges = np.zeros(n, dtype=np.int64), []
        parent = np.arange(n)
        own = codes[:, table, 0] == here
        for lo in range(0, n, 256):
            rows = np.arange(lo, min(lo + 256, n))
            i, j = np.nonzero(x[rows] @ x.T >= threshold)
            i = rows[i]
            keep = (i < j) & (own[i] | own[j])
            if sides[0] >= 0:
                keep &= sides[i] != sides[j]
            i, j = i[keep], j[keep]
            first = np.ones(len(i), dtype=bool)
            for t in range(table):  # met in an earlier table
                a, b = codes[i, t], codes[j, t]
                first &= ~((a[:, :1] == b).any(axis=1) | (b[:, :1] == a).any(axis=1))
            a, b = codes[i, table], codes[j, table]
            ab, ba = (a[:, :1] == b).any(axis=1), (b[:, :1] == a).any(axis=1)  # in the cell of i, of j
            first &= np.where(ab & ba, np.minimum(a[:, 0], b[:, 0]) == here, True)
            i, j = i[first], j[first]
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            _join(parent, i, j)
        moved = np.flatnonzero(parent != np.arange(n))
        return links, (ids[moved], ids[parent[moved]])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], []]
            members = batch["members"]
            opens = members.offsets.to_numpy()
            flat = members.values
            ids = flat.field("class_id").to_numpy()
            copies = flat.field("copies").to_numpy()
            sides = flat.field("side").to_numpy()
            vectors, codes = flat.field("embedding"), flat.field("codes").values.to_numpy().reshape(-1, tables, each)
            vopens = vectors.offsets.to_numpy()
            values = vectors.values.to_numpy(zero_copy_only=False)
            for g, (here, table) in enumerate(zip(batch["code"].to_pylist(), batch["tab"].to_pylist())):
                a, b = opens[g], opens[g + 1]
                x = values[vopens[a] : vopens[b]].astype(np.float64).reshape(b - a, -1)
                x = x / np.abs(x).max(axis=1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                links, (src, dst) = compare(ids[a:b], copies[a:b], sides[a:b], x, codes[a:b], here, table)
                some = links > 0
                out[0] += [ids[a:b][some], src]
                out[1] += [np.full(some.sum(), -1), dst]
                out[2] += [links[some], np.zeros(len(src), dtype=np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in out], names=["class_id", "other", "links"])

    return emit


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, tables: int = TABLES, probes: int = PROBES, block: int = BLOCK) -> DataFrame:
    """Per row of `vectors` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Vectors are compared if their labels and lengths are equal.  A null label or
    vec_id, or a vector that is null, empty, zero or holds null or non-finite
    numbers links with nothing and is its own component.  Repeated rows are vectors
    of their own: they link with each other."""
    wide = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    numbers = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("embedding", lambda v: v != 0)
    wide = wide.withColumn("usable", F.coalesce(numbers & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.lit(False)))
    good = wide.filter("usable").withColumn("vkey", F.xxhash64("embedding"))
    classes = good.groupBy("vkey", "label", "embedding").agg(F.min("vec_id").alias("class_id"), F.count("*").alias("copies"))
    each = (1 + probes) ** 2
    schema = "label string, class_id long, copies long, embedding array<double>, codes array<long>"
    coded = mapped(classes.select(F.col("label").cast("string").alias("label"), "class_id", "copies", "embedding"), _cell_rows(tables, probes), schema)
    coded = written(coded, "lattice-classes")
    place = F.struct("label", F.size("embedding").alias("dim"))
    met = coded.select(place.alias("place"), "class_id", F.posexplode("codes").alias("pos", "code"))
    met = met.select("place", "class_id", "code", (F.col("pos") / each).cast("int").alias("tab"), (F.col("pos") % each == 0).alias("own"))
    where = ["place", "tab", "code"]
    met = met.groupBy(*where, "class_id").agg(F.max("own").alias("own"))
    counts = met.groupBy(*where).agg(F.count("*").alias("n"), F.max("own").alias("any_own")).filter("n > 1 and any_own").drop("any_own")
    sent = met.join(counts, where).withColumn("blocks", F.ceil(F.col("n") / block).cast("int")).drop("n", "own")
    mine = F.pmod(F.xxhash64("class_id", F.lit(SEED)), F.col("blocks")).cast("int")
    sent = sent.withColumn("mine", mine).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = F.when(F.col("mine") == F.col("with"), F.lit(-1)).otherwise((F.col("mine") > F.col("with")).cast("int"))
    sent = sent.select(*where, "class_id", F.least("mine", "with").alias("lo"), F.greatest("mine", "with").alias("hi"), F.when(F.col("blocks") == 1, -1).otherwise(side).alias("side"))
    full = sent.join(coded.select("class_id", "copies", "embedding", "codes"), "class_id")
    groups = full.groupBy(*where, "lo", "hi").agg(F.collect_list(F.struct("class_id", "copies", "side", "embedding", "codes")).alias("members"))
    found = mapped(groups.select("code", "tab", "members"), _cell_links(threshold, tables, probes), "class_id long, other long, links long", rows=64)
    found = written(found, "lattice-links")
    links = found.filter("other = -1").groupBy("class_id").agg(F.sum("links").alias("links"))
    linked = connected_components(found.filter("other <> -1"), "class_id", "other").withColumnRenamed("node", "class_id")
    per_class = classes.join(links, "class_id", "left").join(linked, "class_id", "left")
    per_class = per_class.select("vkey", "label", "embedding", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "class_id").alias("component_id"))
    done = good.join(per_class, ["vkey", "label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = wide.filter("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return done.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op3_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings: vec_id, n_links, component_id, kept.
    See `near_vectors`; an empty table gives no rows, further columns are ignored."""
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
