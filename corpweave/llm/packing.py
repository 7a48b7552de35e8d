"""Best-fit packing of token sequences with a grouping genetic algorithm.

Pieces of one length are interchangeable, so the search works on the numbers of
pieces per length, at most `capacity` of them, at any corpus size.  A solution is
a list of bin patterns with multiplicities.  Islands evolve populations on the
executors: crossover injects whole well-filled bins of one parent into the other,
takes out the bins that now hold a piece twice, exchanges pieces where that fills a
bin better, and places the displaced pieces by best fit; mutation empties the
worst-filled bins.  After each round an island passes its elite to the next one.
The best solution gives closed-form places: the k-th piece of a length goes to a bin
and offset found by halving.  Ids are written once and read once more for their
places; they are never shuffled.
"""

from __future__ import annotations

import pickle
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpweave.llm.common import mapped
from corpweave.llm.tokenize import encoder, together
from corpweave.storage import written

CAPACITY = 1024
END_ID = 2
ISLANDS, ROUNDS, GENERATIONS, POPULATION = 4, 3, 200, 6
#: chance that a whole well-filled bin of the other parent is injected
INJECT = 0.4
#: share of the bins, worst-filled first, that a mutation empties
EMPTY = 0.1
#: steps that one island takes in a round, about: patterns handled
STEPS = 1_500_000
#: tasks up to which the table of bases, a row of at most `capacity` numbers a task, is broadcast; beyond, it is joined
BROADCAST_PARTS = 2_000

#: a pattern is a sorted tuple of lengths; a solution maps patterns to numbers of bins
Solution = dict[tuple[int, ...], int]


def fill_best(solution: Solution, wanted: dict[int, int], capacity: int = CAPACITY) -> Solution:
    """Places `wanted` (length -> pieces), longest first, each into the fullest bin
    that has room, and opens bins where none has; many equal steps are one."""
    by_room: dict[int, Solution] = {}
    for pattern, n in solution.items():
        by_room.setdefault(capacity - sum(pattern), {})[pattern] = n
    rooms = sorted(by_room)

    def put(pattern, n):
        room = capacity - sum(pattern)
        if room not in by_room:
            by_room[room] = {}
            insort(rooms, room)
        by_room[room][pattern] = by_room[room].get(pattern, 0) + n

    for length in sorted(wanted, reverse=True):
        left = wanted[length]
        while left:
            i = bisect_left(rooms, length)
            if i == len(rooms):
                fit = capacity // length
                if left >= fit:
                    put((length,) * fit, left // fit)
                if left % fit:
                    put((length,) * (left % fit), 1)
                break
            room = rooms[i]
            pattern, n = by_room[room].popitem()
            if not by_room[room]:
                del by_room[room], rooms[i]
            # equal pieces go on filling the same bin while they fit
            k = room // length
            bins = min(n, left // k)
            if bins:
                put(tuple(sorted(pattern + (length,) * k)), bins)
                left -= bins * k
            if bins < n:
                if left and left < k:
                    put(tuple(sorted(pattern + (length,) * left)), 1)
                    left, bins = 0, bins + 1
                if n > bins:
                    put(pattern, n - bins)
    out: Solution = {}
    for group in by_room.values():
        out.update(group)
    return out


def _held(pattern: tuple[int, ...]) -> dict[int, int]:
    out: dict[int, int] = {}
    for length in pattern:
        out[length] = out.get(length, 0) + 1
    return out


def _keep(pattern, n, rest: dict[int, int], into: Solution) -> None:
    """As many of the n bins as `rest` still wants all pieces of."""
    held = _held(pattern)
    n = min(n, *(rest.get(length, 0) // k for length, k in held.items()))
    if n > 0:
        into[pattern] = into.get(pattern, 0) + n
        for length, k in held.items():
            rest[length] -= n * k


def _exchanged(solution: Solution, displaced: dict[int, int], rng: np.random.Generator, capacity: int) -> tuple[Solution, dict[int, int]]:
    """Bins that are not full give one or two pieces for one or two displaced ones that
    fill them better (the dominance step of grouping algorithms); what they give is
    displaced in turn and is smaller, so best fit has an easier rest."""
    out: Solution = {}
    free = {k: n for k, n in displaced.items() if n}
    sizes = sorted(free)
    work = [(p, n) for p, n in solution.items()]
    rng.shuffle(work)
    for pattern, n in work:
        slack = capacity - sum(pattern)
        while slack and n and sizes:
            swap = _swap(pattern, slack, sizes, free)
            if swap is None:
                break
            gone, come = swap
            times = min(n, *(free[c] // come.count(c) for c in set(come)))
            if not times:
                break
            n -= times
            rest = list(pattern)
            for x in gone:
                rest.remove(x)
                if not free.get(x):
                    free[x] = 0
                    insort(sizes, x)
                free[x] += times
            for x in come:
                free[x] -= times
                if not free[x]:
                    del free[x]
                    sizes.remove(x)
            fuller = tuple(sorted(rest + list(come)))
            out[fuller] = out.get(fuller, 0) + times
        if n:
            out[pattern] = out.get(pattern, 0) + n
    return out, free


def _swap(pattern, slack: int, sizes: list[int], free: dict[int, int]):
    """(pieces out, pieces in) with the greatest gain of one bin, or None."""
    best, gain = None, 0
    held = sorted(set(pattern))
    outs = [(x,) for x in held] + [(x, y) for i, x in enumerate(held) for y in held[i:] if x != y or pattern.count(x) > 1][:60]
    for gone in outs:
        room = sum(gone) + slack
        i = bisect_right(sizes, room) - 1
        if i >= 0 and sizes[i] - sum(gone) > gain:
            best, gain = (gone, (sizes[i],)), sizes[i] - sum(gone)
        if gain == slack:
            break
        if len(gone) == 2:
            for c in sizes[max(0, bisect_right(sizes, room // 2) - 4) : bisect_right(sizes, room // 2)]:
                i = bisect_right(sizes, room - c) - 1
                d = sizes[i]
                if (d != c or free[c] > 1) and c + d - sum(gone) > gain:
                    best, gain = (gone, (c, d)), c + d - sum(gone)
    return best


def _filled_up(child: Solution, rest: dict[int, int], rng: np.random.Generator, capacity: int) -> Solution:
    child, free = _exchanged(child, rest, rng, capacity)
    return fill_best(child, free, capacity)


def cross(a: Solution, b: Solution, wanted: dict[int, int], rng: np.random.Generator, capacity: int = CAPACITY) -> Solution:
    rest, child = dict(wanted), {}
    full = sorted(b, key=lambda p: (-sum(p), rng.random()))
    for pattern in full[: max(1, len(full) * 2 // 3)]:
        if rng.random() < INJECT:
            _keep(pattern, max(1, int(b[pattern] * rng.random() + 0.5)), rest, child)
    for pattern in sorted(a, key=lambda p: -sum(p)):
        _keep(pattern, a[pattern], rest, child)
    return _filled_up(child, rest, rng, capacity)


def mutate(a: Solution, wanted: dict[int, int], rng: np.random.Generator, capacity: int = CAPACITY) -> Solution:
    """Empties the worst-filled bins and some others."""
    rest, child = dict(wanted), {}
    stay = sum(a.values()) * (1 - EMPTY * rng.random())
    for pattern in sorted(a, key=lambda p: (-sum(p), rng.random())):
        n = min(a[pattern], int(stay))
        stay -= n
        if n and rng.random() > EMPTY:
            _keep(pattern, n, rest, child)
    return _filled_up(child, rest, rng, capacity)


def matched_start(wanted: dict[int, int], rng: np.random.Generator, capacity: int = CAPACITY) -> Solution:
    """A start of another kind: bins begun with a long piece and closed by the pair or the
    single piece that fills them best, in an order drawn at random; the rest by best fit."""
    rest, out = dict(wanted), {}
    order = sorted(wanted, key=lambda x: -x * (0.7 + 0.6 * rng.random()))
    for a in order:
        sizes = sorted(k for k, n in rest.items() if n)
        if not rest.get(a):
            continue
        room, best = capacity - a, ()
        for c in sizes[bisect_right(sizes, room // 3) : bisect_right(sizes, room // 2)] or sizes[:1]:
            i = bisect_right(sizes, room - c) - 1
            if i >= 0 and sum(best) < c + sizes[i] <= room:
                best = (c, sizes[i])
        i = bisect_right(sizes, room) - 1
        if i >= 0 and sizes[i] > sum(best):
            best = (sizes[i],)
        _keep(tuple(sorted((a, *best))), rest[a], rest, out)
    return fill_best(out, {k: n for k, n in rest.items() if n}, capacity)


def fitness(solution: Solution, capacity: int = CAPACITY) -> tuple[int, float]:
    """Fewer bins are better; then, unequal fill is (Falkenauer's measure)."""
    return sum(solution.values()), -sum(n * (sum(p) / capacity) ** 2 for p, n in solution.items())


def least_bins(wanted: dict[int, int], capacity: int = CAPACITY) -> int:
    """Martello and Toth's second lower bound."""
    sizes = sorted(wanted)
    best = 0
    for k in {0, *(s for s in sizes if s <= capacity // 2)}:
        big = sum(wanted[s] for s in sizes if s > capacity - k)
        mid = sum(wanted[s] for s in sizes if capacity // 2 < s <= capacity - k)
        room = mid * capacity - sum(s * wanted[s] for s in sizes if capacity // 2 < s <= capacity - k)
        low = sum(s * wanted[s] for s in sizes if k <= s <= capacity // 2)
        best = max(best, big + mid + max(0, -(-(low - room) // capacity)))
    return best


def evolve(wanted: dict[int, int], elites: list[Solution], seed: int, capacity: int = CAPACITY) -> Solution:
    """One island: steady-state, the worst of the population making room; it ends at the
    lower bound or after about `STEPS` patterns."""
    rng = np.random.default_rng(seed)
    pool = [fill_best({}, wanted, capacity), *elites]
    while len(pool) < POPULATION:
        pool.append(matched_start(wanted, rng, capacity))
    floor, spent = least_bins(wanted, capacity), 0
    for _ in range(GENERATIONS):
        pool.sort(key=lambda s: fitness(s, capacity))
        if sum(pool[0].values()) <= floor or spent > STEPS:
            break
        i, j = sorted(rng.choice(len(pool), 2, replace=False).tolist())
        young = [cross(pool[i], pool[j], wanted, rng, capacity), cross(pool[j], pool[i], wanted, rng, capacity)]
        young.append(mutate(young[0], wanted, rng, capacity))
        spent += sum(len(s) for s in young) * 20
        known = {fitness(s, capacity) for s in pool}
        for s in young:  # of equal ones the older stays, so that the population keeps apart
            if fitness(s, capacity) not in known:
                known.add(fitness(s, capacity))
                pool.append(s)
        pool = sorted(pool, key=lambda s: fitness(s, capacity))[:POPULATION]
    return min(pool, key=lambda s: fitness(s, capacity))


def search(spark: SparkSession, wanted: dict[int, int], capacity: int = CAPACITY, islands: int = ISLANDS, rounds: int = ROUNDS, seed: int = 0) -> Solution:
    """Islands on the executors, with the elites handed round the ring after each
    round.  What travels is patterns, whose number is bounded by that of lengths."""
    if not wanted:
        return {}
    elites: list[list[Solution]] = [[] for _ in range(islands)]
    best = None
    for turn in range(rounds):
        sent = pickle.dumps((wanted, elites))

        def island(batches: Iterator[pa.RecordBatch], sent=sent, turn=turn) -> Iterator[pa.RecordBatch]:
            wanted, elites = pickle.loads(sent)
            for batch in batches:
                for i in batch["id"].to_pylist():
                    found = evolve(wanted, elites[i], seed * 1000 + turn * islands + i, capacity)
                    yield pa.RecordBatch.from_pydict({"id": [i], "found": [pickle.dumps(found)]})

        rows = mapped(spark.range(0, islands, 1, islands), island, "id long, found binary").collect()
        found = [pickle.loads(r["found"]) for r in sorted(rows, key=lambda r: r["id"])]
        best = min([*found, *([best] if best else [])], key=lambda s: fitness(s, capacity))
        if sum(best.values()) <= least_bins(wanted, capacity):
            break
        elites = [[found[i], found[i - 1]] for i in range(islands)]
    return best


def slots_of(solution: Solution) -> list[tuple[int, int, int, int, int, int]]:
    """(length, from rank, to rank, pieces per bin, first sequence, first offset)."""
    rank: dict[int, int] = {}
    out, sequence = [], 0
    for pattern, n in sorted(solution.items()):
        at = 0
        for length, k in sorted(_held(pattern).items()):
            start = rank.get(length, 0)
            out.append((length, start, start + n * k, k, sequence, at))
            rank[length] = start + n * k
            at += length * k
        sequence += n
    return out


PIECE = "doc_id long, piece int, start long, length int, ids_crc32 long, ids binary, part int, rank long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, sequence_id long, offset long"


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int | None = END_ID, with_ids: bool = True) -> DataFrame:
    """Token pieces of every document: texts longer than `capacity` ids are cut into
    full ones after a first that takes the odd length.  `part` and `rank` number the
    pieces of a length within the task that made them."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(path, end_id).encode, TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in together(batches):
            found = encode(batch["text"])
            sizes = np.array([len(x) for x in found], dtype=np.int64)
            number = np.maximum(1, -(-sizes // capacity))
            owner = np.repeat(np.arange(len(sizes)), number)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
            first = sizes - (number - 1) * capacity
            length = np.where(piece == 0, first[owner], capacity)
            start = np.where(piece == 0, 0, first[owner] + (piece - 1) * capacity)
            ids = np.concatenate(found).astype("<u4", copy=False).view(np.uint8)
            ends = np.concatenate([[0], np.cumsum(4 * length)])
            upto = ends.tolist()
            crcs = [zlib.crc32(ids[a:b]) for a, b in zip(upto, upto[1:])]
            order = np.argsort(length, kind="stable")
            opens = np.searchsorted(length[order], np.arange(capacity + 2))
            rank = np.empty(len(length), dtype=np.int64)
            rank[order] = np.arange(len(order)) - opens[length[order]] + seen[length[order]]
            seen += np.diff(opens)
            # by buffers: an array made of memoryviews never lets go of the bytes behind them
            own = pa.BinaryArray.from_buffers(pa.binary(), len(length), [None, pa.array(ends, pa.int32()).buffers()[1], pa.py_buffer(ids)]) if with_ids else pa.nulls(len(length), pa.binary())
            cols = [batch["doc_id"].take(pa.array(owner)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length.astype(np.int32)), pa.array(crcs, pa.int64()), own, pa.array(np.full(len(length), part, np.int32)), pa.array(rank)]
            yield pa.RecordBatch.from_arrays(cols, names=[f.split()[0] for f in PIECE.split(", ")])

    return mapped(docs.select("doc_id", "text"), emit, PIECE)


class Slots:
    """Where the k-th piece of each length goes."""

    def __init__(self, solution: Solution, nothing: int = 0):
        rows = slots_of(solution)
        if nothing:  # pieces without ids, each in a sequence of its own
            rows.append((0, 0, nothing, 1, sum(solution.values()), 0))
        rows.sort()
        self.cols = np.array(rows, dtype=np.int64).reshape(-1, 6).T.copy()

    def find(self, length: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes, begin, _, per_bin, sequence, offset = self.cols
        base = int(max(begin.max(initial=0), k.max(initial=0))) + 1
        if base * (int(sizes.max(initial=0)) + 1) >= 1 << 63:
            raise OverflowError("more pieces than can be numbered")
        at = np.searchsorted(sizes * base + begin, length * base + k, side="right") - 1
        inside = k - begin[at]
        return sequence[at] + inside // per_bin[at], offset[at] + inside % per_bin[at] * length


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int | None = END_ID, with_ids: bool = True) -> DataFrame:
    """Pieces of all documents with sequence_id and offset.

    A null text is empty; it still has the end id.  A tokenizer without `end_id`
    gives an empty text a piece of length 0 at the start of a sequence of its own.
    Null doc_ids and repeated rows are packed like any other; of two equal rows
    either may stand in either place.  No documents give no rows."""
    spark = docs.sparkSession
    made = written(pieces(docs, path, capacity, end_id, with_ids), "pieces")
    counts = made.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = written(counts, "piece-counts")
    wanted = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    nothing = wanted.pop(0, 0)
    slots = spark.sparkContext.broadcast(Slots(search(spark, wanted, capacity), nothing))
    # pieces of a length in the tasks before, one row a task; a task made pieces of few lengths
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", F.struct("length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")).alias("b"))
    bases = written(bases.groupBy("part").agg(F.array_sort(F.collect_list("b")).alias("bases")), "piece-bases")
    few = bases.count() <= BROADCAST_PARTS
    ranked = made.join(F.broadcast(bases) if few else bases, "part")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch["length"].to_numpy().astype(np.int64)
            k = batch["rank"].to_numpy() + batch["base"].to_numpy()
            sequence, offset = slots.value.find(length, k)
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("doc_id", "piece", "start")), pa.array(length), batch["ids_crc32"], batch["ids"], pa.array(sequence), pa.array(offset)], names=[f.split()[0] for f in PLACED.split(", ")])

    own = F.element_at(F.map_from_entries("bases"), F.col("length")).alias("base")
    placed = mapped(ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "ids", "rank", own), place, PLACED, rows=1 << 16)
    return placed if with_ids else placed.drop("ids")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 ids: doc_id, piece, start,
    length, ids_crc32, sequence_id, offset.  See `packed` for nulls and repeats; an
    empty table gives no rows, further columns are ignored."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return packed(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)
