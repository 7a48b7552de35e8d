"""Token ids in raw shards with a minimal perfect hash index.

Documents are dealt by ranges of doc_id, and each task encodes its range in order
into a shard: a header and the bare ids, two bytes each where the vocabulary
allows, else four.  The index maps a key, (doc_id, its how-manieth row), to shard,
offset and length: keys are dealt to buckets by hash, and a bucket's keys get the
numbers 0 to n-1 by a cascade of bit arrays (a key is placed at the first level
where it is alone); a stored fingerprint tells keys that were never put in.  Keys
whose 64-bit hashes are equal are listed in full beside the index.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpweave.llm.common import mapped
from corpweave.llm.files import Output, Ranges, new_file
from corpweave.llm.tokenize import encoder, together
from corpweave.storage import shared_path, written

END_ID = 2
MAGIC = b"IDSHARD1"
#: keys in a bucket of the index, about, and buckets that a task handles
BUCKET_KEYS = 1 << 14
BUCKETS_A_TASK = 64
#: bits of a level per key that is left
GAMMA = 2
PLACE = ("shard", "offset", "length")
_U = np.uint64


def _mix(h: np.ndarray, level: int) -> np.ndarray:
    h = h ^ _U((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h = (h ^ (h >> _U(shift))) * _U(factor)
    return h ^ (h >> _U(33))


class PerfectHash:
    """Numbers 0 to n-1 for n distinct 64-bit keys; others get any number or -1."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self._ranks = []
        total = 0
        for bits in levels:
            upto = np.cumsum(bits) - bits + total
            self._ranks.append(upto)
            total += int(bits.sum())

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys
        while len(left):
            size = _U(max(2, GAMMA * len(left)))
            at = (_mix(left, len(levels)) % size).astype(np.int64)
            n = np.bincount(at, minlength=int(size))
            levels.append(n == 1)
            left = left[n[at] > 1]
        return cls(levels)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self._ranks)):
            at = (_mix(keys[left], level) % _U(len(bits))).astype(np.int64)
            hit = bits[at]
            out[left[hit]] = ranks[at[hit]]
            left = left[~hit]
        return out


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys, 97) >> _U(32)).astype(np.uint32)


def pack_index(rows: pa.Table) -> bytes:
    """The index of a bucket's rows (key, doc_id, copy, shard, offset, length)."""
    keys = rows["key"].to_numpy().view(np.uint64)
    _, back, times = np.unique(keys, return_inverse=True, return_counts=True)
    twice = times[back] > 1
    spare, rows, keys = rows.filter(pa.array(twice)), rows.filter(pa.array(~twice)), keys[~twice]
    index = PerfectHash.of(keys)
    at = index.numbers(keys)
    cols = {}
    for name, values in (("fp", fingerprint(keys)), *((c, rows[c].to_numpy()) for c in PLACE)):
        cols[name] = np.empty(len(keys), dtype=values.dtype)
        cols[name][at] = values
    for name in ("doc_id", "copy", *PLACE):
        cols[f"spare_{name}"] = spare[name].combine_chunks().fill_null(0).to_numpy(zero_copy_only=False)
    cols["spare_null"] = spare["doc_id"].combine_chunks().is_null().to_numpy(zero_copy_only=False)
    out = io.BytesIO()
    np.savez(out, sizes=np.array([len(b) for b in index.levels], dtype=np.int64), bits=np.packbits(np.concatenate([*index.levels, np.zeros(0, bool)])), **cols)
    return out.getvalue()


class PackedIndex:
    def __init__(self, data: bytes):
        self.cols = dict(np.load(io.BytesIO(data)))
        sizes = self.cols["sizes"]
        bits = np.unpackbits(self.cols["bits"], count=int(sizes.sum())).astype(bool)
        self.hash = PerfectHash(np.split(bits, np.cumsum(sizes)[:-1]) if len(sizes) else [])
        named = zip(*(self.cols[f"spare_{c}"].tolist() for c in ("null", "doc_id", "copy")))
        self.spare = {(None if null else doc, copy): i for i, (null, doc, copy) in enumerate(named)}

    def locate(self, rows: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        """(found, shard, offset, length) of each of `rows` (key, doc_id, copy)."""
        keys = rows["key"].to_numpy().view(np.uint64)
        at = self.hash.numbers(keys)
        found = at >= 0
        if len(self.cols["fp"]):
            found &= self.cols["fp"][at] == fingerprint(keys)
        out = [(self.cols[c][at] if len(self.cols[c]) else np.zeros(len(at), np.int64)).astype(np.int64) for c in PLACE]
        if self.spare:
            own = [self.spare.get(x, -1) for x in zip(rows["doc_id"].to_pylist(), rows["copy"].to_pylist())]
            listed = np.flatnonzero(np.array(own) >= 0)
            found[listed] = True
            for values, c in zip(out, PLACE):
                values[listed] = self.cols[f"spare_{c}"][np.array(own)[listed]]
        return found, *out


def _key():
    return F.xxhash64("doc_id", "copy")


def _ranges(reads: Ranges, file: str, width: int, offset: np.ndarray, length: np.ndarray) -> Iterator[np.ndarray]:
    """Ids of places in the order of a shard; places that lie close are read at once."""
    low, high = int(offset[0]), int((offset + length).max())
    if high - low <= 2 * int(length.sum()) + 1024:
        near = np.frombuffer(reads.read(file, 16 + width * low, width * (high - low)), dtype=f"<u{width}")
        yield from (near[a - low : a - low + n] for a, n in zip(offset.tolist(), length.tolist()))
        return
    for a, n in zip(offset.tolist(), length.tolist()):
        yield np.frombuffer(reads.read(file, 16 + width * a, width * n), dtype=f"<u{width}")


def _write_shards(folder: str, path: str, end_id: int | None):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path, end_id)
        kind = np.uint16 if tokens.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        out, at, last, copy, part = None, 0, object(), 0, TaskContext.get().partitionId()
        for batch in together(batches):
            if out is None:
                out = Output(new_file(folder, f"shard-{part:05d}", ".ids"))
                out.write(MAGIC + np.dtype(kind).itemsize.to_bytes(8, "little"))
            ids = tokens.encode(batch["text"])
            out.write(np.concatenate(ids).astype(kind).tobytes())
            copies = []
            for doc in batch["doc_id"].to_pylist():
                copy = copy + 1 if doc == last else 0
                last = doc
                copies.append(copy)
            length = np.array([len(x) for x in ids], dtype=np.int64)
            offset = at + np.cumsum(length) - length
            at += int(length.sum())
            n = len(ids)
            cols = [batch["doc_id"], pa.array(copies, pa.int32()), pa.array([part] * n, pa.int32()), pa.array([out.uri] * n), pa.array(offset), pa.array(length)]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "copy", "shard", "file", "offset", "length"])
        if out is not None:
            out.close()

    return emit


def _write_index(folder: str):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        rows = pa.Table.from_batches(held)
        bucket = rows["bucket"].to_numpy()
        files = []
        for b in np.unique(bucket).tolist():
            own = rows.filter(pa.array(bucket == b))
            out = Output(new_file(folder, f"keys-{b:05d}", ".mph"))
            out.write(pack_index(own))
            out.close()
            files.append((b, out.uri))
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in files], pa.int32()), pa.array([f[1] for f in files])], names=["bucket", "index_file"])

    return emit


class IdStore:
    """Shards and index on disk.  `shards` has a row a shard (shard, file, base,
    n_ids), `indexes` one a bucket (bucket, index_file), `keys` one a document."""

    def __init__(self, shards: DataFrame, indexes: DataFrame, keys: DataFrame, buckets: int, n_shards: int):
        self.shards, self.indexes, self.keys, self.buckets, self.n_shards = shards, indexes, keys, buckets, n_shards

    def locate(self, wanted: DataFrame) -> DataFrame:
        """`wanted` (doc_id, copy) that are in the store, with shard, offset, length.
        A bucket's index is read once by the task that has its keys."""
        keyed = wanted.select("doc_id", "copy", _key().alias("key")).withColumn("bucket", F.pmod("key", F.lit(self.buckets)).cast("int"))
        tasks = _tasks(wanted.sparkSession, self.buckets)
        keyed = keyed.join(self.indexes, "bucket").repartition(tasks, "index_file").sortWithinPartitions("index_file")

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            reads, held = Ranges(), (None, None)
            for batch in batches:
                names = batch["index_file"].to_pylist()
                cuts = [i for i in range(len(names)) if not i or names[i] != names[i - 1]] + [len(names)]
                for a, b in zip(cuts, cuts[1:]):
                    if held[0] != names[a]:
                        held = (names[a], PackedIndex(reads.read(names[a], 0, reads.size(names[a]))))
                    own = batch.slice(a, b - a)
                    found, *places = held[1].locate(own)
                    cols = [own["doc_id"], own["copy"], *(pa.array(p) for p in places)]
                    yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "copy", *PLACE]).filter(pa.array(found))
            reads.close()

        return mapped(keyed, look, "doc_id long, copy int, shard long, offset long, length long")

    def read(self, places: DataFrame, with_ids: bool = True) -> DataFrame:
        """doc_id, start, n_tokens, ids_crc32 and ids of located documents; start counts
        the ids of all shards and documents before."""
        placed = places.join(F.broadcast(self.shards), "shard").repartition(self.n_shards, "file").sortWithinPartitions("file", "offset")

        def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            reads, width = Ranges(), (None, 0)
            for batch in batches:
                crcs, ids = [], []
                files, offset, length = batch["file"].to_pylist(), batch["offset"].to_numpy(), batch["length"].to_numpy()
                cuts = [i for i in range(len(files)) if not i or files[i] != files[i - 1]] + [len(files)]
                for a, b in zip(cuts, cuts[1:]):
                    if width[0] != files[a]:
                        head = reads.read(files[a], 0, 16)
                        if head[:8] != MAGIC:
                            raise ValueError(f"{files[a]} is no shard of ids")
                        width = (files[a], int.from_bytes(head[8:], "little"))
                    for own in _ranges(reads, files[a], width[1], offset[a:b], length[a:b]):
                        raw = own.astype("<u4").tobytes()
                        crcs.append(zlib.crc32(raw))
                        ids.append(raw if with_ids else None)
                start = batch["base"].to_numpy() + offset
                yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(start), batch["length"], pa.array(crcs, pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"])
            reads.close()

        return mapped(placed, fetch, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def write_ids(docs: DataFrame, path: str, end_id: int | None = END_ID, partitions: int | None = None) -> IdStore:
    """Encodes `docs` (doc_id, text) into a store, in ascending order of doc_id.

    A null text is empty; a null doc_id comes first; rows with one doc_id are
    numbered in the order of their texts.  A shard is a range of doc_id, read back by one
    task: at scale ask for so many `partitions` that a range fits one."""
    spark = docs.sparkSession
    folder = shared_path(spark, "ids")
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select("doc_id", "text").repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    keys = mapped(ordered, _write_shards(folder, path, end_id), "doc_id long, copy int, shard int, file string, offset long, length long")
    keys = written(keys, "id-keys")
    totals = sorted(keys.groupBy("shard", "file").agg(F.sum("length").alias("n_ids"), F.count("*").alias("n")).collect())
    shards, base = [], 0
    for shard, file, n_ids, _ in totals:
        shards.append((shard, file, base, n_ids))
        base += n_ids
    shards = spark.createDataFrame(shards, "shard long, file string, base long, n_ids long")
    buckets = max(1, -(-sum(t["n"] for t in totals) // BUCKET_KEYS))
    keyed = keys.select(_key().alias("key"), "doc_id", "copy", *PLACE).withColumn("bucket", F.pmod("key", F.lit(buckets)).cast("int"))
    indexes = mapped(keyed.repartition(_tasks(spark, buckets), "bucket"), _write_index(folder), "bucket int, index_file string")
    return IdStore(shards, written(indexes, "id-indexes"), keys, buckets, max(1, len(totals)))


def _tasks(spark: SparkSession, buckets: int) -> int:
    """Tasks for the buckets: as many as the session deals to, more where a task's would be too many."""
    return max(1, min(buckets, int(spark.conf.get("spark.sql.shuffle.partitions"))), -(-buckets // BUCKETS_A_TASK))


def op6_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, written, found by the index and read back: doc_id, start,
    n_tokens, ids_crc32.  See `write_ids`; an empty table gives no rows, further
    columns are ignored."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = write_ids(docs, public_tokenizers.path("word_bpe_49k.json"))
    return kept.read(kept.locate(kept.keys), with_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")
