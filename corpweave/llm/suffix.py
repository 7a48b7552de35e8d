"""Removal of repeated byte strings with a two-stage suffix array.

A byte goes if some string of `min_len` bytes that covers it also starts in a
document with a smaller doc_id.  Equal strings have to meet without a global sort
of all suffixes, so the texts are dealt by content first:

1. Of documents with equal texts only the first takes part; the others lose all.
2. Each window of `min_len` bytes is assigned to the rightmost least hash of the
   k-grams in it (its anchor), so equal windows have equal anchors.  Anchors are
   dealt by hash; one that a single document holds settles all its windows.
3. Around each other anchor the text that its windows cover (its context) is dealt
   by the hash.  Equal contexts of a batch are sent once, for their first document.
   The contexts of an anchor that more than `MOST_CONTEXTS` documents hold, as counted
   in step 2, are split into the single windows, each dealt by its own content, so
   what one hash gathers does not grow with the corpus.  Anchors found in more than a
   hundredth of a sample of documents are known to be such beforehand and skip step 2.
4. In each partition, contexts are joined to texts of bounded size whose suffixes
   are sorted in two stages: those smaller than their successor directly, the rest
   induced from them by scans over the buckets.  Common prefixes of neighbours
   give the runs of equal windows, and a run its least doc_id.

What goes to a partition is packed by batch: rows hold arrays, not single anchors.
Whole texts are read, never prefixes; a hash collision only adds a comparison.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpweave.llm.common import mapped

MIN_LEN = 50
GRAM = 16
#: documents looked at for frequent anchors, about, and the share that makes one
SAMPLE = 4000
FREQUENT = 0.01
#: documents with an anchor beyond which its contexts are split
MOST_CONTEXTS = 20_000
#: partitions that anchors and contexts are dealt to, at least
LEAST_PARTS = 64
#: bytes that are hashed, or sorted, at once
BLOCK = 1 << 19
#: stands for a null doc_id: greater than any
NO_ID = (1 << 63) - 1

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> _U(31))
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(29)
    return h


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k bytes from each place: hashes of lengths that are powers of
    two, each rolled up from two of half the length, put together."""
    power, length = data.astype(np.uint64) + _U(1), 1
    base, out, done = _BASE, None, 0
    n = len(data) - k + 1
    while True:
        if k & length:
            part = power[done : done + n]
            out = part.copy() if out is None else out * base + part
            done += length
        if 2 * length > k:
            return _mixed(out)
        power = power[:-length] * base + power[length:]
        base, length = _U(int(base) ** 2 & 0xFFFFFFFFFFFFFFFF), 2 * length


def _least_of(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` values in a row."""
    out, length = values, 1
    while 2 * length <= width:
        out = np.minimum(out[:-length], out[length:])
        length *= 2
    rest = width - length
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def anchors(data: np.ndarray, valid: np.ndarray, min_len: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, first, last): the anchors of the windows that start where `valid`
    holds, and the first and last of the windows of each, which stand in a row."""
    width = min_len - k + 1
    h = gram_hashes(data, k)
    place = np.arange(len(h), dtype=np.uint64)
    with_place = (h >> _U(20) << _U(20)) | (_U((1 << 20) - 1) - place)  # the rightmost of equal hashes is least
    least = _least_of(with_place, width)
    starts = np.flatnonzero(valid[: len(least)])
    if not len(starts):
        return starts, starts, starts
    at = (_U((1 << 20) - 1) - (least[starts] & _U((1 << 20) - 1))).astype(np.int64)
    opens = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    return at[opens], starts[opens], starts[np.append(opens[1:], len(starts)) - 1]


def _blocks(texts: list[bytes], min_len: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts joined to blocks, as (bytes, valid window starts, starts of the parts,
    (owner, place in the owner's text) of the parts); longer texts are cut into
    parts that overlap by all but one byte of a window."""
    held, where, total = [], [], 0
    for k, text in enumerate(texts):
        for at in range(0, max(1, len(text) - min_len + 1), BLOCK):
            part = text[at : at + BLOCK + min_len - 1]
            if len(part) < min_len:
                break
            held.append(part)
            where.append((k, at))
            total += len(part)
            if total >= BLOCK // 2:
                yield _block(held, where, min_len)
                held, where, total = [], [], 0
    if held:
        yield _block(held, where, min_len)


def _block(held: list[bytes], where: list[tuple[int, int]], min_len: int):
    data = np.frombuffer(b"".join(held), dtype=np.uint8)
    ends = np.cumsum([len(h) for h in held])
    valid = np.ones(len(data), dtype=bool)
    for j in range(1, min_len):
        valid[ends - j] = False
    return data, valid, np.concatenate([[0], ends[:-1]]), np.array(where)


def _six(h: np.ndarray) -> np.ndarray:
    """The 48-bit numbers as rows of six bytes."""
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])


def _from_six(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel().astype(np.int64)


def _bytes_column(rows: np.ndarray, opens: np.ndarray) -> pa.Array:
    """Binary values out of rows of bytes; value i begins at row opens[i]."""
    ends = np.append(opens, len(rows)).astype(np.int32) * rows.shape[1]
    return pa.BinaryArray.from_buffers(pa.binary(), len(opens), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(rows))])


def _text_bytes(batch: pa.RecordBatch) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in batch["text"].to_pylist()]


def _anchors_of(texts: list[bytes], min_len: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(owner, hash) of all anchors, each once per text, in order."""
    found = [np.zeros(0, dtype=np.int64)]
    for data, valid, opens, where in _blocks(texts, min_len):
        place, _, _ = anchors(data, valid, min_len, k)
        owner = where[np.searchsorted(opens, place, side="right") - 1, 0]
        found.append(owner << 48 | (gram_hashes(data, k)[place] >> _U(16)).astype(np.int64))
    both = np.unique(np.concatenate(found))
    return both >> 48, both & ((1 << 48) - 1)


def _sample_rows(min_len: int, k: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_anchors_of(_text_bytes(batch), min_len, k)[1])], names=["h"])

    return emit


def _anchor_rows(min_len: int, k: int, parts: int, frequent):
    """Per batch and partition a row with the anchors that go there, by document."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, h = _anchors_of(_text_bytes(batch), min_len, k)
            often = np.isin(h, frequent.value)
            part = np.where(often, batch["did"].to_numpy()[owner] % parts, h % parts)
            sent = ~often  # of frequent anchors, one tells that a document has any
            sent[np.flatnonzero(often)[np.unique(owner[often], return_index=True)[1]]] = True
            owner, h, part = owner[sent], h[sent], part[sent]
            order = np.lexsort((owner, part))
            owner, h, part = owner[order], h[order], part[order]
            if not len(h):
                continue
            row = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            doc = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (owner[1:] != owner[:-1])]))
            ids = batch["did"].to_numpy()[owner[doc]]
            n = np.diff(np.append(doc, len(h))).astype("<u4")
            row_of_doc = np.searchsorted(doc, row)
            cols = [_bytes_column(_six(h), row), _bytes_column(ids.view(np.uint8).reshape(-1, 8), row_of_doc), _bytes_column(n.view(np.uint8).reshape(-1, 4), row_of_doc)]
            yield pa.RecordBatch.from_arrays([pa.array(part[row].astype(np.int32)), *cols], names=["part", "hs", "dids", "ns"])

    return emit


def _shared_rows(frequent):
    """All anchors of a partition -> per document those that another one has too, and of
    these those that very many have."""
    most = MOST_CONTEXTS
    return lambda batches: _shared(batches, frequent.value, most)


def _shared(batches: Iterator[pa.RecordBatch], frequent: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    hs, dids = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for batch in batches:
        for h, d, n in zip(*(batch[c].to_pylist() for c in ("hs", "dids", "ns"))):
            hs.append(_from_six(h))
            dids.append(np.repeat(np.frombuffer(d, "<i8"), np.frombuffer(n, "<u4")))
    h, did = np.concatenate(hs), np.concatenate(dids)
    order = np.argsort(h, kind="stable")
    h, did = h[order], did[order]
    if not len(h):
        return
    opens = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    apart = (np.minimum.reduceat(did, opens) != np.maximum.reduceat(did, opens)) | np.isin(h[opens], frequent)
    times = np.diff(np.append(opens, len(h)))
    shared, often = np.repeat(apart, times), np.repeat(times > most, times)
    h, did, often = h[shared], did[shared], often[shared]
    order = np.argsort(did, kind="stable")
    h, did, often = h[order], did[order], often[order]
    doc = np.flatnonzero(np.concatenate([[True], did[1:] != did[:-1]])) if len(did) else np.zeros(0, np.int64)
    for lo in range(0, len(doc), 10_000):
        cut = doc[lo : lo + 10_000]
        end = doc[lo + 10_000] if lo + 10_000 < len(doc) else len(h)
        many = often[cut[0] : end]
        opens = np.concatenate([[0], np.cumsum(many)])[cut - cut[0]]
        cols = [_bytes_column(_six(h[cut[0] : end]), cut - cut[0]), _bytes_column(_six(h[cut[0] : end][many]), opens)]
        yield pa.RecordBatch.from_arrays([pa.array(did[cut]), *cols], names=["did", "hs", "many"])


def _merged(did: np.ndarray, th: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans of each text, with those that touch joined."""
    if not len(did):
        return did, th, a, b
    order = np.lexsort((a, th, did))
    did, th, a, b = did[order], th[order], a[order], b[order]
    text = np.concatenate([[0], np.cumsum((did[1:] != did[:-1]) | (th[1:] != th[:-1]))]) << 40
    reach = np.maximum.accumulate(b + text)
    opens = np.flatnonzero(np.concatenate([[True], (a + text)[1:] > reach[:-1]]))
    last = np.append(opens[1:], len(a)) - 1
    return did[opens], th[opens], a[opens], (reach - text)[last]


class _Packed:
    """Contexts, or settled spans where the context is empty, on their way to a partition."""

    FIELDS = (("h", "<i8"), ("did", "<i8"), ("th", "<i8"), ("at", "<i8"), ("len", "<i4"))

    def __init__(self) -> None:
        self.rows: dict[int, tuple[list, ...]] = {}

    def add(self, part: int, *values) -> None:
        for into, value in zip(self.rows.setdefault(part, ([], [], [], [], [], [])), values):
            into.append(value)

    def batch(self) -> pa.RecordBatch:
        cols: list[list] = [[] for _ in range(7)]
        for part, rows in self.rows.items():
            cols[0].append(part)
            for into, values, (_, kind) in zip(cols[1:], rows, self.FIELDS):
                into.append(np.array(values, dtype=kind).tobytes())
            cols[6].append(b"".join(rows[5]))
        names = ["part", *(f for f, _ in self.FIELDS), "contexts"]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if not i else pa.binary()) for i, c in enumerate(cols)], names=names)


PACKED = "part int, h binary, did binary, th binary, at binary, len binary, contexts binary"


def _context_rows(min_len: int, k: int, parts: int, frequent):
    """For documents with the lists `marks` of their shared anchors and `many` of those
    that very many have: contexts to be compared, and spans that a smaller document of
    the batch settles already."""

    def of_documents(lists: list) -> np.ndarray:
        found = [i << 48 | _from_six(b"".join(m)) for i, m in enumerate(lists) if m]
        return np.unique(np.concatenate([np.zeros(0, np.int64), *found]))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids, versions = _text_bytes(batch), batch["did"].to_pylist(), batch["th"].to_pylist()
            named, many = of_documents(batch["marks"].to_pylist()), of_documents(batch["many"].to_pylist())
            first: dict[bytes, tuple] = {}
            out = _Packed()
            done: list[tuple[int, int, int, int]] = []

            def settled(did, th, at, length, done=done):
                done.append((did, th, at, at + length))

            for data, valid, opens, where in _blocks(texts, min_len):
                place, lo, hi = anchors(data, valid, min_len, k)
                part = np.searchsorted(opens, place, side="right") - 1
                h = (gram_hashes(data, k)[place] >> _U(16)).astype(np.int64)
                own = where[part, 0] << 48 | h
                often = np.isin(h, frequent.value) | np.isin(own, many)
                held = np.flatnonzero(often | np.isin(own, named))
                part = part[held]
                raw, owner, shift = data.tobytes(), where[part, 0].tolist(), (where[part, 1] - opens[part]).tolist()
                for key, a, b, o, s, alone in zip(h[held].tolist(), lo[held].tolist(), hi[held].tolist(), owner, shift, often[held].tolist()):
                    for i, j in [(i, i) for i in range(a, b + 1)] if alone else [(a, b)]:
                        context = raw[i : j + min_len]
                        mine = (ids[o], versions[o], i + s)
                        seen = first.get(context)
                        if seen is None:
                            first[context] = (key, alone, *mine)
                        elif mine[0] < seen[2]:
                            settled(*seen[2:], len(context))
                            first[context] = (key, alone, *mine)
                        elif mine[0] > seen[2]:
                            settled(*mine, len(context))
                        else:  # once more in the document
                            dealt = _content_hash(context) if alone else key
                            out.add(dealt % parts, dealt, *mine, len(context), context)
            for context, (key, alone, *mine) in first.items():
                dealt = _content_hash(context) if alone else key
                out.add(dealt % parts, dealt, *mine, len(context), context)
            if done:
                for did, th, a, b in zip(*(x.tolist() for x in _merged(*np.array(done, dtype=np.int64).T))):
                    out.add(did % parts, -1, did, th, a, b - a, b"")
            yield out.batch()

    return emit


def _content_hash(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=6).digest(), "little")


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as one number that orders like them."""
    padded = np.concatenate([text, np.zeros(64, dtype=np.uint8)]).astype(np.uint64)
    out = padded[:-7].copy()
    for j in range(1, 8):
        out = (out << _U(8)) | padded[j : len(padded) - 7 + j]
    return out


def _sorted_directly(places: np.ndarray, word: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first `depth` bytes, by eight bytes at a time
    within what is still equal."""
    order = places[np.argsort(word[places], kind="stable")]
    key = word[order]
    rank = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
    for off in range(8, depth, 8):
        tied = np.flatnonzero(np.concatenate([rank[1:] == rank[:-1], [False]]) | np.concatenate([[False], rank[1:] == rank[:-1]])) if len(rank) else rank
        if not len(tied):
            break
        sub, r = order[tied], rank[tied]
        w = word[np.minimum(sub + off, len(word) - 1)]
        o = np.lexsort((w, r))
        order[tied], w = sub[o], w[o]
        step = np.zeros(len(rank), dtype=bool)
        step[1:] = rank[1:] != rank[:-1]
        step[tied[1:]] |= w[1:] != w[:-1]
        rank = np.cumsum(step)
    return order


def suffix_array(text: np.ndarray, depth: int = 1 << 30, word: np.ndarray | None = None) -> np.ndarray:
    """Suffixes of a byte text in order (equal within the first `depth` bytes: in
    any order).  Stage one sorts the suffixes smaller than their successor; stage
    two scans the buckets of first bytes upwards, and from each suffix of a bucket
    puts the one before it, if that is greater than its successor, at the next place
    of the front part of its own bucket."""
    n = len(text)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    word = _words(text) if word is None else word
    change = np.flatnonzero(np.append(text[1:] != text[:-1], True))  # where a run of one byte ends
    at = np.repeat(change, np.diff(np.concatenate([[-1], change])))
    after = np.append(text, 0)[at + 1].astype(np.int16)
    after[at == n - 1] = -1  # the empty suffix is least
    small = text < after
    direct = _sorted_directly(np.flatnonzero(small), word, min(depth, n))
    cut = np.searchsorted(text[direct], np.arange(257))
    front: list[list[np.ndarray]] = [[] for _ in range(256)]
    front[text[n - 1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        if not front[c] and cut[c] == cut[c + 1]:
            continue
        newest = np.concatenate(front[c]) if front[c] else np.zeros(0, dtype=np.int64)
        whole = [newest]
        while len(newest):  # runs of the bucket's own byte
            before = newest[newest > 0] - 1
            newest = before[text[before] == c]
            whole.append(newest)
        bucket = np.concatenate([*whole, direct[cut[c] : cut[c + 1]]])
        before = bucket[bucket > 0] - 1
        before = before[text[before] > c]
        if len(before):
            byte = text[before]
            before = before[np.argsort(byte, kind="stable")]
            found, opens = np.unique(text[before], return_index=True)
            for b, part in zip(found.tolist(), np.split(before, opens[1:])):
                front[b].append(part)
        out.append(bucket)
    return np.concatenate(out)


def common_prefixes(order: np.ndarray, word: np.ndarray, least: int) -> np.ndarray:
    """Whether each suffix and the next share `least` bytes."""
    a, b = order[:-1], order[1:]
    live = np.arange(len(a))
    for off in [*range(0, least - 7, 8), *([least - 8] if least % 8 else [])]:
        live = live[word[a[live] + off] == word[b[live] + off]]
    same = np.zeros(len(a), dtype=bool)
    same[live] = True
    return same


def repeated_windows(contexts: list[bytes], owners: np.ndarray, min_len: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, start, end) of the maximal runs of bytes covered by windows that
    also occur in a context with a smaller owner."""
    text = np.frombuffer(b"".join(contexts), dtype=np.uint8)
    lengths = np.array([len(c) for c in contexts])
    ends = np.cumsum(lengths)
    owner = np.repeat(owners, lengths)
    left = np.repeat(ends, lengths) - np.arange(len(text))
    word = _words(np.concatenate([text, np.zeros(min_len, dtype=np.uint8)]))
    order = suffix_array(text, min_len, word)
    opens = np.concatenate([[0], np.flatnonzero(~common_prefixes(order, word, min_len)) + 1])
    whole = left[order] >= min_len
    mine = np.where(whole, owner[order], NO_ID)
    least = np.repeat(np.minimum.reduceat(mine, opens), np.diff(np.append(opens, len(order))))
    gone = order[whole & (mine > least)]
    edge = np.zeros(len(text) + 1, dtype=np.int64)
    np.add.at(edge, gone, 1)
    np.subtract.at(edge, gone + min_len, 1)
    covered = np.cumsum(edge[:-1]) > 0
    step = np.concatenate([[True], covered[1:] != covered[:-1]])
    step[ends[:-1]] = True
    runs = np.flatnonzero(step)
    stops = np.append(runs[1:], len(text))
    keep = covered[runs]
    part = np.searchsorted(ends, runs[keep], side="right")
    base = ends[part] - lengths[part]
    return part, runs[keep] - base, stops[keep] - base


def _span_rows(min_len: int):
    """Spans to remove, from all contexts of a partition."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {f: [np.zeros(0, kind)] for f, kind in _Packed.FIELDS}
        contexts: list[bytes] = []
        for batch in batches:
            for name, kind in _Packed.FIELDS:
                held[name] += [np.frombuffer(x, kind) for x in batch[name].to_pylist()]
            contexts += batch["contexts"].to_pylist()
        h, did, th, at, n = (np.concatenate(held[f]).astype(np.int64) for f, _ in _Packed.FIELDS)
        text = b"".join(contexts)
        del contexts, held
        ends = np.cumsum(np.where(h < 0, 0, n)).tolist()
        # of equal contexts the one of the first document stays, the others go whole
        gone = h < 0
        first: dict[bytes, int] = {}
        ids, sizes = did.tolist(), n.tolist()
        for i in np.flatnonzero(~gone).tolist():
            context = text[ends[i] - sizes[i] : ends[i]]
            seen = first.setdefault(context, i)
            if ids[i] > ids[seen]:
                gone[i] = True
            elif ids[i] < ids[seen]:
                gone[seen] = True
                first[context] = i
        spans = [[x[gone] for x in (did, th, at, at + n)]]
        del first
        order = np.argsort(h, kind="stable")
        order = order[~gone[order]]
        group, upto = h[order], np.cumsum(n[order])
        opens = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, np.int64)
        alone = np.diff(np.append(opens, len(group))) == 1  # nothing to compare with
        if alone.any():
            single = np.zeros(len(group), dtype=bool)
            single[opens[alone]] = True
            order = order[~single]
            group, upto = h[order], np.cumsum(n[order])
            opens = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else opens[:0]
        begun = 0
        while begun < len(order):  # whole hashes, of about a block of text
            base = upto[begun - 1] if begun else 0
            later = opens[np.searchsorted(opens, max(np.searchsorted(upto, base + BLOCK), begun + 1)) :]
            stop = int(later[0]) if len(later) else len(order)
            own = order[begun:stop]
            part, a, b = repeated_windows([text[ends[i] - sizes[i] : ends[i]] for i in own.tolist()], did[own], min_len)
            own = own[part]
            spans.append([did[own], th[own], at[own] + a, at[own] + b])
            begun = stop
        done = _merged(*(np.concatenate([s[k] for s in spans]) for k in range(4)))
        for lo in range(0, len(done[0]), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[lo : lo + 50_000]) for x in done], names=["did", "th", "a", "b"])

    return emit


def _kept_rows(min_len: int, with_text: bool):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = ([], [], [], [], [])
            for th, text, first, spans in zip(*(batch[c].to_pylist() for c in ("th", "text", "first", "spans"))):
                raw = text.encode("utf-8", "surrogatepass")
                runs: list[list[int]] = []
                if not first:
                    runs = [[0, len(raw)]] if len(raw) >= min_len else []
                else:
                    for a, b in sorted((s["a"], s["b"]) for s in spans or () if s["th"] == th):
                        if runs and a <= runs[-1][1]:
                            runs[-1][1] = max(runs[-1][1], b)
                        else:
                            runs.append([a, b])
                cuts = [0, *(x for run in runs for x in run), len(raw)]
                rest = b"".join(raw[a:b] for a, b in zip(cuts[::2], cuts[1::2]))
                for into, value in zip(cols, (len(raw), len(raw) - len(rest), len(runs), hashlib.sha256(rest).hexdigest(), "".join(raw[a:b].decode("utf-8", "ignore") for a, b in zip(cuts[::2], cuts[1::2])) if with_text else None)):
                    into.append(value)
            made = [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()))]
            names = ["did", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]
            carried = ["no_text", "rest"] if with_text else []
            yield pa.RecordBatch.from_arrays([batch["did"], *made, *(batch[c] for c in carried)], names=[*names, *carried])

    return emit


def frequent_anchors(texts: DataFrame, min_len: int, k: int, sample: int = SAMPLE, share: float = FREQUENT) -> np.ndarray:
    """Hashes of the anchors that more than `share` of a sample of about `sample` rows
    hold; there are at most as many as the sample's documents have anchors / share."""
    n = texts.count()
    chosen = texts.filter(F.pmod(F.xxhash64("did", F.lit("sample")), F.lit(max(1, n // sample))) == 0).select("did", "text")
    least = max(20, int(share * min(n, sample)))
    found = mapped(chosen, _sample_rows(min_len, k), "h long").groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    return np.sort(np.array([r["h"] for r in found.select("h").collect()], dtype=np.int64))


def without_repeats(docs: DataFrame, min_len: int = MIN_LEN, k: int = GRAM, share: float = FREQUENT, with_text: bool = False) -> DataFrame:
    """Per row of `docs`: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked
    for, kept_text (a character cut in two goes whole), no_text, whether the text was null,
    and `rest`, a struct of the other columns.

    A null text is empty.  A null doc_id counts as greater than any; rows with one
    doc_id are not compared with each other, and each gives a row."""
    spark = docs.sparkSession
    parts = max(LEAST_PARTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("none"))
    carried = [F.col("text").isNull().alias("no_text"), rest.alias("rest")] if with_text else []
    also = ["no_text", "rest"] if with_text else []
    texts = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("did"), F.coalesce("text", F.lit("")).alias("text"), *carried)
    texts = texts.withColumn("th", F.xxhash64("text"))
    frequent = spark.sparkContext.broadcast(frequent_anchors(texts, min_len, k, share=share))
    firsts = texts.groupBy(F.sha2("text", 256).alias("sha")).agg(F.min("did").alias("did"), F.first("th").alias("th"))
    firsts = firsts.groupBy("did").agg(F.collect_set("th").alias("firsts"))
    # every join is on did alone: the texts are dealt once, and that exchange is used
    # again; it has to carry the same columns each time
    own = texts.join(firsts, "did", "left").withColumn("first", F.coalesce(F.array_contains("firsts", F.col("th")), F.lit(False)))
    found = mapped(own.filter("first").select("did", "text", *also), _anchor_rows(min_len, k, parts, frequent), "part int, hs binary, dids binary, ns binary")
    shared = mapped(found.repartitionById(parts, F.col("part")).drop("part"), _shared_rows(frequent), "did long, hs binary, many binary")
    many = F.collect_list(F.when(F.octet_length("many") > 0, F.col("many")))
    marks = shared.groupBy("did").agg(F.collect_list("hs").alias("marks"), many.alias("many"))
    marked = own.join(marks, "did", "left").filter("first and marks is not null").select("did", "th", "text", "marks", "many", *also)
    contexts = mapped(marked, _context_rows(min_len, k, parts, frequent), PACKED)
    spans = mapped(contexts.repartitionById(parts, F.col("part")).drop("part"), _span_rows(min_len), "did long, th long, a long, b long")
    lists = spans.groupBy("did").agg(F.collect_list(F.struct("th", "a", "b")).alias("spans"))
    kept = own.join(lists, "did", "left").select("did", "th", "text", "first", "spans", *also)
    schema = "did long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string"
    if with_text:
        schema = StructType([*StructType.fromDDL(schema).fields, texts.schema["no_text"], texts.schema["rest"]])
    kept = mapped(kept, _kept_rows(min_len, with_text), schema)
    return kept.withColumn("did", F.nullif("did", F.lit(NO_ID))).withColumnRenamed("did", "doc_id")


def op10_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without strings of 50 bytes that a document
    with a smaller doc_id holds: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    See `without_repeats` for nulls and repeated rows; an empty table gives no
    rows, further columns are ignored."""
    found = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
