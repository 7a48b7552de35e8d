"""Token ids of whole texts by the `tokenizers` library, a batch of texts at a time.

Both public vocabularies cut a text into pre-tokens before any merge is applied, and
a single space, or line end, between two visible characters always begins a new one.
So a batch is cut there into chunks, the library encodes each distinct chunk once,
and the ids of a text are those of its chunks put together by index.  Cutting,
finding the distinct chunks and putting together are array operations.  Texts in
which such a cut could depend on its surroundings (other white space) are encoded
by the library whole, so the ids are always those of the library.  Chunks and their
ids are kept for the batches that follow, up to a number of bytes.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: bytes of text that are encoded together, about
TOGETHER = 4 << 20
#: distinct chunks in one call of the library
JOIN = 256
#: bytes of chunks and ids that a worker keeps, about; beyond them, what was not asked for again goes
KEPT = 16 << 20
#: white space but for the space and the line end; the separators 1C-1F are white space for some libraries only
_OTHER_SPACES = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0     　" + "".join(map(chr, range(0x2000, 0x200B)))
_UNEVEN = rf"\A[ \n]|[ \n]\z|[ \n][ \n]|[{_OTHER_SPACES}]|\A\z"


def together(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = TOGETHER) -> Iterator[pa.RecordBatch]:
    """Batches joined until their texts have about `size` bytes; a larger one is sliced."""
    held, total = [], 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(batch):
            begun = int(ends[at - 1]) if at else 0
            stop = min(len(batch), max(at + 1, int(np.searchsorted(ends, begun + size - total, side="right"))))
            held.append(batch.slice(at, stop - at))
            total += int(ends[stop - 1]) - begun
            at = stop
            if total >= size or at < len(batch):
                yield _joined(held)
                held, total = [], 0
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]


class Encoder:
    """`encode(texts) -> list of uint32 arrays`: ids of each text, with `end_id` behind them."""

    def __init__(self, path: str, end_id: int | None = None):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(path)
        self.end_id = end_id
        spec = json.load(open(path, encoding="utf-8"))
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer") or {}
        #: line ends are tokens of their own; each chunk but a line's first takes the space before it
        self._spaced = not norm and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        #: white space is dropped
        self._worded = [n["type"] for n in norm.get("normalizers", ())] == ["NFC", "Replace", "Lowercase"] and pre["pretokenizers"][0]["type"] == "Split"
        self._forget()

    def encode(self, texts: pa.Array | list[str | None]) -> list[np.ndarray]:
        texts = pc.fill_null(pa.array(texts, pa.string()) if isinstance(texts, list) else texts, "")
        if not self._spaced and not self._worded:
            return [self._ended(np.array(e.ids, dtype=np.uint32)) for e in self._library(texts)]
        if self._worded:
            return self._by_chunks(texts)
        uneven = pc.match_substring_regex(texts, _UNEVEN)
        odd = np.flatnonzero(uneven.to_numpy(zero_copy_only=False))
        if not len(odd):
            return self._by_chunks(texts)
        even = iter(self._by_chunks(texts.filter(pc.invert(uneven))))
        whole = dict(zip(odd.tolist(), self._library(texts.take(pa.array(odd)))))
        return [self._ended(np.array(whole[i].ids, dtype=np.uint32)) if i in whole else next(even) for i in range(len(texts))]

    def _library(self, texts: pa.Array) -> list:
        return self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)

    def _ended(self, ids: np.ndarray) -> np.ndarray:
        return ids if self.end_id is None else np.append(ids, np.uint32(self.end_id))

    def _by_chunks(self, texts: pa.Array) -> list[np.ndarray]:
        """By distinct chunks.  A chunk stands without the space before it; one that
        follows a line end, or begins a text, has a line end in front (spaced kind)."""
        if not len(texts):
            return []
        texts = pc.replace_substring(texts, "\n", " \n" if self._spaced else " ")
        if self._spaced:
            texts = pc.binary_join_element_wise("\n", texts, "")
        lists = pc.split_pattern(texts, " ")
        chunks = lists.flatten().dictionary_encode()
        opens = lists.offsets.to_numpy().astype(np.int64)
        opens -= opens[0]
        values, first, count = self._learned(chunks.dictionary)
        at = chunks.indices.to_numpy(zero_copy_only=False)
        n = count[at]
        upto = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
        step = np.int32 if max(upto[-1], len(values)) < 1 << 31 else np.int64
        ids = values[np.arange(upto[-1], dtype=step) + np.repeat((first[at] - upto[:-1]).astype(step), n)]
        edges = upto[opens]
        if self._spaced:  # what begins each text is the id of the line end that was put there
            return [self._ended(ids[a + 1 : b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
        return [self._ended(ids[a:b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]

    def _learned(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first, count): ids, and where those of each chunk stand among them."""
        known = pc.index_in(chunks, value_set=self._chunks).fill_null(-1).to_numpy(zero_copy_only=False)
        new = np.flatnonzero(known < 0)
        ids, count = self._asked(chunks.take(pa.array(new)))
        at = known.astype(np.int64)
        at[new] = len(self._count) + np.arange(len(new))
        self._again[known[known >= 0]] = True
        self._chunks = pa.concat_arrays([self._chunks, chunks.take(pa.array(new))])
        self._ids, self._count = np.concatenate([self._ids, ids]), np.concatenate([self._count, count])
        self._again = np.concatenate([self._again, np.zeros(len(new), dtype=bool)])
        first = np.cumsum(self._count) - self._count
        out = self._ids, first[at], self._count[at].astype(np.int64)
        if self._chunks.nbytes + self._ids.nbytes > KEPT:
            self._keep(np.flatnonzero(self._again), first)
        return out

    def _forget(self) -> None:
        self._chunks, self._ids = pa.array([], pa.string()), np.zeros(0, dtype=np.uint32)
        self._count, self._again = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=bool)

    def _keep(self, which: np.ndarray, first: np.ndarray) -> None:
        n = self._count[which]
        if int(n.sum()) * 4 > KEPT // 2:
            return self._forget()
        ids = self._ids[np.arange(n.sum()) + np.repeat(first[which] - (np.cumsum(n) - n), n)]
        self._chunks, self._ids, self._count, self._again = self._chunks.take(pa.array(which)), ids, n, np.zeros(len(which), dtype=bool)

    def _asked(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, count) of chunks from the library.  Many are sent as one text, which the
        places that the library tells cut again."""
        lead = pc.if_else(pc.starts_with(chunks, "\n"), "", " ") if self._spaced else " "
        texts = pc.binary_join_element_wise(lead, chunks, "")
        sizes = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        pieces = texts.to_pylist()
        ids, counts = [np.zeros(0, dtype=np.uint32)], [np.zeros(0, dtype=np.int32)]
        for at in range(0, len(pieces), JOIN):
            found = self.tokenizer.encode("".join(pieces[at : at + JOIN]), add_special_tokens=False)
            size, own = sizes[at : at + JOIN], found.ids
            places = np.fromiter(chain.from_iterable(found.offsets), np.int64, 2 * len(own))[::2]
            owner = np.searchsorted(np.cumsum(size), places, side="right")
            ids.append(np.array(own, dtype=np.uint32))
            counts.append(np.bincount(owner, minlength=len(size)).astype(np.int32))
        return np.concatenate(ids), np.concatenate(counts)


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, end_id: int | None = None) -> Encoder:
    """The worker's encoder for a vocabulary file; kept between tasks of a reused worker."""
    key = (path, end_id)
    if key not in _ENCODERS:
        _ENCODERS.clear()  # one vocabulary at a time
        _ENCODERS[key] = Encoder(path, end_id)
    return _ENCODERS[key]
