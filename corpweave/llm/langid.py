"""Language identification: multinomial naive Bayes over hashed character n-grams.

Fitting counts n-grams of a bounded sample of labelled rows on the executors and
sums them per language and bucket; the log-probability matrix (languages x
buckets, float32) is broadcast.  Its size is a parameter: 256 KB a language.
Scoring handles a batch of texts as one array of code points: the n-gram hashes
index the matrix and the rows picked are summed per document.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from corpweave.llm.common import mapped

#: log2 of the number of hash buckets of the matrix
BUCKET_BITS = 16
#: labelled documents per language that a model is fitted on, at most about so many
SAMPLE_PER_LANG = 1500
#: added to every count
ALPHA = 0.1
#: code points scored at once
CHUNK = 1 << 18
#: a text is in no learned language if its mean log-probability a gram is lower than that of
#: the training text by more than MARGIN, and SHORT over the root of its letters besides
MARGIN = 1.75
SHORT = 4.0
#: grams of a language that must be learned before its training text is a measure of others
LEAST_GRAMS = 200_000
UNDETERMINED = "und"

_WORD_SIGN = re.compile(r"[^\W\d_]")
#: what is no prose: tokens with a digit, marks
_NO_WORD = re.compile(r"\S*\d\S*|[^\w\s]+|_+")
#: multipliers of the n-gram hashes, for n = 1, 2, 3
_MIX = tuple(tuple(np.uint32(x) for x in m) for m in ((0x9E3779B1,), (0x85EBCA77, 0xC2B2AE3D), (0x27D4EB2F, 0x165667B1, 0xD3A2646D)))


def has_letter(text: str) -> bool:
    """Whether a text has a sign of Unicode's categories L; numbers such as ½ or Ⅷ are none."""
    return any(m[0].isalpha() for m in _WORD_SIGN.finditer(text))


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def gram_buckets(points: np.ndarray, bits: int = BUCKET_BITS) -> list[np.ndarray]:
    """Buckets of the n-grams that start at each place, for n = 1, 2, 3; the two
    last places serve only as the ends of earlier grams."""
    m, shift = len(points) - 2, np.uint32(32 - bits)
    out = []
    for mix in _MIX:
        h = points[:m] * mix[0]
        for i in range(1, len(mix)):
            h ^= (points[i : m + i] + np.uint32(i)) * mix[i]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        out.append(h >> shift)
    return out


def _pieces(texts: list[str], size: int = CHUNK) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """Texts joined, each followed by two line ends, as (string, starts, owners);
    a text longer than `size` comes in several pieces that overlap by two."""
    held, owners, total = [], [], 0
    for k, text in enumerate(texts):
        for at in range(0, len(text), size):
            part = text[at : at + size + 2]
            if at and len(part) <= 2:
                break
            ends = "\n\n" if at + size + 2 >= len(text) else ""
            held.append(part + ends)
            owners.append(k)
            total += len(held[-1])
            if total >= size:
                yield _joined(held, owners)
                held, owners, total = [], [], 0
    if held:
        yield _joined(held, owners)


def _joined(held: list[str], owners: list[int]):
    starts = np.cumsum([0] + [len(h) for h in held[:-1]])
    return "".join(held), starts, np.array(owners)


def _starts_of_grams(starts: np.ndarray, length: int) -> np.ndarray:
    """Places that start no gram of their own: the last two of every piece."""
    ends = np.append(starts[1:], length)
    return np.concatenate([ends - 1, ends - 2])


@dataclass
class LanguageModel:
    """`langs` in order, and the (buckets + 1) x langs matrix of log probabilities;
    its last row, of zeros, is where places without a gram point."""

    langs: list[str]
    matrix: np.ndarray
    prior: np.ndarray
    #: mean log probability a gram of each language's training text; minus infinity where
    #: less than LEAST_GRAMS were learned
    level: np.ndarray | None = None

    def score(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Predicted language and its posterior; `und` and 0 for texts that are
        null or have no letter, or if no language was learned."""
        labels, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        known = [i for i, t in enumerate(texts) if t and self.langs and has_letter(t)]
        if not known:
            return labels, scores
        total = self._totals([texts[i].lower() for i in known])
        total += self.prior
        best = total.argmax(axis=1)
        part = np.exp(total - total.max(axis=1, keepdims=True))
        for i, b, s in zip(known, best.tolist(), (1 / part.sum(axis=1)).tolist()):
            labels[i], scores[i] = self.langs[b], min(1.0, s)
        return labels, scores

    def _totals(self, texts: list[str]) -> np.ndarray:
        """Log probability of each (not empty, lower-cased) text in each language."""
        total = np.zeros((len(texts), len(self.langs)))
        nothing = np.uint32(len(self.matrix) - 1)
        for text, starts, owners in _pieces(texts):
            points = _points(text)
            silent = _starts_of_grams(starts, len(points))
            silent = silent[silent < len(points) - 2]
            for bucket in gram_buckets(points, int(nothing).bit_length() - 1):
                bucket[silent] = nothing
                np.add.at(total, owners, np.add.reduceat(self.matrix[bucket], starts, axis=0, dtype=np.float64))
        return total

    def recognised(self, texts: list[str | None]) -> np.ndarray:
        """Whether a text has a letter and is in a learned language: the mean log
        probability of its grams in its best language comes up to the training text's.
        A text that fails is judged once more by its words alone, so numbers, keys and
        marks within prose do not count against it.  Without a measure (no language
        learned, or too little of the best one) a letter is enough."""
        out = np.array([bool(t and has_letter(t)) for t in texts], dtype=bool)
        if not self.langs or self.level is None:
            return out
        asked = np.flatnonzero(out)
        for strip in (False, True):
            held = [_NO_WORD.sub(" ", texts[i].lower()) if strip else texts[i].lower() for i in asked]
            if strip:
                held = [" ".join(t.split()) or texts[i].lower() for i, t in zip(asked, held)]
            if not held:
                break
            total = self._totals(held)
            best = (total + self.prior).argmax(axis=1)
            n = np.array([len(t) for t in held])
            mean = total[np.arange(len(held)), best] / (len(_MIX) * n)
            low = mean < self.level[best] - MARGIN - SHORT / np.sqrt(n)
            out[asked] = ~low
            asked = asked[low]
        return out


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fifth of the documents that no model may learn from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def _counts(bits: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            by: dict[str, list[str]] = {}
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                by.setdefault(lang, []).append(text.lower())
            for lang, texts in by.items():
                into = sums.setdefault(lang, np.zeros(1 << bits, dtype=np.int64))
                for text, starts, _ in _pieces(texts):
                    points = _points(text)
                    own = np.ones(len(points), dtype=bool)
                    own[_starts_of_grams(starts, len(points))] = False
                    for bucket in gram_buckets(points, bits):
                        into += np.bincount(bucket[own[:-2]], minlength=1 << bits)
        for lang, total in sums.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used)), pa.array(used, pa.int32()), pa.array(total[used])], names=["lang", "bucket", "n"])

    return count


def fit(docs: DataFrame, bits: int = BUCKET_BITS, sample_per_lang: int = SAMPLE_PER_LANG) -> LanguageModel:
    """A model of the labelled rows of `docs` (text and lang not null) outside the
    held-out fifth: about `sample_per_lang` documents of each language, chosen by
    a hash of doc_id.  Priors are the languages' counts over all such rows."""
    rows = docs.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    n = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(n)
    if not langs:
        return LanguageModel([], np.zeros(((1 << bits) + 1, 0), dtype=np.float32), np.zeros(0))
    share = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, sample_per_lang / n[lang]))])
    chance = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("langid")), F.lit(1_000_003)) / 1_000_003.0
    sample = rows.filter(chance <= F.element_at(share, F.col("lang"))).select("lang", "text")
    sums = mapped(sample, _counts(bits), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros((1 << bits, len(langs)))
    got = sums.toArrow()
    at = {lang: i for i, lang in enumerate(langs)}
    counts[got["bucket"].to_numpy(), [at[x] for x in got["lang"].to_pylist()]] = got["n"].to_numpy()
    logp = np.log(counts + ALPHA) - np.log(counts.sum(axis=0) + ALPHA * (1 << bits))
    prior = np.log(np.array([n[lang] for lang in langs]) / sum(n.values()))
    learned = counts.sum(axis=0)
    level = np.where(learned >= LEAST_GRAMS, (counts * logp).sum(axis=0) / np.maximum(learned, 1), -np.inf)
    return LanguageModel(langs, np.vstack([logp, np.zeros((1, len(langs)))]).astype(np.float32), prior, level)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """`docs` with a column `language` of struct(lang_pred, score); see
    `LanguageModel.score`.  Only text is read for it."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, scores = held.value.score(batch["text"].to_pylist())
            found = pa.StructArray.from_arrays([pa.array(labels, pa.string()), pa.array(scores)], names=["lang_pred", "score"])
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, "language"])

    language = StructField("language", StructType.fromDDL("lang_pred string, score double"))
    return mapped(docs, emit, StructType([*docs.schema.fields, language]))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document: doc_id, held_out, lang_pred, score.

    Nulls: a null text, one without a letter and an empty one give `und` and 0; a
    null lang is not learned from; a null doc_id counts as not held out.  Texts of
    any length are scored whole, in pieces.  Repeated rows give repeated results,
    an empty table none; further columns are ignored."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = predict(docs.select("doc_id", "text"), fit(docs.select("doc_id", "text", "lang")))
    return found.select("doc_id", held_out().alias("held_out"), "language.lang_pred", "language.score")


def in_learned_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of `docs` that `LanguageModel.recognised` holds."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(held.value.recognised(batch["text"].to_pylist())))

    return mapped(docs, emit, docs.schema)
