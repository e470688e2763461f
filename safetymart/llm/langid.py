"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from safetymart.llm.common import LOWER, row_chunks, text_bytes, unused

# Buckets that n-grams of 1 to ``N_MAX`` characters are hashed to; the matrix of a
# model has so many rows for each language.
BITS, N_MAX = 16, 3
BUCKETS = 1 << BITS
# Labelled documents that a model is fitted on, about so many at most.
MAX_TRAINING = 50_000
CHUNK_BYTES = 1 << 20
UNDETERMINED = "und"

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_LOWER = np.frombuffer(LOWER, np.uint8)


def gram_buckets(data: np.ndarray, starts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """For n = 1, 2, ... the bucket of the n-gram at each character, and where texts start.

    ``data`` are UTF-8 bytes of adjoining texts, ``starts`` the byte each text
    starts at and the end. An n-gram that would reach into the next text has
    bucket ``BUCKETS``, which no model counts.
    """
    chars = np.frombuffer(_LOWER[data].tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4")
    begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[starts - starts[0]]
    codes = chars.astype(np.uint64)
    grams, mixed = [], np.zeros(len(codes), np.uint64)
    for n in range(1, N_MAX + 1):
        mixed = mixed[: len(mixed) - (n > 1)] if n > 1 else mixed
        mixed = (mixed + codes[n - 1 :]) * _MULTIPLIERS[(n - 1) % len(_MULTIPLIERS)]
        bucket = np.full(len(codes), BUCKETS, np.int32)
        bucket[: len(mixed)] = (mixed ^ (mixed >> np.uint64(29))) * _MULTIPLIERS[0] >> np.uint64(64 - BITS)
        for back in range(1, n):
            late = begins[1:] - back
            bucket[late[late >= begins[:-1]]] = BUCKETS
        grams.append(bucket)
    return grams, begins


@dataclass
class LanguageModel:
    """``log_prob[bucket, language]`` and each language's log share of documents."""

    languages: list[str]
    log_prob: np.ndarray
    log_prior: np.ndarray

    def scores(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Log likelihood of each text in each language; texts by languages."""
        grams, begins = gram_buckets(data, starts)
        out = np.tile(self.log_prior, (len(starts) - 1, 1))
        some = np.flatnonzero(np.diff(begins))
        if len(some):
            for bucket in grams:
                for k in range(len(self.languages)):
                    out[some, k] += np.add.reduceat(
                        self.log_prob[k][bucket], begins[some], dtype=np.float64
                    )
        return out


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    n_docs: dict[str, int] = {}
    for batch in batches:
        labels = np.array(batch.column(1).to_pylist(), object)
        for label in set(labels):
            mine = batch.column(0).take(pa.array(np.flatnonzero(labels == label)))
            data, starts = text_bytes(mine)
            total = counts.setdefault(label, np.zeros(BUCKETS + 1, np.int64))
            n_docs[label] = n_docs.get(label, 0) + len(mine)
            for a, b in row_chunks(starts, CHUNK_BYTES):
                own = starts[a : b + 1]
                for bucket in gram_buckets(data[own[0] : own[-1]], own)[0]:
                    total += np.bincount(bucket, minlength=BUCKETS + 1)
    for label, total in counts.items():
        total[BUCKETS] = n_docs[label]  # the last place holds the documents
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([label] * len(at)), pa.array(at, pa.int32()), pa.array(total[at])],
            names=["language", "bucket", "n"],
        )


def fit(
    docs: DataFrame,
    labels: Column,
    text_col: str = "text",
    id_col: str = "doc_id",
    max_training: int = MAX_TRAINING,
    smoothing: float = 0.1,
) -> LanguageModel:
    """A model from the rows of ``docs`` whose label is not null.

    Of more than ``max_training`` labelled rows, those with a small hash of their
    id are taken, about so many. Counts are added up by Spark; what reaches the
    driver is a number for each language and bucket.
    """
    label, text = unused(docs, "label"), F.coalesce(text_col, F.lit(""))
    rows = docs.select(text.alias("text"), labels.alias(label), F.col(id_col).alias("id"))
    rows = rows.filter(F.col(label).isNotNull())
    n = rows.count()
    if n > max_training:
        share = int(max_training / n * 2**32)
        rows = rows.filter(F.pmod(F.xxhash64("id"), F.lit(2**32)) < share)
    counted = rows.select("text", label).mapInArrow(
        _count_batches, "language string, bucket int, n bigint"
    )
    sums = counted.groupBy("language", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(sums["language"].unique())
    totals = np.zeros((len(languages), BUCKETS + 1))
    totals[np.searchsorted(languages, sums["language"]), sums["bucket"]] = sums["n"]
    n_docs, totals = totals[:, BUCKETS].copy(), totals + smoothing
    totals[:, BUCKETS] = 0
    log_prob = np.zeros(totals.shape, np.float32)
    log_prob[:, :BUCKETS] = np.log(
        totals[:, :BUCKETS] / totals[:, :BUCKETS].sum(axis=1, keepdims=True)
    )
    return LanguageModel(languages, log_prob, np.log(n_docs / n_docs.sum()))


def predict(
    docs: DataFrame, model: LanguageModel, text_col: str = "text", into: str = "language"
) -> DataFrame:
    """``docs`` with a struct ``into``: lang_pred and score.

    The language is the most probable one, the score its posterior probability. A
    text that is null or has no letter is ``und`` with score 0, and so is every
    text when there was nothing to learn from; of equally probable languages the
    first in the alphabet is taken. No shuffle; the model is broadcast, its size
    is ``BUCKETS`` numbers for each language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            column = batch.column(text_col)
            data, starts = text_bytes(column)
            names, scores = [], []
            for a, b in row_chunks(starts, CHUNK_BYTES):
                part = starts[a : b + 1]
                if own.languages:
                    raw = own.scores(data[part[0] : part[-1]], part)
                    best = raw.argmax(axis=1)
                    certain = 1 / np.exp(raw - raw.max(axis=1, keepdims=True)).sum(axis=1)
                for i in range(b - a):
                    text = column[a + i].as_py()
                    known = own.languages and text and any(map(str.isalpha, text))
                    names.append(own.languages[best[i]] if known else UNDETERMINED)
                    scores.append(float(certain[i]) if known else 0.0)
            result = pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["lang_pred", "score"],
            )
            columns = [c for c in batch.schema.names if c != into]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, columns), result], names=[*columns, into]
            )

    docs = docs.drop(into)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(
        run, f"{fields}, `{into}` struct<lang_pred:string,score:double>"
    )


def identified(
    docs: DataFrame,
    languages: list[str] | None = None,
    min_score: float = 0.0,
    fold: Column | None = None,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
) -> DataFrame:
    """The documents whose language is known, and one of ``languages`` if given.

    Rejected are texts without letters, texts below ``min_score`` and other
    languages. ``fold`` says which labelled rows to learn from (default: all).
    Same columns as ``docs``.
    """
    label = F.col(lang_col) if fold is None else F.when(fold, F.col(lang_col))
    into = unused(docs, "language")
    found = predict(docs, fit(docs, label, text_col, id_col), text_col, into)
    good = (F.col(f"{into}.lang_pred") != UNDETERMINED) & (F.col(f"{into}.score") >= min_score)
    if languages is not None:
        good = good & F.col(f"{into}.lang_pred").isin(languages)
    return found.filter(good).select(*docs.columns)
