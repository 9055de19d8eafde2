"""Language of a text by the nearest of several centroids.

A text is a normalised TF-IDF vector of hashed letter n-grams.  Document frequencies count all training
documents; a bounded sample of each language (about ``per_language`` texts, chosen by a hash of the id) is
clustered by spherical k-means into ``clusters`` centroids.  The language of the nearest centroid by
cosine is predicted; a text further from all of them than any training text of the sample but a small share
is flagged as rejected.

Null texts and texts without a letter are ``und`` with score 0 and rejected.  Repeated rows are judged alike, long
texts whole, other columns are not read.  Rows without a language teach nothing; with no training rows at all,
every text is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoalcast.llm.common import chunks, hash_rate
from shoalcast.llm.ngrams import hashed, letters_only

BITS = 13
SIZES = (1, 2, 3)
CLUSTERS = 4
PER_LANGUAGE = 600
REJECTED_SHARE = 0.002
SHARPNESS = 20.0
UNKNOWN = "und"


def counts(texts: list[str | None], bits: int) -> np.ndarray:
    symbols, owner = letters_only(texts)
    bucket, text = hashed(symbols, owner, SIZES, bits)
    return np.bincount(text << bits | bucket, minlength=len(texts) << bits).reshape(len(texts), 1 << bits)


def frequencies(bits: int):
    """Map texts to (bucket, documents, texts): how many texts of the task hold each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(1 << bits, np.int64), 0
        for batch in chunks(batches, "text", 1 << 19):
            for at in range(0, batch.num_rows, 256):
                part = batch.column("text").slice(at, 256).to_pylist()
                total += (counts(part, bits) > 0).sum(axis=0)
                seen += len(part)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(held, -1).astype(np.int32)), pa.array(np.append(total[held], seen))], names=["bucket", "n"]
        )

    return run


def vectors(texts: list[str | None], idf: np.ndarray, bits: int) -> np.ndarray:
    """Normalised TF-IDF rows; zero for a text without a letter."""
    out = np.log1p(counts(texts, bits).astype(np.float32)) * idf
    length = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out / np.where(length > 0, length, 1)


def spherical_means(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids; starts from rows far from each other, so the result depends on nothing random."""
    centre = rows.mean(axis=0)
    chosen = [int(np.argmax(rows @ centre))]
    nearest = rows @ rows[chosen[0]]
    while len(chosen) < min(k, len(rows)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, rows @ rows[chosen[-1]])
    means = rows[chosen]
    for _ in range(rounds):
        own = np.argmax(rows @ means.T, axis=1)
        moved = np.stack([rows[own == c].sum(axis=0) if (own == c).any() else means[c] for c in range(len(means))])
        length = np.linalg.norm(moved, axis=1, keepdims=True)
        means = moved / np.where(length > 0, length, 1)
    return means


def cluster(idf: np.ndarray, bits: int, clusters: int, share: float):
    """One language's sampled texts to its centroids and the similarity below which a text is foreign."""

    def run(group: pa.Table) -> pa.Table:
        texts = group.column("text").to_pylist()
        rows = np.concatenate([vectors(texts[i : i + 256], idf, bits) for i in range(0, len(texts), 256)])
        rows = rows[np.any(rows > 0, axis=1)]
        if not len(rows):
            return pa.table({"lang": pa.array([], pa.string()), "bound": pa.array([], pa.float64()), "centroid": pa.array([], pa.list_(pa.float32()))})
        means = spherical_means(rows, clusters)
        bound = float(np.quantile((rows @ means.T).max(axis=1), share))
        lang = group.column("lang")[0].as_py()
        return pa.table({"lang": [lang] * len(means), "bound": [bound] * len(means), "centroid": pa.array([m.tolist() for m in means], pa.list_(pa.float32()))})

    return run


@dataclass
class Model:
    idf: np.ndarray
    languages: list[str]
    centroids: np.ndarray
    bounds: np.ndarray
    bits: int


def train(docs: DataFrame, bits: int = BITS, clusters: int = CLUSTERS, per_language: int = PER_LANGUAGE) -> Model:
    """A model of (doc_id, text, lang) rows; rows without text or language are left out."""
    rows = docs.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    held = rows.select("text").mapInArrow(frequencies(bits), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    found = {r["bucket"]: r["n"] for r in held}
    total = found.pop(-1, 0)
    idf = np.zeros(1 << bits, np.float32)
    for bucket, n in found.items():
        idf[bucket] = np.log((1 + total) / (1 + n)) + 1
    rate = F.lit(0.0)
    for r in rows.groupBy("lang").count().collect():
        rate = F.when(F.col("lang") == r["lang"], F.lit(min(1.0, per_language / r["count"]))).otherwise(rate)
    sample = rows.where(hash_rate(F.concat_ws(" ", F.col("doc_id").cast("string"), "lang"), rate)).select("lang", "text")
    fitted = sample.groupBy("lang").applyInArrow(cluster(idf, bits, clusters, REJECTED_SHARE), "lang string, bound double, centroid array<float>")
    centroids = sorted((r["lang"], tuple(r["centroid"]), r["bound"]) for r in fitted.collect())
    return Model(
        idf,
        [c[0] for c in centroids],
        np.array([c[1] for c in centroids], np.float32).reshape(len(centroids), 1 << bits),
        np.array([c[2] for c in centroids]),
        bits,
    )


def judge(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = held.value
        names = sorted(set(model.languages))
        first = np.searchsorted(model.languages, names) if names else np.zeros(0, np.int64)
        for batch in chunks(batches, "text", 1 << 19):
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = vectors(part.column("text").to_pylist(), model.idf, model.bits)
                some = np.any(rows > 0, axis=1) & bool(names)
                lang, score, near = [UNKNOWN] * len(rows), np.zeros(len(rows)), np.zeros(len(rows))
                rejected = np.ones(len(rows), dtype=bool)
                if names:
                    best = np.maximum.reduceat(rows @ model.centroids.T, first, axis=1)
                    pick = best.argmax(axis=1)
                    near = best[np.arange(len(rows)), pick].astype(float)
                    share = np.exp(SHARPNESS * (best - best.max(axis=1, keepdims=True)))
                    score = np.where(some, 1 / share.sum(axis=1), 0.0)
                    lang = [names[p] if s else UNKNOWN for p, s in zip(pick, some)]
                    rejected = ~some | (near < model.bounds[first][pick])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(lang, pa.string()), pa.array(score.astype(float)), pa.array(near), pa.array(rejected)],
                    names=["doc_id", "lang_pred", "score", "similarity", "rejected"],
                )

    return run


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred (nearest language), score (its share among the languages, 0 to 1), similarity (cosine to
    the nearest centroid), rejected (too far from every centroid to belong to a known language)."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, lang_pred string, score double, similarity double, rejected boolean"
    return docs.select("doc_id", "text").mapInArrow(judge(held), schema)
