"""Quality rules: counts of odd features, and a log-likelihood ratio of hashed n-grams.

Two multinomials over hashed character n-grams are counted, one over the trusted texts (labelled as
good) and one over all texts.  A document's verdict is the mean of log(trusted / raw) over its
n-grams against a threshold; the threshold is the one that best parts the labelled documents, found
on a fixed grid over all of them, so every document is judged by the same number.

Null texts count as empty: no words, base_failed.  Ties at the threshold are kept.  Repeated rows are judged
alike, texts whole; other columns are not read.  Without trusted texts the ratio is 0 for all and the base
rules alone decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoalcast.llm.common import SPACE_PARTED, U64, Words, chunks, mix, utf8
from shoalcast.llm.ngrams import codes, hashed
from shoalcast.session import cut_lineage

BITS = 16
SIZES = (2, 3)
SMOOTHING = 1.0
GRID = 0.01
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def texts_codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points with every run of white space as one blank; the text of each place."""
    raw, owner = codes(texts)
    blank = (raw == 0) | (raw == 32) | ((raw >= 9) & (raw <= 13))
    symbols = np.where(blank, 32, raw)
    kept = ~blank
    kept[1:] |= ~blank[:-1]
    return symbols[kept], owner[kept]


def grams(texts: list[str | None], bits: int) -> tuple[np.ndarray, np.ndarray]:
    return hashed(*texts_codes(texts), SIZES, bits)


def counted(bits: int):
    """Map (text, trusted) to (bucket, trusted count, raw count) of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trusted, raw = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
        for batch in chunks(batches, "text"):
            bucket, text = grams(batch.column("text").to_pylist(), bits)
            good = batch.column("trusted").fill_null(False).to_numpy(zero_copy_only=False)
            raw += np.bincount(bucket, minlength=1 << bits)
            trusted += np.bincount(bucket[good[text]], minlength=1 << bits)
        held = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held.astype(np.int32)), pa.array(trusted[held]), pa.array(raw[held])], names=["bucket", "trusted", "raw"]
        )

    return run


def trusted_texts(docs: DataFrame, good: DataFrame) -> DataFrame:
    """(text, trusted) of every row.

    The labels grow with the documents: they are merged at any size, never broadcast, so the texts are shuffled once
    and the shuffle grows as the input does.
    """
    return docs.select("doc_id", "text").join(good.hint("merge"), "doc_id", "left").select("text", "trusted")


def ratios(docs: DataFrame, labels: DataFrame, bits: int = BITS) -> np.ndarray:
    """log(trusted / raw) of each bucket, smoothed; zeros without trusted texts."""
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct().withColumn("trusted", F.lit(True))
    rows = trusted_texts(docs, good).mapInArrow(counted(bits), "bucket int, trusted long, raw long")
    # 2^bits rows at most, whatever the corpus.
    table = rows.groupBy("bucket").agg(F.sum("trusted").alias("trusted"), F.sum("raw").alias("raw")).toArrow()
    trusted, raw = np.zeros(1 << bits), np.zeros(1 << bits)
    bucket = table.column("bucket").to_numpy()
    trusted[bucket], raw[bucket] = table.column("trusted").to_numpy(), table.column("raw").to_numpy()
    if not trusted.sum():
        return np.zeros(1 << bits)
    size = 1 << bits
    return np.log((trusted + SMOOTHING) / (trusted.sum() + SMOOTHING * size)) - np.log((raw + SMOOTHING) / (raw.sum() + SMOOTHING * size))


def repeated(hashes: np.ndarray, text: np.ndarray, size: int) -> np.ndarray:
    """True for words in a window of ``size`` words that occurs twice or more in its text, first included."""
    out = np.zeros(len(hashes), dtype=bool)
    n = len(hashes) - size + 1
    if n <= 0:
        return out
    value = np.zeros(n, U64)
    for j in range(size):
        value = value * U64(0xD6E8FEB86659FD93) + hashes[j : j + n]
    whole = np.flatnonzero(text[:n] == text[size - 1 :])
    key = mix(mix(value[whole]) + text[whole].astype(U64) * U64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(whole), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    for j in range(size):
        out[whole[twice] + j] = True
    return out


def base_counts(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The base features of each text, in the order of BASE."""
    n = len(offsets) - 1
    words = Words(data, offsets, SPACE_PARTED)
    hashes = words.hashes()

    def per_text(truth: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(truth)])
        return total[offsets[1:]] - total[offsets[:-1]]

    lead = (data & 0xC0) != 0x80
    repeat = np.bincount(words.text[repeated(hashes, words.text, 5)], minlength=n)
    # Lines as words of their own: hashes of the bytes between line feeds.
    lines = Words(data, offsets, np.arange(256) != 10)
    line = lines.hashes()
    with_word = np.zeros(len(line), dtype=bool)
    if len(line) and len(words):
        with_word[np.unique(np.searchsorted(lines.starts, words.starts, "right") - 1)] = True
    key = mix(line + lines.text.astype(U64) * U64(0x9E3779B97F4A7C15))[with_word]
    text = lines.text[with_word]
    _, first = np.unique(key, return_index=True)
    duplicate = np.bincount(text, minlength=n) - np.bincount(text[first], minlength=n)
    return [np.diff(words.bounds), per_text(words.inside & lead), per_text(SYMBOLS[data]), duplicate, repeat]


def measured(held, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = held.value
        for batch in chunks(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            bucket, text = grams(batch.column("text").to_pylist(), bits)
            n = batch.num_rows
            total = np.bincount(text, ratio[bucket], n) / np.maximum(np.bincount(text, minlength=n), 1)
            columns = [pa.array(c.astype(np.int64)) for c in base_counts(data, offsets)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns, pa.array(total.astype(float))], names=["doc_id", *BASE, "ratio"])

    return run


def threshold(measures: DataFrame, labels: DataFrame, grid: float = GRID) -> float:
    """The grid point with the best mean of recall of good and of bad labelled documents; the lowest of equals.
    -inf without labels of both kinds: nothing is rejected then."""
    marked = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    step = F.floor(F.col("ratio") / grid)
    rows = measures.join(marked, "doc_id").groupBy(step.alias("step"), "quality").count().collect()
    good = {r["step"]: r["count"] for r in rows if r["quality"] == 1}
    bad = {r["step"]: r["count"] for r in rows if r["quality"] == 0}
    if not good or not bad:
        return float("-inf")
    best, at = -1.0, float("-inf")
    kept, dropped = sum(good.values()), 0
    for place in sorted({*good, *bad}):
        value = kept / sum(good.values()) + dropped / sum(bad.values())
        if value > best:
            best, at = value, place * grid
        kept -= good.get(place, 0)
        dropped += bad.get(place, 0)
    return at


def judge(docs: DataFrame, labels: DataFrame, bits: int = BITS) -> DataFrame:
    """doc_id, the base features, base_failed, ratio (mean log-likelihood ratio), kept."""
    held = docs.sparkSession.sparkContext.broadcast(ratios(docs, labels, bits))
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in BASE) + ", ratio double"
    measures = cut_lineage(docs.select("doc_id", "text").mapInArrow(measured(held, bits), schema))
    bound = threshold(measures, labels)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return measures.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("ratio") >= F.lit(bound)))
