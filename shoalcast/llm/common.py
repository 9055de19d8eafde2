"""Helpers the operators share: tables, folds and word arrays over Arrow text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id written as text, modulo ``folds``; null ids give null."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def hash_rate(column: Column | str, rate: Column | float) -> Column:
    """True for about ``rate`` of the ids, the same ones on every run."""
    spread = F.pmod(F.xxhash64(column), F.lit(1 << 30)) / float(1 << 30)
    return spread < rate


def bytes_class(pattern_is_word) -> np.ndarray:
    """Truth of a predicate for each byte value."""
    return np.array([bool(pattern_is_word(b)) for b in range(256)])


# Fixed by contract: white space 09-0D and 20 parts words; or anything but digits, letters and
# non-ASCII bytes does.
SPACE_PARTED = bytes_class(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
ALNUM_PARTED = bytes_class(lambda b: 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)


def u64(x: int) -> np.uint64:
    return U64(x & 0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE_VALUE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
WORD_BASE = U64(0x9E6C63D0876A9A47)


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets of each; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offset_buffer, data = column.buffers()
    n = len(column)
    if n == 0 or offset_buffer is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(offset_buffer, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    values = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return values[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], column: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that ``column`` holds at most ``most`` bytes, or one row."""
    for batch in batches:
        _, offsets = utf8(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
            yield batch.slice(at, end - at)
            at = end


class Words:
    """Words of a batch of texts: byte positions, bounds for each text and 64-bit hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray):
        self.data = data
        inside = word_byte[data]
        before = np.empty(len(data) + 1, dtype=bool)
        before[0] = False
        before[1:] = inside
        text_starts = offsets[:-1][offsets[:-1] < len(data)]
        first = inside & ~before[:-1]
        first[text_starts] = inside[text_starts]
        after = np.empty(len(data) + 1, dtype=bool)
        after[-1] = True
        after[:-1] = ~inside
        after[text_starts] = True
        self.inside, self.first = inside, first
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(inside & after[1:]) + 1
        self.bounds = np.searchsorted(self.starts, offsets)  # words of text i: bounds[i]..bounds[i+1]
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(self.bounds))

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, prefix: int | None = None) -> np.ndarray:
        """Hash of each word, or of its first ``prefix`` bytes (whole words only as long)."""
        if not len(self):
            return np.zeros(0, U64)
        place = np.arange(len(self.data)) - self.starts[np.maximum(np.cumsum(self.first) - 1, 0)]
        counted = self.inside if prefix is None else self.inside & (place < prefix)
        place = np.where(counted, place, 0)
        value = BYTE_VALUE[self.data] * powers(WORD_BASE, int(place.max()) + 1)[place]
        value[~counted] = 0
        return mix(np.add.reduceat(value, self.starts) + U64(prefix or 0))


def shingles(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive words and the text of each; shorter texts give one of all their words."""
    counts = np.diff(bounds)
    text = np.repeat(np.arange(len(counts)), counts)
    out, owner = np.zeros(0, U64), np.zeros(0, np.int64)
    base = U64(0xD6E8FEB86659FD93)
    if len(hashes) >= size:
        n = len(hashes) - size + 1
        value = np.zeros(n, U64)
        for j in range(size):
            value = value * base + hashes[j : j + n]
        whole = text[:n] == text[size - 1 :]
        out, owner = mix(value[whole]), text[:n][whole]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        extra = []
        for i in short:
            value = 0
            for h in hashes[bounds[i] : bounds[i + 1]]:
                value = value * int(base) + int(h)
            extra.append(u64(value + int(counts[i])))
        out = np.concatenate([out, mix(np.array(extra, U64))])
        owner = np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        out, owner = out[order], owner[order]
    return out, owner
