"""Draws of a bootstrap summed by cell, on arrays of rows by draws.

The numbers are those of ``draws`` (a digest of key and draw, cut at Poisson or binomial probabilities); here a task
holds them for a batch of rows and all draws at once and adds them up by cell, so no row is made for each draw.
Rows are range partitioned by cell and key: a cell lies together, and one with half of all rows in many parts.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LANES = 1 << 14
SHIFTS = [7, 12, 17, 22] * 4 + [5, 9, 14, 20] * 4 + [4, 11, 16, 23] * 4 + [6, 10, 15, 21] * 4
SINES = np.floor(np.abs(np.sin(np.arange(1, 65))) * 2**32).astype(np.uint32)
START = [np.uint32(x) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]


def md5_heads(keys: Sequence[bytes], draws: int) -> np.ndarray:
    """The first 32 bits of the MD5 of ``key-draw`` for every key and draw from 1, as numbers: keys x draws.

    MD5 is rounds of arithmetic on 32-bit words, done here for many messages of one length at a time; a message that
    does not fit one block of it goes to hashlib.
    """
    out = np.empty((len(keys), draws), np.uint32)
    ends = [f"-{d}".encode() for d in range(1, draws + 1)]
    sizes = np.array([len(k) for k in keys], np.int64)
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        if size + len(ends[-1]) > 55:
            for i in at:
                out[i] = [int.from_bytes(hashlib.md5(keys[i] + end).digest()[:4], "big") for end in ends]
            continue
        head, tail = np.zeros((len(at), 64), np.uint8), np.zeros((draws, 64), np.uint8)
        head[:, :size] = np.frombuffer(b"".join(keys[i] for i in at), np.uint8).reshape(len(at), size)
        for d, end in enumerate(ends):
            last = size + len(end)
            tail[d, size:last] = list(end)
            tail[d, last], tail[d, 56], tail[d, 57] = 128, last * 8 & 255, last * 8 >> 8
        head, tail = head.view("<u4"), tail.view("<u4")
        step = max(1, LANES // draws)
        for first in range(0, len(at), step):
            mine = at[first : first + step]
            out[mine] = _block(head[first : first + step], tail)
    return out


def _block(head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    shape = (len(head), len(tail))
    words = [
        tail[None, :, w] if w * 4 >= 56 or not head[:, w].any() else head[:, w, None] | tail[None, :, w] if tail[:, w].any() else head[:, w, None]
        for w in range(16)
    ]
    a, b, c, d = (np.full(shape, x, np.uint32) for x in START)
    f, spare = np.empty(shape, np.uint32), np.empty(shape, np.uint32)
    for i in range(64):
        if i < 16:
            word = i
            np.bitwise_xor(c, d, out=f)
            f &= b
            f ^= d
        elif i < 32:
            word = (5 * i + 1) % 16
            np.bitwise_xor(b, c, out=f)
            f &= d
            f ^= c
        elif i < 48:
            word = (3 * i + 5) % 16
            np.bitwise_xor(b, c, out=f)
            f ^= d
        else:
            word = 7 * i % 16
            np.invert(d, out=f)
            f |= b
            f ^= c
        f += a
        f += SINES[i]
        f += words[word]
        np.left_shift(f, np.uint32(SHIFTS[i]), out=spare)
        f >>= np.uint32(32 - SHIFTS[i])
        f |= spare
        f += b
        a, d, c, b, f = d, c, b, f, a
    a += START[0]
    return a.byteswap()


def poisson_weights(keys: Sequence[bytes], draws: int, cuts: Sequence[float]) -> np.ndarray:
    """Weights of ``with_draws`` under md5, keys x draws."""
    heads = md5_heads(keys, draws)
    out = np.zeros(heads.shape, np.uint8)
    for mark in (math.ceil(cut * 2**32) for cut in cuts):
        if mark < 2**32:
            out += heads >= np.uint32(mark)
    return out


def binomial_numbers(keys: Sequence[bytes], draws: int, trials: np.ndarray, rate: np.ndarray, most: int) -> np.ndarray:
    """Numbers of ``binomial_draw`` under md5, keys x draws."""
    out = np.zeros((len(keys), draws), np.int64)
    held = np.where(np.isnan(rate), 1 - 1e-12, np.minimum(np.maximum(rate, 0.0), 1 - 1e-12))
    for part in range(max(1, math.ceil(trials.max(initial=0) / most))):
        mine = np.flatnonzero(trials > part * most)
        if not len(mine):
            continue
        size, p = np.minimum(trials[mine] - part * most, most), held[mine]
        uniform = md5_heads([keys[i] + f".{part}".encode() for i in mine], draws) / 2.0**32
        ratio = p / (1 - p)
        term = (1 - p) ** size
        below, found, top = term.copy(), np.zeros(uniform.shape, np.int64), uniform.max()
        for i in range(1, int(size.max()) + 1):
            if below.min() > top:
                break
            found += (below[:, None] <= uniform) & (i <= size)[:, None]
            term = term * (size - i + 1) / i * ratio
            below = below + term
        out[mine] += found
    return out


def in_cells(df: DataFrame, key: str, keys: Sequence[str], dealt: bool) -> DataFrame:
    """Rows with those of a cell next to each other, in parts of equal size if ``dealt``, else where they are."""
    if not dealt:
        return df.sortWithinPartitions(*keys)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(parts, *keys, key).sortWithinPartitions(*keys)


def cell_starts(batch: pa.RecordBatch, keys: Sequence[str]) -> np.ndarray:
    """Where a row's cell is another than that of the row before."""
    new = np.zeros(batch.num_rows, bool)
    new[:1] = True
    for name in keys:
        codes = batch.column(name).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)


def summed_by_cell(
    df: DataFrame, key: str, keys: Sequence[str], names: Sequence[str], draws: int, sums: Callable[[pa.RecordBatch, list[bytes], np.ndarray], tuple], dealt: bool = True
) -> DataFrame:
    """Sums ``names`` by ``keys`` and draw.  ``sums`` gives, for the runs of cells of a batch, which of them a draw has
    (cells x draws) and for each name the sums and where there is one."""
    row = df.select(*keys).schema
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in row.fields], "draw int", *[f"`{n}` double" for n in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            starts = cell_starts(batch, keys)
            present, found = sums(batch, [k.encode() for k in batch.column(key).to_pylist()], starts)
            cell, draw = np.nonzero(present)
            place = pa.array(starts[cell])
            columns = [batch.column(k).take(place) for k in keys] + [pa.array(draw.astype(np.int32) + 1)]
            columns += [pa.array(total[cell, draw], mask=~known[cell, draw]) for total, known in found]
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, "draw", *names])

    parts = in_cells(df, key, keys, dealt).mapInArrow(run, schema)
    # A cell may go on in the next batch or part.
    return parts.groupBy(*keys, "draw").agg(*[F.sum(n).alias(n) for n in names])


def added(rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(rows, starts, axis=0)


def weighted_sums(df: DataFrame, key: str, keys: Sequence[str], draws: int, sums: dict[str, Column], cuts: Sequence[float], dealt: bool = True) -> DataFrame:
    """``sums`` of columns times the Poisson weight of their unit, by ``keys`` and draw, under md5.

    A cell has a row for each draw in which one of its units occurs; sums skip missing values, as Spark's do.
    """
    narrow = df.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("__key"), *keys, *[c.cast("double").alias(n) for n, c in sums.items()])
    names = list(sums)

    def of(batch, units, starts):
        weights = poisson_weights(units, draws, cuts).astype(np.float64)
        size, found = added(weights, starts), []
        for name in names:
            column = batch.column(name)
            values, known = column.fill_null(0.0).to_numpy(zero_copy_only=False), size > 0
            if column.null_count:
                known = added(weights * column.is_valid().to_numpy(zero_copy_only=False)[:, None], starts) > 0
            rows = weights * values[:, None]
            if not np.isfinite(values).all():
                rows[weights == 0] = 0.0
            found.append((added(rows, starts), known))
        return size > 0, found

    return summed_by_cell(narrow, "__key", keys, names, draws, of, dealt)


def binomial_sums(df: DataFrame, key: Column, keys: Sequence[str], draws: int, n: str, rate: str, out: str, most: int) -> DataFrame:
    """Trials ``n`` and their simulated successes ``out`` summed by ``keys`` and draw, under md5."""
    narrow = df.select(F.coalesce(key.cast("string"), F.lit("")).alias("__key"), *keys, F.col(n).cast("double").alias("__n"), F.coalesce(F.col(rate), F.lit(0.0)).alias("__p"))

    def of(batch, units, starts):
        column = batch.column("__n")
        trials, known = column.fill_null(0.0).to_numpy(zero_copy_only=False), column.is_valid().to_numpy(zero_copy_only=False)
        # As in ``binomial_draw``, one whole part is drawn where the trials are missing.
        numbers = binomial_numbers(units, draws, np.where(known, trials, most), batch.column("__p").to_numpy(zero_copy_only=False), most)
        every = np.ones((len(starts), draws), bool)
        some = (added(known.astype(np.int64), starts) > 0)[:, None] & every
        return every, [(added(trials, starts)[:, None] * every, some), (added(numbers, starts).astype(np.float64), every)]

    return summed_by_cell(narrow, "__key", keys, [n, out], draws, of)
