"""Benchmark decontamination with an FM-index for each shard of training text.

A shard is a run of documents of bounded bytes.  Its words become symbols, the runs of benchmark
words long enough to hold a phrase are indexed (suffix array, Burrows-Wheeler transform, wavelet matrix,
every eighth suffix position kept), all benchmark phrases are found by backward search at once, and
their occurrences, located over the sampled positions, merge into spans.  A word outside the
benchmark can be in no occurrence, so leaving such runs out loses nothing.

The benchmark goes to the tasks in blocks of at most ``block_bytes`` of text each, one after the
other in the same stage; documents are never shuffled.

Nulls, empty texts and texts without a word have no hits; so have all documents if the benchmark is
empty.  Benchmark items with the same id count as one; items without an id mark words but are not
listed.  Repeated rows are treated alike, other columns pass by.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoalcast.llm.common import ALNUM_PARTED, LOWER, Words, chunks, utf8

PHRASE = 10
SAMPLED = 8
BLOCK_BYTES = 16 << 20
SPANS = "array<struct<first:int,last:int,start:int,stop:int>>"


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes, by doubling the compared length."""
    _, rank = np.unique(symbols, return_inverse=True)
    rank = rank.astype(np.int64)
    n, length = len(symbols), 1
    while True:
        next_rank = np.zeros(n, np.int64)
        next_rank[: n - length] = rank[length:] + 1 if length < n else 0
        key = rank * (n + 1) + next_rank
        order = np.argsort(key, kind="stable")
        new = np.ones(n, dtype=np.int64)
        new[0] = 0
        new[1:] = key[order][1:] != key[order][:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        if rank[order[-1]] == n - 1:
            return order
        length *= 2


class WaveletMatrix:
    """Rank of any symbol at any place of a sequence, for arrays of queries."""

    def __init__(self, sequence: np.ndarray, bits: int):
        self.levels = []
        for bit in range(bits - 1, -1, -1):
            one = (sequence >> bit) & 1
            ones = np.concatenate([[0], np.cumsum(one)])
            self.levels.append((bit, ones, len(sequence) - int(ones[-1])))
            sequence = np.concatenate([sequence[one == 0], sequence[one == 1]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before ``place``."""
        first = np.zeros_like(place)
        for bit, ones, zeros in self.levels:
            up = (symbol >> bit) & 1 == 1
            first = np.where(up, zeros + ones[first], first - ones[first])
            place = np.where(up, zeros + ones[place], place - ones[place])
        return place - first


class FMIndex:
    """Index over symbols 1.. of a text whose separators are 0."""

    def __init__(self, text: np.ndarray, n_symbols: int, sampled: int = SAMPLED):
        # Every separator is a smallest symbol; the last one ends the text.
        self.order = suffix_array(text)
        self.bwt = text[self.order - 1]
        self.tree = WaveletMatrix(self.bwt, max(1, int(n_symbols).bit_length()))
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols + 1))])
        self.kept = self.order % sampled == 0
        self.position = np.where(self.kept, self.order, -1)

    def count(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [first, last) of each phrase; ``phrases`` is right-aligned, one in each row."""
        first, last = np.zeros(len(phrases), np.int64), np.full(len(phrases), len(self.bwt), np.int64)
        for back in range(1, phrases.shape[1] + 1):
            live = np.flatnonzero((lengths >= back) & (first < last))
            symbol = phrases[live, -back]
            first[live] = self.before[symbol] + self.tree.rank(symbol, first[live])
            last[live] = self.before[symbol] + self.tree.rank(symbol, last[live])
        return first, last

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows, walking back to a sampled one."""
        found = np.empty(len(rows), np.int64)
        todo, steps = np.arange(len(rows)), 0
        while len(todo):
            done = self.kept[rows]
            found[todo[done]] = self.position[rows[done]] + steps
            todo, rows = todo[~done], rows[~done]
            symbol = self.bwt[rows]
            rows = self.before[symbol] + self.tree.rank(symbol, rows)
            steps += 1
        return found


class Phrases:
    """The phrases of one block of benchmark items, as symbols of the block's words."""

    def __init__(self, items: list[tuple[str | None, str]], size: int):
        texts = pa.array([t or "" for _, t in items], pa.large_string())
        words = Words(LOWER[utf8(texts)[0]], utf8(texts)[1], ALNUM_PARTED)
        hashes = words.hashes()
        self.vocabulary = np.unique(hashes)
        symbol = np.searchsorted(self.vocabulary, hashes) + 1
        found: dict[tuple, set] = {}
        for i, (item, _) in enumerate(items):
            own = symbol[words.bounds[i] : words.bounds[i + 1]].tolist()
            for at in range(max(1, len(own) - size + 1) if own else 0):
                found.setdefault(tuple(own[at : at + size]), set()).add(item)
        self.items = [sorted(x for x in ids if x is not None) for ids in found.values()]
        self.lengths = np.array([len(p) for p in found], np.int64)
        self.shortest = int(self.lengths.min(initial=size))
        self.symbols = np.zeros((len(found), size), np.int64)
        for row, phrase in enumerate(found):
            self.symbols[row, size - len(phrase) :] = phrase


def occurrences(words: Words, hashes: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(first word, phrase number) of every occurrence of a phrase in the shard's texts."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(phrases.lengths) or not len(hashes):
        return none
    place = np.minimum(np.searchsorted(phrases.vocabulary, hashes), len(phrases.vocabulary) - 1)
    known = phrases.vocabulary[place] == hashes
    # Runs of benchmark words inside one text, kept if a phrase can fit.
    starts = known.copy()
    starts[1:] &= ~known[:-1] | (words.text[1:] != words.text[:-1])
    run = np.cumsum(starts) - 1
    kept = known.copy()
    kept[known] = np.bincount(run[known])[run[known]] >= phrases.shortest
    at = np.flatnonzero(kept)
    if not len(at):
        return none
    # One separator before each run and one at the end.
    shift = np.cumsum(starts[at]) + np.arange(len(at))
    text = np.zeros(shift[-1] + 2, np.int64)
    text[shift] = place[at] + 1
    origin = np.zeros(len(text), np.int64)
    origin[shift] = at
    index = FMIndex(text, len(phrases.vocabulary))
    first, last = index.count(phrases.symbols, phrases.lengths)
    number = np.repeat(np.arange(len(first)), np.maximum(last - first, 0))
    offset = np.arange(len(number)) - np.repeat(np.cumsum(np.maximum(last - first, 0)) - np.maximum(last - first, 0), np.maximum(last - first, 0))
    return origin[index.locate(first[number] + offset)], number


def search(block, size: int, columns: list[str]):
    """Add the hits of one block of the benchmark to __spans and __items of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases(block.value, size)
        # The word and index arrays take dozens of bytes for each byte of text: a shard is a small one.
        for batch in chunks(batches, "__text"):
            data, offsets = utf8(batch.column("__text"))
            words = Words(LOWER[data], offsets, ALNUM_PARTED)
            start, number = occurrences(words, words.hashes(), phrases)
            n = batch.num_rows
            # Words covered by any occurrence, then maximal runs of them.
            edge = np.zeros(len(words) + 1, np.int64)
            np.add.at(edge, start, 1)
            np.add.at(edge, start + phrases.lengths[number] if len(number) else start, -1)
            hit = np.cumsum(edge)[:-1] > 0
            first = hit.copy()
            first[1:] &= ~hit[:-1] | (words.text[1:] != words.text[:-1])
            final = hit.copy()
            final[:-1] &= ~hit[1:] | (words.text[1:] != words.text[:-1])
            firsts, finals = np.flatnonzero(first), np.flatnonzero(final)
            spans: list[list] = [[] for _ in range(n)]
            for i, j in zip(firsts.tolist(), finals.tolist()):
                t = int(words.text[i])
                low = int(words.bounds[t])
                spans[t].append((i - low, j - low, int(words.starts[i] - offsets[t]), int(words.ends[j] - offsets[t])))
            items: list[set] = [set() for _ in range(n)]
            pair = np.unique(np.stack([words.text[start], number]), axis=1) if len(number) else np.zeros((2, 0), np.int64)
            for t, k in pair.T.tolist():
                items[t].update(phrases.items[k])
            arrays = []
            for name in columns:
                old = batch.column(name)
                if name == "__spans":
                    merged = [[tuple(s.values()) for s in o] + m for o, m in zip(old.to_pylist(), spans)]
                    kind = pa.struct([(c, pa.int32()) for c in ("first", "last", "start", "stop")])
                    old = pa.array([[dict(zip(("first", "last", "start", "stop"), s)) for s in m] for m in merged], pa.list_(kind))
                elif name == "__items":
                    old = pa.array([sorted(m.union(o)) for o, m in zip(old.to_pylist(), items)], pa.list_(pa.string()))
                elif name == "__words":
                    old = pa.array(np.diff(words.bounds).astype(np.int64))
                arrays.append(old)
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return run


def merged(spans):
    """Sorted spans with overlapping and touching ones joined; ``stop`` follows the later end."""
    one = F.array_sort(spans)
    empty = F.lit(None).cast(SPANS)

    def add(done, span):
        tail = F.element_at(done, -1)
        touching = (F.size(done) > 0) & (tail["last"] + 1 >= span["first"])
        longer = F.struct(
            tail["first"].alias("first"),
            F.greatest(tail["last"], span["last"]).alias("last"),
            tail["start"].alias("start"),
            F.greatest(tail["stop"], span["stop"]).alias("stop"),
        )
        return F.when(touching, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(one, F.coalesce(empty, F.array().cast(SPANS)), add)


def mark(docs: DataFrame, benchmark: DataFrame, size: int = PHRASE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with __words (their number), __spans (word and byte bounds of removal spans) and __items
    (benchmark ids with an occurring phrase, sorted as strings)."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = int(total // block_bytes) + 1
    numbered = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    frame = (
        docs.withColumn("__text", F.col("text"))
        .withColumn("__words", F.lit(0).cast("long"))
        .withColumn("__spans", F.array().cast(SPANS))
        .withColumn("__items", F.array().cast("array<string>"))
    )
    schema = frame.schema
    for block in range(blocks):
        # About block_bytes of text, whatever the size of the benchmark.
        rows = [(r[0], r[1]) for r in numbered.where(F.col("block") == block).select("item_id", "text").collect()]
        held = docs.sparkSession.sparkContext.broadcast(rows)
        frame = frame.mapInArrow(search(held, size, frame.columns), schema)
    out = frame.drop("__text")
    return out if blocks == 1 else out.withColumn("__spans", merged(F.col("__spans")))


def without_spans(text, spans):
    """The text less the bytes of its removal spans; what is left on both sides keeps its own white space."""
    raw = text.cast("binary")
    starts = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["stop"]))
    stops = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.octet_length(text)))
    parts = F.transform(F.arrays_zip(starts.alias("a"), stops.alias("b")), lambda p: F.substring(raw, p["a"] + 1, p["b"] - p["a"]).cast("string"))
    return F.array_join(parts, "")
