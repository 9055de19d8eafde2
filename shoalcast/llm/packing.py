"""Packing of tokenised documents into sequences by Karmarkar-Karp multiway differencing.

A document's ids are cut into full windows, which are sequences of their own, and a rest.  Rests are
cut into pieces of at most ``PIECE`` ids and pooled; the pool's pieces go to the fewest windows
that differencing keeps within capacity.  Pools are filled in scan order inside a scan task, so
nothing is shuffled, no pool grows with the data, and a task run again gives the same rows.

Null and empty texts hold the end id alone; documents without an id are packed as well and have a null
doc_id; repeated rows are packed as often as they occur; other columns are not read; an empty table
gives no rows.
"""

from __future__ import annotations

import heapq
import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

WINDOW = 1024
PIECE = 256
POOL_WINDOWS = 192
END_ID = 0

# Fixed value: how byte-level vocabularies of this family cut text before merging.
BYTE_LEVEL_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


def differencing(sizes: list[int], ways: int) -> list[list[int]]:
    """Spread items over ``ways`` windows with near-equal sums: the two partial partitions with the
    largest spreads merge, the heavier windows of one with the lighter ones of the other.

    A partition lists its non-empty windows (sum, items) from heavy to light; the rest are empty.
    """
    heap = [(-size, i, [(size, (i,))]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    tag = len(sizes)
    while len(heap) > 1:
        _, _, one = heapq.heappop(heap)
        _, _, two = heapq.heappop(heap)
        overlap = len(one) + len(two) - ways
        if overlap <= 0:
            merged = one + two
        else:
            merged = one[: len(one) - overlap] + two[: len(two) - overlap]
            lighter = one[len(one) - overlap :]
            merged += [(a[0] + b[0], a[1] + b[1]) for a, b in zip(lighter, reversed(two[len(two) - overlap :]))]
        merged.sort(key=lambda window: -window[0])
        spread = merged[0][0] - (merged[-1][0] if len(merged) == ways else 0)
        heapq.heappush(heap, (-spread, tag, merged))
        tag += 1
    return [list(items) for _, items in heap[0][2]] if heap else []


def windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Differencing over the least number of windows, raised while any of them exceeds ``capacity``."""
    ways = max(1, -(-sum(sizes) // capacity))
    while True:
        found = differencing(sizes, ways)
        if all(sum(sizes[i] for i in items) <= capacity for items in found):
            return found
        ways += 1


def byte_of_character() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: visible Latin-1 stands for itself, the rest from 256 up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def encoder(path: str):
    """A function from texts to id lists, equal to the tokenizer file's own encoding without special tokens added.

    Plain byte-level BPE files are run by a faster library over the same vocabulary; other
    files, and texts that spell an added token, go to the tokenizer itself.
    """
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    spec = json.load(open(path, encoding="utf-8"))
    slow = Tokenizer.from_file(path)
    added = [t["content"] for t in spec.get("added_tokens", [])]
    split = spec.get("pre_tokenizer") or {}
    model = spec["model"]
    plain = (
        split.get("type") == "ByteLevel"
        and not split.get("add_prefix_space")
        and split.get("use_regex", True)
        and not spec.get("normalizer")
        and model.get("type") == "BPE"
        and not model.get("dropout")
        and not model.get("ignore_merges")
    )
    if plain:
        import tiktoken

        table = byte_of_character()
        ranks = {bytes(table[c] for c in token): i for token, i in model["vocab"].items() if token not in added}
        fast = tiktoken.Encoding("byte-level", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        if plain and not any(token in text for token in added):
            return fast.encode_ordinary(text)
        return slow.encode(text, add_special_tokens=False).ids

    return encode


def pack_batches(tokenizer_path: str, window: int, piece: int, pool_windows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path)
        # Sequence numbers of different scan tasks never meet.
        number = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []
        pool: list[tuple] = []
        pooled = 0

        def emit(doc, start, ids, total, sequence, offset):
            rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total, sequence, offset))

        def settle():
            nonlocal number, pool, pooled
            for items in windows([len(x[2]) for x in pool], window):
                offset = 0
                for i in items:
                    emit(*pool[i], number, offset)
                    offset += len(pool[i][2])
                number += 1
            pool, pooled = [], 0

        def drained():
            nonlocal rows
            columns = list(zip(*rows)) or [()] * 7
            rows = []
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=COLUMNS)

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = np.array([*encode(text.as_py() or ""), END_ID], dtype="<u4")
                full = len(ids) - len(ids) % window
                for start in range(0, full, window):
                    emit(doc, start, ids[start : start + window], len(ids), number, 0)
                    number += 1
                for start in range(full, len(ids), piece):
                    pool.append((doc, start, ids[start : start + piece], len(ids)))
                    pooled += len(pool[-1][2])
                if pooled >= pool_windows * window:
                    settle()
                if len(rows) >= 20_000:
                    yield drained()
        settle()
        yield drained()

    return run


COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, piece: int = PIECE, pool_windows: int = POOL_WINDOWS) -> DataFrame:
    """One row for each piece: which ids of which document lie where in which sequence."""
    schema = ", ".join(f"{c} long" for c in COLUMNS)
    return docs.select("doc_id", "text").mapInArrow(pack_batches(tokenizer_path, window, piece, pool_windows), schema)
