"""Hard negatives by an inverted multi-index with certified stops.

Vectors are scaled to integers, floor(256 x), and cut into two halves.  Each half has a codebook; the pair of
nearest centroids is a vector's cell.  The score of an anchor with any vector of a cell is at most the sum over
the halves of (anchor . centroid + |anchor| * radius), the radius being the largest distance of a vector in the
chunk from that centroid.  For each anchor a heap walks the pairs of centroids from the largest sum
down (multi-sequence order) and scores whole cells, until the next sum is below what is already
found: the window is then certified, and the result is exact.

Codebooks are fitted on at most ``SAMPLE`` vectors; every vector is indexed.  Vectors are written once, range
partitioned and sorted by cell (a cell of any size is cut by the hash of its rows), and each task walks its vectors in
chunks of at most ``CHUNK`` with all anchors of a block.  Anchors go out in blocks of about ``ANCHORS``, one
broadcast at a time (so many rows of the vectors' width at most); a task sends its first few for each anchor,
which meet by anchor with a limit before the shuffle.  A first walk finds the positives, a second one
their negatives, as the windows depend on the positive scores.

Rows with a null label, a null vector or a null or non-finite component take no part.  A shorter vector counts as
padded with zeros; a component beyond +-2^28 after scaling counts as that.  Rows without an id are no anchors and
come last among equal scores.  Rows that repeat an id count each, also as anchors.  Equal scores go by the smaller id.  An
empty table gives no rows.  Other columns are not read.  Chunks hold fewer vectors, the wider these are.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoalcast.session import cut_lineage, drop_written

CENTROIDS = 16
SAMPLE = 8192
CHUNK = 32_768  # vectors of a chunk, and components
COMPONENTS = 1 << 21
ANCHORS = 20_000
CELLS_AT_ONCE = 16
PART_ROWS = 20_000
LARGEST = float(1 << 28)
POSITIVES, NEGATIVES = 5, 3
NO_ID = np.iinfo(np.int64).max


def scaled(vectors: pa.ListArray | pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of floor(256 x), padded with zeros to ``width``."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
    return np.clip(np.floor(out * 256), -LARGEST, LARGEST)


def nearest(rows: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.argmax(rows @ book.T - (book * book).sum(axis=1) / 2, axis=1)


def codebook(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids of Lloyd's rounds; starts are spread over the distinct rows."""
    distinct = np.unique(rows, axis=0)
    book = distinct[np.linspace(0, len(distinct) - 1, min(k, len(distinct))).astype(int)]
    for _ in range(rounds):
        own = nearest(rows, book)
        size = np.bincount(own, minlength=len(book))
        total = np.zeros_like(book)
        np.add.at(total, own, rows)
        book = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], book)
    return book


class Index:
    """The vectors of one chunk by cell, with both codebooks and the radii of this chunk."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, books: tuple[np.ndarray, np.ndarray]):
        self.half = books[0].shape[1]
        one, two = rows[:, : self.half], rows[:, self.half :]
        first, second = nearest(one, books[0]), nearest(two, books[1])
        order = np.lexsort((ids, second, first))
        self.ids, self.labels, self.rows = ids[order], labels[order], rows[order]
        first, second = first[order], second[order]
        self.books = books
        self.radii = [self.radius(part[order], cell, book) for part, cell, book in ((one, first, books[0]), (two, second, books[1]))]
        cells = first * len(books[1]) + second
        starts = np.flatnonzero(np.diff(cells, prepend=-1))
        self.spans = {(int(c) // len(books[1]), int(c) % len(books[1])): (int(a), int(b)) for c, a, b in zip(cells[starts], starts, [*starts[1:], len(cells)])}
        self.largest = np.abs(rows).max(initial=0)

    @staticmethod
    def radius(rows: np.ndarray, cell: np.ndarray, book: np.ndarray) -> np.ndarray:
        out = np.full(len(book), -np.inf)
        np.maximum.at(out, cell, np.sqrt(((rows - book[cell]) ** 2).sum(axis=1)))
        return out

    def half_bounds(self, anchors: np.ndarray) -> list[np.ndarray]:
        """For each half, an upper bound of the half score of each anchor with each centroid's vectors."""
        out = []
        for part, book, radius in zip((anchors[:, : self.half], anchors[:, self.half :]), self.books, self.radii):
            norm = np.sqrt((part * part).sum(axis=1))[:, None]
            with np.errstate(invalid="ignore"):
                bound = part @ book.T + norm * radius[None, :]
            bound[:, np.isinf(radius)] = -np.inf
            # Slack for the rounding of floating point sums.
            out.append(bound + np.abs(np.where(np.isinf(bound), 0, bound)) * 1e-9 + 1e-3)
        return out

    def scores(self, anchor: np.ndarray, a: np.ndarray) -> np.ndarray:
        """Exact integer scores of the rows ``a``: sums below 2^53 are exact in floating point."""
        if self.largest * np.abs(anchor).max(initial=0) * len(anchor) < 2**53:
            return (self.rows[a] @ anchor).astype(np.int64)
        return self.rows[a].astype(np.int64) @ anchor.astype(np.int64)

    def walk(self, one: np.ndarray, two: np.ndarray) -> Iterator[tuple[float, tuple[int, int]]]:
        """Cells that hold vectors with the sums of their half bounds, largest first."""
        first, second = np.argsort(-one, kind="stable"), np.argsort(-two, kind="stable")
        one, two = one[first].tolist(), two[second].tolist()
        heap = [(-(one[0] + two[0]), 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            if bound == np.inf:
                return
            span = self.spans.get((int(first[i]), int(second[j])))
            if span:
                yield -bound, span
            if j + 1 < len(two):
                heapq.heappush(heap, (-(one[i] + two[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(one):
                heapq.heappush(heap, (-(one[i + 1] + two[0]), i + 1, 0))

    def batches(self, one: np.ndarray, two: np.ndarray, enough: Callable[[float], bool]) -> Iterator[np.ndarray]:
        """Row numbers of cells in the order of the walk, first one, then more at a time, until ``enough`` of a bound."""
        held: list[np.ndarray] = []
        most = 1
        for bound, (a, b) in self.walk(one, two):
            if enough(bound):
                break
            held.append(np.arange(a, b))
            if len(held) == most:
                yield np.concatenate(held)
                held, most = [], min(2 * most, CELLS_AT_ONCE)
        if held:
            yield np.concatenate(held)


class First:
    """The first ``k`` of (score, id) by larger score, then smaller id."""

    def __init__(self, k: int):
        self.k, self.score, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        if len(score):
            score, ids = np.concatenate([self.score, score]), np.concatenate([self.ids, ids])
            kept = np.lexsort((ids, -score))[: self.k]
            self.score, self.ids = score[kept], ids[kept]

    def closed(self, bound: float) -> bool:
        """No vector of a score of at most ``bound`` can still come in."""
        return len(self.score) == self.k and bound < self.score[-1]


def find_positives(index: Index, anchors: dict, found: list[First]) -> None:
    """Add to ``found`` the same-label rows of the chunk; a row is not its own positive."""
    one, two = index.half_bounds(anchors["rows"])
    for a, first in enumerate(found):
        row, label, key = anchors["rows"][a], anchors["labels"][a], anchors["keys"][a]
        for at in index.batches(one[a], two[a], first.closed):
            at = at[(index.labels[at] == label) & (index.keys[at] != key)]
            first.add(index.scores(row, at), index.ids[at])


def find_negatives(index: Index, anchors: dict, found: list[list[First]]) -> None:
    """Add to ``found`` the rows of other labels in each window [low, high] of each anchor."""
    one, two = index.half_bounds(anchors["rows"])
    for a, windows in enumerate(found):
        if not windows:
            continue
        row, label, bounds = anchors["rows"][a], anchors["labels"][a], anchors["windows"][a]
        done = lambda bound: all(bound < low or first.closed(bound) for (low, _), first in zip(bounds, windows))
        for at in index.batches(one[a], two[a], done):
            at = at[index.labels[at] != label]
            score = index.scores(row, at)
            for (low, high), first in zip(bounds, windows):
                inside = (low <= score) & (score <= high)
                first.add(score[inside], index.ids[at[inside]])


def index_of(held: list[pa.RecordBatch], width: int, books) -> Index:
    table = pa.Table.from_batches(held)
    ids = table.column("vec_id").fill_null(NO_ID).to_numpy()
    index = Index(np.arange(len(ids)), table.column("label").to_numpy(), scaled(table.column("vec"), width), books)
    # The order of the rows in the index carries their ids and keys along.
    index.keys, index.ids = table.column("key").to_numpy()[index.ids], ids[index.ids]
    return index


def rows_at_once(width: int) -> int:
    return max(1, min(CHUNK, COMPONENTS // width))


def chunked(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[list[pa.RecordBatch]]:
    held, n = [], 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, rows - n)
            held.append(part)
            n += part.num_rows
            at += part.num_rows
            if n == rows:
                yield held
                held, n = [], 0
    if held:
        yield held


def walked(sent, negatives: bool, n_positives: int, n_negatives: int):
    """Map indexed vectors to what the anchors of one broadcast block find among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = sent.value
        n = len(anchors["keys"])
        if negatives:
            found = [[First(n_negatives) for _ in w] for w in anchors["windows"]]
        else:
            found = [First(n_positives) for _ in range(n)]
        width = anchors["rows"].shape[1]
        for held in chunked(batches, rows_at_once(width)):
            index = index_of(held, width, anchors["books"])
            (find_negatives if negatives else find_positives)(index, anchors, found)
        flat = [(a, w, first) for a, some in enumerate(found) for w, first in enumerate(some if negatives else [some])]
        flat = [x for x in flat if len(x[2].score)]
        if flat:
            sizes = [len(first.score) for _, _, first in flat]
            ids = np.concatenate([first.ids for _, _, first in flat])
            columns = [
                np.repeat([anchors["keys"][a] for a, _, _ in flat], sizes),
                np.repeat(np.array([w for _, w, _ in flat], np.int32), sizes),
                np.concatenate([first.score for _, _, first in flat]),
            ]
            arrays = [*map(pa.array, columns), pa.array(ids, mask=ids == NO_ID)]
            yield pa.RecordBatch.from_arrays(arrays, names=["anchor", "window", "score", "vec_id"])

    return run


def taking_part(rows: DataFrame, label: Column) -> DataFrame:
    """(key, vec_id, label, vec) of the rows that take part."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad)
    return kept.select("vec_id", label.cast("long").alias("label"), F.transform("embedding", lambda x: x.cast("double")).alias("vec"))


def ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def cell_of(books):
    half = books[0].shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = half + books[1].shape[1]
        for held in chunked(batches, rows_at_once(width)):
            for batch in held:
                rows = scaled(batch.column("vec"), width)
                cell = nearest(rows[:, :half], books[0]) * len(books[1]) + nearest(rows[:, half:], books[1])
                yield batch.append_column("cell", pa.array(cell.astype(np.int32)))

    return run


def mine(rows: DataFrame, label: Column | None = None, is_anchor: Column | None = None, n_positives: int = POSITIVES, n_negatives: int = NEGATIVES, least: int = 50, most: int = 95) -> DataFrame:
    """One row for each hard negative of ``rows`` (vec_id, embedding, label): anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score.

    ``label`` replaces the label, ``is_anchor`` picks the anchors (default: all rows).  The positives of an anchor
    are its first ``n_positives`` other rows of its label; the negatives of a positive the first ``n_negatives`` rows of
    other labels whose score lies between ``least`` and ``most`` hundredths of the positive's.
    """
    spark = rows.sparkSession
    part = taking_part(rows, F.col("label") if label is None else label)
    vectors = cut_lineage(part.withColumn("key", F.monotonically_increasing_id()))
    n, width = vectors.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    width = max(2, width or 0)
    half = width // 2
    sample = scaled(vectors.orderBy(F.xxhash64("vec", "key")).limit(min(SAMPLE, rows_at_once(width))).select("vec").toArrow().column("vec"), width)
    books = (np.zeros((1, half)), np.zeros((1, width - half))) if not len(sample) else (codebook(sample[:, :half], CENTROIDS), codebook(sample[:, half:], CENTROIDS))
    schema = "vec_id long, label long, vec array<double>, key long, cell int"
    parts = max(spark.sparkContext.defaultParallelism, n // PART_ROWS + 1)
    dealt = vectors.mapInArrow(cell_of(books), schema).repartitionByRange(parts, "cell", F.xxhash64("key")).sortWithinPartitions("cell")
    indexed = cut_lineage(dealt)
    chosen = vectors.where(F.col("vec_id").isNotNull() & (F.lit(True) if is_anchor is None else is_anchor))
    n_blocks = -(-chosen.count() // min(ANCHORS, rows_at_once(width))) or 1
    anchors = cut_lineage(chosen.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(n_blocks)).cast("int")))

    def blocks(windows: DataFrame | None, columns: list[str]) -> list[DataFrame]:
        """The indexed vectors walked with each block of anchors."""
        out = []
        for block in range(n_blocks):
            asked = anchors.where(F.col("block") == block)
            if windows is not None:
                asked = asked.join(windows, asked.key == windows.anchor)
            asked = asked.toArrow()
            if asked.num_rows:
                value = {
                    "keys": asked.column("key").to_numpy(),
                    "labels": asked.column("label").to_numpy(),
                    "rows": scaled(asked.column("vec"), width),
                    "windows": None if windows is None else [[(w["low"], w["high"]) for w in some] for some in asked.column("windows").to_pylist()],
                    "books": books,
                }
                sent = spark.sparkContext.broadcast(value)
                found = indexed.mapInArrow(walked(sent, windows is not None, n_positives, n_negatives), "anchor long, window int, score long, vec_id long")
                out.append(cut_lineage(ranked(found, columns, n_positives if windows is None else n_negatives)))
                sent.destroy()
        return out

    def together(tables: list[DataFrame]) -> DataFrame:
        whole = spark.createDataFrame([], "anchor long, window int, score long, vec_id long, rank int")
        for one in tables:
            whole = whole.union(one)
        return whole

    positives = blocks(None, ["anchor"])
    pairs = together(positives).select("anchor", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    low, high = F.expr(f"(positive_score * {least} + 99) div 100"), F.expr(f"(positive_score * {most}) div 100")
    windows = F.sort_array(F.collect_list(F.struct("window", low.alias("low"), high.alias("high")))).alias("windows")
    # A negative score has no window: its larger share is the smaller number.  The windows an anchor asks for are
    # numbered anew, in the order of its positives.
    bounds = cut_lineage(pairs.where("positive_score >= 0").groupBy("anchor").agg(windows))
    found = blocks(bounds, ["anchor", "window"])
    drop_written(vectors, indexed, bounds)
    negatives = together(found).select("anchor", "window", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    ids = anchors.select(F.col("key").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return negatives.join(pairs, ["anchor", "window"]).join(ids, "anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
