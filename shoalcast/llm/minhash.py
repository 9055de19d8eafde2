"""Near duplicates by DartMinHash signatures, banding and an exact check.

Each element (a hash of five consecutive words) owns weight regions; darts fall on a region as
a Poisson process in rank, drawn from a hash of the element, so equal elements get equal darts
in every document.  A coordinate keeps its earliest dart.  Equal bands of coordinates make
candidates, and a candidate pair counts when the Jaccard similarity of its shingle sets reaches
the threshold.  Texts with the same shingle set collapse first, so copies never pair up.  Elements weigh 1 here, as
the similarity is one of sets; ``dart_signatures`` takes any weights.

``BANDS`` bands of ``ROWS`` coordinates miss a pair at 0.8 with probability 0.0004, and fewer above.  Every pair that
shares a band is compared, connected otherwise, or ruled out by a bound: a vertex shares at most those of its
shingles that some other vertex left in its buckets has too.  Texts that resemble each other just below the threshold fail that
bound one by one, before any pair of them is formed.

Nulls and texts without a word stand alone; a text of one to four words is one shingle of
all its words, so it only groups with equal ones.  Repeated rows share a class.  Extra columns are not
read.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from shoalcast.llm.common import LOWER, SPACE_PARTED, U64, Words, chunks, mix, shingles, u64, utf8
from shoalcast.session import cut_lineage, drop_written

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 20
ROWS = 5
# Pairs of one step at most; more are taken in several steps.
PAIRS_AT_ONCE = 200_000_000
ROWS_PER_TASK = 200_000
# Words of 64 bits of the table that tells which texts to read again.
SLOTS = 1 << 20


def darts(elements: np.ndarray, weights: np.ndarray, text: np.ndarray, until: np.ndarray, k: int, out: np.ndarray) -> None:
    """Put the earliest rank of each (text, coordinate) into ``out``, throwing darts up to rank ``until[text]``.

    Weight regions are [0, 1), [1, 2), [2, 4), [4, 8)...; a dart counts if its weight is below the
    element's.  The rate of a region is its width, so ranks need no upper bound on weights.
    """
    low, width, level = 0.0, 1.0, 0
    while True:
        live = np.flatnonzero(weights > low)
        if not len(live):
            return
        seed = mix(elements[live] + u64(level * 0xA0761D6478BD642F))
        weight, owner, stop = weights[live], text[live], until[text[live]]
        rank = np.zeros(len(live))
        throw = 0
        while len(seed):
            drawn = mix(seed + u64((2 * throw + 1) * 0xE7037ED1A0B428DB))
            rank = rank - np.log(((drawn >> U64(11)).astype(np.float64) + 1.0) / 9007199254740993.0) / width
            kept = rank <= stop
            seed, weight, owner, stop, rank = seed[kept], weight[kept], owner[kept], stop[kept], rank[kept]
            place = mix(seed + u64((2 * throw + 2) * 0xE7037ED1A0B428DB))
            share = low + width * ((place >> U64(40)).astype(np.float64) / float(1 << 24))
            hit = share < weight
            cell = owner[hit] * k + ((place[hit] & U64(0xFFFFFFFF)) % U64(k)).astype(np.int64)
            np.minimum.at(out.reshape(-1), cell, rank[hit])
            throw += 1
        low, width, level = low + width, max(1.0, low + width), level + 1


def dart_signatures(elements: np.ndarray, weights: np.ndarray, text: np.ndarray, n: int, k: int) -> np.ndarray:
    """Earliest rank for each of ``k`` coordinates of ``n`` texts; infinite for texts without an element."""
    out = np.full((n, k), np.inf)
    total = np.bincount(text, weights, n)
    until = np.where(total > 0, k * (np.log(k) + 2) / np.maximum(total, 1e-12), 0)
    todo = np.flatnonzero(total > 0)
    while len(todo):
        chosen = np.zeros(n, dtype=bool)
        chosen[todo] = True
        mine = chosen[text]
        darts(elements[mine], weights[mine], text[mine], until, k, out)
        todo = todo[np.isinf(out[todo]).any(axis=1)]
        until[todo] *= 2
    return out


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, ordered by text and value, with the text of each."""
    words = Words(LOWER[data], offsets, SPACE_PARTED)
    value, text = shingles(words.hashes(), words.bounds, size)
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    return value[new], text[new]


def sign(size: int, bands: int, rows: int):
    """Map batches of (doc_id, text) to the digest of the shingle set, its size and the band hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = bands * rows
        for batch in chunks(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            value, text = shingle_sets(data, offsets, size)
            n = batch.num_rows
            count = np.bincount(text, minlength=n)
            ranks = dart_signatures(value, np.ones(len(value)), text, n, k).view(U64).reshape(n, bands, rows)
            band = np.broadcast_to(np.arange(1, bands + 1, dtype=U64), (n, bands)).copy()
            for j in range(rows):
                band = mix(band * U64(0x9FB21C651E98DF25) + ranks[:, :, j])
            digest = digests(value, text, n)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(digest[0].view(np.int64)),
                    pa.array(digest[1].view(np.int64)),
                    pa.array(count.astype(np.int32)),
                    pa.ListArray.from_arrays(np.arange(0, n * bands + 1, bands, dtype=np.int32), band.reshape(-1).view(np.int64)),
                ],
                names=["doc_id", "d1", "d2", "n_shingles", "bands"],
            )

    return run


def digests(value: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Two hashes of the shingle set of each of ``n`` texts; zero for an empty one."""
    out = np.zeros((2, n), U64)
    some = np.flatnonzero(np.bincount(text, minlength=n))
    if len(some):
        starts = np.searchsorted(text, some)
        out[0, some] = mix(np.add.reduceat(mix(value), starts))
        out[1, some] = mix(np.add.reduceat(mix(value ^ U64(0x5851F42D4C957F2D)), starts))
    return out


def shingle_rows(size: int):
    """Map batches of texts to the digest of each shingle set and its members as 32-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            value, text = shingle_sets(data, offsets, size)
            digest = digests(value, text, batch.num_rows)
            bounds = np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int32)
            low = (value >> U64(32)).astype(np.uint32).view(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(digest[0].view(np.int64)), pa.array(digest[1].view(np.int64)), pa.ListArray.from_arrays(bounds, low)],
                names=["d1", "d2", "shingles"],
            )

    return run


def written(df: DataFrame, *checks) -> tuple[DataFrame, list]:
    """``df`` written and read back, with its number of rows and the given aggregates taken on the way."""
    seen = Observation()
    out = cut_lineage(df.observe(seen, F.count(F.lit(1)).alias("n"), *(c.alias(f"c{i}") for i, c in enumerate(checks))))
    return out, list(seen.get.values())


def tasks(rows: int) -> int:
    """Tasks for a step over so many short rows."""
    return max(1, rows // ROWS_PER_TASK)


def components(edges: DataFrame, n: int) -> tuple[DataFrame, int]:
    """(vertex, label) of every vertex but the labels in ``edges`` (a, b; about ``n`` rows): the smallest
    vertex of its component; and their number.

    Alternates large-star and small-star steps, with minima aggregated and joined back, so a
    vertex with many neighbours is never gathered.
    """
    check = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    first = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v")
    links, before = written(first.coalesce(tasks(n)), check)
    while before[0]:
        k = tasks(before[0])
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).coalesce(k)
        large = both.where("v > u").join(nearest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(k)
        least = large.groupBy("u").agg(F.min("v").alias("m")).coalesce(k)
        small = large.join(least, "u").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        small = small.union(least.select("u", F.col("m").alias("v"))).where("u != v").coalesce(k)
        stepped, after = written(small.distinct().coalesce(k), check)
        drop_written(links)
        links = stepped
        if after == before:
            break
        before = after
    labels = links.select(F.col("u").alias("vertex"), F.col("v").alias("label"))
    labels.written_path = links.written_path
    return labels, before[0]


def similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets reach ``similarity``."""
    left = sets.select(F.col("vertex").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("vertex").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", common.alias("common"), (F.size("sa") + F.size("sb")).alias("total"))
    return both.where(F.col("common") >= F.lit(similarity) * (F.col("total") - F.col("common"))).select("a", "b")


def near_duplicates(
    docs: DataFrame, size: int = SHINGLE, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, class_id (the smallest doc_id of its
    group of near duplicates), n_copies (rows with the same shingle set), is_kept."""
    return classes_of(docs, size, similarity, bands, rows)[0]


def classes_of(
    docs: DataFrame, size: int = SHINGLE, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS
) -> tuple[DataFrame, list[DataFrame]]:
    """The rows of ``near_duplicates`` and the written tables that they are read from.

    A vertex is a distinct shingle set.  Each vertex is first compared with the smallest centre of its buckets, then
    with the centres whose label differs.  In buckets that are not connected by then the bound of common shingles
    rules vertices out, the rest meets the vertex with the least shingles of its own, and what is then not
    connected is compared where two vertices share one of their rarest shingles, as near duplicates must.
    """
    texts = docs.select("doc_id", "text")
    signed = texts.mapInArrow(sign(size, bands, rows), "doc_id long, d1 long, d2 long, n_shingles int, bands array<long>")
    signed = cut_lineage(signed.withColumn("row", F.monotonically_increasing_id()))
    wordless = signed.where("n_shingles = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("n_copies"))
    some = signed.where("n_shingles > 0")
    # A set goes by the number of its first row, whose bands stand for all its copies.
    vertices = cut_lineage(
        some.groupBy("d1", "d2", "n_shingles").agg(F.min("row").alias("vertex"), F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n_copies"))
    )
    own = some.select(F.col("row").alias("vertex"), "n_shingles", "bands").join(vertices.select("vertex"), "vertex", "left_semi")
    members = own.select("vertex", "n_shingles", F.explode("bands").alias("band"))
    crowded = members.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("vertex", "n_shingles")).alias("centre")).where("n > 1")
    crowded = crowded.select("band", F.col("centre.vertex").alias("centre"), F.col("centre.n_shingles").alias("n_centre"))
    # Only buckets with two vertices or more matter from here on.
    buckets, (n,) = written(members.join(crowded, "band").where("vertex > centre"))
    close = F.least("n_shingles", "n_centre") >= F.lit(similarity) * F.greatest("n_shingles", "n_centre")
    sets = shingles_of(docs, vertices, buckets, n, size)
    nearest = buckets.where(close).groupBy("vertex").agg(F.min("centre").alias("a")).select("a", F.col("vertex").alias("b"))
    links, n_links = verified(nearest, sets, similarity)
    done = [links]
    known = links.select(F.col("b").alias("vertex"), F.col("a").alias("label"))
    hubs = known.select(F.col("vertex").alias("centre"), F.col("label").alias("hub"))
    labelled = buckets.join(known, "vertex", "left").join(hubs, "centre", "left")
    labelled = cut_lineage(labelled.withColumns({"label": F.coalesce("label", "vertex"), "hub": F.coalesce("hub", "centre")}))
    drop_written(buckets)
    stars = labelled.where(close & (F.col("label") != F.col("hub"))).select(F.col("centre").alias("a"), F.col("vertex").alias("b")).distinct()
    more, n_more = verified(stars, sets, similarity)
    done.append(more)
    links, n_links = links.union(more), n_links + n_more
    labels, n_labels = components(links, n_links)
    done.append(labels)
    links = labels.select(F.col("vertex").alias("a"), F.col("label").alias("b"))
    # The centre is a member too.
    whole = labelled.select("band", "vertex", "n_shingles").union(labelled.select("band", F.col("centre").alias("vertex"), F.col("n_centre").alias("n_shingles")).distinct())
    held, (n_held,) = written(unconnected(with_labels(whole, labels)))
    drop_written(labelled)
    if n_held:
        common = common_shingles(held, sets)
        bounded = cut_lineage(held.join(common, "vertex").where(F.col("common") >= similarity * F.col("n_shingles")))
        drop_written(held)
        best = F.max(F.struct((F.col("common") / F.col("n_shingles")).alias("share"), (-F.col("vertex")).alias("order"), "vertex", "n_shingles", "common", "label"))
        centres = bounded.groupBy("band").agg(best.alias("c")).select("band", *[F.col(f"c.{x}").alias(f"c_{x}") for x in ("vertex", "n_shingles", "common", "label")])
        met = bounded.join(centres, "band").where((F.col("label") != F.col("c_label")) & may_link("common", "n_shingles", "c_common", "c_n_shingles", similarity))
        more, n_more = verified(met.select(F.col("c_vertex").alias("a"), F.col("vertex").alias("b")).distinct(), sets, similarity)
        done.append(more)
        labels, n_labels = components(links.union(more), n_labels + n_more)
        done.append(labels)
        links = labels.select(F.col("vertex").alias("a"), F.col("label").alias("b"))
        left = cut_lineage(unconnected(with_labels(bounded, labels)))
        drop_written(bounded)
        prefixes = cut_lineage(rare_shingles(left, sets, similarity))
        at_most = prefixes.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).agg(F.sum(F.col("n") * (F.col("n") - 1))).first()[0] or 0
        slices = int(at_most) // PAIRS_AT_ONCE + 1
        for part in range(slices if at_most else 0):
            more, n_more = verified(rare_pairs(prefixes, part, slices, similarity).distinct(), sets, similarity)
            done.append(more)
            links, n_labels = links.union(more), n_labels + n_more
        drop_written(prefixes)
        drop_written(left)
        if at_most:
            labels, _ = components(links, n_labels)
    drop_written(sets)
    joined = with_labels(vertices, labels)
    least = joined.groupBy("label").agg(F.min("first_id").alias("class_id"))
    classes = cut_lineage(joined.join(least, "label").select("d1", "d2", "n_shingles", "class_id", "n_copies"))
    drop_written(vertices, *(table for table in done if table is not labels), labels)
    grouped = some.select("doc_id", "d1", "d2", "n_shingles").join(classes, ["d1", "d2", "n_shingles"]).select("doc_id", "class_id", "n_copies")
    return grouped.union(wordless).withColumn("is_kept", F.col("doc_id").eqNullSafe(F.col("class_id"))), [signed, classes]


def with_labels(df: DataFrame, labels: DataFrame) -> DataFrame:
    return df.drop("label").join(labels.select("vertex", "label"), "vertex", "left").withColumn("label", F.coalesce("label", "vertex"))


def unconnected(members: DataFrame) -> DataFrame:
    """The members of buckets that hold more than one label."""
    labels = members.groupBy("band").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least < most")
    return members.join(labels.select("band"), "band", "left_semi")


def common_shingles(held: DataFrame, sets: DataFrame) -> DataFrame:
    """(vertex, common): how many shingles of a vertex another vertex of ``held`` has too.

    Counted from the other side, by the shingles that only one vertex has: those are summed by vertex, so a
    shingle of all vertices is one row.
    """
    mine = sets.join(held.select("vertex").distinct(), "vertex", "left_semi")
    shingle = mine.select("vertex", F.explode("shingles").alias("shingle"))
    alone = shingle.groupBy("shingle").agg(F.min("vertex").alias("vertex"), F.max("vertex").alias("other")).where("vertex = other")
    counted = mine.select("vertex", F.size("shingles").alias("n")).join(alone.groupBy("vertex").agg(F.count(F.lit(1)).alias("alone")), "vertex", "left")
    return counted.select("vertex", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("common"))


def may_link(common_a: str, n_a: str, common_b: str, n_b: str, similarity: float):
    """Whether two sets of these sizes that share no more than these reach ``similarity``: J = s / (na + nb - s)."""
    share = F.least(F.col(common_a), F.col(common_b), F.col(n_a), F.col(n_b))
    return share * (1 + similarity) >= F.lit(similarity) * (F.col(n_a) + F.col(n_b))


def rare_shingles(left: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(vertex, shingle, at, n, label): the rarest shingles of each vertex, enough that two near duplicates share one.

    In any order of all shingles, sets of a similarity t share one among their first n - ceil(t n) + 1; ordered by
    how many vertices have them, these are the rare ones.  Shingles of one vertex alone count but need no row.
    """
    mine = left.select("vertex", "label").distinct().join(sets, "vertex")
    shingle = mine.select("vertex", "label", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    shared = shingle.groupBy("shingle").agg(F.count(F.lit(1)).alias("n_with")).where("n_with > 1")
    every = Window.partitionBy("vertex")
    rows = shingle.join(shared, "shingle").withColumns({"rank": F.row_number().over(every.orderBy("n_with", "shingle")), "common": F.count(F.lit(1)).over(every)})
    at = F.col("n") - F.col("common") + F.col("rank")
    return rows.select("vertex", "shingle", at.alias("at"), "n", "label").where(F.col("at") <= F.col("n") - F.ceil(similarity * F.col("n") - 1e-9) + 1)


def rare_pairs(prefixes: DataFrame, part: int, slices: int, similarity: float) -> DataFrame:
    """The pairs (a, b) not connected yet that share a rare shingle early enough.

    Two sets share at most one more than what follows their first common shingle in the shorter rest; a shingle for which
    this is too little is not the first common one of near duplicates.
    """
    one = prefixes.where(F.pmod(F.xxhash64("vertex"), F.lit(slices)) == part)
    one = one.select("shingle", F.col("vertex").alias("a"), F.col("at").alias("i"), F.col("n").alias("na"), F.col("label").alias("la"))
    two = prefixes.select(F.col("shingle").alias("shingle2"), F.col("vertex").alias("b"), F.col("at").alias("j"), F.col("n").alias("nb"), F.col("label").alias("lb"))
    most = 1 + F.least(F.col("na") - F.col("i"), F.col("nb") - F.col("j"))
    enough = most * (1 + similarity) >= similarity * (F.col("na") + F.col("nb")) - 1e-9
    return one.join(two, (F.col("shingle") == F.col("shingle2")) & (F.col("a") < F.col("b")) & (F.col("la") != F.col("lb")) & enough).select("a", "b")


def likely(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The ``rows`` whose key may be among ``ids``, so that few others are shuffled to the exact join.

    The keys set bits in at most ``SLOTS`` words of 64, whatever their number: that table is broadcast.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(SLOTS))
    place = F.pmod(F.shiftrightunsigned(F.xxhash64(key), 40), F.lit(64)).cast("int")
    words = ids.groupBy(slot.alias("slot")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(shiftrightunsigned(xxhash64({key}), 40), 64) as int))")).alias("word"))
    kept = rows.withColumns({"slot": slot, "place": place}).join(F.broadcast(words), "slot").where(F.bit_get("word", F.col("place")) == 1)
    return kept.select(*rows.columns)


def shingles_of(docs: DataFrame, vertices: DataFrame, buckets: DataFrame, n: int, size: int) -> DataFrame:
    """(vertex, shingles) of every member and centre of ``buckets`` (``n`` rows), read from one text each and written."""
    k = tasks(n)
    wanted = buckets.select("vertex").union(buckets.select("centre")).distinct().coalesce(k)
    named = cut_lineage(wanted.join(vertices.select("vertex", "d1", "d2", "first_id"), "vertex"))
    texts = docs.select("doc_id", "text")
    ids = named.select(F.col("first_id").alias("doc_id")).where("doc_id is not null").distinct().coalesce(k)
    # An inner join with distinct ids: a semi join would be pushed below the bit table, to all texts.
    read = likely(texts, ids, "doc_id").join(ids, "doc_id").union(texts.where("doc_id is null"))
    sets = read.mapInArrow(shingle_rows(size), "d1 long, d2 long, shingles array<int>")
    out = cut_lineage(sets.join(named.select("vertex", "d1", "d2"), ["d1", "d2"]).groupBy("vertex").agg(F.any_value("shingles").alias("shingles")))
    drop_written(named)
    return out


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> tuple[DataFrame, int]:
    """The pairs that are near duplicates, written, and their number."""
    # Written first: where they are few, that is known before any shingle set is shuffled.
    pairs = cut_lineage(pairs)
    links, (m,) = written(similar(pairs, sets, similarity))
    drop_written(pairs)
    return links, m
