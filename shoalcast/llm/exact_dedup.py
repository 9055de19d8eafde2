"""Exact duplicates by a heavy-hitter split, in DataFrame functions only.

Texts are equal when they are the same after their white space (20 and 09-0D) is deleted.  Of equal texts
the row of the most code points in the original text stays, then the smallest doc_id; a row without a doc_id
comes after all others, and rows that agree in all of this are alike, so one of them stays.

A slim table (row, doc_id, code points, digest) is written once; texts are read once and never shuffled.
Misra-Gries summaries (``approx_top_k``, a mergeable form of it, one summary for each of ``BUCKETS`` parts
of the hash space) name at most ``BUCKETS * PER_BUCKET`` frequent hashes.  The rows of these are grouped by
whole digest and counted exactly, which combines in the map tasks to one row a digest; those that do have
``HEAVY`` rows or more are the verified winners.  There are at most ``BUCKETS * PER_BUCKET`` of them for any
input (about a hundred bytes each), so they are broadcast, and their rows, however many, are decided where
they were read.  All other digests are grouped and joined by an ordinary shuffle; a digest the summaries
miss is right there too, as nothing depends on their estimates.

Null texts are empty ones, and all texts without a word are equal.  Texts of any length are hashed whole, by
SHA-256.  An empty table gives no rows.  Other columns are not read by ``decide`` and are kept by
``deduplicate``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoalcast.session import cut_lineage, drop_written

BUCKETS = 64
PER_BUCKET = 32
TRACKED = 1024
HEAVY = 64
SPACE = " \t\n\x0b\x0c\r"


def digest(text: Column) -> Column:
    """SHA-256 of a text without its white space, in lower-case hexadecimal digits."""
    return F.sha2(F.translate(F.coalesce(text, F.lit("")), SPACE, "").cast("binary"), 256)


def frequent_hashes(slim: DataFrame) -> DataFrame:
    """Candidates for frequent digests, as 64-bit hashes: at most PER_BUCKET for each of BUCKETS parts."""
    part = F.pmod(F.col("hash"), F.lit(BUCKETS))
    top = F.expr(f"approx_top_k(hash, {PER_BUCKET}, {TRACKED})")
    return slim.groupBy(part.alias("part")).agg(top.alias("top")).select(F.explode("top.item").alias("hash"))


def winners(rows: DataFrame) -> DataFrame:
    """(digest, first, n): for each digest the row that stays and the number of rows."""
    first = F.min(F.struct((-F.col("n_points")).alias("n"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    return rows.groupBy("digest").agg(first.alias("first"), F.count(F.lit(1)).alias("n"))


def slim_rows(docs: DataFrame) -> DataFrame:
    """(row, doc_id, n_points, digest, hash) of every row of ``docs`` (row, doc_id, text)."""
    points = F.char_length(F.coalesce("text", F.lit("")))
    slim = docs.select("row", "doc_id", points.alias("n_points"), digest(F.col("text")).alias("digest"))
    return slim.withColumn("hash", F.xxhash64("digest"))


def resolved(slim: DataFrame) -> DataFrame:
    """(row, doc_id, keep_id, group_size, kept, text_sha256) of every row of the written table ``slim``."""
    suspects = slim.join(F.broadcast(frequent_hashes(slim)), "hash", "left_semi")
    heavy = cut_lineage(winners(suspects).where(F.col("n") >= HEAVY))
    marked = slim.join(F.broadcast(heavy), "digest", "left")
    # The other digests: counted with a combine in the map tasks, then met by their rows.
    rest = marked.where(F.col("n").isNull()).drop("first", "n")
    light = rest.join(winners(rest), "digest")
    columns = ["row", "doc_id", "digest", "first", "n"]
    both = marked.where(F.col("n").isNotNull()).select(*columns).union(light.select(*columns))
    return both.select(
        "row",
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("first.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def decide(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, keep_id (doc_id of the row that stays), group_size,
    kept, text_sha256 (of the text without white space)."""
    # Written before it is read twice: the number of a row must not change between reads.
    slim = cut_lineage(slim_rows(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")))
    return resolved(slim).drop("row")


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    taken = {c.lower() for c in docs.columns}
    row = next(name for name in (f"row{'_' * i}" for i in range(len(taken) + 1)) if name not in taken)
    numbered = cut_lineage(docs.withColumn(row, F.monotonically_increasing_id()))
    slim = cut_lineage(slim_rows(numbered.select(F.col(row).alias("row"), "doc_id", "text")))
    gone = cut_lineage(resolved(slim).where("not kept").select(F.col("row").alias(row)))
    drop_written(slim)
    return numbered.join(gone, row, "left_anti").select(*docs.columns)
