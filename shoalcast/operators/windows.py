"""Ordered operators (W1-W12): latest row per key, forward fill, running shares, ECDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoalcast.session import cut_lineage


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key in the given order.

    Spark keeps one row per key and map task before the shuffle (WindowGroupLimit), so a
    hot key sends a handful of rows, not all of them.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rn", rank).where(F.col("__rn") == 1).drop("__rn")


def latest_version(df: DataFrame, key: str, version: str, tie: Sequence[str] = ()) -> DataFrame:
    """Last version of each key by text order; a missing version counts as the last."""
    order = [F.col(version).desc_nulls_first(), *[F.col(c).asc_nulls_last() for c in tie]]
    return first_per_key(df, [key], order)


def forward_fill(
    df: DataFrame, by: Sequence[str], order: Sequence[str | Column], columns: Sequence[str], block: Column
) -> DataFrame:
    """Replace NULLs by the last value before them within ``by``.

    ``block`` cuts the leading order column into ordered stretches (a month, say).  Values
    are carried inside a block first, then across blocks on one summary row per block, so
    one long-lived key is spread over as many tasks as it has blocks.  Keys must not be NULL;
    the order columns are ascending, NULL first.
    """
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    blocked = df.withColumn("__block", block)
    inside = Window.partitionBy(*by, "__block").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    position = F.struct(*order_cols)
    ends = blocked.groupBy(*by, "__block").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), position)).alias(f"__end_{c}") for c in columns]
    )
    before = Window.partitionBy(*by).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        *by, "__block", *[F.last(f"__end_{c}", ignorenulls=True).over(before).alias(f"__carry_{c}") for c in columns]
    )
    filled = blocked.withColumns({c: F.last(c, ignorenulls=True).over(inside) for c in columns})
    joined = filled.join(carried, [*by, "__block"], "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.col(f"__carry_{c}")) for c in columns}).select(*df.columns)


def running_share(df: DataFrame, order: str, value: str, share: str = "share", running: str = "share_cum") -> DataFrame:
    """Share of the total and its running sum over an aggregated table of few rows.

    The total comes from a one-row subquery; the running sum needs one ordered pass.
    """
    total = df.agg(F.sum(value).alias("t")).scalar()
    shares = df.withColumn(share, F.try_divide(F.col(value), total))
    frame = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return shares.withColumn(running, F.sum(share).over(frame))


def ecdf(df: DataFrame, value: str, buckets: int | None = None, out: str = "ecdf") -> DataFrame:
    """Empirical distribution function, one row per distinct value.

    Equal values are counted before any ordering, then the counts are range partitioned and
    written with their partition number; counts run inside a partition and are shifted by
    the total of the partitions before it.  No task sees more than its range.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Written once, so that the running counts and the totals see the same ranges.
    placed = cut_lineage(counts.repartitionByRange(buckets, value).withColumn("__b", F.spark_partition_id()))
    totals = placed.groupBy("__b").agg(F.sum("n").alias("__total"))
    # One row per range, at most ``buckets`` rows.
    before = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "__b",
        F.coalesce(F.sum("__total").over(before), F.lit(0)).alias("__before"),
        F.sum("__total").over(Window.partitionBy()).alias("__all"),
    )
    inside = Window.partitionBy("__b").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.withColumn("__run", F.sum("n").over(inside))
        .join(F.broadcast(offsets), "__b")
        .select(value, "n", ((F.col("__before") + F.col("__run")) / F.col("__all")).alias(out))
    )
