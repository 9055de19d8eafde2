"""Aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sum_or_null(value: Column) -> Column:
    """NULL when every value is missing, else the sum of the others (A2): Spark's own ``sum``."""
    return F.sum(value)


def sum_or_zero(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0.0))


def weighted_mean(value: Column, weight: Column) -> Column:
    """Weights that are zero or missing skip their row; NULL for no weight or a weighted NULL (A4)."""
    w = F.coalesce(weight, F.lit(0.0))
    total = F.try_divide(F.sum(F.when(w != 0, value * w).otherwise(0.0)), F.sum(w))
    return F.when(F.count_if(value.isNull() & (w != 0)) == 0, total)


def summarise_trips(points: DataFrame, keys: Sequence[str] = ("day", "trip")) -> DataFrame:
    """Points to one row per trip and file day (A1): span, range and the first point's identity."""
    identity = ["boat", "boat_name", "community", "imei"]
    first = F.min(F.struct(F.col("time").isNull().alias("__late"), "time", *identity))
    return (
        points.groupBy(*keys)
        .agg(
            F.min("time").alias("start"),
            F.max("time").alias("end"),
            F.max("range_meters").alias("range"),
            first.alias("__first"),
        )
        .select(
            "trip" if "trip" in keys else F.lit(None).cast("string").alias("trip"),
            "start",
            "end",
            "range",
            F.col("__first.boat").alias("boat_id"),
            F.col("__first.boat_name").alias("boat_name"),
            F.col("__first.community").alias("community"),
            F.col("__first.imei").alias("imei"),
            *[k for k in keys if k != "trip"],
        )
    )


def activity_cells(panel: DataFrame) -> DataFrame:
    """Days and active days per boat and period."""
    return (
        panel.where(F.col("municipality_name").isNotNull())
        .groupBy("period_static", "individual_boat", "boat_code", "municipality_name", "period_seasonal")
        .agg(F.count(F.lit(1)).alias("n_days"), F.sum("trip_activity").alias("n_trips"))
    )


def boat_span(panel: DataFrame) -> DataFrame:
    """First and last day of each tracked boat."""
    return panel.groupBy("imei", "boat_id_pds", "boat_code", "municipality_name").agg(
        F.min("trip_end_date_pds").alias("installation"), F.max("trip_end_date_pds").alias("last_heard")
    )


def species_count_distribution(trips: DataFrame, lowest: int = 1, highest: int = 8) -> DataFrame:
    """Trips by number of species in a range (A14, before the shares)."""
    return (
        trips.where(F.col("trip_n_species").between(lowest, highest))
        .groupBy("trip_n_species")
        .agg(F.count(F.lit(1)).alias("n"))
    )


ADDITIVE = ("n_trips", "total_weight", "total_value")


def totals_by_draw(estimates: DataFrame, keys: Sequence[str], additive: Sequence[str] = ADDITIVE) -> DataFrame:
    """Sum the additive columns for each key and draw."""
    return estimates.groupBy(*keys, "draw").agg(*[F.sum(c).alias(c) for c in additive])


def interval_summary(
    draws: DataFrame, keys: Sequence[str], value: str, widths: Sequence[float] = (0.66, 0.95), exact: bool = True
) -> DataFrame:
    """Median, mean and quantile intervals over the draws of each key, one row per width.

    A key has as many rows as there are draws, so the exact percentile is the default.
    """
    marks = [0.5, *[m for w in widths for m in ((1 - w) / 2, (1 + w) / 2)]]
    quantiles = F.percentile(value, marks) if exact else F.percentile_approx(value, marks, 10_000)
    stats = draws.groupBy(*keys).agg(quantiles.alias("__q"), F.avg(value).alias("mean"))
    rows = F.array(
        *[
            F.struct(
                F.lit(float(w)).alias("width"),
                F.col("__q")[1 + 2 * i].alias("lower"),
                F.col("__q")[2 + 2 * i].alias("upper"),
            )
            for i, w in enumerate(widths)
        ]
    )
    return stats.withColumn("__i", F.explode(rows)).select(
        *keys, "__i.width", F.col("__q")[0].alias("median"), "mean", "__i.lower", "__i.upper"
    )


def sketches(draws: DataFrame, keys: Sequence[str], value: str, size: int = 800) -> DataFrame:
    """A quantile sketch (KLL) of the values of each key, of bounded size however many draws there are.

    Ranks are off by about 1.65 / ``size`` with 99 % confidence, 0.3 % by default.  Sketches of parts of the draws, kept
    from several runs, add up by :func:`merged_sketches`.
    """
    return draws.groupBy(*keys).agg(F.expr(f"kll_sketch_agg_double({value}, {size})").alias("sketch"), F.count(value).alias("n"))


def merged_sketches(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sketches of several parts of the same keys as one, pair by pair."""
    merge = F.expr("aggregate(slice(s, 2, size(s)), s[0], (a, b) -> kll_sketch_merge_double(a, b))")
    packed = parts.groupBy(*keys).agg(F.collect_list("sketch").alias("s"), F.sum("n").alias("n"))
    return packed.select(*keys, merge.alias("sketch"), "n")


def sketch_quantiles(sketched: DataFrame, keys: Sequence[str], marks: Sequence[float]) -> DataFrame:
    """(keys, mark, quantile, n) for each mark."""
    each = [F.struct(F.lit(float(m)).alias("mark"), F.expr(f"kll_sketch_get_quantile_double(sketch, {float(m)}D)").alias("quantile")) for m in marks]
    return sketched.select(*keys, "n", F.explode(F.array(*each)).alias("q")).select(*keys, "q.mark", "q.quantile", "n")


def order_levels(df: DataFrame, level: str, stat: Column, descending: bool = False) -> DataFrame:
    """Levels with the statistic that orders them (A18), one row per level."""
    stats = df.groupBy(level).agg(stat.alias("level_stat"))
    order = F.col("level_stat").desc_nulls_last() if descending else F.col("level_stat").asc_nulls_last()
    return stats.orderBy(order, F.col(level).asc_nulls_last())
