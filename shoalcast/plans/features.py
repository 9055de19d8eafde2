"""Model inputs from clean trips."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoalcast.functions.dates import month_number, period_features
from shoalcast.functions.flags import without_price_flag
from shoalcast.functions.numeric import cube_root_units, tenth_units
from shoalcast.operators.joins import lookup_join
from shoalcast.schemas import GEARS
from shoalcast.session import cut_lineage

CELL = ["municipality_name", "boat_type", "period_static", "period_seasonal"]


def _placed(trips: DataFrame, stations: DataFrame, unit: str, seasonal: Callable[[Column], Column]) -> DataFrame:
    periods = period_features(trips, "trip_date", unit, seasonal)
    placed = lookup_join(periods, stations, "trip_landing_site", "station_code", spread=["record_id"])
    return placed.dropna(subset=["municipality_name", "trip_gear", "boat_type"])


def catch_features(
    trips: DataFrame,
    stations: DataFrame,
    period_static_unit: str = "month",
    period_seasonal_function: Callable[[Column], Column] = month_number,
) -> DataFrame:
    """Trips without a price flag, with cube-root catch."""
    # Price flags are costly: they are written before they are filtered by, as a filter takes in what it reads and
    # would work them out several times, for the hot keys of the join and for its rows.
    unflagged = cut_lineage(trips).where(without_price_flag(F.col("flags")))
    placed = _placed(unflagged, stations, period_static_unit, period_seasonal_function)
    return placed.withColumns(
        {
            "trip_catch_po": tenth_units(F.col("trip_catch")),
            "trip_catch_po_3": cube_root_units(F.col("trip_catch")),
        }
    )


def value_features(
    trips: DataFrame,
    stations: DataFrame,
    period_static_unit: str = "month",
    period_seasonal_function: Callable[[Column], Column] = month_number,
) -> DataFrame:
    """The same with cube-root value."""
    features = catch_features(trips, stations, period_static_unit, period_seasonal_function)
    return features.withColumn("trip_value_po_3", cube_root_units(F.col("trip_value")))


def gear_tally(
    trips: DataFrame,
    stations: DataFrame,
    period_static_unit: str = "month",
    period_seasonal_function: Callable[[Column], Column] = month_number,
) -> DataFrame:
    """Trips per cell and gear with the cell's size (A10)."""
    placed = _placed(trips, stations, period_static_unit, period_seasonal_function)
    counts = placed.groupBy(*CELL, "trip_gear").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("size", F.sum("n").over(Window.partitionBy(*CELL)))


def gear_features(
    trips: DataFrame,
    stations: DataFrame,
    period_static_unit: str = "month",
    period_seasonal_function: Callable[[Column], Column] = month_number,
    gears: Sequence[str] = GEARS,
) -> DataFrame:
    """One row per cell with a count column per gear and the size of the cell."""
    placed = _placed(trips, stations, period_static_unit, period_seasonal_function)
    counts = [F.count_if(F.col("trip_gear") == g).alias(f"tg.{g}") for g in gears]
    return placed.groupBy(*CELL).agg(F.count(F.lit(1)).alias("size"), *counts)
