"""Daily vessel-activity panel (C8) and tracker coverage (C14)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoalcast.functions.dates import local_date, month_number, period_features
from shoalcast.functions.text import map_codes
from shoalcast.operators.aggregates import boat_span, order_levels
from shoalcast.operators.joins import asof_latest, lookup_join, without_dates
from shoalcast.operators.reshape import complete, densify_days, unpivot_columns
from shoalcast.operators.windows import first_per_key, forward_fill
from shoalcast.schemas import CENSUS_CODES
from shoalcast.session import cut_lineage

# Before any trip: the date of a registry row that holds for all times.
ALWAYS = "0001-01-01"

TRIP_FIELDS = [
    "imei",
    "boat_id_pds",
    "boat_code",
    "municipality_name",
    "trip_start_date_pds",
    "trip_end_date_pds",
    "trip_id_pds",
]


def assign_boats(trips: DataFrame, boats: DataFrame, mode: str = "asof") -> DataFrame:
    """Boat type and municipality of each trip from the registry.

    ``asof``: one row per trip; a device with one registry row takes it, a device with
    several takes the latest installed before the trip's end, and the trip is dropped if
    there is none.  ``reference``: the choice is made over all rows of a trip id, where a
    missing or later installation date drops the trip.
    """
    if mode == "asof":
        return _assign_asof(trips, boats)
    if mode == "reference":
        return _assign_literal(trips, boats)
    raise ValueError(f"unknown mode: {mode}")


def _assign_asof(trips: DataFrame, boats: DataFrame) -> DataFrame:
    known = boats.where(F.col("imei").isNotNull()).select("imei", "boat_code", "municipality_name", "installation_date")
    # Per device: whether there is one row only, and that row.
    sizes = known.groupBy("imei").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("boat_code", "municipality_name")).alias("only")
    )
    always = F.lit(ALWAYS).cast("date").alias("installation_date")
    single = F.col("n") == 1
    # A device with several rows starts with "none": a trip that still has it later is dropped.
    start = sizes.select(
        "imei",
        always,
        F.when(single, F.col("only.boat_code")).alias("boat_code"),
        F.when(single, F.col("only.municipality_name")).alias("municipality_name"),
        (~single).alias("unknown"),
    )
    several = sizes.where(~single).select("imei")
    dated = known.join(several, "imei", "left_semi").withColumn("unknown", F.lit(False))
    history = start.unionByName(dated)
    # Written once: the join reads it for its dates, its hot keys and its rows.
    one_per_trip = cut_lineage(
        first_per_key(
            trips, ["trip_id_pds"], [F.col("end").desc_nulls_last(), F.col("download_date_pds").asc_nulls_last()]
        )
    )
    assigned = asof_latest(
        one_per_trip,
        history,
        "imei",
        "trip_end_date_pds",
        "installation_date",
        ["boat_code", "municipality_name", "unknown"],
        spread=["trip_id_pds"],
    )
    return assigned.where(~F.coalesce("unknown", F.lit(False))).drop("unknown")


def _assign_literal(trips: DataFrame, boats: DataFrame) -> DataFrame:
    """The same result as filtering all trip x registry pairs, from one summary row per device."""
    known = boats.where(F.col("imei").isNotNull()).select("imei", "boat_code", "municipality_name", "installation_date")
    sizes = known.groupBy("imei").agg(
        F.count(F.lit(1)).alias("__n"),
        F.max("installation_date").alias("__last"),
        F.count_if(F.col("installation_date").isNull()).alias("__undated"),
    )
    sized = lookup_join(trips, sizes, "imei", spread=["trip_id_pds", "download_date_pds"])
    gap = F.when(F.col("__undated") == 0, F.datediff("trip_end_date_pds", "__last"))
    sized = sized.withColumn("__gap", gap)
    per_trip = sized.groupBy("trip_id_pds").agg(
        F.sum(F.coalesce("__n", F.lit(1))).alias("__rows"),
        F.min("__gap").alias("__least"),
        F.count_if(F.col("__gap").isNull()).alias("__open"),
    )
    judged = sized.join(per_trip, "trip_id_pds")
    nearest = (F.col("__open") == 0) & (F.col("__gap") == F.col("__least")) & (F.col("__gap") > 0)
    kept = judged.where((F.col("__rows") == 1) | nearest)
    # The registry rows to attach: a device's only row, or all rows of its last installation date.
    last = known.join(sizes.select("imei", "__n", "__last"), "imei").where(
        (F.col("__n") == 1) | (F.col("installation_date") == F.col("__last"))
    )
    attached = last.select(F.col("imei").alias("__imei"), "boat_code", "municipality_name", "installation_date")
    out = lookup_join(kept, attached, "imei", "__imei", spread=["trip_id_pds", "download_date_pds"])
    return out.drop("__n", "__last", "__undated", "__gap", "__rows", "__least", "__open")


def one_trip_per_day(trips: DataFrame) -> DataFrame:
    """One trip per device, boat and end day: the latest end."""
    return first_per_key(
        trips,
        ["imei", "boat_id_pds", "trip_end_date_pds"],
        [F.col("end").desc_nulls_last(), F.col("trip_id_pds").asc_nulls_last()],
    ).select(*TRIP_FIELDS)


def last_seen_rows(devices: DataFrame) -> DataFrame:
    """The day each device was last heard from."""
    return devices.select(
        "imei", F.lit(True).alias("last_seen"), local_date(F.col("last_seen")).alias("trip_end_date_pds")
    )


def outage_days(trips: DataFrame) -> DataFrame:
    """Download days with trips of no device, and the days before them (U4)."""
    day = F.col("download_date_pds")
    return trips.where(F.col("imei").isNull()).select(F.explode(F.array(day, F.date_sub(day, 1))).alias("day")).distinct()


def format_vessel_activity(
    trips: DataFrame,
    boats: DataFrame,
    devices: DataFrame,
    include_last_seen_info: bool = True,
    correct_empty_days: bool = True,
    period_static_unit: str = "month",
    period_seasonal_function: Callable[[Column], Column] = month_number,
    asof_mode: str = "asof",
    dedupe_last_seen: bool = False,
) -> DataFrame:
    """One row per boat and day between its first and last sign of life.

    Boat details are carried forward within a device.  A day with a trip and a last-seen
    record has two rows unless ``dedupe_last_seen`` is set.
    """
    tracked = trips.where(F.col("trip_id_pds").isNotNull() & F.col("imei").isNotNull())
    days = one_trip_per_day(assign_boats(tracked, boats, asof_mode))
    if include_last_seen_info:
        seen = last_seen_rows(devices.where(F.col("imei").isNotNull()))
        if dedupe_last_seen:
            seen = seen.join(days.select("imei", "trip_end_date_pds").distinct(), ["imei", "trip_end_date_pds"], "left_anti")
        days = days.unionByName(seen, allowMissingColumns=True)
    else:
        days = days.withColumn("last_seen", F.lit(None).cast("boolean"))
    # One small row per boat and active day; the fill and the day grid read their input twice.
    days = cut_lineage(days.where(F.col("trip_end_date_pds").isNotNull()))
    filled = forward_fill(
        days,
        ["imei"],
        ["trip_end_date_pds", F.coalesce("last_seen", F.lit(False)), "boat_id_pds"],
        ["boat_id_pds", "boat_code", "municipality_name"],
        block=F.trunc("trip_end_date_pds", "month"),
    ).where(F.col("boat_code").isNotNull())
    panel = densify_days(cut_lineage(filled), ["imei", "boat_id_pds"], ["boat_code", "municipality_name"], "trip_end_date_pds")
    panel = panel.withColumn(
        "individual_boat", F.concat_ws(" ", F.coalesce("imei", F.lit("NA")), F.coalesce("boat_id_pds", F.lit("NA")))
    )
    if correct_empty_days:
        panel = without_dates(panel, "trip_end_date_pds", outage_days(trips), "day")
    panel = panel.withColumn("trip_activity", F.col("trip_id_pds").isNotNull().cast("double"))
    return period_features(panel, "trip_end_date_pds", period_static_unit, period_seasonal_function)


def census_long(municipalities: DataFrame) -> DataFrame:
    """Boats per municipality and boat code."""
    long = unpivot_columns(municipalities, ["municipality_name"], list(CENSUS_CODES), "boat_code", "value")
    return long.withColumn("boat_code", map_codes(F.col("boat_code"), CENSUS_CODES))


def tracked_boats(panel: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct boats per observed combination of the keys, zero where none.

    Boats are counted before the grid is completed, so the grid meets one row per cell.  The
    counts are written once: the levels of every key and the grid are read from them.
    """
    counts = cut_lineage(panel.groupBy(*keys).agg(F.countDistinct("boat_id_pds").alias("n_boats")))
    return complete(counts, keys).na.fill(0, ["n_boats"])


def coverage_ratio(panel: DataFrame, municipalities: DataFrame) -> DataFrame:
    """Tracked boats over the census, by municipality, period and boat code."""
    counts = tracked_boats(panel, ["municipality_name", "period_static", "boat_code"])
    joined = lookup_join(counts, census_long(municipalities), ["municipality_name", "boat_code"])
    return joined.withColumn("prop_boats", F.try_divide("n_boats", "value"))


def coverage_report(panel: DataFrame, municipalities: DataFrame) -> dict[str, DataFrame]:
    """The tables of the coverage report (C14)."""
    by_place = coverage_ratio(panel, municipalities)
    return {
        "boat_span": boat_span(panel),
        "tracked_boats": tracked_boats(panel, ["period_static", "boat_code"]),
        "coverage": by_place,
        "municipality_order": order_levels(by_place, "municipality_name", F.max("n_boats"), descending=True),
    }
