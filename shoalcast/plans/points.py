"""Track points to trips (C12) and trips to one per device and day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoalcast.functions.dates import local_date
from shoalcast.operators.aggregates import summarise_trips
from shoalcast.operators.windows import first_per_key
from shoalcast.sources.points import scan_point_files
from shoalcast.sources.readers import read_points_trips_csv


def points_to_trips(spark, directory: str, pattern: str = "*") -> DataFrame:
    """Folder of daily point files to trips, with a placeholder row for days without points."""
    points, empty = scan_point_files(spark, directory, pattern)
    return summarise_trips(points).unionByName(empty.select("day"), allowMissingColumns=True)


def latest_trip_per_day(trips: DataFrame) -> DataFrame:
    """Local dates, working names, and the latest trip of a device, end day and download."""
    dated = trips.withColumns(
        {"trip_end_date_pds": local_date(F.col("end")), "trip_start_date_pds": local_date(F.col("start"))}
    ).withColumnsRenamed({"day": "download_date_pds", "trip": "trip_id_pds", "boat_id": "boat_id_pds"})
    return first_per_key(
        dated,
        ["imei", "trip_end_date_pds", "download_date_pds"],
        [F.col("end").desc_nulls_last(), F.col("trip_id_pds").asc_nulls_last()],
    )


def clean_trips_from_points(spark, path: str) -> DataFrame:
    return latest_trip_per_day(read_points_trips_csv(spark, path))
