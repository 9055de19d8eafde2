"""Column lists of the inputs.  Text inputs are read as strings and converted with ``try_*``."""

from __future__ import annotations

from pyspark.sql import types as T


def text_schema(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# Point files: known columns; files carry some more that no step reads.
POINT_COLUMNS = ["time", "trip", "boat", "boat_name", "community", "range_meters", "imei"]

TRIPS_FROM_POINTS = text_schema(
    "trip", "start", "end", "range", "boat_id", "boat_name", "community", "imei", "day"
)

# Fixed names: the survey questions that the trip cleaning reads.
SURVEY_TRIP_COLUMNS = [
    "date",
    "deviceid",
    "end",
    "happiness_rating",
    "landing_site_name",
    "total_catch_value",
    "trip_group_boat_reg_no",
    "trip_group_boat_type",
    "trip_group_duration",
    "trip_group_gear_type",
    "trip_group_habitat_boat",
    "trip_group_has_boat",
    "trip_group_imei",
    "trip_group_mesh_size",
    "trip_group_mesh_size_other",
    "trip_group_no_fishers_no_child_fishers",
    "trip_group_no_fishers_no_men_fishers",
    "trip_group_no_fishers_no_women_fishers",
    "uuid",
]

# The nine gears of the gear model.
GEARS = ["GN", "CN", "HL", "LL", "SG", "BS", "MC", "SN", "TP"]

# Boat type names of the census and their registry codes.
BOAT_CODES = {"canoe": "1", "motor": "2"}
CENSUS_CODES = {"canoes": "1", "motors": "2"}

# Fixed value: the local calendar.
LOCAL_TZ = "Asia/Dili"
