"""Daily point files.

A folder is one text scan: lines know their file, header lines are told by the names in them and joined to the
other lines of their file, which then hand over their fields by name.  The number of Spark jobs does not grow with the
files.  Files without a point are an anti join of the folder's listing, one short row a file and day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoalcast.functions.dates import parse_timestamp
from shoalcast.functions.text import to_number
from shoalcast.schemas import POINT_COLUMNS

DAY_PATTERN = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
# Fields of a line that are looked at.
MOST_FIELDS = 64


def day_of_path(path: Column) -> Column:
    """First ISO date in a file name."""
    return F.nullif(F.regexp_extract(path, DAY_PATTERN, 0), F.lit("")).try_cast("date")


def clean_name(field: Column) -> Column:
    """A header field as a snake-case name."""
    return F.trim(F.regexp_replace(F.lower(F.trim(field)), "[^a-z0-9]+", "_"), F.lit("_"))


def listed_files(lines: DataFrame) -> DataFrame:
    """(path) of the files of a scan, empty ones included: the listing Spark itself has made of them."""
    return lines.sparkSession.createDataFrame([(path,) for path in lines.inputFiles()], "path string")


def scan_point_files(spark: SparkSession, directory: str, pattern: str = "*") -> tuple[DataFrame, DataFrame]:
    """All points of a folder, and (day) of each file that holds none.  Columns a file lacks are NULL.

    A header is a line that names a time and a trip; a file without one, or with nothing below it, holds no points.
    """
    options = {"pathGlobFilter": pattern, "recursiveFileLookup": True}
    fields = ", ".join(f"c{i} string" for i in range(MOST_FIELDS))
    lines = spark.read.options(**options).text(directory)
    parsed = lines.where(F.length("value") > 0).select(F.col("_metadata.file_path").alias("path"), F.from_csv("value", fields).alias("c"))
    parts = parsed.select("path", F.array(*[f"c.c{i}" for i in range(MOST_FIELDS)]).alias("fields"))
    named = parts.withColumn("names", F.transform("fields", clean_name))
    is_header = F.array_contains("names", "time") & F.array_contains("names", "trip")
    headers = named.where(is_header).groupBy("path").agg(F.min("names").alias("names"))
    rows = named.where(~F.coalesce(is_header, F.lit(False))).drop("names").join(headers, "path")
    value = lambda name: F.get("fields", (F.array_position("names", name) - 1).cast("int"))
    points = rows.select("path", *[F.when(F.array_contains("names", c), value(c)).alias(c) for c in POINT_COLUMNS])
    typed = points.withColumns(
        {
            "time": parse_timestamp(F.col("time")),
            "range_meters": to_number(F.col("range_meters")),
            "day": day_of_path(F.col("path")),
        }
    )
    # The listing and the text scan may spell a local path with one slash or three.
    plain = F.regexp_replace("path", "^file:/+", "file:/")
    full = points.select(plain.alias("path")).distinct()
    empty = listed_files(lines).select(plain.alias("path")).join(full, "path", "left_anti")
    return typed.drop("path"), empty.select("path", day_of_path(F.col("path")).alias("day"))


def read_point_files(spark: SparkSession, directory: str, pattern: str = "*") -> tuple[DataFrame, list[str]]:
    """All points of a folder, and the paths of the files that hold none."""
    points, empty = scan_point_files(spark, directory, pattern)
    return points, [r["path"] for r in empty.collect()]
