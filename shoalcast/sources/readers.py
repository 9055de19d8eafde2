"""CSV inputs (S1-S8, S13, S14, S17).  Everything is read as text and converted here."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoalcast.functions.dates import parse_timestamp, two_format_date
from shoalcast.functions.names import mutate_strings, with_clean_names
from shoalcast.functions.text import (
    MUNICIPALITY_FIXES,
    decimal_comma,
    duration_seconds,
    first_number,
    fix_values,
    null_sentinel,
    to_number,
)
from shoalcast.operators.windows import latest_version
from shoalcast.schemas import TRIPS_FROM_POINTS


def read_text_csv(spark: SparkSession, path: str, sep: str = ",", multi_line: bool = False) -> DataFrame:
    """CSV with a header, every column text, snake_case names.  Only the header is looked at.

    ``multi_line`` reads quoted values with line breaks whole; a file is then one task.
    """
    raw = spark.read.options(header=True, sep=sep, quote='"', escape='"', multiLine=multi_line).csv(path)
    return with_clean_names(raw)


def convert(df: DataFrame, numbers=(), longs=(), parse=to_number) -> DataFrame:
    present = set(df.columns)
    casts = {c: parse(F.col(c)) for c in numbers if c in present}
    casts |= {c: parse(F.col(c)).cast("long") for c in longs if c in present}
    return df.withColumns(casts) if casts else df


def read_boats_csv(spark: SparkSession, path: str, numbers: tuple[str, ...] = ()) -> DataFrame:
    """Devices: ';' separated, decimal comma in ``numbers``, '--' is NULL."""
    df = mutate_strings(read_text_csv(spark, path, ";"), null_sentinel)
    return convert(df, numbers, parse=decimal_comma).withColumns(
        {"imei_long": F.col("imei"), "last_seen": parse_timestamp(F.col("last_seen"))}
    )


def read_trips_csv(spark: SparkSession, path: str) -> DataFrame:
    """Trip export: ';' separated, units stripped, duration in seconds."""
    df = mutate_strings(read_text_csv(spark, path, ";"), null_sentinel)
    return df.withColumns(
        {
            "start": parse_timestamp(F.col("start")),
            "end": parse_timestamp(F.col("end")),
            "distance": first_number(F.col("distance")),
            "range": first_number(F.col("range")),
            "duration": duration_seconds(F.col("duration")),
        }
    )


def read_points_trips_csv(spark: SparkSession, path: str) -> DataFrame:
    """Trips made from points, as written by this package (S3)."""
    df = spark.read.schema(TRIPS_FROM_POINTS).options(header=True).csv(path)
    return df.withColumns(
        {
            "start": parse_timestamp(F.col("start")),
            "end": parse_timestamp(F.col("end")),
            "range": to_number(F.col("range")),
            "day": F.col("day").try_cast("date"),
        }
    )


def read_species_csv(spark: SparkSession, path: str) -> DataFrame:
    return convert(read_text_csv(spark, path), ["a", "b", "minlength", "maxlength"])


def read_boat_registry_csv(spark: SparkSession, path: str) -> DataFrame:
    """Boat registry: all text but the installation date."""
    return read_text_csv(spark, path).withColumns(
        {
            "imei_long": F.col("imei"),
            "installation_date": two_format_date(F.col("installation_date")),
            "municipality_name": fix_values(F.col("municipality_name"), MUNICIPALITY_FIXES),
        }
    )


def read_municipalities_csv(spark: SparkSession, path: str) -> DataFrame:
    df = read_text_csv(spark, path).where(F.col("municipality_code").isNotNull())
    return convert(df, longs=["canoes", "motors", "fishers"])


def read_stations_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_text_csv(spark, path)


def read_survey_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Landing survey, as wide as its header, latest version of each record.

    Answers are free text and may hold line breaks.  Versions of the same time are told apart by all columns.
    """
    survey = read_text_csv(spark, path, multi_line=multi_line)
    return latest_version(survey, "uuid", "end", tie=[c for c in survey.columns if c not in ("uuid", "end")])


def read_gz_shards(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Gzip CSV shards as one table (S17).  Gzip cannot be split, so rows are spread after the scan."""
    df = read_text_csv(spark, path)
    return df.repartition(partitions) if partitions else df


def warehouse_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table as a lazy scan."""
    return spark.read.table(name)


def time_filtered(df: DataFrame, since: str, column: str = "time") -> DataFrame:
    """Rows from ``since`` on (S14).  The literal takes the column's type, so it reaches the scan."""
    kind = df.schema[column].dataType
    return df.where(F.col(column) >= F.lit(since).cast(kind))
