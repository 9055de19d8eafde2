"""Outputs (S15, S16)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV folder with a header in every part."""
    df.write.mode(mode).options(header=True).csv(path)


def write_csv_by_day(df: DataFrame, path: str, day: str = "day", mode: str = "errorifexists") -> None:
    """CSV files with a header, in one folder for each day whose name the reader finds again."""
    df.write.mode(mode).options(header=True).partitionBy(day).csv(path)


def write_by_day(df: DataFrame, path: str, day: str = "day", mode: str = "overwrite") -> None:
    """Parquet with one folder per day, the form to prefer between steps.

    ``overwrite`` replaces the days that ``df`` holds and keeps all others, so a daily run can be repeated.  Rows are
    dealt by day and hash, so a day of any size is written by several tasks.
    """
    spread = F.pmod(F.xxhash64(*df.columns), F.lit(8))
    dealt = df.repartition(day, spread)
    dealt.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def export_gzip_csv(df: DataFrame, directory: str, name: str, stamp: str, rows_per_file: int = 5_000_000) -> str:
    """Gzip CSV shards in a date-stamped folder (S15); returns the folder."""
    target = f"{directory.rstrip('/')}/{name}_{stamp}"
    df.write.options(header=True, compression="gzip", maxRecordsPerFile=rows_per_file).csv(target)
    return target
