"""Rules on single values: each fires once, does not fire once, and meets NULL."""

import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from shoalcast.functions import dates, flags, names, numeric, text


def apply(spark, fn, *values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").select("o").collect()]


def test_clean_names():
    assert names.clean_names(["Boat ID", "lastSeen", "IMEI", "a.b", "a b", "1st", "Share %"]) == [
        "boat_id", "last_seen", "imei", "a_b", "a_b_2", "x1st", "share_percent",
    ]


def test_to_number_rejects_java_spellings(spark):
    assert apply(spark, text.to_number, "12", " 1.5 ", "-3e2", "12d", "NaN", "x", "", None) == [
        12.0, 1.5, -300.0, None, None, None, None, None,
    ]


def test_first_number_and_decimal_comma(spark):
    assert apply(spark, text.first_number, "12.3 km", "about 7", "--", None) == [12.3, 7.0, None, None]
    assert apply(spark, text.decimal_comma, "1.234,5", "7", "x") == [1234.5, 7.0, None]


def test_duration(spark):
    assert apply(spark, text.duration_seconds, "3h 20m", "45m", "1d 2H", "soon", None) == [12000.0, 2700.0, 93600.0, None, None]


def test_two_format_date(spark):
    assert apply(spark, dates.two_format_date, "3/15/19", "15/3/2019", "15-03-2019", "3/15/75", "x", None) == [
        date(2019, 3, 15), date(2019, 3, 15), date(2019, 3, 15), date(1975, 3, 15), None, None,
    ]


def test_local_date_changes_at_three_pm_utc(spark):
    fn = lambda c: dates.local_date(dates.parse_timestamp(c))
    assert apply(spark, fn, "2020-05-01 14:59:59", "2020-05-01 15:30:00", None) == [date(2020, 5, 1), date(2020, 5, 2), None]


def test_weeks(spark):
    days = (date(2019, 12, 30), date(2020, 1, 5), date(2020, 1, 1), None)
    assert apply(spark, dates.floor_week, *days, kind="date") == [date(2019, 12, 29), date(2020, 1, 5), date(2019, 12, 29), None]
    assert apply(spark, dates.week_number, *days, kind="date") == [52, 1, 1, None]


def test_month_sequence_has_fifty_months(spark):
    assert spark.range(1).select(F.size(dates.month_sequence("2017-01-01", "2021-02-28"))).first()[0] == 50


def test_bin_midpoint(spark):
    bins = ("no_fish_0_5", "no_fish_5_10", "fish_over60", "species", None)
    assert apply(spark, text.bin_midpoint, *bins) == [2.5, 7.5, 60.0, None, None]
    assert [text.bin_midpoint_of_name(b) for b in bins[:4]] == [2.5, 7.5, 60.0, None]


def test_registration_keeps_trailing_blank(spark):
    assert apply(spark, text.boat_registration, "ab12", "AB 123 cd", "ab12cd", "a1", None) == [
        "AB 12 ", "AB 123 CD", "AB 12 CD", None, None,
    ]


def test_platform(spark):
    assert apply(spark, text.platform_label, "TRUE", "false", "1", None) == ["boat", "land", None, None]


def test_sanitize(spark):
    hours = lambda c: numeric.sanitize_numeric(c, absolute=True, maximum=72, zero_is_null=True)
    assert apply(spark, hours, 0.0, -5.0, 72.0, 73.0, 1500.0, None, kind="double") == [None, 5.0, 72.0, None, None, None]


def test_cube_root_rounds_half_to_even_and_rejects_negatives(spark):
    assert apply(spark, numeric.cube_root_units, 1.0, 0.0, -1.0, None, kind="double") == [10.0, 0.0, None, None]
    assert apply(spark, numeric.from_cube_root, 10.0, kind="double") == [1.0]


def test_fish_weight_constants(spark):
    df = spark.createDataFrame([("45",), ("24",), ("50",), ("1",)], "c string")
    out = df.select(numeric.fish_weight_kg(F.col("c"), F.lit(0.01), F.lit(3.0), F.lit(10.0))).collect()
    assert [r[0] for r in out] == [0.05, 1.0, 0.006, 0.01]


@pytest.mark.parametrize(
    "price, factor, flag",
    [
        (1.5, None, None),
        (20.0, 10.0, "trip_catch__price_per_kg_extremely_large"),
        (0.1, 0.1, "trip_catch__price_per_kg_extremely_small"),
        (8.0, 4.0, "trip_catch__price_per_kg_too_large"),
        (0.25, 0.25, "trip_catch__price_per_kg_too_small"),
    ],
)
def test_price_flags(spark, price, factor, flag):
    df = spark.range(1).select(numeric.residual_factor(F.lit(price), F.lit(1.0), F.lit(2.0)).alias("f"))
    got, name = df.select("f", flags.price_flag(F.col("f"))).first()
    assert name == flag
    if factor:
        assert math.isclose(got, factor)


def test_zero_price_has_no_factor(spark):
    assert spark.range(1).select(numeric.residual_factor(F.lit(0.0), F.lit(1.0), F.lit(2.0))).first()[0] is None


def test_flag_texts(spark):
    df = spark.createDataFrame([("species_size__too_small", None), ("species_number__zero", "species_size__too_small"), (None, None)], "a string, b string")
    joined = df.agg(flags.collect_flags(F.col("a"), F.col("b"))).first()[0]
    assert joined == "species_number__zero;species_size__too_small"
    assert df.where("a is null").agg(flags.collect_flags(F.col("a"))).first()[0] is None
    kept = spark.createDataFrame([("x;trip_catch__price_per_kg_too_large",), ("x",), (None,)], "f string")
    assert kept.where(flags.without_price_flag(F.col("f"))).count() == 2
