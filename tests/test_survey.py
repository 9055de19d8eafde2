"""Catch lines and trips from a hand-written wide survey."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from shoalcast.plans import catch, features, prices, trips
from shoalcast.schemas import SURVEY_TRIP_COLUMNS

STEM = "species_group_{}_species_group_"
BIN = "no_fish_by_length_group_no_individuals_"
OVER = "no_fish_by_length_group_fish_length_over60"
SPECIES = [
    ("0", None, None, None, None, "none"),
    ("1", 0.01, 3.0, 4.0, 20.0, "fish"),
    ("45", 0.02, 3.0, 1.0, 99.0, "crab"),
]


def survey(spark, records):
    """``records``: dicts of trip fields plus 'groups': {index: {question: text}}."""
    names = list(SURVEY_TRIP_COLUMNS)
    questions = ["species", "food_or_sale", OVER, BIN + "0_5", BIN + "5_10", BIN + "over60", "species_name", "photo"]
    columns = [*names, *[STEM.format(g) + q for g in (0, 1) for q in questions]]
    data = [
        tuple(
            [r.get(n) for n in names] + [r.get("groups", {}).get(g, {}).get(q) for g in (0, 1) for q in questions]
        )
        for r in records
    ]
    return spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in columns))


def species(spark):
    return spark.createDataFrame(SPECIES, "species_code string, a double, b double, minlength double, maxlength double, category string")


def boats(spark):
    return spark.createDataFrame([("350000000012345",), ("350000000112345",), ("350000000099999",)], "imei_long string")


CATCH_CASES = {
    "plain": ({0: {"species": "1", "food_or_sale": "sale", BIN + "5_10": "4"}}, [("1", "sale", 7.5, 4.0, 0.0169, None)]),
    "two_bins": (
        {0: {"species": "1", "food_or_sale": "sale", BIN + "0_5": "1", BIN + "5_10": "3"}},
        [("1", "sale", 6.2, 4.0, 0.0128, None)],
    ),
    "nothing": ({}, []),
    "photo_only": ({0: {"photo": "p.jpg", "species_name": "x"}}, []),
    "no_catch": ({0: {"species": "0"}}, [("0", None, None, None, None, None)]),
    "not_recorded": ({0: {"species": "1"}}, [("1", None, None, None, None, "species_number__not_recorded")]),
    "too_large": ({0: {"species": "1", BIN + "5_10": "30000"}}, [("1", None, None, None, None, "species_number__too_large")]),
    "negative": ({0: {"species": "1", BIN + "5_10": "-3"}}, [("1", None, 7.5, 3.0, 0.0127, "species_number__negative")]),
    "zero": ({0: {"species": "1", BIN + "0_5": "0", BIN + "5_10": "0"}}, [("1", None, None, None, None, "species_number__zero")]),
    "size_large": ({0: {"species": "1", BIN + "over60": "1", OVER: "70"}}, [("1", None, 70.0, 1.0, 3.43, "species_size__too_large")]),
    "size_open": ({0: {"species": "45", BIN + "over60": "2"}}, [("45", None, 60.0, 2.0, 0.1, None)]),
    "unknown_species": ({0: {"species": "77", BIN + "5_10": "2"}}, [("77", None, 7.5, 2.0, None, None)]),
    "same_species_twice": (
        {0: {"species": "45", BIN + "5_10": "2"}, 1: {"species": "45", BIN + "5_10": "3"}},
        [("45", None, 7.5, 5.0, 0.25, None)],
    ),
}


@pytest.fixture(scope="module")
def lines(spark):
    records = [{"uuid": name, "groups": groups} for name, (groups, _) in CATCH_CASES.items()]
    df = catch.clean_catch(survey(spark, records), species(spark)).withColumn("weight", F.round("weight", 4))
    found = {}
    for r in df.collect():
        found.setdefault(r["record_id"], []).append(tuple(r[1:]))
    return found


@pytest.mark.parametrize("name", CATCH_CASES)
def test_catch_lines(lines, name):
    assert lines.get(name, []) == CATCH_CASES[name][1]


def test_empty_bins_do_not_change_catch_lines(spark, rows):
    records = [{"uuid": name, "groups": groups} for name, (groups, _) in CATCH_CASES.items()]
    full = catch.species_lines(survey(spark, records), all_bins=True)
    joined = full.join(species(spark).drop("category"), "species_code", "left")
    assert rows(catch.catch_lines(catch.flag_lines(joined))) == rows(catch.clean_catch(survey(spark, records), species(spark)))


def test_size_flags_in_single_line_groups_only(spark):
    records = [{"uuid": "size_large", "groups": CATCH_CASES["size_large"][0]}]
    out = catch.clean_catch(survey(spark, records), species(spark), size_flag_mode="reference").first()
    assert out["species_flags"] is None


BASE = {"end": "2020-05-10T10:00:00.000+09:00", "date": "2020-05-10", "trip_group_has_boat": "TRUE", "total_catch_value": "10"}
SOLD = {"groups": {0: {"species": "45", "food_or_sale": "sale", BIN + "5_10": "2"}}}
FOOD = {"groups": {0: {"species": "45", "food_or_sale": "food", BIN + "5_10": "2"}}}
TRIP_CASES = {
    "imei_negative": ({"trip_group_imei": "-12345"}, {"n": 2, "flags": None}),
    "imei_small": ({"trip_group_imei": "9998"}, {"trip_imei": None, "flags": "imei__not_found"}),
    "imei_edge": ({"trip_group_imei": "9999"}, {"trip_imei": "350000000099999", "flags": None}),
    "imei_text": ({"trip_group_imei": "abc"}, {"trip_imei": None, "flags": "imei__not_found"}),
    "imei_missing": ({}, {"trip_imei": None, "flags": None}),
    "registration_bad": ({"trip_group_boat_reg_no": "a1"}, {"boat_registration": None, "flags": "boat_registration__invalid"}),
    "registration_good": ({"trip_group_boat_reg_no": "ab12"}, {"boat_registration": "AB 12 ", "flags": None}),
    "hours_zero": ({"trip_group_duration": "0"}, {"trip_duration": None, "flags": "trip_duration__zero_hours"}),
    "hours_negative": ({"trip_group_duration": "-5"}, {"trip_duration": 5.0, "flags": None}),
    "hours_max": ({"trip_group_duration": "72"}, {"trip_duration": 72.0, "flags": None}),
    "hours_long": ({"trip_group_duration": "73"}, {"trip_duration": None, "flags": "trip_duration__too_long"}),
    "hours_text": ({"trip_group_duration": "x"}, {"trip_duration": None, "flags": "trip_duration__too_long"}),
    "land": ({"trip_group_has_boat": "false"}, {"trip_platform": "land"}),
    "platform_unknown": ({"trip_group_has_boat": "1"}, {"trip_platform": None}),
    "date_future": ({"date": "2020-05-11"}, {"flags": "trip_date__trip_is_in_future"}),
    "date_30_days": ({"date": "2020-04-10"}, {"flags": None}),
    "date_31_days": ({"date": "2020-04-09"}, {"flags": "trip_date__trip_date_too_old"}),
    "date_next_local_day": ({"end": "2020-05-10 15:30:00", "date": "2020-05-11"}, {"flags": None}),
    "mesh_other": ({"trip_group_mesh_size": "seluk", "trip_group_mesh_size_other": "2.5"}, {"gear_mesh_size": 2.5, "flags": None}),
    "mesh_bad": (
        {"trip_group_mesh_size": "seluk", "trip_group_mesh_size_other": "x"},
        {"gear_mesh_size": None, "flags": "gear_mesh_size__invalid"},
    ),
    "mesh": ({"trip_group_mesh_size": "3"}, {"gear_mesh_size": 3.0}),
    "crew_zero": (
        {f"trip_group_no_fishers_no_{w}_fishers": "0" for w in ("men", "women", "child")},
        {"fisher_number_total": None, "flags": "fisher_number__zero_fishers"},
    ),
    "crew_partly": ({"trip_group_no_fishers_no_men_fishers": "2"}, {"fisher_number_total": None, "flags": None}),
    "value_missing_no_catch": ({"total_catch_value": None, "groups": {0: {"species": "0"}}}, {"trip_value": 0.0, "trip_catch": 0.0}),
    "value_missing_catch": ({"total_catch_value": None, **SOLD}, {"trip_value": None, "flags": "trip_value_not_recorded"}),
    "value_max": ({"total_catch_value": "20000", **SOLD}, {"trip_value": 20000.0, "flags": None}),
    "value_large": ({"total_catch_value": "20001", **SOLD}, {"trip_value": None, "flags": "trip_value__too_large"}),
    "value_zero_food": ({"total_catch_value": "0", **FOOD}, {"trip_value": None, "flags": None, "trip_catch_use": "food"}),
    "value_zero_sale": ({"total_catch_value": "0", **SOLD}, {"trip_value": None, "flags": "trip_value__is_zero"}),
    "catch_repaired": (
        {"total_catch_value": "0", "groups": {0: {"species": "77", BIN + "5_10": "2"}}},
        {"trip_catch": None, "trip_value": None},
    ),
    "both_uses": (
        {"groups": {**SOLD["groups"], 1: {"species": "45", "food_or_sale": "food", BIN + "5_10": "1"}}},
        {"trip_catch_use": "both", "trip_n_species": 1},
    ),
}


@pytest.fixture(scope="module")
def clean(spark):
    records = [{**BASE, "uuid": name, **fields} for name, (fields, _) in TRIP_CASES.items()]
    wide = survey(spark, records)
    df = trips.clean_trips(wide, catch.clean_catch(wide, species(spark)), boats(spark))
    found = {}
    for r in df.collect():
        found.setdefault(r["record_id"], []).append(r.asDict())
    return found


@pytest.mark.parametrize("name", TRIP_CASES)
def test_trip_rules(clean, name):
    expected = dict(TRIP_CASES[name][1])
    assert len(clean[name]) == expected.pop("n", 1)
    for row in clean[name]:
        assert {k: row[k] for k in expected} == expected


def test_unweighed_catch_flag_before_repair(spark):
    df = spark.createDataFrame([(0.0, None, 0, None, None)], "__value double, trip_catch double, trip_n_species int, trip_platform string, trip_catch_use string")
    assert trips.value_rules(df).first()["trip_catch_flag"] is None
    out = trips.value_rules(df, "before").first()
    assert out["trip_catch_flag"] == "trip_catch__not_properly_recorded" and out["trip_catch"] == 0.0


def test_species_wide(spark):
    data = [
        ("r", "a", "food", 3.0), ("r", "b", "food", 2.0), ("r", "c", "food", 1.0), ("r", "d", None, None),
        ("s", "a", "food", None), ("t", "x", "food", 1.0), ("t", "y", "food", 1.0), ("t", "z", "food", 0.5),
    ]
    df = spark.createDataFrame(data, "record_id string, species_code string, use string, weight double")
    got = {r["record_id"]: tuple(r)[1:] for r in catch.species_wide(df).collect()}
    assert got["r"] == ("a", 3.0, "b", 2.0, "other", 1.0)
    assert got["s"] == ("a", 0.0, "none", 0.0, "none", 0.0)
    assert got["t"] == ("x", 1.0, "y", 1.0, "z", 0.5)


def test_species_columns_come_with_the_trips(spark, rows):
    raw = survey(spark, [{**BASE, "uuid": name, "trip_group_imei": digits} for name, digits in [("r", None), ("r", None), ("s", "12345"), ("t", "x"), ("u", None)]])
    data = [
        ("r", "a", "food", 3.0, None), ("r", "a", "sale", 2.0, "species_number__zero"), ("r", "0", None, None, None), ("r", "d", None, None, None),
        ("s", "a", "food", None, None), ("t", "x", "sale", 1.0, None), ("t", "x", None, 1.0, None), ("t", "z", "sale", 0.5, None), (None, "z", "food", 1.0, None),
    ]
    lines = spark.createDataFrame(data, "record_id string, species_code string, use string, weight double, species_flags string")
    apart = catch.widen_trip_catch(trips.clean_trips(raw, lines, boats(spark)), lines)
    once = catch.widen_trip_catch(trips.clean_trips(raw, lines, boats(spark), n_top_species=2))
    assert once.columns == apart.columns and once.schema.simpleString() == apart.schema.simpleString()
    assert rows(once) == rows(apart) and once.count() >= 5
    # The lines are read once, where trips and species columns are made apart twice.
    leaves = lambda df: df._jdf.queryExecution().optimizedPlan().collectLeaves().length()
    assert leaves(once) == leaves(apart) - 1


def wide_trips(spark):
    data = [
        (f"r{i}", "boat" if i % 5 else "land", date(2020, 1 + i % 3, 1 + i % 27), f"s{i % 2}", "GN" if i % 3 else "HL", "1",
         10.0, (5.0 if i % 2 else 2.0) * (100 if i == 7 else 1), None if i % 4 else "x",
         "a" if i % 2 else "b", 8.0, "c", 2.0, "none", 0.0)
        for i in range(1, 80)
    ]
    return spark.createDataFrame(
        data,
        """record_id string, trip_platform string, trip_date date, trip_landing_site string, trip_gear string, boat_type string,
        trip_catch double, trip_price double, flags string, species_code_1 string, weight_1 double, species_code_2 string,
        weight_2 double, species_code_other string, weight_other double""",
    ).withColumn("trip_value", F.col("trip_price") * F.col("trip_catch"))


def test_price_flags_and_features(spark):
    wide = wide_trips(spark)
    estimates, overall = prices.species_price_draws(wide.where("trip_platform = 'boat'"), 30)
    flagged = prices.add_price_flags(wide, estimates, overall, 30)
    by_id = {r["record_id"]: r for r in flagged.collect()}
    assert len(by_id) == 79
    assert by_id["r7"]["flags"] == "trip_catch__price_per_kg_extremely_large"
    assert by_id["r4"]["flags"] == "x" and by_id["r1"]["flags"] is None
    interval = prices.price_interval(wide, estimates, overall, 30)
    assert interval.where("price_lower > price_upper or price_lower is null").count() == 0
    stations = spark.createDataFrame([("s0", "Place"), ("s1", None)], "station_code string, municipality_name string")
    assert features.catch_features(flagged, stations).count() == 39
    gears = features.gear_features(flagged, stations)
    assert gears.agg(F.sum("size")).first()[0] == 39
    assert gears.where("`tg.GN` + `tg.HL` != size").count() == 0
    assert prices.price_features(wide, stations, "year").where("period_static != '2020-01-01'").count() == 0


def test_merge_trips(spark, rows):
    survey_trips = spark.createDataFrame([("a", "i1", date(2020, 1, 1)), ("b", None, date(2020, 1, 1))], "record_id string, trip_imei string, trip_date date")
    tracked = spark.createDataFrame(
        [("i1", date(2020, 1, 1), "t1"), ("i2", date(2020, 1, 1), "t2"), (None, date(2020, 1, 1), "t3")],
        "imei string, trip_end_date_pds date, trip_id_pds string",
    )
    out = trips.merge_trips(survey_trips, tracked).select("record_id", "trip_imei", "trip_id_pds")
    assert rows(out) == [("a", "i1", "t1"), ("b", None, None), (None, "i2", "t2")]


def test_devices_are_matched_alone_where_every_record_has_an_id(spark, rows):
    boats = spark.createDataFrame([("350000000012345",), ("350000000912345",), ("350000000077777",)], "imei_long string")
    typed = [("a", "-12345"), ("a", "-12345"), ("a", "77777"), ("b", "12345"), ("c", "99999"), ("d", None), ("e", "12")]
    survey = spark.createDataFrame(typed, "uuid string, trip_group_imei string").withColumn("other", F.lit("x"))
    named = survey.withColumn("uuid", F.concat_ws("-", "uuid"))
    assert survey.schema["uuid"].nullable and not named.schema["uuid"].nullable
    for most in (100, 1):
        old = trips.match_imei(survey, boats, most).select("uuid", "other", "trip_imei", "boat_imei_flag")
        new = trips.match_imei(named, boats, most)
        assert rows(new.select(*old.columns)) == rows(old)
    # The fields meet their devices by record: they are dealt by it and not by digits.
    dealt = [line for line in new._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join LeftOuter" in line]
    assert "uuid" in dealt[0] and "__record" in dealt[0]


def test_typed_devices_are_parsed_once(spark, rows):
    boats = spark.createDataFrame([("350000000012345",), ("350000000077777",)], "imei_long string")
    typed = [("a", "-12345"), ("b", "7777.0"), ("c", "77777"), ("d", None), ("e", "x")]
    survey = spark.createDataFrame(typed, "id string, trip_group_imei string").select(F.concat_ws("-", "id").alias("uuid"), "trip_group_imei")
    for most in (100, 1):
        matched = trips.match_imei(survey, boats, most)
        assert rows(matched.select("uuid", "trip_imei")) == [
            ("a", "350000000012345"), ("b", None), ("c", "350000000077777"), ("d", None), ("e", None)
        ]
        # The test for digits is not pushed down to the text, where it would repeat the parsing.
        plan = matched._jdf.queryExecution().optimizedPlan().toString().splitlines()
        assert not [line for line in plan if "Filter" in line and "RLIKE" in line]
