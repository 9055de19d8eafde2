"""Trips from points, the boat assignment and the daily panel."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shoalcast.functions import dates
from shoalcast.operators.aggregates import activity_cells
from shoalcast.plans import activity, points, totals
from shoalcast.sources import readers, writers
from shoalcast.sources.points import read_point_files

TRIPS = "trip_id_pds string, imei string, boat_id_pds string, trip_start_date_pds date, trip_end_date_pds date, `end` timestamp, download_date_pds date"
BOATS = "imei string, boat_id string, boat_code string, municipality_name string, installation_date date"
DAY = date(2020, 1, 1)


def trip(i, imei, offset, boat="b", download=None):
    day = DAY + timedelta(offset)
    return (f"t{i}", imei, boat, day, day, datetime.combine(day, datetime.min.time()), DAY + timedelta(offset if download is None else download))


def random_world():
    rng = random.Random(11)
    trips = [trip(i, rng.choice(["a", "a", "b", "c", "d", "x"]), rng.randrange(60)) for i in range(80)]
    trips += [trip(i, trips[i][1], rng.randrange(60), download=90) for i in range(0, 20, 3)]
    boats = [("a", "b1", "1", "M", DAY + timedelta(5)), ("a", "b2", "2", "N", DAY + timedelta(30)), ("b", "b3", "1", "M", None),
             ("c", "b4", "1", "M", DAY), ("c", "b5", "2", "N", None), ("d", "b6", "2", "M", DAY + timedelta(100))]
    return trips, boats


def test_assign_boats_reference_against_brute_force(spark, rows):
    trips, boats = random_world()
    got = activity.assign_boats(spark.createDataFrame(trips, TRIPS), spark.createDataFrame(boats, BOATS), "reference")
    expected = []
    pairs = [(t, b) for t in trips for b in ([x for x in boats if x[0] == t[1]] or [None])]
    for t, b in pairs:
        group = [(u, c) for u, c in pairs if u[0] == t[0]]
        gaps = [(u[4] - c[4]).days if c and c[4] else None for u, c in group]
        own = (t[4] - b[4]).days if b and b[4] else None
        if len(group) == 1 or (None not in gaps and own > 0 and own == min(gaps)):
            expected.append((t[0], t[4], b[2] if b else None))
    assert rows(got.select("trip_id_pds", "trip_end_date_pds", "boat_code")) == sorted(expected, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_assign_boats_asof_against_brute_force(spark):
    trips, boats = random_world()
    got = activity.assign_boats(spark.createDataFrame(trips, TRIPS), spark.createDataFrame(boats, BOATS))
    found = {r["trip_id_pds"]: r["boat_code"] for r in got.collect()}
    assert got.count() == len(found)
    latest = {}
    for t in trips:
        if t[0] not in latest or t[5] > latest[t[0]][5]:
            latest[t[0]] = t
    for key, t in latest.items():
        own = [b for b in boats if b[0] == t[1]]
        earlier = sorted((b[4], b[2]) for b in own if b[4] and b[4] < t[4])
        if len(own) > 1 and not earlier:
            assert key not in found
        else:
            assert found[key] == (own[0][2] if len(own) == 1 else earlier[-1][1] if own else None)


def panel(spark, **options):
    trips = [trip(1, "a", 0), trip(2, "a", 4), trip(3, None, 2, download=2), (None, "a", "b", None, None, None, DAY)]
    boats = [("a", "b1", "1", "M", DAY)]
    devices = spark.createDataFrame(
        [("a", datetime(2020, 1, 8, 20)), ("a", datetime(2020, 1, 4, 20)), ("z", datetime(2020, 1, 8))], "imei string, last_seen timestamp"
    )
    return activity.format_vessel_activity(spark.createDataFrame(trips, TRIPS), spark.createDataFrame(boats, BOATS), devices, **options)


def test_panel_fills_days_and_drops_outages(spark):
    out = panel(spark).orderBy("trip_end_date_pds", "trip_activity").collect()
    got = [(r["trip_end_date_pds"].day, r["trip_activity"]) for r in out]
    # 2 and 3 January are outage days; the 5th has a trip and a last-seen row.
    assert got == [(1, 1.0), (4, 0.0), (5, 0.0), (5, 1.0), (6, 0.0), (7, 0.0), (8, 0.0), (9, 0.0)]
    assert {r["individual_boat"] for r in out} == {"a b"} and {r["municipality_name"] for r in out} == {"M"}


@pytest.mark.parametrize(
    "options, days",
    [
        ({"dedupe_last_seen": True}, 7),
        ({"include_last_seen_info": False}, 3),
        ({"correct_empty_days": False}, 10),
        ({"asof_mode": "reference"}, 8),
    ],
)
def test_panel_options(spark, options, days):
    assert panel(spark, **options).count() == days


def test_cells_and_coverage(spark):
    weekly = panel(spark, period_static_unit="week", period_seasonal_function=dates.week_number)
    assert activity_cells(weekly).agg(F.sum("n_days"), F.sum("n_trips")).first()[:] == (8, 2.0)
    census = spark.createDataFrame([("M", 4, 0)], "municipality_name string, canoes long, motors long")
    report = activity.coverage_report(panel(spark), census)
    assert report["coverage"].first()["prop_boats"] == 0.25
    assert report["boat_span"].first()["last_heard"] == date(2020, 1, 9)
    assert report["municipality_order"].first()["municipality_name"] == "M"


def test_point_files(spark, tmp_path, rows):
    folder = tmp_path / "points"
    folder.mkdir()
    head = "Time,Trip,Boat,Boat Name,Community,Range Meters"
    (folder / "all_2020-01-01.csv").write_text(head + ",Imei\n2020-01-01 10:00:00,t1,b,B,C,5,i1\n2020-01-01 09:00:00,t1,b0,B0,C0,7,i0\n")
    (folder / "all_2020-01-02.csv").write_text("Imei," + head + "\ni9,2020-01-02 10:00:00,t2,b,B,C,1\n")
    (folder / "all_2020-01-03.csv").write_text(head + "\n2020-01-03 10:00:00,t3,b,B,C,1\n")
    (folder / "all_2020-01-04.csv").write_text(head + ",Imei\n")
    (folder / "all_2020-01-05.csv").write_text("")
    (folder / "all_2020-01-06.csv").write_text("nothing\nhere\n")
    (folder / "other.txt").write_text("a,b\n1,2\n")
    frame, empty = read_point_files(spark, str(folder), "all_*")
    assert frame.count() == 4 and len(empty) == 3
    trips = points.points_to_trips(spark, str(folder), "all_*")
    got = rows(trips.select("trip", "boat_id", "imei", "range", "day"))
    assert got[:3] == [("t1", "b0", "i0", 7.0, date(2020, 1, 1)), ("t2", "b", "i9", 1.0, date(2020, 1, 2)), ("t3", "b", None, 1.0, date(2020, 1, 3))]
    assert [r[4].day for r in got[3:]] == [4, 5, 6]
    target = str(tmp_path / "trips")
    writers.write_csv(trips, target)
    back = points.clean_trips_from_points(spark, target)
    assert back.where("trip_id_pds is not null").count() == 3
    assert back.where("download_date_pds is not null").count() == 6
    writers.write_by_day(trips, str(tmp_path / "byday"))
    assert spark.read.parquet(str(tmp_path / "byday")).where("day = '2020-01-02'").count() == 1
    folder_out = writers.export_gzip_csv(trips, str(tmp_path), "points", "2020-01-07")
    assert readers.read_gz_shards(spark, folder_out, 3).count() == 6


def test_readers(spark, tmp_path):
    def path(name, content):
        (tmp_path / name).write_text(content)
        return str(tmp_path / name)

    boat = readers.read_boats_csv(spark, path("b.csv", "IMEI;Last Seen;Depth;Note\n350000000012345;2020-01-01 10:00:00;1,5;--\n--;--;--;x\n"), ("depth",)).collect()
    assert boat[0]["imei_long"] == "350000000012345" and boat[0]["depth"] == 1.5 and boat[0]["note"] is None
    assert boat[1]["imei"] is None and boat[1]["last_seen"] is None
    row = readers.read_trips_csv(spark, path("t.csv", "Start;End;Distance;Range;Duration;Trip ID\n2020-01-01 10:00:00;--;12.3 km;4 m;3h 20m;7\n")).first()
    assert (row["distance"], row["range"], row["duration"], row["trip_id"], row["end"]) == (12.3, 4.0, 12000.0, "7", None)
    registry = readers.read_boat_registry_csv(spark, path("r.csv", "Boat ID,IMEI,Municipality Name,Installation Date\n1,35,Manatutu,3/15/19\n2,,Dili,15/3/2019\n")).collect()
    assert registry[0]["municipality_name"] == "Manatuto" and {r["installation_date"] for r in registry} == {date(2019, 3, 15)}
    places = readers.read_municipalities_csv(spark, path("m.csv", "municipality_code,municipality_name,canoes\n1,A,3\n,B,4\n"))
    assert [tuple(r) for r in places.collect()] == [("1", "A", 3)]
    fish = readers.read_species_csv(spark, path("s.csv", "species_code,a,b\n01,0.5,x\n")).first()
    assert tuple(fish) == ("01", 0.5, None)
    survey = readers.read_survey_csv(spark, path("k.csv", "uuid,end,v\na,2020,1\na,2021,2\nb,2020,3\nb,,4\n"))
    assert sorted((r["uuid"], r["v"]) for r in survey.collect()) == [("a", "2"), ("b", "4")]
    events = spark.createDataFrame([(datetime(2020, 1, 1),), (datetime(2021, 1, 1),)], "time timestamp")
    assert readers.time_filtered(events, "2020-06-01").count() == 1
    events.createOrReplaceTempView("tracks")
    assert readers.warehouse_table(spark, "tracks").count() == 2


def test_totals_with_and_without_gear(spark):
    rng = random.Random(2)
    rows_in = [(f"r{i}", f"M{i % 3}", "1" if i % 2 else "2", "GN" if i % 3 else "HL", date(2020, 1 + i % 2, 1), "1", float(3 + rng.randrange(4)), float(5 + i % 2)) for i in range(120)]
    trips = spark.createDataFrame(rows_in, "record_id string, municipality_name string, boat_type string, trip_gear string, period_static date, period_seasonal string, trip_catch_po_3 double, trip_value_po_3 double")
    cells = spark.createDataFrame(
        [(date(2020, 1 + i % 2, 1), f"boat{i}", "1" if i % 2 else "2", f"M{i % 3}", "1", 30, i % 20) for i in range(60)],
        "period_static date, individual_boat string, boat_code string, municipality_name string, period_seasonal string, n_days long, n_trips long",
    )
    census = spark.createDataFrame([("M0", 10, 5), ("M1", 4, 0), ("M9", 1, 1)], "municipality_name string, canoes long, motors long")
    out = totals.national_totals(cells, trips, trips, trips, census, "2020-01-01", "2020-03-31", draws=8)
    assert out.without_gear.count() == 3 * 2 * 3 * 8
    assert out.without_gear.where("total_weight is null or total_value is null").count() == 0
    split = out.with_gear.groupBy(*totals.CELL, "draw").agg(F.sum("gear_prop").alias("p"), F.sum("n_trips").alias("t"), F.first("n_trips_total").alias("all"))
    assert split.where("abs(p - 1) > 1e-9 or abs(t - all) > 1e-6").count() == 0
    yearly = totals.annual_totals(out, "2020-01-01", "2020-12-01").collect()
    assert len(yearly) == 16 and all(r["total_weight"] > 0 for r in yearly)
    shares = totals.gear_share_table(totals.gear_draws(trips, 8))
    assert shares.where("lower > median or median > upper").count() == 0
    assert totals.marginal_means(trips, "trip_catch_po_3", ["municipality_name"], 8).where("municipality_name = 'Overall'").count() == 2
    assert totals.activity_table(cells, [], 8, 30).count() == 6


def test_survey_keeps_line_breaks_and_all_ties(spark, tmp_path):
    file = tmp_path / "survey.csv"
    file.write_text('uuid,end,a,b,c,d\nx,2020,"one\ntwo",2,3,4\ny,2021,1,1,1,9\ny,2021,1,1,1,2\n')
    got = {r["uuid"]: tuple(r)[2:] for r in readers.read_survey_csv(spark, str(file)).collect()}
    assert got == {"x": ("one\ntwo", "2", "3", "4"), "y": ("1", "1", "1", "2")}
