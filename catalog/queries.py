"""One query per operator, run over whole driver tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import standins as S
from shoalcast.functions import dates, numeric, text
from shoalcast.operators import aggregates, crossed, draws, glm, joins, membership, reshape, shrinkage, windows
from shoalcast.plans import activity, catch, features, points, prices, totals, trips
from shoalcast.schemas import GEARS
from shoalcast.session import cut_lineage, removed_at_exit, shared_folder
from shoalcast.sources import writers
from shoalcast.sources.readers import time_filtered

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def query(fn: Query) -> Query:
    QUERIES["q_" + fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 6, *columns: str) -> DataFrame:
    names = columns or [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns({c: F.round(c, digits) for c in names})


# Scans, points and scalar functions -------------------------------------------------


@query
def points_to_trips(spark, d):
    return aggregates.summarise_trips(S.points(spark, d))


@query
def latest_trip_per_day(spark, d):
    return S.tracked_trips(spark, d)


@query
def latest_version(spark, d):
    lines = S.table(spark, d, "lineitem")
    version = F.when(F.col("l_linenumber") != 7, F.date_format("l_shipdate", "yyyy-MM-dd"))
    rows = lines.select(*LINE, version.alias("end"))
    return windows.latest_version(
        rows, "l_orderkey", "end", tie=["l_partkey", "l_suppkey", "l_extendedprice", "l_linenumber"]
    )


@query
def time_filtered_scan(spark, d):
    lines = S.table(spark, d, "lineitem").select(*LINE, "l_shipdate")
    return time_filtered(lines, "1998-09-02 00:00:00", "l_shipdate")


@query
def first_number(spark, d):
    km = (
        F.when(F.col("l_returnflag") == "R", F.lit("--"))
        .when(F.col("l_returnflag") == "A", F.concat(F.lit("about "), F.col("l_quantity").cast("string"), F.lit(" km")))
        .otherwise(F.concat(F.col("l_quantity").cast("string"), F.lit("km of 100")))
    )
    rows = S.table(spark, d, "lineitem").select(*LINE, text.null_sentinel(km).alias("raw"))
    return rows.withColumn("distance", text.first_number(F.col("raw")))


@query
def duration_seconds(spark, d):
    hours, minutes = F.floor(F.col("l_quantity") / 7).cast("string"), F.col("l_linenumber").cast("string")
    raw = (
        F.when(F.col("l_returnflag") == "R", F.concat(hours, F.lit("h "), minutes, F.lit("m")))
        .when(F.col("l_returnflag") == "A", F.concat(minutes, F.lit("m")))
        .when(F.col("l_linestatus") == "F", F.concat(minutes, F.lit("d "), hours, F.lit("H")))
        .otherwise(F.lit("long"))
    )
    return S.table(spark, d, "lineitem").select(*LINE, text.duration_seconds(raw).alias("seconds"))


@query
def two_format_date(spark, d):
    day = F.col("o_orderdate")
    raw = (
        F.when(F.col("o_orderpriority") == "5-LOW", "soon")
        .when(F.col("o_orderstatus") == "F", F.date_format(day, "M/d/yy"))
        .when(F.col("o_orderstatus") == "O", F.date_format(day, "d/M/yyyy"))
        .otherwise(F.date_format(day, "d-M-yyyy"))
    )
    return S.table(spark, d, "orders").select("o_orderkey", dates.two_format_date(raw).alias("installation_date"))


@query
def local_date(spark, d):
    return S.table(spark, d, "events").select("event_id", dates.local_date(F.col("ts")).alias("local_day"))


@query
def period_features(spark, d):
    orders = S.table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    weekly = dates.period_features(orders, "day", "week", dates.week_number)
    return weekly.withColumns(
        {
            "month_static": dates.floor_period(F.col("day"), "month"),
            "year_static": dates.floor_period(F.col("day"), "year"),
            "month_seasonal": dates.month_number(F.col("day")),
            "month_days": dates.days_in_month(F.col("day")),
        }
    )


@query
def bin_midpoint(spark, d):
    size = F.col("p_size").cast("string")
    name = (
        F.when(F.col("p_type") == "LARGE", F.concat(F.lit("fish_over"), size))
        .when(F.col("p_type") == "SMALL", F.lit("fish_length"))
        .otherwise(F.concat(F.lit("fish_no_"), size, F.lit("_"), (F.col("p_size") + 5).cast("string")))
    )
    return S.table(spark, d, "part").select("p_partkey", text.bin_midpoint(name).alias("mean_length"))


@query
def sanitize_numeric(spark, d):
    balance = F.col("c_acctbal")
    hours = numeric.sanitize_numeric(F.floor(balance / 100).cast("double"), True, 3, 72, True)
    return S.table(spark, d, "customer").select(
        "c_custkey", hours.alias("hours"), numeric.cube_root_units(balance).alias("cube_root"),
        numeric.unit_price(balance, F.floor(balance / 1000)).alias("price"),
    )


@query
def registration(spark, d):
    brand, size = F.substring("p_brand", 1, 2), F.col("p_size").cast("string")
    raw = (
        F.when(F.col("p_type") == "LARGE", F.concat(brand, size, F.lit(" cd")))
        .when(F.col("p_type") == "SMALL", F.concat(brand, F.lit(" "), size))
        .when(F.col("p_type") == "PROMO", F.concat(F.lit("x"), size))
        .when(F.col("p_type") != "ECONOMY", F.concat(brand, size, F.lit("Efg")))
    )
    return S.table(spark, d, "part").select("p_partkey", text.boat_registration(raw).alias("boat_registration"))


@query
def text_logical(spark, d):
    return S.survey_fields(spark, d).select("uuid", text.platform_label(F.col("trip_group_has_boat")).alias("platform"))


# Reshaping and windows -----------------------------------------------------------------


@query
def unpivot_group(spark, d):
    return reshape.unpivot_group(S.survey_groups(spark, d), ["uuid"])


def lines_with_brand(spark, d):
    part = S.table(spark, d, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    return S.table(spark, d, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))


@query
def lump_top_n(spark, d):
    brands = lines_with_brand(spark, d).select("l_orderkey", "p_brand", "l_quantity")
    lumped = reshape.lump_top_n(brands, "p_brand", 5)
    return lumped.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


@query
def pivot_counts(spark, d):
    keys = ["municipality_name", "boat_type", "period_static", "period_seasonal"]
    counts = S.order_trips(spark, d).groupBy(*keys, "trip_gear").agg(F.count(F.lit(1)).alias("n"))
    return reshape.pivot_counts(counts, keys, "trip_gear", "n", GEARS, prefix="tg_")


@query
def pivot_by_boat_code(spark, d):
    cells = S.order_cells(spark, d).withColumn("customer", F.split("individual_boat", " ")[0])
    return reshape.pivot_values(cells, ["period_static", "customer"], "boat_code", ["n_days", "n_trips"], ["1", "2"])


@query
def complete(spark, d):
    orders = S.table(spark, d, "orders").select("o_custkey", F.trunc("o_orderdate", "month").alias("month"))
    counts = orders.groupBy("o_custkey", "month").agg(F.count(F.lit(1)).alias("n"))
    return reshape.complete(counts, ["o_custkey", "month"]).na.fill(0, ["n"])


@query
def daily_panel(spark, d):
    days = S.points(spark, d).groupBy("imei", "boat", "day").agg(F.count(F.lit(1)).alias("n"))
    return reshape.densify_days(days.withColumn("kind", F.substring("boat", 1, 1)), ["imei"], ["boat", "kind"], "day")


@query
def forward_fill(spark, d):
    events = S.table(spark, d, "events").select(
        "event_id", "user_id", "ts", F.when(F.col("event_type") == "view", F.col("value")).alias("seen")
    )
    return windows.forward_fill(events, ["user_id"], ["ts", "event_id"], ["seen"], block=F.to_date("ts"))


@query
def running_share(spark, d):
    counts = S.table(spark, d, "part").groupBy("p_size").agg(F.count(F.lit(1)).alias("n"))
    return rounded(windows.running_share(counts, "p_size", "n"), 9)


@query
def price_ecdf(spark, d):
    prices_per_unit = S.table(spark, d, "lineitem").select(
        F.floor(F.col("l_extendedprice") / F.col("l_quantity")).cast("double").alias("price")
    )
    return rounded(windows.ecdf(prices_per_unit, "price"), 9, "ecdf")


# Joins ------------------------------------------------------------------------------


@query
def suffix_join(spark, d):
    typed = S.survey_fields(spark, d).select(
        "uuid", trips.imei_digits(text.to_number(F.col("trip_group_imei"))).alias("digits")
    )
    return joins.suffix_join(typed, S.boats(spark, d), "digits", "imei_long", spread=["uuid"])


@query
def asof_latest(spark, d):
    orders = S.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    done = orders.where(F.col("o_orderstatus") != "P").drop("o_orderstatus")
    installed = orders.where(F.col("o_orderstatus") == "P").select(
        F.col("o_custkey"), F.col("o_orderdate").alias("installed"), F.col("o_orderkey").alias("installation")
    )
    return joins.asof_latest(
        done, installed, "o_custkey", "o_orderdate", "installed", ["installation"], spread=["o_orderkey"]
    )


@query
def full_outer_trips(spark, d):
    """Survey trips of a device and day against tracked trips, as whole pipelines feed it."""
    fields = S.survey_fields(spark, d).select(
        F.col("uuid").alias("record_id"),
        F.when(F.col("trip_group_boat_type").isNotNull(), S.imei(F.col("deviceid").cast("long"))).alias("trip_imei"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.dayofmonth(F.col("date").cast("date"))).alias("trip_date"),
    )
    tracked = S.tracked_trips(spark, d).select("imei", "trip_end_date_pds", "trip_id_pds", "boat_id_pds")
    return trips.merge_trips(fields, tracked)


@query
def outage_anti(spark, d):
    tracked = S.tracked_trips(spark, d)
    return joins.without_dates(
        tracked.select("imei", "trip_id_pds", "trip_end_date_pds"), "trip_end_date_pds", activity.outage_days(tracked), "day"
    )


@query
def union_last_seen(spark, d):
    tracked = S.tracked_trips(spark, d).select("imei", "trip_id_pds", "trip_end_date_pds")
    both = tracked.unionByName(activity.last_seen_rows(S.devices(spark, d)), allowMissingColumns=True)
    return both.groupBy("imei").agg(
        F.max("trip_end_date_pds").alias("last_day"), F.count("trip_id_pds").alias("n_trips"), F.count("last_seen").alias("n_seen")
    )


# Survey ---------------------------------------------------------------------------


@query
def catch_flags(spark, d):
    lines = catch.species_lines(S.survey_groups(spark, d))
    joined = joins.lookup_join(lines, S.species(spark, d).drop("category"), "species_code", spread=["record_id", "record"])
    flagged = catch.flag_lines(joined)
    return rounded(
        flagged.select(
            "record_id", "record", "species_code", "use", "question", "mean_length", "n_individuals",
            "n_individuals_flag", "size_flag", "weight",
        )
    )


@query
def catch_lines(spark, d):
    return rounded(S.catch(spark, d))


@query
def trip_catch(spark, d):
    return rounded(trips.trip_catch(S.catch(spark, d)))


@query
def trip_flags(spark, d):
    clean, _ = S.trips_and_catch(spark, d)
    return rounded(clean)


@query
def top_n_species_wide(spark, d):
    return rounded(catch.species_wide(S.catch(spark, d)))


@query
def widen_trip_catch(spark, d):
    wide = S.wide_trips(spark, d)
    return rounded(
        wide.select(
            "record_id", "trip_imei", "trip_price", "species_code_1", "weight_1", "species_code_2", "weight_2",
            "species_code_other", "weight_other",
        )
    )


@query
def species_count_share(spark, d):
    counts = aggregates.species_count_distribution(trips.trip_catch(S.catch(spark, d)))
    return rounded(windows.running_share(counts, "trip_n_species", "n"), 9)


# Vessel activity ------------------------------------------------------------------------


@query
def assign_boats(spark, d):
    tracked = S.tracked_trips(spark, d).where(F.col("imei").isNotNull())
    assigned = activity.assign_boats(tracked, S.boats(spark, d))
    return assigned.select("trip_id_pds", "imei", "trip_end_date_pds", "boat_code", "municipality_name")


@query
def assign_boats_literal(spark, d):
    tracked = S.tracked_trips(spark, d).where(F.col("imei").isNotNull())
    assigned = activity.assign_boats(tracked, S.boats(spark, d), mode="reference")
    return assigned.select("trip_id_pds", "imei", "trip_end_date_pds", "boat_code", "municipality_name")


@query
def activity_panel(spark, d):
    return S.panel(spark, d)


@query
def activity_cells(spark, d):
    return aggregates.activity_cells(S.panel(spark, d))


@query
def activity_rate_pooled(spark, d):
    cells = S.panel(spark, d, period_static_unit="week", period_seasonal_function=dates.week_number)
    keys = ["boat_code", "municipality_name", "period_static"]
    summed = aggregates.activity_cells(cells).groupBy(*keys).agg(
        F.sum("n_days").alias("n_days"), F.sum("n_trips").alias("n_trips")
    )
    return rounded(shrinkage.shrunk_rates(summed, ["boat_code"]), 7)


@query
def boat_span(spark, d):
    return aggregates.boat_span(S.panel(spark, d))


@query
def tracked_boats(spark, d):
    return activity.tracked_boats(S.panel(spark, d, period_static_unit="week"), ["period_static", "boat_code"])


@query
def coverage_ratio(spark, d):
    return rounded(activity.coverage_ratio(S.panel(spark, d), S.municipalities(spark, d)), 9)


# Prices -------------------------------------------------------------------------------


@query
def species_price(spark, d):
    return rounded(prices.species_price(S.boat_trips(S.wide_trips(spark, d))).drop("ss"), 5)


@query
def price_interval(spark, d):
    wide = cut_lineage(S.wide_trips(spark, d))
    estimates, overall = prices.species_price_draws(S.boat_trips(wide), S.DRAWS, "md5")
    out = prices.price_interval(wide, estimates, overall, S.DRAWS)
    return rounded(out.select("record_id", "trip_imei", "price_lower", "price_upper"), 5)


@query
def price_flags(spark, d):
    return rounded(S.flagged_trips(spark, d).select("record_id", "trip_imei", "trip_price_residual_factor", "flags"), 5)


@query
def catch_features(spark, d):
    flagged = S.flagged_trips(spark, d)
    built = features.value_features(flagged, S.stations(spark, d))
    return built.select(
        "record_id", "trip_imei", "municipality_name", "boat_type", "trip_gear", "period_static", "period_seasonal", "wday",
        "trip_catch_po", "trip_catch_po_3", "trip_value_po_3",
    )


@query
def price_features(spark, d):
    asked = S.wide_trips(spark, d).select("record_id", "trip_platform", "trip_landing_site", "trip_date", "trip_price")
    built = prices.price_features(asked, S.stations(spark, d), "year")
    return rounded(
        built.groupBy("municipality_name", "period_static", "period_seasonal", "wday").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.ln("trip_price")).alias("log_price")
        ), 4
    )


# Estimates ------------------------------------------------------------------------------


@query
def gear_mix(spark, d):
    clean = S.survey_as_trips(spark, d)
    return features.gear_features(clean, S.stations(spark, d)).toDF(*GEAR_COLUMNS)


GEAR_COLUMNS = ["municipality_name", "boat_type", "period_static", "period_seasonal", "size", *[f"tg_{g}" for g in GEARS]]


@query
def gear_mix_pooled(spark, d):
    counts = S.order_trips(spark, d).groupBy("municipality_name", "boat_type", "trip_gear").agg(
        F.count(F.lit(1)).alias("n")
    )
    return rounded(
        shrinkage.shrunk_shares(counts, ["municipality_name", "boat_type"], ["boat_type"], "trip_gear", "n"), 9
    )


def cell_means(response):
    def run(spark, d):
        keys = ["municipality_name", "boat_type", "period_static"]
        cells = shrinkage.cell_moments(S.order_trips(spark, d), keys, response)
        return rounded(shrinkage.shrunk_means(cells, []), 6)

    return run


QUERIES["q_catch_cell_means"] = cell_means("trip_catch_po_3")
QUERIES["q_value_cell_means"] = cell_means("trip_value_po_3")


@query
def bootstrap_draws(spark, d):
    trips_in = S.order_trips(spark, d).select("record_id", "municipality_name", "boat_type", "trip_catch_po_3")
    resampled = draws.with_draws(trips_in, "record_id", S.DRAWS, "md5")
    keys = ["municipality_name", "boat_type", "draw"]
    return rounded(shrinkage.cell_moments(resampled, keys, "trip_catch_po_3", "draw_weight"), 5)


def trips_by_draw(spark, d):
    grid = totals.prediction_grid(S.municipalities(spark, d), *S.months(spark, d), S.DRAWS)
    return totals.expected_trips(grid, totals.activity_draws(S.order_cells(spark, d), S.DRAWS, "md5"))


def all_totals(spark, d):
    order_trips = S.order_trips(spark, d)
    return totals.national_totals(
        S.order_cells(spark, d), order_trips, order_trips, order_trips, S.municipalities(spark, d),
        *S.months(spark, d), S.DRAWS, hash_name="md5",
    )


def no_gear(spark, d):
    order_trips = S.order_trips(spark, d)
    return totals.national_totals_without_gear(trips_by_draw(spark, d), order_trips, order_trips, S.DRAWS, "md5")


def with_gear(spark, d):
    order_trips = S.order_trips(spark, d)
    return totals.national_totals_with_gear(
        trips_by_draw(spark, d), order_trips, order_trips, order_trips, S.DRAWS, hash_name="md5"
    )


ESTIMATE = [*totals.CELL, "draw", "n_trips", "catch_weight", "catch_value", "total_weight", "total_value"]


@query
def expected_trips(spark, d):
    return rounded(trips_by_draw(spark, d).select(*totals.CELL, "n", "n_days_month", "draw", "rate", "n_trips"), 5)


@query
def totals_no_gear(spark, d):
    return rounded(no_gear(spark, d).select(*ESTIMATE), 3)


@query
def totals_gear(spark, d):
    return rounded(with_gear(spark, d).select(*ESTIMATE, "trip_gear", "gear_prop"), 3)


@query
def totals_by_draw(spark, d):
    return rounded(totals.annual_totals(all_totals(spark, d), "1996-01-01", "1996-12-01"), 1)


@query
def interval_summary(spark, d):
    per_place = aggregates.totals_by_draw(totals.between(no_gear(spark, d), "1996-01-01"), ["municipality_name"])
    return rounded(aggregates.interval_summary(per_place, ["municipality_name"], "total_weight"), 2)


@query
def marginal_means(spark, d):
    return rounded(totals.marginal_means(S.order_trips(spark, d), "trip_catch_po_3", ["trip_gear", "boat_type"], S.DRAWS, "md5"), 4)


@query
def activity_table(spark, d):
    return rounded(totals.activity_table(S.order_cells(spark, d), ["municipality_name"], S.DRAWS, 30, "md5"), 4)


@query
def gear_share_table(spark, d):
    return rounded(totals.gear_share_table(totals.gear_draws(S.order_trips(spark, d), S.DRAWS, hash_name="md5")), 5)


# Models in tables ---------------------------------------------------------------------------


ACTIVITY_FACTORS = {
    "place": ["municipality_name"],
    "period": ["period_static"],
    "place_period": ["municipality_name", "period_static"],
    "season": ["period_seasonal"],
    "boat": ["individual_boat"],
}
ACTIVITY_GRID = ["boat_code", "municipality_name", "period_static", "period_seasonal"]


def weekly_cells(spark, d):
    """Days and active days by boat, week and weekday: the panel holds idle days."""
    panel = S.panel(spark, d, period_static_unit="week", period_seasonal_function=F.dayofweek)
    return cut_lineage(aggregates.activity_cells(panel))


def activity_model(cells):
    return crossed.fit_crossed(cells, "boat_code", ACTIVITY_FACTORS, "n_days", "n_trips", rounds=3, iterations=3)


@query
def glm_activity(spark, d):
    """Zero-inflated binomial activity with crossed effects, predicted without the boats."""
    cells = weekly_cells(spark, d)
    grid = cells.select(*ACTIVITY_GRID).distinct()
    return rounded(crossed.predict_crossed(activity_model(cells), grid, ["place", "period", "place_period", "season"]), 5)


@query
def activity_variances(spark, d):
    """Standard deviation of each factor's effects, and how many levels it has."""
    fit = activity_model(weekly_cells(spark, d))
    levels = fit.effects.groupBy("boat_code", "factor").agg(F.count(F.lit(1)).alias("n_levels"), F.sum("weight").alias("weight"))
    spread = F.when(F.col("precision") > 0, 1 / F.sqrt("precision")).alias("sd")
    return rounded(levels.join(fit.precisions, ["boat_code", "factor"]).select("boat_code", "factor", "n_levels", "weight", spread), 4)


@query
def predict_grid(spark, d):
    """Expected activity by cell and draw from the fitted model, boats resampled."""
    cells = weekly_cells(spark, d)
    fit = activity_model(cells)
    drawn = crossed.draw_effects(fit, cells, "n_days", "n_trips", "individual_boat", S.DRAWS, 3, "md5")
    grid = cells.select("boat_code", "municipality_name", "period_static").distinct()
    return rounded(crossed.predict_crossed(fit, grid, ["place", "period", "place_period"], draws=drawn), 5)


ORDER_FACTORS = {"place": ["municipality_name"], "period": ["period_static"], "season": ["period_seasonal"], "boat": ["individual_boat"]}


@query
def model_trips(spark, d):
    """Expected trips by cell and draw with the fitted model's rates in place of the closed form's."""
    cells = cut_lineage(S.order_cells(spark, d))
    fit = crossed.fit_crossed(cells, "boat_code", ORDER_FACTORS, "n_days", "n_trips", rounds=2, iterations=3, zero_inflated=False)
    drawn = crossed.draw_effects(fit, cells, "n_days", "n_trips", "individual_boat", S.DRAWS, 2, "md5")
    # Boats' own effects take no part in the rates.
    drawn = cut_lineage(drawn.where(F.col("factor") != "boat"))
    grid = totals.prediction_grid(S.municipalities(spark, d), *S.months(spark, d), S.DRAWS)
    rates = totals.model_draws(fit, drawn, grid, ["place", "period", "season"])
    return rounded(totals.expected_trips(grid, rates).select(*totals.CELL, "n", "n_days_month", "draw", "rate", "n_trips"), 4)


@query
def glm_moments(spark, d):
    """Canoe and motor activity of a place as correlated effects."""
    logits = shrinkage.logit_cells(S.order_cells(spark, d), "municipality_name", "boat_code", ["1", "2"], "n_days", "n_trips")
    return rounded(shrinkage.shrunk_pairs(cut_lineage(logits), "municipality_name"), 7)


@query
def price_student(spark, d):
    """Robust log price per species with Student-t errors."""
    members = prices.memberships(S.boat_trips(S.wide_trips(spark, d)))
    return rounded(membership.species_effects(members, rounds=2, iterations=3), 4)


@query
def gear_mix_hierarchy(spark, d):
    """Gear shares by boat type, place and month, each level with its own concentration."""
    levels = ["boat_type", "municipality_name", "period_static"]
    counts = S.order_trips(spark, d).groupBy(*levels, "trip_gear").agg(F.count(F.lit(1)).alias("n"))
    return rounded(shrinkage.hierarchical_shares(cut_lineage(counts), levels, "trip_gear", "n"), 6)


@query
def parametric_bootstrap(spark, d):
    """Activity rates refitted to trips simulated from the fit, as intervals over draws."""
    cells = S.order_cells(spark, d)
    keys = ["boat_code", "municipality_name"]
    fitted = shrinkage.shrunk_rates(cells.groupBy(*keys).agg(F.sum("n_days").alias("n_days"), F.sum("n_trips").alias("n_trips")), ["boat_code"])
    rows = cells.join(fitted.select(*keys, "estimate"), keys)
    key = F.concat_ws("/", "individual_boat", F.col("period_static").cast("string"))
    sums = draws.simulated_trips(rows, key, S.DRAWS, "n_days", "estimate", "k", "md5", by=keys).withColumnRenamed("k", "n_trips")
    refitted = shrinkage.shrunk_rates(cut_lineage(sums), ["boat_code", "draw"])
    return rounded(aggregates.interval_summary(refitted, keys, "estimate", (0.95,)), 7)


# Files and days ---------------------------------------------------------------------------------


def scratch_folder(spark):
    path = f"{shared_folder(spark).rstrip('/')}/shoalcast-files-{uuid.uuid4().hex}"
    removed_at_exit(spark, path)
    return path


@query
def point_files(spark, d):
    """Daily point files to trips (C12, S9-S12): odd days have an imei column, even ones have none."""
    folder = scratch_folder(spark)
    rows = S.points(spark, d).withColumns({"odd": F.day("day") % 2 == 1, "time": F.col("time").cast("string")})
    rows = rows.withColumnsRenamed({"range_meters": "Range Meters", "boat_name": "Boat Name"})
    writers.write_csv_by_day(rows.where("odd").drop("odd"), f"{folder}/with")
    writers.write_csv_by_day(rows.where("not odd").drop("odd", "imei"), f"{folder}/without")
    return points.points_to_trips(spark, folder, "*.csv")


@query
def days_rewritten(spark, d):
    """Days written, some of them again with other rows: the rest stays."""
    path = scratch_folder(spark)
    rows = S.points(spark, d).select("trip", "range_meters", "day")
    first = F.lit("2024-01-16").cast("date")
    writers.write_by_day(rows, path)
    writers.write_by_day(rows.where((F.col("day") >= first) & (F.col("range_meters") > 100)), path)
    back = spark.read.parquet(path).withColumn("day", F.col("day").cast("date"))
    return rounded(back.groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.sum("range_meters").alias("metres")), 4)


@query
def sketch_ranks(spark, d):
    """Quantiles from merged sketches of each gear's trips, held against their exact ranks."""
    rows = S.order_trips(spark, d).select("municipality_name", "trip_gear", F.col("trip_value_po_3").alias("value"))
    parts = aggregates.sketches(rows, ["municipality_name", "trip_gear"], "value")
    found = aggregates.sketch_quantiles(aggregates.merged_sketches(parts, ["municipality_name"]), ["municipality_name"], (0.025, 0.17, 0.5, 0.83, 0.975))
    found = cut_lineage(found)
    below = F.count_if(F.col("value") < F.col("quantile")).alias("below")
    upto = F.count_if(F.col("value") <= F.col("quantile")).alias("upto")
    ranks = rows.join(found, "municipality_name").groupBy("municipality_name", "mark", "n").agg(below, upto)
    off = F.greatest(F.col("below") / F.col("n") - F.col("mark"), F.col("mark") - F.col("upto") / F.col("n"), F.lit(0.0))
    return ranks.select("municipality_name", "mark", "n", (off <= 0.01 + 1 / F.col("n")).alias("within"))


# Spark ML: no SQL twin ----------------------------------------------------------------------


def binomial_cells(spark, d):
    return glm.level_cells(
        S.order_cells(spark, d), ["municipality_name", "boat_code", "period_seasonal"], ["n_days", "n_trips"]
    )


@query
def glm_joint(spark, d):
    _, effects, _ = glm.fit_joint(
        binomial_cells(spark, d), "municipality_name", "boat_code", "n_trips", "n_days", ["period_seasonal"]
    )
    return effects


ZIP_EFFECTS = ["trip_gear", "municipality_name", "boat_type", "period_static"]


def zero_inflated_poisson(response):
    def run(spark, d):
        trips_in = S.order_trips(spark, d)
        cells = glm.level_cells(trips_in, ZIP_EFFECTS, [response])
        model = glm.fit_cells(cells, ZIP_EFFECTS, response, "poisson", zero_inflated=True)
        grid = trips_in.select("trip_gear", "boat_type").distinct()
        return glm.predict_grid(model, grid, ["trip_gear", "boat_type"])

    return run


QUERIES["q_zip_catch"] = zero_inflated_poisson("trip_catch_po_3")
QUERIES["q_zip_value"] = zero_inflated_poisson("trip_value_po_3")


@query
def price_huber(spark, d):
    wide = S.boat_trips(S.wide_trips(spark, d)).withColumn("log_price", F.when(F.col("trip_price") > 0, F.ln("trip_price")))
    slots = ["1", "2", "other"]
    return glm.fit_membership_huber(
        cut_lineage(wide.select("log_price", *[f"{c}_{s}" for s in slots for c in ("species_code", "weight")])),
        [f"species_code_{s}" for s in slots], [f"weight_{s}" for s in slots], "log_price",
    )


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points to trips to daily panel to activity rate per municipality, boat type and week."""
    return QUERIES["q_activity_rate_pooled"](spark, sf_dir)
