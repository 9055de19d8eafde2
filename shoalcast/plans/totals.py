"""National totals with uncertainty.

Every table here is keyed by cell and draw; draws are numbered when they are made, so
independent estimates pair up by number.  All cells of one draw come from one resample.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoalcast.functions.dates import days_in_month, month_number, month_sequence
from shoalcast.functions.numeric import from_cube_root
from shoalcast.functions.text import map_codes, strip_suffix
from shoalcast.operators.aggregates import interval_summary, totals_by_draw
from shoalcast.operators.crossed import CrossedFit, predict_crossed
from shoalcast.operators.draws import drawn_sums, with_draws
from shoalcast.operators.joins import tagged_union
from shoalcast.operators.reshape import expand_array, unpivot_columns
from shoalcast.operators.shrinkage import (
    cell_moments,
    overall_mean,
    overall_rate,
    parent_shares,
    rolled_up_moments,
    shrunk_means,
    shrunk_rates,
    shrunk_shares,
    summed_columns,
)
from shoalcast.schemas import BOAT_CODES
from shoalcast.session import cut_lineage

CELL = ["municipality_name", "boat_type", "period_static"]
WEIGHT, VALUE = "trip_catch_po_3", "trip_value_po_3"


@dataclass
class Draws:
    """Estimates per cell and draw, and what a cell without data gets."""

    cells: DataFrame
    fallback: DataFrame
    keys: list[str]
    fallback_keys: list[str]


def _drawn_cells(cells: DataFrame, keys: Sequence[str], draws: int, hash_name: str) -> DataFrame:
    """Days and trips per key and draw; written once, as cells and hyper-parameters read them."""
    return cut_lineage(drawn_sums(cells, "individual_boat", keys, draws, {c: F.col(c) for c in ("n_days", "n_trips")}, hash_name))


def activity_draws(cells: DataFrame, draws: int, hash_name: str = "xxhash64") -> Draws:
    """Activity rate per municipality, period and boat type; boats are resampled."""
    keys = ["municipality_name", "period_static", "boat_type"]
    sums = _drawn_cells(cells.withColumnRenamed("boat_code", "boat_type"), keys, draws, hash_name)
    by = ["boat_type", "draw"]
    return Draws(
        shrunk_rates(sums, by).select(*keys, "draw", "estimate"),
        overall_rate(sums, by).select(*by, "overall"),
        keys,
        ["boat_type"],
    )


def model_draws(fit: CrossedFit, drawn: DataFrame, grid: DataFrame, factors: Sequence[str]) -> Draws:
    """Activity rates of the fitted model on a prediction grid, by draw of its effects."""
    keys = ["municipality_name", "period_static", "boat_type"]
    cells = grid.select(*keys, "period_seasonal").distinct().withColumnRenamed("boat_type", fit.by)
    rates = predict_crossed(fit, cells, factors, draws=drawn).withColumnRenamed(fit.by, "boat_type")
    pooled = predict_crossed(fit, cells.select(fit.by).distinct(), [], "overall", drawn).withColumnRenamed(fit.by, "boat_type")
    return Draws(rates.select(*keys, "draw", "estimate"), pooled.select("boat_type", "draw", "overall"), keys, ["boat_type"])


def mean_draws(
    features: DataFrame, response: str, keys: Sequence[str], draws: int, hash_name: str = "xxhash64"
) -> Draws:
    """Mean cube-root catch or value per cell; trips are resampled."""
    resampled = with_draws(features.select("record_id", *keys, response), "record_id", draws, hash_name)
    return _mean_draws(cut_lineage(cell_moments(resampled, [*keys, "draw"], response, "draw_weight")), keys)


def _mean_draws(cells: DataFrame, keys: Sequence[str]) -> Draws:
    return Draws(
        shrunk_means(cells, ["draw"]).select(*keys, "draw", "estimate"),
        overall_mean(cells, ["draw"]).select("draw", "overall"),
        list(keys),
        [],
    )


def gear_draws(trips: DataFrame, draws: int, kappa: float = 10.0, hash_name: str = "xxhash64") -> Draws:
    """Gear shares per municipality and boat type; trips are resampled."""
    levels = ["municipality_name", "boat_type", "trip_gear"]
    resampled = with_draws(trips.select("record_id", *levels), "record_id", draws, hash_name)
    return _gear_draws(cut_lineage(resampled.groupBy(*levels, "draw").agg(F.sum("draw_weight").alias("n"))), kappa)


def _gear_draws(counts: DataFrame, kappa: float) -> Draws:
    keys = ["municipality_name", "boat_type"]
    parent = ["boat_type", "draw"]
    return Draws(
        shrunk_shares(counts, [*keys, "draw"], parent, "trip_gear", "n", kappa).select(
            *keys, "draw", "trip_gear", "estimate"
        ),
        parent_shares(counts, parent, "trip_gear", "n").withColumnRenamed("prior", "overall"),
        [*keys, "trip_gear"],
        ["boat_type", "trip_gear"],
    )


def pooled_trips(catch: DataFrame, value: DataFrame, gear: DataFrame | None = None) -> DataFrame:
    """Feature tables as one: a row holds the responses it counts for, and ``for_gear``.

    A table given for every part is taken once, others are put below each other.
    """
    if catch is value and (gear is None or gear is value):
        return catch.withColumn("for_gear", F.lit(gear is not None))
    names = ["record_id", *CELL, *([] if gear is None else ["trip_gear"])]
    parts = [catch.select(*names, WEIGHT, F.lit(False).alias("for_gear")), value.select(*names, VALUE)]
    if gear is not None:
        parts.append(gear.select("record_id", "municipality_name", "boat_type", "trip_gear", F.lit(True).alias("for_gear")))
    return tagged_union(dict(enumerate(parts)), "part")


def resampled_sums(
    pooled: DataFrame, keys: Sequence[str], draws: int, hash_name: str = "xxhash64"
) -> DataFrame:
    """One resample of trips for every estimate: sizes and sums by keys and draw, written once."""
    sums = {"n_gear": F.when(F.col("for_gear"), F.lit(1.0))} | summed_columns(WEIGHT) | summed_columns(VALUE)
    return cut_lineage(drawn_sums(pooled, "record_id", keys, draws, sums, hash_name))


def attach_draws(grid: DataFrame, draws: Draws, out: str) -> DataFrame:
    """Look the estimates up on a grid that has a ``draw`` column."""
    keys, fallback = [*draws.keys, "draw"], [*draws.fallback_keys, "draw"]
    cells = draws.cells.withColumnRenamed("estimate", "__cell")
    overall = draws.fallback.withColumnRenamed("overall", "__overall")
    joined = grid.join(cells, keys, "left").join(overall, fallback, "left")
    return joined.withColumn(out, F.coalesce("__cell", "__overall")).drop("__cell", "__overall")


def boats_census(municipalities: DataFrame) -> DataFrame:
    """Boats per municipality and boat type name."""
    long = unpivot_columns(municipalities, ["municipality_name"], ["canoes", "motors"], "boat_type", "n")
    return long.withColumn("boat_type", strip_suffix(F.col("boat_type"), "s"))


def prediction_grid(municipalities: DataFrame, first_month: str, last_month: str, draws: int) -> DataFrame:
    """Municipality x boat type x month x draw with boat counts and days."""
    places = municipalities.select("municipality_name").distinct()
    named = expand_array(places, "boat_type", list(BOAT_CODES))
    months = expand_array(named, "period_static", month_sequence(first_month, last_month))
    counted = months.join(boats_census(municipalities), ["municipality_name", "boat_type"])
    typed = counted.withColumns(
        {
            "period_seasonal": month_number(F.col("period_static")).cast("string"),
            "n_days_month": days_in_month(F.col("period_static")),
            "boat_type_name": F.col("boat_type"),
            "boat_type": map_codes(F.col("boat_type"), BOAT_CODES),
        }
    )
    return expand_array(typed, "draw", F.sequence(F.lit(1), F.lit(draws)))


def expected_trips(grid: DataFrame, activity: Draws) -> DataFrame:
    """Trips per cell and draw: rate x boats x days in the month."""
    rated = attach_draws(grid, activity, "rate")
    return rated.withColumn("n_trips", F.col("n") * F.col("rate") * F.col("n_days_month"))


def _products(df: DataFrame) -> DataFrame:
    scaled = df.withColumns(
        {"catch_weight": from_cube_root(F.col("catch_weight")), "catch_value": from_cube_root(F.col("catch_value"))}
    )
    return scaled.withColumns(
        {
            "total_weight": F.col("n_trips") * F.col("catch_weight"),
            "total_value": F.col("n_trips") * F.col("catch_value"),
        }
    )


def totals_without_gear(trips: DataFrame, weight: Draws, value: Draws) -> DataFrame:
    """Trips x mean catch and value of the cell."""
    return _products(attach_draws(attach_draws(trips, weight, "catch_weight"), value, "catch_value"))


def totals_with_gear(trips: DataFrame, gear: Draws, weight: Draws, value: Draws) -> DataFrame:
    """Trips split by gear share, then catch and value per gear."""
    levels = gear.fallback.select("boat_type", "draw", "trip_gear")
    per_gear = attach_draws(trips.join(levels, ["boat_type", "draw"]), gear, "gear_prop")
    split = per_gear.withColumns(
        {"n_trips_total": F.col("n_trips"), "n_trips": F.col("n_trips") * F.col("gear_prop")}
    )
    return _products(attach_draws(attach_draws(split, weight, "catch_weight"), value, "catch_value"))


def _without_gear(trips: DataFrame, sums: DataFrame) -> DataFrame:
    fits = [_mean_draws(rolled_up_moments(sums, [*CELL, "draw"], y), CELL) for y in (WEIGHT, VALUE)]
    return totals_without_gear(trips, *fits)


def _with_gear(trips: DataFrame, sums: DataFrame, kappa: float) -> DataFrame:
    by_gear = [*CELL, "trip_gear"]
    counts = sums.groupBy("municipality_name", "boat_type", "trip_gear", "draw").agg(F.sum("n_gear").alias("n"))
    fits = [_mean_draws(rolled_up_moments(sums, [*by_gear, "draw"], y), by_gear) for y in (WEIGHT, VALUE)]
    return totals_with_gear(trips, _gear_draws(counts.where(F.col("n").isNotNull()), kappa), *fits)


def national_totals_without_gear(
    trips: DataFrame, catch: DataFrame, value: DataFrame, draws: int, hash_name: str = "xxhash64"
) -> DataFrame:
    """Expected trips and feature tables to totals by cell and draw, any gear."""
    return _without_gear(trips, resampled_sums(pooled_trips(catch, value), CELL, draws, hash_name))


def national_totals_with_gear(
    trips: DataFrame,
    catch: DataFrame,
    value: DataFrame,
    gear: DataFrame,
    draws: int,
    kappa: float = 10.0,
    hash_name: str = "xxhash64",
) -> DataFrame:
    """The same, split by the share of each gear."""
    sums = resampled_sums(pooled_trips(catch, value, gear), [*CELL, "trip_gear"], draws, hash_name)
    return _with_gear(trips, sums, kappa)


@dataclass
class Totals:
    without_gear: DataFrame
    with_gear: DataFrame


def national_totals(
    cells: DataFrame,
    catch: DataFrame,
    value: DataFrame,
    gear: DataFrame,
    municipalities: DataFrame,
    first_month: str = "2017-01-01",
    last_month: str = "2021-02-28",
    draws: int = 100,
    kappa: float = 10.0,
    hash_name: str = "xxhash64",
) -> Totals:
    """Activity cells, feature tables and the census to totals by cell and draw."""
    grid = prediction_grid(municipalities, first_month, last_month, draws)
    trips = expected_trips(grid, activity_draws(cells, draws, hash_name))
    sums = resampled_sums(pooled_trips(catch, value, gear), [*CELL, "trip_gear"], draws, hash_name)
    return Totals(_without_gear(trips, sums), _with_gear(trips, sums, kappa))


def annual_totals(totals: Totals, first: str, last: str | None = None) -> DataFrame:
    """Both estimates summed over a span of months, by draw (U3, F-g, A15)."""
    both = tagged_union(
        {
            "accounting for fishing gear": totals.with_gear,
            "not accounting for fishing gear": totals.without_gear,
        },
        "est",
    )
    return totals_by_draw(between(both, first, last), ["est"])


def between(df: DataFrame, first: str, last: str | None = None) -> DataFrame:
    """Months from ``first`` to ``last``, or open ended."""
    period = F.col("period_static")
    kept = df.where(period >= F.lit(first).cast("date"))
    return kept if last is None else kept.where(period <= F.lit(last).cast("date"))


def marginal_means(
    features: DataFrame, response: str, keys: Sequence[str], draws: int, hash_name: str = "xxhash64"
) -> DataFrame:
    """Catch or value by chosen keys with an 'Overall' row, as intervals over draws."""
    fitted = mean_draws(features, response, keys, draws, hash_name)
    names = {k: F.lit("Overall") for k in keys}
    overall = fitted.fallback.withColumnRenamed("overall", "estimate").withColumns(names)
    levels = fitted.cells.withColumns({k: F.col(k).cast("string") for k in keys})
    scaled = levels.unionByName(overall).withColumn("value", from_cube_root(F.col("estimate")))
    return interval_summary(scaled, keys, "value")


def gear_share_table(gear: Draws) -> DataFrame:
    """Gear shares by municipality and boat type as intervals over draws."""
    return interval_summary(gear.cells, gear.keys, "estimate")


def activity_table(
    cells: DataFrame, keys: Sequence[str], draws: int, days: int = 1, hash_name: str = "xxhash64"
) -> DataFrame:
    """Trips per boat in ``days`` days by boat code and chosen keys, as intervals."""
    sums = _drawn_cells(cells, ["boat_code", *keys], draws, hash_name)
    rates = shrunk_rates(sums, ["boat_code", "draw"]).withColumn("value", F.col("estimate") * days)
    return interval_summary(rates, ["boat_code", *keys], "value", (0.05, 0.66, 0.95))
