"""Crossed random effects on planted data, their draws against full refits."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoalcast.operators import crossed
from shoalcast.operators.draws import with_draws

FACTORS = {"place": ["place"], "period": ["period"], "place_period": ["place", "period"], "season": ["season"], "boat": ["boat"]}
SD = {"place": 0.9, "period": 0.6, "place_period": 0.4, "season": 0.3, "boat": 0.7}
SHARE = 0.15


@pytest.fixture(scope="module")
def planted(spark):
    rnd, effects = random.Random(5), {}

    def effect(factor, level):
        return effects.setdefault((factor, level), rnd.gauss(0, SD[factor]))

    rows = []
    for boat in range(220):
        place = boat % 22
        for period in range(18):
            season, n = period % 6, rnd.randrange(15, 31)
            eta = -0.3 + effect("place", place) + effect("period", period) + effect("place_period", (place, period))
            eta += effect("season", season) + effect("boat", boat)
            k = 0 if rnd.random() < SHARE else sum(rnd.random() < 1 / (1 + math.exp(-eta)) for _ in range(n))
            rows.append(("1", str(place), str(period), str(season), str(boat), n, k))
    rows += [("2", r[1], r[2], r[3], r[4], r[5], r[5] - r[6]) for r in rows[:60]]
    rows += [("1", None, "0", "0", "0", 10, 5), ("1", "0", "0", "0", "0", 0, 0), ("1", "0", "0", "0", "0", 10, None)]
    frame = spark.createDataFrame(rows, "code string, place string, period string, season string, boat string, n int, k int")
    frame = frame.repartition(4).cache()
    first = crossed.fit_crossed(frame, "code", FACTORS, "n", "k", rounds=6, iterations=5)
    # Settled under the variances found.
    return effects, frame, crossed.fit_crossed(frame, "code", FACTORS, "n", "k", rounds=2, iterations=8, fixed=first)


def values(fit, factor):
    return {r["level"]: r["value"] for r in fit.effects.where((F.col("code") == "1") & (F.col("factor") == factor)).collect()}


def test_planted_variances_effects_and_zeros_come_back(planted):
    effects, _, fit = planted
    for factor in ("place", "period", "boat"):
        found = values(fit, factor)
        true = {str(level): v for (f, level), v in effects.items() if f == factor}
        a, b = np.array([[found[level], true[level]] for level in true]).T
        assert np.corrcoef(a, b)[0, 1] > 0.8, factor
        sd = fit.precisions.where((F.col("code") == "1") & (F.col("factor") == factor)).first()["precision"] ** -0.5
        assert 0.6 * SD[factor] < sd < 1.5 * SD[factor], (factor, sd)
    assert len(values(fit, "place_period")) == 22 * 18
    share = fit.shares.where("code = '1'").first()["share"]
    assert abs(share - SHARE) < 0.04


def test_rounds_settle_where_scores_equal_penalties(planted, spark):
    """Under fixed variances the rounds converge: one more moves no level by a tenth of its factor's spread."""
    _, frame, fit = planted
    again = crossed.fit_crossed(frame, "code", FACTORS, "n", "k", rounds=1, iterations=8, fixed=fit)
    for factor in ("place", "period", "boat"):
        before, after = values(fit, factor), values(again, factor)
        assert max(abs(before[level] - after[level]) for level in before) < 0.1 * SD[factor]


def test_prediction_by_some_factors(planted, spark):
    _, _, fit = planted
    grid = spark.createDataFrame([("1", "3", "4", "4"), ("1", "new", "4", "4"), ("2", "3", "4", "4"), ("9", "3", "4", "4")], "code string, place string, period string, season string")
    got = {(r["code"], r["place"]): r["estimate"] for r in crossed.predict_crossed(fit, grid, ["place", "season"]).collect()}
    base, share = values(fit, crossed.INTERCEPT)[""], fit.shares.where("code = '1'").first()["share"]
    rate = lambda eta: (1 - share) / (1 + math.exp(-eta))
    season = values(fit, "season")["4"]
    assert got["1", "3"] == pytest.approx(rate(base + values(fit, "place")["3"] + season))
    assert got["1", "new"] == pytest.approx(rate(base + season))
    assert ("9", "3") not in got


def test_one_step_draws_are_near_full_refits(planted, spark):
    _, frame, fit = planted
    draws = 10
    drawn = crossed.draw_effects(fit, frame, "n", "k", "boat", draws, iterations=8)
    places = {(r["level"], r["draw"]): r["value"] for r in drawn.where("code = '1' and factor = 'place'").collect()}
    assert len(places) == 22 * draws
    fitted = values(fit, "place")
    # A resampled boat comes as so many boats of its own.
    weighted = with_draws(frame.dropna(), "boat", draws).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("draw_weight").cast("int"))))
    weighted = weighted.withColumn("boat", F.concat_ws("-", "boat", "copy")).drop("copy", "draw_weight").cache()
    one, full = [], []
    # Of the ten draws two are refitted, which takes as many whole fits.
    for draw in (1, 4):
        refit = crossed.fit_crossed(weighted.where(F.col("draw") == draw), "code", FACTORS, "n", "k", rounds=2, iterations=8, fixed=fit)
        levels = values(refit, "place")
        one += [places[level, draw] - fitted[level] for level in levels]
        full += [levels[level] - fitted[level] for level in levels]
    assert np.corrcoef(one, full)[0, 1] > 0.9
    assert np.abs(np.array(one) - np.array(full)).mean() < 0.5 * np.std(full)


def test_draws_have_the_shape_of_a_grid(planted, spark):
    _, frame, fit = planted
    drawn = crossed.draw_effects(fit, frame, "n", "k", "boat", 4, iterations=2)
    grid = frame.where("code = '1'").select("code", "place", "period", "season").dropna().distinct()
    out = crossed.predict_crossed(fit, grid, ["place", "period", "place_period", "season"], draws=drawn)
    assert out.count() == 4 * grid.count()
    assert out.where("estimate is null or estimate <= 0 or estimate >= 1").count() == 0


@pytest.mark.parametrize("name", ["md5", "xxhash64"])
def test_units_worked_out_are_those_of_the_tables(planted, spark, monkeypatch, name):
    """The draws by arrays, units left out, against the same iterations on tables of levels by draws."""
    _, frame, fit = planted
    few = frame.where("boat % 5 = 0")
    found = []
    for most in (crossed.MOST_LEVELS, 0):
        monkeypatch.setattr(crossed, "MOST_LEVELS", most)
        drawn = crossed.draw_effects(fit, few, "n", "k", "boat", 5, 3, name)
        found.append({(r["code"], r["factor"], r["level"], r["draw"]): r["value"] for r in drawn.collect()})
    by_units, by_tables = found
    assert by_units.keys() == by_tables.keys() and {f for _, f, _, _ in by_units} == {crossed.INTERCEPT, *FACTORS}
    assert max(abs(by_units[k] - by_tables[k]) for k in by_tables) < 1e-9
    boats = [k for k in by_tables if k[1] == "boat"]
    assert max(abs(by_tables[k] - by_tables[(*k[:3], 1)]) for k in boats) > 1e-3


def test_effects_of_units_are_not_made_for_other_factors(planted):
    _, frame, fit = planted
    drawn = crossed.draw_effects(fit, frame.limit(50), "n", "k", "boat", 2, 1)
    plan = drawn.where("factor = 'place'")._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan
