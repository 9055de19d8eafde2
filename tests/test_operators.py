"""Joins, windows, reshaping and estimators, against brute force where that is possible."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from shoalcast.operators import aggregates, draws, glm, joins, reshape, shrinkage, windows


def skewed(spark, n=600):
    """A third of the rows on one key, some without a key."""
    rng = random.Random(7)
    data = [(i, "hot" if i % 3 == 0 else None if i % 10 == 0 else f"k{rng.randrange(40)}") for i in range(n)]
    return spark.createDataFrame(data, "id int, k string")


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(spark, rows, how):
    facts = skewed(spark)
    lookup = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), (None, 4)], "k string, v int")
    plain = facts.join(lookup, "k", how).select("id", "k", "v")
    salted = joins.salted_join(facts, lookup, ["k"], ["k"], ["id"], how).select("id", "k", "v")
    assert rows(salted) == rows(plain)
    small = joins.lookup_join(facts, lookup, "k", how=how).select("id", "k", "v")
    assert rows(small) == rows(plain)
    large = joins.lookup_join(facts, lookup, "k", spread=["id"], how=how, broadcast_rows=0).select("id", "k", "v")
    assert rows(large) == rows(plain)


def test_salted_join_spreads_hot_key(spark):
    facts = skewed(spark)
    counts = facts.groupBy("k").agg(F.count(F.lit(1)).alias("__n"))
    assert "hot" in [r[0] for r in joins.hot_keys(counts, ["k"], 0.3).collect()]
    assert joins.hot_keys(counts, ["k"], 0.9) is None


def test_null_safe_join_matches_missing_keys(spark):
    facts = skewed(spark)
    lookup = spark.createDataFrame([(None, 4)], "k string, v int")
    missing = facts.where("k is null").count()
    for broadcast_rows in (0, 10):
        out = joins.lookup_join(facts, lookup, "k", spread=["id"], how="inner", null_safe=True, broadcast_rows=broadcast_rows)
        assert out.count() == missing


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_suffix_join_keeps_every_row(spark, rows, broadcast_rows):
    survey = spark.createDataFrame([(1, "12345"), (2, "45"), (3, None), (4, "99999"), (5, "0012345")], "id int, d string")
    registry = spark.createDataFrame([("350000000012345",), ("350000000112345",), ("350000000012345",), (None,)], "full string")
    out = joins.suffix_join(survey, registry, "d", "full", ["id"], broadcast_rows=broadcast_rows).select("id", "full")
    assert rows(out) == [
        (1, "350000000012345"), (1, "350000000112345"), (2, None), (3, None), (4, None), (5, "350000000012345"),
    ]


def test_asof_latest_against_brute_force(spark):
    rng = random.Random(1)
    day = date(2020, 1, 1)
    events = [(i, "hot" if i % 3 else f"k{rng.randrange(5)}", day + timedelta(rng.randrange(90))) for i in range(200)]
    events += [(900, None, day), (901, "hot", None)]
    history = [(f"k{rng.randrange(5)}" if i % 2 else "hot", day + timedelta(rng.randrange(90)), i) for i in range(40)]
    history += [("hot", None, 99)]
    out = joins.asof_latest(
        spark.createDataFrame(events, "id int, k string, t date"),
        spark.createDataFrame(history, "k string, h date, p int"),
        "k", "t", "h", ["p"], ["id"],
    )
    got = {r["id"]: r["p"] for r in out.collect()}
    assert len(got) == len(events)
    for i, k, t in events:
        before = [(h, -p) for kk, h, p in history if k and t and h and kk == k and h < t]
        assert got[i] == (-max(before)[1] if before else None)


def test_full_outer_keeps_both_sides(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "z"), (4, "a")], "id int, k string")
    right = spark.createDataFrame([("a", 10), ("b", 20), ("a", 11)], "kk string, v int")
    out = joins.full_outer(left, right, ["k"], ["kk"], ["id"]).select("id", "k", "v")
    assert rows(out) == [(1, "a", 10), (1, "a", 11), (2, None, None), (3, "z", None), (4, "a", 10), (4, "a", 11), (None, "b", 20)]


def test_without_dates_keeps_rows_without_date(spark):
    df = spark.createDataFrame([(1, date(2020, 1, 1)), (2, date(2020, 1, 2)), (3, None)], "id int, d date")
    days = spark.createDataFrame([(date(2020, 1, 1),), (date(2020, 1, 1),)], "day date")
    assert [r[0] for r in joins.without_dates(df, "d", days, "day").orderBy("id").collect()] == [2, 3]


def test_latest_version_prefers_missing_end(spark, rows):
    df = spark.createDataFrame([("a", "2020", 1), ("a", "2021", 2), ("b", "2020", 3), ("b", None, 4)], "uuid string, end string, v int")
    assert rows(windows.latest_version(df, "uuid", "end")) == [("a", "2021", 2), ("b", None, 4)]


def test_forward_fill_crosses_blocks(spark):
    day = date(2020, 1, 30)
    data = [("a", day + timedelta(20 * i), i if i in (0, 4) else None) for i in range(8)] + [("b", day, None)]
    df = spark.createDataFrame(data, "k string, t date, v int").repartition(3)
    out = windows.forward_fill(df, ["k"], ["t"], ["v"], block=F.trunc("t", "month")).orderBy("k", "t")
    assert [r["v"] for r in out.collect()] == [0, 0, 0, 0, 4, 4, 4, 4, None]


@pytest.mark.parametrize("buckets", [2, 64])
def test_ecdf_is_exact(spark, buckets):
    rng = random.Random(3)
    values = [5.0] * 100 + [float(rng.randrange(50)) for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    got = {r["x"]: r["ecdf"] for r in windows.ecdf(df, "x", buckets).collect()}
    assert got == {v: sum(w <= v for w in values) / len(values) for v in set(values)}


def test_lump_keeps_ties(spark, rows):
    data = [("a",)] * 5 + [("b",)] * 3 + [("c",)] * 3 + [("d",)] + [(None,)] * 9
    out = reshape.lump_top_n(spark.createDataFrame(data, "l string"), "l", 2).groupBy("l").count()
    assert rows(out) == [("a", 5), ("b", 3), ("c", 3), ("other", 1), (None, 9)]


def test_grid_uses_blocks(spark, monkeypatch):
    monkeypatch.setattr(reshape, "LEVELS_PER_BLOCK", 4)
    monkeypatch.setattr(reshape, "BROADCAST_ROWS", 8)
    left = spark.range(7).withColumnRenamed("id", "a")
    right = spark.range(23).select((F.col("id") * 3).alias("b"))
    out = reshape.expand_levels(left, right)
    assert out.count() == 161 and out.distinct().count() == 161


def test_complete_and_densify(spark, rows):
    df = spark.createDataFrame([("a", 1, 5), ("b", 2, 6)], "x string, y int, v int")
    assert rows(reshape.complete(df, ["x", "y"])) == [("a", 1, 5), ("a", 2, None), ("b", 1, None), ("b", 2, 6)]
    day = date(2020, 2, 27)
    trips = spark.createDataFrame(
        [("i", None, "1", day, "t"), ("i", None, "1", day, "u"), ("i", None, "2", day + timedelta(3), "v")],
        "imei string, boat string, code string, d date, trip string",
    )
    out = reshape.densify_days(trips, ["imei", "boat"], ["code"], "d")
    assert out.count() == 9 and out.where("trip is not null").count() == 3


def test_unpivot_drops_two_digit_groups(spark, rows):
    df = spark.createDataFrame([("r", "x", "y")], "uuid string, species_group_0_species_group_species string, species_group_10_species_group_species string")
    assert rows(reshape.unpivot_group(df, ["uuid"])) == [("r", "0", "species", "x")]


def test_weighted_mean_rules(spark):
    df = spark.createDataFrame(
        [("a", 2.0, 1.0), ("a", 4.0, 3.0), ("a", None, 0.0), ("b", None, 1.0), ("c", 5.0, None)], "k string, x double, w double"
    )
    out = df.groupBy("k").agg(aggregates.weighted_mean(F.col("x"), F.col("w")).alias("m")).orderBy("k")
    assert [r["m"] for r in out.collect()] == [3.5, None, None]


def test_intervals_are_ordered(spark):
    df = spark.range(100).select(F.lit("k").alias("k"), F.col("id").cast("double").alias("v"))
    for r in aggregates.interval_summary(df, ["k"], "v").collect():
        assert r["lower"] <= r["median"] <= r["upper"]


@pytest.mark.parametrize("name", ["md5", "xxhash64"])
def test_draw_weights_look_poisson_and_repeat(spark, name):
    df = spark.range(2000).select(F.col("id").cast("string").alias("key"))
    first = draws.with_draws(df, "key", 10, name).agg(F.sum("draw_weight"), F.count("*")).first()
    again = draws.with_draws(df.repartition(5), "key", 10, name).agg(F.sum("draw_weight"), F.count("*")).first()
    assert first == again
    assert abs(first[0] / 20000 - 1) < 0.03 and abs(first[1] / 20000 - 0.632) < 0.02


def test_shrunk_rate_lies_between_cell_and_overall(spark):
    cells = spark.createDataFrame([("1", i, 30, (i * 7) % 25) for i in range(12)], "b string, c int, n_days int, n_trips int")
    for r in shrinkage.shrunk_rates(cells, ["b"]).collect():
        low, high = sorted([r["n_trips"] / r["n_days"], r["overall"]])
        assert low - 1e-12 <= r["estimate"] <= high + 1e-12
    one = shrinkage.shrunk_rates(cells.where("c = 3"), ["b"]).first()
    assert abs(one["estimate"] - one["overall"]) < 1e-3


def test_shrunk_means_pool_when_cells_agree(spark):
    df = spark.createDataFrame([(i % 4, float(i % 5)) for i in range(200)], "c int, y double")
    out = shrinkage.shrunk_means(shrinkage.cell_moments(df, ["c"], "y"), []).collect()
    assert all(abs(r["estimate"] - 2.0) < 0.2 for r in out)


def test_gear_shares_sum_to_one(spark):
    df = spark.createDataFrame([("m1", "1", "GN", 5), ("m1", "1", "HL", 2), ("m2", "1", "GN", 1)], "m string, b string, g string, n int")
    out = shrinkage.shrunk_shares(df, ["m", "b"], ["b"], "g", "n")
    sums = out.groupBy("m", "b").agg(F.sum("estimate").alias("s")).collect()
    assert len(sums) == 2 and all(abs(r["s"] - 1) < 1e-12 for r in sums)


def test_zero_inflated_poisson_recovers_structure(spark):
    rng = random.Random(5)

    def poisson(mean):
        total, count = rng.expovariate(1), 0
        while total < mean:
            total, count = total + rng.expovariate(1), count + 1
        return count

    data = [(g, 0 if rng.random() < 0.3 else poisson(4 if g == "a" else 9)) for g in "ab" for _ in range(600)]
    cells = glm.level_cells(spark.createDataFrame(data, "g string, y int"), ["g"], ["y"])
    model = glm.fit_cells(cells, ["g"], "y", "poisson", reg=0.0001, zero_inflated=True)
    assert abs(model.inflation - 0.3) < 0.06
    grid = spark.createDataFrame([("a",), ("b",), ("new",)], "g string")
    got = {r["g"]: r["estimate"] for r in glm.predict_grid(model, grid, ["g"]).collect()}
    assert abs(got["a"] - 2.8) < 0.5 and abs(got["b"] - 6.3) < 0.7
    assert got["a"] < got["new"] < got["b"]


def test_joint_model_and_huber(spark):
    data = [(m, b, s, 30, (5 if m == "x" else 15) + (3 if b == "2" else 0)) for m in ("x", "y") for b in ("1", "2") for s in ("1", "2")]
    cells = glm.level_cells(spark.createDataFrame(data, "m string, b string, s string, n_days int, n_trips int"), ["m", "b", "s"], ["n_days", "n_trips"])
    _, effects, corr = glm.fit_joint(cells, "m", "b", "n_trips", "n_days", ["s"])
    got = {r["m"]: (r["effect_1"], r["effect_2"]) for r in effects.collect()}
    assert got["y"][0] > got["x"][0] and got["y"][1] > got["x"][1] and corr.first()[0] > 0.9
    trips = spark.createDataFrame(
        [(c, 1.0, "none", 0.0, v + 0.01 * (i % 3)) for c, v in (("a", 0.0), ("b", 2.0)) for i in range(40)] + [("a", 1.0, "none", 0.0, 50.0)],
        "c1 string, w1 double, c2 string, w2 double, y double",
    )
    fit = {r["species_code"]: r["log_price"] for r in glm.fit_membership_huber(trips, ["c1", "c2"], ["w1", "w2"], "y", 0.001).collect()}
    assert abs(fit["a"]) < 0.3 and abs(fit["b"] - 2) < 0.3 and "none" not in fit


def test_choose_reg_prefers_a_light_penalty_on_clear_effects(spark):
    data = [(f"g{i % 6}", f"p{i % 4}", 2 + 3 * (i % 6) + i % 2) for i in range(480)]
    cells = glm.level_cells(spark.createDataFrame(data, "g string, p string, y int"), ["g", "p"], ["y"])
    assert glm.choose_reg(cells, ["g"], "y", "poisson", [0.001, 50.0]) == 0.001


def test_draws_queries_take_the_references_hundred_draws(spark):
    from catalog.queries import QUERIES

    sf_dir = "/root/testdata/sf0.001"
    assert QUERIES["q_bootstrap_draws"](spark, sf_dir).agg(F.countDistinct("draw")).first()[0] == 100


def test_costly_facts_of_a_large_lookup_are_made_once(spark, rows):
    made = spark.sparkContext.accumulator(0)

    def costly(v):
        made.add(1)
        return v

    facts = spark.createDataFrame([(i, i % 7) for i in range(40)], "id int, k int").withColumn("v", F.udf(costly, "int").asNondeterministic()("id"))
    lookup = spark.createDataFrame([(k, f"n{k}") for k in range(5)], "k int, name string")
    out = joins.lookup_join(facts, lookup, "k", spread=["id"], broadcast_rows=1, write=True)
    assert rows(out.select("id", "k", "name")) == rows(facts.drop("v").join(lookup, "k", "left").select("id", "k", "name"))
    before = made.value
    joins.lookup_join(facts, lookup, "k", spread=["id"], broadcast_rows=1, write=True).collect()
    assert made.value - before == 40


@pytest.mark.parametrize("name", ["md5", "xxhash64"])
def test_weights_of_draws_equal_those_of_their_numbers(spark, name):
    units = spark.range(300).select(F.col("id").cast("string").alias("unit"))
    found = draws.with_draws(units, "unit", 50, name)
    number = units.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(50)))).withColumn("u", draws.draw_uniform(F.col("unit"), F.col("draw"), name))
    expected = {(r.unit, r.draw): float(sum(cut <= r.u for cut in draws.POISSON_CUTS)) for r in number.collect()}
    assert {(r.unit, r.draw): r.draw_weight for r in found.collect()} == {k: w for k, w in expected.items() if w}
    # Digits are compared as they are.
    assert "conv(" not in found._jdf.queryExecution().optimizedPlan().toString()
