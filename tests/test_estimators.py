"""Correlated effects, robust prices, hierarchical shares, simulated numbers, sketches and day output."""

import math
import random
from collections import Counter
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoalcast.operators import aggregates, draws, joins, membership, shrinkage
from shoalcast.sources import writers


def test_correlated_effects_come_back(spark):
    rnd = np.random.default_rng(3)
    effects = rnd.multivariate_normal([-0.5, 0.4], [[0.6, 0.42], [0.42, 0.5]], size=400)
    rows = []
    for place, pair in enumerate(effects):
        for code, eta in zip("12", pair):
            if place % 10 == 0 and code == "2":
                continue
            rows.append((f"p{place}", code, 200, int(rnd.binomial(200, 1 / (1 + math.exp(-eta))))))
    cells = spark.createDataFrame(rows, "place string, code string, n int, k int")
    out = shrinkage.shrunk_pairs(shrinkage.logit_cells(cells, "place", "code", ["1", "2"], "n", "k"), "place").collect()
    assert len(out) == 400
    assert abs(out[0]["correlation"] - 0.42 / math.sqrt(0.3)) < 0.1
    assert abs(out[0]["var_1"] - 0.6) < 0.15
    # A place seen with one boat type borrows for the other.
    got = {r["place"]: r for r in out}
    missing = [(got[f"p{p}"]["effect_2"], effects[p][1] - 0.4) for p in range(0, 400, 10)]
    assert np.corrcoef(np.array(missing).T)[0, 1] > 0.5
    alone = spark.createDataFrame([("a", "1", 10, 5), ("b", "3", 10, 5)], "place string, code string, n int, k int")
    lone = {r["place"]: r for r in shrinkage.shrunk_pairs(shrinkage.logit_cells(alone, "place", "code", ["1", "2"], "n", "k"), "place").collect()}
    assert lone["b"]["effect_1"] == lone["b"]["effect_2"] == 0.0


def test_concentrations_and_shares_of_a_hierarchy(spark):
    rnd = np.random.default_rng(5)
    gears, rows = ["a", "b", "c", "d"], []
    top = {"1": np.array([0.4, 0.3, 0.2, 0.1]), "2": np.array([0.1, 0.2, 0.3, 0.4])}
    for boat, shares in top.items():
        for place in range(60):
            own = rnd.dirichlet(8 * shares)
            for month in range(12):
                month_shares = rnd.dirichlet(40 * own)
                for gear, n in zip(gears, rnd.multinomial(rnd.integers(5, 60), month_shares)):
                    if n:
                        rows.append((boat, f"p{place}", month, gear, int(n)))
    counts = spark.createDataFrame(rows, "boat string, place string, month int, gear string, n long")
    out = shrinkage.hierarchical_shares(counts, ["boat", "place", "month"], "gear", "n").collect()
    total = Counter()
    for r in out:
        total[r["boat"], r["place"], r["month"]] += r["estimate"]
    assert all(abs(x - 1) < 1e-9 for x in total.values()) and len(total) == 2 * 60 * 12
    assert 25 < out[0]["kappa"] < 70
    second = shrinkage.hierarchical_shares(counts, ["boat", "place"], "gear", "n").first()["kappa"]
    assert 5 < second < 13


def dense_student(trips, rounds, freedom=4.0):
    """The same rounds with dense matrices and exact solutions."""
    codes = sorted({c for _, terms in trips for c in terms})
    x = np.array([[1.0, *[terms.get(c, 0.0) for c in codes]] for _, terms in trips])
    y = np.array([v for v, _ in trips])
    beta, spread = np.array([y.mean(), *[0.0] * len(codes)]), np.ones(len(codes))
    scale = y.var(ddof=1)
    for _ in range(rounds):
        r = y - x @ beta
        omega = (freedom + 1) / (freedom + r * r / scale)
        w = omega / scale
        precision = np.array([0.0, *[1 / max((beta[1:] ** 2 + spread).mean(), 1e-4)] * len(codes)])
        curvature = (x * w[:, None]).T @ x + np.diag(precision)
        spread = 1 / np.diag(curvature)[1:]
        beta = beta + np.linalg.solve(curvature, x.T @ (w * r) - precision * beta)
        scale = max((omega * r * r).mean(), 1e-4)
    return {c: (b, b + beta[0]) for c, b in zip(codes, beta[1:])}


def test_robust_prices_equal_dense_rounds_and_bear_outliers(spark):
    rnd = random.Random(9)
    true = {f"s{i}": rnd.gauss(0, 0.8) for i in range(12)}
    trips = []
    for i in range(600):
        picked = rnd.sample(sorted(true), 2)
        share = rnd.choice([0.25, 0.5, 0.75])
        terms = {picked[0]: share, picked[1]: 1 - share}
        y = 1.5 + sum(s * true[c] for c, s in terms.items()) + rnd.gauss(0, 0.1)
        trips.append((y + (8 if i % 15 == 0 else 0), terms))
    rows = [(str(i), c, s, y) for i, (y, terms) in enumerate(trips) for c, s in terms.items()]
    rows += [("600", "s0", 0.5, None), ("601", "s1", 0.0, 2.0)]
    members = spark.createDataFrame(rows, "record_id string, species_code string, share double, log_price double")
    got = {r["species_code"]: (r["effect"], r["estimate"]) for r in membership.species_effects(members, rounds=3, iterations=13).collect()}
    expected = dense_student(trips, 3)
    assert got.keys() == expected.keys()
    for code in expected:
        assert got[code] == pytest.approx(expected[code], abs=1e-3)
    found = np.array([[got[c][0], true[c]] for c in true]).T
    assert np.corrcoef(found)[0, 1] > 0.95


def test_binomial_and_poisson_numbers(spark):
    cells = spark.createDataFrame([(i, n, p) for i, (n, p) in enumerate([(0, 0.5), (30, 0.2), (30, 1.0), (31, 0.0), (150, 0.9)])], "id int, n int, p double")
    drawn = draws.simulated_trips(cells, F.col("id"), 4000, "n", "p", "k", "md5")
    stats = {r["id"]: r for r in drawn.groupBy("id").agg(F.avg("k").alias("m"), F.var_samp("k").alias("v"), F.min("k").alias("lo"), F.max("k").alias("hi")).collect()}
    assert (stats[0]["lo"], stats[0]["hi"]) == (0, 0) and (stats[2]["lo"], stats[3]["hi"]) == (30, 0)
    for i, n, p in ((1, 30, 0.2), (4, 150, 0.9)):
        assert abs(stats[i]["m"] - n * p) < 0.15 and abs(stats[i]["v"] / (n * p * (1 - p)) - 1) < 0.1
        assert 0 <= stats[i]["lo"] and stats[i]["hi"] <= n
    again = draws.simulated_trips(cells, F.col("id"), 4000, "n", "p", "k", "md5")
    assert again.exceptAll(drawn).count() == 0
    u = [0.0, 0.3, 0.5, 0.9, 0.999999]
    frame = spark.createDataFrame([(x, m) for x in u for m in (0.0, 2.5, 40.0)], "u double, m double")
    for r in frame.select("u", "m", draws.poisson_quantile(F.col("u"), F.col("m")).alias("k")).collect():
        term, below, k = math.exp(-r["m"]), math.exp(-r["m"]), 0
        while below <= r["u"] and r["m"]:
            k += 1
            term *= r["m"] / k
            below += term
        assert r["k"] == k


def test_a_key_with_half_of_all_rows_is_carried_over_parts(spark):
    rnd = random.Random(2)
    rows = [("hot" if i % 2 else f"k{rnd.randrange(30)}", rnd.randrange(10_000), i) for i in range(4000)]
    rows = [(k, t, i, i if rnd.random() < 0.01 else None) for k, t, i in rows]
    frame = spark.createDataFrame(rows, "k string, t int, i int, v int")
    out = joins.carried_forward(frame, "k", ["t", "i"], "v", parts=16)
    expected, last = {}, {}
    for k, t, i, v in sorted(rows):
        last[k] = v if v is not None else last.get(k)
        expected[i] = last[k]
    assert {r["i"]: r["v"] for r in out.collect()} == expected
    sizes = frame.repartitionByRange(16, "k", "t", "i").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert sizes < 1000


def test_sketches_of_parts_add_up(spark):
    values = spark.range(30_000).select((F.col("id") % 3).alias("k"), (F.col("id") % 7).alias("part"), F.col("id").cast("double").alias("v"))
    whole = aggregates.merged_sketches(aggregates.sketches(values, ["k", "part"], "v"), ["k"])
    for r in aggregates.sketch_quantiles(whole, ["k"], (0.025, 0.5, 0.975)).collect():
        assert r["n"] == 10_000 and abs(r["quantile"] / 30_000 - r["mark"]) < 0.01


def test_writing_a_day_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = lambda *r: spark.createDataFrame(r, "trip string, day date")
    one, two = date(2024, 1, 1), date(2024, 1, 2)
    writers.write_by_day(rows(("a", one), ("b", one)), path)
    writers.write_by_day(rows(("c", two)), path)
    writers.write_by_day(rows(("d", two), ("e", two)), path)
    writers.write_by_day(rows(("d", two), ("e", two)), path)
    assert sorted((r["trip"], r["day"]) for r in spark.read.parquet(path).collect()) == [("a", one), ("b", one), ("d", two), ("e", two)]


def test_draw_weights_follow_their_cuts(spark):
    frame = spark.createDataFrame([(u,) for u in (0.0, 0.367879440, 0.367879441, 0.7, 0.92, 0.9999999999999)], "u double")
    got = [r[0] for r in frame.select(draws.poisson_weight(F.col("u"))).collect()]
    assert got == [0.0, 0.0, 1.0, 1.0, 3.0, 13.0]
