"""Draws summed on arrays against the same draws as rows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from shoalcast.operators import draws, resample
from shoalcast.plans import prices


def test_digests_are_md5():
    keys = [b"", b"7", b"150000-2", "ré".encode(), b"x" * 51, b"x" * 52, b"y" * 80]
    found = resample.md5_heads(keys, 120)
    assert found.tolist() == [[int(hashlib.md5(k + f"-{d}".encode()).hexdigest()[:8], 16) for d in range(1, 121)] for k in keys]


@pytest.fixture(scope="module")
def units(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice(["a", "b", None, *map(str, range(300))]), rnd.choice(["p", "q", None]), rnd.choice([1.0, 2.5, None]), float("inf") if i == 5 else 1.0) for i in range(900)]
    return spark.createDataFrame([*rows, ("only", "r", None, 1.0)], "unit string, place string, y double, z double").repartition(5)


@pytest.mark.parametrize("name", ["md5", "xxhash64"])
def test_drawn_sums_are_those_of_the_rows(spark, units, name):
    weight = F.col("draw_weight")
    rowwise = draws.with_draws(units, "unit", 30, name).groupBy("place", "draw").agg(F.sum(F.col("y") * weight).alias("s"), F.sum(F.col("z") * weight).alias("z"), F.sum(weight).alias("n"))
    summed = draws.drawn_sums(units, "unit", ["place"], 30, {"s": F.col("y"), "z": F.col("z"), "n": F.lit(1.0)}, name)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 70)
    try:
        found = {(r["place"], r["draw"]): (r["s"], r["z"], r["n"]) for r in summed.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == {(r["place"], r["draw"]): (r["s"], r["z"], r["n"]) for r in rowwise.collect()}
    assert any(p == "r" and s is None for (p, _), (s, _, _) in found.items())


@pytest.mark.parametrize("name", ["md5", "xxhash64"])
def test_simulated_sums_are_those_of_the_rows(spark, name):
    rows = [(f"c{i}", "p" if i % 3 else None, t, p) for i, (t, p) in enumerate([(31, 0.03), (0, 0.5), (200, 0.9), (64, 0.5), (65, 0.4), (30, None), (None, 0.2), (28, 1.0), (30, 0.0)] * 9)]
    cells = spark.createDataFrame([*rows, ("c", "none", None, 0.1)], "id string, place string, n long, p double")
    rowwise = draws.simulated_trips(cells, F.col("id"), 20, "n", "p", "k", name).groupBy("place", "draw").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    summed = draws.simulated_trips(cells, F.col("id"), 20, "n", "p", "k", name, by=["place"])
    assert {tuple(r) for r in summed.select("place", "draw", "n", "k").collect()} == {tuple(r) for r in rowwise.select("place", "draw", "n", "k").collect()}
    # No row is made for each draw before the sums.
    plan = summed._jdf.queryExecution().optimizedPlan().toString()
    assert name != "md5" or "Generate" not in plan


def test_price_intervals_by_arrays_are_those_of_the_joins(spark, monkeypatch):
    codes = ["a", "b", "none", None, "new"]
    rnd = random.Random(8)
    rows = [(str(i), *[x for _ in range(3) for x in (rnd.choice(codes), rnd.choice([0.0, None, -1.0, 0.5, 3.0]))]) for i in range(200)]
    rows += [("nan", "a", float("nan"), "b", 1.0, None, None), ("inf", "a", float("inf"), "b", 1.0, None, None)]
    wide = spark.createDataFrame(rows, "record_id string, " + ", ".join(f"species_code_{s} string, weight_{s} double" for s in prices.SLOTS))
    # Draw 3 has no estimate of b, draw 4 none at all.
    estimates = spark.createDataFrame([("a", d, 0.1 * d) for d in (1, 2, 3, 5)] + [("b", d, -0.2 * d) for d in (1, 2, 5)], "species_code string, draw int, estimate double")
    overall = spark.createDataFrame([(d, 0.3 * d) for d in (1, 2, 3, 5)], "draw int, overall double")
    found = []
    for most in (prices.MOST_SPECIES, 0):
        monkeypatch.setattr(prices, "MOST_SPECIES", most)
        for width in (0.95, 0.3):
            out = prices.price_interval(wide, estimates, overall, 5, width)
            assert (most == 0) == ("ArrowEvalPython" not in out._jdf.queryExecution().optimizedPlan().toString())
            found.append({r["record_id"]: tuple(None if v is None else f"{v:.9g}" for v in (r["price_lower"], r["price_upper"])) for r in out.collect()})
    assert found[0] == found[2] and found[1] == found[3] and len(found[0]) == 202
    assert any(v[0] is not None for v in found[1].values()) and any(v[0] is None for v in found[1].values())
