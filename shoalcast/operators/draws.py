"""Uncertainty by a deterministic bootstrap: Poisson weights of units, or numbers simulated from a fit."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoalcast.operators import resample

# Cumulative probabilities of a Poisson variable with mean 1, for 0, 1, 2, ...
POISSON_CUTS = [
    0.367879441,
    0.735758882,
    0.919698603,
    0.981011843,
    0.996340153,
    0.999405815,
    0.999916759,
    0.999989751,
    0.999998875,
    0.999999888575,
    0.999999989952,
    0.999999999168,
    0.999999999936,
]


def md5_digits(key: Column, draw: Column) -> Column:
    """The first 32 bits of a digest of key and draw, as eight hexadecimal digits."""
    return F.substring(F.md5(F.concat(key.cast("string"), F.lit("-"), draw.cast("string"))), 1, 8)


def draw_uniform(key: Column, draw: Column, hash_name: str = "xxhash64") -> Column:
    """Number in [0, 1) that depends on the key and the draw only.

    ``xxhash64`` for production; ``md5`` gives the same numbers in other SQL engines.
    """
    if hash_name == "md5":
        return F.conv(md5_digits(key, draw), 16, 10).cast("double") / F.lit(2.0**32)
    return F.shiftrightunsigned(F.xxhash64(key, draw), 11).cast("double") / F.lit(2.0**53)


def reached(value: Column, cuts: Sequence) -> Column:
    """How many of the ascending ``cuts`` the value has reached; the low ones, which most values stop at, are tried first."""
    out = F.when(value.isNull() | (value < cuts[0]), 0.0)
    for n, cut in enumerate(cuts[1:], start=1):
        out = out.when(value < cut, float(n))
    return out.otherwise(float(len(cuts)))


def poisson_weight(uniform: Column) -> Column:
    """How many of the cumulative probabilities ``uniform`` has reached."""
    return reached(uniform, POISSON_CUTS)


def draw_value(key: Column, draw: Column, hash_name: str) -> tuple[Column, list]:
    """What a draw's weight is read from, and the cuts it is held against: digits as text order like the numbers they
    spell, so no digest is made a number."""
    if hash_name == "md5":
        marks = [math.ceil(cut * 2**32) for cut in POISSON_CUTS]
        return md5_digits(key, draw), [f"{mark:08x}" for mark in marks if mark < 2**32]
    return draw_uniform(key, draw, hash_name), POISSON_CUTS


def with_draws(df: DataFrame, key: str, draws: int, hash_name: str = "xxhash64") -> DataFrame:
    """One row per draw in which the row's unit occurs, with its multiplicity ``draw_weight``.

    Rows sharing ``key`` are resampled together.  Always follow with an aggregation by
    (cell, draw): it combines on the map side, so only cells x draws rows are shuffled.
    Rows are multiplied where the scan left them; pass only needed columns.  The hash is
    taken once a row and draw, as a field of what is exploded.
    """
    number = F.sequence(F.lit(1), F.lit(draws))
    _, cuts = draw_value(F.lit(""), F.lit(0), hash_name)
    each = F.transform(number, lambda draw: F.struct(draw.alias("draw"), draw_value(F.col(key), draw, hash_name)[0].alias("u")))
    exploded = df.select("*", F.explode(each).alias("__draw")).where(F.col("__draw.u") >= cuts[0])
    return exploded.withColumns({"draw": F.col("__draw.draw"), "draw_weight": reached(F.col("__draw.u"), cuts)}).drop("__draw")


def drawn_sums(
    df: DataFrame, key: str, keys: Sequence[str], draws: int, sums: dict[str, Column], hash_name: str = "xxhash64", dealt: bool = True
) -> DataFrame:
    """``sums`` of columns times ``draw_weight`` by ``keys`` and draw: ``with_draws`` and its aggregation in one.

    Digests are costly in rows, so under md5 the draws of a row are made as an array.  Rows are ``dealt`` by cell, so
    that few sums of parts of a cell are shuffled; where cells are few that is not worth a shuffle of the rows.
    """
    if hash_name == "md5":
        return resample.weighted_sums(df, key, keys, draws, sums, POISSON_CUTS, dealt)
    resampled = with_draws(df.select(key, *keys, *[c.alias(f"__{n}") for n, c in sums.items()]), key, draws, hash_name)
    return resampled.groupBy(*keys, "draw").agg(*[F.sum(F.col(f"__{n}") * F.col("draw_weight")).alias(n) for n in sums])


# Trials of one inverse-CDF draw; more are drawn in several parts.
TRIALS = 64


def binomial_quantile(uniform: Column, trials: Column, rate: Column) -> Column:
    """The smallest number of successes whose cumulative probability exceeds ``uniform``: one walk up the distribution."""
    ratio = rate / (1 - rate)

    def next_term(state: Column, i: Column) -> Column:
        term = state["term"] * (trials - i + 1) / i * ratio
        return F.struct(
            term.alias("term"), (state["below"] + term).alias("below"), (state["k"] + F.when(state["below"] <= uniform, 1).otherwise(0)).cast("long").alias("k")
        )

    first = F.pow(1 - rate, trials)
    start = F.struct(first.alias("term"), first.alias("below"), F.lit(0).cast("long").alias("k"))
    steps = F.when(trials > 0, F.sequence(F.lit(1).cast("long"), trials.cast("long"))).otherwise(F.array().cast("array<long>"))
    return F.aggregate(steps, start, next_term, lambda state: state["k"])


def binomial_draw(key: Column, draw: Column, trials: Column, rate: Column, hash_name: str = "xxhash64") -> Column:
    """A binomial number that depends on the key and the draw only.

    Trials are drawn ``TRIALS`` at a time, each part from a number of its own: a sum of binomials of one rate is binomial.
    """
    held = F.least(F.greatest(rate, F.lit(0.0)), F.lit(1 - 1e-12))
    parts = F.sequence(F.lit(0).cast("long"), F.greatest(F.floor((trials - 1) / TRIALS), F.lit(0)).cast("long"))

    def numbered(i: Column) -> Column:
        uniform = draw_uniform(F.concat_ws(".", key.cast("string"), i.cast("string")), draw, hash_name)
        return F.struct(uniform.alias("u"), F.least(trials.cast("double") - i * TRIALS, F.lit(float(TRIALS))).alias("size"))

    # The hash is taken once a part, before the walk up its distribution.
    uniforms = F.transform(parts, numbered)
    return F.aggregate(uniforms, F.lit(0).cast("long"), lambda total, x: total + binomial_quantile(x["u"], x["size"], held))


def poisson_quantile(uniform: Column, mean: Column, most: int = 200) -> Column:
    """The smallest number whose cumulative Poisson probability exceeds ``uniform``; for means up to about 100."""

    def next_term(state: Column, i: Column) -> Column:
        term = state["term"] * mean / i
        return F.struct(
            term.alias("term"), (state["below"] + term).alias("below"), (state["k"] + F.when(state["below"] <= uniform, 1).otherwise(0)).cast("long").alias("k")
        )

    start = F.struct(F.exp(-mean).alias("term"), F.exp(-mean).alias("below"), F.lit(0).cast("long").alias("k"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(most)), start, next_term, lambda state: state["k"])


def simulated_trips(
    cells: DataFrame, key: Column, draws: int, n: str, rate: str, out: str, hash_name: str = "xxhash64", by: Sequence[str] | None = None
) -> DataFrame:
    """Cells by draw with a simulated number ``out`` of ``n`` trials at the fitted rate: the data of a parametric bootstrap.

    With ``by`` trials and numbers summed by these columns and draw; the cells are then not written out for each draw.
    """
    if by is not None and hash_name == "md5":
        return resample.binomial_sums(cells, key, by, draws, n, rate, out, TRIALS)
    exploded = cells.withColumn("draw", F.explode(F.sequence(F.lit(1), F.lit(draws))))
    simulated = exploded.withColumn(out, binomial_draw(key, F.col("draw"), F.col(n), F.col(rate), hash_name))
    return simulated if by is None else simulated.groupBy(*by, "draw").agg(*[F.sum(c).cast("double").alias(c) for c in (n, out)])
