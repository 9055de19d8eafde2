"""Robust prices per species from weighted memberships (E4): Student-t errors, one random effect a species.

log price = intercept + sum over a trip's species of share x effect + error.  Each round weighs trips by how far they
lie off (the t weights of iteratively reweighted least squares), then solves the weighted, penalised normal equations by
conjugate gradients.  The equations live in tables: a row for each species and for each two species that occur in one
trip.  Nothing is collected and species may be as many as the data has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoalcast.operators.crossed import INTERCEPT, LEAST_VARIANCE, solve
from shoalcast.session import cut_lineage, drop_written

FREEDOM = 4.0
LEVEL = ["fit", "factor", "level"]


def with_terms(members: DataFrame, key: str, species: str, share: str, y: str) -> DataFrame:
    """One row for each trip: ``y`` and its terms (factor, level, x), the intercept first; equal species of a trip add up."""
    once = members.where(F.col(y).isNotNull() & (F.col(share) > 0)).groupBy(key, species).agg(F.sum(share).alias("x"), F.first(y).alias("y"))
    term = F.struct(F.lit("species").alias("factor"), F.col(species).alias("level"), F.col("x"))
    own = F.array(F.struct(F.lit(INTERCEPT).alias("factor"), F.lit("").alias("level"), F.lit(1.0).alias("x")))
    return once.groupBy(key).agg(F.first("y").alias("y"), F.concat(own, F.sort_array(F.collect_list(term))).alias("terms"))


def residuals(trips: DataFrame, key: str, effects: DataFrame) -> DataFrame:
    """Trips with ``r``, what their terms leave of ``y``."""
    term = trips.select(key, "y", F.explode("terms").alias("t")).select(key, "y", "t.*").join(effects.select("factor", "level", "value"), ["factor", "level"])
    fitted = term.groupBy(key).agg(F.sum(F.col("x") * F.col("value")).alias("fitted"))
    return trips.join(fitted, key).withColumn("r", F.col("y") - F.col("fitted")).drop("fitted")


def normal_equations(weighted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Curvature and score of each term, and curvatures of terms that occur together, of trips with a weight ``w``."""
    one = weighted.select("w", "r", "terms", F.explode("terms").alias("a"))
    sums = one.groupBy(F.lit(0).alias("fit"), "a.factor", "a.level").agg(
        F.sum(F.col("w") * F.col("a.x") * F.col("a.x")).alias("weight"), F.sum(F.col("w") * F.col("a.x") * F.col("r")).alias("pull")
    )
    two = one.select("w", "a", F.explode("terms").alias("b")).where((F.col("a.factor") != F.col("b.factor")) | (F.col("a.level") != F.col("b.level")))
    links = two.groupBy(F.lit(0).alias("fit"), "a.factor", "a.level", F.col("b.factor").alias("other"), F.col("b.level").alias("other_level")).agg(
        F.sum(F.col("w") * F.col("a.x") * F.col("b.x")).alias("weight")
    )
    return sums, links


def species_effects(
    members: DataFrame, key: str = "record_id", species: str = "species_code", share: str = "share", y: str = "log_price", rounds: int = 3, iterations: int = 4, freedom: float = FREEDOM
) -> DataFrame:
    """(species, effect, estimate): effects and log prices of all species, robust against trips far off."""
    trips = cut_lineage(with_terms(members, key, species, share, y))
    mean = trips.agg(F.avg("y").alias("m"), F.var_samp("y").alias("v"))
    levels = trips.select(F.explode("terms").alias("t")).select("t.factor", "t.level").distinct()
    middle = mean.select("m").scalar()
    value = F.when(F.col("factor") == INTERCEPT, middle).otherwise(0.0)
    effects = cut_lineage(levels.select("factor", "level", value.alias("value"), F.lit(1.0).alias("variance")))
    scale = cut_lineage(mean.select(F.greatest("v", F.lit(LEAST_VARIANCE)).alias("scale")))
    for _ in range(rounds):
        spread = F.col("r") * F.col("r")
        rows = residuals(trips, key, effects).withColumn("scale", scale.select("scale").scalar())
        rows = rows.withColumn("omega", (freedom + 1) / (freedom + spread / F.col("scale")))
        rows = cut_lineage(rows.withColumn("w", F.col("omega") / F.col("scale")))
        sums, links = normal_equations(rows)
        variance = effects.where(F.col("factor") != INTERCEPT).agg(F.avg(F.col("value") * F.col("value") + F.col("variance")).alias("v"))
        precision = F.when(F.col("factor") == INTERCEPT, 0.0).otherwise(1 / F.greatest(variance.scalar(), F.lit(LEAST_VARIANCE)))
        joined = sums.join(effects, ["factor", "level"]).withColumn("precision", precision)
        score = F.col("pull") - F.col("precision") * F.col("value")
        system = cut_lineage(joined.select(*LEVEL, "value", (F.col("weight") + F.col("precision")).alias("size"), score.alias("score")))
        links = cut_lineage(links)
        steps = solve(links, system, "fit", ["fit"], iterations)
        before = effects, scale
        effects = cut_lineage(system.join(steps, LEVEL).select("factor", "level", (F.col("value") + F.col("x")).alias("value"), (1 / F.col("size")).alias("variance")))
        scale = cut_lineage(rows.agg(F.greatest(F.avg(F.col("omega") * spread), F.lit(LEAST_VARIANCE)).alias("scale")))
        drop_written(rows, links, system, steps, *before)
    drop_written(trips)
    level = effects.where(F.col("factor") == INTERCEPT).select("value").scalar()
    found = effects.where(F.col("factor") != INTERCEPT)
    return found.select(F.col("level").alias(species), F.col("value").alias("effect"), (F.col("value") + level).alias("estimate"))
