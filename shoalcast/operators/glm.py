"""Regularised GLMs on cell tables with Spark ML.

The L2 penalty takes the place of the random-intercept variances.  Rows are grouped to
(effect levels, response) with a count before any fit: the predictors are categorical and
the response is an integer, so this is exact and the iterations touch a small table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GeneralizedLinearRegression, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoalcast.functions.numeric import inverse_logit
from shoalcast.session import cut_lineage



@dataclass
class CellModel:
    """Fitted effects: a table (effect, level, value) of at most 4096 rows, and scalars."""

    effects: DataFrame
    intercept: float
    inflation: float
    dispersion: float
    family: str
    reg: float
    iterations: int


def level_cells(df: DataFrame, effects: Sequence[str], response: Sequence[str]) -> DataFrame:
    """Group rows to distinct (levels, response) with their number ``n_rows``."""
    keys = [*effects, *response]
    return df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("n_rows"))


def _encoder(effects: Sequence[str]) -> Pipeline:
    indexed = [f"__i_{e}" for e in effects]
    encoded = [f"__v_{e}" for e in effects]
    return Pipeline(
        stages=[
            StringIndexer(inputCols=list(effects), outputCols=indexed, stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=False),
            VectorAssembler(inputCols=encoded, outputCol="features"),
        ]
    )


def _mean_of(family: str, eta: Column) -> Column:
    return inverse_logit(eta) if family == "binomial" else F.exp(eta)


def _zero_probability(family: str, mean: Column, trials: Column) -> Column:
    return F.pow(1 - mean, trials) if family == "binomial" else F.exp(-mean)


def fit_cells(
    cells: DataFrame,
    effects: Sequence[str],
    label: str,
    family: str,
    trials: str | None = None,
    reg: float = 0.01,
    zero_inflated: bool = False,
    max_em: int = 10,
    tol: float = 1e-4,
) -> CellModel:
    """Fit a binomial or Poisson GLM with one intercept per level of each effect.

    ``cells`` comes from :func:`level_cells`.  With ``zero_inflated`` a constant share of
    structural zeros is fitted by EM: each round is one fit and one aggregate over the same
    checkpointed table, so no lineage builds up.
    """
    spark = cells.sparkSession
    size = F.col(trials).cast("double") if trials else F.lit(1.0)
    response = F.col(label) / size if family == "binomial" else F.col(label).cast("double")
    base = (
        cells.withColumns({e: F.col(e).cast("string") for e in effects})
        .withColumns({"__trials": size, "__y": response})
        .where(F.col("__trials") > 0)
    )
    encoder = _encoder(effects).fit(base)
    table = cut_lineage(
        encoder.transform(base).select(*effects, "features", "__y", "__trials", "n_rows")
    )
    multiplier = F.col("__trials") if family == "binomial" else F.lit(1.0)
    glm = GeneralizedLinearRegression(
        family=family,
        link="logit" if family == "binomial" else "log",
        labelCol="__y",
        weightCol="__w",
        regParam=reg,
        maxIter=50,
    )

    totals = table.agg(
        F.sum("n_rows").alias("rows"), F.sum(F.when(F.col("__y") == 0, F.col("n_rows"))).alias("zeros")
    ).first()
    inflation = 0.5 * (totals["zeros"] or 0.0) / totals["rows"] if zero_inflated else 0.0
    # Before the first fit a zero row is structural with half the chance of a zero.
    weighted = table.withColumn(
        "__w", multiplier * F.col("n_rows") * F.when(F.col("__y") == 0, 1 - F.lit(inflation)).otherwise(1.0)
    )
    rounds = 0
    while True:
        rounds += 1
        model = glm.fit(weighted)
        scored = model.transform(table).withColumnRenamed("prediction", "__mean")
        if not zero_inflated:
            break
        chance = _zero_probability(family, F.col("__mean"), F.col("__trials"))
        structural = F.when(
            F.col("__y") == 0, F.lit(inflation) / (F.lit(inflation) + (1 - F.lit(inflation)) * chance)
        ).otherwise(0.0)
        scored = scored.withColumn("__z", structural)
        updated = scored.agg((F.sum(F.col("__z") * F.col("n_rows")) / F.sum("n_rows")).alias("p")).first()["p"]
        moved, inflation = abs(updated - inflation), updated
        if moved < tol or rounds == max_em:
            break
        weighted = scored.drop("__mean").withColumn("__w", multiplier * F.col("n_rows") * (1 - F.col("__z")))

    mean = F.col("__mean")
    variance = mean * (1 - mean) / F.col("__trials") if family == "binomial" else mean
    chi = scored.agg(
        F.sum(F.col("n_rows") * F.pow(F.col("__y") - mean, 2) / F.greatest(variance, F.lit(1e-12))).alias("c")
    ).first()["c"]

    # The coefficients are the model: at most 4096 numbers.
    names = [(e, lv) for e, levels in zip(effects, encoder.stages[0].labelsArray) for lv in levels]
    rows = [(e, lv, float(c)) for (e, lv), c in zip(names, model.coefficients.toArray())]
    return CellModel(
        effects=spark.createDataFrame(rows, "effect string, level string, value double"),
        intercept=float(model.intercept),
        inflation=float(inflation),
        dispersion=float(chi / max(totals["rows"] - len(names) - 1, 1.0)),
        family=family,
        reg=reg,
        iterations=rounds,
    )


def choose_reg(cells: DataFrame, effects: Sequence[str], label: str, family: str, grid: Sequence[float], **fit) -> float:
    """Penalty with the smallest squared error on a fifth of the cells (set aside by hash)."""
    part = F.pmod(F.xxhash64(*cells.columns), F.lit(5))
    trials = fit.get("trials")
    y = F.col(label) / F.col(trials) if trials else F.col(label)
    losses = {}
    for reg in grid:
        model = fit_cells(cells.where(part != 0), effects, label, family, reg=reg, **fit)
        scored = predict_grid(model, cells.where(part == 0), effects)
        losses[reg] = scored.agg(F.avg(F.col("n_rows") * F.pow(y - F.col("estimate"), 2)).alias("l")).first()["l"]
    return min(losses, key=lambda r: float("inf") if losses[r] is None else losses[r])


def predict_grid(model: CellModel, grid: DataFrame, effects: Sequence[str], out: str = "estimate") -> DataFrame:
    """Expected response on a grid, using the chosen effects only.

    A level the fit has not seen and an effect that is left out both add nothing.  The
    lookups hold model coefficients, at most 4096 in all.
    """
    scored, terms = grid, []
    for i, effect in enumerate(effects):
        values = model.effects.where(F.col("effect") == effect).select(
            F.col("level").alias(f"__l{i}"), F.col("value").alias(f"__e{i}")
        )
        scored = scored.join(F.broadcast(values), F.col(effect).cast("string") == F.col(f"__l{i}"), "left").drop(f"__l{i}")
        terms.append(F.coalesce(F.col(f"__e{i}"), F.lit(0.0)))
    eta = reduce(lambda x, y: x + y, terms, F.lit(model.intercept))
    mean = (1 - F.lit(model.inflation)) * _mean_of(model.family, eta)
    return scored.withColumn(out, mean).drop(*[f"__e{i}" for i in range(len(effects))])


def fit_joint(cells: DataFrame, group: str, split: str, label: str, trials: str, shared: Sequence[str], reg: float = 0.01):
    """One activity model for both boat types with effects of ``group`` by ``split``.

    Returns the model, the two effects per level of ``group`` side by side, and their correlation.
    """
    crossed = cells.withColumn("__cross", F.concat_ws("|", F.col(group), F.col(split)))
    model = fit_cells(crossed, ["__cross", split, *shared], label, "binomial", trials=trials, reg=reg, zero_inflated=True)
    pattern = r"^(.*)\|([^|]*)$"
    effects = (
        model.effects.where(F.col("effect") == "__cross")
        .select(
            F.regexp_extract("level", pattern, 1).alias(group),
            F.regexp_extract("level", pattern, 2).alias("__split"),
            "value",
        )
        .groupBy(group)
        .agg(
            F.max(F.when(F.col("__split") == "1", F.col("value"))).alias("effect_1"),
            F.max(F.when(F.col("__split") == "2", F.col("value"))).alias("effect_2"),
        )
    )
    return model, effects, effects.agg(F.corr("effect_1", "effect_2").alias("correlation"))


def fit_membership_huber(
    trips: DataFrame, codes: Sequence[str], weights: Sequence[str], log_price: str, reg: float = 0.01
) -> DataFrame:
    """Robust log price per species from weighted memberships (E4b): (species_code, effect, log_price).

    The feature vector of a trip holds its normalised weight per species.  The species list
    is the coefficient list, so it is known to the driver.
    """
    memberships = F.array(*[F.struct(F.col(c).alias("c"), F.col(w).alias("w")) for c, w in zip(codes, weights)])
    used = F.filter(memberships, lambda m: m["w"] > 0)
    rows = trips.where(F.col(log_price).isNotNull()).select(used.alias("m"), F.col(log_price).alias("__y"))
    rows = rows.withColumn("__total", F.aggregate("m", F.lit(0.0), lambda acc, m: acc + m["w"])).where("__total > 0")
    levels = [r["c"] for r in rows.select(F.explode("m.c").alias("c")).distinct().orderBy("c").collect()]
    share = lambda code: F.aggregate(
        F.filter("m", lambda m: m["c"] == code), F.lit(0.0), lambda acc, m: acc + m["w"]
    )
    vector = F.transform(F.array(*[F.lit(lv) for lv in levels]), lambda code: share(code) / F.col("__total"))
    # Trips with equal memberships and price count once, with their number as weight.
    table = cut_lineage(
        rows.select(vector.alias("f"), "__y").groupBy("f", "__y").agg(F.count(F.lit(1)).cast("double").alias("__w"))
    ).select(array_to_vector("f").alias("features"), "__y", "__w")
    fit = LinearRegression(
        loss="huber", labelCol="__y", weightCol="__w", regParam=reg, elasticNetParam=0.0, standardization=False, maxIter=200
    ).fit(table)
    values = [(lv, float(c), float(c) + float(fit.intercept)) for lv, c in zip(levels, fit.coefficients.toArray())]
    return trips.sparkSession.createDataFrame(values, "species_code string, effect double, log_price double")
