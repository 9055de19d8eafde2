"""Closed-form partially pooled estimates.

Each estimator takes one row per cell with sufficient statistics and returns that table
with an ``estimate`` column.  ``by`` separates independent fits (boat type, draw); the
hyper-parameters of a fit come from one more aggregation of the cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoalcast.operators.draws import drawn_sums
from shoalcast.session import cut_lineage

# Bounds of the intraclass correlation, away from 0 and 1.
RHO_MIN = 1e-6
RHO_MAX = 1 - 1e-6


def _between_within(ss_between: Column, ss_within: Column) -> tuple[Column, Column, Column]:
    """Mean squares between and within cells, and the effective cell size."""
    n, n2, j = F.col("__n"), F.col("__n2"), F.col("__j")
    return (
        F.try_divide(ss_between, j - 1),
        F.try_divide(ss_within, n - j),
        F.try_divide(n - F.try_divide(n2, n), j - 1),
    )


def _with_fit(cells: DataFrame, hyper: DataFrame, by: Sequence[str]) -> DataFrame:
    """Cells with the hyper-parameters of their fit; without ``by`` there is one fit, a scalar subquery."""
    if by:
        return cells.join(hyper, list(by), "left")
    names = hyper.columns
    return cells.withColumn("__fit", hyper.select(F.struct(*names)).scalar()).select("*", *[F.col(f"__fit.{n}").alias(n) for n in names]).drop("__fit")


def cell_moments(df: DataFrame, keys: Sequence[str], y: str, weight: str | None = None) -> DataFrame:
    """Rows to cells: size ``n``, mean ``mean`` and squares within ``ss`` of a response."""
    w = F.col(weight) if weight else F.lit(1.0)
    value = F.col(y)
    sums = (
        df.where(value.isNotNull())
        .groupBy(*keys)
        .agg(F.sum(w).alias("n"), F.sum(w * value).alias("__sy"), F.sum(w * value * value).alias("__syy"))
    )
    return _cells(sums, keys)


def summed_columns(y: str) -> dict[str, Column]:
    """What a response is rolled up from when it is summed with weights: its size, itself and its square."""
    value = F.col(y)
    return {f"n_{y}": F.when(value.isNotNull(), F.lit(1.0)), f"sum_{y}": value, f"sq_{y}": value * value}


def rolled_up_moments(sums: DataFrame, keys: Sequence[str], y: str) -> DataFrame:
    """The cells of ``cell_moments`` by fewer keys, from the weighted sums of ``summed_columns``."""
    totals = sums.groupBy(*keys).agg(
        F.sum(f"n_{y}").alias("n"), F.sum(f"sum_{y}").alias("__sy"), F.sum(f"sq_{y}").alias("__syy")
    )
    return _cells(totals.where(F.col("n").isNotNull()), keys)


def _cells(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    return sums.select(
        *keys,
        "n",
        F.try_divide("__sy", "n").alias("mean"),
        F.greatest(F.col("__syy") - F.try_divide(F.col("__sy") * F.col("__sy"), F.col("n")), F.lit(0.0)).alias("ss"),
    )


def membership_moments(df: DataFrame, keys: Sequence[str], y: str, share: str, weight: str | None = None) -> DataFrame:
    """Cells of weighted memberships: the size is the effective one, (sum w)^2 / sum w^2."""
    times = F.col(weight) if weight else F.lit(1.0)
    sums = df.where(F.col(y).isNotNull() & (F.col(share) > 0)).groupBy(*keys)
    return _membership_cells(sums.agg(*[F.sum(times * c).alias(n) for n, c in _membership_columns(y, share).items()]), keys)


def drawn_memberships(df: DataFrame, unit: str, keys: Sequence[str], y: str, share: str, draws: int, hash_name: str = "xxhash64") -> DataFrame:
    """``membership_moments`` by ``keys`` and draw, units resampled; cells are taken to be few."""
    used = df.where(F.col(y).isNotNull() & (F.col(share) > 0))
    return _membership_cells(drawn_sums(used, unit, keys, draws, _membership_columns(y, share), hash_name, dealt=False), [*keys, "draw"])


def _membership_columns(y: str, share: str) -> dict[str, Column]:
    w, value = F.col(share), F.col(y)
    return {"__w": w, "__ww": w * w, "__wy": w * value, "__wyy": w * value * value}


def _membership_cells(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    size = F.col("__w") * F.col("__w") / F.col("__ww")
    mean = F.col("__wy") / F.col("__w")
    return sums.select(
        *keys,
        size.alias("n"),
        mean.alias("mean"),
        (size * F.greatest(F.col("__wyy") / F.col("__w") - mean * mean, F.lit(0.0))).alias("ss"),
    )


def overall_mean(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """Hyper-parameters of the cell means, one row per fit."""
    sums = (
        cells.where(F.col("n") > 0)
        .groupBy(*by)
        .agg(
            F.sum("n").alias("__n"),
            F.sum(F.col("n") * F.col("n")).alias("__n2"),
            F.count(F.lit(1)).alias("__j"),
            F.sum(F.col("n") * F.col("mean")).alias("__s"),
            F.sum(F.col("n") * F.col("mean") * F.col("mean")).alias("__q"),
            F.sum("ss").alias("__ss"),
        )
    )
    between = F.col("__q") - F.try_divide(F.col("__s") * F.col("__s"), F.col("__n"))
    msb, msw, n0 = _between_within(between, F.col("__ss"))
    return sums.select(
        *by,
        F.try_divide("__s", "__n").alias("overall"),
        msw.alias("var_within"),
        F.greatest(F.try_divide(msb - msw, n0), F.lit(0.0)).alias("var_between"),
    )


def shrunk_means(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """One-way random-effects estimate of every cell mean."""
    joined = _with_fit(cells, overall_mean(cells, by), by)
    pull = F.try_divide(
        F.col("var_between"), F.col("var_between") + F.try_divide(F.col("var_within"), F.col("n"))
    )
    estimate = F.col("overall") + F.coalesce(pull, F.lit(0.0)) * (F.col("mean") - F.col("overall"))
    return joined.withColumn("estimate", F.coalesce(estimate, F.col("overall"))).drop("var_within", "var_between")


def overall_rate(cells: DataFrame, by: Sequence[str], n: str = "n_days", k: str = "n_trips") -> DataFrame:
    """Hyper-parameters of the cell rates, one row per fit."""
    size, hits = F.col(n).cast("double"), F.col(k).cast("double")
    sums = (
        cells.where(size > 0)
        .groupBy(*by)
        .agg(
            F.sum(size).alias("__n"),
            F.sum(size * size).alias("__n2"),
            F.count(F.lit(1)).alias("__j"),
            F.sum(hits).alias("__k"),
            F.sum(hits * hits / size).alias("__q"),
        )
    )
    between = F.col("__q") - F.try_divide(F.col("__k") * F.col("__k"), F.col("__n"))
    msb, msw, n0 = _between_within(between, F.col("__k") - F.col("__q"))
    raw_rho = F.try_divide(msb - msw, msb + (n0 - 1) * msw)
    rho = F.coalesce(F.least(F.greatest(raw_rho, F.lit(RHO_MIN)), F.lit(RHO_MAX)), F.lit(RHO_MIN))
    rho = F.when(raw_rho.isNull(), F.lit(RHO_MIN)).otherwise(rho)
    return sums.select(*by, F.try_divide("__k", "__n").alias("overall"), ((1 - rho) / rho).alias("prior_size"))


def shrunk_rates(cells: DataFrame, by: Sequence[str], n: str = "n_days", k: str = "n_trips") -> DataFrame:
    """Beta-binomial estimate of every cell rate."""
    joined = _with_fit(cells, overall_rate(cells, by, n, k), by)
    estimate = (F.col("overall") * F.col("prior_size") + F.col(k)) / (F.col("prior_size") + F.col(n))
    return joined.withColumn("estimate", estimate).drop("prior_size")


def parent_shares(counts: DataFrame, parent: Sequence[str], level: str, n: str) -> DataFrame:
    """Share of each level in its parent: what an unseen cell gets."""
    by_level = counts.groupBy(*parent, level).agg(F.sum(n).alias("__nl"))
    by_parent = by_level.groupBy(*parent).agg(F.sum("__nl").alias("__np"))
    return by_level.join(by_parent, list(parent)).select(*parent, level, (F.col("__nl") / F.col("__np")).alias("prior"))


def shrunk_shares(
    counts: DataFrame, cell: Sequence[str], parent: Sequence[str], level: str, n: str, kappa: float = 10.0
) -> DataFrame:
    """Dirichlet estimate of the share of each level in a cell.

    The prior of a cell is the share of the level in its parent; every level seen in the
    parent gets a row in each of its cells, so shares add up to one.
    """
    priors = parent_shares(counts, parent, level, n).withColumnRenamed("prior", "__prior")
    sizes = counts.groupBy(*cell).agg(F.sum(n).alias("__size"))
    observed = counts.groupBy(*cell, level).agg(F.sum(n).alias("__n"))
    grid = sizes.join(priors, list(parent)).join(observed, [*cell, level], "left")
    share = (F.coalesce(F.col("__n"), F.lit(0)) + kappa * F.col("__prior")) / (F.col("__size") + kappa)
    return grid.select(
        *cell, level, F.coalesce(F.col("__n"), F.lit(0)).alias(n), F.col("__size").alias("size"), share.alias("estimate")
    )


def logit_cells(cells: DataFrame, group: str, split: str, levels: Sequence[str], n: str, k: str) -> DataFrame:
    """Rates of each group in each of two classes as empirical logits ``y_1``, ``y_2`` with sampling variances ``s_1``, ``s_2``."""
    sums = []
    for i, level in enumerate(levels, start=1):
        mine = F.col(split) == level
        sums += [F.sum(F.when(mine, F.col(n))).cast("double").alias(f"n_{i}"), F.sum(F.when(mine, F.col(k))).cast("double").alias(f"k_{i}")]
    wide = cells.groupBy(group).agg(*sums)
    out = [group]
    for i in range(1, len(levels) + 1):
        hits, misses = F.col(f"k_{i}") + 0.5, F.col(f"n_{i}") - F.col(f"k_{i}") + 0.5
        out += [F.ln(hits / misses).alias(f"y_{i}"), (1 / hits + 1 / misses).alias(f"s_{i}")]
    return wide.select(*out)


def shrunk_pairs(logits: DataFrame, group: str, least: float = 1e-6, most_correlation: float = 0.99) -> DataFrame:
    """Correlated effects of a group in two classes (E3): ``effect_1``, ``effect_2`` and the covariance they were shrunk by.

    Effects are bivariate normal around the class means.  Their variances are the variances of the logits less the mean sampling
    variance, and their covariance is that of the logits, as sampling errors of the classes are independent.  A group
    seen in one class borrows from the correlation in the other.
    """
    moments = logits.agg(
        *[F.avg(f"y_{i}").alias(f"m_{i}") for i in (1, 2)],
        *[F.greatest(F.var_samp(f"y_{i}") - F.avg(f"s_{i}"), F.lit(least)).alias(f"t_{i}") for i in (1, 2)],
        F.covar_samp("y_1", "y_2").alias("raw"),
    )
    limit = F.lit(most_correlation) * F.sqrt(F.col("t_1") * F.col("t_2"))
    held = moments.withColumn("c", F.coalesce(F.greatest(F.least("raw", limit), -limit), F.lit(0.0)))
    one_row = held.select(F.struct("m_1", "m_2", "t_1", "t_2", "c").alias("h")).scalar()
    rows = logits.withColumn("h", one_row).select("*", "h.*").drop("h")
    c, t1, t2 = F.col("c"), F.col("t_1"), F.col("t_2")
    a, b = t1 + F.col("s_1"), t2 + F.col("s_2")
    d1, d2 = F.col("y_1") - F.col("m_1"), F.col("y_2") - F.col("m_2")
    size = a * b - c * c
    u1, u2 = (b * d1 - c * d2) / size, (a * d2 - c * d1) / size
    alone_1, alone_2 = d2.isNull() & d1.isNotNull(), d1.isNull() & d2.isNotNull()
    effect_1 = F.when(alone_1, t1 * d1 / a).when(alone_2, c * d2 / b).otherwise(F.coalesce(t1 * u1 + c * u2, F.lit(0.0)))
    effect_2 = F.when(alone_1, c * d1 / a).when(alone_2, t2 * d2 / b).otherwise(F.coalesce(c * u1 + t2 * u2, F.lit(0.0)))
    return rows.select(
        group, effect_1.alias("effect_1"), effect_2.alias("effect_2"), t1.alias("var_1"), t2.alias("var_2"), c.alias("covariance"), (c / F.sqrt(t1 * t2)).alias("correlation")
    )


def concentration(cells: DataFrame) -> Column:
    """Kappa of a level by moments, from cells (x, n, prior, g): the Pearson statistic of a Dirichlet-multinomial cell
    is on average (g - 1)(1 + (n - 1) rho), and rho is 1 / (1 + kappa)."""
    per_cell = cells.groupBy("cell").agg(
        F.sum(F.pow(F.col("x") - F.col("n") * F.col("prior"), 2) / (F.col("n") * F.col("prior"))).alias("chi"), F.max("n").alias("n"), F.max("g").alias("g")
    )
    rho = F.try_divide(F.sum(F.col("chi") - (F.col("g") - 1)), F.sum((F.col("g") - 1) * (F.col("n") - 1)))
    held = F.coalesce(F.least(F.greatest(rho, F.lit(RHO_MIN)), F.lit(RHO_MAX)), F.lit(RHO_MIN))
    return per_cell.agg(((1 - held) / held).alias("kappa")).scalar()


def hierarchical_shares(counts: DataFrame, levels: Sequence[str], category: str, n: str) -> DataFrame:
    """Shares of categories with one random effect a level (E7): the cells of each level are Dirichlet around their parent.

    ``levels`` are columns from the coarsest on; a cell of the k-th level is keyed by the first k.  Each level has a
    concentration of its own, found from the data.  Returns the last level's cells: keys, category, n, size, estimate and
    ``kappa`` of that level.
    """
    keys: list[str] = []
    shares = counts.groupBy(category).agg(F.sum(n).cast("double").alias("x"))
    total = counts.agg(F.sum(n).cast("double").alias("t")).scalar()
    parent = shares.select(category, (F.col("x") / total).alias("estimate")).where("estimate > 0")
    for level in levels:
        above, keys = list(keys), [*keys, level]
        observed = counts.groupBy(*keys, category).agg(F.sum(n).cast("double").alias("x"))
        sizes = observed.groupBy(*keys).agg(F.sum("x").alias("n")).where("n > 0")
        known = parent.select(*above, category, F.col("estimate").alias("prior"))
        # A cell of the first level has the same parent, a handful of categories.
        packed = known.groupBy(*above).agg(F.collect_list(F.struct(category, "prior")).alias("p"), F.count(F.lit(1)).alias("g"))
        if above:
            grid = sizes.join(packed, above)
        else:
            whole = packed.select(F.struct("p", "g").alias("w")).scalar()
            grid = sizes.withColumn("w", whole).select("*", "w.*").drop("w")
        grid = grid.select(*keys, "n", "g", F.explode("p").alias("p")).select(*keys, "n", "g", "p.*")
        cells = grid.join(observed, [*keys, category], "left").withColumn("x", F.coalesce("x", F.lit(0.0)))
        kappa = concentration(cells.withColumn("cell", F.struct(*keys)))
        cells = cells.withColumn("kappa", kappa)
        parent = cells.select(*keys, category, "x", "n", ((F.col("x") + F.col("kappa") * F.col("prior")) / (F.col("n") + F.col("kappa"))).alias("estimate"), "kappa")
        parent = cut_lineage(parent)
    return parent.select(*keys, category, F.col("x").cast("long").alias(n), F.col("n").cast("long").alias("size"), "estimate", "kappa")
