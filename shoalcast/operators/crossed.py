"""Crossed random effects on cell tables, and their draws.

A binomial response (``k`` of ``n``) has one effect for each level of several crossed factors, for instance
place, period, place x period, season and boat:  logit p = intercept + sum of effects, each effect normal
around 0 with the variance of its factor.  Levels live in tables, never in a feature vector, so boats and periods may
be as many as the data has.

A round of the fit reads the cells once: scores and curvatures by level, and curvatures by pairs of levels that occur
together.  The penalised Newton step is then solved by conjugate gradients on these sparse tables, one join and
one aggregate an iteration.  A factor's variance is the mean of effect^2 + conditional variance of its levels (an
EM step).  Structural zeros of a zero-inflated response are weighted out by their chance.  ``by`` separates
independent fits (boat types).  The numbers of rounds and iterations are fixed, so the result is a plain function of the data.

Draws are a one-step bootstrap: units (boats) are resampled with Poisson weights, the scores at the fit are
summed by level and draw in one aggregate, and each draw takes one Newton step with the curvature of the fit.  A unit
is resampled with its own effect and its penalty, so a factor of the unit itself has no score to move it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from shoalcast.functions.numeric import inverse_logit
from shoalcast.operators.draws import drawn_sums
from shoalcast.operators.joins import fits_broadcast
from shoalcast.session import cut_lineage, drop_written

INTERCEPT = "intercept"
# Longest step of an effect, and the least variance of a factor.
STEP = 2.0
LEAST_VARIANCE = 1e-4
# Levels beside the units' own that a draw may hold as arrays, as many as coefficients of a GLM; more are kept in tables.
MOST_LEVELS = 4096


@dataclass
class CrossedFit:
    """``effects`` (by, factor, level, value, variance, weight), ``shares`` (by, share of structural zeros) and
    ``precisions`` (by, factor, precision)."""

    by: str
    factors: dict[str, list[str]]
    effects: DataFrame
    shares: DataFrame
    precisions: DataFrame


def level_of(columns: Sequence[str]) -> Column:
    """A level's name: the values of its columns; none of a factor without columns."""
    return F.concat_ws("|", *[F.col(c).cast("string") for c in columns]) if columns else F.lit("")


def with_levels(df: DataFrame, factors: dict[str, list[str]]) -> DataFrame:
    return df.withColumns({f"level_{f}": level_of(columns) for f, columns in factors.items()})


def binomial_cells(df: DataFrame, by: str, factors: dict[str, list[str]], n: str, k: str) -> DataFrame:
    """Rows with equal levels and response as one, with their number ``rows``."""
    columns = sorted({c for names in factors.values() for c in names})
    used = df.dropna(subset=[by, *columns, n, k]).where(F.col(n) > 0)
    keys = dict.fromkeys([by, *columns])
    cells = used.groupBy(*keys, F.col(n).cast("double").alias("n"), F.col(k).cast("double").alias("k"))
    return with_levels(cells.agg(F.count(F.lit(1)).cast("double").alias("rows")), factors)


def with_eta(cells: DataFrame, by: str, factors: Sequence[str], effects: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``eta``, the sum of the effects of a row's levels; a level without one adds nothing."""
    terms = []
    for factor in factors:
        mine = effects.where(F.col("factor") == factor)
        cells = cells.join(
            mine.select(by, *keys, F.col("level").alias(f"level_{factor}"), F.col("value").alias(f"value_{factor}")), [by, *keys, f"level_{factor}"], "left"
        )
        terms.append(F.coalesce(f"value_{factor}", F.lit(0.0)))
    return cells.withColumn("eta", reduce(lambda a, b: a + b, terms)).drop(*[f"value_{f}" for f in factors])


def scored(cells: DataFrame, by: str, factors: Sequence[str], effects: DataFrame, shares: DataFrame) -> DataFrame:
    """``chance`` (of a structural zero), ``w`` (curvature) and ``r`` (score) of each cell at the current effects."""
    rows = with_eta(cells, by, factors, effects).join(shares, by).withColumn("p", inverse_logit(F.col("eta")))
    zero = F.col("share") / (F.col("share") + (1 - F.col("share")) * F.pow(1 - F.col("p"), F.col("n")))
    rows = rows.withColumn("chance", F.when((F.col("k") == 0) & (F.col("share") > 0), zero).otherwise(0.0))
    real = F.col("rows") * (1 - F.col("chance"))
    return rows.withColumns({"w": real * F.col("n") * F.col("p") * (1 - F.col("p")), "r": real * (F.col("k") - F.col("n") * F.col("p"))})


def precision_of(effects: DataFrame, by: str) -> DataFrame:
    """(by, factor, precision) of each factor's normal distribution; the intercept has none."""
    spread = F.greatest(F.avg(F.col("value") * F.col("value") + F.col("variance")), F.lit(LEAST_VARIANCE))
    free = F.when(F.col("factor") == INTERCEPT, F.lit(0.0)).otherwise(1 / F.col("spread"))
    return effects.groupBy(by, "factor").agg(spread.alias("spread")).select(by, "factor", free.alias("precision"))


def each_level(factors: Sequence[str]) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(f).alias("factor"), F.col(f"level_{f}").alias("level")) for f in factors]))


def level_links(rows: DataFrame, by: str, factors: Sequence[str]) -> DataFrame:
    """Curvatures of the levels that occur together: (by, factor, level, other, other_level, weight), one way."""
    pairs = [
        F.struct(F.lit(a).alias("factor"), F.col(f"level_{a}").alias("level"), F.lit(b).alias("other"), F.col(f"level_{b}").alias("other_level"))
        for i, a in enumerate(factors)
        for b in factors[i + 1 :]
    ]
    pair = rows.select(by, "w", F.explode(F.array(*pairs)).alias("pair")).select(by, "w", "pair.*")
    return pair.groupBy(by, "factor", "level", "other", "other_level").agg(F.sum("w").alias("weight"))


def both_ways(links: DataFrame) -> DataFrame:
    """Written links and their mirror images: the curvature is symmetric, so half of it is summed, shuffled and written."""
    names = {"factor": "other", "level": "other_level", "other": "factor", "other_level": "level"}
    return links.unionByName(links.select(*[F.col(c).alias(names.get(c, c)) for c in links.columns]))


def solve(links: DataFrame, system: DataFrame, by: str, keys: Sequence[str], iterations: int) -> DataFrame:
    """``x`` of the written table ``system`` (keys, factor, level, size, score): conjugate gradients, scaled by the
    diagonal ``size``, for each of the systems that ``keys`` (``by`` among them) separate."""
    level = [*keys, "factor", "level"]
    state = system.select(*level, "size", F.lit(0.0).alias("x"), F.col("score").alias("r"), (F.col("score") / F.col("size")).alias("p"))
    x, r, p, q, size = (F.col(c) for c in ("x", "r", "p", "q", "size"))
    held = None
    for _ in range(iterations):
        ahead = state.select(*keys, F.col("factor").alias("other"), F.col("level").alias("other_level"), "p")
        pulled = links.join(ahead, [by, "other", "other_level"]).groupBy(*level).agg(F.sum(F.col("weight") * p).alias("pull"))
        table = cut_lineage(state.join(pulled, level, "left").withColumn("q", size * p + F.coalesce("pull", F.lit(0.0))).drop("pull"))
        if held is not None:
            drop_written(held)
        held = table
        # The next residual's size follows from sums of this one, so one aggregate gives both factors.
        sums = table.groupBy(*keys).agg(
            F.sum(r * r / size).alias("rr"), F.sum(p * q).alias("pq"), F.sum(r * q / size).alias("rq"), F.sum(q * q / size).alias("qq")
        )
        ahead = F.coalesce(F.try_divide("rr", "pq"), F.lit(0.0))
        left = F.greatest(F.col("rr") - 2 * F.col("ahead") * F.col("rq") + F.col("ahead") * F.col("ahead") * F.col("qq"), F.lit(0.0))
        sums = sums.withColumn("ahead", ahead).withColumn("turn", F.coalesce(F.try_divide(left, F.col("rr")), F.lit(0.0)))
        rest = r - F.col("ahead") * q
        state = table.join(sums.select(*keys, "ahead", "turn"), [*keys]).select(
            *level, "size", (x + F.col("ahead") * p).alias("x"), rest.alias("r"), (rest / size + F.col("turn") * p).alias("p")
        )
    out = cut_lineage(state.select(*level, "x"))
    if held is not None:
        drop_written(held)
    return out


def start(cells: DataFrame, by: str, factors: Sequence[str], zero_inflated: bool) -> tuple[DataFrame, DataFrame]:
    """The intercept of the pooled rate, no effects, variances of 1, and half of the zeros structural."""
    mean = F.sum(F.col("k") * F.col("rows")) / F.sum(F.col("n") * F.col("rows"))
    zeros = F.sum(F.when(F.col("k") == 0, F.col("rows")).otherwise(0.0)) / F.sum("rows")
    pooled = cells.groupBy(by).agg(mean.alias("m"), zeros.alias("zeros"))
    kept = F.greatest(F.least(F.col("m"), F.lit(1 - 1e-6)), F.lit(1e-6))
    levels = cells.select(by, each_level(factors).alias("l")).select(by, "l.*").distinct()
    value = F.when(F.col("factor") == INTERCEPT, F.ln(kept / (1 - kept))).otherwise(0.0)
    effects = levels.join(pooled, by).select(by, "factor", "level", value.alias("value"), F.lit(1.0).alias("variance"), F.lit(0.0).alias("weight"))
    return cut_lineage(effects), cut_lineage(pooled.select(by, (F.col("zeros") * (0.5 if zero_inflated else 0.0)).alias("share")))


def fit_crossed(
    df: DataFrame,
    by: str,
    factors: dict[str, list[str]],
    n: str,
    k: str,
    rounds: int = 4,
    iterations: int = 4,
    zero_inflated: bool = True,
    fixed: CrossedFit | None = None,
) -> CrossedFit:
    """Fit the effects of ``factors`` ({name: columns}) on ``k`` of ``n``, one fit for each value of ``by``.

    With ``fixed`` the fit starts from another one and keeps its variances.
    """
    factors = {INTERCEPT: [], **factors}
    level = [by, "factor", "level"]
    cells = cut_lineage(binomial_cells(df, by, factors, n, k))
    effects, shares = (fixed.effects, fixed.shares) if fixed else start(cells, by, list(factors), zero_inflated)
    for _ in range(rounds):
        before = (effects, shares)
        precisions = fixed.precisions if fixed else precision_of(effects, by)
        rows = cut_lineage(scored(cells, by, list(factors), effects, shares).drop("eta", "p", "n", "k"))
        sums = rows.select(by, "w", "r", each_level(factors).alias("l")).groupBy(by, "l.factor", "l.level").agg(F.sum("w").alias("weight"), F.sum("r").alias("r"))
        joined = sums.join(effects.select(*level, "value"), level, "left").na.fill(0.0, ["value"]).join(precisions, [by, "factor"])
        system = cut_lineage(
            joined.select(
                *level, "value", "weight", (F.col("weight") + F.col("precision")).alias("size"), (F.col("r") - F.col("precision") * F.col("value")).alias("score")
            )
        )
        links = cut_lineage(level_links(rows, by, list(factors)))
        steps = solve(both_ways(links), system, by, [by], iterations)
        moved = F.col("value") + F.greatest(F.least(F.col("x"), F.lit(STEP)), F.lit(-STEP))
        effects = cut_lineage(system.join(steps, level).select(*level, moved.alias("value"), (1 / F.col("size")).alias("variance"), "weight"))
        shares = cut_lineage(rows.groupBy(by).agg((F.sum(F.col("chance") * F.col("rows")) / F.sum("rows")).alias("share")))
        drop_written(rows, links, system, steps)
        if before[0] is not (fixed.effects if fixed else None):
            drop_written(*before)
    drop_written(cells)
    return CrossedFit(by, factors, effects, shares, fixed.precisions if fixed else precision_of(effects, by))


def predict_crossed(fit: CrossedFit, grid: DataFrame, factors: Sequence[str], out: str = "estimate", draws: DataFrame | None = None) -> DataFrame:
    """Expected rate on a grid by the chosen factors and the intercept (E9); levels never seen add nothing.

    With ``draws`` (of ``draw_effects``) one row for each grid row and draw.
    """
    used = {f: fit.factors[f] for f in (INTERCEPT, *factors)}
    rows = with_levels(grid, used).join(fit.shares, fit.by)
    if draws is None:
        rows = with_eta(rows, fit.by, list(used), fit.effects)
    else:
        numbers = draws.where(F.col("factor") == INTERCEPT).select(fit.by, "draw")
        rows = with_eta(rows.join(numbers, fit.by), fit.by, list(used), draws, ["draw"])
    estimate = (1 - F.col("share")) * inverse_logit(F.col("eta"))
    return rows.withColumn(out, estimate).drop("eta", "share", *[f"level_{f}" for f in used])


def draw_effects(
    fit: CrossedFit, df: DataFrame, n: str, k: str, unit: str, draws: int, iterations: int = 8, hash_name: str = "xxhash64"
) -> DataFrame:
    """Effects by draw (by, factor, level, draw, value): one Newton step of each bootstrap resample of ``unit``.

    Levels of the unit itself have no score.  Where the others are few, as many as coefficients of a model, the unit's
    are worked out from them wherever they are met (``UnitSolver``), so no table of units by draws is made.
    """
    by, factors = fit.by, list(fit.factors)
    level = [by, "factor", "level"]
    rows = with_levels(df.dropna(subset=[by, unit, n, k]).where(F.col(n) > 0), fit.factors)
    rows = rows.select(by, F.col(unit).cast("string").alias("unit"), F.col(n).cast("double").alias("n"), F.col(k).cast("double").alias("k"), *[f"level_{f}" for f in factors])
    rows = scored(rows.withColumn("rows", F.lit(1.0)), by, factors, fit.effects, fit.shares)
    rows = cut_lineage(rows.select(by, "unit", "w", "r", *[f"level_{f}" for f in factors]))
    own = [f for f, columns in fit.factors.items() if columns == [unit]]
    others = [f for f in factors if f not in own]
    # Scores by unit first: a unit has the same weight in all its rows.
    by_unit = rows.select(by, "unit", "w", "r", each_level(others).alias("l")).groupBy(by, "unit", "l.factor", "l.level").agg(F.sum("r").alias("r"), F.sum("w").alias("w"))
    by_unit = cut_lineage(by_unit)
    drawn = drawn_sums(by_unit, "unit", level, draws, {"drawn": F.col("r")}, hash_name)
    base = by_unit.groupBy(*level).agg(F.sum("r").alias("base"))
    every = base.select("*", F.explode(F.sequence(F.lit(1), F.lit(draws))).alias("draw")).join(drawn, [*level, "draw"], "left")
    scores = every.select(*level, "draw", (F.coalesce("drawn", F.lit(0.0)) - F.col("base")).alias("score"))
    sizes = fit.effects.join(fit.precisions, [by, "factor"]).select(*level, "value", (F.col("weight") + F.col("precision")).alias("size"))
    system = cut_lineage(scores.join(sizes, level))
    few = len(own) == 1 and fits_broadcast(system.where(F.col("draw") == 1), MOST_LEVELS)
    if few:
        solver = UnitSolver(by, own[0], system, cut_lineage(level_links(rows, by, others)), by_unit, sizes, draws)
        drop_written(rows, by_unit)
        return solver.solved(iterations)
    if own:
        still = rows.select(by, each_level(own).alias("l")).select(by, "l.*").distinct()
        still = still.select("*", F.explode(F.sequence(F.lit(1), F.lit(draws))).alias("draw"), F.lit(0.0).alias("score"))
        system = cut_lineage(system.unionByName(still.join(sizes, level)))
    links = cut_lineage(level_links(rows, by, factors))
    steps = solve(both_ways(links), system, by, [by, "draw"], iterations)
    drop_written(rows, by_unit, links)
    return system.join(steps, [*level, "draw"]).select(*level, "draw", (F.col("value") + F.col("x")).alias("value"))


class UnitSolver:
    """The conjugate gradients of ``solve`` for all draws, with the levels of the units left out of the tables.

    A unit's levels start at 0 and are linked to other levels alone, so after any number of iterations their state
    follows from the other levels' directions so far.  Each iteration is one job over the units (their links, one row
    each): it runs a unit's iterations again for all draws at once and adds up what the unit gives the other levels and
    the sums.  The other levels, ``MOST_LEVELS`` at most, are arrays of levels x draws that go out with the job.
    """

    def __init__(self, by: str, own: str, system: DataFrame, links: DataFrame, by_unit: DataFrame, sizes: DataFrame, draws: int):
        self.by, self.own, self.draws, self.spark = by, own, draws, system.sparkSession
        level = [by, "factor", "level"]
        found = system.where(F.col("draw") == 1).select(*level, "size", "value").orderBy(*level).toArrow()
        names = [(r[by], r["factor"], r["level"]) for r in found.to_pylist()]
        self.levels, place = found.select(level), {name: i for i, name in enumerate(names)}
        self.size, self.value = (found.column(c).to_numpy() for c in ("size", "value"))
        groups = {b: i for i, b in enumerate(dict.fromkeys(b for b, _, _ in names))}
        self.group, self.groups = np.array([groups[b] for b, _, _ in names], np.int64), len(groups)
        self.score = np.zeros((len(names), draws))
        numbered = self.spark.createDataFrame([(*name, i) for name, i in place.items()], system.select(*level).schema.add("at", IntegerType()))
        scores = system.join(F.broadcast(numbered), level).select("at", "draw", "score").toArrow()
        self.score[scores.column("at").to_numpy(), scores.column("draw").to_numpy() - 1] = scores.column("score").to_numpy()
        ends = numbered.withColumnsRenamed({"factor": "other", "level": "other_level", "at": "to"})
        pairs = links.join(F.broadcast(numbered), level).join(F.broadcast(ends), [by, "other", "other_level"]).select("at", "to", "weight").toArrow()
        drop_written(links)
        self.links = [pairs.column(c).to_numpy() for c in ("at", "to", "weight")]
        linked = by_unit.join(F.broadcast(numbered), level).groupBy(by, "unit").agg(F.collect_list(F.struct("at", "w")).alias("l"))
        mine = sizes.where(F.col("factor") == own).select(by, F.col("level").alias("unit"), "value", "size")
        self.units = cut_lineage(linked.join(mine, [by, "unit"]).select(by, "unit", "value", "size", F.col("l.at").alias("at"), F.col("l.w").alias("w")))

    def solved(self, iterations: int) -> DataFrame:
        size, group = self.size[:, None], self.group
        x, r, p = np.zeros_like(self.score), self.score.copy(), self.score / size
        past, turns = [], []
        for _ in range(iterations):
            past.append(p)
            pull, sums = self._met(past, turns)
            q = size * p + pull
            for a, b in ((0, 1), (1, 0)):
                np.add.at(q, self.links[a], self.links[2][:, None] * p[self.links[b]])
            for total, terms in zip(sums, (r * r / size, p * q, r * q / size, q * q / size)):
                np.add.at(total, group, terms)
            rr, pq, rq, qq = sums
            ahead = np.divide(rr, pq, out=np.zeros_like(rr), where=pq != 0)
            left = np.maximum(rr - 2 * ahead * rq + ahead * ahead * qq, 0.0)
            turn = np.divide(left, rr, out=np.zeros_like(rr), where=rr != 0)
            turns.append((ahead, turn))
            x, r = x + ahead[group] * p, r - ahead[group] * q
            p = r / size + turn[group] * p
        return self._table(x).unionByName(self._units(past, turns))

    def _table(self, x: np.ndarray) -> DataFrame:
        count = len(x)
        moved = (self.value[:, None] + x).ravel()
        names = self.levels.take(pa.array(np.repeat(np.arange(count), self.draws)))
        numbers = pa.array(np.tile(np.arange(1, self.draws + 1, dtype=np.int32), count))
        return self.spark.createDataFrame(names.append_column("draw", numbers).append_column("value", pa.array(moved)))

    def _met(self, past: list[np.ndarray], turns: list) -> tuple[np.ndarray, list[np.ndarray]]:
        """What the units give each level, and their part of the four sums of each group and draw."""
        levels, groups, draws, group = len(self.size), self.groups, self.draws, self.group

        def run(batches):
            pull, sums = np.zeros((levels, draws)), np.zeros((4, groups, draws))
            for size, at, w, starts, _ in unit_chunks(batches):
                r, p, q, _ = unit_state(size, at, w, starts, group, past, turns)
                owner = np.repeat(np.arange(len(size)), np.diff(np.append(starts, len(at))))
                order = np.argsort(at, kind="stable")
                levels_met, first = np.unique(at[order], return_index=True)
                pull[levels_met] += np.add.reduceat(w[order, None] * p[owner[order]], first, axis=0)
                for total, terms in zip(sums, (r * r / size, p * q, r * q / size, q * q / size)):
                    np.add.at(total, group[at[starts]], terms)
            every = np.concatenate([pull, *sums])
            place, draw = np.nonzero(every)
            yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int32)), pa.array(draw.astype(np.int32)), pa.array(every[place, draw])], names=["place", "draw", "value"])

        met = self.units.mapInArrow(run, "place int, draw int, value double").groupBy("place", "draw").agg(F.sum("value").alias("value")).toArrow()
        every = np.zeros((levels + 4 * groups, draws))
        every[met.column("place").to_numpy(), met.column("draw").to_numpy()] = met.column("value").to_numpy()
        return every[:levels], [every[levels + i * groups : levels + (i + 1) * groups] for i in range(4)]

    def _units(self, past: list[np.ndarray], turns: list) -> DataFrame:
        """The units' own levels by draw, made where they are read."""
        draws, group, by = self.draws, self.group, self.by

        def run(batches):
            for size, at, w, starts, batch in unit_chunks(batches):
                x = unit_state(size, at, w, starts, group, past, turns)[3]
                rows = pa.array(np.repeat(np.arange(len(size)), draws))
                moved = (batch.column("value").to_numpy()[:, None] + x).ravel()
                numbers = pa.array(np.tile(np.arange(1, draws + 1, dtype=np.int32), len(size)))
                yield pa.RecordBatch.from_arrays([batch.column(by).take(rows), batch.column("unit").take(rows), numbers, pa.array(moved)], names=[by, "level", "draw", "value"])

        kind = self.units.schema[by].dataType.simpleString()
        made = self.units.mapInArrow(run, f"`{by}` {kind}, level string, draw int, value double")
        return made.select(by, F.lit(self.own).alias("factor"), "level", "draw", "value")


def unit_chunks(batches: Iterator[pa.RecordBatch], most: int = 500) -> Iterator[tuple]:
    """(size, at, w, starts, batch) of a few hundred units at a time: their levels and curvatures one after the other."""
    for whole in batches:
        for first in range(0, whole.num_rows, most):
            batch = whole.slice(first, most)
            at, w = (batch.column(c) for c in ("at", "w"))
            starts = np.append(0, np.cumsum(at.value_lengths().to_numpy(zero_copy_only=False)))[:-1]
            yield batch.column("size").to_numpy()[:, None], at.flatten().to_numpy(), w.flatten().to_numpy(), starts, batch


def unit_state(size: np.ndarray, at: np.ndarray, w: np.ndarray, starts: np.ndarray, group: np.ndarray, past: list, turns: list) -> tuple:
    """(r, p, q, x) of units x draws at the last of the directions ``past``, after the steps ``turns`` made so far."""
    mine = group[at[starts]]
    r = p = x = np.zeros((len(starts), past[0].shape[1]))
    q = r
    for i, ahead in enumerate(past):
        q = size * p + np.add.reduceat(w[:, None] * ahead[at], starts, axis=0)
        if i < len(turns):
            step, turn = turns[i][0][mine], turns[i][1][mine]
            x, r = x + step * p, r - step * q
            p = r / size + turn * p
    return r, p, q, x
