"""Wide/long reshaping, completion and lumping."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoalcast.operators.joins import BROADCAST_ROWS, _joined, lookup_join

# Fixed pattern of a repeated group's columns: group index (one character) and question.
GROUP_PATTERN = r"species_group_(.)_species_group_(.*)"

# Levels carried by one row while a grid is expanded.
LEVELS_PER_BLOCK = 1000


def group_columns(columns: Sequence[str], pattern: str = GROUP_PATTERN) -> dict[str, dict[str, str]]:
    """``{group: {question: column}}``; names that do not match are left out."""
    found: dict[str, dict[str, str]] = {}
    for name in columns:
        match = re.search(pattern, name)
        if match:
            found.setdefault(match.group(1), {})[match.group(2)] = name
    return found


def unpivot_group(df: DataFrame, ids: Sequence[str], pattern: str = GROUP_PATTERN) -> DataFrame:
    """Repeated group columns to (ids, record, question, value) rows."""
    groups = group_columns(df.columns, pattern)
    names = {c: (g, q) for g, qs in groups.items() for q, c in qs.items()}
    record = F.create_map(*[x for c, (g, _) in names.items() for x in (F.lit(c), F.lit(g))])
    question = F.create_map(*[x for c, (_, q) in names.items() for x in (F.lit(c), F.lit(q))])
    return df.unpivot(list(ids), list(names), "__name", "value").select(
        *ids, record[F.col("__name")].alias("record"), question[F.col("__name")].alias("question"), "value"
    )


def unpivot_columns(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot(list(ids), list(columns), name, value)


def pivot_counts(
    df: DataFrame, keys: Sequence[str], level: str, value: str, levels: Sequence[str], prefix: str = ""
) -> DataFrame:
    """One column per listed level, zero where a key lacks it."""
    cells = [
        F.coalesce(F.sum(F.when(F.col(level) == lv, F.col(value))), F.lit(0)).alias(f"{prefix}{lv}") for lv in levels
    ]
    return df.groupBy(*keys).agg(*cells)


def pivot_values(
    df: DataFrame, keys: Sequence[str], level: str, values: Sequence[str], levels: Sequence[str]
) -> DataFrame:
    """``<value>_<level>`` columns, NULL where a key lacks the level (P10)."""
    cells = [F.sum(F.when(F.col(level) == lv, F.col(v))).alias(f"{v}_{lv}") for v in values for lv in levels]
    return df.groupBy(*keys).agg(*cells)


def lump_top_n(df: DataFrame, level: str, n: int, other: str = "other", out: str | None = None) -> DataFrame:
    """Keep the ``n`` most frequent levels, call the rest ``other``; ties at the edge all stay."""
    counts = df.where(F.col(level).isNotNull()).groupBy(level).agg(F.count(F.lit(1)).alias("__n"))
    # The n-th largest count: at most n rows leave the top-n operator.
    edge = counts.orderBy(F.desc("__n")).limit(n).agg(F.min("__n").alias("e")).scalar()
    kept = counts.where(F.col("__n") >= edge).select(F.col(level).alias("__level"), F.lit(True).alias("__kept"))
    lumped = F.when(F.col("__kept"), F.col(level)).when(F.col(level).isNotNull(), F.lit(other))
    joined = lookup_join(df, kept, level, "__level")
    return joined.withColumn(out or level, lumped).drop("__kept")


def expand_levels(df: DataFrame, levels: DataFrame) -> DataFrame:
    """Every row of ``df`` with every row of the one-column table ``levels``.

    The levels are packed into blocks of about a thousand; rows meet blocks by an equality
    join on the block number, so neither side is ever gathered whole.
    """
    (name,) = levels.columns
    blocks = max(1, -(-levels.count() // LEVELS_PER_BLOCK))
    packed = levels.groupBy(F.pmod(F.xxhash64(name), F.lit(blocks)).cast("int").alias("__block")).agg(
        F.collect_list(F.struct(name)).alias("__levels")
    )
    if blocks * LEVELS_PER_BLOCK <= BROADCAST_ROWS:
        packed = F.broadcast(packed)
    return (
        df.withColumn("__block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        .join(packed, "__block")
        .withColumn("__level", F.explode("__levels"))
        .withColumn(name, F.col(f"__level.{name}"))
        .drop("__block", "__levels", "__level")
    )


def expand_array(df: DataFrame, name: str, values: Column | Sequence) -> DataFrame:
    """Every row with every element of a short literal list or array column."""
    array = values if isinstance(values, Column) else F.array(*[F.lit(v) for v in values])
    return df.withColumn(name, F.explode(array))


def complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add rows so that every combination of observed values occurs."""
    first, *rest = [df.select(c).distinct() for c in columns]
    grid = reduce(expand_levels, rest, first)
    return _joined(grid, df, list(columns), list(columns), "left", True).select(*df.columns)


def densify_days(df: DataFrame, group: Sequence[str], nested: Sequence[str], date: str) -> DataFrame:
    """One row per day from the first to the last day of each group (T4).

    Every observed combination of ``nested`` gets the full range of its group; rows that
    exist are kept as they are, the added ones hold only the keys and the day.
    """
    keys = [*group, *nested]
    spans = df.groupBy(*keys).agg(F.min(date).alias("__lo"), F.max(date).alias("__hi"))
    # Already one row per combination here.
    whole = Window.partitionBy(*group)
    ranges = spans.withColumns({"__first": F.min("__lo").over(whole), "__last": F.max("__hi").over(whole)})
    days = ranges.select(*keys, F.explode(F.sequence("__first", "__last", F.expr("interval 1 day"))).alias(date))
    return _joined(days, df, [*keys, date], [*keys, date], "left", True).select(*df.columns)
