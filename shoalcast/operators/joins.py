"""Joins (J1-J16, U5) that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoalcast.session import cut_lineage

# A side is broadcast only after a count shows it has at most this many rows.
BROADCAST_ROWS = 100_000
# Keys holding at least this share of the rows are salted; there can be at most 1/share of them.
HOT_SHARE = 0.01
SALTS = 64


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Bounded check: reads no more than ``rows + 1`` rows."""
    return df.limit(rows + 1).count() <= rows


def keys_equal(left: Sequence[Column], right: Sequence[Column], null_safe: bool) -> Column:
    pairs = [(l.eqNullSafe(r) if null_safe else l == r) for l, r in zip(left, right)]
    return reduce(lambda x, y: x & y, pairs)


def _joined(
    left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str], how: str, null_safe: bool
) -> DataFrame:
    """Equi join keeping the left keys only.  ``right`` must not share other names with ``left``."""
    renamed = {name: f"__r{i}" for i, name in enumerate(right_on)}
    right = right.withColumnsRenamed(renamed)
    condition = keys_equal(
        [F.col(c) for c in left_on], [F.col(renamed[c]) for c in right_on], null_safe
    )
    return left.join(right, condition, how).drop(*renamed.values())


def hot_keys(counts: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> DataFrame | None:
    """Keys holding at least ``share`` of the rows, from rows per key (``__n``); None if there are none.

    No more than ``1 / share`` keys can hold that much, so the driver takes them as a local table.
    """
    total = counts.agg(F.sum("__n").alias("t")).scalar()
    found = counts.where(F.col("__n") >= total * share).select(*keys)
    rows = found.collect()
    return found.sparkSession.createDataFrame(rows, found.schema) if rows else None


def salted_join(
    facts: DataFrame,
    lookup: DataFrame,
    left_on: Sequence[str],
    right_on: Sequence[str],
    spread: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    salts: int = SALTS,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Shuffle join with hot keys spread over ``salts`` tasks.

    The salt is a hash of ``spread`` (columns that tell the facts of one key apart), so a
    recomputed task sends every row to the same place.  Only hot keys are copied on the
    lookup side.  Facts with a missing key match nothing and are spread as well.
    ``counts`` are the rows per key (``__n``), if the caller has them already.
    """
    if how not in ("left", "inner"):
        raise ValueError("copies of a hot lookup row would come out unmatched: use a left or an inner join")
    if counts is None:
        counts = facts.groupBy(*left_on).agg(F.count(F.lit(1)).alias("__n"))
    if not null_safe:
        counts = counts.dropna(subset=list(left_on))
    hot = hot_keys(counts, left_on)
    zero = F.lit(0)
    bucket = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    missing = F.lit(False) if null_safe else reduce(lambda x, y: x | y, [F.col(c).isNull() for c in left_on])
    if hot is None:
        salted_facts = facts.withColumn("__salt", F.when(missing, bucket).otherwise(zero))
        salted_lookup = lookup.withColumn("__rsalt", zero)
    else:
        marked = hot.withColumn("__hot", F.lit(True))
        salted_facts = (
            _joined(facts, F.broadcast(marked), left_on, left_on, "left", null_safe)
            .withColumn("__salt", F.when(F.col("__hot").isNotNull() | missing, bucket).otherwise(zero))
            .drop("__hot")
        )
        marked_lookup = marked.toDF(*right_on, "__hot")
        copies = F.when(F.col("__hot").isNotNull(), F.sequence(zero, F.lit(salts - 1))).otherwise(F.array(zero))
        salted_lookup = (
            _joined(lookup, F.broadcast(marked_lookup), right_on, right_on, "left", null_safe)
            .withColumn("__rsalt", F.explode(copies))
            .drop("__hot")
        )
    # The salt is part of the key; it is never null, so both equality kinds agree on it.
    return _joined(
        salted_facts, salted_lookup, [*left_on, "__salt"], [*right_on, "__rsalt"], how, null_safe
    ).drop("__salt")


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    left_on: Sequence[str] | str,
    right_on: Sequence[str] | str | None = None,
    spread: Sequence[str] | None = None,
    how: str = "left",
    null_safe: bool = False,
    broadcast_rows: int = BROADCAST_ROWS,
    write: bool = False,
) -> DataFrame:
    """Left (or inner) equi join to a reference table.

    Broadcast when a bounded count proves the table small, otherwise a shuffle join
    with hot keys salted by ``spread`` (default: all fact columns).  That join reads the facts
    for its hot keys and for its rows: ``write`` facts that are costly to make.
    """
    left_on = [left_on] if isinstance(left_on, str) else list(left_on)
    right_on = left_on if right_on is None else [right_on] if isinstance(right_on, str) else list(right_on)
    if fits_broadcast(lookup, broadcast_rows):
        return _joined(facts, F.broadcast(lookup), left_on, right_on, how, null_safe)
    if write:
        facts = cut_lineage(facts)
    return salted_join(facts, lookup, left_on, right_on, spread or facts.columns, how, null_safe)


def suffix_join(
    survey: DataFrame,
    registry: DataFrame,
    digits: str,
    full: str,
    spread: Sequence[str],
    shortest: int = 4,
    broadcast_rows: int = BROADCAST_ROWS,
    write: bool = False,
) -> DataFrame:
    """Attach every registry value that ends in the given digits.

    All survey rows stay; several matches give several rows.  The registry is turned
    into one row per suffix, which makes this an equality join; ``write`` as in ``lookup_join``.
    """
    full_values = registry.select(full).where(F.length(full) >= shortest).distinct()
    lengths = F.sequence(F.lit(shortest), F.length(full))
    suffixes = full_values.select(full, F.explode(lengths).alias("__len")).select(
        full, F.col(full).substr(-F.col("__len"), F.col("__len")).alias("__suffix")
    )
    return lookup_join(survey, suffixes, digits, "__suffix", spread=spread, broadcast_rows=broadcast_rows, write=write)


def asof_latest(
    events: DataFrame,
    history: DataFrame,
    by: str,
    event_date: str,
    history_date: str,
    payload: Sequence[str],
    spread: Sequence[str],
) -> DataFrame:
    """Give each event the latest history row dated strictly before it.

    The dates of a key, one row each, are lined up with its history dates and the last
    history row is carried forward; the pairs of a key are never formed, and a key's line may
    lie in many parts.  ``payload`` names the history columns to attach; among
    rows of one date the smallest payload wins.
    """
    dates = events.groupBy(by, event_date).agg(F.count(F.lit(1)).alias("__n"))
    event_dates = dates.dropna(subset=[by, event_date]).select(
        F.col(by).alias("__by"), F.col(event_date).alias("__t"), F.lit(0).alias("__kind")
    )
    history_dates = (
        history.dropna(subset=[by, history_date])
        .groupBy(F.col(by).alias("__by"), F.col(history_date).alias("__t"))
        .agg(F.min(F.struct(*payload)).alias("__match"))
        .withColumn("__kind", F.lit(1))
    )
    line = event_dates.unionByName(history_dates, allowMissingColumns=True)
    # At one date the event comes first, so it does not see that day's history.
    matches = (
        carried_forward(line, "__by", ["__t", "__kind"], "__match")
        .where((F.col("__kind") == 0) & F.col("__match").isNotNull())
        .select("__by", "__t", *[F.col(f"__match.{p}").alias(p) for p in payload])
    )
    return salted_join(events, matches, [by, event_date], ["__by", "__t"], spread, counts=dates)


def carried_forward(line: DataFrame, by: str, order: Sequence[str], value: str, parts: int | None = None) -> DataFrame:
    """``line`` with the last ``value`` of its key so far, as a segmented scan.

    Rows are range partitioned by key and order, so a key with half of all rows spreads over many parts.  Each part
    carries forward by itself; what a part of a key ends with goes to the key's later parts, which are one row each.
    """
    spark = line.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Written, as the number of a part must not change between reads.
    placed = cut_lineage(line.repartitionByRange(parts, by, *order).withColumn("__part", F.spark_partition_id()))
    so_far = Window.partitionBy("__part", by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    own = placed.withColumn("__own", F.last(value, ignorenulls=True).over(so_far)).drop(value)
    seen = F.when(F.col(value).isNotNull(), F.struct(*order))
    ends = placed.groupBy("__part", by).agg(F.max_by(value, seen).alias("__end"))
    earlier = Window.partitionBy(by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select("__part", by, F.last("__end", ignorenulls=True).over(earlier).alias("__carry")).where(F.col("__carry").isNotNull())
    return own.join(carry, ["__part", by], "left").withColumn(value, F.coalesce("__own", "__carry")).drop("__own", "__carry", "__part")


def full_outer(
    left: DataFrame,
    right: DataFrame,
    left_on: Sequence[str],
    right_on: Sequence[str],
    spread: Sequence[str],
    null_safe: bool = False,
) -> DataFrame:
    """Full outer equi join (J7); the result keeps the left key names.

    Written as left join plus unmatched right rows, so that rows without a key skip the
    join and a hot key can be spread, which a plain full outer join does not allow.
    """
    renamed = right.withColumnsRenamed(dict(zip(right_on, left_on)))
    has_key = F.lit(True) if null_safe else reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in left_on])
    with_left = salted_join(left.where(has_key), renamed, left_on, left_on, spread, null_safe=null_safe)
    left_keys = left.where(has_key).select(*left_on).distinct()
    only_right = _joined(renamed, left_keys, left_on, left_on, "left_anti", null_safe)
    out = with_left.unionByName(only_right, allowMissingColumns=True)
    return out if null_safe else out.unionByName(left.where(~has_key), allowMissingColumns=True)


def without_dates(df: DataFrame, date_col: str, dates: DataFrame, dates_col: str) -> DataFrame:
    """Rows whose date is not in the set (J9); rows without a date stay.

    The set is made distinct first: it has at most one row per calendar day.
    """
    return _joined(df, dates.select(dates_col).distinct(), [date_col], [dates_col], "left_anti", False)


def tagged_union(parts: dict[str, DataFrame], tag: str) -> DataFrame:
    """Union by name with a column telling where a row came from."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in parts.items()]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), tagged)
