"""Price per species (C11, E4a, E8) and price flags on trips."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoalcast.functions.dates import month_number, period_features
from shoalcast.functions.flags import join_flags, price_flag
from shoalcast.functions.numeric import is_finite, residual_factor
from shoalcast.operators.joins import fits_broadcast, lookup_join
from shoalcast.operators.shrinkage import drawn_memberships, membership_moments, overall_mean, shrunk_means
from shoalcast.session import cut_lineage

SLOTS = ("1", "2", "other")
# Species whose effects by draw are held as one array; more are looked up in a table.
MOST_SPECIES = 4096


def price_features(
    trips_wide: DataFrame,
    stations: DataFrame,
    period_static_unit: str = "month",
    period_seasonal_function: Callable[[Column], Column] = month_number,
) -> DataFrame:
    """Boat trips with a price, their municipality and period (C11)."""
    priced = trips_wide.where(is_finite(F.col("trip_price")) & (F.col("trip_platform") == "boat"))
    placed = lookup_join(priced, stations, "trip_landing_site", "station_code", spread=["record_id"], write=True)
    return period_features(placed, "trip_date", period_static_unit, period_seasonal_function)


MEMBERSHIP_INPUT = ["record_id", "trip_price", *[f"{c}_{s}" for s in SLOTS for c in ("species_code", "weight")]]


def memberships(trips_wide: DataFrame, keep: Sequence[str] = (), slots: Sequence[str] = SLOTS) -> DataFrame:
    """One row per trip and species slot that has weight: (record_id, species_code, share, log_price)."""
    total = sum((F.coalesce(F.col(f"weight_{s}"), F.lit(0.0)) for s in slots[1:]), F.coalesce(F.col(f"weight_{slots[0]}"), F.lit(0.0)))
    parts = F.array(
        *[F.struct(F.col(f"species_code_{s}").alias("code"), F.col(f"weight_{s}").alias("w")) for s in slots]
    )
    rows = trips_wide.where(F.col("trip_price") > 0).select(
        "record_id", *keep, F.ln("trip_price").alias("log_price"), total.alias("__total"), F.explode(parts).alias("m")
    )
    return rows.where(F.col("m.w") > 0).select(
        "record_id",
        *keep,
        F.col("m.code").alias("species_code"),
        (F.col("m.w") / F.col("__total")).alias("share"),
        "log_price",
    )


def species_price(trips_wide: DataFrame) -> DataFrame:
    """Partially pooled log price per species (E4a): species_code, n, mean, ss, overall, estimate."""
    # One row a species, written as the estimates and their hyper-parameters both read it.
    return shrunk_means(cut_lineage(membership_moments(memberships(trips_wide), ["species_code"], "log_price", "share")), [])


def species_price_draws(trips_wide: DataFrame, draws: int = 100, hash_name: str = "xxhash64") -> tuple[DataFrame, DataFrame]:
    """Log price per species and draw, and the overall log price per draw."""
    members = memberships(trips_wide.select(*MEMBERSHIP_INPUT))
    cells = cut_lineage(drawn_memberships(members, "record_id", ["species_code"], "log_price", "share", draws, hash_name))
    estimates = shrunk_means(cells, ["draw"]).select("species_code", "draw", "estimate")
    return estimates, overall_mean(cells, ["draw"]).select("draw", "overall")


def _quantile(values: Column, size: int, p: float) -> Column:
    """Linear interpolation in a sorted array of known size."""
    position = p * (size - 1)
    low = int(position)
    high = min(low + 1, size - 1)
    return values[low] + F.lit(position - low) * (values[high] - values[low])


def _interval_of(effects: DataFrame, overall: Sequence[float | None], draws: int, width: float, slots: int) -> Callable[[Column], Column]:
    """The interval as a function of a trip's codes and weights: prices of a batch of trips by draws, the few effects at hand."""
    found = [*effects.select("species_code", "e").collect(), (None, overall)]
    place = {code: i for i, (code, _) in enumerate(found[:-1]) if code is not None}
    values = np.array([[0.0 if v is None else v for v in e] for _, e in found])
    missing = np.array([[v is None for v in e] for _, e in found])
    tail = (1 - width) / 2
    marks = [p * (draws - 1) for p in (tail, 1 - tail)]
    spots = [(int(m), min(int(m) + 1, draws - 1), m - int(m)) for m in marks]

    def interval(asked: pa.Array) -> pa.Array:
        lower, upper = [], []
        for first in range(0, len(asked), 1000):
            part = asked.slice(first, 1000).flatten()
            sums, gone, total = np.zeros((len(part[0]), draws)), np.zeros((len(part[0]), draws), bool), 0.0
            for code, weight in zip(part[:slots], part[slots:]):
                known = code.dictionary_encode()
                # A species without estimates has the overall ones.
                at = np.array([*[place.get(c, len(found) - 1) for c in known.dictionary.to_pylist()], len(found) - 1], np.int64)
                rows = at[known.indices.fill_null(len(at) - 1).to_numpy(zero_copy_only=False)]
                w = weight.to_numpy(zero_copy_only=False)
                used = ((w > 0) | np.isnan(w))[:, None]
                with np.errstate(all="ignore"):
                    sums += np.where(used, w[:, None] * values[rows], 0.0)
                gone |= used & missing[rows]
                total = total + w
            with np.errstate(all="ignore"):
                logs = sums / total[:, None]
                # Missing ones come first in order, as in a sorted array.
                logs[gone] = -np.inf
                logs = np.partition(logs, sorted({x for low, high, _ in spots for x in (low, high)}), axis=1)
                for (low, high, share), out in zip(spots, (lower, upper)):
                    a, b = np.exp(logs[:, low]), np.exp(logs[:, high])
                    out.append(pa.array(a + share * (b - a), mask=(total == 0) | (gone.sum(axis=1) > low)))
        kind = pa.float64()
        return pa.StructArray.from_arrays([pa.concat_arrays(x) if x else pa.array([], kind) for x in (lower, upper)], names=["price_lower", "price_upper"])

    return F.arrow_udf(interval, "price_lower double, price_upper double")


def price_interval(
    trips_wide: DataFrame,
    price_draws: DataFrame,
    overall_draws: DataFrame,
    draws: int,
    width: float = 0.95,
    slots: Sequence[str] = SLOTS,
) -> DataFrame:
    """Interval of the expected price of each trip given its species.

    The draws of a species are one array, so a trip stays one row: three lookups and arithmetic on arrays, in one function
    of the trip's columns where species are few, else by joins.  A species without an estimate in a draw gets that draw's mean.
    """
    numbers = F.sequence(F.lit(1), F.lit(draws))
    pack = lambda value: F.map_from_entries(F.collect_list(F.struct("draw", value)))
    means = cut_lineage(overall_draws.agg(pack("overall").alias("m")))
    overall = means.select(F.transform(numbers, lambda d: F.try_element_at("m", d)).alias("o")).scalar()
    # The fitted model: species x draws numbers, written once and read by the three lookups.
    effects = cut_lineage(
        price_draws.groupBy("species_code")
        .agg(pack("estimate").alias("m"))
        .withColumn("__o", overall)
        .select(
            "species_code",
            F.transform(
                numbers, lambda d: F.coalesce(F.try_element_at("m", d), F.get("__o", d - 1))
            ).alias("e"),
        )
    )
    weight = {s: F.greatest(F.coalesce(F.col(f"weight_{s}"), F.lit(0.0)), F.lit(0.0)) for s in slots}
    if fits_broadcast(effects, MOST_SPECIES):
        interval = _interval_of(effects, means.select(F.transform(numbers, lambda d: F.try_element_at("m", d))).first()[0], draws, width, len(slots))
        asked = F.struct(*[F.col(f"species_code_{s}").alias(f"c{i}") for i, s in enumerate(slots)], *[weight[s].alias(f"w{i}") for i, s in enumerate(slots)])
        scored = trips_wide.withColumn("__i", interval(asked))
        return scored.withColumns({c: F.col(f"__i.{c}") for c in ("price_lower", "price_upper")}).drop("__i")
    looked_up = trips_wide.withColumn("__o", overall)
    for slot in slots:
        renamed = effects.select(F.col("species_code").alias("__code"), F.col("e").alias(f"__e_{slot}"))
        looked_up = lookup_join(looked_up, renamed, f"species_code_{slot}", "__code", spread=["record_id"])
    total = sum((weight[s] for s in slots[1:]), weight[slots[0]])

    def expected(draw: Column) -> Column:
        terms = []
        for s in slots:
            effect = F.get(F.coalesce(f"__e_{s}", "__o"), draw - 1)
            terms.append(F.when(weight[s] > 0, weight[s] * effect).otherwise(0.0))
        return F.exp(F.try_divide(sum(terms[1:], terms[0]), total))

    prices = F.sort_array(F.transform(numbers, expected))
    tail = (1 - width) / 2
    scored = looked_up.withColumn("__p", prices)
    return scored.withColumns(
        {
            "price_lower": _quantile(F.col("__p"), draws, tail),
            "price_upper": _quantile(F.col("__p"), draws, 1 - tail),
        }
    ).drop("__p", "__o", *[f"__e_{s}" for s in slots])


def add_price_flags(
    trips_wide: DataFrame,
    price_draws: DataFrame,
    overall_draws: DataFrame,
    draws: int,
) -> DataFrame:
    """Compare each price with the interval expected from the species and flag far ones.

    The interval needs a trip's own columns only, so no join back to the trips is made.
    """
    expected = price_interval(trips_wide, price_draws, overall_draws, draws)
    price = F.when(is_finite(F.col("trip_price")), F.col("trip_price"))
    scored = expected.withColumn(
        "trip_price_residual_factor", residual_factor(price, F.col("price_lower"), F.col("price_upper"))
    )
    flags = join_flags(F.col("flags"), price_flag(F.col("trip_price_residual_factor")))
    return scored.withColumn("flags", flags).drop("price_lower", "price_upper")
