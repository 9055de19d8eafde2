"""Number rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean weight in kg of species counted rather than measured
# (45 crab, 24 octopus, 50 cockle).
COUNTED_SPECIES_KG = {"45": 0.05, "24": 1.0, "50": 0.006}


def sanitize_numeric(
    value: Column,
    absolute: bool = False,
    minimum: float | None = None,
    maximum: float | None = None,
    zero_is_null: bool = False,
) -> Column:
    """Fold the sign, then blank values outside the range; NULL stays NULL."""
    out = F.abs(value) if absolute else value
    if zero_is_null:
        out = F.when(out != 0, out)
    if minimum is not None:
        out = F.when(out >= minimum, out)
    if maximum is not None:
        out = F.when(out <= maximum, out)
    return out


def fish_weight_kg(species: Column, a: Column, b: Column, length_cm: Column) -> Column:
    """Weight of one fish: a * L^b grams, or a constant for counted species."""
    out = F.when(species == "45", F.lit(COUNTED_SPECIES_KG["45"]))
    for code in ("24", "50"):
        out = out.when(species == code, F.lit(COUNTED_SPECIES_KG[code]))
    return out.otherwise(a * F.pow(length_cm, b) / 1000)


def cube_root_units(value: Column) -> Column:
    """Cube root of thousandths, rounded half to even; NULL for negative input."""
    return F.when(value >= 0, F.bround(F.pow(value * 1000, F.lit(1.0 / 3.0)), 0))


def tenth_units(value: Column) -> Column:
    """Tenths, rounded half to even.  Sums carry noise from their order, so ties are settled at six digits."""
    return F.bround(F.round(value, 6) * 10, 0)


def from_cube_root(units: Column) -> Column:
    return units * units * units / 1000


def unit_price(value: Column, weight: Column) -> Column:
    return F.try_divide(value, weight)


def is_finite(value: Column) -> Column:
    """TRUE for ordinary numbers; FALSE for NULL, NaN and infinities."""
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))


def _log(value: Column) -> Column:
    return F.when(value > 0, F.ln(value))


def residual_factor(price: Column, lower: Column, upper: Column) -> Column:
    """Multiplicative distance to the nearer interval end, above 1 on the upper side."""
    to_lower = F.abs(_log(F.try_divide(price, lower)))
    to_upper = F.abs(_log(F.try_divide(price, upper)))
    nearest = F.when(to_lower.isNotNull() & to_upper.isNotNull(), F.least(to_lower, to_upper))
    return F.exp(nearest * F.signum(to_lower - to_upper))


def inverse_logit(value: Column) -> Column:
    return 1 / (1 + F.exp(-value))
