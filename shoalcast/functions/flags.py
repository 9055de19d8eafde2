"""Quality flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed names of the price flags, in the order they are tried.
PRICE_FLAGS = [
    ("above", 5.0, "trip_catch__price_per_kg_extremely_large"),
    ("below", 1.0 / 5.0, "trip_catch__price_per_kg_extremely_small"),
    ("above", 3.0, "trip_catch__price_per_kg_too_large"),
    ("below", 1.0 / 3.0, "trip_catch__price_per_kg_too_small"),
]


def price_flag(factor: Column) -> Column:
    out = None
    for side, limit, name in PRICE_FLAGS:
        test = factor > limit if side == "above" else factor < limit
        out = F.when(test, F.lit(name)) if out is None else out.when(test, F.lit(name))
    return out


def join_flags(*flags: Column) -> Column:
    """Non-null flags joined by ';', NULL when there are none."""
    return F.nullif(F.concat_ws(";", *flags), F.lit(""))


# Fixed names of the flags a catch line can carry, in the order they are written.
SPECIES_FLAGS = [
    "species_number__negative",
    "species_number__not_recorded",
    "species_number__too_large",
    "species_number__zero",
    "species_size__too_large",
    "species_size__too_small",
]


def collect_flags(*flags: Column, names: Sequence[str] = SPECIES_FLAGS) -> Column:
    """Aggregate: distinct flags of a group joined by ';', NULL when there are none.

    The names are known, so each is a bit and the group's bits are or-ed: a fixed-size
    buffer that hash aggregation combines on the map side.
    """
    bits = F.lit(0)
    for flag in flags:
        bit = F.lit(0)
        for i, name in enumerate(names):
            bit = F.when(flag == name, F.lit(1 << i)).otherwise(bit)
        bits = bits.bitwiseOR(bit)
    return render_flags(F.bit_or(bits), names)


def merge_flag_texts(text: Column, names: Sequence[str] = SPECIES_FLAGS) -> Column:
    """Aggregate over already joined flag texts, without duplicates."""
    bits = F.lit(0)
    for i, name in enumerate(names):
        bits = bits.bitwiseOR(F.when(text.contains(name), F.lit(1 << i)).otherwise(F.lit(0)))
    return render_flags(F.bit_or(bits), names)


def render_flags(bits: Column, names: Sequence[str]) -> Column:
    return join_flags(*[F.when(bits.bitwiseAND(F.lit(1 << i)) != 0, F.lit(n)) for i, n in enumerate(names)])


def without_price_flag(flags: Column) -> Column:
    """Predicate: no price flag; a NULL text passes (F-f)."""
    return flags.isNull() | ~flags.contains("price_per_kg_")
