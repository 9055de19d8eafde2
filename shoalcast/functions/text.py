"""Text conversions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal text; casts alone would also accept '12d', 'NaN' and 'Infinity'.
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"

# Fixed patterns of a valid boat registration.
REGISTRATION_PATTERN = r"^[a-z]{2,4} ?[0-9]{2,3}( ?[a-z]{2,3})?$"
REGISTRATION_PARTS = r"([a-z]{2,4}) ?([0-9]{2,3})( ?)([a-z]{2,3})?$"

# Spellings of a logical.
TRUE_TEXT = ["TRUE", "true", "T", "True"]
FALSE_TEXT = ["FALSE", "false", "F", "False"]

# Fixed value: misspelt municipality.
MUNICIPALITY_FIXES = {"Manatutu": "Manatuto"}


def null_sentinel(col: Column, sentinel: str = "--") -> Column:
    return F.nullif(col, F.lit(sentinel))


def to_number(col: Column) -> Column:
    """Text to double, NULL for anything that is not plain decimal text."""
    return F.when(col.rlike(NUMBER_PATTERN), F.trim(col).try_cast("double"))


def decimal_comma(col: Column) -> Column:
    """'1.234,5' to 1234.5."""
    return to_number(F.regexp_replace(F.regexp_replace(col, r"\.", ""), ",", "."))


def first_number(col: Column) -> Column:
    return to_number(F.nullif(F.regexp_extract(col, r"[0-9.]+", 0), F.lit("")))


def duration_seconds(col: Column) -> Column:
    """'1d 3h 20m 5s' to seconds, NULL when no part is present."""
    # Seconds per unit.
    units = {"d": 86400.0, "h": 3600.0, "m": 60.0, "s": 1.0}
    parts = [
        to_number(F.nullif(F.regexp_extract(F.lower(col), r"([0-9.]+)\s*" + unit, 1), F.lit(""))) * F.lit(seconds)
        for unit, seconds in units.items()
    ]
    total = sum((F.coalesce(p, F.lit(0.0)) for p in parts[1:]), F.coalesce(parts[0], F.lit(0.0)))
    return F.when(F.coalesce(*parts).isNotNull(), total)


def fix_values(col: Column, fixes: dict[str, str]) -> Column:
    """Replace whole values, leave the rest (F8)."""
    out = col
    for wrong, right in fixes.items():
        out = F.when(col == wrong, F.lit(right)).otherwise(out)
    return out


# Fixed pattern: the numbers of a length range in a question's name.
BIN_NUMBER = "(?<=_|r)[0-9]+"


def numbers_after_marker(col: Column) -> Column:
    """All numbers that follow an underscore or an 'r'."""
    return F.transform(F.regexp_extract_all(col, F.lit(f"({BIN_NUMBER})"), F.lit(1)), lambda s: s.try_cast("double"))


def bin_midpoint(col: Column) -> Column:
    """Middle of the length range named in the text, NULL without numbers."""
    numbers = numbers_after_marker(col)
    total = F.aggregate(numbers, F.lit(0.0), lambda acc, x: acc + x)
    return F.try_divide(total, F.size(numbers))


def bin_midpoint_of_name(name: str) -> float | None:
    """The same for a column name, worked out once when the plan is built."""
    numbers = [float(n) for n in re.findall(BIN_NUMBER, name)]
    return sum(numbers) / len(numbers) if numbers else None


def boat_registration(col: Column) -> Column:
    """Lower, validate, re-space, upper.  A missing suffix leaves a trailing blank."""
    low = F.lower(col)
    spaced = F.regexp_replace(low, REGISTRATION_PARTS, "$1 $2 $4")
    return F.upper(F.when(low.rlike(REGISTRATION_PATTERN), spaced))


def platform_label(col: Column) -> Column:
    return F.when(col.isin(TRUE_TEXT), F.lit("boat")).when(col.isin(FALSE_TEXT), F.lit("land"))


def mesh_choice(size: Column, other: Column) -> Column:
    """The free-text size counts where the choice is 'seluk' (F19); still text."""
    return F.when(size == "seluk", other).when(size != "seluk", size)


def strip_suffix(col: Column, suffix: str) -> Column:
    return F.regexp_replace(col, re.escape(suffix) + "$", "")


def map_codes(col: Column, codes: dict[str, str]) -> Column:
    out = None
    for name, code in codes.items():
        out = F.when(col == name, F.lit(code)) if out is None else out.when(col == name, F.lit(code))
    return out
