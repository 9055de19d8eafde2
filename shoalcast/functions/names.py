"""Column-name helpers; they work on schemas, never on rows."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def clean_names(names: Iterable[str]) -> list[str]:
    """Headers to unique snake_case names."""
    out: list[str] = []
    seen: dict[str, int] = {}
    for raw in names:
        name = raw.replace("%", "_percent_").replace("#", "_number_")
        name = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name)
        name = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", name)
        name = re.sub(r"[^0-9A-Za-z]+", "_", name).strip("_").lower() or "x"
        if name[0].isdigit():
            name = "x" + name
        seen[name] = seen.get(name, 0) + 1
        out.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return out


def with_clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*clean_names(df.columns))


def matching(df: DataFrame, prefix: str = "", suffix: str = "") -> list[str]:
    """Names that start and end as asked."""
    return [c for c in df.columns if c.startswith(prefix) and c.endswith(suffix)]


def mutate_strings(df: DataFrame, fn: Callable[[Column], Column]) -> DataFrame:
    """Apply ``fn`` to every text column (P5)."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({n: fn(F.col(n)) for n in names}) if names else df
