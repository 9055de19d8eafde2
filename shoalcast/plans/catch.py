"""Catch lines from the landing survey (C3) and their wide form."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoalcast.functions.flags import collect_flags
from shoalcast.functions.names import matching
from shoalcast.functions.numeric import fish_weight_kg, unit_price
from shoalcast.functions.text import bin_midpoint_of_name, to_number
from shoalcast.operators.aggregates import sum_or_null, sum_or_zero, weighted_mean
from shoalcast.operators.joins import lookup_join
from shoalcast.operators.reshape import group_columns

# Fixed names of the questions that are not counts of individuals.
SPECIES = "species"
USE = "food_or_sale"
LENGTH_OVER_60 = "no_fish_by_length_group_fish_length_over60"

# Most individuals believed in one line, half a length bin in cm,
# the code for "no catch", and the bin that may carry a measured length.
MAX_INDIVIDUALS = math.exp(10)
HALF_BIN_CM = 2.5
NO_CATCH = "0"
OPEN_BIN_CM = 60.0


def species_lines(survey: DataFrame, record_id: str = "uuid", all_bins: bool = False) -> DataFrame:
    """One row per record, species group and length bin, with the raw count and the group's total.

    A group's answers sit in one survey row, so its total is plain arithmetic on columns
    and the lines are exploded in place: no shuffle and no window.  Every group gets every
    question asked in any group; groups without an answer are left out.  Empty bins are left
    out too unless ``all_bins``; catch lines do not depend on them.
    """
    dropped = {*matching(survey, suffix="species_name"), *matching(survey, suffix="photo")}
    groups = group_columns([c for c in survey.columns if c.startswith("species_group") and c not in dropped])
    questions = sorted({q for asked in groups.values() for q in asked})
    counted = [q for q in questions if q not in (SPECIES, USE, LENGTH_OVER_60)]

    def answer(group: str, question: str) -> Column:
        asked = groups[group]
        return F.col(f"`{asked[question]}`") if question in asked else F.lit(None).cast("string")

    def entry(group: str) -> Column:
        asked = F.coalesce(*[answer(group, q) for q in questions]).isNotNull()
        fields = F.struct(
            F.lit(group).alias("record"),
            answer(group, SPECIES).alias("species_code"),
            answer(group, USE).alias("use"),
            answer(group, LENGTH_OVER_60).alias("length_over_60"),
            *[answer(group, q).alias(f"text_{i}") for i, q in enumerate(counted)],
        )
        return F.when(asked, fields)

    entries = F.array(*[entry(g) for g in sorted(groups)])
    per_group = survey.select(F.col(record_id).alias("record_id"), F.explode(entries).alias("g"))
    parsed = per_group.where(F.col("g").isNotNull()).select(
        "record_id",
        "g.record",
        "g.species_code",
        "g.use",
        "g.length_over_60",
        *[to_number(F.col(f"g.text_{i}")).alias(f"n_{i}") for i in range(len(counted))],
    )
    numbers = [F.col(f"n_{i}") for i in range(len(counted))]
    total = sum((F.coalesce(n, F.lit(0.0)) for n in numbers[1:]), F.coalesce(numbers[0], F.lit(0.0)))
    summed = parsed.withColumn("n_group", F.when(F.coalesce(*numbers).isNotNull(), total))
    bins = [
        F.struct(
            F.lit(q).alias("question"),
            F.lit(bin_midpoint_of_name(q)).cast("double").alias("bin_length"),
            F.col(f"n_{i}").alias("n_individuals"),
            # An empty bin adds nothing to its group, unless all are empty: then one line stands for them.
            (F.lit(all_bins) | F.col(f"n_{i}").isNotNull() | (F.col("n_group").isNull() & F.lit(i == 0))).alias("kept"),
        )
        for i, q in enumerate(counted)
    ]
    lines = summed.withColumn("b", F.explode(F.array(*bins)))
    measured = (F.col("b.bin_length") == OPEN_BIN_CM) & F.col("length_over_60").isNotNull()
    return lines.where("b.kept").select(
        "record_id",
        "record",
        "species_code",
        "use",
        "b.question",
        F.when(measured, to_number(F.col("length_over_60"))).otherwise(F.col("b.bin_length")).alias("mean_length"),
        "b.n_individuals",
        "n_group",
    )


def flag_lines(lines: DataFrame, size_flag_mode: str = "rowwise") -> DataFrame:
    """Count and size flags, cleaned counts and weights of species lines.

    ``size_flag_mode='rowwise'`` checks every line; ``'reference'`` sets size flags only in
    groups of a single line (needs ``n_lines``, the number of lines of the group).
    """
    n, total = F.col("n_individuals"), F.col("n_group")
    caught = F.col("species_code") != NO_CATCH
    lines = lines.withColumns(
        {
            "n_individuals_flag": F.when(n > MAX_INDIVIDUALS, "species_number__too_large")
            .when(n < 0, "species_number__negative")
            .when((total == 0) & caught, "species_number__zero")
            .when(total.isNull() & caught, "species_number__not_recorded"),
            "n_individuals": F.when(n > MAX_INDIVIDUALS, F.lit(None).cast("double"))
            .when(n < 0, -n)
            .when((total == 0) & caught, F.lit(None).cast("double"))
            .otherwise(n),
        }
    )
    present = F.col("n_individuals") > 0
    if size_flag_mode == "reference":
        present = present & (F.col("n_lines") == 1)
    elif size_flag_mode != "rowwise":
        raise ValueError(f"unknown size_flag_mode: {size_flag_mode}")
    kg = fish_weight_kg(F.col("species_code"), F.col("a"), F.col("b"), F.col("mean_length"))
    return lines.withColumns(
        {
            "size_flag": F.when(
                present & (F.col("mean_length") - HALF_BIN_CM > F.col("maxlength")), "species_size__too_large"
            ).when(present & (F.col("mean_length") + HALF_BIN_CM < F.col("minlength")), "species_size__too_small"),
            "mean_weight": kg,
        }
    ).withColumn("weight", F.col("mean_weight") * F.col("n_individuals"))


def catch_lines(flagged: DataFrame) -> DataFrame:
    """One row per record, species and use (A5)."""
    return (
        flagged.groupBy("record_id", "species_code", "use")
        .agg(
            F.bround(weighted_mean(F.col("mean_length"), F.col("n_individuals")), 1).alias("mean_length"),
            sum_or_null(F.col("n_individuals")).alias("n_individuals"),
            sum_or_null(F.col("weight")).alias("weight"),
            collect_flags(F.col("n_individuals_flag"), F.col("size_flag")).alias("species_flags"),
        )
    )


def clean_catch(survey: DataFrame, species: DataFrame, size_flag_mode: str = "rowwise") -> DataFrame:
    """Survey and species table to clean catch lines.

    One shuffle, by record; none if the survey is already distributed by record.
    """
    lines = species_lines(survey)
    if size_flag_mode == "reference":
        questions = group_columns(survey.columns)
        counted = {q for asked in questions.values() for q in asked} - {SPECIES, USE, LENGTH_OVER_60}
        counted = {q for q in counted if not q.endswith(("species_name", "photo"))}
        lines = lines.withColumn("n_lines", F.lit(len(counted)))
    wanted = species.select("species_code", "a", "b", "minlength", "maxlength")
    joined = lookup_join(lines, wanted, "species_code", spread=["record_id", "record", "question"])
    return catch_lines(flag_lines(joined, size_flag_mode))


def ranked_lines(catch: DataFrame) -> DataFrame:
    """Catch lines with ``r``, their rank by weight in the record.

    A record has at most as many catch lines as the survey has species groups, so ranking inside a record is cheap.
    """
    by_weight = Window.partitionBy("record_id").orderBy(
        F.col("weight").desc_nulls_last(), F.col("species_code").asc_nulls_last(), F.col("use").asc_nulls_last()
    )
    return catch.withColumn("r", F.row_number().over(by_weight))


def species_slots(n_top_species: int) -> list[str]:
    return [*[str(i) for i in range(1, n_top_species + 1)], "other"]


def species_columns(n_top_species: int = 2) -> list[str]:
    return [f"{c}_{slot}" for slot in species_slots(n_top_species) for c in ("species_code", "weight")]


def wide_cells(n_top_species: int = 2) -> list[Column]:
    """Aggregates of a record's ranked lines: ``species_columns``."""
    cells = []
    for i, slot in enumerate(species_slots(n_top_species), 1):
        member = F.col("r") > n_top_species if slot == "other" else F.col("r") == i
        count = F.count_if(member)
        code = F.max(F.when(member, F.col("species_code")))
        if slot == "other":
            code = F.when(count > 1, F.lit("other")).otherwise(code)
        cells.append(F.when(count == 0, F.lit("none")).otherwise(code).alias(f"species_code_{slot}"))
        cells.append(sum_or_zero(F.when(member, F.col("weight"))).alias(f"weight_{slot}"))
    return cells


def species_wide(catch: DataFrame, n_top_species: int = 2) -> DataFrame:
    """Codes and weights of the heaviest species per record, the rest as ``other``.

    Missing combinations get code 'none' and weight 0.
    """
    ranked = ranked_lines(catch.select("record_id", "species_code", "use", "weight"))
    return ranked.groupBy("record_id").agg(*wide_cells(n_top_species))


def widen_trip_catch(trips: DataFrame, catch: DataFrame | None = None, n_top_species: int = 2) -> DataFrame:
    """Trips with their price per kg and species columns.

    Trips that carry their species columns already (``clean_trips`` with ``n_top_species``) need no ``catch``.
    """
    priced = trips.withColumn("trip_price", unit_price(F.col("trip_value"), F.col("trip_catch")))
    if catch is None:
        wide = species_columns(n_top_species)
        return priced.select("record_id", *[c for c in priced.columns if c not in ("record_id", *wide)], *wide)
    return priced.join(species_wide(catch, n_top_species), "record_id", "left")
