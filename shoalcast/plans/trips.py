"""Clean trips from the landing survey (C4) and their match with tracked trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoalcast.functions.dates import local_date, parse_date, parse_timestamp
from shoalcast.functions.flags import join_flags, merge_flag_texts
from shoalcast.functions.numeric import sanitize_numeric
from shoalcast.functions.text import boat_registration, mesh_choice, platform_label, to_number
from shoalcast.operators.aggregates import sum_or_null
from shoalcast.operators.joins import BROADCAST_ROWS, full_outer, suffix_join
from shoalcast.plans.catch import NO_CATCH, ranked_lines, species_columns, wide_cells
from shoalcast.schemas import SURVEY_TRIP_COLUMNS

# Fixed limits.
MIN_IMEI = 9999
MAX_HOURS = 3 * 24
MAX_TRIP_VALUE = 20000
MAX_DAYS_BEFORE_RECORD = 30


# Crew counts and their questions.
CREW = {"men": "no_men", "women": "no_women", "children": "no_child"}


def trip_catch(catch: DataFrame, n_top_species: int | None = None) -> DataFrame:
    """Catch lines to one row per record.

    With ``n_top_species`` the rows also get the columns of ``species_wide``, from one reading of the lines: ranked
    lines lie in the order of their records, so they are counted and summed without a further sort.
    """
    # A missing use counts as a value of its own.
    one_use = (F.min("use") == F.max("use")) & (F.count("use") == F.count(F.lit(1)))
    codes = F.collect_set(F.when(F.col("species_code") != NO_CATCH, F.col("species_code")))
    lines, n_species, wide = catch, F.size(codes), []
    if n_top_species is not None:
        lines = ranked_lines(catch).withColumn("__n", F.size(codes.over(Window.partitionBy("record_id"))))
        n_species, wide = F.max("__n"), wide_cells(n_top_species)
    per_trip = lines.groupBy("record_id").agg(
        F.when(one_use, F.max("use")).when(F.count("use") > 0, F.lit("both")).alias("trip_catch_use"),
        n_species.cast("long").alias("trip_n_species"),
        sum_or_null(F.col("weight")).alias("trip_catch"),
        merge_flag_texts(F.col("species_flags")).alias("species_flag"),
        *wide,
    )
    nothing = F.col("trip_catch").isNull() & (F.col("trip_n_species") == 0)
    return per_trip.withColumn("trip_catch", F.when(nothing, F.lit(0.0)).otherwise(F.col("trip_catch")))


def imei_digits(number: Column) -> Column:
    """Digits to search for: whole numbers from 9999 on, sign dropped."""
    size = F.abs(number)
    return F.when((size >= MIN_IMEI) & (size == F.floor(size)), size.try_cast("decimal(38,0)").cast("string"))


def match_imei(survey: DataFrame, boats: DataFrame, broadcast_rows: int = BROADCAST_ROWS, record: str = "uuid") -> DataFrame:
    """Replace the typed IMEI by the registered ones it is a suffix of.

    Where every record has an id, ids and digits are matched alone and the fields meet their devices by record, as
    they meet the catch: whole rows are dealt by record once, never by digits.
    """
    searched = survey.withColumn("__imei", to_number(F.col("trip_group_imei"))).withColumn(
        "__digits", imei_digits(F.col("__imei"))
    )
    if searched.schema[record].nullable:
        matched = suffix_join(
            searched, boats, "__digits", "imei_long", spread=[record], broadcast_rows=broadcast_rows
        )
    else:
        # Exploded, so that the test is made on the digits: pushed down to the typed text it would parse it many times over.
        asked = searched.select(record, F.explode(F.array("__digits")).alias("__digits")).where(F.col("__digits").isNotNull()).distinct()
        found = suffix_join(asked, boats, "__digits", "imei_long", spread=[record], broadcast_rows=broadcast_rows, write=True)
        found = found.where(F.col("imei_long").isNotNull()).withColumnsRenamed({record: "__record", "__digits": "__found"})
        # Equal, but not a key of the join: rows are placed by their record alone.
        same = (F.col("__digits") <= F.col("__found")) & (F.col("__digits") >= F.col("__found"))
        matched = searched.join(found, (F.col(record) == F.col("__record")) & same, "left").drop("__record", "__found")
    missed = F.col("imei_long").isNull() & F.col("trip_group_imei").isNotNull()
    return matched.withColumns(
        {"boat_imei_flag": F.when(missed, "imei__not_found"), "trip_imei": F.col("imei_long")}
    ).drop("imei_long", "__digits", "__imei", "trip_group_imei")


def clean_trip_fields(raw: DataFrame) -> DataFrame:
    """All fields that need only their own row: registration to crew.

    Texts are parsed first and the rules refer to the parsed columns, so that no text is
    parsed once per rule.
    """
    parsed = raw.withColumns(
        {
            "__hours": to_number(F.col("trip_group_duration")),
            "__mesh": mesh_choice(F.col("trip_group_mesh_size"), F.col("trip_group_mesh_size_other")),
            "__mesh_other": to_number(F.col("trip_group_mesh_size_other")),
            "__value": to_number(F.col("total_catch_value")),
            **{f"fisher_number_{who}": to_number(F.col(f"trip_group_no_fishers_{asked}_fishers")) for who, asked in CREW.items()},
            "boat_registration": boat_registration(F.col("trip_group_boat_reg_no")),
            "trip_platform": platform_label(F.col("trip_group_has_boat")),
            "trip_date": parse_date(F.col("date")),
            "recording_datetime": parse_timestamp(F.col("end")),
            "trip_happiness": to_number(F.col("happiness_rating")),
        }
    )
    crew = [F.col(f"fisher_number_{who}") for who in CREW]
    typed = parsed.withColumns(
        {
            "trip_duration": sanitize_numeric(F.col("__hours"), absolute=True, maximum=MAX_HOURS, zero_is_null=True),
            "gear_mesh_size": to_number(F.col("__mesh")),
            "__crew": crew[0] + crew[1] + crew[2],
            "__recorded": local_date(F.col("recording_datetime")),
        }
    )
    unread = lambda field, raw: F.col(field).isNull() & F.col(raw).isNotNull()
    flagged = typed.withColumns(
        {
            "fisher_number_total": sanitize_numeric(F.col("__crew"), zero_is_null=True),
            "boat_registration_flag": F.when(unread("boat_registration", "trip_group_boat_reg_no"), "boat_registration__invalid"),
            "trip_duration_flag": F.when(F.col("__hours") == 0, "trip_duration__zero_hours").when(
                unread("trip_duration", "trip_group_duration"), "trip_duration__too_long"
            ),
            "trip_date_flag": F.when(F.col("trip_date") > F.col("__recorded"), "trip_date__trip_is_in_future").when(
                F.col("trip_date") < F.date_sub("__recorded", MAX_DAYS_BEFORE_RECORD), "trip_date__trip_date_too_old"
            ),
            "gear_mesh_size_flag": F.when(
                F.col("__mesh_other").isNull() & F.col("trip_group_mesh_size_other").isNotNull(), "gear_mesh_size__invalid"
            ),
            "fisher_number_flag": F.when(
                (F.col("__crew") == 0) & F.col("trip_platform").isNotNull(), "fisher_number__zero_fishers"
            ),
        }
    )
    return flagged.withColumnsRenamed(
        {
            "uuid": "record_id",
            "deviceid": "record_device_id",
            "landing_site_name": "trip_landing_site",
            "trip_group_boat_type": "boat_type",
            "trip_group_gear_type": "trip_gear",
            "trip_group_habitat_boat": "trip_habitat",
        }
    )


def value_rules(trips: DataFrame, catch_flag_mode: str = "reference") -> DataFrame:
    """Value and catch repair; both need the trip's catch.

    ``catch_flag_mode='before'`` also flags a catch that was empty before it was repaired;
    by default that flag never fires.
    """
    value, weight, species = F.col("__value"), F.col("trip_catch"), F.col("trip_n_species")
    something = (weight != 0) | (species != 0)
    sold_for_nothing = F.col("trip_platform").isNotNull() & (weight != 0) & (F.col("trip_catch_use") != "food")
    valued = trips.withColumns(
        {
            "trip_value": F.when(value.isNull() & (weight == 0) & (species == 0), F.lit(0.0))
            .when(value > MAX_TRIP_VALUE, F.lit(None).cast("double"))
            .when((value == 0) & something, F.lit(None).cast("double"))
            .otherwise(value),
            "trip_value_flag": F.when(value.isNull() & something, "trip_value_not_recorded")
            .when(value > MAX_TRIP_VALUE, "trip_value__too_large")
            .when((value == 0) & sold_for_nothing, "trip_value__is_zero"),
        }
    )
    unweighed = F.col("trip_catch").isNull() & (F.col("trip_value") == 0)
    if catch_flag_mode not in ("reference", "before"):
        raise ValueError(f"unknown catch_flag_mode: {catch_flag_mode}")
    flag = F.when(unweighed, "trip_catch__not_properly_recorded") if catch_flag_mode == "before" else F.lit(None)
    return valued.withColumns(
        {
            "trip_catch_flag": flag.cast("string"),
            "trip_catch": F.when(unweighed, F.lit(0.0)).otherwise(F.col("trip_catch")),
        }
    )


# Order in which flags are written.
FLAG_ORDER = [
    "boat_imei_flag",
    "boat_registration_flag",
    "trip_duration_flag",
    "trip_date_flag",
    "trip_value_flag",
    "gear_mesh_size_flag",
    "species_flag",
    "trip_catch_flag",
    "fisher_number_flag",
]

TRIP_COLUMNS = [
    "trip_imei",
    "boat_registration",
    "trip_duration",
    "trip_platform",
    "trip_date",
    "recording_datetime",
    "gear_mesh_size",
    "fisher_number_men",
    "fisher_number_women",
    "fisher_number_children",
    "fisher_number_total",
    "record_device_id",
    "record_id",
    "trip_happiness",
    "boat_type",
    "trip_gear",
    "trip_habitat",
    "trip_landing_site",
    "trip_catch_use",
    "trip_n_species",
    "trip_catch",
    "trip_value",
    "flags",
]


def clean_trips(
    survey: DataFrame,
    catch: DataFrame,
    boats: DataFrame,
    catch_flag_mode: str = "reference",
    broadcast_rows: int = BROADCAST_ROWS,
    n_top_species: int | None = None,
) -> DataFrame:
    """Survey, catch lines and boat registry to one row per landing (C4).

    An IMEI that is the ending of several registered devices gives one row for each.  With ``n_top_species`` the
    landings carry their species columns too, and ``widen_trip_catch`` need not read the lines again.
    """
    # Texts are parsed where they are read: the shuffle by record carries clean fields.
    parsed = clean_trip_fields(survey.select(*SURVEY_TRIP_COLUMNS))
    fields = match_imei(parsed, boats, broadcast_rows, "record_id")
    with_catch = fields.join(trip_catch(catch, n_top_species), "record_id", "left")
    flagged = value_rules(with_catch, catch_flag_mode)
    wide = [] if n_top_species is None else species_columns(n_top_species)
    return flagged.withColumn("flags", join_flags(*[F.col(c) for c in FLAG_ORDER])).select(*TRIP_COLUMNS, *wide)


def merge_trips(survey_trips: DataFrame, tracked_trips: DataFrame) -> DataFrame:
    """Full outer match of survey trips and tracked trips on device and local day."""
    return full_outer(
        survey_trips,
        tracked_trips.where(F.col("imei").isNotNull()),
        ["trip_imei", "trip_date"],
        ["imei", "trip_end_date_pds"],
        spread=["record_id"],
    )
