"""The driver's tables read as the inputs of the library.

Points come from ``events``, boats and stations from ``customer`` and ``supplier``, the
landing survey from ``orders``, ``lineitem`` and ``part``.  Missing and dirty values are
made by expressions on other columns.  All rows of every table are used: a line item whose order and line number
repeat goes to a record of its own, so each is one answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoalcast.functions.numeric import cube_root_units
from shoalcast.operators.aggregates import summarise_trips
from shoalcast.plans.activity import format_vessel_activity
from shoalcast.plans.catch import clean_catch, widen_trip_catch
from shoalcast.plans.points import latest_trip_per_day
from shoalcast.plans.prices import add_price_flags, species_price_draws
from shoalcast.plans.trips import clean_trips
from shoalcast.session import cut_lineage, drop_written

BINS = ["0_10", "10_20", "20_30", "30_40", "over60"]
GROUPS = range(1, 8)
OUTAGE_DAYS = ["2024-01-09", "2024-01-17"]
GEAR_OF_PRIORITY = {
    "1-URGENT": "GN",
    "2-HIGH": "HL",
    "3-MEDIUM": "LL",
    "4-NOT SPECIFIED": "SN",
    "5-LOW": "MC",
}
DRAWS = 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def device_digits(key: Column) -> Column:
    return (key * 7919 + 12345).cast("string")


def imei(key: Column) -> Column:
    return F.concat(F.lit("35"), F.lpad(device_digits(key), 13, "0"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    day = F.to_date("ts")
    lost = day.isin([F.lit(d).cast("date") for d in OUTAGE_DAYS]) & (F.col("event_type") == "error")
    return events.select(
        F.col("ts").cast("timestamp").alias("time"),
        F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd")).alias("trip"),
        F.col("event_type").alias("boat"),
        F.concat(F.lit("boat "), F.col("event_type")).alias("boat_name"),
        F.concat(F.lit("k"), F.regexp_extract("props", "[0-9]+", 0)).alias("community"),
        F.col("value").alias("range_meters"),
        F.when(~lost, imei(F.col("user_id"))).alias("imei"),
        day.alias("day"),
    )


def boat_code(segment: Column) -> Column:
    return F.when(segment.isin("HOUSEHOLD", "FURNITURE", "BUILDING"), F.lit("1")).otherwise(F.lit("2"))


def boats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry: customers, and suppliers as second boats of the same devices."""
    nation = table(spark, sf_dir, "nation")
    installed = lambda bal: F.when(
        bal >= 0, F.date_add(F.lit("2023-12-25").cast("date"), F.floor(bal / 500).cast("int"))
    )
    first = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("boat_id"),
        imei(F.col("c_custkey")).alias("imei"),
        boat_code(F.col("c_mktsegment")).alias("boat_code"),
        F.col("c_nationkey").alias("n_nationkey"),
        installed(F.col("c_acctbal")).alias("installation_date"),
    )
    second = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("boat_id"),
        imei(F.col("s_suppkey")).alias("imei"),
        F.lit("2").alias("boat_code"),
        F.col("s_nationkey").alias("n_nationkey"),
        installed(F.col("s_acctbal")).alias("installation_date"),
    )
    return first.unionByName(second).join(nation, "n_nationkey").select(
        "boat_id", "imei", F.col("imei").alias("imei_long"), "boat_code", F.col("n_name").alias("municipality_name"),
        "installation_date",
    )


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_add(F.lit("2024-01-25").cast("date"), F.floor(F.col("c_acctbal") / 1000).cast("int"))
    return table(spark, sf_dir, "customer").select(
        imei(F.col("c_custkey")).alias("imei"), (day.cast("timestamp") + F.expr("interval 20 hours")).alias("last_seen")
    )


def municipalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = boat_code(F.col("c_mktsegment"))
    counts = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.count_if(code == "1").alias("canoes"), F.count_if(code == "2").alias("motors")
    )
    return table(spark, sf_dir, "nation").join(counts, "n_nationkey").select(
        F.col("n_nationkey").cast("string").alias("municipality_code"),
        F.col("n_name").alias("municipality_name"),
        "canoes",
        "motors",
        (F.col("canoes") + F.col("motors")).alias("fishers"),
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").cast("string").alias("station_code"),
        F.col("n_nationkey").cast("string").alias("municipality_code"),
        F.col("n_name").alias("municipality_name"),
    )


def species_code() -> Column:
    return (
        F.when(F.col("p_size") == 50, "0")
        .when(F.col("p_size") == 49, "99")
        .when(F.col("p_size") == 48, F.lit(None).cast("string"))
        .when(F.col("p_type") == "ECONOMY", "45")
        .when(F.col("p_type") == "SMALL", "24")
        .when(F.col("p_type") == "MEDIUM", "50")
        .otherwise(F.regexp_extract("p_brand", "[0-9]+", 0))
    )


def species(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = table(spark, sf_dir, "part").withColumn("species_code", species_code())
    half = F.col("species_code").cast("double") / 2
    return (
        coded.where(F.col("species_code").isNotNull() & (F.col("species_code") != "99"))
        .groupBy("species_code")
        .agg((F.min("p_retailprice") / 99991).alias("a"), F.min("p_type").alias("category"))
        .select(
            "species_code", "a", F.lit(3.0).alias("b"), half.alias("minlength"), (half + 20).alias("maxlength"), "category"
        )
    )


# What tells line items of one order and number apart.
REPEATS = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def record_id(key: Column) -> Column:
    """The order's key, with the occurrence behind it from the second on."""
    return F.concat_ws("-", key.cast("string"), F.when(F.col("occurrence") > 1, F.col("occurrence").cast("string")))


def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their occurrence among those of one order and line number, use (1 food, 2 sale) and count."""
    discount, tax, quantity = F.col("l_discount"), F.col("l_tax"), F.col("l_quantity")
    count = (
        F.when((discount > 0.095) & (tax > 0.075), -quantity)
        .when((discount < 0.005) & (tax < 0.005), F.lit(30000.0))
        .when((discount > 0.045) & (discount < 0.055), F.lit(0.0))
        .when(~((discount > 0.085) & (discount < 0.095)), quantity)
    )
    # The occurrence is told among the lines of an order.
    return table(spark, sf_dir, "lineitem").repartition("l_orderkey").select(
        "l_orderkey",
        "l_linenumber",
        F.row_number().over(Window.partitionBy("l_orderkey", "l_linenumber").orderBy(*REPEATS)).alias("occurrence"),
        "l_partkey",
        F.when(F.col("l_returnflag") == "R", 2).when(F.col("l_returnflag") == "A", 1).alias("use"),
        count.alias("n"),
    )


def repeated_lines(spark: SparkSession, sf_dir: str, numbered: DataFrame | None = None) -> DataFrame:
    """Orders in which a line number repeats, with how often the commonest does; a small table, written once.

    Read from ``numbered`` lines, where they are at hand, these need not be counted.
    """
    if numbered is not None:
        repeats = numbered.where(F.col("occurrence") > 1).groupBy("l_orderkey").agg(F.max("occurrence").alias("most"))
        return cut_lineage(repeats)
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))
    return cut_lineage(lines.where(F.col("n") > 1).groupBy("l_orderkey").agg(F.max("n").cast("int").alias("most")))


def line_answers(spark: SparkSession, sf_dir: str, numbered: DataFrame | None = None) -> DataFrame:
    """Line items as raw survey answers, still as numbers: species code, use, length, bin, count."""
    part = table(spark, sf_dir, "part").select(
        "p_partkey",
        species_code().cast("int").alias("species"),
        F.when(F.col("p_size") >= 45, F.col("p_size") + 25).alias("length"),
        F.least(F.floor(F.col("p_size") / 10), F.lit(4)).cast("int").alias("bin"),
    )
    lines = numbered_lines(spark, sf_dir) if numbered is None else numbered
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).drop("l_partkey", "p_partkey")


def survey_groups(spark: SparkSession, sf_dir: str, answers: DataFrame | None = None) -> DataFrame:
    """The repeated group as wide text columns: one aggregation by record."""
    cells, texts = [], []
    for i in GROUPS:
        here = F.col("l_linenumber") == i
        stem = f"species_group_{i - 1}_species_group_"
        cells += [F.max(F.when(here, F.col(c))).alias(f"{c}_{i}") for c in ("species", "use", "length")]
        cells += [F.sum(F.when(here & (F.col("bin") == j), F.col("n"))).alias(f"n_{i}_{j}") for j in range(len(BINS))]
        texts.append(F.col(f"species_{i}").cast("string").alias(stem + "species"))
        texts.append(F.when(F.col(f"use_{i}") == 2, "sale").when(F.col(f"use_{i}") == 1, "food").alias(stem + "food_or_sale"))
        texts.append(F.col(f"length_{i}").cast("string").alias(stem + "no_fish_by_length_group_fish_length_over60"))
        texts += [
            F.col(f"n_{i}_{j}").cast("string").alias(f"{stem}no_fish_by_length_group_no_individuals_{b}")
            for j, b in enumerate(BINS)
        ]
    # Dealt by record once: the record's groups and its catch lines both follow from it.
    lines = line_answers(spark, sf_dir) if answers is None else answers
    dealt = lines.withColumn("uuid", record_id(F.col("l_orderkey"))).repartition("uuid")
    return dealt.groupBy("uuid", "l_orderkey", "occurrence").agg(*cells).select("uuid", *texts)


def months(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """First and last day with an order."""
    day = F.to_date("o_orderdate").cast("string")
    return tuple(table(spark, sf_dir, "orders").agg(F.min(day), F.max(day)).first())


def survey_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The survey's trip questions; what the trip cleaning reads of a survey file."""
    return order_fields(table(spark, sf_dir, "orders").withColumn("uuid", F.col("o_orderkey").cast("string")))


def order_fields(orders: DataFrame) -> DataFrame:
    """Orders with a ``uuid`` as answers to the trip questions."""
    status, priority, key = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_custkey")
    rank = F.substring(priority, 1, 1)
    day = F.to_date("o_orderdate")
    padded = F.lpad(key.cast("string"), 12, "0")
    digits = device_digits(key)
    shift = F.when(rank == "1", 2).when(rank == "2", 0).when(rank == "3", -10).when(rank == "4", -30).otherwise(-29)
    hours = F.floor(F.col("o_totalprice") / 5000).cast("string")
    no_text = F.lit(None).cast("string")
    return orders.select(
        "uuid",
        F.concat(day.cast("string"), F.when(rank == "1", " 14:00:00").otherwise(" 15:30:00")).alias("end"),
        F.date_add(day, shift).cast("string").alias("date"),
        key.cast("string").alias("deviceid"),
        key.cast("string").alias("landing_site_name"),
        F.when((rank == "3") & (status == "P"), no_text)
        .when((rank == "2") & (status == "P"), "0")
        .otherwise((F.col("o_totalprice") / 25).cast("string"))
        .alias("total_catch_value"),
        rank.alias("happiness_rating"),
        F.when(status == "F", F.concat(F.lit("-"), digits))
        .when(status == "O", digits)
        .when(rank != "5", F.right(digits, F.lit(5)))
        .alias("trip_group_imei"),
        F.when(rank == "5", no_text)
        .when(status == "F", F.concat(F.lit("ab"), F.right(padded, F.lit(3)), F.lit(" cd")))
        .when(status == "O", F.concat(F.lit("ABC "), F.right(padded, F.lit(2))))
        .otherwise(F.concat(F.lit("a"), F.right(padded, F.lit(2))))
        .alias("trip_group_boat_reg_no"),
        F.when(status == "F", "1").when(status == "O", "2").alias("trip_group_boat_type"),
        F.when((rank == "3") & (status == "F"), "x")
        .when(rank == "2", F.concat(F.lit("-"), hours))
        .otherwise(hours)
        .alias("trip_group_duration"),
        gear_of(priority).alias("trip_group_gear_type"),
        priority.alias("trip_group_habitat_boat"),
        F.when(status == "F", "TRUE").when(status == "O", "True").when(rank <= "3", "FALSE").otherwise("1")
        .alias("trip_group_has_boat"),
        F.when(rank <= "2", "seluk").when(rank == "3", "3").alias("trip_group_mesh_size"),
        F.when(rank == "1", "2.5").when(rank == "2", "x").when(rank == "5", "1e1").alias("trip_group_mesh_size_other"),
        (rank.cast("int") - 1).cast("string").alias("trip_group_no_fishers_no_men_fishers"),
        F.when(status == "F", "1").when(status == "O", "0").alias("trip_group_no_fishers_no_women_fishers"),
        F.lit("0").alias("trip_group_no_fishers_no_child_fishers"),
    )


def survey_records(spark: SparkSession, sf_dir: str, numbered: DataFrame | None = None) -> DataFrame:
    """The trip questions of every record: an order's, and once more for each further occurrence of its lines.

    Orders are dealt by record before their answers are spelled out and parsed: the shuffle carries six short columns.
    """
    most = repeated_lines(spark, sf_dir, numbered).select(F.col("l_orderkey").cast("string").alias("uuid"), "most")
    orders = table(spark, sf_dir, "orders").withColumn("uuid", F.col("o_orderkey").cast("string")).join(most, "uuid", "left")
    each = orders.withColumn("occurrence", F.explode(F.sequence(F.lit(1), F.coalesce("most", F.lit(1)))))
    return order_fields(each.withColumn("uuid", record_id(F.col("uuid"))).drop("o_orderkey", "most", "occurrence").repartition("uuid"))


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All survey columns, as in one wide file."""
    return survey_records(spark, sf_dir).join(survey_groups(spark, sf_dir), "uuid", "left")


def order_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as placed trips with cube-root catch and value, for the estimators."""
    weight = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg((F.sum("l_extendedprice") / 1000).alias("kg"))
    status = F.col("o_orderstatus")
    day = F.to_date("o_orderdate")
    orders = table(spark, sf_dir, "orders").join(weight, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    placed = orders.join(
        stations(spark, sf_dir), F.col("o_custkey").cast("string") == F.col("station_code")
    )
    return placed.select(
        F.col("o_orderkey").cast("string").alias("record_id"),
        "municipality_name",
        F.when(status == "F", "1").when(status == "O", "2").alias("boat_type"),
        gear_of(F.col("o_orderpriority")).alias("trip_gear"),
        F.trunc(day, "month").alias("period_static"),
        F.month(day).cast("string").alias("period_seasonal"),
        cube_root_units(F.coalesce("kg", F.lit(0.0))).alias("trip_catch_po_3"),
        cube_root_units(F.col("o_totalprice") / 1000).alias("trip_value_po_3"),
    ).where(F.col("boat_type").isNotNull())


def survey_as_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The survey fields the gear model reads, under their clean names."""
    return survey_fields(spark, sf_dir).select(
        F.col("uuid").alias("record_id"),
        F.col("date").cast("date").alias("trip_date"),
        F.col("landing_site_name").alias("trip_landing_site"),
        F.col("trip_group_gear_type").alias("trip_gear"),
        F.col("trip_group_boat_type").alias("boat_type"),
    )


def catch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_catch(survey_groups(spark, sf_dir), species(spark, sf_dir))


def trips_and_catch(spark: SparkSession, sf_dir: str, n_top_species: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Clean trips and catch lines.

    Line items are numbered and meet their parts in steps that are written, so that the shuffles of a step are gone
    when the next begins.  Catch lines lie by record, so what is made of them by record needs no further shuffle.
    """
    numbered = cut_lineage(numbered_lines(spark, sf_dir))
    records = survey_records(spark, sf_dir, numbered)
    answers = cut_lineage(line_answers(spark, sf_dir, numbered))
    drop_written(numbered)
    lines = clean_catch(survey_groups(spark, sf_dir, answers), species(spark, sf_dir))
    return clean_trips(records, lines, boats(spark, sf_dir), n_top_species=n_top_species), lines


def wide_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with their species columns; both come from one reading of the catch lines."""
    trips, _ = trips_and_catch(spark, sf_dir, n_top_species=2)
    return widen_trip_catch(trips)


def tracked_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_trip_per_day(summarise_trips(points(spark, sf_dir)))


def flagged_trips(spark: SparkSession, sf_dir: str, draws: int = DRAWS) -> DataFrame:
    """Trips with price flags; the wide trips feed both the price model and the flags."""
    wide = cut_lineage(wide_trips(spark, sf_dir))
    estimates, overall = species_price_draws(boat_trips(wide), draws, "md5")
    return add_price_flags(wide, estimates, overall, draws)


def boat_trips(wide: DataFrame) -> DataFrame:
    return wide.where(F.col("trip_platform") == "boat")


def panel(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    trips = cut_lineage(tracked_trips(spark, sf_dir))
    return format_vessel_activity(trips, boats(spark, sf_dir), devices(spark, sf_dir), **options)


def gear_of(priority: Column) -> Column:
    out = None
    for name, gear in GEAR_OF_PRIORITY.items():
        out = F.when(priority == name, gear) if out is None else out.when(priority == name, gear)
    return out


def order_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity cells from orders: a boat is a customer and status, a trip an order."""
    orders = table(spark, sf_dir, "orders").join(
        stations(spark, sf_dir), F.col("o_custkey").cast("string") == F.col("station_code")
    )
    month = F.trunc(F.to_date("o_orderdate"), "month")
    code = F.when(F.col("o_orderstatus") == "F", "1").when(F.col("o_orderstatus") == "O", "2")
    cells = orders.withColumns({"period_static": month, "boat_code": code}).where(F.col("boat_code").isNotNull())
    return (
        cells.withColumns(
            {
                "individual_boat": F.concat_ws(" ", F.col("o_custkey").cast("string"), "boat_code"),
                "period_seasonal": F.month("period_static").cast("string"),
            }
        )
        .groupBy("period_static", "individual_boat", "boat_code", "municipality_name", "period_seasonal")
        .agg(F.count(F.lit(1)).cast("double").alias("n_trips"))
        .withColumn("n_days", F.day(F.last_day("period_static")).cast("long"))
    )
