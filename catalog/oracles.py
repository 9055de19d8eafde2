"""The SQL twin of each query, written for DuckDB on the same tables."""

from __future__ import annotations

from catalog.standins import DRAWS, GROUPS
from shoalcast.functions.flags import PRICE_FLAGS
from shoalcast.operators.draws import POISSON_CUTS
from shoalcast.schemas import GEARS

ORACLES: dict[str, str] = {}
LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"


def imei(key: str) -> str:
    return f"'35' || lpad(CAST({key} * 7919 + 12345 AS VARCHAR), 13, '0')"


def local(ts: str) -> str:
    """Local day of the events, all later than the zone's change from +8 to +9 hours in 2000."""
    return f"CAST({ts} + INTERVAL 9 HOUR AS DATE)"


# Stand-in inputs, as a chain of common table expressions.
BOAT_CODE = "CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE', 'BUILDING') THEN '1' ELSE '2' END"
SPECIES = """CASE WHEN p_size = 50 THEN 0 WHEN p_size = 49 THEN 99 WHEN p_size = 48 THEN NULL
    WHEN p_type = 'ECONOMY' THEN 45 WHEN p_type = 'SMALL' THEN 24 WHEN p_type = 'MEDIUM' THEN 50
    ELSE CAST(regexp_extract(p_brand, '[0-9]+') AS INT) END"""
RECORD = "CAST({0} AS VARCHAR) || CASE WHEN occurrence > 1 THEN '-' || occurrence ELSE '' END"
GEAR = """CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'GN' WHEN '2' THEN 'HL' WHEN '3' THEN 'LL'
    WHEN '4' THEN 'SN' ELSE 'MC' END"""

CTES = {
    "pts": f"""SELECT ts AS time, user_id || '-' || strftime(ts, '%Y%m%d') AS trip, event_type AS boat,
        'boat ' || event_type AS boat_name, 'k' || regexp_extract(props, '[0-9]+') AS community, value AS range_meters,
        CASE WHEN NOT (CAST(ts AS DATE) IN (DATE '2024-01-09', DATE '2024-01-17') AND event_type = 'error')
          THEN {imei('user_id')} END AS imei, CAST(ts AS DATE) AS day FROM events""",
    "trp": """SELECT trip, min(time) AS start, max(time) AS "end", max(range_meters) AS "range",
        first(boat ORDER BY time, boat) AS boat_id, first(boat_name ORDER BY time, boat) AS boat_name,
        first(community ORDER BY time, boat) AS community, first(imei ORDER BY time, boat) AS imei, day
        FROM pts GROUP BY day, trip""",
    "tracked": f"""SELECT * EXCLUDE (rn) FROM (SELECT trip AS trip_id_pds, start, "end", "range", boat_id AS boat_id_pds,
        boat_name, community, imei, day AS download_date_pds, {local('"end"')} AS trip_end_date_pds,
        {local('start')} AS trip_start_date_pds, row_number() OVER (PARTITION BY imei, {local('"end"')}, day
        ORDER BY "end" DESC, trip) AS rn FROM trp) WHERE rn = 1""",
    "boats": f"""SELECT boat_id, imei, boat_code, n_name AS municipality_name,
        CASE WHEN bal >= 0 THEN DATE '2023-12-25' + CAST(floor(bal / 500) AS INT) END AS installation_date FROM (
        SELECT c_name AS boat_id, {imei('c_custkey')} AS imei, {BOAT_CODE} AS boat_code, c_nationkey AS nk, c_acctbal AS bal
        FROM customer UNION ALL
        SELECT s_name, {imei('s_suppkey')}, '2', s_nationkey, s_acctbal FROM supplier) JOIN nation ON nk = n_nationkey""",
    "devices": f"""SELECT {imei('c_custkey')} AS imei, CAST(DATE '2024-01-25' + CAST(floor(c_acctbal / 1000) AS INT)
        AS TIMESTAMP) + INTERVAL 20 HOUR AS last_seen FROM customer""",
    "muni": f"""SELECT n_name AS municipality_name, count(*) FILTER (bc = '1') AS canoes, count(*) FILTER (bc = '2') AS motors
        FROM (SELECT c_nationkey, {BOAT_CODE} AS bc FROM customer) JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
    "stations": """SELECT CAST(c_custkey AS VARCHAR) AS station_code, n_name AS municipality_name
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "species": f"""SELECT CAST(code AS VARCHAR) AS species_code, min(p_retailprice) / 99991 AS a, 3.0::DOUBLE AS b,
        code / 2.0::DOUBLE AS minlength, code / 2.0::DOUBLE + 20 AS maxlength FROM (SELECT *, {SPECIES} AS code FROM part)
        WHERE code IS NOT NULL AND code <> 99 GROUP BY code""",
    "answers": f"""SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey,
          l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS occurrence, {SPECIES} AS species, CASE WHEN p_size >= 45 THEN p_size + 25 END AS length,
        least(p_size // 10, 4) AS bin, CASE l_returnflag WHEN 'R' THEN 2 WHEN 'A' THEN 1 END AS use,
        CASE WHEN l_discount > 0.095 AND l_tax > 0.075 THEN -l_quantity WHEN l_discount < 0.005 AND l_tax < 0.005 THEN 30000.0
          WHEN l_discount > 0.045 AND l_discount < 0.055 THEN 0.0
          WHEN NOT (l_discount > 0.085 AND l_discount < 0.095) THEN l_quantity END AS n
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "grp": f"""SELECT {RECORD.format('l_orderkey')} AS record_id, CAST(l_linenumber - 1 AS VARCHAR) AS record,
        CAST(max(species) AS VARCHAR) AS species_code, CASE max(use) WHEN 2 THEN 'sale' WHEN 1 THEN 'food' END AS use,
        CAST(max(length) AS DOUBLE) AS length, """
    + ", ".join(f"sum(n) FILTER (bin = {j}) AS n{j}" for j in range(5))
    + """, sum(n) AS total FROM answers GROUP BY l_orderkey, occurrence, l_linenumber""",
    "lines": " UNION ALL ".join(
        f"""SELECT record_id, record, species_code, use, 'no_fish_by_length_group_no_individuals_{name}' AS question,
        {f'coalesce(length, 60.0)' if name == 'over60' else f'{mid}::DOUBLE'} AS mean_length, n{j} AS n, total FROM grp
        WHERE coalesce(species_code, use, CAST(coalesce(length, n0, n1, n2, n3, n4) AS VARCHAR)) IS NOT NULL
        AND (n{j} IS NOT NULL{' OR total IS NULL' if j == 0 else ''})"""
        for j, (name, mid) in enumerate([("0_10", 5.0), ("10_20", 15.0), ("20_30", 25.0), ("30_40", 35.0), ("over60", 60.0)])
    ),
    "cleaned": """SELECT l.*, a, b, minlength, maxlength,
        CASE WHEN n > exp(10) THEN 'species_number__too_large' WHEN n < 0 THEN 'species_number__negative'
          WHEN total = 0 AND species_code <> '0' THEN 'species_number__zero'
          WHEN total IS NULL AND species_code <> '0' THEN 'species_number__not_recorded' END AS n_individuals_flag,
        CASE WHEN n > exp(10) THEN NULL WHEN n < 0 THEN -n WHEN total = 0 AND species_code <> '0' THEN NULL ELSE n END
          AS n_individuals FROM lines l LEFT JOIN species USING (species_code)""",
    "flagged_lines": """SELECT *, CASE WHEN n_individuals > 0 AND mean_length - 2.5 > maxlength THEN 'species_size__too_large'
          WHEN n_individuals > 0 AND mean_length + 2.5 < minlength THEN 'species_size__too_small' END AS size_flag,
        n_individuals * CASE species_code WHEN '45' THEN 0.05 WHEN '24' THEN 1.0 WHEN '50' THEN 0.006
          ELSE a * pow(mean_length, b) / 1000 END AS weight FROM cleaned""",
    "catch": """SELECT record_id, species_code, use,
        CASE WHEN count(*) FILTER (mean_length IS NULL AND n_individuals <> 0) = 0 THEN
          round_even(sum(CASE WHEN n_individuals <> 0 THEN mean_length * n_individuals ELSE 0 END) / nullif(sum(n_individuals), 0), 1)
          END AS mean_length, sum(n_individuals) AS n_individuals, sum(weight) AS weight,
        nullif(array_to_string(list_sort(list_distinct(list(n_individuals_flag) || list(size_flag))), ';'), '') AS species_flags
        FROM flagged_lines GROUP BY ALL""",
    "trip_catch": """SELECT record_id, CASE WHEN count(DISTINCT use) = 1 AND count(use) = count(*) THEN max(use)
          WHEN count(use) > 0 THEN 'both' END AS trip_catch_use,
        count(DISTINCT species_code) FILTER (species_code <> '0') AS trip_n_species,
        CASE WHEN sum(weight) IS NULL AND count(DISTINCT species_code) FILTER (species_code <> '0') = 0 THEN 0 ELSE sum(weight) END
          AS trip_catch, nullif(array_to_string(list_sort(list_distinct(flatten(list(
          coalesce(string_split(species_flags, ';'), []))))), ';'), '') AS species_flag FROM catch GROUP BY record_id""",
    "fields": """SELECT *, 1 AS occurrence, substr(o_orderpriority, 1, 1) AS r, o_orderstatus AS s, CAST(o_orderdate AS DATE) AS d,
        o_custkey * 7919 + 12345 AS dg FROM orders""",
    "records": """SELECT f.* REPLACE (coalesce(a.occurrence, 1) AS occurrence) FROM fields f
        LEFT JOIN (SELECT DISTINCT l_orderkey, occurrence FROM answers) a ON o_orderkey = l_orderkey""",
    "typed": f"""SELECT {RECORD.format('o_orderkey')} AS record_id, CAST(o_custkey AS VARCHAR) AS record_device_id,
        CAST(o_custkey AS VARCHAR) AS trip_landing_site,
        s IN ('F', 'O') OR r <> '5' AS imei_typed,
        CASE WHEN s IN ('F', 'O') THEN dg WHEN r <> '5' THEN CAST(right(CAST(dg AS VARCHAR), 5) AS BIGINT) END AS imei_number,
        CASE WHEN r = '5' THEN NULL WHEN s = 'F' THEN 'AB ' || right(lpad(CAST(o_custkey AS VARCHAR), 12, '0'), 3) || ' CD'
          WHEN s = 'O' THEN 'ABC ' || right(lpad(CAST(o_custkey AS VARCHAR), 12, '0'), 2) || ' ' END AS boat_registration,
        CASE WHEN r <> '5' AND s = 'P' THEN 'boat_registration__invalid' END AS registration_flag,
        CASE WHEN r = '3' AND s = 'F' THEN NULL ELSE floor(o_totalprice / 5000) END AS hours,
        CASE WHEN s IN ('F', 'O') THEN 'boat' WHEN r <= '3' THEN 'land' END AS trip_platform,
        d + CASE r WHEN '1' THEN 2 WHEN '2' THEN 0 WHEN '3' THEN -10 WHEN '4' THEN -30 ELSE -29 END AS trip_date,
        CASE WHEN r = '1' OR d < DATE '2000-09-17' THEN d ELSE d + 1 END AS recorded,
        CAST(d AS TIMESTAMP) + CASE WHEN r = '1' THEN INTERVAL '14 hours' ELSE INTERVAL '930 minutes' END AS recording_datetime,
        CASE r WHEN '1' THEN 2.5::DOUBLE WHEN '3' THEN 3.0 END AS gear_mesh_size,
        CASE WHEN r = '2' THEN 'gear_mesh_size__invalid' END AS mesh_flag,
        CAST(r AS DOUBLE) - 1 AS fisher_number_men, CASE s WHEN 'F' THEN 1.0::DOUBLE WHEN 'O' THEN 0.0 END AS fisher_number_women,
        0.0::DOUBLE AS fisher_number_children, CAST(r AS DOUBLE) AS trip_happiness,
        CASE s WHEN 'F' THEN '1' WHEN 'O' THEN '2' END AS boat_type, {GEAR} AS trip_gear, o_orderpriority AS trip_habitat,
        CASE WHEN r = '3' AND s = 'P' THEN NULL WHEN r = '2' AND s = 'P' THEN 0 ELSE o_totalprice / 25 END AS val FROM fields""",
    "matched": """SELECT t.*, imei AS trip_imei, CASE WHEN imei IS NULL AND imei_typed THEN 'imei__not_found' END AS imei_flag,
        CASE WHEN hours <> 0 AND hours <= 72 THEN hours END AS trip_duration,
        CASE WHEN hours = 0 THEN 'trip_duration__zero_hours' WHEN hours IS NULL OR hours > 72 THEN 'trip_duration__too_long' END
          AS duration_flag,
        CASE WHEN trip_date > recorded THEN 'trip_date__trip_is_in_future'
          WHEN trip_date < recorded - 30 THEN 'trip_date__trip_date_too_old' END AS date_flag,
        nullif(fisher_number_men + fisher_number_women + fisher_number_children, 0) AS fisher_number_total,
        CASE WHEN fisher_number_men + fisher_number_women + fisher_number_children = 0 AND trip_platform IS NOT NULL
          THEN 'fisher_number__zero_fishers' END AS crew_flag,
        trip_catch_use, trip_n_species, trip_catch AS catch0, species_flag
        FROM typed_records t LEFT JOIN (SELECT DISTINCT imei FROM boats) bt
          ON imei_number >= 9999 AND suffix(imei, CAST(imei_number AS VARCHAR))
        LEFT JOIN trip_catch c ON t.record_id = c.record_id""",
    "valued": """SELECT *, CASE WHEN val IS NULL AND catch0 = 0 AND trip_n_species = 0 THEN 0 WHEN val > 20000 THEN NULL
          WHEN val = 0 AND (catch0 <> 0 OR trip_n_species <> 0) THEN NULL ELSE val END AS trip_value,
        CASE WHEN val IS NULL AND (catch0 <> 0 OR trip_n_species <> 0) THEN 'trip_value_not_recorded'
          WHEN val > 20000 THEN 'trip_value__too_large'
          WHEN val = 0 AND trip_platform IS NOT NULL AND catch0 <> 0 AND trip_catch_use <> 'food' THEN 'trip_value__is_zero'
          END AS value_flag FROM matched""",
    "trips": """SELECT *, CASE WHEN catch0 IS NULL AND trip_value = 0 THEN 0 ELSE catch0 END AS trip_catch,
        nullif(concat_ws(';', imei_flag, registration_flag, duration_flag, date_flag, value_flag, mesh_flag, species_flag,
          crew_flag), '') AS flags FROM valued""",
    "ranked": """SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY weight DESC NULLS LAST,
        species_code NULLS LAST, use NULLS LAST) AS rk FROM catch""",
    "wide": """SELECT record_id, CASE WHEN count(*) FILTER (rk = 1) = 0 THEN 'none' ELSE max(species_code) FILTER (rk = 1) END
          AS species_code_1, coalesce(sum(weight) FILTER (rk = 1), 0) AS weight_1,
        CASE WHEN count(*) FILTER (rk = 2) = 0 THEN 'none' ELSE max(species_code) FILTER (rk = 2) END AS species_code_2,
        coalesce(sum(weight) FILTER (rk = 2), 0) AS weight_2,
        CASE WHEN count(*) FILTER (rk > 2) = 0 THEN 'none' WHEN count(*) FILTER (rk > 2) > 1 THEN 'other'
          ELSE max(species_code) FILTER (rk > 2) END AS species_code_other,
        coalesce(sum(weight) FILTER (rk > 2), 0) AS weight_other FROM ranked GROUP BY record_id""",
    "wide_trips": """SELECT t.*, CASE WHEN trip_catch <> 0 THEN trip_value / trip_catch END AS trip_price,
        species_code_1, weight_1, species_code_2, weight_2, species_code_other, weight_other
        FROM trips t LEFT JOIN wide w ON t.record_id = w.record_id""",
    # Vessel activity
    "one_trip": """SELECT * FROM tracked WHERE imei IS NOT NULL QUALIFY row_number() OVER (PARTITION BY trip_id_pds
        ORDER BY "end" DESC, download_date_pds) = 1""",
    "registry_size": "SELECT imei, count(*) AS n FROM boats GROUP BY imei",
    "earlier": """SELECT t.trip_id_pds, b.boat_code, b.municipality_name FROM one_trip t JOIN boats b USING (imei)
        WHERE b.installation_date < t.trip_end_date_pds QUALIFY row_number() OVER (PARTITION BY t.trip_id_pds
        ORDER BY b.installation_date DESC, b.boat_code, b.municipality_name) = 1""",
    "assigned": """SELECT t.*, CASE WHEN z.n = 1 THEN b.boat_code ELSE e.boat_code END AS boat_code,
        CASE WHEN z.n = 1 THEN b.municipality_name ELSE e.municipality_name END AS municipality_name
        FROM one_trip t LEFT JOIN registry_size z USING (imei) LEFT JOIN boats b ON z.n = 1 AND b.imei = t.imei
        LEFT JOIN earlier e USING (trip_id_pds) WHERE z.n IS NULL OR z.n = 1 OR e.trip_id_pds IS NOT NULL""",
    "signs": f"""SELECT imei, boat_id_pds, boat_code, municipality_name, trip_start_date_pds, trip_end_date_pds, trip_id_pds,
        NULL::BOOLEAN AS last_seen FROM assigned QUALIFY row_number() OVER (PARTITION BY imei, boat_id_pds, trip_end_date_pds
        ORDER BY "end" DESC, trip_id_pds) = 1
        UNION ALL SELECT imei, NULL, NULL, NULL, NULL, {local('last_seen')}, NULL, TRUE FROM devices""",
    "filled": """SELECT imei, trip_start_date_pds, trip_end_date_pds, trip_id_pds, last_seen,
        """
    + ", ".join(
        f"last_value({c} IGNORE NULLS) OVER w AS {c}" for c in ("boat_id_pds", "boat_code", "municipality_name")
    )
    + """ FROM signs WINDOW w AS (PARTITION BY imei ORDER BY trip_end_date_pds, coalesce(last_seen, FALSE),
        boat_id_pds NULLS FIRST ROWS UNBOUNDED PRECEDING)""",
    "kept": "SELECT * FROM filled WHERE boat_code IS NOT NULL",
    "spans": """SELECT DISTINCT imei, boat_id_pds, boat_code, municipality_name,
        min(trip_end_date_pds) OVER (PARTITION BY imei, boat_id_pds) AS lo,
        max(trip_end_date_pds) OVER (PARTITION BY imei, boat_id_pds) AS hi FROM kept""",
    "days": """SELECT imei, boat_id_pds, boat_code, municipality_name,
        CAST(unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS day FROM spans""",
    "outages": """SELECT DISTINCT unnest([download_date_pds, download_date_pds - 1]) AS day FROM tracked WHERE imei IS NULL""",
    "panel": """SELECT g.imei, g.boat_id_pds, g.boat_code, g.municipality_name, k.trip_start_date_pds, g.day AS trip_end_date_pds,
        k.trip_id_pds, k.last_seen, coalesce(g.imei, 'NA') || ' ' || coalesce(g.boat_id_pds, 'NA') AS individual_boat,
        CASE WHEN k.trip_id_pds IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS trip_activity,
        CAST(date_trunc('month', g.day) AS DATE) AS period_static, CAST(month(g.day) AS VARCHAR) AS period_seasonal,
        strftime(g.day, '%a') AS wday FROM days g LEFT JOIN kept k ON g.imei = k.imei
        AND g.boat_id_pds IS NOT DISTINCT FROM k.boat_id_pds AND g.boat_code = k.boat_code
        AND g.municipality_name IS NOT DISTINCT FROM k.municipality_name AND g.day = k.trip_end_date_pds
        WHERE g.day NOT IN (SELECT day FROM outages)""",
    # Orders as placed trips
    "order_trips": f"""SELECT CAST(o_orderkey AS VARCHAR) AS record_id, municipality_name,
        CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '2' END AS boat_type, {GEAR} AS trip_gear,
        CAST(date_trunc('month', o_orderdate) AS DATE) AS period_static,
        CAST(month(o_orderdate) AS VARCHAR) AS period_seasonal,
        round_even(pow(coalesce(kg, 0) * 1000, 1.0::DOUBLE / 3.0), 0) AS trip_catch_po_3,
        round_even(pow(o_totalprice / 1000 * 1000, 1.0::DOUBLE / 3.0), 0) AS trip_value_po_3
        FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_extendedprice) / 1000 AS kg FROM lineitem GROUP BY 1)
        ON o_orderkey = l_orderkey JOIN stations ON CAST(o_custkey AS VARCHAR) = station_code WHERE o_orderstatus IN ('F', 'O')""",
    "order_cells": """SELECT period_static, individual_boat, boat_code, municipality_name,
        CAST(month(period_static) AS VARCHAR) AS period_seasonal, CAST(count(*) AS DOUBLE) AS n_trips,
        CAST(day(last_day(period_static)) AS BIGINT) AS n_days FROM (
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period_static, municipality_name,
        CASE o_orderstatus WHEN 'F' THEN '1' ELSE '2' END AS boat_code,
        o_custkey || ' ' || CASE o_orderstatus WHEN 'F' THEN '1' ELSE '2' END AS individual_boat
        FROM orders JOIN stations ON CAST(o_custkey AS VARCHAR) = station_code WHERE o_orderstatus IN ('F', 'O')) GROUP BY ALL""",
}

CTES["typed_records"] = CTES["typed"].replace("FROM fields", "FROM records")

# Kept as tables while a query runs: DuckDB 2.0 stops with an internal error when dictionary
# strings of the scan reach the draws.
STORED = {"stations", "order_trips"}

CHAINS = {
    "tracked": ["pts", "trp", "tracked"],
    "catch": ["species", "answers", "grp", "lines", "cleaned", "flagged_lines", "catch"],
}
CHAINS["trips"] = [*CHAINS["catch"], "boats", "trip_catch", "fields", "records", "typed_records", "matched", "valued", "trips"]
CHAINS["wide_trips"] = [*CHAINS["trips"], "ranked", "wide", "wide_trips"]
CHAINS["assigned"] = [*CHAINS["tracked"], "boats", "one_trip", "registry_size", "earlier", "assigned"]
CHAINS["panel"] = [
    *CHAINS["assigned"], "devices", "signs", "filled", "kept", "spans", "days", "outages", "panel",
]


def sql(select: str, *ctes: str, **extra: str) -> str:
    """WITH the named stand-ins (or chains of them), then extra expressions, then the select."""
    names: list[str] = []
    for cte in ctes:
        names += [n for n in CHAINS.get(cte, [cte]) if n not in names]
    parts = [f"{n} AS {'MATERIALIZED ' if n in STORED else ''}({CTES[n]})" for n in names]
    parts += [f"{n} AS ({body})" for n, body in extra.items()]
    return (f"WITH {', '.join(parts)} " if parts else "") + select


def oracle(name: str, select: str, *ctes: str, **extra: str) -> None:
    ORACLES["q_" + name] = sql(select, *ctes, **extra)


# Estimators ------------------------------------------------------------------------------


def poisson(u: str) -> str:
    whens = " ".join(f"WHEN {u} < {cut} THEN {k}" for k, cut in enumerate(POISSON_CUTS))
    return f"CAST(CASE {whens} ELSE {len(POISSON_CUTS)} END AS DOUBLE)"


def drawn(source: str, key: str) -> str:
    u = f"CAST(('0x' || substr(md5({key} || '-' || draw), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE"
    return f"""SELECT * FROM (SELECT s.* REPLACE (CAST(draw AS INT) AS draw), {poisson('u')} AS dw FROM (SELECT *, {u} AS u
        FROM (SELECT * FROM {source}), range(1, {DRAWS + 1}) t(draw)) s) WHERE dw > 0"""


def moments(source: str, keys: str, y: str, w: str = "1.0::DOUBLE") -> str:
    return f"""SELECT {keys}, n, sy / n AS mean, greatest(syy - sy * sy / n, 0) AS ss FROM (SELECT {keys}, sum({w}) AS n,
        sum({w} * {y}) AS sy, sum({w} * {y} * {y}) AS syy FROM {source} WHERE {y} IS NOT NULL GROUP BY {keys})"""


def mean_hyper(cells: str, by: str = "") -> str:
    head, tail = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return f"""SELECT {head}s / nn AS overall, CASE WHEN nn - j <> 0 THEN w / (nn - j) END AS vw,
        CASE WHEN j > 1 THEN greatest(((q - s * s / nn) / (j - 1) - CASE WHEN nn - j <> 0 THEN w / (nn - j) END)
          / ((nn - n2 / nn) / (j - 1)), 0) END AS vb
        FROM (SELECT {head}sum(n) AS nn, sum(n * n) AS n2, count(*) AS j, sum(n * mean) AS s, sum(n * mean * mean) AS q,
        sum(ss) AS w FROM {cells} WHERE n > 0 {tail})"""


def shrunk(cells: str, hyper: str, by: str = "") -> str:
    join = f"JOIN {hyper} USING ({by})" if by else f", {hyper}"
    return f"""SELECT {cells}.*, overall, overall + coalesce(CASE WHEN vb + vw / n <> 0 THEN vb / (vb + vw / n) END, 0)
        * (mean - overall) AS estimate FROM {cells} {join}"""


def rate_hyper(cells: str, by: str) -> str:
    return f"""SELECT {by}, overall, (1 - rho) / rho AS m FROM (SELECT {by}, k / nn AS overall,
        least(greatest(coalesce((msb - msw) / nullif(msb + (n0 - 1) * msw, 0), 1e-6), 1e-6), 1 - 1e-6) AS rho FROM (
        SELECT *, (q - k * k / nn) / nullif(j - 1, 0) AS msb, (k - q) / nullif(nn - j, 0) AS msw,
        (nn - n2 / nn) / nullif(j - 1, 0) AS n0 FROM (SELECT {by}, CAST(sum(n_days) AS DOUBLE) AS nn,
        sum(CAST(n_days AS DOUBLE) * n_days) AS n2, count(*) AS j, CAST(sum(n_trips) AS DOUBLE) AS k,
        sum(CAST(n_trips AS DOUBLE) * n_trips / n_days) AS q FROM {cells} WHERE n_days > 0 GROUP BY {by})))"""


def shrunk_rate(cells: str, hyper: str, by: str) -> str:
    return f"""SELECT {cells}.*, overall, (overall * m + n_trips) / (m + n_days) AS estimate
        FROM {cells} JOIN {hyper} USING ({by})"""


def rounds(digits: int, **columns: str) -> str:
    return ", ".join(f"round({expr}, {digits}) AS {name}" for name, expr in columns.items())


def same(digits: int, *names: str) -> str:
    return rounds(digits, **{n: n for n in names})


# Scans, points, scalar functions --------------------------------------------------------

oracle("points_to_trips", "SELECT * FROM trp", "pts", "trp")
oracle("latest_trip_per_day", "SELECT * FROM tracked", "tracked")
oracle(
    "latest_version",
    f"""SELECT {LINE}, "end" FROM (SELECT {LINE}, CASE WHEN l_linenumber <> 7 THEN strftime(l_shipdate, '%Y-%m-%d') END AS "end"
    FROM lineitem) QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY "end" DESC NULLS FIRST, l_partkey, l_suppkey,
    l_extendedprice, l_linenumber) = 1""",
)
oracle("time_filtered_scan", f"SELECT {LINE}, l_shipdate FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-09-02'")
oracle(
    "first_number",
    f"""SELECT {LINE}, CASE WHEN l_returnflag = 'R' THEN NULL WHEN l_returnflag = 'A' THEN 'about ' || l_quantity || ' km'
    ELSE l_quantity || 'km of 100' END AS raw, CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS distance FROM lineitem""",
)
oracle(
    "duration_seconds",
    f"""SELECT {LINE}, CASE WHEN l_returnflag = 'R' THEN floor(l_quantity / 7) * 3600 + l_linenumber * 60
    WHEN l_returnflag = 'A' THEN l_linenumber * 60.0::DOUBLE
    WHEN l_linestatus = 'F' THEN l_linenumber * 86400 + floor(l_quantity / 7) * 3600 END AS seconds FROM lineitem""",
)
oracle(
    "two_format_date",
    """SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS installation_date
    FROM orders""",
)
oracle("local_date", f"SELECT event_id, {local('ts')} AS local_day FROM events")
oracle(
    "period_features",
    """SELECT o_orderkey, day, day - CAST(dayofweek(day) AS INT) AS period_static,
    CAST((dayofyear(day) - 1) // 7 + 1 AS VARCHAR) AS period_seasonal, strftime(day, '%a') AS wday,
    CAST(date_trunc('month', day) AS DATE) AS month_static, CAST(date_trunc('year', day) AS DATE) AS year_static,
    CAST(month(day) AS INT) AS month_seasonal, CAST(day(last_day(day)) AS INT) AS month_days
    FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders)""",
)
oracle(
    "bin_midpoint",
    """SELECT p_partkey, CASE p_type WHEN 'LARGE' THEN CAST(p_size AS DOUBLE) WHEN 'SMALL' THEN NULL ELSE p_size + 2.5 END
    AS mean_length FROM part""",
)
oracle(
    "sanitize_numeric",
    """SELECT c_custkey, CASE WHEN abs(floor(c_acctbal / 100)) BETWEEN 3 AND 72 THEN abs(floor(c_acctbal / 100)) END AS hours,
    CASE WHEN c_acctbal >= 0 THEN round_even(pow(c_acctbal * 1000, 1.0::DOUBLE / 3.0), 0) END AS cube_root,
    c_acctbal / nullif(floor(c_acctbal / 1000), 0) AS price FROM customer""",
)
oracle(
    "registration",
    """SELECT p_partkey, CASE WHEN p_size >= 10 THEN CASE p_type WHEN 'LARGE' THEN 'BR ' || p_size || ' CD'
    WHEN 'SMALL' THEN 'BR ' || p_size || ' ' WHEN 'PROMO' THEN NULL WHEN 'ECONOMY' THEN NULL
    ELSE 'BR ' || p_size || ' EFG' END END AS boat_registration FROM part""",
)
oracle(
    "text_logical",
    """SELECT CAST(o_orderkey AS VARCHAR) AS uuid, CASE WHEN o_orderstatus IN ('F', 'O') THEN 'boat'
    WHEN substr(o_orderpriority, 1, 1) <= '3' THEN 'land' END AS platform FROM orders""",
)

# Reshaping and windows ----------------------------------------------------------------------

QUESTIONS = {
    "species": "species_code",
    "food_or_sale": "use",
    "no_fish_by_length_group_fish_length_over60": "CAST(CAST(length AS INT) AS VARCHAR)",
    **{
        f"no_fish_by_length_group_no_individuals_{name}": f"CAST(n{j} AS VARCHAR)"
        for j, name in enumerate(["0_10", "10_20", "20_30", "30_40", "over60"])
    },
}
oracle(
    "unpivot_group",
    " UNION ALL ".join(
        f"""SELECT record_id AS uuid, record, '{q}' AS question, {e} AS value FROM (SELECT DISTINCT record_id FROM grp)
        CROSS JOIN (SELECT CAST(unnest(range({len(GROUPS)})) AS VARCHAR) AS record) LEFT JOIN grp USING (record_id, record)"""
        for q, e in QUESTIONS.items()
    ),
    "answers",
    "grp",
)
oracle(
    "lump_top_n",
    """SELECT CASE WHEN r <= 5 THEN b.p_brand ELSE 'other' END AS p_brand, sum(n)::BIGINT AS n, sum(q) AS quantity
    FROM (SELECT p_brand, count(*) AS n, sum(l_quantity) AS q, rank() OVER (ORDER BY count(*) DESC) AS r
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand) b GROUP BY 1""",
)
CELL = "municipality_name, boat_type, period_static"
oracle(
    "pivot_counts",
    f"""SELECT {CELL}, period_seasonal, """
    + ", ".join(f"count(*) FILTER (trip_gear = '{g}') AS tg_{g}" for g in GEARS)
    + f" FROM order_trips GROUP BY {CELL}, period_seasonal",
    "stations",
    "order_trips",
)
oracle(
    "pivot_by_boat_code",
    "SELECT period_static, split_part(individual_boat, ' ', 1) AS customer, "
    + ", ".join(f"CAST(sum({v}) FILTER (boat_code = '{c}') AS {t}) AS {v}_{c}"
                for v, t in (("n_days", "BIGINT"), ("n_trips", "DOUBLE")) for c in "12")
    + " FROM order_cells GROUP BY 1, 2",
    "stations",
    "order_cells",
)
oracle(
    "complete",
    """SELECT o_custkey, month, coalesce(n, 0) AS n FROM (SELECT DISTINCT o_custkey FROM orders) CROSS JOIN
    (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders) LEFT JOIN
    (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n FROM orders GROUP BY 1, 2)
    USING (o_custkey, month)""",
)
oracle(
    "daily_panel",
    """SELECT g.imei, g.boat, g.kind, g.day, n FROM (SELECT imei, boat, kind,
    CAST(unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS day FROM (SELECT DISTINCT imei, boat, kind,
    min(day) OVER (PARTITION BY imei) AS lo, max(day) OVER (PARTITION BY imei) AS hi FROM dd)) g
    LEFT JOIN dd ON g.imei IS NOT DISTINCT FROM dd.imei AND g.boat = dd.boat AND g.day = dd.day""",
    "pts",
    dd="SELECT imei, boat, day, count(*) AS n, substr(boat, 1, 1) AS kind FROM pts GROUP BY imei, boat, day",
)
oracle(
    "forward_fill",
    """SELECT event_id, user_id, ts, last_value(CASE WHEN event_type = 'view' THEN value END IGNORE NULLS) OVER (
    PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS seen FROM events""",
)
SHARES = """round(n / sum(n) OVER (), 9) AS share,
    round(sum(n) OVER (ORDER BY {0} ROWS UNBOUNDED PRECEDING) / sum(n) OVER (), 9) AS share_cum"""
oracle(
    "running_share",
    f"SELECT p_size, n, {SHARES.format('p_size')} FROM (SELECT p_size, count(*) AS n FROM part GROUP BY 1)",
)
oracle(
    "price_ecdf",
    """SELECT price, n, round(sum(n) OVER (ORDER BY price) / sum(n) OVER (), 9) AS ecdf FROM (
    SELECT floor(l_extendedprice / l_quantity) AS price, count(*) AS n FROM lineitem GROUP BY 1)""",
)

# Joins -------------------------------------------------------------------------------------

oracle(
    "suffix_join",
    """SELECT record_id AS uuid, CASE WHEN imei_number >= 9999 THEN CAST(imei_number AS VARCHAR) END AS digits, imei AS imei_long
    FROM typed LEFT JOIN (SELECT DISTINCT imei FROM boats) ON imei_number >= 9999 AND suffix(imei, CAST(imei_number AS VARCHAR))""",
    "boats",
    "fields",
    "typed",
)
oracle(
    "asof_latest",
    """SELECT o_orderkey, o_custkey, o_orderdate, installation FROM (SELECT o.o_orderkey, o.o_custkey, o.o_orderdate,
    i.o_orderkey AS installation, row_number() OVER (PARTITION BY o.o_orderkey ORDER BY i.o_orderdate DESC, i.o_orderkey) AS rn
    FROM orders o LEFT JOIN orders i ON i.o_custkey = o.o_custkey AND i.o_orderstatus = 'P' AND i.o_orderdate < o.o_orderdate
    WHERE o.o_orderstatus <> 'P') WHERE rn = 1""",
)
oracle(
    "full_outer_trips",
    """SELECT record_id, coalesce(f.trip_imei, t.imei) AS trip_imei, coalesce(f.trip_date, t.trip_end_date_pds) AS trip_date,
    trip_id_pds, boat_id_pds FROM ff f FULL JOIN (SELECT * FROM tracked WHERE imei IS NOT NULL) t
    ON f.trip_imei = t.imei AND f.trip_date = t.trip_end_date_pds""",
    "tracked",
    "fields",
    "typed",
    ff=f"""SELECT record_id, CASE WHEN boat_type IS NOT NULL THEN {imei('CAST(record_device_id AS BIGINT)')} END AS trip_imei,
    DATE '2024-01-01' + CAST(day(trip_date) AS INT) AS trip_date FROM typed""",
)
oracle(
    "outage_anti",
    "SELECT imei, trip_id_pds, trip_end_date_pds FROM tracked WHERE trip_end_date_pds NOT IN (SELECT day FROM outages)",
    "tracked",
    "outages",
)
oracle(
    "union_last_seen",
    f"""SELECT imei, max(d) AS last_day, count(t) AS n_trips, count(s) AS n_seen FROM (
    SELECT imei, trip_end_date_pds AS d, trip_id_pds AS t, NULL AS s FROM tracked
    UNION ALL SELECT imei, {local('last_seen')}, NULL, 1 FROM devices) GROUP BY imei""",
    "tracked",
    "devices",
)

# Survey -----------------------------------------------------------------------------------

oracle(
    "catch_flags",
    f"""SELECT record_id, record, species_code, use, question, n_individuals_flag, size_flag,
    {same(6, 'mean_length', 'n_individuals', 'weight')} FROM flagged_lines""",
    *CHAINS["catch"][:-1],
)
oracle(
    "catch_lines",
    f"SELECT record_id, species_code, use, mean_length, {same(6, 'n_individuals', 'weight')}, species_flags FROM catch",
    "catch",
)
oracle(
    "trip_catch",
    "SELECT record_id, trip_catch_use, trip_n_species, round(trip_catch, 6) AS trip_catch, species_flag FROM trip_catch",
    "catch",
    "trip_catch",
)
oracle(
    "trip_flags",
    """SELECT trip_imei, boat_registration, trip_duration, trip_platform, trip_date, recording_datetime, gear_mesh_size,
    fisher_number_men, fisher_number_women, fisher_number_children, fisher_number_total, record_device_id, record_id,
    trip_happiness, boat_type, trip_gear, trip_habitat, trip_landing_site, trip_catch_use, trip_n_species,
    round(trip_catch, 6) AS trip_catch, round(trip_value, 6) AS trip_value, flags FROM trips""",
    "trips",
)
SLOTS = "species_code_1, species_code_2, species_code_other, " + same(6, "weight_1", "weight_2", "weight_other")
oracle("top_n_species_wide", f"SELECT record_id, {SLOTS} FROM wide", "catch", "ranked", "wide")
oracle(
    "widen_trip_catch",
    f"SELECT record_id, trip_imei, round(trip_price, 6) AS trip_price, {SLOTS} FROM wide_trips",
    "wide_trips",
)
oracle(
    "species_count_share",
    f"""SELECT trip_n_species, n, {SHARES.format('trip_n_species')} FROM (SELECT trip_n_species, count(*) AS n FROM trip_catch
    WHERE trip_n_species BETWEEN 1 AND 8 GROUP BY 1)""",
    "catch",
    "trip_catch",
)

# Vessel activity -----------------------------------------------------------------------------

ASSIGNED = "trip_id_pds, imei, trip_end_date_pds, boat_code, municipality_name"
oracle("assign_boats", f"SELECT {ASSIGNED} FROM assigned", "assigned")
oracle(
    "assign_boats_literal",
    f"""SELECT {ASSIGNED} FROM (SELECT *, count(*) OVER w AS nr, min(gap) OVER w AS g0, count(*) FILTER (gap IS NULL) OVER w AS gn
    FROM pairs WINDOW w AS (PARTITION BY trip_id_pds)) WHERE nr = 1 OR (gn = 0 AND gap = g0 AND gap > 0)""",
    "tracked",
    "boats",
    pairs="""SELECT t.*, b.boat_code, b.municipality_name, datediff('day', b.installation_date, t.trip_end_date_pds) AS gap
    FROM tracked t LEFT JOIN boats b USING (imei) WHERE t.imei IS NOT NULL""",
)
oracle("activity_panel", "SELECT * FROM panel", "panel")
CELLS = """SELECT period_static, individual_boat, boat_code, municipality_name, period_seasonal, count(*) AS n_days,
    sum(trip_activity) AS n_trips FROM panel WHERE municipality_name IS NOT NULL GROUP BY ALL"""
oracle("activity_cells", CELLS, "panel")
oracle(
    "activity_rate_pooled",
    f"SELECT boat_code, municipality_name, period_static, n_days, {same(7, 'n_trips', 'overall', 'estimate')} FROM est",
    "panel",
    cells="""SELECT boat_code, municipality_name, trip_end_date_pds - CAST(dayofweek(trip_end_date_pds) AS INT) AS period_static,
    count(*) AS n_days, sum(trip_activity) AS n_trips FROM panel WHERE municipality_name IS NOT NULL GROUP BY ALL""",
    hyper=rate_hyper("cells", "boat_code"),
    est=shrunk_rate("cells", "hyper", "boat_code"),
)
oracle(
    "boat_span",
    """SELECT imei, boat_id_pds, boat_code, municipality_name, min(trip_end_date_pds) AS installation,
    max(trip_end_date_pds) AS last_heard FROM panel GROUP BY ALL""",
    "panel",
)
oracle(
    "tracked_boats",
    """SELECT period_static, boat_code, coalesce(n_boats, 0) AS n_boats FROM (SELECT DISTINCT period_static FROM wk) CROSS JOIN
    (SELECT DISTINCT boat_code FROM wk) LEFT JOIN (SELECT period_static, boat_code, count(DISTINCT boat_id_pds) AS n_boats
    FROM wk GROUP BY 1, 2) USING (period_static, boat_code)""",
    "panel",
    wk="""SELECT trip_end_date_pds - CAST(dayofweek(trip_end_date_pds) AS INT) AS period_static, boat_code, boat_id_pds
    FROM panel""",
)
oracle(
    "coverage_ratio",
    """SELECT municipality_name, period_static, boat_code, coalesce(n_boats, 0) AS n_boats, value,
    round(coalesce(n_boats, 0) / nullif(value, 0), 9) AS prop_boats FROM (SELECT DISTINCT municipality_name FROM panel) CROSS JOIN
    (SELECT DISTINCT period_static FROM panel) CROSS JOIN (SELECT DISTINCT boat_code FROM panel)
    LEFT JOIN (SELECT municipality_name, period_static, boat_code, count(DISTINCT boat_id_pds) AS n_boats FROM panel GROUP BY ALL)
    USING (municipality_name, period_static, boat_code)
    LEFT JOIN (SELECT municipality_name, '1' AS boat_code, canoes AS value FROM muni
    UNION ALL SELECT municipality_name, '2', motors FROM muni) USING (municipality_name, boat_code)""",
    "panel",
    "muni",
)

# Prices ---------------------------------------------------------------------------------------

W_TOTAL = "coalesce(weight_1, 0) + coalesce(weight_2, 0) + coalesce(weight_other, 0)"


def members(source: str, extra: str = "") -> str:
    return " UNION ALL ".join(
        f"""SELECT record_id, {extra} species_code_{s} AS species_code, weight_{s} / ({W_TOTAL}) AS share, ln(trip_price) AS y
        FROM {source} WHERE trip_price > 0 AND weight_{s} > 0"""
        for s in ("1", "2", "other")
    )


def member_moments(source: str, keys: str, w: str) -> str:
    return f"""SELECT {keys}, w * w / ww AS n, wy / w AS mean, w * w / ww * greatest(wyy / w - (wy / w) * (wy / w), 0) AS ss FROM (
        SELECT {keys}, sum(share * {w}) AS w, sum(share * share * {w}) AS ww, sum(share * {w} * y) AS wy,
        sum(share * {w} * y * y) AS wyy FROM {source} GROUP BY {keys})"""


BOAT_TRIPS = "SELECT * FROM wide_trips WHERE trip_platform = 'boat'"
oracle(
    "species_price",
    f"SELECT species_code, {same(5, 'n', 'mean', 'overall', 'estimate')} FROM est",
    "wide_trips",
    boat_trips=BOAT_TRIPS,
    mem=members("boat_trips"),
    cells=member_moments("mem", "species_code", "1.0::DOUBLE"),
    hyper=mean_hyper("cells"),
    est=shrunk("cells", "hyper"),
)
PRICE_MODEL = {
    "boat_trips": BOAT_TRIPS,
    "dtrips": drawn("boat_trips", "record_id"),
    "mem": members("dtrips", "draw, dw,"),
    "cells": member_moments("mem", "species_code, draw", "dw"),
    "hyper": mean_hyper("cells", "draw"),
    "est": shrunk("cells", "hyper", "draw"),
    "nums": f"SELECT CAST(i AS INT) AS draw FROM range(1, {DRAWS + 1}) t(i)",
    "uniq": "SELECT row_number() OVER () AS id, * FROM wide_trips",
    "fit": f"""SELECT id, draw, exp(sum(w * coalesce(estimate, overall)) / sum(w)) AS p FROM (
        SELECT id, species_code_1 AS code, weight_1 AS w FROM uniq WHERE weight_1 > 0
        UNION ALL SELECT id, species_code_2, weight_2 FROM uniq WHERE weight_2 > 0
        UNION ALL SELECT id, species_code_other, weight_other FROM uniq WHERE weight_other > 0) m
        CROSS JOIN nums LEFT JOIN hyper USING (draw) LEFT JOIN (SELECT species_code AS code, draw, estimate FROM est)
        USING (code, draw) GROUP BY id, draw""",
    "bounds": "SELECT id, quantile_cont(p, 0.025) AS lo, quantile_cont(p, 0.975) AS hi FROM fit GROUP BY id",
    "priced": "SELECT u.*, lo, hi FROM uniq u LEFT JOIN bounds USING (id)",
    "judged": """SELECT *, exp(least(abs(ln(trip_price / lo)), abs(ln(trip_price / hi)))
        * sign(abs(ln(trip_price / lo)) - abs(ln(trip_price / hi)))) AS factor FROM (
        SELECT * EXCLUDE (trip_price), CASE WHEN trip_price > 0 THEN trip_price END AS trip_price FROM priced)""",
    "tagged": "SELECT * EXCLUDE (flags), nullif(concat_ws(';', flags, CASE "
    + " ".join(f"WHEN factor {'>' if side == 'above' else '<'} {limit!r} THEN '{name}'" for side, limit, name in PRICE_FLAGS)
    + " END), '') AS flags FROM judged",
}
oracle(
    "price_interval",
    f"SELECT record_id, trip_imei, {rounds(5, price_lower='lo', price_upper='hi')} FROM priced",
    "wide_trips",
    **{k: v for k, v in PRICE_MODEL.items() if k not in ("judged", "tagged")},
)
oracle(
    "price_flags",
    f"SELECT record_id, trip_imei, {rounds(5, trip_price_residual_factor='factor')}, flags FROM tagged",
    "wide_trips",
    **PRICE_MODEL,
)
oracle(
    "catch_features",
    """SELECT record_id, trip_imei, municipality_name, boat_type, trip_gear,
    CAST(date_trunc('month', trip_date) AS DATE) AS period_static, CAST(month(trip_date) AS VARCHAR) AS period_seasonal,
    strftime(trip_date, '%a') AS wday, round_even(round(trip_catch, 6) * 10, 0) AS trip_catch_po,
    round_even(pow(trip_catch * 1000, 1.0::DOUBLE / 3.0), 0) AS trip_catch_po_3,
    round_even(pow(trip_value * 1000, 1.0::DOUBLE / 3.0), 0) AS trip_value_po_3
    FROM tagged JOIN stations ON trip_landing_site = station_code
    WHERE boat_type IS NOT NULL AND (flags IS NULL OR NOT contains(flags, 'price_per_kg_'))""",
    "wide_trips",
    "stations",
    **PRICE_MODEL,
)
oracle(
    "price_features",
    """SELECT municipality_name, CAST(date_trunc('year', trip_date) AS DATE) AS period_static,
    CAST(month(trip_date) AS VARCHAR) AS period_seasonal, strftime(trip_date, '%a') AS wday, count(*) AS n,
    round(sum(CASE WHEN trip_price > 0 THEN ln(trip_price) END), 4) AS log_price
    FROM wide_trips LEFT JOIN stations ON trip_landing_site = station_code
    WHERE trip_price IS NOT NULL AND trip_platform = 'boat' GROUP BY ALL""",
    "wide_trips",
    "stations",
)

# Estimates ---------------------------------------------------------------------------------------

oracle(
    "gear_mix",
    f"""SELECT {CELL}, period_seasonal, count(*) AS size, """
    + ", ".join(f"count(*) FILTER (trip_gear = '{g}') AS tg_{g}" for g in GEARS)
    + f""" FROM (SELECT municipality_name, boat_type, trip_gear, CAST(date_trunc('month', trip_date) AS DATE) AS period_static,
    CAST(month(trip_date) AS VARCHAR) AS period_seasonal FROM typed JOIN stations ON trip_landing_site = station_code
    WHERE boat_type IS NOT NULL) GROUP BY {CELL}, period_seasonal""",
    "fields",
    "typed",
    "stations",
)


def gear_shares(source: str, cell: str, parent: str, w: str) -> dict[str, str]:
    return {
        "by_level": f"SELECT {parent}, trip_gear, sum({w}) AS nl FROM {source} GROUP BY {parent}, trip_gear",
        "prior": f"SELECT *, nl / sum(nl) OVER (PARTITION BY {parent}) AS p FROM by_level",
        "sizes": f"SELECT {cell}, sum({w}) AS size FROM {source} GROUP BY {cell}",
        "seen": f"SELECT {cell}, trip_gear, sum({w}) AS n FROM {source} GROUP BY {cell}, trip_gear",
        "shares": f"""SELECT {cell}, trip_gear, coalesce(n, 0) AS n, size, (coalesce(n, 0) + 10 * p) / (size + 10) AS estimate
        FROM sizes JOIN prior USING ({parent}) LEFT JOIN seen USING ({cell}, trip_gear)""",
    }


oracle(
    "gear_mix_pooled",
    """SELECT municipality_name, boat_type, trip_gear, CAST(n AS BIGINT) AS n, CAST(size AS BIGINT) AS size,
    round(estimate, 9) AS estimate FROM shares""",
    "stations",
    "order_trips",
    **gear_shares("order_trips", "municipality_name, boat_type", "boat_type", "1"),
)
for _name, _y in (("catch_cell_means", "trip_catch_po_3"), ("value_cell_means", "trip_value_po_3")):
    oracle(
        _name,
        f"SELECT {CELL}, {same(6, 'n', 'mean', 'ss', 'overall', 'estimate')} FROM est",
        "stations",
        "order_trips",
        cells=moments("order_trips", CELL, _y),
        hyper=mean_hyper("cells"),
        est=shrunk("cells", "hyper"),
    )
oracle(
    "bootstrap_draws",
    f"SELECT municipality_name, boat_type, draw, {same(5, 'n', 'mean', 'ss')} FROM m",
    "stations",
    "order_trips",
    dtrips=drawn("order_trips", "record_id"),
    m=moments("dtrips", "municipality_name, boat_type, draw", "trip_catch_po_3", "dw"),
)

GRID = {
    "nums": f"SELECT CAST(i AS INT) AS draw FROM range(1, {DRAWS + 1}) t(i)",
    "grid": """SELECT municipality_name, boat_type, n, CAST(m AS DATE) AS period_static,
        CAST(day(last_day(CAST(m AS DATE))) AS INT) AS n_days_month, draw FROM (
        SELECT municipality_name, '1' AS boat_type, canoes AS n FROM muni
        UNION ALL SELECT municipality_name, '2', motors FROM muni),
        (SELECT unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS m FROM (SELECT CAST(date_trunc('month', min(o_orderdate))
        AS TIMESTAMP) AS lo, CAST(max(o_orderdate) AS TIMESTAMP) AS hi FROM orders)), nums""",
    "dcells": drawn("order_cells", "individual_boat"),
    "acells": """SELECT municipality_name, period_static, boat_code AS boat_type, draw, sum(n_days * dw) AS n_days,
        sum(n_trips * dw) AS n_trips FROM dcells GROUP BY ALL""",
    "ahyper": rate_hyper("acells", "boat_type, draw"),
    "aest": shrunk_rate("acells", "ahyper", "boat_type, draw"),
    "exp_trips": """SELECT g.*, coalesce(e.estimate, h.overall) AS rate,
        g.n * coalesce(e.estimate, h.overall) * n_days_month AS n_trips
        FROM grid g LEFT JOIN aest e USING (municipality_name, period_static, boat_type, draw)
        LEFT JOIN ahyper h ON h.boat_type = g.boat_type AND h.draw = g.draw""",
}
MODELS = {"dtrips": drawn("order_trips", "record_id")}
for _tag, _y in (("w", "trip_catch_po_3"), ("v", "trip_value_po_3")):
    for _suffix, _keys in (("", CELL), ("g", CELL + ", trip_gear")):
        _t = _tag + _suffix
        MODELS[f"{_t}c"] = moments("dtrips", _keys + ", draw", _y, "dw")
        MODELS[f"{_t}h"] = mean_hyper(f"{_t}c", "draw")
        MODELS[f"{_t}e"] = shrunk(f"{_t}c", f"{_t}h", "draw")
MODELS |= gear_shares("dtrips", "municipality_name, boat_type, draw", "boat_type, draw", "dw")


def product_sql(source: str, tag: str, keys: str) -> str:
    return f"""SELECT *, n_trips * catch_weight AS total_weight, n_trips * catch_value AS total_value FROM (
        SELECT t.*, pow(coalesce(w.estimate, wh.overall), 3) / 1000 AS catch_weight,
        pow(coalesce(v.estimate, vh.overall), 3) / 1000 AS catch_value FROM {source} t
        LEFT JOIN w{tag}e w USING ({keys}, draw) LEFT JOIN w{tag}h wh ON wh.draw = t.draw
        LEFT JOIN v{tag}e v USING ({keys}, draw) LEFT JOIN v{tag}h vh ON vh.draw = t.draw)"""


TOTALS = {
    **GRID,
    **MODELS,
    "no_gear": product_sql("exp_trips", "", CELL),
    "split": """SELECT t.* REPLACE (t.n_trips * coalesce(s.estimate, p.p) AS n_trips), p.trip_gear,
        coalesce(s.estimate, p.p) AS gear_prop FROM exp_trips t JOIN prior p USING (boat_type, draw)
        LEFT JOIN (SELECT municipality_name, boat_type, draw, trip_gear, estimate FROM shares) s
        ON s.municipality_name = t.municipality_name AND s.boat_type = t.boat_type AND s.draw = t.draw
        AND s.trip_gear = p.trip_gear""",
    "by_gear": product_sql("split", "g", CELL + ", trip_gear"),
}
PLACES = ("stations", "muni", "order_cells", "order_trips")
OUT = f"{CELL}, draw, " + same(3, "n_trips", "catch_weight", "catch_value", "total_weight", "total_value")
oracle(
    "expected_trips",
    f"SELECT {CELL}, n, n_days_month, draw, {same(5, 'rate', 'n_trips')} FROM exp_trips",
    "stations",
    "muni",
    "order_cells",
    **GRID,
)
oracle("totals_no_gear", f"SELECT {OUT} FROM no_gear", *PLACES, **{k: v for k, v in TOTALS.items() if k not in ("split", "by_gear")})
oracle("totals_gear", f"SELECT {OUT}, trip_gear, round(gear_prop, 3) AS gear_prop FROM by_gear", *PLACES, **TOTALS)
oracle(
    "totals_by_draw",
    " UNION ALL ".join(
        f"""SELECT '{label} for fishing gear' AS est, draw, {rounds(1, n_trips='sum(n_trips)', total_weight='sum(total_weight)',
        total_value='sum(total_value)')} FROM {source} WHERE period_static BETWEEN DATE '1996-01-01' AND DATE '1996-12-01'
        GROUP BY draw"""
        for label, source in (("accounting", "by_gear"), ("not accounting", "no_gear"))
    ),
    *PLACES,
    **TOTALS,
)


def intervals(source: str, keys: str, value: str, digits: int, widths: tuple[float, ...] = (0.66, 0.95)) -> str:
    return " UNION ALL ".join(
        f"""SELECT {keys}, {w}::DOUBLE AS width, round(quantile_cont({value}, 0.5), {digits}) AS median,
        round(avg({value}), {digits}) AS mean, round(quantile_cont({value}, {(1 - w) / 2!r}), {digits}) AS lower,
        round(quantile_cont({value}, {(1 + w) / 2!r}), {digits}) AS upper FROM {source} GROUP BY {keys}"""
        for w in widths
    )


oracle(
    "interval_summary",
    intervals("per_place", "municipality_name", "total_weight", 2),
    *PLACES,
    **{k: v for k, v in TOTALS.items() if k not in ("split", "by_gear")},
    per_place="""SELECT municipality_name, draw, sum(total_weight) AS total_weight FROM no_gear
    WHERE period_static >= DATE '1996-01-01' GROUP BY ALL""",
)
oracle(
    "marginal_means",
    intervals("lv", "trip_gear, boat_type", "value", 4),
    "stations",
    "order_trips",
    dtrips=drawn("order_trips", "record_id"),
    cells=moments("dtrips", "trip_gear, boat_type, draw", "trip_catch_po_3", "dw"),
    hyper=mean_hyper("cells", "draw"),
    est=shrunk("cells", "hyper", "draw"),
    lv="""SELECT trip_gear, boat_type, pow(estimate, 3) / 1000 AS value FROM est
    UNION ALL SELECT 'Overall', 'Overall', pow(overall, 3) / 1000 FROM hyper""",
)
oracle(
    "activity_table",
    intervals("lv", "boat_code, municipality_name", "value", 4, (0.05, 0.66, 0.95)),
    "stations",
    "order_cells",
    dcells=drawn("order_cells", "individual_boat"),
    cells="""SELECT boat_code, municipality_name, draw, sum(n_days * dw) AS n_days, sum(n_trips * dw) AS n_trips
    FROM dcells GROUP BY ALL""",
    hyper=rate_hyper("cells", "boat_code, draw"),
    est=shrunk_rate("cells", "hyper", "boat_code, draw"),
    lv="SELECT boat_code, municipality_name, estimate * 30 AS value FROM est",
)
oracle(
    "gear_share_table",
    intervals("shares", "municipality_name, boat_type, trip_gear", "estimate", 5),
    "stations",
    "order_trips",
    dtrips=drawn("order_trips", "record_id"),
    **gear_shares("dtrips", "municipality_name, boat_type, draw", "boat_type, draw", "dw"),
)


# Crossed effects -------------------------------------------------------------------------
# The same rounds and iterations, one common table expression for each written table.

ACTIVITY_LEVELS = {
    "intercept": "''",
    "place": "municipality_name",
    "period": "CAST(period_static AS VARCHAR)",
    "place_period": "municipality_name || '|' || CAST(period_static AS VARCHAR)",
    "season": "period_seasonal",
    "boat": "individual_boat",
}
WEEKLY = """SELECT trip_end_date_pds - CAST(dayofweek(trip_end_date_pds) AS INT) AS period_static, individual_boat, boat_code,
    municipality_name, CAST(dayofweek(trip_end_date_pds) + 1 AS VARCHAR) AS period_seasonal, CAST(count(*) AS DOUBLE) AS n,
    sum(trip_activity) AS k FROM panel WHERE municipality_name IS NOT NULL GROUP BY ALL"""


def with_eta(source: str, effects: str, factors, keys: str = "") -> str:
    """Rows of ``source`` with eta, the sum of the effects of their levels."""
    draw = "AND {0}.draw = s.draw" if keys else ""
    joins = " ".join(
        f"LEFT JOIN (SELECT * FROM {effects} WHERE factor = '{f}') e_{f} ON e_{f}.boat_code = s.boat_code AND e_{f}.level = s.l_{f} {draw.format('e_' + f)}"
        for f in factors
    )
    return f"SELECT s.*, {' + '.join(f'coalesce(e_{f}.value, 0)' for f in factors)} AS eta FROM {source} s {joins}"


def scored(source: str, effects: str, shares: str, factors) -> str:
    rate = "1 / (1 + exp(-eta))"
    return f"""SELECT *, rows * (1 - chance) * n * p * (1 - p) AS w, rows * (1 - chance) * (k - n * p) AS r FROM (
        SELECT *, CASE WHEN k = 0 AND share > 0 THEN share / (share + (1 - share) * pow(1 - p, n)) ELSE 0 END AS chance FROM (
        SELECT *, {rate} AS p FROM ({with_eta(source, effects, factors)}) JOIN {shares} USING (boat_code)))"""


def precisions(effects: str) -> str:
    return f"""SELECT boat_code, factor, CASE WHEN factor = 'intercept' THEN 0 ELSE 1 / greatest(avg(value * value + variance), 1e-4) END
        AS precision FROM {effects} GROUP BY boat_code, factor"""


def by_level(source: str, factors, columns: str) -> str:
    return " UNION ALL ".join(f"SELECT boat_code, '{f}' AS factor, l_{f} AS level, {columns} FROM {source} GROUP BY ALL" for f in factors)


def links(source: str, factors) -> str:
    return " UNION ALL ".join(
        f"""SELECT boat_code, '{a}' AS factor, l_{a} AS level, '{b}' AS other, l_{b} AS other_level, sum(w) AS weight
        FROM {source} GROUP BY ALL"""
        for a in factors
        for b in factors
        if a != b
    )


def solved(name: str, system: str, linked: str, keys: str, iterations: int, by: str = "boat_code") -> dict[str, str]:
    """Conjugate gradients as a chain of tables, the last one ``name``_x."""
    level = f"{keys}, factor, level"
    out = {f"{name}_s0": f"SELECT {level}, size, 0.0::DOUBLE AS x, score AS r, score / size AS p FROM {system}"}
    own = ", ".join(f"s.{c.strip()}" for c in keys.split(","))
    for i in range(iterations):
        out[f"{name}_q{i}"] = f"""SELECT s.*, size * s.p + coalesce(pull, 0) AS q FROM {name}_s{i} s LEFT JOIN (
            SELECT {own}, l.factor, l.level, sum(l.weight * s.p) AS pull FROM {linked} l JOIN {name}_s{i} s ON l.{by} = s.{by}
            AND l.other = s.factor AND l.other_level = s.level GROUP BY ALL) USING ({level})"""
        out[f"{name}_f{i}"] = f"""SELECT {keys}, ahead, coalesce(greatest(rr - 2 * ahead * rq + ahead * ahead * qq, 0) / nullif(rr, 0), 0) AS turn
            FROM (SELECT *, coalesce(rr / nullif(pq, 0), 0) AS ahead FROM (SELECT {keys}, sum(r * r / size) AS rr, sum(p * q) AS pq,
            sum(r * q / size) AS rq, sum(q * q / size) AS qq FROM {name}_q{i} GROUP BY {keys}))"""
        out[f"{name}_s{i + 1}"] = f"""SELECT {level}, size, x + ahead * p AS x, r - ahead * q AS r, (r - ahead * q) / size + turn * p AS p
            FROM {name}_q{i} JOIN {name}_f{i} USING ({keys})"""
    out[f"{name}_x"] = f"SELECT {level}, x FROM {name}_s{iterations}"
    return out


def fitted(rounds: int, iterations: int, levels: dict[str, str], source: str, zeros: float) -> dict[str, str]:
    """The activity model: tables effects_N, shares_N, precisions_N, and the cells."""
    factors = list(levels)
    named = ", ".join(f"{expr} AS l_{f}" for f, expr in levels.items())
    out = {
        "weekly": source,
        "cells": f"SELECT *, {named} FROM (SELECT *, 1.0::DOUBLE AS rows FROM weekly)",
        "pooled": "SELECT boat_code, sum(k) / sum(n) AS m, avg(CASE WHEN k = 0 THEN 1.0::DOUBLE ELSE 0 END) AS zeros FROM cells GROUP BY 1",
        "effects_0": f"""SELECT boat_code, factor, level, CASE WHEN factor = 'intercept' THEN ln(m / (1 - m)) ELSE 0 END AS value,
            1.0::DOUBLE AS variance, 0.0::DOUBLE AS weight FROM ({by_level("cells", factors, "count(*) AS n_rows")}) JOIN pooled USING (boat_code)""",
        "shares_0": f"SELECT boat_code, zeros * {zeros}::DOUBLE AS share FROM pooled",
    }
    for i in range(rounds):
        out[f"precisions_{i}"] = precisions(f"effects_{i}")
        out[f"rows_{i}"] = scored("cells", f"effects_{i}", f"shares_{i}", factors)
        out[f"system_{i}"] = f"""SELECT s.boat_code, s.factor, s.level, value, s.weight, s.weight + precision AS size, s.r - precision * value AS score
            FROM ({by_level(f"rows_{i}", factors, "sum(w) AS weight, sum(r) AS r")}) s JOIN effects_{i} e USING (boat_code, factor, level)
            JOIN precisions_{i} USING (boat_code, factor)"""
        out[f"links_{i}"] = links(f"rows_{i}", factors)
        out |= solved(f"cg{i}", f"system_{i}", f"links_{i}", "boat_code", iterations)
        out[f"effects_{i + 1}"] = f"""SELECT boat_code, factor, level, value + greatest(least(x, 2), -2) AS value, 1 / size AS variance, weight
            FROM system_{i} JOIN cg{i}_x USING (boat_code, factor, level)"""
        out[f"shares_{i + 1}"] = f"SELECT boat_code, sum(chance * rows) / sum(rows) AS share FROM rows_{i} GROUP BY 1"
    out[f"precisions_{rounds}"] = precisions(f"effects_{rounds}")
    return out


def stored(select: str, *ctes: str, **extra: str) -> str:
    """Like ``sql``, with the extra tables kept while the query runs."""
    return sql(select, *ctes, **{f"{n} ": body for n, body in extra.items()}).replace("  AS (", " AS MATERIALIZED (")


def predicted(source: str, effects: str, factors, keys: str = "", shares: str = "shares_3") -> str:
    return f"SELECT *, (1 - share) / (1 + exp(-eta)) AS estimate FROM ({with_eta(source, effects, factors, keys)}) JOIN {shares} USING (boat_code)"


ROUNDS = 3
CELL_FACTORS = ["intercept", "place", "period", "place_period"]
MODEL = fitted(ROUNDS, 3, ACTIVITY_LEVELS, WEEKLY, 0.5)
ORACLES["q_glm_activity"] = stored(
    "SELECT DISTINCT boat_code, municipality_name, period_static, period_seasonal, round(estimate, 5) AS estimate FROM predicted",
    "panel",
    **MODEL,
    predicted=predicted("cells", "effects_3", [*CELL_FACTORS, "season"]),
)
ORACLES["q_activity_variances"] = stored(
    """SELECT boat_code, factor, count(*) AS n_levels, round(sum(weight), 4) AS weight,
    round(max(CASE WHEN precision > 0 THEN 1 / sqrt(precision) END), 4) AS sd
    FROM effects_3 JOIN precisions_3 USING (boat_code, factor) GROUP BY ALL""",
    "panel",
    **MODEL,
)


def drawn_effects(rounds: int, iterations: int, levels: dict[str, str]) -> dict[str, str]:
    """Effects by draw, ``draw_effects``, of the model after so many rounds."""
    factors = list(levels)
    return {
        "last_rows": scored("cells", f"effects_{rounds}", f"shares_{rounds}", factors),
        "by_unit": " UNION ALL ".join(
            f"SELECT boat_code, individual_boat, '{f}' AS factor, l_{f} AS level, sum(r) AS r FROM last_rows GROUP BY ALL" for f in factors
        ),
        "units": "SELECT DISTINCT individual_boat AS unit FROM weekly",
        "resampled": drawn("units", "unit"),
        "scores": f"""SELECT boat_code, factor, level, draw, CASE WHEN factor = 'boat' THEN 0 ELSE coalesce(got, 0) - base END AS score FROM (
            SELECT * FROM (SELECT boat_code, factor, level, sum(r) AS base FROM by_unit GROUP BY ALL)
            CROSS JOIN (SELECT CAST(unnest(range(1, {DRAWS + 1})) AS INT) AS draw)) LEFT JOIN (
            SELECT boat_code, factor, level, draw, sum(r * dw) AS got FROM by_unit JOIN resampled ON unit = individual_boat GROUP BY ALL)
            USING (boat_code, factor, level, draw)""",
        "draw_system": f"""SELECT boat_code, factor, level, draw, score, value, weight + precision AS size FROM scores
            JOIN effects_{rounds} USING (boat_code, factor, level) JOIN precisions_{rounds} USING (boat_code, factor)""",
        "draw_links": links("last_rows", factors),
        **solved("draws", "draw_system", "draw_links", "boat_code, draw", iterations),
        "draw_effects": """SELECT boat_code, factor, level, draw, value + x AS value FROM draw_system
            JOIN draws_x USING (boat_code, factor, level, draw)""",
    }


DRAWN = {
    **drawn_effects(ROUNDS, 3, ACTIVITY_LEVELS),
    "grid": f"""SELECT DISTINCT boat_code, municipality_name, period_static, {', '.join(f'l_{f}' for f in CELL_FACTORS)}, draw
        FROM cells, (SELECT CAST(unnest(range(1, {DRAWS + 1})) AS INT) AS draw)""",
}
ORACLES["q_predict_grid"] = stored(
    "SELECT boat_code, municipality_name, period_static, draw, round(estimate, 5) AS estimate FROM predicted",
    "panel",
    **MODEL,
    **DRAWN,
    predicted=predicted("grid", "draw_effects", CELL_FACTORS, "draw"),
)


# Closed forms and simulation ------------------------------------------------------------

oracle(
    "glm_moments",
    f"""SELECT municipality_name, {same(7, "effect_1", "effect_2", "var_1", "var_2", "covariance", "correlation")} FROM (
    SELECT municipality_name, t1 AS var_1, t2 AS var_2, c AS covariance, c / sqrt(t1 * t2) AS correlation,
    CASE WHEN d2 IS NULL AND d1 IS NOT NULL THEN t1 * d1 / a WHEN d1 IS NULL AND d2 IS NOT NULL THEN c * d2 / b
      ELSE coalesce((t1 * (b * d1 - c * d2) + c * (a * d2 - c * d1)) / (a * b - c * c), 0) END AS effect_1,
    CASE WHEN d2 IS NULL AND d1 IS NOT NULL THEN c * d1 / a WHEN d1 IS NULL AND d2 IS NOT NULL THEN t2 * d2 / b
      ELSE coalesce((c * (b * d1 - c * d2) + t2 * (a * d2 - c * d1)) / (a * b - c * c), 0) END AS effect_2
    FROM (SELECT municipality_name, t1, t2, c, t1 + s1 AS a, t2 + s2 AS b, y1 - m1 AS d1, y2 - m2 AS d2 FROM logits, bounded))""",
    "stations",
    "order_cells",
    logits="""SELECT municipality_name, ln((k1 + 0.5) / (n1 - k1 + 0.5)) AS y1, 1 / (k1 + 0.5) + 1 / (n1 - k1 + 0.5) AS s1,
    ln((k2 + 0.5) / (n2 - k2 + 0.5)) AS y2, 1 / (k2 + 0.5) + 1 / (n2 - k2 + 0.5) AS s2 FROM (SELECT municipality_name,
    sum(CASE WHEN boat_code = '1' THEN n_days END)::DOUBLE AS n1, sum(CASE WHEN boat_code = '1' THEN n_trips END) AS k1,
    sum(CASE WHEN boat_code = '2' THEN n_days END)::DOUBLE AS n2, sum(CASE WHEN boat_code = '2' THEN n_trips END) AS k2
    FROM order_cells GROUP BY 1)""",
    moments="""SELECT avg(y1) AS m1, avg(y2) AS m2, greatest(var_samp(y1) - avg(s1), 1e-6) AS t1,
    greatest(var_samp(y2) - avg(s2), 1e-6) AS t2, covar_samp(y1, y2) AS raw FROM logits""",
    bounded="SELECT *, coalesce(greatest(least(raw, 0.99 * sqrt(t1 * t2)), -0.99 * sqrt(t1 * t2)), 0) AS c FROM moments",
)


def shares_below(i: int, above: str, keys: str) -> dict[str, str]:
    """One level of the hierarchy of gear shares."""
    join = f"JOIN parent_{i} p USING ({above})" if above else f", parent_{i} p"
    return {
        f"sizes_{i}": f"SELECT {keys}, sum(x) AS n FROM (SELECT {keys}, trip_gear, count(*)::DOUBLE AS x FROM order_trips GROUP BY ALL) GROUP BY ALL",
        f"cells_{i}": f"""SELECT g.*, coalesce(x, 0) AS x, count(*) OVER (PARTITION BY {keys}) AS g FROM (
            SELECT {keys}, s.n, p.trip_gear, p.estimate AS prior FROM sizes_{i} s {join}) g
            LEFT JOIN (SELECT {keys}, trip_gear, count(*)::DOUBLE AS x FROM order_trips GROUP BY ALL) USING ({keys}, trip_gear)""",
        f"kappa_{i}": f"""SELECT (1 - rho) / rho AS kappa FROM (SELECT coalesce(least(greatest(sum(chi - (g - 1)) / nullif(sum((g - 1) * (n - 1)), 0),
            1e-6), 1 - 1e-6), 1e-6) AS rho FROM (SELECT {keys}, sum(pow(x - n * prior, 2) / (n * prior)) AS chi, max(n) AS n, max(g) AS g
            FROM cells_{i} GROUP BY {keys}))""",
        f"parent_{i + 1}": f"SELECT {keys}, trip_gear, x, n, (x + kappa * prior) / (n + kappa) AS estimate, kappa FROM cells_{i}, kappa_{i}",
    }


ORACLES["q_gear_mix_hierarchy"] = stored(
    f"""SELECT boat_type, municipality_name, period_static, trip_gear, x::BIGINT AS n, n::BIGINT AS size, {same(6, "estimate", "kappa")} FROM parent_3""",
    "stations",
    "order_trips",
    parent_0="SELECT trip_gear, count(*)::DOUBLE / sum(count(*)) OVER () AS estimate FROM order_trips GROUP BY 1",
    **shares_below(0, "", "boat_type"),
    **shares_below(1, "boat_type", "boat_type, municipality_name"),
    **shares_below(2, "boat_type, municipality_name", "boat_type, municipality_name, period_static"),
)

oracle(
    "parametric_bootstrap",
    """SELECT boat_code, municipality_name, 0.95::DOUBLE AS width, round(quantile_cont(estimate, 0.5), 7) AS median, round(avg(estimate), 7) AS mean,
    round(quantile_cont(estimate, 0.025), 7) AS lower, round(quantile_cont(estimate, 0.975), 7) AS upper FROM refitted GROUP BY ALL""",
    "stations",
    "order_cells",
    sums="""SELECT boat_code, municipality_name, sum(n_days) AS n_days, sum(n_trips) AS n_trips FROM order_cells GROUP BY ALL""",
    hyper=rate_hyper("sums", "boat_code"),
    fit=shrunk_rate("sums", "hyper", "boat_code"),
    uniforms=f"""SELECT boat_code, municipality_name, order_cells.n_days, least(greatest(estimate, 0), 1 - 1e-12) AS p, draw::INT AS draw,
    CAST(('0x' || substr(md5(individual_boat || '/' || period_static || '.0-' || draw), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE AS u
    FROM order_cells JOIN fit USING (boat_code, municipality_name), range(1, {DRAWS + 1}) t(draw)""",
    steps="SELECT DISTINCT boat_code, municipality_name, n_days, p FROM uniforms",
    terms="""SELECT boat_code, municipality_name, n_days, p, list_reduce(
      list_prepend([pow(1 - p, n_days)], list_transform(range(1, n_days + 1), lambda i: [(n_days - i + 1)::DOUBLE / i * (p / (1 - p))])),
      lambda a, b: list_append(a, a[-1] * b[1])) AS pmf FROM steps""",
    below="SELECT * EXCLUDE (pmf), list_transform(range(1, n_days + 1), lambda i: list_sum(pmf[1:i])) AS cdf FROM terms",
    drawn_trips="""SELECT boat_code, municipality_name, draw, sum(n_days) AS n_days, sum(len(list_filter(cdf, lambda c: c <= u)))::DOUBLE AS n_trips
    FROM uniforms JOIN below USING (boat_code, municipality_name, n_days, p) GROUP BY ALL""",
    drawn_hyper=rate_hyper("drawn_trips", "boat_code, draw"),
    refitted=shrunk_rate("drawn_trips", "drawn_hyper", "boat_code, draw"),
)

# Files and days ----------------------------------------------------------------------------

oracle(
    "point_files",
    """SELECT trip, start, "end", "range", boat_id, boat_name, community, CASE WHEN day(day) % 2 = 1 THEN imei END AS imei, day FROM trp""",
    "pts",
    "trp",
)
oracle(
    "days_rewritten",
    """SELECT day, count(*) AS n, round(sum(range_meters), 4) AS metres FROM pts
    WHERE day < DATE '2024-01-16' OR range_meters > 100
      OR day NOT IN (SELECT day FROM pts WHERE day >= DATE '2024-01-16' AND range_meters > 100) GROUP BY 1""",
    "pts",
)
oracle(
    "sketch_ranks",
    """SELECT municipality_name, unnest([0.025, 0.17, 0.5, 0.83, 0.975])::DOUBLE AS mark, count(trip_value_po_3) AS n, TRUE AS within
    FROM order_trips GROUP BY 1""",
    "stations",
    "order_trips",
)

# Robust prices: the rounds of the t fit --------------------------------------------------------


def student(rounds: int, iterations: int, freedom: float = 4.0) -> dict[str, str]:
    out = {
        "slots": """SELECT record_id, ln(trip_price) AS y, weight_1 + weight_2 + weight_other AS total, unnest([
            {'level': species_code_1, 'w': weight_1}, {'level': species_code_2, 'w': weight_2}, {'level': species_code_other, 'w': weight_other}]) AS m
            FROM wide_trips WHERE trip_price > 0 AND trip_platform = 'boat'""",
        "terms": """SELECT record_id, 'species' AS factor, m.level AS level, sum(m.w / total) AS x, any_value(y) AS y FROM slots WHERE m.w > 0 GROUP BY ALL
            UNION ALL SELECT record_id, 'intercept', '', 1.0::DOUBLE, any_value(y) FROM slots WHERE m.w > 0 GROUP BY ALL""",
        "priced": "SELECT record_id, y FROM terms WHERE factor = 'intercept'",
        "eff_0": """SELECT factor, level, CASE WHEN factor = 'intercept' THEN (SELECT avg(y) FROM priced) ELSE 0 END AS value, 1.0::DOUBLE AS variance
            FROM (SELECT DISTINCT factor, level FROM terms)""",
        "scale_0": "SELECT greatest(var_samp(y), 1e-4) AS scale FROM priced",
    }
    for i in range(rounds):
        out[f"res_{i}"] = f"""SELECT record_id, y - fitted AS r, omega, omega / scale AS w FROM (SELECT record_id, y, fitted, scale,
            ({freedom} + 1) / ({freedom} + (y - fitted) * (y - fitted) / scale) AS omega FROM priced JOIN (
            SELECT record_id, sum(x * value) AS fitted FROM terms JOIN eff_{i} USING (factor, level) GROUP BY 1) USING (record_id), scale_{i})"""
        out[f"prec_{i}"] = f"SELECT 1 / greatest(avg(value * value + variance), 1e-4) AS prec FROM eff_{i} WHERE factor <> 'intercept'"
        out[f"sys_{i}"] = f"""SELECT 0 AS fit, factor, level, value, weight + p AS size, pull - p * value AS score FROM (
            SELECT s.*, value, CASE WHEN factor = 'intercept' THEN 0 ELSE prec END AS p FROM (SELECT factor, level, sum(w * x * x) AS weight,
            sum(w * x * r) AS pull FROM terms JOIN res_{i} USING (record_id) GROUP BY ALL) s JOIN eff_{i} USING (factor, level), prec_{i})"""
        out[f"lnk_{i}"] = f"""SELECT 0 AS fit, a.factor, a.level, b.factor AS other, b.level AS other_level, sum(w * a.x * b.x) AS weight FROM terms a
            JOIN terms b USING (record_id) JOIN res_{i} USING (record_id) WHERE a.factor <> b.factor OR a.level <> b.level GROUP BY ALL"""
        out |= solved(f"t{i}", f"sys_{i}", f"lnk_{i}", "fit", iterations, "fit")
        out[f"eff_{i + 1}"] = f"SELECT factor, level, value + x AS value, 1 / size AS variance FROM sys_{i} JOIN t{i}_x USING (fit, factor, level)"
        out[f"scale_{i + 1}"] = f"SELECT greatest(avg(omega * r * r), 1e-4) AS scale FROM res_{i}"
    return out


ORACLES["q_price_student"] = stored(
    """SELECT level AS species_code, round(value, 4) AS effect, round(value + (SELECT value FROM eff_2 WHERE factor = 'intercept'), 4) AS estimate
    FROM eff_2 WHERE factor <> 'intercept'""",
    "wide_trips",
    **student(2, 3),
)

ORDER_LEVELS = {k: v for k, v in ACTIVITY_LEVELS.items() if k != "place_period"}
ORDERS = """SELECT period_static, individual_boat, boat_code, municipality_name, period_seasonal, n_days::DOUBLE AS n, n_trips AS k
    FROM order_cells"""
ORACLES["q_model_trips"] = stored(
    f"""SELECT municipality_name, boat_code AS boat_type, period_static, n, n_days_month, draw, round(estimate, 4) AS rate,
    round(n * estimate * n_days_month, 4) AS n_trips FROM predicted""",
    "stations",
    "muni",
    "order_cells",
    **fitted(2, 3, ORDER_LEVELS, ORDERS, 0.0),
    **drawn_effects(2, 2, ORDER_LEVELS),
    nums=GRID["nums"],
    grid=GRID["grid"],
    named_grid=f"""SELECT *, boat_type AS boat_code, '' AS l_intercept, municipality_name AS l_place, CAST(period_static AS VARCHAR) AS l_period,
    CAST(month(period_static) AS VARCHAR) AS l_season FROM grid""",
    predicted=predicted("named_grid", "draw_effects", ["intercept", "place", "period", "season"], "draw", "shares_2"),
)
