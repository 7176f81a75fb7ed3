"""The registered queries in DuckDB SQL, over the same tables.

``RELATIONS`` are named building blocks; a query is a SELECT over them, and gets those it needs as common table
expressions.
"""

from __future__ import annotations

import re

from checks.bindings import AUDIT_TS, BATCHES

TRIP = (
    "vendorid, tpep_pickup_datetime, tpep_dropoff_datetime, trip_distance, pulocationid, dolocationid, payment_type, "
    "fare_amount, total_amount"
)
DIM_TAIL = "hash_diff, version_number, is_current, start_date, end_date"
ZONE_COLUMNS = f"zone_key, locationid, zone, borough, {DIM_TAIL}"
VENDOR_COLUMNS = f"vendor_key, vendorid, vendor_name, {DIM_TAIL}"
AT = {number: f"TIMESTAMP '{run.run_ts}'" for number, run in BATCHES.items()}
AUDITED = f"TIMESTAMP '{AUDIT_TS}'"

RELATIONS: dict[str, str] = {}

# -- trips

RELATIONS["t_raw"] = """
SELECT CASE WHEN l_orderkey % 499 <> 0 THEN l_suppkey % 8 END AS vendorid,
       CASE WHEN l_partkey % 997 <> 0 THEN o_orderdate + l_linenumber * INTERVAL 1 HOUR END AS tpep_pickup_datetime,
       o_orderdate + l_linenumber * INTERVAL 1 HOUR + CAST(l_quantity - 1 AS INTEGER) * INTERVAL 1 MINUTE
         AS tpep_dropoff_datetime,
       CASE WHEN l_partkey % 500 = 0 THEN -1 WHEN l_partkey % 501 = 0 THEN NULL ELSE l_quantity END AS trip_distance,
       CAST(c_nationkey + CASE WHEN l_partkey % 300 = 0 THEN 100 ELSE 0 END AS DOUBLE) AS pulocationid,
       l_partkey % 25 AS dolocationid,
       CAST(l_linenumber - 1 AS VARCHAR) AS payment_type,
       c_acctbal + 900 AS fare_amount,
       l_extendedprice * (1 - l_discount) AS total_amount,
       CASE WHEN l_partkey % 503 <> 0 THEN CAST(l_suppkey % 5 AS INTEGER) END AS passenger_count,
       l_returnflag AS store_and_fwd_flag
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"""

RELATIONS["t_typed"] = """
SELECT * REPLACE (
  TRY_CAST(vendorid AS INTEGER) AS vendorid, TRY_CAST(pulocationid AS INTEGER) AS pulocationid,
  TRY_CAST(dolocationid AS INTEGER) AS dolocationid, TRY_CAST(payment_type AS INTEGER) AS payment_type)
FROM t_raw"""

# A comparison with an unknown operand counts as passed, but for the order of the two times.
MEASURES = "coalesce(least(trip_distance, fare_amount, total_amount) >= 0, TRUE)"
IN_ORDER = "coalesce(tpep_dropoff_datetime > tpep_pickup_datetime, FALSE)"
KEYED = "vendorid + pulocationid + dolocationid IS NOT NULL"
RELATIONS["t_flagged"] = f"SELECT *, {IN_ORDER} AND {KEYED} AND {MEASURES} AS is_valid FROM t_typed"
RELATIONS["t_flagged_v0"] = f"""
SELECT *, {IN_ORDER} AND {MEASURES} AND coalesce(passenger_count, 1) >= 1 AS is_valid FROM t_typed"""

RELATIONS["t_valid"] = f"SELECT {TRIP} FROM t_flagged WHERE is_valid"
RELATIONS["t_valid_v0"] = f"SELECT {TRIP}, passenger_count FROM t_flagged_v0 WHERE is_valid"


def _eligible(source: str) -> str:
    return f"SELECT * FROM {source} WHERE payment_type > 0 AND tpep_dropoff_datetime > tpep_pickup_datetime"


def _first_per_trip(source: str, ties: str = "") -> str:
    order = ("tpep_dropoff_datetime", "dolocationid", "trip_distance", "fare_amount", "total_amount", "payment_type")
    ranked = ", ".join(f"{c} ASC NULLS FIRST" for c in (*order, *ties.split()))
    return (
        f"SELECT * FROM {source} QUALIFY row_number() OVER "
        f"(PARTITION BY vendorid, tpep_pickup_datetime, pulocationid ORDER BY {ranked}) = 1"
    )


def _measured(source: str) -> str:
    return f"""
SELECT * EXCLUDE (s), s / 60.0 AS trip_duration_minutes,
       CASE WHEN s > 0 THEN round(trip_distance / (s / 3600.0::DOUBLE), 2) END AS speed_mph
FROM (SELECT *, CAST(tpep_pickup_datetime AS DATE) AS trip_date,
             CAST(date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) AS DOUBLE) AS s FROM {source})
WHERE s > 0"""


PROCESSED = (
    "vendorid, pulocationid, dolocationid, tpep_pickup_datetime, tpep_dropoff_datetime, trip_date, trip_distance, "
    "fare_amount, total_amount, payment_type, trip_duration_minutes, speed_mph"
)
RELATIONS["t_eligible"] = _eligible("t_valid")
RELATIONS["t_deduped"] = _first_per_trip("t_eligible")
RELATIONS["t_measured"] = _measured("t_deduped")
RELATIONS["t_processed"] = f"SELECT {PROCESSED} FROM t_measured"
RELATIONS["t_eligible_v0"] = "SELECT * FROM t_valid_v0 WHERE tpep_dropoff_datetime > tpep_pickup_datetime"
RELATIONS["t_deduped_v0"] = _first_per_trip("t_eligible_v0", "passenger_count")
RELATIONS["t_processed_v0"] = _measured("t_deduped_v0")

# -- master data


def _zone_records(batch: int) -> str:
    borough = (
        "CASE c_custkey % 10 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'N/A' WHEN 3 THEN ' unknown ' "
        "WHEN 4 THEN 'na' ELSE r_name END"
    )
    if batch in (2, 3):
        borough = f"CASE WHEN r_name = 'AFRICA' THEN 'moved' ELSE {borough} END"
    sql = f"""
SELECT CAST(c_nationkey AS VARCHAR) AS locationid,
       '  ' || c_name || repeat(' x', CAST(c_custkey % 9 AS INTEGER)) AS zone, {borough} AS borough
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
    if batch > 1:
        sql += """
WHERE n_name <> 'NATION_3'
UNION ALL SELECT CAST(25 + r_regionkey AS VARCHAR), 'all ' || r_name, r_name FROM region"""
    return sql


def _standard(source: str, outside: str = "OUTSIDE NYC") -> str:
    return f"""
SELECT TRY_CAST(locationid AS INTEGER) AS locationid, upper(trim(zone)) AS zone,
       CASE WHEN b IS NULL OR b IN ('', 'UNKNOWN', 'N/A', 'NA') THEN '{outside}' ELSE b END AS borough
FROM (SELECT locationid, zone, upper(trim(borough)) AS b FROM {source})"""


def _golden(source: str) -> str:
    return (
        f"SELECT * FROM {source} QUALIFY row_number() OVER "
        "(PARTITION BY locationid ORDER BY length(zone) DESC NULLS LAST, zone NULLS FIRST, borough NULLS FIRST) = 1"
    )


for _batch in (1, 2, 3, 4):
    RELATIONS[f"z_raw{_batch}"] = _zone_records(_batch)
    RELATIONS[f"z_std{_batch}"] = _standard(f"z_raw{_batch}")
    RELATIONS[f"z_gold{_batch}"] = _golden(f"z_std{_batch}")

VENDOR_NAME = (
    "CASE vendorid WHEN 1 THEN 'CREATIVE MOBILE TECHNOLOGIES, LLC' WHEN 2 THEN 'CURB MOBILITY, LLC' "
    "WHEN 6 THEN 'MYLE TECHNOLOGIES INC' WHEN 7 THEN 'HELIX' ELSE 'UNKNOWN' END"
)
RELATIONS["v_gold"] = f"SELECT DISTINCT vendorid, {VENDOR_NAME} AS vendor_name FROM t_processed"
RELATIONS["v_known"] = "SELECT * FROM v_gold WHERE vendor_name <> 'UNKNOWN'"


def _vendors_v0(nation: str, kept: str) -> str:
    return f"""
SELECT TRY_CAST(code AS INTEGER) AS vendor_code,
       CASE WHEN name IS NULL OR name = '' THEN 'UNKNOWN' ELSE name END AS vendor_name,
       CASE WHEN flag IS NULL THEN TRUE ELSE TRY_CAST(flag AS BOOLEAN) END AS active_flag
FROM (SELECT CAST(s_suppkey AS VARCHAR) AS code,
             upper(trim(CASE s_suppkey % 4 WHEN 0 THEN '  ' WHEN 1 THEN NULL ELSE ' ' || s_name || ' ' END)) AS name,
             CASE ({nation}) % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' END AS flag
      FROM supplier WHERE {kept})"""


RELATIONS["v_v0"] = _vendors_v0("s_nationkey", "TRUE")
RELATIONS["v_v0_second"] = _vendors_v0("s_nationkey + s_suppkey % 2", "s_suppkey % 5 <> 0")

# -- dimensions


def _hash(key: str, attributes: tuple[str, ...]) -> str:
    return "sha256(concat_ws('||', " + ", ".join(
        [f"CAST({key} AS VARCHAR)", *[f"coalesce(CAST({a} AS VARCHAR), '')" for a in attributes]]
    ) + "))"


def _hashed(source: str, key: str, attributes: tuple[str, ...]) -> str:
    return f"SELECT {key}, {', '.join(attributes)}, {_hash(key, attributes)} AS hash_diff FROM {source}"


def _surrogate(key: str, at: str, version: str) -> str:
    return f"sha256(concat_ws('||', CAST({key} AS VARCHAR), CAST({at} AS VARCHAR), CAST({version} AS VARCHAR)))"


def _initial(hashed: str, surrogate: str, key: str, attributes: tuple[str, ...], at: str) -> str:
    return f"""
SELECT {_surrogate(key, at, '1')} AS {surrogate}, {key}, {', '.join(attributes)}, hash_diff, 1 AS version_number,
       TRUE AS is_current, {at} AS start_date, CAST(NULL AS TIMESTAMP) AS end_date
FROM {hashed}"""


def _changes(hashed: str, dim: str, key: str, attributes: tuple[str, ...]) -> str:
    columns = ", ".join(f"n.{c}" for c in (key, *attributes, "hash_diff"))
    return f"""
SELECT {columns}, CAST(CASE WHEN c.{key} IS NULL THEN 1 ELSE c.version_number + 1 END AS INTEGER) AS version_number
FROM {hashed} n LEFT JOIN (SELECT * FROM {dim} WHERE is_current) c ON n.{key} = c.{key}
WHERE c.{key} IS NULL OR n.hash_diff <> c.hash_diff"""


def _expired(dim: str, changes: str, surrogate: str, key: str, attributes: tuple[str, ...], at: str) -> str:
    """The whole dimension joined to the changed keys, current rows of those closed."""
    columns = ", ".join(f"o.{c}" for c in (surrogate, key, *attributes, "hash_diff", "version_number"))
    hit = f"o.is_current AND k.{key} IS NOT NULL"
    return f"""
SELECT {columns}, CASE WHEN {hit} THEN FALSE ELSE o.is_current END AS is_current, o.start_date,
       CASE WHEN {hit} THEN {at} ELSE o.end_date END AS end_date
FROM {dim} o LEFT JOIN (SELECT DISTINCT {key} FROM {changes}) k ON o.{key} = k.{key}"""


def _merged(expired: str, changes: str, surrogate: str, key: str, attributes: tuple[str, ...], at: str) -> str:
    return f"""
SELECT * FROM {expired}
UNION ALL
SELECT {_surrogate(key, at, 'version_number')} AS {surrogate}, {key}, {', '.join(attributes)}, hash_diff,
       version_number, TRUE, {at}, CAST(NULL AS TIMESTAMP)
FROM {changes}"""


def _dimension(prefix: str, goldens: dict[int, str], surrogate: str, key: str, attributes: tuple[str, ...]) -> None:
    previous = ""
    for batch, golden in goldens.items():
        hashed, dim = f"{prefix}_hash{batch}", f"{prefix}_dim{batch}"
        RELATIONS[hashed] = _hashed(golden, key, attributes)
        if not previous:
            RELATIONS[dim] = _initial(hashed, surrogate, key, attributes, AT[batch])
        else:
            changes, expired = f"{prefix}_chg{batch}", f"{prefix}_exp{batch}"
            RELATIONS[changes] = _changes(hashed, previous, key, attributes)
            RELATIONS[expired] = _expired(previous, changes, surrogate, key, attributes, AT[batch])
            RELATIONS[dim] = _merged(expired, changes, surrogate, key, attributes, AT[batch])
        previous = dim


_dimension("z", {b: f"z_gold{b}" for b in (1, 2, 3, 4)}, "zone_key", "locationid", ("zone", "borough"))
_dimension("v", {1: "v_known", 2: "v_gold"}, "vendor_key", "vendorid", ("vendor_name",))
_dimension("w", {1: "v_v0", 2: "v_v0_second"}, "vendor_key", "vendor_code", ("vendor_name", "active_flag"))

# -- fact


def _fact(trips: str, vendors: str = "v_dim1") -> str:
    return f"""
SELECT t.*, v.vendor_key, z.zone_key AS pickup_zone_key,
       z.zone_key IS NULL AS zone_orphan_flag, v.vendor_key IS NULL AS vendor_orphan_flag
FROM {trips} t
LEFT JOIN (SELECT * FROM z_dim1 WHERE is_current) z ON t.pulocationid = z.locationid
LEFT JOIN (SELECT * FROM {vendors} WHERE is_current) v ON t.vendorid = v.vendorid"""


FACT = (
    "vendorid, pulocationid AS pickup_location_id, dolocationid AS dropoff_location_id, vendor_key, pickup_zone_key, "
    "trip_date, tpep_pickup_datetime, tpep_dropoff_datetime, trip_distance, fare_amount, total_amount, payment_type, "
    "trip_duration_minutes, speed_mph, zone_orphan_flag, vendor_orphan_flag"
)
RELATIONS["fact"] = f"SELECT {FACT} FROM ({_fact('t_processed')})"

# The lake after two runs: what the first delivery made of the trips, and the fact of the second with all vendors known.
RELATIONS["first_raw"] = """
SELECT * REPLACE (CASE WHEN tpep_pickup_datetime::DATE = (SELECT min(tpep_pickup_datetime)::DATE FROM t_raw)
                       THEN total_amount + 1 ELSE total_amount END AS total_amount)
FROM t_raw
WHERE tpep_pickup_datetime IS NULL
   OR tpep_pickup_datetime::DATE < (SELECT max(tpep_pickup_datetime)::DATE FROM t_raw) - 1"""
RELATIONS["first_typed"] = """
SELECT * REPLACE (CAST(pulocationid AS INTEGER) AS pulocationid, CAST(payment_type AS INTEGER) AS payment_type) FROM first_raw"""
RELATIONS["first_valid"] = f"SELECT {TRIP} FROM first_typed WHERE {IN_ORDER} AND {KEYED} AND {MEASURES}"
RELATIONS["first_eligible"] = _eligible("first_valid")
RELATIONS["first_deduped"] = _first_per_trip("first_eligible")
RELATIONS["first_measured"] = _measured("first_deduped")
RELATIONS["v_all"] = f"""
SELECT * FROM ({_initial(f"({_hashed('v_gold', 'vendorid', ('vendor_name',))})", 'vendor_key', 'vendorid', ('vendor_name',),
                         AT[1])})"""
RELATIONS["lake_fact"] = f"SELECT {FACT} FROM ({_fact('t_processed', 'v_all')})"
RELATIONS["lake_first"] = f"SELECT {FACT} FROM ({_fact('first_measured', 'v_all')})"
RELATIONS["fact_first"] = f"SELECT {FACT} FROM ({_fact('first_measured')})"


def _touched(new: str, old: str) -> str:
    """Dates whose rows differ."""
    return f"""
SELECT DISTINCT trip_date FROM (
  (SELECT * FROM {new} EXCEPT ALL SELECT * FROM {old}) UNION ALL (SELECT * FROM {old} EXCEPT ALL SELECT * FROM {new}))"""


MONTH = "CAST(date_trunc('month', trip_date) AS DATE)"
RELATIONS["dates_touched"] = _touched("fact", "fact_first")
RELATIONS["months_touched"] = f"SELECT DISTINCT {MONTH} AS trip_month FROM ({_touched('lake_fact', 'lake_first')})"
RELATIONS["fact_v0"] = f"""
SELECT vendorid AS vendor_code, pulocationid AS pickup_location_id, dolocationid AS dropoff_location_id, vendor_key,
       pickup_zone_key, trip_date, tpep_pickup_datetime, tpep_dropoff_datetime,
       passenger_count, trip_distance, fare_amount, total_amount, payment_type, zone_orphan_flag, vendor_orphan_flag
FROM ({_fact("t_processed_v0")})"""

RELATIONS["load"] = """
SELECT (SELECT count(*) FROM z_dim1) AS zone_dim, (SELECT count(*) FROM v_dim1) AS vendor_dim, count(*) AS fact_trips,
       CASE WHEN count(*) = 0 THEN 0 ELSE count(total_amount) / count(*) END AS completeness,
       coalesce(sum(CASE WHEN zone_orphan_flag THEN 1 ELSE 0 END)::DOUBLE / nullif(count(*), 0), 0) AS zone_orphan_rate
FROM fact"""


def _gated(max_orphan_rate: float, min_completeness: float | None) -> str:
    incomplete = ""
    if min_completeness is not None:
        incomplete = f"CASE WHEN completeness < {min_completeness} THEN printf('completeness %.4f', completeness) END, "
    return f"""
SELECT *, CASE WHEN errors = '' THEN 'SUCCESS' ELSE 'FAILED' END AS status
FROM (SELECT *, concat_ws('; ',
        CASE WHEN zone_dim = 0 THEN 'zone_dim empty' END,
        CASE WHEN vendor_dim = 0 THEN 'vendor_dim empty' END,
        CASE WHEN fact_trips = 0 THEN 'fact_trips empty' END,
        {incomplete}CASE WHEN zone_orphan_rate > {max_orphan_rate} THEN printf('zone orphan rate %.4f', zone_orphan_rate) END
      ) AS errors FROM load)"""


RELATIONS["load_gated"] = _gated(0.01, 0.99)



def exact_sum(column: str, scale: int = 4) -> str:
    return f"sum(CAST({column} AS DECIMAL(18, {scale})))"


def _zone_revenue(fact: str) -> str:
    return f"""
SELECT trip_date, pickup_zone_key, count(*) AS trip_count, CAST({exact_sum("total_amount")} AS DOUBLE) AS total_revenue,
       CAST({exact_sum("fare_amount")} AS DOUBLE) / nullif(count(fare_amount), 0) AS avg_fare
FROM {fact} GROUP BY trip_date, pickup_zone_key"""


def _vendor_perf(fact: str) -> str:
    return f"""
SELECT trip_date, vendorid AS vendor_code, count(*) AS trip_count, CAST({exact_sum("total_amount")} AS DOUBLE) AS total_revenue,
       CAST({exact_sum("trip_distance", 6)} AS DOUBLE) / nullif(count(trip_distance), 0) AS avg_trip_distance
FROM {fact} GROUP BY trip_date, vendorid"""


def _daily_revenue(fact: str) -> str:
    return f"SELECT trip_date, CAST({exact_sum('total_amount')} AS DOUBLE) AS revenue FROM {fact} GROUP BY trip_date"


def _serving_fact(fact: str) -> str:
    return f"SELECT * RENAME (tpep_pickup_datetime AS pickup_datetime, tpep_dropoff_datetime AS dropoff_datetime) FROM {fact}"


def _metrics(gated: str, more: str = "") -> str:
    return f"""
SELECT 'FactRowCount' AS name, CAST(fact_trips AS DOUBLE) AS value, 'Count' AS unit{more} FROM {gated}
UNION ALL SELECT 'ZoneDimRowCount', zone_dim, 'Count'{more} FROM {gated}
UNION ALL SELECT 'VendorDimRowCount', vendor_dim, 'Count'{more} FROM {gated}
UNION ALL SELECT 'CompletenessPct', completeness * 100, 'Percent'{more} FROM {gated}
UNION ALL SELECT 'OrphanRatePct', zone_orphan_rate * 100, 'Percent'{more} FROM {gated}
UNION ALL SELECT 'PipelineDQStatus', 1, 'Count'{more} FROM {gated}"""


def _run_load(fact: str, run: int) -> str:
    return f"""
SELECT '{BATCHES[run].run_id}' AS run_id, {AT[run]} AS run_ts, (SELECT count(*) FROM z_dim1) AS zone_dim,
       (SELECT count(*) FROM v_all) AS vendor_dim, count(*) AS fact_trips, count(total_amount) / count(*) AS completeness,
       count(*) FILTER (zone_orphan_flag) / count(*) AS zone_orphan_rate
FROM {fact}"""


RELATIONS["lake_load"] = f"{_run_load('lake_first', 1)} UNION ALL {_run_load('lake_fact', 2)}"


def _run_audits(run: int, raw: str, valid: str, processed: str, inserted: int, written: str) -> str:
    zones, vendors = "(SELECT count(*) FROM z_gold1)", "(SELECT count(*) FROM v_gold)"
    rows = [
        ("validate", f"(SELECT count(*) FROM {raw})", f"(SELECT count(*) FROM {valid})"),
        ("process", f"(SELECT count(*) FROM {valid})", f"(SELECT count(*) FROM {processed})"),
        ("master_zones", "(SELECT count(*) FROM z_raw1)", zones),
        ("master_vendors", f"(SELECT count(*) FROM {processed})", vendors),
        ("scd2_zones", zones, f"{inserted} * {zones}"),
        ("scd2_vendors", vendors, f"{inserted} * {vendors}"),
        ("fact_trips", f"(SELECT count(*) FROM {processed})", f"(SELECT count(*) FROM {written})"),
        ("governance", f"(SELECT count(*) FROM {processed})", zones),
    ]
    return " UNION ALL ".join(
        f"SELECT '{name}' AS audit, '{BATCHES[run].run_id}' AS run_id, CAST({a} AS BIGINT) AS rows_in, CAST({b} AS BIGINT) AS rows_out"
        for name, a, b in rows
    )


def _backup(raw: str, run: int) -> str:
    return f"""
SELECT '{BATCHES[run].run_id}' AS run_id, count(*) AS rows, count(vendorid) AS vendors, count(passenger_count) AS passengers,
       CAST(sum(CAST(payment_type AS INTEGER)) AS VARCHAR) AS payment_types
FROM {raw}"""


SELECTS: dict[str, str] = {
    "scan_trips": "SELECT * FROM t_raw",
    "normalize_types": "SELECT * FROM t_typed",
    "validate_flags": f"SELECT {TRIP}, is_valid FROM t_flagged",
    "validate_rules_v0": f"SELECT {TRIP}, passenger_count, is_valid FROM t_flagged_v0",
    "validated_trips": "SELECT * FROM t_valid",
    "quarantined_trips": "SELECT * EXCLUDE (is_valid) FROM t_flagged WHERE NOT is_valid",
    "quarantine_reasons": f"""
SELECT {TRIP}, concat_ws(',',
  CASE WHEN vendorid IS NULL THEN 'vendor_known' END,
  CASE WHEN tpep_pickup_datetime IS NULL THEN 'pickup_known' END,
  CASE WHEN tpep_dropoff_datetime IS NULL THEN 'dropoff_known' END,
  CASE WHEN (tpep_dropoff_datetime > tpep_pickup_datetime) IS NOT TRUE THEN 'dropoff_after_pickup' END,
  CASE WHEN trip_distance < 0 THEN 'distance_not_negative' END,
  CASE WHEN fare_amount < 0 THEN 'fare_not_negative' END,
  CASE WHEN total_amount < 0 THEN 'total_not_negative' END,
  CASE WHEN pulocationid IS NULL THEN 'pickup_zone_known' END,
  CASE WHEN dolocationid IS NULL THEN 'dropoff_zone_known' END) AS broken_rules
FROM t_flagged WHERE NOT is_valid""",
    "validation_audit": f"""
SELECT *, CASE WHEN rows_in > 0 AND valid_pct < 0.9 THEN printf('valid share %.4f below %.2f', valid_pct, 0.9) ELSE ''
       END AS errors,
       CASE WHEN rows_in > 0 AND valid_pct < 0.9 THEN 'FAILED' ELSE 'SUCCESS' END AS status
FROM (SELECT {AUDITED} AS run_ts, count(*) AS rows_in, count(*) FILTER (is_valid) AS rows_valid,
             count(*) FILTER (NOT is_valid) AS rows_quarantined,
             CASE WHEN count(*) > 0 THEN count(*) FILTER (is_valid) / count(*) ELSE 0 END AS valid_pct
      FROM t_flagged)""",
    "process_filters": "SELECT * FROM t_eligible",
    "dedupe_trips": "SELECT * FROM t_deduped",
    "derive_trip_metrics": f"SELECT * FROM ({_measured('t_eligible')})",
    "processed_trips": "SELECT * FROM t_processed",
    "processed_trips_v0": f"SELECT {PROCESSED}, passenger_count FROM t_processed_v0",
    "process_audit": f"""
SELECT *, CASE WHEN rows_in > 0 THEN (rows_in - rows_after_dedupe) / rows_in ELSE 0 END AS dedupe_reduction_pct
FROM (SELECT {AUDITED} AS run_ts, (SELECT count(*) FROM t_valid) AS rows_in,
             (SELECT count(*) FROM t_deduped) AS rows_after_dedupe, (SELECT count(*) FROM t_processed) AS rows_out)""",
    "standardize_zones": "SELECT * FROM z_std1",
    "standardize_zones_mixed_case": f"SELECT * FROM ({_standard('z_raw1', 'Outside NYC')})",
    "golden_zones": "SELECT * FROM z_gold1",
    "golden_zones_audit": f"""
SELECT {AUDITED} AS run_ts, rows_in, rows_out, rows_in - rows_out AS duplicates_removed, 'LocationID' AS business_key,
       'deterministic' AS matching_type, 'longest zone name' AS survivorship
FROM (SELECT (SELECT count(*) FROM z_raw1) AS rows_in, (SELECT count(*) FROM z_gold1) AS rows_out)""",
    "dedupe_zones_by_name": f"""
SELECT min(locationid) AS locationid, zone, borough FROM ({_standard('z_raw1', 'Outside NYC')}) GROUP BY zone, borough""",
    "map_vendor_names": f"SELECT vendorid, pulocationid, {VENDOR_NAME} AS vendor_name FROM t_typed",
    "golden_vendors": "SELECT * FROM v_gold",
    "golden_vendors_audit": f"""
SELECT {AUDITED} AS run_ts, rows_in, rows_out, rows_in - rows_out AS duplicates_removed, 'VendorID' AS business_key,
       'deterministic' AS matching_type, 'TLC data dictionary' AS mapping_source
FROM (SELECT (SELECT count(*) FROM t_processed) AS rows_in, (SELECT count(*) FROM v_gold) AS rows_out)""",
    "vendor_defaults": "SELECT * FROM v_v0",
    "key_profile": """
SELECT count(*) AS row_count, count(*) FILTER (vendorid IS NULL) AS null_keys,
       (SELECT count(*) FROM (SELECT vendorid FROM t_typed WHERE vendorid IS NOT NULL GROUP BY vendorid
                              HAVING count(*) > 1)) AS duplicate_keys
FROM t_typed""",
    "duplicate_keys": "SELECT locationid, count(*) AS row_count FROM z_std1 GROUP BY locationid HAVING count(*) > 1",
    "hash_diff": f"SELECT * FROM ({_hashed('z_std1', 'locationid', ('zone', 'borough'))})",
    "scd2_initial": "SELECT * FROM z_dim1",
    "scd2_changes": "SELECT * FROM z_chg2",
    "scd2_stage": f"""
SELECT locationid AS merge_key, 'expire' AS op, locationid, CAST(NULL AS VARCHAR) AS zone_key,
       CAST(NULL AS VARCHAR) AS zone, CAST(NULL AS VARCHAR) AS borough, CAST(NULL AS VARCHAR) AS hash_diff,
       CAST(NULL AS INTEGER) AS version_number
FROM z_chg2
UNION ALL
SELECT NULL, 'insert', locationid, {_surrogate('locationid', AT[2], 'version_number')}, zone, borough, hash_diff,
       version_number
FROM z_chg2""",
    "scd2_expire": "SELECT * FROM z_exp2",
    "scd2_merge": "SELECT * FROM z_dim2",
    "scd2_audit": f"""
SELECT {AT[2]} AS run_ts, (SELECT count(*) FROM z_gold2) AS rows_in_golden, count(*) AS changed_input_rows,
       count(DISTINCT locationid) AS changed_keys, count(*) AS rows_inserted,
       count(*) FILTER (version_number > 1) AS rows_expired, 'merge_scd2' AS note
FROM z_chg2""",
    "scd2_noop": f"""
SELECT {AT[3]} AS run_ts, (SELECT count(*) FROM z_gold3) AS rows_in_golden, count(*) AS changed_input_rows,
       count(DISTINCT locationid) AS changed_keys, count(*) AS rows_inserted,
       count(*) FILTER (version_number > 1) AS rows_expired,
       CASE WHEN count(*) = 0 THEN 'noop_no_changes' ELSE 'merge_scd2' END AS note
FROM z_chg3""",
    "scd2_vendors": "SELECT * FROM v_dim2",
    "scd2_vendors_v0": f"""
SELECT * FROM ({_initial(f"({_hashed('v_v0', 'vendor_code', ('vendor_name', 'active_flag'))})", 'vendor_key',
                         'vendor_code', ('vendor_name', 'active_flag'), AT[1])})""",
    "scd2_violations": """
SELECT 'more_than_one_current' AS invariant, count(*) AS keys
FROM (SELECT locationid FROM z_dim2 WHERE is_current GROUP BY locationid HAVING count(*) > 1)
UNION ALL SELECT 'versions_not_contiguous', count(*)
FROM (SELECT locationid FROM z_dim2 GROUP BY locationid
      HAVING min(version_number) <> 1 OR max(version_number) <> count(DISTINCT version_number))
UNION ALL SELECT 'version_repeated', count(*)
FROM (SELECT locationid FROM z_dim2 GROUP BY locationid HAVING count(*) <> count(DISTINCT version_number))
UNION ALL SELECT 'open_end_not_current', count(DISTINCT locationid) FROM z_dim2
WHERE is_current <> (end_date IS NULL)
UNION ALL SELECT 'ends_before_start', count(DISTINCT locationid) FROM z_dim2 WHERE start_date > end_date""",
    "dim_current": "SELECT * FROM z_dim4 WHERE is_current",
    "dim_latest": "SELECT * FROM z_dim4",
    "dim_as_of_version": "SELECT * FROM z_dim2",
    "commit_history": f"""
SELECT 0 AS version, 'batch-1' AS run_id, {AT[1]} AS run_ts, 'WRITE' AS operation, count(*) AS rows_inserted,
       CAST(0 AS BIGINT) AS rows_expired, (SELECT count(*) FROM z_dim1 WHERE is_current) AS rows_current
FROM z_dim1
UNION ALL SELECT 1, 'batch-2', {AT[2]}, 'MERGE', count(*), count(*) FILTER (version_number > 1),
       (SELECT count(*) FROM z_dim2 WHERE is_current) FROM z_chg2
UNION ALL SELECT 2, 'batch-4', {AT[4]}, 'MERGE', count(*), count(*) FILTER (version_number > 1),
       (SELECT count(*) FROM z_dim4 WHERE is_current) FROM z_chg4""",
    "fact_trips": "SELECT * FROM fact",
    "fact_trips_v0": "SELECT * FROM fact_v0",
    "orphan_flags": "SELECT zone_orphan_flag, vendor_orphan_flag, count(*) AS trips FROM fact GROUP BY ALL",
    "fact_audit": f"""
SELECT {AUDITED} AS run_ts, count(*) AS rows_total,
       CASE WHEN count(*) > 0 THEN count(*) FILTER (zone_orphan_flag) / count(*) ELSE 0 END AS zone_orphan_rate,
       CASE WHEN count(*) > 0 THEN count(*) FILTER (vendor_orphan_flag) / count(*) ELSE 0 END AS vendor_orphan_rate
FROM fact""",
    "completeness": """
SELECT fact_count, null_rows, CASE WHEN fact_count > 0 THEN 1.0::DOUBLE - null_rows / fact_count ELSE 1 END
       AS completeness_pct
FROM (SELECT count(*) AS fact_count, count(*) FILTER (vendor_key IS NULL OR pickup_zone_key IS NULL OR trip_date IS NULL
             OR fare_amount IS NULL OR total_amount IS NULL) AS null_rows FROM fact)""",
    "completeness_amount": "SELECT completeness FROM load",
    "orphan_rate": "SELECT zone_orphan_rate FROM load",
    "orphan_rate_join": """
SELECT CASE WHEN count(*) = 0 THEN 0
       ELSE CAST(sum(CASE WHEN z.zone_key IS NULL THEN 1 ELSE 0 END) AS DOUBLE) / count(*) END AS orphan_rate
FROM fact f LEFT JOIN z_dim1 z ON f.pickup_zone_key = z.zone_key""",
    "table_counts": """
SELECT 'fact_trips' AS table_name, count(*) AS row_count FROM fact
UNION ALL SELECT 'zone_dim', count(*) FROM z_dim1
UNION ALL SELECT 'vendor_dim', count(*) FROM v_dim1""",
    "load_gate": "SELECT * FROM load_gated",
    "load_gate_strict": f"SELECT * FROM ({_gated(0.001, 0.999)})",
    "load_gate_counts": f"SELECT * FROM ({_gated(0.01, None)})",
    "exact_totals": f"""
SELECT vendorid, count(*) AS trips, CAST({exact_sum("total_amount")} AS VARCHAR) AS total_amount,
       CAST({exact_sum("fare_amount")} AS VARCHAR) AS fare_amount,
       CAST({exact_sum("trip_distance", 6)} AS VARCHAR) AS trip_distance,
       CAST({exact_sum("trip_duration_minutes", 2)} AS VARCHAR) AS trip_duration_minutes
FROM fact GROUP BY vendorid""",
    "scd2_next": f"""
SELECT 'keep' AS op, * FROM z_dim1 WHERE locationid NOT IN (SELECT locationid FROM z_chg2)
UNION ALL SELECT 'expire', * FROM z_exp2 WHERE NOT is_current
UNION ALL SELECT 'insert', * FROM z_dim2 WHERE start_date = {AT[2]}""",
    "scd2_vendors_v0_merge": "SELECT * FROM w_dim2",
    "commit_details": """
SELECT 0 AS version, 'first_run' AS action, count(*) AS changed_keys, count(*) AS rows_in_golden, 'zones of batch-1' AS source_path
FROM z_dim1
UNION ALL SELECT 1, 'merge_scd2', (SELECT count(*) FROM z_chg2), count(*), 'zones of batch-2' FROM z_gold2
UNION ALL SELECT 2, 'merge_scd2', (SELECT count(*) FROM z_chg4), count(*), 'zones of batch-4' FROM z_gold4""",
    "zones_by_header": """
SELECT locationid, trim(zone) AS zone, nullif(trim(borough), '') AS borough FROM z_raw1 WHERE length(zone) % 3 < 2""",
    "zones_malformed": """
SELECT locationid || ',' || zone || ',' || coalesce(borough, '') || ',more' AS line FROM z_raw1 WHERE length(zone) % 3 = 2""",
    "fact_incremental": "SELECT * FROM lake_fact",
    "fact_by_date": "SELECT * FROM fact",
    "fact_dates_touched": "SELECT trip_date, count(*) AS rows FROM fact WHERE trip_date IN (FROM dates_touched) GROUP BY trip_date",
    "fact_months_touched": f"""
SELECT {MONTH} AS trip_month, count(*) AS rows FROM lake_fact WHERE {MONTH} IN (FROM months_touched) GROUP BY 1""",
    "curated_catalog": f"""
SELECT {MONTH} AS trip_month, count(*) AS trips, count(DISTINCT trip_date) AS dates,
       CAST({exact_sum("total_amount")} AS VARCHAR) AS revenue
FROM lake_fact GROUP BY 1""",
    "curated_daily_revenue": _daily_revenue("lake_fact"),
    "published_zone_revenue": _zone_revenue("lake_fact"),
    "published_vendor_perf": _vendor_perf("lake_fact"),
    "published_fact_trips": _serving_fact("lake_fact"),
    "published_dimensions": """
SELECT 'zone' AS dimension, zone_key AS surrogate, locationid AS key, version_number, is_current, start_date, end_date, hash_diff
FROM z_dim1
UNION ALL SELECT 'vendor', vendor_key, vendorid, version_number, is_current, start_date, end_date, hash_diff FROM v_all""",
    "staged_runs": """
SELECT t AS table_name, run_id, n AS rows FROM lake_load UNPIVOT (n FOR t IN (zone_dim, vendor_dim, fact_trips))""",
    "serving_layout": """
SELECT CAST(0 AS BIGINT) AS out_of_order, count(*) AS trips, CAST(0 AS BIGINT) AS split_places FROM lake_fact""",
    "backup_snapshots": f"{_backup('first_raw', 1)} UNION ALL {_backup('t_raw', 2)}",
    "audit_log": " UNION ALL ".join([
        _run_audits(1, "first_raw", "first_valid", "first_measured", 1, "first_measured"),
        _run_audits(2, "t_raw", "t_valid", "t_processed", 0, f"(SELECT * FROM lake_fact WHERE {MONTH} IN (FROM months_touched))"),
    ]),
    "load_documents": """
SELECT run_id, run_ts AS run_ts_utc, 'zone_dim,vendor_dim,fact_trips' AS tables, zone_dim, vendor_dim, fact_trips, completeness,
       zone_orphan_rate AS orphan_rate, CAST(0 AS BIGINT) AS failures, 'SUCCESS' AS status
FROM lake_load""",
    "metric_points_log": _metrics("lake_load", ", run_id, run_ts"),
    "tables_exist": """
SELECT 'zones' AS dimension, TRUE AS present, count(*) AS current_rows FROM z_dim1 WHERE is_current
UNION ALL SELECT 'vendors', TRUE, count(*) FROM v_all
UNION ALL SELECT 'drivers', FALSE, 0""",
    "catalog_evolved": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS orders, count(DISTINCT o_custkey) AS customers,
       count(o_totalprice) AS priced
FROM orders WHERE year(o_orderdate) > (SELECT min(year(o_orderdate)) FROM orders) GROUP BY 1""",
    "metric_points": """
SELECT 'FactRowCount' AS name, CAST(fact_trips AS DOUBLE) AS value, 'Count' AS unit FROM load_gated
UNION ALL SELECT 'ZoneDimRowCount', zone_dim, 'Count' FROM load_gated
UNION ALL SELECT 'VendorDimRowCount', vendor_dim, 'Count' FROM load_gated
UNION ALL SELECT 'CompletenessPct', completeness * 100, 'Percent' FROM load_gated
UNION ALL SELECT 'OrphanRatePct', zone_orphan_rate * 100, 'Percent' FROM load_gated
UNION ALL SELECT 'PipelineDQStatus', CASE WHEN status = 'SUCCESS' THEN 1 ELSE 0 END, 'Count' FROM load_gated""",
    "governance_metrics": f"""
SELECT {AUDITED} AS run_ts_utc, *, CASE WHEN completeness_pct >= 0.99 AND zone_orphan_rate <= 0.01
       AND vendor_orphan_rate <= 0.01 THEN 'PASS' ELSE 'FAIL' END AS pipeline_status
FROM (SELECT count(*) AS fact_count,
        CASE WHEN count(*) > 0 THEN 1.0::DOUBLE - count(*) FILTER (vendor_key IS NULL OR pickup_zone_key IS NULL
          OR trip_date IS NULL OR fare_amount IS NULL OR total_amount IS NULL) / count(*) ELSE 1 END AS completeness_pct,
        CASE WHEN count(*) > 0 THEN count(*) FILTER (zone_orphan_flag) / count(*) ELSE 0 END AS zone_orphan_rate,
        CASE WHEN count(*) > 0 THEN count(*) FILTER (vendor_orphan_flag) / count(*) ELSE 0 END AS vendor_orphan_rate,
        (SELECT count(*) FROM z_dim1 WHERE is_current) AS current_zones,
        (SELECT count(*) FROM v_dim1 WHERE is_current) AS current_vendors
      FROM fact)""",
    "agg_daily_zone_revenue": _zone_revenue("fact"),
    "agg_daily_vendor_perf": _vendor_perf("fact"),
    "daily_revenue": _daily_revenue("fact"),
    "serving_fact_trips": _serving_fact("fact"),
    "serving_zone_dim": "SELECT * RENAME (locationid AS location_id) FROM z_dim2",
    "serving_vendor_dim": "SELECT * FROM v_dim2",
    "full_run_summary": """
SELECT CAST(step AS INTEGER) AS step, name, rows_in, rows_out, status FROM (
SELECT 1 AS step, 'validate' AS name, (SELECT count(*) FROM t_raw) AS rows_in, (SELECT count(*) FROM t_valid)
       AS rows_out, 'SUCCESS' AS status
UNION ALL SELECT 2, 'process', (SELECT count(*) FROM t_valid), (SELECT count(*) FROM t_processed), 'SUCCESS'
UNION ALL SELECT 3, 'master_zones', (SELECT count(*) FROM z_raw1), (SELECT count(*) FROM z_gold1), 'SUCCESS'
UNION ALL SELECT 4, 'master_vendors', (SELECT count(*) FROM t_processed), (SELECT count(*) FROM v_gold), 'SUCCESS'
UNION ALL SELECT 5, 'dim_zones', (SELECT count(*) FROM z_gold1), (SELECT count(*) FROM z_gold1), 'first_run'
UNION ALL SELECT 6, 'dim_vendors', (SELECT count(*) FROM v_gold), (SELECT count(*) FROM v_gold), 'first_run'
UNION ALL SELECT 7, 'fact_trips', (SELECT count(*) FROM t_processed), (SELECT count(*) FROM t_processed), 'SUCCESS'
UNION ALL SELECT 8, 'load', (SELECT count(*) FROM t_processed), (SELECT count(*) FROM t_processed), 'SUCCESS'
UNION ALL SELECT 9, 'governance', (SELECT count(*) FROM t_processed), (SELECT count(*) FROM t_processed), 'PASS')""",
}


def _needed(sql: str) -> list[str]:
    """Relations a statement uses, directly or through others, in definition order."""
    found: set[str] = set()
    todo = [sql]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in (words & RELATIONS.keys()) - found:
            found.add(name)
            todo.append(RELATIONS[name])
    return [name for name in RELATIONS if name in found]


def statement(select: str) -> str:
    parts = [f"{name} AS ({RELATIONS[name].strip()})" for name in _needed(select)]
    return f"WITH {', '.join(parts)} {select.strip()}" if parts else select.strip()


def all_statements() -> dict[str, str]:
    return {name: statement(select) for name, select in SELECTS.items()}
