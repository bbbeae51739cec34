"""Expected results of :mod:`stratamart.plans.queries`, in SQL for an independent engine."""

from __future__ import annotations

from stratamart.contracts import FACT_TRIP

TRIPS = """
t AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
trips AS (
  SELECT event_id,
    CASE WHEN user_id % 2 = 0 THEN 'yellow' ELSE 'green' END AS taxi_type,
    CAST(CASE WHEN user_id % 75 = 74 THEN NULL ELSE ([1,2,6,7])[(user_id % 4) + 1] END AS INTEGER)
      AS VendorID,
    CASE WHEN k % 25 = 24 THEN NULL ELSE k % 7 END AS passenger_count,
    CAST(CASE WHEN k % 20 = 19 THEN -value ELSE value END AS DECIMAL(10,2)) AS total_amount,
    CASE WHEN event_id % 997 = 0 THEN NULL ELSE ts END AS pickup_datetime,
    CASE WHEN k = 50 THEN NULL ELSE ts + to_minutes(k - 2) END AS dropoff_datetime,
    value AS trip_distance,
    CASE WHEN k % 10 = 9 THEN NULL ELSE k % 6 + 1 END AS RatecodeID,
    CAST(CASE WHEN user_id % 50 = 49 THEN NULL ELSE user_id + 1 END AS INTEGER) AS PULocationID,
    CASE WHEN k % 33 = 32 THEN NULL ELSE k + 1 END AS DOLocationID,
    CASE WHEN event_type = 'signup' THEN NULL ELSE k % 4 + 1 END AS payment_type,
    CASE WHEN user_id % 2 <> 0 AND k % 5 <> 4 THEN k / 4 END AS ehail_fee,
    CASE WHEN user_id % 2 <> 0 AND k % 9 <> 8 THEN k % 2 + 1 END AS trip_type,
    event_type,
    CASE WHEN event_type = 'error' THEN props END AS _rescued_data
  FROM t)
"""

# Names and bounds of the rules.
PREDICATES = {
    "passenger_count_not_null": "passenger_count IS NOT NULL",
    "passenger_count_positive": "passenger_count > 0",
    "dropoff_after_pickup": "dropoff_datetime > pickup_datetime",
    "total_amount_non_negative": "total_amount >= 0",
    "pickup_not_null": "pickup_datetime IS NOT NULL",
    "dropoff_not_null": "dropoff_datetime IS NOT NULL",
    "vendor_not_null": "VendorID IS NOT NULL",
    "pickup_in_study_range": "pickup_datetime >= TIMESTAMP '2024-01-03'"
    " AND pickup_datetime < TIMESTAMP '2024-01-29'",
}
ALL_HOLD = " AND ".join(f"coalesce({p}, false)" for p in PREDICATES.values())
REASONS = (
    "concat_ws(',', "
    + ", ".join(
        f"CASE WHEN coalesce({p}, false) THEN NULL ELSE '{n}' END" for n, p in PREDICATES.items()
    )
    + ")"
)

# The parts of a trip's key, and the columns that the test tables have no values for.
KEY_COLUMNS = (
    "VendorID",
    "pickup_datetime",
    "dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "RatecodeID",
    "store_and_fwd_flag",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "airport_fee",
)
WITHOUT_VALUES = (
    "store_and_fwd_flag",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
)
GREEN_KEY_COLUMNS = ("ehail_fee", "trip_type")


def key_part(column: str) -> str:
    return "'__null__'" if column in WITHOUT_VALUES else f"coalesce(CAST({column} AS VARCHAR), '__null__')"


KEY = "sha256(concat_ws('|', {}))".format(
    ", ".join(
        [
            "taxi_type",
            *map(key_part, KEY_COLUMNS),
            *(f"CASE WHEN taxi_type = 'green' THEN {key_part(c)} END" for c in GREEN_KEY_COLUMNS),
        ]
    )
)

CLEAN = f"{TRIPS}, clean AS (SELECT *, {KEY} AS tripsk FROM trips WHERE {ALL_HOLD})"
REJECTED = (
    f"{TRIPS}, rejected AS (SELECT *, {REASONS} AS reasons FROM trips WHERE NOT ({ALL_HOLD}))"
)
FACT_COLUMNS = """tripsk, CAST(strftime(pickup_datetime, '%Y%m%d') AS INTEGER) AS date_key,
  VendorID AS vendor_id, passenger_count, total_amount, pickup_datetime, dropoff_datetime,
  date_diff('second', date_trunc('second', pickup_datetime),
            date_trunc('second', dropoff_datetime)) AS duration_seconds,
  taxi_type"""
FACT = f"""{CLEAN}, fact AS (
  SELECT {FACT_COLUMNS}, TIMESTAMP '2024-02-01' AS _ingestion_ts FROM clean)"""

ORDERS = """fact AS (
  SELECT o_orderstatus AS taxi_type, o_orderdate AS pickup_datetime,
    CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
    CAST(o_totalprice AS DECIMAL(10,2)) AS total_amount,
    CAST(o_custkey % 7 AS INTEGER) AS passenger_count
  FROM orders)"""
LINES = """fact AS (
  SELECT l_returnflag AS taxi_type, l_shipdate AS pickup_datetime,
    CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS date_key,
    CAST(l_extendedprice AS DECIMAL(10,2)) AS total_amount,
    CAST(l_quantity AS INTEGER) AS passenger_count
  FROM lineitem)"""
CALENDAR = """calendar AS (
  SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE)
    AS full_date FROM orders)"""

# Mean of a decimal, kept to six digits and then rounded to two, half up both times.
CENTS = "sum(CAST(round(total_amount * 100) AS HUGEINT))"
MONEY_MEAN = (
    f"CAST(((({CENTS} * 20000 + count(*)) // (2 * count(*))) + 5000) // 10000 AS DOUBLE) / 100"
)
MEASURES = f"""count(*) AS trip_count,
  CAST(sum(total_amount) AS DECIMAL(18,2)) AS total_amount_sum,
  CAST(sum(passenger_count) AS BIGINT) AS passenger_count_sum,
  {MONEY_MEAN} AS avg_total_amount,
  round(avg(passenger_count), 4) AS avg_passenger_count"""
HOURLY = f"""SELECT date_key, CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour, taxi_type,
  {MEASURES} FROM fact GROUP BY ALL"""
MONTHLY = f"""SELECT CAST(strftime(pickup_datetime, '%Y%m') AS INTEGER) AS month_key,
  CAST(year(pickup_datetime) AS INTEGER) AS year, CAST(month(pickup_datetime) AS INTEGER) AS month,
  taxi_type, {MEASURES} FROM fact GROUP BY ALL"""
Q1 = f"""WITH {ORDERS}
  SELECT CAST(year(pickup_datetime) AS INTEGER) AS year,
    CAST(month(pickup_datetime) AS INTEGER) AS month,
    {MONEY_MEAN} AS avg_total_amount, count(*) AS trip_count
  FROM fact WHERE taxi_type = 'F' GROUP BY ALL"""
Q2 = f"""WITH {FACT}
  SELECT CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
    round(avg(passenger_count), 4) AS avg_passengers, count(*) AS trip_count
  FROM fact WHERE date_key BETWEEN 20240101 AND 20240131 GROUP BY ALL"""

UPSERTED = """
SELECT coalesce(s.VendorID, f.VendorID) AS VendorID,
  coalesce(s.passenger_count, f.passenger_count) AS passenger_count,
  coalesce(s.total_amount, f.total_amount) AS total_amount,
  coalesce(s.pickup_datetime, f.pickup_datetime) AS pickup_datetime,
  coalesce(s.dropoff_datetime, f.dropoff_datetime) AS dropoff_datetime,
  coalesce(s.tripsk, f.tripsk) AS tripsk,
  coalesce(s._ingestion_ts, f._ingestion_ts) AS _ingestion_ts
FROM (SELECT *, TIMESTAMP '2024-02-01' AS _ingestion_ts FROM clean
      WHERE pickup_datetime < TIMESTAMP '2024-01-20') f
FULL OUTER JOIN (SELECT *, TIMESTAMP '2024-02-02' AS _ingestion_ts FROM clean
      WHERE pickup_datetime >= TIMESTAMP '2024-01-10') s USING (tripsk)"""

# The columns whose absence matters.
CRITICAL = (
    "VendorID",
    "passenger_count",
    "RatecodeID",
    "PULocationID",
    "DOLocationID",
    "payment_type",
)
NULLS = ", ".join(f"count(*) FILTER ({c} IS NULL) AS {c.lower()}_nulls" for c in CRITICAL)
ANY_NULL = " OR ".join(f"{c} IS NULL" for c in CRITICAL)
TRIP_COLUMNS = """event_id, taxi_type, VendorID, passenger_count, total_amount, pickup_datetime,
  dropoff_datetime"""


def percentiles(column: str, source: str) -> str:
    points = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    found = ", ".join(f"quantile_disc({column}, {p}) AS {n}_{column}" for n, p in points.items())
    return f"""WITH {source} SELECT taxi_type, min({column}) AS min_{column}, {found},
      max({column}) AS max_{column}
      FROM {"trips" if "trips AS" in source else "fact"} WHERE {column} IS NOT NULL
      GROUP BY taxi_type"""


LANDED = """landed AS (
  SELECT DISTINCT 'orders' AS source, strftime(o_orderdate, '%Y-%m') AS period,
    year(o_orderdate) % 2 = 0 AS narrow FROM orders),
  columns(column_name, data_type) AS (VALUES
    ('o_orderkey', 'bigint'), ('o_custkey', 'bigint'), ('o_orderstatus', 'string'),
    ('o_totalprice', 'double'), ('o_orderdate', 'timestamp_ntz'), ('o_orderpriority', 'string')),
  snapshot AS (
    SELECT source, period, column_name,
      CASE WHEN column_name = 'o_custkey' AND narrow THEN 'int'
        WHEN column_name = 'o_orderdate' AND NOT narrow THEN 'timestamp' ELSE data_type END AS data_type,
      true AS nullable
    FROM landed CROSS JOIN columns)"""

EXPECTED: dict[str, str] = {
    "rules_split_summary": f"""WITH {TRIPS}, counted AS (
        SELECT taxi_type, count(*) AS rows_in, count(*) FILTER ({ALL_HOLD}) AS rows_clean,
          count(*) FILTER (NOT ({ALL_HOLD})) AS rows_quarantine
        FROM trips GROUP BY taxi_type)
      SELECT *, CAST(rows_quarantine AS DOUBLE) / greatest(rows_in, 1) * 100 AS quarantine_pct
      FROM counted""",
    "rule_failures": f"WITH {TRIPS} "
    + " UNION ALL ".join(
        f"SELECT '{n}' AS rule, count(*) FILTER (NOT coalesce({p}, false)) AS failed_rows FROM trips"
        for n, p in PREDICATES.items()
    ),
    "clean_trips": f"WITH {CLEAN} SELECT {TRIP_COLUMNS} FROM clean",
    "quarantine_trips": f"""WITH {REJECTED} SELECT event_id, taxi_type, VendorID,
        CAST(passenger_count AS DOUBLE) AS passenger_count,
        CAST(total_amount AS DOUBLE) AS total_amount, pickup_datetime, dropoff_datetime, reasons
      FROM rejected""",
    "quarantine_by_reason": f"""WITH {REJECTED}
      SELECT taxi_type, reasons, count(*) AS rows_in_quarantine FROM rejected GROUP BY ALL""",
    "quarantine_bounds": f"""WITH {REJECTED} SELECT taxi_type, count(*) AS quarantine_rows,
        min(pickup_datetime) AS min_pickup_datetime, max(pickup_datetime) AS max_pickup_datetime
      FROM rejected GROUP BY taxi_type""",
    "quarantine_samples": f"""WITH {REJECTED} SELECT {TRIP_COLUMNS}, reasons FROM rejected
      ORDER BY taxi_type, pickup_datetime NULLS FIRST, event_id LIMIT 50""",
    "surrogate_key": f"WITH {TRIPS} SELECT event_id, {KEY} AS tripsk FROM trips",
    "duplicate_keys": """SELECT sha256(concat_ws('|', l_orderkey, l_returnflag)) AS line_key,
        count(*) AS count FROM lineitem GROUP BY l_orderkey, l_returnflag HAVING count(*) > 1""",
    "duplicate_keys_topk": """SELECT sha256(concat_ws('|', l_orderkey, l_returnflag)) AS line_key,
        count(*) AS count FROM lineitem GROUP BY l_orderkey, l_returnflag HAVING count(*) > 1
      ORDER BY count DESC, line_key LIMIT 10""",
    "keep_one_per_key": """SELECT l_orderkey, l_returnflag, l_shipdate, l_linenumber, l_quantity
      FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_returnflag
        ORDER BY l_shipdate DESC, l_linenumber DESC, l_quantity DESC) = 1""",
    "upsert_silver": f"WITH {CLEAN} {UPSERTED}",
    "upsert_stored": f"WITH {CLEAN} {UPSERTED}",
    "upsert_bucketed": f"WITH {CLEAN} {UPSERTED}",
    "overwritten_by_position": """SELECT o_orderpriority AS priority,
        CASE WHEN year(o_orderdate) % 2 <> 0 THEN 2 * count(*) ELSE count(*) END AS orders,
        o_orderstatus AS status, CAST(year(o_orderdate) AS INTEGER) AS year
      FROM orders GROUP BY o_orderpriority, o_orderstatus, year(o_orderdate)""",
    "bounds_from_footers": """SELECT o_orderstatus, count(*) AS rows,
        count(o_orderkey) AS n_o_orderkey, min(o_orderkey) AS min_o_orderkey, max(o_orderkey) AS max_o_orderkey,
        count(o_totalprice) AS n_o_totalprice, min(o_totalprice) AS min_o_totalprice, max(o_totalprice) AS max_o_totalprice,
        count(o_orderdate) AS n_day, CAST(min(o_orderdate) AS DATE) AS min_day, CAST(max(o_orderdate) AS DATE) AS max_day
      FROM orders GROUP BY o_orderstatus""",
    "refused_in_write": f"""WITH {TRIPS}
      SELECT passenger_count, count(*) AS rows, max(event_id) AS last, true AS named
      FROM (SELECT *, date_diff('second', date_trunc('second', pickup_datetime),
          date_trunc('second', dropoff_datetime)) AS duration_seconds FROM trips)
      WHERE event_id % 997 <> 0 AND total_amount >= 0 AND passenger_count > 0 AND duration_seconds >= 0
      GROUP BY passenger_count""",
    "orphan_keys": """SELECT 'l_suppkey' AS link, count(DISTINCT l_suppkey) AS used,
        count(DISTINCT l_suppkey) FILTER (NOT EXISTS (SELECT 1 FROM supplier
          WHERE s_suppkey = l_suppkey AND s_acctbal >= 0)) AS orphan_keys FROM lineitem
      UNION ALL SELECT 'l_partkey', count(DISTINCT l_partkey),
        count(DISTINCT l_partkey) FILTER (NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey)) FROM lineitem""",
    "upsert_fact_union": f"""WITH {CLEAN} SELECT {FACT_COLUMNS},
        CASE WHEN pickup_datetime >= TIMESTAMP '2024-01-10' THEN TIMESTAMP '2024-02-02'
          ELSE TIMESTAMP '2024-02-01' END AS _ingestion_ts
      FROM clean""",
    "orphans_date": f"""WITH {FACT} SELECT taxi_type, date_key, count(*) AS orphans FROM fact
      WHERE NOT EXISTS (SELECT 1 FROM generate_series(DATE '2024-01-01', DATE '2024-01-15',
          INTERVAL 1 DAY) d(day)
        WHERE CAST(strftime(day, '%Y%m%d') AS INTEGER) = fact.date_key)
      GROUP BY ALL""",
    "orphans_vendor": f"""WITH {TRIPS} SELECT taxi_type, VendorID, count(*) AS orphans FROM trips
      WHERE VendorID IS NULL OR VendorID NOT IN (1, 2, 6) GROUP BY ALL""",
    "orphan_counts": """SELECT count(*) AS rows,
        count(*) FILTER (l_suppkey IS NULL OR NOT EXISTS (SELECT 1 FROM supplier
          WHERE s_suppkey = l_suppkey AND s_acctbal >= 0)) AS orphans_l_suppkey,
        count(*) FILTER (l_partkey IS NULL OR NOT EXISTS (SELECT 1 FROM part
          WHERE p_partkey = l_partkey)) AS orphans_l_partkey
      FROM lineitem""",
    "constraint_violations": f"""WITH {TRIPS}, raw AS (SELECT *,
        date_diff('second', date_trunc('second', pickup_datetime),
          date_trunc('second', dropoff_datetime)) AS duration_seconds FROM trips)
      SELECT 'tripsk_required' AS check_name, count(*) FILTER (event_id % 997 = 0) AS violations FROM raw
      UNION ALL SELECT 'ck_positive_amount',
        count(*) FILTER (NOT coalesce(total_amount >= 0, false)) FROM raw
      UNION ALL SELECT 'ck_valid_passenger',
        count(*) FILTER (NOT coalesce(passenger_count > 0, false)) FROM raw
      UNION ALL SELECT 'ck_valid_duration',
        count(*) FILTER (NOT coalesce(duration_seconds >= 0, false)) FROM raw""",
    "dim_date": f"""WITH {CALENDAR} SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key,
        full_date, CAST(year(full_date) AS INTEGER) AS year,
        CAST(quarter(full_date) AS INTEGER) AS quarter, CAST(month(full_date) AS INTEGER) AS month,
        CAST(day(full_date) AS INTEGER) AS day,
        CAST(dayofweek(full_date) + 1 AS INTEGER) AS day_of_week,
        CAST(weekofyear(full_date) AS INTEGER) AS week_of_year,
        dayofweek(full_date) IN (0, 6) AS is_weekend
      FROM calendar""",
    "dim_vendor": f"""WITH {TRIPS}, known(vendor_id, vendor_name, vendor_short_name) AS (VALUES -- fixed values
        (1, 'Creative Mobile Technologies, LLC', 'CMT'), (2, 'VeriFone Inc.', 'VeriFone'),
        (6, 'Myle Technologies Inc', 'Myle'), (7, 'Helix', 'Helix'))
      SELECT vendor_id, vendor_name, vendor_short_name, nullif(count(VendorID), 0) AS trips
      FROM known LEFT JOIN trips ON vendor_id = VendorID GROUP BY ALL""",
    "fact_trip": f"WITH {FACT} SELECT * FROM fact",
    "agg_hourly_daily": f"WITH {FACT} {HOURLY}",
    "agg_hourly_daily_lines": f"WITH {LINES} {HOURLY}",
    "agg_monthly": f"WITH {ORDERS} {MONTHLY}",
    "agg_monthly_rollup": f"WITH {ORDERS} {MONTHLY}",
    "q1_monthly_mean": Q1,
    "q1_from_fact": Q1,
    "q2_hourly_mean": Q2,
    "q2_from_fact": Q2,
    "null_profile": f"""WITH {TRIPS} SELECT taxi_type, count(*) AS total_rows,
        count(_rescued_data) AS rescued_rows, {NULLS} FROM trips GROUP BY taxi_type""",
    "null_profile_rescued": f"""WITH {TRIPS} SELECT taxi_type, count(*) AS rescued_rows, {NULLS}
      FROM trips WHERE _rescued_data IS NOT NULL GROUP BY taxi_type""",
    "null_attribution": f"""WITH {TRIPS}
      SELECT taxi_type, count(*) AS rows_with_null_passenger_count,
        count(_rescued_data) AS rescued_rows_with_null_passenger_count
      FROM trips WHERE passenger_count IS NULL GROUP BY taxi_type""",
    "rescued_samples": f"""WITH {TRIPS} SELECT event_id, taxi_type, {", ".join(CRITICAL)},
        _rescued_data
      FROM trips WHERE _rescued_data IS NOT NULL AND ({ANY_NULL})
      ORDER BY taxi_type, event_id LIMIT 50""",
    "null_samples": f"""WITH {TRIPS} SELECT {TRIP_COLUMNS}, _rescued_data FROM trips
      WHERE passenger_count IS NULL
      ORDER BY taxi_type, pickup_datetime NULLS FIRST, event_id LIMIT 50""",
    "range_outliers": f"""WITH {TRIPS} SELECT taxi_type, count(*) AS rows_outside_study_range,
        min(pickup_datetime) AS min_pickup_datetime, max(pickup_datetime) AS max_pickup_datetime
      FROM trips WHERE pickup_datetime < TIMESTAMP '2024-01-03'
        OR pickup_datetime >= TIMESTAMP '2024-01-29' GROUP BY taxi_type""",
    "time_bounds": f"""WITH {TRIPS} SELECT taxi_type, min(pickup_datetime) AS min_pickup_datetime,
        max(pickup_datetime) AS max_pickup_datetime FROM trips GROUP BY taxi_type""",
    "fact_bounds": f"""WITH {FACT} SELECT taxi_type, min(pickup_datetime) AS min_pickup_datetime,
        max(pickup_datetime) AS max_pickup_datetime, min(total_amount) AS min_total_amount,
        max(total_amount) AS max_total_amount FROM fact GROUP BY taxi_type""",
    "percentiles_passengers": percentiles("passenger_count", TRIPS),
    "percentiles_amount": percentiles("total_amount", TRIPS),
    "percentiles_distance": percentiles("trip_distance", TRIPS),
    "percentiles_line_price": percentiles("total_amount", LINES),
    "percentiles_incremental": f"""WITH {LINES} SELECT taxi_type, count(*) AS rows,
        CAST(min(total_amount) AS DOUBLE) AS min_amount, CAST(max(total_amount) AS DOUBLE) AS max_amount,
        true AS p50_near, true AS p95_near, true AS p99_near
      FROM fact GROUP BY taxi_type""",
    "top_passengers": f"""WITH {TRIPS} SELECT event_id, taxi_type, pickup_datetime,
        dropoff_datetime, passenger_count, trip_distance, total_amount
      FROM trips WHERE passenger_count IS NOT NULL
      ORDER BY passenger_count DESC, total_amount DESC, event_id LIMIT 25""",
    "top_amounts": f"""WITH {TRIPS} SELECT event_id, taxi_type, pickup_datetime,
        dropoff_datetime, passenger_count, trip_distance, total_amount
      FROM trips WHERE total_amount IS NOT NULL
      ORDER BY total_amount DESC, trip_distance DESC, event_id LIMIT 25""",
    "monthly_trips": f"""WITH {ORDERS} SELECT taxi_type,
        strftime(pickup_datetime, '%Y-%m') AS year_month, count(*) AS trips
      FROM fact GROUP BY ALL""",
    "hourly_trips": f"""WITH {FACT} SELECT CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour,
        count(*) AS trips, round(avg(passenger_count), 4) AS avg_passenger_count
      FROM fact WHERE pickup_datetime >= TIMESTAMP '2024-01-10'
        AND pickup_datetime < TIMESTAMP '2024-01-20' GROUP BY ALL""",
    "table_metrics": f"""WITH {TRIPS}
      SELECT 'trips' AS table, 'rows' AS metric, count(*) AS value FROM trips
      UNION ALL SELECT 'trips', 'rescued_rows', count(_rescued_data) FROM trips
      UNION ALL SELECT 'orders', 'rows', count(*) FROM orders
      UNION ALL SELECT 'lineitem', 'rows', count(*) FROM lineitem""",
    "rescue_recover": """SELECT event_id, CAST(value AS DECIMAL(10,2)) AS value,
        CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(NULL AS DOUBLE) AS absent,
        props AS _rescued_data
      FROM events""",
    "schema_snapshot": f"WITH {LANDED} SELECT * FROM snapshot",
    "type_drift": f"""WITH {LANDED} SELECT source, column_name,
        count(DISTINCT data_type) AS distinct_types,
        string_agg(period || ' -> ' || data_type, ',' ORDER BY period) AS observed_types
      FROM snapshot GROUP BY source, column_name HAVING count(DISTINCT data_type) > 1""",
    "bronze_stream": f"""WITH {TRIPS}
      SELECT CAST(user_id AS INTEGER) AS VendorID, ts AS tpep_pickup_datetime,
        ts + to_minutes(k) AS tpep_dropoff_datetime,
        CASE WHEN k % 25 = 24 THEN NULL ELSE k % 7 END AS passenger_count,
        value AS trip_distance, CAST(event_id AS INTEGER) AS PULocationID,
        CASE WHEN ts < TIMESTAMP '2024-01-20' THEN value END AS airport_fee,
        CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN '{{"kind":"' || event_type || '"}}'
          WHEN ts >= TIMESTAMP '2024-01-10' THEN '{{"Airport_fee":' || value || '}}'
          WHEN k % 25 <> 24 THEN '{{"passenger_count":' || (k % 7) || '.0}}' END AS _rescued_data
      FROM t""",
    "published_silver": f"""WITH {TRIPS} SELECT taxi_type, VendorID, passenger_count, total_amount,
        pickup_datetime, dropoff_datetime, {KEY} AS tripsk
      FROM trips WHERE {ALL_HOLD}""",
    "published_quarantine": f"""WITH {REJECTED} SELECT taxi_type, VendorID,
        CAST(passenger_count AS DOUBLE) AS passenger_count,
        CAST(total_amount AS DOUBLE) AS total_amount, pickup_datetime, dropoff_datetime, reasons
      FROM rejected""",
    "published_fact": f"""WITH {TRIPS}, clean AS (
        SELECT *, {KEY} AS tripsk FROM trips WHERE {ALL_HOLD})
      SELECT {FACT_COLUMNS} FROM clean""",
    "published_fact_incremental": f"""WITH {TRIPS}, clean AS (
        SELECT *, {KEY} AS tripsk FROM trips WHERE {ALL_HOLD})
      SELECT {FACT_COLUMNS} FROM clean""",
    "rejudged_batches": f"""WITH {TRIPS} SELECT taxi_type, VendorID, pickup_datetime, dropoff_datetime,
        CASE WHEN {ALL_HOLD} THEN 'silver' ELSE 'aside' END AS side
      FROM trips""",
    "bronze_two_checkpoints": "SELECT CAST(event_id AS INTEGER) AS PULocationID FROM events",
    "bronze_uniform": """SELECT CAST(event_id AS INTEGER) AS PULocationID, value AS trip_distance
      FROM events""",
    "stored_fact_answers": f"""WITH {FACT}
      SELECT 'hour ' || hour(pickup_datetime) AS part, round(avg(passenger_count), 4) AS mean,
        count(*) AS trip_count
      FROM fact WHERE date_key BETWEEN 20240101 AND 20240131 GROUP BY hour(pickup_datetime)
      UNION ALL
      SELECT 'month ' || year(pickup_datetime) || ' ' || month(pickup_datetime), {MONEY_MEAN}, count(*)
      FROM fact WHERE taxi_type = 'yellow' GROUP BY year(pickup_datetime), month(pickup_datetime)""",
    "lake_checks": f"""WITH {TRIPS}
      SELECT 'rows_in_silver' AS what, count(*) AS value FROM trips WHERE {ALL_HOLD}
      UNION ALL SELECT * FROM (VALUES ('keys_twice_in_yellow_trips', 0), ('keys_twice_in_green_trips', 0),
        ('keys_twice_in_fact_trip', 0), ('days_in_calendar', 26), ('comments_as_stated', {len(FACT_TRIP.column_comments)}))""",
    "view_totals": f"""WITH {TRIPS}
      SELECT 'bronze' AS view, taxi_type, count(*) AS rows,
        count(*) FILTER (event_type = 'error') AS rescued FROM trips GROUP BY taxi_type
      UNION ALL SELECT 'fact', taxi_type, count(*), 0 FROM trips WHERE {ALL_HOLD} GROUP BY taxi_type
      UNION ALL SELECT * FROM (VALUES ('landing', 'yellow', 11, 0), ('landing', 'green', 13, 0))""",
    "rescued_in_bronze": f"""WITH {TRIPS}
      SELECT taxi_type, '{{"trip_distance":' || trip_distance || '}}' AS _rescued_data
      FROM trips WHERE event_type = 'error'
      QUALIFY row_number() OVER (PARTITION BY taxi_type ORDER BY '{{"trip_distance":' || trip_distance || '}}') <= 3""",
    "evolved_table": """SELECT event_id, value,
        CASE WHEN event_id % 2 <> 0 THEN event_type END AS kind
      FROM events""",
    "published_monthly_mart": f"WITH {FACT} {MONTHLY}",
    "published_hourly_mart": f"WITH {FACT} {HOURLY}",
    "published_answer": Q2,
}

# Columns that are decimals above; results are compared with decimals as doubles.
_AMOUNT, _SUM = ("total_amount",), ("total_amount_sum",)
_ENDS = ("min_total_amount", "max_total_amount")
_POINTS = (*_ENDS, "p50_total_amount", "p95_total_amount", "p99_total_amount")
DECIMALS: dict[str, tuple[str, ...]] = {
    "clean_trips": _AMOUNT,
    "quarantine_samples": _AMOUNT,
    "upsert_silver": _AMOUNT,
    "upsert_stored": _AMOUNT,
    "upsert_bucketed": _AMOUNT,
    "upsert_fact_union": _AMOUNT,
    "fact_trip": _AMOUNT,
    "null_samples": _AMOUNT,
    "top_passengers": _AMOUNT,
    "top_amounts": _AMOUNT,
    "published_silver": _AMOUNT,
    "published_fact": _AMOUNT,
    "published_fact_incremental": _AMOUNT,
    "agg_hourly_daily": _SUM,
    "agg_hourly_daily_lines": _SUM,
    "agg_monthly": _SUM,
    "agg_monthly_rollup": _SUM,
    "published_hourly_mart": _SUM,
    "published_monthly_mart": _SUM,
    "fact_bounds": _ENDS,
    "percentiles_amount": _POINTS,
    "percentiles_line_price": _POINTS,
    "rescue_recover": ("value",),
}


def _comparable(sql: str, decimals: tuple[str, ...]) -> str:
    if not decimals:
        return sql
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in decimals)
    return f"SELECT * REPLACE ({casts}) FROM ({sql}) AS expected"


ORACLES = {name: _comparable(sql, DECIMALS.get(name, ())) for name, sql in EXPECTED.items()}
