"""DuckDB oracle SQL for the contract queries.

The fixture mapping here mirrors ``odometer.sources.fixtures`` expression
for expression.  Parity rules: literals cast to DOUBLE; rounding reproduces Spark's round
(HALF_UP on the shortest decimal text of the double, via a VARCHAR ->
DECIMAL(38,18) cast); two-decimal sums taken as DECIMAL(18,2); integer sums cast
to BIGINT; timestamps are plain (naive, UTC) TIMESTAMPs.
"""

from __future__ import annotations

from odometer.plans.params import (
    CLOSED_BEFORE,
    CLOSED_ZONE,
    CHECK_MINUTES,
    HEALTH_NOW,
    LATE_EVERY,
    LATE_FEE,
    LATEST_ZONE,
    REPORT_DAY,
    RERUN_FROM,
    THRESHOLD,
    UPDATED_AT_BATCH,
    UPDATED_AT_TARGET,
)


def d(x) -> str:
    """A DOUBLE literal."""
    return f"CAST({x} AS DOUBLE)"


def rnd(expr: str, n: int) -> str:
    """Spark's round(double, n): HALF_UP on the double's shortest decimal text."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"


def money_sum(expr: str) -> str:
    return f"CAST(sum(CAST({expr} AS DECIMAL(18,2))) AS DOUBLE)"


TELEMETRY = f"""
tel AS (
  SELECT event_id,
         'T' || CAST(k % 2 AS VARCHAR) AS trip_id,
         'D' || CAST(user_id AS VARCHAR) AS driver_id,
         'V' || CAST(user_id AS VARCHAR) AS vehicle_id,
         CAST(6800 + 3 * k AS DOUBLE) / {d(1000)} AS lat,
         CAST(79780 + 2 * ((event_id * 7) % 100) AS DOUBLE) / {d(1000)} AS lon,
         CAST(floor(value) AS INTEGER) AS speed,
         CASE event_type WHEN 'view' THEN 'idle' WHEN 'click' THEN 'enroute'
              WHEN 'purchase' THEN 'on_trip' WHEN 'signup' THEN 'on_trip'
              WHEN 'error' THEN 'offline' END AS status,
         CASE WHEN event_type IN ('purchase', 'signup') THEN value ELSE {d(0)} END AS fare,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS "timestamp",
         ts AS event_time
  FROM (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) ev
)"""

ZONE = f"""CASE WHEN lat < {d(6.85)} OR lat > {d(7.05)} OR lon < {d(79.80)} OR lon > {d(79.95)}
            THEN 'outside_service_area'
          WHEN lat >= {d(6.95)} THEN CASE WHEN lon >= {d(79.875)} THEN 'colombo_north_east' ELSE 'colombo_north_west' END
          ELSE CASE WHEN lon >= {d(79.875)} THEN 'colombo_south_east' ELSE 'colombo_south_west' END END"""

BOX_ZONE = f"""CASE WHEN lat >= {d(6.90)} AND lat < {d(6.94)} AND lon >= {d(79.83)} AND lon < {d(79.88)} THEN 'Colombo-Central'
          WHEN lat >= {d(6.90)} AND lat < {d(6.98)} AND lon >= {d(79.88)} AND lon < {d(79.95)} THEN 'Colombo-East'
          WHEN lat >= {d(6.90)} AND lat < {d(7.05)} AND lon >= {d(79.80)} AND lon < {d(79.83)} THEN 'Colombo-West'
          ELSE 'Other' END"""

VALID = """trip_id IS NOT NULL AND driver_id IS NOT NULL AND vehicle_id IS NOT NULL
    AND event_time IS NOT NULL AND status IN ('idle', 'enroute', 'on_trip')
    AND speed BETWEEN 0 AND 180 AND fare >= 0"""

CLEAN = f"""
clean AS (
  SELECT trip_id, driver_id, vehicle_id, lat, lon, speed, status, fare, "timestamp", event_time,
         {ZONE} AS zone
  FROM tel WHERE {VALID}
)"""

UTILIZATION = f"""
util AS (
  SELECT zone,
         count(*) AS telemetry_event_count,
         CAST(sum(CASE WHEN status = 'idle' THEN 1 ELSE 0 END) AS BIGINT) AS idle_event_count,
         CAST(sum(CASE WHEN status = 'on_trip' THEN 1 ELSE 0 END) AS BIGINT) AS on_trip_event_count,
         CAST(sum(CASE WHEN status <> 'idle' THEN 1 ELSE 0 END) AS BIGINT) AS active_event_count,
         {money_sum('fare')} AS observed_earnings,
         avg(speed) AS average_speed,
         time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start,
         time_bucket(INTERVAL 5 MINUTE, event_time) + INTERVAL 5 MINUTE AS window_end,
         {rnd('CAST(sum(CASE WHEN status = ' + "'idle'" + ' THEN 1 ELSE 0 END) AS DOUBLE) / CAST(count(*) AS DOUBLE)', 4)} AS idle_ratio
  FROM clean
  GROUP BY zone, time_bucket(INTERVAL 5 MINUTE, event_time)
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


ORACLES: dict[str, str] = {}

ORACLES["clean_telemetry"] = with_ctes(TELEMETRY, CLEAN) + "SELECT * FROM clean"

ORACLES["utilization_5m"] = with_ctes(TELEMETRY, CLEAN, UTILIZATION) + "SELECT * FROM util"

TRIP_REVENUE = f"""
trips AS (
  SELECT CAST(event_time AS DATE) AS report_date, vehicle_id, trip_id, max(fare) AS trip_fare
  FROM clean WHERE status = 'on_trip' AND fare > {d(0)}
  GROUP BY CAST(event_time AS DATE), vehicle_id, trip_id
),
rev AS (
  SELECT report_date, vehicle_id, count(trip_id) AS completed_trip_count,
         {money_sum('trip_fare')} AS trip_revenue
  FROM trips GROUP BY report_date, vehicle_id
)"""

EXPENSES = f"""
dates AS (SELECT DISTINCT CAST(event_time AS DATE) AS report_date FROM clean),
expenses AS (
  SELECT dates.report_date,
         'V' || CAST(s_suppkey AS VARCHAR) AS vehicle_id,
         {rnd('abs(s_acctbal) / ' + d(100), 2)} AS fuel_cost,
         CAST(s_nationkey AS DOUBLE) * {d(3.5)} AS maintenance_cost,
         CAST(15 + (s_suppkey * 37) % 205 AS DOUBLE) AS distance_covered,
         CASE WHEN s_suppkey % 8 = 0 THEN 'required' ELSE 'not_required' END AS service_flag
  FROM supplier CROSS JOIN dates
)"""

REPORT = f"""
joined AS (
  SELECT e.report_date, e.vehicle_id,
         coalesce(r.completed_trip_count, 0) AS completed_trip_count,
         coalesce(r.trip_revenue, {d(0)}) AS trip_revenue,
         e.fuel_cost, e.maintenance_cost,
         {rnd('e.fuel_cost + e.maintenance_cost', 2)} AS total_expense,
         e.distance_covered, e.service_flag
  FROM expenses e LEFT JOIN rev r ON e.report_date = r.report_date AND e.vehicle_id = r.vehicle_id
),
profit AS (
  SELECT *, {rnd('trip_revenue - total_expense', 2)} AS profit FROM joined
),
report AS (
  SELECT report_date, vehicle_id, completed_trip_count, trip_revenue, fuel_cost, maintenance_cost,
         total_expense, distance_covered, service_flag, profit,
         CASE WHEN trip_revenue > {d(0)} THEN {rnd('(profit / trip_revenue) * ' + d(100), 2)}
              ELSE CAST(NULL AS DOUBLE) END AS profit_margin_pct,
         CASE WHEN profit < {d(0)} THEN 'unprofitable' ELSE 'profitable' END AS profitability_status
  FROM profit
)"""

REPORT_CTES = (TELEMETRY, CLEAN, TRIP_REVENUE, EXPENSES, REPORT)

ORACLES["trip_revenue"] = with_ctes(TELEMETRY, CLEAN, TRIP_REVENUE) + "SELECT * FROM rev"

ORACLES["profitability_report"] = with_ctes(*REPORT_CTES) + "SELECT * FROM report"


ORACLES["profitability_report_day"] = (
    with_ctes(*REPORT_CTES)
    + f"SELECT * FROM report WHERE report_date = DATE '{REPORT_DAY}' ORDER BY profit NULLS FIRST, vehicle_id"
)

ORACLES["profitability_summary"] = with_ctes(*REPORT_CTES) + """
SELECT report_date,
       count(*) AS vehicle_count,
       count(*) FILTER (WHERE profitability_status = 'unprofitable') AS unprofitable_vehicle_count
FROM report GROUP BY report_date"""

ORACLES["unprofitable_vehicles"] = with_ctes(*REPORT_CTES) + """
SELECT report_date,
       row_number() OVER (PARTITION BY report_date ORDER BY profit NULLS FIRST, vehicle_id) AS position,
       vehicle_id, profit
FROM report WHERE profitability_status = 'unprofitable'"""

UTIL_SELECT = f"""zone,
         count(*) AS telemetry_event_count,
         CAST(sum(CASE WHEN status = 'idle' THEN 1 ELSE 0 END) AS BIGINT) AS idle_event_count,
         CAST(sum(CASE WHEN status = 'on_trip' THEN 1 ELSE 0 END) AS BIGINT) AS on_trip_event_count,
         CAST(sum(CASE WHEN status <> 'idle' THEN 1 ELSE 0 END) AS BIGINT) AS active_event_count,
         {money_sum('fare')} AS observed_earnings,
         avg(speed) AS average_speed,
         ws AS window_start,
         ws + INTERVAL 5 MINUTE AS window_end,
         {rnd("CAST(sum(CASE WHEN status = 'idle' THEN 1 ELSE 0 END) AS DOUBLE) / CAST(count(*) AS DOUBLE)", 4)} AS idle_ratio"""

HISTORY = f"""
hist_rows AS (
  SELECT *, CAST(floor((epoch_us(event_time) - epoch_us(ws)) / 100000000) AS INTEGER) AS row_step
  FROM (SELECT *, time_bucket(INTERVAL 5 MINUTE, event_time) AS ws FROM clean) c
),
fanned AS (
  SELECT h.*, v.spark_batch_id
  FROM hist_rows h JOIN (SELECT unnest([0, 1, 2]) AS spark_batch_id) v ON v.spark_batch_id >= h.row_step
),
history AS (
  SELECT {UTIL_SELECT},
         CAST(spark_batch_id AS BIGINT) AS spark_batch_id,
         ws + to_seconds(CAST((spark_batch_id + 1) * 100 AS BIGINT)) AS processed_at
  FROM fanned
  GROUP BY zone, ws, spark_batch_id
  HAVING count(*) FILTER (WHERE row_step = spark_batch_id) > 0
),
serving AS (
  SELECT * FROM history
  QUALIFY row_number() OVER (PARTITION BY window_start, window_end, zone
                             ORDER BY processed_at DESC, spark_batch_id DESC) = 1
)"""

SERVING_CTES = (TELEMETRY, CLEAN, HISTORY)

ORACLES["latest_metrics_per_key"] = with_ctes(*SERVING_CTES) + "SELECT * FROM serving"

ORACLES["batch_totals"] = with_ctes(*SERVING_CTES) + """
SELECT spark_batch_id, count(*) AS metric_rows, CAST(sum(telemetry_event_count) AS BIGINT) AS telemetry_events
FROM history GROUP BY spark_batch_id"""

ORACLES["utilization_upsert"] = with_ctes(*SERVING_CTES) + """,
target AS (
  SELECT * FROM history WHERE spark_batch_id <= 1
  QUALIFY row_number() OVER (PARTITION BY window_start, window_end, zone
                             ORDER BY processed_at DESC, spark_batch_id DESC) = 1
),
incoming AS (
  SELECT * FROM history WHERE spark_batch_id = 2
  UNION ALL SELECT * REPLACE (CAST(3 AS BIGINT) AS spark_batch_id) FROM history WHERE spark_batch_id = 0
  UNION ALL SELECT * REPLACE (CAST(4 AS BIGINT) AS spark_batch_id) FROM history WHERE spark_batch_id = 1
),
both_sides AS (
  SELECT *, 0 AS is_incoming FROM target UNION ALL SELECT *, 1 AS is_incoming FROM incoming
)
SELECT * EXCLUDE (is_incoming) FROM both_sides
QUALIFY row_number() OVER (PARTITION BY window_start, window_end, zone
                           ORDER BY processed_at DESC, is_incoming DESC, spark_batch_id DESC) = 1"""

LATEST_COLS = """zone, telemetry_event_count, idle_event_count, on_trip_event_count, active_event_count,
       observed_earnings, average_speed, window_start, window_end, idle_ratio, processed_at"""

ORACLES["latest_window"] = with_ctes(*SERVING_CTES) + f"""
SELECT {LATEST_COLS}, count(*) OVER () AS metric_window_count
FROM serving WHERE window_end = (SELECT max(window_end) FROM serving)
ORDER BY zone"""


ORACLES["latest_window_zone"] = with_ctes(*SERVING_CTES) + f"""
SELECT {LATEST_COLS}, count(*) OVER () AS metric_window_count
FROM serving WHERE window_end = (SELECT max(window_end) FROM serving) AND zone = '{LATEST_ZONE}'
ORDER BY zone"""


def dec(expr: str, p: int, s: int) -> str:
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18)), {s}) AS DECIMAL({p},{s}))"


CLOSED = f"""
closed AS (SELECT * FROM serving WHERE window_end <= TIMESTAMP '{CLOSED_BEFORE}'),
newest AS (SELECT * FROM closed WHERE window_end = (SELECT max(window_end) FROM closed))
SELECT zone, telemetry_event_count, idle_event_count, on_trip_event_count, active_event_count,
       observed_earnings, average_speed, window_start, window_end, idle_ratio, processed_at,
       count(*) OVER () AS metric_window_count
FROM newest"""

ORACLES["latest_window_closed"] = with_ctes(*SERVING_CTES) + "," + CLOSED

ORACLES["latest_window_closed_zone"] = with_ctes(*SERVING_CTES) + "," + CLOSED + f" WHERE zone = '{CLOSED_ZONE}'"

ORACLES["serving_conform"] = with_ctes(*SERVING_CTES) + f"""
SELECT window_start, window_end, zone,
       CAST(coalesce(telemetry_event_count, 0) AS INTEGER) AS telemetry_event_count,
       CAST(coalesce(idle_event_count, 0) AS INTEGER) AS idle_event_count,
       CAST(coalesce(on_trip_event_count, 0) AS INTEGER) AS on_trip_event_count,
       CAST(coalesce(active_event_count, 0) AS INTEGER) AS active_event_count,
       {dec('coalesce(observed_earnings, ' + d(0) + ')', 14, 2)} AS observed_earnings,
       {dec('coalesce(average_speed, ' + d(0) + ')', 8, 2)} AS average_speed,
       {dec('coalesce(idle_ratio, ' + d(0) + ')', 7, 4)} AS idle_ratio,
       spark_batch_id, processed_at
FROM serving"""


ORACLES["profitability_upsert"] = with_ctes(*REPORT_CTES) + f""",
rerun_joined AS (
  SELECT report_date, vehicle_id, completed_trip_count, trip_revenue, fuel_cost,
         maintenance_cost + {d(LATE_FEE)} AS maintenance_cost,
         {rnd('fuel_cost + (maintenance_cost + ' + d(LATE_FEE) + ')', 2)} AS total_expense,
         distance_covered, service_flag
  FROM report WHERE report_date >= DATE '{RERUN_FROM}' AND completed_trip_count > 0
),
rerun_profit AS (SELECT *, {rnd('trip_revenue - total_expense', 2)} AS profit FROM rerun_joined),
rerun AS (
  SELECT report_date, vehicle_id, completed_trip_count, trip_revenue, fuel_cost, maintenance_cost,
         total_expense, distance_covered, service_flag, profit,
         CASE WHEN trip_revenue > {d(0)} THEN {rnd('(profit / trip_revenue) * ' + d(100), 2)}
              ELSE CAST(NULL AS DOUBLE) END AS profit_margin_pct,
         CASE WHEN profit < {d(0)} THEN 'unprofitable' ELSE 'profitable' END AS profitability_status,
         TIMESTAMP '{UPDATED_AT_BATCH}' AS updated_at
  FROM rerun_profit
)
SELECT * FROM rerun
UNION ALL
SELECT r.*, TIMESTAMP '{UPDATED_AT_TARGET}' AS updated_at
FROM report r ANTI JOIN rerun n ON r.report_date = n.report_date AND r.vehicle_id = n.vehicle_id"""



def status_sql(now: str, last: str, threshold: int = THRESHOLD) -> str:
    """CTE-body columns: age_seconds, status, reason for check time ``now``."""
    age = (
        f"CASE WHEN {last} IS NULL THEN CAST(NULL AS BIGINT) ELSE "
        f"greatest(CAST(0 AS BIGINT), CAST(floor((epoch_us({now}) - epoch_us({last})) / 1000000) AS BIGINT)) END"
    )
    status = (
        f"CASE WHEN {last} IS NULL THEN 'degraded' WHEN ({age}) > {threshold} THEN 'unhealthy' ELSE 'healthy' END"
    )
    reason = (
        f"CASE WHEN {last} IS NULL THEN 'No telemetry metrics have been processed yet.' "
        f"WHEN ({age}) > {threshold} THEN 'No telemetry processed for ' || CAST(({age}) AS VARCHAR) || ' seconds.' "
        f"ELSE 'Telemetry is current.' END"
    )
    return f"{age} AS age_seconds, {status} AS status, {reason} AS reason"


SNAPSHOT = """
snapshot AS (
  SELECT (SELECT max(processed_at) FROM serving) AS last_processed_at,
         (SELECT count(*) FROM serving) AS metric_rows,
         (SELECT count(*) FROM report) AS profitability_rows
)"""

HEALTH_CTES = (TELEMETRY, CLEAN, HISTORY, TRIP_REVENUE, EXPENSES, REPORT, SNAPSHOT)

ORACLES["health_snapshot"] = with_ctes(*HEALTH_CTES) + "SELECT * FROM snapshot"

ORACLES["health_status"] = with_ctes(*HEALTH_CTES) + f"""
SELECT last_processed_at, metric_rows, profitability_rows,
       {status_sql(f"TIMESTAMP '{HEALTH_NOW}'", 'last_processed_at')},
       {THRESHOLD} AS no_data_alert_seconds,
       TIMESTAMP '{HEALTH_NOW}' AS checked_at
FROM snapshot"""

ORACLES["gauge_export"] = with_ctes(*HEALTH_CTES) + f""",
st AS (SELECT metric_rows, {status_sql(f"TIMESTAMP '{HEALTH_NOW}'", 'last_processed_at')} FROM snapshot)
SELECT 'fleet_serving_metric_rows' AS name, CAST(metric_rows AS BIGINT) AS value FROM st
UNION ALL
SELECT 'fleet_last_telemetry_age_seconds' AS name, CAST(coalesce(age_seconds, -1) AS BIGINT) AS value FROM st"""


ORACLES["health_transitions"] = with_ctes(*SERVING_CTES) + f""",
bounds AS (
  SELECT CAST(CAST(min(processed_at) AS DATE) AS TIMESTAMP) AS lo,
         CAST(CAST(max(processed_at) AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY AS hi
  FROM history
),
checks AS (
  SELECT unnest(generate_series(lo, hi - INTERVAL {CHECK_MINUTES} MINUTE, INTERVAL {CHECK_MINUTES} MINUTE)) AS check_time
  FROM bounds
),
firsts AS (SELECT min(processed_at) AS t FROM history GROUP BY window_start, window_end, zone),
stamps AS (
  SELECT processed_at, sum(n) OVER (ORDER BY processed_at) AS metric_rows FROM (
    SELECT processed_at, (SELECT count(*) FROM firsts f WHERE f.t = h.processed_at) AS n
    FROM (SELECT DISTINCT processed_at FROM history) h
  ) x
),
asof_rows AS (
  SELECT c.check_time, s.processed_at AS last_processed_at, coalesce(s.metric_rows, 0) AS metric_rows
  FROM checks c ASOF LEFT JOIN stamps s ON c.check_time >= s.processed_at
),
st AS (SELECT check_time, last_processed_at, metric_rows, {status_sql('check_time', 'last_processed_at')} FROM asof_rows),
lagged AS (SELECT *, lag(status) OVER (ORDER BY check_time) AS prev_status FROM st)
SELECT check_time AS created_at,
       CASE status WHEN 'healthy' THEN 'info' WHEN 'degraded' THEN 'warning' WHEN 'unhealthy' THEN 'critical' END
         AS severity,
       'no_telemetry_processed' AS rule_name,
       reason AS message, status, age_seconds, last_processed_at,
       CAST(to_json({{'status': status, 'reason': reason, 'age_seconds': age_seconds,
                      'last_processed_at': strftime(last_processed_at, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00',
                      'metric_rows': CAST(metric_rows AS BIGINT), 'profitability_rows': CAST(NULL AS BIGINT),
                      'no_data_alert_seconds': {THRESHOLD}}}) AS VARCHAR)
         AS context
FROM lagged WHERE prev_status IS NULL OR status <> prev_status"""


ORACLES["zone_assignment"] = with_ctes(TELEMETRY) + f"SELECT event_id, lat, lon, {ZONE} AS zone FROM tel"

ORACLES["zone_boxes"] = with_ctes(TELEMETRY) + f"SELECT event_id, lat, lon, {BOX_ZONE} AS zone FROM tel"

ORACLES["telemetry_json_roundtrip"] = with_ctes(TELEMETRY) + """
SELECT trip_id, driver_id, vehicle_id, lat, lon, speed, status, fare, "timestamp" FROM tel"""

ORACLES["utc_normalize"] = "SELECT event_id, ts AS local_time, ts - INTERVAL 330 MINUTE AS utc_time FROM events"

ORACLES["telemetry_checks"] = with_ctes(TELEMETRY) + """
SELECT CAST(event_time AS DATE) AS event_date,
       count(*) AS rows,
       count(*) FILTER (WHERE trip_id IS NULL OR driver_id IS NULL OR vehicle_id IS NULL OR lat IS NULL
                        OR lon IS NULL OR speed IS NULL OR status IS NULL OR fare IS NULL
                        OR "timestamp" IS NULL) AS missing_field_rows,
       count(*) FILTER (WHERE NOT coalesce(status IN ('idle', 'enroute', 'on_trip'), false)) AS bad_status_rows,
       count(*) FILTER (WHERE NOT coalesce(starts_with(vehicle_id, 'V'), false)) AS bad_vehicle_id_rows,
       count(*) FILTER (WHERE NOT coalesce(speed BETWEEN 0 AND 180, false)) AS bad_speed_rows,
       count(*) FILTER (WHERE NOT coalesce(fare >= 0, false)) AS bad_fare_rows,
       count(*) FILTER (WHERE event_time IS NULL) AS bad_time_rows,
       count(*) FILTER (WHERE NOT coalesce(""" + VALID + """, false)) AS rejected_rows,
       count(*) FILTER (WHERE coalesce(""" + VALID + """, false)) AS accepted_rows
FROM tel GROUP BY CAST(event_time AS DATE)"""

ORACLES["expense_feed_checks"] = with_ctes(TELEMETRY, CLEAN, EXPENSES) + """,
dim AS (SELECT DISTINCT vehicle_id FROM clean),
per_vehicle AS (
  SELECT e.report_date, e.vehicle_id, count(*) AS n, bool_or(d.vehicle_id IS NOT NULL) AS known,
         count(*) FILTER (WHERE NOT coalesce(e.fuel_cost > 0, false)) AS bad_fuel,
         count(*) FILTER (WHERE NOT coalesce(e.maintenance_cost >= 0, false)) AS bad_maintenance,
         count(*) FILTER (WHERE NOT coalesce(e.service_flag IN ('required', 'not_required'), false)) AS bad_flag
  FROM expenses e LEFT JOIN dim d ON e.vehicle_id = d.vehicle_id
  GROUP BY e.report_date, e.vehicle_id
)
SELECT report_date,
       CAST(sum(n) AS BIGINT) AS rows,
       CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS duplicate_vehicle_rows,
       CAST(coalesce(sum(n) FILTER (WHERE NOT known), 0) AS BIGINT) AS unknown_vehicle_rows,
       (SELECT count(*) FROM dim) - count(*) FILTER (WHERE known) AS missing_vehicles,
       CAST(sum(bad_fuel) AS BIGINT) AS bad_fuel_rows,
       CAST(sum(bad_maintenance) AS BIGINT) AS bad_maintenance_rows,
       CAST(sum(bad_flag) AS BIGINT) AS bad_flag_rows,
       CAST(0 AS BIGINT) AS date_mismatch_rows
FROM per_vehicle GROUP BY report_date"""

ORACLES["expense_feed_scan"] = with_ctes(TELEMETRY, CLEAN, EXPENSES) + """
SELECT report_date, vehicle_id, fuel_cost, maintenance_cost, distance_covered, service_flag,
       CAST(report_date AS VARCHAR) AS csv_report_date
FROM expenses"""

SLIDING = f"""
fan AS (
  SELECT t.*, time_bucket(INTERVAL 1 MINUTE, event_time) - to_minutes(CAST(ks.k AS BIGINT)) AS window_start
  FROM tel t JOIN (SELECT unnest([0, 1, 2, 3, 4]) AS k) ks ON true
  WHERE t.event_time IS NOT NULL
)"""

ORACLES["sliding_metrics"] = with_ctes(TELEMETRY, SLIDING) + f"""
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end,
       count(DISTINCT vehicle_id) AS active_vehicles,
       count(*) FILTER (WHERE status = 'idle') AS idle_events,
       count(*) AS total_events,
       count(DISTINCT trip_id) AS trips,
       {money_sum('fare')} AS total_earnings,
       avg(speed) AS average_speed,
       CAST(count(*) FILTER (WHERE status = 'idle') AS DOUBLE) / CAST(count(*) AS DOUBLE) AS idle_ratio
FROM fan GROUP BY window_start"""

DIRTY_TELEMETRY = """
dirty AS (
  SELECT CASE WHEN event_id % 31 <> 0 THEN trip_id END AS trip_id, driver_id,
         CASE WHEN event_id % 13 = 0 THEN 'X' || vehicle_id WHEN event_id % 11 <> 0 THEN vehicle_id END AS vehicle_id,
         lat, CASE WHEN event_id % 37 <> 0 THEN lon END AS lon,
         CASE WHEN event_id % 7 = 0 THEN speed + 200 WHEN event_id % 29 = 0 THEN -1 ELSE speed END AS speed,
         CASE WHEN event_id % 5 = 0 THEN 'parked' ELSE status END AS status,
         CASE WHEN event_id % 17 = 0 THEN CAST(-1 AS DOUBLE) WHEN event_id % 19 <> 0 THEN fare END AS fare,
         CASE WHEN event_id % 23 <> 0 THEN "timestamp" ELSE 'not a time' END AS "timestamp",
         CASE WHEN event_id % 23 <> 0 THEN event_time END AS event_time
  FROM tel
)"""

ORACLES["telemetry_checks_dirty"] = ORACLES["telemetry_checks"].replace(
    with_ctes(TELEMETRY), with_ctes(TELEMETRY, DIRTY_TELEMETRY)
).replace("FROM tel GROUP BY", "FROM dirty GROUP BY")

DIRTY_FEED = """
dirty AS (
  SELECT report_date,
         CASE WHEN n % 7 = 0 THEN 'U' || CAST(n AS VARCHAR) ELSE vehicle_id END AS vehicle_id,
         CASE WHEN n % 3 = 0 THEN CAST(0 AS DOUBLE) WHEN n % 8 = 0 THEN NULL ELSE fuel_cost END AS fuel_cost,
         CASE WHEN n % 9 = 0 THEN CAST(-1 AS DOUBLE) ELSE maintenance_cost END AS maintenance_cost,
         CASE WHEN n % 4 = 0 THEN 'maybe' ELSE service_flag END AS service_flag,
         CASE WHEN n % 6 = 0 THEN 1 ELSE 0 END AS wrong_date
  FROM (SELECT *, CAST(substr(vehicle_id, 2) AS BIGINT) AS n FROM expenses) e
  JOIN (SELECT unnest([0, 1]) AS copy) c ON c.copy = 0 OR n % 5 = 0
)"""

ORACLES["expense_feed_checks_dirty"] = (
    ORACLES["expense_feed_checks"]
    .replace(with_ctes(TELEMETRY, CLEAN, EXPENSES), with_ctes(TELEMETRY, CLEAN, EXPENSES, DIRTY_FEED))
    .replace("FROM expenses e LEFT JOIN dim", "FROM dirty e LEFT JOIN dim")
    .replace("AS bad_flag\n", "AS bad_flag, sum(e.wrong_date) AS wrong_date\n")
    .replace("CAST(0 AS BIGINT) AS date_mismatch_rows", "CAST(sum(wrong_date) AS BIGINT) AS date_mismatch_rows")
)

ORACLES["stream_serving"] = (
    "SELECT * EXCLUDE (spark_batch_id, processed_at) FROM (" + ORACLES["serving_conform"] + ")"
)

ORACLES["sliding_metrics_approx"] = (
    "SELECT * EXCLUDE (active_vehicles, trips), active_vehicles AS exact_vehicles, trips AS exact_trips, "
    f"true AS vehicles_near, true AS trips_near FROM ({ORACLES['sliding_metrics']})"
)

ORACLES["stream_utilization"] = ORACLES["utilization_5m"]

ORACLES["late_repair"] = with_ctes(TELEMETRY, CLEAN.replace("SELECT trip_id", "SELECT event_id, trip_id"), UTILIZATION) + f""",
live AS (
  SELECT *, time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start, event_id % {LATE_EVERY} = 0 AS late FROM clean
),
dropped AS (
  SELECT window_start, zone, count(*) AS recovered_rows FROM live
  WHERE late AND window_start + INTERVAL 5 MINUTE <= (SELECT max(event_time) FROM live WHERE NOT late) - INTERVAL 2 MINUTE
  GROUP BY window_start, zone
)
SELECT zone, CAST(telemetry_event_count AS INTEGER) AS telemetry_event_count,
       CAST(idle_event_count AS INTEGER) AS idle_event_count, CAST(on_trip_event_count AS INTEGER) AS on_trip_event_count,
       CAST(active_event_count AS INTEGER) AS active_event_count,
       {dec('observed_earnings', 14, 2)} AS observed_earnings, {dec('average_speed', 8, 2)} AS average_speed,
       window_start, window_end, {dec('idle_ratio', 7, 4)} AS idle_ratio,
       CAST(coalesce(recovered_rows, 0) AS BIGINT) AS recovered_rows
FROM util LEFT JOIN dropped USING (window_start, zone)"""

ORACLES["latest_window_served"] = ORACLES["latest_window_closed"]

ORACLES["health_snapshot_served"] = ORACLES["health_snapshot"]
