"""DuckDB SQL equal to each named query, written from the definitions."""

from __future__ import annotations

from collections.abc import Sequence

from telepulse.operators.alarms import AlarmRule
from telepulse.operators.notify import FOOTER, INVALID_ENVELOPE
from telepulse.plans import catalog
from telepulse.plans.catalog import (
    AD_HOC_SQL,
    HOUR_AS_OF,
    HOURLY_RULES,
    INGEST_AS_OF,
    KPI_AS_OF,
    KPI_DAY_END,
    NO_DATA_AS_OF,
    QUALITY_AS_OF,
    REPORT_DAY,
    STORED_RULES,
)

EPOCH = "TIMESTAMP '1970-01-01'"


def rounded(value: str, digits: int) -> str:
    """Decimal rounding of the shortest text of a double."""
    return f"CAST(round(CAST(CAST(CAST({value} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,16)), {digits}) AS DOUBLE)"


def exact_sum(column: str) -> str:
    """Exact sum of readings in millionths."""
    return f"sum(CAST(round(CAST({column} AS DOUBLE) * 1000000) AS HUGEINT))"


def exact_mean(column: str) -> str:
    return f"({exact_sum(column)}::DOUBLE / 1000000 / nullif(count({column}), 0))"


def rounded_mean(column: str, digits: int) -> str:
    """Average rounded half away from zero, in whole numbers."""
    total, count = exact_sum(column), f"count({column})"
    units = f"(abs({total}) * {2 * 10**digits} + {count} * 1000000) // nullif({count} * 2000000, 0)"
    return f"(sign({total}) * CAST({units} AS DOUBLE) / {10**digits} + 0.0::DOUBLE)"


def percent(part: str, whole: str) -> str:
    return rounded(f"({part}) * 100.0::DOUBLE / nullif({whole}, 0)", 2)


TELEMETRY = """telemetry AS (
  SELECT 'ROBOT-' || lpad(user_id::VARCHAR, greatest(4, length(user_id::VARCHAR))::INTEGER, '0') AS device_id,
    ['FLEET-BOSTON-01', 'FLEET-BOSTON-02', 'FLEET-SEATTLE-01'][event_id % 3 + 1] AS fleet_id,
    ts AS event_time,
    json_extract_string(props, '$.k')::INTEGER AS battery_level,
    CASE WHEN event_type IN ('click', 'signup') THEN (event_id % 7) * 0.5::DOUBLE ELSE 0.0::DOUBLE END AS speed_mps,
    CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'click' THEN 'ACTIVE' WHEN 'view' THEN 'IDLE'
      WHEN 'purchase' THEN 'CHARGING' WHEN 'signup' THEN 'MOVING' END AS status,
    CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN 'ERR_SENSOR' END AS error_code,
    'ZONE-' || substr('ABCDE', (event_id % 5 + 1)::INTEGER, 1) AS location_zone,
    value - 52.0::DOUBLE AS temperature_celsius,
    strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
    event_id
  FROM events
)"""
FIELDS = (
    "device_id, fleet_id, event_time, battery_level, speed_mps, status, error_code, "
    "location_zone, temperature_celsius"
)
ALL = f"{FIELDS}, year, month, day"


def over_telemetry(select: str, *ctes: str) -> str:
    return f"WITH {', '.join([TELEMETRY, *ctes])} {select}"


def day_of(as_of: str) -> str:
    return f"event_time >= date_trunc('day', TIMESTAMP '{as_of}') AND event_time <= TIMESTAMP '{as_of}'"


def hour_before(as_of: str) -> str:
    end = f"date_trunc('hour', TIMESTAMP '{as_of}')"
    return f"event_time >= {end} - INTERVAL 1 HOUR AND event_time < {end}"


WHOLE_DAY = f"CAST(event_time AS DATE) = DATE '{REPORT_DAY}'"
IN_MONTH = "year = '2024' AND month = '01'"
KEPT = "temperature_celsius BETWEEN -50 AND 150"

DEVICE_COLUMNS = f"""max(event_time) AS last_seen,
  count(*) AS session_count,
  count(*) FILTER (status = 'ERROR') AS error_count,
  {percent("count(*) FILTER (status = 'ERROR')", "count(*)")} AS error_rate_pct,
  max(status) AS last_status,
  arg_max(status, (event_time, status)) AS latest_status,
  {rounded_mean("battery_level", 1)} AS avg_battery_pct,
  min(battery_level) AS min_battery_pct,
  {rounded_mean("temperature_celsius", 1)} AS avg_temp_celsius,
  max(temperature_celsius) AS max_temp_celsius,
  {rounded_mean("speed_mps", 2)} AS avg_speed_mps"""

FLEET_HEALTH = f"""SELECT year, month, day, fleet_id,
  count(*) AS total_events,
  count(DISTINCT device_id) AS active_devices,
  count(*) FILTER (status = 'ERROR') AS error_count,
  {percent("count(*) FILTER (status = 'ERROR')", "count(*)")} AS error_rate_pct,
  {rounded_mean("battery_level", 1)} AS avg_battery_pct,
  count(*) FILTER (battery_level < 20) AS critical_battery_events,
  min(battery_level) AS min_battery_pct,
  {rounded_mean("speed_mps", 2)} AS avg_speed_mps,
  count(*) FILTER (speed_mps = 0 AND status = 'ACTIVE') AS stalled_events,
  {rounded_mean("temperature_celsius", 1)} AS avg_temp_celsius,
  max(temperature_celsius) AS max_temp_celsius,
  count(*) FILTER (temperature_celsius > 80) AS high_temp_events
FROM telemetry GROUP BY ALL"""

DEVICE_SUMMARY = f"SELECT year, month, day, fleet_id, device_id, {DEVICE_COLUMNS} FROM telemetry GROUP BY ALL"

ZONES = f"""SELECT year, month, day, location_zone,
  count(*) AS total_events,
  count(DISTINCT device_id) AS unique_devices,
  count(DISTINCT fleet_id) AS fleet_count,
  count(*) FILTER (status = 'ERROR') AS error_count,
  {percent("count(*) FILTER (status = 'ERROR')", "count(*)")} AS error_rate_pct,
  {rounded_mean("speed_mps", 2)} AS avg_speed_mps,
  count(*) FILTER (speed_mps = 0) AS stopped_events,
  {rounded_mean("battery_level", 1)} AS avg_battery_pct,
  count(*) FILTER (battery_level < 20) AS low_battery_count
FROM telemetry GROUP BY ALL"""


def window_rows(interval: str, where: str = "TRUE", source: str = "telemetry") -> str:
    measures = ", ".join(
        f"{rounded(exact_mean(m), 2)} AS {m}_avg, min({m}) AS {m}_min, max({m}) AS {m}_max"
        for m in ("temperature_celsius", "battery_level", "speed_mps")
    )
    start = f"time_bucket(INTERVAL '{interval}', event_time, {EPOCH})"
    return (
        f"SELECT device_id, {start} AS window_start, {start} + INTERVAL '{interval}' AS window_end, "
        f"{measures}, count(*) AS record_count FROM {source} WHERE {KEPT} AND {where} GROUP BY ALL"
    )


# --- KPIs -------------------------------------------------------------------------
KPI_COLUMNS = f"""count(DISTINCT device_id) AS active_device_count,
  CAST(sum(error_count) AS BIGINT) AS total_error_events,
  count(DISTINCT device_id) FILTER (error_count > 0) AS error_device_count,
  count(DISTINCT device_id) FILTER (min_battery_pct < 20) AS critical_battery_count,
  {rounded_mean("avg_battery_pct", 1)} AS fleet_avg_battery,
  {rounded_mean("avg_temp_celsius", 1)} AS fleet_avg_temp,
  {percent("sum(error_count)", "sum(session_count)")} AS fleet_error_rate_pct"""


def device_day(where: str) -> str:
    return f"devices AS (SELECT fleet_id, device_id, {DEVICE_COLUMNS} FROM telemetry WHERE {where} GROUP BY ALL)"


def kpi_history(interval: str) -> str:
    """All rows from midnight to the end of each period, period by period."""
    return (
        f"days AS (SELECT unnest(generate_series(min(event_time)::DATE::TIMESTAMP, max(event_time)::DATE::TIMESTAMP, "
        f"INTERVAL 1 DAY)) AS day_start FROM telemetry), "
        f"starts AS (SELECT day_start, unnest(generate_series(day_start, day_start + INTERVAL 1 DAY - INTERVAL '{interval}', "
        f"INTERVAL '{interval}')) AS period_start FROM days), "
        f"periods AS (SELECT period_start, fleet_id, device_id, {DEVICE_COLUMNS} FROM starts LEFT JOIN telemetry "
        f"ON event_time >= day_start AND event_time < period_start + INTERVAL '{interval}' "
        f"AND CAST(event_time AS DATE) = CAST(day_start AS DATE) WHERE event_time IS NOT NULL GROUP BY ALL), "
        f"kpis AS (SELECT s.period_start, {KPI_COLUMNS} FROM starts s LEFT JOIN periods p USING (period_start) "
        f"GROUP BY s.period_start)"
    )


PUBLISHED = [
    ("ActiveDeviceCount", "active_device_count", "Count"),
    ("ErrorDeviceCount", "error_device_count", "Count"),
    ("CriticalBatteryCount", "critical_battery_count", "Count"),
    ("FleetErrorRatePct", "fleet_error_rate_pct", "Percent"),
    ("AvgBatteryLevel", "fleet_avg_battery", "Percent"),
    ("AvgTemperatureCelsius", "fleet_avg_temp", "None"),
]


def kpi_metrics(source: str, fleet: str, stamp: str) -> str:
    return " UNION ALL ".join(
        f"SELECT 'Telemetry/Fleet' AS namespace, '{metric}' AS metric, "
        f"coalesce({kpi}::DOUBLE, 0.0) AS value, '{unit}' AS unit, "
        f"'{{\"Fleet\":\"' || {fleet} || '\"}}' AS dimensions, {stamp} AS ts FROM {source}"
        for metric, kpi, unit in PUBLISHED
    )


DAY_KPIS = f"kpis AS (SELECT {KPI_COLUMNS} FROM devices)"


FLEET_KPIS = (
    f"SELECT fleet_id AS fleet, {KPI_COLUMNS} FROM devices GROUP BY fleet_id "
    f"UNION ALL SELECT 'ALL' AS fleet, {KPI_COLUMNS} FROM devices"
)


# --- data quality ------------------------------------------------------------------
def checks(as_of: str) -> str:
    now = f"TIMESTAMP '{as_of}'"
    today = f"event_time >= date_trunc('day', {now})"
    delta = "(today_count - yesterday_count) / nullif(yesterday_count, 0)::DOUBLE * 100.0"
    return f"""raw_checks AS (
  SELECT max(event_time) FILTER ({today}) AS last,
    count(*) FILTER ({today}) AS today_record_count,
    count(DISTINCT device_id) FILTER ({today}) AS today_count,
    count(DISTINCT device_id) FILTER (NOT {today}) AS yesterday_count
  FROM telemetry
  WHERE event_time >= date_trunc('day', {now}) - INTERVAL 1 DAY AND event_time <= {now}
), checks AS (
  SELECT coalesce(floor(date_sub('second', last, {now}) / 60), 9999)::INTEGER AS freshness_minutes,
    coalesce(strftime(last, '%Y-%m-%d %H:%M:%S'), 'NEVER') AS last_seen,
    today_record_count, today_record_count > 0 AS partition_exists, today_count, yesterday_count,
    coalesce(floor({delta} + 0.5), 0)::INTEGER AS delta_percent
  FROM raw_checks
)"""


STALE_TEXT = (
    "'🚨 DATA FRESHNESS ALERT\nLast telemetry received: ' || last_seen || '\nStaleness: ' || freshness_minutes"
    " || ' minutes\nNext step: see whether devices still send and whether their messages are rejected.'"
)
MISSING_TEXT = (
    "'⚠️ MISSING PARTITION ALERT\nNo data found for today''s partition (year/month/day).\n"
    "Next step: list the table''s folders and register the ones that are missing.'"
)
DROP_TEXT = (
    "'⚠️ DEVICE COUNT REGRESSION\nYesterday: ' || yesterday_count || ' devices\nToday:     ' || today_count"
    " || ' devices\nDrop:      ' || abs(delta_percent) || "
    "'%\nNext step: compare the silent devices by fleet and zone.'"
)
ALERTS = f"""alerts AS (
  SELECT 1 AS n, 'freshness' AS "check", {STALE_TEXT} AS text FROM checks WHERE freshness_minutes > 30
  UNION ALL SELECT 2, 'partition', {MISSING_TEXT} FROM checks WHERE NOT partition_exists
  UNION ALL SELECT 3, 'device_count', {DROP_TEXT} FROM checks WHERE yesterday_count > 0 AND delta_percent < -30
)"""
QUALITY_METRICS = " UNION ALL ".join(
    f"SELECT 'Telemetry/DataQuality' AS namespace, '{metric}' AS metric, {value}::DOUBLE AS value, "
    f"'{unit}' AS unit, '{{\"Pipeline\":\"Telemetry\"}}' AS dimensions, TIMESTAMP '{QUALITY_AS_OF}' AS ts FROM checks"
    for metric, value, unit in [
        ("DataFreshnessMinutes", "least(freshness_minutes, 9999)", "None"),
        ("TodayPartitionExists", "partition_exists::INTEGER", "Count"),
        ("ActiveDeviceCount", "today_count", "Count"),
        ("DeviceCountDeltaPct", "delta_percent", "Percent"),
    ]
)
FRESHNESS_HISTORY = """hourly AS (
  SELECT date_trunc('day', event_time) AS day_start, date_trunc('hour', event_time) AS hour_start,
    date_trunc('second', max(event_time)) AS last
  FROM telemetry GROUP BY ALL
), hours AS (
  SELECT day_start, unnest(generate_series(day_start, day_start + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS period_start
  FROM (SELECT unnest(generate_series(min(day_start), max(day_start), INTERVAL 1 DAY)) AS day_start FROM hourly)
), freshness AS (
  SELECT period_start,
    coalesce(floor(date_sub('second', max(last), period_start + INTERVAL 1 HOUR) / 60), 9999)::INTEGER
      AS freshness_minutes
  FROM hours h LEFT JOIN hourly l ON l.day_start = h.day_start AND l.hour_start <= h.period_start
  GROUP BY period_start
)"""

# --- ingest ----------------------------------------------------------------------------
VALIDATED = """validated AS (
  SELECT *, CASE fault
      WHEN 0 THEN 'Missing required field: device_id'
      WHEN 1 THEN 'Missing required field: fleet_id'
      WHEN 2 THEN 'Missing or invalid field: battery_level'
      WHEN 3 THEN 'Missing or invalid field: speed_mps'
      WHEN 4 THEN 'Missing required field: status'
      WHEN 5 THEN 'Missing required field: location_zone'
      WHEN 6 THEN 'Missing or invalid field: temperature_celsius'
      WHEN 7 THEN 'Failed to parse telemetry data' END AS reject_reason
  FROM (SELECT *, CASE WHEN event_id % 22 IN (10, 20) THEN 7 ELSE event_id % 11 END AS fault FROM telemetry)
)"""
ACCEPTED = f"""accepted AS (
  SELECT device_id, fleet_id, arrival AS event_time, battery_level, speed_mps, status, error_code,
    location_zone, temperature_celsius, strftime(arrival, '%Y') AS year, strftime(arrival, '%m') AS month,
    strftime(arrival, '%d') AS day, event_id
  FROM (SELECT *, CASE WHEN fault = 8 THEN TIMESTAMP '{INGEST_AS_OF}' ELSE event_time END AS arrival
        FROM validated WHERE reject_reason IS NULL)
)"""

# --- metrics and alarms -------------------------------------------------------------------
SERVICE_POINTS = """SELECT 'Telemetry/Service' AS namespace, 'QueryDuration' AS metric,
    'Service=query' AS dimension_key, value * 600.0::DOUBLE AS value, ts FROM events
  UNION ALL SELECT 'Telemetry/Service', 'Throttles', 'Service=ingest', 1.0, ts FROM events
  WHERE event_type = 'error'"""
INGEST_POINTS = """SELECT 'Telemetry/Service' AS namespace, 'IngestErrors' AS metric,
    'Service=ingest' AS dimension_key, 1.0::DOUBLE AS value, event_time AS ts
  FROM validated WHERE reject_reason IS NOT NULL"""
KPI_POINTS = (
    "SELECT namespace, metric, 'Fleet=ALL' AS dimension_key, value, ts FROM "
    f"({kpi_metrics('kpis', chr(39) + 'ALL' + chr(39), 'period_start')})"
)
FRESHNESS_POINTS = """SELECT 'Telemetry/DataQuality' AS namespace, 'DataFreshnessMinutes' AS metric,
    'Pipeline=Telemetry' AS dimension_key, freshness_minutes::DOUBLE AS value, period_start AS ts FROM freshness"""

# Definitions each kind of points needs.
POINTS = {
    "kpi": (KPI_POINTS, [kpi_history("1 hour")]),
    "freshness": (FRESHNESS_POINTS, [FRESHNESS_HISTORY]),
    "service": (SERVICE_POINTS, []),
    "ingest": (INGEST_POINTS, [VALIDATED]),
}


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def alarm_ctes(kinds: Sequence[str], rules: Sequence[AlarmRule]) -> list[str]:
    ctes = [cte for kind in kinds for cte in POINTS[kind][1]]
    values = ", ".join(
        f"({quoted(r.name)}, {quoted(r.description)}, '{r.namespace}', '{r.metric}', '{r.key()}', "
        f"'{r.statistic}', {r.period_seconds}, {r.threshold}::DOUBLE, '{r.comparison}', {r.periods}, '{r.missing}')"
        for r in rules
    )
    return [
        *ctes,
        "points AS (" + " UNION ALL ".join(f"({POINTS[kind][0]})" for kind in kinds) + ")",
        "rules(alarm, description, namespace, metric, dimension_key, statistic, period_seconds, threshold, "
        f"comparison, periods, missing) AS (VALUES {values})",
        f"""stats AS (
  SELECT alarm, period_seconds, time_bucket(to_seconds(period_seconds), ts, {EPOCH}) AS period_start,
    CASE any_value(statistic) WHEN 'Sum' THEN {exact_sum("value")}::DOUBLE / 1000000 WHEN 'Average' THEN {exact_mean("value")}
      WHEN 'Maximum' THEN max(value) ELSE min(value) END AS value
  FROM points JOIN rules USING (namespace, metric, dimension_key) GROUP BY ALL
)""",
        """grid AS (
  SELECT alarm, unnest(generate_series(min(period_start), max(period_start), to_seconds(period_seconds)))
    AS period_start
  FROM stats GROUP BY alarm, period_seconds
)""",
        """series AS (
  SELECT g.alarm, g.period_start, s.value, r.* EXCLUDE (alarm),
    coalesce(CASE WHEN comparison = '>=' THEN value >= threshold ELSE value > threshold END, FALSE) AS breach
  FROM grid g JOIN rules r USING (alarm) LEFT JOIN stats s USING (alarm, period_start)
)""",
        """run AS (
  SELECT *,
    CASE periods WHEN 1 THEN breach::INTEGER
      ELSE breach::INTEGER + coalesce(lag(breach::INTEGER) OVER w, 0) END AS breaching_periods,
    CASE periods WHEN 1 THEN value IS NOT NULL
      ELSE value IS NOT NULL OR coalesce(lag(value IS NOT NULL) OVER w, FALSE) END AS has_data
  FROM series WINDOW w AS (PARTITION BY alarm ORDER BY period_start)
)""",
        """states AS (
  SELECT *, CASE WHEN breaching_periods = periods THEN 'ALARM'
      WHEN missing = 'missing' AND NOT has_data THEN 'INSUFFICIENT_DATA' ELSE 'OK' END AS state
  FROM run
)""",
    ]


TWO_DIGITS = "printf('%.2f', {})"
TRANSITIONS = f"""transitions AS (
  SELECT alarm, description, old_state, state AS new_state,
    period_start + to_seconds(period_seconds) AS changed_at,
    CASE state WHEN 'ALARM' THEN 'Threshold crossed' WHEN 'OK' THEN 'Threshold not crossed'
      ELSE 'Insufficient data' END
    || ': ' || breaching_periods || ' of ' || periods || ' periods had ' || statistic || ' of ' || metric
    || ' ' || comparison || ' ' || {TWO_DIGITS.format(rounded("threshold", 2))} || '; latest value '
    || coalesce({TWO_DIGITS.format(rounded("value", 2))}, 'missing') AS reason,
    namespace, metric, statistic, dimension_key
  FROM (SELECT *, coalesce(lag(state) OVER (PARTITION BY alarm ORDER BY period_start), 'OK') AS old_state
        FROM states)
  WHERE state <> old_state
)"""
STATES = f"SELECT alarm, period_start, {rounded('value', 2)} AS value, breach, state FROM states"


def alarm_states(kinds: Sequence[str], *names: str) -> str:
    return over_telemetry(STATES, *alarm_ctes(kinds, [HOURLY_RULES[name] for name in names]))


CLOCK = "'%-m/%-d/%Y, %-I:%M:%S %p'"
MAIL_HEAD = "'TELEMETRY ALARM NOTIFICATION\n\nAlarm Name: '"


def mail_text(name: str, state: str, time: str, reason: str, details: Sequence[str], dimensions: str) -> str:
    labels = ("Name", "Namespace", "Statistic", "Unit")
    shown = " || ".join(f"'\n  - {label}: ' || {value}" for label, value in zip(labels, details))
    return (
        f"{MAIL_HEAD} || {name} || '\nState: ' || {state} || '\nTime: ' || {time} || '\n\nReason:\n' || {reason}"
        f" || '\n\nMetric Details:' || {shown} || '\n\nDimensions:\n' || {dimensions} || '\n\n---\n{FOOTER}'"
    )


# What an alarm notice made of an event says.
NOTICES = f"""notices AS (
  SELECT event_id,
    CASE WHEN event_id % 13 < 2 THEN '{INVALID_ENVELOPE}' END AS warning,
    'alarm-' || user_id AS alarm_name,
    CASE event_type WHEN 'error' THEN 'ALARM' WHEN 'view' THEN 'OK' ELSE 'INSUFFICIENT_DATA' END AS state,
    'Threshold crossed by event ' || event_id AS reason,
    strftime(ts, {CLOCK}) AS shown_time,
    CASE WHEN event_id % 5 <> 0 THEN 'Metric' || event_id % 10 END AS metric,
    CASE WHEN event_id % 5 <> 0 AND event_id % 6 <> 0 THEN 'Maximum' END AS statistic,
    CASE WHEN event_id % 5 <> 0 AND event_id % 7 <> 0 THEN 'Percent' END AS unit,
    CASE WHEN event_id % 5 <> 0 THEN 'Telemetry/Fleet' END AS namespace,
    CASE WHEN event_id % 5 = 0 THEN NULL
      WHEN event_id % 4 = 0 THEN []::VARCHAR[]
      WHEN event_id % 4 = 1 THEN ['Fleet: ' || fleet]
      ELSE ['Fleet: ' || fleet, 'Zone: <' || event_type || '> & more'] END AS dimensions
  FROM (SELECT *, ['FLEET-BOSTON-01', 'FLEET-BOSTON-02', 'FLEET-SEATTLE-01'][event_id % 3 + 1] AS fleet FROM events)
)"""


def shown_dimensions(prefix: str, suffix: str, separator: str, escaped: bool = False) -> str:
    item = "replace(replace(replace(d, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')" if escaped else "d"
    lines = f"list_transform(dimensions, lambda d: '{prefix}' || {item} || '{suffix}')"
    return f"coalesce(nullif(array_to_string({lines}, '{separator}'), ''), '{prefix}N/A{suffix}')"


def or_na(column: str) -> str:
    return f"coalesce({column}, 'N/A')"


COLOR = "CASE state WHEN 'ALARM' THEN '#DC143C' WHEN 'OK' THEN '#32CD32' ELSE '#FFA500' END"
MARK = "CASE state WHEN 'ALARM' THEN '🚨' WHEN 'OK' THEN '✅' ELSE '⚠️' END"


def _chat() -> str:
    def text(kind: str, body: str) -> str:
        return f"json_object('type', '{kind}', 'text', {body})"

    metric = (
        f"'*Metric*\n' || {or_na('metric')} || '\n*Statistic*\n' || {or_na('statistic')} || "
        f"'\n*Dimensions*\n' || {shown_dimensions('', '', ', ')}"
    )
    status = text("mrkdwn", "'*Status*\n' || state")
    time = text("mrkdwn", "'*Time*\n' || shown_time")
    reason = text("mrkdwn", "'*Reason*\n' || reason")
    header = text("plain_text", f"{MARK} || ' Telemetry Alarm: ' || alarm_name")
    blocks = (
        f"json_array(json_object('type', 'header', 'text', {header}), "
        f"json_object('type', 'section', 'fields', json_array({status}, {time})), "
        f"json_object('type', 'section', 'text', {reason}), "
        f"json_object('type', 'section', 'text', {text('mrkdwn', metric)}), "
        "json_object('type', 'divider'))"
    )
    title = f"{MARK} || ' ' || alarm_name || ' - ' || state"
    return f"CAST(json_object('text', {title}, 'blocks', {blocks}) AS VARCHAR)"


def _html() -> str:
    details = " || ".join(
        f"'<li>{label}: ' || {or_na(name)} || '</li>'"
        for label, name in [
            ("Name", "metric"),
            ("Namespace", "namespace"),
            ("Statistic", "statistic"),
            ("Unit", "unit"),
        ]
    )
    return (
        f"'<!DOCTYPE html><html><body><div style=\"color:white;padding:16px;background:' || {COLOR} || '\"><h1>' "
        "|| alarm_name || '</h1><p>State: ' || state || '</p></div><h2>Alert Time</h2><p>' || shown_time || "
        "'</p><h2>Reason</h2><p>' || reason || '</p><h2>Metric Details</h2><ul>' || "
        f"{details} || '</ul><h2>Dimensions</h2><ul>' || {shown_dimensions('<li>', '</li>', '', True)} || "
        f"'</ul><p style=\"color:#999\">{FOOTER}</p></body></html>'"
    )


def _period_stats(points: str, interval: str, names: Sequence[str], digits: int = 2) -> str:
    functions = {
        "sum": f"{exact_sum('value')}::DOUBLE / 1000000",
        "average": exact_mean("value"),
        "maximum": "max(value)",
        "minimum": "min(value)",
    }
    columns = ", ".join(f"{rounded(functions[n], digits)} AS {n}" for n in names)
    return (
        "SELECT namespace, metric, dimension_key AS dimensions, "
        f"time_bucket(INTERVAL '{interval}', ts, {EPOCH}) AS period_start, {columns}, count(value) AS samples "
        f"FROM ({points}) GROUP BY ALL"
    )


NEWEST_FIRST = ", ".join(
    [
        "event_time DESC",
        *[
            f"{c} ASC NULLS LAST"
            for c in f"{FIELDS}, year, month, day".split(", ")
            if c != "event_time"
        ],
    ]
)
SAMPLE = "device_id, fleet_id, event_time, battery_level, speed_mps, temperature_celsius"
SAMPLE_ORDER = "event_time, device_id, fleet_id, battery_level, speed_mps, temperature_celsius"
REPORT_FIELDS = "device_id, fleet_id, location_zone, status, error_code, event_time"
SIX_FIELD_START = f"time_bucket(INTERVAL '5 minutes', event_time, {EPOCH})"
SIX_FIELD_TIME = "strftime(ts, '%Y-%m-%dT%H:%M:%SZ')"


def decimal(value: str) -> str:
    return f"CAST({rounded(value, 2)} AS DECIMAL(5,2))"


def _processing(as_of: str) -> str:
    kept_windows = (
        f"count(DISTINCT (device_id, time_bucket(INTERVAL '5 minutes', event_time, {EPOCH}))) FILTER ({KEPT})"
    )
    return over_telemetry(
        "SELECT CASE WHEN count(*) > 0 THEN 'Processing completed successfully' ELSE 'No data to process' END "
        f"AS message, count(*) AS records_processed, {kept_windows} AS aggregates_created "
        f"FROM telemetry WHERE {hour_before(as_of)}"
    )


def _csv_number(name: str) -> str:
    return f"coalesce({name}::VARCHAR, '')"


CSV_LINE = " || ',' || ".join(
    f"strftime({c}, '%Y-%m-%dT%H:%M:%S.%fZ')" if c == "event_time" else _csv_number(c)
    for c in FIELDS.split(", ")
)
AGGREGATE_LINE = (
    "device_id || ',' || epoch_ms(window_start) || ',' || epoch_ms(window_end) || ',' || "
    + " || ',' || ".join(
        f"printf('%.2f', {rounded(f'{m}_{s}', 2)})"
        for m in ("temperature_celsius", "battery_level", "speed_mps")
        for s in ("avg", "min", "max")
    )
    + f" || ',' || record_count || ',' || strftime(TIMESTAMP '{KPI_AS_OF}', '%Y-%m-%dT%H:%M:%S.%gZ')"
)

ORACLES: dict[str, str] = {
    # sources, sinks, catalog
    "read_telemetry_csv": over_telemetry(
        f"SELECT {ALL} FROM telemetry"
    ),
    "tolerant_read": over_telemetry(
        "SELECT year || '/' || month || '/' || day AS path, count(*) FILTER (NOT broken) AS lines, "
        "count(*) FILTER (NOT broken AND event_id % 13 = 0) AS skipped, CAST(1 AS BIGINT) AS files, "
        "CAST(bool_or(broken) AS BIGINT) AS skipped_files FROM (SELECT *, CAST(event_time AS DATE) IN ("
        "min(CAST(event_time AS DATE)) OVER (), max(CAST(event_time AS DATE)) OVER ()) AS broken FROM telemetry) GROUP BY year, month, day"
    ),
    "six_field_windows": f"""SELECT device_id, {SIX_FIELD_START} AS window_start, {SIX_FIELD_START} + INTERVAL 5 MINUTE AS window_end,
  {", ".join(f"{rounded(exact_mean(m), 2)} AS {m}_avg, min({m}) AS {m}_min, max({m}) AS {m}_max" for m in ("temperature", "humidity", "pressure"))},
  count(*) AS record_count
FROM (
  SELECT 'ROBOT-' || user_id AS device_id, CASE WHEN event_id % 9 <> 0 THEN value END AS temperature,
    CASE WHEN event_id % 9 <> 1 THEN (event_id % 100)::DOUBLE END AS humidity, event_id % 50 + 0.25::DOUBLE AS pressure,
    date_trunc('millisecond', ts) AS event_time FROM events
) WHERE temperature BETWEEN -50 AND 150 AND {hour_before(HOUR_AS_OF)} GROUP BY ALL""",
    "repair_partitions": over_telemetry("SELECT year, month, day, count(*) AS events FROM telemetry GROUP BY ALL"),
    "read_hour": over_telemetry(f"SELECT {ALL} FROM telemetry WHERE {hour_before(HOUR_AS_OF)}"),
    "parse_csv_record": f"""SELECT 'ROBOT-' || user_id AS device_id,
  CASE WHEN event_id % 9 <> 0 THEN value END AS temperature,
  CASE WHEN event_id % 9 <> 1 THEN (event_id % 100)::DOUBLE END AS humidity,
  event_id % 50 + 0.25::DOUBLE AS pressure,
  epoch_us(ts) // 1000 AS timestamp,
  CASE WHEN event_id % 9 <> 2 THEN {SIX_FIELD_TIME} END AS iso_timestamp
FROM events""",
    "empty_input": _processing(NO_DATA_AS_OF),
    "processing_report": _processing(HOUR_AS_OF),
    "format_csv_row": over_telemetry(f"SELECT {CSV_LINE} AS line FROM telemetry"),
    "format_aggregate_row": over_telemetry(
        f"SELECT device_id, window_start, {AGGREGATE_LINE} AS line FROM stats",
        f"stats AS ({window_rows('5 minutes')})",
    ),
    "show_partitions": over_telemetry("SELECT DISTINCT year, month, day FROM telemetry"),
    "retention": over_telemetry(
        f"SELECT {ALL} FROM telemetry WHERE CAST(event_time AS DATE) > DATE '2025-01-14' - 365"
    ),
    "result_retention": over_telemetry(
        f"SELECT {ALL} FROM telemetry WHERE CAST(event_time AS DATE) > DATE '2024-02-09' - 30"
    ),
    "bi_fleet_daily_health": over_telemetry(
        "SELECT * REPLACE (min_battery_pct::DOUBLE AS min_battery_pct), "
        f"year || '-' || month || '-' || day AS event_date FROM ({FLEET_HEALTH})"
    ),
    "bi_device_status_summary": over_telemetry(
        "SELECT * EXCLUDE (latest_status) REPLACE (min_battery_pct::DOUBLE AS min_battery_pct, "
        "strftime(last_seen, '%Y-%m-%d %H:%M:%S') AS last_seen), "
        f"year || '-' || month || '-' || day AS event_date FROM ({DEVICE_SUMMARY})"
    ),
    "create_views": over_telemetry(
        "SELECT year, month, day, fleet_id, device_id, error_rate_pct, min_battery_pct "
        f"FROM ({DEVICE_SUMMARY}) WHERE error_rate_pct > 50 AND min_battery_pct < 20"
    ),
    # ingest
    "unwrap_event": over_telemetry(
        """SELECT event_id,
  CASE WHEN fault NOT IN (0, 7) THEN device_id END AS device_id,
  CASE WHEN fault = 1 THEN '' WHEN fault <> 7 THEN fleet_id END AS fleet_id,
  CASE WHEN fault NOT IN (2, 7) THEN battery_level::DOUBLE END AS battery_level,
  CASE WHEN fault NOT IN (3, 7) THEN speed_mps END AS speed_mps,
  CASE WHEN fault NOT IN (4, 7) THEN status END AS status,
  CASE WHEN fault <> 7 THEN error_code END AS error_code,
  CASE WHEN fault NOT IN (5, 7) THEN location_zone END AS location_zone,
  CASE WHEN fault NOT IN (6, 7) THEN temperature_celsius END AS temperature_celsius,
  CASE WHEN fault NOT IN (7, 8) THEN strftime(event_time, '%Y-%m-%dT%H:%M:%S.%fZ') END AS event_time
FROM validated""",
        VALIDATED,
    ),
    "validate_event": over_telemetry("SELECT event_id, reject_reason FROM validated", VALIDATED),
    "accepted_events": over_telemetry(f"SELECT {ALL}, event_id FROM accepted", VALIDATED, ACCEPTED),
    "rejected_events": over_telemetry(
        "SELECT CASE WHEN fault IN (0, 7) THEN 'unknown' ELSE device_id END AS device_id, reject_reason, event_id "
        "FROM validated WHERE reject_reason IS NOT NULL",
        VALIDATED,
    ),
    "reject_summary": over_telemetry(
        "SELECT reject_reason, count(*) AS events FROM validated WHERE reject_reason IS NOT NULL GROUP BY ALL",
        VALIDATED,
    ),
    "default_event_time": over_telemetry(
        "SELECT year, month, day, count(*) AS events, "
        f"count(*) FILTER (event_time = TIMESTAMP '{INGEST_AS_OF}') AS default_times FROM accepted GROUP BY ALL",
        VALIDATED,
        ACCEPTED,
    ),
    "partition_columns": "SELECT event_id, ts, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, "
    "strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour FROM events",
    "ingest_audit": over_telemetry(
        "SELECT 'Telemetry ingested successfully' AS message, device_id, event_time, "
        "strftime(event_time, 'year=%Y/month=%m/day=%d') AS storage_path FROM accepted",
        VALIDATED,
        ACCEPTED,
    ),
    # filters
    "filter_partition_day": over_telemetry(f"SELECT {ALL} FROM telemetry WHERE {day_of(QUALITY_AS_OF)}"),
    "filter_two_days": over_telemetry(
        f"SELECT {ALL} FROM telemetry WHERE event_time <= TIMESTAMP '{QUALITY_AS_OF}' "
        "AND CAST(event_time AS DATE) IN (DATE '2024-01-29', DATE '2024-01-30')"
    ),
    "filter_outliers": over_telemetry(f"SELECT {ALL} FROM telemetry WHERE {KEPT}"),
    "filter_status_error": over_telemetry(f"SELECT {ALL} FROM telemetry WHERE status = 'ERROR'"),
    "conditional_counts": over_telemetry(
        """SELECT count(*) FILTER (status = 'ERROR') AS error_events,
  count(*) FILTER (battery_level < 20) AS low_battery_events,
  count(*) FILTER (speed_mps = 0 AND status = 'ACTIVE') AS stalled_events,
  count(*) FILTER (speed_mps = 0) AS stopped_events,
  count(*) FILTER (temperature_celsius > 80) AS hot_events FROM telemetry"""
    ),
    "latest_per_device_day": over_telemetry(
        f"SELECT {ALL} FROM telemetry QUALIFY row_number() OVER "
        f"(PARTITION BY year, month, day, device_id ORDER BY {NEWEST_FIRST}) = 1"
    ),
    # views, windows, KPIs
    "fleet_daily_health": over_telemetry(FLEET_HEALTH),
    "device_status_summary": over_telemetry(DEVICE_SUMMARY),
    "zone_activity": over_telemetry(ZONES),
    "window_stats": over_telemetry(window_rows("5 minutes")),
    "window_stats_daily": over_telemetry(window_rows("1 day")),
    "window_stats_previous_hour": over_telemetry(window_rows("5 minutes", hour_before(HOUR_AS_OF))),
    "fleet_kpis": over_telemetry(f"SELECT {KPI_COLUMNS} FROM devices", device_day(day_of(KPI_AS_OF))),
    "fleet_kpis_by_fleet": over_telemetry(FLEET_KPIS, device_day(day_of(KPI_AS_OF))),
    "kpi_history": over_telemetry("SELECT * FROM kpis", kpi_history("1 day")),
    "kpi_metrics": over_telemetry(
        kpi_metrics("kpis", "'ALL'", f"TIMESTAMP '{KPI_AS_OF}'"),
        device_day(day_of(KPI_AS_OF)),
        DAY_KPIS,
    ),
    "kpis_no_data": over_telemetry(
        kpi_metrics("kpis", "'ALL'", f"TIMESTAMP '{NO_DATA_AS_OF}'"),
        device_day(day_of(NO_DATA_AS_OF)),
        DAY_KPIS,
    ),
    "kpi_metrics_by_fleet": over_telemetry(
        kpi_metrics("kpis", "fleet", f"TIMESTAMP '{KPI_AS_OF}'"),
        device_day(day_of(KPI_AS_OF)),
        f"kpis AS ({FLEET_KPIS})",
    ),
    # data quality
    "data_freshness": over_telemetry(
        "SELECT freshness_minutes, last_seen, today_record_count AS record_count FROM checks", checks(QUALITY_AS_OF)
    ),
    "data_freshness_no_data": over_telemetry(
        "SELECT freshness_minutes, last_seen, today_record_count AS record_count FROM checks", checks(NO_DATA_AS_OF)
    ),
    "partition_health": over_telemetry(
        "SELECT today_record_count, partition_exists FROM checks", checks(QUALITY_AS_OF)
    ),
    "device_count_regression": over_telemetry(
        "SELECT today_count, yesterday_count, delta_percent FROM checks", checks(QUALITY_AS_OF)
    ),
    "quality_checks": over_telemetry("SELECT * FROM checks", checks(QUALITY_AS_OF)),
    "freshness_history": over_telemetry("SELECT * FROM freshness", FRESHNESS_HISTORY),
    "quality_metrics": over_telemetry(QUALITY_METRICS, checks(QUALITY_AS_OF)),
    "quality_alerts": over_telemetry('SELECT "check", text FROM alerts', checks(QUALITY_AS_OF), ALERTS),
    "quality_alerts_no_data": over_telemetry('SELECT "check", text FROM alerts', checks(NO_DATA_AS_OF), ALERTS),
    "consolidated_alert": over_telemetry(
        "SELECT 'Telemetry Data Quality Issue (' || count(*) || ' check(s) failed)' AS subject, "
        "string_agg(text, '\n\n---\n\n' ORDER BY n) AS message FROM alerts HAVING count(*) > 0",
        checks(NO_DATA_AS_OF),
        ALERTS,
    ),
    "quality_report": over_telemetry(
        """SELECT CAST(json_object('checksRun', 3, 'alertsFired', (SELECT count(*) FROM alerts),
  'freshness', json_object('freshnessMinutes', freshness_minutes, 'lastSeen', last_seen),
  'partition', json_object('todayRecordCount', today_record_count, 'partitionExists', partition_exists),
  'deviceCount', json_object('todayCount', today_count, 'yesterdayCount', yesterday_count,
    'deltaPercent', delta_percent)) AS VARCHAR) AS report FROM checks""",
        checks(QUALITY_AS_OF),
        ALERTS,
    ),
    # reports
    "temperature_statistics": over_telemetry(
        f"""SELECT device_id, fleet_id, CAST({rounded_mean("temperature_celsius", 2)} AS DECIMAL(5,2)) AS avg_temp,
  {decimal("min(temperature_celsius)")} AS min_temp, {decimal("max(temperature_celsius)")} AS max_temp,
  count(*) AS measurement_count FROM telemetry WHERE {IN_MONTH} GROUP BY ALL"""
    ),
    "speed_and_battery_analysis": over_telemetry(
        f"""SELECT device_id, status, CAST({rounded_mean("speed_mps", 2)} AS DECIMAL(5,2)) AS avg_speed,
  CAST({rounded_mean("battery_level", 2)} AS DECIMAL(5,2)) AS avg_battery, count(*) AS readings
FROM telemetry WHERE {IN_MONTH} GROUP BY ALL ORDER BY avg_battery DESC, device_id, status LIMIT 10"""
    ),
    "avg_temp_by_device": over_telemetry(
        f"SELECT device_id, {rounded(exact_mean('temperature_celsius'), 4)} AS avg_temp, "
        "min(temperature_celsius) AS min_temp, max(temperature_celsius) AS max_temp FROM telemetry GROUP BY ALL"
    ),
    "device_avg_month": over_telemetry(
        f"SELECT device_id, {rounded(exact_mean('temperature_celsius'), 4)} AS avg_temp "
        f"FROM telemetry WHERE {IN_MONTH} GROUP BY ALL"
    ),
    "record_count": over_telemetry("SELECT count(*) AS records FROM telemetry"),
    "telemetry_sample": over_telemetry(
        f"SELECT {SAMPLE} FROM telemetry WHERE {IN_MONTH} ORDER BY {SAMPLE_ORDER} LIMIT 10"
    ),
    "last_records": over_telemetry(f"SELECT {ALL} FROM telemetry ORDER BY {NEWEST_FIRST} LIMIT 10"),
    "device_status_report": over_telemetry(
        f"SELECT {REPORT_FIELDS} FROM telemetry WHERE {WHOLE_DAY} ORDER BY event_time DESC, device_id, fleet_id, "
        "location_zone, status, error_code NULLS LAST LIMIT 20"
    ),
    "battery_timeline": over_telemetry(
        f"SELECT device_id, battery_level, event_time FROM telemetry WHERE {WHOLE_DAY}"
    ),
    "error_events": over_telemetry(
        f"SELECT device_id, error_code, event_time FROM telemetry WHERE status = 'ERROR' AND {IN_MONTH}"
    ),
    "run_sql": over_telemetry(
        "SELECT device_id, status, events::VARCHAR AS events, min_battery::VARCHAR AS min_battery, error_code FROM "
        f"({AD_HOC_SQL})",
        "device_telemetry AS (SELECT * FROM telemetry)",
    ),
    "scalar_expressions": f"""SELECT event_id, {rounded("value / 3", 2)} AS rounded,
  {percent("event_id % 7", "event_id % 4")} AS safe_percentage,
  floor(event_id % 9 - 4.5::DOUBLE + 0.5)::BIGINT AS half_up,
  least(floor(value * 40), 9999)::BIGINT AS capped,
  abs(event_id % 5 - 2) AS absolute,
  (event_id % 2 = 0)::INTEGER AS flag,
  0.0::DOUBLE AS defaulted,
  -1.0::DOUBLE AS no_number,
  substr(repeat(event_type, 30), 1, 100) AS head,
  strftime(ts, '%Y-%m') AS year_month,
  ts - INTERVAL 1 HOUR AS hour_before,
  time_bucket(INTERVAL '5 minutes', ts, {EPOCH}) AS window_start,
  strftime(ts, {CLOCK}) AS shown,
  'Invalid Date' AS shown_invalid
FROM events""",
    # metrics and alarms
    "metric_period_stat": _period_stats(
        SERVICE_POINTS, "30 minutes", ("sum", "average", "maximum", "minimum")
    ),
    "dashboard_series": over_telemetry(
        _period_stats(KPI_POINTS, "6 hours", ("maximum", "average"), 5), kpi_history("1 hour")
    ),
    "alarm_high_error_rate": alarm_states(["ingest"], "high-error-rate"),
    "alarm_throttling": alarm_states(["service"], "throttling"),
    "alarm_slow_queries": alarm_states(["service"], "slow-queries"),
    "alarm_critical_battery": alarm_states(["kpi"], "critical-battery-count"),
    "alarm_fleet_error_rate": alarm_states(["kpi"], "fleet-error-rate"),
    "alarm_data_freshness": alarm_states(["freshness"], "data-freshness"),
    "evaluate_alarms": alarm_states(list(POINTS), *HOURLY_RULES),
    "consecutive_breach": over_telemetry(
        "SELECT alarm, period_start, value, breach, breaching_periods, breaching_periods = periods AS all_breach "
        "FROM states",
        *alarm_ctes(["kpi"], [HOURLY_RULES["fleet-error-rate"]]),
    ),
    "alarm_transitions": over_telemetry(
        "SELECT * FROM transitions", *alarm_ctes(list(POINTS), list(HOURLY_RULES.values())), TRANSITIONS
    ),
    "alarm_notifications": over_telemetry(
        "SELECT alarm AS \"AlarmName\", strftime(changed_at, '%Y-%m-%dT%H:%M:%SZ') AS \"StateUpdatedTimestamp\", "
        "'[' || new_state || '] ' || alarm AS subject, "
        + mail_text(
            "alarm",
            "new_state",
            f"strftime(changed_at, {CLOCK})",
            "reason",
            ["metric", "namespace", "statistic", "'N/A'"],
            "'  - ' || replace(dimension_key, '=', ': ')",
        )
        + " AS body_text FROM transitions",
        *alarm_ctes(["kpi"], [HOURLY_RULES["critical-battery-count"], HOURLY_RULES["fleet-error-rate"]]),
        TRANSITIONS,
    ),
    # notifications
    "parse_alarm": f"WITH {NOTICES} "
    """SELECT event_id, warning,
  CASE WHEN warning IS NULL THEN alarm_name END AS alarm_name,
  CASE WHEN warning IS NULL THEN state END AS state,
  CASE WHEN warning IS NULL THEN reason END AS reason,
  CASE WHEN warning IS NULL THEN metric END AS metric,
  CASE WHEN warning IS NULL THEN len(dimensions)::INTEGER END AS dimension_count
FROM notices""",
    "unreadable_alarms": f"WITH {NOTICES} SELECT event_id, warning, CASE WHEN event_id % 13 = 0 THEN '{{}}' "
    "ELSE 'plain text ' || event_id END AS value FROM notices WHERE warning IS NOT NULL",
    "render_chat": f"WITH {NOTICES} SELECT event_id, {COLOR} AS color, {_chat()} AS chat "
    "FROM notices WHERE warning IS NULL",
    "render_email_text": f"WITH {NOTICES} SELECT event_id, '[' || state || '] ' || alarm_name AS subject, "
    + mail_text(
        "alarm_name",
        "state",
        "shown_time",
        "reason",
        [or_na(c) for c in ("metric", "namespace", "statistic", "unit")],
        shown_dimensions("  - ", "", "\n"),
    )
    + " AS body_text FROM notices WHERE warning IS NULL",
    "render_email_html": f"WITH {NOTICES} SELECT event_id, '[' || state || '] ' || alarm_name AS subject, "
    f"{_html()} AS body_html FROM notices WHERE warning IS NULL",
    # streams
    "stream_window_stats": over_telemetry(window_rows("5 minutes")),
    "stream_deduplicated_windows": over_telemetry(window_rows("5 minutes")),
    "stream_ingest": over_telemetry(f"SELECT {ALL} FROM accepted", VALIDATED, ACCEPTED),
    "stream_kpis": over_telemetry(
        kpi_metrics("kpis", "'ALL'", f"TIMESTAMP '{KPI_DAY_END}'"), device_day(day_of(KPI_DAY_END)), DAY_KPIS
    ),
    "alarms_carried_on": alarm_states(["kpi", "freshness"], *STORED_RULES),
    "merge_raw": over_telemetry(
        f"SELECT {ALL} FROM (SELECT * REPLACE (CASE WHEN v = 1 THEN 'STALE' WHEN v = 3 THEN 'FINAL' ELSE status END AS status) "
        "FROM telemetry, range(1, 4) versions(v) WHERE v < 3 OR event_id % 3 = 0) QUALIFY row_number() OVER "
        "(PARTITION BY device_id, date_trunc('millisecond', event_time) ORDER BY v DESC, "
        f"{', '.join(f'{c} ASC NULLS LAST' for c in ALL.split(', '))}) = 1"
    ),
}
ORACLES["write_raw"] = over_telemetry(f"SELECT {ALL} FROM telemetry")
ORACLES["write_window_stats"] = ORACLES["window_stats_daily"]
ORACLES["append_metrics"] = over_telemetry(kpi_metrics("kpis", "'ALL'", "period_start"), kpi_history("1 hour"))
ORACLES["stream_rejects"] = ORACLES["reject_summary"]
ORACLES["read_mixed_csv"] = ORACLES["read_telemetry_csv"]
ORACLES["stream_quality"] = ORACLES["quality_metrics"]

assert set(ORACLES) <= set(catalog.QUERIES)
