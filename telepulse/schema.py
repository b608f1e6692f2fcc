"""Record layouts and thresholds."""

from __future__ import annotations

# --- fixed values: column names and types of the telemetry record -----------
TELEMETRY_COLUMNS = [
    "device_id",
    "fleet_id",
    "event_time",
    "battery_level",
    "speed_mps",
    "status",
    "error_code",
    "location_zone",
    "temperature_celsius",
]
PARTITION_COLUMNS = ["year", "month", "day"]

TELEMETRY_DDL = (
    "device_id string, fleet_id string, event_time timestamp, battery_level int, "
    "speed_mps double, status string, error_code string, location_zone string, "
    "temperature_celsius double"
)
PARTITION_DDL = "year string, month string, day string"

# A CSV line: the time stays text until it is parsed leniently.
TELEMETRY_CSV_DDL = TELEMETRY_DDL.replace("event_time timestamp", "event_time string")

# A JSON event: numbers are doubles, so that text in them reads as NULL.
EVENT_DDL = (
    "device_id string, fleet_id string, battery_level double, speed_mps double, "
    "status string, error_code string, location_zone string, "
    "temperature_celsius double, event_time string"
)
# The event itself, or an envelope holding it as JSON text.
ENVELOPE_DDL = (
    "body string, Records array<struct<Sns: struct<Message: string>>>, " + EVENT_DDL
)

# The older six-field record that the window job also accepts.
SIX_FIELD_COLUMNS = [
    "device_id",
    "temperature",
    "humidity",
    "pressure",
    "timestamp",
    "iso_timestamp",
]

ALARM_DDL = (
    "AlarmName string, AlarmDescription string, StateChangeReason string, "
    "StateUpdatedTimestamp string, NewStateValue string, NewStateReason string, "
    "Trigger struct<MetricName: string, Namespace: string, Statistic: string, "
    "Unit: string, Dimensions: array<struct<name: string, value: string>>>"
)
NOTIFICATION_DDL = "Records array<struct<Sns: struct<Message: string>>>"

METRICS_DDL = (
    "namespace string, metric string, value double, unit string, "
    "dimensions map<string,string>, ts timestamp"
)

METRICS_COLUMNS = ["namespace", "metric", "value", "unit", "dimensions", "ts"]

# --- fixed values: thresholds ------------------------------------------------
LOW_BATTERY_PCT = 20
HIGH_TEMPERATURE = 80
OUTLIER_MIN_TEMPERATURE = -50
OUTLIER_MAX_TEMPERATURE = 150
WINDOW_LENGTH = "5 minutes"
STALE_AFTER_MINUTES = 30
NO_DATA_MINUTES = 9999
NO_DATA_TEXT = "NEVER"
MAX_DEVICE_DROP_PCT = 30
TELEMETRY_RETENTION_DAYS = 365
RESULT_RETENTION_DAYS = 30

# Names under which metrics are published.
FLEET_NAMESPACE = "Telemetry/Fleet"
QUALITY_NAMESPACE = "Telemetry/DataQuality"
SERVICE_NAMESPACE = "Telemetry/Service"
