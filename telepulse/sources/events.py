"""Adapters: telemetry, raw messages and alarm notices from an events table.

Every adapter is a row-by-row projection of
``events(event_id, ts, user_id, event_type, value, props)``, so its output grows
with the table and filters on ``event_time`` still reach the scan as ``ts``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telepulse.functions.calendar import with_partition_columns
from telepulse.schema import PARTITION_COLUMNS, TELEMETRY_COLUMNS

_FLEETS = ["FLEET-BOSTON-01", "FLEET-BOSTON-02", "FLEET-SEATTLE-01"]
_STATUS = {
    "error": "ERROR",
    "click": "ACTIVE",
    "view": "IDLE",
    "purchase": "CHARGING",
    "signup": "MOVING",
}


def _one_of(index: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _case(column: Column, mapping: dict[str, str]) -> Column:
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.create_map(*pairs)[column]


def _battery_level() -> Column:
    """Field k of the JSON properties."""
    return F.get_json_object("props", "$.k").try_cast("int")


def telemetry_from_events(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Telemetry rows with partition columns; ``keep`` passes source columns on."""
    user = F.col("user_id").cast("string")
    kind = F.col("event_type")
    number = F.col("event_id")
    telemetry = events.select(
        F.concat(
            F.lit("ROBOT-"), F.lpad(user, F.greatest(F.length(user), F.lit(4)), F.lit("0"))
        ).alias("device_id"),
        _one_of(number % 3, _FLEETS).alias("fleet_id"),
        F.col("ts").alias("event_time"),
        _battery_level().alias("battery_level"),
        F.when(kind.isin("click", "signup"), (number % 7) * F.lit(0.5))
        .otherwise(F.lit(0.0))
        .alias("speed_mps"),
        _case(kind, _STATUS).alias("status"),
        F.when((kind == "error") & (number % 3 == 0), F.lit("ERR_SENSOR")).alias("error_code"),
        F.concat(F.lit("ZONE-"), F.substring(F.lit("ABCDE"), number % 5 + 1, F.lit(1))).alias(
            "location_zone"
        ),
        (F.col("value") - F.lit(52.0)).alias("temperature_celsius"),
        *keep,
    )
    return with_partition_columns(telemetry).select(*TELEMETRY_COLUMNS, *PARTITION_COLUMNS, *keep)


def raw_messages_from_events(events: DataFrame) -> DataFrame:
    """(event_id, received_at, value): JSON events in all three envelopes.

    Each fault that validation knows occurs in one of eleven rows: a missing,
    empty or null field, text in a number, text that is no JSON, no time. Two
    of 22 are an event with something behind it that closes an array early.
    """
    fault = F.col("event_id") % 11
    more = F.col("event_id") % 22
    fields = {
        "device_id": F.when(fault != 0, F.col("device_id")),
        "fleet_id": F.when(fault == 1, F.lit("")).otherwise(F.col("fleet_id")),
        "battery_level": F.col("battery_level"),
        "speed_mps": F.when(fault != 3, F.col("speed_mps")),
        "status": F.when(fault != 4, F.col("status")),
        "error_code": F.col("error_code"),
        "location_zone": F.when(fault != 5, F.col("location_zone")),
        "temperature_celsius": F.col("temperature_celsius"),
        "event_time": F.when(
            fault != 8, F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        ),
    }
    def document(**changed: Column) -> Column:
        return F.to_json(F.struct(*[c.alias(name) for name, c in {**fields, **changed}.items()]))

    event = (
        F.when(fault == 2, document(battery_level=F.col("battery_level").cast("string")))
        .when(fault == 6, document(temperature_celsius=F.lit("hot")))
        .when(fault == 7, F.concat(F.lit("no json "), F.col("device_id")))
        .when(more == 20, F.concat(document(), F.lit("] garbage")))
        .when(more == 10, F.concat(document(), F.lit("],["), document()))
        .otherwise(document())
    )
    envelope = F.col("event_id") % 3
    in_body = F.to_json(F.struct(F.col("event").alias("body")))
    in_record = F.to_json(
        F.struct(F.array(F.struct(F.struct(F.col("event").alias("Message")).alias("Sns"))).alias("Records"))
    )
    return (
        telemetry_from_events(events, keep=("event_id",))
        .withColumn("event", event)
        .select(
            "event_id",
            F.col("event_time").alias("received_at"),
            F.when(envelope == 0, in_body).when(envelope == 1, in_record).otherwise(F.col("event")).alias("value"),
        )
    )


def alarm_notices_from_events(events: DataFrame) -> DataFrame:
    """(event_id, value): alarm notification envelopes, one per event.

    Event types stand for the three states; some rows lack the trigger or its
    dimensions, some are no notification at all.
    """
    number, kind = F.col("event_id"), F.col("event_type")
    state = (
        F.when(kind == "error", "ALARM").when(kind == "view", "OK").otherwise("INSUFFICIENT_DATA")
    )
    fleet = F.struct(
        F.lit("Fleet").alias("name"), _one_of(number % 3, _FLEETS).alias("value")
    )
    zone = F.struct(
        F.lit("Zone").alias("name"), F.concat(F.lit("<"), kind, F.lit("> & more")).alias("value")
    )
    dimensions = (
        F.when(number % 4 == 0, F.array().cast("array<struct<name: string, value: string>>"))
        .when(number % 4 == 1, F.array(fleet))
        .otherwise(F.array(fleet, zone))
    )
    trigger = F.struct(
        F.concat(F.lit("Metric"), (number % 10).cast("string")).alias("MetricName"),
        F.lit("Telemetry/Fleet").alias("Namespace"),
        F.when(number % 6 == 0, "").otherwise("Maximum").alias("Statistic"),
        F.when(number % 7 != 0, "Percent").alias("Unit"),
        dimensions.alias("Dimensions"),
    )
    message = F.to_json(
        F.struct(
            F.concat(F.lit("alarm-"), F.col("user_id").cast("string")).alias("AlarmName"),
            F.lit("Derived from an event").alias("AlarmDescription"),
            F.concat(F.lit("Threshold crossed by event "), number.cast("string")).alias(
                "StateChangeReason"
            ),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("StateUpdatedTimestamp"),
            state.alias("NewStateValue"),
            F.when(number % 5 != 0, trigger).alias("Trigger"),
        )
    )
    envelope = F.to_json(
        F.struct(F.array(F.struct(F.struct(F.col("message").alias("Message")).alias("Sns"))).alias("Records"))
    )
    return events.withColumn("message", message).select(
        "event_id",
        F.when(number % 13 == 0, "{}")
        .when(number % 13 == 1, F.concat(F.lit("plain text "), number.cast("string")))
        .otherwise(envelope)
        .alias("value"),
    )


def service_points_from_events(events: DataFrame) -> DataFrame:
    """Metric rows standing for service telemetry: query durations, throttles."""
    is_error = F.col("event_type") == "error"
    duration = F.struct(
        F.lit("QueryDuration").alias("metric"),
        (F.col("value") * F.lit(600.0)).alias("value"),
        F.lit("Milliseconds").alias("unit"),
        F.create_map(F.lit("Service"), F.lit("query")).alias("dimensions"),
    )
    throttle = F.struct(
        F.lit("Throttles").alias("metric"),
        F.lit(1.0).alias("value"),
        F.lit("Count").alias("unit"),
        F.create_map(F.lit("Service"), F.lit("ingest")).alias("dimensions"),
    )
    points = F.when(is_error, F.array(duration, throttle)).otherwise(F.array(duration))
    return events.select("ts", F.inline(points)).select(
        F.lit("Telemetry/Service").alias("namespace"), "metric", "value", "unit", "dimensions", "ts"
    )
