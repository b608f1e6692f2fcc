"""From raw messages to telemetry rows: unwrap, validate, default, partition.

``unwrap_event`` turns text into columns once; validation is one CASE, and
both outcomes are filters on it, so a batch is parsed in a single pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telepulse.functions.calendar import AsOf, lenient_timestamp, moment_literal, with_partition_columns
from telepulse.schema import ENVELOPE_DDL, EVENT_DDL, PARTITION_COLUMNS, TELEMETRY_COLUMNS

# --- fixed values: fields in the order they are checked ----------------------
_CHECKS = [
    ("device_id", "text"),
    ("fleet_id", "text"),
    ("battery_level", "number"),
    ("speed_mps", "number"),
    ("status", "text"),
    ("location_zone", "text"),
    ("temperature_celsius", "number"),
]
UNREADABLE = "Failed to parse telemetry data"

def _is_one_value(text: Column) -> Column:
    """Whether a text is one JSON value and nothing else; the parser alone stops behind the first.

    As the content of an array it makes one element, and two with another behind it. A text that closes the array
    itself, with whatever follows, makes as many both times.
    """
    alone = F.json_array_length(F.concat(F.lit("["), text, F.lit("]")))
    followed = F.json_array_length(F.concat(F.lit("["), text, F.lit(",0]")))
    return F.coalesce((alone == 1) & (followed == 2), F.lit(False))


# Quoted numbers and NaN are no JSON numbers.
_JSON = {"mode": "PERMISSIVE", "allowNonNumericNumbers": "false"}


def unwrap_event(raw: DataFrame, column: str = "value") -> DataFrame:
    """Add ``payload`` (the event's JSON text) and ``event`` (its fields).

    A ``body`` text goes before the message of the first record, that before
    the object itself.
    """
    names = [field.split()[0] for field in EVENT_DDL.split(", ")]
    outer, inner = F.col("_outer"), F.col("_inner")
    record = F.try_element_at(outer["Records"], F.lit(1))["Sns"]
    message = F.when(record.isNotNull(), F.coalesce(record["Message"], F.lit("")))
    bare = F.struct(*[outer[name].alias(name) for name in names])
    inside = F.when(_is_one_value(inner), F.from_json(inner, EVENT_DDL, _JSON))
    parsed = F.struct(
        F.coalesce(inner, F.col(column)).alias("payload"),
        F.when(inner.isNotNull(), inside).otherwise(bare).alias("event"),
    )
    kept = [name for name in raw.columns if name not in ("payload", "event")]
    return (
        raw.withColumn("_outer", F.when(_is_one_value(F.col(column)), F.from_json(column, ENVELOPE_DDL, _JSON)))
        .withColumn("_inner", F.coalesce(outer["body"], message))
        # Generated columns are computed once; as plain expressions a filter on
        # them would be pushed below and parse the text again for every rule.
        .select(*kept, F.inline(F.array(parsed)))
    )


def _reject_reason() -> Column:
    def absent(field: str, kind: str) -> Column:
        value = F.col("event")[field]
        return value.isNull() | (value == "") if kind == "text" else value.isNull() | F.isnan(value)

    # Whether the text parses is only asked again of rows without the first field: what does not has no fields.
    first = _CHECKS[0]
    unreadable = F.try_parse_json("payload").isNull() | ~_is_one_value(F.col("payload"))
    reason = F.when(absent(*first) & unreadable, F.lit(UNREADABLE))
    for field, kind in _CHECKS:
        label = "Missing required field" if kind == "text" else "Missing or invalid field"
        reason = reason.when(absent(field, kind), F.lit(f"{label}: {field}"))
    given = F.nullif(F.col("event")["event_time"], F.lit(""))
    unusable = given.isNotNull() & lenient_timestamp(given).isNull()
    return reason.when(unusable, F.lit("Missing or invalid field: event_time"))


def validate_event(unwrapped: DataFrame) -> DataFrame:
    """Add ``reject_reason``: the first failed rule, NULL for a sound event.

    After the seven field rules, a time that is present but unreadable is
    rejected too: it has no partition a query would ever find.
    """
    return unwrapped.withColumn("reject_reason", _reject_reason())


def accepted_events(validated: DataFrame, *, as_of: AsOf = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Telemetry rows of the sound events, with partition columns."""
    event = F.col("event")
    rows = validated.filter(F.col("reject_reason").isNull()).select(
        *[
            event[name].alias(name)
            for name in TELEMETRY_COLUMNS
            if name not in ("battery_level", "event_time")
        ],
        F.round(event["battery_level"]).try_cast("int").alias("battery_level"),
        default_event_time(event["event_time"], as_of).alias("event_time"),
        *keep,
    )
    return with_partition_columns(rows).select(*TELEMETRY_COLUMNS, *PARTITION_COLUMNS, *keep)


def default_event_time(text: Column, as_of: AsOf = None) -> Column:
    """Parsed event time; ``as_of`` (None: the query's own time) if absent."""
    now = F.current_timestamp() if as_of is None else moment_literal(as_of).cast("timestamp")
    return F.coalesce(lenient_timestamp(F.nullif(text, F.lit(""))), now)


def rejected_events(validated: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Quarantine rows: the message text, whose it was, and why."""
    return validated.filter(F.col("reject_reason").isNotNull()).select(
        F.coalesce(F.nullif(F.col("event.device_id"), F.lit("")), F.lit("unknown")).alias("device_id"),
        "reject_reason",
        "payload",
        *keep,
    )


def reject_summary(validated: DataFrame) -> DataFrame:
    return rejected_events(validated).groupBy("reject_reason").agg(F.count("*").alias("events"))


def ingest_audit(accepted: DataFrame) -> DataFrame:
    """Where each event is stored and when it was taken in."""
    folder = F.concat_ws("/", *[F.concat(F.lit(f"{name}="), F.col(name)) for name in PARTITION_COLUMNS])
    return accepted.select(
        F.lit("Telemetry ingested successfully").alias("message"),
        "device_id",
        "event_time",
        folder.alias("storage_path"),
        F.current_timestamp().alias("ingested_at"),
    )


def format_csv_row(df: DataFrame) -> DataFrame:
    """The nine fields in table order as a CSV line, NULL as nothing."""
    fields = [
        F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias(name) if name == "event_time" else F.col(name)
        for name in TELEMETRY_COLUMNS
    ]
    line = F.to_csv(F.struct(*fields), {"nullValue": "", "emptyValue": ""})
    return df.withColumn("line", line)


def ingest_error_points(validated: DataFrame, time: str) -> DataFrame:
    """One metric row per rejected event, for the ingest error alarm."""
    return validated.filter(F.col("reject_reason").isNotNull()).select(
        F.lit("Telemetry/Service").alias("namespace"),
        F.lit("IngestErrors").alias("metric"),
        F.lit(1.0).alias("value"),
        F.lit("Count").alias("unit"),
        F.create_map(F.lit("Service"), F.lit("ingest")).alias("dimensions"),
        F.col(time).alias("ts"),
    )


def ingest(raw: DataFrame, column: str = "value") -> DataFrame:
    """Unwrap and validate in one call."""
    return validate_event(unwrap_event(raw, column))

