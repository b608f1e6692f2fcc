"""Alarm notifications to chat and mail texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telepulse.functions.calendar import display_time
from telepulse.functions.text import escape_html, joined, or_absent, or_not_available
from telepulse.schema import ALARM_DDL, NOTIFICATION_DDL

# --- fixed values: state colours and marks, structure of the texts -------------
_COLOURS = {"ALARM": "#DC143C", "OK": "#32CD32"}
_OTHER_COLOUR = "#FFA500"
_MARKS = {"ALARM": "🚨", "OK": "✅"}
_OTHER_MARK = "⚠️"
INVALID_ENVELOPE = "Invalid notification structure"
INVALID_MESSAGE = "Notification message is not JSON"
FOOTER = "This is an automated alert from the telemetry monitoring system"


def parse_alarm(raw: DataFrame, column: str = "value") -> DataFrame:
    """Add ``alarm`` (struct) and ``warning``; a bad row never fails the job."""
    outer = F.from_json(column, NOTIFICATION_DDL)
    message = F.nullif(F.try_element_at(outer["Records"], F.lit(1))["Sns"]["Message"], F.lit(""))
    parsed = F.struct(
        F.col("_text").alias("_message"), F.from_json("_text", ALARM_DDL).alias("alarm")
    )
    warning = F.when(F.col("_message").isNull(), INVALID_ENVELOPE).when(
        F.col("alarm.AlarmName").isNull() & F.try_parse_json("_message").isNull(), INVALID_MESSAGE
    )
    kept = [name for name in raw.columns if name != "alarm"]
    # Generated, so that the text is parsed once and not again for a filter on it.
    return (
        raw.withColumn("_text", message)
        .select(*kept, F.inline(F.array(parsed)))
        .withColumn("warning", warning)
        .drop("_message")
    )


def readable_alarms(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("warning").isNull()).drop("warning")


def unreadable_alarms(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("warning").isNotNull()).drop("alarm")


def _field(name: str) -> Column:
    return or_absent(F.col("alarm")[name])


def _trigger(name: str) -> Column:
    return or_not_available(F.col("alarm.Trigger")[name])


def _by_state(known: dict[str, str], other: str) -> Column:
    state = F.col("alarm.NewStateValue")
    chosen = F
    for name, value in known.items():
        chosen = chosen.when(state == name, value)
    return chosen.otherwise(other)


def _time() -> Column:
    return display_time(F.col("alarm.StateUpdatedTimestamp"))


def _pair(dimension: Column) -> Column:
    return F.concat(or_absent(dimension["name"]), F.lit(": "), or_absent(dimension["value"]))


def _dimensions(separator: str, prefix: str = "", suffix: str = "", escaped: bool = False) -> Column:
    def line(dimension: Column) -> Column:
        text = escape_html(_pair(dimension)) if escaped else _pair(dimension)
        return F.concat(F.lit(prefix), text, F.lit(suffix))

    return joined(F.col("alarm.Trigger.Dimensions"), line, separator, f"{prefix}N/A{suffix}")


def render_chat(alarms: DataFrame) -> DataFrame:
    """Add ``color`` and ``chat``, the JSON of a block message."""

    def text(kind: str, *parts: Column | str) -> Column:
        body = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
        return F.struct(F.lit(kind).alias("type"), body.alias("text"))

    def block(kind: str, body: Column | None = None, fields: Column | None = None) -> Column:
        shape = "struct<type: string, text: string>"
        return F.struct(
            F.lit(kind).alias("type"),
            (F.lit(None).cast(shape) if body is None else body).alias("text"),
            (F.lit(None).cast(f"array<{shape}>") if fields is None else fields).alias("fields"),
        )

    mark, state = _by_state(_MARKS, _OTHER_MARK), _field("NewStateValue")
    blocks = F.array(
        block("header", text("plain_text", mark, " Telemetry Alarm: ", _field("AlarmName"))),
        block(
            "section",
            fields=F.array(
                text("mrkdwn", "*Status*\n", state),
                text("mrkdwn", "*Time*\n", _time()),
            ),
        ),
        block("section", text("mrkdwn", "*Reason*\n", _field("StateChangeReason"))),
        block(
            "section",
            text(
                "mrkdwn",
                "*Metric*\n",
                _trigger("MetricName"),
                "\n*Statistic*\n",
                _trigger("Statistic"),
                "\n*Dimensions*\n",
                _dimensions(", "),
            ),
        ),
        block("divider"),
    )
    title = F.concat(mark, F.lit(" "), _field("AlarmName"), F.lit(" - "), state)
    message = F.to_json(F.struct(title.alias("text"), blocks.alias("blocks")))
    return alarms.withColumns({"color": _by_state(_COLOURS, _OTHER_COLOUR), "chat": message})


def email_subject() -> Column:
    return F.concat(F.lit("["), _field("NewStateValue"), F.lit("] "), _field("AlarmName"))


def render_email_text(alarms: DataFrame) -> DataFrame:
    """Add ``subject`` and ``body_text``."""
    lines = [
        F.lit("TELEMETRY ALARM NOTIFICATION\n"),
        F.concat(F.lit("Alarm Name: "), _field("AlarmName")),
        F.concat(F.lit("State: "), _field("NewStateValue")),
        F.concat(F.lit("Time: "), _time(), F.lit("\n")),
        F.lit("Reason:"),
        F.concat(_field("StateChangeReason"), F.lit("\n")),
        F.lit("Metric Details:"),
        *[
            F.concat(F.lit(f"  - {label}: "), _trigger(name))
            for label, name in [
                ("Name", "MetricName"),
                ("Namespace", "Namespace"),
                ("Statistic", "Statistic"),
                ("Unit", "Unit"),
            ]
        ],
        F.lit("\nDimensions:"),
        F.concat(_dimensions("\n", prefix="  - "), F.lit("\n")),
        F.lit("---"),
        F.lit(FOOTER),
    ]
    return alarms.withColumns({"subject": email_subject(), "body_text": F.concat_ws("\n", *lines)})


def render_email_html(alarms: DataFrame) -> DataFrame:
    """Add ``subject`` and ``body_html``; values are escaped."""

    def tag(name: str, *content: Column | str, style: str = "") -> Column:
        opening = f'<{name} style="{style}">' if style else f"<{name}>"
        parts = [F.lit(p) if isinstance(p, str) else p for p in content]
        return F.concat(F.lit(opening), *parts, F.lit(f"</{name}>"))

    def item(label: str, name: str) -> Column:
        return tag("li", f"{label}: ", escape_html(_trigger(name)))

    banner = F.concat(
        F.lit('<div style="color:white;padding:16px;background:'),
        _by_state(_COLOURS, _OTHER_COLOUR),
        F.lit('">'),
        tag("h1", escape_html(_field("AlarmName"))),
        tag("p", "State: ", escape_html(_field("NewStateValue"))),
        F.lit("</div>"),
    )
    body = [
        banner,
        tag("h2", "Alert Time"),
        tag("p", _time()),
        tag("h2", "Reason"),
        tag("p", escape_html(_field("StateChangeReason"))),
        tag("h2", "Metric Details"),
        tag(
            "ul",
            item("Name", "MetricName"),
            item("Namespace", "Namespace"),
            item("Statistic", "Statistic"),
            item("Unit", "Unit"),
        ),
        tag("h2", "Dimensions"),
        tag("ul", _dimensions("", prefix="<li>", suffix="</li>", escaped=True)),
        tag("p", FOOTER, style="color:#999"),
    ]
    page = F.concat(F.lit("<!DOCTYPE html><html>"), tag("body", *body), F.lit("</html>"))
    return alarms.withColumns({"subject": email_subject(), "body_html": page})
