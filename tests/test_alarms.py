import json
from dataclasses import replace
from datetime import datetime, timedelta, timezone

import pytest
from conftest import only

from telepulse.operators import alarms, notify
from telepulse.schema import METRICS_DDL

START = datetime(2026, 3, 20, 12, 0)
BATTERY = alarms.RULES["critical-battery-count"]
ERRORS = alarms.RULES["fleet-error-rate"]
SLOW = alarms.RULES["slow-queries"]
THROTTLES = alarms.RULES["throttling"]


@pytest.fixture
def series(spark):
    def rows(rule, *values, offset=0):
        """One value per period; a list for several, None for an empty period."""
        points = []
        for i, value in enumerate(values):
            for v in value if isinstance(value, list) else [value]:
                if v is not None:
                    at = START + timedelta(seconds=i * rule.period_seconds + offset)
                    points.append((rule.namespace, rule.metric, float(v), "Count", rule.dimensions, at))
        return spark.createDataFrame(points, METRICS_DDL.replace("ts timestamp", "ts timestamp_ntz"))

    return rows


def states(metrics, *rules, **options):
    rows = alarms.evaluate_alarms(metrics, list(rules), **options).orderBy("alarm", "period_start").collect()
    return [r.state for r in rows]


def test_threshold_is_strict(series):
    assert states(series(BATTERY, 3, 4, 3.01), BATTERY) == ["OK", "ALARM", "ALARM"]


def test_throttling_includes_threshold(series):
    assert states(series(THROTTLES, 1, [0.5, 0.4], [0.5, 0.5]), THROTTLES) == ["ALARM", "OK", "ALARM"]


def test_two_periods_in_a_row(series):
    found = states(series(ERRORS, 30, 30, 20, 30, 25, 26, 27), ERRORS)
    assert found == ["OK", "ALARM", "OK", "OK", "OK", "OK", "ALARM"]


def test_gap_does_not_breach(series):
    assert states(series(ERRORS, 30, None, 30, 30), ERRORS) == ["OK", "OK", "OK", "ALARM"]


def test_gap_without_rule_is_insufficient(series):
    found = states(series(SLOW, 40000, 40000, None, None, None, 100), SLOW)
    assert found == ["OK", "ALARM", "OK", "INSUFFICIENT_DATA", "INSUFFICIENT_DATA", "OK"]


def test_series_runs_to_the_end_asked_for(series):
    end = START + timedelta(minutes=17)
    assert states(series(BATTERY, 9), BATTERY, end=end) == ["ALARM", "OK", "OK", "OK"]


@pytest.mark.parametrize(
    "statistic,value", [("Sum", 6.0), ("Average", 2.0), ("Maximum", 3.0), ("Minimum", 1.0)]
)
def test_statistics(series, statistic, value):
    rule = replace(BATTERY, statistic=statistic)
    row = only(alarms.evaluate_alarms(series(rule, [1, 2, 3]), [rule]))
    assert row["value"] == value
    stat = only(alarms.metric_period_stat(series(rule, [1, 2, 3]), period="5 minutes"))
    assert stat[statistic.lower()] == value and stat["samples"] == 3 and stat["dimensions"] == "Fleet=ALL"


def test_other_dimensions_do_not_count(series):
    other = replace(BATTERY, dimensions={"Fleet": "F-1"})
    assert states(series(other, 9), BATTERY) == []
    more = replace(BATTERY, dimensions={"Zone": "Z", "Fleet": "ALL"})
    assert states(series(more, 9), BATTERY) == [] and states(series(more, 9), more) == ["ALARM"]


def test_rules_of_different_periods_together(series):
    metrics = series(BATTERY, 9, 1, offset=299).union(series(THROTTLES, 0, 2))
    assert states(metrics, BATTERY, THROTTLES) == ["ALARM", "OK", "OK", "ALARM"]


def test_six_rules():
    assert {(r.threshold, r.periods, r.comparison, r.missing) for r in alarms.RULES.values()} == {
        (5.0, 1, ">", "missing"),
        (1.0, 1, ">=", "missing"),
        (30000.0, 2, ">", "missing"),
        (3.0, 1, ">", "notBreaching"),
        (25.0, 2, ">", "notBreaching"),
        (60.0, 1, ">", "notBreaching"),
    }


def test_transitions_and_notification(series):
    evaluated = alarms.evaluate_alarms(series(BATTERY, 1, 5, 6, 2), [BATTERY])
    changes = alarms.alarm_transitions(evaluated).orderBy("changed_at").collect()
    assert [(r.old_state, r.new_state) for r in changes] == [("OK", "ALARM"), ("ALARM", "OK")]
    assert changes[0].changed_at == START + timedelta(minutes=10)
    assert "5.00" in changes[0].reason and "3.00" in changes[0].reason
    sent = alarms.alarm_notifications(alarms.alarm_transitions(evaluated))
    parsed = notify.readable_alarms(notify.parse_alarm(sent))
    row = parsed.filter("alarm.NewStateValue = 'ALARM'").collect()[0].alarm
    assert row.AlarmName == "critical-battery-count" and row.Trigger.Statistic == "Maximum"
    assert [(d.name, d.value) for d in row.Trigger.Dimensions] == [("Fleet", "ALL")]


def test_random_series_against_brute_force(spark):
    import random

    random.seed(7)
    rules = [replace(r, name=f"{r.name}-{n}", periods=n) for r in (BATTERY, SLOW) for n in (1, 2, 3)]
    values = {}
    for rule in (BATTERY, SLOW):
        present = [i for i in range(80) if random.random() < 0.6]
        values[rule.metric] = {i: random.choice([rule.threshold, rule.threshold + 1, 0.0]) for i in present}
    points = [
        (r.namespace, r.metric, v, "x", r.dimensions, START + timedelta(seconds=300 * i))
        for r in (BATTERY, SLOW)
        for i, v in values[r.metric].items()
    ]
    metrics = spark.createDataFrame(points, METRICS_DDL.replace("ts timestamp", "ts timestamp_ntz"))
    expected = set()
    for rule in rules:
        series = values[rule.metric]
        for i in range(min(series), max(series) + 1):
            frame = [series.get(k) for k in range(max(i - rule.periods + 1, min(series)), i + 1)]
            breaching = [v is not None and v > rule.threshold for v in frame]
            state = "OK"
            if len(frame) == rule.periods and all(breaching):
                state = "ALARM"
            elif rule.missing == "missing" and all(v is None for v in frame):
                state = "INSUFFICIENT_DATA"
            expected.add((rule.name, START + timedelta(seconds=300 * i), state))
    found = alarms.evaluate_alarms(metrics, rules).collect()
    assert {(r.alarm, r.period_start, r.state) for r in found} == expected
    assert len(found) == len(expected)


def points_of(spark, rule, seconds):
    rows = [(rule.namespace, rule.metric, v, "x", rule.dimensions, datetime(1970, 1, 1) + timedelta(seconds=s)) for s, v in seconds]
    return spark.createDataFrame(rows, METRICS_DDL.replace("ts timestamp", "ts timestamp_ntz"))


@pytest.mark.parametrize("periods,rows", [(1, 3), (2, 4), (3, 5)])
def test_a_long_gap_is_few_rows(spark, periods, rows):
    """One stray stamp of 1970 with a rule of 60 seconds: 29 million missing periods."""
    rule = replace(THROTTLES, periods=periods)
    now = int(START.replace(tzinfo=timezone.utc).timestamp())
    runs = alarms.alarm_runs(points_of(spark, rule, [(0, 5.0), (now, 5.0)]), [rule]).orderBy("period_start").collect()
    assert len(runs) == rows and sum(r.length for r in runs) == now // 60 + 1
    assert runs[-2].state == "INSUFFICIENT_DATA" and runs[-2].length > 29_000_000
    changes = alarms.alarm_transitions(alarms.alarm_runs(points_of(spark, rule, [(0, 5.0), (now, 5.0)]), [rule]))
    assert changes.count() == (3 if periods == 1 else 2)


def test_portions_equal_the_whole(spark):
    import random

    random.seed(11)
    rules = [replace(r, name=f"{r.name}-{n}", periods=n) for r in (BATTERY, SLOW, THROTTLES) for n in (1, 2, 3)]
    points = []
    for rule in (BATTERY, SLOW, THROTTLES):
        for i in range(120):
            if random.random() < 0.3 and not 40 < i < 70:
                value = random.choice([rule.threshold, rule.threshold + 1, 0.0])
                points.append((rule.namespace, rule.metric, value, "x", rule.dimensions, START + timedelta(seconds=300 * i + random.randint(0, 299))))
    metrics = spark.createDataFrame(points, METRICS_DDL.replace("ts timestamp", "ts timestamp_ntz"))
    whole = alarms.alarm_runs(metrics, rules)
    found, changes, carried = [], [], None
    for minutes in (0, 7, 100, 101, 290, 300, 450, 1000):
        until = START + timedelta(minutes=minutes)
        since = alarms.look_back(carried, rules) if carried is not None else None
        new = metrics if since is None else metrics.where(metrics.ts >= since)
        runs = alarms.alarm_runs(new, rules, carried=carried, until=until)
        found += [tuple(r) for r in alarms.alarm_periods(runs).collect()]
        changes += [tuple(r) for r in alarms.alarm_transitions(runs, carried).collect()]
        kept = alarms.carried_runs(runs, carried).collect()
        carried = spark.createDataFrame(kept, alarms.CARRIED_DDL)
        assert len(kept) <= sum(rule.periods for rule in rules)
    assert sorted(found, key=str) == sorted((tuple(r) for r in alarms.alarm_periods(whole).collect()), key=str)
    assert sorted(changes, key=str) == sorted((tuple(r) for r in alarms.alarm_transitions(whole).collect()), key=str)


# --- messages ---------------------------------------------------------------------
ALARM = {
    "AlarmName": "slow-queries",
    "AlarmDescription": "Queries taking too long",
    "NewStateValue": "ALARM",
    "StateChangeReason": "Average duration exceeded 30 seconds",
    "StateUpdatedTimestamp": "2026-03-29T10:00:00Z",
    "Trigger": {
        "MetricName": "Duration",
        "Namespace": "Telemetry/Service",
        "Statistic": "Average",
        "Unit": "Milliseconds",
        "Dimensions": [{"name": "Service", "value": "query"}, {"name": "Zone", "value": "<a & b>"}],
    },
}


def read(spark, *alarms_, raw=()):
    texts = [json.dumps({"Records": [{"Sns": {"Message": json.dumps(a)}}]}) for a in alarms_]
    return notify.parse_alarm(spark.createDataFrame([(t,) for t in [*texts, *raw]], "value string"))


def rendered(spark, alarm):
    df = notify.readable_alarms(read(spark, alarm))
    for render in (notify.render_chat, notify.render_email_text, notify.render_email_html):
        df = render(df)
    return only(df)


@pytest.mark.parametrize(
    "state,color,mark", [("ALARM", "#DC143C", "🚨"), ("OK", "#32CD32", "✅"), ("INSUFFICIENT_DATA", "#FFA500", "⚠️")]
)
def test_states(spark, state, color, mark):
    row = rendered(spark, {**ALARM, "NewStateValue": state})
    chat = json.loads(row["chat"])
    assert chat["text"] == f"{mark} slow-queries - {state}"
    assert row["color"] == color and color in row["body_html"]
    assert row["subject"] == f"[{state}] slow-queries" and f"State: {state}" in row["body_text"]


def test_chat_blocks(spark):
    blocks = json.loads(rendered(spark, ALARM)["chat"])["blocks"]
    assert [b["type"] for b in blocks] == ["header", "section", "section", "section", "divider"]
    assert blocks[1]["fields"][1] == {"type": "mrkdwn", "text": "*Time*\n3/29/2026, 10:00:00 AM"}
    assert blocks[2]["text"]["text"] == "*Reason*\nAverage duration exceeded 30 seconds"
    assert blocks[3]["text"]["text"].endswith("*Dimensions*\nService: query, Zone: <a & b>")
    assert blocks[4] == {"type": "divider"}


def test_mail(spark):
    row = rendered(spark, ALARM)
    text, html = row["body_text"], row["body_html"]
    assert "Alarm Name: slow-queries" in text and "  - Service: query\n  - Zone: <a & b>" in text
    assert "  - Unit: Milliseconds" in text and "automated alert" in text
    assert html.startswith("<!DOCTYPE html><html>") and html.endswith("</html>")
    assert "<li>Service: query</li>" in html and "&lt;a &amp; b&gt;" in html and "<a" not in html
    for part in ("Duration", "Telemetry/Service", "Average"):
        assert part in html


@pytest.mark.parametrize("trigger", [None, {}, {"MetricName": "", "Dimensions": []}])
def test_missing_trigger(spark, trigger):
    row = rendered(spark, {**ALARM, "Trigger": trigger})
    assert "*Metric*\nN/A\n*Statistic*\nN/A\n*Dimensions*\nN/A" in json.loads(row["chat"])["blocks"][3]["text"]["text"]
    assert "  - Name: N/A" in row["body_text"] and "Dimensions:\n  - N/A" in row["body_text"]
    assert "<li>N/A</li>" in row["body_html"]


def test_missing_fields_keep_the_message(spark):
    row = rendered(spark, {"NewStateValue": "OK"})
    assert row["subject"] == "[OK] undefined" and "Time: Invalid Date" in row["body_text"]


def test_malformed_rows_only_warn(spark):
    bad = ["{}", "text", '{"Records": []}', '{"Records": [{"Sns": {}}]}', '{"Records": [{"Sns": {"Message": "plain"}}]}']
    parsed = read(spark, ALARM, raw=bad)
    assert notify.readable_alarms(parsed).count() == 1
    warnings = [r.warning for r in notify.unreadable_alarms(parsed).collect()]
    assert sorted(warnings) == sorted([notify.INVALID_ENVELOPE] * 4 + [notify.INVALID_MESSAGE])
