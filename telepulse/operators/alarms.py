"""Threshold alarms on metric series.

Metric rows are aggregated to one value per alarm and period in one shuffle.
Everything after works on runs: a period with data, each of the first missing
ones behind it that an alarm still looks back over, and all further missing ones
as one row with their number. So a gap costs as many rows as the rule has
periods, however long it is.

``alarm_runs`` can carry on: given the last runs of an earlier evaluation it
reads the metric rows of new periods only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telepulse.functions.calendar import AsOf, moment_literal, utc_moment
from telepulse.functions.numeric import exact_mean, exact_sum, round_half_up
from telepulse.functions.text import dimension_key
from telepulse.schema import FLEET_NAMESPACE, QUALITY_NAMESPACE, SERVICE_NAMESPACE

NOT_BREACHING = "notBreaching"
MISSING = "missing"

_STATISTICS = {
    "Sum": lambda name: exact_sum(name).cast("double"),
    "Average": exact_mean,
    "Maximum": F.max,
    "Minimum": F.min,
}


@dataclass(frozen=True)
class AlarmRule:
    """Alarm when ``statistic`` of a metric breaches in N periods in a row."""

    name: str
    description: str
    namespace: str
    metric: str
    dimensions: dict[str, str] = field(hash=False)
    statistic: str
    period_seconds: int
    threshold: float
    comparison: str = ">"
    periods: int = 1
    missing: str = MISSING

    def key(self) -> str:
        return ",".join(f"{k}={v}" for k, v in sorted(self.dimensions.items()))


# --- fixed values: the six alarms ---------------------------------------------
RULES = {
    rule.name: rule
    for rule in [
        AlarmRule(
            name="high-error-rate",
            description="Alert when ingest errors exceed the threshold",
            namespace=SERVICE_NAMESPACE,
            metric="IngestErrors",
            dimensions={"Service": "ingest"},
            statistic="Sum",
            period_seconds=300,
            threshold=5.0,
        ),
        AlarmRule(
            name="throttling",
            description="Alert when ingest is throttled",
            namespace=SERVICE_NAMESPACE,
            metric="Throttles",
            dimensions={"Service": "ingest"},
            statistic="Sum",
            period_seconds=60,
            threshold=1.0,
            comparison=">=",
        ),
        AlarmRule(
            name="slow-queries",
            description="Alert when queries take too long",
            namespace=SERVICE_NAMESPACE,
            metric="QueryDuration",
            dimensions={"Service": "query"},
            statistic="Average",
            period_seconds=300,
            threshold=30000.0,
            periods=2,
        ),
        AlarmRule(
            name="critical-battery-count",
            description="Alert when more than 3 devices have critically low battery (< 20%)",
            namespace=FLEET_NAMESPACE,
            metric="CriticalBatteryCount",
            dimensions={"Fleet": "ALL"},
            statistic="Maximum",
            period_seconds=300,
            threshold=3.0,
            missing=NOT_BREACHING,
        ),
        AlarmRule(
            name="fleet-error-rate",
            description="Alert when the fleet error rate exceeds 25% for 2 periods in a row",
            namespace=FLEET_NAMESPACE,
            metric="FleetErrorRatePct",
            dimensions={"Fleet": "ALL"},
            statistic="Maximum",
            period_seconds=300,
            threshold=25.0,
            periods=2,
            missing=NOT_BREACHING,
        ),
        AlarmRule(
            name="data-freshness",
            description="Alert when no new telemetry has arrived in the last 60 minutes",
            namespace=QUALITY_NAMESPACE,
            metric="DataFreshnessMinutes",
            dimensions={"Pipeline": "Telemetry"},
            statistic="Maximum",
            period_seconds=1800,
            threshold=60.0,
            missing=NOT_BREACHING,
        ),
    ]
}


def _rule_struct(rule: AlarmRule) -> Column:
    return F.struct(
        F.lit(rule.name).alias("alarm"),
        F.lit(rule.description).alias("description"),
        F.lit(rule.namespace).alias("namespace"),
        F.lit(rule.metric).alias("metric"),
        F.lit(rule.key()).alias("dimension_key"),
        F.lit(rule.statistic).alias("statistic"),
        F.lit(rule.period_seconds).cast("bigint").alias("period_seconds"),
        F.lit(float(rule.threshold)).alias("threshold"),
        F.lit(rule.comparison).alias("comparison"),
        F.lit(rule.periods).alias("periods"),
        F.lit(rule.missing).alias("missing"),
    )


def _rules_of_metric(rules: Sequence[AlarmRule], namespace: Column, metric: Column) -> Column:
    """Array of the rules about a metric, NULL for none.

    Rules are listed in code, so they are a literal to look up, not a table to
    join.
    """
    groups: dict[str, list[Column]] = {}
    for rule in rules:
        groups.setdefault(f"{rule.namespace}|{rule.metric}", []).append(_rule_struct(rule))
    entries = [x for key, group in groups.items() for x in (F.lit(key), F.array(*group))]
    return F.try_element_at(F.create_map(*entries), F.concat(namespace, F.lit("|"), metric))


def _rule_named(rules: Sequence[AlarmRule], name: Column) -> Column:
    entries = [x for rule in rules for x in (F.lit(rule.name), _rule_struct(rule))]
    return F.try_element_at(F.create_map(*entries), name)


def metric_period_stat(
    metrics: DataFrame, *, period: str, statistics: Sequence[str] = tuple(_STATISTICS)
) -> DataFrame:
    """Statistics of each metric and dimension set per period."""
    by = metrics.groupBy(
        "namespace",
        "metric",
        dimension_key(F.col("dimensions")).alias("dimensions"),
        F.window("ts", period).alias("period"),
    )
    stats = by.agg(
        *[_STATISTICS[name]("value").alias(name.lower()) for name in statistics],
        F.count("value").alias("samples"),
    )
    return stats.select(
        "namespace",
        "metric",
        "dimensions",
        F.col("period.start").alias("period_start"),
        *[name.lower() for name in statistics],
        "samples",
    )


def alarm_values(metrics: DataFrame, rules: Sequence[AlarmRule]) -> DataFrame:
    """The value each alarm compares, per period of its own length."""
    points = metrics.select(
        "dimensions",
        "value",
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("second"),
        F.explode(_rules_of_metric(rules, F.col("namespace"), F.col("metric"))).alias("rule"),
    )
    # Dimensions are only spelled out for metrics that some rule is about.
    matched = points.filter(dimension_key(F.col("dimensions")) == F.col("rule.dimension_key")).select(
        "value", "second", "rule.alarm", "rule.statistic", "rule.period_seconds"
    )
    start = F.col("second") - F.pmod("second", F.col("period_seconds"))
    # Further rule columns are the same in all rows of an alarm.
    stats = matched.groupBy("alarm", "statistic", "period_seconds", start.alias("period_start")).agg(
        *[function("value").alias(name) for name, function in _STATISTICS.items()]
    )
    value = F.coalesce(*[F.when(F.col("statistic") == name, F.col(name)) for name in _STATISTICS])
    return stats.select("alarm", "period_seconds", "period_start", value.alias("value"))


def _with_gaps(values: DataFrame, rules: Sequence[AlarmRule], end: AsOf) -> DataFrame:
    """Add ``length`` (1) and the gaps behind each present period, up to the next one or to the period of ``end``.

    Of a gap the first N-1 periods are rows of their own, as an alarm of N periods still sees data before them; the
    rest is one row of its length.
    """
    step = F.col("period_seconds")
    following = F.lead("period_start").over(Window.partitionBy("alarm").orderBy("period_start"))
    last = F.col("period_start")
    if end is not None:
        final = F.unix_seconds(moment_literal(end).cast("timestamp"))
        last = F.greatest(last, final - F.pmod(final, step))
    missing = ((F.coalesce(following - step, last) - F.col("period_start")) / step).cast("bigint")
    single = F.least(F.col("missing"), F.col("periods").cast("bigint") - 1)
    place = F.explode(F.sequence(F.lit(0).cast("bigint"), single + (F.col("missing") > single).cast("bigint")))
    periods = _rule_named(rules, F.col("alarm"))["periods"]
    return (
        values.withColumns({"missing": missing, "periods": periods})
        .withColumn("place", place)
        .select(
            "alarm",
            (F.col("period_start") + F.col("place") * step).alias("period_start"),
            F.when(F.col("place") <= single, F.lit(1).cast("bigint")).otherwise(F.col("missing") - single).alias("length"),
            F.when(F.col("place") == 0, F.col("value")).alias("value"),
        )
    )


RUN_COLUMNS = ["alarm", "period_start", "length", "value", "breach", "breaching_periods", "state"]
CARRIED_DDL = "alarm string, period_start timestamp_ntz, length bigint, value double, state string"


def alarm_runs(
    metrics: DataFrame, rules: Sequence[AlarmRule], *, end: AsOf = None, carried: DataFrame | None = None, until: AsOf = None
) -> DataFrame:
    """Runs of periods with their state since each alarm's first metric row: ``length`` periods from ``period_start``.

    ALARM needs N breaching periods in a row, so never comes in the first N-1.
    A missing period does not breach; where the rule does not say so and all N
    periods are missing, the state is INSUFFICIENT_DATA. Else it is OK.

    ``until`` leaves periods that are not over by then to a later call, which takes what ``carried_runs`` kept of this
    one as ``carried``, and returns new periods only.
    """
    if until is not None:
        metrics = metrics.where(F.col("ts") < moment_literal(until))
    values = alarm_values(metrics, rules)
    rule = _rule_named(rules, F.col("alarm"))
    if until is not None:
        bound = int(utc_moment(until).replace(tzinfo=timezone.utc).timestamp())
        values = values.where(F.col("period_start") + F.col("period_seconds") <= bound)
    if carried is not None:
        before = carried.select(
            "alarm",
            rule["period_seconds"].alias("period_seconds"),
            F.unix_seconds(F.col("period_start").cast("timestamp")).alias("period_start"),
            "length",
            "value",
        )
        # a carried run of missing periods stands at its last one: what is before it is not looked at again
        before = before.withColumn("period_start", F.col("period_start") + (F.col("length") - 1) * F.col("period_seconds"))
        marks = F.broadcast(before.groupBy("alarm").agg(F.max("period_start").alias("seen")))  # a row an alarm
        new = F.col("seen").isNull() | (F.col("period_start") > F.col("seen"))
        values = values.join(marks, "alarm", "left").where(new).drop("seen").unionByName(before.drop("length"))
    runs = _with_gaps(values, rules, end)
    series = runs.withColumn("rule", rule).select("period_start", "length", "value", "rule.*")
    above = F.col("value") > F.col("threshold")
    at_or_above = F.col("value") >= F.col("threshold")
    breach = F.coalesce(F.when(F.col("comparison") == ">=", at_or_above).otherwise(above), F.lit(False))
    widest = max(rule.periods for rule in rules)
    by_alarm = Window.partitionBy("alarm").orderBy("period_start")
    # The frame of the longest rule, cut to each rule's own length. Behind a run of missing periods a frame is as if
    # it were one period: those before it are missing as well.
    history = F.collect_list(
        F.struct(F.col("breach"), F.col("value").isNotNull().alias("present"))
    ).over(by_alarm.rowsBetween(1 - widest, 0))
    recent = F.slice(
        "history", F.greatest(F.size("history") - F.col("periods") + 1, F.lit(1)), F.col("periods")
    )
    breaching = F.size(F.filter("recent", lambda p: p["breach"]))
    has_data = F.exists("recent", lambda p: p["present"])
    state = (
        F.when(breaching == F.col("periods"), "ALARM")
        .when((F.col("missing") == MISSING) & ~has_data, "INSUFFICIENT_DATA")
        .otherwise("OK")
    )
    found = (
        series.withColumn("breach", breach)
        .withColumn("history", history)
        .withColumn("recent", recent)
        .select(
            "alarm",
            "period_start",
            "length",
            "value",
            "breach",
            breaching.alias("breaching_periods"),
            state.alias("state"),
            "period_seconds",
            "periods",
            "description",
            "namespace",
            "metric",
            "dimension_key",
            "statistic",
            "comparison",
            "threshold",
        )
    )
    if carried is not None:
        found = found.join(marks, "alarm", "left").where(new).drop("seen")
    return found.withColumn("period_start", F.timestamp_seconds("period_start").cast("timestamp_ntz"))


def carried_runs(runs: DataFrame, carried: DataFrame | None = None) -> DataFrame:
    """The last runs of each alarm that a later evaluation looks back on: as many as the rule has periods."""
    kept = runs.select("alarm", "period_start", "length", "value", "state", "periods")
    if carried is not None:
        periods = runs.groupBy("alarm").agg(F.max("periods").alias("periods"))
        kept = kept.unionByName(carried.join(F.broadcast(periods), "alarm", "left").withColumn("periods", F.coalesce("periods", F.lit(1 << 20))))
    newest = Window.partitionBy("alarm").orderBy(F.desc("period_start"))
    return kept.withColumn("place", F.row_number().over(newest)).where("place <= periods").drop("place", "periods")


def look_back(carried: DataFrame, rules: Sequence[AlarmRule]) -> datetime | None:
    """From when on metric rows are needed: the first period that some alarm has not seen. None for all of them.

    ``carried`` holds a few rows an alarm, and alarms are listed in code.
    """
    seconds = {rule.name: rule.period_seconds for rule in rules}
    ends: dict[str, datetime] = {}
    for row in carried.collect():
        if row.alarm in seconds:
            end = row.period_start + timedelta(seconds=row.length * seconds[row.alarm])
            ends[row.alarm] = max(end, ends.get(row.alarm, end))
    return min(ends.values()) if len(ends) == len(seconds) else None


def evaluate_alarms(
    metrics: DataFrame, rules: Sequence[AlarmRule], *, end: AsOf = None
) -> DataFrame:
    """State of each alarm in each period: ``alarm_runs`` with a row for each period of a run."""
    return alarm_periods(alarm_runs(metrics, rules, end=end))


def alarm_periods(runs: DataFrame) -> DataFrame:
    start, step = F.col("period_start"), F.make_dt_interval(secs=F.col("period_seconds"))
    last = start + F.make_dt_interval(secs=(F.col("length") - 1) * F.col("period_seconds"))
    each = F.explode(F.when(F.col("length") == 1, F.array(start)).otherwise(F.sequence(start, last, step)))
    return runs.withColumn("period_start", each).drop("length")


def consecutive_breach(metrics: DataFrame, rules: Sequence[AlarmRule], *, end: AsOf = None) -> DataFrame:
    """How many of the last N periods breached, and whether all did."""
    states = evaluate_alarms(metrics, rules, end=end)
    return states.select(
        "alarm",
        "period_start",
        "value",
        "breach",
        "breaching_periods",
        (F.col("breaching_periods") == F.col("periods")).alias("all_breach"),
    )


def _number(value: Column) -> Column:
    # format_string writes a NULL as text.
    return F.when(value.isNotNull(), F.format_string("%.2f", round_half_up(value, 2)))


def _reason() -> Column:
    compared = F.concat(
        F.col("statistic"),
        F.lit(" of "),
        F.col("metric"),
        F.lit(" "),
        F.col("comparison"),
        F.lit(" "),
        _number(F.col("threshold")),
    )
    held = F.concat(
        F.lit(": "),
        F.col("breaching_periods").cast("string"),
        F.lit(" of "),
        F.col("periods").cast("string"),
        F.lit(" periods had "),
        compared,
        F.lit("; latest value "),
        F.coalesce(_number(F.col("value")), F.lit("missing")),
    )
    crossing = F.when(F.col("state") == "ALARM", "Threshold crossed").when(
        F.col("state") == "OK", "Threshold not crossed"
    )
    return F.concat(F.coalesce(crossing, F.lit("Insufficient data")), held)


def alarm_transitions(states: DataFrame, carried: DataFrame | None = None) -> DataFrame:
    """Rows (of periods or runs) where an alarm changes its state; each alarm starts as OK, or as it was carried.

    ``changed_at`` is the end of the period that settled the new state.
    """
    series = Window.partitionBy("alarm").orderBy("period_start")
    first = F.lit("OK")
    if carried is not None:
        last = carried.groupBy("alarm").agg(F.max_by("state", "period_start").alias("carried_state"))
        states = states.join(F.broadcast(last), "alarm", "left")
        first = F.coalesce("carried_state", first)
    before = F.coalesce(F.lag("state").over(series), first)
    changes = states.withColumn("old_state", before).filter(F.col("state") != F.col("old_state"))
    return changes.select(
        "alarm",
        "description",
        "old_state",
        F.col("state").alias("new_state"),
        (F.col("period_start") + F.make_dt_interval(secs=F.col("period_seconds"))).alias("changed_at"),
        _reason().alias("reason"),
        "namespace",
        "metric",
        "statistic",
        "dimension_key",
    )


def alarm_notifications(transitions: DataFrame) -> DataFrame:
    """Transitions as the notification envelopes that ``parse_alarm`` reads."""
    dimension = F.transform(
        F.split("dimension_key", ","),
        lambda pair: F.struct(
            F.substring_index(pair, "=", 1).alias("name"),
            F.regexp_extract(pair, "=(.*)$", 1).alias("value"),
        ),
    )
    message = F.to_json(
        F.struct(
            F.col("alarm").alias("AlarmName"),
            F.col("description").alias("AlarmDescription"),
            F.col("reason").alias("StateChangeReason"),
            F.date_format("changed_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("StateUpdatedTimestamp"),
            F.col("new_state").alias("NewStateValue"),
            F.struct(
                F.col("metric").alias("MetricName"),
                F.col("namespace").alias("Namespace"),
                F.col("statistic").alias("Statistic"),
                dimension.alias("Dimensions"),
            ).alias("Trigger"),
        )
    )
    record = F.struct(F.struct(message.alias("Message")).alias("Sns"))
    return transitions.select(
        F.col("alarm").alias("alarm_name"), "changed_at", F.to_json(F.struct(F.array(record).alias("Records"))).alias("value")
    )
