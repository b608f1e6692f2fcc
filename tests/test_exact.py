"""Averages depend on no order of rows and on no grouping of partial sums."""

import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from telepulse.functions import numeric
from telepulse.operators import health, kpi, reports, windows


def test_the_tie_that_doubles_miss(spark):
    df = spark.createDataFrame([(-20.84,), (81.63,), (-19.24,)], "v double")
    row = df.agg(numeric.exact_rounded_mean("v", 1).alias("r"), numeric.exact_mean("v").alias("m")).first()
    assert (row.r, row.m) == (13.9, 13.85)


def test_against_decimals(spark):
    random.seed(3)
    rows = [(k, random.choice([None, round(random.uniform(-99, 99), 2), random.randint(-9, 9) / 4, float("nan")])) for k in range(200) for _ in range(6)]
    df = spark.createDataFrame(rows, "k int, v double")
    found = {r.k: (r.a, r.b) for r in df.groupBy("k").agg(
        numeric.exact_rounded_mean("v", 1).alias("a"), F.expr(numeric.rounded_mean_sql(f"sum({numeric.exact_sql('v')})", f"count({numeric.exact_sql('v')})", 2)).alias("b")
    ).collect()}
    for k in range(200):
        values = [Decimal(str(v)) for i, v in rows if i == k and v is not None and v == v]
        if values:
            mean = sum(values) / len(values)
            wanted = tuple(float(mean.quantize(Decimal(q), ROUND_HALF_UP)) for q in ("0.1", "0.01"))
        else:
            wanted = (None, None)
        assert found[k] == wanted


def test_odd_readings(spark):
    df = spark.createDataFrame([(float("inf"),), (1e30,), (None,), (-0.01,)], "v double")
    row = df.agg(numeric.exact_rounded_mean("v", 1).alias("r"), numeric.exact_mean("v").alias("m")).first()
    assert str(row.r) == "0.0" and row.m == -0.01
    none = df.where("v > 5").agg(numeric.exact_rounded_mean("v", 1).alias("r"), numeric.exact_mean("v").alias("m")).first()
    assert (none.r, none.m) == (None, None)


@pytest.mark.parametrize(
    "rollup",
    [
        health.fleet_daily_health,
        health.device_status_summary,
        health.zone_activity,
        lambda df: windows.window_stats(df).drop("processed_at"),
        lambda df: kpi.kpi_history(df, period="1 hour"),
        lambda df: kpi.kpis_of_partials(kpi.add_up(kpi.kpi_partials(df.where("battery_level > 20")).union(kpi.kpi_partials(df.where("battery_level <= 20")))), as_of="2026-03-20 23:59:59"),
        lambda df: reports.avg_temp_by_device(df),
    ],
)
def test_rollups_do_not_depend_on_the_order_of_rows(spark, make, rollup):
    random.seed(5)
    rows = [
        {
            "device_id": f"R-{random.randint(0, 4)}",
            "event_time": f"2026-03-20 {random.randint(0, 23):02d}:00:00",
            "temperature_celsius": round(random.uniform(-30, 90), 2),
            "speed_mps": round(random.uniform(0, 3), 3),
            "battery_level": random.randint(0, 100),
            "status": random.choice(["ACTIVE", "ERROR", "IDLE"]),
        }
        for _ in range(500)
    ]
    df = make(*rows)
    wanted = sorted(map(tuple, rollup(df).collect()), key=str)
    for parts in (1, 7, 40):
        assert sorted(map(tuple, rollup(df.repartition(parts, F.rand(parts))).collect()), key=str) == wanted
