"""Readings that pass 64 bits in whole units are averaged like all others."""

from decimal import ROUND_HALF_UP, Decimal

import pytest
from conftest import only
from pyspark.sql import functions as F

from telepulse.functions import numeric
from telepulse.operators import health, kpi

HUGE = [1e14, 3e14, 123456789012345.6, -5e17, 9.5e20, 0.25]


@pytest.mark.parametrize("digits", [1, 2])
def test_means_of_huge_readings(spark, digits):
    df = spark.createDataFrame([(v,) for v in HUGE], "v double")
    text = numeric.rounded_mean_sql(f"sum({numeric.exact_sql('v')})", f"count({numeric.exact_sql('v')})", digits)
    row = df.agg(numeric.exact_rounded_mean("v", digits).alias("a"), F.expr(text).alias("b"), numeric.exact_mean("v").alias("m")).first()
    mean = sum(Decimal(repr(v)) for v in HUGE) / len(HUGE)
    wanted = float(mean.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))
    assert row.a == pytest.approx(wanted, rel=1e-15) and row.b == row.a
    assert row.m == pytest.approx(float(mean), rel=1e-15)


def test_huge_readings_in_rollups(make):
    df = make({"temperature_celsius": 1e20}, {"temperature_celsius": 3e20, "event_time": "2026-03-20 12:01:00"})
    assert only(health.fleet_daily_health(df))["avg_temp_celsius"] == 2e20
    assert only(health.device_status_summary(df))["avg_temp_celsius"] == 2e20
    assert only(kpi.fleet_kpis(df, as_of="2026-03-20 23:00:00"))["fleet_avg_temp"] == 2e20
    series = kpi.kpi_history(df, period="1 day").collect()
    assert [r.fleet_avg_temp for r in series] == [2e20]


def test_reading_too_large_for_a_decimal_is_none(make):
    df = make({"temperature_celsius": 1e21}, {"temperature_celsius": 20.0})
    assert only(health.fleet_daily_health(df))["avg_temp_celsius"] == 20.0
