import pytest
from pyspark.errors import AnalysisException

from telepulse.operators import reports
from telepulse.sources import tables


@pytest.mark.parametrize("query", [None, "", "   "])
def test_query_is_required(spark, query):
    with pytest.raises(ValueError, match="Missing required field: query"):
        reports.run_sql(spark, query)


def test_values_are_text_and_null_stays_null(spark):
    df = reports.run_sql(spark, " SELECT * FROM VALUES ('A', 85, NULL), ('B', 42, 1.5) AS t(device_id, level, `odd.name`) ")
    rows = [r.asDict() for r in df.collect()]
    assert rows == [
        {"device_id": "A", "level": "85", "odd.name": None},
        {"device_id": "B", "level": "42", "odd.name": "1.5"},
    ]


def test_limit_counts_data_rows(spark):
    assert reports.run_sql(spark, "SELECT id FROM range(5000)").count() == 5000
    assert reports.run_sql(spark, "SELECT id FROM range(5000)", max_rows=7).count() == 7
    assert reports.run_sql(spark, "SELECT id FROM range(0)").count() == 0


def test_failure_tells_why(spark):
    with pytest.raises(AnalysisException, match="no_such_table"):
        reports.run_sql(spark, "SELECT * FROM no_such_table")


def test_unknown_name(make):
    with pytest.raises(ValueError, match="Unknown query"):
        reports.named_query(make({}), "nothing")


def test_views_answer_sql(spark, make):
    tables.create_views(spark, make({}, {"status": "ERROR"}))
    row = reports.run_sql(spark, "SELECT error_rate_pct FROM fleet_daily_health WHERE day = '20'").collect()
    assert [r.error_rate_pct for r in row] == ["50.0"]
    assert spark.table("zone_activity").count() == 1
