"""Every checked query against its SQL, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry
from check import rows_of
from pricemart.plans.catalogue import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, db, name):
    frame = QUERIES[name](spark, FOLDER)
    result = db.execute(SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(frame.columns)
    assert rows_of(frame.columns, frame.collect()) == rows_of(columns, result.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_sheets_and_reports_cover_all_dates(spark, tmp_path):
    events = spark.read.parquet(f"{FOLDER}/events.parquet").selectExpr("* EXCEPT (ts)", "ts + INTERVAL 60 DAYS AS ts")
    events.write.parquet(str(tmp_path / "events.parquet"))
    series = events.select("user_id", "event_type").distinct().count()
    assert QUERIES["grounded_reports"](spark, str(tmp_path)).count() == series
    assert QUERIES["insufficient_flags_all_dates"](spark, str(tmp_path)).count() == series
    sheets = QUERIES["fact_sheets_all_dates"](spark, str(tmp_path)).where("seq = 0").collect()
    assert len(sheets) == series and sum(r["count"] for r in sheets) == events.count()
