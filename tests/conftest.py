import sys
from datetime import date, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pricemart.schemas import TABLES  # noqa: E402
from pricemart.session import build_session  # noqa: E402
from times import utc  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def prices(spark):
    """Price rows from dicts; ids, dates and load times have defaults."""

    def make(*points):
        rows = []
        for n, point in enumerate(points):
            row = {
                "instrument_id": "i1", "source_id": "s1", "record_date": date(2024, 1, 1) + timedelta(days=n),
                "system_date": utc(2024, 6, 1), "extra_indicators": {}, **point,
            }
            row.setdefault("ingested_at", row["system_date"])
            row.setdefault("record_year", row["record_date"].year)
            rows.append(tuple(row.get(f.name) for f in TABLES["prices"].schema))
        return spark.createDataFrame(rows, TABLES["prices"].schema)

    return make
