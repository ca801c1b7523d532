from datetime import date, timedelta
from decimal import Decimal

import pytest
from times import utc
from pyspark.sql import functions as F

from pricemart.schemas import TABLES
from pricemart.sources import commits, tables
from pricemart.sources.commits import Folder


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def test_missing_table_is_empty(spark, root):
    for name, spec in TABLES.items():
        empty = tables.scan(spark, root, name)
        assert empty.columns == spec.schema.names and empty.isEmpty()


def test_append_prices_by_source_and_year(spark, root, prices, tmp_path):
    tables.append(prices({"close_price": Decimal("1.5")}, {"record_date": date(2023, 5, 5)}), root, "prices")
    tables.append(prices({"source_id": "s2"}), root, "prices")
    assert tables.scan(spark, root, "prices").count() == 3
    years = {p.name for p in (tmp_path / "prices").glob("commit=*/source_id=s1/*")}
    assert years == {"record_year=2023", "record_year=2024"}


def test_a_load_written_twice_counts_once(spark, root, prices):
    for _ in range(2):
        tables.append_load(prices({}, {}), root, "prices", "load-1")
    tables.append_load(prices({}), root, "prices", "load-2")
    tables.append(prices({}), root, "prices")
    assert tables.scan(spark, root, "prices").count() == 4
    assert tables.scan(spark, root, "prices").columns == TABLES["prices"].schema.names
    loads = tables.scan(spark, root, "prices", with_load=True).select("load_batch").distinct()
    assert loads.count() == 3
    with pytest.raises(ValueError):
        tables.upsert(spark, root, "prices", prices({}))
    with pytest.raises(ValueError):
        tables.append_load(prices({}), root, "owners", "load-1")


def test_upsert_last_write_wins(spark, root):
    schema = "owner_id string, owner_type string, name string, n int"
    tables.upsert(spark, root, "owners", spark.createDataFrame([("1", "person", "Alice", 0), ("2", "person", "Bob", 0)], schema))
    later = spark.createDataFrame([("1", "person", "first", 1), ("1", "person", "last", 2), ("3", "firm", "New", 1)], schema)
    tables.upsert(spark, root, "owners", later, F.col("n"))
    assert {r.owner_id: r.name for r in tables.scan(spark, root, "owners").collect()} == {"1": "last", "2": "Bob", "3": "New"}


def test_upsert_rewrites_touched_partitions_only(spark, root, tmp_path):
    def averages(window, value):
        return spark.createDataFrame(
            [("i", "s", window, date(2024, 1, 1), value)],
            "instrument_id string, source_id string, window_days int, record_date date, close_price double",
        )

    tables.upsert(spark, root, "rolling_averages", averages(7, 1.0))
    def live(window):
        _, entries = commits.live(Folder(spark, tables.table_path(root, "rolling_averages")))
        return [e for e in entries if f"window_days={window}/" in e.path]

    before = live(7)
    tables.upsert(spark, root, "rolling_averages", averages(30, 2.0))
    tables.upsert(spark, root, "rolling_averages", averages(30, 3.0))
    assert live(7) == before and len(before) == 1
    got = {r.window_days: r.close_price for r in tables.scan(spark, root, "rolling_averages").collect()}
    assert got == {7: 1.0, 30: 3.0}


OWNER = "owner_id string, owner_type string, name string"


def owners(spark, **names):
    return spark.createDataFrame([(k, "person", v) for k, v in names.items()], OWNER)


def shown(frame):
    return {r.owner_id: r.name for r in frame.collect()}


def test_a_write_that_is_cut_off_leaves_the_table_as_it_was(spark, root, monkeypatch):
    tables.upsert(spark, root, "owners", owners(spark, a="old", b="old"))

    def killed(*_):
        raise KeyboardInterrupt

    for cut in ("replace", "live"):
        with monkeypatch.context() as patched, pytest.raises(KeyboardInterrupt):
            patched.setattr(tables.commits, cut, killed)
            tables.upsert(spark, root, "owners", owners(spark, a="new"))
    assert shown(tables.scan(spark, root, "owners")) == {"a": "old", "b": "old"}
    with monkeypatch.context() as patched, pytest.raises(KeyboardInterrupt):
        patched.setattr(tables.commits, "replace", killed)
        tables.delete(spark, root, "owners", owners(spark, a="x").select("owner_id"))
    assert shown(tables.scan(spark, root, "owners")) == {"a": "old", "b": "old"}
    gone = tables.vacuum(spark, root, "owners", timedelta(0))
    assert len([n for n in gone if n.startswith("commit=")]) >= 2
    assert shown(tables.scan(spark, root, "owners")) == {"a": "old", "b": "old"}


def test_a_reader_sees_the_table_as_it_was_when_it_began(spark, root):
    tables.upsert(spark, root, "owners", owners(spark, a="old"))
    before = tables.scan(spark, root, "owners")
    tables.upsert(spark, root, "owners", owners(spark, a="new", b="new"))
    after = tables.scan(spark, root, "owners")
    tables.delete(spark, root, "owners", owners(spark, a="").select("owner_id"))
    assert shown(before) == {"a": "old"} and shown(after) == {"a": "new", "b": "new"}
    assert shown(tables.scan(spark, root, "owners")) == {"b": "new"}


def test_of_two_writers_that_meet_none_is_lost(spark, root, monkeypatch):
    tables.upsert(spark, root, "owners", owners(spark, a="1"))
    replace, calls = commits.replace, []

    def late(folder, number, entries):
        if not calls:
            calls.append(1)
            tables.upsert(spark, root, "owners", owners(spark, b="other"))
        return replace(folder, number, entries)

    monkeypatch.setattr(tables.commits, "replace", late)
    tables.upsert(spark, root, "owners", owners(spark, a="2"))
    assert shown(tables.scan(spark, root, "owners")) == {"a": "2", "b": "other"}


def test_an_incomplete_list_does_not_count(spark, root, monkeypatch):
    monkeypatch.setattr(commits.time, "sleep", lambda _: None)
    tables.append(owners(spark, a="1"), root, "owners")
    folder = Folder(spark, tables.table_path(root, "owners"))
    assert folder.create("_commits/000000000002.json", '{"path": "commit=no"')
    assert not folder.create("_commits/000000000002.json", "again")
    assert shown(tables.scan(spark, root, "owners")) == {"a": "1"}
    tables.append(owners(spark, b="2"), root, "owners")
    assert shown(tables.scan(spark, root, "owners")) == {"a": "1", "b": "2"}


def test_compaction_keeps_all_rows_and_reads_fewer_files(spark, root, prices):
    for load in range(6):
        tables.append_load(
            prices(*({"instrument_id": f"i{n:02d}", "system_date": utc(2024, 6, 1, load)} for n in range(20))), root, "prices", f"load-{load}"
        )
    key = lambda frame: sorted((r.instrument_id, r.system_date, r.load_batch) for r in frame.collect())
    before = key(tables.scan(spark, root, "prices", with_load=True))
    one, files = tables.scan_key(spark, root, "prices", "i07"), lambda f: len(f.inputFiles())
    count, many = one.count(), files(one)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # a file for every range
    try:
        tables.compact(spark, root, "prices")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert key(tables.scan(spark, root, "prices", with_load=True)) == before
    one = tables.scan_key(spark, root, "prices", "i07")
    assert one.count() == count == 6 and files(one) < many
    assert files(one) < files(tables.scan(spark, root, "prices"))

    # a closed load that is tried again adds nothing; a new one is read beside the compacted rows
    tables.append_load(prices({"instrument_id": "i07"}), root, "prices", "load-3")
    tables.append_load(prices({"instrument_id": "i07"}), root, "prices", "load-9")
    assert tables.scan_key(spark, root, "prices", "i07").count() == 7
    tables.compact(spark, root, "prices")
    tables.vacuum(spark, root, "prices", timedelta(0))
    assert tables.scan(spark, root, "prices").count() == len(before) + 1
    assert tables.scan_key(spark, root, "prices", "i07").count() == 7
    with pytest.raises(ValueError):
        tables.compact(spark, root, "owners")


def test_delete_policies(spark, root):
    assets = spark.createDataFrame(
        [("p1", "a", utc(2024, 1, 1), "A", "stock"), ("p1", "a", utc(2024, 2, 1), "A", "stock"), ("p2", "a", utc(2024, 1, 1), "A", "stock")],
        "portfolio_id string, instrument_id string, added_at timestamp, symbol string, instrument_class string",
    )
    tables.upsert(spark, root, "portfolio_assets", assets)
    key = spark.createDataFrame([("p1", "a", utc(2024, 1, 1))], "portfolio_id string, instrument_id string, added_at timestamp")
    tables.delete(spark, root, "portfolio_assets", key)
    assert tables.scan(spark, root, "portfolio_assets").count() == 2
    tables.delete(spark, root, "portfolio_assets", key.select("portfolio_id"))
    assert [r.portfolio_id for r in tables.scan(spark, root, "portfolio_assets").collect()] == ["p2"]
    tables.delete(spark, root, "portfolio_assets", assets)
    assert tables.scan(spark, root, "portfolio_assets").isEmpty()

    signal = spark.createDataFrame([("a", utc(2024, 1, 1), "1", "volatility", "high")],
                                   "instrument_id string, generated_at timestamp, signal_id string, signal_type string, severity string")
    tables.append(signal, root, "risk_signals")
    tables.delete(spark, root, "risk_signals", signal)
    assert tables.scan(spark, root, "risk_signals").count() == 1, "append-only tables ignore deletes"
    for name in ("ingest_jobs", "prices"):
        with pytest.raises(tables.DeleteRefused):
            tables.delete(spark, root, name, spark.createDataFrame([("x",)], "job_id string"))


LATEST = {
    "portfolio_assets": ("added_at", ("portfolio_id", "instrument_id")),
    "analytics_results": ("computed_at", ("instrument_id", "source_id")),
    "risk_signals": ("generated_at", ("instrument_id",)),
    "recommendations": ("created_at", ("user_id",)),
    "ingest_log": ("ingested_at", ("source_id", "log_year")),
    "question_log": ("asked_at", ("user_id", "session_id")),
}


@pytest.mark.parametrize("name", LATEST)
def test_latest_and_history(spark, name):
    moment, group = LATEST[name]
    spec = TABLES[name]

    def row(owner, month):
        values = {f.name: None for f in spec.schema}
        for f in spec.schema:
            if not f.nullable:
                values[f.name] = {"integer": 2024}.get(f.dataType.typeName(), f"{f.name}-x")
        values.update({k: values[k] if k == "log_year" else f"{k}-{owner}" for k in group})
        return tuple({**values, moment: utc(2024, month, 1)}[f.name] for f in spec.schema)

    rows = spark.createDataFrame([row("a", 1), row("a", 3), row("a", 2), row("b", 1)], spec.schema)
    newest = tables.latest(rows, name).collect()
    assert sorted(r[moment].month for r in newest) == [1, 3]
    first = group[0]
    listed = tables.history(rows, name, **{first: f"{first}-a"}).collect()
    assert [r[moment].month for r in listed] == [3, 2, 1]
