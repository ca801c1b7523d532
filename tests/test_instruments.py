import json

from times import utc

from pricemart.operators import instruments as ops
from pricemart.schemas import TABLES


def base_of(spark, *rows):
    schema = TABLES["financial_instruments"].schema
    defaults = {"instrument_class": "stock", "region": "US", "currency": "USD", "created_at": utc(2024, 1, 1)}
    filled = [{"name": r.get("symbol"), **defaults, **r} for r in rows]
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in filled], schema)


def versions_of(spark, *rows):
    schema = TABLES["instrument_versions"].schema
    filled = [
        {"version_id": f"v{n}", "change_type": "update", "is_delete_marker": False, "changed_by": "system", **r}
        for n, r in enumerate(rows)
    ]
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in filled], schema)


def snapshot(**fields):
    return json.dumps({
        "instrument_id": "x", "exchange_id": None, "symbol": "TSLA", "instrument_class": "stock", "name": "Tesla",
        "region": "US", "currency": "USD", "description": None, "created_at": "2024-02-01T10:00:00.123456Z", **fields,
    })


def by_id(frame):
    return {r.instrument_id: r for r in frame.collect()}


def test_current_snapshot_rules(spark):
    base = base_of(spark, *({"instrument_id": i, "symbol": i.upper()} for i in "abcde"))
    versions = versions_of(
        spark,
        {"instrument_id": "b", "valid_from": utc(2024, 2, 1), "snapshot": snapshot(symbol="OLD")},
        {"instrument_id": "b", "valid_from": utc(2024, 3, 1), "snapshot": snapshot(symbol="NEW")},
        {"instrument_id": "c", "valid_from": utc(2024, 2, 1), "snapshot": snapshot()},
        {"instrument_id": "c", "valid_from": utc(2024, 3, 1), "is_delete_marker": True, "change_type": "delete_marker"},
        {"instrument_id": "d", "valid_from": utc(2024, 2, 1), "snapshot": ""},
        {"instrument_id": "e", "valid_from": utc(2024, 2, 1), "snapshot": snapshot(symbol="LIVE")},
        {"instrument_id": "e", "valid_from": utc(2023, 1, 1), "is_delete_marker": True, "change_type": "delete_marker"},
        {"instrument_id": "nobase", "valid_from": utc(2024, 2, 1), "snapshot": snapshot()},
    )
    got = by_id(ops.current_instruments(base, versions))
    assert {i: r.symbol for i, r in got.items()} == {"a": "A", "b": "NEW", "d": "D", "e": "LIVE"}
    assert got["b"].created_at.microsecond == 123456
    assert got["b"].name == "Tesla"
    flags = {r.instrument_id: r.is_deleted for r in ops.deleted_flags(base, versions).collect()}
    assert flags == {"a": False, "b": False, "c": True, "d": False, "e": False}
    assert ops.instrument_by_id(ops.current_instruments(base, versions), "c").collect() == []
    assert [r.instrument_id for r in ops.instrument_summaries(ops.current_instruments(base, versions), 2).collect()] == ["a", "b"]


def test_symbol_lookup_is_trimmed_and_takes_the_newest(spark):
    base = base_of(
        spark,
        {"instrument_id": "old", "symbol": "AAPL", "created_at": utc(2023, 1, 1)},
        {"instrument_id": "new", "symbol": " aapl ", "created_at": utc(2024, 1, 1)},
    )
    current = ops.current_instruments(base, versions_of(spark))
    assert [r.instrument_id for r in ops.find_by_symbol(current, "AAPL ").collect()] == ["new"]
    assert [r.instrument_id for r in ops.instruments_by_symbol(current).collect()] == ["new"]
    assert ops.find_by_symbol(current, "MSFT").collect() == []


def test_class_reads_base_rows_even_if_deleted(spark):
    base = base_of(spark, {"instrument_id": "a", "symbol": "A", "instrument_class": "bond"}, {"instrument_id": "b", "symbol": "B"})
    assert [r.instrument_id for r in ops.summaries_of_class(base, "bond").collect()] == ["a"]


def test_save_creates_once_and_then_appends(spark):
    base = base_of(spark, {"instrument_id": "a", "symbol": "A"})
    entities = base_of(spark, {"instrument_id": "a", "symbol": "A2"}, {"instrument_id": "b", "symbol": "B", "created_at": utc(2024, 5, 1)})
    created, versions = ops.save_instruments(entities, base)
    assert [r.instrument_id for r in created.collect()] == ["b"]
    kinds = by_id(versions)
    assert (kinds["a"].change_type, kinds["b"].change_type) == ("update", "create")
    assert json.loads(kinds["b"].snapshot)["description"] is None
    assert kinds["b"].valid_from == kinds["b"].valid_from and kinds["b"].changed_by == "system"
    again = by_id(ops.current_instruments(base.unionByName(created), versions))
    assert (again["a"].symbol, again["b"].symbol) == ("A2", "B")
    assert again["b"].created_at == created.first().created_at


def test_delete_markers_need_a_base_row(spark):
    base = base_of(spark, {"instrument_id": "a", "symbol": "A"})
    asked = spark.createDataFrame([("a",), ("missing",)], "instrument_id string")
    (marker,) = ops.delete_markers(asked, base, utc(2024, 6, 1)).collect()
    assert (marker.change_type, marker.is_delete_marker, marker.snapshot) == ("delete_marker", True, None)
    marked = ops.delete_markers(asked, base, utc(2024, 6, 1))
    current = ops.current_instruments(base, marked)
    assert current.collect() == []
    live, rejected = ops.split_delete_requests(asked, current)
    assert (live.count(), rejected.count()) == (0, 2)


def test_patches_apply_in_order(spark):
    base = base_of(spark, {"instrument_id": "a", "symbol": "A", "description": "first"})
    current = ops.current_instruments(base, versions_of(spark))
    patches = spark.createDataFrame(
        [
            ("a", utc(2024, 5, 1), "", "renamed", None),
            ("a", utc(2024, 5, 2), "A2", None, ""),
            ("gone", utc(2024, 5, 2), "X", None, None),
        ],
        "instrument_id string, patched_at timestamp, symbol string, name string, description string",
    )
    updated, rejected = ops.patch_instruments(patches, current)
    first, second = updated.orderBy("created_at").collect()
    assert (first.symbol, first.name, first.description) == ("A", "renamed", "first")
    assert (second.symbol, second.name, second.description) == ("A2", "renamed", "")
    assert [r.instrument_id for r in rejected.collect()] == ["gone"]
    _, versions = ops.save_instruments(updated, base)
    assert by_id(ops.current_instruments(base, versions))["a"].symbol == "A2"


def test_history_closes_intervals(spark):
    versions = versions_of(
        spark,
        {"instrument_id": "a", "valid_from": utc(2024, 1, 1)}, {"instrument_id": "a", "valid_from": utc(2024, 3, 1)},
        {"instrument_id": "a", "valid_from": utc(2024, 3, 1), "version_id": "v9"},
    )
    rows = ops.version_history(versions).orderBy("valid_from").collect()
    assert [r.version_id for r in rows] == ["v0", "v9"]
    assert rows[0].valid_to == rows[1].valid_from and rows[1].valid_to is None
    assert ops.newest_versions(versions, 1).collect()[0].version_id == "v9"


def test_as_of(spark):
    base = base_of(spark, {"instrument_id": "a", "symbol": "BASE"})
    versions = versions_of(
        spark,
        {"instrument_id": "a", "valid_from": utc(2024, 2, 1), "snapshot": snapshot(symbol="ONE")},
        {"instrument_id": "a", "valid_from": utc(2024, 3, 1), "is_delete_marker": True},
        {"instrument_id": "a", "valid_from": utc(2024, 4, 1), "snapshot": snapshot(symbol="TWO")},
    )
    asked = spark.createDataFrame(
        [("a", utc(2024, m, 1, 1)) for m in (1, 2, 3, 4)] + [("a", utc(2024, 2, 1))], "instrument_id string, known_at timestamp"
    )
    got = sorted((r.known_at.month, r.symbol) for r in ops.instruments_as_of(base, versions, asked).collect())
    assert got == [(1, "BASE"), (2, "ONE"), (2, "ONE"), (4, "TWO")]


def test_resolve_or_create(spark):
    base = base_of(spark, {"instrument_id": "a", "symbol": "AAPL"})
    current = ops.current_instruments(base, versions_of(spark))
    asked = spark.createDataFrame(
        [(1, "aapl", None), (2, "msft", "bond"), (3, "MSFT ", None)], "request_order int, symbol string, instrument_class string"
    )
    resolved, created = ops.resolve_instruments(asked, current, utc(2024, 6, 1))
    ids = {r.request_order: r.instrument_id for r in resolved.collect()}
    assert ids[1] == "a" and ids[2] == ids[3]
    (new,) = created.collect()
    assert (new.instrument_id, new.symbol, new.name, new.instrument_class, new.region, new.currency) == (
        ids[2], "msft", "msft", "bond", "US", "USD",
    )
    again, _ = ops.resolve_instruments(asked, current, utc(2024, 6, 1))
    assert {r.request_order: r.instrument_id for r in again.collect()} == ids, "a rerun gives the same ids"


def test_of_equal_times_the_last_written_version_counts(spark):
    base = base_of(spark)
    schema = base.schema
    rows = {name: spark.createDataFrame([tuple({"instrument_id": "i", "symbol": name, "created_at": utc(2024, 1, 1)}.get(f.name) for f in schema)], schema)
            for name in ("first", "second", "third")}
    made, versions = ops.save_instruments(rows["first"], base, utc(2024, 5, 1))
    for n, name in enumerate(("second", "third")):
        versions = versions.unionByName(ops.save_instruments(rows[name], made, utc(2024, 5, 2 + n))[1])
    assert versions.select("version_id").distinct().count() == 3
    assert ops.current_instruments(made, versions).first().symbol == "third"
    assert ops.version_history(versions).first().written_at == utc(2024, 5, 3).replace(tzinfo=None)
    asked = spark.createDataFrame([("i", utc(2024, 6, 1))], "instrument_id string, known_at timestamp")
    assert ops.instruments_as_of(made, versions, asked).first().symbol == "third"
    gone = ops.delete_markers(made.select("instrument_id"), made, utc(2024, 1, 1), written_at=utc(2024, 5, 9))
    assert ops.current_instruments(made, versions.unionByName(gone)).count() == 0
