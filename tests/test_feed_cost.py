"""What a feed costs: a page is parsed once, a value read once, and a load keeps compressed files and no cache."""

import pytest
from pyspark.sql import functions as F
from times import utc

from pricemart.operators import ingest
from pricemart.plans import catalogue, jobs
from pricemart.schemas import PRICE
from pricemart.sources import feed

FOLDER = "/root/testdata/sf0.001"
RECORDS = "source_id string, instrument_id string, page string, position int, record map<string,string>"


def optimized(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["feed_casts", "feed_rejects", "extra_indicators"])
def test_generators_only_pass_on_what_was_computed(spark, name):
    # Spark does not generate code for a generator that holds a lambda, nor for what a parser is given
    plan = optimized(catalogue.QUERIES[name](spark, FOLDER))
    checked = [line for line in plan.splitlines() if "Generate inline" in line and "reject_reason" in line]
    assert len(checked) == 1 and "lambda" not in checked[0] and "cast(" not in checked[0]
    parsers = [line for line in plan.splitlines() if "from_json" in line]
    assert len(parsers) == 1 and "concat(" not in parsers[0] and not parsers[0].lstrip(" :+-").startswith("Filter")


@pytest.mark.parametrize("name", ["load_log", "job_outcomes"])
def test_the_log_reads_the_feed_without_a_copy(spark, name):
    assert "LogicalRDD" not in optimized(catalogue.QUERIES[name](spark, FOLDER))


def test_a_load_reads_files_and_leaves_none(spark, tmp_path, monkeypatch):
    plans, paths, log = [], [], ingest.load_log

    def seen(transformed, *more):
        plans.append(optimized(transformed))
        paths.append(transformed.inputFiles()[0])
        return log(transformed, *more)

    monkeypatch.setattr(jobs.ingest, "load_log", seen)
    rows = [("s1", "i1", "p", n, {"date": f"2024-01-0{n + 1}", "close": "7.5", "mood": "x"}) for n in range(3)]
    jobs.load_records(spark, str(tmp_path / "w"), spark.createDataFrame(rows, RECORDS), utc(2024, 6, 1), "first")
    assert "InMemoryRelation" not in plans[0] and "Relation [" in plans[0]
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(paths[0]).getParent()
    assert not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
    assert jobs.tables.scan(spark, str(tmp_path / "w"), "prices").count() == 3


def test_landed_pages_are_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalogue, "scratch_path", lambda _, name: str(tmp_path / name))
    assert catalogue.QUERIES["stream_feed_load"](spark, FOLDER).count() > 0
    landed = [f.name for f in (tmp_path / "feed-landed").rglob("part-*") if not f.name.startswith(".")]
    assert landed and all(name.endswith(".gz") for name in landed)


def test_tables_without_rows_give_no_records(spark):
    pages = spark.createDataFrame([
        ("none", '{"datatable": {"columns": [{"name": "a"}], "data": []}}'), ("null", '{"datatable": {"columns": [{"name": "a"}]}}'),
        ("unnamed", '{"datatable": {"data": [["1"]]}}'), ("null row", '{"datatable": {"columns": [{"name": "a"}, {}], "data": [null, ["1", "2"]]}}'),
        ("broken", '{"datatable"'),
    ], "page string, text string")
    got = [(r.page, r.position, r.record) for r in feed.page_records(feed.parse_pages(pages, "text")).orderBy("page", "position").collect()]
    assert got == [("null row", 0, None), ("null row", 1, {"a": "1", "": "2"}), ("unnamed", 0, {})]


def test_integers_are_those_read_by_way_of_the_decimal(spark):
    texts = ["12.9", "-12.9", "1_000", "1__0", " 7 ", "\t7\n", "5e-19", "1e-30", "1e18", "9e18", "1e19", "1e30", "12d", "0x1p3", "nan", "inf", "", None,
             "4.9999999999999999", "4.99999999999999", "9007199254740993", "123456789012345", "9223372036854775807", "9223372036854775808", "-0.9", "1e3"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    slow = F.when(F.col("t").contains("_"), F.regexp_replace("t", "(?<=[0-9])_(?=[0-9])", "")).otherwise(F.col("t"))
    slow = F.trim(slow).try_cast(PRICE).cast("double").try_cast("bigint")
    assert [r for r in frame.select("t", ingest.to_integer(F.col("t")).alias("fast"), slow.alias("slow")).collect() if r.fast != r.slow] == []
