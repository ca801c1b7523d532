from pathlib import Path

import pytest
from pyspark.sql import types as T

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark, tmp_path):
    """Documents from texts or rows, read back from a file, with other columns of clashing names on demand."""

    def make(*rows, extra=()):
        full = []
        for n, row in enumerate(rows):
            row = {"text": row} if isinstance(row, str) or row is None else row
            text = row.get("text")
            full.append((row.get("doc_id", n), text, row.get("lang"), row.get("source"), len(text) if text else None))
        frame = spark.createDataFrame(full, T._parse_datatype_string(DOCUMENT))
        for name in extra:
            frame = frame.selectExpr("*", f"'x' AS `{name}`")
        path = str(tmp_path / f"docs-{len(list(tmp_path.iterdir()))}")
        frame.coalesce(2).write.parquet(path)
        return spark.read.parquet(path)

    return make


@pytest.fixture
def repacked(spark, monkeypatch):
    """Cores come and go: what is scanned after the first save of a module is packed into other partitions."""

    def after_first_save(module):
        save = module.saved

        def saved(df):
            out = save(df)
            spark.conf.set("spark.sql.leafNodeDefaultParallelism", "1")
            return out

        monkeypatch.setattr(module, "saved", saved)
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "12")

    yield after_first_save
    spark.conf.unset("spark.sql.leafNodeDefaultParallelism")


@pytest.fixture
def many_files(spark, tmp_path):
    """Sixty documents of different words in twelve files, every third one a copy of the one before."""
    texts = [" ".join(f"w{n}x{k}" for k in range(9 + n % 7)) for n in range(60)]
    texts = [texts[n - 1] if n % 3 == 2 else t for n, t in enumerate(texts)]
    rows = [(n, t, "en", f"s{n % 4}", len(t)) for n, t in enumerate(texts)]
    path = str(tmp_path / "many_files")
    spark.createDataFrame(rows, DOCUMENT).repartition(12).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def tables():
    for name in ("sf0.001", "sf0.01"):
        if Path(f"/root/testdata/{name}").exists():
            return f"/root/testdata/{name}"
    pytest.skip("no test tables")
