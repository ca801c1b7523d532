"""Centroid clustering against brute force with Python integers."""

import hashlib
import math
import random

import pytest

from pricemart.llm import lloyd

DIMS = 5


def vectors(spark, rows, extra=()):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for name in extra:
        frame = frame.selectExpr("*", f"'x' AS `{name}`")
    return frame.repartition(3)


def brute(rows, k, rounds):
    kept = [(i, [math.floor(1024 * x) for x in e]) for i, e in rows]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [list(x) for _, x in order[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        found = [nearest(x)[1] for _, x in kept]
        for n in range(len(centres)):
            members = [x for (_, x), m in zip(kept, found) if m == n]
            if members:
                centres[n] = [sum(z) // len(members) for z in zip(*members)]
    out = [(i, *nearest(x)) for i, x in kept]
    return sorted((i, n, d, sum(e for _, e, m in out if m == n), sum(e for _, e, _ in out), centres[n]) for i, d, n in out)


def found(frame):
    return sorted(
        (r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid"]) for r in frame.collect()
    )


@pytest.mark.parametrize("scale", [1.0, 3e6, 2.0**44])
def test_clusters_against_brute_force(spark, scale):
    rng = random.Random(int(scale))
    spread = min(scale, 2.0**16)  # so that distances fit a long where components are large
    rows = [(n, [scale + spread * rng.gauss(0, 0.4) for _ in range(DIMS)]) for n in range(60)]
    rows += [(100 + n, rows[n % 4][1]) for n in range(20)]  # copies and ties
    frame = vectors(spark, rows, extra=("cluster", "x", "chunk", "ids"))
    got = found(lloyd.clusters(frame, dims=DIMS, k=4, rounds=3, chunk_rows=7, block_dims=2))
    assert got == brute(rows, 4, 3)


def test_a_third_of_all_rows_is_one_vector(spark):
    rng = random.Random(2)
    rows = [(n, [rng.gauss(0, 1) for _ in range(DIMS)]) for n in range(40)] + [(50 + n, [0.5] * DIMS) for n in range(20)]
    assert found(lloyd.clusters(vectors(spark, rows), dims=DIMS, k=3, rounds=4)) == brute(rows, 3, 4)


def test_vectors_that_take_no_part_and_repeated_rows(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(1, None), (2, []), (3, [1.0]), (4, [1.0, nan]), (5, [None, 1.0]), (6, [inf, 1.0]), (7, [1.0, 2.0, 3.0])]
    good = [(8, [0.1, 0.2]), (8, [0.1, 0.2]), (9, [-3.5, 0.0]), (None, [5.0, 5.0])]
    rows = lloyd.clusters(vectors(spark, odd + good), dims=2, k=3, rounds=2).collect()
    assert sorted(str(r["vec_id"]) for r in rows) == ["8", "8", "9", "None"]
    assert len({(r["cluster"], r["distance"]) for r in rows if r["vec_id"] == 8}) == 1


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = lloyd.clusters(vectors(spark, [(1, [1.0, 0.0]), (2, [0.0, 1.0])]), dims=2, k=8, rounds=10).collect()
    assert sorted((r["vec_id"], r["distance"], r["inertia"]) for r in rows) == [(1, 0, 0), (2, 0, 0)]
    empty = lloyd.clusters(vectors(spark, [(1, [1.0])]), dims=2)
    assert empty.count() == 0 and empty.columns == lloyd.clusters(vectors(spark, [(1, [1.0])]), dims=1).columns


def test_what_no_long_can_hold_is_an_error(spark):
    with pytest.raises(ValueError, match="too large"):
        lloyd.clusters(vectors(spark, [(1, [1e30])]), dims=1)
    with pytest.raises(ValueError, match="inertia"):
        lloyd.clusters(vectors(spark, [(n, [1e13 * (-1) ** n]) for n in range(4)]), dims=1, k=1, rounds=1)


def test_shards_stay_where_they_are(spark):
    """In a round only parts of distances and assignments are shuffled, never the shards."""
    from pyspark import StorageLevel

    monkey = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    shards = spark.range(8).selectExpr("id AS chunk", "0 AS block", "1 AS n", "unhex('00') AS x")
    shards = shards.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "chunk", "block").persist(StorageLevel.DISK_ONLY)
    try:
        back = spark.range(8).selectExpr("id AS chunk", "0 AS block", "array(1) AS cluster")
        plan = shards.join(back, ["chunk", "block"])._jdf.queryExecution().executedPlan().toString()
        join = plan.split("InMemoryRelation")[0]
        assert join.count("Exchange hashpartitioning") == 1
    finally:
        shards.unpersist()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", monkey)
