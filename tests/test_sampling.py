"""Order-free sampling: exact sizes, same rows under any partitioning, hot groups."""

import hashlib

import pytest
from pyspark.sql import functions as F

from corpusflow.functions import hashing
from corpusflow.operators import sampling

SEED = 42


def python_hash(key, tag):
    return int(hashlib.md5(f"{SEED}|{tag}|{key}".encode()).hexdigest()[:15], 16)


def ids(spark, n):
    return spark.range(n).select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("key"), "id")


@pytest.mark.parametrize("n", [0, 1, 19, 20, 21, 60, 1003])
def test_holdout_is_exact(spark, n):
    rows = sampling.holdout(ids(spark, n), "key", SEED).collect()
    val = {r.key for r in rows if r.split == "val"}
    ordered = sorted((python_hash(f"r{i}", "order"), f"r{i}") for i in range(n))
    assert len(rows) == n
    assert val == {k for _, k in ordered[: max(1, int(n * 0.05))]}


def test_holdout_ignores_partitioning(spark):
    def val(df):
        return {r.key for r in sampling.holdout(df, "key", SEED).filter("split = 'val'").collect()}

    base = ids(spark, 500)
    assert val(base) == val(base.repartition(7)) == val(base.orderBy(F.desc("key")).coalesce(1))


@pytest.mark.parametrize("limit", [0, 1, 37, 499, 500, 501])
def test_cap_takes_the_smallest_hashes(spark, limit):
    kept = {r.key for r in sampling.cap(ids(spark, 500), "key", limit, SEED).collect()}
    ordered = sorted((python_hash(f"r{i}", "cap"), f"r{i}") for i in range(500))
    assert kept == {k for _, k in ordered[: limit or 500]}


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_cap_per_group_with_a_hot_group(spark, threshold):
    """A third of the rows in one group; with and without broadcast."""
    n = 3000
    rows = ids(spark, n).withColumn(
        "group", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string"))
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        kept = sampling.cap_per_group(rows, "group", "key", 45, SEED).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    expected = set()
    groups = {}
    for i in range(n):
        groups.setdefault("hot" if i % 3 == 0 else str(i % 50), []).append(f"r{i}")
    for members in groups.values():
        expected |= set(sorted(members, key=lambda k: (python_hash(k, "cap"), k))[:45])
    assert {r.key for r in kept} == expected and len(kept) == len(expected)


def test_positions_are_the_sorted_order(spark):
    rows = sampling.with_position(ids(spark, 700), "key", SEED).collect()
    ordered = sorted((python_hash(r.key, "order"), r.key) for r in rows)
    assert {r.key: r.position for r in rows} == {k: i for i, (_, k) in enumerate(ordered)}
    listed = [r.key for r in sampling.shuffled(ids(spark, 700), "key", SEED).collect()]
    assert listed == [k for _, k in ordered]


def test_keep_share_grows_with_the_weight(spark):
    rows = ids(spark, 2000)

    def kept(w):
        return {r.key for r in rows.filter(hashing.keep_share(F.col("key"), SEED, "t", w)).collect()}

    sets = [kept(w) for w in (0, 0.1, 0.5, 0.9, 1)]
    assert all(a <= b for a, b in zip(sets, sets[1:]))
    assert not sets[0] and len(sets[-1]) == 2000 and abs(len(sets[2]) - 1000) < 120


def test_pick_is_even(spark):
    counts = ids(spark, 4000).groupBy(hashing.pick(F.col("key"), SEED, "w", list("abcd")).alias("c")).count().collect()
    assert len(counts) == 4 and all(abs(r["count"] - 1000) < 150 for r in counts)


def test_prefix_cap(spark):
    assert [r.id for r in sampling.first_rows(ids(spark, 50), 3, "id").collect()] == [0, 1, 2]


def test_shuffled_rows_keep_their_order_in_partitioned_files(spark, tmp_path):
    rows = sampling.holdout(ids(spark, 900), "key", SEED, share=0.3)
    sampling.shuffled(rows, "key", SEED, "split").select("split", "key").write.partitionBy("split").json(str(tmp_path / "o"))
    for split, size in (("train", 630), ("val", 270)):
        keys = []
        for part in sorted((tmp_path / "o" / f"split={split}").glob("part-*")):
            keys += [line.split('"')[3] for line in part.read_text().splitlines()]
        assert len(keys) == size
        assert keys == sorted(keys, key=lambda k: (python_hash(k, "order"), k))


def test_repeated_keys_are_counted_one_by_one(spark):
    from collections import Counter

    df = spark.range(600).select((F.col("id") % 7).cast("string").alias("key"), (F.col("id") % 2).alias("g"))
    for limit in (1, 100, 250, 599, 600, 700):
        assert sampling.cap(df, "key", limit, SEED).count() == min(limit, 600)
        groups = Counter(r.g for r in sampling.cap_per_group(df, "g", "key", limit, SEED).collect())
        assert groups == {0: min(limit, 300), 1: min(limit, 300)}
    assert Counter(r.split for r in sampling.holdout(df, "key", SEED).collect()) == {"val": 30, "train": 570}
    one = df.filter("key = '3'")
    assert Counter(r.split for r in sampling.holdout(one, "key", SEED).collect())["val"] == one.count() * 5 // 100


def test_rows_of_one_key_stay_spread(spark):
    """All rows are tied at the cut; no single task numbers them."""
    df = spark.range(0, 800, 1, 16).select(F.lit("k").alias("key"), F.lit("g").alias("g"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for kept in (sampling.cap(df, "key", 700, SEED), sampling.cap_per_group(df, "g", "key", 700, SEED)):
            rows = kept.withColumn("task", F.spark_partition_id()).collect()
            assert len({r.id for r in rows}) == len(rows) == 700 and set(kept.columns) == set(df.columns)
            assert len({r.task for r in rows}) > 2
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_order_needs_no_range_sample(spark):
    plan = sampling.shuffled(ids(spark, 700), "key", SEED, "key")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and plan.count("Exchange") == 1
