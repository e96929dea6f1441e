"""Globally ordered operators against plain single-task forms."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from opsframe.operators import objects, ordered


def skewed(spark, n=6000):
    """Rows of which a third share one key, in scrambled order."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.hash("id"), F.lit(1000))).alias("k"), F.col("id").alias("v")
    )


def test_rank_is_the_global_row_number(spark):
    df = skewed(spark)
    plain = df.select("*", (F.row_number().over(Window.orderBy("k", "v")) - 1).cast("long").alias("rank"))
    assertDataFrameEqual(ordered.with_rank(df, "k", "v"), plain)


def test_descending_order_and_total(spark):
    ranked = ordered.with_rank(skewed(spark, 500), F.col("k").desc(), F.col("v"), rank="at", total="n")
    plain = skewed(spark, 500).select(
        "*",
        (F.row_number().over(Window.orderBy(F.col("k").desc(), "v")) - 1).cast("long").alias("at"),
        F.lit(500).cast("long").alias("n"),
    )
    assertDataFrameEqual(ranked, plain)


def test_hot_key_is_cut_into_slices(spark):
    keep = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = ordered.range_parts(skewed(spark).select("k"), "k")
        sizes = [r["count"] for r in parts.groupBy(ordered.PART).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", keep)
    assert sum(sizes) == 6000
    # A third of all rows are copies of one row; still every slice is near a quarter.
    assert len(sizes) == 4 and max(sizes) < 1900


def test_copies_get_different_ranks(spark):
    copies = spark.range(900).select(F.lit("same").alias("k"))
    ranks = sorted(r.rank for r in ordered.with_rank(copies, "k").collect())
    assert ranks == list(range(900))


def test_map_columns_are_carried(spark):
    df = spark.createDataFrame([(2, {"a": 1}), (1, {"b": 2})], "k int, m map<string,int>")
    assert [(r.k, r.m, r.rank) for r in ordered.with_rank(df, "k").orderBy("rank").collect()] == [
        (1, {"b": 2}, 0), (2, {"a": 1}, 1),
    ]


def test_no_rows(spark):
    none = spark.range(0).select(F.col("id").alias("k"))
    assert ordered.with_rank(none, "k").count() == 0
    assert ordered.ntile_partition(none, "k", tiles=3).count() == 0
    assert ordered.chunk_assign(none, "k").count() == 0
    assert ordered.quota_sample(none.withColumn("size", F.lit(1)), "k", "size", 5).count() == 0


@pytest.mark.parametrize("n, tiles", [(5, 10), (112, 10), (1001, 7)])
def test_ntile_equals_the_window_function(spark, n, tiles):
    df = spark.range(n).select((F.col("id") * 7919 % 10007).alias("k"))
    plain = df.select("*", F.ntile(tiles).over(Window.orderBy("k")).alias("tile"))
    got = ordered.ntile_partition(df, "k", tiles=tiles)
    assertDataFrameEqual(got, plain)
    sizes = [r["count"] for r in got.groupBy("tile").count().orderBy("tile").collect()]
    assert max(sizes) - min(sizes) <= 1 and sizes == sorted(sizes, reverse=True)


def fan_out(keys, fan, path=()):
    size = len(keys) // fan
    if size > 1:
        for number, at in enumerate(range(0, len(keys), size)):
            yield from fan_out(keys[at:at + size], fan, (*path, number))
    else:
        for key in keys:
            yield key, list(path)


@pytest.mark.parametrize("n, fan", [(7, 4), (8, 4), (333, 4), (1234, 5)])
def test_chunks_equal_the_recursion(spark, n, fan):
    got = ordered.chunk_assign(spark.range(n).select(F.col("id").alias("k")), "k", fan_out=fan)
    assert {r.k: r.chunk_path for r in got.collect()} == dict(fan_out(list(range(n)), fan))


def sample_by_hand(rows, quota, seed):
    import hashlib

    total, kept = 0, []
    for key, size in sorted(rows, key=lambda r: hashlib.md5((seed + r[0]).encode()).hexdigest()):
        if total > quota:
            break
        kept.append(key)
        total += size
    return sorted(kept)


@pytest.mark.parametrize("quota", [0, 999, 20_000, 10**9])
def test_quota_sample_equals_the_loop(spark, quota):
    rng = random.Random(4)
    rows = [(f"key{i}", rng.choice([0, 1, 5, 100])) for i in range(3000)]
    df = spark.createDataFrame(rows, "key string, size long")
    got = sorted(r.key for r in ordered.quota_sample(df, "key", "size", quota, "s").collect())
    assert got == sample_by_hand(rows, quota, "s")


def test_quota_sample_with_too_little_data_returns_all(spark):
    df = spark.createDataFrame([("a", 1), ("b", None)], "key string, size long")
    assert ordered.quota_sample(df, "key", "size", 100).count() == 2


def test_quota_sample_of_copies(spark):
    # All rows share one hash bucket; the sample ends within the copies.
    df = spark.range(5000).select(F.lit("same").alias("key"), F.lit(2).alias("size"))
    assert ordered.quota_sample(df, "key", "size", 1000).count() == 501


def test_shuffle_repeats_with_the_seed(spark):
    df = spark.range(200).select(F.col("id").cast("string").alias("key"))
    one, two = (ordered.shuffle_order(df, "key", "a").orderBy("position").collect() for _ in range(2))
    other = ordered.shuffle_order(df, "key", "b").orderBy("position").collect()
    assert one == two and one != other
    assert sorted(r.key for r in other) == sorted(r.key for r in one)
    assert [r.position for r in one] == list(range(1, 201))


def runs_by_hand(rows):
    runs, last = [], object()
    for key, name in sorted(rows):
        if name != last:
            runs.append([])
        runs[-1].append(key)
        last = name
    return runs


@pytest.mark.parametrize("alphabet", ["a", "abcdefgh"])
def test_runs_reach_over_slices(spark, alphabet):
    rng = random.Random(len(alphabet))
    rows, name = [], alphabet[0]
    for key in range(4000):
        # Long runs: several slices hold no start of a run at all.
        if rng.random() < 0.002:
            name = rng.choice(alphabet)
        rows.append((key, name))
    df = spark.createDataFrame(rows, "key long, name string").repartition(5)
    keep = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = ordered.consecutive_runs(df, ["key"], ["name"]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", keep)
    found = {}
    for row in sorted(got, key=lambda r: r.key):
        assert row.run_place == len(found.setdefault(row.run, []))
        found[row.run].append(row.key)
    assert list(found.values()) == runs_by_hand(rows)


def test_null_ids_form_runs_of_their_own(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a"), (4, None)], "k int, name string")
    got = {r.k: (r.run, r.run_place) for r in ordered.consecutive_runs(df, ["k"], ["name"]).collect()}
    assert got == {1: (0, 0), 2: (0, 1), 3: (2, 0), 4: (3, 0)}


def test_collated_lines(spark):
    rows = [("1", "A"), ("2", "A"), ("3", ""), ("4", "A"), ("5", "B"), ("6", None), ("7", "B")]
    runs = objects.collate_runs(spark.createDataFrame(rows, "url string, id string"), ["url"], "id")
    lines = sorted(r.line for r in objects.collate_lines(runs, "id", "url").collect())
    # No empty first line, the last group is there, an empty id breaks a run.
    assert lines == ["A,1,2", "A,4", "B,5", "B,7"]


def test_long_runs_continue_on_further_lines(spark):
    df = spark.range(25).select(F.format_string("%02d", "id").alias("url"), F.lit("A").alias("id"))
    lines = objects.collate_lines(objects.collate_runs(df, ["url"], "id"), "id", "url", per_line=10)
    urls = [r.line.split(",") for r in lines.orderBy("line").collect()]
    assert [u[0] for u in urls] == ["A"] * 3 and [len(u) - 1 for u in urls] == [10, 10, 5]
    assert sum((u[1:] for u in urls), []) == [f"{i:02d}" for i in range(25)]
