"""Listings, bundles, orphans, chunks and inventories."""

import pytest
from pyspark.sql import functions as F

from opsframe.operators import inventory, objects


def names(spark, *values, column="name"):
    return spark.createDataFrame([(v,) for v in values], f"{column} string")


def found(df, *columns):
    return sorted(tuple(r) if len(r) > 1 else r[0] for r in df.select(*(columns or df.columns)).collect())


def test_prefix_bundle_over_captures_and_exact_does_not(spark):
    files = names(spark, "S1_L001_R1", "S1_L002_R1", "S10_L001_R1", "plain")
    ids = objects.bundle_ids(files)
    assert found(ids) == ["S1", "S10", "plain"]
    assert found(objects.prefix_bundle(ids, files)) == [
        ("S1", "S10_L001_R1"), ("S1", "S1_L001_R1"), ("S1", "S1_L002_R1"), ("S10", "S10_L001_R1"), ("plain", "plain"),
    ]
    assert found(objects.exact_bundle(files).filter("id = 'S1'"), "name") == ["S1_L001_R1", "S1_L002_R1"]


def test_prefix_bundle_agrees_with_startswith(spark):
    # A third of the names share one id.
    files = spark.range(900).select(
        F.concat(F.when(F.col("id") % 3 == 0, "1").otherwise(F.hex("id")), F.lit("_L00"), F.col("id").cast("string")).alias("name"))
    ids = objects.bundle_ids(files)
    plain = ids.join(files, F.expr("startswith(name, id)"))
    bundled = objects.prefix_bundle(ids, files)
    assert found(bundled) == found(plain.select("id", "name"))
    plan = bundled._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_empty_ids_match_every_name(spark):
    assert found(objects.prefix_bundle(names(spark, "", column="id"), names(spark, "a", "b"))) == [("", "a"), ("", "b")]


def test_orphans(spark):
    domains = names(spark, "a--files", "a--jobs", "b--files", "b--jobs", "c--files", "c--files", "other")
    buckets = names(spark, "a--files", "x--files")
    assert found(objects.orphan_names(domains, buckets)) == ["b--files", "c--files"]
    # The partner of c does not exist.
    assert found(objects.orphan_pairs(domains, buckets)) == [
        ("b--files", "b--files"), ("b--files", "b--jobs"), ("c--files", "c--files"),
    ]
    assert found(objects.set_difference(domains, buckets)) == ["a--jobs", "b--files", "b--jobs", "c--files", "other"]


def test_rename_undoes_the_uuid_map(spark):
    files = names(spark, "a.b.fastq.gz", "c.fastq.gz")
    pairs = objects.name_pairs(files, "P", "seed")
    assert found(pairs, "project", "stem") == [("P", "a"), ("P", "c")]
    ids = [r.uuid for r in pairs.collect()]
    assert ids == [r.uuid for r in objects.name_pairs(files, "P", "seed").collect()]
    import uuid

    assert all(uuid.UUID(i).version == 4 and uuid.UUID(i).variant == uuid.RFC_4122 for i in ids)
    twice = objects.rename_join(
        pairs.select(F.concat("uuid", F.lit(".fastq.gz")).alias("name")), pairs.union(pairs))
    assert twice.count() == 2
    renamed = objects.rename_join(pairs.select(F.concat("uuid", F.lit(".fastq.gz")).alias("name")), pairs)
    assert found(renamed, "new_name") == ["a.fastq.gz", "c.fastq.gz"]


def test_skip_existing(spark):
    have = names(spark, "a", "a", "z", column="key")
    assert found(objects.skip_existing(names(spark, "a", "b", "b", column="key"), have)) == ["b", "b"]


def test_tested_dirs(spark):
    changed = names(spark, "src/a/x.py", "src/a/y.py", "src/b/x.py", "doc/a/x.txt", column="path")
    children = spark.createDataFrame([("src/a", "test"), ("src/b", "lib"), ("doc/a", "tests")], "dir string, child string")
    assert found(objects.tested_dirs(changed, children)) == ["src/a"]


def test_chunks_cover_the_object(spark):
    listed = spark.createDataFrame([("zero", 0), ("small", 3), ("exact", 20), ("more", 21)], "key string, size long")
    plan = objects.chunk_plan(listed, 10)
    assert found(plan) == [
        ("exact", 1, 0, 10), ("exact", 2, 10, 10), ("more", 1, 0, 10), ("more", 2, 10, 10), ("more", 3, 20, 1),
        ("small", 1, 0, 3),
    ]
    sums = plan.groupBy("key").agg(F.sum("bytes").alias("size"))
    assert found(sums) == found(listed.filter("size > 0"))


def test_large_chunk_counts_are_exact(spark):
    size = objects.CHUNK_BYTES * 1_000_000 + 1
    listed = spark.createDataFrame([("k", size)], "key string, size long")
    last = objects.chunk_plan(listed).orderBy(F.col("part").desc()).first()
    assert (last.part, last.bytes) == (1_000_001, 1)


def test_chunk_verify(spark):
    plan = spark.createDataFrame([("a", 2), ("b", 2), ("none", 0), ("lost", 1)], "key string, planned int")
    got = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("b", 1), ("b", 1)], "key string, part int")
    assert found(objects.chunk_verify(plan, got)) == [
        ("a", 2, 2, True), ("b", 2, 1, False), ("lost", 1, 0, False), ("none", 0, 0, True),
    ]


def test_parts_outside_the_plan_do_not_count(spark):
    plan = spark.createDataFrame([("a", 3), ("b", 130), ("b", 130), ("none", 0), ("lost", 65)], "key string, planned int")
    got = [("a", 1), ("a", 2), ("a", 99), ("a", 0), ("a", -5), ("a", None), ("other", 1), ("none", 1)]
    got += [("b", i) for i in range(1, 140) if i not in (1, 64, 65, 128, 130)]
    got = spark.createDataFrame(got, "key string, part int")
    assert found(objects.chunk_verify(plan, got)) == [
        ("a", 3, 2, False), ("b", 130, 125, False), ("lost", 65, 0, False), ("none", 0, 0, True),
    ]
    assert found(objects.missing_parts(plan, got)) == [
        ("a", 3), *[("b", i) for i in (1, 64, 65, 128, 130)], *[("lost", i) for i in range(1, 66)],
    ]
    nothing = got.limit(0)
    assert objects.chunk_verify(plan.limit(0), got).count() == objects.missing_parts(plan.limit(0), nothing).count() == 0


def test_parts_of_one_large_object(spark):
    # One key has all parts but every thousandth.
    plan = spark.createDataFrame([("big", 200_000)], "key string, planned long")
    got = spark.range(1, 200_001).filter("id % 1000 != 7").select(F.lit("big").alias("key"), F.col("id").alias("part"))
    assert found(objects.chunk_verify(plan, got.union(got))) == [("big", 200_000, 199_800, False)]
    assert found(objects.missing_parts(plan, got), "part") == list(range(7, 200_000, 1000))


def test_failures_need_all_tries_to_fail(spark):
    log = [("two", False), ("two", False), ("late", False), ("late", False), ("late", True)] + [("bad", False)] * 3
    assert found(objects.failure_list(spark.createDataFrame(log, "key string, ok boolean"))) == ["bad"]


def test_marks_count_in_file_names_only(spark):
    archives = spark.createDataFrame(
        [("a1", ["tpm/keep.txt", "x/norm_tpm.txt", "x/fpkm"]), ("a2", [])], "archive string, members array<string>")
    members = objects.explode_members(archives)
    assert found(objects.drop_marked(members, ["tpm", "fpkm"])) == [("a1", "tpm/keep.txt")]


def test_suffixes(spark):
    df = names(spark, "a.tar.gz", "b/", "c.txt")
    assert found(objects.suffix_filter(df, "name", ".tar.gz", "/")) == ["a.tar.gz", "b/"]
    assert found(objects.suffix_filter(df, "name", "/", keep=False)) == ["a.tar.gz", "c.txt"]


def test_config_lines_drop_directories(spark):
    df = names(spark, "dir/sub/S1.fastq.tar", column="key")
    assert found(objects.config_lines(df, "https://host/bucket/")) == ["S1,https://host/bucket/S1.fastq.tar"]


@pytest.fixture
def reservations(spark):
    instance = "struct<id string, state string, ip string, placement string, tags map<string,string>>"
    return spark.createDataFrame(
        [
            ("r1", [("i1", "running", "10.0.0.1", "za", {"Name": "w", "cluster_name": "c"}),
                    ("i2", "stopped", None, None, {"Name": "w"})]),
            ("r2", []),
            ("r3", [("i3", "running", None, "zb", None)]),
        ],
        f"reservation string, instances array<{instance}>",
    )


def test_inventory(reservations):
    flat = inventory.inventory_flatten(reservations)
    assert found(flat, "reservation", "id") == [("r1", "i1"), ("r1", "i2"), ("r3", "i3")]
    assert found(inventory.running_ids(flat)) == ["i1", "i3"]
    assert found(inventory.not_null_filter(flat, "ip")) == ["10.0.0.1"]
    assert found(inventory.tag_filter(flat, Name="w", cluster_name=None), "id") == ["i1", "i2"]
    assert found(inventory.tag_filter(flat, Name="w", cluster_name="c"), "id") == ["i1"]


def test_optional_filter_skips_empty_arguments(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "x")], "p string, q string")
    assert inventory.optional_filter(df, p=None, q="").count() == 2
    assert inventory.optional_filter(df, p="a", q="x").count() == 1


def test_outer_union_fills_with_null(spark):
    one = spark.createDataFrame([("a", 1)], "id string, x int")
    two = spark.createDataFrame([("b", 2)], "id string, y int")
    assert [tuple(r) for r in inventory.outer_union(one, two).orderBy("id").collect()] == [("a", 1, None), ("b", None, 2)]


def test_first_match(spark):
    df = spark.createDataFrame([("k", "late", 2), ("k", "early", 1)], "key string, v string, o int")
    assert found(inventory.first_match(df, "v", "o", "key")) == [("k", "early")]
    assert found(inventory.first_match(df, "v", "o")) == ["early"]
