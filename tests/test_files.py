"""Files written and read by many tasks: metric files, lines of runs, listings of trees."""

import glob
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from opsframe.operators import fleet, objects, records
from opsframe.sinks import run_lines
from opsframe.sinks.metric_files import append_metric_files, file_stem
from opsframe.sources import lines, metrics, tree
from opsframe.storage import open_store

POINT = "metric string, id string, ts timestamp_ntz, value double"
AT = datetime(2016, 2, 1)


def found(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


@pytest.fixture
def small_parts(spark):
    """Small partitions stay apart, as large ones would."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


# Metric files


def test_what_is_appended_is_read(spark, tmp_path):
    names = ["CPU", "a.b.c", "x/y z", "50%", "_hidden", ".dot", "plus+star*", "Größe", "%41"]
    rows = [(n, f"i{k}", datetime(2016, 2, 1, 0, k), float(k)) for n in names for k in range(3)] + [("CPU", None, AT, None)]
    points = spark.createDataFrame(rows, POINT)
    path = f"{tmp_path}/run"
    append_metric_files(points, path)
    assert found(metrics.read_metric_files(spark, path), "metric", "id", "ts", "value") == found(points)
    append_metric_files(points.filter("metric = 'CPU'"), path)
    assert metrics.read_metric_files(spark, path).filter("metric = 'CPU'").count() == 8
    files = [os.path.basename(f) for f in glob.glob(f"{path}/[!_]*")]
    assert all(f.endswith(".tsv") for f in files) and sum(f.startswith("CPU.") for f in files) >= 2
    first = sorted(glob.glob(f"{path}/a%2Eb*.tsv"))[0]
    assert open(first).readline() == "i0\t0.0\t2016-02-01 00:00:00.000000\n"


def test_an_append_counts_once(spark, tmp_path):
    points = spark.createDataFrame([("CPU", "i1", AT, 1.0), ("Mem", "i1", AT, 2.0)], POINT)
    path = f"{tmp_path}/run"
    for _ in range(3):
        append_metric_files(points, path, "first")
    assert metrics.read_metric_files(spark, path).count() == 2
    # One that was interrupted while its files got their names: they are replaced.
    os.remove(f"{path}/_append-first.done")
    append_metric_files(points, path, "first")
    append_metric_files(points.limit(0), path, "nothing")
    assert found(metrics.read_metric_files(spark, path), "metric", "value") == [("CPU", 1.0), ("Mem", 2.0)]
    with pytest.raises(ValueError, match="named by"):
        append_metric_files(points, path, "../x")


def test_a_failed_append_leaves_nothing_that_is_read(spark, tmp_path):
    path = f"{tmp_path}/run"
    append_metric_files(spark.createDataFrame([("CPU", "i1", AT, 1.0)], POINT), path)
    for bad in (None, ""):
        with pytest.raises(Exception, match="without a metric"):
            append_metric_files(spark.createDataFrame([("CPU", "i2", AT, 1.0), (bad, "i3", AT, 1.0)], POINT), path)
    assert found(metrics.read_metric_files(spark, path), "id") == [("i1",)]


def test_a_hot_metric_has_several_files(spark, tmp_path, small_parts):
    points = spark.range(20_000).selectExpr(
        "if(id % 3 = 0, 'rare', 'hot') as metric", "string(id) as id", "timestamp_ntz'2016-02-01 00:00:00' as ts", "double(id) as value")
    append_metric_files(points, f"{tmp_path}/run")
    assert len(glob.glob(f"{tmp_path}/run/hot.*.tsv")) > 1
    assert found(metrics.read_metric_files(spark, f"{tmp_path}/run").groupBy("metric").count()) == found(points.groupBy("metric").count())


def test_names_need_no_folder(spark):
    names = spark.createDataFrame([("a/b.c d_e-f",), ("_x",)], "m string").select(file_stem(F.col("m"))).collect()
    assert [r[0] for r in names] == ["a%2Fb%2Ec%20d_e-f", "%5Fx"]


# Lines of runs


def text_of(path):
    return "".join(open(f"{path}/{p['file']}", newline="").read() for p in run_lines.read_manifest(path)["parts"])


def plain_lines(rows):
    out, last = [], None
    for _, name, url in sorted(rows, key=lambda r: r[0]):
        if name and name != last:
            out.append([name])
        if name:
            out[-1].append(url)
        last = name
    return out


def write(spark, rows, path):
    df = spark.createDataFrame(rows, "nr long, id string, url string").repartition(5)
    run_lines.write_run_lines(objects.collate_runs(df, ["nr"], "id"), path)


@pytest.mark.parametrize("block", [1, 7, 4 << 20])
def test_runs_are_lines_whatever_their_length(spark, tmp_path, monkeypatch, small_parts, block):
    names = ["first"] + ["hot"] * 3000 + ["é"] * 2 + [None] * 3 + ["é", "b", "a", "", "a"] + [f"n{i // 3}" for i in range(2000)] + ["hot"] * 4000
    rows = [(i, n, f"https://host/{i}ü") for i, n in enumerate(names)]
    path = f"{tmp_path}/lines"
    write(spark, rows, path)
    want = plain_lines(rows)
    assert text_of(path) == "\n".join(map(",".join, want))
    parts = run_lines.read_manifest(path)["parts"]
    assert len(parts) > 2 and sum(p["id"] == "hot" for p in parts) >= 2  # the hot run lies in several parts
    store, folder = open_store(path)
    monkeypatch.setattr(run_lines, "BLOCK", block)
    got = [tuple(x.values()) for at, p in enumerate(parts) for b in run_lines._parsed(store, f"{folder}/{p['file']}", {**p, "first": at == 0}) for x in b.to_pylist()]
    assert got == [(n, k, line[0], url) for n, line in enumerate(want) for k, url in enumerate(line[1:])]
    assert found(run_lines.read_run_lines(spark, path)) == sorted(got, key=str)


def test_lines_without_rows_and_that_do_not_fit(spark, tmp_path):
    write(spark, [(1, None, "x")], f"{tmp_path}/none")
    assert run_lines.read_run_lines(spark, f"{tmp_path}/none").count() == 0
    write(spark, [(1, "a", None), (2, "a", "x")], f"{tmp_path}/null")
    assert text_of(f"{tmp_path}/null") == "a,,x"
    for bad in ("x,y", "x\ny"):
        with pytest.raises(Exception, match="does not fit a line"):
            write(spark, [(1, "a", bad)], f"{tmp_path}/bad")
        assert not os.path.exists(f"{tmp_path}/bad/manifest.json")


# Trees


def test_trees_are_walked_level_by_level(spark, tmp_path):
    for name, size in (("a.tsv", 5), ("d/b.txt", 1), ("d/e/f/c.tsv", 7), ("d/e/f/g.tsv", 0), ("d/_hidden/x.tsv", 3), (".h.tsv", 3), ("sp ace/ü.tsv", 2)):
        os.makedirs(os.path.dirname(f"{tmp_path}/root/{name}"), exist_ok=True)
        with open(f"{tmp_path}/root/{name}", "w") as out:
            out.write("x" * size)
    os.makedirs(f"{tmp_path}/root/empty/er")
    every = tree.walk_files(spark, f"{tmp_path}/root/")
    assert found(every, "key", "size") == [("a.tsv", 5), ("d/b.txt", 1), ("d/e/f/c.tsv", 7), ("d/e/f/g.tsv", 0), ("sp ace/ü.tsv", 2)]
    assert found(tree.walk_files(spark, f"{tmp_path}/root", "*.txt"), "key") == [("d/b.txt",)]
    assert found(tree.folder_totals(every)) == [("", 1, 5), ("d", 1, 1), ("d/e/f", 2, 7), ("sp ace", 1, 2)]
    assert tree.walk_files(spark, f"{tmp_path}/root/empty").count() == 0
    with pytest.raises(ValueError, match="not an absolute path"):
        open_store("relative/path")


# Aligned series


def test_series_are_aligned_to_all_times(spark):
    rows = [("cpu", "i1", datetime(2016, 2, 1, 0, m), float(m)) for m in (0, 10, 15)] + [("cpu", "i2", datetime(2016, 2, 1, 0, 5), 1.0), ("mem", "i1", datetime(2016, 2, 1, 0, 20), 2.0)]
    got = {(r.metric, r.id): (r["values"], r.present) for r in fleet.aligned_grid(fleet.grid_dedup(spark.createDataFrame(rows, POINT))).collect()}
    assert got == {
        ("cpu", "i1"): ([0.0, None, 10.0, 15.0, None], "10110"),
        ("cpu", "i2"): ([None, 1.0, None, None, None], "01000"),
        ("mem", "i1"): ([None, None, None, None, 2.0], "00001"),
    }
    assert fleet.aligned_grid(fleet.grid_dedup(spark.createDataFrame([], POINT))).count() == 0


# Reads in files


def test_reads_reach_over_blocks_and_files(spark, tmp_path):
    text = [f"line {i} {'x' * (i % 37)}é" for i in range(4000)]
    os.makedirs(f"{tmp_path}/in")
    cuts = [0, 1, 1500, 1503, 4000]
    for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
        with open(f"{tmp_path}/in/part-{n}.txt", "w") as out:
            out.write("".join(f"{x}\n" for x in text[a:b]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        raw = lines.read_lines(spark, f"{tmp_path}/in")
        got = records.fastq_reads(lines.in_sequence(raw).select(F.col("place").alias("ordinal"), "line")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r.ordinal, r.read, r.field, r.line) for r in got) == [(i, i // 4, i % 4, x) for i, x in enumerate(text)]
