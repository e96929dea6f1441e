"""Manifests, line records, and the files they come from and go to."""

import glob
import gzip
import os
import weakref
from datetime import date, datetime

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from opsframe.operators import manifest, records
from opsframe.sinks import text as sink
from opsframe.sources import lines as numbered
from opsframe.sources import listings, manifests, metrics


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return str(path)


def found(df, *columns):
    return sorted(tuple(r) if len(r) > 1 else r[0] for r in df.select(*(columns or df.columns)).collect())


def lines_of(spark, text, file="f"):
    return records.text_lines(spark.createDataFrame([(file, text)], "file string, text string"), "file", "text")


# Manifests

MANIFEST = (
    "# comment\n"
    "QRX7000012\tPROJ1\tSINGLE\n"
    "\n"
    " \t \n"
    "  QRX700345\tPROJ2\tPAIRED \n"
    " # not a comment\n"
    "ERR1\tnan\tPAIRED\r\n"
)


def test_manifest(spark, tmp_path):
    rows = manifests.read_manifest(spark, put(f"{tmp_path}/m.tsv", MANIFEST))
    assert sorted((r.run, r.project, r.layout) for r in rows.collect() if r.project) == [
        ("ERR1", "nan", "PAIRED"), ("QRX7000012", "PROJ1", "SINGLE"), ("QRX700345", "PROJ2", "PAIRED"),
    ]
    # A comment sign after blanks is data, as is a line with too few fields.
    assert [r.run for r in rows.filter("project is null").collect()] == ["# not a comment"]


def test_derived_columns(spark, tmp_path):
    rows = manifests.read_manifest(spark, put(f"{tmp_path}/m.tsv", MANIFEST)).filter("project is not null")
    derived = {r.run: r for r in manifest.manifest_derive(rows, "out/").collect()}
    base = "ftp://ftp-trace.ncbi.nih.gov/sra/sra-instant/reads/ByRun/sra"
    assert derived["QRX7000012"].url == f"{base}/QRX/QRX700/QRX7000012/QRX7000012.sra"
    assert derived["QRX700345"].url == f"{base}/QRX/QRX700/QRX700345/QRX700345.sra"  # nine characters
    assert [derived[r].paired for r in ("QRX7000012", "QRX700345")] == [False, True]
    assert derived["QRX700345"].output_dir == "out/experiments/PROJ2"
    assert (derived["ERR1"].project, derived["ERR1"].output_dir) == (None, "out/experiments/unassigned")


def test_gdc_manifest(spark, tmp_path):
    path = put(f"{tmp_path}/gdc.tsv", "id\tfile\nu1\ta.bam\n\n \t \nu2\tb \"q.bam\n")
    assert found(manifests.read_gdc_manifest(spark, path)) == ["u1", "u2"]


def test_name_pairs_keep_dots(spark, tmp_path):
    path = put(f"{tmp_path}/pairs.tsv", "P\ta.b.c\tu-1\n")
    assert found(manifests.read_name_pairs(spark, path)) == [("P", "a.b.c", "u-1")]


def test_map_samples_passes_arguments(spark):
    def tagged(batch, tag, factor):
        return pd.DataFrame({"run": batch["run"] + tag, "n": batch["n"] * factor})

    samples = spark.createDataFrame([("a", 1), ("b", 2)], "run string, n long")
    done = manifest.map_samples(samples, tagged, "run string, n long", "!", 10, partitions=2)
    assert found(done) == [("a!", 10), ("b!", 20)]


def test_map_samples_lets_go_of_batches(spark):
    def held(batch, frames):
        batch["text"].str.len()  # ties the column to itself
        frames.append(weakref.ref(batch["text"].str))
        return pd.DataFrame({"n": [sum(f() is not None for f in frames)]})

    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "100")
    try:
        samples = spark.range(4000).selectExpr("repeat('x', 10) AS text").coalesce(1)
        found_held = [r.n for r in manifest.map_samples(samples, held, "n long", []).collect()]
    finally:
        spark.conf.set(setting, before)
    assert len(found_held) == 40 and max(found_held) <= 4


def test_projects_come_in_batches(spark):
    # A third of all samples is of one project; none of its batches holds more than the session allows.
    def sizes(project, batches, tag):
        counts = [batch.num_rows for batch in batches]
        names = pa.schema({"project": pa.string(), "n": pa.int64(), "most": pa.int64(), "tag": pa.string()})
        yield pa.RecordBatch.from_pylist([{"project": project, "n": sum(counts), "most": max(counts), "tag": tag}], names)

    project = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 != 0, F.concat(F.lit("p"), F.col("id") % 5))
    samples = spark.range(3000).select(project.alias("project"), "id")
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "100")
    try:
        schema = "project string, n long, most long, tag string"
        done = {r.project: r for r in manifest.map_projects(samples, sizes, schema, "x").collect()}
        dealt = manifest.map_projects(samples, sizes, schema, "x", parts=4, spread=["id"])
        hot = [r.n for r in dealt.collect() if r.project == "hot"]
        assert manifest.map_projects(samples.limit(0), sizes, schema, "x").count() == 0
    finally:
        spark.conf.set(setting, before)
    assert {p: r.n for p, r in done.items()} == {r.project: r["count"] for r in samples.groupBy("project").count().collect()}
    assert done["hot"].n == 1000 and None in done
    assert sum(hot) == 1000 and len(hot) == 4 and max(hot) < 400
    with pytest.raises(ValueError, match="columns"):
        manifest.map_projects(samples, sizes, schema, "x", parts=4)
    assert all(r.most <= 100 and r.tag == "x" for r in done.values())


def test_multiply_equals_the_expression(spark):
    df = spark.createDataFrame([(2.0, 3.0), (0.1, 0.2), (None, 1.0)], "x double, y double")
    pairs = df.select(manifest.multiply("x", "y"), F.col("x") * F.col("y")).collect()
    assert all(a == b or (b is None and (a is None or a != a)) for a, b in pairs)


# Lines


def test_pairs_are_split_and_the_rest_dropped(spark):
    text = "\n".join(f"l{i}" for i in range(8 * 3 + 5))
    mates = records.deinterleave(lines_of(spark, text))
    got = {m: [r.line for r in mates.filter(F.col("mate") == m).orderBy("mate_ordinal").collect()] for m in (1, 2)}
    assert got[1] == [f"l{i}" for i in range(24) if i % 8 < 4]
    assert got[2] == [f"l{i}" for i in range(24) if i % 8 >= 4]
    ordinals = [r.mate_ordinal for r in mates.filter("mate = 2").orderBy("mate_ordinal").collect()]
    assert ordinals == list(range(12))


def test_reads_and_fields(spark):
    got = found(records.fastq_reads(lines_of(spark, "\n".join("abcde"))), "ordinal", "read", "field", "n_lines")
    assert got == [(0, 0, 0, 5), (1, 0, 1, 5), (2, 0, 2, 5), (3, 0, 3, 5), (4, 1, 0, 5)]


def test_counting_lines_does_not_carry_the_text(spark):
    plan = records.deinterleave(lines_of(spark, "a"))._jdf.queryExecution().optimizedPlan().toString()
    above, generate = plan.split("Generate", 1)
    assert "size(split" not in above and "size(split" in generate


def test_head(spark):
    assert found(records.head_lines(lines_of(spark, "a\nb\nc"), 2), "line") == ["a", "b"]


def test_gtf_takes_whole_words(spark):
    text = "chr6\tx\nchr60\tx\nchr6_alt\tx\nxchr6\nchr6"
    assert found(records.chrom_filter_gtf(lines_of(spark, text), "chr6"), "line") == ["chr6", "chr6\tx"]
    assert found(records.chrom_filter_gtf(lines_of(spark, "aXb\na.b"), "a.b"), "line") == ["a.b"]
    with pytest.raises(ValueError):
        records.chrom_filter_gtf(lines_of(spark, text), "chr6.")


def test_vcf_keeps_the_header(spark):
    text = "##h\n#CHROM\tPOS\nchr6\t1\nchr60\t2\nchr6"
    assert found(records.chrom_filter_vcf(lines_of(spark, text), "chr6"), "line") == ["##h", "#CHROM\tPOS", "chr6", "chr6\t1"]


def test_first_rule_rewrites(spark):
    rules = [("aws", "aws:new"), ("--s3_dir", "--s3_dir out"), ("aw", "never")]
    got = records.line_rewrite(lines_of(spark, "aws:old\n--s3_dir old\nother aws"), rules)
    assert [r.line for r in got.orderBy("ordinal").collect()] == ["aws:new", "--s3_dir out", "other aws"]
    assert found(records.line_rewrite(lines_of(spark, "x"), []), "line") == ["x"]


def test_one_file_read_in_many_blocks(spark, tmp_path):
    rows = [f"line {i} " + "x" * (i % 50) for i in range(3000)]
    put(f"{tmp_path}/in/big.txt", "\n".join(rows) + "\n")
    put(f"{tmp_path}/in/small.txt", "a\nb\n")
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        assert spark.read.text(f"{tmp_path}/in").rdd.getNumPartitions() > 4
        lines = numbered.read_lines(spark, f"{tmp_path}/in").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)
    by_file = {}
    for r in sorted(lines, key=lambda r: (r.file, r.ordinal)):
        by_file.setdefault(os.path.basename(r.file), []).append(r)
    assert [r.line for r in by_file["big.txt"]] == rows
    assert [r.ordinal for r in by_file["big.txt"]] == list(range(3000))
    assert [(r.ordinal, r.n_lines, r.line) for r in by_file["small.txt"]] == [(0, 2, "a"), (1, 2, "b")]


def test_gzipped_mates_round_trip(spark, tmp_path):
    text = [f"r{i}" for i in range(8 * 40)]
    path = put(f"{tmp_path}/in/reads.fq", "\n".join(text) + "\n")
    sink.write_mates(records.deinterleave(numbered.read_lines(spark, path)), f"{tmp_path}/out")

    def mate(n):
        parts = sorted(glob.glob(f"{tmp_path}/out/mate={n}/*.gz"))
        return [line for p in parts for line in gzip.open(p, "rt").read().splitlines()]

    assert mate(1) == [t for i, t in enumerate(text) if i % 8 < 4]
    assert mate(2) == [t for i, t in enumerate(text) if i % 8 >= 4]


# Metric files and listings


def test_metric_files_are_found_below_the_root(spark, tmp_path):
    put(f"{tmp_path}/in/CPU.load.tsv", "i1\t0.5\t2016-02-01 00:00:00\ni2\tnan\t2016-02-01T00:05:00\n")
    put(f"{tmp_path}/in/deep/er/Mem+ Use.tsv", "i1\t1e3\t2016-02-01 00:00:00.250000\n")
    put(f"{tmp_path}/in/deep/notes.txt", "no\n")
    got = found(metrics.read_metric_files(spark, f"{tmp_path}/in").fillna(-1.0, ["value"]))
    assert got == [
        ("CPU", "i1", datetime(2016, 2, 1), 0.5),
        ("CPU", "i2", datetime(2016, 2, 1, 0, 5), -1.0),
        ("Mem+ Use", "i1", datetime(2016, 2, 1, 0, 0, 0, 250000), 1000.0),
    ]


def test_metric_folders_append_and_prune(spark, tmp_path):
    points = spark.createDataFrame(
        [("CPU", "i1", datetime(2016, 2, 1, 0, 5), 2.0), ("CPU", "i1", datetime(2016, 2, 1, 0, 0, 0, 5), 1.0),
         ("A/B", "i1", datetime(2016, 2, 1), 3.0)], "metric string, id string, ts timestamp_ntz, value double")
    for _ in range(2):
        sink.append_metric_tsv(points, f"{tmp_path}/out")
    back = metrics.read_metric_table(spark, f"{tmp_path}/out")
    assert found(back) == sorted(found(points.select("metric", "id", "ts", "value")) * 2)
    files = glob.glob(f"{tmp_path}/out/metric=CPU/*.csv")
    assert len(files) == 2
    assert open(files[0]).read() == "i1\t1.0\t2016-02-01 00:00:00.000005\ni1\t2.0\t2016-02-01 00:05:00.000000\n"
    plan = back.filter("metric = 'CPU'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(metric" in plan


def test_listings_read_no_contents(spark, tmp_path):
    put(f"{tmp_path}/root/a.tsv", "12345")
    put(f"{tmp_path}/root/d/root/b.txt", "1")
    listed = listings.read_listing(spark, f"{tmp_path}/root")
    assert found(listed, "key", "size") == [("a.tsv", 5), ("d/root/b.txt", 1)]
    assert found(listings.read_listing(spark, f"{tmp_path}/root", "*.tsv"), "key") == ["a.tsv"]
    assert found(listings.read_listing(spark, f"{tmp_path}/root", recursive=False), "key") == ["a.tsv"]
    assert found(listings.read_tree(spark, f"{tmp_path}/root/"), "path") == ["root/a.tsv", "root/d/root/b.txt"]
    assert "content:binary" not in listed._jdf.queryExecution().executedPlan().toString()


# Other sinks


def text_of(path):
    return "".join(open(p).read() for p in sorted(glob.glob(f"{path}/part-*")))


def test_text_sinks(spark, tmp_path):
    ids = spark.createDataFrame([("b",), ("a",), ("a",)], "id string")
    sink.write_ids(ids, f"{tmp_path}/ids")
    assert sorted(text_of(f"{tmp_path}/ids").split()) == ["a", "b"]
    pairs = spark.createDataFrame([("P", 's"1', "u")], "project string, stem string, uuid string")
    sink.write_name_pairs(pairs, f"{tmp_path}/pairs")
    assert text_of(f"{tmp_path}/pairs") == 'P\ts"1\tu\n'
    lines = spark.createDataFrame([("m", "1,2"), ("m", "3")], "metric string, line string")
    sink.write_ragged(lines, f"{tmp_path}/ragged")
    assert sorted(text_of(f"{tmp_path}/ragged/metric=m").split()) == ["1,2", "3"]
    report = spark.createDataFrame([(2, "B", "2"), (1, "A", "$1")], "place int, label string, value string")
    sink.write_report(report, f"{tmp_path}/report")
    assert text_of(f"{tmp_path}/report") == "A: $1\nB: 2\n"


def test_run_names_and_columns(spark):
    assert sink.run_name("c", "u", "2016-02-23") == "c_u_2016-02-23"
    df = spark.createDataFrame([(datetime(2016, 2, 23, 23, 59),)], "ts timestamp_ntz")
    row = sink.with_run(df, "u", F.col("ts")).first()
    assert (row.run_id, row.run_date) == ("u", date(2016, 2, 23))
