"""Metric files that are appended to: ``<metric>.<append>-<part>.tsv``, which ``read_metric_files`` reads."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsframe.sinks.text import TIME_TEXT


def file_stem(metric: Column) -> Column:
    """A metric as the part of a file name up to its first dot: percent escapes for all but letters, digits, ``_`` and ``-``.

    Files whose names begin with a mark are hidden to readers, so that is escaped as well.
    """
    escaped = F.url_encode(metric)
    for plain, code in (("+", "%20"), (".", "%2E"), ("*", "%2A")):
        escaped = F.replace(escaped, F.lit(plain), F.lit(code))
    return F.regexp_replace(escaped, "^_", "%5F")


def append_metric_files(points: DataFrame, path: str, append_id: str | None = None) -> None:
    """Appends ``id, value, ts`` to the files of each metric, sorted by time.

    Rows are written below a hidden folder first, where Spark commits only what successful tasks wrote, and its files then
    get their names.  ``append_id`` names the append: one that was interrupted may run again and replaces what it
    left, and one that is complete is not repeated.  A file belongs to one metric; a metric that holds most of
    the points has several.  Rows without a metric fail the append; without rows nothing is added.
    """
    spark, append_id = points.sparkSession, append_id or uuid.uuid4().hex
    if not append_id.replace("-", "").replace("_", "").isalnum():
        raise ValueError(f"an append is named by letters, digits, - and _: {append_id}")
    path = path.rstrip("/")
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    store = jvm_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    done, staging = jvm_path(f"{path}/_append-{append_id}.done"), f"{path}/_append-{append_id}"
    if store.exists(done):
        return
    none = F.raise_error(F.lit("a point without a metric belongs to no file")).cast("string")
    named = F.when(F.coalesce("metric", F.lit("")) != "", file_stem(F.col("metric"))).otherwise(none)
    rows = points.select("id", "value", F.date_format("ts", TIME_TEXT).alias("ts"), named.alias("_stem"))
    (
        rows.repartitionByRange("_stem", "ts", "id")
        .sortWithinPartitions("_stem", "ts", "id")
        .write.partitionBy("_stem")
        .mode("overwrite")
        .option("sep", "\t")
        .csv(staging)
    )
    for left in store.globStatus(jvm_path(f"{path}/*.{append_id}-*.tsv")) or []:
        store.delete(left.getPath(), False)
    for file in store.globStatus(jvm_path(f"{staging}/_stem=*/part-*")) or []:  # a few for each metric
        name = file.getPath().getName().split("-")
        stem = spark._jvm.java.net.URLDecoder.decode(file.getPath().getParent().getName().removeprefix("_stem="), "UTF-8")
        target = f"{stem}.{append_id}-{name[1]}-{name[-1].split('.')[-2]}.tsv"
        if not store.rename(file.getPath(), jvm_path(jvm_path(path), target)):
            raise OSError(f"{file.getPath()} could not be named {target}")
    store.create(done).close()
    store.delete(jvm_path(staging), True)
