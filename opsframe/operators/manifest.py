"""Sample manifests: lines, derived columns, per-sample work."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Layout text, missing project, output folder, folder of the run archives and their ending.
PAIRED = "PAIRED"
MISSING_PROJECT = "nan"
UNASSIGNED = "unassigned"
ARCHIVES = "ftp://ftp-trace.ncbi.nih.gov/sra/sra-instant/reads/ByRun/sra"
ARCHIVE_SUFFIX = ".sra"
# Characters that count as white space at the ends of a manifest line.
BLANKS = " \t\n\r\x0b\x0c"


def manifest_rows(lines: DataFrame, line: str = "line") -> DataFrame:
    """Run, project and layout of each sample line.

    Blank lines and lines that start with ``#`` are dropped; a ``#`` after
    leading blanks is data.  Fields are divided by tabs.
    """
    text = F.btrim(F.col(line), F.lit(BLANKS))
    fields = F.split(text, "\t")
    return lines.filter((text != "") & ~F.col(line).startswith("#")).select(
        F.get(fields, F.lit(0)).alias("run"),
        F.get(fields, F.lit(1)).alias("project"),
        F.get(fields, F.lit(2)).alias("layout"),
    )


def manifest_derive(samples: DataFrame, output_dir: str = "") -> DataFrame:
    """Adds ``paired``, the output directory and the download URL of each run.

    A missing project is written ``nan`` in manifests; it becomes NULL and its
    runs go below ``experiments/unassigned``.
    """
    project = F.when(F.col("project") != MISSING_PROJECT, F.col("project"))
    folder = F.concat(F.lit(output_dir + "experiments/"), F.coalesce(project, F.lit(UNASSIGNED)))
    run = F.col("run")
    # Archives lie in folders named by the first three, six and ten characters of the run.
    folders = [F.substring(run, 1, n) for n in (3, 6, 10)]
    url = F.concat(F.concat_ws("/", F.lit(ARCHIVES), *folders, run), F.lit(ARCHIVE_SUFFIX))
    return samples.select(
        "run",
        project.alias("project"),
        "layout",
        F.coalesce(F.col("layout") == PAIRED, F.lit(False)).alias("paired"),
        folder.alias("output_dir"),
        url.alias("url"),
    )


def map_samples(
    samples: DataFrame,
    func: Callable[..., pd.DataFrame],
    schema: T.StructType | str,
    *args: object,
    partitions: int | None = None,
) -> DataFrame:
    """Applies ``func(batch, *args)`` to batches of samples, as many at a time as there are task slots.

    ``func`` gets a pandas frame with one row per sample.  Batches are limited
    by ``spark.sql.execution.arrow.maxRecordsPerBatch``; a project with many
    samples is spread like any other rows; a task lets go of each batch before
    long.  ``partitions`` spreads few samples with long work over more tasks.
    """
    spread = samples.repartition(partitions) if partitions else samples

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = func(batch, *args)
            del batch
            yield done
            del done
            # Accessors such as .str tie a column to itself; a batch has too few objects to make Python look for that.
            gc.collect()

    return spread.mapInPandas(run, schema)


def map_projects(
    samples: DataFrame,
    func: Callable[..., Iterator[pa.RecordBatch]],
    schema: T.StructType | str,
    *args: object,
    by: str = "project",
    parts: int = 1,
    spread: Sequence[str] = (),
) -> DataFrame:
    """Applies ``func(project, batches, *args)`` to the samples of each project; it yields Arrow batches.

    With ``parts`` above 1, a project is dealt over that many calls by a hash of
    the columns ``spread``, so that a project with many samples takes several
    tasks; the results of its parts are for the caller to merge.

    ``batches`` is read once, in Arrow batches of at most
    ``spark.sql.execution.arrow.maxRecordsPerBatch`` samples and in no set order,
    so a task holds one batch of a project, however many samples that has.  A
    missing project is a project of its own.
    """

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from func(key[0].as_py(), batches, *args)

    if parts == 1:
        return samples.groupBy(by).applyInArrow(run, schema)
    if not spread:
        raise ValueError("name the columns that deal a project over its parts")
    part = F.pmod(F.xxhash64(*spread), F.lit(parts))
    return samples.groupBy(by, part).applyInArrow(run, schema)


@F.pandas_udf(T.DoubleType())
def multiply(x: pd.Series, y: pd.Series) -> pd.Series:
    """Product of two columns, on Arrow batches."""
    return x * y
