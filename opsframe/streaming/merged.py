"""A stream kept as partial aggregates that merge, without state in the query.

Each micro-batch is reduced to a partial aggregate (a maximum per series, a sum
and a count per period) and written to its own folder, so nothing stays in
memory between batches, silent series cost nothing and no row is ever too late.
Every ``fan_in`` batches their folders are merged to one, every ``fan_in`` of
those again: a row is rewritten once per level, and a reader opens fewer than
``fan_in`` folders of each level, however many batches there have been.

A batch that runs again replaces its folder and the merged ones that end with
it.  What they were made from is removed only with a later batch.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from opsframe.storage import committed_folders, remove_folder
from opsframe.streaming.run import trigger

FAN_IN = 16
Reduce = Callable[[DataFrame], DataFrame]
Span = tuple[int, int]

_NAME = re.compile(r"batches-(\d+)-(\d+)")


def _folder(path: str, span: Span) -> str:
    return f"{path}/batches-{span[0]}-{span[1]}"


def _spans(spark: SparkSession, path: str) -> list[Span]:
    named = (_NAME.fullmatch(name) for name in committed_folders(spark, path))
    return [(int(match[1]), int(match[2])) for match in named if match]


def cover(spans: list[Span]) -> list[Span]:
    """The widest spans that hold every batch once."""
    chosen, done = [], -1
    for first, last in sorted(spans, key=lambda span: (span[0], -span[1])):
        if first > done:
            chosen.append((first, last))
            done = last
    return chosen


def merged_spans(number: int, fan_in: int) -> list[Span]:
    """The spans that end with a batch, narrow ones first."""
    ends, width = [], fan_in
    while (number + 1) % width == 0:
        ends.append((number + 1 - width, number))
        width *= fan_in
    return ends


def merge_batches(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    partial: Reduce,
    merge: Reduce,
    fan_in: int = FAN_IN,
    available_now: bool = False,
) -> StreamingQuery:
    """Writes ``partial`` of every micro-batch below ``path`` and merges the folders as their number grows.

    ``merge`` takes rows of several partial aggregates and returns rows of the
    same columns; it must not depend on their order.  An empty batch leaves an
    empty folder.  Read with ``read_merged``.
    """
    if fan_in < 2:
        raise ValueError(f"fan_in must be at least 2, not {fan_in}")

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        partial(batch).write.mode("overwrite").parquet(_folder(path, (number, number)))
        for span in merged_spans(number, fan_in):
            inner = [s for s in _spans(spark, path) if span[0] <= s[0] and s[1] <= span[1] and s != span]
            parts = _read(spark, path, cover(inner))
            merge(parts).write.mode("overwrite").parquet(_folder(path, span))
        _remove_merged(spark, path, number)

    writer = stream.writeStream.outputMode("append").foreachBatch(write)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger(available_now)).start()


def _remove_merged(spark: SparkSession, path: str, number: int) -> None:
    spans = _spans(spark, path)
    kept = cover(spans)
    for span in spans:
        # A folder that ends with this batch may be written again, from the folders within it.
        within = [k for k in kept if k != span and k[0] <= span[0] and span[1] <= k[1]]
        if within and within[0][1] < number:
            remove_folder(spark, _folder(path, span))


def _read(spark: SparkSession, path: str, spans: list[Span]) -> DataFrame:
    if not spans:
        raise ValueError(f"no batch has been written below {path}")
    return spark.read.parquet(*[_folder(path, span) for span in spans])


def read_merged(spark: SparkSession, path: str, merge: Reduce) -> DataFrame:
    """The aggregate over all batches so far; a result is good until the stream has written two more merges."""
    return merge(_read(spark, path, cover(_spans(spark, path))))
