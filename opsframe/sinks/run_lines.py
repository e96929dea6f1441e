"""One text line ``id,url1,url2,…`` for each run of rows, of any length, written and read by many tasks.

The text lies in parts.  Rows are range-partitioned by run and place, and a task writes each row behind its divider: a
new line where a run starts, else a comma.  A line may thus begin in one part and end in another; the manifest names
the parts in order and says, for each, which line is open where it begins.  Read one behind the other, the parts
are the text.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.storage import cut_lineage, open_store

MANIFEST = "manifest.json"
#: Bytes of a part that a reader takes at once.
BLOCK = 4 << 20
_PART = "part int, file string, bytes bigint, starts bigint, last_id string, last_place bigint"
_ROW = "line bigint, place bigint, id string, url string"


def write_run_lines(runs: DataFrame, path: str, id_column: str = "id", url: str = "url", run: str = "run", place: str = "run_place") -> None:
    """Writes the rows of ``collate_runs`` as lines below ``path``, in the order of runs and of places within them.

    No task holds a run.  Parts are written under names of their own; the manifest, written last, names those of successful
    tasks alone, and without it there is no text.  Ids and URLs that hold a comma or a line break fail, as a line could
    not be told apart; null URLs are empty.  Without rows the text is empty.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    fits = lambda c: F.when(~text(c).rlike("[,\\n]"), text(c)).otherwise(
        F.raise_error(F.concat(F.lit("does not fit a line: "), text(c))).cast("string")
    )
    rows = cut_lineage(runs.select(fits(id_column).alias("id"), fits(url).alias("url"), F.col(run).alias("run"), F.col(place).alias("place")), "runs")
    first = rows.agg(F.min("run")).first()[0]
    divider = F.when(F.col("place") > 0, ",").when(F.col("run") == first, F.concat("id", F.lit(","))).otherwise(F.concat(F.lit("\n"), "id", F.lit(",")))
    ordered = rows.repartitionByRange("run", "place").sortWithinPartitions("run", "place")
    attempt = uuid.uuid4().hex

    def write(batches) -> Iterator[pa.RecordBatch]:
        store, folder = open_store(path)
        out, size, starts, last = None, 0, 0, None
        number = TaskContext.get().partitionId()
        name = f"part-{number:06d}-{attempt}-{uuid.uuid4().hex}.txt"
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                store.create_dir(folder)
                out = store.open_output_stream(f"{folder}/{name}", compression=None)
            data = "".join(batch.column("text").to_pylist()).encode()
            out.write(data)
            size += len(data)
            places = batch.column("place").to_pylist()
            starts += places.count(0)
            last = batch.column("id")[-1].as_py(), places[-1]
        if out is not None:
            out.close()
            row = number, name, size, starts, *last
            yield pa.record_batch([pa.array([x], f.type) for x, f in zip(row, _schema())], schema=_schema())

    written = ordered.select("id", "place", F.concat(divider, "url").alias("text")).mapInArrow(write, _PART)
    parts, lines, open_id, open_place = [], 0, None, -1
    for row in sorted(written.collect()):  # one row for each task
        parts.append({"file": row.file, "bytes": row.bytes, "lines": lines, "id": open_id, "place": open_place})
        lines, open_id, open_place = lines + row.starts, row.last_id, row.last_place
    store, folder = open_store(path)
    store.create_dir(folder)
    temporary = f"{folder}/.{attempt}"
    with store.open_output_stream(temporary, compression=None) as out:
        out.write(json.dumps({"lines": lines, "parts": parts}).encode())
    store.move(temporary, f"{folder}/{MANIFEST}")


def _schema() -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in _PART.split(", "))])


def read_manifest(path: str) -> dict:
    store, folder = open_store(path)
    with store.open_input_stream(f"{folder}/{MANIFEST}", compression=None) as source:
        return json.loads(source.read())


def read_run_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line, place, id, url``: every URL of the text, with the number of its line and its place there, both from 0.

    Each part is read by one task, in blocks, whatever lines it holds or shares with other parts.
    """
    parts = read_manifest(path)["parts"]
    if not parts:
        return spark.createDataFrame([], _ROW)
    listed = spark.createDataFrame([(json.dumps({**part, "first": at == 0}),) for at, part in enumerate(parts)], "part string")

    def read(batches) -> Iterator[pa.RecordBatch]:
        store, folder = open_store(path)
        for batch in batches:
            for part in map(json.loads, batch.column("part").to_pylist()):
                yield from _parsed(store, f"{folder}/{part['file']}", part)

    return listed.repartition(len(parts)).mapInArrow(read, _ROW)


def _parsed(store, file: str, part: dict) -> Iterator[pa.RecordBatch]:
    """The rows of one part: it begins with a divider, but the first one with the first id."""
    line, place, name, begins = part["lines"] - 1, part["place"], part["id"], part["first"]
    data, ended = b"", False
    with store.open_input_stream(file, compression=None) as source:
        while not ended:
            block = source.read(BLOCK)
            data, ended = data + block, not block
            # Up to the last divider all is whole.
            cut = len(data) if ended else max(data.rfind(b","), data.rfind(b"\n"))
            if cut <= 0:
                continue
            lines, places, names, urls = [], [], [], []
            for nth, some in enumerate(data[:cut].decode().split("\n")):
                head, *found = some.split(",")
                if nth or begins:  # else nothing stands before the first divider
                    line, place, name, begins = line + 1, -1, head, False
                lines += [line] * len(found)
                places += range(place + 1, place + 1 + len(found))
                names += [name] * len(found)
                urls += found
                place += len(found)
            data = data[cut:]
            columns = [pa.array(lines, pa.int64()), pa.array(places, pa.int64()), pa.array(names, pa.string()), pa.array(urls, pa.string())]
            yield pa.record_batch(columns, names=["line", "place", "id", "url"])
