"""Counts of 64-bit keys: summed in Spark, kept as sorted arrays that workers map into memory.

Tasks count what they read and send, for each shard of the key space, blocks of sorted keys as column-like
binary rows.  A shard's task merges its blocks and writes its two arrays to the shared folder under a temporary name,
which it then replaces by the final one, so a task that runs again leaves the same files.

The number of shards is that of the session's shuffle partitions: it has to grow with the data, as for any shuffle.
"""

from __future__ import annotations

import mmap
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys that a task holds before it sums them and passes them on.
BUFFERED_KEYS = 4 << 20
BLOCKS = "shard int, block binary"


def shards_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder that all executors share, and the folder's path in it."""
    plain = re.sub(r"^s3[an]:", "s3:", uri)
    try:
        return pafs.FileSystem.from_uri(plain)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError) as error:
        raise ValueError(f"spark.checkpoint.dir has to be an absolute path or in a store that pyarrow reads, not {uri}") from error


def write_file(uri: str, name: str, parts: list) -> None:
    """Writes a file under a temporary name and moves it to its own."""
    store, folder = open_folder(uri)
    store.create_dir(folder)
    temporary = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(temporary, compression=None) as out:
        for part in parts:
            out.write(part)
    store.move(temporary, f"{folder}/{name}")


def map_file(uri: str, name: str, dtype) -> np.ndarray:
    """A file of the shared folder as an array that is paged in when used."""
    store, folder = open_folder(uri)
    path = f"{folder}/{name}"
    size = store.get_file_info(path).size
    if not size:
        return np.zeros(0, dtype)
    if isinstance(store, pafs.LocalFileSystem):
        return np.memmap(path, dtype, "r")
    copy = tempfile.TemporaryFile()  # has no name, so nothing stays behind
    with store.open_input_stream(path, compression=None) as source:
        while chunk := source.read(1 << 24):
            copy.write(chunk)
    copy.flush()
    return np.frombuffer(mmap.mmap(copy.fileno(), 0, access=mmap.ACCESS_READ), dtype)


def _narrow(values: np.ndarray) -> bytes:
    """Unsigned numbers in as many bytes as the largest needs; the first byte says how many."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    return bytes([width]) + values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _wide(data: np.ndarray) -> np.ndarray:
    width = int(data[0])
    out = np.zeros(((len(data) - 1) // width, 8), np.uint8)
    out[:, :width] = data[1:].reshape(-1, width)
    return out.reshape(-1).view("<u8")


def pack(columns: list[np.ndarray]) -> bytes:
    """A sorted column, as differences, and further columns of unsigned numbers."""
    coded = [_narrow(np.diff(columns[0], prepend=np.uint64(0))), *map(_narrow, columns[1:])]
    head = np.array([len(coded), *map(len, coded)], "<u8").tobytes()
    return head + b"".join(coded)


def unpack(block: bytes) -> list[np.ndarray]:
    data = np.frombuffer(block, np.uint8)
    count = int(data[:8].view("<u8")[0])
    sizes = data[8 : 8 + 8 * count].view("<u8").astype(np.int64)
    at = 8 + 8 * count
    out = []
    for size in sizes:
        out.append(_wide(data[at : at + size]))
        at += size
    out[0] = np.cumsum(out[0], dtype=np.uint64)
    return out


def summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and their total counts."""
    if not len(keys):
        return keys, np.zeros(0, np.uint64)
    if counts is None:
        ordered = np.sort(keys)
    else:
        order = np.argsort(keys)
        ordered, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    if counts is None:
        return ordered[first], np.diff(first, append=len(ordered)).astype(np.uint64)
    return ordered[first], np.add.reduceat(counts, first)


def shard_bounds(shards: int, bits: int) -> np.ndarray:
    """The first key of each shard of keys of ``bits`` bits."""
    return np.array([-(-(i << bits) // shards) for i in range(shards)], np.uint64)


def blocks(found: Iterator[np.ndarray], shards: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Blocks of the keys found by a task, summed as far as memory allows."""
    bounds = shard_bounds(shards, bits)
    schema = pa.schema([("shard", pa.int32()), ("block", pa.binary())])

    def flush(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys, counts = summed(np.concatenate(held))
        cuts = np.append(np.searchsorted(keys, bounds), len(keys))
        for shard in np.flatnonzero(np.diff(cuts)):
            part = slice(cuts[shard], cuts[shard + 1])
            yield pa.record_batch([pa.array([shard], pa.int32()), pa.array([pack([keys[part], counts[part]])])], schema)

    held, size = [], 0
    for keys in found:
        held.append(keys)
        size += len(keys)
        if size >= BUFFERED_KEYS:
            yield from flush(held)
            held, size = [], 0
    if size:
        yield from flush(held)


def merge_shards(
    counted: DataFrame,
    uri: str,
    schema: str,
    keep: Callable[[np.ndarray, np.ndarray], tuple[list[tuple[str, np.ndarray]], dict]],
) -> DataFrame:
    """Merges the blocks of each shard and writes its arrays; one row of figures per shard.

    ``keep`` gets the distinct keys and their counts, and returns what to write, by kind, and the figures.
    """
    shards = shards_of(counted.sparkSession)
    types = [(f.name, f.dataType.simpleString()) for f in counted.sparkSession.createDataFrame([], schema).schema]
    arrow = pa.schema([(n, {"int": pa.int32(), "bigint": pa.int64()}[t]) for n, t in types])

    def merge(batches):
        keys, counts, shard = [], [], None
        for batch in batches:
            for at, block in zip(batch.column(0).to_pylist(), batch.column(1)):
                if shard not in (None, at):
                    raise ValueError("two shards in one task")
                shard = at
                k, c = unpack(block.as_buffer())
                keys.append(k)
                counts.append(c)
            if sum(map(len, keys[1:])) > BUFFERED_KEYS:
                k, c = summed(np.concatenate(keys), np.concatenate(counts))
                keys, counts = [k], [c]
        if shard is None:
            return
        k, c = summed(np.concatenate(keys), np.concatenate(counts))
        del keys, counts
        files, figures = keep(k, c)
        for kind, values in files:
            write_file(uri, f"{shard:06d}.{kind}", [np.ascontiguousarray(values)])
        row = {"shard": shard} | figures
        yield pa.record_batch([pa.array([row[n]], t) for n, t in zip(arrow.names, arrow.types)], arrow)

    return counted.repartitionById(shards, F.col("shard")).mapInArrow(merge, schema)


class MappedCounts:
    """Sorted arrays of all shards, opened when first needed."""

    def __init__(self, uri: str, shards: int, bits: int, present: list[int], kinds: dict[str, str]):
        self.uri, self.bounds, self.present, self.kinds = uri, shard_bounds(shards, bits), set(present), kinds
        self.opened: dict[int, dict[str, np.ndarray]] = {}

    def shard(self, at: int) -> dict[str, np.ndarray]:
        if at not in self.opened:
            self.opened[at] = {k: map_file(self.uri, f"{at:06d}.{k}", t) for k, t in self.kinds.items()}
        return self.opened[at]

    def ordered(self, keys: np.ndarray, *kinds: str) -> list[np.ndarray]:
        """For keys in order: the values of each kind, 0 where the key is not there."""
        out = [np.zeros(len(keys), np.uint64 if k != "id" else np.int64) for k in kinds]
        cuts = np.append(np.searchsorted(keys, self.bounds), len(keys))
        for at in np.flatnonzero(np.diff(cuts)):
            if int(at) not in self.present:
                continue
            arrays, part = self.shard(int(at)), slice(cuts[at], cuts[at + 1])
            wanted = keys[part]
            where = np.searchsorted(arrays["keys"], wanted)
            where[where == len(arrays["keys"])] = 0
            hit = np.flatnonzero(arrays["keys"][where] == wanted)
            for values, kind in zip(out, kinds):
                values[part][hit] = arrays[kind][where[hit]]
        return out

    def values(self, keys: np.ndarray, *kinds: str) -> list[np.ndarray]:
        """The values of each kind for keys in any order."""
        order = np.argsort(keys)
        found = self.ordered(keys[order], *kinds)
        out = []
        for values in found:
            back = np.empty_like(values)
            back[order] = values
            out.append(back)
        return out
