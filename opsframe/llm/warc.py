"""WARC archives: a deterministic sharded writer, and a reader of what it committed.

Records are range-sorted by key into shards.  The bounds of the shards are quantiles of the keys with the smallest
hashes, so the same table gives the same shards however it is partitioned.  A shard's task streams its records in
order, one gzip member each, and begins a new file when the compressed size is reached.  Files are written under
temporary names; only those that the stored manifest lists are moved to their own names, so tasks that run twice
or are lost leave nothing behind that a reader would see.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsframe.llm.sorted_counts import open_folder
from opsframe.storage import cut_lineage

#: Keys looked at for each shard when its bounds are chosen.
KEYS_PER_SHARD = 16
#: Records that a reader passes on at once.
READ_ROWS = 500
_DATE = "2024-01-01T00:00:00Z"
_MANIFEST = "shard int, file string, temporary string, n_records bigint, n_bytes bigint, sha256 string"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(key: int | None, digest: str) -> str:
    return f"<urn:x-record:{'' if key is None else key}:{digest}>"


def _safe(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")


def format_record(key: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record, with headers and digests made anew from its payload; a revisit carries no payload."""
    digest = payload_digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(key, digest)}",
        f"WARC-Target-URI: {_safe(url)}",
        f"WARC-Date: {_DATE}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{payload_digest(block)}",
    ]
    if refers_to is not None:
        head.append(f"WARC-Refers-To: {record_id(refers_to, digest)}")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an uncompressed archive."""
    while line := stream.readline():
        if line.strip() != b"WARC/1.1":
            raise ValueError(f"no record begins with {line[:40]!r}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            headers[name] = value
        block = stream.read(int(headers["Content-Length"]))
        if len(block) != int(headers["Content-Length"]) or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"{headers['WARC-Record-ID']} is cut off")
        yield headers, block


class _Files:
    """The files of one shard, each begun when the last one is full."""

    def __init__(self, uri: str, shard: int, roll_bytes: int):
        self.store, self.folder = open_folder(uri)
        self.shard, self.roll_bytes, self.attempt = shard, roll_bytes, uuid.uuid4().hex
        self.done: list[tuple] = []
        self.out = None

    def add(self, record: bytes) -> None:
        if self.out is None:
            self.temporary = f"_temporary/{self.attempt}-{len(self.done):05d}"
            self.store.create_dir(f"{self.folder}/_temporary")
            self.out = self.store.open_output_stream(f"{self.folder}/{self.temporary}", compression=None)
            self.records, self.bytes, self.sha = 0, 0, hashlib.sha256()
        gz = zlib.compressobj(6, zlib.DEFLATED, 31)
        member = gz.compress(record) + gz.flush()
        self.out.write(member)
        self.sha.update(member)
        self.records += 1
        self.bytes += len(member)
        if self.bytes >= self.roll_bytes:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            name = f"part-{self.shard:06d}-{len(self.done):05d}.warc.gz"
            self.done.append((self.shard, name, self.temporary, self.records, self.bytes, self.sha.hexdigest()))
            self.out = None


def _with_shards(rows: DataFrame, bounds: list[float]) -> DataFrame:
    """``shard`` of each row: how many bounds are not above its key; rows without key come first."""
    if not bounds:
        return rows.withColumn("shard", F.lit(0))
    floor = float("-inf")
    at = rows.withColumn("_at", F.coalesce(F.col("key").cast("double"), F.lit(floor)))
    cut = Bucketizer(splits=[floor, *bounds, float("inf")], inputCol="_at", outputCol="_shard").transform(at)
    return cut.withColumn("shard", F.col("_shard").cast("int")).drop("_at", "_shard")


def _bounds(keys: DataFrame, shards: int) -> list[float]:
    if shards < 2:
        return []
    hashed = F.xxhash64("key")
    sample = keys.filter(F.col("key").isNotNull()).orderBy(hashed, "key").limit(KEYS_PER_SHARD * shards)
    found = sorted(float(k) for k in sample.select("key").toPandas()["key"])
    return sorted({found[len(found) * i // shards] for i in range(1, shards)}) if found else []


def write_warc(
    pages: DataFrame,
    uri: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_revisit_bytes: int = 0,
    shard_bytes: int = 64 << 20,
    roll_bytes: int = 1 << 30,
) -> DataFrame:
    """Writes a record per row below ``uri`` and returns the manifest, which is stored there as well.

    ``key`` is a whole number.  Of rows with equal payloads of ``min_revisit_bytes`` or more, those with the smallest
    key are responses and the others revisits of it; smaller payloads are all responses.  Null payloads are empty;
    rows without key come first and revisit a row with key if there is one.  Repeated rows are written as
    often as they occur.  ``shard_bytes`` of payload go to a shard, so choose it to suit the corpus: the driver
    holds ``KEYS_PER_SHARD`` keys for each shard.  An empty table gives an empty manifest.
    """
    spark = pages.sparkSession
    body = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), body.alias("body"))
    digests = cut_lineage(rows.select("key", F.octet_length("body").alias("size"), F.sha1("body").alias("digest")), "digests")
    total = digests.agg(F.sum("size")).first()[0] or 0
    bounds = _bounds(digests, -(-total // shard_bytes))

    large = digests.filter(F.col("size") >= min_revisit_bytes)
    repeated = large.groupBy("digest").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("copies"))
    repeated = cut_lineage(repeated.filter((F.col("copies") > 1) & F.col("first").isNotNull()), "repeated-payloads")
    revisits = large.join(repeated, "digest").filter(~F.col("key").eqNullSafe(F.col("first"))).select("key", "digest", "first")

    # Which records are revisits travels with the records, ahead of each.
    marks = revisits.distinct().select("key", "digest", "first", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("body"))
    records = rows.select("key", F.sha1("body").alias("digest"), F.lit(None).cast("long").alias("first"), "url", "body")
    both = _with_shards(marks.union(records), bounds)
    # A copy of each row's order decides between rows of one key.
    order = ["key", "digest", F.col("first").isNull(), "url"]
    sorted_rows = both.repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions("shard", *order)

    def write(batches):
        files, marked = None, None
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("shard", "key", "digest", "first", "url"))
            for shard, key, digest, first, url, body in zip(*columns, batch.column("body")):
                if first is not None:
                    marked = (key, digest, first)
                    continue
                if files is None:
                    files = _Files(uri, shard, roll_bytes)
                if files.shard != shard:
                    raise ValueError("two shards in one task")
                refers_to = marked[2] if marked and marked[:2] == (key, digest) else None
                files.add(format_record(key, url, body.as_py(), refers_to))
        if files is not None:
            files.close()
            schema = pa.schema([("shard", pa.int32()), ("file", pa.string()), ("temporary", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64()), ("sha256", pa.string())])
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*files.done), schema.types)], schema)

    written = cut_lineage(sorted_rows.select("shard", "key", "digest", "first", "url", "body").mapInArrow(write, _MANIFEST), "warc-files")

    def commit(batches):
        store, folder = open_folder(uri)
        for batch in batches:
            for row in batch.to_pylist():
                final = f"{folder}/{row['file']}"
                if store.get_file_info(f"{folder}/{row['temporary']}").type == pafs.FileType.File:
                    store.move(f"{folder}/{row['temporary']}", final)
                if store.get_file_info(final).size != row["n_bytes"]:
                    raise ValueError(f"{final} is not as it was written")
            yield batch

    manifest = written.mapInArrow(commit, _MANIFEST).drop("temporary")
    manifest.write.mode("overwrite").parquet(f"{uri}/manifest")
    store, folder = open_folder(uri)
    if store.get_file_info(f"{folder}/_temporary").type == pafs.FileType.Directory:
        store.delete_dir(f"{folder}/_temporary")
    return spark.read.parquet(f"{uri}/manifest")


def read_warc(manifest: DataFrame, uri: str, with_payload: bool = False) -> DataFrame:
    """The records of the files that a manifest lists, each file read as a stream.

    ``key, url, record_type, refers_to, payload_bytes, payload_digest`` and, on request, ``payload``, which is null
    for revisits.  A payload that does not match its digest is an error.
    """
    shards = (manifest.agg(F.max("shard")).first()[0] or 0) + 1
    fields = [("key", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
    arrow = pa.schema(fields + ([("payload", pa.binary())] if with_payload else []))
    schema = "key bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string"

    def number(name: str | None) -> int | None:
        text = name.split(":")[2] if name else ""
        return int(text) if text else None

    def rows(headers: dict[str, str], block: bytes) -> tuple:
        http, _, payload = block.partition(b"\r\n\r\n")
        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
        response = headers["WARC-Type"] == "response"
        if response and payload_digest(payload) != digest:
            raise ValueError(f"{headers['WARC-Record-ID']} has another payload")
        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
        key, first = number(headers["WARC-Record-ID"]), number(headers.get("WARC-Refers-To"))
        found = (key, headers["WARC-Target-URI"], headers["WARC-Type"], first, size, digest)
        return found + ((payload if response else None,) if with_payload else ())

    def read(batches):
        store, folder = open_folder(uri)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                held = []
                with store.open_input_stream(f"{folder}/{name}", compression=None) as source, gzip.GzipFile(fileobj=source) as plain:
                    for headers, block in parse_records(io.BufferedReader(plain, 1 << 18)):
                        held.append(rows(headers, block))
                        if len(held) == READ_ROWS:
                            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), arrow.types)], arrow)
                            held = []
                if held:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), arrow.types)], arrow)

    files = manifest.select("file", "shard").repartitionById(shards, F.col("shard")).select("file")
    return files.mapInArrow(read, schema + (", payload binary" if with_payload else ""))

