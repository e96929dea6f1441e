"""WARC archives: round trip, revisits, equal files from any partitioning, recovery of a commit."""

import base64
import gzip
import hashlib
import io
import random

import pytest

from opsframe.llm import warc
from opsframe.storage import scratch_path


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload.encode()).digest()).decode()


def pages(n=60):
    rng = random.Random(3)
    rows = [(i, f"http://x/{i}?a b", "".join(rng.choice("abc é\n") for _ in range(rng.randrange(300)))) for i in range(n)]
    rows += [(n, None, None), (n + 1, "http://y\r\nX: 1", ""), (n + 2, "u", rows[4][2]), (n + 3, "u", rows[4][2])]
    return [*rows, (None, "nameless", rows[4][2]), (None, "alone", "only here"), rows[9], rows[9]]


SCHEMA = "page_id long, url string, html string"


@pytest.mark.parametrize("least", [0, 10, 10_000])
def test_round_trip(spark, least):
    rows = pages()
    uri = scratch_path(spark, "warc-test")
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", key int, digest string")
    manifest = warc.write_warc(frame, uri, min_revisit_bytes=least, shard_bytes=3000, roll_bytes=900)
    assert manifest.count() > 5
    got = warc.read_warc(manifest, uri, with_payload=True).collect()
    first = {}
    for i, _, text in rows:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    want = []
    for i, _, text in rows:
        body = text or ""
        of = first.get(body)
        again = of is not None and i != of and len(body.encode()) >= least
        want.append((i, len(body.encode()), digest(body), "revisit" if again else "response", of if again else None, None if again else body.encode()))
    found = [(r.key, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in got]
    assert sorted(found, key=str) == sorted(want, key=str)


def test_same_files_from_any_partitioning(spark):
    frame = spark.createDataFrame(pages(), SCHEMA)
    kinds = []
    for n in (1, 5):
        manifest = warc.write_warc(frame.repartition(n), scratch_path(spark, "warc-test"), shard_bytes=3000, roll_bytes=900)
        kinds.append(sorted((r.file, r.n_records, r.n_bytes, r.sha256) for r in manifest.collect()))
    assert kinds[0] == kinds[1]


def test_no_rows(spark):
    uri = scratch_path(spark, "warc-test")
    manifest = warc.write_warc(spark.createDataFrame([], SCHEMA), uri)
    assert manifest.count() == 0
    assert warc.read_warc(manifest, uri).count() == 0


def test_records_are_members_of_their_own():
    record = warc.format_record(7, "http://x/\r\ny", b"hello", None)
    both = gzip.compress(record) + gzip.compress(warc.format_record(8, "u", b"hello", 7))
    (one, block), (two, empty) = warc.parse_records(io.BytesIO(gzip.decompress(both)))
    assert one["WARC-Target-URI"] == "http://x/%0D%0Ay" and block.endswith(b"\r\n\r\nhello")
    assert two["WARC-Refers-To"] == one["WARC-Record-ID"] and empty.endswith(b"\r\n\r\n")
    with pytest.raises(ValueError, match="cut off"):
        list(warc.parse_records(io.BytesIO(record[:-3])))
