"""Column functions for names, URLs, sizes and keys."""

import base64
import hashlib
import os.path
from urllib.parse import urlparse

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from opsframe.functions import keys, paths, sizes

MASTER = "m" * 32


def values(spark, column, rows):
    """The column over rows of one text column ``x``."""
    df = spark.createDataFrame(list(enumerate(rows)), "i int, x string")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


PATHS = ["", "a", "/", "//", "/x", "a/b", "a//b", "a/b/", "/a/b.c.d", "s3://b/k.tar.gz"]


def test_path_parts_agree_with_the_standard_library(spark):
    assert values(spark, paths.dirname(F.col("x")), PATHS) == [os.path.dirname(p) for p in PATHS]
    assert values(spark, paths.basename(F.col("x")), PATHS) == [os.path.basename(p) for p in PATHS]
    assert values(spark, paths.stem(F.col("x")), PATHS) == [os.path.basename(p).split(".")[0] for p in PATHS]
    assert values(spark, paths.stem_before(F.col("x"), ".tar"), PATHS) == [
        os.path.basename(p).split(".tar")[0] for p in PATHS
    ]


URLS = [
    "s3://bucket/dir/key", "https://host:80/p/q?x=1#f", "http://host", "HTTP://Host/P", "/only/path", "s3://bucket//k",
    "https://h/a b|c", "mailto:x@y",
]


def test_url_parts_agree_with_the_standard_library(spark):
    for column, want in (
        (paths.url_scheme, lambda u: u.scheme), (paths.url_host, lambda u: u.netloc), (paths.url_path, lambda u: u.path),
        (paths.url_key, lambda u: u.path.lstrip("/")),
    ):
        assert values(spark, column(F.col("x")), URLS) == [want(urlparse(u)) for u in URLS]


def test_buckets(spark):
    assert values(spark, paths.bucket_of(F.col("x")), ["s3://b/dir/k", "b", "/b"]) == ["b", "b", "b"]


def test_url_guards(spark):
    assert values(spark, paths.require_scheme(F.col("x"), "s3"), ["s3://b/k"]) == ["s3://b/k"]
    with pytest.raises(Exception, match="wrong URL scheme"):
        values(spark, paths.require_scheme(F.col("x"), "s3"), ["http://b/k"])
    with pytest.raises(Exception, match="host and a path"):
        values(spark, paths.require_host(F.col("x")), ["s3:///k"])


def test_strip_is_by_character(spark):
    rows = ["SAMPLETMP.TMP", "a.TMP", "TMP", "x"]
    assert values(spark, paths.rstrip_charset(F.col("x"), ".TMP"), rows) == [r.rstrip(".TMP") for r in rows] == ["SAMPLE", "a", "", "x"]


def test_after_host(spark):
    assert values(spark, paths.after_host(F.col("x")), ["https://h.com/b/k", "h.com/b.com/k", "none"]) == ["b/k", "b", None]


def test_relative_path_is_literal(spark):
    rows = ["/a.b/c/a.b/d", "/aXb/c", "/a.b"]
    assert values(spark, paths.relative_to(F.col("x"), F.lit("/a.b")), rows) == ["c/a.b/d", "/aXb/c", "/a.b"]


def test_object_urls(spark):
    x = F.col("x")
    assert values(spark, paths.object_url(F.lit("b"), x), ["k"]) == ["https://s3.amazonaws.com/b/k"]
    located = paths.object_url(F.lit("b"), x, F.lit("us-west-2"), F.lit("dir/"))
    assert values(spark, located, ["k"]) == ["https://s3-us-west-2.amazonaws.com/b/dir/k"]
    empty = paths.object_url(F.lit("b"), x, F.lit(None).cast("string"), F.lit(""))
    assert values(spark, empty, ["k"]) == ["https://s3.amazonaws.com/b/k"]


def test_disk_requests(spark):
    df = spark.createDataFrame([(0,), (1,), (1024**3,), (1024**3 + 1,), (3 * 1024**3 - 1,)], "size long")
    assert [r[0] for r in df.select(sizes.disk_request(F.col("size"))).collect()] == ["0.0G", "1.0G", "1.0G", "2.0G", "3.0G"]


def master(spark, text=MASTER):
    return keys.master_key(spark.createDataFrame([(text,)], "key string"))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_characters="\x00"), max_size=30), min_size=1, max_size=20))
def test_keys_agree_with_hashlib(spark, urls):
    key = keys.derive_key(master(spark), F.col("x"))
    want = [hashlib.sha256((MASTER + u).encode()).digest() for u in urls]
    assert [bytes(k) for k in values(spark, key, urls)] == want
    headers = values(spark, keys.key_headers(key), urls)
    assert headers == [
        {
            "x-amz-server-side-encryption-customer-algorithm": "AES256",
            "x-amz-server-side-encryption-customer-key": base64.b64encode(k).decode(),
            "x-amz-server-side-encryption-customer-key-md5": base64.b64encode(hashlib.md5(k).digest()).decode(),
        }
        for k in want
    ]


def test_short_master_key_fails(spark):
    with pytest.raises(Exception, match="32 characters, has 31"):
        values(spark, keys.derive_key(master(spark, "m" * 31), F.col("x")), ["u"])


def test_s3_variant_wants_an_s3_url(spark):
    assert values(spark, keys.derive_key_for_s3(master(spark), F.col("x")), ["s3://b/k"])
    with pytest.raises(Exception, match="must be an s3 URL"):
        values(spark, keys.derive_key_for_s3(master(spark), F.col("x")), ["http://b/k"])


def test_master_key_stays_out_of_plans(spark):
    df = spark.range(1).select(keys.derive_key(master(spark), F.lit("u")).alias("key"))
    df.collect()
    assert MASTER not in df._jdf.queryExecution().toString()
