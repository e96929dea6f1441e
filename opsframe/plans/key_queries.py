"""Keys and URLs over the pages table."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from opsframe.functions import keys, paths
from opsframe.plans import tables as t
from opsframe.plans.registry import query

# A constant for checks; not a secret.
CHECK_MASTER = "0123456789abcdef0123456789abcdef"


def master(spark: SparkSession) -> Column:
    return keys.master_key(spark.createDataFrame([(CHECK_MASTER,)], "key string"))


DERIVED = f"derived AS (SELECT page_id, url, unhex(sha256('{CHECK_MASTER}' || url)) AS key FROM pages)"


@query(f"WITH {DERIVED} SELECT page_id, lower(hex(key)) AS key, octet_length(key)::INTEGER AS n_bytes FROM derived")
def key_derive(spark, sf_dir):
    derived = t.urls(spark, sf_dir).select("page_id", keys.derive_key(master(spark), F.col("url")).alias("key"))
    return derived.select("page_id", F.lower(F.hex("key")).alias("key"), F.octet_length("key").alias("n_bytes"))


@query(f"""
SELECT page_id, sha256('{CHECK_MASTER}' || 's3://' || regexp_extract(url, '^[a-z]+://(.*)$', 1)) AS key FROM pages
""")
def key_derive_s3(spark, sf_dir):
    s3_url = F.concat(F.lit("s3://"), F.regexp_extract("url", r"^[a-z]+://(.*)$", 1))
    derived = t.urls(spark, sf_dir).select("page_id", keys.derive_key_for_s3(master(spark), s3_url).alias("key"))
    return derived.select("page_id", F.lower(F.hex("key")).alias("key"))


@query(f"""
WITH {DERIVED}
SELECT page_id, 'AES256' AS algorithm, to_base64(key) AS key, to_base64(unhex(md5(key))) AS key_md5 FROM derived
""")
def key_headers(spark, sf_dir):
    headers = keys.key_headers(keys.derive_key(master(spark), F.col("url")))
    return t.urls(spark, sf_dir).select("page_id", headers.alias("h")).select(
        "page_id",
        F.col("h")[keys.HEADER_PREFIX + "algorithm"].alias("algorithm"),
        F.col("h")[keys.HEADER_PREFIX + "key"].alias("key"),
        F.col("h")[keys.HEADER_PREFIX + "key-md5"].alias("key_md5"),
    )


PARTS = r"""
parts AS (
  SELECT page_id, url, lower(regexp_extract(url, '^([a-zA-Z]+):', 1)) AS scheme,
         regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1) AS host,
         regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1) AS path
  FROM pages)
"""


@query(f"WITH {PARTS} SELECT page_id, scheme, host, path, ltrim(path, '/') AS key FROM parts")
def url_parts(spark, sf_dir):
    url = paths.require_host(paths.require_scheme(F.col("url"), "http", "https"))
    checked = t.urls(spark, sf_dir).select("page_id", url.alias("url"))
    u = F.col("url")
    return checked.select(
        "page_id",
        paths.url_scheme(u).alias("scheme"),
        paths.url_host(u).alias("host"),
        paths.url_path(u).alias("path"),
        paths.url_key(u).alias("key"),
    )


@query(f"""
WITH {PARTS}
SELECT page_id,
       CASE WHEN scheme = 'https' THEN 'https://s3-us-west-2.amazonaws.com/' ELSE 'https://s3.amazonaws.com/' END || host ||
       '/' || CASE WHEN contains(host, 'blog') THEN 'posts/' ELSE '' END || ltrim(path, '/') AS object_url
FROM parts
""")
def object_url(spark, sf_dir):
    url = F.col("url")
    location = F.when(paths.url_scheme(url) == "https", paths.DEFAULT_LOCATION)
    directory = F.when(paths.url_host(url).contains("blog"), "posts/")
    built = paths.object_url(paths.url_host(url), paths.url_key(url), location, directory)
    return t.urls(spark, sf_dir).select("page_id", built.alias("object_url"))


@query(r"""
WITH named AS (SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS base FROM pages)
SELECT page_id, base, split_part(base, '.', 1) AS stem, split_part(base, '.html', 1) AS before_html FROM named
""")
def basename_id(spark, sf_dir):
    url = F.col("url")
    return t.urls(spark, sf_dir).select(
        "page_id", paths.basename(url).alias("base"), paths.stem(url).alias("stem"),
        paths.stem_before(url, ".html").alias("before_html"),
    )


@query("SELECT page_id, rtrim(url, '.html') AS stripped FROM pages")
def rstrip_charset(spark, sf_dir):
    return t.urls(spark, sf_dir).select("page_id", paths.rstrip_charset(F.col("url"), ".html").alias("stripped"))


@query("""
SELECT page_id, CASE WHEN contains(url, '.com/') THEN split_part(url, '.com/', 2) END AS rest FROM pages
""")
def after_host(spark, sf_dir):
    return t.urls(spark, sf_dir).select("page_id", paths.after_host(F.col("url")).alias("rest"))
