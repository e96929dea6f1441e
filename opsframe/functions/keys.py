"""Per-object keys, request headers and repeatable ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Key length in characters and the customer key headers.
MASTER_KEY_LENGTH = 32
HEADER_PREFIX = "x-amz-server-side-encryption-customer-"
HEADER_ALGORITHM = "AES256"


def master_key(keys: DataFrame) -> Column:
    """The single master key of a one-row, one-column DataFrame.

    Used as a scalar subquery, so that the key is data and never stands as a
    literal in a plan, a log or an event record.  A key of another length than
    32 characters fails the query.
    """
    column = F.col(keys.columns[0])
    message = F.concat(F.lit("master key must have 32 characters, has "), F.length(column).cast("string"))
    valid = F.when(F.length(column) == MASTER_KEY_LENGTH, column).otherwise(F.raise_error(message).cast("string"))
    return keys.select(valid).scalar()


def derive_key(master: Column, url: Column) -> Column:
    """SHA-256 of master key and URL: 32 bytes."""
    return F.unhex(F.sha2(F.concat(master, url), 256))


def derive_key_for_s3(master: Column, url: Column) -> Column:
    """As ``derive_key``; a URL that does not start with ``s3`` fails the query."""
    message = F.concat(F.lit("URL must be an s3 URL: "), url)
    return derive_key(master, F.when(url.startswith("s3"), url).otherwise(F.raise_error(message).cast("string")))


def key_base64(key: Column) -> Column:
    return F.base64(key)


def key_md5_base64(key: Column) -> Column:
    """Base64 of the raw MD5 digest of the key."""
    return F.base64(F.unhex(F.md5(key)))


def key_headers(key: Column) -> Column:
    """The three customer key headers as a map."""
    return F.create_map(
        F.lit(HEADER_PREFIX + "algorithm"), F.lit(HEADER_ALGORITHM),
        F.lit(HEADER_PREFIX + "key"), key_base64(key),
        F.lit(HEADER_PREFIX + "key-md5"), key_md5_base64(key),
    )


def stable_uuid(name: Column, seed: str) -> Column:
    """Version 4 shaped id that is the same in every run.

    A random id would differ between a task and its retry; the id is taken
    from the MD5 digest of seed and name instead.
    """
    digest = F.md5(F.concat(F.lit(seed), name))
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"),
        F.substring(digest, 9, 4), F.lit("-4"),
        F.substring(digest, 14, 3), F.lit("-"),
        variant, F.substring(digest, 18, 3), F.lit("-"),
        F.substring(digest, 21, 12),
    )
