"""Names, paths and object URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Object URL forms.
DEFAULT_BASE = "https://s3.amazonaws.com"
LOCATION_BASE = "https://s3-{location}.amazonaws.com"
DEFAULT_LOCATION = "us-west-2"


def basename(path: Column) -> Column:
    """Text after the last slash."""
    return F.substring_index(path, "/", -1)


def dirname(path: Column) -> Column:
    """Text before the last slash, empty without one; ``/x`` lies in ``/``.

    Slashes at the end of the directory part are dropped unless it is only
    slashes, so ``a//b`` lies in ``a``.
    """
    head = F.regexp_extract(path, r"(?s)^(.*/)[^/]*$", 1)
    return F.when(F.rtrim(head, F.lit("/")) == "", head).otherwise(F.rtrim(head, F.lit("/")))


def stem(path: Column) -> Column:
    """Basename up to its first dot."""
    return F.substring_index(basename(path), ".", 1)


def stem_before(path: Column, marker: str) -> Column:
    """Basename up to the first occurrence of ``marker``."""
    return F.substring_index(basename(path), marker, 1)


def relative_to(path: Column, root: Column) -> Column:
    """``path`` without the literal prefix ``root`` and its slash; otherwise unchanged."""
    prefix = F.concat(F.rtrim(root, F.lit("/")), F.lit("/"))
    return F.when(path.startswith(prefix), F.substring(path, F.length(prefix) + 1, F.length(path))).otherwise(path)


def after_host(url: Column, marker: str = ".com/") -> Column:
    """Text after the first ``marker`` up to the next one, NULL without a marker."""
    quoted = r"\Q" + marker + r"\E"
    return F.get(F.split(url, quoted), F.lit(1))


def rstrip_charset(text: Column, charset: str) -> Column:
    """Strip every trailing character that occurs in ``charset``.

    This is a character set, not a suffix: with ``.TMP`` the name
    ``SAMPLETMP.TMP`` becomes ``SAMPLE``.
    """
    return F.rtrim(text, F.lit(charset))


def suffix_swap(name: Column, old: str, new: str) -> Column:
    """Replace every ``old`` by ``new``."""
    return F.replace(name, F.lit(old), F.lit(new))


def has_suffix(name: Column, *suffixes: str) -> Column:
    """True if ``name`` ends with one of the suffixes."""
    test = F.lit(False)
    for suffix in suffixes:
        test = test | name.endswith(suffix)
    return test


def url_scheme(url: Column) -> Column:
    """Lower-case scheme, empty without one."""
    return F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))


def url_host(url: Column) -> Column:
    """Network location, empty without one."""
    return F.regexp_extract(url, r"^(?:[^:/?#]+:)?//([^/?#]*)", 1)


def url_path(url: Column) -> Column:
    """Path with its leading slash, without query and fragment."""
    return F.regexp_extract(url, r"^(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*)", 1)


def url_key(url: Column) -> Column:
    """Path without leading slashes."""
    return F.ltrim(url_path(url), F.lit("/"))


def bucket_of(url: Column) -> Column:
    """Bucket of an ``s3`` URL; any other text names the bucket itself."""
    return F.when(url_scheme(url) == "s3", url_host(url)).otherwise(url_key(url))


def require_scheme(url: Column, *schemes: str) -> Column:
    """``url``, or a failure of the query if its scheme is none of ``schemes``."""
    message = F.concat(F.lit("wrong URL scheme: "), url)
    return F.when(url_scheme(url).isin(*schemes), url).otherwise(F.raise_error(message).cast("string"))


def require_host(url: Column) -> Column:
    """``url``, or a failure of the query if it has no host or no path."""
    message = F.concat(F.lit("URL needs a host and a path: "), url)
    usable = (url_host(url) != "") & url_path(url).startswith("/")
    return F.when(usable, url).otherwise(F.raise_error(message).cast("string"))


def object_url(bucket: Column, key: Column, location: Column | None = None, directory: Column | None = None) -> Column:
    """``base/bucket[/directory]/key``; location and directory may be NULL or empty."""
    base = F.lit(DEFAULT_BASE)
    if location is not None:
        before, after = LOCATION_BASE.split("{location}")
        named = F.concat(F.lit(before), location, F.lit(after))
        base = F.when(F.coalesce(location, F.lit("")) != "", named).otherwise(base)
    parts = [base, bucket]
    if directory is not None:
        trimmed = F.rtrim(directory, F.lit("/"))
        parts.append(F.when(trimmed != "", trimmed))
    return F.concat_ws("/", *parts, key)
