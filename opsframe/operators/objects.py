"""Object inventories: listing, grouping, reconciling, chunking.

Listings have the columns ``key`` and ``size``.  No operator broadcasts a
listing: both sides grow with the store, so the join strategy is left to
adaptive execution, which also splits skewed keys.  It can split only the left
side of a semi or anti join, so the right side is made distinct first; that
combines before the shuffle and uses the partitioning of the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsframe.functions.keys import stable_uuid
from opsframe.functions.paths import basename, dirname, has_suffix, stem, suffix_swap
from opsframe.functions.sizes import chunk_count, int_div
from opsframe.operators.ordered import consecutive_runs

# Part size, tries of an upload, name endings of run artifacts.
CHUNK_BYTES = 5000 * 1024 * 1024
UPLOAD_TRIES = 3
FILES_SUFFIX = "--files"
JOBS_SUFFIX = "--jobs"
LANE_MARK = "_L00"
# Parts whose receipt one long holds as bits.
WORD_PARTS = 64


def object_listing(objects: DataFrame, prefix: str = "") -> DataFrame:
    """Key and size of the objects whose key starts with ``prefix``."""
    listed = objects.select("key", "size")
    return listed.filter(F.col("key").startswith(prefix)) if prefix else listed


def object_count(objects: DataFrame, prefix: str = "") -> DataFrame:
    """Number of objects whose key starts with ``prefix``."""
    return object_listing(objects, prefix).agg(F.count(F.lit(1)).alias("n"))


def suffix_filter(df: DataFrame, column: str, *suffixes: str, keep: bool = True) -> DataFrame:
    """Keeps, or drops, rows whose text ends with one of the suffixes."""
    test = has_suffix(F.col(column), *suffixes)
    return df.filter(test if keep else ~test)


def explode_members(archives: DataFrame, members: str = "members", member: str = "member") -> DataFrame:
    """One row per member of each archive."""
    return archives.withColumn(member, F.explode(members)).drop(members)


def drop_marked(members: DataFrame, marks: Sequence[str], member: str = "member") -> DataFrame:
    """Drops members whose file name contains a mark; directories do not count."""
    name = basename(F.col(member))
    marked = F.lit(False)
    for mark in marks:
        marked = marked | name.contains(mark)
    return members.filter(~marked)


def bundle_ids(names: DataFrame, mark: str = LANE_MARK) -> DataFrame:
    """Distinct text before the first ``mark`` of each name."""
    return names.select(F.substring_index("name", mark, 1).alias("id")).distinct()


def prefix_bundle(ids: DataFrame, names: DataFrame) -> DataFrame:
    """Every id with every name that starts with it (``S1`` also takes ``S10``).

    A name can only match its own prefixes, so it is joined on those whose
    length some id has: an equi join in place of comparing all ids with all
    names.  The lengths are one small array, as names have a limited length.
    """
    distinct = ids.select("id").distinct()
    lengths = distinct.agg(F.sort_array(F.collect_set(F.length("id")))).scalar()
    prefixes = names.withColumn("_length", F.explode(lengths)).filter(F.col("_length") <= F.length("name"))
    keyed = prefixes.withColumn("id", F.substring(F.col("name"), F.lit(1), F.col("_length"))).drop("_length")
    return keyed.join(distinct, "id").select("id", *names.columns)


def exact_bundle(names: DataFrame, mark: str = LANE_MARK) -> DataFrame:
    """Every name with the id it carries itself, so ``S1`` does not take ``S10``."""
    return names.select(F.substring_index("name", mark, 1).alias("id"), *names.columns)


def orphan_names(domains: DataFrame, buckets: DataFrame, suffix: str = FILES_SUFFIX) -> DataFrame:
    """Distinct names with the suffix that exist as a domain but not as a bucket."""
    def named(df: DataFrame) -> DataFrame:
        return suffix_filter(df.select("name"), "name", suffix)

    return named(domains).distinct().join(named(buckets).distinct(), "name", "left_anti")


def orphan_pairs(
    domains: DataFrame, buckets: DataFrame, suffix: str = FILES_SUFFIX, partner: str = JOBS_SUFFIX
) -> DataFrame:
    """Each orphan and its partner name, as far as they exist as domains."""
    pair = F.array(F.col("name"), suffix_swap(F.col("name"), suffix, partner))
    wanted = orphan_names(domains, buckets, suffix).select(F.col("name").alias("orphan"), F.explode(pair).alias("name"))
    return wanted.join(domains.select("name").distinct(), "name").select("orphan", "name")


def rename_join(files: DataFrame, name_pairs: DataFrame, extension: str = ".fastq.gz") -> DataFrame:
    """New name ``stem.ext`` of each file called ``uuid.ext``.

    Repeated lines of the name pairs count once, so copies of a file are not
    paired with copies of its line.
    """
    pairs = name_pairs.select(
        F.concat("uuid", F.lit(extension)).alias("name"), F.concat("stem", F.lit(extension)).alias("new_name")
    ).distinct()
    return files.join(pairs, "name")


def name_pairs(files: DataFrame, project: str, seed: str, name: str = "name") -> DataFrame:
    """Project, stem and a repeatable id for each file."""
    return files.select(
        F.lit(project).alias("project"), stem(F.col(name)).alias("stem"), stable_uuid(F.col(name), seed).alias("uuid")
    )


def skip_existing(objects: DataFrame, existing: DataFrame) -> DataFrame:
    """Objects whose key is not at the target yet."""
    return objects.join(existing.select("key").distinct(), "key", "left_anti")


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that ``right`` does not have."""
    return left.subtract(right.distinct())


def tested_dirs(changed: DataFrame, children: DataFrame, within: str = "src", mark: str = "test") -> DataFrame:
    """Directories of changed paths containing ``within`` that hold a child directory named with ``mark``."""
    dirs = changed.filter(F.col("path").contains(within)).select(dirname(F.col("path")).alias("dir")).distinct()
    holding = children.filter(F.col("child").contains(mark)).select("dir").distinct()
    return dirs.join(holding, "dir", "left_semi")


def chunk_plan(objects: DataFrame, chunk: int = CHUNK_BYTES) -> DataFrame:
    """Parts of each object: number from 1, offset and bytes; an empty object has none."""
    parts = objects.filter(F.col("size") > 0).select(
        "key", "size", F.posexplode(F.sequence(F.lit(1).cast("long"), chunk_count(F.col("size"), chunk)))
    )
    offset = (F.col("col") - 1) * F.lit(chunk)
    return parts.select(
        "key",
        F.col("col").alias("part"),
        offset.alias("offset"),
        F.least(F.lit(chunk).cast("long"), F.col("size") - offset).alias("bytes"),
    )


def _words(received: DataFrame) -> DataFrame:
    """Parts received as bits of words of 64 parts: combined before the shuffle, and a key of many parts has many words."""
    zero = F.col("part").cast("long") - 1
    word = int_div(zero, F.lit(WORD_PARTS))
    return (
        received.filter(F.col("part") >= 1)
        .select("key", word.alias("_word"), F.call_function("shiftleft", F.lit(1).cast("long"), (zero % WORD_PARTS).cast("int")).alias("_bit"))
        .groupBy("key", "_word")
        .agg(F.bit_or("_bit").alias("_bits"))
    )


def _planned_bits(word: Column, planned: Column) -> Column:
    """The bits of a word that stand for planned parts."""
    n = F.least(planned.cast("long") - word * WORD_PARTS, F.lit(WORD_PARTS).cast("long")).cast("int")
    one = F.lit(1).cast("long")
    return F.when(n >= WORD_PARTS, F.lit(-1).cast("long")).when(n <= 0, F.lit(0).cast("long")).otherwise(
        F.call_function("shiftleft", one, n) - 1
    )


def chunk_verify(plan: DataFrame, received: DataFrame) -> DataFrame:
    """Parts planned, and how many of them were received, per key; complete if that is all of them.

    A part that was sent twice counts once, one that is not in the plan does not
    count.  Repeated lines of the plan count once.
    """
    joined = plan.select("key", "planned").distinct().join(_words(received), "key", "left")
    wanted = F.col("_bits").bitwiseAND(_planned_bits(F.col("_word"), F.col("planned")))
    got = F.coalesce(F.sum(F.bit_count(wanted).cast("long")), F.lit(0).cast("long"))
    counted = joined.groupBy("key", "planned").agg(got.alias("received"))
    return counted.withColumn("complete", F.col("received") == F.greatest("planned", F.lit(0)))


def missing_parts(plan: DataFrame, received: DataFrame) -> DataFrame:
    """One row per planned part that was not received."""
    last = int_div(F.col("planned").cast("long") - 1, F.lit(WORD_PARTS))
    words = (
        plan.select("key", "planned")
        .distinct()
        .filter(F.col("planned") > 0)
        .withColumn("_word", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    )
    lacking = _planned_bits(F.col("_word"), F.col("planned")).bitwiseAND(
        F.bitwise_not(F.coalesce("_bits", F.lit(0).cast("long")))
    )
    places = F.filter(F.sequence(F.lit(0), F.lit(WORD_PARTS - 1)), lambda i: F.getbit("_lacking", i) == 1)
    return (
        words.join(_words(received), ["key", "_word"], "left")
        .withColumn("_lacking", lacking)
        .filter(F.col("_lacking") != 0)
        .select("key", "_word", F.explode(places).alias("_place"))
        .select("key", (F.col("_word") * WORD_PARTS + F.col("_place") + 1).alias("part"))
    )


def failure_list(attempts: DataFrame, tries: int = UPLOAD_TRIES) -> DataFrame:
    """Keys that were tried at least ``tries`` times and never succeeded."""
    return (
        attempts.groupBy("key")
        .agg(F.count(F.lit(1)).alias("_tries"), F.bool_or("ok").alias("_ok"))
        .filter((F.col("_tries") >= tries) & ~F.col("_ok"))
        .select("key")
    )


def collate_runs(
    df: DataFrame, order: Sequence[str], id_column: str, within: Sequence[str] = ()
) -> DataFrame:
    """Rows in order, with the run of equal neighbouring ids they belong to.

    Rows without an id end a run and are dropped.  ``run`` tells runs apart,
    ``run_place`` counts within one.  The rows of a run are not collected: one
    run may hold a large part of all rows.
    """
    runs = consecutive_runs(df, [*within, *order], [*within, id_column])
    return runs.filter(F.coalesce(F.col(id_column).cast("string"), F.lit("")) != "")


def collate_lines(runs: DataFrame, id_column: str, url: str, *keep: str, per_line: int | None = None) -> DataFrame:
    """One line ``id,url1,url2,…`` per run, or one for each ``per_line`` URLs of it if that is given.

    A line holds its run whole; for runs too long for a line use the rows of ``collate_runs`` themselves.
    """
    piece = int_div(F.col("run_place"), F.lit(per_line)) if per_line else F.lit(0)
    urls = F.array_sort(F.collect_list(F.struct("run_place", F.col(url).cast("string").alias("url"))))
    return (
        runs.groupBy(*keep, "run", piece.alias("piece"), F.col(id_column).alias("id"))
        .agg(F.transform(urls, lambda u: u["url"]).alias("urls"))
        .select(
            *keep, "id", F.size("urls").alias("n"),
            F.concat_ws(",", F.col("id").cast("string"), "urls").alias("line"),
        )
    )


def config_lines(samples: DataFrame, bucket_url: str, key: str = "key") -> DataFrame:
    """One line ``id,url`` per object; directories are dropped from the key."""
    name = basename(F.col(key))
    return samples.select(F.concat_ws(",", stem(F.col(key)), F.concat(F.lit(bucket_url.rstrip("/") + "/"), name)).alias("line"))
