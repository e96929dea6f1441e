"""Operators that need one global order, without sorting it in one task.

An unpartitioned window would move every row into a single task.  Here the
rows are range partitioned instead, each slice is numbered where it lies, and
only one row per slice (at most ``spark.sql.shuffle.partitions`` rows) is
added up to find where each slice begins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsframe.functions.sizes import int_div
from opsframe.storage import cut_lineage

PART = "_part"
POS = "_pos"
# monotonically_increasing_id keeps the row number within a task in its low 33 bits.
ROW_BITS = (1 << 33) - 1
# Buckets of the hashed order, three hexadecimal digits of an MD5 digest.
HASH_BUCKETS = 4096


def _column(order: str | Column) -> Column:
    return F.col(order) if isinstance(order, str) else order


def _row_hash(df: DataFrame) -> Column:
    """A hash over all columns; those that cannot be hashed enter as JSON."""

    def plain(kind: T.DataType) -> bool:
        if isinstance(kind, T.ArrayType):
            return plain(kind.elementType)
        if isinstance(kind, T.StructType):
            return all(plain(f.dataType) for f in kind.fields)
        return not isinstance(kind, (T.MapType, T.VariantType))

    parts = [F.col(f.name) if plain(f.dataType) else F.to_json(F.struct(f.name)) for f in df.schema.fields]
    return F.xxhash64(*parts)


def range_parts(df: DataFrame, *order: str | Column) -> DataFrame:
    """Rows with the slice ``_part`` and the place ``_pos`` they have in the order.

    The order is completed by a hash of the row, which makes it repeatable,
    and by an arbitrary number that only tells identical copies apart.  A key,
    or a group of copies, that holds a third of all rows is therefore cut into
    several slices like any other range.  The result is written once: the
    bounds of a range partitioning are sampled and would differ if the rows
    were computed again.
    """
    keys = [*map(_column, order), F.col("_tie"), F.col("_copy")]
    ranged = (
        df.withColumn("_tie", _row_hash(df))
        .withColumn("_copy", F.monotonically_increasing_id())
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select(
            *df.columns,
            F.spark_partition_id().alias(PART),
            F.monotonically_increasing_id().bitwiseAND(F.lit(ROW_BITS)).alias(POS),
        )
    )
    return cut_lineage(ranged, "ranged")


def part_totals(parts: DataFrame, weight: str | None = None) -> DataFrame:
    """One row per slice: rows and weight in it, before it, and overall rows."""
    size = F.sum(weight) if weight else F.lit(0).cast("long")
    totals = parts.groupBy(PART).agg(F.count(F.lit(1)).alias("_n"), size.alias("_size"))
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        PART, "_n", "_size",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n_before"),
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_size_before"),
        F.sum("_n").over(Window.partitionBy()).alias("_n_all"),
    )


def with_rank(df: DataFrame, *order: str | Column, rank: str = "rank", total: str | None = None) -> DataFrame:
    """Adds the 0-based place of each row in the global order, and the row count."""
    parts = range_parts(df, *order)
    # One row per slice, so the broadcast is bounded by the number of shuffle partitions.
    placed = parts.join(F.broadcast(part_totals(parts)), PART)
    extra = [F.col("_n_all").alias(total)] if total else []
    return placed.select(*df.columns, (F.col("_n_before") + F.col(POS)).alias(rank), *extra)


def ntile_partition(df: DataFrame, *order: str | Column, tiles: int, tile: str = "tile") -> DataFrame:
    """Cuts the ordered rows into ``tiles`` consecutive pieces, the first ones one row longer."""
    ranked = with_rank(df, *order, rank="_rank", total="_total")
    rank, total = F.col("_rank"), F.col("_total")
    short = int_div(total, F.lit(tiles))
    longer = total % tiles
    in_longer = longer * (short + 1)
    number = F.when(rank < in_longer, int_div(rank, short + 1)).otherwise(
        longer + int_div(rank - in_longer, F.greatest(short, F.lit(1)))
    )
    return ranked.select(*df.columns, (number + 1).cast("int").alias(tile))


def chunk_assign(df: DataFrame, *order: str | Column, fan_out: int = 100, path: str = "chunk_path") -> DataFrame:
    """Numbers the ordered rows by the tree of chunks a recursive fan-out makes.

    A list of n rows is cut into consecutive chunks of ``n div fan_out`` rows
    while that is more than one, and every chunk is cut again in the same way.
    ``chunk_path`` holds the chunk number at each level, from the root.
    """
    parts = range_parts(df, *order)
    placed = parts.join(F.broadcast(part_totals(parts)), PART).select(
        *df.columns,
        (F.col("_n_before") + F.col(POS)).alias("_at"),
        F.col("_n_all").alias("_len"),
        F.array().cast("array<bigint>").alias(path),
    )
    # The depth follows from the row count alone, which the written slices hold in their footers.
    longest = parts.count()
    while longest // fan_out > 1:
        longest //= fan_out
        size = int_div(F.col("_len"), F.lit(fan_out))
        divided = size > 1
        step = F.greatest(size, F.lit(1))
        number = int_div(F.col("_at"), step)
        placed = placed.select(
            *df.columns,
            F.when(divided, F.col("_at") - number * step).otherwise(F.col("_at")).alias("_at"),
            F.when(divided, F.least(step, F.col("_len") - number * step)).otherwise(F.col("_len")).alias("_len"),
            F.when(divided, F.concat(F.col(path), F.array(number))).otherwise(F.col(path)).alias(path),
        )
    return placed.select(*df.columns, path)


def shuffle_key(key: str | Column, seed: str) -> Column:
    """A hash that orders rows at random, the same way in every run."""
    return F.md5(F.concat(F.lit(seed), _column(key).cast("string")))


def shuffle_order(df: DataFrame, key: str | Column, seed: str = "", position: str = "position") -> DataFrame:
    """Numbers the rows from 1 in a random order that ``seed`` repeats."""
    keyed = df.withColumn("_hash", shuffle_key(key, seed))
    return with_rank(keyed, "_hash", key, rank="_rank").select(*df.columns, (F.col("_rank") + 1).alias(position))


def quota_sample(df: DataFrame, key: str, size: str, quota: int, seed: str = "") -> DataFrame:
    """Rows in random order until their summed size first exceeds ``quota``.

    The row that crosses the quota belongs to the sample; with too little data
    every row does.  Sizes must not be negative; a missing size counts as 0.

    Only sums per hash bucket are needed to see which buckets lie wholly
    inside; just the rows of the one bucket that crosses the quota are sorted.
    """
    weighted = (
        df.withColumn("_hash", shuffle_key(key, seed))
        .withColumn("_bucket", F.conv(F.substring("_hash", 1, 3), 16, 10).cast("int"))
        .withColumn("_w", F.coalesce(F.col(size).cast("long"), F.lit(0)))
    )
    sums = weighted.groupBy("_bucket").agg(F.sum("_w").alias("_bucket_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # At most HASH_BUCKETS rows, so the window and the broadcast stay small.
    starts = sums.select(
        "_bucket",
        F.coalesce(F.sum("_bucket_size").over(before), F.lit(0)).alias("_start"),
        (F.coalesce(F.sum("_bucket_size").over(before), F.lit(0)) + F.col("_bucket_size")).alias("_end"),
    )
    inside = starts.filter(F.col("_end") <= quota).select("_bucket")
    crossing = starts.filter((F.col("_start") <= quota) & (F.col("_end") > quota)).select("_bucket", "_start")

    whole = weighted.join(F.broadcast(inside), "_bucket", "left_semi").select(*df.columns)

    parts = range_parts(weighted.join(F.broadcast(crossing), "_bucket"), "_hash", key)
    slices = parts.join(F.broadcast(part_totals(parts, "_w")), PART).withColumn(
        "_start", F.col("_start") + F.col("_size_before")
    )
    in_slice = Window.partitionBy(PART).orderBy(POS).rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        slices.filter(F.col("_start") <= quota)
        .withColumn("_start", F.col("_start") + F.coalesce(F.sum("_w").over(in_slice), F.lit(0)))
        .filter(F.col("_start") <= quota)
        .select(*df.columns)
    )
    return whole.unionByName(cut)


def consecutive_runs(
    df: DataFrame,
    order: Sequence[str | Column],
    same: Sequence[str],
    run: str = "run",
    place: str = "run_place",
) -> DataFrame:
    """Numbers the runs of ordered rows that agree in the columns ``same``.

    ``run`` is the global place of the first row of the run, ``run_place`` the
    0-based place within it.  Each slice finds its own starts; a run that
    reaches over slices is continued from one row per slice.  Those rows come
    from a first pass over the written slices that reads only the columns
    ``same``.
    """
    parts = range_parts(df, *order)
    totals = part_totals(parts)
    key = F.struct(*[F.col(c) for c in same])

    last_rows = totals.select(PART, (F.col("_n") - 1).alias(POS))
    slices = Window.orderBy(PART)
    carried = (
        parts.join(F.broadcast(last_rows), [PART, POS])
        .select(F.lead(PART).over(slices).alias(PART), key.alias("_carried"))
        .filter(F.col(PART).isNotNull())
    )
    placed = parts.join(
        F.broadcast(totals.join(carried, PART, "left").select(PART, "_n_before", "_carried")), PART
    ).withColumn("_rank", F.col("_n_before") + F.col(POS))

    in_slice = Window.partitionBy(PART).orderBy(POS)
    previous = F.when(F.col(POS) == 0, F.col("_carried")).otherwise(F.lag(key).over(in_slice))
    started = placed.withColumn("_first", previous.isNull() | ~previous.eqNullSafe(key)).withColumn(
        "_run", F.max(F.when(F.col("_first"), F.col("_rank"))).over(in_slice)
    )

    open_run = F.max("_run").over(slices.rowsBetween(Window.unboundedPreceding, -1))
    opened = started.groupBy(PART).agg(F.max("_run").alias("_run")).select(PART, open_run.alias("_open"))
    number = F.coalesce(F.col("_run"), F.col("_open"))
    return started.join(F.broadcast(opened), PART).select(
        *df.columns, number.alias(run), (F.col("_rank") - number).alias(place)
    )
