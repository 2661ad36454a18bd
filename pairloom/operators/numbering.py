"""Dense row numbers 1..n without putting all rows in one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

_DIGITS = 3  # leading hex digits that form a bucket, at least: 4096 buckets


def bucket_digits(partitions: int) -> int:
    """Hex digits that give at least four buckets a shuffle partition."""
    return max(_DIGITS, math.ceil(math.log(4 * partitions, 16)))


def shuffled_order(key: Column, seed: str = "") -> Column:
    """A fixed pseudo-random order of keys: the hex digest of the seeded key."""
    return F.md5(F.concat(F.lit(seed), key).cast("binary"))


def numbered(df: DataFrame, order: Column, ties: list[str], name: str, upto: Column | None = None) -> DataFrame:
    """Rows numbered by a hex digest (then by ``ties``), as one global ``row_number`` would.

    With ``upto`` only rows whose number is at most that: buckets behind it leave
    in the broadcast join, before anything is shuffled or sorted.

    Digests are uniform, so their leading digits cut the rows into even,
    ordered buckets.  Rows are numbered inside their bucket and shifted by the
    sizes of the buckets before it; that table has a few rows a shuffle partition
    (4096 at least), which is why it may be summed in one task and broadcast.
    """
    digits = bucket_digits(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bucketed = df.withColumn("_order", order).withColumn("_bucket", F.left(F.col("_order"), F.lit(digits)))
    sizes = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_shift"))
    if upto is not None:
        shifts = shifts.filter(F.col("_shift") < upto)
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy("_order", *ties))
    placed = bucketed.join(F.broadcast(shifts), "_bucket").withColumn("_inside", inside)
    placed = placed.select(*df.columns, (F.col("_shift") + F.col("_inside")).alias(name))
    return placed if upto is None else placed.filter(F.col(name) <= upto)
