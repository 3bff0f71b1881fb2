"""Gapless numbers in an order, without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticehouse.session import scratch_path

_MARK, _PART = "_mark", "_part"
#: A mark holds the partition above so many bits of the row's place in it.
_PLACE_BITS = 33


def numbered(
    df: DataFrame, order: Sequence[Column | str], name: str = "id", start: int = 1
) -> DataFrame:
    """Rows with their place in a total order, counted from ``start`` without gaps.

    Rows are range-partitioned, sorted and written with their place in the partition.
    The partitions' sizes, one number each, are summed up on the driver, and a row's
    number is its place plus what lies in the partitions before. Rows that the order
    does not tell apart are numbered in any order, but once and for all.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "numbered")
    spread = df.repartitionByRange(*order).sortWithinPartitions(*order)
    spread.withColumn(_MARK, F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    part = F.shiftright(F.col(_MARK), _PLACE_BITS).cast("int")
    sizes = rows.groupBy(part.alias(_PART)).count().collect()
    offsets, before = [], start
    for row in sorted(sizes):
        offsets.append((row[_PART], before))
        before += row["count"]
    # A row per partition.
    starts = F.broadcast(spark.createDataFrame(offsets, f"{_PART} int, _start bigint"))
    place = F.col(_MARK).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    placed = rows.withColumn(_PART, part).join(starts, _PART)
    return placed.select((F.col("_start") + place).alias(name), *df.columns)
