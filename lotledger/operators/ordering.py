"""Global order without a single task: range partitions, each sorted."""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotledger.sources.working import kept


def ordered(df: DataFrame, keys: Sequence[Column | str]) -> DataFrame:
    """Rows dealt by ranges of ``keys`` and sorted within; ``F.desc_nulls_last`` and the like
    place NULLs. Written files then follow the order. Equal rows of all keys share a range, so keys
    should end in something that tells rows apart."""
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def numbered(df: DataFrame, keys: Sequence[Column | str], name: str = "rank") -> DataFrame:
    """Adds each row's number in the order of ``keys``, from 1.

    The rows are dealt by ranges and written with the number of theirs, so that counting and numbering
    see the same ranges: dealt anew, each would sample bounds of its own. Counts are summed up (one
    row per range); rows count on within theirs. ``keys`` name columns of ``df``. Rows with equal keys
    are numbered in any order, and share a range, so keys should end in something that tells them apart.
    """
    at, inner, of, n, base = (f"_{uuid4().hex}" for _ in range(5))
    dealt = kept(df.repartitionByRange(*keys).withColumn(at, F.spark_partition_id()))
    counts = dealt.groupBy(F.col(at).alias(of)).agg(F.count(F.lit(1)).alias(n))
    before = Window.orderBy(of).rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(of, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(base))
    placed = dealt.withColumn(inner, F.row_number().over(Window.partitionBy(at).orderBy(*keys)))
    return placed.join(bases, F.col(at) == F.col(of)).select(
        *df.columns, (F.col(base) + F.col(inner)).cast("bigint").alias(name))
