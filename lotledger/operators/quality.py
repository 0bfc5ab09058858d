"""Data checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicates(df: DataFrame, keys: Sequence[str], nulls_distinct: bool = True) -> DataFrame:
    """Keys that occur more than once; a key with a NULL part never repeats unless asked."""
    if nulls_distinct:
        for k in keys:
            df = df.filter(F.col(k).isNotNull())
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).filter("count > 1")


def null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a NULL part in a key that must be complete."""
    test = F.lit(False)
    for k in keys:
        test = test | F.col(k).isNull()
    return df.filter(test)


def assert_unique(df: DataFrame, keys: Sequence[str], nulls_distinct: bool = True) -> DataFrame:
    """Return ``df`` unchanged, or raise with a few offending keys."""
    found = duplicates(df, keys, nulls_distinct).take(5)
    if found:
        raise ValueError(f"not unique on {list(keys)}: {found}")
    return df


def one_per(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: of several, the one that is largest in its other columns, from left to
    right, NULL below all values. Rows with a NULL in the key are left out."""
    others = [c for c in df.columns if c not in keys]
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    return df.groupBy(*keys).agg(F.max(F.struct(*others)).alias("_one")).select(
        *[F.col(k) if k in keys else F.col(f"_one.{k}").alias(k) for k in df.columns])


def violations(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """For each (table, key): keys that occur more than once, and rows with a NULL in the key."""
    out = None
    for name, (df, keys) in tables.items():
        null = F.lit(False)
        for k in keys:
            null = null | F.col(k).isNull()
        counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(
            F.coalesce(F.count_if((F.col("n") > 1) & ~null), F.lit(0)).alias("repeated"),
            F.coalesce(F.sum(F.when(null, F.col("n"))), F.lit(0)).cast("bigint").alias("with_null"))
        part = counts.select(F.lit(name).alias("name"), F.lit(", ".join(keys)).alias("key"), "repeated", "with_null")
        out = part if out is None else out.unionByName(part)
    return out
