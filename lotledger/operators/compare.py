"""Yearly movements against official totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotledger.functions.lots import borough_of
from lotledger.operators.panel import yearly_pairs
from lotledger.operators.quality import one_per


def yearly_moves(panel: DataFrame) -> DataFrame:
    """Net, loss and gain by borough number and year; pairs with a missing side add nothing."""
    step = F.col("cur") - F.col("prev")
    return (
        yearly_pairs(panel)
        .groupBy(borough_of(F.col("ucbbl")).alias("borough"), "year")
        .agg(
            F.sum(step).alias("net"),
            F.sum(F.when(step < 0, step).otherwise(0)).alias("loss"),
            F.sum(F.when(step > 0, step).otherwise(0)).alias("gain"),
        )
    )


def _official(official: DataFrame) -> DataFrame:
    """Official totals, one row per borough and year."""
    return one_per(official.select(
        F.col("borough").cast("bigint").alias("o_borough"), F.col("year").alias("o_year"),
        F.col("net").cast("double").alias("o_net"),
        F.col("total_sub").alias("o_sub"),
        F.col("total_add").cast("double").alias("o_add"),
    ), ["o_borough", "o_year"])


def _int(c: Column) -> Column:
    """A float assigned to an integer column: nearest, ties to even."""
    return F.rint(c).cast("int")


def _matches() -> Column:
    return (F.col("borough") == F.col("o_borough")) & (F.col("year") == F.col("o_year"))


def compare_official(panel: DataFrame, official: DataFrame) -> DataFrame:
    """Our movements, the official ones (0 when none was published) and the differences."""
    joined = yearly_moves(panel).join(_official(official), _matches(), "left")
    found = F.col("o_borough").isNotNull()
    out = []
    for ours, theirs, name in (("net", "o_net", "diff"), ("loss", "o_sub", "loss"),
                               ("gain", "o_add", "gain")):
        ref = F.col(theirs).cast("double")
        out += [
            F.col(ours).alias(f"dof_{name}"),
            F.when(found, _int(ref)).otherwise(0).alias(f"rgb_{name}"),
            F.when(found, _int(F.col(ours) - ref)).otherwise(0).alias(f"diff_{name}"),
        ]
    return joined.select("year", "borough", *out)


def percent_error(panel: DataFrame, official: DataFrame) -> DataFrame:
    """Relative error of net, losses and gains in whole percent, for published years only."""
    joined = yearly_moves(panel).join(_official(official), _matches())

    def share(ours: str, theirs: str) -> Column:
        ref = F.col(theirs).cast("double")
        return F.try_divide((ref - F.col(ours)) * 100.0, ref)

    return joined.select(
        "borough", "year",
        F.col("net").alias("dof_net"), F.col("o_net").alias("rgb_net"),
        _int(share("net", "o_net")).alias("net_err"),
        F.col("loss").alias("dof_sub"), F.col("o_sub").alias("rgb_sub"),
        F.round(share("loss", "o_sub")).cast("int").alias("sub_err"),
        F.col("gain").alias("dof_add"), F.col("o_add").alias("rgb_add"),
        _int(share("gain", "o_add")).alias("add_err"),
    )


def rollup_comparison(comparison: DataFrame) -> DataFrame:
    """The comparison summed over years."""
    names = [f"{who}_{what}" for what in ("diff", "loss", "gain") for who in ("dof", "rgb", "diff")]
    return comparison.groupBy("borough").agg(*[F.sum(n).alias(n) for n in names])
