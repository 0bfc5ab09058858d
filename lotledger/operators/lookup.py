"""Lot histories, profiles and list comparisons for all lots at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotledger.functions.lots import block_of, borough_of, lot_of
from lotledger.operators.facts import STABILIZATION_KEY
from lotledger.operators.quality import one_per


def _place(raw: DataFrame) -> list[Column]:
    """Where a row stood: document, then line."""
    known = [F.col("doc_path")] if "doc_path" in raw.columns else []
    return [*known, F.col("line_no")]


def unit_history(raw: DataFrame) -> DataFrame:
    """Units per lot and due date, each registration id counted once (its first bill line).

    The first line is a minimum over (bill day, line), an aggregate that combines before the
    shuffle, rather than a window over all bills of a lot.
    """
    firsts = (
        raw.filter(F.col("key") == STABILIZATION_KEY)
        .groupBy("bbl", "duedate", "meta")
        .agg(F.min(F.struct(
            "activitythrough", *_place(raw), F.col("apts").try_cast("double").alias("apts")
        )).alias("first"))
    )
    return firsts.groupBy("bbl", "duedate").agg(
        F.sum(F.coalesce(F.col("first.apts"), F.lit(0.0))).cast("bigint").alias("units")
    ).select("bbl", "duedate", F.year("duedate").alias("year"), "units")


def lot_summary(raw: DataFrame) -> DataFrame:
    """Latest bill day, the property tax on it, and the latest stabilization line of each lot.

    The day is a plain hash aggregation over all rows. The two lines are maxima of whole rows,
    which Spark aggregates by sorting, so only rows with those keys get there; both sides are
    already partitioned by lot when they meet.
    """
    days = raw.groupBy("bbl").agg(F.max("activitythrough").alias("last_activity"))
    tax_row = F.struct("activitythrough", (-F.col("line_no")).alias("l"), "value")
    fee_row = F.struct("activitythrough", "line_no", "duedate", "meta", "apts", "value")
    found = (
        raw.filter(F.col("key").isin("annual property tax", STABILIZATION_KEY))
        .groupBy(F.col("bbl").alias("found_bbl"))
        .agg(
            F.max(F.when(F.col("key") == "annual property tax", tax_row)).alias("tax"),
            F.max(F.when(F.col("key") == STABILIZATION_KEY, fee_row)).alias("fee"),
        )
    )
    return days.join(found, F.col("bbl") == F.col("found_bbl"), "left").select(
        "bbl", "last_activity",
        F.when(F.col("tax.activitythrough") == F.col("last_activity"), F.col("tax.value"))
        .alias("property_tax"),
        F.col("fee.activitythrough").alias("stabilized_through"),
        F.col("fee.duedate").alias("stabilized_due"),
        F.col("fee.meta").alias("regno"),
        F.col("fee.apts").alias("apts"),
    )


def lot_profile(raw: DataFrame, only_day: str) -> DataFrame:
    """First and last bill day, id parts, whether ``only_day`` is the only bill, and whether any
    line is a stabilization line (case matters). One pass replaces the membership join."""
    day = F.lit(only_day).cast("date")
    seen = raw.groupBy("bbl").agg(
        F.min("activitythrough").alias("earliest"),
        F.max("activitythrough").alias("last"),
        F.coalesce(F.bool_or(F.col("key") == STABILIZATION_KEY), F.lit(False)).alias("stabilized"),
    )
    bbl = F.col("bbl")
    return seen.select(
        "bbl",
        borough_of(bbl).cast("int").alias("borough"),
        block_of(bbl).cast("int").alias("block"),
        lot_of(bbl).cast("int").alias("lot"),
        "earliest", "last",
        ((F.col("last") == day) & (F.col("earliest") == day)).alias("oneyear"),
        "stabilized",
    )


def missing_stabilized(profile: DataFrame) -> DataFrame:
    return profile.filter(F.col("oneyear") & F.col("stabilized")).select("borough", "block", "lot")


def list_only_entries(units: DataFrame, listed: DataFrame) -> DataFrame:
    """Lots with a listed year in which they have no bill line, one row per lot."""
    billed = units.select(F.col("bbl"), F.col("year")).distinct()
    entries = listed.select("bbl", "year").distinct()
    return entries.join(billed, ["bbl", "year"], "left_anti").select("bbl").distinct()


def list_only_lots(units: DataFrame, listed: DataFrame, lots: DataFrame) -> DataFrame:
    """The same with parcel units."""
    parcels = one_per(lots.select("bbl", "unitstotal", "unitsres"), ["bbl"])
    return parcels.join(list_only_entries(units, listed), "bbl")


def list_only_ids(units: DataFrame, listed: DataFrame) -> DataFrame:
    bbl = F.col("bbl")
    return list_only_entries(units, listed).select(
        borough_of(bbl).alias("borough"), block_of(bbl).alias("block"), lot_of(bbl).alias("lot"),
        "bbl",
    )


def list_only_by_borough(units: DataFrame, listed: DataFrame) -> DataFrame:
    return (
        list_only_entries(units, listed)
        .groupBy(borough_of(F.col("bbl")).alias("borough"))
        .agg(F.count(F.lit(1)).alias("lots"))
    )


def all_lots(lots: DataFrame, listed: DataFrame, min_units: int = 6) -> DataFrame:
    """Lots with enough units and lots on the list, each once."""
    large = lots.filter(F.col("unitstotal") >= min_units).select(
        F.col("borough_no").cast("int").alias("borough"), "block", "lot"
    )
    on_list = listed.select(F.col("boro_code").cast("int").alias("borough"), "block", "lot")
    return large.union(on_list).distinct()


def lots_held(rows: DataFrame) -> DataFrame:
    """Number of distinct lots."""
    return rows.agg(F.count_distinct("bbl").alias("lots"))
