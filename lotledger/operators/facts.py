"""Typed facts out of key/value rows: unit counts, exemption codes, owners, registrations."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotledger.functions.text import money, whole

STABILIZATION_KEY = "Housing-Rent Stabilization"
NO_LOT, NO_YEAR = -(2**63), -(2**31)  # equal no list entry
NUMERIC_ID = r"^[\d ]+$"

# Printed key (lower case) to exemption code.
EXEMPTION_CODES = {
    "scrie rent stabilization abatement": "scrie",
    "j51 abatement": "j51",
    "coop condo abatement": "coco",
    "basic star - school tax relief": "star",
    "drie disability rent increase abate": "drie",
    "senior citizens homeowners’ exemption": "sche",
    "j-51 exemption": "j51",
    "veteran exemption": "vet",
    "co-op condo abatement": "coco",
    "enhanced star - school tax relief": "estar",
    "co-op condo abatement 2013/14*": "coco",
    "new mult dwellings - 421a": "421a",
    "j-51 alteration": "j51",
    "421a (25 yr not cap": "421a",
    "420c housing": "420c",
    "421a (15 yr not cap)": "421a",
    "new mult dwellings": "421a",
    "421a (10 yr cap)": "421a",
    "421a (20 yr not cap": "421a",
}


def literal_map(values: Mapping[str, str]) -> Column:
    quoted = ", ".join(f"{_quote(k)}, {_quote(v)}" for k, v in values.items())
    return F.expr(f"map({quoted})")


def _quote(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def key_class(section: Column) -> Column:
    """Class of a row by its section; stored rows have a folder for each."""
    return (
        F.when(section == "nopv", "notice")
        .when(section.isNull(), "owner")
        .when(section.startswith("details"), "details")
        .otherwise("charges")
    )


def with_keys(raw: DataFrame, keys: Iterable[str], classes: Iterable[str] = ()) -> DataFrame:
    """Rows whose key, in lower case, is one of ``keys``.

    Stored rows (``read_raw_store``) are pruned by their key; ``classes``, if the keys occur in
    no other, also picks the folders.
    """
    if "key_lc" not in raw.columns:
        return raw.filter(F.lower("key").isin(list(keys)))
    found = raw.filter(F.col("key_lc").isin(list(keys)))
    return found.filter(F.col("key_class").isin(list(classes))) if classes else found


def unit_counts(raw: DataFrame, cutoff: str = "2012-04-01", shift: int = 2,
                unit_price: int = 10) -> DataFrame:
    """One row per registration line; units of non-numeric ids are recomputed from the fee.

    Due dates after ``cutoff`` belong to ``shift`` years earlier. The fee quotient is cut to
    cents, then rounded half away from zero.
    """
    year = F.year("duedate")
    cents = F.call_function("div", (F.col("amount") * 100).cast("bigint"), F.lit(unit_price))
    repaired = F.round(cents.cast("decimal(19,0)") / 100).cast("int")
    return (
        with_keys(raw, [STABILIZATION_KEY.lower()])
        .select(
            "bbl", "activitythrough", "duedate",
            F.when(F.col("duedate") > F.lit(cutoff).cast("date"), year - shift)
            .otherwise(year).alias("year"),
            money(F.col("value")).alias("amount"),
            whole(F.col("apts")).alias("units"),
            "meta",
        )
        .withColumn(
            "units", F.when(~F.col("meta").rlike(NUMERIC_ID), repaired).otherwise(F.col("units"))
        )
    )


def nonnumeric_ids(units: DataFrame) -> DataFrame:
    """Audit: registration lines whose id is not digits and blanks."""
    return units.filter(~F.col("meta").rlike(NUMERIC_ID))


def abatements(raw: DataFrame, codes: Mapping[str, str] = EXEMPTION_CODES) -> DataFrame:
    """Count of exemption lines per lot, bill day and code."""
    key = F.lower("key")
    return (
        with_keys(raw, codes)
        .groupBy("bbl", "activitythrough", literal_map(codes)[key].alias("abatement"))
        .agg(F.count(F.lit(1)).cast("int").alias("cnt"))
    )


def keyed_rows(raw: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Rows whose key, in lower case, is one of ``keys``."""
    return with_keys(raw, keys)


def abatements_by_year(facts: DataFrame) -> DataFrame:
    """Sorted distinct codes per lot and year, joined with commas."""
    return facts.groupBy("bbl", F.year("activitythrough").alias("year")).agg(
        F.array_join(F.sort_array(F.collect_set("abatement")), ",").alias("abatements")
    )


def _largest_by_year(raw: DataFrame, key: str, name: str) -> DataFrame:
    return (
        with_keys(raw, [key])
        .groupBy("bbl", F.year("activitythrough").alias("year"))
        .agg(F.max("value").alias(name))
    )


def owners(raw: DataFrame) -> DataFrame:
    return _largest_by_year(raw, "owner name", "owner")


def addresses(raw: DataFrame) -> DataFrame:
    return _largest_by_year(raw, "mailing address", "address")


def owner_addresses(raw: DataFrame) -> DataFrame:
    """Owner and address of each lot and year that has both.

    One aggregation with two conditional maxima replaces the join of two aggregates.
    """
    key = F.lower("key")
    owner, address = key == "owner name", key == "mailing address"
    return (
        with_keys(raw, ["owner name", "mailing address"])
        .filter(F.col("bbl").isNotNull() & F.col("activitythrough").isNotNull())
        .groupBy("bbl", F.year("activitythrough").alias("year"))
        .agg(
            F.max(F.when(owner, F.col("value"))).alias("owner"),
            F.max(F.when(address, F.col("value"))).alias("address"),
            F.bool_or(owner).alias("has_owner"),
            F.bool_or(address).alias("has_address"),
        )
        .filter("has_owner AND has_address")
        .select("bbl", "year", "owner", "address")
    )


def registrations(units: DataFrame, listed: DataFrame) -> DataFrame:
    """Bill lines against the published list, per id, due date and both lots.

    The full outer match on (lot, year) is split in two. Bill lines are first reduced to distinct
    (id, due date, lot, year, units), so a lot with very many bills shrinks before the shuffle,
    and a left join can be split further when one key is still hot; list entries without a bill
    follow from an anti join. Neither split changes the maxima or the distinct count.

    ``indhcr``: ``?`` when the bill year was never published, ``Y`` when the lot is on the list,
    else ``N``. A NULL bill year falls through the first test unless the list is empty, and a
    NULL year in the list switches that test off.
    """
    # Both uses below read one shuffled result instead of scanning the raw rows twice: the count
    # keeps the reduction from being optimized away below the second distinct, and standing in for
    # NULL there keeps the anti join from pushing a NULL filter into one of the two.
    bills = (
        units.groupBy(
            F.col("meta").alias("regno"), "duedate", F.col("year").alias("uc_year"),
            F.col("bbl").alias("ucbbl"), "units",
        )
        .agg(F.count(F.lit(1)).alias("copies")).filter("copies > 0")
    )
    entries = listed.select(F.col("bbl").alias("dhcrbbl"), F.col("year").alias("dh_year")).distinct()
    same = (F.col("ucbbl") == F.col("dhcrbbl")) & (F.col("uc_year") == F.col("dh_year"))

    matched = bills.join(entries, same, "left").drop("copies")
    billed = bills.select(
        F.coalesce("ucbbl", F.lit(NO_LOT)).alias("ucbbl"),
        F.coalesce("uc_year", F.lit(NO_YEAR)).alias("uc_year"),
    ).distinct()
    unmatched = entries.join(billed, same, "left_anti").select(
        F.lit(None).cast("string").alias("regno"),
        F.lit(None).cast("date").alias("duedate"),
        F.lit(None).cast("int").alias("uc_year"),
        F.lit(None).cast("bigint").alias("ucbbl"),
        F.lit(None).cast("int").alias("units"),
        "dhcrbbl", "dh_year",
    )
    grouped = matched.unionByName(unmatched).groupBy("regno", "duedate", "ucbbl", "dhcrbbl").agg(
        F.max("uc_year").alias("ucyear"),
        F.max("dh_year").alias("dhcryear"),
        F.max("units").alias("maxunits"),
        F.count_distinct("units").cast("int").alias("diffunits"),
    )
    known = listed.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("year").isNull()).alias("unknown"),
        ).alias("known")
    ).scalar()
    published = listed.select(F.col("year").alias("published")).distinct()
    grouped = grouped.join(published, F.col("ucyear") == F.col("published"), "left")
    never = (known["n"] == 0) | (
        (known["unknown"] == 0) & F.col("ucyear").isNotNull() & F.col("published").isNull()
    )
    return grouped.select(
        "regno", "duedate", "ucyear", "dhcryear", "ucbbl", "dhcrbbl", "maxunits", "diffunits",
        F.when(never, "?").when(F.col("dhcrbbl").isNotNull(), "Y").otherwise("N").alias("indhcr"),
    )


def units_by_year(regs: DataFrame) -> DataFrame:
    return (
        regs.filter(F.col("regno").isNotNull())
        .groupBy("ucbbl", "ucyear")
        .agg(F.sum("maxunits").alias("units"))
    )


def listed_by_year(regs: DataFrame) -> DataFrame:
    return regs.groupBy("dhcrbbl", "dhcryear").agg(F.max("indhcr").alias("indhcr"))


def value_estimates(raw: DataFrame) -> DataFrame:
    """Income and expense estimates of value notices."""
    notices = raw.filter(F.col("section") == "nopv")
    if "key_class" in raw.columns:
        notices = notices.filter(F.col("key_class") == "notice")
    return notices.select(
        "bbl", "activitythrough", F.lower("key").alias("key"), "value"
    )


def key_frequency(raw: DataFrame) -> DataFrame:
    return raw.groupBy("key").agg(F.count(F.lit(1)).alias("count"))


def lot_rows(raw: DataFrame, bbl: int) -> DataFrame:
    """All raw rows of one lot."""
    return raw.filter(F.col("bbl") == bbl)


def unit_rows(units: DataFrame, regno: str) -> DataFrame:
    """All count rows of one registration id."""
    return units.filter(F.col("meta") == regno)
