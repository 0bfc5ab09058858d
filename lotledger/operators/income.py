"""Income and expense estimates by lot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotledger.functions.text import amount
from lotledger.operators.facts import with_keys
from lotledger.operators.panel import cell_of
from lotledger.operators.quality import one_per

INCOME_PARCEL_COLUMNS = [
    "lon", "lat", "cd", "ct2010", "council", "zipcode", "address", "ownertype", "ownername",
    "numbldgs", "numfloors", "unitsres", "unitstotal", "yearbuilt", "condono",
]
# Exemption keys looked for.
EXEMPT_KEYS = (
    "new mult dwellings - 421a", "421a (25 yr not cap", "421a (15 yr not cap)",
    "new mult dwellings", "421a (10 yr cap)", "421a (20 yr not cap",
)
EXEMPT_KEYS_AS_RUN = (
    "new mult dwellings - 421a", "421a (25 yr not cap", "421a (15 yr not cap)",
    "421a (20 yr not cap",
)
# Keys of lots with an exemption that implies regulation.
EXEMPT_STABILIZED_KEYS = (
    "new mult dwellings - 421a", "j-51 alteration", "421a (25 yr not cap", "420c housing",
    "421a (15 yr not cap)", "new mult dwellings", "421a (10 yr cap)", "421a (20 yr not cap",
)


def income_by_year(estimates: DataFrame, lots: DataFrame, years: Sequence[int],
                   mode: str = "numeric") -> DataFrame:
    """Highest gross income estimate per lot and year, with parcel attributes.

    ``as_run`` compares the values as text. Estimates are reduced to one row per lot before they
    meet the parcels.
    """
    value = F.col("value") if mode == "as_run" else amount(F.col("value"))
    by_lot = (
        estimates.filter(F.lower("key") == "gross income")
        .groupBy(F.col("bbl").alias("n_bbl"))
        .agg(*[
            F.max(F.when(F.year("activitythrough") == y, value)).alias(f"income{y % 100:02d}")
            for y in years
        ])
    )
    parcels = one_per(lots.select("bbl", *INCOME_PARCEL_COLUMNS), ["bbl"])
    return by_lot.join(parcels, F.col("n_bbl") == F.col("bbl")).select(
        "bbl", *INCOME_PARCEL_COLUMNS, *[f"income{y % 100:02d}" for y in years]
    )


def exempt_lots(raw: DataFrame, panel: DataFrame, lots: DataFrame, estimates: DataFrame,
                years: Sequence[int], at: str, count_year: int,
                mode: str = "intended") -> DataFrame:
    """Lots outside condominiums that took one of the exemptions on one bill day.

    Counts come from ``count_year`` unless estimated, units from the parcels, income and expenses
    from the latest notice (the highest value when several share its day). ``as_run`` looks for
    the four keys that the original comparison could match.
    """
    keys = EXEMPT_KEYS_AS_RUN if mode == "as_run" else EXEMPT_KEYS
    exempt = (
        with_keys(raw, keys).filter(
            (F.col("activitythrough") == F.lit(at).cast("date"))
            & (F.col("bbl") % 10_000 < 1000)
        )
        .groupBy("bbl")
        .agg(F.array_join(F.sort_array(F.collect_set("key")), ",").alias("exemptions"))
    )
    counts = panel.filter(cell_of(years, count_year, "est") == "N").select(
        F.col("ucbbl").alias("bbl"),
        cell_of(years, count_year, "uc").alias("registered_stabilized_apts"),
    )
    parcels = one_per(lots.select("bbl", F.coalesce("unitsres", "unitstotal").alias("pluto_apts")), ["bbl"])
    latest = F.struct("activitythrough", amount(F.col("value")).alias("v"))
    notices = estimates.groupBy("bbl").agg(
        F.max(F.when(F.col("key") == "gross income", latest))["v"].cast("float")
        .alias("estimated_gross_income"),
        F.max(F.when(F.col("key") == "expenses", latest))["v"].cast("float")
        .alias("estimated_expenses"),
    )
    return (
        exempt.join(counts, "bbl", "left").join(parcels, "bbl", "left").join(notices, "bbl", "left")
    )


def exempt_totals(exempt: DataFrame) -> DataFrame:
    return exempt.agg(
        F.sum("pluto_apts").alias("pluto_apts"),
        F.sum("registered_stabilized_apts").alias("registered_stabilized_apts"),
    )
