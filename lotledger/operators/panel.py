"""Year panel: one row per lot with an array of year cells.

``panel`` keeps all years of a lot in one row, ``cells array<struct<year, uc, est, dhcr, abat>>``,
one cell per panel year. The array length is the number of panel years, so a lot never outgrows a
row, and gap filling, yearly differences, wide and long forms and lot summaries are all narrow:
after the aggregation by lot nothing is shuffled again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotledger.operators.quality import one_per

PARCEL_COLUMNS = [
    "cd", "ct2010", "cb2010", "council", "zipcode", "address", "ownername", "numbldgs",
    "numfloors", "unitsres", "unitstotal", "yearbuilt", "condono", "lon", "lat",
]
FIELDS = ("uc", "est", "dhcr", "abat")
POLICIES = ("as_run", "documented", "notes")


def crosstab(df: DataFrame, row: str, category: str, value: str,
             years: Sequence[int]) -> DataFrame:
    """One row per ``row`` (NULL included), one column per listed year; other years are ignored.

    Conditional maxima give a single aggregation over an input with one row per (row, category).
    """
    return df.groupBy(row).agg(*[
        F.expr(f"max(CASE WHEN {category} = {y} THEN {value} END) AS `{y}`") for y in years
    ])


def registrations_crosstab(units: DataFrame, years: Sequence[int]) -> DataFrame:
    return crosstab(units, "ucbbl", "ucyear", "cast(units AS int)", years)


def listed_crosstab(flags: DataFrame, years: Sequence[int]) -> DataFrame:
    return crosstab(flags, "dhcrbbl", "dhcryear", "indhcr", years)


def abatements_crosstab(by_year: DataFrame, years: Sequence[int]) -> DataFrame:
    return crosstab(by_year, "bbl", "year", "abatements", years)


def _cells(year: str, uc: str, est: str, dhcr: str, abat: str, years: Sequence[int]) -> Column:
    fields = (("year", year), ("uc", uc), ("est", est), ("dhcr", dhcr), ("abat", abat))
    structs = (
        "named_struct(" + ", ".join(f"'{n}', {text.format(y)}" for n, text in fields) + ")"
        for y in years
    )
    return F.expr(f"array({', '.join(structs)})")


def panel(regs: DataFrame, abatements: DataFrame, lots: DataFrame,
          years: Sequence[int]) -> DataFrame:
    """Unfilled panel of every lot with a registration, with its parcel attributes.

    Bill lines and list entries of a lot meet in one conditional aggregation over the
    registrations (both lot columns name the same lot when both are set), so they are read once
    and need no join. Codes are collected per year; there are only as many as the code map has.
    """
    by_lot = (
        regs.filter("ucbbl IS NOT NULL OR dhcrbbl IS NOT NULL")
        .groupBy(F.coalesce("ucbbl", "dhcrbbl").alias("ucbbl"))
        .agg(
            F.expr("bool_or(ucbbl IS NOT NULL AND regno IS NOT NULL) AS registered"),
            *[F.expr(f"cast(sum(CASE WHEN ucyear = {y} AND ucbbl IS NOT NULL "
                     f"AND regno IS NOT NULL THEN maxunits END) AS int) AS uc{y}") for y in years],
            *[F.expr(f"max(CASE WHEN dhcryear = {y} AND dhcrbbl IS NOT NULL THEN indhcr END) "
                     f"AS dhcr{y}") for y in years],
        )
        .filter("registered")
    )
    codes = abatements.groupBy("bbl").agg(*[
        F.expr(f"nullif(array_join(sort_array(collect_set(CASE WHEN year(activitythrough) = {y} "
               f"THEN abatement END)), ','), '') AS abat{y}")
        for y in years
    ])
    parcel = one_per(lots.select(F.col("bbl").alias("lot_bbl"), "borough", *PARCEL_COLUMNS), ["lot_bbl"])
    cells = _cells("{0}", "uc{0}", "'N'", "dhcr{0}", "abat{0}", years)
    return (
        by_lot.join(codes, F.col("ucbbl") == F.col("bbl"), "left")
        .join(parcel, F.col("ucbbl") == F.col("lot_bbl"), "left")
        .select("borough", "ucbbl", cells.alias("cells"), *PARCEL_COLUMNS)
    )


def _still_regulated(cell: Column, policy: str) -> Column:
    like = F.Column.like if policy == "as_run" else F.Column.ilike
    rent_exempt = like(cell["abat"], "%SCRIE%") | like(cell["abat"], "%DRIE%")
    return F.coalesce(rent_exempt, F.lit(False)) | F.coalesce(cell["dhcr"] == "Y", F.lit(False))


def _sweep(cells: Column, copy_test, flag_only=None) -> Column:
    """Walk the cells once, carrying the value of the previous cell into gaps that pass the test."""

    def step(acc: Column, cell: Column) -> Column:
        prev = F.element_at(acc, -1)
        gap = cell["uc"].isNull() & prev["uc"].isNotNull()
        copied = gap & copy_test(prev, cell)
        flagged = copied if flag_only is None else copied | (gap & flag_only(cell))
        return F.concat(acc, F.array(F.struct(
            cell["year"].alias("year"),
            F.when(copied, prev["uc"]).otherwise(cell["uc"]).alias("uc"),
            F.when(flagged, "Y").otherwise(cell["est"]).alias("est"),
            cell["dhcr"].alias("dhcr"),
            cell["abat"].alias("abat"),
        )))

    rest = F.slice(cells, 2, F.greatest(F.size(cells) - 1, F.lit(0)))
    return F.aggregate(rest, F.slice(cells, 1, 1), step)


def fill(panel: DataFrame, years: Sequence[int], policy: str = "as_run") -> DataFrame:
    """Fill gaps forward, then backward, and mark estimates.

    ``as_run``: the second year takes the first year's count and the first two years take later
    counts without a test; the third year is only *marked* going forward, never filled; all other
    steps need equal exemption codes on both sides, an upper-case SCRIE/DRIE code or a place on
    the list. ``documented``: codes match in any case and the third year is filled like the
    others. ``notes``: as documented, but a lot without any codes and list entry that year (no
    bill) takes the previous count, and going backward a count is taken when the later year adds
    no new code.
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy}")
    if len(years) < 2:
        return panel  # no year to fill from
    loose, marked = years[1], years[2] if policy == "as_run" and len(years) > 2 else None

    def regulated(cell: Column) -> Column:
        return _still_regulated(cell, policy)

    def same_codes(prev: Column, cell: Column) -> Column:
        return F.coalesce(prev["abat"] == cell["abat"], F.lit(False))

    def forward(prev: Column, cell: Column) -> Column:
        test = same_codes(prev, cell) | regulated(cell)
        if policy == "notes":
            test = test | (cell["abat"].isNull() & cell["dhcr"].isNull())
        if marked is not None:
            test = test & (cell["year"] != marked)
        return (cell["year"] == loose) | test

    def backward(later: Column, cell: Column) -> Column:
        test = same_codes(later, cell) | regulated(cell)
        if policy == "notes":
            added = F.array_except(
                F.split(F.coalesce(later["abat"], F.lit("")), ","),
                F.split(F.coalesce(cell["abat"], F.lit("")), ","),
            )
            test = test | (F.size(F.array_remove(added, "")) == 0)
        return (cell["year"] <= loose) | test

    def mark(cell: Column) -> Column:
        return (cell["year"] == marked) & (cell["abat"].isNotNull() | regulated(cell))

    forwarded = _sweep(F.col("cells"), forward, None if marked is None else mark)
    return (
        panel.withColumn("cells", F.reverse(forwarded))
        .withColumn("cells", F.reverse(_sweep(F.col("cells"), backward)))
    )


def cell_of(years: Sequence[int], year: int, field: str) -> Column:
    return F.expr(f"cells[{years.index(year)}].{field}")


def to_wide(panel: DataFrame, years: Sequence[int], *more: str) -> DataFrame:
    """``<year>uc, <year>est, <year>dhcr, <year>abat`` columns for each year."""
    return panel.select(
        "borough", "ucbbl",
        *[F.expr(f"cells[{i}].{f} AS `{y}{f}`") for i, y in enumerate(years) for f in FIELDS],
        *PARCEL_COLUMNS, *more,
    )


def to_long(panel: DataFrame) -> DataFrame:
    """One row per lot and year, empty cells kept; ``year`` is the first of January."""
    return panel.select("ucbbl", F.explode("cells").alias("cell"), *PARCEL_COLUMNS).select(
        "ucbbl",
        F.make_date(F.col("cell.year"), F.lit(1), F.lit(1)).alias("year"),
        F.col("cell.uc").alias("unitcount"),
        F.col("cell.est").alias("estimate"),
        F.col("cell.dhcr").alias("indhcr"),
        F.col("cell.abat").alias("abatements"),
        *PARCEL_COLUMNS,
    )


def from_wide(wide: DataFrame, years: Sequence[int]) -> DataFrame:
    """Wide table back to the array panel."""
    cells = _cells("{0}", "`{0}uc`", "`{0}est`", "`{0}dhcr`", "`{0}abat`", years)
    return wide.select("borough", "ucbbl", cells.alias("cells"), *PARCEL_COLUMNS)


def yearly_pairs(panel: DataFrame, *carry: str) -> DataFrame:
    """(lot, year, count of the year before, count of the year) for each pair of panel years."""
    later = F.slice("cells", 2, F.size("cells") - 1)
    pairs = F.zip_with(
        F.slice("cells", 1, F.size("cells") - 1), later,
        lambda a, b: F.struct(b["year"].alias("year"), a["uc"].alias("prev"), b["uc"].alias("cur")),
    )
    return panel.select("ucbbl", *carry, F.explode(pairs).alias("p")).select(
        "ucbbl", *carry, "p.year", "p.prev", "p.cur"
    )


def vanished_counts(panel: DataFrame) -> DataFrame:
    """Years in which a lot that had a count the year before reports none."""
    pairs = yearly_pairs(panel)
    return pairs.filter(F.col("prev").isNotNull() & F.col("cur").isNull()).select(
        "ucbbl", "year", F.col("prev").alias("last_count")
    )
