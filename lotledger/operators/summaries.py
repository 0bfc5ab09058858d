"""Summaries of the filled panel: changes per lot, totals per group, selections of lots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotledger.functions.lots import borough_of
from lotledger.operators.panel import PARCEL_COLUMNS, cell_of
from lotledger.operators.quality import one_per

SPAN_CODES = ("j51", "421a", "scrie", "drie", "420c")


def abatement_span(code: str) -> Column:
    """``first - last`` year in which a lot's cells mention a code, NULL when none does."""
    hits = f"transform(filter(cells, c -> c.abat ILIKE '%{code}%'), c -> c.year)"
    return F.expr(f"concat(array_min({hits}), ' - ', array_max({hits}))")


def spans(panel: DataFrame, codes: Sequence[str] = SPAN_CODES) -> DataFrame:
    return panel.select("ucbbl", *[abatement_span(c).alias(c) for c in codes])


def changes_summary(panel: DataFrame, years: Sequence[int], first: int | None = None,
                    last: int | None = None) -> DataFrame:
    """Change per lot between two years; a missing count is 0. Needs no shuffle.

    The panel has one row per lot, so attributes need no aggregate.
    """
    first, last = first or years[0], last or years[-1]

    def at(year: int) -> Column:
        return F.greatest(F.coalesce(cell_of(years, year, "uc"), F.lit(0)), F.lit(0))

    largest = F.array_max(F.transform("cells", lambda c: c["uc"]))
    rest = [c for c in PARCEL_COLUMNS if c != "unitstotal"]
    position = rest.index("unitsres") + 1
    diff = F.col(f"unitsstab{last}") - F.col(f"unitsstab{first}")
    return (
        panel.withColumn("units", F.greatest("unitsres", "unitstotal", largest, F.lit(1)))
        .withColumn(f"unitsstab{first}", at(first))
        .withColumn(f"unitsstab{last}", at(last))
        .select(
            "ucbbl",
            F.col("units").alias("unitstotal"),
            f"unitsstab{first}",
            f"unitsstab{last}",
            diff.alias("diff"),
            F.round(diff / F.col("units") * 100, 2).alias("percentchange"),
            *[abatement_span(c).alias(c) for c in SPAN_CODES],
            *rest[:position],
            F.col("unitstotal").alias("unitstotalpluto"),
            *rest[position:],
        )
    )


def _sums(years: Sequence[int], shown: Sequence[int]) -> list[Column]:
    return [F.expr(f"sum(cells[{years.index(y)}].uc) AS `{y}`") for y in shown]


def totals(panel: DataFrame, by: str, years: Sequence[int],
           shown: Sequence[int] | None = None) -> DataFrame:
    """Total count per group, one column per year."""
    return panel.groupBy(by).agg(*_sums(years, shown or years))


def totals_long(panel: DataFrame) -> DataFrame:
    """Total count by borough number and year."""
    return (
        panel.select(borough_of(F.col("ucbbl")).alias("borough"), F.explode("cells").alias("c"))
        .groupBy("borough", F.col("c.year").alias("year"))
        .agg(F.sum("c.uc").alias("sum"))
    )


def yearly_deltas(sums: DataFrame, by: str, years: Sequence[int]) -> DataFrame:
    """Differences of neighbouring totals."""
    return sums.select(
        by, *[(F.col(str(y)) - F.col(str(p))).alias(str(y)) for p, y in zip(years, years[1:])]
    )


def change(panel: DataFrame, by: str, years: Sequence[int], first: int, last: int) -> DataFrame:
    """Totals of two years and the share lost."""
    start, end = F.sum(cell_of(years, first, "uc")), F.sum(cell_of(years, last, "uc"))
    return panel.groupBy(by).agg(start.alias("start"), end.alias("end")).withColumn(
        "change", 1 - F.try_divide(F.col("end").cast("double"), F.col("start"))
    )


def change_by_district(panel: DataFrame, years, first, last) -> DataFrame:
    return change(panel, "cd", years, first, last)


def change_by_borough(panel: DataFrame, years, first, last) -> DataFrame:
    numbered = panel.withColumn("borough_no", borough_of(F.col("ucbbl")))
    return change(numbered, "borough_no", years, first, last)


def growth(panel: DataFrame, by: str, years: Sequence[int], shown: Sequence[int]) -> DataFrame:
    """Totals of the shown years, then change and relative change from the first to the last."""
    first, last = str(shown[0]), str(shown[-1])
    diff = F.col(last) - F.col(first)
    return (
        totals(panel, by, years, shown)
        .withColumn("change", diff)
        .withColumn("percent", F.try_divide(diff.cast("double"), F.col(first)))
    )


def estimate_listing(panel: DataFrame, years: Sequence[int], shown: Sequence[int]) -> DataFrame:
    return panel.select(
        "ucbbl",
        *[cell_of(years, y, f).alias(f"{y}{f}") for y in shown for f in ("uc", "est")],
    )


def lots_in_zip(panel: DataFrame, zipcode: int, years: Sequence[int]) -> DataFrame:
    return totals(panel.filter(F.col("zipcode") == zipcode), "ucbbl", years)


def lot_counts(panel: DataFrame, bbl: int, years: Sequence[int]) -> DataFrame:
    return panel.filter(F.col("ucbbl") == bbl).select(
        "ucbbl", *[cell_of(years, y, "uc").alias(str(y)) for y in years]
    )


def complete_history(panel: DataFrame, years: Sequence[int], counted: Sequence[int],
                     coded: Sequence[int]) -> DataFrame:
    """Lots with a count in every ``counted`` year and, in every ``coded`` year, codes that
    neither end in 420c nor mention 421a. A year without codes removes the lot."""
    keep = F.lit(True)
    for y in counted:
        keep = keep & cell_of(years, y, "uc").isNotNull()
    for y in coded:
        abat = cell_of(years, y, "abat")
        keep = keep & ~abat.like("%420c") & ~abat.like("%421a%")
    return panel.filter(keep)


def not_monotone(panel: DataFrame, years: Sequence[int], shown: Sequence[int],
                 tolerance: int = 2) -> DataFrame:
    """Lots whose count grew by more than ``tolerance`` somewhere; undecidable lots drop out."""
    falling = F.lit(True)
    for y, following in zip(shown, shown[1:]):
        later = F.coalesce(cell_of(years, following, "uc"), F.lit(0))
        falling = falling & (cell_of(years, y, "uc") >= later - tolerance)
    return panel.filter(~falling)


def steep_drops(panel: DataFrame, years: Sequence[int], required: Sequence[int], least: int = 9,
                ratio: float = 0.5) -> DataFrame:
    """Lots that lost more than half of a count above ``least``, with ``droppercent``."""
    first, last = cell_of(years, required[0], "uc"), cell_of(years, required[-1], "uc")
    keep = F.lit(True)
    for y in required:
        keep = keep & cell_of(years, y, "uc").isNotNull()
    remaining = F.when(first > least, F.try_divide(last.cast("double"), first))
    return panel.filter(keep & (first > least) & (remaining < ratio)).withColumn(
        "droppercent", 1 - remaining
    )


def landmark_change(panel: DataFrame, landmarks: DataFrame, years: Sequence[int], first: int,
                    last: int, without: str | None = None) -> DataFrame:
    """Totals by district and historic status; ``without`` drops lots whose last-year codes
    mention it (and lots without codes)."""
    if without is not None:
        panel = panel.filter(~cell_of(years, last, "abat").like(f"%{without}%"))
    marks = one_per(landmarks.select(F.col("bbl").alias("mark_bbl"), "histdist", "landmark"), ["mark_bbl"])
    historic = F.col("histdist").isNotNull() | F.col("landmark").isNotNull()
    a, b = F.sum(cell_of(years, first, "uc")), F.sum(cell_of(years, last, "uc"))
    return (
        panel.join(marks, F.col("ucbbl") == F.col("mark_bbl"), "left")
        .groupBy("cd", historic.alias("ishist"))
        .agg(a.alias(str(first)), b.alias(str(last)))
        .withColumn(
            "change",
            F.try_divide((F.col(str(last)) - F.col(str(first))).cast("double"), F.col(str(first)))
            * 100,
        )
    )
