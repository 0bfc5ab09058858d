"""Lot identifiers: a 10-digit number, borough x 10^9 + block x 10^4 + lot."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Borough codes and the county name each borough number answers to.
BOROUGH_NUMBERS = {"MN": "1", "BX": "2", "BK": "3", "QN": "4", "SI": "5"}
COUNTY_NUMBERS = {"new york": 1, "bronx": 2, "kings": 3, "queens": 4, "richmond": 5}


def borough_of(bbl: Column) -> Column:
    return F.call_function("div", bbl, F.lit(1_000_000_000))


def block_of(bbl: Column) -> Column:
    return F.call_function("div", bbl, F.lit(10_000)) % 100_000


def lot_of(bbl: Column) -> Column:
    return bbl % 10_000


def pad(c: Column, width: int) -> Column:
    """Left-pad with zeros; longer text is kept whole."""
    text = c.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def borough_no(c: Column) -> Column:
    """Two-letter borough code to its number; anything else passes through."""
    found = c
    for code, number in BOROUGH_NUMBERS.items():
        found = F.when(c == code, F.lit(number)).otherwise(found)
    return found


def borough_code(number: Column) -> Column:
    text = number.cast("string")
    found = text
    for code, digit in BOROUGH_NUMBERS.items():
        found = F.when(text == digit, F.lit(code)).otherwise(found)
    return found


def county_borough(c: Column) -> Column:
    """County name (by prefix, any case) to borough number, NULL when unknown."""
    found = F.lit(None).cast("int")
    for county, number in COUNTY_NUMBERS.items():
        found = F.when(F.lower(c).startswith(county), F.lit(number)).otherwise(found)
    return found


def bbl_text(borough: Column, block: Column, lot: Column) -> Column:
    return F.concat(borough_no(borough), pad(block, 5), pad(lot, 4))


def bbl_number(borough: Column, block: Column, lot: Column) -> Column:
    return bbl_text(borough, block, lot).try_cast("bigint")


def is_condo_unit(bbl: Column) -> Column:
    """Condominium unit lots are numbered from 1000 up."""
    return lot_of(bbl) >= 1000
