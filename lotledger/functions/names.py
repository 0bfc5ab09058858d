"""Document names, kinds, extensions and request addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The name of each document kind, most specific use first.
BILL = "Quarterly Property Tax Bill"
STATEMENT = "Quarterly Statement of Account"
NOTICE = "Notice of Property Value"
ROLL = "Tentative Assessment Roll"
WANTED_TYPES = (STATEMENT, BILL, NOTICE, ROLL)

# Billing days on which each document of a kind was published.
PERIODS_SOA_TEXT_BILL = (
    "20120608", "20121130", "20130222", "20130607", "20130823", "20131122", "20140221", "20140606",
    "20140822", "20141121", "20150220", "20150605", "20160219", "20160603", "20160826", "20161118",
    "20170224", "20170602", "20170825", "20171117", "20180223", "20180601",
)
PERIODS_SOA_TEXT_STATEMENT = (
    "20090606", "20090828", "20091120", "20100226", "20100611", "20100827", "20101119", "20110218",
    "20110610", "20110826", "20111118", "20120224",
)
PERIODS_SOA_HTML_STATEMENT = ("20080613", "20080822", "20081219", "20090220")
PERIODS_NOPV_HTML_YEARS = range(2005, 2010)
PERIODS_NOPV_PDF_YEARS = range(2010, 2019)
PERIODS_TAR_HTML_YEARS = range(2010, 2017)

MONTHS = (
    "January", "February", "March", "April", "May", "June", "July", "August", "September",
    "October", "November", "December",
)


def document_name(day: str, kind: str, extension: str) -> str:
    """``20170602`` -> ``June 2, 2017 - <kind>.<extension>``."""
    month = MONTHS[int(day[4:6]) - 1]
    return f"{month} {int(day[6:])}, {day[:4]} - {kind}.{extension}"


def known_periods() -> list[tuple[str, str, str]]:
    """(period, document type, document name) of every known publication."""
    groups = [
        (PERIODS_SOA_TEXT_BILL, "SOA", BILL, "pdf"),
        (PERIODS_SOA_TEXT_STATEMENT, "SOA", STATEMENT, "pdf"),
        (PERIODS_SOA_HTML_STATEMENT, "SOA", STATEMENT, "html"),
        ([f"{y}0115" for y in PERIODS_NOPV_HTML_YEARS], "NOPV", NOTICE, "html"),
        ([f"{y}0115" for y in PERIODS_NOPV_PDF_YEARS], "NOPV", NOTICE, "pdf"),
        ([f"{y}0115" for y in PERIODS_TAR_HTML_YEARS], "TAR", ROLL, "html"),
    ]
    return [
        (day, doc_type, document_name(day, kind, ext))
        for days, doc_type, kind, ext in groups
        for day in days
    ]


def document_kind(path: Column) -> Column:
    """``text`` (bill or statement), ``notice``, ``html`` (statement) or NULL; case matters."""
    text = path.contains(f"{BILL}.txt") | path.contains(f"{STATEMENT}.txt")
    notice = path.contains(f"{NOTICE}.txt") | path.contains(f"{NOTICE}.html")
    return (
        F.when(text, "text").when(notice, "notice").when(path.contains(f"{STATEMENT}.html"), "html")
    )


def folder(path: Column) -> Column:
    return F.regexp_extract(path, r"(?s)^(.*)/[^/]*$", 1)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(name: Column) -> Column:
    """A name without its last extension; a name without one is kept."""
    return F.regexp_replace(name, r"(?s)^(.+)\.[^.]*$", "$1")


def held_name(name: Column) -> Column:
    """The published name a held file stands for: text of a PDF, or one saved with a doubled ``.pdf``."""
    single = F.regexp_replace(name, r"\.(pdf|html)\.pdf$", ".$1")
    return F.regexp_replace(single, r"\.txt$", ".pdf")


def extension(content_type: Column) -> Column:
    return F.when(content_type.contains("html"), "html").when(content_type.contains("pdf"), "pdf")


def request_address(base: str, bbl: Column, period: Column, doc_type: Column) -> Column:
    return F.concat(
        F.lit(f"{base}?bbl="), bbl.cast("string"), F.lit("&stmtDate="), period,
        F.lit("&stmtType="), doc_type,
    )
