"""Text helpers: whitespace cells, amounts, whole numbers and dates.

Java and Python disagree on two points that matter for bill text, so every pattern here is
explicit about them: ``(?d)`` makes ``.`` stop at a line feed only, and ``strip`` removes every
ASCII white-space character, not just blanks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITE_SPACE = " \t\n\x0b\f\r"
CELL_GAP = r"\s{2,}"
CELL_GAP_X = r"[\sX$]{2,}"
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"  # a cast takes the blanks away
WHOLE = r"^\s*[+-]?\d+\s*$"

# The date spellings that bills use, each with the shape that selects it.
DATE_FORMATS = {
    "M/d/yyyy": r"^\d{1,2}/\d{1,2}/\d{4}$",
    "M/d/yy": r"^\d{1,2}/\d{1,2}/\d{2}$",
    "M-d-yyyy": r"^\d{1,2}-\d{1,2}-\d{4}$",
    "MMMM d, yyyy": r"^([A-Za-z]{4,}|May) \d{1,2}, \d{4}$",
    "MMM d, yyyy": r"^(?!May)[A-Za-z]{3} \d{1,2}, \d{4}$",
    "d MMMM yyyy": r"^\d{1,2} ([A-Za-z]{4,}|May) \d{4}$",
    "d MMM yyyy": r"^\d{1,2} (?!May)[A-Za-z]{3} \d{4}$",
    "yyyy-MM-dd": r"^\d{4}-\d{2}-\d{2}$",
}


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITE_SPACE))


def cells(c: Column, with_x: bool = False) -> Column:
    """Split a line wherever two or more blanks meet (``with_x``: blanks, ``X`` or ``$``)."""
    return F.split(strip(c), CELL_GAP_X if with_x else CELL_GAP)


def cell(c: Column, i: int) -> Column:
    """The i-th cell, NULL when absent; negative positions count from the end."""
    return F.try_element_at(c, F.lit(i)) if i < 0 else F.get(c, F.lit(i))


def tokens(c: Column) -> Column:
    return F.split(strip(c), r"\s+")


def amount(c: Column) -> Column:
    """``-$24,705.75`` as a double; NULL when it is not a number."""
    clean = F.translate(c, ",$*X", "")
    return F.when(clean.rlike(NUMBER), clean.try_cast("double"))


def number_text(c: Column) -> Column:
    """A double as plain text with at least one decimal (``100.0``), never in powers of ten.

    One spelling for every size: the shortest digits that name the number, without trailing zeros.
    """
    size = F.abs(c)
    short = (size >= 1e-3) & (size < 1e7) | (size == 0)  # where a cast gives this form
    long = F.regexp_replace(F.format_string("%.340f", c), r"(\.\d+?)0+$", "$1")
    return F.when(short, c.cast("string")).when(c.isNotNull(), long)


def amount_text(c: Column) -> Column:
    """``-$24,705.75`` as ``-24705.75``, see ``amount`` and ``number_text``; the number is made once."""
    return F.get(F.transform(F.array(amount(c)), number_text), F.lit(0))


def money(c: Column) -> Column:
    """Currency text as DECIMAL(19,2)."""
    return strip(F.translate(c, "$,", "")).try_cast("decimal(19,2)")


def whole(c: Column) -> Column:
    return F.when(c.rlike(WHOLE), c.try_cast("int"))


def bill_date(c: Column, formats: Mapping[str, str] = DATE_FORMATS, spelled: bool = True) -> Column:
    """A date in one of the formats, else (``spelled``) by the grammar of ``spelled_date``, else NULL.

    Only the format whose shape fits is tried: a failed attempt costs far more than a match. The
    first format is the first one tested, so the usual one should lead.
    """
    text, found = strip(c), F.lit(None).cast("timestamp")
    for form, shape in reversed(formats.items()):
        found = F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(form))).otherwise(found)
    found = F.coalesce(found, spelled_date(text)) if spelled else found
    return F.when(c.rlike("[0-9]"), found).cast("date")  # words without a digit need no further test


# Token classes of dates. A month is a name or its abbreviation; weekdays, the endings of ordinals
# and small words carry nothing; blanks and marks between tokens separate.
MONTH = r"jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?"
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
IDLE = (r"(?<![a-z])(?:mon|tues?|wed(?:nes)?|thu(?:rs?)?|fri|sat(?:ur)?|sun)(?:day)?(?![a-z])"
        r"|(?<=[0-9])(?:st|nd|rd|th)(?![a-z])|(?<![a-z])(?:of|the)(?![a-z])")
BETWEEN = r"[\s,./-]+"

# What three tokens mean, by their classes: places of year, month and day. The first rule that fits
# holds, so numbers are month first unless the first one cannot be a month.
DATE_RULES = [
    (rf"^(?:{MONTH}) [0-9]{{1,2}} (?:[0-9]{{4}}|[0-9]{{2}})$", (2, 0, 1)),
    (rf"^[0-9]{{1,2}} (?:{MONTH}) (?:[0-9]{{4}}|[0-9]{{2}})$", (2, 1, 0)),
    (rf"^[0-9]{{4}} (?:{MONTH}) [0-9]{{1,2}}$", (0, 1, 2)),
    (r"^[0-9]{4} [0-9]{1,2} [0-9]{1,2}$", (0, 1, 2)),
    (r"^(?:0?[1-9]|1[0-2]) [0-9]{1,2} [0-9]{4}$", (2, 0, 1)),
    (r"^[0-9]{1,2} [0-9]{1,2} [0-9]{4}$", (2, 1, 0)),
]


def spelled_date(text: Column) -> Column:
    """A date spelled in any order that ``DATE_RULES`` knows, as a timestamp; NULL otherwise.

    Text with a month's name and digits, or three numbers with one kind of mark between them, is
    looked at; years of two digits are of this century, and only stand next to a month's name.
    Days that do not exist and text with any other word are no dates.
    """
    low = F.lower(text)
    likely = low.rlike(r"^[a-z0-9].*[0-9]") & low.rlike(rf"(?<![a-z])(?:{MONTH})(?![a-z])") | low.rlike(
        r"^[0-9]{1,4}([/.-])[0-9]{1,2}\1[0-9]{1,4}$")
    plain = F.btrim(F.regexp_replace(F.regexp_replace(low, IDLE, " "), BETWEEN, " "))
    part = F.split(plain, " ")

    def year(c: Column) -> Column:
        return F.when(F.length(c) == 2, F.concat(F.lit("20"), c)).otherwise(c)

    def month(c: Column) -> Column:
        return F.when(c.rlike("^[0-9]"), c).otherwise(
            F.array_position(F.array(*map(F.lit, MONTHS)), F.substring(c, 1, 3)).cast("string"))

    found = F.lit(None).cast("string")
    for shape, (y, m, d) in reversed(DATE_RULES):
        found = F.when(plain.rlike(shape), F.concat_ws(
            "-", year(part[y]), month(part[m]), part[d])).otherwise(found)
    return F.when(likely, F.try_to_timestamp(found, F.lit("yyyy-M-d")))


def contains_any(c: Column, words: Sequence[str]) -> Column:
    test = F.lit(False)
    for word in words:
        test = test | c.contains(word)
    return test
