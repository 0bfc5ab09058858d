"""Documents read in Python, a batch of them at a time: the rows and rejects that the columns of ``extract`` name.

Each step of those columns is one turn of a loop over the lines here. Patterns are the same ones; where a
pattern would try many places of a long text, its fixed words are looked up instead. Dates are read in the
given formats if it ``knows`` them. The module calls no other code of the package and goes to the workers
by value, so these need nothing of it installed.
"""

from __future__ import annotations

import datetime
import re
import sys
from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyspark import cloudpickle

from lotledger.functions.text import (
    BETWEEN,
    CELL_GAP,
    CELL_GAP_X,
    DATE_FORMATS,
    DATE_RULES,
    IDLE,
    MONTH,
    MONTHS,
    NUMBER,
    WHITE_SPACE,
    WHOLE,
)
from lotledger.operators.phrases import (
    BLOCK_STEP,
    BRANCHES,
    CHARGE_HEADINGS,
    EXPENSES,
    GAP_STARTS,
    HTML_BLOCK,
    HTML_OWNER,
    HTML_RENT,
    INCOME,
    MODES,
    NOTES,
    RENT_KEY,
    WHOLE_BRANCHES,
)

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DOCUMENTS = 500  # whose rows are made at once

Dates = Callable[[str | None], int | None]


def _pattern(java: str, more: int = 0) -> re.Pattern:
    """A pattern of the columns: classes are of ASCII, and ``.`` stops at a line feed only (``(?d)``)."""
    flags, body = re.fullmatch(r"(?s)(?:\(\?([isd]+)\))?(.*)", java).groups()
    named = {"i": re.I, "s": re.S, "d": 0}
    return re.compile(body, re.A | more | sum(named[f] for f in flags or ""))


_GAP, _GAP_X, _BLANKS = _pattern(CELL_GAP), _pattern(CELL_GAP_X), _pattern(r"\s+")
FOR_SPARK = "\0"  # a number follows
_NUMBER, _WHOLE = _pattern(NUMBER[:-1] + r"\Z"), _pattern(WHOLE[:-1] + r"\Z")


# -- numbers and dates


def amount(text: str | None) -> float | None:
    if text is None:
        return None
    clean = text.replace(",", "").replace("$", "").replace("*", "").replace("X", "")
    return float(clean) if _NUMBER.match(clean) else None


def number_text(number: float | None) -> str | None:
    """The shortest digits that name the number, with at least one decimal, never in powers of ten.

    Versions of Java differ in the digits of very large and small numbers: these are left to Spark (``spelled``).
    """
    if number is None:
        return None
    text = repr(number)
    return FOR_SPARK + text if "e" in text or "." not in text else text


def amount_text(text: str | None) -> str | None:
    return number_text(amount(text))


def whole(text: str | None) -> str | None:
    if text is None or not _WHOLE.match(text):
        return None
    number = int(text.strip(WHITE_SPACE))
    return str(number) if -(2**31) <= number < 2**31 else None


_EPOCH = datetime.date(1970, 1, 1).toordinal()
_FULL = {m.lower(): i for i, m in enumerate((
    "January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November",
    "December"), 1)}
_SHORT = {m: i for i, m in enumerate(MONTHS, 1)}
_PLACES = {  # the shape with year, month and day as groups, their places, and what the month is
    "M/d/yyyy": (r"(\d{1,2})/(\d{1,2})/(\d{4})", 3, 1, 2, None),
    "M/d/yy": (r"(\d{1,2})/(\d{1,2})/(\d{2})", 3, 1, 2, None),
    "M-d-yyyy": (r"(\d{1,2})-(\d{1,2})-(\d{4})", 3, 1, 2, None),
    "MMMM d, yyyy": (r"([A-Za-z]{4,}|May) (\d{1,2}), (\d{4})", 3, 1, 2, _FULL),
    "MMM d, yyyy": (r"((?!May)[A-Za-z]{3}) (\d{1,2}), (\d{4})", 3, 1, 2, _SHORT),
    "d MMMM yyyy": (r"(\d{1,2}) ([A-Za-z]{4,}|May) (\d{4})", 3, 2, 1, _FULL),
    "d MMM yyyy": (r"(\d{1,2}) ((?!May)[A-Za-z]{3}) (\d{4})", 3, 2, 1, _SHORT),
    "yyyy-MM-dd": (r"(\d{4})-(\d{2})-(\d{2})", 1, 2, 3, None),
}


def knows(formats: Mapping[str, str]) -> bool:
    """Whether all these formats, with these shapes, are read here."""
    return all(form in _PLACES and DATE_FORMATS.get(form) == shape for form, shape in formats.items())


def _days(year: int, month: int | None, day: int) -> int | None:
    """Days since 1970, NULL for a day that does not exist; there is a year 0."""
    try:
        if year:
            return datetime.date(year, month, day).toordinal() - _EPOCH
        return datetime.date(400, month, day).toordinal() - 146_097 - _EPOCH
    except (TypeError, ValueError):
        return None


_ANY = r"[^\n\r\u0085\u2028\u2029]"  # what a dot is for Java
_STARTS, _NAMED = re.compile(rf"[a-z0-9]{_ANY}*[0-9]"), re.compile(rf"(?<![a-z])(?:{MONTH})(?![a-z])")
_THREE = re.compile(r"[0-9]{1,4}([/.-])[0-9]{1,2}\1[0-9]{1,4}")
_IDLE, _BETWEEN = re.compile(IDLE), _pattern(BETWEEN)
_RULES = [(re.compile(shape[1:-1]), places) for shape, places in DATE_RULES]


def _spelled(text: str) -> int | None:
    low = text.lower()
    if not (_STARTS.match(low) and _NAMED.search(low)) and not _THREE.fullmatch(low):
        return None
    plain = _BETWEEN.sub(" ", _IDLE.sub(" ", low)).strip(" ")
    for shape, (y, m, d) in _RULES:
        if shape.fullmatch(plain):
            part = plain.split(" ")
            year, month = part[y], part[m]
            return _days(int(year) + (2000 if len(year) == 2 else 0),
                         int(month) if month.isdigit() else _SHORT[month[:3]], int(part[d]))
    return None


def dates_in(formats: Mapping[str, str]) -> Dates:
    """A function that reads a date in these formats, else by ``DATE_RULES``, as days since 1970."""
    known = []
    for form in formats:
        shape, y, m, d, names = _PLACES[form]
        known.append((_pattern(shape).fullmatch, y, m, d, names, 2000 if form.endswith("/yy") else 0))

    def read(text: str | None) -> int | None:
        if text is None:
            return None
        text, found = text.strip(WHITE_SPACE), None
        for shape, y, m, d, names, century in known:
            if part := shape(text):
                month = names.get(part[m].lower()) if names else int(part[m])
                found = _days(int(part[y]) + century, month, int(part[d]))
                break
        return _spelled(text) if found is None else found

    return read


# -- bills


def _lower(text: str) -> str:
    """Letters of ASCII in lower case, so that every character keeps its place."""
    return text.lower() if text.isascii() else text.encode().lower().decode()


def _last(low: str, word: str, pattern: re.Pattern) -> int:
    """Where the last match of a pattern that begins with the word starts, -1 without one."""
    at = low.rfind(word)
    while at >= 0 and not pattern.match(low, at):
        at = low.rfind(word, 0, at + len(word) - 1)
    return at


_OWNER, _ADDRESS, _LOT = "owner name:", "property address:", "borough, block & lot:"
_OWNER_ENDS = [(w, _pattern(p)) for w, p in (
    ("outstanding", r"outstanding\s+charges"), ("statement", r"statement\s+billing\s+summary"))]


def _owner_parts(text: str, low: str) -> list[str] | None:
    """The three parts of the owner area (``OWNER_AREA``)."""
    start, end = low.find(_OWNER), max(_last(low, *e) for e in _OWNER_ENDS)
    if start < 0 or end < 0:
        return None
    behind = start + len(_OWNER)
    lot = low.rfind(_LOT, behind, end)
    address = low.rfind(_ADDRESS, behind, lot) if lot >= 0 else -1
    if address < 0:
        return None
    return [text[behind:address], text[address + len(_ADDRESS):lot], text[lot + len(_LOT):end]]


_DETAIL_HEADINGS, _DETAIL_END = ("annual property tax detail", "how we calculated your property tax"), "annual property tax"


def _detail_area(text: str, low: str) -> str | None:
    """The area of the tax detail (``DETAIL_AREA``)."""
    starts = [(at, at + len(h)) for h in _DETAIL_HEADINGS if (at := low.find(h)) >= 0]
    feed = text.rfind("\n")
    if not starts or feed < 0:
        return None
    start, behind = min(starts)
    last = low.rfind(_DETAIL_END, behind, feed)
    return None if last < 0 else text[start:text.index("\n", last + len(_DETAIL_END)) + 1]


_CHARGE_START = _pattern(rf"(?:{'|'.join(CHARGE_HEADINGS)})[ \n\r]+Activity Date")
_CHARGE_END = _pattern(r"(?:Total|Unpaid Balance, [iI]f Any)[\S ]*")


def _charge_blocks(text: str) -> Iterator[str]:
    """The charge blocks, one after the other (``CHARGE_BLOCK``)."""
    at = 0
    while (start := _CHARGE_START.search(text, at)) and (end := _CHARGE_END.search(text, start.end())):
        at = end.end()
        yield text[start.start():at]


_PREFIXES = tuple(BRANCHES)
_SUFFIXES = (" units", " unit")


def _branch(c0: str) -> str:
    """What a line of the tax detail is, before modes, by its first cell."""
    if c0 in WHOLE_BRANCHES:
        return WHOLE_BRANCHES[c0]
    if c0.startswith(_PREFIXES):
        for start in BRANCHES:
            if c0.startswith(start):
                return BRANCHES[start]
    return "by mode"


def _read_detail(area: str, doc: int, rows: list) -> tuple | None:
    """Adds the rows of the tax detail, through the first unreadable line, which is returned."""
    carried, modes = "details", []  # the modes of the lines so far, as they are in MODES
    for nr, line in enumerate(area.split("\n")):
        if not nr or not line:
            continue
        x = _GAP_X.split(line.strip(WHITE_SPACE))
        c0, before = x[0].lower(), modes
        own = _branch(c0)
        if own in MODES and own not in modes:
            modes = [m for m in MODES if m == own or m in modes]
        if own in ("none", "revocation") or (own == "by mode" and len(x) < 2 and not before):
            continue
        mode = own if own != "by mode" else MODES[before[0]] if before else "plain"
        if mode not in ("class", "second", "second raw"):
            carried = mode if mode.startswith("details-") else "details"
        elif not before:
            carried = "details"
        number = meta = units = value = None
        key, last, must_meta = c0, x[-1], False
        if mode == "class":
            key, value = "tax class", c0.split("tax class")[1]
        elif mode == "second raw":
            value = x[1] if len(x) > 1 else None
        elif mode == "original":
            key, value, meta = "original tax rate", last, c0.split("original tax rate")[1]
        elif mode == "last raw":
            value = last
        else:
            number = last if mode != "second" else x[1] if len(x) > 1 else None
            value = amount_text(number)
            if mode in ("before exemptions", "before abatements"):
                meta, must_meta = amount_text(x[1] if len(x) > 1 else None), True
            elif mode in ("details-abatements", "details-exemptions") and len(x) > 2:
                second = x[1].lower()
                if "unit" in second:
                    units = second.replace(" units", "").replace(" unit", "")
                meta, must_meta = amount_text(x[2] if units is not None or x[1].endswith("%") else x[1]), True
        bad = value is None or (must_meta and meta is None)
        apts, must_apts = whole(units), units is not None
        if key.endswith(_SUFFIXES):
            for suffix in _SUFFIXES:
                if key.endswith(suffix):
                    words = key.replace(suffix, "").split(" ")
                    bad |= must_apts and apts is None
                    apts, must_apts, key = whole(words[-1]), True, " ".join(words[:-1])
        if bad or (must_apts and apts is None):
            return doc, "line", 0, nr, line
        rows.append((doc, nr, carried, key, None, None, value, meta, apts))
    return None


def _read_block(content: str, block: int, doc: int, rows: list, dates: Dates) -> tuple | None:
    """Adds the rows of a charge block, through the first unreadable line, which is returned."""
    lines = content.split("\n")
    if len(lines) < 2:
        return None
    heading, due, in_break = _GAP.split(lines[0].strip(WHITE_SPACE))[0], None, False
    for nr in range(1, len(lines)):
        line = lines[nr]
        c = _GAP.split(line.strip(WHITE_SPACE))
        c0, n = c[0], len(c)
        if in_break:
            in_break = c[-1] != "Amount"
            continue
        start = c0.lower()
        if nr == 2 and start.startswith("activity date"):
            continue
        if line.startswith(("\f", "\v")) or start.startswith(GAP_STARTS):
            in_break = True
            continue
        rent = c0 == RENT_KEY
        if ((n == 1 and not c0) or "rent stabilization fee" in start or c0.startswith("Activity Date")
                or (not 2 <= n <= 4 and not rent and any(w in line for w in NOTES))):
            continue
        key = value = meta = apts = day = own_due = None
        bad = False
        if rent:
            t = _BLANKS.split(line.strip(WHITE_SPACE))
            k = len(t)
            key, value = c0, amount_text(t[-1])
            own_due = dates(t[3] if k > 5 else t[2] if k == 4 else None)
            bad = k < 4 or k == 5 or own_due is None or value is None
            if k > 5:
                apts, meta = whole(t[2]), " ".join(t[4:-1])
                bad |= apts is None
        elif 2 <= n <= 4:
            key, value = c0, amount_text(c[-1])
            bad = value is None
            if n > 2:
                day = dates(c[1])
                no_day = day is None
                if n == 4:
                    later = dates(c[2]) if no_day else None
                    meta, bad, day = (c[1], bad or later is None, later) if no_day else (c[2], bad, day)
                elif no_day:
                    meta = c[1]
        if bad:
            return doc, "line", block, nr, line
        if own_due is not None:
            due = own_due
        rows.append((doc, block * BLOCK_STEP + nr, heading, key, due, day, value, meta, apts))
    return None


def _read_bill(text: str, doc: int, rows: list, rejects: list, dates: Dates, charges: bool) -> None:
    low = _lower(text)
    parts = _owner_parts(text, low)
    if parts is None:
        rejects.append((doc, "owner", None, None, None))
        return
    found = [_GAP.split(p.strip(WHITE_SPACE)) for p in parts]
    mailing = "\\n".join([c[1] if len(c) > 1 else "" for c in found])
    rows.append((doc, -2, None, "Owner name", None, None, found[0][0], None, None))
    rows.append((doc, -1, None, "Mailing address", None, None, mailing.strip(WHITE_SPACE), None, None))
    area = _detail_area(text, low)
    reject = None if area is None else _read_detail(area, doc, rows)
    if charges and reject is None:
        for block, content in enumerate(_charge_blocks(text), 1):
            if (reject := _read_block(content, block, doc, rows, dates)) is not None:
                break
    if reject is not None:
        rejects.append(reject)


# -- statements and notices


_HTML_BLOCK, _HTML_RENT, _HTML_OWNER = map(_pattern, (HTML_BLOCK, HTML_RENT, HTML_OWNER))
_ESTIMATES = [(_pattern(p), key) for p, key in ((INCOME, "gross income"), (EXPENSES, "expenses"))]


def _read_statement(text: str | None, doc: int, rows: list, rejects: list, dates: Dates, as_run: bool) -> None:
    owner = _HTML_OWNER.search(text) if text is not None else None
    if owner is None:
        rejects.append((doc, "owner", None, None, None))
        return
    rows.append((doc, -2, None, "Owner name", None, None, owner[1].strip(WHITE_SPACE), None, None))
    nr = 0
    for section in _HTML_BLOCK.finditer(text[16:] if as_run else text):
        for found in _HTML_RENT.finditer(section[0]):
            t = _BLANKS.split(found[1].strip(WHITE_SPACE))
            due = dates(t[3]) if len(t) == 7 else None
            if due is None:
                rejects.append((doc, "row", None, nr, " ".join(t)))
                return
            rows.append((doc, nr, section[1], f"{t[0]} {t[1]}", due, None, t[6], f"{t[4]} {t[5]}", t[2]))
            nr += 1


def _read_notice(text: str, doc: int, rows: list, rejects: list) -> None:
    hidden = False  # an unreadable income also hides the expenses
    for nr, (pattern, key) in enumerate(_ESTIMATES):
        found = pattern.search(text)
        if found is None:
            continue
        printed = found[1] or found[2] or None
        number = amount(printed)
        if number is None:
            rejects.append((doc, "amount", None, nr, printed))
            hidden = True
        elif not hidden:
            rows.append((doc, nr, "nopv", key, None, None, number_text(number), None, None))


# -- batches


def _columns(found: list, kinds: list[pa.DataType]) -> list[pa.Array]:
    columns = zip(*found) if found else [()] * len(kinds)
    return [pa.array(c, pa.int32()).cast(k) if k == pa.date32() else pa.array(c, k) for c, k in zip(columns, kinds)]


_ROW = {"line_no": pa.int64(), "section": pa.string(), "key": pa.string(), "duedate": pa.date32(), "activitydate": pa.date32(),
        "value": pa.string(), "meta": pa.string(), "apts": pa.string()}
_REJECT = {"reason": pa.string(), "block": pa.int32(), "reject_line": pa.int32(), "line": pa.string()}


def _part(batch: pa.RecordBatch, found: list, kinds: Mapping[str, pa.DataType], names: list[str], row: bool) -> pa.RecordBatch:
    docs, *own = _columns(found, [pa.int32(), *kinds.values()])
    made = dict(zip(kinds, own))
    for name, source in (("bbl", "bbl"), ("doc_path", "path"), ("kind", "kind"), ("activitythrough", "activity_through")):
        if row or name != "activitythrough":
            made[name] = batch.column(source).take(docs)
    nulls = {**_ROW, **_REJECT, "activitythrough": pa.date32()}
    return pa.RecordBatch.from_arrays([made[n] if n in made else pa.nulls(len(docs), nulls[n]) for n in names], names)


def read_batch(batch: pa.RecordBatch, names: list[str], dates: Dates, as_run: bool, charges: bool) -> Iterator[pa.RecordBatch]:
    """The rows of these documents, then what could not be read, with columns of these names."""
    rows, rejects = [], []
    dated = batch.column("activity_through").is_valid().to_pylist()
    for doc, (kind, raw) in enumerate(zip(batch.column("kind").to_pylist(), batch.column("text").to_pylist())):
        if not dated[doc]:
            rejects.append((doc, "date", None, None, None))
            continue
        # Bytes that are no text become the same sign as in the columns.
        text = None if raw is None else raw.decode("utf-8", "replace")
        if kind == "html":
            _read_statement(text, doc, rows, rejects, dates, as_run)
        elif text is None:
            continue
        elif kind == "text":
            _read_bill(text, doc, rows, rejects, dates, charges)
        elif kind == "notice":
            _read_notice(text, doc, rows, rejects)
    if rows:
        yield _part(batch, rows, _ROW, names, True)
    if rejects:
        yield _part(batch, rejects, _REJECT, names, False)


def reader(names: list[str], formats: Mapping[str, str], as_run: bool, charges: bool) -> Callable:
    """A function over batches of documents, for ``mapInArrow``; ``text`` comes as bytes."""
    formats = dict(formats)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dates = dates_in(formats)
        for batch in batches:
            for start in range(0, batch.num_rows, DOCUMENTS):
                yield from read_batch(batch.slice(start, DOCUMENTS), names, dates, as_run, charges)

    return read
