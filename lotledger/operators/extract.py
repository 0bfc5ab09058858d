"""Bills, statements and value notices to key/value rows.

Input: one row per document, ``path, bbl, activity_through, kind, text``. The areas of interest
are cut out of a text by pattern and split into lines, which never leave their document: nothing is
shuffled, and a document is a single input row, so its lines always fit a task. ``read_all`` does so
in Python (``reading``), ``read_columns`` in columns: there the lines are an array, each step is a pass over
it, and what a line hands on to those after it (mode, section, page gap, due date, first error) is
the state of a fold. Spark interprets these passes, which takes several times as long.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotledger.functions.arrays import Lines, running
from lotledger.functions.text import (
    DATE_FORMATS,
    amount,
    amount_text,
    bill_date,
    cell,
    cells,
    contains_any,
    number_text,
    strip,
    tokens,
    whole,
)
from lotledger.operators import reading
from lotledger.operators.phrases import (
    ACTIVITY_THROUGH,
    BLOCK_STEP,
    BRANCH,
    BRANCHES,
    CHARGE_BLOCK,
    DETAIL_AREA,
    EXPENSES,
    GAP_STARTS,
    HTML_BLOCK,
    HTML_OWNER,
    HTML_RENT,
    INCOME,
    MODES,
    NOTES,
    OWNER_AREA,
    OWNER_PART,
    RENT_KEY,
    WHOLE_BRANCHES,
)

DOCUMENT = ["path", "bbl", "activity_through"]
ROW_COLUMNS = [
    "bbl", "activitythrough", "section", "key", "duedate", "activitydate", "value", "meta", "apts",
    "doc_path", "line_no",
]


def _text() -> Column:
    return F.lit(None).cast("string")


def _date() -> Column:
    return F.lit(None).cast("date")


def _row(section, key, value, line_no, duedate=None, activitydate=None, meta=None,
         apts=None) -> list[Column]:
    return [
        "bbl",
        F.col("activity_through").alias("activitythrough"),
        (_text() if section is None else section).alias("section"),
        key.alias("key"),
        (_date() if duedate is None else duedate).alias("duedate"),
        (_date() if activitydate is None else activitydate).alias("activitydate"),
        value.alias("value"),
        (_text() if meta is None else meta).alias("meta"),
        (_text() if apts is None else apts).alias("apts"),
        F.col("path").alias("doc_path"),
        line_no.cast("bigint").alias("line_no"),
    ]


def _of_kind(docs: DataFrame, kind: str) -> DataFrame:
    return docs.filter((F.col("kind") == kind) & F.col("activity_through").isNotNull())


def activity_date(docs: DataFrame) -> DataFrame:
    """Date printed on a bill or statement (the file name is what the rows use)."""
    found = [F.nullif(F.regexp_extract("text", p, 1), F.lit("")) for p in ACTIVITY_THROUGH]
    return docs.select("path", bill_date(F.coalesce(*found)).alias("printed_through"))


#: What is read of a document, row or reject, in one form: a reject has a ``reason``, or ``bad`` or one
#: of the fields that it ``must`` have is missing. Rows and rejects outside the blocks of a bill have no ``block``.
_ENTRY = {"block": "int", "line_no": "int", "line": "string", "section": "string", "key": "string", "duedate": "date",
          "activity": "date", "value": "string", "meta": "string", "apts": "string", "reason": "string", "bad": "boolean",
          "must_value": "boolean", "must_meta": "boolean", "must_apts": "boolean"}


def _entry(**given: Column) -> Column:
    return F.struct(*[(given[n] if n in given else F.lit(False) if kind == "boolean" else F.lit(None)).cast(kind).alias(n)
                      for n, kind in _ENTRY.items()])


def _is_bad(e: Column) -> Column:
    return (e["bad"] | (e["must_value"] & e["value"].isNull()) | (e["must_meta"] & e["meta"].isNull())
            | (e["must_apts"] & e["apts"].isNull()))


def _made_row(reason=None, **given: Column) -> Column:
    """A row that is read inside its document, or the reject that stands for it (``reason``)."""
    return _entry(**given, **({} if reason is None else {"reason": F.lit(reason)}))


def _html_found(as_run: bool) -> Column:
    text = F.expr("substring(text, 17)") if as_run else F.col("text")
    sections = F.regexp_extract_all(text, F.lit(HTML_BLOCK), F.lit(0))
    return F.flatten(F.transform(sections, lambda content: F.transform(
        F.regexp_extract_all(content, F.lit(HTML_RENT), F.lit(1)),
        lambda line: F.struct(F.regexp_extract(content, HTML_BLOCK, 1).alias("section"), tokens(line).alias("t")),
    )))


def _html_owner() -> Column:
    return F.when(F.col("text").rlike(HTML_OWNER), strip(F.regexp_extract("text", HTML_OWNER, 1)))


def _statement_rows(as_run: bool, formats: Mapping[str, str]) -> Column:
    """Rows of a statement behind its owner, up to the first unreadable one, which follows as a reject."""
    def due(r: Column) -> Column:
        day = F.when(F.size(r["t"]) == 7, bill_date(F.get(r["t"], F.lit(3)), formats))
        return F.struct(r["section"].alias("section"), r["t"].alias("t"), day.alias("due"))

    def rent(r: Column, i: Column) -> Column:
        t = r["t"]
        return F.when(r["due"].isNull(), _made_row(line_no=i, reason="row", line=F.array_join(t, " "))).otherwise(_made_row(
            section=r["section"], key=F.concat_ws(" ", cell(t, 0), cell(t, 1)), value=cell(t, 6), line_no=i,
            duedate=r["due"], meta=F.concat_ws(" ", cell(t, 4), cell(t, 5)), apts=cell(t, 2)))

    def up_to_reject(rows: Column) -> Column:
        at = F.array_position(F.transform(rows, lambda r: r["reason"].isNotNull()), True)
        return F.when(at > 0, F.slice(rows, F.lit(1), at)).otherwise(rows)

    rows = F.transform(F.transform(_html_found(as_run), due), rent)
    # One element, so that the rows are made once for both uses of them.
    return F.flatten(F.transform(F.array(rows), up_to_reject))


def _made(docs: DataFrame, as_run: bool, formats: Mapping[str, str]) -> DataFrame:
    """One row per document with ``owner_area`` (bills) and ``made``: rows and rejects of
    statements and notices, and rejects of documents that cannot be read at all.

    A pattern is only evaluated for documents of its kind.
    """
    kind, dated = F.col("kind"), F.col("activity_through").isNotNull()
    html, notice = dated & (kind == "html"), dated & (kind == "notice")
    staged = docs.select(
        *DOCUMENT, "kind", "text",
        F.when(dated & (kind == "text"), _owner_area()).alias("owner_area"),
        F.when(html, _html_owner()).alias("owner"),
        *[c.alias(f"{name}_{part}") for name, pattern in (("income", INCOME), ("expenses", EXPENSES))
          for part, c in (("has", F.when(notice, F.col("text").rlike(pattern))), ("printed", F.when(notice, _estimate(pattern))))],
    ).withColumns({"income": amount(F.col("income_printed")), "expenses": amount(F.col("expenses_printed"))})
    none = F.slice(F.array(_made_row()), 1, 0)
    statement = F.when(F.col("owner").isNull(), F.array(_made_row(reason="owner"))).otherwise(F.concat(
        F.array(_made_row(key=F.lit("Owner name"), value=F.col("owner"), line_no=F.lit(-2))),
        _statement_rows(as_run, formats),
    ))

    def estimate(name: str, key: str, i: int, hidden: Column) -> Column:
        has, number = F.col(f"{name}_has"), F.col(name)
        return F.when(number.isNotNull() & ~hidden, F.array(_made_row(
                section=F.lit("nopv"), key=F.lit(key), value=number_text(number), line_no=F.lit(i)))).when(
            has & number.isNull(), F.array(_made_row(line_no=F.lit(i), reason="amount", line=F.col(f"{name}_printed")))).otherwise(none)

    hides = F.col("income_has") & F.col("income").isNull()
    value_rows = F.concat(estimate("income", "gross income", 0, F.lit(False)), estimate("expenses", "expenses", 1, hides))
    made = (
        F.when(~dated, F.array(_made_row(reason="date")))
        .when(kind == "html", statement)
        .when(kind == "notice", value_rows)
        .when((kind == "text") & (F.col("owner_area") == ""), F.array(_made_row(reason="owner")))
        .otherwise(none)
    )
    return staged.select(*DOCUMENT, "kind", "text", "owner_area", made.alias("made"))


def _owner_area() -> Column:
    return F.regexp_extract(F.regexp_extract("text", OWNER_PART, 0), OWNER_AREA, 0)


def _owner_lines() -> Column:
    """Owner, and mailing address with its three lines joined by a literal backslash-n."""
    parts = [cells(F.regexp_extract("owner_area", OWNER_AREA, i)) for i in (1, 2, 3)]
    mailing = F.concat_ws("\\n", *[F.coalesce(cell(p, 1), F.lit("")) for p in parts])
    return F.array(cell(parts[0], 0), strip(mailing))


def document_lines(docs: DataFrame, as_run: bool = False,
                   formats: Mapping[str, str] = DATE_FORMATS, charges: bool = True) -> DataFrame:
    """One row per document: what ``_made`` gives, and for bills the two owner lines (owner, mailing
    address with its three lines joined by a literal backslash-n), the lines of the tax detail, and
    those of all charge blocks with the number and heading of theirs (without ``charges`` NULL).

    Each text is read once, whatever its kind, and its lines stay in its row.
    """
    bill = F.col("owner_area") != ""
    blocks = F.filter(
        F.transform(F.regexp_extract_all("text", F.lit(CHARGE_BLOCK), F.lit(0)), lambda b, i: F.struct(
            (i + 1).alias("block"), cell(cells(F.substring_index(b, "\n", 1)), 0).alias("heading"),
            F.split(b, "\n").alias("lines"))),
        lambda b: F.size(b["lines"]) > 1)
    return _made(docs, as_run, formats).select(
        *DOCUMENT, "kind", "made",
        F.when(bill, _owner_lines()).alias("owner_lines"),
        F.when(bill, F.regexp_extract("text", DETAIL_AREA, 0)).alias("detail"),
        F.when(bill & F.lit(charges), blocks).alias("blocks"),
    ).select(
        *DOCUMENT, "kind", "made", "owner_lines",
        F.transform(F.split(F.nullif("detail", F.lit("")), "\n"), lambda line, i: F.struct(
            i.alias("line_no"), line.alias("line"))).alias("detail_lines"),
        F.flatten(F.transform("blocks", lambda b: F.transform(b["lines"], lambda line, i: F.struct(
            b["block"].alias("block"), b["heading"].alias("heading"), i.alias("line_no"), line.alias("line"))))).alias("charge_lines"),
    )


def _branch(c0: Column) -> Column:
    """What a line of the tax detail is, before modes, by its first cell."""
    kinds = BRANCHES | {f"{w}|": kind for w, kind in WHOLE_BRANCHES.items()}
    names = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])
    return F.coalesce(F.try_element_at(names, F.regexp_extract(F.concat_ws("", c0, F.lit("|")), BRANCH, 1)), F.lit("by mode"))


def _detail_lines(lines: str) -> Lines:
    """The lines of the tax detail with their cells, first cell and branch."""
    return (
        Lines(lines, ["line_no", "line"]).keep(lambda r: (r["line_no"] > 0) & (r["line"] != ""))
        .add(lambda r: {"x": cells(r["line"], with_x=True)})
        .add(lambda r: {"c0": F.lower(cell(r["x"], 0)), "own": _branch(F.lower(cell(r["x"], 0)))})
    )


def _mode_starts(found: Lines) -> Column:
    """Line number of the first line of each mode, by branch; no line is behind one that does not occur."""
    kinds = F.transform(found.array, lambda r: r["own"])
    return F.struct(*[F.coalesce(
        F.get(found.array, F.nullif(F.array_position(kinds, own), F.lit(0)).cast("int") - 1)["line_no"],
        F.lit(2**31 - 1)).alias(own.replace(" ", "_")) for own in MODES])


def _with_modes(found: Lines, starts: Column) -> Lines:
    """The lines that are rows, with their mode and section.

    A line without a mode of its own has that of the strongest line before it. A section is NULL where it is
    that of the last line that names one.
    """
    after = {own: lambda r, own=own: r["line_no"] > starts[own.replace(" ", "_")] for own in MODES}

    def any_mode(r: Column) -> Column:
        return after["revocation"](r) | after["before abatements"](r) | after["before exemptions"](r)

    def is_row(r: Column) -> Column:
        return (r["own"] != "none") & (r["own"] != "revocation") & (
            (r["own"] != "by mode") | (F.size(r["x"]) > 1) | any_mode(r))

    def mode(r: Column) -> Column:
        found = F.when(r["own"] != "by mode", r["own"])
        for own, later in MODES.items():
            found = found.when(after[own](r), later)
        return found.otherwise("plain")

    def section(r: Column) -> Column:
        m = r["mode"]
        carried = (m == "class") | (m == "second") | (m == "second raw")
        return F.when(carried, F.when(~any_mode(r), "details")).when(m.startswith("details-"), m).otherwise("details")

    return found.keep(is_row).add(lambda r: {"mode": mode(r)}, drop=["own"]).add(lambda r: {"section": section(r)})


def _with_sections(found: Lines) -> Column:
    """Lines that name no section have the last one before them. The state is that section."""

    def step(s: Column, r: Column):
        section = F.coalesce(r["section"], s["section"])
        return {"section": section}, F.struct(
            *[(section if n == "section" else r[n]).alias(n) for n in found.names]), None

    return F.when(F.exists(found.array, lambda r: r["section"].isNull()), running(
        found.array, {"section": F.lit("details")}, step)).otherwise(found.array)


def _detail_fields(found: Lines) -> Column:
    """Entries of the tax detail."""

    def picked(r: Column) -> dict[str, Column]:
        mode, x, c0 = r["mode"], r["x"], r["c0"]
        second, third, last = cell(x, 1), cell(x, 2), cell(x, -1)
        base = (mode == "before exemptions") | (mode == "before abatements")
        listed = ((mode == "details-abatements") | (mode == "details-exemptions")) & (F.size(x) > 2)
        in_units = listed & F.contains(F.lower(second), F.lit("unit"))
        unit_cell = F.replace(F.replace(F.lower(second), F.lit(" units"), F.lit("")), F.lit(" unit"), F.lit(""))
        return {
            "number_cell": F.when(mode == "second", second).when(
                (mode != "class") & (mode != "second raw") & (mode != "original") & (mode != "last raw"), last),
            "meta_cell": F.when(base, second).when(listed, F.when(in_units | second.endswith("%"), third).otherwise(second)),
            "raw_value": F.when(mode == "class", F.get(F.split(c0, "tax class"), F.lit(1)))
            .when(mode == "second raw", second).when((mode == "original") | (mode == "last raw"), last),
            "raw_meta": F.when(mode == "original", F.get(F.split(c0, "original tax rate"), F.lit(1))),
            "unit_cell": F.when(in_units, unit_cell),
            "key": F.when(mode == "class", "tax class").when(mode == "original", "original tax rate").otherwise(c0),
            "base": base,
        }

    def entry(r: Column) -> Column:
        return _entry(
            block=F.lit(0), line_no=r["line_no"], line=r["line"], section=r["section"], key=r["key"],
            value=F.coalesce(r["raw_value"], amount_text(r["number_cell"])), must_value=F.lit(True),
            meta=F.coalesce(r["raw_meta"], amount_text(r["meta_cell"])), must_meta=r["base"] | r["meta_cell"].isNotNull(),
            apts=whole(r["unit_cell"]), must_apts=r["unit_cell"].isNotNull())

    return F.transform(found.add(picked, drop=["x", "c0", "mode"]).array, entry)


def _with_unit_counts(found: Column) -> Column:
    """Entries whose key ends in a unit count. Most documents have none: they are tested, not copied."""
    suffixes = (" units", " unit")
    counted = found
    for suffix in suffixes:
        counted = _unit_suffix(counted, suffix)
    return F.when(F.exists(found, lambda r: r["key"].endswith(suffixes[0]) | r["key"].endswith(suffixes[1])), counted).otherwise(found)


def _unit_suffix(found: Column, suffix: str) -> Column:
    """``... 12 units``: the last word of a key becomes the unit count."""

    def counted(r: Column) -> Column:
        words = F.split(F.replace(r["key"], F.lit(suffix), F.lit("")), " ")  # only read in the few lines hit
        count = whole(cell(words, -1))
        new = {"bad": r["bad"] | count.isNull() | (r["must_apts"] & r["apts"].isNull()), "apts": count, "must_apts": F.lit(False),
               "key": F.array_join(F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))), " ")}
        return F.when(r["key"].endswith(suffix), _entry(**({n: r[n] for n in _ENTRY} | new))).otherwise(r)

    return F.transform(found, counted)


def _charge_lines(lines: str) -> Lines:
    """The lines of charge blocks with their cells, and with their words where they may be of rent."""
    return Lines(lines, ["block", "heading", "line_no", "line"]).add(lambda r: {
        "c": cells(r["line"]), "t": F.when(r["line"].contains(RENT_KEY), tokens(r["line"]))})


def _without_breaks(found: Lines) -> Column:
    """The lines that are no headings and lie in no page break.

    The state is whether a break is open: from an opening line through the next line that ends in
    ``Amount``. Each block starts without one. Documents without such a line need no state.
    """

    def start(r: Column) -> Column:
        return F.lower(cell(r["c"], 0))

    def head(r: Column) -> Column:
        return (r["line_no"] == 0) | ((r["line_no"] == 2) & start(r).startswith("activity date"))

    def marks(r: Column) -> Column:
        return (r["line"].startswith("\f") | r["line"].startswith("\v")
                | start(r).startswith(GAP_STARTS[0]) | start(r).startswith(GAP_STARTS[1]))

    def step(s: Column, r: Column):
        inside, opens = s["open"] & (r["line_no"] > 0), ~head(r) & marks(r)
        after = F.when(inside, F.coalesce(cell(r["c"], -1) != "Amount", F.lit(True))).otherwise(opens)
        return {"open": after}, r, ~(inside | opens | head(r))

    return F.when(F.exists(found.array, marks), running(found.array, {"open": F.lit(False)}, step)).otherwise(
        F.filter(found.array, lambda r: ~head(r)))


def _charge_fields(found: Lines, formats: Mapping[str, str] = DATE_FORMATS) -> Column:
    """Entries of charge lines."""

    def rows(r: Column) -> Column:
        c0, n = cell(r["c"], 0), F.size(r["c"])
        # A line of blanks has one cell, which is empty.
        return ~(((n == 1) & (c0 == "")) | F.contains(F.lower(c0), F.lit("rent stabilization fee"))
                 | c0.startswith("Activity Date")
                 | (((n < 2) | (n > 4)) & (c0 != RENT_KEY) & contains_any(r["line"], NOTES)))

    def picked(r: Column) -> dict[str, Column]:
        c, t, n, k, rent = r["c"], r["t"], F.size(r["c"]), F.size(r["t"]), cell(r["c"], 0) == RENT_KEY
        listed = rent | (n == 2) | (n == 3) | (n == 4)
        return {
            "rent": rent, "wide": rent & (k > 5), "short": rent & ((k < 4) | (k == 5)), "n": F.when(rent, 0).otherwise(n),
            "key": F.when(listed, cell(c, 0)),
            "day_cell": F.when(rent, F.when(k == 4, cell(t, 2)).when(k > 5, cell(t, 3))).when((n == 3) | (n == 4), cell(c, 1)),
            "later_cell": F.when(~rent & (n == 4), cell(c, 2)),
            "number_cell": F.when(rent, cell(t, -1)).when(listed, cell(c, -1)),
            "apts_cell": F.when(rent & (k > 5), cell(t, 2)),
            "meta": F.when(rent & (k > 5), F.array_join(F.slice(t, 5, F.greatest(k - 5, F.lit(0))), " ")),
        }

    def dated(r: Column) -> dict[str, Column]:
        return {"day_1": bill_date(r["day_cell"], formats), "day_2": bill_date(r["later_cell"], formats)}

    def entry(r: Column) -> Column:
        no_day, four = r["day_1"].isNull(), r["n"] == 4
        return _entry(
            block=r["block"], line_no=r["line_no"], line=r["line"], section=r["heading"], key=r["key"],
            duedate=F.when(r["rent"], r["day_1"]),
            activity=F.when(~r["rent"], F.coalesce(r["day_1"], r["day_2"])),
            value=amount_text(r["number_cell"]), must_value=r["number_cell"].isNotNull(),
            meta=F.when(r["rent"], r["meta"]).when((r["n"] == 3) & no_day, r["day_cell"]).when(
                four, F.when(no_day, r["day_cell"]).otherwise(r["later_cell"])),
            apts=whole(r["apts_cell"]), must_apts=r["wide"],
            bad=r["short"] | (r["rent"] & no_day) | (four & no_day & r["day_2"].isNull()))

    return F.transform(found.keep(rows).add(picked, drop=["c", "t"]).add(dated).array, entry)


def _with_last_due(found: Column) -> Column:
    """Rows without a due date have the last one before them in their block."""

    def step(s: Column, r: Column):
        due = F.coalesce(r["duedate"], F.when(s["block"] == r["block"], s["due"]))
        item = F.when(r["duedate"].isNotNull() | due.isNull(), r).otherwise(F.struct(
            *[(due if n == "duedate" else r[n]).alias(n) for n in _ENTRY]))
        return {"block": r["block"], "due": due}, item, None

    return F.when(F.exists(found, lambda r: r["duedate"].isNotNull()), running(
        found, {"block": F.lit(None).cast("int"), "due": _date()}, step)).otherwise(found)


def _owner_entries(lines: Column) -> Column:
    kinds = [(-2, "Owner name"), (-1, "Mailing address")]
    return F.array(*[_entry(
        block=F.lit(block), line_no=F.lit(0), line=F.get(lines, F.lit(i)), key=F.lit(key), value=F.get(lines, F.lit(i)),
    ) for i, (block, key) in enumerate(kinds)])


def _read_bills(docs: DataFrame, as_run: bool, formats: Mapping[str, str], charges: bool) -> DataFrame:
    """Documents with ``made`` and ``read``, the entries of a bill in the order of its lines through the first
    unreadable one. Every step is a projection: no line leaves its document."""
    empty = F.slice(F.array(_entry()), 1, 0)
    read = document_lines(docs, as_run, formats, charges)
    details, charges = _detail_lines("detail_lines"), _charge_lines("charge_lines")

    def staged(df: DataFrame, **found: Column) -> DataFrame:
        # What a later step names several times is a column of a stage of its own, so it is computed once.
        return df.select(*DOCUMENT, "kind", "made", "owner_lines", *[c.alias(n) for n, c in found.items()])

    lines = staged(read, details=details.array, charges=charges.array)
    details, charges = Lines("details", details.names), Lines("charges", charges.names)
    # Each start is named in several places, which also keeps it out of the passes over the lines.
    modes = _with_modes(details, F.col("starts"))
    begun = staged(lines, details=F.col("details"), starts=_mode_starts(details), charges=F.col("charges"))
    rows = staged(begun, details=modes.array, charges=_without_breaks(charges))
    fields = staged(rows, details=_detail_fields(Lines(_with_sections(Lines("details", modes.names)), modes.names)),
                    charges=_charge_fields(charges, formats))
    return (
        fields.select(*DOCUMENT, "kind", "made", F.when(F.col("owner_lines").isNotNull(), F.concat(
            _owner_entries(F.col("owner_lines")), F.coalesce(_with_unit_counts(F.col("details")), empty),
            F.coalesce(_with_last_due(F.col("charges")), empty))).alias("all"))
        .withColumn("bad_at", F.array_position(F.transform("all", _is_bad), True).cast("int"))
        .select(*DOCUMENT, "kind", "made", F.when(F.col("bad_at") > 0, F.slice("all", F.lit(1), F.col("bad_at")))
                .otherwise(F.col("all")).alias("read"))
    )


def _bills(docs: DataFrame, charges: bool = True) -> DataFrame:
    return read_all(docs.filter(F.col("kind") == "text"), charges=charges)


def bill_rows(docs: DataFrame) -> DataFrame:
    """All rows of bills; rows after an unreadable line of the same bill are dropped."""
    return rows_of(_bills(docs))


def owner_address(docs: DataFrame) -> DataFrame:
    """Owner name and mailing address of bills: they come before any line that may be unreadable, so no
    other line is read."""
    area = _of_kind(docs, "text").select(*DOCUMENT, _owner_area().alias("owner_area"))
    lines = area.filter(F.col("owner_area") != "").select(*DOCUMENT, F.posexplode_outer(_owner_lines()).alias("nr", "line"))
    key = F.when(F.col("nr") == 0, "Owner name").otherwise("Mailing address")
    return lines.select(_row(None, key, F.col("line"), F.col("nr") - 2))


def detail_rows(docs: DataFrame) -> DataFrame:
    """Rows of the tax detail. Charges are read behind it and change nothing in it, so they are left out."""
    return rows_of(_bills(docs, charges=False)).filter(F.col("line_no").between(0, BLOCK_STEP - 1))


def charge_rows(docs: DataFrame) -> DataFrame:
    return bill_rows(docs).filter(F.col("line_no") >= BLOCK_STEP)


def bill_rejects(docs: DataFrame) -> DataFrame:
    """First unreadable line of each bill, and bills without an owner area or a date."""
    return rejects_of(_bills(docs)).drop("kind")


def document_rejects(docs: DataFrame) -> DataFrame:
    """What could not be read, of every kind: path, kind, reason, block, line_no, line.

    Reasons: ``date`` (no billing day), ``owner`` (bill or statement without one), ``line`` (first
    unreadable line of a bill), ``row`` (first unreadable row of a statement), ``amount`` (an
    estimate of a notice that is no number).
    """
    return rejects_of(read_all(docs))


def _inside(docs: DataFrame, kind: str, as_run: bool = False) -> DataFrame:
    """Rows read inside the documents of a kind, without a shuffle."""
    # The outer form keeps the optimizer from testing the array for emptiness beforehand, which
    # would read the documents twice.
    return (
        _made(_of_kind(docs, kind), as_run, DATE_FORMATS)
        .select(*DOCUMENT, F.explode_outer("made").alias("made")).filter(F.col("made.reason").isNull() & F.col("made.key").isNotNull())
        .select(_row(F.col("made.section"), F.col("made.key"), F.col("made.value"),
                     F.col("made.line_no"), duedate=F.col("made.duedate"), meta=F.col("made.meta"),
                     apts=F.col("made.apts")))
    )


def html_rows(docs: DataFrame, as_run: bool = False) -> DataFrame:
    """Owner, then stabilization rows, of HTML statements, up to the first row that is not seven
    words with a date.

    A section's columns stay on one line; values are kept as printed. ``as_run`` looks for sections
    only after the first 16 characters.
    """
    return _inside(docs, "html", as_run)


def html_owner(docs: DataFrame) -> DataFrame:
    """The owner rows of ``html_rows``, which depend on nothing else."""
    return _of_kind(docs, "html").select(*DOCUMENT, _html_owner().alias("owner")).filter(F.col("owner").isNotNull()).select(
        _row(None, F.lit("Owner name"), F.col("owner"), F.lit(-2)))


def html_rent_rows(docs: DataFrame) -> DataFrame:
    return html_rows(docs).filter("line_no >= 0")


def html_mailing_address(docs: DataFrame) -> DataFrame:
    """Second cells of the two-cell rows that follow ``Mailing Address:`` in its table."""
    area = F.regexp_extract("text", r"(?is)Mailing Address:(.*?)</table>", 1)
    rows = F.regexp_extract_all(area, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    pairs = F.filter(
        F.transform(rows, lambda r: F.regexp_extract_all(
            r, F.lit(r"(?is)<td[^>]*>(.*?)</td>"), F.lit(1))),
        lambda tds: F.size(tds) == 2,
    )
    lines = F.transform(pairs, lambda tds: F.regexp_replace(tds[1], r"<[^>]*>", ""))
    return _of_kind(docs, "html").filter(F.col("text").ilike("%Mailing Address:%")).select(
        _row(None, F.lit("Mailing address"), strip(F.array_join(lines, "\n")), F.lit(-1))
    )


def _estimate(pattern: str) -> Column:
    return F.coalesce(*[
        F.nullif(F.regexp_extract("text", pattern, i), F.lit("")) for i in (1, 2)
    ])


def value_notice_rows(docs: DataFrame) -> DataFrame:
    """Income and expense estimates; an unreadable income also hides the expenses."""
    return _inside(docs, "notice")


def value_notice_wide(docs: DataFrame) -> DataFrame:
    """One row per notice; the last line that names an amount counts. No shuffle."""

    def last_amount(pattern: str) -> Column:
        line = F.try_element_at(
            F.filter(F.split("text", "\n"), lambda s: s.rlike(pattern)), F.lit(-1)
        )
        found = F.coalesce(*[
            F.nullif(F.regexp_extract(line, pattern, i), F.lit("")) for i in (1, 2)
        ])
        return amount(F.translate(found, ",", ""))

    bbl = F.col("bbl")
    return _of_kind(docs, "notice").select(
        "bbl", F.col("activity_through").alias("date"),
        F.expr("bbl div 1000000000").alias("borough"),
        F.expr("bbl div 10000 % 100000").alias("block"), (bbl % 10_000).alias("lot"),
        last_amount(INCOME).alias("estimatedGrossIncome"),
        last_amount(EXPENSES).alias("estimatedExpenses"),
    )


#: Columns of ``read_all`` that a document does not have, with their types.
_READ = {"section": "string", "key": "string", "duedate": "date", "activitydate": "date", "value": "string", "meta": "string",
         "apts": "string", "line_no": "bigint", "reason": "string", "block": "int", "reject_line": "int", "line": "string"}


def read_all(docs: DataFrame, as_run: bool = False,
             formats: Mapping[str, str] = DATE_FORMATS, charges: bool = True) -> DataFrame:
    """Rows and rejects of all documents in one frame, from one scan of the texts and no shuffle.

    Rows have a NULL ``reason``; rejects have NULL row columns and ``path``, ``kind``, ``block``,
    ``reject_line``, ``line``. Write it once and take both parts from what was written. Without ``charges``
    the charges of bills, and what is unreadable there, are left out.

    Documents are read in Python by batches (``reading``). Date formats that only Spark knows are read by
    columns, with the same result at several times the cost.
    """
    if not reading.knows(formats):
        return read_columns(docs, as_run, formats, charges)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    types = _READ | {"bbl": kinds["bbl"], "activitythrough": "date", "doc_path": kinds["path"], "kind": kinds["kind"]}
    names = ["bbl", "activitythrough", "section", "key", "duedate", "activitydate", "value", "meta", "apts", "doc_path",
             "line_no", "kind", "reason", "block", "reject_line", "line"]
    found = docs.select(*DOCUMENT, "kind", F.col("text").cast("binary").alias("text")).mapInArrow(
        reading.reader(names, formats, as_run, charges), ", ".join(f"{n} {types[n]}" for n in names))

    def spelled(c: Column) -> Column:
        left = number_text(F.substring(c, 2, 400).try_cast("double"))
        return F.when(c.startswith(reading.FOR_SPARK), F.coalesce(left, c)).otherwise(c)

    return found.withColumns({n: spelled(F.col(n)) for n in ("value", "meta")})


def read_columns(docs: DataFrame, as_run: bool = False,
                 formats: Mapping[str, str] = DATE_FORMATS, charges: bool = True) -> DataFrame:
    """What ``read_all`` gives, in columns of Spark alone: for any formats of dates."""
    none = F.slice(F.array(_entry()), 1, 0)
    # The outer form keeps the optimizer from testing the array for emptiness beforehand, which
    # would read the documents twice.
    every = F.explode_outer(F.concat("made", F.coalesce("read", none)))
    e, block = F.col("e"), F.col("e.block").cast("bigint")
    found = _read_bills(docs, as_run, formats, charges).select(*DOCUMENT, "kind", every.alias("e")).filter(e.isNotNull()).withColumn(
        "reason", F.coalesce(e["reason"], F.when(_is_bad(e), "line")))
    row = F.col("reason").isNull()
    at = F.when(block.isNull(), e["line_no"].cast("bigint")).when(block < 0, block).otherwise(block * BLOCK_STEP + e["line_no"])
    return found.select(
        "bbl", F.when(row, F.col("activity_through")).alias("activitythrough"),
        *[F.when(row, e[n]).alias("activitydate" if n == "activity" else n)
          for n in ("section", "key", "duedate", "activity", "value", "meta", "apts")],
        F.col("path").alias("doc_path"), F.when(row, at).alias("line_no"), "kind", "reason", F.when(~row, e["block"]).alias("block"),
        F.when(~row, e["line_no"]).alias("reject_line"), F.when(~row, e["line"]).alias("line"))


def rows_of(read: DataFrame) -> DataFrame:
    return read.filter(F.col("reason").isNull()).select(*ROW_COLUMNS)


def rejects_of(read: DataFrame) -> DataFrame:
    return read.filter(F.col("reason").isNotNull()).select(
        F.col("doc_path").alias("path"), "kind", "reason", "block",
        F.col("reject_line").alias("line_no"), "line")


def extract_all(docs: DataFrame, as_run: bool = False,
                formats: Mapping[str, str] = DATE_FORMATS) -> tuple[DataFrame, DataFrame]:
    """Rows of all documents, and what could not be read: two views of ``read_all``."""
    read = read_all(docs, as_run, formats)
    return rows_of(read), rejects_of(read)


def line_shape(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Lines, cells and widest line of each text."""
    lines = texts.select(key, F.explode(F.split(text, "\n")).alias("line"))
    return lines.select(key, F.col("line"), F.size(cells(F.col("line"))).alias("n")).groupBy(key).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(strip(F.col("line")) == "").alias("blank_lines"),
        F.sum("n").alias("cells"),
        F.max("n").alias("widest"),
    )
