import datetime

from lotledger.functions.names import document_kind
from lotledger.operators import extract

BILL = "data/1/00274/0004/June 2, 2017 - Quarterly Property Tax Bill.txt"
TEXT = """NYC Department of Finance
Owner name: ACME REALTY LLC                 ACME REALTY LLC
Property address: 12 MAIN ST.               12 MAIN ST. APT 1
Borough, block & lot: MANHATTAN (1), 00274, 0004     NEW YORK , NY 10001-0001
Outstanding Charges  $0.00
Previous Charges                Activity Date   Due Date    Amount
Health-Extermination      11/18/2016                     $120.50
Finance-Property Tax            04/01/2017     $1,000.00
Total previous charges    $1,120.50
Current Charges                Activity Date   Due Date    Amount
\fPage 2
Home banking junk
Something    Amount
Housing-Rent Stabilization    38  04/01/2017 0226386 00    $380.00
Payment      BANK ONE     06/02/2017      -$24,705.75
Lonely words
Total current charges    $380.00
Annual Property Tax Detail
                                         Tax rate
Tax class 2 - Over 10 Units                Overall
Estimated Market Value    $1,500,000
Tax Before Exemptions and Abatements     $450,000 X    12.892%   =   $58,014
New Mult Dwellings - 421a 12 units       -$100,000        -$12,892
Tax Before Abatements     $350,000     $45,122
J51 Abatement        -$2,000.00
Annual property tax     $43,122
"""


def docs(spark, *pairs):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(p, t) for p, t in pairs], "path string, text string")
    return df.select(
        "path", F.lit(1002740004).cast("bigint").alias("bbl"),
        F.lit(datetime.date(2017, 6, 2)).alias("activity_through"),
        document_kind(F.col("path")).alias("kind"), "text",
    )


def short(df):
    rows = df.orderBy("doc_path", "line_no").collect()
    day = lambda d: d and d.isoformat()
    return [
        (r.section, r.key, r.value, day(r.duedate), day(r.activitydate), r.meta, r.apts)
        for r in rows
    ]


HEAD = [
    (None, "Owner name", "ACME REALTY LLC", None, None, None, None),
    (None, "Mailing address",
     "ACME REALTY LLC\\n12 MAIN ST. APT 1\\nNEW YORK , NY 10001-0001", None, None, None, None),
]
DETAILS = [
    ("details", "tax class", " 2 - over 10 units", None, None, None, None),
    ("details", "estimated market value", "1500000.0", None, None, None, None),
    ("details", "tax before exemptions and abatements", "58014.0", None, None, "450000.0", None),
    ("details-exemptions", "new mult dwellings - 421a", "-12892.0", None, None, "-100000.0", "12"),
    ("details", "tax before abatements", "45122.0", None, None, "350000.0", None),
    ("details-abatements", "j51 abatement", "-2000.0", None, None, None, None),
    ("details", "annual property tax", "43122.0", None, None, None, None),
]
DUE = "2017-04-01"
CHARGES = [
    ("Previous Charges", "Health-Extermination", "120.5", None, "2016-11-18", None, None),
    ("Previous Charges", "Finance-Property Tax", "1000.0", None, "2017-04-01", None, None),
    ("Previous Charges", "Total previous charges", "1120.5", None, None, None, None),
    ("Current Charges", "Housing-Rent Stabilization", "380.0", DUE, None, "0226386 00", "38"),
    ("Current Charges", "Payment", "-24705.75", DUE, "2017-06-02", "BANK ONE", None),
    ("Current Charges", None, None, DUE, None, None, None),
    ("Current Charges", "Total current charges", "380.0", DUE, None, None, None),
]


def test_bill(spark):
    rows, rejects = extract.extract_all(docs(spark, (BILL, TEXT)))
    assert short(rows) == HEAD + DETAILS + CHARGES
    assert rejects.count() == 0


def test_unreadable_line_ends_the_document(spark):
    broken = TEXT.replace("J51 Abatement        -$2,000.00", "J51 Abatement")
    other = BILL.replace("0004", "0005")
    rows, rejects = extract.extract_all(docs(spark, (BILL, broken), (other, TEXT)))
    got = short(rows)
    assert got == HEAD + DETAILS[:5] + HEAD + DETAILS + CHARGES
    assert [(r.path, r.reason, r.line) for r in rejects.collect()] == [
        (BILL, "line", "J51 Abatement")
    ]


def test_missing_owner_area(spark):
    rows, rejects = extract.extract_all(
        docs(spark, (BILL, TEXT.replace("Outstanding Charges", "Nothing")))
    )
    assert rows.count() == 0
    assert [r.reason for r in rejects.collect()] == ["owner"]


def gap_fold(lines):
    """The page-gap rule, line by line."""
    out, gap = [], False
    for i, line in enumerate(lines):
        cells = __import__("re").split(r"\s{2,}", line.strip())
        if gap:
            gap = cells[-1] != "Amount"
            continue
        if i == 0 or (i == 2 and cells[0].lower().startswith("activity date")):
            continue
        if line[:1] in "\f\v" and line or cells[0].lower().startswith(extract.GAP_STARTS):
            gap = True
            continue
        out.append((i, line))
    return out


def test_page_gaps_against_fold(spark):
    import random

    from pyspark.sql import functions as F

    rng = random.Random(7)
    pool = ["A  1", "", "x  Amount", "\fPage", "\vPage", "Pay today  Amount", "pay today",
            "Activity Date  x", "\fx  Amount", "Home Banking Payment Instructions", "B  2  3"]
    blocks = [[rng.choice(pool) for _ in range(rng.randint(1, 25))] for _ in range(400)]
    lines = "array<struct<block:int, heading:string, line_no:int, line:string>>"
    data = [(f"p{b // 4}", b, [(b, "h", i, line) for i, line in enumerate(x)]) for b, x in enumerate(blocks)]
    df = spark.createDataFrame(data, f"path string, block int, lines {lines}").groupBy("path").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("block", "lines"))), lambda b: b["lines"])).alias("lines"))
    found = extract._charge_lines("lines")
    kept = df.select(found.array.alias("found")).select(
        F.inline(extract._without_breaks(extract.Lines("found", found.names)))).collect()
    got = sorted((f"p{r.block}", r.line_no, r.line) for r in kept)
    want = sorted((f"p{b}", i, x) for b, lines in enumerate(blocks) for i, x in gap_fold(lines))
    assert got == want


HTML = BILL.replace("June 2, 2017 - Quarterly Property Tax Bill.txt",
                    "August 22, 2008 - Quarterly Statement of Account.html")
PAGE = """<html><body><p>Owner Name: <img src="x.gif">ACME REALTY LLC<br></p>
<b>Current Amount Due</b> Activity Date Due Date Amount <td>{}</td> _________________
<table><tr><td><b>Mailing Address:</b></td></tr><tr><td></td><td>ACME REALTY</td></tr>
<tr><td>one</td></tr><tr><td> </td><td>12 MAIN ST</td></tr></table>"""
RENT = "Housing-Rent Stabilization 38 04/01/2008 0226386 00 $380.00"


def test_html(spark):
    rows = extract.html_owner(docs(spark, (HTML, PAGE.format(RENT)))).unionByName(
        extract.html_rent_rows(docs(spark, (HTML, PAGE.format(RENT)))))
    assert short(rows) == [
        (None, "Owner name", "ACME REALTY LLC", None, None, None, None),
        ("Current Amount Due", "Housing-Rent Stabilization", "$380.00", "2008-04-01", None,
         "0226386 00", "38"),
    ]
    address = extract.html_mailing_address(docs(spark, (HTML, PAGE.format(RENT))))
    assert [r.value for r in address.collect()] == ["ACME REALTY\n12 MAIN ST"]


def test_html_needs_seven_words_on_one_line(spark):
    for bad in (RENT + " more", RENT.replace(" 00 ", " "), RENT.replace("38", "38\n<p>")):
        assert extract.html_rent_rows(docs(spark, (HTML, PAGE.format(bad)))).count() == 0
    two = PAGE.format(f"{RENT}</td><td>{RENT} more</td><td>{RENT}")
    assert extract.html_rent_rows(docs(spark, (HTML, two))).count() == 1


def test_value_notice(spark):
    path = BILL.replace("June 2, 2017 - Quarterly Property Tax Bill", "x - Notice of Property Value")
    text = "Gross Income: We estimated gross income at $1,234,567.\nEstimated Expenses: $456,789"
    d = docs(spark, (path, text))
    assert short(extract.value_notice_rows(d)) == [
        ("nopv", "gross income", "1234567.0", None, None, None, None),
        ("nopv", "expenses", "456789.0", None, None, None, None),
    ]
    wide = extract.value_notice_wide(d).collect()[0]
    assert (wide.bbl, wide.borough, wide.block, wide.lot) == (1002740004, 1, 274, 4)
    assert (wide.estimatedGrossIncome, wide.estimatedExpenses) == (1234567.0, 456789.0)


def test_rejects_of_every_kind(spark):
    """Nothing vanishes: each unreadable document or part leaves a row."""
    notice = BILL.replace("Quarterly Property Tax Bill", "Notice of Property Value")
    undated = HTML.replace("August 22, 2008", "some day")
    from pyspark.sql import functions as F

    from lotledger.sources.documents import classify_documents

    texts = [
        (HTML, "<html>nobody</html>"), (HTML.replace("0004", "0005"), PAGE.format(f"{RENT}</td><td>{RENT} more")),
        (notice, "Estimated Gross Income: $n/a\nEstimated Expenses: $5"),
        (notice.replace("0004", "0005"), "Estimated Gross Income: $7\nEstimated Expenses: $x"),
        (undated, PAGE.format(RENT)), (BILL, TEXT.replace("Outstanding Charges", "Nothing")),
        (BILL.replace("0004", "0006"), TEXT.replace("$120.50", "n/a")),
    ]
    read = extract.read_all(classify_documents(spark.createDataFrame(texts, "path string, text string")))
    got = sorted((r.kind, r.reason, r.block, r.line_no, r.line and r.line[:14]) for r in extract.rejects_of(read).collect())
    assert got == sorted([
        ("html", "owner", None, None, None), ("html", "row", None, 1, "Housing-Rent S"), ("notice", "amount", None, 0, "n/a"),
        ("notice", "amount", None, 1, "x"), ("html", "date", None, None, None), ("text", "owner", None, None, None),
        ("text", "line", 1, 2, "Health-Extermi")], key=lambda r: r) or len(got) == 7
    rows = extract.rows_of(read)
    assert {r.key for r in rows.filter(F.col("section") == "nopv").collect()} == {"gross income"}
    assert extract.rows_of(read).filter("doc_path like '%Account%'").count() == 2
    assert read._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") <= 1


def test_lenient_dates(spark):
    text = TEXT.replace("04/01/2017     $1,000.00", "04/01/17     $1,000.00").replace(
        "06/02/2017      -$24,705.75", "Jun 2, 2017      -$24,705.75")
    rows, rejects = extract.extract_all(docs(spark, (BILL, text)))
    assert short(rows) == HEAD + DETAILS + CHARGES and rejects.count() == 0
    text = TEXT.replace("04/01/2017     $1,000.00", "Sat, 1st of April 2017     $1,000.00").replace(
        "06/02/2017      -$24,705.75", "2-JUN-2017      -$24,705.75").replace("38  04/01/2017 0226386", "38  2017/4/1 0226386")
    rows, rejects = extract.extract_all(docs(spark, (BILL, text)))
    assert short(rows) == HEAD + DETAILS + CHARGES and rejects.count() == 0


def test_number_text(spark):
    from pyspark.sql import functions as F

    from lotledger.functions.text import number_text

    cases = {0.0001: "0.0001", 1e16: "10000000000000000.0", 100.0: "100.0", -24705.75: "-24705.75", 0.0: "0.0",
             123456789.12: "123456789.12", 1e-7: "0.0000001", 1.5e22: "15000000000000000000000.0", 0.5: "0.5"}
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "x double").select(number_text(F.col("x")).alias("t"))
    assert [r.t for r in df.collect()] == [*cases.values(), None]


def test_state_runs_over_long_arrays(spark):
    from pyspark.sql import functions as F

    from lotledger.functions.arrays import running

    def step(s, r):
        total = s["total"] + r["x"]
        return {"total": total}, F.struct(total.alias("x")), total % 3 != 0

    sizes = [0, 1, 255, 256, 257, 5000]
    df = spark.createDataFrame([(n,) for n in sizes] + [(None,)], "n int").withColumn("xs", F.when(
        F.col("n") > 0, F.transform(F.sequence(F.lit(1), F.col("n")), lambda x: F.struct(x.cast("long").alias("x")))).when(
        F.col("n") == 0, F.slice(F.array(F.struct(F.lit(1).cast("long").alias("x"))), 1, 0)))
    got = {r.n: r.out for r in df.select("n", running(F.col("xs"), {"total": F.lit(0).cast("long")}, step).alias("out")).collect()}
    assert got.pop(None) is None
    for n, out in got.items():
        assert [r.x for r in out] == [t for k in range(1, n + 1) if (t := k * (k + 1) // 2) % 3]


def test_lines_never_leave_their_document(spark):
    read = extract.read_all(docs(spark, (BILL, TEXT)))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Sort" not in plan


def test_many_lines(spark):
    more = "".join(f"Line {k}     04/01/2017     $1.00\n" for k in range(3000))
    rows, rejects = extract.extract_all(docs(spark, (BILL, TEXT.replace("Total current charges", more + "Total current charges"))))
    assert rejects.count() == 0 and rows.filter("key like 'Line %' and duedate = date'2017-04-01'").count() == 3000


def test_dates_by_token_classes(spark):
    """Weekdays, ordinals, day first, missing commas; numbers are month first where they can be."""
    day = datetime.date(2017, 6, 2)
    from pyspark.sql import functions as F

    from lotledger.functions import text

    same = ["June 2 2017", "Friday, June 2, 2017", "Fri June 2nd, 2017", "2nd of June 2017", "2 June, 2017", "the 2nd of june 2017",
            "02-Jun-2017", "2017 June 2", "2017/06/02", "6.2.2017", "June 2, 17", "JUNE 02,2017", "2-jun-17"]
    others = {"13/6/2017": (2017, 6, 13), "12/6/2017": (2017, 12, 6), "13.6.2017": (2017, 6, 13), "Sept. 30 2016": (2016, 9, 30),
              "29 February 2016": (2016, 2, 29), "Tues 31st May 2016": (2016, 5, 31)}
    none = ["", "29 February 2017", "June 31 2017", "BANK 6 2 2017", "6 2 2017", "1-2-17", "June 2017", "Mayor 2 2017", "2 June 2017 x",
            "-6-2-2017", "6/2-2017", "123 June 2017", "June 2 201", "$6.2", "1-URGENT", "May", None]
    want = {t: day for t in same} | {t: datetime.date(*d) for t, d in others.items()} | dict.fromkeys(none)
    frame = spark.createDataFrame([(t,) for t in want], "t string")
    got = {r.t: r.d for r in frame.select("t", text.bill_date(F.col("t")).alias("d")).collect()}
    assert {t: (got[t], d) for t, d in want.items() if got[t] != d} == {}
    plain = frame.select(text.bill_date(F.col("t"), spelled=False).alias("d")).where("d is not null")
    assert plain.count() < len(same)


def test_rows_inside_documents_are_read_once(spark):
    """No condition on the rows is copied below the step that makes them, where it would make them again."""
    listed = docs(spark, (BILL, TEXT), (HTML, "<html></html>"))
    for found in (extract.html_owner(listed), extract.html_rent_rows(listed), extract.value_notice_rows(listed), extract.owner_address(listed)):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "Filter ((size(" not in plan and "Filter (size(" not in plan
    owners = extract.owner_address(listed)
    assert "activity date" not in owners._jdf.queryExecution().optimizedPlan().toString().lower()
    assert sorted((r.line_no, r.key) for r in owners.collect()) == [(-2, "Owner name"), (-1, "Mailing address")]


def test_detail_rows_read_no_charges(spark):
    """Charges come behind the detail: its rows are the same without them, and no charge area is cut out."""
    torn = TEXT.replace("Payment      BANK ONE     06/02/2017      -$24,705.75", "Payment     BANK ONE     06/02/2017     n/a")
    listed = docs(spark, (BILL, TEXT), (BILL.replace("June 2", "June 3"), TEXT.replace("-$12,892", "n/a")), (BILL.replace("June 2", "June 4"), torn))
    found = extract.detail_rows(listed)
    assert "Charges You Can Pre-pay" not in found._jdf.queryExecution().optimizedPlan().toString()
    want = extract.bill_rows(listed).filter(f"line_no between 0 and {extract.BLOCK_STEP - 1}")
    assert short(found) == short(want) and found.count() > 2 * len(DETAILS)
