"""Documents read in Python give what the columns give."""

import random

from test_extract import BILL, TEXT, docs

from lotledger.functions.text import DATE_FORMATS
from lotledger.operators import extract, reading

NOTICE = BILL.replace("Quarterly Property Tax Bill", "Notice of Property Value")
HTML = BILL.replace("Quarterly Property Tax Bill.txt", "Quarterly Statement of Account.html")
STATEMENT = (
    "<html><p>Owner Name: <img src=\"x.gif\"> \tACME <br></p>\n<b>Current Amount Due</b> Activity Date Due Date\nAmount "
    "<td>Housing-Rent Stabilization 12 04/01/2017 123 00 $380.00</td><td>housing-rent stabilization 1 5/1/17 9 x $1</td>"
    "_________________\n<b>New Charges Due June 02, 2017</b> Activity Date <td>Housing-Rent Stabilization 3 2-JUN-2017 "
    "4 5 $6</td>_________________</html>")
ESTIMATES = "Gross Income:  We estimated gross income at $1,234,567.\nEstimated Expenses: $456.5"
DETAIL = """How We Calculated Your Property Tax
 junk
Revocation     x
Original tax rate 12 - a     9.5%
Current tax rate     10.1%     2
New tax rate     7.5%
SCRIE 4 unit     5 Units     $9,000     $7
420c Housing 3 units unit     12%     -$4     $5
Coop     12%     -$4     $5
Plain
Annual property tax     $1
"""
ODD = ["", " ", "  ", "\t", "\t ", "\f", "\x0b", "\r", "\r\n", " ", "\u0085", "  ", "\x1c ", "X", "$", "XX", "$$ ", "|", "%",
       "İ", "K", "ß", "Σ", "0", "-", ".", "e5", "E-9", "99999999999", "0.00001", "12345678.9", "units", " unit",
       " units", "Amount", "Activity Date", "Total", "Current Charges\nActivity Date", "Previous Balance \r\n\n Activity Date\n\n",
       "Owner name:", "Property address:", "Borough, block & lot:", "STATEMENT billing\nsummary", "Outstanding \t charges", "Statement",
       "Pay today", "\fPage", "Home Banking Payment Instructions", "State law recently changed", "rent stabilization fee",
       "Housing-Rent Stabilization", "Housing-Rent Stabilization  04/01/2017  $5", "Housing-Rent Stabilization  1 04/01/2017 2  $5",
       "revocation", "tax before abatements  $1", "tax rate", "overall", "value", "annual property tax", "Annual property tax detail",
       "02/30/2017", "13/6/2017", "1/1/0000", "2/29/0000", "6/2/17", "2017-06-02", "2 June 2017", "MAY 1, 2017", "may 1, 2017",
       "Sept 3, 2017", "Sep 3, 2017", "Sat, 1st of April 2017", "2-jun-17", "6.2.2017", "6 / 2 / 2017", "2017 June 2", "June 31, 2017",
       "٢٣", "_", "_________________", "<", "Estimated Gross Income: $", "Expenses: We estimated expenses at $7.", "n/a"]


def mixed(seed: int, count: int) -> list[tuple[str, str | None]]:
    """Documents of each kind with odd words put in, lines taken out, doubled and dealt anew."""
    rnd, found = random.Random(seed), [(BILL, None), (HTML, None), (NOTICE, None), (BILL, ""), (HTML, ""), (NOTICE, "")]
    bills = [TEXT, TEXT[:TEXT.index("Annual Property")] + DETAIL, TEXT.replace("J51 Abatement", "Revocation", 1),
             TEXT.replace("     $45,122", "").replace("Tax Before Abatements", "Tax x 3 Units")]
    for _ in range(count):
        path, text = rnd.choice([(BILL, rnd.choice(bills)), (BILL, rnd.choice(bills)), (HTML, STATEMENT), (NOTICE, ESTIMATES)])
        for _ in range(rnd.choice([0, 1, 1, 2, 4, 12])):
            lines, how = text.split("\n"), rnd.random()
            i, j = rnd.randrange(len(lines)), rnd.randrange(len(lines))
            if how < 0.15:
                del lines[i]
            elif how < 0.3:
                lines.insert(j, lines[i])
            elif how < 0.4:
                lines[i], lines[j] = lines[j], lines[i]
            elif how < 0.5:
                lines.insert(i, f"{rnd.choice(ODD)}{rnd.choice(['  ', ' ', '   '])}{rnd.choice(ODD)}    {rnd.choice(ODD)}   {rnd.choice(ODD)}")
            elif how < 0.75:
                cells = lines[i].split("  ")
                cells[rnd.randrange(len(cells))] = rnd.choice(ODD)
                lines[i] = "  ".join(cells)
            else:
                at = rnd.randrange(len(lines[i]) + 1)
                lines[i] = lines[i][:at] + rnd.choice(ODD) + lines[i][at:]
            text = "\n".join(lines) or "x"
        if rnd.random() < 0.1:
            text = text.swapcase() if rnd.random() < 0.5 else text.upper()
        found.append((path, text))
    return [(p.replace("00274", f"{i:05}"), t) for i, (p, t) in enumerate(found)]


def differing(spark, pairs, **how) -> list:
    listed = docs(spark, *pairs)
    by_python, by_column = extract.read_all(listed, **how).cache(), extract.read_columns(listed, **how).cache()
    assert by_python.schema.simpleString() == by_column.schema.simpleString() and by_python.count() >= len(pairs)
    return by_python.exceptAll(by_column).collect() + by_column.exceptAll(by_python).collect()


def test_python_and_columns_read_the_same(spark):
    assert differing(spark, mixed(1, 1500)) == []
    assert differing(spark, mixed(2, 200), as_run=True, charges=False) == []


def test_documents_are_read_by_batches(spark):
    """The arrays of lines, which Spark interprets, are left to formats that only Spark reads."""
    listed = docs(spark, (BILL, TEXT))
    plan = extract.read_all(listed)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "aggregate(" not in plan and "transform(" not in plan
    own = DATE_FORMATS | {"yyyy.DDD": r"^\d{4}\.\d{3}$"}
    assert not reading.knows(own) and reading.knows({"yyyy-MM-dd": DATE_FORMATS["yyyy-MM-dd"]})
    text = TEXT.replace("06/02/2017      -$24,705.75", "2017.153      -$24,705.75")
    rows = extract.rows_of(extract.read_all(docs(spark, (BILL, text)), formats=own))
    assert rows.filter("key = 'Payment' and activitydate = date'2017-06-02'").count() == 1


def test_bytes_that_are_no_text(spark):
    from pyspark.sql import functions as F

    listed = docs(spark, (BILL, TEXT)).withColumn("text", F.expr(
        "cast(concat(cast('Caf' as binary), X'E9', cast(text as binary), X'FF') as string)"))
    assert extract.rows_of(extract.read_all(listed)).count() == extract.rows_of(extract.read_columns(listed)).count() > 15


def test_amounts_are_spelled_alike(spark):
    """Java and Python differ in the digits of some numbers from 1.8e16 on."""
    rnd = random.Random(3)
    texts = [f"{rnd.choice('-+ ')}${rnd.uniform(0, 10 ** rnd.randint(-6, 24)):,.{rnd.randint(0, 7)}f}" for _ in range(3000)]
    texts += ["957,497,072,153,535,360", "1e400", "-1e400", "-0", "0", "1E-5", "1e22", "4.9E-324", ".5", "5.", "1e-3", "1e7",
              "9999999.99", "nan", "inf", "1_0", "", "5 ", "1d", "0x1", "\x001"]
    pairs = [(NOTICE.replace("00274", f"{i:05}"), f"Estimated Gross Income: ${t}") for i, t in enumerate(texts)]
    pairs += [(BILL.replace("00274", f"{i:05}"), TEXT.replace("$120.50", t).replace("12.892%", t or "x")) for i, t in enumerate(texts[-60:])]
    assert differing(spark, pairs) == []
