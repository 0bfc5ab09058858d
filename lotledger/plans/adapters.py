"""Property-record views over the star-schema tables (each is one lazy DataFrame).

Region keys play the boroughs, customers the lots, line items and orders the lines of tax bills.
Every source row takes part: the return flag and line status of a line item decide which kind of
bill line it becomes, the status and priority of an order which further lines its bill carries.
``oracles.py`` holds the same definitions as SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotledger.functions import names
from lotledger.functions.lots import borough_code
from lotledger.sources import documents

YEARS = list(range(1995, 2002))
CUTOFF = "1998-04-01"
BILL_DAY = "1998-04-01"
LIST_FROM = "1997-01-01"

RAW_COLUMNS = [
    "bbl", "activitythrough", "section", "key", "duedate", "activitydate", "value", "meta", "apts",
    "line_no",
]

# Key printed on a bill for each (order priority, order status).
EXEMPTION_KEYS = {
    ("1-URGENT", "F"): "J51 Abatement",
    ("1-URGENT", "O"): "J-51 Alteration",
    ("1-URGENT", "P"): "J-51 Exemption",
    ("2-HIGH", "F"): "New Mult Dwellings - 421a",
    ("2-HIGH", "O"): "421a (15 yr not cap)",
    ("2-HIGH", "P"): "New Mult Dwellings",
    ("3-MEDIUM", "F"): "SCRIE Rent Stabilization Abatement",
    ("3-MEDIUM", "O"): "DRIE Disability Rent Increase Abate",
    ("3-MEDIUM", "P"): "421a (10 yr cap)",
    ("4-NOT SPECIFIED", "F"): "420c Housing",
    ("4-NOT SPECIFIED", "O"): "Co-op Condo Abatement",
    ("4-NOT SPECIFIED", "P"): "Veteran Exemption",
    ("5-LOW", "F"): "School Tax Relief",
    ("5-LOW", "O"): "Basic STAR - School Tax Relief",
    ("5-LOW", "P"): "School Tax Relief",
}

# Key, section of each kind of line item (return flag, line status).
CHARGE_KEYS = {
    ("R", "O"): ("Housing-Rent Stabilization", "Current Charges"),
    ("R", "F"): ("Finance-Property Tax", "Previous Charges"),
    ("A", "O"): ("Payment", "Current Charges"),
    ("A", "F"): ("Health-Extermination", "Previous Charges"),
    ("N", "O"): ("Total current charges", "Current Charges"),
    ("N", "F"): ("Interest", "Previous Charges"),
}


def by_pair(first: str, second: str, values: dict[tuple[str, str], str]) -> Column:
    """The value of a pair of columns (one SQL text: quicker to build than a chain of calls)."""
    whens = " ".join(
        f"WHEN {first} = '{a}' AND {second} = '{b}' THEN '{v}'" for (a, b), v in values.items()
    )
    return F.expr(f"CASE {whens} END")


def _line(df: DataFrame, section, key, value, line, *, day=None, due=None, activity=None,
          meta=None, apts=None) -> DataFrame:
    none = F.lit(None)
    return df.select(
        "bbl",
        (F.col("activitythrough") if day is None else day).alias("activitythrough"),
        (F.lit(section) if section is None or isinstance(section, str) else section)
        .cast("string").alias("section"),
        (F.lit(key) if isinstance(key, str) else key).alias("key"),
        (none if due is None else due).cast("date").alias("duedate"),
        (none if activity is None else activity).cast("date").alias("activitydate"),
        value.cast("string").alias("value"),
        (none if meta is None else meta).cast("string").alias("meta"),
        (none if apts is None else apts).cast("string").alias("apts"),
        line.cast("bigint").alias("line_no"),
    )


# What documents name many times: columns, so that each is printed once per order.
_PRINTED = {"printed_day": "date_format(o_orderdate, 'MM/dd/yyyy')",
            "printed_money": "concat('$', format_number(o_totalprice, 2))",
            "printed_units": "cast(o_custkey % 40 + 1 AS string)"}
_DAY, _MONEY, _UNITS = _PRINTED
_FEE_LINE = (
    f"CASE WHEN o_orderstatus = 'F' "
    f"THEN concat('Housing-Rent Stabilization    ', {_DAY}, '    ', {_MONEY}) "
    f"ELSE concat('Housing-Rent Stabilization    ', {_UNITS}, '  ', {_DAY}, ' ', "
    f"cast(o_custkey AS string), ' 00    ', {_MONEY}) END"
)
_EXEMPTION_CASE = "CASE " + " ".join(
    f"WHEN o_orderpriority = '{a}' AND o_orderstatus = '{b}' THEN '{v}'"
    for (a, b), v in EXEMPTION_KEYS.items()
) + " END"
_BILL_LINES = [
    "concat('Activity through ', day_text)",
    "concat('Owner name: ', c_name, '                 ', c_name)",
    "concat('Property address: ', o_custkey, ' MAIN ST.        ', o_custkey, ' MAIN ST. APT 1')",
    "concat('Borough, block & lot: ', lot_dir, '     NEW YORK , ', n_name)",
    "CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'Amount due' "
    "ELSE 'Outstanding Charges  $0.00' END",
    "'Previous Charges                Activity Date   Due Date    Amount'",
    f"concat('Health-Extermination      ', {_DAY}, '                     ', {_MONEY})",
    "concat('Finance-Property Tax            ', o_orderpriority, '     $1,000.00')",
    f"concat('Total previous charges    ', {_MONEY})",
    "'Current Charges                Activity Date   Due Date    Amount'",
    "CASE WHEN o_orderstatus = 'P' "
    "THEN concat(char(12), 'Page 2', char(10), 'Home banking junk', char(10), 'Some    Amount') END",
    _FEE_LINE,
    f"concat('Payment      BANK ONE     ', {_DAY}, '      -', {_MONEY})",
    "'Lonely words'",
    f"concat('Total current charges    ', {_MONEY})",
    "'Annual Property Tax Detail'",
    "'                          Tax rate'",
    "'Tax class 2 - Over 10 Units                Overall'",
    f"concat('Estimated Market Value    ', {_MONEY})",
    f"concat('Tax Before Exemptions and Abatements     $450,000 X    12.892%   =   ', {_MONEY})",
    f"concat({_EXEMPTION_CASE}, ' ', {_UNITS}, ' units       -$100,000        -$12,892')",
    "'Tax Before Abatements     $350,000     $45,122'",
    "CASE WHEN o_orderpriority = '1-URGENT' THEN 'J51 Abatement' "
    "ELSE 'J51 Abatement        -$2,000.00' END",
    "'Annual property tax     $43,122'",
]
BILL_TEXT = f"concat_ws(char(10), {', '.join(_BILL_LINES)})"
_HTML_ROW = (
    f"concat('<td>Housing-Rent Stabilization ', {_UNITS}, ' ', {_DAY}, ' ', o_custkey, "
    f"CASE WHEN o_orderstatus = 'F' THEN '' ELSE ' 00' END, ' ', {_MONEY}, '</td>')"
)
HTML_TEXT = (
    "concat('<html><body><p>Owner Name: <img src=\"x.gif\"> ', c_name, ' <br></p>', char(10), "
    "'<b>Current Amount Due</b> Activity Date Due Date', "
    "CASE WHEN o_orderstatus = 'P' THEN char(10) ELSE ' ' END, 'Amount ', "
    f"{_HTML_ROW}, {_HTML_ROW}, repeat('_', 17), char(10), "
    "'<table><tr><td>Mailing Address:</td></tr><tr><td></td><td>', c_name, '</td></tr><tr><td></td><td>', "
    "n_name, '</td></tr></table></body></html>')"
)
NOTICE_TEXT = (
    "CASE o_orderstatus "
    f"WHEN 'O' THEN concat('Gross Income: We estimated gross income at ', {_MONEY}, '.', char(10), "
    "'Estimated Expenses: $456,789') "
    f"WHEN 'F' THEN concat('Estimated Gross Income: ', {_MONEY}, char(10), "
    "'Expenses: We estimated expenses at $1,000.', char(10), 'Estimated Gross Income: $7') "
    "ELSE concat('Estimated Gross Income: $n/a', char(10), 'Estimated Expenses: $5') END"
)


def document_columns(files: DataFrame) -> DataFrame:
    """Lot, date and kind of documents, from ``path, text``."""
    return documents.from_path(files)


def once(build: Callable) -> Callable:
    """Build a view at most once per ``Views`` object, so that its uses share one plan."""

    @wraps(build)
    def cached(self):
        if build.__name__ not in self.built:
            self.built[build.__name__] = build(self)
        return self.built[build.__name__]

    return cached


class Views:
    """The adapter views of one table folder (lazy; nothing is read until an action)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self.built = spark, sf_dir, {}

    def table(self, name: str) -> DataFrame:
        if name not in self.built:
            self.built[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self.built[name]

    @once
    def owners_of_lots(self) -> DataFrame:
        """customer with its lot id."""
        nation = self.table("nation").select("n_nationkey", "n_name", "n_regionkey")
        joined = self.table("customer").join(
            nation, F.col("c_nationkey") == F.col("n_nationkey")
        )
        borough = F.col("n_regionkey") + 1
        return joined.withColumn("bbl", borough.cast("bigint") * 1_000_000_000 + F.col("c_custkey"))

    @once
    def lots(self) -> DataFrame:
        """Parcel attributes, one row per lot."""
        k = F.col("c_custkey")
        borough = F.col("n_regionkey") + 1
        units = F.floor(F.abs("c_acctbal")).cast("int") % 100
        return self.owners_of_lots().select(
            "bbl",
            borough.alias("borough_no"),
            borough_code(borough).alias("borough"),
            F.call_function("div", k, F.lit(10_000)).cast("int").alias("block"),
            (k % 10_000).cast("int").alias("lot"),
            (borough * 100 + F.col("n_nationkey")).alias("cd"),
            (k % 97).cast("string").alias("ct2010"),
            (k % 911).cast("string").alias("cb2010"),
            (F.col("n_nationkey") + 1).alias("council"),
            (F.col("n_nationkey") + 10_000).alias("zipcode"),
            F.concat(k.cast("string"), F.lit(" MAIN ST")).alias("address"),
            F.substring("c_mktsegment", 1, 1).alias("ownertype"),
            F.col("c_name").alias("ownername"),
            (k % 3 + 1).cast("int").alias("numbldgs"),
            ((k % 40).cast("float") / 2).cast("float").alias("numfloors"),
            F.when(k % 13 != 0, units).alias("unitsres"),
            F.when(k % 11 != 0, units + (k % 5).cast("int")).alias("unitstotal"),
            (k % 120 + 1900).cast("int").alias("yearbuilt"),
            F.when(k % 7 == 0, (k % 100).cast("int")).alias("condono"),
            ((k % 64).cast("float") / 64 - 74).cast("float").alias("lon"),
            ((k % 32).cast("float") / 64 + 40).cast("float").alias("lat"),
            F.when(k % 4 == 0, F.concat(F.lit("D"), (k % 6).cast("string"))).alias("histdist"),
            F.when(k % 9 == 0, F.lit("LANDMARK")).alias("landmark"),
        )

    @once
    def bills(self) -> DataFrame:
        """orders with the lot they bill and the bill day (first day of the quarter)."""
        customer = self.owners_of_lots().select("c_custkey", "bbl", "c_name", "n_name")
        return (
            self.table("orders")
            .join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .withColumn("activitythrough", F.trunc("o_orderdate", "quarter"))
        )

    @once
    def rawdata(self) -> DataFrame:
        """Key/value rows of all bills.

        One branch per kind of order line: a filter on a key then folds to a constant in the other
        branches, which Catalyst drops together with their scans.
        """
        bill = self.bills()
        status, at = F.col("o_orderstatus"), F.col("o_orderkey") * 100
        notice_day = F.make_date(F.year("o_orderdate"), F.lit(1), F.lit(15))
        notices = bill.filter(status == "O")
        from_orders = [
            _line(bill, None, "Owner name",
                  F.when(status == "F", F.concat("c_name", F.lit(" LLC"))).otherwise(F.col("c_name")),
                  at),
            _line(bill.filter(status != "P"), None, "Mailing address",
                  F.concat("c_name", F.lit("\\n"), "n_name"), at + 1),
            _line(bill, "details", "annual property tax", F.col("o_totalprice"), at + 2),
            _line(bill, "details-exemptions",
                  by_pair("o_orderpriority", "o_orderstatus", EXEMPTION_KEYS), F.lit("-100.0"), at + 3),
            _line(notices, "nopv", "Gross income", F.col("o_totalprice"), at + 4, day=notice_day),
            _line(notices, "nopv", "Expenses", F.floor(F.col("o_totalprice") / 4).cast("double"),
                  at + 5, day=notice_day),
        ]
        return reduce(DataFrame.unionByName, [self.charges(), *from_orders])

    @once
    def charges(self) -> DataFrame:
        """Charge and payment lines: one row per line item."""
        items = self.table("lineitem").join(
            self.bills().select("o_orderkey", "bbl", "activitythrough"),
            F.col("l_orderkey") == F.col("o_orderkey"),
        )
        flag, state = F.col("l_returnflag"), F.col("l_linestatus")
        fee = (flag == "R") & (state == "O")
        name = by_pair("l_returnflag", "l_linestatus", {k: v[0] for k, v in CHARGE_KEYS.items()})
        registration = F.concat(
            F.when(F.col("l_discount") >= 0.08, F.lit("R")).otherwise(F.lit("")),
            F.col("l_suppkey").cast("string"),
        )
        return _line(
            items,
            by_pair("l_returnflag", "l_linestatus", {k: v[1] for k, v in CHARGE_KEYS.items()}),
            F.when(fee & (F.col("l_tax") >= 0.08), F.upper(name)).otherwise(name),
            F.col("l_extendedprice"),
            F.col("l_orderkey") * 100 + 10 + F.col("l_linenumber"),
            due=F.when(fee & (F.col("l_discount") > 0), F.col("l_shipdate")),
            activity=F.when(~fee, F.col("l_shipdate")),
            meta=F.when(fee & (F.col("l_tax") > 0), registration)
            .when(flag == "A", F.concat(F.lit("BANK "), F.col("l_suppkey").cast("string"))),
            apts=F.when(fee, F.col("l_quantity").cast("int")),
        )

    @once
    def listed(self) -> DataFrame:
        """List entries: lots by year; years before ``LIST_FROM`` are known but were not published."""
        return (
            self.bills().filter(F.col("o_orderstatus") == "F")
            .select(
                "bbl",
                F.year("o_orderdate").alias("year"),
                (F.col("o_orderdate") >= LIST_FROM).alias("published"),
                F.call_function("div", F.col("bbl"), F.lit(1_000_000_000)).cast("int")
                .alias("boro_code"),
                (F.call_function("div", F.col("bbl"), F.lit(10_000)) % 100_000).cast("int")
                .alias("block"),
                (F.col("bbl") % 10_000).cast("int").alias("lot"),
            )
            .distinct()
        )

    @once
    def official(self) -> DataFrame:
        """Yearly totals by borough; borough 5 has drafts (source ``draft``) only from 1998 on."""
        bill = self.bills()
        status = F.col("o_orderstatus")
        counts = bill.groupBy(
            F.call_function("div", F.col("bbl"), F.lit(1_000_000_000)).cast("smallint")
            .alias("borough"),
            F.year("o_orderdate").alias("year"),
        ).agg(
            F.count_if(status == "O").cast("int").alias("add_421a"),
            (-F.count_if(status == "P")).cast("int").alias("total_sub"),
        )
        add = F.col("add_421a") * 1.5
        draft = (F.col("year") >= 1998) & (F.col("borough") == 5)
        return counts.select(
            F.when(draft, "draft").otherwise("rgb").alias("source"), "borough", "year", "add_421a", "total_sub",
            add.cast("float").alias("total_add"),
            (add + F.col("total_sub")).cast("float").alias("net"),
        )

    @once
    def bill_paths(self) -> DataFrame:
        """orders with the folder and date part of their bill's path."""
        bbl, day = F.col("bbl"), F.date_format("o_orderdate", "MMMM d, yyyy")
        part = lambda c, width: F.lpad(c.cast("string"), width, "0")
        return self.bills().withColumn("lot_dir", F.concat_ws(
            "/", F.lit("data"), F.col("o_orderkey").cast("string"),
            F.expr("cast(bbl div 1000000000 as string)"),
            part(F.expr("bbl div 10000 % 100000"), 5), part(bbl % 10_000, 4),
        )).withColumn("day_text", day)

    def _documents(self, *named: tuple[str, Column]) -> DataFrame:
        """A document per order and name, with its text."""
        # The array keeps the optimizer from copying the long text expression into every use.
        printed = F.explode(F.array(*[F.struct(F.lit(f" - {name}").alias("name"), text.alias("text")) for name, text in named]))
        # A text is many times the size of its order: spread the orders before printing them.
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        orders = self.bill_paths().repartition(parts, "o_orderkey").withColumns(
            {name: F.expr(text) for name, text in _PRINTED.items()}).select("lot_dir", "day_text", printed.alias("p"))
        path = F.concat_ws("", "lot_dir", F.lit("/"), "day_text", "p.name")
        return document_columns(orders.select(path.alias("path"), "p.text"))

    @once
    def bill_documents(self) -> DataFrame:
        """One printed bill per order.

        Some lines depend on the order: bills of status P have a page gap, urgent ones an
        unreadable abatement line, low-priority P ones no owner area; status F bills show no
        registration.
        """
        return self._documents(self._bill())

    @once
    def html_documents(self) -> DataFrame:
        """One HTML statement per order: two readable rows (O), one broken row (F), or a section
        over two lines (P)."""
        return self._documents(self._statement())

    @once
    def notice_documents(self) -> DataFrame:
        return self._documents(self._notice())

    @once
    def every_document(self) -> DataFrame:
        """Bill, statement and notice of each order, from one pass over the orders."""
        return self._documents(self._bill(), self._statement(), self._notice())

    def _bill(self) -> tuple[str, Column]:
        return "Quarterly Property Tax Bill.txt", F.concat(F.expr(BILL_TEXT), F.lit("\n"))

    def _statement(self) -> tuple[str, Column]:
        return "Quarterly Statement of Account.html", F.expr(HTML_TEXT)

    def _notice(self) -> tuple[str, Column]:
        return "Notice of Property Value.txt", F.expr(NOTICE_TEXT)

    @once
    def file_listing(self) -> DataFrame:
        """A PDF per order, beside it its text when the order is final (F)."""
        pdf = F.concat(F.col("lot_dir"), F.lit("/"), F.col("day_text"),
                       F.lit(" - Quarterly Property Tax Bill.pdf"))
        base = self.bill_paths().select(pdf.alias("path"), "o_orderstatus")
        texts = base.filter("o_orderstatus = 'F'").select(
            F.regexp_replace("path", r"\.pdf$", ".txt").alias("path")
        )
        return base.select("path").union(texts)

    @once
    def event_files(self) -> DataFrame:
        """Files each user (as lot) holds: one per event, by type a PDF, its text, a doubled PDF
        or a marker that nothing was published."""
        name = F.concat(F.date_format("ts", "MMMM d, yyyy"),
                        F.lit(" - Quarterly Property Tax Bill"))
        kind = F.col("event_type")
        return self.table("events").select(
            F.col("user_id").alias("bbl"),
            F.when(kind == "click", F.concat(name, F.lit(".txt")))
            .when(kind == "error", F.concat(
                F.lit("nostatement."), F.date_format("ts", "yyyyMMdd"), F.lit(".txt")))
            .when(kind == "view", F.concat(name, F.lit(".pdf.pdf")))
            .otherwise(F.concat(name, F.lit(".pdf"))).alias("file"),
        )

    @once
    def known_files(self) -> DataFrame:
        """Files held of the known publications, one per order: its lot's document of one period, by order
        status as PDF, as its text, or as a marker that the period has none."""
        known = self.spark.createDataFrame(list(enumerate(names.known_periods())),
                                           "nr bigint, p struct<period: string, doc_type: string, docname: string>")
        status = F.col("o_orderstatus")
        return self.bills().join(known, F.col("o_orderkey") % known.count() == F.col("nr")).select(
            "bbl", F.when(status == "O", F.col("p.docname"))
            .when(status == "F", F.regexp_replace("p.docname", r"\.pdf$", ".txt"))
            .otherwise(F.concat(F.lit("nostatement."), "p.period", F.lit(".txt"))).alias("file"))

    @once
    def responses(self) -> DataFrame:
        """Events as server answers: a content type and the county asked about."""
        counties = ["New York County", "Bronx", "kings", "Queens County", "RICHMOND", "Albany"]
        kind = F.col("event_type")
        return self.table("events").select(
            "event_id",
            F.when(kind == "click", "text/html; charset=utf-8").when(kind == "view",
                                                                      "application/pdf")
            .otherwise("text/plain").alias("content_type"),
            F.array(*[F.lit(c) for c in counties])[(F.col("user_id") % 6).cast("int")]
            .alias("county"),
        )

    @once
    def lot_lines(self) -> DataFrame:
        """Lot list lines: three cells, one cell, or (building segment) two cells."""
        p = F.col("c_custkey").cast("string")
        b = F.col("n_regionkey") + 1
        segment = F.col("c_mktsegment")
        return self.owners_of_lots().select(
            F.when(segment == "BUILDING", F.concat_ws("\t", borough_code(b), p))
            .when(segment == "MACHINERY", F.col("bbl").cast("string"))
            .otherwise(F.concat_ws(
                "\t", borough_code(b), F.expr("cast(c_custkey div 10000 as string)"),
                F.expr("cast(c_custkey % 10000 as string)"))).alias("line"),
        )
