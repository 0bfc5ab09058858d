"""Fixed values of documents: headings, phrases and areas printed on them, and what lines of the tax detail are."""

from __future__ import annotations

OWNER_AREA = (
    r"(?isd)Owner name:(.*)Property address:(.*)Borough, block & lot:(.*)"
    r"(Outstanding\s+Charges|Statement\s+Billing\s+Summary)"
)
# Through the last of the words that end an owner area: what is behind them need not be tried.
OWNER_PART = r"(?isd)^.*(?=[os])(?:Outstanding\s+Charges|Statement\s+Billing\s+Summary)"
DETAIL_AREA = (
    r"(?isd)(?=[ah])(Annual property tax detail|How We Calculated Your Property Tax).*"
    r"annual property tax.*?\n"
)
CHARGE_HEADINGS = (
    "Charges You Can Pre-pay", "Amount Not Due [bB]ut That Can [bB]e Paid Early",
    "Tax Year Charges Remaining", "Current Amount Due", "Current Charges",
    "Overpayments/[Cc]redits", "Payment Agreement", "Previous Balance", "Previous Charges",
)
CHARGE_BLOCK = (
    rf"(?sd)(?=[CATOP])({'|'.join(CHARGE_HEADINGS)})[ \n\r]+Activity Date.*?"  # the first letters: fewer tries
    r"(Total|Unpaid Balance, [iI]f Any)[\S ]*"
)
HTML_HEADINGS = (
    "Current Amount Due", "Amount Not Due [bB]ut That Can be Paid Early",
    r"New Charges Due \w+ \d{2}, \d{4}", "Remaining Balance/Credits from Your Last Statement",
    "Previous Balance",
)
HTML_BLOCK = rf"(?d)(?=[CANRP])({'|'.join(HTML_HEADINGS)})[^_]+?Activity Date.*?_{{17}}"
HTML_RENT = r"(?id)(Housing-Rent Stabilization.*?)<"
HTML_OWNER = r"(?id)Owner Name:.*?<img[^>]*>([^<]*)<"
INCOME = (
    r"(?d)(?:\s*Gross Income:\s*We estimated gross income at \$(.*)\."
    r"|Estimated Gross Income:\s*\$(.*))"
)
EXPENSES = (
    r"(?d)(?:\s*Expenses:\s*We estimated expenses at \$(.*)\."
    r"|Estimated Expenses:\s*\$(.*))"
)
ACTIVITY_THROUGH = (r"(?id)Activity through (.*)", r"(?id)Last Statement Through (.*?)\)")
RENT_KEY = "Housing-Rent Stabilization"
NOT_DETAILS = ("value", "tax rate", "overall")
GAP_STARTS = ("pay today", "home banking payment instructions")
NOTES = ("State law recently changed", "Due to this change,")

BLOCK_STEP = 1_000_000_000  # line_no = block number * BLOCK_STEP + line within the block

# What a line of the tax detail is, before modes, by its first cell in lower case with a bar behind it.
BRANCHES = {
    "tax class": "class", "current tax rate": "second raw", "estimated market value": "second",
    "tax before exemptions and abatements": "before exemptions", "tax before abatements": "before abatements",
    "original tax rate": "original",
}
WHOLE_BRANCHES = {"annual property tax": "total", "new tax rate": "last raw", "revocation": "revocation"} | {
    w: "none" for w in ("", *NOT_DETAILS)}
BRANCH = rf"^({'|'.join(BRANCHES)}|(?:{'|'.join(WHOLE_BRANCHES)})\|\z)"

#: Lines that change what the lines after them are, with the mode of these; the strongest first.
MODES = {"revocation": "details-revocation", "before abatements": "details-abatements",
         "before exemptions": "details-exemptions"}
