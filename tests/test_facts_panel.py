import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from lotledger.operators import compare, facts, income, lookup, manifest, panel, quality, summaries
from lotledger.sources.readers import RAW_SCHEMA

YEARS = list(range(2007, 2018))
RAW = RAW_SCHEMA + ", line_no BIGINT"


def raw(spark, *rows):
    full = []
    for i, r in enumerate(rows):
        base = dict(bbl=1000010001, activitythrough=date(2015, 6, 5), section=None, key=None,
                    duedate=None, activitydate=None, value=None, meta=None, apts=None, line_no=i)
        full.append(tuple({**base, **r}.values()))
    return spark.createDataFrame(full, RAW)


def fee(due, **more):
    return dict(key="Housing-Rent Stabilization", duedate=due, value="380.0", apts="38", **more)


def test_unit_years_and_repair(spark):
    dues = [date(2012, 4, 1), date(2012, 4, 2), date(2013, 4, 1), date(2011, 4, 1), None]
    units = facts.unit_counts(raw(
        spark, *[fee(d, meta="12 3") for d in dues],
        fee(dues[0], meta="R12") | {"value": "385.00"}, fee(dues[0]) | {"value": "$3,850.00"},
        fee(dues[0], meta="12") | {"key": "HOUSING-RENT STABILIZATION"},
    )).collect()
    assert [r.year for r in units[:5]] == [2012, 2010, 2011, 2011, None]
    assert [r.units for r in units] == [38] * 5 + [39, 38, 38]
    assert str(units[6].amount) == "3850.00"


LISTED = [(1, 2009), (1, 2010), (2, 2009), (2, 2010)]


def regs(spark, uc, listed):
    schema = "bbl bigint, activitythrough date, duedate date, year int, units int, meta string"
    df = spark.createDataFrame(
        [(b, None, date(y or 2000, 4, 1), y, u, m) for b, y, u, m in uc], schema)
    rows = facts.registrations(df, spark.createDataFrame(listed, "bbl bigint, year int"))
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def test_registrations(spark):
    got = regs(spark, [(1, 2008, 38, "a"), (1, 2009, 38, "a"), (1, 2009, 38, "a"),
                       (1, 2009, 40, "a"), (3, 2010, 5, "b")], LISTED)
    day = lambda y: date(y, 4, 1)
    assert got == sorted([
        ("a", day(2008), 2008, None, 1, None, 38, 1, "?"),
        ("a", day(2009), 2009, 2009, 1, 1, 40, 2, "Y"),
        ("b", day(2010), 2010, None, 3, None, 5, 1, "N"),
        (None, None, None, 2010, None, 1, None, 0, "Y"),
        (None, None, None, 2010, None, 2, None, 0, "Y"),
    ], key=repr)


@pytest.mark.parametrize("listed, flags", [
    ([(9, 2009)], ["?", "N", "N", "Y"]),
    ([(9, 2009), (9, None)], ["N", "N", "N", "Y"]),
    ([], ["?", "?", "?"]),
])
def test_flag_with_nulls(spark, listed, flags):
    got = regs(spark, [(1, 2008, 1, "a"), (1, None, 1, "b"), (1, 2009, 1, "c")], listed)
    by_id = {r[0]: r[-1] for r in got}
    assert [by_id[k] for k in ("a", "b", "c")] == flags[:3]
    assert all(r[-1] == "Y" for r in got if r[0] is None)


def panel_of(spark, lots, years=YEARS):
    """lots: {bbl: {year: (uc, dhcr, abat)}}"""
    rows = [
        (b, [(y, cells.get(y, (None,))[0], "N",
              (cells.get(y, (None, None)) + (None,))[1],
              (cells.get(y, (None, None, None)) + (None, None))[2]) for y in years])
        for b, cells in lots.items()
    ]
    return spark.createDataFrame(
        rows, "ucbbl bigint, "
        "cells array<struct<year: int, uc: int, est: string, dhcr: string, abat: string>>")


def filled(df, policy="as_run", years=YEARS):
    rows = panel.fill(df, years, policy).collect()
    return {r.ucbbl: {c.year: (c.uc, c.est) for c in r.cells} for r in rows}


def test_fill_fixtures(spark):
    got = filled(panel_of(spark, {
        1: {2007: (10,)},
        2: {2007: (10,), 2009: (None, None, "j51")},
        3: {2010: (5, None, "421a"), 2011: (None, None, "421a"), 2012: (None, None, "j51")},
        4: {2012: (7,), 2013: (None, "Y")},
        5: {2012: (7,), 2013: (None, None, "scrie")},
        6: {2010: (9, None, "j51"), 2009: (None, None, "j51")},
        7: {2012: (7,), 2013: (3, "Y")},
    }))
    pick = lambda lot, *years: [got[lot][y] for y in years]
    none = (None, "N")
    assert pick(1, 2007, 2008, 2009) == [(10, "N"), (10, "Y"), none]
    assert pick(2, 2008, 2009, 2010) == [(10, "Y"), (None, "Y"), none]
    assert pick(3, 2007, 2008, 2009, 2011, 2012) == [none, none, none, (5, "Y"), none]
    assert pick(4, 2013) == [(7, "Y")]
    assert pick(5, 2013) == [none]
    assert pick(6, 2007, 2008, 2009) == [(9, "Y")] * 3
    assert pick(7, 2013) == [(3, "N")]
    assert filled(panel_of(spark, {5: {2012: (7,), 2013: (None, None, "scrie")}}),
                  "documented")[5][2013] == (7, "Y")


def simulate(cells, policy):
    """The fill rules, one year after the other."""
    uc = {y: cells.get(y, (None,))[0] for y in YEARS}
    dhcr = {y: (cells.get(y, ()) + (None,) * 3)[1] for y in YEARS}
    abat = {y: (cells.get(y, ()) + (None,) * 3)[2] for y in YEARS}
    est = dict.fromkeys(YEARS, "N")

    def keeps(y, other):
        a = abat[y] or ""
        a = a if policy == "as_run" else a.upper()
        return ((abat[y] is not None and abat[y] == abat[other])
                or "SCRIE" in a or "DRIE" in a or dhcr[y] == "Y")

    for y in YEARS[1:]:
        if uc[y] is None and uc[y - 1] is not None:
            if y == 2009 and policy == "as_run":
                est[y] = "Y" if keeps(y, y) else est[y]
            elif y == 2008 or keeps(y, y - 1):
                uc[y], est[y] = uc[y - 1], "Y"
    for y in reversed(YEARS[:-1]):
        if uc[y] is None and uc[y + 1] is not None and (y <= 2008 or keeps(y, y + 1)):
            uc[y], est[y] = uc[y + 1], "Y"
    return {y: (uc[y], est[y]) for y in YEARS}


@pytest.mark.parametrize("policy", ["as_run", "documented"])
def test_fill_against_simulation(spark, policy):
    rng = random.Random(11)
    lots = {
        b: {y: (rng.choice([None, None, rng.randint(1, 9)]), rng.choice([None, None, "Y"]),
                rng.choice([None, "j51", "421a", "SCRIE", "drie,j51"])) for y in YEARS}
        for b in range(1500)
    }
    got = filled(panel_of(spark, lots).repartition(7, F.rand(5)), policy)
    assert got == {b: simulate(cells, policy) for b, cells in lots.items()}


def test_panel_round_trip_and_summary(spark):
    uc = spark.createDataFrame(
        [("a", date(2007, 4, 1), 2007, None, 1, None, 20, 1, "N"),
         ("a", date(2017, 4, 1), 2017, 2017, 1, 1, 5, 1, "Y"),
         ("b", date(2017, 4, 1), 2017, 2017, 1, 1, 3, 1, "Y"),
         (None, None, None, 2017, None, 2, None, 0, "Y")],
        "regno string, duedate date, ucyear int, dhcryear int, ucbbl bigint, dhcrbbl bigint, "
        "maxunits int, diffunits int, indhcr string")
    ab = spark.createDataFrame([(1, date(2010, 6, 1), "j51", 1), (1, date(2012, 6, 1), "j51", 2),
                                (1, date(2012, 6, 1), "421a", 1)],
                               "bbl bigint, activitythrough date, abatement string, cnt int")
    parcels = ", ".join(
        f"{c} {'string' if c in ('ct2010', 'cb2010', 'address', 'ownername') else 'int'}"
        for c in panel.PARCEL_COLUMNS)
    values = {"unitsres": 30, "unitstotal": 32}
    lots = spark.createDataFrame(
        [(1, "MN", *[values.get(c) for c in panel.PARCEL_COLUMNS])],
        f"bbl bigint, borough string, {parcels}")
    p = panel.panel(uc, ab, lots, YEARS)
    wide = panel.to_wide(p, YEARS)
    row = wide.collect()
    assert len(row) == 1 and row[0]["2007uc"] == 20 and row[0]["2017uc"] == 8
    assert row[0]["2017dhcr"] == "Y" and row[0]["2012abat"] == "421a,j51"
    back = panel.to_wide(panel.from_wide(wide, YEARS), YEARS)
    assert back.collect() == row
    assert panel.to_long(p).count() == len(YEARS)
    s = summaries.changes_summary(p, YEARS).collect()[0]
    assert (s.unitstotal, s.unitsstab2007, s.unitsstab2017, s.diff) == (32, 20, 8, -12)
    assert (s.percentchange, s.j51, s["421a"], s.scrie) == (
        -37.5, "2010 - 2012", "2012 - 2012", None)
    official = spark.createDataFrame([("x", 0, 2017, -3, 2.5, -0.5)],
                                     "source string, borough int, year int, total_sub int, "
                                     "total_add float, net float")
    moves = {r.year: r for r in compare.compare_official(p, official).collect()}
    assert (moves[2017].rgb_gain, moves[2017].rgb_diff, moves[2016].rgb_loss) == (2, 0, 0)
    assert moves[2017].dof_diff is None and moves[2016].diff_diff == 0


def test_lookups(spark):
    d = date(2015, 6, 5)
    r = raw(spark, fee(date(2014, 4, 1), meta="a", activitythrough=date(2014, 6, 1)),
            fee(date(2014, 4, 1), meta="a", activitythrough=d) | {"apts": "50"},
            fee(date(2014, 4, 1), meta=None, activitythrough=d) | {"apts": None},
            fee(date(2014, 4, 1), meta="b", activitythrough=d) | {"apts": "2"},
            dict(key="annual property tax", value="7.0", activitythrough=d),
            dict(key="annual property tax", value="9.0", activitythrough=d),
            dict(bbl=2000020003, key="Housing-Rent Stabilization"))
    history = {x.bbl: x.units for x in lookup.unit_history(r).collect()}
    assert history == {1000010001: 40, 2000020003: 0}
    summary = {x.bbl: x for x in lookup.lot_summary(r).collect()}
    assert (summary[1000010001].property_tax, summary[1000010001].regno) == ("7.0", "b")
    profile = lookup.lot_profile(r, "2015-06-05")
    assert [tuple(x) for x in lookup.missing_stabilized(profile).collect()] == [(2, 2, 3)]


def test_income_modes(spark):
    lots = spark.createDataFrame(
        [(1, *[None] * len(income.INCOME_PARCEL_COLUMNS))],
        "bbl bigint, " + ", ".join(f"{c} string" for c in income.INCOME_PARCEL_COLUMNS))
    est = spark.createDataFrame(
        [(1, date(2010, 1, 15), "gross income", v) for v in ("99.0", "100.0")],
        "bbl bigint, activitythrough date, key string, value string")
    assert income.income_by_year(est, lots, [2010]).first().income10 == 100.0
    assert income.income_by_year(est, lots, [2010], "as_run").first().income10 == "99.0"


def test_quality(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, None), (1, None)], "a int, b int")
    assert quality.duplicates(df, ["a", "b"]).count() == 1
    assert quality.duplicates(df, ["a", "b"], nulls_distinct=False).count() == 2
    assert quality.null_keys(df, ["a", "b"]).count() == 2
    with pytest.raises(ValueError):
        quality.assert_unique(df, ["a", "b"])


def test_work_list(spark):
    periods = [("20170602", "SOA", "June 2, 2017 - Quarterly Property Tax Bill.pdf"),
               ("20160115", "NOPV", "January 15, 2016 - Notice of Property Value.pdf"),
               ("20160115", "TAR", "January 15, 2016 - Tentative Assessment Roll.html")]
    lots = spark.createDataFrame([(i,) for i in (1, 1, 2, 3, 4)], "bbl bigint")
    files = spark.createDataFrame(
        [(1, periods[0][2]), (2, periods[0][2].replace(".pdf", ".txt")), (3, periods[0][2] + ".pdf"),
         (4, "nostatement.20160115.txt"), (2, periods[2][2])], "bbl bigint, file string")
    table = manifest.period_table(spark, periods)
    todo = manifest.work_list(lots, table, files).collect()
    assert sorted((r.bbl, r.doc_type) for r in todo) == [
        (1, "NOPV"), (1, "TAR"), (2, "NOPV"), (3, "NOPV"), (3, "TAR"), (4, "SOA")]
    assert manifest.expected_documents(lots, table).count() == 12
    assert {(r.bbl, r.docname) for r in manifest.held_documents(files, table).collect()} == {
        (1, periods[0][2]), (2, periods[0][2]), (2, periods[2][2]), (3, periods[0][2]), (4, periods[1][2]), (4, periods[2][2])}
    assert manifest.work_list(lots, manifest.period_table(spark, []), files).count() == 0


def test_work_list_of_many_periods(spark):
    """Three thousand periods; what is held is one row per lot, and no pair is shuffled."""
    import datetime

    days = [datetime.date(2010, 1, 1) + datetime.timedelta(k) for k in range(3000)]
    periods = [(f"{d:%Y%m%d}", "SOA", f"{d:%Y%m%d} - bill.pdf") for d in days]
    rng = random.Random(4)
    held = [(bbl, k) for bbl in range(1, 40) for k in rng.sample(range(3000), rng.choice([0, 1, 64, 1500, 3000]))]
    files = spark.createDataFrame([(b, periods[k][2]) for b, k in held] + [(99, "other.pdf"), (None, periods[0][2])], "bbl bigint, file string")
    lots = spark.createDataFrame([(b,) for b in range(1, 41)], "bbl bigint")
    todo = manifest.work_list(lots, manifest.period_table(spark, periods), files)
    want = {(b, periods[k][0]) for b in range(1, 41) for k in range(3000)} - {(b, periods[k][0]) for b, k in held}
    got = [(r.bbl, r.period) for r in todo.select("bbl", "period").collect()]
    assert len(got) == len(want) and set(got) == want
    plan = todo._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan and "Cross" not in plan
    missing = manifest.missing_periods(lots, spark.createDataFrame([(p,) for p, _, _ in periods], "period string"),
                                       spark.createDataFrame([(b, periods[k][0]) for b, k in held], "bbl bigint, period string"))
    assert {(r.bbl, r.period) for r in missing.collect()} == want


def test_shards_keep_copies(spark):
    rng = random.Random(3)
    ids = [rng.choice([1000010001, 1000010002, 1000020001, 2000010001, 2000010007, 5000010001])
           for _ in range(200)]
    got = manifest.shards(spark.createDataFrame([(i,) for i in ids], "bbl bigint"), 7).collect()
    want = {}
    for at, bbl in enumerate(sorted(ids)):
        want[bbl, at // 7] = want.get((bbl, at // 7), 0) + 1
    assert {(r.bbl, r.shard): r.copies for r in got} == want


def test_doubled_parcels_count_once(spark):
    units = spark.createDataFrame([(1, 1999)], "bbl long, year int")
    listed = spark.createDataFrame([(1, 1999), (2, 1999)], "bbl long, year int")
    lots = spark.createDataFrame([(2, 5, 4), (2, 5, 4), (2, 6, None), (None, 1, 1)], "bbl long, unitstotal int, unitsres int")
    assert [tuple(r) for r in lookup.list_only_lots(units, listed, lots).collect()] == [(2, 6, None)]
    cells = "array<struct<year:int,uc:int,abat:string>>"
    panel = spark.createDataFrame([(2, 101, [(1998, 4, None), (1999, 3, None)])], f"ucbbl long, cd int, cells {cells}")
    marks = spark.createDataFrame([(2, "H", None), (2, "H", None)], "bbl long, histdist string, landmark string")
    got = summaries.landmark_change(panel, marks, (1998, 1999), 1998, 1999).collect()
    assert [(r.cd, r.ishist, r["1998"], r["1999"], r.change) for r in got] == [(101, True, 4, 3, -25.0)]
