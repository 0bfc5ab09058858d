"""Keys, parcels given twice, and panels of one year."""

from pyspark.sql import functions as F

from lotledger.operators import panel, quality


def test_one_per(spark):
    rows = [(1, 2, "a"), (1, 3, None), (1, None, "z"), (2, None, None), (None, 1, "x")]
    df = spark.createDataFrame(rows, "k int, a int, b string")
    assert sorted(tuple(r) for r in quality.one_per(df, ["k"]).collect()) == [(1, 3, None), (2, None, None)]


def test_violations(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "a int, b int")
    got = quality.violations({"t": (df, ["a", "b"]), "u": (df.limit(0), ["a"])}).collect()
    assert [tuple(r) for r in got] == [("t", "a, b", 1, 2), ("u", "a", 0, 0)]


def test_doubled_parcel_and_single_year(spark):
    regs = spark.createDataFrame([("R", 2010, None, 7, None, 5, "N")],
                                 "regno string, ucyear int, dhcryear int, ucbbl long, dhcrbbl long, maxunits int, indhcr string")
    codes = spark.createDataFrame([], "bbl long, activitythrough date, abatement string")
    lots = spark.createDataFrame([(7, "MN", 4), (7, "MN", 6)], "bbl long, borough string, unitstotal int")
    for c in panel.PARCEL_COLUMNS:
        if c not in lots.columns:
            lots = lots.withColumn(c, F.lit(None).cast("int"))
    built = panel.panel(regs, codes, lots, [2010])
    assert [(r.ucbbl, r.unitstotal) for r in built.collect()] == [(7, 6)]
    assert panel.fill(built, [2010]).collect() == built.collect()
