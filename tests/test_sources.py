import pathlib
import json

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lotledger.operators import facts, lookup, ordering
from lotledger.sources import documents, readers, writers
from lotledger.streaming import ingest
from test_extract import HTML, PAGE, RENT, TEXT, short

NAME = "June 2, 2017 - Quarterly Property Tax Bill"


@pytest.fixture()
def tree(tmp_path):
    lot = tmp_path / "data" / "1" / "00274" / "0004"
    lot.mkdir(parents=True)
    (lot / f"{NAME}.txt").write_text(TEXT)
    (lot / f"{NAME}.pdf").write_bytes(b"%PDF")
    (lot / f"{NAME}_corrupted.txt").write_text(TEXT)
    (lot / "data.json").write_text("[]")
    (lot / "June 3, 2017 - Quarterly Property Tax Bill.txt").write_text("")
    (lot / "notes.txt").write_text("x")
    (lot / HTML.split("/")[-1]).write_text(PAGE.format(RENT))
    return tmp_path


def test_read_documents(spark, tree):
    rows = documents.read_documents(spark, str(tree / "data")).orderBy("path").collect()
    got = [(r.path.split("/")[-1], r.bbl, str(r.activity_through), r.kind) for r in rows]
    assert got == [
        ("August 22, 2008 - Quarterly Statement of Account.html", 1002740004, "2008-08-22", "html"),
        (f"{NAME}.txt", 1002740004, "2017-06-02", "text"),
    ]


def test_ingest_adds_nothing_twice(spark, tree):
    sink, lot = str(tree / "sink"), tree / "data" / "1" / "00274" / "0004"
    run = lambda c: ingest.ingest_stream(
        spark, str(tree / "data"), sink, str(tree / c)).awaitTermination()
    run("check")
    once = short(ingest.ingested_rows(spark, sink))
    assert len(once) == 16 + 2
    run("check")
    assert short(ingest.ingested_rows(spark, sink)) == once
    (lot.parent / "0005").mkdir()
    (lot.parent / "0005" / f"{NAME}.txt").write_text(TEXT)
    run("check")
    assert ingest.ingested_rows(spark, sink).count() == len(once) + 16


def test_batch_replay_and_relisted_documents(spark, tree):
    sink = str(tree / "sink2")
    docs = documents.read_documents(spark, str(tree / "data"))
    handle = ingest.read_batch(sink)
    for batch in (0, 0, 1, 1):
        handle(docs, batch)
    assert ingest.ingested_rows(spark, sink).count() == 18


def test_rawdata_round_trip(spark, tmp_path):
    row = (1002740004, "2017-06-02", None, 'a "quoted", key', None, None, "line\nbreak", None, "12")
    raw = spark.createDataFrame([row], readers.RAW_SCHEMA.replace("DATE", "STRING")).select(
        *[F.col(c).cast("date") if c in ("activitythrough", "duedate", "activitydate") else c
          for c in writers.HEADERS])
    writers.write_rawdata_csv(raw, str(tmp_path / "csv"))
    back = readers.read_rawdata(spark, str(tmp_path / "csv"), multiline=True)
    assert back.select(*raw.columns).collect() == raw.collect()
    assert back.dtypes[-2:] == [("doc_path", "string"), ("line_no", "bigint")]
    writers.write_rawdata(raw, str(tmp_path / "parquet"))
    stored = spark.read.parquet(str(tmp_path / "parquet"))
    assert stored.select("key_lc", "key_class").collect() == [('a "quoted", key', "owner")]
    writers.write_lot_json(raw, str(tmp_path / "json"))
    files = list((tmp_path / "json" / "borough=1" / "block=00274" / "lot=0004").glob("*.json"))
    assert [json.loads(line) for f in files for line in f.read_text().splitlines()] == [
        {"bbl": 1002740004, "activityThrough": "2017-06-02", "key": 'a "quoted", key',
         "value": "line\nbreak", "apts": "12"}
    ]


def test_lists(spark, tmp_path):
    (tmp_path / "lots.tsv").write_text("1\t274\t4\nMN\t00274\t0005\n3012340001\n1\t2\n")
    good, bad = readers.read_lot_list(spark, str(tmp_path / "lots.tsv"))
    assert sorted(r.bbl for r in good.collect()) == [1002740004, 1002740005, 3012340001]
    assert [r.line for r in bad.collect()] == ["1\t2"]
    (tmp_path / "parcels.csv").write_text('"MN","  274",   4,"x"\n"SI",12,1,"y"\n')
    good, bad = readers.read_parcel_list(spark, str(tmp_path / "parcels.csv"))
    assert sorted(r.bbl for r in good.collect()) == [1002740004, 5000120001]
    assert bad.count() == 0
    (tmp_path / "addr.tsv").write_text("1153\tPresident St\t3\n")
    assert [tuple(r) for r in readers.read_address_list(spark, str(tmp_path / "addr.tsv")).collect()
            ] == [("1153", "President St", 3)]
    (tmp_path / "roll.csv").write_text('"1000010001","x"\n"1000010002","y"\n')
    roll = readers.read_assessment_roll(spark, str(tmp_path / "roll.csv"))
    assert sorted(r.bbl for r in roll.collect()) == ["1000010001", "1000010002"]


def test_official_totals_and_exports(spark, tmp_path):
    names = [c.split()[0] for c in readers.OFFICIAL_SCHEMA.split(", ")]
    values = {"source": "x", "borough": "1", "year": "2010", "total_sub": "-5", "net": "1.5"}
    (tmp_path / "o.csv").write_text(
        ",".join(names) + "\n" + ",".join(values.get(n, "") for n in names) + "\n")
    row = readers.read_official_totals(spark, str(tmp_path / "o.csv")).collect()[0]
    assert (row.borough, row.total_sub, row.net, row.add_421a) == (1, -5, 1.5, None)
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    writers.export_csv(df, str(tmp_path / "out"), header=False, sep="\t")
    text = "".join(f.read_text() for f in (tmp_path / "out").glob("*.csv"))
    assert text == "1\t2\n"
    parts = df.select(F.lit("1").alias("borough"), F.lit("2").alias("block"),
                      F.lit("3").alias("lot"), "a")
    writers.write_relayout(parts, str(tmp_path / "lay"))
    assert (tmp_path / "lay" / "borough=1" / "block=2" / "lot=3").is_dir()


def test_splittable_rawdata_feeds_the_operators(spark, tmp_path):
    rows = [(1002740004, "2017-06-02", "Current Charges", "Housing-Rent Stabilization", "2017-04-01", None, "380.0", "R1 00", "38"),
            (1002740004, "2017-06-02", "details", "annual property tax", None, None, "43122.0", None, None)]
    raw = spark.createDataFrame(rows, readers.RAW_SCHEMA.replace("DATE", "STRING"))
    writers.write_rawdata_csv(raw, str(tmp_path / "csv"))
    back = readers.read_rawdata(spark, str(tmp_path / "csv"))
    assert [r.units for r in lookup.unit_history(back).collect()] == [38]
    assert [(r.property_tax, r.apts) for r in lookup.lot_summary(back).collect()] == [("43122.0", "38")]


def test_stored_rows_are_pruned(spark, tmp_path):
    rows = [(1002740004, "2017-06-02", s, k, None, None, "1", None, None) for s, k in (
        ("details", "J51 Abatement"), ("nopv", "gross income"), (None, "Owner name"), ("Current Charges", "Payment"))]
    raw = spark.createDataFrame(rows, readers.RAW_SCHEMA.replace("DATE", "STRING")).withColumn(
        "activitythrough", F.col("activitythrough").cast("date"))
    writers.write_rawdata(raw, str(tmp_path / "store"))
    store = readers.read_raw_store(spark, str(tmp_path / "store"))
    for found, plain in ((facts.abatements(store), facts.abatements(raw)), (facts.owners(store), facts.owners(raw)),
                         (facts.value_estimates(store), facts.value_estimates(raw))):
        assert found.collect() == plain.collect() and found.count() == 1
    plan = facts.abatements(store)._jdf.queryExecution().executedPlan().toString()
    assert "key_lc" in plan.split("PushedFilters")[1].split("ReadSchema")[0]
    plan = facts.value_estimates(store)._jdf.queryExecution().executedPlan().toString()
    assert "key_class" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_export_in_order(spark, tmp_path):
    df = spark.range(500).select((F.col("id") * 37 % 101).alias("k"), "id").withColumn("k", F.when(F.col("k") > 90, None).otherwise(F.col("k")))
    writers.export_csv(df, str(tmp_path / "o"), header=False, order=[F.desc_nulls_last("k"), "id"])
    lines = [x for f in sorted((tmp_path / "o").glob("part*.csv")) for x in f.read_text().splitlines()]
    want = sorted(((r.k, r.id) for r in df.collect()), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert lines == [f"{'' if k is None else k},{i}" for k, i in want]
    ranks = {r.id: r["rank"] for r in ordering.numbered(df, [F.desc_nulls_last("k"), "id"]).collect()}
    assert [ranks[i] for _, i in want] == list(range(1, 501))


def test_numbers_of_many_rows(spark):
    """Ranks of more rows than a range sample holds, with columns beside the keys."""
    n = 1_000_000
    df = spark.range(n).select(F.xxhash64("id").alias("k"), "id", F.concat(F.lit("payload "), "id").alias("more"))
    got = ordering.numbered(df, ["k", "id"])
    before = F.lag("k").over(Window.partitionBy(F.expr("(rank - 1) div 1000")).orderBy("rank"))
    seen = got.agg(F.count("*"), F.countDistinct("rank"), F.min("rank"), F.max("rank"), F.sum("id")).first()
    assert tuple(seen) == (n, n, 1, n, n * (n - 1) // 2)
    assert got.withColumn("before", before).filter("before > k").count() == 0
    edges = got.groupBy(F.expr("(rank - 1) div 1000").alias("part")).agg(F.min("k").alias("low"), F.max("k").alias("high"))
    assert edges.withColumn("last", F.lag("high").over(Window.orderBy("part"))).filter("last > low").count() == 0
    assert got.columns == ["k", "id", "more", "rank"] and got.filter("more <> concat('payload ', id)").count() == 0


def test_working_folder_must_be_shared(monkeypatch):
    from types import SimpleNamespace

    from lotledger.sources.working import working_folder

    def session(master, **settings):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: settings.get(k, d)), sparkContext=SimpleNamespace(master=master))

    warehouse = {"spark.sql.warehouse.dir": "/w"}
    assert working_folder(session("local[4]", **warehouse)).startswith("/w/ingest-")
    assert working_folder(session("yarn", **warehouse, **{"spark.checkpoint.dir": "/s/"})).startswith("/s/ingest-")
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://x"):
        with pytest.raises(ValueError):
            working_folder(session(master, **warehouse))


def test_replace_table_switches_versions(spark):
    """Readers keep the version they opened; a write that fails leaves the table as it is."""
    frame = lambda *rows: spark.createDataFrame(list(rows), "a bigint, b string")
    first = writers.replace_table(frame((1, "x"), (2, None)), "staged")
    opened = spark.table("staged")
    second = writers.replace_table(frame((3, "y")), "staged")
    assert first != second
    assert sorted(map(tuple, opened.collect())) == [(1, "x"), (2, None)]
    assert [tuple(r) for r in spark.table("staged").collect()] == [(3, "y")]
    with pytest.raises(Exception):
        writers.replace_table(frame((4, "z")).selectExpr("a", "cast(b AS int) AS b"), "staged")
    assert [tuple(r) for r in spark.table("staged").collect()] == [(3, "y")]
    writers.replace_table(frame(), "staged")  # an empty version is a table too
    assert spark.table("staged").count() == 0
    spark.sql("DROP VIEW staged")


def test_kept_layouts_do_not_make_a_folder_per_lot(spark, monkeypatch):
    from lotledger.plans import catalog

    for name, writer in (("kept_relayout", "write_relayout"), ("kept_lot_json", "write_lot_json")):
        paths, write = [], getattr(writers, writer)
        monkeypatch.setattr(writers, writer, lambda df, path, *a, _w=write, _p=paths, **k: (_w(df, path, *a, **k), _p.append(path)))
        rows = catalog.queries()[name](spark, "/root/testdata/sf0.001").count()
        folder = pathlib.Path(paths[0].removeprefix("file:"))
        assert rows >= 150 and sum(p.is_dir() for p in folder.rglob("*")) <= 5


def test_orders_are_printed_in_one_pass(spark):
    from lotledger.plans import catalog

    sf = "/root/testdata/sf0.001"
    plan = catalog.queries()["document_rows"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("o_orderpriority") and plan.count("Relation [o_orderkey") == 1  # three before
    t = catalog.Tables(spark, sf)
    apart = t.bill_documents().union(t.html_documents()).union(t.notice_documents())
    assert t.every_document().exceptAll(apart).count() == apart.exceptAll(t.every_document()).count() == 0


def test_amounts_and_dates_are_printed_once_per_order(spark):
    from lotledger.plans import catalog

    plan = catalog.Tables(spark, "/root/testdata/sf0.001").every_document()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("format_number(o_totalprice") == plan.count("MM/dd/yyyy") == 1


def test_kept_lot_json_is_packed(spark, monkeypatch, tmp_path):
    """Plain lines took over ten times the disk, a shuffle before them more than packed ones; the rows, block and lot included, stay."""
    from pyspark.sql import functions as F

    from lotledger.plans import catalog

    paths, write = [], writers.write_lot_json
    monkeypatch.setattr(writers, "write_lot_json", lambda df, path, *a, **k: (write(df, path, *a, **k), paths.append(path)))
    t = catalog.Tables(spark, "")
    t.built["rawdata"] = rows = spark.range(20_000).selectExpr(
        "(id % 5 + 1) * 1000000000 + id % 700 as bbl", "date'1998-04-01' as activitythrough", "'Current Charges' as section",
        "concat('Payment ', id % 9) as key", "cast(null as date) as duedate", "date'1998-05-01' as activitydate",
        "cast(id * 7 % 1000 as string) as value", "cast(null as string) as meta", "cast(null as string) as apts", "id as line_no")
    catalog._BUILD["kept_lot_json"](t)
    write(rows, str(tmp_path / "plain"), folders=["borough"])
    size = lambda path: sum(p.stat().st_size for p in pathlib.Path(path).rglob("part-*"))
    packed = paths[0].removeprefix("file:")
    assert 5 * size(packed) < size(tmp_path / "plain")
    a, b = spark.read.json(packed), spark.read.json(str(tmp_path / "plain"))
    assert {"block", "lot"} <= set(a.columns) and a.columns == b.columns and a.count() == 20_000
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0
    bare = rows.withColumn("borough", (F.col("bbl") / 10**9).cast("int"))
    made = {"block": F.lit("0"), "lot": F.lit("0")}
    plans = [writers._in_folders(bare, ["borough"], made, deal)._jdf.queryExecution().optimizedPlan().toString() for deal in (True, False)]
    assert ["Rebalance" in plan for plan in plans] == [True, False]
