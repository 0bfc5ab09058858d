"""Planning which documents to fetch: lots by period, less what is held or known missing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotledger.functions.lots import bbl_number, bbl_text, block_of, borough_of
from lotledger.functions.names import (
    WANTED_TYPES,
    file_name,
    folder,
    held_name,
    request_address,
    stem,
)

Period = tuple[str, str, str]  # period yyyymmdd, document type, document name


def lot_ids(lines: DataFrame, line: str = "line") -> DataFrame:
    """Lot list lines: three cells (borough, block, lot) or one 10-digit cell.

    ``bbl`` is NULL for anything else; split with ``bad_lot_ids``.
    """
    cells = F.split(F.regexp_replace(line, r"^\s+|\s+$", ""), "\t")
    one = F.get(cells, F.lit(0))
    return lines.select(
        F.col(line).alias("line"),
        F.when(F.size(cells) == 3, bbl_number(*[F.get(cells, F.lit(i)) for i in range(3)]))
        .when(F.size(cells) == 1, bbl_number(
            F.substring(one, 1, 1), F.substring(one, 2, 5), F.substring(one, 7, 4)
        )).alias("bbl"),
    )


def good_lot_ids(ids: DataFrame) -> DataFrame:
    return ids.filter(F.col("bbl").isNotNull()).select("bbl")


def bad_lot_ids(ids: DataFrame) -> DataFrame:
    return ids.filter(F.col("bbl").isNull()).select("line")


def parcel_ids(parcels: DataFrame, *columns: str) -> DataFrame:
    """First three columns of a parcel file, blanks and quotes removed, as lot list lines."""
    clean = [F.translate(F.col(c), ' "', "") for c in columns]
    return parcels.select(F.concat_ws("\t", *clean).alias("line"))


def period_table(spark: SparkSession, periods: Sequence[Period]) -> DataFrame:
    """Periods as a table: period, doc_type, docname."""
    return spark.createDataFrame(list(periods), "period string, doc_type string, docname string")


def expected_documents(lots: DataFrame, periods: DataFrame) -> DataFrame:
    """Each lot with each period."""
    return work_list(lots, periods, lots.select("bbl", F.lit(None).cast("string").alias("file")).limit(0))


def held_documents(files: DataFrame, periods: DataFrame) -> DataFrame:
    """(lot, document name) that need no fetch, from ``bbl, file`` listings.

    A document is held under its own name, as the text of its PDF or with a doubled extension;
    ``nostatement.<period>.txt`` marks that none of the period's documents exists.
    """
    return _held(files, periods).select("bbl", "docname").distinct()


def _held(files: DataFrame, periods: DataFrame) -> DataFrame:
    """``bbl`` and the columns of each period that a file holds or a marker settles."""
    marker = F.nullif(F.regexp_extract("file", r"^nostatement\.(.*)\.txt$", 1), F.lit(""))
    named = files.select("bbl", marker.alias("of"), held_name(F.col("file")).alias("name"))
    known = periods.distinct()
    settled = named.filter(F.col("of").isNotNull()).join(known, F.col("of") == F.col("period"))
    own = named.join(known, F.col("name") == F.col("docname"))
    return own.unionByName(settled).drop("of", "name")


WORD = 64  # periods of one word of a lot's bitmap


def _numbered(periods: DataFrame) -> DataFrame:
    """Periods with a number each, from 0. The list has a row per publication, so one task numbers it."""
    order = Window.orderBy(*[F.asc_nulls_last(c) for c in periods.columns])
    return periods.distinct().withColumn("nr", F.row_number().over(order) - 1)


def _lacking(lots: DataFrame, held: DataFrame, numbered: DataFrame) -> DataFrame:
    """Each lot with the periods of which ``held`` (bbl, nr) has no number.

    Numbers become words of a bitmap by partial bitwise sums, one small row per lot; the unset bits are
    expanded in that row. Pairs of lot and period that are held are never made, and none is shuffled.
    """
    count = numbered.count()
    nr = F.col("nr")
    words = held.groupBy("bbl", F.call_function("div", nr, F.lit(WORD)).cast("int").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), nr % WORD)).alias("bits"))
    maps = words.groupBy("bbl").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("held"))
    every = F.transform(F.sequence(F.lit(0), F.lit(max(0, count - 1) // WORD)), lambda w: F.struct(
        w.alias("word"), F.coalesce(F.try_element_at("held", w), F.lit(0).cast("bigint")).alias("bits")))
    unset = F.flatten(F.transform("words", lambda w: F.filter(
        F.sequence(w["word"] * WORD, F.least(w["word"] * WORD + WORD - 1, F.lit(count - 1))),
        lambda n: F.getbit(w["bits"], n % WORD) == 0)))
    known = lots.select("bbl").distinct().join(maps, "bbl", "left").filter(F.lit(count > 0))
    return known.select("bbl", every.alias("words")).select("bbl", F.explode(unset).alias("nr")).join(numbered, "nr").drop("nr")


def work_list(lots: DataFrame, periods: DataFrame, files: DataFrame,
              base: str | None = None) -> DataFrame:
    """Documents still to fetch; with ``base`` also the address to ask.

    ``periods`` is a table of period, doc_type and docname, of any length. What a lot holds is a bitmap of
    period numbers; its unset bits are the work.
    """
    wanted = periods.select("period", "doc_type", "docname")
    numbered = _numbered(wanted)
    named = F.struct("period", "doc_type", "docname").alias("document")  # equal when all parts are, NULL or not
    held = _held(files, wanted).select("bbl", named).join(numbered.select("nr", named), "document").select("bbl", "nr")
    todo = _lacking(lots, held, numbered).select("bbl", "period", "doc_type", "docname")
    if base is None:
        return todo
    return todo.withColumn(
        "url", request_address(base, F.col("bbl"), F.col("period"), F.col("doc_type"))
    )


def missing_periods(lots: DataFrame, periods: DataFrame, held: DataFrame) -> DataFrame:
    """(lot, period) pairs without a bill; ``periods`` has a column ``period``."""
    numbered = _numbered(periods.select("period"))
    return _lacking(lots, held.select("bbl", "period").join(numbered, "period").select("bbl", "nr"), numbered)


def converted(files: DataFrame) -> DataFrame:
    """PDFs whose text already lies beside them (``path`` listings)."""
    path = F.col("path")
    pdf = files.filter(F.lower(path).endswith(".pdf")).select(
        "path", F.concat(folder(path), F.lit("/"),
                         F.regexp_replace(file_name(path), r"\.pdf$", ""), F.lit(".txt"))
        .alias("text_path"),
    )
    texts = files.filter(path.endswith(".txt")).select(path.alias("text_path"))
    return pdf.join(texts, "text_path", "left_semi").select("path")


def wanted_types(names: DataFrame, types: Sequence[str] = WANTED_TYPES) -> DataFrame:
    """Documents (``docname`` = ``<date> - <type>``) of a wanted type."""
    return names.filter(F.get(F.split("docname", " - "), F.lit(1)).isin(list(types)))


def skipped_types(names: DataFrame, types: Sequence[str] = WANTED_TYPES) -> DataFrame:
    """Count of each type left out."""
    kind = F.get(F.split("docname", " - "), F.lit(1))
    return (
        names.withColumn("doc_type", kind)
        .filter(F.col("doc_type").isNull() | ~F.col("doc_type").isin(list(types)))
        .groupBy("doc_type").agg(F.count(F.lit(1)).alias("count"))
    )


def document_names(files: DataFrame) -> DataFrame:
    """Listed files without extension."""
    return files.select("path", stem(file_name(F.col("path"))).alias("docname"))


def relayout(folders: DataFrame, key: str) -> DataFrame:
    """``<borough>-<block>-<lot>`` folder keys as partition columns."""
    parts = F.split(key, "-")
    return folders.withColumns({
        n: F.get(parts, F.lit(i)) for i, n in enumerate(("borough", "block", "lot"))
    })


def shards(lots: DataFrame, size: int) -> DataFrame:
    """Consecutive slices of ``size`` rows in lot order, exactly as sorting and cutting would.

    A global row number would need one task. Offsets are summed in three bounded steps instead:
    copies of a lot are counted, then lots within a block, blocks within a borough, boroughs.
    Copies of one lot that fall into several slices keep their multiplicity.
    """
    bbl = F.col("bbl")
    per_lot = lots.groupBy("bbl").agg(F.count(F.lit(1)).alias("n")).select(
        borough_of(bbl).alias("borough"), block_of(bbl).alias("block"), "bbl", "n"
    )
    per_block = per_lot.groupBy("borough", "block").agg(F.sum("n").alias("block_n"))
    per_borough = per_block.groupBy("borough").agg(F.sum("block_n").alias("borough_n"))

    def running(df: DataFrame, keys: list[str], order: str, n: str, out: str) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(out, F.coalesce(F.sum(n).over(w), F.lit(0)))

    borough_at = running(per_borough, [], "borough", "borough_n", "borough_at")
    block_at = running(per_block, ["borough"], "block", "block_n", "block_at")
    # Boroughs are few and large: their offsets go to the blocks, never to the lots by themselves.
    block_first = block_at.join(borough_at.drop("borough_n"), "borough").select(
        "borough", "block", (F.col("borough_at") + F.col("block_at")).alias("block_first"))
    placed = (
        running(per_lot, ["borough", "block"], "bbl", "n", "lot_at")
        .join(block_first, ["borough", "block"])
        .withColumn("first", F.col("block_first") + F.col("lot_at"))
    )
    shard = F.explode(F.sequence(
        F.call_function("div", F.col("first"), F.lit(size)),
        F.call_function("div", F.col("first") + F.col("n") - 1, F.lit(size)),
    ))
    end = F.col("first") + F.col("n")
    low, high = F.col("shard") * size, (F.col("shard") + 1) * size
    return placed.select("bbl", "first", "n", shard.alias("shard")).select(
        "bbl", F.col("shard"),
        (F.least(end, high) - F.greatest(F.col("first"), low)).alias("copies"),
    )


def lot_identifiers(borough: str, block: str, lot: str):
    """``bbl`` text from parts of any width."""
    return bbl_text(F.col(borough), F.col(block), F.col(lot))
