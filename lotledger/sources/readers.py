"""Table readers: declared schemas, no inference over the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotledger.operators.manifest import bad_lot_ids, good_lot_ids, lot_ids, parcel_ids

# The columns of the published files.
RAW_SCHEMA = (
    "bbl BIGINT, activitythrough DATE, section STRING, key STRING, duedate DATE, "
    "activitydate DATE, value STRING, meta STRING, apts STRING"
)
OFFICIAL_SCHEMA = (
    "source STRING, borough SMALLINT, year INT, add_421a INT, add_421g INT, add_420c INT, "
    "add_j51 INT, add_ML_buyout INT, add_loft INT, add_former_control FLOAT, "
    "sub_high_rent_income INT, sub_high_rent_vacancy INT, sub_coop_condo_conversion INT, "
    "sub_421a_expiration INT, sub_j51_expiration INT, sub_substantial_rehab INT, "
    "sub_commercial_prof_conversion INT, sub_other INT, total_sub INT, total_add FLOAT, "
    "inflated STRING, net FLOAT"
)


def _csv(spark: SparkSession, path: str, schema: str, multiline: bool = True) -> DataFrame:
    return spark.read.schema(schema).csv(
        path, header=True, nullValue="", quote='"', escape='"', multiLine=multiline
    )


def read_rawdata(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Key/value rows from CSV with a header; empty is NULL, quotes are doubled.

    Files are split over tasks. ``multiline`` reads values with line breaks, one task per file.
    A CSV does not say where a row stood: ``doc_path`` and ``line_no`` are NULL.
    """
    return _csv(spark, path, RAW_SCHEMA, multiline).withColumns({
        "doc_path": F.lit(None).cast("string"), "line_no": F.lit(None).cast("bigint"),
    })


def read_raw_store(spark: SparkSession, path: str) -> DataFrame:
    """Rows kept by ``writers.write_rawdata``, with ``key_class`` and ``key_lc``, by which facts
    skip folders and row groups."""
    return spark.read.parquet(path)


def read_official_totals(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, OFFICIAL_SCHEMA)


def read_lot_list(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Lots of a list with one or three tab-separated cells, and the lines that are neither."""
    ids = lot_ids(spark.read.text(path), "value")
    return good_lot_ids(ids), bad_lot_ids(ids)


def read_parcel_list(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The same from the first three columns of a parcel CSV."""
    columns = spark.read.schema("a STRING, b STRING, c STRING").csv(
        path, enforceSchema=True, mode="PERMISSIVE"
    )
    ids = lot_ids(parcel_ids(columns, "a", "b", "c"), "line")
    return good_lot_ids(ids), bad_lot_ids(ids)


def read_address_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("house_no STRING, street STRING, borough INT").csv(path, sep="\t")


def read_assessment_roll(spark: SparkSession, path: str) -> DataFrame:
    """First column of a roll without header."""
    return spark.read.schema("bbl STRING").csv(path, enforceSchema=True).select(
        F.translate("bbl", '"', "").alias("bbl")
    )
