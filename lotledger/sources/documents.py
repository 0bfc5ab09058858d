"""Documents: one file per lot and billing day, ``.../<borough>/<block>/<lot>/<date> - <type>``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotledger.functions.names import document_kind
from lotledger.functions.text import DATE_FORMATS, bill_date

# Shapes exclude each other, so their order is free: file names usually spell the month.
NAME_FORMATS = {form: DATE_FORMATS[form] for form in ("MMMM d, yyyy", *DATE_FORMATS)}


def from_path(files: DataFrame) -> DataFrame:
    """``path, text`` listings with path, bbl, activity_through and kind of each document."""
    parts, path = F.split("path", "/"), F.col("path")
    lot = F.concat_ws("", *[F.try_element_at(F.col("parts"), F.lit(-i)) for i in (4, 3, 2)])
    # The date names its text many times: as a column of its own that is made once.
    named = files.select("path", "text", parts.alias("parts")).select(
        "path", "text", F.when(F.size("parts") >= 4, lot).try_cast("bigint").alias("bbl"),
        F.split_part(F.element_at("parts", -1), F.lit(" - "), F.lit(1)).alias("day"))
    return named.select("path", "bbl", bill_date(F.col("day"), NAME_FORMATS).alias("activity_through"),
                        document_kind(path).alias("kind"), "text")


def usable(files: DataFrame) -> DataFrame:
    """Drop damaged, derived and empty files, and kinds that are not read."""
    name = F.element_at(F.split("path", "/"), -1)
    return files.filter(
        ~F.contains(name, F.lit("corrupted")) & ~F.contains(name, F.lit("data.json"))
        & (F.col("text") != "") & F.col("kind").isNotNull()
    )


def classify_documents(files: DataFrame) -> DataFrame:
    """``path, text`` listings to documents."""
    return usable(from_path(files))


def read_documents(spark: SparkSession, root: str) -> DataFrame:
    """Text and HTML documents below ``root``, each file once as one row.

    Many small files are packed into one task by ``spark.sql.files.maxPartitionBytes`` and
    ``openCostInBytes``; land the result in Parquet before using it more than once.
    """
    files = spark.read.text(
        root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.{txt,html}"
    ).select(F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B")).alias("path"),
             F.col("value").alias("text"))
    return classify_documents(files)
