"""Table writers. All write in parallel; nothing is gathered by lot or on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotledger.functions.lots import block_of, borough_of, lot_of, pad
from lotledger.operators.facts import key_class
from lotledger.operators.ordering import ordered
from lotledger.sources.working import working_folder

HEADERS = {
    "bbl": "bbl", "activitythrough": "activityThrough", "section": "section", "key": "key",
    "duedate": "dueDate", "activitydate": "activityDate", "value": "value", "meta": "meta",
    "apts": "apts",
}


def _headed(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.col(c).alias(h) for c, h in HEADERS.items()])


def write_rawdata_csv(rows: DataFrame, path: str) -> None:
    """Key/value rows as CSV in the published column order."""
    export_csv(_headed(rows), path)


def write_rawdata(rows: DataFrame, path: str) -> None:
    """Key/value rows as Parquet, one folder per key class.

    Facts filter on the lower-case key, so ``key_lc`` is stored: its row-group statistics, within
    files sorted by it, let a scan for one key skip the rest. Notices and owner rows have their
    own classes. The rebalance hint evens out file sizes, splitting a class that is very large.
    """
    keyed = rows.withColumns({"key_lc": F.lower("key"), "key_class": key_class(F.col("section"))})
    (
        keyed.hint("rebalance", "key_class").sortWithinPartitions("key_class", "key_lc", "bbl")
        .write.mode("overwrite").partitionBy("key_class").parquet(path)
    )


LOT_FOLDERS = ("borough", "block", "lot")


def _in_folders(df: DataFrame, folders: Sequence[str], more: dict[str, Column] | None = None, deal: bool = True) -> DataFrame:
    """Rows dealt by the columns of their folders; within a file by lot, if lots have no folders.

    Columns in ``more`` are made behind the shuffle, so that it does not carry them. Without ``deal`` rows stay
    in their tasks: each writes a file into every folder it has rows of.
    """
    dealt = (df.hint("rebalance", *folders) if deal else df).withColumns(more or {})
    return dealt if set(LOT_FOLDERS) <= set(folders) else dealt.sortWithinPartitions(
        *folders, *[c for c in LOT_FOLDERS if c not in folders])


def write_lot_json(rows: DataFrame, path: str, folders: Sequence[str] = LOT_FOLDERS, compression: str = "none",
                   deal: bool = True) -> None:
    """JSON rows in one folder per lot, ``borough=/block=/lot=``, or in fewer ``folders``.

    Rows stay rows (JSON lines): a lot with very many rows is spread over several files instead
    of being collected into one array. Each folder costs files and requests of its own, so where lots
    are many, name fewer columns: the files then grow with the bytes, and lots lie together in them.
    With ``compression`` the files are packed: the names in every line take most of their bytes. A shuffle
    takes more disk than packed files: where folders are few, it can be left out (``deal``).
    """
    bbl = F.col("bbl")
    ids = {"borough": borough_of(bbl), "block": pad(block_of(bbl), 5), "lot": pad(lot_of(bbl), 4)}
    lots = _headed(rows).withColumns({n: c for n, c in ids.items() if n in folders})
    _in_folders(lots, folders, {n: c for n, c in ids.items() if n not in folders}, deal).write.mode("overwrite").partitionBy(
        *folders).json(path, compression=compression)


def export_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",",
               order: Sequence[Column | str] = ()) -> None:
    """Delimited files with NULL as nothing; ``header=False`` for plain lot lists.

    With ``order`` the rows of all files, in the order of the file names, are in that order.
    """
    (ordered(df, order) if order else df).write.mode("overwrite").csv(path, header=header, sep=sep, nullValue="", emptyValue='""',
                                   quote='"', escape='"')


def write_relayout(df: DataFrame, path: str, folders: Sequence[str] = LOT_FOLDERS) -> None:
    """Rows with borough, block and lot columns as partition folders, or in fewer ``folders`` (see
    ``write_lot_json``)."""
    _in_folders(df, folders).write.mode("overwrite").partitionBy(*folders).parquet(path)


def replace_table(df: DataFrame, name: str) -> str:
    """Create or replace a staging table; returns the folder of the new version.

    Rows go to a new folder below the working folder, then a view is switched to it. Readers that
    have opened the table keep the version they saw, and a write that fails changes nothing.
    Folders of earlier versions stay until the working folder is cleaned.
    """
    spark, path = df.sparkSession, working_folder(df.sparkSession)
    df.write.parquet(path)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{path}`")
    return path
