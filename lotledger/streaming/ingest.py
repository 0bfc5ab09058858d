"""Incremental ingest: new documents are read once, repeated runs add nothing.

Extraction orders lines within a document, which a stream cannot do by itself, so each micro-batch
is read inside ``foreachBatch``. A batch writes its own folder with overwrite: after a lost
executor or a restart the replayed batch replaces its own output. Documents already read in an
earlier batch are left out by an anti join on the document path.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lotledger.operators.extract import read_all, rejects_of, rows_of
from lotledger.sources.documents import classify_documents
from lotledger.sources.working import working_folder  # noqa: F401

DOCUMENTS, READ = "documents", "read"


def _slot(path: Column) -> Column:
    return F.pmod(F.xxhash64(path), F.lit(SLOTS)).cast("int")


SLOTS = 256  # folders of the list of documents, by hash of the path


def earlier_documents(spark: SparkSession, sink: str, batch: int) -> DataFrame:
    known = spark.read.schema("path STRING, batch BIGINT, slot INT").parquet(f"{sink}/{DOCUMENTS}")
    return known.filter(F.col("batch") < batch).select("slot", "path")


def read_batch(sink: str) -> Callable[[DataFrame, int], None]:
    """Handler that reads one batch of documents into ``sink``.

    New documents are chosen on their paths alone. Rows and rejects are one table, written once.
    """

    def handle(docs: DataFrame, batch: int) -> None:
        spark = docs.sparkSession
        paths = docs.groupBy("path").agg(F.count(F.lit(1)).alias("copies")).withColumn(
            "slot", _slot(F.col("path")))
        if batch > 0:
            paths = paths.join(earlier_documents(spark, sink, batch), ["slot", "path"], "left_anti")
        paths.select("path", "slot").hint("rebalance", "slot").write.mode("overwrite").partitionBy(
            "slot").parquet(f"{sink}/{DOCUMENTS}/batch={batch}")
        fresh = spark.read.schema("path STRING, slot INT").parquet(f"{sink}/{DOCUMENTS}/batch={batch}")
        again = paths.filter("copies > 1").limit(1).count() > 0
        if batch > 0 or again:
            docs = docs.join(fresh.select("path"), "path", "left_semi")
        if again:  # only documents that a batch repeats are compared by text
            docs = docs.dropDuplicates(["path"])
        read_all(docs).write.mode("overwrite").parquet(f"{sink}/{READ}/batch={batch}")

    return handle


def start_ingest(documents: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Read everything a document stream has, then stop."""
    return (
        documents.writeStream.foreachBatch(read_batch(sink))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def document_stream(spark: SparkSession, root: str, files_per_batch: int = 100_000) -> DataFrame:
    """Documents that appear below ``root``."""
    files = (
        spark.readStream.option("maxFilesPerTrigger", files_per_batch)
        .text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.{txt,html}")
        .select(F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B")).alias("path"),
                F.col("value").alias("text"))
    )
    return classify_documents(files)


def ingest_stream(spark: SparkSession, root: str, sink: str, checkpoint: str) -> StreamingQuery:
    return start_ingest(document_stream(spark, root), sink, checkpoint)


def ingested_rows(spark: SparkSession, sink: str) -> DataFrame:
    return rows_of(spark.read.parquet(f"{sink}/{READ}"))


def ingested_rejects(spark: SparkSession, sink: str) -> DataFrame:
    return rejects_of(spark.read.parquet(f"{sink}/{READ}"))
