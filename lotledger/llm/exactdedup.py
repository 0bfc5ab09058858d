"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

One scan writes the length and the hash of a short prefix of every text. Groups of one length and
prefix with a single member are settled there. Full texts are hashed only where the group survived:
the surviving groups, folded into at most ``2 ** bits`` buckets, are broadcast (that is the proven
size bound), and a scan hashes only the rows of those buckets. A bucket that also holds lone texts
costs their hash, never the result. Rows of ids and digests are all that is shuffled.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotledger.llm.common import text_of, written

PREFIX = 64
BITS = 18


def _bucket(bits: int) -> Column:
    return F.pmod(F.xxhash64("n_bytes", "head"), F.lit(1 << bits))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", text_of().alias("body")).select(
        "doc_id", "body", F.octet_length("body").cast("long").alias("n_bytes"),
        F.xxhash64(F.substring("body", 1, PREFIX)).alias("head"))


def classes(docs: DataFrame, hash_all: bool = False, bits: int = BITS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their UTF-8 bytes are (null counts as empty). The row with the largest
    doc_id stays. Rows that repeat an id and a text count as members; one of them is kept. A null
    doc_id is smaller than all others, so such a row stays only in a group without ids. Texts
    whose full content was not needed have a null text_sha256 unless ``hash_all``. An empty table
    gives an empty result; other columns are not read.
    """
    slim = written(_keyed(docs).select(_bucket(bits).alias("bucket"), "n_bytes", "head"))
    buckets = F.broadcast(
        slim.groupBy("n_bytes", "head").agg(F.count("*").alias("n"), F.first("bucket").alias("bucket"))
        .where("n > 1").select("bucket").distinct())
    keyed = _keyed(docs).withColumn("bucket", _bucket(bits))
    sha = F.sha2("body", 256).alias("text_sha256")
    full = written(keyed.join(buckets, "bucket", "left_semi").select("doc_id", "n_bytes", sha)
                   .groupBy("doc_id", "n_bytes", "text_sha256").agg(F.count("*").alias("times")))
    groups = written(full.groupBy("n_bytes", "text_sha256").agg(
        F.max("doc_id").alias("keep_id"), F.sum("times").alias("group_size")))
    same = [full[c] == groups[c] for c in ("n_bytes", "text_sha256")]
    compared = full.join(groups, same).select(
        "doc_id", "keep_id", "group_size", full["text_sha256"],
        F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("copy")).select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "text_sha256")
    lone = keyed.join(buckets, "bucket", "left_anti").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), sha if hash_all else F.lit(None).cast("string").alias("text_sha256"))
    return compared.unionByName(lone)


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, whole; of rows that repeat an id and a text, one stays.

    Rows are matched to the decisions by id and digest; rows of ids that nothing was decided on
    pass as they are.
    """
    found = classes(docs)
    own, full, copy = (f"_{uuid4().hex}" for _ in range(3))  # no names that columns of docs can have
    ids = found.select(F.col("doc_id").alias(own), F.col("text_sha256").alias(full), "kept")
    dropped = written(ids.where("not kept").select(own, full).distinct())
    # Kept, but another row repeats its id and text, so it is among the dropped too.
    again = written(ids.where("kept").select(own, full).intersect(dropped))
    sha = F.sha2(text_of(), 256)
    match = F.col("doc_id").eqNullSafe(F.col(own)) & (sha == F.col(full))
    first = F.row_number().over(Window.partitionBy("doc_id", sha).orderBy("doc_id"))
    one = docs.join(again, match, "left_semi").withColumn(copy, first).where(F.col(copy) == 1).drop(copy)
    return docs.join(dropped.hint("merge"), match, "left_anti").unionByName(one)
