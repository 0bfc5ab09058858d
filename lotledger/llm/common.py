"""Helpers of the training-data operators: scratch tables, table readers, connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share.

    Where the setting is absent, a local session gets a temporary folder; any other must name one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


ROWS_PER_FILE = 500_000  # of narrow rows: ids, digests, counts


def written(df: DataFrame, path: str | None = None, rows: int | None = None) -> DataFrame:
    """The rows of ``df``, written once as Parquet in the shared folder and read from there.

    This cuts the lineage, survives lost executors, and gives joins on the result plain exchanges
    that adaptive execution can split where a key is hot. ``rows`` bounds the number of narrow
    rows, from which the number of files follows; otherwise it is that of the partitions. These files
    stay until the folder is cleaned, so they are packed tighter than Parquet's default.
    """
    spark = df.sparkSession
    path = path or scratch_dir(spark)
    if rows is not None:
        df = df.coalesce(max(8, -(-rows // ROWS_PER_FILE)))
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def forest(a: Iterable[int], b: Iterable[int]) -> list[tuple[int, int]]:
    """A star for each component of the edges (a, b): every other node with the smallest one.

    As many as the edges of a spanning forest, but none is further than one step from the smallest
    node, so that ``components`` needs few steps where the edges given are long chains.
    """
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    for x, y in zip(a, b):
        p, q = top(x), top(y)
        if p != q:
            up[max(p, q)] = min(p, q)
    return [(x, top(x)) for x in up if top(x) != x]


def thinned(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(a, b): stars that connect what the edges of a partition connect, batch by batch. ``edges`` should be
    read from files: behind other Python code each task would hold two Python workers."""

    def thin(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame(forest(f[left].tolist(), f[right].tolist()), columns=["a", "b"], dtype="int64")

    return edges.where(f"{left} <> {right}").select(left, right).mapInPandas(thin, "a long, b long")


def _star(edges: DataFrame, large: bool, rows: int) -> DataFrame:
    """One step of alternating large and small stars; ``edges`` has a > b in each row."""
    if large:
        # Only edges whose smaller end hangs on another node change, so the hot roots stay out.
        above = written(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")), rows=rows)
        met = edges.join(above, edges["b"] == above["node"], "left")
        out = met.select("a", F.coalesce("m", "b").alias("b"))
        # What a node hangs on is connected through the smallest of these.
        return out.distinct()
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    met = edges.join(least, "a")
    out = met.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.unionByName(least.select("a", F.col("m").alias("b"))).where("a > b").distinct()


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) for every node of an edge list: the smallest node that its edges reach.

    Alternating steps move edges to the smallest known neighbour: one hangs every node on what its
    upper neighbour hangs on, one joins the upper neighbours of a node. Each step's result is
    written, so none depends on the lineage of those before. Ends when the edges are stars. Nodes
    without an edge are not returned; null ends are ignored.
    """
    edges = edges.where(f"{left} is not null and {right} is not null")
    now = written(edges.select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b"))
                  .where("a > b").distinct())
    while True:
        rows = now.count()
        twice = now.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a")
        inner = now.select(F.col("b").alias("a")).join(now.select("a"), "a", "left_semi")
        if not twice.unionByName(inner).limit(1).count():  # every node hangs on one that hangs on none
            break
        now = written(_star(now, False, rows), rows=2 * rows)
        now = written(_star(now, True, rows), rows=2 * rows)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
