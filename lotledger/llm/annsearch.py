"""Approximate nearest neighbours by learned partitions.

A neighbour graph of a bounded sample of vectors is cut into parts of equal size by recursive
spectral bisection and a refinement that keeps the sizes. A softmax classifier learns the part
from the vector. It places every vector of the table in its most probable part and sends a query to
as many of its most probable parts as held-out queries of the sample needed for the wanted recall.
There the query is compared with every vector, in double precision.

Equal vectors are one entry of the index, with the ``k + 1`` smallest ids, all that any answer can
need. Parts are cut into chunks and queries into blocks of bounded size; a task sees one of each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotledger.llm.common import written

SAMPLE = 8192       # vectors that graph and classifier are fitted on, those of the smallest hashes
PARTS = 32
NEIGHBOURS = 16
RECALL = 0.95       # wanted on held-out queries of the sample
CHUNK = 8192
BLOCK = 4096


def valid(column: str = "embedding") -> Column:
    """Neither null nor zero nor with a null or non-finite component."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(column).isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(column, lambda x: x != 0)


def graph(x: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k largest inner products of each row with the others, in blocks."""
    out = np.empty((len(x), k), np.int64)
    for at in range(0, len(x), 512):
        s = x[at:at + 512] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        out[at:at + 512] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def _halves(nodes: np.ndarray, near: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Splits nodes in two equal parts by a smooth vector over the graph among them."""
    place = np.full(len(near), -1)
    place[nodes] = np.arange(len(nodes))
    inner = place[near[nodes]]
    has = inner >= 0
    degree = np.maximum(1, has.sum(1))
    v = rng.standard_normal(len(nodes))
    for _ in range(60):
        pull = np.where(has, v[inner], 0).sum(1)
        push = np.bincount(inner[has], np.repeat(v, has.sum(1)), len(nodes))
        v = v + (pull + push) / (2 * degree)
        v -= v.mean()
        v /= np.linalg.norm(v) + 1e-12
    order = np.argsort(v, kind="stable")
    half = len(nodes) // 2
    return nodes[order[:half]], nodes[order[half:]]


def partition(near: np.ndarray, parts: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Part of each node: a power of two of parts of equal size (up to one node) with few cut edges."""
    rng = np.random.default_rng(seed)
    groups = [np.arange(len(near))]
    while len(groups) < parts:
        groups = [half for g in groups for half in _halves(g, near, rng)]
    label = np.empty(len(near), np.int64)
    for i, g in enumerate(groups):
        label[g] = i
    rows = np.arange(len(near))
    for _ in range(rounds):  # pairs of nodes that both gain swap their parts
        votes = np.zeros((len(near), parts), np.int32)
        for j in range(near.shape[1]):
            np.add.at(votes, (rows, label[near[:, j]]), 1)
        want = votes.argmax(1)
        gain = votes[rows, want] - votes[rows, label]
        moved = 0
        for a in range(parts):
            for b in range(a + 1, parts):
                there = rows[(label == a) & (want == b) & (gain > 0)]
                back = rows[(label == b) & (want == a) & (gain > 0)]
                n = min(len(there), len(back))
                label[there[:n]], label[back[:n]] = b, a
                moved += n
        if not moved:
            break
    return label


class Router:
    """Softmax regression from a vector's direction to its part."""

    def __init__(self, x: np.ndarray, label: np.ndarray, parts: int, steps: int = 300):
        self.w, self.b = np.zeros((x.shape[1], parts)), np.zeros(parts)
        x = self._unit(x)
        want = np.eye(parts)[label]
        speed_w, speed_b = np.zeros_like(self.w), np.zeros_like(self.b)
        for _ in range(steps):
            miss = (self._softmax(x) - want) / len(x)
            speed_w = 0.9 * speed_w - 4.0 * (x.T @ miss + 1e-5 * self.w)
            speed_b = 0.9 * speed_b - 4.0 * miss.sum(0)
            self.w, self.b = self.w + speed_w, self.b + speed_b

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)

    def _softmax(self, x: np.ndarray) -> np.ndarray:
        z = x @ self.w + self.b
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def ranked(self, x: np.ndarray) -> np.ndarray:
        return np.argsort(-self._softmax(self._unit(x)), axis=1, kind="stable")


def fit(x: np.ndarray, parts: int, k: int, recall: float = RECALL) -> tuple[Router, int]:
    """(router, parts to search). Every eighth vector is held out as a query; ``x`` is a sample."""
    while parts > 1 and len(x) < 64 * parts:
        parts //= 2
    held = np.arange(len(x)) % 8 == 0
    rest = x[~held]
    if parts == 1 or not held.any():
        return Router(x, np.zeros(len(x), np.int64), 1, 0), 1
    near = graph(rest, min(NEIGHBOURS, len(rest) - 1))
    router = Router(rest, partition(near, parts), parts)
    home, tried = router.ranked(rest)[:, 0], router.ranked(x[held])
    best = np.argpartition(-(x[held] @ rest.T), min(k, len(rest)) - 1, axis=1)[:, :k]
    depth = np.argmax(tried[:, None, :] == home[best][:, :, None], axis=2)
    found = np.array([(depth < r).mean() for r in range(1, parts + 1)])
    return router, int(np.argmax(found >= min(recall, found[-1]))) + 1


def _distinct(rows: DataFrame, keep: int) -> DataFrame:
    """v, ids: each different vector once, with its ``keep`` smallest ids."""

    def combine(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            f["v"] = [np.asarray(e, np.float64).tobytes() for e in f["embedding"]]
            few = f.sort_values("vec_id").groupby("v", sort=False)["vec_id"].apply(lambda s: s.head(keep).tolist())
            yield pd.DataFrame({"v": few.index, "ids": few.values})

    part = rows.mapInPandas(combine, "v binary, ids array<long>")
    return part.groupBy("v").agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, keep).alias("ids"))


def _vectors(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1)


def nearest(table: DataFrame, queries: Column, k: int = 20, parts: int = PARTS, sample: int = SAMPLE,
            recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score: the k found vectors of largest inner product per query row.

    ``table`` has vec_id and embedding, ``queries`` selects its query rows. Ties go to the smaller
    id. A query is no candidate of its own. Vectors that are null, zero, or have null or non-finite
    components, rows without id, and vectors of another length than most of the sample take no
    part. A row that repeats an id and a vector counts once. Other columns are not read; an empty
    table gives an empty result.
    """
    spark = table.sparkSession
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"),
                        queries.alias("asks")).where(F.col("vec_id").isNotNull() & valid())
    index = written(_distinct(rows.select("vec_id", "embedding").distinct(), k + 1))
    few = index.select("v").orderBy(F.xxhash64("v"), "v").limit(sample).toPandas()["v"]  # at most ``sample`` vectors
    result = "query_id long, vec_id long, score double"
    if not len(few):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size = int(few.map(len).mode()[0])
    router, tries = fit(_vectors(few[few.map(len) == size]), parts, k, recall)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            f["part"] = router.ranked(_vectors(f["v"]))[:, 0]
            yield f

    placed = written(index.where(F.octet_length("v") == size)
                     .mapInPandas(place, "v binary, ids array<long>, part int"))
    chunks = {r["part"]: math.ceil(r["n"] / CHUNK) for r in
              placed.groupBy("part").agg(F.count("*").alias("n")).collect()}  # one row per part
    asked = rows.where(F.coalesce("asks", F.lit(False)) & (F.size("embedding") == size // 8)) \
        .select("vec_id", "embedding").distinct()
    blocks = math.ceil(asked.count() * tries / max(1, len(router.b)) / BLOCK) or 1

    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                x = np.array(f["embedding"].tolist(), np.float64)
                yield pd.DataFrame({"query_id": f["vec_id"], "q": [r.tobytes() for r in x],
                                    "part": router.ranked(x)[:, :tries].tolist()})

    per_part = F.create_map(*[F.lit(x) for p, n in sorted(chunks.items()) for x in (int(p), n)])
    sent = asked.mapInPandas(route, "query_id long, q binary, part array<int>")
    sent = sent.select("query_id", "q", F.explode("part").alias("part")).select(
        "query_id", "q", "part", F.explode(F.sequence(F.lit(0), per_part[F.col("part")] - 1)).alias("chunk"),
        F.pmod(F.xxhash64("query_id"), F.lit(blocks)).alias("block"))
    placed = placed.select("v", "ids", "part", F.pmod(F.xxhash64("v"), per_part[F.col("part")]).cast("int").alias("chunk"),
                           F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))

    def search(asking: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asking) and len(held):
            v, ids = _vectors(held["v"]), held["ids"].tolist()
            for at in range(0, len(asking), 256):
                part = asking.iloc[at:at + 256]
                scores = _vectors(part["q"]) @ v.T
                most = min(k + 1, len(v))
                least = np.partition(scores, len(v) - most, axis=1)[:, len(v) - most]
                for q, s, low in zip(part["query_id"], scores, least):
                    hits = sorted((-s[j], i) for j in np.flatnonzero(s >= low) for i in ids[j] if i != q)[:k]
                    out += [(q, i, -s) for s, i in hits]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    keys = ["part", "chunk", "block"]
    found = sent.groupBy(*keys).cogroup(placed.groupBy(*keys)).applyInPandas(search, result)

    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
