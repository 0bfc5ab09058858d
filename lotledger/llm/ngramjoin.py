"""Jaccard self-join on word n-grams as a blocked sparse matrix product.

The incidence matrix has a row per document and a column per n-gram; the product with its transpose
counts overlaps. Only blocks that can hold a link are multiplied:

1. One pass counts all n-grams in a table of fixed size, by hash. That orders the columns, rare ones
   first; n-grams of passages that many documents share come last. Counts that fall together make
   the order worse, never the result.
2. Sizes give the bounds. Two linked documents share ``ceil(t * size)`` n-grams of either, so their
   first ``size - ceil(t * size) + 1`` columns in that order have one in common. Those are all that
   is shuffled. Rows that share one and whose sizes allow a link are joined to row groups; rows that
   share none are never multiplied. This is exact: no link is lost.
3. A group is cut into blocks of bounded size; a task multiplies one block (or a pair of blocks) of
   the incidence matrix, accumulates overlap counts, discards pairs below the overlap that their
   sizes ask for, and returns stars that connect what the links it found connect, never the pairs.
4. Large groups are cut at random and multiplied in parts, then grouped anew: a document with too many
   n-grams that no other class has is done; of the others, with the columns ordered by their own
   counts, only one that shares a prefix n-gram with another class is still open, and what such pairs
   connect is a group of its own, small as a rule. Rounds go on while they merge classes. In what is left, the
   parts of the largest class meet the parts of the others and these each other, so no link is lost
   and the members of a class are not compared again.

Blocks are bounded by n-grams, of which a document counts at least ``UNIT``. Texts are moved, not
n-gram arrays: compressed they take half the bytes of hashes.

Rows with equal sets are linked by definition and compared through one of them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotledger.llm.common import components, forest, thinned, written
from lotledger.llm.hashing import mix, shingles

BLOCK = 512          # documents of a block, or units of n-grams of long ones
UNIT = 2048          # n-grams that count as one document
BUCKETS = 256        # groups of prefix n-grams, at least
ENTRIES = 2_000_000  # prefix n-grams of a group
TASKS = 256          # tasks whose counts are added up first
COUNTERS = 22  # binary logarithm of the number of counters
DENSE = 24   # documents from which a column is multiplied as a dense one


def counted(docs: DataFrame, n: int, bits: int = COUNTERS) -> tuple[np.ndarray, int]:
    """How often n-grams of each of ``2 ** bits`` hash classes occur, as rounded binary logarithms,
    and how many there are in all.

    Tasks add up their counts; the sums are taken by ranges of classes, first over ``TASKS`` tasks each,
    then over what these gave, so that a group holds tens of MB. The result has a byte per class.
    """
    parts, width = 64, (1 << bits) // 64

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.uint32)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for text in batch.column(0).slice(at, 256).to_pylist():
                    # A text's classes, so that memory follows one text and the counters.
                    classes, times = np.unique(shingles(text, n) >> np.uint64(64 - bits), return_counts=True)
                    counts[classes.astype(np.int64)] += times.astype(np.uint32)
        task = TaskContext.get().partitionId() // TASKS
        # The four bytes of the counts apart: the upper ones are nearly all zero and compress to nothing.
        rows = [np.ascontiguousarray(counts[k * width:(k + 1) * width].view(np.uint8).reshape(-1, 4).T).tobytes() for k in range(parts)]
        yield pa.RecordBatch.from_arrays([pa.array(range(parts), pa.int32()), pa.array([task] * parts, pa.int32()), pa.array(rows, pa.binary())],
                                         names=["part", "task", "counts"])

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(width, np.uint64)
        for raw in frame["counts"]:
            total += np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view(np.uint32).ravel()
        return pd.DataFrame({"part": frame["part"].iloc[:1], "counts": [total.tobytes()]})

    def level(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(raw, np.uint64) for raw in frame["counts"]], axis=0).astype(float)
        levels = np.rint(4 * np.log2(total + 1)).astype(np.uint8)  # a quarter of a bit is fine enough
        return pd.DataFrame({"part": frame["part"].iloc[:1], "n": [int(total.sum())], "counts": [levels.tobytes()]})

    schema = "part int, task int, counts binary"
    some = docs.select("text").mapInArrow(read, schema).groupBy("part", "task").applyInPandas(add, "part int, counts binary")
    done = some.groupBy("part").applyInPandas(level, "part int, n long, counts binary").toPandas()
    if not len(done):
        return np.zeros(1 << bits, np.uint8), 0
    return np.frombuffer(b"".join(done.sort_values("part")["counts"]), np.uint8), int(done["n"].sum())


def prefix(grams: np.ndarray, level: np.ndarray, t: int) -> np.ndarray:
    """The first ``size - ceil(t * size) + 1`` n-grams in the common order: by count, then by hash."""
    size, bits = len(grams), len(level).bit_length() - 1
    order = np.argsort(level[(grams >> np.uint64(64 - bits)).astype(np.int64)], kind="stable")
    return grams[order[:size + (-t * size) // 100 + 1]]


def overlaps(rows: list[np.ndarray]) -> np.ndarray:
    """Overlap counts of all rows of a block: incidence times its transpose, column by column."""
    m = len(rows)
    flat = np.concatenate(rows) if m else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(m), [len(r) for r in rows])
    order = np.argsort(flat, kind="stable")
    owner, flat = owner[order], flat[order]
    start = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1]))) if len(flat) else np.empty(0, np.int64)
    width = np.diff(np.append(start, len(flat)))
    counts = np.zeros(m * m, np.int64)
    for w in np.unique(width[(width > 1) & (width < DENSE)]):
        i, j = np.triu_indices(w, 1)
        columns = start[width == w]
        for at in range(0, len(columns), 1 + 1_000_000 // len(i)):
            ids = owner[columns[at:at + 1 + 1_000_000 // len(i), None] + np.arange(w)]
            counts += np.bincount((ids[:, i] * m + ids[:, j]).ravel(), minlength=m * m)
    counts = counts.reshape(m, m)
    counts += counts.T
    wide = np.flatnonzero(width >= DENSE)
    for at in range(0, len(wide), 2048):
        part = wide[at:at + 2048]
        dense = np.zeros((m, len(part)), np.float32)
        for c, k in enumerate(part):
            dense[owner[start[k]:start[k] + width[k]], c] = 1
        counts += np.rint(dense @ dense.T).astype(np.int64)
    return counts


def block_links(ids: np.ndarray, rows: list[np.ndarray], label: np.ndarray, t: int) -> list[tuple[int, int]]:
    """Stars that connect what the links of a block, between rows of different labels, connect."""
    size = np.array([len(r) for r in rows])
    both = size[:, None] + size[None, :]
    need = -(-t * both // (100 + t))  # the overlap that the sizes ask for
    counts = overlaps(rows)
    # Equivalent to 100 * overlap >= t * union.
    hit = np.triu((counts >= need) & (counts > 0) & (label[:, None] != label[None, :]), 1)
    a, b = np.nonzero(hit)
    return forest(ids[a].tolist(), ids[b].tolist())


_KEYS = "doc_id long, n_shingles long, k1 long, k2 long, bucket int, sig binary, ids binary, sizes binary"


def _bucketed(sigs: list[np.ndarray], buckets: int, *beside: list[np.ndarray]) -> Iterator[tuple]:
    """(bucket, n-grams, and what stands beside each) of a batch; five bytes of a hash are enough: a
    chance match costs a test, no more."""
    sig, *rest = (np.concatenate(x) for x in (sigs, *beside))
    bucket = ((sig >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    order = np.argsort(bucket, kind="stable")
    sig, bucket, rest = sig[order], bucket[order], [x[order] for x in rest]
    cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    for x, y in zip(cuts, np.append(cuts[1:], len(sig))):
        low = np.ascontiguousarray(sig[x:y].view(np.uint8).reshape(-1, 8)[:, :5])
        yield int(bucket[x]), low.tobytes(), *(part[x:y].tobytes() for part in rest)


def _unpacked(frame: pd.DataFrame, **kinds: type) -> list[np.ndarray]:
    """The n-grams of a bucket and what stands beside them, one array each."""
    low = np.frombuffer(b"".join(frame["sig"]), np.uint8).reshape(-1, 5)
    sig = np.zeros((len(low), 8), np.uint8)
    sig[:, :5] = low
    return [sig.view(np.uint64).ravel(), *(np.frombuffer(b"".join(frame[c]), k).astype(np.int64) for c, k in kinds.items())]


def _scanned(docs: DataFrame, n: int, t: int, level: Broadcast, buckets: int) -> DataFrame:
    """A row per document (bucket -1) with size and set key, and rows of prefix n-grams by bucket.
    Of documents with equal sets in a batch only the first sends n-grams."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                part = whole.slice(at, 512)
                keys, sigs, owners, sizes, seen = [], [], [], [], set()
                for doc_id, text in zip(*(c.to_pylist() for c in part.columns)):
                    grams = shingles(text, n)
                    k1 = int(mix(grams).sum(dtype=np.uint64).view(np.int64)) if len(grams) else 0
                    k2 = int(np.bitwise_xor.reduce(mix(grams + np.uint64(1))).view(np.int64)) if len(grams) else 0
                    keys.append((doc_id, len(grams), k1, k2))
                    if doc_id is not None and len(grams) and (len(grams), k1, k2) not in seen:
                        seen.add((len(grams), k1, k2))
                        sigs.append(prefix(grams, level.value, t))
                        owners.append(np.full(len(sigs[-1]), doc_id, np.int64))
                        sizes.append(np.full(len(sigs[-1]), len(grams), np.uint32))
                rows = [(*k, -1, None, None, None) for k in keys]
                if sigs:
                    rows += [(None, None, None, None, *x) for x in _bucketed(sigs, buckets, owners, sizes)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (
                    *[pa.int64()] * 4, pa.int32(), *[pa.binary()] * 3))],
                    names=[x.split()[0] for x in _KEYS.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(read, _KEYS)


def _shared(t: int):
    """Edges, as stars, that connect the documents that share an n-gram of their prefixes.

    Those that share one are sorted by size and joined each to the next, unless the next is too
    large for a link: of two that may link, all between them may too.
    """

    def join(frame: pd.DataFrame) -> pd.DataFrame:
        sig, ids, size = _unpacked(frame, ids=np.int64, sizes=np.uint32)
        order = np.lexsort((ids, size, sig))
        sig, ids, size = sig[order], ids[order], size[order]
        near = (sig[1:] == sig[:-1]) & (100 * size[:-1] >= t * size[1:]) & (ids[1:] != ids[:-1])
        pairs = np.unique(np.stack([ids[1:][near], ids[:-1][near]], 1), axis=0)
        return pd.DataFrame(forest(pairs[:, 0].tolist(), pairs[:, 1].tolist()), columns=["a", "b"])

    return join


def _multiplied(rows: DataFrame, n: int, t: int) -> DataFrame:
    """Links (a, b) within the blocks of rows (block, part, doc_id, label, text)."""

    def multiply(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, group in frame.groupby("part", sort=False):
            if len(group) > 1:
                grams = [shingles(x, n) for x in group["text"]]
                out += block_links(group["doc_id"].to_numpy(), grams, group["label"].to_numpy(), t)
        return pd.DataFrame(out, columns=["a", "b"])

    return rows.groupBy("block").applyInPandas(multiply, "a long, b long")


def _postings(marked: DataFrame, n: int, buckets: int, pick: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """Rows of the n-grams that ``pick`` takes of ``marked`` (doc_id, label, text), by bucket."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                part = whole.slice(at, 256)
                sigs, beside = [], ([], [], [])
                for doc_id, label, text in zip(*(c.to_pylist() for c in part.columns)):
                    grams = shingles(text, n)
                    sigs.append(pick(grams))
                    for x, value, kind in zip(beside, (doc_id, label, len(grams)), (np.int64, np.int64, np.uint32)):
                        x.append(np.full(len(sigs[-1]), value, kind))
                rows = list(_bucketed(sigs, buckets, *beside)) if any(map(len, sigs)) else []
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int32() if not k else pa.binary()) for k in range(5)],
                                                 names=["bucket", "sig", "ids", "labels", "sizes"])

    return marked.select("doc_id", "label", "text").mapInArrow(read, "bucket int, sig binary, ids binary, labels binary, sizes binary")


def _possible(marked: DataFrame, n: int, t: int, buckets: int) -> DataFrame:
    """The rows of ``marked`` that may still link with one of another label.

    All but ``size - ceil(t * size)`` n-grams of a document would have to be shared with such a row.
    Half of the columns are looked at: a document that has more n-grams than that of its label alone
    among these is done. Rows that repeat an id stay.
    """

    def lone(frame: pd.DataFrame) -> pd.DataFrame:
        sig, ids, label, size = _unpacked(frame, ids=np.int64, labels=np.int64, sizes=np.uint32)
        order = np.lexsort((label, sig))
        sig, ids, label, size = sig[order], ids[order], label[order], size[order]
        start = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
        end = np.append(start[1:], len(sig))
        own = np.repeat(label[start] == label[end - 1], end - start)
        docs, at, times = np.unique(ids[own], return_index=True, return_counts=True)
        return pd.DataFrame({"of": docs, "size": size[own][at], "n": times})

    found = _postings(marked, n, buckets, lambda grams: grams[(grams >> np.uint64(32)) & np.uint64(1) == 0])
    counts = found.groupBy("bucket").applyInPandas(lone, "of long, size long, n long").groupBy("of").agg(
        F.sum("n").alias("n"), F.max("size").alias("size"))
    done = written(counts.where(F.col("n") > F.col("size") - F.ceil(F.lit(t) * F.col("size") / 100)).select("of"))
    again = marked.groupBy("doc_id").agg(F.count("*").alias("times")).where("times > 1").select(F.col("doc_id").alias("of"))
    done = written(done.join(again, "of", "left_anti"))
    return written(marked.join(done.hint("merge"), marked["doc_id"] == done["of"], "left_anti"))


def _contested(marked: DataFrame, n: int, t: int, level: Broadcast, buckets: int) -> DataFrame:
    """(node, component): the documents of ``marked`` (doc_id, label, text) that share a prefix n-gram
    with one of another label and of a size that allows a link, by what such pairs connect."""

    def join(frame: pd.DataFrame) -> pd.DataFrame:
        sig, ids, label, size = _unpacked(frame, ids=np.int64, labels=np.int64, sizes=np.uint32)
        order = np.lexsort((ids, label, size, sig))
        sig, ids, label, size = sig[order], ids[order], label[order], size[order]
        at = np.arange(len(sig))
        # The nearest one before and after, by size, that has the n-gram and another label.
        first = np.concatenate(([True], (sig[1:] != sig[:-1]) | (label[1:] != label[:-1])))
        before = np.maximum.accumulate(np.where(first, at, 0)) - 1
        after = np.append(np.minimum.accumulate(np.where(first, at, len(sig))[::-1])[::-1][1:], len(sig))
        open_ = np.zeros(len(sig), bool)
        for other, small in ((before, True), (after, False)):
            there = (other >= 0) & (other < len(sig))
            o = np.where(there, other, 0)
            low, high = (size[o], size) if small else (size, size[o])
            open_ |= there & (sig[o] == sig) & (100 * low >= t * high)
        sig, ids, size = sig[open_], ids[open_], size[open_]
        near = (sig[1:] == sig[:-1]) & (100 * size[:-1] >= t * size[1:]) & (ids[1:] != ids[:-1])
        pairs = np.unique(np.stack([ids[1:][near], ids[:-1][near]], 1), axis=0)
        return pd.DataFrame(forest(pairs[:, 0].tolist(), pairs[:, 1].tolist()), columns=["a", "b"], dtype="int64")

    found = _postings(marked, n, buckets, lambda grams: prefix(grams, level.value, t))
    edges = written(found.groupBy("bucket").applyInPandas(join, "a long, b long"))
    return components(thinned(edges, "a", "b"), "a", "b")


def _linked(docs: DataFrame, groups: DataFrame, sizes: DataFrame, equal: DataFrame, n: int, t: int, block: int,
            buckets: int) -> DataFrame:
    """Edges that connect all linked documents of ``groups`` (node, component) and those of ``equal``;
    ``sizes`` has the units of each document."""

    def sized(found: DataFrame, units: DataFrame) -> DataFrame:
        """found (node, component) with the units of the document and those of its group."""
        each = written(found.join(units, found["node"] == units["doc_id"]).select("node", "component", "units"), rows=known)
        total = each.groupBy("component").agg(F.sum("units").alias("total"))
        return written(each.join(total, "component"), rows=known)

    known = groups.count()
    if not known:
        return equal
    members = sized(groups, sizes)
    # Whole texts move once, as a plain shuffle at every size, and only those of groups are kept.
    texts = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        members.select(F.col("node").alias("_id"), F.col("component").alias("comp"), "units", "total").hint("merge"),
        F.col("doc_id") == F.col("_id")).drop("_id").withColumn("label", F.col("doc_id")))
    edges, seed, classes = equal, 0, None
    while True:
        # Small groups share blocks and are compared whole; large ones are cut at random.
        small = F.col("total") <= block
        few = max(1, math.ceil((texts.where(small).agg(F.sum("units")).first()[0] or 0) / block))
        apart = F.xxhash64("comp", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.ceil(F.col("total") / block)))
        cut = texts.select("doc_id", "label", "text", F.when(small, F.col("comp")).otherwise(apart).alias("part"),
                           F.when(small, F.pmod(F.xxhash64("comp"), F.lit(few))).otherwise(few + F.abs(apart % 2**40)).alias("block"))
        edges = written(edges.unionByName(_multiplied(cut, n, t)))
        big = texts.where(~small)
        if not big.limit(1).count():
            return edges
        label = components(edges, "a", "b")
        marked = written(big.select("doc_id", "units", "text").join(label, big["doc_id"] == label["node"], "left").select(
            "doc_id", "units", "text", F.coalesce("component", "doc_id").alias("label")))
        marked = _possible(marked, n, t, buckets)
        # Counts of the few that are left tell their rare n-grams apart, as those of the table cannot.
        level = docs.sparkSession.sparkContext.broadcast(counted(marked, n)[0])
        again = sized(_contested(marked, n, t, level, buckets), marked.groupBy("doc_id").agg(F.max("units").alias("units")))
        texts = written(marked.join(again.select(F.col("node").alias("_id"), F.col("component").alias("comp"), "total").hint("merge"),
                                    F.col("doc_id") == F.col("_id")).drop("_id"))
        left = texts.where(F.col("total") > block).agg(F.countDistinct("label")).first()[0]
        if not left or classes is None or 2 * left < classes:
            classes, seed = left, seed + 1
            continue
        small = texts.where(F.col("total") <= block)
        large = _across(texts.where(F.col("total") > block), n, t, block)
        alone = _multiplied(small.select("doc_id", "label", "text", F.col("comp").alias("part"), F.col("comp").alias("block")), n, t)
        return written(edges.unionByName(large).unionByName(alone))


def _across(rows: DataFrame, n: int, t: int, block: int) -> DataFrame:
    """Links between the classes of large groups (comp, doc_id, label, units, text): parts of the
    largest class meet parts of the others, and these each other."""
    of = written(rows.groupBy("comp", "label").agg(F.sum("units").alias("units")))
    top = of.groupBy("comp").agg(F.max_by("label", F.struct("units", "label")).alias("most"), F.max("units").alias("of_most"), F.sum("units").alias("of_all"))
    half = block / 2
    cut = rows.join(written(top), "comp").withColumns({
        "main": F.ceil(F.col("of_most") / half).cast("long"), "side": F.ceil((F.col("of_all") - F.col("of_most")) / half).cast("long"),
        "is_main": F.col("label") == F.col("most")})
    own = F.pmod(F.xxhash64(F.lit(-1), "doc_id"), F.when(F.col("is_main"), F.col("main")).otherwise(F.col("side")))
    sides = F.sequence(F.lit(0).cast("long"), F.col("side") - 1)
    mains = F.sequence(F.lit(0).cast("long"), F.col("main") - 1)
    own = cut.withColumn("own", own)
    parts = F.when(F.col("is_main"), F.transform(sides, lambda x: F.xxhash64("comp", F.lit(0), "own", x))).otherwise(F.concat(
        F.transform(mains, lambda x: F.xxhash64("comp", F.lit(0), x, "own")),
        F.transform(sides, lambda x: F.xxhash64("comp", F.lit(1), F.least(x, F.col("own")), F.greatest(x, F.col("own"))))))
    met = own.select("doc_id", "label", "text", F.explode(parts).alias("part"))
    return _multiplied(met.withColumn("block", F.col("part")), n, t)


def joined(docs: DataFrame, n: int = 5, t: int = 80, block: int = BLOCK, buckets: int = BUCKETS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Documents link when 100 * overlap >= t * union of their sets of n-word shingles;
    ``component_id`` is the smallest doc_id that links reach, the document itself included. Null
    and blank texts have the empty set and link with nothing. Rows without id link with nothing
    and have no component. Rows that repeat an id are one node with the links of all their texts.
    Other columns are not read; an empty table gives an empty result.
    """
    levels, grams = counted(docs, n)
    level = docs.sparkSession.sparkContext.broadcast(levels)  # a byte per counter
    buckets = max(buckets, math.ceil(grams * (100 - t) / 100 / ENTRIES))
    scan = written(_scanned(docs, n, t, level, buckets))
    keys = scan.where("bucket = -1").select("doc_id", "n_shingles", "k1", "k2")
    shared = scan.where("bucket >= 0").select("bucket", "sig", "ids", "sizes").groupBy("bucket").applyInPandas(
        _shared(t), "a long, b long")
    groups = components(thinned(written(shared), "a", "b"), "a", "b")
    units = keys.groupBy("doc_id").agg(F.max(F.ceil(F.greatest(F.col("n_shingles"), F.lit(1)) / UNIT)).alias("units"))
    least = written(keys.where("n_shingles > 0").groupBy("n_shingles", "k1", "k2").agg(
        F.min("doc_id").alias("b"), F.count("*").alias("times")).where("times > 1").drop("times"), rows=keys.count())
    equal = keys.join(least, ["n_shingles", "k1", "k2"]).select(F.col("doc_id").alias("a"), "b").where("a <> b")
    edges = _linked(docs, groups, units, written(equal, rows=keys.count()), n, t, block, buckets)
    label = components(edges, "a", "b")
    return keys.join(label, keys["doc_id"] == label["node"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def deduplicated(docs: DataFrame, n: int = 5, t: int = 80) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component; rows without id stay."""
    found, own = joined(docs, n, t), f"_{uuid4().hex}"  # no name that a column of docs can have
    dropped = written(found.where("doc_id <> component_id").select(F.col("doc_id").alias(own)).distinct())
    return docs.join(dropped.hint("merge"), docs["doc_id"] == F.col(own), "left_anti")
