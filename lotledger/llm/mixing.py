"""Mixing sources to target weights by proportionally fair scheduling.

Each source's documents form blocks. Block ``j`` of a source of weight ``w`` is released at slot
``floor(j / w)`` and due at ``ceil((j + 1) / w)``; of the released blocks, the one due first takes
the slot. Weights are whole numbers over their sum, so both follow exactly, for every block there is,
from the weights themselves. After any number of slots each source has had its share to within less
than one block, as long as it has blocks; when a source runs out, its slots pass to the others in
their proportion.

The slots are cut into chunks that are dealt apart. A first pass deals each chunk as if nothing were
left from the one before; a block that it leaves over stays so however many come before it. What is
really handed on then follows chunk by chunk: of what came in and what the chunk dealt, as many as fit
in its slots go first by their due slots, the others wait. At most one block of a source waits, so
this chain needs a few rows a chunk. A second pass deals each chunk with what is handed to it. The
outcome is the schedule of one walk over all slots.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator, Mapping
from decimal import Decimal
from fractions import Fraction
from uuid import uuid4

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotledger.llm.common import written

BLOCK = 32
PERIOD = 4096
POWER = 0.7
CHUNK = 65_536      # slots that are dealt in one task
LARGEST = 10 ** 18  # sum up to which given weights are kept exactly
FINE = 10 ** 15     # sum of the weights that follow from counts


def shares(weights: Mapping[str, float], period: int = PERIOD) -> dict[str, int]:
    """Slots of each source in a period, by largest remainders, at least one each."""
    weights = {s: w for s, w in weights.items() if w > 0}
    if not weights:
        return {}
    period = max(period, 16 * len(weights))
    total = sum(weights.values())
    exact = {s: max(1.0, w / total * period) for s, w in weights.items()}
    over = sum(exact.values()) - period  # what the sources of less than one slot got on top
    big = sum(x for x in exact.values() if x > 1)
    exact = {s: x - over * x / big if x > 1 else x for s, x in exact.items()} if big else exact
    slots = {s: max(1, int(x)) for s, x in exact.items()}
    for s in sorted(exact, key=lambda s: (slots[s] - exact[s], s))[:max(0, period - sum(slots.values()))]:
        slots[s] += 1
    return slots


def dealt(blocks: Iterable[tuple[int, int, str, int]], start: int, stop: int) -> tuple[list, list]:
    """Earliest deadline first from slot ``start`` up to ``stop``: (slot, due, source, block) of the
    blocks that had their turn and (due, source, block) of those left, from (release, due, source, block)."""
    coming = sorted(blocks, reverse=True)
    ready: list[tuple[int, str, int]] = []
    out, slot = [], start
    while slot < stop and (coming or ready):
        while coming and coming[-1][0] <= slot:
            heapq.heappush(ready, coming.pop()[1:])
        if ready:
            out.append((slot, *heapq.heappop(ready)))
            slot += 1
        else:
            slot = coming[-1][0]
    return out, ready + [x[1:] for x in coming]


def schedule(slots: Mapping[str, int]) -> list[tuple[str, int, int]]:
    """(source, block, slot) of one period: earliest deadline first among the released blocks.

    The weights add up to one, so no slot is idle and, on a single line of slots, every block
    meets its deadline however ties are broken.
    """
    period = sum(slots.values())
    blocks = [(j * period // n, -(-(j + 1) * period // n), s, j) for s, n in slots.items() for j in range(n)]
    return [(s, j, slot) for slot, _, s, j in dealt(blocks, 0, period)[0]]


def whole(weights: Mapping[str, float]) -> dict[str, int]:
    """Positive weights as whole numbers in exact proportion to their decimal spelling; where these add up to
    more than ``LARGEST``, rounded to parts of it."""
    exact = {s: Fraction(str(w)) for s, w in weights.items() if w > 0}
    scale = math.lcm(*(w.denominator for w in exact.values()))
    if sum(exact.values()) * scale > LARGEST:
        scale = LARGEST / sum(exact.values())
    return {s: max(1, round(w * scale)) for s, w in exact.items()}


def _source() -> Column:
    return F.coalesce(F.col("source").cast("string"), F.lit(""))


def ranked(docs: DataFrame) -> DataFrame:
    """doc_id, source and rank, a document's number in its source in an order of hashes.

    Two-pass prefix sums: rows are dealt by ranges of (source, hash, id), so a hot source covers
    many ranges; the ranges' counts per source are summed up, and rows count on within a range.
    """
    keys = docs.select("doc_id", _source().alias("source"))
    h = F.xxhash64("doc_id")
    dealt = written(keys.withColumn("h", h).repartitionByRange("source", "h", "doc_id")
                    .withColumn("range", F.spark_partition_id()))
    counts = dealt.groupBy("source", "range").agg(F.count("*").alias("n"))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    bases = written(counts.select("source", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    inner = F.row_number().over(Window.partitionBy("range", "source").orderBy("h", "doc_id")) - 1
    return dealt.withColumn("inner", inner).join(bases, ["source", "range"]).select(
        "doc_id", "source", (F.col("base") + F.col("inner")).alias("rank"))


def weighted(counts: DataFrame, weights: Mapping[str, float] | None) -> DataFrame:
    """source, late, weight from source and n: given weights, else in proportion to a power of the
    counts over all rows. Sources without a weight are late and have one part each."""
    if weights is None:
        share = F.pow(F.col("n").cast("double"), F.lit(POWER))
        total = counts.agg(F.sum(share)).first()[0] or 1.0  # one number
        weight = F.greatest(F.lit(1), F.round(share / total * FINE)).cast("decimal(19,0)")
        return written(counts.select("source", F.lit(False).alias("late"), weight.alias("weight")))
    given = counts.sparkSession.createDataFrame(
        [(s, Decimal(w)) for s, w in whole(weights).items()], "source string, weight decimal(19,0)")
    return written(counts.join(given, "source", "left").select(
        "source", F.col("weight").isNull().alias("late"),
        F.coalesce("weight", F.lit(1)).cast("decimal(19,0)").alias("weight")))


def scheduled(blocks: DataFrame, weights: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """late, source, block, slot of all blocks; late ones have slots of their own, from zero."""
    sums = {r["late"]: (r["w"], r["n"]) for r in weights.groupBy("late").agg(  # two rows
        F.sum("weight").cast("decimal(19,0)").alias("w"), F.count("*").alias("n")).collect()}
    # The blocks that wait, one of a source at most, fit in a chunk.
    chunk = max(chunk, 4 * max((n for _, n in sums.values()), default=0))
    total = F.when(F.col("late"), F.lit(sums.get(True, (Decimal(1), 0))[0])).otherwise(
        F.lit(sums.get(False, (Decimal(1), 0))[0])).cast("decimal(19,0)")
    timed = blocks.join(weights, "source").withColumn("total", total).select(
        "late", "source", "block",
        F.expr("cast(block as decimal(15,0)) * total div weight").alias("release"),
        F.expr("(cast(block + 1 as decimal(15,0)) * total + weight - 1) div weight").alias("due"))
    timed = written(timed.withColumn("chunk", F.expr(f"release div {chunk}")))

    def rows(f: pd.DataFrame) -> Iterable[tuple[int, int, str, int]]:
        return zip(*(f[c].tolist() for c in ("release", "due", "source", "block")))

    def alone(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        late, k = key
        stop = (int(k) + 1) * chunk
        out, left = dealt(rows(f), stop - chunk, stop)
        found = [("idle", chunk - len(out), "", 0)]
        found += [("dealt", *x[1:]) for x in out if x[1] > stop]  # what is due earlier never waits
        found += [("left", *x) for x in left]
        return pd.DataFrame([(late, k, *x) for x in found], columns=["late", "chunk", "kind", "due", "source", "block"])

    def chain(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, idle, waiting, got, left = None, 0, [], [], []

        def handed() -> list[tuple[int, str, int]]:
            stay = max(0, len(waiting) - idle)
            return sorted(waiting + got)[len(waiting) + len(got) - stay:] + left

        def rest() -> list[tuple]:
            return [(at[0], at[1] + 1, (at[1] + 1) * chunk, *x) for x in waiting]

        columns = ["late", "chunk", "release", "due", "source", "block"]
        for f in frames:
            out = []
            for late, k, kind, *x in zip(*(f[c].tolist() for c in ("late", "chunk", "kind", "due", "source", "block"))):
                if (late, k) != at:
                    if at is not None:
                        waiting = handed()
                        out += rest()
                        if (late, k) != (at[0], at[1] + 1):  # no block is released in the chunk between
                            waiting = []
                    at, idle, got, left = (late, k), 0, [], []
                if kind == "idle":
                    idle = x[0]
                else:
                    (got if kind == "dealt" else left).append(tuple(x))
            yield pd.DataFrame(out, columns=columns)
        if at is not None:
            waiting = handed()
            yield pd.DataFrame(rest(), columns=columns)

    def final(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        late, k = key
        stop = (int(k) + 1) * chunk
        out, _ = dealt(rows(f), stop - chunk, stop)
        return pd.DataFrame([(late, s, j, slot) for slot, _, s, j in out], columns=["late", "source", "block", "slot"])

    ends = written(timed.groupBy("late", "chunk").applyInPandas(
        alone, "late boolean, chunk long, kind string, due long, source string, block long"))
    # A few rows for each chunk, streamed through one task.
    waiting = written(ends.repartition(1).sortWithinPartitions("late", "chunk").mapInPandas(
        chain, "late boolean, chunk long, release long, due long, source string, block long"))
    return written(timed.unionByName(waiting).groupBy("late", "chunk").applyInPandas(
        final, "late boolean, source string, block long, slot long"))


def mixed(docs: DataFrame, weights: Mapping[str, float] | None = None, block: int = BLOCK,
          period: int | None = None, chunk: int = CHUNK) -> DataFrame:
    """One row per document: doc_id, source, block, slot, position.

    ``position`` orders all documents: blocks by slot, documents within by rank. Without
    ``weights`` these follow the counts. Every row is kept: sources without a weight come
    after all others, in equal parts. A null source is the source of the empty name. Rows that
    repeat an id are documents of their own; a null id sorts first. Texts are not read.
    With ``period``, given weights are first rounded to whole slots of it.
    """
    counts = written(docs.groupBy(_source().alias("source")).agg(F.count("*").alias("n")))
    if weights is not None and period is not None:
        known = {r["source"] for r in counts.select("source").collect()}
        weights = shares({s: w for s, w in weights.items() if s in known}, period)
    by_rank = written(ranked(docs).withColumn("block", F.floor(F.col("rank") / block)))
    firsts = by_rank.where(F.col("rank") % block == 0).select("source", "block")
    plan = scheduled(firsts, weighted(counts, weights), chunk)
    late = plan.where(~F.col("late")).agg(F.coalesce(F.max("slot") + 1, F.lit(0))).first()[0]  # one number
    slot = F.when(F.col("late"), F.col("slot") + late).otherwise(F.col("slot"))
    placed = by_rank.join(plan.select("source", "block", slot.alias("slot")), ["source", "block"])
    return placed.select("doc_id", "source", "block", "slot",
                         (F.col("slot") * block + F.col("rank") % block).alias("position"))


def interleaved(docs: DataFrame, weights: Mapping[str, float] | None = None, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs``, whole, dealt and sorted by position, so that files follow the mix.

    Rows that repeat an id stand at the first of its positions.
    """
    own, place = (f"_{uuid4().hex}" for _ in range(2))  # no names that columns of docs can have
    order = written(mixed(docs, weights, block).groupBy(F.col("doc_id").alias(own)).agg(
        F.min("position").alias(place)))
    met = docs.join(order.hint("merge"), docs["doc_id"].eqNullSafe(order[own])).drop(own)
    return met.repartitionByRange(place).sortWithinPartitions(place).drop(place)
