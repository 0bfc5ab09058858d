"""How text filters interact: which documents each one removes, in every order of application.

1. One scan marks each document with a bit for every filter that looks at the text alone.
2. An existential self-join marks the last filter. Hashes that occur once are settled without their
   text. The texts of the others are reduced to one row per hash and exact text, with the smallest
   doc_id, and a left-semi join on hash, exact text and smaller doc_id finds the rows that fail.
3. Failures of both kinds are united and aggregated to counts per part and bit combination. All that
   is reported for any order follows from these at most 32 counts of a part.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotledger.llm.common import text_of, written

FILTERS = "ABCDE"
EXISTS = 1 << FILTERS.index("E")
ALL = (1 << len(FILTERS)) - 1
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
GAP = r"[\x20\x09-\x0D]+"


def text_bits(text: Column, min_words: int = 50, distinct_pct: int = 65, upper_pct: int = 5,
              marks: str = "[#$%&*|]") -> Column:
    """The bits of the four filters that need no other document; ``text`` must not be null."""
    words = F.filter(F.split(text, GAP), lambda w: w != "")
    n, different = F.size(words), F.size(F.array_distinct(words))
    upper = F.length(text) - F.length(F.translate(text, UPPER, ""))
    failed = [n < min_words, 100 * different < distinct_pct * n, 100 * upper > upper_pct * F.length(text), text.rlike(marks)]
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(failed)), F.lit(0))


def repeated(rows: DataFrame) -> DataFrame:
    """The rows of ``rows`` (doc_id, text and others) whose text a row of smaller doc_id has too.

    Rows without an id fail nothing and make nothing fail. Texts move only where their hash occurs
    under more than one id, and a hot text's first row is found by partial minima.
    """
    hashed = rows.withColumn("hash", F.xxhash64("text"))
    met = written(hashed.groupBy("hash").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
                  .where("low < high").select("hash"))
    some = written(hashed.join(met, "hash", "left_semi"))
    first = written(some.groupBy("hash", "text").agg(F.min("doc_id").alias("low")))
    same = [some["hash"] == first["hash"], some["text"] == first["text"], first["low"] < some["doc_id"]]
    return some.join(first, same, "left_semi").drop("hash")


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, bits, n, good, toxic: documents by source (null: empty string) and failed filters.

    Null text counts as empty. ``good`` and ``toxic`` count rows whose id has a label row with
    quality = 1, or toxic = 1; ids without labels, and rows without id, are neither. Rows that repeat
    an id are documents of their own. An empty table has no parts. Other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"),
                       text_of().alias("text"))
    bits = text_bits(F.col("text"))
    alone = rows.select("doc_id", "part", bits.alias("bits"), F.lit(1).alias("n"))
    # A document that fails the self-join leaves its combination for the one with that bit too.
    moves = F.array(F.struct(F.lit(0).alias("more"), F.lit(-1).alias("n")), F.struct(F.lit(EXISTS).alias("more"), F.lit(1).alias("n")))
    again = written(repeated(rows).select("doc_id", "part", bits.alias("bits"))).select("*", F.inline(moves)).select(
        "doc_id", "part", (F.col("bits") + F.col("more")).alias("bits"), "n")
    united = written(alone.unionByName(again).groupBy("doc_id", "part", "bits").agg(F.sum("n").alias("n")).where("n > 0"))
    told = written(labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("of")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")))
    return united.join(told, united["doc_id"] == told["of"], "left").groupBy("part", "bits").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"))


def audit(found: DataFrame) -> DataFrame:
    """What each filter does at each step of each order, from ``combinations``.

    One row per part, filter_order and step (from 1): kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley; zeros included.
    """
    # Documents by the filters that they must all pass: a count for each of the 32 sets.
    sets = F.sequence(F.lit(0), F.lit(ALL))

    def passing(of: str) -> Column:
        return F.transform(sets, lambda s: F.aggregate("all", F.lit(0).cast("long"), lambda t, x: t + F.when(
            x["bits"].bitwiseAND(s) == 0, x[of]).otherwise(0))).alias(of)

    parts = found.groupBy("part").agg(F.collect_list(F.struct("bits", "n", "good", "toxic")).alias("all")).select(
        "part", "all", *map(passing, ("n", "good", "toxic")))
    orders = F.lit(["".join(p) for p in permutations(FILTERS)])
    steps = parts.select("*", F.explode(orders).alias("filter_order")).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))

    def bits_of(letters: Column) -> Column:
        return sum((F.when(F.contains(letters, F.lit(x)), 1 << k).otherwise(0) for k, x in enumerate(FILTERS)), F.lit(0))

    before = bits_of(F.substring("filter_order", F.lit(1), F.col("step") - 1))
    own = bits_of(F.substring("filter_order", F.col("step"), F.lit(1)))
    # Of the orders, the filter comes before all others that a document fails in this share.
    first = F.aggregate("all", F.lit(0).cast("long"), lambda t, x: t + F.when(
        x["bits"].bitwiseAND(F.col("own")) != 0, x["n"] * F.element_at(F.lit([120, 60, 40, 30, 24]), F.bit_count(x["bits"]))).otherwise(0))
    only = F.aggregate("all", F.lit(0).cast("long"), lambda t, x: t + F.when(x["bits"] == F.col("own"), x["n"]).otherwise(0))

    def lost(of: str) -> Column:
        return F.get(of, F.col("before")) - F.get(of, F.col("after"))

    failing = F.get("n", F.lit(0)) - F.get("n", F.col("own"))
    return steps.select("*", before.alias("before"), own.alias("own")).withColumn("after", F.col("before") + F.col("own")).select(
        "part", "filter_order", "step", F.get("n", F.col("after")).alias("kept"), lost("n").alias("removed"),
        (failing - lost("n")).alias("redundant"), only.alias("unique_fails"), lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"), first.alias("shapley"))


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``audit`` of the ``combinations`` of a table."""
    return audit(combinations(docs, labels))
