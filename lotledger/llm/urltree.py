"""URL filter by path-template trees.

Per host, path segments form a tree. Segments that look variable (numbers, long hexadecimal runs,
numbers with a file ending) become typed wildcards, and below every node the rare literals become
``*``, so a node keeps at most ``1 / share`` literal children. Children whose own children are
distributed alike, and whose labels do not contradict each other, are merged; the tree is as deep as
the paths branch. A template is rejected when its smoothed labelled purity reaches the
threshold; urls that a rule decides are the labels, and only they count in it. A template with few
of them rejects nothing.

Everything is counted on distinct (host, typed segments) rows, so a host with a third of all urls
shrinks in the map-side aggregation before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotledger.llm.common import written

ALLOW, BLOCK = "allow", "block"
SHARE = 0.05        # of a node's urls that keeps a literal child from becoming ``*``
DISTANCE = 0.25     # Hellinger distance up to which a branch is like its siblings
CONTRAST = 0.25     # difference of labelled block rates up to which they do not contradict
WEIGHT = 4.0        # urls that the corpus-wide block rate counts as, in the purity
LABELS = 10         # labelled urls from which a template or branch speaks for unlabelled ones
PURITY = 0.9


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #``, A-Z lower-cased; empty without ``://`` or url."""
    raw = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest (host, path, verdict) rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def _kind(segment: Column) -> Column:
    return (F.when(segment.rlike(r"^[0-9]+$"), "{n}")
            .when(segment.rlike(r"^(?=.*[0-9])[0-9a-fA-F-]{8,}$"), "{x}")
            .when(segment.rlike(r"^[0-9]+\.[A-Za-z]{1,5}$"), F.concat(F.lit("{n}."), F.substring_index(segment, ".", -1)))
            .otherwise(segment))


def _segments(path: Column) -> Column:
    """The typed segments of a path, all of them."""
    return F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), _kind)


def _placed(tree: DataFrame, rows: int) -> DataFrame:
    """Moves every row below what all rows of its (host, prefix) have in common.

    The common start of sorted arrays is that of the first and the last, so a chain without a
    branch takes one step, however long. ``thin`` marks nodes with too few urls for any verdict.
    """
    nodes = written(tree.groupBy("host", "prefix").agg(
        F.sum("n").alias("t"), F.min("rest").alias("lo"), F.max("rest").alias("hi")), rows=rows)
    same = F.zip_with("lo", "hi", lambda x, y: F.coalesce(x == y, F.lit(False)))
    differs = F.array_position(same, False).cast("int")
    nodes = nodes.select("host", "prefix", "t", (F.col("t") < LABELS).alias("thin"),
                         F.when(differs == 0, F.size("lo")).otherwise(differs - 1).alias("shared"))
    down = F.concat("prefix", F.array_join(F.transform(
        F.slice("rest", 1, F.col("shared")), lambda s: F.concat(F.lit("/"), s)), ""))
    return tree.join(nodes, ["host", "prefix"]).select(
        "host", "segments", "n", "blocked", "allowed", "t", "thin",
        F.when(F.col("thin"), F.col("prefix")).otherwise(down).alias("prefix"),
        F.when(F.col("thin"), F.col("rest")).otherwise(
            F.slice("rest", F.col("shared") + 1, F.size("rest"))).alias("rest"))


def _wildcards(tree: DataFrame, rows: int) -> DataFrame:
    """Replaces the rare literals of the next segment below each (host, prefix) by ``*``."""
    tree = tree.withColumn("child", F.coalesce(F.get("rest", F.lit(0)), F.lit("")))
    counts = tree.groupBy("host", "prefix", "child").agg(F.sum("n").alias("c"), F.first("t").alias("t"))
    kept = written(counts.where(F.col("child").isin("{n}", "{x}", "")
                                | (F.col("c") >= F.greatest(F.lit(2.0), F.col("t") * SHARE)))
                   .select("host", "prefix", "child", F.lit(True).alias("kept")), rows=rows)
    return tree.join(kept, ["host", "prefix", "child"], "left").withColumn(
        "token", F.when(F.col("kept"), F.col("child")).otherwise("*")).drop("kept", "child")


def clusters(pairs: Sequence[tuple[str, str, float]]) -> dict[str, list[str]]:
    """Complete-linkage groups of tokens, from the pairs that are alike, nearest first.

    Two groups become one only if every token of one is like every token of the other, so no
    group holds two branches that contradict each other. Ties go by the tokens.
    """
    alike = {frozenset(p[:2]) for p in pairs}
    group = {t: [t] for p in pairs for t in p[:2]}
    for a, b, _ in sorted(pairs, key=lambda p: (round(p[2], 9), p[0], p[1])):
        one, two = group[a], group[b]
        if one is not two and all(frozenset((x, y)) in alike for x in one for y in two):
            one = sorted(one + two)
            group.update({t: one for t in one})
    return {t: g for t, g in group.items() if len(g) > 1}


def _joint(pairs: pd.Series) -> pd.Series:
    """A few hundred pairs of one node; the name of a group is ``*`` if that is in it, else its tokens."""
    return pairs.map(lambda ps: [
        {"token": t, "joint": "*" if "*" in g else "{" + "|".join(g) + "}"}
        for t, g in clusters([(p["a"], p["b"], p["far"]) for p in ps]).items()])


def _merged(tree: DataFrame, rows: int) -> DataFrame:
    """Gives alike branches below a (host, prefix) one token.

    A node has at most ``1 / SHARE`` literals, two typed wildcards and ``*``, so its branches are
    compared in pairs: by the distribution of the segment after them and by labelled block rates.
    Where one side has no labels, the other must have enough of them, nearly all alike.
    """
    node, sums = ["host", "prefix"], ("n", "blocked", "allowed")
    after = F.coalesce(F.get("rest", F.lit(1)), F.lit(""))
    cells = written(tree.where("token <> ''").groupBy(*node, "token", after.alias("next")).agg(
        *(F.sum(c).alias(c) for c in sums)), rows=rows)
    side = written(cells.groupBy(*node, "token").agg(*(F.sum(c).alias(c) for c in sums)), rows=rows)

    def named(df: DataFrame, tag: str, columns: Sequence[str]) -> DataFrame:
        return df.select(*node, *(["next"] if "next" in df.columns else []), F.col("token").alias(tag),
                         *(F.col(c).alias(f"{tag}_{c}") for c in columns))

    shared = named(cells, "a", ["n"]).join(named(cells, "b", ["n"]), [*node, "next"]).where("a < b").groupBy(
        *node, "a", "b").agg(F.sum(F.sqrt(F.col("a_n") * F.col("b_n"))).alias("shared"))
    met = shared.join(named(side, "a", sums), [*node, "a"]).join(named(side, "b", sums), [*node, "b"])
    near = F.col("shared") / F.sqrt(F.col("a_n") * F.col("b_n"))
    far = F.sqrt(F.greatest(F.lit(0.0), 1 - near))
    mine, others = F.col("a_blocked") + F.col("a_allowed"), F.col("b_blocked") + F.col("b_allowed")
    rate = (F.col("a_blocked") + F.col("b_blocked")) / (mine + others)
    clear = (mine + others >= LABELS) & ((rate <= CONTRAST) | (rate >= 1 - CONTRAST))
    agree = F.when(mine + others == 0, True).when((mine == 0) | (others == 0), clear).otherwise(
        F.abs(F.col("a_blocked") / mine - F.col("b_blocked") / others) <= CONTRAST)
    joint = F.pandas_udf(_joint, "array<struct<token: string, joint: string>>")
    like = written(met.where((far <= DISTANCE) & agree).select(*node, F.struct("a", "b", far.alias("far")).alias("pair"))
                   .groupBy(*node).agg(F.collect_list("pair").alias("pairs"))
                   .select(*node, F.inline(joint("pairs"))), rows=rows)
    return tree.join(like, [*node, "token"], "left").withColumn("token", F.coalesce("joint", "token")).drop("joint")


def templates(urls: DataFrame) -> DataFrame:
    """(host, segments, template, purity, labelled) from rows of host, path and label (allow, block, null).

    Levels are added until no (host, prefix) with ``LABELS`` urls has a segment left; below a node
    with fewer, where no template can have the labels for a verdict, the rest of a path is ``**``.
    """
    first = written(urls.groupBy("host", _segments(F.col("path")).alias("segments")).agg(
        F.count("*").alias("n"), F.count_if(F.col("label") == BLOCK).alias("blocked"),
        F.count_if(F.col("label") == ALLOW).alias("allowed")))
    rows = first.count()
    keep = ["host", "segments", "n", "blocked", "allowed"]
    live, ended = first.select("*", F.lit("").alias("prefix"), F.col("segments").alias("rest")), []
    while rows:
        tree = written(_placed(live, rows), rows=rows)
        rest = F.size("rest") > 0
        ended.append(tree.where(F.col("thin") | ~rest).select(
            *keep, F.when(rest, F.concat("prefix", F.lit("/**"))).otherwise(F.col("prefix")).alias("template")))
        if tree.where(rest & ~F.col("thin")).isEmpty():
            break
        tree = _merged(written(_wildcards(tree.where(~F.col("thin")), rows), rows=rows), rows)
        live = written(tree.where(rest).select(
            *keep, F.concat("prefix", F.lit("/"), "token").alias("prefix"),
            F.slice("rest", 2, F.size("rest")).alias("rest")), rows=rows)
    tree = reduce(DataFrame.unionByName, ended or [first.select(*keep, F.lit("").alias("template"))])
    rate = F.sum("blocked") / F.greatest(F.lit(1), F.sum("blocked") + F.sum("allowed"))
    prior = first.agg(F.coalesce(rate, F.lit(0.0))).first()[0]  # one number
    blocked, labelled = F.sum("blocked"), F.sum(F.col("blocked") + F.col("allowed"))
    stats = written(tree.groupBy("host", "template").agg(
        ((blocked + WEIGHT * prior) / (labelled + WEIGHT)).alias("purity"), labelled.alias("labelled")), rows=rows)
    return written(tree.select("host", "segments", "template").join(stats, ["host", "template"]), rows=rows)


def judged(pages: DataFrame, rules: Sequence[tuple[str, str, str]], purity: float = PURITY) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, template, purity.

    A rule's verdict stands; other urls get ``block`` when their template has at least ``LABELS``
    labelled urls and its purity is at least ``purity``, else ``allow``. Null urls and urls without ``://`` have an empty host and
    path and form a template of their own. Repeated rows count as often as they occur; other
    columns are not read; an empty table gives an empty result.
    """
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, label = rule_of(F.col("host"), F.col("path"), rules)
    parts = parts.select("*", rule.alias("rule"), label.alias("label"))
    found = templates(parts)
    keyed = parts.withColumn("segments", _segments(F.col("path")))
    return keyed.join(found, ["host", "segments"], "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("label", F.when((F.col("purity") >= purity) & (F.col("labelled") >= LABELS), BLOCK).otherwise(ALLOW)).alias("verdict"),
        "template", "purity")
