"""Secrets in texts: fixed patterns, and character Markov models of random strings.

All of it is DataFrame expressions. A pattern's spans come from its matches and the gaps between
them, which ``split`` gives. Long tokens that no pattern covers are scored by the log-likelihood
ratio, a pair of characters, of two first-order models: one of random strings and one of ordinary
identifiers. Both are counted on labelled samples. Random are strings drawn from digests in several
alphabets, and the values (not the key words) that the assignment pattern finds in at most
``sample`` documents. Ordinary are the other tokens of these documents, and identifiers of all
usual styles made of their words and of common words of programs, with and without numbers. The
fitted model is a table of ``len(ALPHABET) ** 2`` numbers.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotledger.llm.common import text_of

# The patterns that are to be matched.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
# A run that is long enough is the same match as any run whose short ones are dropped.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ASSIGN_VALUE = 8
KINDS = ("assign", "access", "hex", "random")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
TRAIN_TOKEN = r"[A-Za-z0-9+/_=-]{8,}"
SAMPLE = 4000   # documents that the models are counted on, those of the smallest hashed ids
DRAWN = 20_000  # strings of each class that are made
MARGIN = 0.6    # nats a pair of characters by which the random model must be likelier

# Common words of programs and addresses.
WORDS = (
    "abstract access account action adapter address admin agent alert analysis api app application archive array "
    "article async auth backup base batch binary block buffer build builder button bytes cache call catalog chain "
    "channel check class client cluster code collection column command commit common component config connection "
    "constant content context controller convert copy core count create current custom data database date default "
    "delete device document driver dynamic element engine entity error event example exception execute export "
    "factory feature field file filter final folder format function generate get global group handler hash header "
    "helper host http https id image import index info input instance interface internal invalid item java job key "
    "language layout length level library limit link list listener load local lock log main manager map message "
    "method model module name network node number object office option order output package page parameter parser "
    "password path payment plugin pool process product profile project property provider proxy query queue reader "
    "record registry remote report request resource response result root rule schema script search section "
    "security selector serializer server service session set settings singleton source spark sql state static "
    "status storage stream string style system table target task template test text thread time token tree type "
    "update upload url user util value version view web widget window worker writer www xml").split()


def _placed(matches: Column, gaps: Column, rank: int, values: Column | None = None) -> Column:
    """Array of (start, rank, end, size): where each match lies, in code points."""
    sizes = F.transform(values if values is not None else matches, F.length)
    items = F.arrays_zip(F.slice(gaps, 1, F.size(matches)).alias("gap"), matches.alias("match"), sizes.alias("size"))
    none = F.array().cast("array<struct<start:int,rank:int,end:int,size:int>>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["match"])
        one = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), x["size"].alias("size"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(one)).alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    return F.when(F.size(matches) > 0, F.aggregate(items, begin, step)["spans"]).otherwise(none)


def _matched(df: DataFrame, name: str, pattern: str) -> DataFrame:
    """Adds the matches of a pattern and, where there are any, the gaps around them."""
    df = df.withColumn(name, F.regexp_extract_all("body", F.lit(pattern), F.lit(0)))
    return df.withColumn(f"{name}_gaps", F.when(F.size(name) > 0, F.split("body", pattern, -1)))


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, body and ``base``: the sorted (start, rank, end, size) of all pattern matches."""
    df = docs.select("doc_id", text_of().alias("body"))
    for name, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX)):
        df = _matched(df, name, pattern)
    df = df.withColumn("value", F.when(F.size("assign") > 0, F.regexp_extract_all("body", F.lit(ASSIGN), F.lit(2))))
    found = [_placed(F.col(k), F.col(f"{k}_gaps"), r, F.col("value") if k == "assign" else None)
             for r, k in enumerate(KINDS[:3])]
    long = F.filter(found[0], lambda s: s["size"] >= ASSIGN_VALUE)
    return df.select("doc_id", "body", F.array_sort(F.concat(long, *found[1:])).alias("base"))


def _styled(words: Column, style: Column, number: Column) -> Column:
    """An identifier of some lower-case words in one of 14 styles, most of them with a number."""
    camel = F.array_join(F.transform(words, F.initcap), "")
    snake, path = F.array_join(words, "_"), F.array_join(words, "/")
    lower = F.concat(F.get(words, F.lit(0)), F.array_join(F.transform(F.slice(words, 2, 9), F.initcap), ""))
    year = (number % 40 + 1990).cast("string")
    day = F.concat_ws("/", year, F.lpad((number % 12 + 1).cast("string"), 2, "0"), F.lpad((number % 28 + 1).cast("string"), 2, "0"))
    forms = (
        camel, lower, snake, F.array_join(words, "-"), path, F.upper(snake),
        F.concat(camel, (number % 100).cast("string")), F.concat(lower, year), F.concat(snake, F.lit("_v"), (number % 10).cast("string")),
        F.concat(F.array_join(words, "-"), F.lit("-"), number.cast("string")), F.concat_ws("/", path, day, F.array_join(words, "-")),
        F.concat(F.upper(snake), F.lit("_"), number.cast("string")),
        F.concat(F.translate(day, "/", "-"), F.lit("T"), F.translate(F.substring(day, 6, 5), "/", "-"), F.lit("-00Z-"), F.get(words, F.lit(0))),
        F.concat(F.get(words, F.lit(0)), F.lit("-"), F.translate(day, "/", ""), F.lit("-"), F.lpad(number.cast("string"), 6, "0")))
    return F.coalesce(*(F.when(style == k, form) for k, form in enumerate(forms)))


def made_strings(spark: SparkSession, n: int, start: int = 0) -> DataFrame:
    """(random, token): ``n`` random strings and ``n`` identifiers, the ``start``-th and on."""
    rows = spark.range(start, start + n)
    sha = F.sha2(F.concat(F.lit("sample "), F.col("id").cast("string")), 256)
    base64 = F.translate(F.base64(F.unhex(sha)), "=", "")
    plain = F.translate(base64, "+/", "")
    alphabets = F.array(base64, F.translate(base64, "+/", "-_"), plain, plain, F.lower(plain), F.upper(plain), sha, F.upper(sha))
    size = (F.lit(20) + F.pmod(F.xxhash64("id", F.lit(0)), F.lit(21))).cast("int")
    drawn = F.substring(F.get(alphabets, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(8)).cast("int")), F.lit(1), size)
    words = F.split(F.lit(" ".join(WORDS)), " ")
    picked = F.transform(F.sequence(F.lit(2), F.lit(4) + F.pmod(F.xxhash64("id", F.lit(6)), F.lit(2))), lambda j: F.get(
        words, F.pmod(F.xxhash64("id", j), F.lit(len(WORDS))).cast("int")))
    named = _styled(picked, F.pmod(F.xxhash64("id", F.lit(7)), F.lit(14)), F.pmod(F.xxhash64("id", F.lit(8)), F.lit(10_000)))
    both = F.array(F.struct(F.lit(1).alias("random"), drawn.alias("token")), F.struct(F.lit(0).alias("random"), named.alias("token")))
    return rows.select(F.explode(both).alias("x")).select("x.random", "x.token")


def labelled(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(random, token) of at most ``sample`` documents: values of assignments, and as ordinary ones
    the tokens outside all pattern spans and identifiers of the words there."""
    few = docs.select("doc_id").where("doc_id is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    part = docs.join(F.broadcast(few), "doc_id", "left_semi").select(text_of().alias("body"))  # at most ``sample`` ids
    values = F.filter(F.regexp_extract_all("body", F.lit(ASSIGN), F.lit(2)), lambda v: (F.length(v) >= ASSIGN_VALUE) & v.rlike("[0-9]"))
    cut = part.select(values.alias("values"), F.concat_ws(" ", F.split("body", f"{ASSIGN}|{ACCESS}|{HEX}", -1)).alias("rest"))
    cut = cut.select("values", F.regexp_extract_all("rest", F.lit(TRAIN_TOKEN), F.lit(0)).alias("tokens"), F.regexp_extract_all(
        "rest", F.lit(r"[A-Za-z]{2,12}+(?:[^A-Za-z]++[A-Za-z]{2,12}+){2}"), F.lit(0)).alias("groups"))
    groups = cut.select(F.posexplode("groups").alias("at", "group")).select(
        "at", F.regexp_extract_all(F.lower("group"), F.lit("[a-z]+"), F.lit(0)).alias("group"))
    style, number = (F.pmod(F.xxhash64(*x), F.lit(n)) for x, n in ((("at", "group"), 14), (("group", "at"), 10_000)))
    groups = groups.select("group", style.alias("style"), number.alias("number"))
    names = groups.select(F.lit(0).alias("random"), _styled(F.col("group"), F.col("style"), F.col("number")).alias("token"))
    return cut.select(F.lit(1).alias("random"), F.explode("values").alias("token")).unionByName(
        cut.select(F.lit(0).alias("random"), F.explode("tokens").alias("token"))).unionByName(names)


def fitted(docs: DataFrame, sample: int = SAMPLE, drawn: int = DRAWN) -> list[float]:
    """Log-likelihood ratios of character pairs, row by row of the alphabet, with add-one smoothing."""
    tokens = labelled(docs, sample).unionByName(made_strings(docs.sparkSession, drawn))
    tokens = tokens.select("random", F.explode(F.regexp_extract_all("token", F.lit(TRAIN_TOKEN), F.lit(0))).alias("token"))
    pairs = tokens.select("random", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("token") - 1), lambda i: F.substring(F.col("token"), i, F.lit(2)))).alias("pair"))
    counts = {(r["random"], r["pair"]): r["n"] for r in
              pairs.groupBy("random", "pair").agg(F.count("*").alias("n")).collect()}  # at most 2 * 67 ** 2 rows
    size, table = len(ALPHABET), []
    for a in ALPHABET:
        rows = [[counts.get((kind, a + b), 0) + 1 for b in ALPHABET] for kind in (0, 1)]
        plain, rand = (sum(r) for r in rows)
        table += [math.log(rows[1][i] / rand) - math.log(rows[0][i] / plain) for i in range(size)]
    return table


def ratio(token: Column, model: Column) -> Column:
    """Nats a pair by which the random model makes a token likelier."""
    def at(i: Column) -> Column:
        return F.instr(F.lit(ALPHABET), F.substring(token, i, F.lit(1)))

    steps = F.sequence(F.lit(1), F.length(token) - 1)
    return F.aggregate(steps, F.lit(0.0), lambda acc, i: acc + F.element_at(
        model, (at(i) - 1) * len(ALPHABET) + at(i + 1))) / (F.length(token) - 1)


def as_column(table: list[float]) -> Column:
    return F.split(F.lit(",".join(map(repr, table))), ",").cast("array<double>")


def secrets(docs: DataFrame, sample: int = SAMPLE, margin: float = MARGIN) -> DataFrame:
    """One row per document: doc_id, ``base`` and ``spans``, arrays of (start, rank, end, size).

    ``spans`` has the pattern spans and the tokens of 20 characters or more, with a letter and a
    digit, that the random model makes likelier by ``margin`` nats a pair of characters and no
    pattern span touches. Null texts have none; repeated rows give repeated rows; ids may be null;
    other columns are not read.
    """
    model = as_column(fitted(docs, sample))
    df = _matched(base_spans(docs), "random", TOKEN)
    df = df.select("doc_id", "base", "random", _placed(F.col("random"), F.col("random_gaps"), 3).alias("placed"))
    scored = F.zip_with("placed", "random", lambda s, t: F.when(
        t.rlike("[0-9]") & t.rlike("[A-Za-z]")
        & ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        & (ratio(t, model) >= margin), s))
    more = F.when(F.size("placed") > 0, F.filter(scored, lambda s: s.isNotNull())).otherwise(F.col("placed"))
    return df.select("doc_id", "base", F.array_sort(F.concat("base", more)).alias("spans"))


def listed(spans: str) -> Column:
    """``kind:start:end`` of an array of spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def reported(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    def count(rank: int) -> Column:
        return F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long").alias(f"n_{KINDS[rank]}")

    return secrets(docs).select("doc_id", count(0), count(1), count(2),
                                F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))
