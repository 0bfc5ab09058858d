"""Benchmark decontamination with a generalised suffix automaton of normalised test items.

1. Items are cut into words (runs of 0-9, a-z and non-ASCII characters, A-Z lower-cased) and long
   ones into pieces that overlap by a window less one word, which keeps every window. Pieces are
   dealt to blocks of bounded bytes; there is one block unless the items are large.
2. For each block the driver builds the suffix automaton of its pieces, over words, and ships it as
   flat arrays: that is what is broadcast, bounded by ``BLOCK_BYTES``.
3. Each task streams the words of its documents through the automaton, which tracks the longest
   match that ends at every word. A match of at least a window hits all its words; the suffix link
   that leads to the window itself tells the items that hold it. Items shorter than a window must
   match whole; they are terminal states on the chain of suffix links.
4. Spans of hits are returned, and ``cleaned`` cuts out those that exceed a length, and empties
   documents that exceed a share of hit words.

No rows are shuffled with one block. With several, only rows that have hits are, to be united.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotledger.llm.common import written

WINDOW = 10
BLOCK_BYTES = 1 << 20
PIECE_WORDS = 2048
STRETCH = 1 << 18
BATCH = 128
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
BREAK = re.compile(rb"[^0-9a-z\x80-\xff]")


def stretches(raw: bytes) -> Iterator[tuple[int, bytes]]:
    """(first byte, lower-cased bytes) of a text, cut between words, so that the words of a long
    text are never all in memory."""
    at = 0
    while at < len(raw):
        end = at + STRETCH
        if end < len(raw):
            gap = BREAK.search(raw[end:end + STRETCH].lower())
            while gap is None and end + STRETCH < len(raw):  # a very long word
                end += STRETCH
                gap = BREAK.search(raw[end:end + STRETCH].lower())
            end = end + gap.start() if gap else len(raw)
        yield at, raw[at:end].lower()
        at = end


def words(raw: bytes) -> list[bytes]:
    return [w for _, part in stretches(raw) for w in WORD.findall(part)]


class Automaton:
    """Suffix automaton of several word sequences; states are numbered from the root, 0."""

    def __init__(self) -> None:
        self.length, self.link, self.next = [0], [-1], [{}]

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(following)
        return len(self.length) - 1

    def _parted(self, p: int, word: int) -> int:
        """The state of ``p``'s longest string and ``word``, split off its state where that also
        holds longer ones."""
        q = self.next[p][word]
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, sequence: list[int]) -> None:
        last = 0
        for word in sequence:
            if word in self.next[last]:
                last = self._parted(last, word)
                continue
            new, p = self._state(self.length[last] + 1, 0, {}), last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self._parted(p, word)
            last = new


def automaton(pieces: list[tuple[str, bytes]], window: int) -> dict:
    """Flat form of the automaton of (item, words parted by a blank): the ids of words, transitions
    by state and word, lengths, links, and for the states of windows and of whole short items the
    length of the string and its items."""
    vocabulary: dict[bytes, int] = {}
    sequences = [[vocabulary.setdefault(w, len(vocabulary)) for w in text.split(b" ")] for _, text in pieces]
    made = Automaton()
    for sequence in dict.fromkeys(map(tuple, sequences)):
        made.add(list(sequence))
    names = sorted({item for item, _ in pieces})
    number = {item: k for k, item in enumerate(names)}
    found: dict[int, dict[int, set[int]]] = {}  # state: length of string: items
    for (item, _), sequence in zip(pieces, sequences):
        size, state = min(window, len(sequence)), 0
        for k, word in enumerate(sequence):
            state = made.next[state][word]
            if k + 1 >= size:
                while made.length[made.link[state]] >= size:  # the window's own state
                    state = made.link[state]
                found.setdefault(state, {}).setdefault(size, set()).add(number[item])
    marks = [(s, n, sorted(items)) for s, by in found.items() for n, items in sorted(by.items())]
    return {
        "words": list(vocabulary), "names": names, "least": min((n for _, n, _ in marks), default=window), "window": window,
        "states": np.array([s for s, f in enumerate(made.next) for _ in f], np.int64),
        "symbols": np.array([w for f in made.next for w in f], np.int64),
        "targets": np.array([t for f in made.next for t in f.values()], np.int64),
        "length": np.array(made.length, np.int64), "link": np.array(made.link, np.int64), "marks": marks}


class Matcher:
    """The automaton of a block in a task: streams words and tells hits."""

    def __init__(self, flat: dict):
        self.ids = {w: k for k, w in enumerate(flat["words"])}
        self.width, self.least, self.window = len(self.ids), flat["least"], flat["window"]
        self.step = dict(zip((flat["states"] * self.width + flat["symbols"]).tolist(), flat["targets"].tolist()))
        self.length, self.link = flat["length"].tolist(), flat["link"].tolist()
        self.names = flat["names"]
        self.own: dict[int, list[tuple[int, list[int]]]] = {}  # by state: length of a string, items
        for state, n, items in flat["marks"]:
            self.own.setdefault(state, []).append((n, items))
        # The nearest state with strings of its own on the chain of links, the state included.
        self.above = [-1] * len(self.length)
        for s in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            self.above[s] = s if s in self.own else self.above[self.link[s]]
        self.known: dict[tuple[int, int], tuple[int, frozenset[int]]] = {}

    def told(self, state: int, length: int) -> tuple[int, frozenset[int]]:
        """Of the strings of items that end a match of this length: the longest's length, all items."""
        most, items, s = 0, set(), self.above[state]
        while s > 0:
            for n, of in self.own[s]:
                if n <= length:
                    most = max(most, n)
                    items.update(of)
            s = self.above[self.link[s]]
        return most, frozenset(items)

    def match(self, raw: bytes) -> tuple[int, list[list[int]], set[int]]:
        """Number of words, spans of hit words (first, end), items whose strings occur."""
        ids, step, link, lengths, width = self.ids, self.step, self.link, self.length, self.width
        spans: list[list[int]] = []
        items: set[int] = set()
        seen: set[tuple[int, int]] = set()
        before = state = length = 0
        for _, part in stretches(raw):
            found = WORD.findall(part)
            for i, word in enumerate(map(ids.get, found)):
                if word is None:
                    state = length = 0
                    continue
                target = step.get(state * width + word)
                while target is None:  # every known word follows the root
                    state = link[state]
                    length = lengths[state]
                    target = step.get(state * width + word)
                state, length = target, length + 1
                if length < self.least:
                    continue
                key = (state, min(length, self.window))
                if key not in self.known:
                    self.known[key] = self.told(*key)
                size, of = self.known[key]
                if not size:
                    continue
                if key not in seen:
                    seen.add(key)
                    items |= of
                end = before + i + 1
                start = end - max(size, length if length >= self.window else 0)
                while spans and spans[-1][0] >= start:
                    spans.pop()
                if spans and spans[-1][1] >= start:
                    spans[-1][1] = end
                else:
                    spans.append([start, end])
            before += len(found)
        return before, spans, items


_last: list = []  # the arrays and the matcher of this Python worker's last task


def _matcher(flat: dict) -> Matcher:
    if not _last or _last[0] is not flat:
        _last[:] = [flat, Matcher(flat)]
    return _last[1]


def places(raw: bytes, spans: list[list[int]]) -> list[tuple[int, int]]:
    """First and end byte of spans of words."""
    want = sorted({x for a, b in spans for x in (a, b - 1)})
    at, k, found = 0, 0, {}
    for first, part in stretches(raw):
        for m in WORD.finditer(part):
            if k < len(want) and at == want[k]:
                found[at] = (first + m.start(), first + m.end())
                k += 1
            at += 1
        if k == len(want):
            break
    return [(found[a][0], found[b - 1][1]) for a, b in spans]


def item_pieces(items: DataFrame, window: int, most: int = PIECE_WORDS) -> DataFrame:
    """item_id (string, null: empty), words (parted by a blank): pieces of at least a window, or of
    the whole item, that hold every window. Items without words have none."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, raw in zip(*(c.to_pylist() for c in batch.columns)):
                of = words(raw)
                starts = range(0, max(1, len(of) - window + 1), most - window + 1) if of else ()
                rows = [b" ".join(of[k:k + most]) for k in starts]
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(rows), pa.string()), pa.array(rows, pa.binary())], names=["item_id", "words"])

    raw = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
                       F.coalesce("text", F.lit("")).cast("binary").alias("raw"))
    return raw.mapInArrow(cut, "item_id string, words binary")


_SPAN = ("first", "end", "first_byte", "end_byte")
_SPANS = f"array<struct<{', '.join(f'{n}: long' for n in _SPAN)}>>"


def _matched(rows: DataFrame, flat: dict, carried: list[str]) -> DataFrame:
    """``carried`` columns of ``rows`` (raw and others), n_words, spans, items."""
    shared = rows.sparkSession.sparkContext.broadcast(flat)
    span = pa.list_(pa.struct([(n, pa.int64()) for n in _SPAN]))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                part, found = whole.slice(at, BATCH), []
                for raw in part.column("raw").to_pylist():
                    n, spans, items = matcher.match(raw)
                    bounds = places(raw, spans) if spans else []
                    found.append((n, [dict(zip(_SPAN, (*s, *b))) for s, b in zip(spans, bounds)], [matcher.names[k] for k in items]))
                made = [pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), span, pa.list_(pa.string())))]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in carried), *made], names=[*carried, "n_words", "spans", "items"])

    kept = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in carried)
    return rows.mapInArrow(read, f"{kept}, n_words long, spans {_SPANS}, items array<string>")


def united(spans: Column) -> Column:
    """Spans of several blocks in order, those that touch or overlap made one."""

    def add(done: Column, x: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        both = F.struct(last["first"].alias("first"), F.greatest(last["end"], x["end"]).alias("end"),
                        last["first_byte"].alias("first_byte"), F.greatest(last["end_byte"], x["end_byte"]).alias("end_byte"))
        return F.when(last["end"] >= x["first"], F.concat(F.slice(done, 1, F.size(done) - 1), F.array(both))).otherwise(
            F.concat(done, F.array(x)))

    return F.aggregate(F.array_sort(spans), F.array().cast(_SPANS), add)


def matched(docs: DataFrame, items: DataFrame, window: int = WINDOW, text: bool = False,
            block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, spans, items, and the raw bytes if ``text``.

    A word is hit when it lies in an occurrence of ``window`` consecutive words of an item, or of all
    words of a shorter one. ``spans`` are the runs of hit words: first, end (words, end exclusive),
    first_byte, end_byte. ``items`` are the ids, as strings, of the items that have an occurrence.
    Null texts have no words; items without words occur nowhere. Rows of ``items`` that repeat an id
    are one item with the windows of all; a null id is an empty string. Repeated rows of ``docs``, and
    rows without id, are documents of their own. Empty tables are allowed; other columns are not read.
    """
    pieces = written(item_pieces(items, window).distinct())
    total = pieces.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)))
    keys = ["doc_id"] if blocks == 1 else ["doc_id", "digest"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("raw"))
    if blocks > 1:
        rows = rows.withColumn("digest", F.sha2("raw", 256))

    def block(k: int) -> dict:
        of = dealt.where(F.col("block") == k).select("item_id", "words").toPandas()
        return automaton(list(zip(of["item_id"], map(bytes, of["words"]))), window)

    found = _matched(rows, block(0), [*keys, "raw"] if text else keys)
    if blocks > 1:
        found = written(found)
        # Equal rows have equal hits, so one of them is enough; each is then met by its id and digest.
        more = [written(_matched(rows, block(k), keys).where(F.size("spans") > 0).dropDuplicates(keys)) for k in range(1, blocks)]
        hits = more[0]
        for x in more[1:]:
            hits = hits.unionByName(x)
        hits = written(hits.groupBy(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).agg(
            F.flatten(F.collect_list("spans")).alias("_spans"), F.flatten(F.collect_list("items")).alias("_items")))
        met = found.join(hits, found["doc_id"].eqNullSafe(hits["_id"]) & (found["digest"] == hits["_digest"]), "left")
        found = met.withColumn("spans", united(F.concat("spans", F.coalesce("_spans", F.array().cast(_SPANS))))).withColumn(
            "items", F.array_union("items", F.coalesce("_items", F.array().cast("array<string>"))))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["first"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), "spans", "items", *["raw"] * text)


def cleaned(docs: DataFrame, items: DataFrame, window: int = WINDOW, min_words: int = WINDOW, max_pct: int = 50) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, dropped, text.

    Spans of at least ``min_words`` hit words are cut out of the text, which else stays as it is. A
    document with more than ``max_pct`` per cent of its words hit is dropped: its text is null.
    """
    found = matched(docs, items, window, text=True)
    cut = F.filter("spans", lambda x: x["end"] - x["first"] >= min_words)
    # What is left before each span, then what is left after the last one.
    left = F.aggregate("cut", F.struct(F.lit(0).cast("long").alias("at"), F.lit(b"").alias("kept")), lambda t, x: F.struct(
        x["end_byte"].alias("at"), F.concat(t["kept"], F.substring("raw", (t["at"] + 1).cast("int"), (x["first_byte"] - t["at"]).cast("int"))).alias("kept")),
        lambda t: F.concat(t["kept"], F.substring("raw", (t["at"] + 1).cast("int"), F.octet_length("raw"))).cast("string"))
    dropped = 100 * F.col("n_hit") > max_pct * F.col("n_words")
    removed = F.aggregate("cut", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["first"])
    return found.withColumn("cut", cut).select(
        "doc_id", "n_words", F.when(dropped, F.col("n_words")).otherwise(removed).alias("n_removed"), dropped.alias("dropped"),
        F.when(~dropped, left).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """The rows of ``matched`` with the number and SHA-256 of the items instead of spans and items."""
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
