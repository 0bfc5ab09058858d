"""Fill-in-the-middle transformation of documents, cut at token boundaries.

Tokens are a run of white space with the word after it, or white space at the end, so a token ends
where a word ends. Where those ends lie follows from summaries of pieces of the text:

1. A rolling hash over the bytes cuts a text into content-defined chunks, so a passage that many
   documents share gives the same chunks in each.
2. A chunk's summary is kept by its content: the dictionary finds it by hash and compares the bytes,
   so a chunk that is met again is not read again, and equal hashes of different chunks do no harm.
   A summary holds the characters, the word ends inside, and whether its first and last byte are
   white space; that is all that is needed to add summaries up.
3. Running sums over the chunks give the number of tokens and the chunk of each cut; only those
   chunks are searched.

The memory of a task is bounded by one text and ``KNOWN_BYTES`` of known chunks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKS = ("<P>", "<S>", "<M>")
SPAN = 16           # bytes that the rolling hash sees
CUT_BITS = 9        # a chunk ends at one of 2 ** CUT_BITS hashes
LONGEST = 1 << 14   # bytes of a chunk
KNOWN_BYTES = 1 << 25
STRETCH = 1 << 16   # bytes whose hashes are computed at a time
BATCH = 128

_GAP = np.zeros(256, bool)
_GAP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_VALUE = np.random.default_rng(7).integers(1, 2**32, 256, dtype=np.uint32)


def chunk_ends(raw: bytes) -> list[int]:
    """Ends of the content-defined chunks of ``raw``; the last one is its length."""
    a, cuts = np.frombuffer(raw, np.uint8), []
    for at in range(0, len(a), STRETCH):
        part = _VALUE[a[max(0, at - SPAN + 1):at + STRETCH]]
        # The hash of SPAN bytes, by doubling: each byte's value is shifted by its distance.
        width = 1
        while width < SPAN and len(part) > width:
            part = part[width:] + (part[:-width] * np.uint32(pow(0x9E3779B1, width, 2**32)))
            width *= 2
        if width == SPAN:
            first = max(0, at - SPAN + 1) + SPAN
            cuts.append(np.flatnonzero(part >> np.uint32(32 - CUT_BITS) == 0) + first)
    found = np.concatenate(cuts) if cuts else np.empty(0, np.int64)
    ends, last = [], 0
    for end in [*found[found < len(a)].tolist(), len(a)]:
        while end - last > LONGEST:
            last += LONGEST
            ends.append(last)
        if end > last:
            ends.append(end)
            last = end
    return ends


def summary(chunk: bytes) -> tuple[int, int, bool, bool]:
    """Characters, word ends before its last byte, and whether its first and last byte are gaps."""
    a = np.frombuffer(chunk, np.uint8)
    gap = _GAP[a]
    inner = int(np.count_nonzero(gap[1:] & ~gap[:-1]))
    return int(np.count_nonzero((a & 0xC0) != 0x80)), inner, bool(gap[0]), bool(gap[-1])


class Chunks:
    """Summaries of the chunks that were met, by content."""

    def __init__(self, most: int = KNOWN_BYTES):
        self.known: dict[bytes, tuple[int, int, bool, bool]] = {}
        self.most, self.held, self.read = most, 0, 0

    def of(self, chunk: bytes) -> tuple[int, int, bool, bool]:
        found = self.known.get(chunk)
        if found is None:
            self.read += 1
            found = summary(chunk)
            if self.held + len(chunk) > self.most:
                self.known.clear()
                self.held = 0
            self.known[chunk] = found
            self.held += len(chunk)
        return found


class Text:
    """Token counts and cuts of one text from its chunks."""

    def __init__(self, raw: bytes, chunks: Chunks):
        self.raw, self.ends = raw, chunk_ends(raw)
        self.starts = [0, *self.ends[:-1]]
        parts = [chunks.of(raw[x:y]) for x, y in zip(self.starts, self.ends)]
        self.words, self.chars, words, chars = [], [], 0, 0  # before the end of each chunk
        follows = [first for _, _, first, _ in parts[1:]] + [True]
        for (n, inner, _, last), gap in zip(parts, follows):
            words += inner + (gap and not last)  # a word may end with its chunk
            chars += n
            self.words.append(words)
            self.chars.append(chars)
        self.n = words + bool(parts and parts[-1][3])

    def cut(self, k: int) -> tuple[int, int]:
        """Bytes and characters of the first ``k`` tokens."""
        if k == 0:
            return 0, 0
        if k == self.n:
            return len(self.raw), self.chars[-1]
        at = int(np.searchsorted(self.words, k))  # the chunk that holds the end of word k
        rest = k - (self.words[at - 1] if at else 0)
        start, end = self.starts[at], self.ends[at]
        # With the next byte, whose kind tells whether a word ends with the chunk.
        gap = _GAP[np.frombuffer(self.raw[start:end + 1] + b" " * (end == len(self.raw)), np.uint8)]
        place = start + int(np.flatnonzero(gap[1:] & ~gap[:-1])[rest - 1]) + 1
        inside = np.frombuffer(self.raw[start:place], np.uint8)
        return place, (self.chars[at - 1] if at else 0) + int(np.count_nonzero((inside & 0xC0) != 0x80))


def draws(seed: int, doc_id: int | None) -> list[int]:
    """The first four 32-bit numbers of the SHA-256 of ``seed:doc_id``; no id is an empty string."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[k:k + 4], "big") for k in range(0, 16, 4)]


_COLUMNS = [("doc_id", pa.int64(), "long"), ("n", pa.int64(), "long"), ("form", pa.string(), "string"),
            ("prefix_chars", pa.int64(), "long"), ("middle_chars", pa.int64(), "long"), ("output", pa.binary(), "binary")]


def transformed(docs: DataFrame, seed: int = 42, rate: int = 50, spm: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n (tokens), form, prefix_chars, middle_chars, output.

    ``rate`` per cent of the documents are cut at two token boundaries drawn from the id, ``spm`` per
    cent of these are put in the order suffix, prefix, middle (form spm), the others in that of
    prefix, suffix, middle (psm). The rest, empty texts and those that hold a mark are plain: the text
    as it is, with null counts. Null text is empty. Rows that repeat an id have the same draws; rows
    without one draw from an empty string. An empty table gives an empty result; other columns are
    not read.
    """
    p, s, m = (x.encode() for x in MARKS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = Chunks()
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                rows = []
                for doc_id, raw in zip(*(c.to_pylist() for c in whole.slice(at, BATCH).columns)):
                    text = Text(raw, chunks)
                    h1, h2, h3, h4 = draws(seed, doc_id)
                    if not raw or p in raw or s in raw or m in raw or h3 % 100 >= rate:
                        rows.append((doc_id, text.n, "plain", None, None, raw))
                        continue
                    (x, before), (y, upto) = (text.cut(k) for k in sorted((h1 % (text.n + 1), h2 % (text.n + 1))))
                    prefix, middle, suffix = raw[:x], raw[x:y], raw[y:]
                    form = "spm" if h4 % 100 < spm else "psm"
                    output = (s + suffix + p + prefix if form == "spm" else p + prefix + s + suffix) + m + middle
                    rows.append((doc_id, text.n, form, before, upto - before, output))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t, _) in zip(zip(*rows), _COLUMNS)],
                                                 names=[n for n, _, _ in _COLUMNS])

    raw = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).cast("binary").alias("raw"))
    return raw.mapInArrow(work, ", ".join(f"{n} {t}" for n, _, t in _COLUMNS)).withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The text that ``transformed`` was given: the parts between the marks in their first order."""
    parts = F.split(output, "|".join(MARKS), -1)  # the marks stand for themselves in a pattern
    order = {"psm": (1, 3, 2), "spm": (2, 3, 1)}
    cases = [F.when(form == f, F.concat(*(F.get(parts, F.lit(k)) for k in ks))) for f, ks in order.items()]
    return F.coalesce(*cases, output)


def digests(found: DataFrame) -> DataFrame:
    """The rows of ``transformed`` with SHA-256 of the output and of the text rebuilt from it."""
    return found.withColumn("output_sha256", F.sha2("output", 256)).withColumn(
        "restored_sha256", F.sha2(restored(F.col("output"), F.col("form")), 256)).drop("output")
