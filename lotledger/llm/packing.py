"""Packing by concatenation and cutting.

First pass: texts are tokenized once and written as ids (two bytes each) with the number of tokens
that come before them in their input split. Second pass: prefix sums over the splits' totals give
each split's global offset, hence each document's, and the stream is cut into fixed windows. Every
id lies in exactly one piece; only the last window has padding.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from lotledger.llm.common import written

WINDOW = 2048
END = 1
#: Fixed value: the split into pieces that comes before the merges of this kind of vocabulary.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KNOWN = 400_000
BATCH = 128


def _ranks(path: str) -> dict[bytes, int]:
    """Tokens of a byte-level tokenizer file as bytes, with their ids, which must follow the order
    of the merges; then a piece's merges can be found from the ids alone."""
    model = json.loads(Path(path).read_text())["model"]
    vocab = model["vocab"]
    for k, merge in enumerate(model["merges"]):
        pair = merge.split(" ") if isinstance(merge, str) else merge
        if vocab["".join(pair)] != 256 + k:
            raise ValueError("ids do not follow the merges")
    # Bytes that print stand for themselves, the others for the characters from 256 on.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(sorted({*range(256)} - {*shown}))}
    return {bytes(byte[c] for c in token): i for token, i in vocab.items() if i < 256 + len(model["merges"])}


def _added(path: str) -> dict[str, int]:
    """The file's added tokens and their ids; those that take in what is around them are not known."""
    tokens = json.loads(Path(path).read_text()).get("added_tokens") or []
    if any(t.get(k) for t in tokens for k in ("single_word", "lstrip", "rstrip")):
        raise ValueError("added tokens that depend on what is around them")
    return {t["content"]: t["id"] for t in tokens}


class _Pieces:
    """Ids of texts as little-endian 16-bit integers; those of words are kept for reuse."""

    def __init__(self, path: str, added: bool):
        ranks, marks = _ranks(path), _added(path) if added else {}
        if max([len(ranks) - 1, *marks.values()]) >= 1 << 16:
            raise ValueError("ids need more than 16 bits")
        self.added = {t: np.array([i], "<u2").tobytes() for t, i in marks.items()}
        # Of those that begin at one place, the longest.
        longest = sorted(map(re.escape, marks), key=len, reverse=True)
        self.marks = re.compile(f"({'|'.join(longest)})") if marks else None
        self.encode = tiktoken.Encoding("own", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.after: dict[str, bytes] = {}  # by what follows a single blank, with that blank

    def _new(self, word: str) -> bytes:
        if len(self.after) > KNOWN:
            self.after.clear()
        ids = self.after[word] = np.array(self.encode(" " + word), "<u2").tobytes()
        return ids

    def ids(self, text: str) -> bytes:
        """Added tokens are found first; what is between them is encoded apart."""
        if self.marks is None or not self.marks.search(text):
            return self._plain(text)
        parts = self.marks.split(text)  # every second one is a mark
        return b"".join(self.added[x] if k % 2 else self._plain(x) for k, x in enumerate(parts))

    def _plain(self, text: str) -> bytes:
        """The tokenizer never joins what a single blank parts, and takes that blank to what
        follows, so texts are cut there; where blanks meet, its own split is needed."""
        if "  " in text:
            return np.array(self.encode(text), "<u2").tobytes()
        first, *rest = text.split(" ")
        found = [ids or self._new(w) for w, ids in zip(rest, map(self.after.get, rest))]
        return np.array(self.encode(first), "<u2").tobytes() + b"".join(found)


@functools.cache
def _of_worker(path: str, added: bool) -> _Pieces:
    """One per Python worker, so that its tasks share what is known."""
    return _Pieces(path, added)


_tokens = StructType([
    StructField("unit", StringType()), StructField("doc_id", LongType()),
    StructField("before", LongType()), StructField("n", LongType()), StructField("ids", BinaryType())])


def tokenized(docs: DataFrame, tokenizer: str, end: int = END, added: bool = False) -> DataFrame:
    """unit, doc_id, before, n, ids: every document's ids and ``end``, null text as empty.

    ``unit`` names the input split (file and first byte, so that units sort in the order of the
    files), ``before`` counts the tokens that precede the document in it. With ``added`` the strings
    of the file's added tokens get their ids, as the tokenizer does; else they are ordinary text.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, last = _of_worker(tokenizer, added), np.array([end], "<u2").tobytes()
        unit, before = None, 0
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                rows = []
                names, doc_ids, texts = (c.to_pylist() for c in whole.slice(at, BATCH).columns)
                for name, doc_id, ids in zip(names, doc_ids, map(known.ids, texts)):
                    if name != unit:
                        unit, before = name, 0
                    ids += last
                    n = len(ids) // 2
                    rows.append((unit, doc_id, before, n, ids))
                    before += n
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
                    pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=_tokens.names)

    task = F.lpad(F.spark_partition_id().cast("string"), 10, "0")
    split = F.concat_ws("#", F.input_file_name(), F.lpad(F.input_file_block_start().cast("string"), 20, "0"), task)
    columns = [F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")]
    try:
        rows = docs.select(split.alias("unit"), *columns)
    except AnalysisException:  # rows of several tables come from no one file; tasks give the order
        rows = docs.select(task.alias("unit"), *columns)
    return written(rows.mapInArrow(encode, _tokens))


def pieces(tokens: DataFrame, window: int = WINDOW) -> DataFrame:
    """Pieces of the concatenated stream: doc_id, start, length, doc_tokens, sequence_id, offset,
    ids (32-bit little-endian)."""
    totals = tokens.groupBy("unit").agg(F.sum("n").alias("total"))
    # One row per input split, so this is as long as the file listing, not as the data.
    upto = Window.orderBy("unit").rowsBetween(Window.unboundedPreceding, -1)
    bases = written(totals.select("unit", F.coalesce(F.sum("total").over(upto), F.lit(0)).alias("base")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                rows = []
                for doc_id, first, raw in zip(*(c.to_pylist() for c in whole.slice(at, BATCH).columns)):
                    ids = np.frombuffer(raw, "<u2").astype("<u4")
                    start = 0
                    while start < len(ids):
                        offset = (first + start) % window
                        part = ids[start:start + window - offset]
                        rows.append((doc_id, start, len(part), len(ids), (first + start) // window, offset, part.tobytes()))
                        start += len(part)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
                    *[pa.int64()] * 6, pa.binary()))], names=_PIECES)

    rows = tokens.join(bases, "unit").select("doc_id", (F.col("base") + F.col("before")).alias("first"), "ids")
    return rows.mapInArrow(cut, ", ".join(f"`{n}` {'binary' if n == 'ids' else 'long'}" for n in _PIECES))


_PIECES = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]


def packed(docs: DataFrame, tokenizer: str, window: int = WINDOW, added: bool = False) -> DataFrame:
    """Every document's pieces, in the order of the input's files.

    Null and empty texts are the end token alone. Null ids and repeated rows are documents of
    their own. Other columns are not read; an empty table gives an empty result. ``added``: see
    ``tokenized``.
    """
    return pieces(tokenized(docs, tokenizer, added=added), window)


def digests(found: DataFrame) -> DataFrame:
    """The pieces with the CRC-32 of their ids instead of these."""
    return found.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def crc32(ids: bytes) -> int:
    return zlib.crc32(ids)
