"""Arrays of structs as the lines of a document: staged fields and running state, inside the row."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK = 256


class Lines:
    """An array of structs. Each step is one pass over the array; a field that a later step uses
    is computed once. NULL arrays stay NULL."""

    def __init__(self, array: Column | str, names: Sequence[str]):
        self.array = F.col(array) if isinstance(array, str) else array
        self.names = list(names)

    def add(self, fields: Callable[[Column], dict[str, Column]], drop: Sequence[str] = ()) -> Lines:
        """With more (or other) fields, from the fields so far; those in ``drop`` are left behind,
        since each pass copies what it carries."""
        added: list[str] = []

        def step(r: Column) -> Column:
            new = fields(r)
            added[:] = new
            return F.struct(*[r[n].alias(n) for n in self.names if n not in new and n not in drop], *[c.alias(n) for n, c in new.items()])

        array = F.transform(self.array, step)
        return Lines(array, [n for n in self.names if n not in added and n not in drop] + added)

    def keep(self, test: Callable[[Column], Column]) -> Lines:
        return Lines(F.filter(self.array, test), self.names)

    def only(self, names: Sequence[str]) -> Lines:
        return Lines(F.transform(self.array, lambda r: F.struct(*[r[n].alias(n) for n in names])), names)


def running(items: Column, zero: dict[str, Column], step: Callable, chunk: int = CHUNK) -> Column:
    """The items, one after the other, under a state that each may change.

    ``step(state, item)`` returns the next state by name, the item in its new form (of the same
    type), and whether it stays (None: always). Results are gathered by chunks, since appending to one
    array copies it: time grows with the items, not with their square.
    """
    names = list(zero)

    def merge(s: Column, x: Column) -> Column:
        after, item, stays = step(s, x)
        more = F.array_append(s["out"], item)
        out = more if stays is None else F.when(stays, more).otherwise(s["out"])
        return F.struct(out.alias("out"), *[after[n].alias(n) for n in names])

    def chunk_of(done: Column, part: Column) -> Column:
        start = F.struct(F.slice(part, 1, 0).alias("out"), *[done[n].alias(n) for n in names])
        return F.aggregate(part, start, merge, lambda s: F.struct(
            F.concat(done["parts"], F.array(s["out"])).alias("parts"), *[s[n].alias(n) for n in names]))

    parts = F.transform(F.sequence(F.lit(0), F.call_function("div", F.size(items) - 1, F.lit(chunk)).cast("int")),
                        lambda k: F.slice(items, k * chunk + 1, chunk))
    none = F.slice(F.array(F.slice(items, 1, 0)), 1, 0)
    whole = F.aggregate(parts, F.struct(none.alias("parts"), *[c.alias(n) for n, c in zero.items()]), chunk_of,
                        lambda s: F.flatten(s["parts"]))
    return F.when(items.isNotNull(), whole)
