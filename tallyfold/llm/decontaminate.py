"""Benchmark decontamination by pigeonhole edit matching.

A test item leaks into a document if some part of the document is within the
item's error budget, ``len * ERRORS_PER_100 // 100`` edits (insert, delete,
replace a character), both lower-cased and with white space collapsed.  An item
with budget ``k`` is split into ``k + 1`` pieces; ``k`` edits cannot touch all
of them, so one piece occurs unchanged.  Exact piece hits come from one
Aho-Corasick automaton per block of items; hits of an item on about the same
diagonal share a window, and Myers' bit-parallel algorithm gives the least edit
distance of the whole item in it.

Items are a query set: they meet all documents block by block
(``BLOCK_CHARS``), so what travels to the tasks is bounded whatever the size of
the benchmark.  Documents are mapped, not shuffled.

Null and empty items and those shorter than ``MIN_CHARS`` are not searched for;
null and empty texts have no leaks; repeated items count once; an item without
an id is reported as -1; empty tables give no leaks.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERRORS_PER_100 = 8
MIN_CHARS = 20
#: Characters of items that one pass over the documents looks for.
BLOCK_CHARS = 1 << 20


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def budget(length: int) -> int:
    return length * ERRORS_PER_100 // 100


def pieces(item: str) -> list[tuple[int, str]]:
    """(offset, piece) of ``budget + 1`` pieces of about equal length."""
    n = budget(len(item)) + 1
    cut = [len(item) * i // n for i in range(n + 1)]
    return [(lo, item[lo:hi]) for lo, hi in zip(cut[:-1], cut[1:], strict=True)]


def myers(item: str, text: str) -> tuple[int, int]:
    """Least edit distance of ``item`` to a part of ``text`` and where the first such part ends."""
    m = len(item)
    equal: dict[str, int] = {}
    for i, c in enumerate(item):
        equal[c] = equal.get(c, 0) | 1 << i
    mask, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = mask, 0, m
    best, end = m, 0
    for j, c in enumerate(text, 1):
        eq = equal.get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph = minus | (~(xh | plus) & mask)
        mh = plus & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph = (ph << 1) & mask
        mh = (mh << 1) & mask
        plus = mh | (~(xv | ph) & mask)
        minus = ph & xv
        if score < best:
            best, end = score, j
    return best, end


class Matcher:
    """The items of one block; the automaton is built where it is first used."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items, self.automaton = items, None

    def __getstate__(self):
        return {"items": self.items, "automaton": None}

    def build(self) -> None:
        where: dict[str, list[tuple[int, int]]] = {}
        for i, (_, item) in enumerate(self.items):
            for offset, piece in pieces(item):
                where.setdefault(piece, []).append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()

    def leaks(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """Each leaking item's id, its best match's distance, start and end in the normalised text."""
        if not self.items:
            return []
        if self.automaton is None:
            self.build()
        clean = normal(text)
        begins: dict[int, set[int]] = {}  # where an item would begin, by item
        for last, (size, places) in self.automaton.iter(clean):
            for i, offset in places:
                begins.setdefault(i, set()).add(last + 1 - size - offset)
        found = []
        for i, at in begins.items():
            item_id, item = self.items[i]
            k, best = budget(len(item)), None
            for lo, hi in self.windows(sorted(at), len(item), k):
                lo = max(lo, 0)
                distance, end = myers(item, clean[lo:hi])
                if distance <= k and (best is None or distance < best[0]):
                    _, back = myers(item[::-1], clean[lo: lo + end][::-1])
                    best = (distance, lo + end - back, lo + end)
            if best:
                found.append((-1 if item_id is None else item_id, *best))
        return sorted(found)

    @staticmethod
    def windows(begins: list[int], length: int, k: int) -> Iterator[tuple[int, int]]:
        """Parts of the text that hold every match with a piece on these diagonals."""
        lo = hi = None
        for b in begins:
            if lo is None:
                lo, hi = b - k, b + length + k
            elif b - k <= lo + length:  # still about the same place
                hi = max(hi, b + length + k)
            else:
                yield lo, hi
                lo, hi = b - k, b + length + k
        if lo is not None:
            yield lo, hi


def blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[Matcher]:
    """Matchers over all items, a block at a time."""
    rows = (benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
            .where("text is not null").distinct().orderBy("item_id", "text"))
    held, size = [], 0
    for row in rows.toLocalIterator():
        item = normal(row["text"])
        if len(item) < MIN_CHARS:
            continue
        if held and size + len(item) > block_chars:
            yield Matcher(held)
            held, size = [], 0
        held.append((row["item_id"], item))
        size += len(item)
    if held:
        yield Matcher(held)


def mark(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS, column: str = "leaks") -> DataFrame:
    """``docs`` with ``column``: an array of (item_id, distance, start, end)."""
    out = docs.withColumn(column, F.array().cast("array<long>"))  # four numbers for each leak until the end

    def marker(matcher: Matcher):
        def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                at, had = b.schema.get_field_index(column), b.column(column).to_pylist()
                new = [old + [x for leak in matcher.leaks(t) for x in leak]
                       for old, t in zip(had, b.column("text").to_pylist(), strict=True)]
                yield b.set_column(at, column, pa.array(new, pa.list_(pa.int64())))

        return marked

    for matcher in blocks(benchmark, block_chars):
        out = out.mapInArrow(marker(matcher), out.schema)
    flat = F.col(column)

    def leak(i: Column) -> Column:
        return F.struct(F.get(flat, i).alias("item_id"), F.get(flat, i + 1).cast("int").alias("distance"),
                        F.get(flat, i + 2).cast("int").alias("start"), F.get(flat, i + 3).cast("int").alias("end"))

    begins = F.filter(F.transform(flat, lambda _, i: i), lambda i: i % 4 == 0)
    return out.withColumn(column, F.transform(begins, leak))
