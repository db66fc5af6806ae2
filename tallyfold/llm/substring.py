"""Substring dedup of word windows with a count-min prefilter.

A window is ``window`` consecutive words of one document.  Pass 1: each chunk
of documents sketches its windows, that is, it lists the cells they hit in each
of two count-min rows; shards of the rows merge these partial sketches and tell
each chunk, one bit per cell, which of its cells were hit twice or more.  A
count-min estimate is never too low, so every repeated window is estimated
repeated.  Pass 2: only windows whose both cells were hit twice are grouped
exactly, by a 128-bit digest of their words: chunks send their distinct
digests, shards say which chunk has each first.  Chunks are ranges of
``doc_id``, so a window that is not the first of its digest in its chunk, or
whose digest an earlier chunk has, starts earlier elsewhere: its words go.

What travels is a byte or two per window for the sketch, 16 bytes per distinct
suspicious window of a chunk, and one bit per entry back; texts are shuffled
once, and no task gets more than a chunk, or a shard's share of the entries,
however often a passage repeats.

Null and empty texts have no words.  Repeated rows (same id) are taken in the
order of their texts, as separate documents of which the earlier counts as
earlier.  Null ids come first.  An empty table gives no rows.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import MESSAGE, counted, documents, messages, mix64, pack, slices, unpack, with_chunks, word_digests

WINDOW = 20
#: Bytes of text in a chunk.
CHUNK_BYTES = 8 << 20
#: Cells of each count-min row per byte of text (a word takes several bytes).
CELLS_PER_BYTE = 0.5
MULTIPLIERS = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)


def rolling(h: np.ndarray, window: int, multiplier: int) -> np.ndarray:
    """A digest of each ``window`` consecutive values, by doubling."""
    m = 1 << 64
    out, have, power = None, 0, 1
    part, size, part_power = h, 1, multiplier
    rest = window
    while rest:
        if rest & 1:
            if out is None:
                out, have, power = part, size, part_power
            else:
                n = len(h) - have - size + 1
                out = out[:n] * np.uint64(part_power) + part[have: have + n]
                have, power = have + size, power * part_power % m
        rest >>= 1
        if rest:
            part = part[: len(part) - size] * np.uint64(part_power) + part[size:]
            size, part_power = size * 2, part_power * part_power % m
    return mix64(out)


class Chunk:
    """The windows of a chunk's documents, in order of id and start."""

    def __init__(self, table: pa.Table, window: int):
        ids, texts = table.column("doc_id").to_pylist(), table.column("text").to_pylist()
        rows = sorted(zip(ids, texts, strict=True), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        self.ids = [r[0] for r in rows]
        self.texts = [r[1] for r in rows]
        self.n_words, *halves = word_digests([t.encode("utf-8", "surrogatepass") for t in self.texts])
        self.first = np.concatenate(([0], np.cumsum(self.n_words)))
        room = np.repeat(self.first[1:], self.n_words) - np.arange(self.first[-1]) >= window
        self.start = np.flatnonzero(room)
        self.a = self.b = np.zeros(0, np.uint64)
        if len(self.start):
            self.a, self.b = (rolling(h, window, m)[self.start] for h, m in zip(halves, MULTIPLIERS, strict=True))


def replies(table: pa.Table, kind: int) -> bytes:
    """The blobs of one kind, joined in order of shard."""
    t = sorted((s, b) for s, k, b in zip(table.column("shard").to_pylist(), table.column("kind").to_pylist(),
                                         table.column("blob").to_pylist(), strict=True) if k == kind)
    return b"".join(b for _, b in t)


class Groups:
    """Distinct values of an array: ``values`` sorted, ``of`` the group of each element."""

    def __init__(self, values: np.ndarray, second: np.ndarray | None = None):
        order = np.argsort(values)
        sorted_ = values[order]
        new = np.concatenate(([True], sorted_[1:] != sorted_[:-1])) if len(values) else np.zeros(0, bool)
        self.second = None
        if second is not None:
            other = second[order]
            if len(values) and (~new[1:] & (other[1:] != other[:-1])).any():  # equal first halves only
                order = np.lexsort((second, values))
                sorted_, other = values[order], second[order]
                new = np.concatenate(([True], (sorted_[1:] != sorted_[:-1]) | (other[1:] != other[:-1])))
            self.second = other[new]
        self.values = sorted_[new]
        self.of = np.empty(len(values), np.int64)
        self.of[order] = np.cumsum(new) - 1


def dedup(docs: DataFrame, window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept`` (words that stay, joined by one space)."""
    chunked, n_chunks, total = with_chunks(documents(docs), chunk_bytes, ordered=True)
    cell_bits = max(16, int(total * CELLS_PER_BYTE).bit_length())
    shard_bits = max(12, min(24, cell_bits - 6))
    exact_shift = 64 - max(4, n_chunks.bit_length())

    def cells(c: Chunk) -> list[np.ndarray]:
        return [h >> np.uint64(64 - cell_bits) for h in (c.a, c.b)]

    def sketch(t: pa.Table) -> pa.Table:
        """The cells a chunk hits, per row and shard: gap from the one before, and whether hit twice here."""
        chunk, out = t.column("chunk")[0].as_py(), []
        for row, hit in enumerate(cells(Chunk(t, window))):
            own, n = counted(hit)
            for shard, at in slices(own, shard_bits):
                gap = np.diff(own[at], prepend=np.uint64(shard << shard_bits))
                out.append((shard * 2 + row, chunk, row, pack(gap * np.uint64(2) + (n[at] > 1).astype(np.uint64))))
        return messages(out)

    def merge(t: pa.Table) -> pa.Table:
        """Adds a shard's partial sketches; a bit per cell listed: hit twice or more by all chunks."""
        counts = np.zeros(1 << shard_bits, np.uint8)
        lists = []
        for blob in t.column("blob"):
            v = unpack(blob.as_py())
            cell = np.cumsum(v >> np.uint64(1)).astype(np.int64)
            counts[cell] = np.minimum(counts[cell] + 1 + (v & np.uint64(1)).astype(np.uint8), 2)
            lists.append(cell)
        bits = [np.packbits(counts[cell] > 1).tobytes() for cell in lists]
        return t.set_column(t.column_names.index("blob"), "blob", pa.array(bits, pa.binary()))

    def suspects(t: pa.Table, answers: pa.Table) -> pa.Table:
        """Digests of windows estimated repeated, and which windows those are."""
        c = Chunk(t, window)
        chunk, suspect = t.column("chunk")[0].as_py(), np.ones(len(c.start), bool)
        for row, hit in enumerate(cells(c)):
            g = Groups(hit)
            said = dict(zip(answers.column("shard").to_pylist(), answers.column("blob").to_pylist(), strict=True))
            flags = [np.unpackbits(np.frombuffer(said[shard * 2 + row], np.uint8), count=at.stop - at.start)
                     for shard, at in slices(g.values, shard_bits)]
            if flags:
                suspect &= np.concatenate(flags).astype(bool)[g.of]
        g = Groups(c.a[suspect], c.b[suspect])
        out = [(shard, chunk, 0, g.values[at].tobytes() + g.second[at].tobytes())
               for shard, at in slices(g.values, exact_shift)]
        return messages([*out, (chunk, chunk, 1, np.packbits(suspect).tobytes())])

    def firsts(t: pa.Table) -> pa.Table:
        """For each digest a chunk sent: a bit, set if no earlier chunk has it."""
        kinds, chunks = t.column("kind").to_pylist(), t.column("chunk").to_pylist()
        blobs = t.column("blob").to_pylist()
        sent = [i for i, k in enumerate(kinds) if k == 0]
        pairs = [np.frombuffer(blobs[i], np.uint64).reshape(2, -1) for i in sent]
        out = list(blobs)
        if sent:
            a, b = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
            of = np.repeat([chunks[i] for i in sent], [p.shape[1] for p in pairs])
            order = np.lexsort((of, b, a))
            a, b = a[order], b[order]
            first = np.empty(len(order), bool)
            first[order] = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
            at = 0
            for i, p in zip(sent, pairs, strict=True):
                out[i] = first[at: at + p.shape[1]].astype(np.uint8).tobytes()
                at += p.shape[1]
        return t.set_column(t.column_names.index("blob"), "blob", pa.array(out, pa.binary()))

    def remove(t: pa.Table, answers: pa.Table) -> pa.Table:
        c = Chunk(t, window)
        suspect = np.unpackbits(np.frombuffer(replies(answers, 1), np.uint8), count=len(c.start)).astype(bool)
        at = np.flatnonzero(suspect)
        g = Groups(c.a[at], c.b[at])
        gone = np.ones(len(at), bool)
        if len(at):
            earliest = np.full(len(g.values), len(at), np.int64)
            np.minimum.at(earliest, g.of, np.arange(len(at)))
            gone[earliest[np.frombuffer(replies(answers, 0), np.uint8).astype(bool)]] = False
        edge = np.zeros(int(c.first[-1]) + window + 1, np.int32)
        np.add.at(edge, c.start[at[gone]], 1)
        np.add.at(edge, c.start[at[gone]] + window, -1)
        covered = np.cumsum(edge)[: int(c.first[-1])] > 0
        removed, kept = [], []
        for i, text in enumerate(c.texts):
            out = covered[c.first[i]: c.first[i + 1]]
            words = text.encode("utf-8", "surrogatepass").split()
            removed.append(int(out.sum()))
            kept.append(b" ".join(compress(words, (~out).tolist()) if removed[-1] else words))
        return pa.table([pa.array(c.ids, pa.int64()), pa.array(c.n_words, pa.int64()), pa.array(removed, pa.int64()),
                         pa.array(kept, pa.binary())], ["doc_id", "n_words", "n_removed", "kept"])

    by_chunk = chunked.groupBy("chunk")
    merged = by_chunk.applyInArrow(sketch, MESSAGE).groupBy("shard").applyInArrow(merge, MESSAGE)
    suspicious = by_chunk.cogroup(merged.groupBy("chunk")).applyInArrow(suspects, MESSAGE)
    first = suspicious.groupBy("shard").applyInArrow(firsts, MESSAGE)
    return by_chunk.cogroup(first.groupBy("chunk")).applyInArrow(
        remove, "doc_id long, n_words long, n_removed long, kept binary")

