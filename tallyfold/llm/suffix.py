"""Exact removal of repeated byte strings by interval expansion on a BWT.

A byte goes if some 200-byte string that covers it starts in two or more places
of the corpus.  The search for such strings is dealt into blocks that each fit
one task:

1. Every 200-byte window is keyed by its minimiser, the 32-byte string in it of
   least hash.  Equal windows have equal keys, and about 85 windows in a row
   share one, so a document is a list of runs: a key and the bytes that its
   windows cover.  Chunks of documents send the keys (13 bytes a run) to shards,
   which answer which keys occur more than once.  All other windows are unique.
2. Runs with a recurring key are sent, once per distinct content and chunk, to
   the block of their key.  A key with very many different contents (a passage
   that very many documents have among words of their own) would fill a block:
   its windows are keyed by a digest of the whole window instead, counted in
   the same way, and only the recurring ones sent.
3. A block concatenates its distinct contents, sorts the suffixes by their
   first 200 bytes (prefix doubling), takes the Burrows-Wheeler transform and
   derives common prefixes by increasing length: starting from the intervals of
   all strings of six symbols, each interval of rows that begin with a string w is extended
   backward by every symbol c that precedes it; the row after the interval of
   cw gets the common prefix |w| if it has none yet, and only then is cw
   extended in turn.  The expansion stops at 200: rows without a value there
   share at least 200 bytes with the row before.  Windows in an interval of
   such rows that stand for two places or more are repeated.
4. Blocks answer the chunks that sent a content which ranges of its windows repeat.

Strings are judged on the input.  Null and empty texts keep nothing; matches
never cross documents; repeated rows are separate documents, so each of them is
a copy.  An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from .common import MESSAGE, documents, messages, mix64, slices, uniq, with_chunks

LENGTH = 200
#: Bytes that a minimiser has.
KMER = 32
CHUNK_BYTES = 8 << 20
#: Bytes that are looked at together; a position in it takes ``POSITION_BITS``.
BUFFER, POSITION_BITS = (1 << 20) - 1024, 20
#: Different contents from which a key's windows are keyed one by one.
HOT_CONTENTS = 4096
#: Bytes of text per block.
BLOCK_BYTES = 1 << 20
SEGMENT = "block int, kind int, key long, content long, n int, chunk int, data binary"
REPLY = "chunk int, kind int, key long, content long, data binary"


def seeds(text: np.ndarray, size: int) -> np.ndarray:
    """Each suffix's first ``size`` symbols as one number (nine bits each; past the end: 0)."""
    padded = np.concatenate((text.astype(np.int64), np.zeros(size, np.int64)))
    out = padded[: len(text)]
    for i in range(1, size):
        out = (out << 9) | padded[i: len(text) + i]
    return out


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffix starts in order of their first ``depth`` symbols at least; symbols are below 512.

    Prefix doubling: suffixes that still tie are sorted by the rank of what follows the part they share.
    """
    n = len(text)
    bits = max(1, int(n + 1).bit_length())
    index = np.arange(n, dtype=np.int64)
    low = (1 << bits) - 1
    have = max(1, min(4, (63 - bits) // 9))
    head = seeds(text, have)
    order = np.sort((head << bits) | index) & low
    head = head[order]
    at, new = index, np.concatenate(([True], head[1:] != head[:-1]))  # rows that tie, and where ties begin
    rank = np.zeros(n + 1, np.int64)  # first row of a suffix's tie, from 1; 0 past the end
    while True:
        begin = np.flatnonzero(new)
        size = np.diff(np.concatenate((begin, [len(at)])))
        rank[order[at]] = np.repeat(at[begin], size) + 1
        at = at[np.repeat(size > 1, size)]
        if have >= depth or not len(at):
            return order
        tied = order[at]
        mine, next_ = rank[tied], rank[np.minimum(tied + have, n)]
        if 3 * bits <= 63:
            key = np.sort((((mine << bits) | next_) << bits) | tied)
            order[at] = key & low
            key >>= bits
            new = np.concatenate(([True], key[1:] != key[:-1]))
        else:
            by = np.lexsort((next_, mine))
            order[at] = tied[by]
            mine, next_ = mine[by], next_[by]
            new = np.concatenate(([True], (mine[1:] != mine[:-1]) | (next_[1:] != next_[:-1])))
        have *= 2


def expand(text: np.ndarray, order: np.ndarray, depth: int, seed: int = 6) -> np.ndarray:
    """For each row of ``order``: whether it shares fewer than ``depth`` symbols
    with the row before (symbol 0 separates contents and is not extended by).

    The expansion starts from the intervals of all strings of ``seed`` symbols.
    """
    n = len(text)
    before = text[order - 1]  # the transform: the symbol before each suffix
    by_symbol = np.argsort(before, kind="stable")
    row_of = np.empty(n, np.int64)  # of the suffix one symbol longer
    row_of[by_symbol] = np.arange(n)
    first, head = text[order], seeds(text, min(seed, depth))[order]
    known = np.zeros(n + 1, bool)
    known[n] = True
    low = np.concatenate(([0], np.flatnonzero(head[1:] != head[:-1]) + 1))
    high = np.concatenate((low[1:], [n]))
    known[low] = True
    for _ in range(seed, depth):  # common prefixes of seed, seed + 1, .. depth - 1 symbols
        if not len(low):
            break
        size = high - low
        of = np.repeat(np.arange(len(low), dtype=np.int64), size)
        rows = np.arange(len(of)) + np.repeat(low - (np.cumsum(size) - size), size)
        can = before[rows] > 0
        to = np.sort((of[can] << 32) | row_of[rows[can]])
        if not len(to):
            break
        row = to & 0xFFFFFFFF
        cut = np.flatnonzero((to[1:] != to[:-1] + 1) | (first[row[1:]] != first[row[:-1]])) + 1
        low = row[np.concatenate(([0], cut))]
        high = row[np.concatenate((cut - 1, [len(row) - 1]))] + 1
        new = ~known[high]
        low, high = low[new], high[new]
        known[high] = True
    return known[:n]


def repeated_windows(contents: list[bytes], counts: list[int], length: int = LENGTH) -> list[np.ndarray]:
    """For each content: which of its windows stand for two places or more,
    where content ``i`` stands for ``counts[i]`` places."""
    sizes = np.array([len(c) for c in contents])
    text = np.frombuffer(b"\0".join(contents) + b"\0", np.uint8).astype(np.int16) + 1
    end = np.cumsum(sizes + 1) - 1
    text[end] = 0
    order = suffix_order(text, length)
    group = np.cumsum(expand(text, order, length)) - 1
    weight = np.zeros(len(text), np.int64)
    for e, size, n in zip(end.tolist(), sizes.tolist(), counts, strict=True):
        weight[e - size: e - length + 1] = n
    places = np.bincount(group, weights=weight[order])
    twice = np.zeros(len(text), bool)
    twice[order] = places[group] >= 2
    return [twice[e - size: e - length + 1] for e, size in zip(end.tolist(), sizes.tolist(), strict=True)]


class Buffer:
    """Bytes of several documents (or a part of one) and the runs of their windows."""

    def __init__(self, parts: list[tuple[int, int, bytes]], length: int):
        self.parts = parts  # (document, offset in it, bytes)
        self.data = b"".join(p[2] for p in parts)
        self.length = length
        n, windows = len(self.data), len(self.data) - length + 1
        ends = np.cumsum([len(p[2]) for p in parts])
        valid = np.zeros(windows, bool)
        for e, p in zip(ends.tolist(), parts, strict=True):
            valid[e - len(p[2]): e - length + 1] = True
        self.part_start = ends - [len(p[2]) for p in parts]
        octets = np.ndarray((n - 7,), "<u8", buffer=self.data, strides=(1,))
        h = octets * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        for step, m in ((8, 0xBF58476D1CE4E5B9), (16, 0x94D049BB133111EB)):
            h = h[:-step] * np.uint64(m) + h[step:]
            h ^= h >> np.uint64(31)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        self.kmer = h
        low = np.uint64((1 << POSITION_BITS) - 1)
        least = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        width, want = 1, length - KMER + 1
        while width * 2 <= want:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < want:
            least = np.minimum(least[: windows], least[want - width: want - width + windows])
        new = np.concatenate(([True], least[1:] != least[:-1]))
        new[1:] |= valid[1:] != valid[:-1]
        at = np.flatnonzero(new)
        stop = np.concatenate((at[1:], [windows]))
        use = valid[at]
        self.start, self.stop = at[use], stop[use]  # windows of each run
        self.key = h[(least[self.start] & low).astype(np.int64)]

    def content(self, run: int) -> bytes:
        return self.data[self.start[run]: self.stop[run] + self.length - 1]

    def digests(self, runs) -> np.ndarray:
        """64-bit digests of the runs' contents."""
        view, more, h = memoryview(self.data), self.length - 1, xxhash.xxh3_64_intdigest
        return np.array([h(view[a: b + more]) for a, b in zip(self.start[runs].tolist(), self.stop[runs].tolist(), strict=True)],
                        np.uint64)

    def windows(self, runs) -> tuple[np.ndarray, np.ndarray]:
        """All windows of the runs: their starts and a digest of each."""
        size = self.stop[runs] - self.start[runs]
        at = np.arange(int(size.sum())) + np.repeat(self.start[runs] - (np.cumsum(size) - size), size)
        out = self.kmer[at + self.length - KMER]
        for step in range(0, self.length - KMER, KMER):
            out = out * np.uint64(0x9E3779B97F4A7C15) + self.kmer[at + step]
        return at, mix64(out)


def buffers(texts: list[bytes], length: int):
    """Documents of at least ``length`` bytes in buffers; long ones in overlapping parts."""
    parts, size = [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), BUFFER):
            piece = text[at: at + BUFFER + length - 1]
            if len(piece) < length:
                continue
            if size + len(piece) > BUFFER + length - 1 and parts:
                yield Buffer(parts, length)
                parts, size = [], 0
            parts.append((i, at, piece))
            size += len(piece)
    if parts:
        yield Buffer(parts, length)


def encoded(table: pa.Table) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in table.column("text").to_pylist()]


def find(values: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each value among sorted distinct ones, and whether it is there."""
    if not len(among):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return at, among[at] == values


def dedup(docs: DataFrame, length: int = LENGTH, chunk_bytes: int = CHUNK_BYTES, hot: int = HOT_CONTENTS) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (the bytes that stay)."""
    chunked, n_chunks, total = with_chunks(documents(docs), chunk_bytes, ordered=False)
    shift = 64 - max(5, n_chunks.bit_length())
    blocks = max(16, -(-total // BLOCK_BYTES))

    def keys(t: pa.Table) -> pa.Table:
        """A chunk's distinct (key, content) pairs with their counts, by shard."""
        chunk, found = t.column("chunk")[0].as_py(), []
        for b in buffers(encoded(t), length):
            found.append((b.key, (b.digests(slice(None)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)))
        if not found:
            return messages([])
        key, content = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((content, key))
        key, content = key[order], content[order]
        new = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (content[1:] != content[:-1]))))
        n = np.minimum(np.diff(np.concatenate((new, [len(key)]))), 255).astype(np.uint8)
        key, content = key[new], content[new]
        return messages([(shard, chunk, 0, key[at].tobytes() + content[at].tobytes() + n[at].tobytes())
                         for shard, at in slices(key, shift)])

    def classes(t: pa.Table) -> pa.Table:
        """For each key of each chunk: 0 it occurs once, 1 more often, 2 with very many contents."""
        parts = []
        for blob in t.column("blob").to_pylist():
            n = len(blob) // 13
            parts.append((np.frombuffer(blob, np.uint64, n), np.frombuffer(blob, np.uint32, n, 8 * n),
                          np.frombuffer(blob, np.uint8, n, 12 * n)))
        key, content, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((content, key))
        key, content, n = key[order], content[order], n[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        other = np.concatenate(([True], (key[1:] != key[:-1]) | (content[1:] != content[:-1])))
        places = np.add.reduceat(n.astype(np.int64), first)
        contents = np.add.reduceat(other.astype(np.int64), first)
        kind = np.where(places < 2, 0, np.where(contents <= hot, 1, 2)).astype(np.uint8)
        known = key[first]
        out = [kind[np.searchsorted(known, k[np.concatenate(([True], k[1:] != k[:-1]))])].tobytes() for k, _, _ in parts]
        return t.set_column(t.column_names.index("blob"), "blob", pa.array(out, pa.binary()))

    def answer(t: pa.Table, kind: int) -> np.ndarray:
        said = sorted((s, b) for s, k, b in zip(t.column("shard").to_pylist(), t.column("kind").to_pylist(),
                                                t.column("blob").to_pylist(), strict=True) if k == kind)
        return np.frombuffer(b"".join(b for _, b in said), np.uint8)

    def kinds_of_runs(made: list[Buffer], kind: np.ndarray) -> list[np.ndarray]:
        known = uniq(np.concatenate([b.key for b in made])) if made else np.zeros(0, np.uint64)
        return [kind[np.searchsorted(known, b.key)] for b in made]

    def hot_windows(t: pa.Table, said: pa.Table) -> pa.Table:
        """Digests of the windows of hot keys, by shard; the classes are passed on."""
        chunk, kind = t.column("chunk")[0].as_py(), answer(said, 0)
        out = [(chunk, chunk, 1, kind.tobytes())]
        if (kind == 2).any():
            made = list(buffers(encoded(t), length))
            digest = np.sort(np.concatenate([b.windows(np.flatnonzero(k == 2))[1] for b, k in
                                             zip(made, kinds_of_runs(made, kind), strict=True)]))
            new = np.flatnonzero(np.concatenate(([True], digest[1:] != digest[:-1])))
            n = np.minimum(np.diff(np.concatenate((new, [len(digest)]))), 255).astype(np.uint8)
            out += [(shard, chunk, 0, digest[new][at].tobytes() + n[at].tobytes()) for shard, at in slices(digest[new], shift)]
        return messages(out)

    def count_windows(t: pa.Table) -> pa.Table:
        """For each digest of each chunk: whether it occurs more than once."""
        kinds, blobs = t.column("kind").to_pylist(), t.column("blob").to_pylist()
        sent = {i: (np.frombuffer(b, np.uint64, len(b) // 9), np.frombuffer(b, np.uint8, offset=len(b) // 9 * 8))
                for i, (k, b) in enumerate(zip(kinds, blobs, strict=True)) if k == 0}
        if sent:
            key, n = (np.concatenate(x) for x in zip(*sent.values(), strict=True))
            order = np.argsort(key)
            key, n = key[order], n[order].astype(np.int64)
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            often, known = np.add.reduceat(n, first) > 1, key[first]
            for i, (k, _) in sent.items():
                blobs[i] = often[np.searchsorted(known, k)].astype(np.uint8).tobytes()
        return t.set_column(t.column_names.index("blob"), "blob", pa.array(blobs, pa.binary()))

    def segments(t: pa.Table, said: pa.Table) -> pa.Table:
        """What a chunk has under recurring keys, once per distinct content."""
        chunk, kind = t.column("chunk")[0].as_py(), answer(said, 1)
        out: dict[tuple[int, int, int], list] = {}
        if not kind.any():
            return segment_table([], chunk)
        made = list(buffers(encoded(t), length))
        of_runs = kinds_of_runs(made, kind)
        for b, k in zip(made, of_runs, strict=True):
            runs = np.flatnonzero(k == 1)
            for run, key, content in zip(runs.tolist(), b.key[runs].tolist(), b.digests(runs).tolist(), strict=True):
                have = out.get((0, key, content))
                if have:
                    have[0] += 1
                else:
                    out[0, key, content] = [1, b.content(run)]
            for key in set(b.key[k == 2].tolist()):
                out[2, key, 0] = [1, b""]
        if (kind == 2).any():
            pairs = [b.windows(np.flatnonzero(k == 2)) for b, k in zip(made, of_runs, strict=True)]
            digest, often = uniq(np.concatenate([p[1] for p in pairs])), answer(said, 0).astype(bool)
            for b, (at, d) in zip(made, pairs, strict=True):
                where, _ = find(d, digest)
                for start, key in zip(at[often[where]].tolist(), d[often[where]].tolist(), strict=True):
                    have = out.get((1, key, 0))
                    if have:
                        have[0] += 1
                    else:
                        out[1, key, 0] = [1, b.data[start: start + length]]
        return segment_table(list(out.items()), chunk)

    def segment_table(items: list, chunk: int) -> pa.Table:
        key = np.array([k[1] for k, _ in items], np.uint64)
        return pa.table([
            pa.array((mix64(key) % np.uint64(blocks)).astype(np.int32)), pa.array([k[0] for k, _ in items], pa.int32()),
            pa.array(key.view(np.int64)), pa.array(np.array([k[2] for k, _ in items], np.uint64).view(np.int64)),
            pa.array([min(v[0], 2) for _, v in items], pa.int32()), pa.array([chunk] * len(items), pa.int32()),
            pa.array([v[1] for _, v in items], pa.binary())],
            ["block", "kind", "key", "content", "n", "chunk", "data"])

    def block(t: pa.Table) -> pa.Table:
        """Interval expansion over the block's distinct contents."""
        number: dict[tuple, int] = {}
        contents, counts, senders, out = [], [], [], []
        for kind, key, content, n, chunk, data in zip(*(t.column(c).to_pylist() for c in (
                "kind", "key", "content", "n", "chunk", "data")), strict=True):
            if kind == 2:  # a hot key: its sender is reminded of it
                out.append((chunk, kind, key, content, b""))
                continue
            i = number.setdefault((kind, key, content), len(number))
            if i == len(contents):
                contents.append(data)
                counts.append(0)
                senders.append([])
            counts[i] += n
            senders[i].append(chunk)
        if contents:
            for (kind, key, content), to, twice in zip(number, senders, repeated_windows(contents, counts, length), strict=True):
                if twice.any():
                    ranges = np.flatnonzero(np.diff(twice, prepend=False, append=False)).astype(np.int32).tobytes()
                    out += [(chunk, kind, key, content, ranges) for chunk in to]
        cols = list(zip(*out, strict=True)) if out else [[]] * 5
        return pa.table([pa.array(c, k) for c, k in zip(cols, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()),
                                                        strict=True)], ["chunk", "kind", "key", "content", "data"])

    def remove(t: pa.Table, said: pa.Table) -> pa.Table:
        texts = encoded(t)
        found = [{}, {}, {}]
        for kind, key, content, data in zip(*(said.column(c).to_pylist() for c in ("kind", "key", "content", "data")), strict=True):
            found[kind][key & (2**64 - 1), content & (2**64 - 1)] = data
        normal = uniq(np.array([k for k, _ in found[0]], np.uint64))
        single = uniq(np.array([k for k, _ in found[1]], np.uint64))
        hot_keys = uniq(np.array([k for k, _ in found[2]], np.uint64))
        ranges: dict[int, list[np.ndarray]] = {}  # of repeated windows, by document
        for b in buffers(texts, length) if len(normal) or len(single) else ():
            begin, stop = [], []
            runs = np.flatnonzero(find(b.key, normal)[1])
            for start, key, content in zip(b.start[runs].tolist(), b.key[runs].tolist(), b.digests(runs).tolist(), strict=True):
                edges = found[0].get((key, content))
                if edges is not None:
                    for i in range(0, len(edges), 8):
                        begin.append(start + int.from_bytes(edges[i: i + 4], "little"))
                        stop.append(start + int.from_bytes(edges[i + 4: i + 8], "little"))
            begin, stop = np.array(begin, np.int64), np.array(stop, np.int64)
            if len(single):
                at, digest = b.windows(np.flatnonzero(find(b.key, hot_keys)[1]))
                at = at[find(digest, single)[1]]
                begin, stop = np.concatenate((begin, at)), np.concatenate((stop, at + 1))
            if len(begin):
                part = np.searchsorted(b.part_start, begin, "right") - 1
                order = np.argsort(part, kind="stable")
                part, begin, stop = part[order], begin[order], stop[order]
                cut = np.concatenate(([0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)])).tolist()
                for lo, hi in zip(cut[:-1], cut[1:], strict=True):
                    doc, offset, _ = b.parts[part[lo]]
                    move = offset - b.part_start[part[lo]]
                    ranges.setdefault(doc, []).append(np.stack((begin[lo:hi], stop[lo:hi] + length - 1)) + move)
        removed, spans, kept = [], [], []
        for i, text in enumerate(texts):
            if i not in ranges:
                removed.append(0)
                spans.append(0)
                kept.append(text)
                continue
            begin, stop = np.concatenate(ranges[i], axis=1)  # of the bytes that they cover
            edge = np.bincount(begin, minlength=len(text) + 1) - np.bincount(stop, minlength=len(text) + 1)
            gone = np.cumsum(edge[:-1]) > 0
            removed.append(int(gone.sum()))
            spans.append(int((gone[1:] & ~gone[:-1]).sum() + gone[0]))
            kept.append(np.frombuffer(text, np.uint8)[~gone].tobytes())
        return pa.table([t.column("doc_id"), pa.array([len(x) for x in texts], pa.int64()), pa.array(removed, pa.int64()),
                         pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
                        ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    by_chunk = chunked.groupBy("chunk")
    classed = by_chunk.applyInArrow(keys, MESSAGE).groupBy("shard").applyInArrow(classes, MESSAGE)
    asked = by_chunk.cogroup(classed.groupBy("chunk")).applyInArrow(hot_windows, MESSAGE)
    counted = asked.groupBy("shard").applyInArrow(count_windows, MESSAGE)
    sent = by_chunk.cogroup(counted.groupBy("chunk")).applyInArrow(segments, SEGMENT)
    found = sent.groupBy("block").applyInArrow(block, REPLY)
    return by_chunk.cogroup(found.groupBy("chunk")).applyInArrow(
        remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
