"""Language-model scoring by context-tree weighting over byte contexts.

A text is coded byte by byte, each byte as eight binary decisions, each in a
context tree over the ``depth`` bytes before it.  Every node keeps how often
its decision went either way in the training texts; the Krichevsky-Trofimov
estimates of the nodes from depth 0 to ``depth`` on the path of a context are
mixed with the weights of context-tree weighting,

    Pw(node) = 1/2 Pe(node) + 1/2 product of Pw(children),

which makes a node's share in a prediction ``1/2 Pe(node) / Pw(node)`` and
leaves the rest to its child.  The text is lower-cased (A-Z), preceded by a
start mark and closed by an end mark, both the byte 255, which UTF-8 never
uses; so the scores are probabilities over all texts.

Counting: tasks count the distinct (context, byte) pairs of their texts, shards
add them up.  Subtrees below the last two bytes are weighted each in one task;
what is above them (256 x 255 nodes at most) goes through the driver.  Scoring:
chunks of documents ask shards for the distinct pairs they hold, seen in
training or not, subtrees work out each asked probability once, and chunks
add up the answers over their texts.  No table that grows with the corpus is
broadcast.

The base score is an add-one unigram model over words and an end token; its
counts travel the same way, keyed by 64-bit digests of the words.

Null and empty texts consist of the end alone.  Null ids count as the empty
text in the split.  Repeated rows are separate documents.  Without training
texts every decision is even.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import MESSAGE, counted, documents, messages, pack, slices, text_stats, uniq, unpack, with_chunks, word_digests

DEPTH = 5
#: Bytes of a chunk, and of the texts that a task counts before it sends on.
CHUNK_BYTES = 16 << 20
#: Bytes looked at together (a position takes ``POSITION_BITS``), and context kept before a part.
BUFFER, POSITION_BITS, BEFORE = (1 << 20) - 4096, 20, 7
#: Groups of subtrees.
GROUPS = 512
MARK = b"\xff"
#: Stands for the end among the digests of words.
END_TOKEN = 0x656E64206F662074
#: Odd, so multiplying by it permutes the pairs.
SPREAD, UNSPREAD = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)


def lowered(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").lower()


def parts(texts: list[bytes]) -> Iterator[tuple[bytes, list[tuple[int, int, int]]]]:
    """Buffers of marked texts; each with (document, begin, end) of the bytes to be coded."""
    held, spans, size = [], [], 0
    for i, text in enumerate(texts):
        whole = MARK * BEFORE + text + MARK
        for at in range(BEFORE, len(whole), BUFFER):
            piece = whole[at - BEFORE: at + BUFFER]
            if held and size + len(piece) > BUFFER + BEFORE:
                yield b"".join(held), spans
                held, spans, size = [], [], 0
            spans.append((i, size + BEFORE, size + len(piece)))
            held.append(piece)
            size += len(piece)
    if held:
        yield b"".join(held), spans


def pairs(data: bytes, spans: list[tuple[int, int, int]], depth: int) -> np.ndarray:
    """Spread (context, byte) pairs of the spans' bytes, in order."""
    last = np.ndarray((len(data) - 7,), ">u8", buffer=data, strides=(1,)).astype(np.uint64)  # of position i + 7
    keep = np.zeros(len(last), bool)
    for _, lo, hi in spans:
        keep[lo - 7: hi - 7] = True
    bits = 8 * (depth + 1)
    return (last[keep] * np.uint64(SPREAD)) & np.uint64((1 << bits) - 1)


def unspread(values: np.ndarray, depth: int) -> np.ndarray:
    """Pairs as (nearest byte, next nearest, .., byte coded), the order of the trees."""
    bits = 8 * (depth + 1)
    v = (values * np.uint64(UNSPREAD)) & np.uint64((1 << bits) - 1)
    out = np.zeros(len(v), np.uint64)
    for i in range(1, depth + 1):
        out = (out << np.uint64(8)) | ((v >> np.uint64(8 * i)) & np.uint64(255))
    return (out << np.uint64(8)) | (v & np.uint64(255))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """For x >= 1/2: Stirling's series at x + 8, brought back by the recurrence."""
    y = x + 8
    rest = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5) * (x + 6) * (x + 7)
    series = (1 / 12 - (1 / 360 - (1 / 1260 - 1 / 1680 / y**2) / y**2) / y**2) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(rest)


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    return log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - log_gamma(n0 + n1 + 1) - np.log(np.pi)


class Subtrees:
    """Context trees from depth ``TOP`` down, over sorted distinct pairs in tree order."""

    TOP = 2

    def __init__(self, pair: np.ndarray, count: np.ndarray, depth: int):
        self.depth = depth
        self.keys, self.counts, self.parent = {depth: pair}, {depth: count.astype(np.float64)}, {}
        for d in range(depth - 1, self.TOP - 1, -1):
            key = ((self.keys[d + 1] >> np.uint64(16)) << np.uint64(8)) | (self.keys[d + 1] & np.uint64(255))
            order = np.argsort(key)
            new = np.concatenate(([True], key[order][1:] != key[order][:-1]))
            self.parent[d + 1] = np.empty(len(key), np.int64)
            self.parent[d + 1][order] = np.cumsum(new) - 1
            self.keys[d] = key[order][new]
            self.counts[d] = np.bincount(self.parent[d + 1], self.counts[d + 1])
        self.of, self.n0, self.n1, self.log_kt, self.log_pw = {}, {}, {}, {}, {}
        for d in range(depth, self.TOP - 1, -1):
            for b in range(8):
                node = self.keys[d] >> np.uint64(8 - b)
                new = np.concatenate(([True], node[1:] != node[:-1]))
                of = self.of[d, b] = np.cumsum(new) - 1
                one = self.bit(d, b)
                n = np.bincount(of, self.counts[d])
                n1 = self.n1[d, b] = np.bincount(of, self.counts[d] * one)
                n0 = self.n0[d, b] = n - n1
                own = self.log_kt[d, b] = log_kt(n0, n1)
                if d < depth:
                    below = self.of[d + 1, b]
                    head = np.flatnonzero(np.concatenate(([True], below[1:] != below[:-1])))
                    children = np.bincount(of[self.parent[d + 1][head]], self.log_pw[d + 1, b], len(n))
                    self.log_pw[d, b] = np.logaddexp(own, children) - np.log(2)
                else:
                    self.log_pw[d, b] = own

    def bit(self, d: int, b: int) -> np.ndarray:
        return ((self.keys[d] >> np.uint64(7 - b)) & np.uint64(1)).astype(np.int64)

    def top(self) -> tuple[np.ndarray, ...]:
        """(nearest byte * 256 + node, zeros, ones, sum of log Pw) over the nodes of depth ``TOP``."""
        d, out = self.TOP, []
        for b in range(8):
            head = np.flatnonzero(np.concatenate(([True], self.of[d, b][1:] != self.of[d, b][:-1])))
            key = self.keys[d][head]
            node = (key >> np.uint64(8 * d)) * np.uint64(256) + ((np.uint64(256) | (key & np.uint64(255))) >> np.uint64(8 - b))
            cell, of = np.unique(node.astype(np.int64), return_inverse=True)
            out.append((cell, *(np.bincount(of, x[d, b]) for x in (self.n0, self.n1, self.log_pw))))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def log10_probabilities(self, crown: Crown) -> np.ndarray:
        """Of each pair's byte in its context."""
        total = np.zeros(len(self.keys[self.depth]))
        for b in range(8):
            one, row, p = self.bit(self.depth, b), np.arange(len(total)), None
            for d in range(self.depth, self.TOP - 1, -1):
                of = self.of[d, b][row]
                n0, n1 = self.n0[d, b][of], self.n1[d, b][of]
                kt = (np.where(one == 1, n1, n0) + 0.5) / (n0 + n1 + 1)
                if p is None:
                    p = kt
                else:
                    own = 0.5 * np.exp(self.log_kt[d, b][of] - self.log_pw[d, b][of])
                    p = own * kt + (1 - own) * p
                if d > self.TOP:
                    row = self.parent[d][row]
            key = self.keys[self.depth]
            nearest = (key >> np.uint64(8 * self.depth)).astype(np.int64)
            node = ((np.uint64(256) | (key & np.uint64(255))) >> np.uint64(8 - b)).astype(np.int64)
            total += np.log10(crown.mix(nearest, node, one, p))
        return total


class Crown:
    """Depths 1 and 0 of all trees: at most 256 x 255 and 255 nodes."""

    def __init__(self, cell: np.ndarray, n0: np.ndarray, n1: np.ndarray, below: np.ndarray):
        dense = [np.zeros(65536) for _ in range(3)]
        for to, values in zip(dense, (n0, n1, below), strict=True):
            to[cell] = values
        a0, a1, children = (x.reshape(256, 256) for x in dense)
        own = log_kt(a0, a1)
        weighted = np.logaddexp(own, children) - np.log(2)
        self.share1 = 0.5 * np.exp(own - weighted)
        self.kt1 = (np.stack((a0, a1)) + 0.5) / (a0 + a1 + 1)
        z0, z1 = a0.sum(0), a1.sum(0)
        own0 = log_kt(z0, z1)
        self.share0 = 0.5 * np.exp(own0 - np.logaddexp(own0, weighted.sum(0)) + np.log(2))
        self.kt0 = (np.stack((z0, z1)) + 0.5) / (z0 + z1 + 1)

    def mix(self, nearest: np.ndarray, node: np.ndarray, one: np.ndarray, p: np.ndarray) -> np.ndarray:
        s1, s0 = self.share1[nearest, node], self.share0[node]
        return s0 * self.kt0[one, node] + (1 - s0) * (s1 * self.kt1[one, nearest, node] + (1 - s1) * p)


def group_of(pair: np.ndarray, depth: int) -> np.ndarray:
    """Group of the subtree (the two nearest bytes) of pairs in tree order."""
    top = pair >> np.uint64(8 * (depth - 1))
    return ((top * np.uint64(SPREAD)) >> np.uint64(40)).astype(np.int64) % GROUPS


def tokens_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Digests of all words of the texts and then of one end token for each; the texts' numbers of words."""
    n, digest = word_digests(texts, 1)
    return np.concatenate((digest, np.full(len(texts), END_TOKEN, np.uint64))), n


class Codec:
    """How pairs and words are dealt to shards and written in messages."""

    def __init__(self, depth: int, shards: int):
        self.depth = depth
        self.pair_shift, self.word_shift = 8 * (depth + 1) - (shards - 1).bit_length(), 64 - (shards - 1).bit_length()

    def pair_slices(self, pair: np.ndarray):
        return slices(pair, self.pair_shift)

    def packed(self, pair: np.ndarray, shard: int, n: np.ndarray) -> bytes:
        gap = np.diff(pair, prepend=np.uint64(shard << self.pair_shift))
        return len(pair).to_bytes(8, "little") + pack(np.concatenate((gap, n.astype(np.uint64))))

    def unpacked(self, blob: bytes, shard: int) -> tuple[np.ndarray, np.ndarray]:
        n, v = int.from_bytes(blob[:8], "little"), unpack(blob[8:])
        return np.cumsum(v[:n]) + np.uint64(shard << self.pair_shift), v[n:].astype(np.int64)

    def group_counts(self, t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct pairs of a group and their counts."""
        blobs = [np.frombuffer(b, np.uint64).reshape(2, -1) for b in t.column("blob").to_pylist()]
        if not blobs:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return counted(np.concatenate([b[0] for b in blobs]), np.concatenate([b[1] for b in blobs]).astype(np.int64))

    def count(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distinct pairs and words of about a chunk of texts at a time, by shard."""
        held, size = [], 0

        def sent() -> pa.RecordBatch:
            found = [counted(pairs(data, spans, self.depth)) for data, spans in parts(held)]
            pair, n = counted(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))
            digest, times = counted(tokens_of(held)[0])
            out = [(s, 0, 0, self.packed(pair[at], s, n[at])) for s, at in self.pair_slices(pair)]
            out += [(s, 0, 1, word_list(digest[at], times[at])) for s, at in slices(digest, self.word_shift)]
            return messages(out).combine_chunks().to_batches()[0]

        for b in batches:
            for t in b.column("text").to_pylist():
                held.append(lowered(t))
                size += len(held[-1])
                if size > CHUNK_BYTES // 2:
                    yield sent()
                    held, size = [], 0
        if held:
            yield sent()

    def add(self, t: pa.Table) -> pa.Table:
        """A shard's sums: pairs by group of subtrees (kind 0), words (kind 1), tokens and distinct words (kind 2)."""
        shard = t.column("shard")[0].as_py()
        rows = list(zip(t.column("kind").to_pylist(), t.column("blob").to_pylist(), strict=True))
        out = []
        sent = [self.unpacked(b, shard) for k, b in rows if k == 0]
        if sent:
            pair, n = counted(np.concatenate([s[0] for s in sent]), np.concatenate([s[1] for s in sent]))
            pair = unspread(pair, self.depth)
            group = group_of(pair, self.depth)
            order = np.argsort(group, kind="stable")
            pair, n, group = pair[order], n[order], group[order]
            out += [(g, shard, 0, pair[at].tobytes() + n[at].tobytes()) for g, at in slices(group.astype(np.uint64), 0)]
        words = [word_counts(b) for k, b in rows if k == 1]
        if words:
            digest, n = counted(np.concatenate([w[0] for w in words]), np.concatenate([w[1] for w in words]))
            out.append((shard, shard, 1, word_list(digest, n)))
            out.append((shard, shard, 2, int(n.sum()).to_bytes(8, "big") + len(n).to_bytes(8, "big")))
        return messages(out)


class Model:
    """Counts of the training texts in shards and groups, written once, and the crown."""

    def __init__(self, train: DataFrame, depth: int, shards: int):
        """``train``: rows with a ``text``."""
        codec = self.codec = Codec(depth, shards)
        added = train.select("text").mapInArrow(lambda bs: codec.count(bs), MESSAGE).groupBy("shard").applyInArrow(
            lambda t: codec.add(t), MESSAGE)
        self.counts = materialize(added, "lm-counts")
        sums = self.counts.where("kind = 2").select(
            F.conv(F.hex(F.substring("blob", 1, 8)), 16, 10).cast("long").alias("n"),
            F.conv(F.hex(F.substring("blob", 9, 8)), 16, 10).cast("long").alias("v")).agg(F.sum("n"), F.sum("v")).first()
        self.tokens, self.words = int(sums[0] or 0), int(sums[1] or 0)

        def tops(t: pa.Table) -> pa.Table:
            cell, n0, n1, below = Subtrees(*codec.group_counts(t), codec.depth).top()
            return pa.table([pa.array(cell), pa.array(n0), pa.array(n1), pa.array(below)], ["cell", "n0", "n1", "below"])

        rows = (self.counts.where("kind = 0").groupBy("shard").applyInArrow(tops, "cell long, n0 double, n1 double, below double")
                .groupBy("cell").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("below").alias("below"))
                .toPandas())  # at most 65,280 rows
        self.crown = Crown(*(rows[c].to_numpy() for c in ("cell", "n0", "n1", "below")))

    def score(self, docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
        """``doc_id``, ``n_tokens``, ``n_known``, ``base_score`` and ``score`` (both log10) of each row."""
        chunked, _, _ = with_chunks(documents(docs), chunk_bytes, ordered=False)
        codec, crown = self.codec, self.crown
        log_total = float(np.log10(self.tokens + self.words + 1))

        def ask(t: pa.Table) -> pa.Table:
            chunk, texts = t.column("chunk")[0].as_py(), [lowered(x) for x in t.column("text").to_pylist()]
            pair = uniq(np.concatenate([uniq(pairs(data, spans, codec.depth)) for data, spans in parts(texts)]))
            digest = uniq(tokens_of(texts)[0])
            none = np.zeros(0, np.int64)
            return messages([(s, chunk, 0, codec.packed(pair[at], s, none)) for s, at in codec.pair_slices(pair)]
                            + [(s, chunk, 1, digest[at].tobytes()) for s, at in slices(digest, codec.word_shift)])

        def gather(t: pa.Table) -> pa.Table:
            """The distinct pairs that chunks ask a shard for, by group of subtrees."""
            shard = t.column("shard")[0].as_py()
            sent = [codec.unpacked(b, shard)[0] for k, b in zip(t.column("kind").to_pylist(), t.column("blob").to_pylist(),
                                                               strict=True) if k == 0]
            pair = uniq(np.concatenate(sent)) if sent else np.zeros(0, np.uint64)
            group = group_of(unspread(pair, codec.depth), codec.depth)
            order = np.argsort(group, kind="stable")
            return messages([(g, shard, 0, pair[order][at].tobytes()) for g, at in slices(group[order].astype(np.uint64), 0)])

        def predict(known: pa.Table, asked: pa.Table) -> pa.Table:
            """Each asked pair's log10 probability, by shard."""
            seen, n = codec.group_counts(known)
            lists = [np.frombuffer(b, np.uint64) for b in asked.column("blob").to_pylist()]
            wanted = [unspread(v, codec.depth) for v in lists]
            if not wanted:
                return messages([])
            pair, count = counted(np.concatenate([seen, *wanted]),
                                  np.concatenate([n, np.zeros(sum(map(len, wanted)), np.int64)]))
            logs = Subtrees(pair, count, codec.depth).log10_probabilities(crown)
            return messages([(shard, 0, 0, v.tobytes() + logs[np.searchsorted(pair, w)].tobytes())
                             for shard, v, w in zip(asked.column("chunk").to_pylist(), lists, wanted, strict=True)])

        def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
            """For each chunk: the log10 probabilities and the word counts that it asked for."""
            if not asked.num_rows:
                return messages([])
            shard, model = asked.column("shard")[0].as_py(), {0: [], 1: []}
            for kind, blob in zip(known.column("kind").to_pylist(), known.column("blob").to_pylist(), strict=True):
                if kind == 0:
                    half = len(blob) // 2
                    model[0].append((np.frombuffer(blob, np.uint64, half // 8), np.frombuffer(blob, np.float64, offset=half)))
                elif kind == 1:
                    model[1].append(word_counts(blob))
            key, value = {}, {}
            for kind, found in model.items():
                k = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.uint64)
                order = np.argsort(k)
                key[kind], value[kind] = k[order], np.concatenate([f[1] for f in found])[order] if found else k
            out = []
            for chunk, kind, blob in zip(*(asked.column(c).to_pylist() for c in ("chunk", "kind", "blob")), strict=True):
                if kind == 0:
                    want = codec.unpacked(blob, shard)[0]
                    out.append((shard, chunk, 0, value[0][np.searchsorted(key[0], want)].tobytes()))
                else:
                    want, n = np.frombuffer(blob, np.uint64), np.zeros(len(blob) // 8, np.int64)
                    if len(key[1]):
                        at = np.minimum(np.searchsorted(key[1], want), len(key[1]) - 1)
                        n = np.where(key[1][at] == want, value[1][at], 0)
                    out.append((shard, chunk, 1, pack(n)))
            return messages(out)

        def add_up(t: pa.Table, said: pa.Table) -> pa.Table:
            texts = [lowered(x) for x in t.column("text").to_pylist()]
            got = {0: [], 1: []}
            for _, kind, blob in sorted(zip(*(said.column(c).to_pylist() for c in ("shard", "kind", "blob")), strict=True),
                                        key=lambda r: r[:2]):
                got[kind].append(np.frombuffer(blob, np.float64) if kind == 0 else unpack(blob))
            logs, times = np.concatenate(got[0]), np.concatenate(got[1]).astype(np.float64)
            tokens, n_words = tokens_of(texts)
            order = np.argsort(tokens)
            kind = np.concatenate(([0], np.cumsum(tokens[order][1:] != tokens[order][:-1])))
            c = np.empty(len(tokens))
            c[order] = times[kind]
            text_of = np.concatenate((np.repeat(np.arange(len(texts)), n_words), np.arange(len(texts))))
            n_known, base = np.bincount(text_of, c > 0), np.bincount(text_of, np.log10(c + 1) - log_total)
            score = np.zeros(len(texts))
            made = list(parts(texts))
            known = uniq(np.concatenate([uniq(pairs(data, spans, codec.depth)) for data, spans in made]))
            low = np.uint64((1 << POSITION_BITS) - 1)
            drop = np.uint64(max(0, 8 * (codec.depth + 1) + POSITION_BITS - 64))
            for data, spans in made:
                pair = pairs(data, spans, codec.depth)
                # Sorted by as many leading bits as leave room for the position; equal pairs may form
                # more than one run, each of which is looked up.
                place = np.arange(len(pair), dtype=np.uint64)
                order = (np.sort(((pair >> drop) << np.uint64(POSITION_BITS)) | place) & low).astype(np.int64)
                pair = pair[order]
                new = np.concatenate(([True], pair[1:] != pair[:-1]))
                value = np.empty(len(pair))
                value[order] = logs[np.searchsorted(known, pair[new])][np.cumsum(new) - 1]
                begin = np.concatenate(([0], np.cumsum([hi - lo for _, lo, hi in spans])[:-1]))
                np.add.at(score, [s[0] for s in spans], np.add.reduceat(value, begin))
            return pa.table([
                t.column("doc_id"), pa.array(n_words + 1), pa.array(n_known.astype(np.int64)), pa.array(base), pa.array(score)],
                ["doc_id", "n_tokens", "n_known", "base_score", "score"])

        by_chunk = chunked.groupBy("chunk")
        asked = by_chunk.applyInArrow(ask, MESSAGE)
        gathered = asked.groupBy("shard").applyInArrow(gather, MESSAGE)
        trained = self.counts.where("kind = 0")
        predicted = trained.groupBy("shard").cogroup(gathered.groupBy("shard")).applyInArrow(predict, MESSAGE)
        known = predicted.unionByName(self.counts.where("kind = 1"))
        said = asked.groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(answer, MESSAGE)
        return by_chunk.cogroup(said.groupBy("chunk")).applyInArrow(
            add_up, "doc_id long, n_tokens long, n_known long, base_score double, score double")


def word_list(digest: np.ndarray, n: np.ndarray) -> bytes:
    return len(digest).to_bytes(8, "little") + digest.tobytes() + pack(n)


def word_counts(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """What ``word_list`` was given."""
    n = int.from_bytes(blob[:8], "little")
    return np.frombuffer(blob, np.uint64, n, 8), unpack(blob[8 + 8 * n:]).astype(np.int64)


def train(docs: DataFrame, depth: int = DEPTH) -> Model:
    """A model of all rows of ``docs`` with a ``text``."""
    _, total = text_stats(documents(docs))
    shards = 1 << max(5, (2 * total // CHUNK_BYTES).bit_length())
    return Model(documents(docs), depth, shards)


def split(docs: DataFrame) -> DataFrame:
    """Documents with ``held_out``: crc32 of the id as text, modulo 7, is 2."""
    clean = documents(docs)
    crc = F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8"))
    return clean.withColumn("held_out", crc % 7 == 2)
