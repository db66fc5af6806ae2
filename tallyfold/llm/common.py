"""Helpers shared by the document operators.

* ``documents``: the two columns most operators need, with nulls settled;
* ``splitters`` / ``range_index``: size-weighted sampled quantiles and a
  native lookup of a row's range among them;
* ``with_chunks``: documents dealt into chunks of about equal bytes;
* ``pack`` / ``unpack``: sorted integers as variable-length bytes, the form in
  which chunks and shards exchange lists.
"""

from __future__ import annotations

import math
from collections import defaultdict
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ASCII white space, the only separator of words in these operators.
WORD = r"[^\x20\x09-\x0D]+"
#: What chunks of documents and shards of digests send each other.
MESSAGE = "shard long, chunk int, kind int, blob binary"


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(df: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` as long and ``text`` (null: empty), and the columns named."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"),
                     F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


def free_name(name: str, columns: list[str]) -> str:
    """``name``, longer by underscores until no column has it in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def uniform(*cols: Column) -> Column:
    """A number in (0, 1) that depends on the columns' values only."""
    return (F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") + 0.5) / F.lit(float(1 << 53))


def splitters(df: DataFrame, key: Column, size: Column, ranges: int, total: int, oversample: int = 32,
              draw: int = 0) -> list[int]:
    """At most ``ranges - 1`` increasing long values that cut ``key`` into
    ranges of about equal ``size``.

    A row is drawn with probability ``size * ranges * oversample / total`` (at
    most 1) and counts as its size over that probability.  The expected sample
    is at most ``ranges * oversample`` rows of two numbers, which is what the
    driver gathers; it depends on the rows' keys and ``draw`` only, so reruns agree.
    """
    if ranges <= 1 or total <= 0:
        return []
    want = ranges * oversample
    p = F.least(F.lit(1.0), size.cast("double") * want / float(total))
    drawn = (df.select(key.alias("k"), size.cast("double").alias("s"), p.alias("p"))
             .where(uniform(F.col("k"), F.lit(draw)) < F.col("p"))
             .select("k", (F.col("s") / F.col("p")).alias("w")).dropna().collect())
    drawn.sort()
    whole, run, cuts = sum(r["w"] for r in drawn), 0.0, []
    for r in drawn:
        run += r["w"]
        while len(cuts) < ranges - 1 and run >= whole * (len(cuts) + 1) / ranges:
            cuts.append(int(r["k"]))
    return sorted(set(cuts))


def range_index(key: Column, cuts: list[int]) -> Column:
    """The number of ``cuts`` that are not above ``key``: a binary search in
    one constant array, so its cost grows with the logarithm of the ranges."""
    if not cuts:
        return F.lit(0)
    steps = len(cuts).bit_length()
    padded = [*cuts, *[2**63 - 1] * ((1 << steps) - 1 - len(cuts))]
    arr = F.split(F.lit(",".join(map(str, padded))), ",").cast("array<bigint>")
    powers = F.array(*[F.lit(1 << (steps - 1 - i)) for i in range(steps)])
    found = F.aggregate(powers, F.lit(0),
                        lambda lo, step: F.when(F.element_at(arr, lo + step) <= key, lo + step).otherwise(lo))
    return F.least(found, F.lit(len(cuts)))


def text_stats(df: DataFrame) -> tuple[int, int]:
    """Rows and UTF-8 bytes of ``text``."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    return int(row["n"] or 0), int(row["b"] or 0)


def with_chunks(docs: DataFrame, chunk_bytes: int, ordered: bool) -> tuple[DataFrame, int, int]:
    """``docs`` with an int ``chunk``; the number of chunks and of bytes.

    ``ordered``: chunks are ranges of ``doc_id`` (nulls first) cut at sampled,
    size-weighted quantiles, so an earlier chunk holds smaller ids.  Otherwise
    chunks are dealt by a hash of the id and the text's length.
    """
    _, total = text_stats(docs)
    n = max(1, math.ceil(total / chunk_bytes))
    if ordered:
        key = F.coalesce(F.col("doc_id"), F.lit(-(2**63)))
        cuts = splitters(docs, key, F.octet_length("text") + 1, n, total, oversample=16)
        return docs.withColumn("chunk", range_index(key, cuts).cast("int")), len(cuts) + 1, total
    chunk = F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(n)).cast("int")
    return docs.withColumn("chunk", chunk), n, total


def uniq(a: np.ndarray) -> np.ndarray:
    """Sorted distinct values (numpy's own ``unique`` is far slower on 64-bit)."""
    a = np.sort(a)
    return a[np.concatenate(([True], a[1:] != a[:-1]))] if len(a) else a


def numbering() -> defaultdict:
    """Numbers its keys from 0 in the order in which they are first asked for."""
    number: defaultdict = defaultdict()
    number.default_factory = number.__len__
    return number


def counted(values: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and how often (or with what weight) each occurs."""
    if not len(values):
        return values, np.zeros(0, np.int64)
    if weights is None:
        values = np.sort(values)
    else:
        order = np.argsort(values)
        values, weights = values[order], weights[order]
    new = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    n = np.diff(np.concatenate((new, [len(values)]))) if weights is None else np.add.reduceat(weights, new)
    return values[new], n


def pack(values: np.ndarray) -> bytes:
    """Non-negative integers as little-endian base-128 bytes."""
    v = values.astype(np.uint64)
    if not len(v):
        return b""
    width = np.ones(len(v), np.int64)
    for bits in range(7, int(v.max()).bit_length(), 7):
        width += v >= np.uint64(1 << bits)
    end = np.cumsum(width)
    out = np.zeros(int(end[-1]), np.uint8)
    start = end - width
    for j in range(int(width.max())):
        has = width > j
        more = (width[has] > j + 1).astype(np.uint8) << 7
        out[start[has] + j] = ((v[has] >> np.uint64(7 * j)) & np.uint64(127)).astype(np.uint8) | more
    return out.tobytes()


def unpack(blob: bytes) -> np.ndarray:
    """What ``pack`` was given."""
    b = np.frombuffer(blob, np.uint8)
    if not len(b):
        return np.zeros(0, np.uint64)
    last = b < 128
    start = np.concatenate(([0], np.flatnonzero(last)[:-1] + 1))
    index = np.cumsum(np.concatenate(([0], last[:-1].astype(np.int64))))
    part = (b & 127).astype(np.uint64) << (7 * (np.arange(len(b)) - start[index])).astype(np.uint64)
    return np.add.reduceat(part, start)


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over the word."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def slices(values: np.ndarray, shift: int):
    """(shard, values of it) of sorted ``values``; the shard is in the bits from ``shift`` up."""
    if not len(values):
        return
    shard = values >> np.uint64(shift)
    cut = np.concatenate(([0], np.flatnonzero(shard[1:] != shard[:-1]) + 1, [len(values)]))
    for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        yield int(shard[lo]), slice(lo, hi)


def messages(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    cols = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
    return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()),
                     pa.array(cols[3], pa.binary())], ["shard", "chunk", "kind", "blob"])


#: Bytes whose words are digested together.
WORD_BUFFER = 1 << 20


def word_parts(texts: list[bytes]):
    """Runs of whole texts of about ``WORD_BUFFER`` bytes, and the texts' indices; a
    longer text comes in parts that end at white space."""
    held, index, size = [], [], 0
    for i, text in enumerate(texts):
        at = 0
        while at < len(text) or not text:
            stop = at + WORD_BUFFER
            if stop < len(text):
                while stop < len(text) and text[stop] not in b" \t\n\r\x0b\x0c":
                    stop += 1
            part = text[at:stop]
            if held and size + len(part) > WORD_BUFFER:
                yield held, index
                held, index, size = [], [], 0
            held.append(part)
            index.append(i)
            size += len(part) + 1
            at = stop
            if not text:
                break
    if held:
        yield held, index


class WordDigests(dict):
    """128-bit digests (BLAKE2b) of words, by their number in order of first sight."""

    def __init__(self) -> None:
        self.blobs: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.blobs)
        self.blobs.append(blake2b(word, digest_size=16).digest())
        return n


def word_digests(texts: list[bytes], digests: int = 2) -> tuple[np.ndarray, ...]:
    """Words (between ASCII white space) of each text, and 64-bit digests of all words in order: the
    halves of a cryptographic digest, so no two words can be made to agree in them.

    Each word of a buffer is digested once, however often it stands there."""
    n_words = np.zeros(len(texts), np.int64)
    out: list[list[np.ndarray]] = [[] for _ in range(digests)]
    for held, index in word_parts(texts):
        table, numbers = WordDigests(), []
        for part, i in zip(held, index, strict=True):
            words = part.split()
            n_words[i] += len(words)
            numbers.append(np.fromiter(map(table.__getitem__, words), np.int64, len(words)))
        halves = np.frombuffer(b"".join(table.blobs), "<u8").reshape(-1, 2)
        for j, found in enumerate(out):
            found.append(halves[np.concatenate(numbers), j])
    return n_words, *(np.concatenate(x) if x else np.zeros(0, np.uint64) for x in out)
