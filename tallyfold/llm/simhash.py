"""SimHash near-dedup by the generalised pigeonhole principle.

A text's 64-bit fingerprint has a bit set if over half of its word shingles'
XXH64 hashes have it.  Two fingerprints link if at most ``distance`` bits
differ; documents of linked fingerprints form components.

Search runs over distinct fingerprints, so copies cost one.  Bits are grouped
into ``parts`` partitions, correlated bits together (greedily, from the bit
correlations of all fingerprints).  By the generalised pigeonhole principle, if
thresholds ``t_i >= -1`` sum to ``distance - parts + 1``, every fingerprint
within ``distance`` of a query is within ``t_i`` of it in some partition ``i``
(-1: the partition need not be looked at).  Each query gets its own unequal
thresholds by dynamic programming over estimated candidate counts: the exact
number of fingerprints that share a partition's value, plus, for values a few
bits away, an estimate from the marginal frequencies of the bits.  A partition
value that very many fingerprints share is expensive and so gets -1; where all
are, the query looks up its whole neighbourhood of 64-bit values instead, which
bounds the work of any query.  Probes meet the index in an equi-join, and the
exact bit distance is verified there.

Null and empty texts have fingerprint 0.  Null ids count for the smallest id of
a component only if it has no other.  Repeated rows stay rows of their own; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import documents
from .graph import components

SHINGLE, DISTANCE, PARTS, SEED = 3, 2, 3, 42
BITS = 64
#: Hashes that are counted at a time.
BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of the text's word shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle], ends[shingle - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[s:e], SEED) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), BLOCK):
        block = np.array(hashes[i: i + BLOCK], dtype=np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def row_key() -> Column:
    """Tells rows apart but for repeated ones."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``row`` (a digest of id and text) and ``fp`` (the fingerprint as a signed long)."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("row"), pa.array(fps)], ["doc_id", "row", "fp"])

    return documents(docs, row_key().alias("row")).mapInArrow(made, "doc_id long, row long, fp long")


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and the 64 x 64 counts of bits set together."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS)), 0
        for b in batches:
            bits = as_bits(b.column("fp").to_numpy(zero_copy_only=False)).astype(np.float64)
            total += bits.T @ bits
            n += len(bits)
        cells = np.concatenate((total.ravel(), [n])).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], ["cell", "n"])

    rows = fps.select("fp").mapInArrow(counted, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    cells = np.zeros(BITS * BITS + 1)
    cells[rows["cell"].to_numpy()] = rows["n"].to_numpy()
    return int(cells[-1]), cells[:-1].reshape(BITS, BITS)


def as_bits(fps: np.ndarray) -> np.ndarray:
    """Rows of 64 bits, the lowest bit first."""
    return np.unpackbits(fps.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def group_bits(n: int, both: np.ndarray, parts: int = PARTS) -> list[list[int]]:
    """Bits in ``parts`` groups of about equal size, each grown from the bit
    left with the strongest correlations by the bits most correlated with it."""
    p = np.diag(both) / max(n, 1)
    dev = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(dev, dev)
    np.fill_diagonal(corr, 0)
    left, groups = list(range(len(p))), []
    for i in range(parts):
        size = (len(p) - sum(map(len, groups))) // (parts - i)
        group = [max(left, key=lambda b: (corr[b, left].sum(), -b))]
        while len(group) < size:
            group.append(max((b for b in left if b not in group), key=lambda b: (corr[b, group].sum(), -b)))
        left = [b for b in left if b not in group]
        groups.append(sorted(group))
    return groups


def part_values(bits: np.ndarray, groups: list[list[int]]) -> list[np.ndarray]:
    return [bits[:, g].astype(np.int64) @ (1 << np.arange(len(g), dtype=np.int64)) for g in groups]


def allocate(costs: np.ndarray, total: int) -> np.ndarray:
    """Thresholds (rows x parts) of least summed cost that sum to ``total``.

    ``costs[:, i, t + 1]`` is what threshold ``t`` costs in part ``i``.  The
    dynamic programme keeps, part by part, the best cost for every sum so far.
    """
    n, parts, options = costs.shape
    span = parts * (options - 1) + 1  # sums from -parts to parts * (options - 2)
    best = np.full((n, span), np.inf)
    best[:, 0] = 0
    choice = np.zeros((parts, n, span), np.int8)
    for i in range(parts):
        new = np.full((n, span), np.inf)
        for o in range(options):
            for s in range(span - o):
                cost = best[:, s] + costs[:, i, o]
                better = cost < new[:, s + o]
                new[better, s + o] = cost[better]
                choice[i, better, s + o] = o
        best = new
    out = np.zeros((n, parts), np.int64)
    at = np.full(n, total + parts)
    for i in reversed(range(parts)):
        out[:, i] = choice[i, np.arange(n), at]
        at = at - out[:, i]
    return out - 1


def links(fps: DataFrame, distance: int = DISTANCE, parts: int = PARTS) -> DataFrame:
    """Pairs ``u < v`` of distinct fingerprints (column ``fp``) at most ``distance`` bits apart."""
    n, both = bit_counts(fps)
    groups = group_bits(n, both, parts)
    share = np.clip(np.diag(both) / max(n, 1), 1e-6, 1 - 1e-6)
    near = [sum(1 << b for b in c) for k in range(distance + 1) for c in combinations(range(BITS), k)]
    whole = np.array(near, np.uint64).view(np.int64)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(part, value, fp); the last part is the whole fingerprint."""
        for b in batches:
            fp = b.column("fp").to_numpy(zero_copy_only=False)
            values = [*part_values(as_bits(fp), groups), fp]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(parts + 1, dtype=np.int32), len(fp))), pa.array(np.concatenate(values)),
                 pa.array(np.tile(fp, parts + 1))], ["part", "value", "x"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column("fp").to_numpy(zero_copy_only=False)
            same = np.stack([b.column(f"c{i}").to_numpy(zero_copy_only=False) for i in range(parts)], 1)
            for lo in range(0, len(fp), 256):
                part, value, query = probes(fp[lo: lo + 256], same[lo: lo + 256])
                yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(value), pa.array(query)], ["part", "value", "q"])

    def probes(fp: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        bits = as_bits(fp)
        odds = np.where(bits, (1 - share) / share, share / (1 - share))  # of the bit's other value
        costs = np.full((len(fp), parts, distance + 2), 0.0)
        for i, g in enumerate(groups):
            of_value = n * np.prod(np.where(bits[:, g], share[g], 1 - share[g]), axis=1)
            flips = np.ones((len(fp), distance + 1))  # sums over 0, 1, .. flipped bits, by Newton's identities
            power = [None, *((odds[:, g] ** k).sum(1) for k in range(1, distance + 1))]
            keys = 0
            for t in range(distance + 1):
                if t:
                    flips[:, t] = sum((-1) ** (k - 1) * flips[:, t - k] * power[k] for k in range(1, t + 1)) / t
                keys += len(list(combinations(range(len(g)), t)))
                costs[:, i, t + 1] = keys + same[:, i] + of_value * flips[:, 1: t + 1].sum(1)
        t = allocate(costs, distance - parts + 1)
        spent = np.take_along_axis(costs, t[:, :, None] + 1, 2).sum((1, 2))
        wide = spent > len(whole)
        out = [(np.full(wide.sum() * len(whole), parts, np.int32), (fp[wide, None] ^ whole).ravel(),
                np.repeat(fp[wide], len(whole)))]
        for i, values in enumerate(part_values(bits, groups)):
            for r in range(distance + 1):
                rows = ~wide & (t[:, i] >= r)
                masks = np.array([sum(1 << b for b in c) for c in combinations(range(len(groups[i])), r)], np.int64)
                if rows.any():
                    out.append((np.full(rows.sum() * len(masks), i, np.int32), (values[rows, None] ^ masks).ravel(),
                                np.repeat(fp[rows], len(masks))))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    indexed = fps.select("fp").mapInArrow(index, "part int, value long, x long")
    counts = indexed.where(F.col("part") < parts).groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"))
    counted = (indexed.where(F.col("part") < parts).join(counts, ["part", "value"]).groupBy("x")
               .agg(*[F.max(F.when(F.col("part") == i, F.col("n"))).alias(f"c{i}") for i in range(parts)])
               .withColumnRenamed("x", "fp"))
    asked = counted.mapInArrow(probe, "part int, value long, q long")
    close = (F.col("q") < F.col("x")) & (F.bit_count(F.col("q").bitwiseXOR(F.col("x"))) <= distance)
    joined = asked.join(indexed, (asked["part"] == indexed["part"]) & (asked["value"] == indexed["value"]) & close)
    return joined.select(F.col("q").alias("u"), F.col("x").alias("v")).distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, parts: int = PARTS) -> DataFrame:
    """``doc_id``, ``row``, ``fp``, ``root`` (the component's smallest fingerprint)
    and ``component_id`` (the smallest id reachable over links) of every row."""
    fps = materialize(fingerprints(docs, shingle), "fingerprints")
    nodes = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "simhash-nodes")
    rooted = components(links(nodes, distance, parts))
    grouped = nodes.join(rooted, nodes["fp"] == rooted["node"], "left").select(
        "fp", "doc_id", F.coalesce("root", "fp").alias("root"))
    smallest = grouped.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = grouped.join(smallest, "root").select("fp", "root", "component_id")
    return fps.join(named, "fp").select("doc_id", "row", "fp", "root", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of ``docs`` for each component: that of the smallest id (null last, then any of equal rows)."""
    found = near_duplicates(docs, shingle, distance)
    chosen = found.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "row"))["row"].alias("__row"))
    return (docs.withColumn("__row", row_key()).join(chosen.select("__row"), "__row", "left_semi")
            .dropDuplicates(["__row"]).select(*docs.columns))


def hex_text(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
