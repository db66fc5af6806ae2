"""Vector code compression by member-resident Lloyd rounds.

A vector is cut into equal consecutive parts; each part position has a codebook
of at most 256 entries, and a vector's code is the index of the nearest entry
(squared Euclidean distance, ties to the lower index) for each of its parts.

The rows of the iteration are parts, dealt to owners by (position, entry,
salt): the parts of one entry stay together, and the salt splits an entry that
holds a large share of all parts.  A round has three steps:

1. owners add up their resident members; the sums of one entry meet in one
   small row per task, and the new codebooks (at most 256 entries a position,
   whatever the input) go through the driver;
2. owners look for each member's nearest entry and write their members where
   they are, those that keep their entry apart from those that change it;
3. only the members that changed are shuffled, to the owners of their new entry.

Every round is a table in the shared folder, so a lost executor repeats tasks
of one round only; tables that the next round has replaced are removed.  Once
no member moves, the codebooks cannot change any more and the rounds end.

All arithmetic is on integers and exact: components become ``floor(1024 * x)``,
distances use doubles only where every intermediate is below 2^53.

* Rows whose vector is null, or holds a null or a non-finite component, are left out.
* The length is that of the longest vector, rounded up to a multiple of the number
  of parts; shorter vectors (empty ones included) end in zeros.
* A codebook starts from the smallest distinct ids, nulls last; of the vectors of
  one id the smallest counts.  With fewer ids the codebook is smaller.
* Repeated rows and equal vectors are rows like any other and get equal codes.
* Distances beyond a 64-bit integer are reported as the largest one.
* An empty table gives no rows.  Columns besides the three named are ignored,
  whatever their names are.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from ..session import discard, materialize, scratch_path

PARTS, ENTRIES, SCALE, ROUNDS = 4, 256, 1024, 4
#: Members of one entry that one owner should hold, and the least number of salts.
OWNER_ROWS, LEAST_SALTS = 10_000, 16
#: Rows whose distances to all entries are held at once.
BLOCK = 4096
#: Components up to this size give distances that doubles hold exactly (parts of up to 2,048 components).
SMALL = 1 << 20
LONGEST = (1 << 63) - 1


def integers(x: np.ndarray) -> np.ndarray:
    """``floor(1024 * x)``: int64 where all of them fit, else Python integers."""
    if not x.size or np.abs(x).max() < 2.0**50:
        return np.floor(x * SCALE).astype(np.int64)
    exact = [math.floor(v * SCALE) if abs(v) < 2.0**50 else int(v) * SCALE for v in x.ravel().tolist()]
    return np.array(exact, dtype=object).reshape(x.shape)


def largest(v: np.ndarray) -> np.ndarray:
    """Every row's largest magnitude."""
    return np.abs(v).max(axis=1) if v.shape[1] else np.zeros(len(v), np.int64)


def nearest(v: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the nearest entry's index and its squared distance, exactly."""
    index, error = np.zeros(len(v), np.int64), np.zeros(len(v), object)
    size = largest(book)
    near = np.flatnonzero(size <= SMALL)
    # An entry this far out is farther from every small row than any small entry is.
    far = size > SMALL + 2 * SMALL * (math.isqrt(v.shape[1]) + 1)
    plain = (largest(v) <= SMALL) & bool(len(near) and len(near) + far.sum() == len(book) and v.shape[1] <= 2048)
    rows = np.flatnonzero(plain)
    if len(rows):
        c = book[near].astype(np.float64)
        for at in range(0, len(rows), BLOCK):
            some = rows[at:at + BLOCK]
            x = v[some].astype(np.float64)
            d = (c * c).sum(axis=1)[None, :] - 2.0 * (x @ c.T)
            best = d.argmin(axis=1)
            index[some] = near[best]
            error[some] = (d[np.arange(len(some)), best] + (x * x).sum(axis=1)).astype(np.int64)
    exact = book.astype(object)
    for i in np.flatnonzero(~plain):
        gap = exact - v[i].astype(object)[None, :]
        d = [sum(g * g for g in row) for row in gap.tolist()]
        index[i] = d.index(min(d))
        error[i] = min(d)
    return index, error


def pack_parts(v: np.ndarray) -> tuple[list[int], list[bytes]]:
    """Every row's form (0: 16 bits, 1: 64 bits, 2: decimal text for what is larger) and bytes."""
    size = largest(v)
    forms, blobs = [], []
    for row, top in zip(v, size, strict=True):
        form = 0 if top < 1 << 15 else 1 if top < 1 << 62 else 2
        forms.append(form)
        blobs.append(row.astype("<i2").tobytes() if form == 0 else row.astype("<i8").tobytes() if form == 1
                     else ",".join(map(str, row.tolist())).encode())
    return forms, blobs


def unpack_parts(forms: np.ndarray, blobs: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(blobs), width), object if (forms == 2).any() else np.int64)
    for form, kind in ((0, "<i2"), (1, "<i8")):
        at = np.flatnonzero(forms == form)
        if len(at):
            out[at] = np.frombuffer(b"".join(blobs[i] for i in at), kind).reshape(len(at), width)
    for i in np.flatnonzero(forms == 2):
        out[i] = [int(t) for t in blobs[i].split(b",")]
    return out


@dataclass
class Codebooks:
    """At most 256 entries of integers per part position."""

    books: list[np.ndarray]
    width: int

    def assign(self, position: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        entry, error = np.zeros(len(v), np.int64), np.zeros(len(v), object)
        for j, book in enumerate(self.books):
            at = np.flatnonzero(position == j)
            if len(at):
                entry[at], error[at] = nearest(v[at], book)
        return entry, error

    def sha256(self) -> str:
        flat = ",".join(str(int(x)) for book in self.books for entry in book for x in entry)
        return hashlib.sha256(flat.encode()).hexdigest()

    def decode(self, code: str) -> list[int]:
        """The integers that a code stands for."""
        return [int(x) for j, book in enumerate(self.books) for x in book[int(code[2 * j:2 * j + 2], 16)]]


def usable(vector: Column) -> Column:
    """Not null, and every component a finite number."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & fine


def first_codebooks(rows: DataFrame, parts: int, entries: int, width: int) -> Codebooks:
    """The parts of the smallest distinct ids (``entries`` of them at most)."""
    ids = [r[0] for r in rows.select("vec_id").distinct().orderBy(F.col("vec_id").asc_nulls_last()).limit(entries).collect()]
    known = [i for i in ids if i is not None]
    wanted = F.lit(False) if not known else F.col("vec_id") <= known[-1]
    if None in ids:
        wanted = wanted | F.col("vec_id").isNull()
    seeds = rows.where(wanted).groupBy("vec_id").agg(F.min("x").alias("x")).orderBy(F.col("vec_id").asc_nulls_last()).collect()
    flat = integers(np.array([r["x"] for r in seeds], np.float64).reshape(len(seeds), parts * width))
    return Codebooks([flat[:, j * width:(j + 1) * width] for j in range(parts)], width)


def values(batch: pa.RecordBatch, width: int) -> np.ndarray:
    forms = batch.column("form").to_numpy(zero_copy_only=False)
    return unpack_parts(forms, batch.column("part").to_pylist(), width)


def first_members(parts: DataFrame, books: Codebooks, salts: int) -> DataFrame:
    """Parts with their nearest first entry, dealt to the entries' owners."""
    width = books.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat = b.column("x").flatten().to_numpy(zero_copy_only=False)
            v = integers(flat.astype(np.float64).reshape(b.num_rows, width))
            entry, _ = books.assign(b.column("position").to_numpy(), v)
            forms, blobs = pack_parts(v)
            yield pa.RecordBatch.from_arrays(
                [b.column("uid"), b.column("vec_id"), b.column("label"), b.column("position"), b.column("salt"),
                 pa.array(entry, pa.int32()), pa.array(forms, pa.int8()), pa.array(blobs, pa.binary())],
                ["uid", "vec_id", "label", "position", "salt", "entry", "form", "part"])

    kinds = dict(parts.dtypes)
    schema = (f"uid long, vec_id {kinds['vec_id']}, label {kinds['label']}, position int, salt int, entry int, "
              "form byte, part binary")
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("uid"), F.lit(salts)).cast("int"))
    return salted.mapInArrow(run, schema).repartition("position", "entry", "salt")


def updated(members: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry moved to the floored mean of its members; unused entries stay."""
    width, parts = books.width, len(books.books)
    most = max(len(book) for book in books.books)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(parts * most, np.int64)
        sums = np.zeros((parts * most, width), object)
        for b in batches:
            v = values(b, width)
            key = b.column("position").to_numpy().astype(np.int64) * most + b.column("entry").to_numpy()
            fits = largest(v) < 1 << 40
            fast = np.zeros((parts * most, width), np.int64)
            np.add.at(fast, key[fits], v[fits].astype(np.int64))
            used = np.unique(key)
            sums[used] += fast[used].astype(object)
            for i in np.flatnonzero(~fits):
                sums[key[i]] += v[i].astype(object)
            np.add.at(count, key, 1)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used // most, pa.int32()), pa.array(used % most, pa.int32()), pa.array(count[used], pa.int64()),
             pa.array([",".join(map(str, row)) for row in sums[used].tolist()], pa.string())],
            ["position", "entry", "n", "sums"])

    def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: dict[tuple[int, int], int] = {}
        total: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for j, k, n, text in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                row = np.array([int(x) for x in text.split(",")] if text else [], object)
                total[j, k] = total[j, k] + row if (j, k) in total else row
                count[j, k] = count.get((j, k), 0) + n
        yield pa.RecordBatch.from_arrays(
            [pa.array([j for j, _ in count], pa.int32()), pa.array([k for _, k in count], pa.int32()),
             pa.array([",".join(str(x // n) for x in total[key]) for key, n in count.items()], pa.string())],
            ["position", "entry", "mean"])

    sums = members.select("position", "entry", "form", "part").mapInArrow(partial, "position int, entry int, n long, sums string")
    found = sums.repartition("position", "entry").mapInArrow(means, "position int, entry int, mean string").collect()
    new = [book.astype(object) for book in books.books]
    for r in found:
        new[r["position"]][r["entry"]] = [int(x) for x in r["mean"].split(",")] if r["mean"] else []
    top = max((int(x) for x in map(np.max, [largest(b) for b in new if len(b)])), default=0)
    return Codebooks([b.astype(np.int64) for b in new] if top < 1 << 62 else new, width)


def reassigned(members: DataFrame, books: Codebooks) -> DataFrame:
    """``members`` with their nearest entry now, whether it changed, and the distance."""
    width = books.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            entry, error = books.assign(b.column("position").to_numpy(), values(b, width))
            moved = entry != b.column("entry").to_numpy()
            keep = [n for n in b.schema.names if n != "entry"]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(n) for n in keep], pa.array(entry, pa.int32()), pa.array(moved),
                 pa.array([min(int(e), LONGEST) for e in error], pa.int64())],
                [*keep, "entry", "moved", "error"])

    kinds = dict(members.dtypes)
    keep = ", ".join(f"{n} {kinds[n]}" for n in members.columns if n != "entry")
    return members.mapInArrow(run, f"{keep}, entry int, moved boolean, error long")


def migrate(members: DataFrame, books: Codebooks) -> tuple[DataFrame, list[str], int]:
    """The next round's members, the folders that hold them, and how many moved.

    Members that keep their entry are written by the task that holds them; only
    the others go through a shuffle, to the owners of their new entry.
    """
    spark = members.sparkSession
    here, there = scratch_path(spark, "vectors-resident"), scratch_path(spark, "vectors-moved")
    reassigned(members, books).drop("error").write.partitionBy("moved").parquet(here)
    written = spark.read.schema(StructType([*members.schema, StructField("moved", BooleanType())])).parquet(here)
    movers = written.where("moved").drop("moved")
    movers.select(*members.columns).repartition("position", "entry", "salt").write.parquet(there)
    arrived = spark.read.schema(members.schema).parquet(there)
    stays = written.where("not moved").select(*members.columns)
    return stays.unionByName(arrived), [here, there], arrived.count()


def learn(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str | None = "label",
          parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame | None, Codebooks | None]:
    """Members after ``rounds`` rounds and the final codebooks (None for an empty table)."""
    x = F.col(vector).cast("array<double>")
    rows = df.select(F.col(vec_id).alias("vec_id"), (F.col(label) if label else F.lit(None).cast("int")).alias("label"),
                     x.alias("x")).where(usable(F.col("x")))
    shape = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d")).first()
    if not shape["n"]:
        return None, None
    width = math.ceil(shape["d"] / parts)
    zeros = F.array_repeat(F.lit(0.0), F.lit(width * parts) - F.size("x"))
    rows = rows.withColumn("x", F.concat("x", zeros))
    books = first_codebooks(rows, parts, entries, width)
    cut = F.array(*[F.slice("x", j * width + 1, width) for j in range(parts)])
    each = (rows.withColumn("uid", F.monotonically_increasing_id())
            .select("uid", "vec_id", "label", F.posexplode(cut).alias("position", "x")))
    once = F.col("position") == 0  # id and label travel with the first part only
    each = each.withColumns({"vec_id": F.when(once, F.col("vec_id")), "label": F.when(once, F.col("label"))})
    salts = max(LEAST_SALTS, shape["n"] // OWNER_ROWS)
    members = materialize(first_members(each, books, salts), "vectors-members")
    folders: list[str] = []
    for _ in range(rounds):
        books, old = updated(members, books), folders
        members, folders, moved = migrate(members, books)
        for path in old:
            discard(members.sparkSession, path)
        if not moved:
            break
    return members, books


def compress(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str | None = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks | None]:
    """``vec_id``, ``label``, ``code``, ``error`` and ``label_error`` of every usable row, and the codebooks."""
    members, books = learn(df, vec_id, vector, label, parts, entries, rounds)
    if members is None:
        kinds = dict(df.dtypes)
        empty = (f"vec_id {kinds[vec_id]}, label {kinds[label] if label else 'int'}, code string, "
                 "error long, label_error long")
        return df.sparkSession.createDataFrame([], empty), None
    whole = F.sum(F.col("error").cast("decimal(20,0)"))
    digits = [F.lpad(F.lower(F.hex(F.max(F.when(F.col("position") == j, F.col("entry"))).cast("long"))), 2, "0")
              for j in range(parts)]
    coded = reassigned(members, books).groupBy("uid").agg(
        F.max(F.when(F.col("position") == 0, F.struct("vec_id", "label"))).alias("own"),
        F.concat(*digits).alias("code"), F.least(whole, F.lit(LONGEST)).cast("long").alias("error"))
    coded = materialize(coded.select("own.vec_id", "own.label", "code", "error"), "vectors-codes")
    total = F.least(F.sum(F.col("error").cast("decimal(20,0)")), F.lit(LONGEST)).cast("long")
    labels = coded.groupBy(F.col("label").alias("its")).agg(total.alias("label_error"))
    found = coded.join(labels, F.col("label").eqNullSafe(F.col("its"))).drop("its")
    return found.select("vec_id", "label", "code", "error", "label_error"), books
