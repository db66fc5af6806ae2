"""State versions that share what did not change.

A state is cut into hash buckets of its key.  A version is a manifest, one row per
bucket: the version whose files hold the bucket, its number of rows and a digest
of them.  A new version writes the changed buckets only:

* :func:`publish` (a full state, a snapshot) compares digests with the version before;
* :func:`merge` (a batch of updates) reads and writes the buckets that the batch touches.

    root/data/v=<version>/bucket=<b>/...    rows of a bucket
    root/manifest/v=<version>/...           what the version consists of

The manifest is written last and counts once it is complete, so a reader sees the
old or the new version.  Writing a version again (a replayed micro-batch) starts
from the newest version below it and overwrites its own files only.  The number of
buckets is fixed with the first version; it bounds the manifest, which is all that
passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.operators import fold
from tallyfold.schema import KEY, STATE, STATE_COLS
from tallyfold.sources.store import _fs, committed_versions, latest_version, version_path

BUCKETS = 256
MANIFEST = "bucket int, holder bigint, buckets int, n bigint, d1 bigint, d2 bigint"
Manifest = dict[int, dict]


def bucket_of(buckets: int):
    return F.pmod(F.xxhash64(*KEY), F.lit(buckets)).cast("int")


def manifest(spark: SparkSession, root: str, version: int | None) -> Manifest:
    """Bucket -> its row of the manifest; at most one per bucket."""
    if version is None:
        return {}
    rows = spark.read.schema(MANIFEST).parquet(version_path(f"{root}/manifest", version)).collect()
    return {r["bucket"]: r.asDict() for r in rows}


def _rows(spark: SparkSession, root: str, held: Manifest) -> DataFrame:
    paths = [f"{version_path(f'{root}/data', m['holder'])}/bucket={b}" for b, m in held.items() if m["n"]]
    return spark.read.schema(STATE).parquet(*paths) if paths else spark.createDataFrame([], STATE)


def read(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """State at ``version`` (the latest by default); empty if there is none."""
    root = root.rstrip("/")
    at = latest_version(spark, f"{root}/manifest") if version is None else version
    return _rows(spark, root, manifest(spark, root, at))


def _digests(rows: DataFrame) -> DataFrame:
    """Rows and a 128-bit digest per bucket, whatever the order of the rows."""
    cols = [F.col(c) for c in STATE_COLS]
    return rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*cols)).alias("d1"),
                                      F.sum(F.xxhash64(F.lit("row"), *cols).cast("decimal(38,0)")).alias("s")).select(
        "bucket", "n", "d1", F.pmod(F.col("s"), F.lit(str(2**63)).cast("decimal(38,0)")).cast("bigint").alias("d2"))


def _commit(spark: SparkSession, root: str, version: int, held: Manifest, buckets: int, keep: int) -> None:
    rows = [(b, m["holder"], buckets, m["n"], m["d1"], m["d2"]) for b, m in sorted(held.items())]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(version_path(f"{root}/manifest", version))
    prune(spark, root, keep)


def _write(tagged: DataFrame, root: str, version: int) -> None:
    tagged.select("bucket", *STATE_COLS).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(
        version_path(f"{root}/data", version))


def publish(state: DataFrame, root: str, version: int, buckets: int = BUCKETS, keep: int = 3) -> int:
    """Write ``state`` as ``version``; returns how many buckets were written.

    ``state`` is read twice, for the digests and for the changed buckets."""
    spark, root = state.sparkSession, root.rstrip("/")
    before = manifest(spark, root, latest_version(spark, f"{root}/manifest", below=version))
    buckets = next(iter(before.values()))["buckets"] if before else buckets
    tagged = state.select(*STATE_COLS).withColumn("bucket", bucket_of(buckets))
    now = {r["bucket"]: r.asDict() for r in _digests(tagged).collect()}
    same = {b for b, m in now.items() if b in before and all(m[c] == before[b][c] for c in ("n", "d1", "d2"))}
    changed = sorted(now.keys() - same)
    if changed:
        _write(tagged.where(F.col("bucket").isin(changed)), root, version)
    held = {b: m | {"holder": before[b]["holder"] if b in same else version} for b, m in now.items()}
    _commit(spark, root, version, held, buckets, keep)
    return len(changed)


def merge(batch: DataFrame, root: str, version: int, initial: DataFrame | None = None, buckets: int = BUCKETS, keep: int = 3) -> int:
    """Merge updates into the version before ``version``; returns how many buckets
    were read and written.  ``initial`` is the state before the first version."""
    spark, root = batch.sparkSession, root.rstrip("/")
    last = latest_version(spark, f"{root}/manifest", below=version)
    if last is None and initial is not None:
        whole = fold.merge_state(initial, batch.select("seq", *KEY, "delta", "value"))
        return publish(whole, root, version, buckets, keep)
    before = manifest(spark, root, last)
    buckets = next(iter(before.values()))["buckets"] if before else buckets
    updates = fold.fold(batch.select("seq", *KEY, "delta", "value")).withColumn("bucket", bucket_of(buckets))
    touched = sorted(r["bucket"] for r in updates.select("bucket").distinct().collect())
    held = dict(before)
    if touched:
        base = _rows(spark, root, {b: before[b] for b in touched if b in before})
        merged = fold.merge_state(base, fold.state_as_updates(updates)).withColumn("bucket", bucket_of(buckets))
        _write(merged, root, version)
        written = spark.read.schema(f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in STATE)}, bucket int").parquet(
            version_path(f"{root}/data", version))
        held |= {r["bucket"]: r.asDict() | {"holder": version} for r in _digests(written).collect()}
    _commit(spark, root, version, held, buckets, keep)
    return len(touched)


def prune(spark: SparkSession, root: str, keep: int = 3) -> None:
    """Remove old manifests and the bucket files that no kept version consists of."""
    versions = committed_versions(spark, f"{root}/manifest")
    kept = versions[-max(2, keep):]
    used = {(m["holder"], b) for v in kept for b, m in manifest(spark, root, v).items()}
    fs, _ = _fs(spark, root)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for v in versions[: -max(2, keep)]:
        fs.delete(hadoop.Path(version_path(f"{root}/manifest", v)), True)
    for v in committed_versions(spark, f"{root}/data", below=kept[-1] if kept else None):
        path = hadoop.Path(version_path(f"{root}/data", v))
        parts = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith("bucket=")]
        gone = [p for p in parts if (v, int(p.getName()[len("bucket="):])) not in used]
        for p in [path] if len(gone) == len(parts) else gone:
            fs.delete(p, True)
