"""Writing and restoring state: snapshots, the state table, feed files.

A state version is written into its own directory and only then named
current, so a reader never sees half a snapshot and a re-run of the same
version overwrites it (idempotent under task or job retry).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyfold.functions.jsoncodec import decoded_field, encode_json, parse_object
from tallyfold.schema import COUNTER, GAUGE, SNAPSHOT, STATE, STATE_COLS
from tallyfold.sources.arrays import read_json_arrays

VERSION_PREFIX = "v="


def write_feed(df: DataFrame, path: str, compression: str | None = "gzip", fmt: str = "json") -> None:
    """Write updates as JSON lines (gzip by default) or another format."""
    w = df.write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    w.format(fmt).save(path)


def write_snapshot(state: DataFrame, path: str, fmt: str = "parquet", files: int = 8) -> None:
    """Replace the snapshot at ``path`` with ``state``.

    ``fmt='json'`` writes the reference's record shape (``id, type, delta,
    value``) as JSON lines, ``json_array`` as JSON arrays, ``files`` of them by a
    hash of the key, so that no task writes all of a large state; Parquet keeps
    ``last_seq`` too."""
    if fmt == "json":
        state.select("id", "type", "delta", "value").write.mode("overwrite").json(path)
    elif fmt == "json_array":
        write_json_arrays(state.select("type", "id", F.lit(0).alias("rank"), encode_json().alias("record")), path, files)
    else:
        state.select(*STATE_COLS).write.mode("overwrite").format(fmt).save(path)


def write_json_arrays(records: DataFrame, path: str, files: int) -> None:
    """``record`` texts as JSON arrays: those of a key (``type``, ``id``) in one array, by ``rank``."""
    part = F.pmod(F.xxhash64("type", "id"), F.lit(files))
    order = W.partitionBy("_part").orderBy("type", "id", "rank")
    lines = records.withColumn("_part", part).select(
        F.concat(F.when(F.row_number().over(order) == 1, F.lit("[")).otherwise(F.lit("")), F.col("record"),
                 F.when(F.lead("rank").over(order).isNull(), F.lit("]")).otherwise(F.lit(","))).alias("value"))
    lines.write.mode("overwrite").text(path)


def _path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def restore_snapshot(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Snapshot -> state.

    A missing snapshot is an empty state.  Rows without payload and unknown
    types are skipped; when a key occurs more than once the last row wins for
    both types (restore assigns, it does not add).  Rows without ``last_seq``
    get -1, older than any update."""
    if not _path_exists(spark, path):
        return spark.createDataFrame([], STATE)
    if fmt == "json_array":
        # JSON arrays (the reference's snapshot file): each file is cut into blocks for many tasks.
        entries = read_json_arrays(spark, path).withColumn("_entries", parse_object(F.col("record")))
        raw = entries.select(*[decoded_field(F.col("_entries"), c).alias(c) for c in ("id", "type", "delta", "value")],
                             F.lit(-1).cast("bigint").alias("last_seq"), F.col("file").alias("_f"), F.col("pos").alias("_r"))
    elif fmt == "json":
        raw = spark.read.schema(SNAPSHOT).json(path).withColumn("last_seq", F.lit(-1).cast("bigint"))
    else:
        raw = spark.read.format(fmt).load(path)
        if "last_seq" not in raw.columns:
            raw = raw.withColumn("last_seq", F.lit(-1).cast("bigint"))
    t = F.col("type")
    ok = ((t == GAUGE) & F.col("value").isNotNull()) | ((t == COUNTER) & F.col("delta").isNotNull())
    # File order, then row order, is the order of duplicates.  The newest row of
    # a key in each file comes from a hash aggregate over fixed-width buffers;
    # only one row per key and file is compared by file name.
    placed = raw if "_f" in raw.columns else raw.select("*", F.input_file_name().alias("_f"), F.monotonically_increasing_id().alias("_r"))
    tagged = placed.where(ok)
    at = F.col("_r")
    per_file = tagged.groupBy("type", "id", "_f").agg(
        F.max_by("delta", at).alias("delta"), F.max_by("value", at).alias("value"), F.max_by("last_seq", at).alias("last_seq"))
    newest = per_file.groupBy("type", "id").agg(*[F.max_by(c, "_f").alias(c) for c in ("delta", "value", "last_seq")])
    return newest.select(
        "type", "id", F.when(F.col("type") == COUNTER, F.col("delta")).alias("delta"),
        F.when(F.col("type") == GAUGE, F.col("value")).alias("value"), "last_seq")


def write_metric_tables(state: DataFrame, root: str) -> None:
    """Store state as the reference's two tables: ``gauge_metrics(name,
    value)`` and ``counter_metrics(name, value)`` under ``root``."""
    t = F.col("type")
    state.where(t == GAUGE).select(F.col("id").alias("name"), F.col("value")).write.mode("overwrite").parquet(
        f"{root.rstrip('/')}/gauge_metrics"
    )
    state.where(t == COUNTER).select(F.col("id").alias("name"), F.col("delta").alias("value")).write.mode(
        "overwrite"
    ).parquet(f"{root.rstrip('/')}/counter_metrics")


def read_metric_tables(spark: SparkSession, root: str) -> DataFrame:
    """Scan the two metric tables back into one state table (``last_seq``
    is unknown there: -1).  Reading the same two tables over JDBC is the same
    plan with ``spark.read.jdbc``."""
    r = root.rstrip("/")
    g = spark.read.parquet(f"{r}/gauge_metrics").select(
        F.lit(GAUGE).alias("type"), F.col("name").alias("id"), F.lit(None).cast("bigint").alias("delta"),
        F.col("value").cast("double").alias("value"), F.lit(-1).cast("bigint").alias("last_seq"),
    )
    c = spark.read.parquet(f"{r}/counter_metrics").select(
        F.lit(COUNTER).alias("type"), F.col("name").alias("id"), F.col("value").cast("bigint").alias("delta"),
        F.lit(None).cast("double").alias("value"), F.lit(-1).cast("bigint").alias("last_seq"),
    )
    return g.unionByName(c)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The stored state table (Parquet, partitioned by ``type``)."""
    return spark.read.parquet(path)


def write_state(state: DataFrame, path: str, ids_per_file: int = 1_000_000, group_bytes: int = 16 << 20) -> None:
    """Store state partitioned by ``type`` and sorted by ``id`` within files, so
    lookups prune partitions and skip row groups by their bounds and pages by the
    page index.  Each row group of ``group_bytes`` carries a Bloom filter of its
    ids (for up to ``ids_per_file`` of them), so that a lookup of an id that is not
    there reads no row group at all, but for a false hit in a hundred."""
    (
        state.select(*STATE_COLS)
        .repartition("type", "id")
        .sortWithinPartitions("type", "id")  # the writer's own sort on the partition column is then met
        .write.mode("overwrite")
        .option("parquet.bloom.filter.enabled#id", "true")
        .option("parquet.bloom.filter.expected.ndv#id", str(ids_per_file))
        .option("parquet.bloom.filter.adaptive.enabled", "true")  # no larger than the ids ask for
        .option("parquet.block.size", str(group_bytes))
        .partitionBy("type")
        .parquet(path)
    )


def save_state_table(state: DataFrame, name: str, buckets: int, path: str | None = None) -> None:
    """Store state as a table bucketed and sorted by ``(type, id)``.

    Joins and aggregates on ``(type, id)`` then read it without an exchange:
    :func:`tallyfold.operators.fold.merge_state_join` shuffles only the new
    batch (into the same ``buckets`` partitions when
    ``spark.sql.shuffle.partitions`` equals ``buckets``), not the state."""
    w = state.select(*STATE_COLS).write.mode("overwrite").bucketBy(buckets, "type", "id").sortBy("type", "id")
    if path:
        w = w.option("path", path)
    w.format("parquet").saveAsTable(name)


def create_state(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the state table if it does not exist."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (id STRING, delta BIGINT, value DOUBLE, last_seq BIGINT, type STRING)"
        f" USING parquet PARTITIONED BY (type){loc}"
    )


def drop_state(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


# ---------------------------------------------------------------- versions


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def version_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/{VERSION_PREFIX}{version:012d}"


def committed_versions(spark: SparkSession, root: str, above: int | None = None, below: int | None = None) -> list[int]:
    """Committed version numbers (those with ``_SUCCESS``) under ``root``,
    ascending.  Lists one directory, which pruning keeps short; no data passes
    through the driver."""
    if not _path_exists(spark, root):
        return []
    fs, hroot = _fs(spark, root)
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    out = []
    for st in fs.listStatus(hroot):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(VERSION_PREFIX):
            n = int(name[len(VERSION_PREFIX):])
            inside = (above is None or n > above) and (below is None or n < below)
            if inside and fs.exists(jpath(st.getPath(), "_SUCCESS")):
                out.append(n)
    return sorted(out)


def latest_version(spark: SparkSession, root: str, below: int | None = None) -> int | None:
    """Highest committed version under ``root``, optionally only among those lower than ``below``."""
    found = committed_versions(spark, root, below=below)
    return found[-1] if found else None


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """State at ``version`` (default: the latest committed); empty if none."""
    v = latest_version(spark, root) if version is None else version
    if v is None or not _path_exists(spark, version_path(root, v)):
        return spark.createDataFrame([], STATE)
    return spark.read.schema(STATE).parquet(version_path(root, v))


def prune_versions(spark: SparkSession, root: str, keep: int = 3, below: int | None = None) -> None:
    """Delete all but the newest ``keep`` committed versions under ``root``
    (with ``below``: all versions below it).  A replayed micro-batch needs the
    version before its own, so at least two must stay."""
    versions = committed_versions(spark, root)
    old = [v for v in versions if v < below] if below is not None else versions[: -max(2, keep)]
    fs, _ = _fs(spark, root)
    for v in old:
        fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(version_path(root, v)), True)


def publish_snapshot(state: DataFrame, root: str, version: int | None = None) -> int:
    """Replace the snapshot under ``root`` atomically: the state is written
    into a new version directory, which counts only once its ``_SUCCESS``
    marker exists, so a reader (:func:`restore_latest`) sees the old or the
    new snapshot, never half of one.  Re-publishing the same ``version``
    (a retried job) overwrites it.  Returns the version written."""
    spark = state.sparkSession
    if version is None:
        last = latest_version(spark, root)
        version = 0 if last is None else last + 1
    state.select(*STATE_COLS).write.mode("overwrite").parquet(version_path(root, version))
    return version


def restore_latest(spark: SparkSession, root: str) -> DataFrame:
    """The newest complete snapshot under ``root``; empty state if none."""
    return read_version(spark, root)
