"""The driver contract in __spark_entry__.py."""

import importlib.util
import os

import duckdb
from conftest import SF001

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs(spark):
    df = _entry().entry(spark)
    assert df.columns == ["type", "id", "delta", "value", "last_seq"]
    assert df.count() > 0


def test_every_query_has_oracle_or_is_rows_only():
    from tallyfold.plans.catalog import QUERIES

    m = _entry()
    qs, sqls = m.queries(), m.oracle_sql()
    assert set(sqls) <= set(qs) and set(QUERIES) <= set(sqls)


def test_oracles_parse_on_smallest_tables():
    con = duckdb.connect()
    for t in ["events", "lineitem", "embeddings", "documents", "conversations"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    for name, sql in _entry().oracle_sql().items():
        con.execute(f"SELECT count(*) FROM ({sql})").fetchone()


def test_checkpoint_root_and_scale_settings(spark):
    from tallyfold.session import checkpoint_root, scale_settings, scratch_path

    root = checkpoint_root(spark)
    assert root and scratch_path(spark, "x").startswith(root.rstrip("/"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert scale_settings(spark, 10 * (256 << 20), min_partitions=4) == 10
        assert spark.conf.get("spark.sql.shuffle.partitions") == "10"
        assert scale_settings(spark, 1, min_partitions=4) == 4
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
