"""The pipeline and the registered queries."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

import corpus_pipeline  # noqa: E402
from tallyfold.llm import decontaminate, simhash  # noqa: E402
from tallyfold.llm.queries import QUERIES  # noqa: E402
from tallyfold.llm.sql import ORACLES  # noqa: E402

from .conftest import to_frame  # noqa: E402


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, docs, rows):
    at = str(tmp_path_factory.mktemp("corpus"))
    leak = rows[9][1]
    docs.write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    spark.createDataFrame([(10, 1, 0), (11, 1, 0), (5, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(i, [i / 10.0] * 4, None) for i in range(9)], "vec_id long, embedding array<float>, label int").write.parquet(f"{at}/embeddings.parquet")
    spark.createDataFrame([(1, 0, "user", "Why?"), (1, 1, "assistant", None), (None, None, None, None)],
                          "conv_id long, turn long, role string, text string").write.parquet(f"{at}/conversations.parquet")
    return at


def test_names():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == sorted({int(n[2:].split("_")[0]) for n in QUERIES})
    assert set(ORACLES) <= set(QUERIES) and [n for n, _ in corpus_pipeline.STAGES][0] == "quality rules"


def test_stages(spark, folder, docs, rows):
    leak = decontaminate.normal(rows[9][1])
    columns = docs.columns
    now = spark.read.parquet(f"{folder}/documents.parquet")
    sizes = [now.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        now = stage(spark, now, folder).cache()
        sizes.append(now.count())
        if i < 4:
            assert now.columns == columns
        if i == 0:
            assert all(len((r["text"] or "").split()) >= 10 for r in now.collect())
        if i == 1:
            fps = [simhash.fingerprint(r["text"]) for r in now.collect()]
            assert all((a ^ b).bit_count() > 2 for j, a in enumerate(fps) for b in fps[:j])
        if i == 2:
            assert not any(leak in decontaminate.normal(r["text"]) for r in now.collect())
        if i == 3:
            assert all(1 <= r["count"] <= 2 for r in now.groupBy("doc_id", "text").count().collect())
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] > 0 and sizes[4] == sizes[5]
    for s in {r["shard"] for r in now.collect()}:
        slots = sorted(r["slot"] for r in now.where(f"shard = {s}").collect())
        assert slots == list(range(len(slots)))
    assert corpus_pipeline.run(spark, folder).count() == sizes[5]


def test_empty_tables(spark, tmp_path):
    at = str(tmp_path)
    to_frame(spark, []).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{at}/embeddings.parquet")
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{at}/conversations.parquet")
    assert corpus_pipeline.run(spark, at).count() == 0
    for name, query in QUERIES.items():
        assert query(spark, at).count() == 0, name


def test_queries_run_on_awkward_documents(spark, folder, rows):
    for name, query in QUERIES.items():
        found = query(spark, folder)
        if name.startswith(("op12", "op13")):
            assert found.count() == (2 if name.startswith("op12") else 9), name
            continue
        assert "doc_id" in found.columns and found.count() == (len(rows) if not name.startswith("op3") else found.count()), name
