"""JSON arrays read in blocks; object keys in any case and repeated; what is read of a body."""

import json
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyfold.functions.jsoncodec import decode_json
from tallyfold.operators import validate
from tallyfold.sources import arrays, readers, store


@pytest.fixture()
def small_blocks(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def awkward(rnd, n):
    names = ["x", "}", '{"', "\\", 'a\\"}b', "é}", "[", "]", '"', "\\\\", ""]
    nested = [None, {"k": [1, {"z": "}"}]}, [{}], "}{", {"}": {"]": "["}}]
    return [{"id": f"{rnd.choice(names)}{i}", "type": "gauge", "value": float(i), "more": rnd.choice(nested)} for i in range(n)]


def test_array_records_are_found_in_any_block(spark, tmp_path, small_blocks):
    rnd = random.Random(1)
    want = {"a.json": awkward(rnd, 400), "b.json": awkward(rnd, 300), "c.json": [], "d.json": awkward(rnd, 1)}
    for name, records in want.items():
        (tmp_path / name).write_text(json.dumps(records, indent=2 if name == "b.json" else None, ensure_ascii=name == "a.json"))
    (tmp_path / "e.json").write_text('[{"id":"q"}, 5, null, {"id":"r","x":{"y":1}}, {"id":"cut')
    found = arrays.read_json_arrays(spark, str(tmp_path))
    got = {}
    for r in sorted(found.collect(), key=lambda r: (r["file"], r["pos"])):
        got.setdefault(r["file"].rsplit("/", 1)[1], []).append(json.loads(r["record"]))
    assert got == {k: v for k, v in want.items() if v} | {"e.json": [{"id": "q"}, {"id": "r", "x": {"y": 1}}]}
    assert arrays.fragments(spark, str(tmp_path)).select(F.spark_partition_id()).distinct().count() > 8
    fed = readers.read_metric_batch(spark, f"{tmp_path}/a.json", whole=False).orderBy("pos").collect()
    assert [(r["pos"], r["id"], r["value"]) for r in fed] == [(i, x["id"], x["value"]) for i, x in enumerate(want["a.json"])]


def test_restore_of_arrays_takes_the_last_of_a_key(spark, tmp_path, small_blocks):
    records = [{"id": f"m{i % 50}", "type": "counter", "delta": i} for i in range(300)]
    records += [{"ID": "m1", "Type": "gauge", "VALUE": 2.5}, {"id": "m2", "type": "counter"}, {"id": "m3", "type": "none", "delta": 1}]
    (tmp_path / "snapshot.json").write_text(json.dumps(records))
    got = rows(store.restore_snapshot(spark, str(tmp_path), fmt="json_array"), "type", "id", "delta", "value", "last_seq")
    assert got == sorted([("counter", f"m{i}", 250 + i, None, -1) for i in range(50)] + [("gauge", "m1", None, 2.5, -1)], key=repr)


def test_array_snapshots_round_trip(spark, tmp_path):
    state = spark.createDataFrame([("counter", f"c}}{i}", i, None, 5) for i in range(40)] + [("gauge", "g", None, 0.1, 6)],
                                  "type string, id string, delta long, value double, last_seq long")
    store.write_snapshot(state, f"{tmp_path}/s", fmt="json_array", files=3)
    back = store.restore_snapshot(spark, f"{tmp_path}/s", fmt="json_array")
    cols = ("type", "id", "delta", "value")
    assert rows(back, *cols) == rows(state, *cols)
    store.write_snapshot(state.limit(0), f"{tmp_path}/none", fmt="json_array")
    assert store.restore_snapshot(spark, f"{tmp_path}/none", fmt="json_array").count() == 0


BODIES = [
    ('{"ID":"a","TYPE":"gauge","VALUE":1}', (True, "a", "gauge", None, 1.0)),
    ('{"id":"a","Id":"b","id":null,"type":"counter","delta":1,"DELTA":2}', (True, "b", "counter", 2, None)),
    ('{"id":"a","type":"counter","delta":1,"delta":null}', (True, "a", "counter", None, None)),
    ('{"id":"a","type":"counter","delta":1.0,"delta":2}', (False,)),
    ('{"id":5,"id":"a","type":"counter","delta":2}', (False,)),
    ('{"id":"a","type":"gauge","value":1,"Value":1e400}', (False,)),
    ('{"id":"a","type":"counter","delta":9223372036854775808}', (False,)),
    ('{"id":"a","type":"gauge","value":9223372036854775808}', (True, "a", "gauge", None, 2.0**63)),
    ('{"id":"a","type":"gauge","value":NaN}', (False,)),
    ('{"id":"a","type":"gauge","value":2} and more }', (True, "a", "gauge", None, 2.0)),
    ('{"id":"a","type":"gauge","value":2', (False,)),
    (" null ", (True, "", "", None, None)), ("5", (False,)), ("", (False,)), ("[]", (False,)), (None, (False,)), ("{}", (True, "", "", None, None)),
]


def test_keys_in_any_case_and_the_last_of_repeated_ones(spark):
    df = spark.createDataFrame([(i, b) for i, (b, _) in enumerate(BODIES)], "n int, body string")
    for r in decode_json(df).collect():
        body, want = BODIES[r["n"]]
        got = (r["decoded"], r["id"], r["type"], r["delta"], r["value"])
        assert got[:1] == want if len(want) == 1 else got == want, body


def test_batches_with_such_bodies(spark):
    good = [b for b, w in BODIES if w[0] and not b.endswith("more }")]
    bad = [b for b, w in BODIES if not w[0] and b]
    pad = " " * (10 * 1024 * 1024)
    cases = [("[" + ",".join(good) + "] tail", 200), *[(f"[{good[0]},{b}]", 400) for b in bad if b not in ("5",)], ("[5]", 400),
             ('["{}"]', 400), ("[null]", 200), ("[]", 400), ("{}", 400), ("", 400), (f"[{good[0]}]{pad}x", 200), (f"[{pad}{good[0]}]", 400),
             (f"[{good[0]}]é{pad}", 200)]
    df = spark.createDataFrame([(i, b) for i, (b, _) in enumerate(cases)], "n int, body string")
    judged = validate.validate_batches(df, content_type=None, keep_parsed=True)
    for r in judged.select("n", "status").collect():
        assert r["status"] == cases[r["n"]][1], cases[r["n"]][0][:80]
    first = readers.decode_parsed_batches(judged.where("n = 0"), "parsed").orderBy("pos").collect()
    want = [w for b, w in BODIES if b in good]
    assert [(r["id"], r["type"], r["delta"], r["value"]) for r in first] == [w[1:] for w in want]
