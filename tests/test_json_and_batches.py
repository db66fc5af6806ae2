"""Single JSON updates, batch bodies, gzip, signing."""

import gzip
import hashlib
import hmac
import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyfold.functions.jsoncodec import decode_json, encode_json
from tallyfold.functions.signing import hmac_sha256_hex, sign_rows, verify_signature
from tallyfold.operators import fold, validate
from tallyfold.sources import readers
from tallyfold.sources.store import write_feed


def _bodies(spark, bodies):
    return spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "seq long, body string")


JSON_CASES = [
    # what is wrong, body, status
    ("nothing: counter", '{"type":"counter","delta":-31,"id":"queue_depth"}', 200),
    ("nothing: whole gauge", '{"id":"load","value":8,"type":"gauge"}', 200),
    ("nothing: unknown fields", '{"id":"load","type":"gauge","value":0.125,"unit":"s","tags":[1]}', 200),
    ("cut short", '{"id":"load","type":"gauge","val', 400),
    ("empty body", "", 400),
    ("array", '[{"id":"load","type":"gauge","value":1}]', 400),
    ("number in a text field", '{"id":17,"type":"gauge","value":1}', 400),
    ("text in a number field", '{"id":"load","type":"gauge","value":"8"}', 400),
    ("fraction in a counter", '{"id":"queue_depth","type":"counter","delta":2.5}', 400),
    ("beyond a double", '{"id":"load","type":"gauge","value":-3e999}', 400),
    ("not a JSON number", '{"id":"load","type":"gauge","value":Infinity}', 400),
    ("payload of the other type", '{"id":"load","type":"gauge","delta":4}', 400),
    ("unknown type", '{"id":"load","type":"histogram","value":1}', 501),
    ("no type", '{"id":"load","value":1}', 501),
    ("a repeated key: the last counts", '{"id":"a","type":"gauge","value":1,"id":"b","value":2}', 200),
    ("text after the value", '{"id":"load","type":"gauge","value":6.5}\n{"more":1}', 200),
    ("no id", '{"type":"counter","delta":9}', 200),
]


def test_json_updates(spark):
    df = decode_json(_bodies(spark, [b for _, b, _ in JSON_CASES]))
    judged = validate.validate(df, mode="json")
    got = {JSON_CASES[r.seq][0]: r.status for r in judged.collect()}
    assert got == {name: status for name, _, status in JSON_CASES}
    by = {JSON_CASES[r.seq][0]: r for r in judged.collect()}
    assert (by["a repeated key: the last counts"].id, by["a repeated key: the last counts"].value) == ("b", 2.0)
    assert by["no id"].id == "" and by["no type"].type == ""
    acks = {JSON_CASES[r.seq][0]: json.loads(r.reply) for r in validate.ack(judged).collect()}
    assert acks["nothing: counter"] == {"id": "queue_depth", "type": "counter", "delta": -31}
    assert acks["nothing: whole gauge"] == {"id": "load", "type": "gauge", "value": 8.0}
    assert set(acks) == {name for name, _, status in JSON_CASES if status == 200}


def test_echo_keeps_the_hash(spark):
    df = decode_json(_bodies(spark, ['{"id":"load","type":"gauge","value":2,"hash":"cafe"}']))
    reply = validate.ack(validate.validate(df, mode="json")).first().reply
    assert json.loads(reply) == {"id": "load", "type": "gauge", "value": 2.0, "hash": "cafe"}


ONE = '{"id":"disk","type":"gauge","value":0.75}'
BATCH_CASES = [
    # body, content type, status
    (f"[{ONE},{ONE}]", "application/json", 200),
    (f" [ {ONE} ] ", None, 200),
    (f"[{ONE}]", "", 200),
    (f"[{ONE}]", "application/xml", 415),
    ("[]", "application/json", 400),
    (ONE, "application/json", 400),
    (f"[{ONE}", "application/json", 400),
    (f"[{ONE},7]", "application/json", 400),
    ('[{"id":"hits","type":"counter","delta":"3"}]', "application/json", 400),
    ('[{"id":"hits","type":"counter","delta":3.0}]', "application/json", 400),
    ('[{"id":"hits","type":"counter","delta":18446744073709551616}]', "application/json", 400),
    ('[{"id":"disk","type":"gauge","value":7e321}]', "application/json", 400),
    ('[{"id":{},"type":"gauge","value":1}]', "application/json", 400),
    # rows that are skipped later do not refuse the batch
    (f'[{ONE},{{"id":"disk","type":"summary","value":1}},null]', "application/json", 200),
    ('[{"id":"disk","type":"gauge"}]', "application/json", 200),
]


def test_batch_status_cases(spark):
    df = spark.createDataFrame([(i, b, c) for i, (b, c, _) in enumerate(BATCH_CASES)],
                               "batch_id long, body string, content_type string")
    got = [r.status for r in validate.validate_batches(df).orderBy("batch_id").collect()]
    assert got == [c[2] for c in BATCH_CASES]


def test_batch_body_limit(spark):
    big = "[" + ",".join(['{"id":"a","type":"gauge","value":1.5}'] * 300_000) + "]"
    assert len(big) > 10 * 1024 * 1024
    df = spark.createDataFrame([(1, big)], "batch_id long, body string")
    assert validate.validate_batches(df, content_type=None).first().status == 400


def test_lenient_and_strict_batches(spark):
    upd = spark.createDataFrame([
        (7, 10, "up", "counter", 4, None), (7, 11, "up", None, 1, None), (7, 12, "up", "counter", 6, None),
        (8, 13, "heat", "gauge", None, -1.5), (8, 14, "heat", "gauge", None, 2.5),
        (9, 15, "heat", "gauge", 3, None), (9, 16, "up", "counter", 1, None),
    ], "batch_id long, seq long, id string, type string, delta long, value double")
    assert rows(validate.validate(upd, "batch"), "seq") == [(10,), (12,), (13,), (14,), (16,)]
    strict = validate.validate(upd, "batch_strict")
    assert rows(strict, "seq", "status") == [(10, 400), (13, 200), (14, 200)]
    st = {r.batch_id: (r.status, r.first_bad) for r in validate.batch_status(upd).collect()}
    assert st == {7: (400, 11), 8: (200, None), 9: (400, 15)}


def test_atomic_batches(spark):
    upd = spark.createDataFrame([(3, 1, "up", "counter", 4, None), (4, 2, "up", "counter", 100, None), (5, 3, "up", "counter", -1, None)],
                                "batch_id long, seq long, id string, type string, delta long, value double")
    status = spark.createDataFrame([(3, 200), (4, 415), (5, 200)], "batch_id long, status int")
    assert rows(fold.fold_atomic(upd, status), "id", "delta") == [("up", 3)]


def test_batch_files_gzip(spark, tmp_dir):
    batches = [
        [{"id": "hits", "type": "counter", "delta": 11}, {"id": "disk", "type": "gauge", "value": 0.5}],
        [{"id": "disk", "type": "gauge", "value": 0.25}, {"id": "disk", "type": "gauge", "value": 0.625}, {"type": "counter", "delta": 2}],
    ]
    for i, rows_ in enumerate(batches):
        with gzip.open(os.path.join(tmp_dir, f"{i}.json.gz"), "wt") as f:
            json.dump(rows_, f, indent=1)
    df = readers.read_metric_batch(spark, tmp_dir)
    assert df.count() == 5
    # Files are batches in name order; within a file, array order.  A row without an id has the empty one.
    numbered = df.withColumn("batch", F.regexp_extract("batch_id", r"(\d+)\.json", 1).cast("long"))
    assert rows(fold.fold_batches(numbered, "batch"), "id", "delta", "value") == [
        ("", 2, None), ("disk", None, 0.625), ("hits", 11, None)]


def test_feed_gzip_roundtrip(spark, tmp_dir):
    upd = spark.createDataFrame([("disk", "gauge", None, 1e-7, "ab"), ("hits", "counter", 3, None, None)],
                                "id string, type string, delta long, value double, hash string")
    write_feed(upd, f"{tmp_dir}/feed")
    assert all(n.endswith(".json.gz") for n in os.listdir(f"{tmp_dir}/feed") if n.startswith("part"))
    back = readers.read_metric_feed(spark, f"{tmp_dir}/feed").cache()
    cols = ("id", "type", "delta", "value", "hash")
    assert rows(back, *cols) == rows(upd, *cols) and back.where("_corrupt_record is not null").count() == 0


def test_update_path_and_request_files(spark, tmp_dir):
    with open(f"{tmp_dir}/paths.txt", "w") as f:
        f.write("/update/gauge/a/1.5\n/update/counter/b/2\n/update/x\n")
    p = readers.read_update_paths(spark, f"{tmp_dir}/paths.txt")
    assert rows(p, "type", "id", "text") == sorted([("gauge", "a", "1.5"), ("counter", "b", "2"), (None, None, None)], key=repr)
    with open(f"{tmp_dir}/req.json", "w") as f:
        f.write('{"id":"a","type":"gauge"}\n')
    assert rows(readers.read_value_requests(spark, f"{tmp_dir}/req.json"), "id", "type") == [("a", "gauge")]


@pytest.mark.parametrize("key", ["k", "secret", "x" * 64, "y" * 100, "ключ"])
def test_hmac_matches_python(spark, key):
    texts = ["", "hello", '{"id":"a","type":"gauge","value":1.5}\n', "ünïcödé"]
    df = spark.createDataFrame([(t,) for t in texts], "body string")
    got = {r.body: r.sig for r in df.select("body", hmac_sha256_hex("body", key).alias("sig")).collect()}
    for t in texts:
        assert got[t] == hmac.new(key.encode(), t.encode(), hashlib.sha256).hexdigest()


def test_sign_and_verify(spark):
    upd = spark.createDataFrame([("disk", "gauge", None, 0.75)], "id string, type string, delta long, value double")
    signed = sign_rows(upd, "pepper").first()
    assert signed.body == '{"id":"disk","type":"gauge","value":0.75}\n'
    assert signed.signature == hmac.new(b"pepper", signed.body.encode(), hashlib.sha256).hexdigest()
    assert sign_rows(upd, None).first().signature is None
    good = hmac.new(b"pepper", b"body", hashlib.sha256).hexdigest()
    df = spark.createDataFrame([("body", s) for s in (good, good[:-1] + "0" + "1", good.upper(), "", None)], "body string, sig string")
    assert [r.s for r in df.select(verify_signature("body", "sig", "pepper").alias("s")).collect()] == [200, 400, 400, 200, 200]
    assert {r.s for r in df.select(verify_signature("body", "sig", None).alias("s")).collect()} == {200}


def test_encode_json_drops_nulls(spark):
    df = spark.createDataFrame([("hits", "counter", 0, None)], "id string, type string, delta long, value double")
    assert df.select(encode_json().alias("j")).first().j == '{"id":"hits","type":"counter","delta":0}'


def test_batch_ack_and_observed_outcomes(spark):
    from pyspark.sql import Observation

    df = _bodies(spark, ['[{"id":"a","type":"gauge","value":1}]', "[]"])
    acks = validate.batch_ack(validate.validate_batches(df, content_type=None)).collect()
    assert [(r.seq, r.reply) for r in acks] == [(0, '{"status":"ok"}')]
    judged = validate.validate(decode_json(_bodies(spark, [
        '{"id":"g","type":"gauge","value":1.5}', '{"id":"g","type":"gauge"}', '{"id":"x","type":"y"}'])), "json")
    obs = Observation("outcomes")
    judged.observe(obs, F.count(F.lit(1)).alias("n")).collect()
    assert obs.get["n"] == 3
    observed = fold.observe_outcomes(judged, "o")
    assert observed.count() == 3


def test_json_lookup_requests_decode(spark):
    from tallyfold.operators import lookup
    from tallyfold.schema import VALUE_REQUEST

    upd = spark.createDataFrame([(1, "heat", "gauge", None, -4.0), (2, "", "counter", 6, None)],
                                "seq long, id string, type string, delta long, value double")
    req = decode_json(_bodies(spark, ["{oops", '{"type":"gauge","id":"heat"}', '{"type":"counter"}', '{"id":"heat","type":"set"}']),
                      schema=VALUE_REQUEST)
    got = [(r.status, r.delta, r.value) for r in lookup.lookup(req, fold.fold(upd)).orderBy("seq").collect()]
    assert got == [(400, None, None), (200, None, -4.0), (200, 6, None), (501, None, None)]


def test_streaming_feed_reader(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/a.json", "w") as f:
        f.write('{"id":"c","type":"counter","delta":2}\n{bad\n{"id":"c","type":"counter","delta":3}\n')
    src = readers.read_metric_feed(spark, f"{tmp_dir}/in", streaming=True)
    assert src.isStreaming
    q = (src.writeStream.format("parquet").option("path", f"{tmp_dir}/out")
         .option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    out = spark.read.parquet(f"{tmp_dir}/out")
    assert out.where("_corrupt_record IS NOT NULL").count() == 1
    assert out.where("delta IS NOT NULL").agg(F.sum("delta")).first()[0] == 5
