"""The batch ingest flow: signatures, whole-batch checks, order, merge."""

import hashlib
import hmac
import json

from conftest import rows

from tallyfold.operators import fold
from tallyfold.operators.ingest import ingest_batches


def _sig(key, body):
    return hmac.new(key.encode(), body.encode(), hashlib.sha256).hexdigest()


def test_ingest_batches(spark):
    key = "k"
    b0 = json.dumps([{"id": "g", "type": "gauge", "value": 1.0}, {"id": "c", "type": "counter", "delta": 2}])
    b1 = json.dumps([{"id": "g", "type": "gauge", "value": 3.0}, {"id": "x", "type": "other", "value": 9.0},
                     {"id": "c", "type": "counter", "delta": 5}])
    b2 = json.dumps([{"id": "c", "type": "counter", "delta": 100}])  # tampered below
    b3 = "[]"
    b4 = json.dumps([{"id": "g", "type": "gauge", "value": 7.0}])  # no signature sent: accepted
    reqs = spark.createDataFrame(
        [(0, b0, _sig(key, b0), "application/json"), (1, b1, _sig(key, b1), None),
         (2, b2, _sig(key, b2 + " "), "application/json"), (3, b3, _sig(key, b3), "application/json"),
         (4, b4, None, "application/json")],
        "batch_seq long, body string, signature string, content_type string")
    statuses, state = ingest_batches(reqs, key=key)
    assert rows(statuses, "batch_seq", "status") == [(0, 200), (1, 200), (2, 400), (3, 400), (4, 200)]
    assert rows(state, "type", "id", "delta", "value") == [("counter", "c", 7, None), ("gauge", "g", None, 7.0)]
    # Merging into existing state adds counters and keeps newer gauges.
    old = fold.fold(spark.createDataFrame([(-1, "c", "counter", 10, None)],
                                          "seq long, id string, type string, delta long, value double"))
    _, merged = ingest_batches(reqs, state=old, key=key)
    assert rows(merged, "type", "id", "delta") == [("counter", "c", 17), ("gauge", "g", None)]
