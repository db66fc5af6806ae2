"""Vector codes against a plain version with Python integers."""

import hashlib
import math
import random

import pytest

from tallyfold.llm import vectors

SCHEMA = "vec_id long, embedding array<double>, label int, uid string, entry string, moved string, position string, code string"


def plain(rows, parts=4, entries=256, rounds=4):
    """(vec_id, code, error, label_error) of every usable row, and the digest of the codebooks."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = -(-max((len(r[1]) for r in rows), default=0) // parts)
    ints = [[math.floor(x * 1024) if abs(x) < 1e15 else int(x) * 1024 for x in r[1]] for r in rows]
    ints = [v + [0] * (width * parts - len(v)) for v in ints]
    first = {}
    for (i, x, *_), v in zip(rows, ints, strict=True):
        if i not in first or tuple(x) < first[i][0]:
            first[i] = (tuple(x), v)
    seeds = [first[i][1] for i in sorted(first, key=lambda i: (i is None, i or 0))[:entries]]
    codes, errors, flat = [""] * len(rows), [0] * len(rows), []
    for j in range(parts):
        cut = [v[j * width:(j + 1) * width] for v in ints]
        book = [list(v[j * width:(j + 1) * width]) for v in seeds]

        def assign(cut=cut, book=book):
            return [min((sum((a - b) ** 2 for a, b in zip(p, c, strict=True)), k) for k, c in enumerate(book)) for p in cut]

        for _ in range(rounds):
            found = assign()
            for k in range(len(book)):
                mine = [p for p, (_, e) in zip(cut, found, strict=True) if e == k]
                if mine:
                    book[k] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
        for n, (d, k) in enumerate(assign()):
            codes[n] += f"{k:02x}"
            errors[n] += d
        flat += [x for c in book for x in c]
    total = {}
    for r, e in zip(rows, errors, strict=True):
        total[r[2]] = total.get(r[2], 0) + e
    top = vectors.LONGEST
    out = [(r[0], c, min(e, top), min(total[r[2]], top)) for r, c, e in zip(rows, codes, errors, strict=True)]
    return out, hashlib.sha256(",".join(map(str, flat)).encode()).hexdigest()


def key(r):
    return tuple((x is not None, x) for x in r)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "u", "e", "m", "p", "c") for r in rows], SCHEMA)


def check(spark, rows, **more):
    found, books = vectors.compress(frame(spark, rows).repartition(3), **more)
    got = [(r["vec_id"], r["code"], r["error"], r["label_error"]) for r in found.collect()]
    want, digest = plain(rows, **more)
    assert sorted(got, key=key) == sorted(want, key=key) and books.sha256() == digest
    return books


def cloud(n, width, seed=3):
    rnd = random.Random(seed)
    return [(i * 7 % 1000, [rnd.gauss(0, 0.3) for _ in range(width)], rnd.choice([None, 1, 2])) for i in range(n)]


def test_equals_the_plain_version(spark):
    rows = cloud(150, 8)
    books = check(spark, rows, entries=9)
    assert len(books.books) == 4 and len(books.decode("00010203")) == 8
    check(spark, rows, entries=5, rounds=1)


def test_nulls_lengths_ties_copies_and_wide_numbers(spark):
    rows = cloud(30, 8) + [
        (900, None, 1), (901, [1.0, None] * 4, 1), (902, [float("nan")] * 8, 1), (903, [float("inf")] * 8, 1),
        (904, [], 1), (905, [0.5], None), (906, [0.25] * 10, 3), (None, [0.1] * 8, 3), (None, [0.1] * 8, 3),
        (5, [1e6] * 8, 2), (6, [3e38, -3e38] + [0.0] * 6, 2), (7, [-(2.0**52)] * 8, 2), (8, [-0.0001] * 8, 2),
    ] + [(907, [0.5] * 8, 4)] * 20 + [(910 + i, [0.5] * 8, None) for i in range(20)]
    check(spark, rows, entries=6)
    check(spark, rows)


def test_only_movers_are_shuffled(spark):
    rows = cloud(200, 8)
    members, books = vectors.learn(frame(spark, rows), entries=9, rounds=2)
    assert members.count() == 4 * len(rows)
    again = vectors.reassigned(members, books)
    assert 0 <= again.where("moved").count() < again.where("not moved").count()
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_salts_split_a_common_vector(spark):
    rows = [(i, [0.5] * 8 if i % 3 else [i / 100.0] * 8, 0) for i in range(300)]
    members, _ = vectors.learn(frame(spark, rows), entries=16, rounds=1)
    groups = members.groupBy("position", "entry", "salt").count()
    hot = max(r["count"] for r in members.groupBy("position", "entry").count().collect())
    assert hot >= 200 and max(r["count"] for r in groups.collect()) < hot / 4


def test_empty_tables(spark):
    for rows in ([], [(1, None, 1)], [(1, [None], 1)]):
        found, books = vectors.compress(frame(spark, rows))
        assert found.collect() == [] and books is None
        assert found.columns == ["vec_id", "label", "code", "error", "label_error"]
    check(spark, [(1, [], 1), (2, [], None)])


@pytest.mark.parametrize("top", [1 << 19, 1 << 25, 1 << 40, 1 << 80])
def test_nearest_is_exact_at_every_magnitude(top):
    import numpy as np

    rnd = random.Random(top)
    v = np.array([[rnd.randint(-top, top) for _ in range(3)] for _ in range(20)], object)
    book = np.array([[rnd.randint(-top, top) for _ in range(3)] for _ in range(7)] + [[5, 5, 5], [5, 5, 5]], object)
    v[0] = [5, 5, 5]
    if top < 1 << 62:
        v, book = v.astype(np.int64), book.astype(np.int64)
    index, error = vectors.nearest(v, book)
    for i, row in enumerate(v.tolist()):
        d = [sum((a - b) ** 2 for a, b in zip(row, c, strict=True)) for c in book.tolist()]
        assert (index[i], int(error[i])) == (d.index(min(d)), min(d))
