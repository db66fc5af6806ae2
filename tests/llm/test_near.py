"""SimHash near-dedup, components and benchmark decontamination against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyfold.llm import decontaminate, graph, simhash

from .conftest import to_frame


def brute_fingerprint(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in lower.replace("\x0b", " ").replace("\x0c", " ").replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") if x]
    shingles = [" ".join(w[i: i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_roots(values, near):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    listed = sorted(root)
    for i, a in enumerate(listed):
        for b in listed[:i]:
            if near(a, b):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {v: find(v) for v in listed}


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def test_near_duplicates_equal_brute_force(docs, rows):
    fps = {(i, t): brute_fingerprint(t) for i, t, _ in rows}
    roots = brute_roots(fps.values(), lambda a, b: (a ^ b).bit_count() <= 2)
    smallest = {}
    for (i, _), fp in fps.items():
        if i is not None:
            smallest[roots[fp]] = min(i, smallest.get(roots[fp], i))
    want = Counter((i, signed(fps[i, t]), smallest.get(roots[fps[i, t]])) for i, t, _ in rows)
    found = simhash.near_duplicates(docs).select("doc_id", "fp", "component_id").collect()
    assert Counter(map(tuple, found)) == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and sorted(map(str, kept.columns)) == sorted(docs.columns)
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(smallest.get(r) for r in set(roots.values()))


@pytest.mark.parametrize("spread", [0, 40])
def test_links_lose_none(spark, spread):
    """Random fingerprints and, with ``spread``, a dense cluster whose partition values are all hot."""
    rnd = random.Random(spread)
    values = {rnd.getrandbits(64) for _ in range(300)}
    for v in list(values)[:100]:
        values.add(v ^ 1 << rnd.randrange(64) ^ 1 << rnd.randrange(64))
    centre = rnd.getrandbits(64)
    for _ in range(spread * 10):
        values.add(centre ^ 1 << rnd.randrange(64) ^ 1 << rnd.randrange(64) ^ 1 << rnd.randrange(64))
    s = sorted(map(signed, values))
    want = {(a, b) for i, b in enumerate(s) for a in s[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    found = simhash.links(spark.createDataFrame([(v,) for v in s], "fp long"))
    assert {(r["u"], r["v"]) for r in found.collect()} == want
    assert len(want) > 50


def test_whole_neighbourhood_where_all_partitions_are_crowded(spark):
    """All 2,081 values around one: every partition value is shared by many, so queries look up neighbours."""
    centre = random.Random(5).getrandbits(64)
    near = [0, *(1 << a for a in range(64)), *(1 << a | 1 << b for a in range(64) for b in range(a))]
    s = sorted(signed(centre ^ m) for m in near)
    want = {(a, b) for i, b in enumerate(s) for a in s[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    found = simhash.links(spark.createDataFrame([(v,) for v in s], "fp long"))
    assert {(r["u"], r["v"]) for r in found.collect()} == want


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.floats(0, 100), min_size=12, max_size=12), min_size=1, max_size=5))
def test_allocation_is_optimal(costs):
    c = np.array(costs).reshape(-1, 3, 4)
    t = simhash.allocate(c, 0)
    for row, chosen in zip(c, t, strict=True):
        best = min(row[0, a + 1] + row[1, b + 1] + row[2, d + 1] for a in range(-1, 3) for b in range(-1, 3)
                   for d in range(-1, 3) if a + b + d == 0)
        assert chosen.sum() == 0 and abs(sum(row[i, x + 1] for i, x in enumerate(chosen)) - best) < 1e-9


def test_bits_that_go_together_share_a_group():
    rnd = np.random.default_rng(1)
    bits = rnd.integers(0, 2, (500, 64))
    bits[:, 40] = bits[:, 3]
    groups = simhash.group_bits(500, (bits.T @ bits).astype(float))
    assert sorted(b for g in groups for b in g) == list(range(64))
    assert any(3 in g and 40 in g for g in groups)


def test_simhash_of_nothing(none):
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(30)] + [(50, 51), (52, 51), (51, 99)]])
def test_components(spark, edges):
    want = brute_roots({x for e in edges if e[0] != e[1] for x in e}, lambda a, b: (a, b) in edges or (b, a) in edges)
    found = graph.components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert sorted(map(tuple, found)) == sorted(want.items())


def brute_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


@settings(max_examples=100, deadline=None)
@given(st.text("abc", min_size=1, max_size=30), st.text("abc", max_size=60))
def test_myers_is_the_edit_distance(item, text):
    distance, end = decontaminate.myers(item, text)
    assert distance == brute_distance(item, text) and 0 <= end <= len(text)


def test_leaks_equal_brute_force(spark):
    rnd = random.Random(11)
    vocabulary = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 6))) for _ in range(60)]

    def prose(n):
        return " ".join(rnd.choice(vocabulary) for _ in range(n))

    def edited(text, n):
        out = list(text)
        for _ in range(n):
            at = rnd.randrange(len(out))
            out[at: at + 1] = rnd.choice([[], ["z"], [out[at], "z"]])
        return "".join(out)

    items = {i: prose(rnd.randint(15, 40)) for i in range(12)} | {50: "again " * 8}
    texts = []
    for d in range(60):
        item = items[d % 12]
        k = decontaminate.budget(len(item))
        body = [prose(20), edited(item, rnd.choice([0, k // 2, k, k + 1, 3 * k])), prose(20)]
        texts.append((d, " \n".join(body).title() if d % 2 else "\t ".join(body), "a"))
    texts += [(None, None, "a"), (200, "", "a"), (201, items[2], "a"), (202, "again again AGAIN again\nagain again again again", "a")]
    given = [*items.items(), (3, items[3]), (90, None), (91, ""), (92, "short")]
    found = decontaminate.mark(to_frame(spark, texts), spark.createDataFrame(given, "item_id long, text string"), block_chars=500)
    caught = 0
    for r in found.collect():
        clean = decontaminate.normal(r["text"])
        want = {i: brute_distance(decontaminate.normal(x), clean) for i, x in items.items()}
        want = {i: n for i, n in want.items() if n <= decontaminate.budget(len(decontaminate.normal(items[i])))}
        assert {x["item_id"]: x["distance"] for x in r["leaks"]} == want, r["doc_id"]
        for x in r["leaks"]:
            assert brute_distance(decontaminate.normal(items[x["item_id"]]), clean[x["start"]: x["end"]]) == x["distance"]
        caught += len(want)
    assert caught > 30 and set(found.columns) == set(to_frame(spark, texts).columns)


def test_no_items_and_no_documents(docs, none, spark):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.mark(docs, empty).selectExpr("max(size(leaks))").first()[0] == 0
    some = spark.createDataFrame([(1, "a passage that is long enough to look for")], "item_id long, text string")
    assert decontaminate.mark(none, some).count() == 0
