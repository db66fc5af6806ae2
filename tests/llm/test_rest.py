"""Scoring, mixing, quality rules, sharding and personal data."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfold.llm import lm, mixing, pii, quality, sharding

from .conftest import to_frame


def tokens(text):
    return (text or "").encode().lower().split() + [b""]


class PlainTree:
    """Context-tree weighting node by node, for one bit tree per byte prefix."""

    def __init__(self, texts, depth):
        self.depth, self.count = depth, defaultdict(lambda: [0, 0])
        for t in texts:
            for context, byte in self.steps(t):
                for b in range(8):
                    for d in range(depth + 1):
                        self.count[context[len(context) - d:], 1 << b | byte >> 8 - b][byte >> 7 - b & 1] += 1
        self.children = defaultdict(set)
        for context, node in self.count:
            if context:
                self.children[context[1:], node].add((context, node))
        self.known = {}

    def steps(self, text):
        data = b"\xff" * self.depth + (text or "").encode().lower() + b"\xff"
        for i in range(self.depth, len(data)):
            yield data[i - self.depth: i], data[i]

    def log_pe(self, key):
        a, b = self.count[key] if key in self.count else (0, 0)
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def log_pw(self, key):
        if key not in self.known:
            own = self.log_pe(key)
            if len(key[0]) < self.depth:
                own = np.logaddexp(own, sum(self.log_pw(c) for c in self.children.get(key, ()))) - math.log(2)
            self.known[key] = float(own)
        return self.known[key]

    def score(self, text):
        total = 0.0
        for context, byte in self.steps(text):
            for b in range(8):
                node, bit, p = 1 << b | byte >> 8 - b, byte >> 7 - b & 1, None
                for d in range(self.depth, -1, -1):
                    key = context[len(context) - d:], node
                    n = self.count[key] if key in self.count else (0, 0)
                    kt = (n[bit] + 0.5) / (sum(n) + 1)
                    if p is None:
                        p = kt
                    else:
                        own = 0.5 * math.exp(self.log_pe(key) - self.log_pw(key))
                        p = own * kt + (1 - own) * p
                total += math.log10(p)
        return total


def held_out(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2


@pytest.mark.parametrize("depth", [2, 5])
def test_scores_equal_the_plain_tree(spark, rows, depth):
    some = [r for r in rows if len(r[1] or "") < 3000]
    parted = lm.split(to_frame(spark, some))
    model = lm.train(parted.where("not held_out"), depth)
    tree = PlainTree([t for i, t, _ in some if not held_out(i)], depth)
    count = Counter(x for i, t, _ in some if not held_out(i) for x in tokens(t))
    total, kinds = sum(count.values()), len(count)
    assert (model.tokens, model.words) == (total, kinds)
    want = sorted((i is not None, i or 0, len(tokens(t)), sum(count[x] > 0 for x in tokens(t)),
                   sum(math.log10((count[x] + 1) / (total + kinds + 1)) for x in tokens(t)), tree.score(t)) for i, t, _ in some)
    got = sorted((r[0] is not None, r[0] or 0, *r[1:]) for r in map(tuple, model.score(parted, chunk_bytes=5000).collect()))
    assert [w[:4] for w in want] == [g[:4] for g in got]
    assert np.allclose([w[4:] for w in want], [g[4:] for g in got], rtol=1e-9)


def test_probabilities_of_the_next_byte_add_up(spark):
    texts = ["the cat", "the dog", "a cat"]
    model = lm.train(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    ends = spark.createDataFrame([(i, "the " + chr(i)) for i in range(1, 65)] + [(i, "the " + chr(i)) for i in range(91, 128)],
                                 "doc_id long, text string")
    both = model.score(ends).agg(F.sum(F.pow(F.lit(10.0), F.col("score")))).first()[0]
    assert 0 < both < 1


def test_long_texts_are_scored_in_parts(spark, monkeypatch):
    text = "some words that go on and on " * 40
    df = spark.createDataFrame([(1, text), (3, "short"), (8, text[:100])], "doc_id long, text string")
    model = lm.train(df)
    whole = [sum(x) for x in zip(*[lm.pairs(d, s, 5) for d, s in lm.parts([lm.lowered(text)])], strict=False)]
    monkeypatch.setattr(lm, "BUFFER", 64)
    cut = [p for d, s in lm.parts([lm.lowered(text)]) for p in lm.pairs(d, s, 5)]
    assert cut == whole and model.score(df).count() == 3


def test_scoring_without_training_or_documents(none, docs):
    model = lm.train(none)
    assert model.score(none).count() == 0 and (model.tokens, model.words) == (0, 0)
    r = model.score(docs.where("doc_id = 3")).first()
    assert r["base_score"] == 0 and abs(r["score"] + 4 * 8 * math.log10(2)) < 1e-9


def fill(sizes, weights, share, most):
    """Water filling round by round."""
    target, capped = {}, set()
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    while True:
        left = share * sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        free = [s for s in names if s not in capped]
        target = {s: most * sizes[s] if s in capped else left * w[s] / sum(w[x] for x in free) for s in names}
        over = {s for s in free if target[s] > most * sizes[s] + 1e-9}
        if not over:
            return target
        capped |= over


def test_mix(docs, rows):
    found = mixing.mix(docs)
    assert [c for c in found.columns if c in docs.columns and c not in ("size", "taken")] == [
        c for c in docs.columns if c not in ("size", "taken")]
    got = found.collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").encode().split())
    want = fill(sizes, [3.0, 1.0, 2.0], 1.5, 2.0)
    taken = Counter()
    for r in got:
        assert r["size"] == len((r["text"] or "").encode().split()) and r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - want[r["source"]]) < 1e-6 and r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    largest = {s: max(r["size"] for r in got if r["source"] == s) for s in sizes}
    assert all(abs(taken[s] - want[s]) <= largest[s] / 2 + 1 for s in sizes)
    again = mixing.mix(docs.repartition(5), prefix="m_").select("doc_id", "source", "m_taken", "size").collect()
    assert Counter((r[0], r[1], r[2]) for r in again) == Counter((r["doc_id"], r["source"], r["taken"]) for r in got)
    assert all(r["size"] == "s" for r in again)


def test_quality_weighs_the_draw(spark):
    rows = [(i, "plain words here " * 3 if i % 2 else "### $$$ *** &&& " * 3, "abc"[i % 3 > 1]) for i in range(4000)]
    got = mixing.mix(to_frame(spark, rows), weights=[1.0], share=0.5, most=1.0).groupBy(F.col("doc_id") % 2).agg(F.sum("copies")).collect()
    odd, even = dict(map(tuple, got))[1], dict(map(tuple, got))[0]
    assert odd > 3 * even


def test_mix_of_nothing(none):
    assert mixing.mix(none).count() == 0


def brute_quality(text):
    text = text or ""
    w = text.encode().split()
    five = Counter(tuple(w[i: i + 5]) for i in range(len(w) - 4))
    again = {j for i in range(len(w) - 4) if five[tuple(w[i: i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return (len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(again))


def test_base_figures(docs, rows):
    got = quality.assess(docs, quality.LineCrf.zero())
    for r in got.collect():
        n, chars, symbols, lines, again = brute_quality(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, lines, again)
        assert r["base_failed"] == (n < 10 or 100 * again > 20 * n) and r["kept"] == (not r["base_failed"])
    assert got.count() == len(rows)
    assert "lang" in got.columns and quality.assess(docs, quality.LineCrf.zero(), ["doc_id"]).columns == ["doc_id", *quality.COLUMNS]


def test_repeated_words_of_large_vocabularies():
    w = [b"%d" % i for i in range(9000)] * 2
    assert quality.repeated_words(w) == 18000
    assert quality.repeated_words([b"%d" % i for i in range(9000)]) == 0


def test_viterbi_is_the_best_labelling():
    rng = np.random.default_rng(2)
    for _ in range(30):
        crf = quality.LineCrf(rng.normal(size=len(quality.FEATURES) + 1), rng.normal(size=(2, 2)))
        bits = rng.integers(0, 1 << len(quality.FEATURES), 7).tolist()

        def value(y, crf=crf, bits=bits):
            return sum(crf.score(b) * s for b, s in zip(bits, y, strict=True)) + sum(crf.moves[a, b] for a, b in zip(y, y[1:], strict=False))

        best = max((tuple(k >> i & 1 for i in range(7)) for k in range(128)), key=value)
        assert abs(value(crf.decode(bits)) - value(best)) < 1e-9
    assert quality.LineCrf.zero().decode([]) == []


def test_gradient_of_the_crf():
    rng = np.random.default_rng(3)
    k = len(quality.FEATURES) + 1
    x, mask, y = rng.integers(0, 2, (3, 4, k)).astype(float), np.array([[1, 1, 1, 1], [1, 1, 0, 0], [1, 1, 1, 0]], float), np.array([1.0, 0, 1])
    x *= mask[:, :, None]
    theta = rng.normal(size=k + 4)

    def loss(theta):
        out, moves = 0.0, theta[k:].reshape(2, 2)
        for s, m, label in zip(x, mask, y, strict=True):
            n = int(m.sum())
            node = s[:n] @ theta[:k]
            scores = [sum(node[i] * (c >> i & 1) for i in range(n)) + sum(moves[c >> i & 1, c >> i + 1 & 1] for i in range(n - 1))
                      for c in range(1 << n)]
            out += np.log(np.exp(scores).sum()) - scores[(1 << n) - 1 if label else 0]
        return out

    got = quality.LineCrf._gradient(theta, x, mask, y)
    for i in range(len(theta)):
        step = np.zeros_like(theta)
        step[i] = 1e-5
        assert abs((loss(theta + step) - loss(theta - step)) / 2e-5 - got[i]) < 1e-5


def test_training_tells_boilerplate(spark):
    good = [(i, f"This is a plain sentence number of words {'x' * (i % 5)}.\nAnother one follows here and ends well.", "a") for i in range(40)]
    bad = [(100 + i, "home | about | contact | login | more | links | help | news | shop | site\nBUY!! NOW!! CHEAP!! DEALS!! TODAY!! ONLY!! HERE!! YES!! OK!! GO!!", "a") for i in range(40)]
    docs = to_frame(spark, good + bad)
    labels = spark.createDataFrame([(i, 1, 0) for i, _, _ in good] + [(i, 0, 0) for i, _, _ in bad] + [(None, 1, 0), (5, None, 0)],
                                   "doc_id long, quality int, toxic int")
    crf = quality.train(docs, labels)
    got = {r["doc_id"]: r["kept"] for r in quality.assess(docs, crf).collect()}
    assert all(got[i] for i, _, _ in good) and not any(got[i] for i, _, _ in bad)
    assert sorted(r["doc_id"] for r in quality.retain(docs, crf).collect()) == [i for i, _, _ in good]
    nothing = quality.train(docs, labels.limit(0))
    assert not nothing.weights.any()


def test_quality_of_nothing(none):
    assert quality.assess(none, quality.LineCrf.zero()).count() == 0


def test_shards(docs, rows):
    got = sharding.shard(docs).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        assert r["size"] == len((r["text"] or "").encode()) + 1
        by[r["shard"]].append(r)
    assert set(by) <= set(range(8))
    for found in by.values():
        assert sorted(r["slot"] for r in found) == list(range(len(found)))


def test_shards_are_near_equal_with_one_hot_text(spark):
    rows = [(i, "the same text for a third" if i % 3 == 0 else f"text number {i} " * (i % 7), "a") for i in range(3000)]
    got = sharding.shard(to_frame(spark, rows)).groupBy("shard").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
    sizes = [r["b"] for r in got]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 2 * max(len(t) + 1 for _, t, _ in rows)
    again = sharding.shard(to_frame(spark, rows).repartition(7)).select("doc_id", "shard", "slot").collect()
    assert Counter(map(tuple, again)) == Counter((r["doc_id"], r["shard"], r["slot"]) for r in sharding.shard(to_frame(spark, rows)).collect())


def test_overfull_ranges_are_subdivided(spark):
    keyed = spark.range(4000).select(F.when(F.col("id") < 3000, F.col("id") % 40 + 1000).otherwise(F.col("id") * 10_000).alias("key"),
                                     F.lit(1).alias("size"))
    cuts = sharding.boundaries(keyed, 16, 4000)
    parts = keyed.groupBy(sharding.range_index(F.col("key"), cuts)).agg(F.sum("size"), F.min("key"), F.max("key")).collect()
    assert all(r[1] <= sharding.OVERFULL * 250 or r[2] == r[3] for r in parts)


def plain_shards(rows, shards=8):
    """(doc_id, size, shard, slot) by one sort and one running sum."""
    def digits(text, n):
        return int(hashlib.md5(text.encode()).hexdigest()[:n], 16)

    keyed = sorted(((digits(t or "", 9) << 24) + digits("null" if i is None else str(i), 6), i is not None, i or 0, len((t or "").encode()) + 1)
                   for i, t, *_ in rows)
    total, before, slots, out = sum(r[3] for r in keyed), 0, Counter(), []
    for _, known, i, size in keyed:
        shard = min(((2 * before + size) * shards) // (2 * total), shards - 1)
        out.append((i if known else None, size, shard, slots[shard]))
        slots[shard] += 1
        before += size
    return out


def test_shards_equal_one_plain_sort(spark, docs, rows, monkeypatch):
    many = [(i, ("the same text for a third" if i % 3 == 0 else f"text number {i} " * (i % 7)) or None, "a") for i in range(2000)]
    for given, df in ((rows, docs), (many, to_frame(spark, many))):
        got = sharding.shard(df).select("doc_id", "size", "shard", "slot").collect()
        assert Counter(map(tuple, got)) == Counter(plain_shards(given))
    monkeypatch.setattr(sharding, "RANGE_ROWS", 10)  # many ranges
    got = sharding.shard(to_frame(spark, many)).select("doc_id", "size", "shard", "slot").collect()
    assert Counter(map(tuple, got)) == Counter(plain_shards(many))


def test_sharding_passes_other_columns_through(spark):
    names = ["key", "KEY_", "range", "before", "rank", "b0", "n0", "first", "_key", "_b0", "_n0", "_first", "_range", "r", "b", "n", "k"]
    df = spark.createDataFrame([(i, f"t{i}", *[f"{n}{i}" for n in names]) for i in range(20)],
                               "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    got = sharding.shard(df)
    assert got.columns == ["shard", *df.columns, "size", "slot"] or set(got.columns) == {*df.columns, "size", "shard", "slot"}
    assert all(r[n] == f"{n}{r['doc_id']}" for r in got.collect() for n in names)


def test_sharding_of_nothing(none):
    assert sharding.shard(none).count() == 0


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def brute_base(text):
    found = []
    for k, pattern in enumerate((pii.EMAIL, pii.IP, pii.CARD, pii.PHONE)):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = (True, k == 1 and all(int(x) <= 255 for x in m[0].split(".")), 14 <= len(digits) <= 19 and luhn(digits), 10 <= len(digits) <= 15)[k]
            if ok:
                found.append((m.start(), k, m.end()))
    return sorted(found)


PERSONAL = [
    "mail a.b+c@ex-ample.co.uk or x@y.z_w@q.r, not a@b", "ips 1.2.3.4.5 256.1.1.1 0001.02.3.255 é 10.0.0.1", "card 4539 1488 0343 6467 and 4539148803436468",
    "card 4539-1488-0343-6467 12 4539 1488 0343 6467", "+1 (202) 555-0143 or +44 20 7946 0958 and +123", "\U0001f600 é +1 202 555 0143 a@b.cc 8.8.8.8", "", None, "no digits at all",
    "7" * 500 + " " + "1.1.1.1 " * 50,
]


def test_base_spans(spark):
    rows = [(i, t, "a") for i, t in enumerate(PERSONAL)] + [(5, PERSONAL[5], "a"), (None, PERSONAL[0], "b")]
    got = pii.extract(to_frame(spark, rows)).collect()
    assert len(got) == len(rows)
    texts = {i: t for i, t, _ in rows}
    for r in got:
        spans = [(s["start"], s["kind"], s["end"]) for s in r["spans"] if s["kind"] < 4]
        assert spans == brute_base(texts[r["doc_id"]] if r["doc_id"] is not None else PERSONAL[0])
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(s[1] == k for s in spans) for k in range(4)]


def test_long_runs_and_tokens(spark):
    n = 1_000_000
    mail = "a@b" + ".c" * (n // 2)
    texts = ["7" * n, "123 " * (n // 4), "1-" * (n // 2), mail, "x" * n, "x" * n + "@", "1" + "-" * n + "1", "1." * (n // 2),
             "+1" + "(" * n, "+1" * (n // 2), "_" * n + " x@y.z_w@q.r 0.0.0.0"]
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["kind"] < 4]
           for r in pii.extract(to_frame(spark, [(i, t, "a") for i, t in enumerate(texts)])).collect()}
    assert got.pop(3) == [(0, 0, len(mail))]
    assert got.pop(10) == [(0, n + 1, n + 6), (0, n + 6, n + 12), (1, n + 13, n + 20)]
    ips = got.pop(7)
    assert len(ips) == n // 8 and ips[:2] == [(1, 0, 7), (1, 8, 15)]
    assert len(got) == 8 and not any(got.values())


def test_java_forms_match_as_the_expressions(spark):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("a1@. .-_+(12\n\u2028\U0001f600") for _ in range(40)) for _ in range(3000)]
    plain = (pii.EMAIL, pii.IP, pii.CARD, pii.PHONE, pii.CANDIDATE)
    found = [F.regexp_extract_all("t", F.lit(p), F.lit(0)) for p in pii.JAVA]
    for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", *found).collect():
        assert list(r[1:]) == [[m[0] for m in re.finditer(p, r["t"])] for p in plain]


def test_patterns_find_unseen_identifiers(spark):
    rows = [(i, f"please write to me at user{i}@mail.example.com any time", "a") for i in range(6)]
    rows += [(20, "please write to me at user77[at]mail soon", "a"), (21, "in the year 1984 nothing happened at all", "a")]
    rows += [(30, "then again user77[at]mail was quoted by user88[at]mail twice", "a")]
    got = {r["doc_id"]: r["spans"] for r in pii.extract(to_frame(spark, rows)).collect()}
    assert [(s["kind"], s["start"], s["end"]) for s in got[20]] == [(4, 22, 36)]
    assert got[21] == [] and [(s["kind"], s["start"]) for s in got[30]] == [(4, 11)]
    text = spark.createDataFrame([(20,)], "i int").select(pii.span_text(F.array(F.struct(
        F.lit(22).alias("start"), F.lit(4).alias("kind"), F.lit(37).alias("end"))))).first()[0]
    assert text == "id:22:37" and hashlib.sha256(b"").hexdigest().startswith("e3b0")


def test_seeds_with_blanks_and_lists_teach(spark):
    rows = [(i, f"call our office line +1 (045) 555-32{i}{i} today\nmembers a{i}@mail.example.com b{i}@mail.example.com", "a")
            for i in range(6)]
    rows += [(20, "call our office line ext-4477 today", "a"), (21, "members M-10021 M-10022 M-10023", "a"), (22, "line\n1984x 1985x", "a")]
    frame = to_frame(spark, rows)
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in pii.extract(frame).collect()}
    assert got[20] == [(4, 21, 29)] and got[22] == []
    assert got[21] == [(4, 8, 15), (4, 16, 23), (4, 24, 31)]
    tokens = pii.candidates(pii.place(pii.find_matches(to_frame(spark, [
        (0, f"word (x@y.zz,v@w.zz) then {'k' * 200} +4539 1488 0343 6467 end", "a")])))).collect()
    assert sorted((t["value"], t["known"], t["patterns"][0]) for t in tokens) == [
        ("4539 1488 0343 6467", True, "before:" + "k" * 200), ("v@w.zz", True, "before:word"), ("x@y.zz", True, "before:word")]


def test_personal_data_of_nothing(none):
    assert pii.extract(none).count() == 0
