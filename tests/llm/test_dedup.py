"""Substring, suffix and line dedup against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyfold.llm import common, substring, suffix, templates

SPACE = b" \t\n\r\x0b\x0c"


def sha(data):
    return hashlib.sha256(data).hexdigest()


def ordered(rows):
    return sorted(((i, (t or "")) for i, t, _ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def brute_substring(rows, window):
    seen, out = set(), []
    for i, text in ordered(rows):
        w = text.encode().split()
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            key = tuple(w[s: s + window])
            if key in seen:
                gone[s: s + window] = [True] * window
            seen.add(key)
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def brute_suffix(rows, length):
    texts = [(i, (t or "").encode()) for i, t, _ in rows]
    count = Counter(t[s: s + length] for _, t in texts for s in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - length + 1):
            if count[t[s: s + length]] > 1:
                gone[s: s + length] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + (gone[0] if len(t) else 0))
        out.append((i, len(t), int(gone.sum()), spans, bytes(np.frombuffer(t, np.uint8)[~gone])))
    return out


def as_set(found):
    return Counter(tuple(bytes(x) if isinstance(x, (bytes, bytearray)) else x for x in r) for r in found)


def test_substring_equals_brute_force(docs, rows):
    want = Counter(brute_substring(rows, 20))
    assert as_set(substring.dedup(docs).collect()) == want
    small = substring.dedup(docs, chunk_bytes=4000)  # many chunks
    assert as_set(small.collect()) == want


def test_words_of_equal_polynomials_are_told_apart(spark):
    # A Thue-Morse word and its complement: equal under every polynomial modulo a power of two.
    bits = [bin(i).count("1") % 2 for i in range(4096)]
    first, second = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    _, low, high = common.word_digests([f"{first} {second} {first}".encode()])
    assert low[0] == low[2] != low[1] and high[0] == high[2] != high[1]
    same = " ".join(f"w{i}" for i in range(19))
    df = spark.createDataFrame([(1, f"{same} {first}"), (2, f"{same} {second}"), (3, f"{same} {first}")], "doc_id long, text string")
    assert {r["doc_id"]: r["n_removed"] for r in substring.dedup(df).collect()} == {1: 0, 2: 0, 3: 20}


def test_substring_of_nothing(none):
    found = substring.dedup(none)
    assert found.count() == 0 and found.columns == ["doc_id", "n_words", "n_removed", "kept"]


def test_suffix_equals_brute_force(docs, rows):
    want = Counter(brute_suffix(rows, 200))
    assert sum(r[2] for r in want) > 10_000
    assert as_set(suffix.dedup(docs).collect()) == want
    assert as_set(suffix.dedup(docs, chunk_bytes=4000).collect()) == want


def test_suffix_keys_windows_of_hot_keys_one_by_one(docs, rows):
    assert as_set(suffix.dedup(docs, hot=1, chunk_bytes=9000).collect()) == Counter(brute_suffix(rows, 200))


def test_suffix_of_nothing(none):
    assert suffix.dedup(none).count() == 0


def test_long_documents_are_cut_into_overlapping_parts(monkeypatch):
    monkeypatch.setattr(suffix, "BUFFER", 500)
    rnd = random.Random(3)
    text = bytes(rnd.choice(b"abcd") for _ in range(3000))
    starts = [p[1] + s for b in suffix.buffers([text], 200) for p, at in zip(b.parts, b.part_start, strict=True)
              for s in range(len(p[2]) - 199) for _ in [at]]
    assert sorted(starts) == list(range(2801))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.binary(min_size=4, max_size=40).map(lambda b: bytes(x % 3 for x in b)), st.integers(1, 2)),
                min_size=1, max_size=8, unique_by=lambda x: x[0]))
def test_interval_expansion_finds_repeated_windows(found):
    contents, counts = [c for c, _ in found], [n for _, n in found]
    want = Counter()
    for c, n in found:
        for s in range(len(c) - 3):
            want[c[s: s + 4]] += n
    got = suffix.repeated_windows(contents, counts, 4)
    assert [g.tolist() for g in got] == [[want[c[s: s + 4]] > 1 for s in range(len(c) - 3)] for c in contents]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**62)))
def test_pack_round_trip(values):
    assert common.unpack(common.pack(np.array(values, np.uint64))).tolist() == values


def brute_templates(rows, lead=3, least=5, share=0.5):
    lines = {}
    for i, t in {(i, t or "") for i, t, _ in rows}:
        for p, line in enumerate(t.split("\n")):
            raw = [x for x in line.translate(str.maketrans("\t\r\x0b\x0c", "    ")).split(" ") if x]
            w = ["<*>" if any("0" <= c <= "9" for c in x) else x for x in raw]
            if w:
                lines[i, t, p] = tuple(w), tuple(raw if set(w) == {"<*>"} else w)
    equal, leaf_docs, token_docs = defaultdict(set), defaultdict(set), defaultdict(set)
    for (i, t, _), (w, key) in lines.items():
        equal[key].add((i, t))
        if len(w) > lead:
            leaf = (len(w), *w[:lead])
            leaf_docs[leaf].add((i, t))
            for j, x in enumerate(w):
                token_docs[leaf, j, x].add((i, t))
    made, template_docs = {}, defaultdict(set)
    for (i, t, _), (w, _) in lines.items():
        leaf = (len(w), *w[:lead])
        if len(leaf_docs[leaf]) >= least:
            constant = [x != "<*>" and len(token_docs[leaf, j, x]) >= max(least, share * len(leaf_docs[leaf]))
                        for j, x in enumerate(w)]
            if sum(constant[lead:]) >= share * (len(w) - lead):
                made[w] = leaf, tuple(x if c or j < lead else "<*>" for j, (x, c) in enumerate(zip(w, constant, strict=True)))
                template_docs[made[w]].add((i, t))
    out = []
    for i, t, _ in rows:
        t = t or ""
        parts = t.split("\n")
        gone = [p for p in range(len(parts)) if (i, t, p) in lines
                and (len(equal[lines[i, t, p][1]]) >= 2 or len(template_docs[made.get(lines[i, t, p][0])]) >= least)]
        out.append((i, len(parts) if t else 0, len(gone), "\n".join(x for p, x in enumerate(parts) if p not in gone)))
    return out


def test_templates_equal_brute_force(spark, rows):
    from .conftest import to_frame

    hosts = ["ab", "cd", "ef", "gh", "ij", "kl", "mn"]
    more = [(100 + i, f"user {i}42 logged in from host {n} today\nkept line {n} of the document number {n}{n} only\n{i}77\n\nsame", "a")
            for i, n in enumerate(hosts)]
    # One opening, many sentences: unique lines stay, however many documents share the opening.
    more += [(200 + i, f"Once upon a {n} there {n}s lived {n}x", "b") for i, n in enumerate(hosts * 3)]
    more += [(300 + i, "12 34\nYes.\n 5\t6 ", "c") for i in range(2)] + [(310, "12 35\nNo.", "c")]
    more += [(320, "twice in one\ntwice in one", "c")]
    found = templates.dedup(to_frame(spark, rows + more)).select("doc_id", "n_lines", "n_dropped", "kept_text")
    want = brute_templates(rows + more)
    assert Counter(map(tuple, found.collect())) == Counter(want)
    by_id = {r[0]: r for r in want}
    assert by_id[100][3] == "kept line ab of the document number abab only\n077\n"  # fields generalise
    assert by_id[300][3] == "" and by_id[310][3] == "12 35\nNo." and by_id[320][2] == 0
    assert by_id[200][2] == 1 and templates.MIN_EQUAL == 2  # an equal sentence in three documents goes


def test_templates_leave_unique_lines_and_drop_equal_ones(spark):
    """On given texts: every line that two documents share goes; one that a single document has goes only if
    four others have a line that agrees with it in half of the words at least."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    kept = {r["doc_id"]: set(r["kept_text"].split("\n")) for r in templates.dedup(docs).collect()}
    count, leaves, tokens = defaultdict(set), defaultdict(dict), {}
    for r in docs.collect():
        for line in (r["text"] or "").split("\n"):
            raw = line.split()
            w = ["<*>" if any(c.isdigit() and c.isascii() for c in x) else x for x in raw]
            if w:
                tokens[r["doc_id"], line] = w, " ".join(raw if set(w) == {"<*>"} else w)
                count[tokens[r["doc_id"], line][1]].add(r["doc_id"])
                leaves[len(w), *w[:3]].setdefault(r["doc_id"], []).append(w)
    alike = 0
    for (i, line), (w, key) in tokens.items():
        if len(count[key]) > 1:
            assert line not in kept[i]
        elif line not in kept[i]:
            near = [j for j, others in leaves[len(w), *w[:3]].items()
                    if any(sum(a == b for a, b in zip(w, x, strict=True)) >= 0.5 * len(w) for x in others)]
            assert len(near) >= 5, line
            alike += 1
    assert alike < 0.01 * len(tokens)


def test_clashing_names_pass_through(spark):
    names = ["doc", "pos", "leaf", "line", "hash", "gone", "its_doc", "GONE_", "key", "at", "h", "h1", "_key", "_gone", "n_lines"]
    rows = [(i, "a line of all\nown %d" % i, *[f"{n}{i}" for n in names]) for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    found = templates.dedup(df)
    for r in found.collect():
        assert r["kept_text"] == "" or r["kept_text"].startswith("own")
        assert all(r[n] == f"{n}{r['doc_id']}" for n in names if n != "n_lines") and r["n_lines"] == 2


def test_templates_of_nothing(none):
    assert templates.dedup(none).count() == 0
