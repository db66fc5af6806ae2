"""Conversation repair against an exhaustive search over edits."""

import hashlib
import itertools
import random
import re
import zlib

from tallyfold.llm import conversations as C
from tallyfold.llm.queries import op12_conversation_repair

SCHEMA = "conv_id long, turn long, role string, text string, tag int, audit string, digest string, n long, at string, place string"
LEGAL = re.compile(r"(s?(ua)+)?")
FIGURES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "a", "d", 2, "t", "p") for r in rows], SCHEMA)


def hurt(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 4:
            role = "user"
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))


def faulty(rows):
    """(role, text, must go, truncated) in order, and the figures."""
    seen, out = set(), []
    figures = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
    for _, _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        kind = ("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
        if kind:
            figures[kind] += 1
        out.append((role, text, kind in ("blank", "duplicate"), kind == "truncated"))
    for a, b in itertools.pairwise(out):
        figures["illegal"] += a[0][:1] + b[0][:1] not in ("su", "ua", "au")
    turns = [r[1] for r in rows if r[1] is not None]
    figures["gaps"] = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return out, figures


def every_edit(rows, inserts):
    """All (cost, audit, repaired) with up to ``inserts`` inserted rows."""
    for where in itertools.chain.from_iterable(
            itertools.combinations_with_replacement(range(len(rows) + 1), k) for k in range(inserts + 1)):
        slots = []
        for i in range(len(rows) + 1):
            slots += [None] * where.count(i)
            slots += rows[i:i + 1]
        choices = []
        for slot in slots:
            if slot is None:
                choices.append([(5, "I", ("user", "")), (5, "I", ("assistant", ""))])
                continue
            role, text, goes, cut = slot
            own = [(2, "D", None)]
            if not goes:
                own += [(5 * cut, "K", (role, text))] + [(1 + 5 * cut, "R", (r, text)) for r in ("user", "assistant")]
            choices.append(own)
        for edits in itertools.product(*choices):
            kept = [e[2] for e in edits if e[2] is not None]
            if all(r for r, _ in kept) and LEGAL.fullmatch("".join(r[0] for r, _ in kept)):
                yield sum(e[0] for e in edits), "".join(e[1] for e in edits), kept


def brute(rows, inserts=2):
    rows, figures = faulty(order(rows))
    cost, audit, kept = min(every_edit(rows, inserts)) if rows else (0, "", [])
    text = "\n".join(f"{r}:{t}" for r, t in kept)
    return figures | {"cost": cost, "audit": audit}, hashlib.sha256(text.encode()).hexdigest(), kept


def some(seed, n=40):
    rnd = random.Random(seed)
    out = []
    for conv in [None, *range(n)]:
        for i in range(rnd.choice([1, 2, 3, 4])):
            role = rnd.choice(["system", "user", "assistant", "user", "assistant", "tool", None, "", "User"])
            text = rnd.choice(["Yes.", "No?", "Fine", "Long " * 30 + ".", "", " \t", None, "é!", "Yes."])
            out.append((conv, rnd.choice([None, i, i, i * 3]), role, text))
    return out


def test_agenda_equals_exhaustive_search(spark):
    rows = some(1) + some(2)[:0]
    clean = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    df = frame(spark, rows).repartition(3)
    found = C.repair(df)
    got = {r["conv_id"]: r.asDict() for r in found.collect()}
    hashes = {r["conv_id"]: r["repaired_sha256"] for r in C.digests(df, found).collect()}
    pairs = {}
    for r in sorted(C.repaired_rows(df, found).collect(), key=lambda r: (r["conv_id"] is None, r["conv_id"] or 0, r["pos"])):
        pairs.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    for conv in {r[0] for r in rows}:
        figures, digest, kept = brute([r for r in clean if r[0] == conv])
        assert {k: got[conv][k] for k in figures} == figures, conv
        assert hashes[conv] == digest and pairs.get(conv, []) == kept


def test_query_damages_and_repairs(spark, tmp_path):
    rows = some(5, 60)
    at = str(tmp_path)
    frame(spark, rows).write.parquet(f"{at}/conversations.parquet")
    got = {r["conv_id"]: r.asDict() for r in op12_conversation_repair(spark, at).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv in got:
        figures, digest, _ = brute(hurt([r for r in rows if r[0] == conv]))
        assert {k: got[conv][k] for k in figures} == figures and got[conv]["repaired_sha256"] == digest, conv
    assert any(not hurt([r for r in rows if r[0] == c]) for c in got)  # a conversation that loses all rows


def steps(rows):
    out = []
    for role, _, goes, cut in rows:
        out.append(C.gone_step(1) if goes else C.row_step(role[:1], cut))
    return out


def test_stretches_put_together_equal_one_agenda():
    rnd = random.Random(9)
    for n in (1, 2, 5, 63, 64, 200, 1500):
        rows = [(rnd.choice(["user", "assistant", "system", "x"]), "", rnd.random() < 0.2, rnd.random() < 0.2) for _ in range(n)]
        (whole,) = C.agenda(steps(rows), C.START, True, C.GOALS).values()
        run = C.Run()
        for role, _, goes, cut in rows:
            run.add(None, role[:1], 1, goes, cut, False)
        assert run.answer() == whole == C.best(run.whole())
        cuts = sorted(rnd.sample(range(1, n), min(n - 1, 4)))
        parts = [rows[a:b] for a, b in itertools.pairwise([0, *cuts, n])]
        assert C.best(C.folded([C.joined(steps(p), True) for p in parts])) == whole


def test_a_conversation_over_many_tasks_and_repeated_rows(spark):
    rnd = random.Random(4)
    rows = [(7, i // 2, rnd.choice(["user", "assistant"]), f"Row {i % 900}{rnd.choice(['.', ''])}") for i in range(2000)]
    rows += [(7, 5, "user", "Same.")] * 500 + [(None, None, "user", "Same.")] * 300 + [(8, 1, "user", "Hi.")]
    df = frame(spark, rows).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        facts = C.materialize(C.faults(C.normal(df, "conv_id", "turn", "role", "text")), "facts")
        assert facts.count() < 2000 + 5  # repeated rows are one fact
        found = C.diagnose(facts)
        got = {r["conv_id"]: r.asDict() for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for conv in (7, None, 8):
        mine, figures = faulty(order([r for r in rows if r[0] == conv]))
        (answer,) = C.agenda(steps(mine), C.START, True, C.GOALS).values()
        assert {k: got[conv][k] for k in FIGURES} == figures | {"cost": answer[0], "audit": answer[1]}
    hashes = {r["conv_id"]: r["repaired_sha256"] for r in C.digests(df, found).collect()}
    assert hashes[None] == hashlib.sha256(b"user:Same.\nassistant:").hexdigest() or got[None]["audit"].startswith("D")


def test_empty_table_and_long_text(spark, tmp_path):
    at = str(tmp_path)
    frame(spark, []).write.parquet(f"{at}/conversations.parquet")
    found = op12_conversation_repair(spark, at)
    assert found.collect() == [] and found.columns == ["conv_id", *FIGURES, "repaired_sha256"]
    long = "word " * 400_000 + "."
    df = frame(spark, [(1, 0, "user", long), (1, 1, "assistant", long), (1, 2**63 - 1, "user", "x" * 10), (1, -(2**63), "system", ".")])
    found = C.repair(df)
    (row,) = found.collect()
    assert row["audit"] == "KKKD" and row["gaps"] == 2**63 - 1
    (digest,) = C.digests(df, found).collect()
    assert digest["repaired_sha256"] == hashlib.sha256(f"system:.\nuser:{long}\nassistant:{long}".encode()).hexdigest()
