"""Conversation structure repair by Knuth's lightest-derivation agenda.

A conversation's rows, by turn, are edited at least cost until their role
initials read ``(s?(ua)+)?``.  A repair item ``(i, state)`` says that the first
``i`` rows have been edited so that the initials end in ``state``; deductions
add an edit to an item (keep, rerole, delete, insert).  An item's weight is the
pair (cost, audit), compared in that order, where the audit holds the edits'
initials.  Deductions only add to the pair and keep its order (two derivations
of one item with equal cost never have one audit as the beginning of the
other), so the agenda pops items in their final order and stops when the goal
item is popped: its audit is the ASCII-least of the cheapest ones.

A stretch of rows is itself a deduction between states, so long conversations
are no special case: rows are range-partitioned by (conversation, turn), each
task finalises the stretches that it holds, and stretches of one conversation
that meet at the borders of tasks are put together by the same agenda.

1. Rows become facts without text (turn, role, SHA-256 of the text, blank,
   truncated); equal rows are one fact with a count, so a row repeated without
   end is no hot key.
2. The first turn of each (conversation, role, text) marks the duplicates.
3. Facts are range-partitioned and sorted; tasks emit stretches, and the few
   that continue in another task are joined per conversation.
4. The texts are sorted once by (conversation, turn) with the audit in front and
   streamed: a task holds the audit and one batch of rows, never a conversation.
   (A SHA-256 of a whole conversation is one sequential pass by its definition.)

* Null roles and texts count as one space.  Null conversation ids are one
  conversation, null turns come first.
* Rows of equal turns are ordered by role, then by the SHA-256 of their text.
* Empty and blank texts are blank rows; texts may be of any length.
* A conversation without rows has zeros, an empty audit and no repaired rows;
  an empty table gives no rows.
* Columns besides the four named are ignored, whatever their names are.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States: nothing yet, after ``s``, after ``u``, after ``a``; and the initials that lead on.
START, SYSTEM, USER, ASSISTANT = range(4)
MOVES = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: States in which a repaired conversation may end, and what a rerole or an insert gives in each.
GOALS = (START, ASSISTANT)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Rows of one stretch, and stretches that are put together at a time.
STRETCH, FAN = 64, 16
BLANK = " \t\n\x0b\x0c\r"
LONGEST = (1 << 63) - 1

#: What a stretch of rows leads to from each state: (end state, cost, audit) by start state.
Step = dict[int, list[tuple[int, int, str]]]


def row_step(initial: str, truncated: bool) -> Step:
    """The edits of a row that may stay."""
    extra = TRUNCATED if truncated else 0
    out: Step = {}
    for state in range(4):
        edits = [(state, DELETE, "D"), (NEXT[state], REROLE + extra, "R")]
        if (state, initial) in MOVES:
            edits.append((MOVES[state, initial], KEEP + extra, "K"))
        out[state] = edits
    return out


def gone_step(n: int) -> Step:
    """``n`` rows that must go (an insert between them is never ASCII-least, as D comes before I)."""
    return {state: [(state, DELETE * n, "D" * n)] for state in range(4)}


def agenda(steps: list[Step], start: int, inserts: bool, goals: tuple[int, ...] | None = None) -> dict[int, tuple[int, str]]:
    """The lightest (cost, audit) of every end state reached from ``start``.

    With ``goals``, the agenda ends as soon as one of them is final, which is then the only answer.
    """
    n, final, found = len(steps), set(), {}
    heap = [(0, "", 0, start)]
    while heap:
        cost, audit, i, state = heapq.heappop(heap)
        if (i, state) in final:
            continue
        final.add((i, state))
        if i == n:
            if goals and state in goals:
                return {state: (cost, audit)}
            found[state] = (cost, audit)
        else:
            for to, more, edits in steps[i].get(state, ()):
                if (i + 1, to) not in final:
                    heapq.heappush(heap, (cost + more, audit + edits, i + 1, to))
        if inserts and (i, NEXT[state]) not in final:
            heapq.heappush(heap, (cost + INSERT, audit + "I", i, NEXT[state]))
    return found


def joined(steps: list[Step], inserts: bool) -> Step:
    """Consecutive steps as one."""
    return {state: [(to, cost, audit) for to, (cost, audit) in agenda(steps, state, inserts).items()] for state in range(4)}


def folded(stretches: list[Step]) -> Step:
    """Any number of stretches as one, ``FAN`` at a time."""
    while len(stretches) > 1:
        stretches = [joined(stretches[i:i + FAN], False) for i in range(0, len(stretches), FAN)]
    return stretches[0] if stretches else {state: [(state, 0, "")] for state in range(4)}


def best(whole: Step) -> tuple[int, str]:
    """The lightest way from the start to a goal."""
    return min((cost, audit) for to, cost, audit in whole[START] if to in GOALS)


class Run:
    """Rows of one conversation that lie together, in order: their faults and their steps."""

    def __init__(self) -> None:
        self.steps: list[Step] = []
        self.stretches: list[Step] = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = None
        self.first = self.last = None  # initials of the outer rows

    def add(self, turn: int | None, initial: str, n: int, blank: bool, truncated: bool, again: bool) -> None:
        if turn is not None:
            self.turns += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        self.illegal += n - 1  # equal initials are never a legal pair
        self.last = initial
        gone = n
        if blank:
            self.blank += n
        elif again:
            self.duplicate += n
        else:
            gone = n - 1
            self.duplicate += gone
            self.truncated += truncated
            self.steps.append(row_step(initial, truncated))
        if gone:
            self.steps.append(gone_step(gone))
        if len(self.steps) >= STRETCH:
            self.stretches.append(joined(self.steps, True))
            self.steps = []

    def answer(self) -> tuple[int, str]:
        """Cost and audit of a conversation that lies in this run."""
        if not self.stretches:
            (result,) = agenda(self.steps, START, True, GOALS).values()
            return result
        return best(self.whole())

    def whole(self) -> Step:
        rest = [joined(self.steps, True)] if self.steps else []
        return folded(self.stretches + rest)

    def row(self) -> dict:
        return {"blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal,
                "turns": self.turns, "low": self.low, "high": self.high, "first": self.first, "last": self.last}


def gaps(low: int | None, high: int | None, turns: int) -> int:
    return 0 if low is None else min(high - low + 1 - turns, LONGEST)


def meet(parts: list[dict]) -> dict:
    """Figures and answer of a conversation whose runs lie in several tasks, in order."""
    figures = {k: sum(p[k] for p in parts) for k in ("blank", "duplicate", "truncated", "illegal", "turns")}
    high = None
    for a, b in zip(parts, parts[1:], strict=False):
        figures["illegal"] += a["last"] + b["first"] not in ("su", "ua", "au")
    for p in parts:
        figures["turns"] -= p["low"] is not None and p["low"] == high
        high = p["high"] if p["high"] is not None else high
    lows = [p["low"] for p in parts if p["low"] is not None]
    steps = [{int(s): [tuple(e) for e in edits] for s, edits in json.loads(p["step"]).items()} for p in parts]
    cost, audit = best(folded(steps))
    return {"gaps": gaps(lows[0] if lows else None, high, figures.pop("turns")), **figures, "cost": cost, "audit": audit}


FIGURES = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def faults(rows: DataFrame) -> DataFrame:
    """Facts of ``conv_id``, ``turn``, ``role``, ``digest``: how many equal rows, blank, truncated, and whether seen earlier."""
    bare = F.rtrim(F.col("text"), F.lit(BLANK))
    facts = rows.select("conv_id", "turn", "role", "digest", (bare == "").alias("blank"),
                        (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("truncated"))
    once = facts.groupBy("conv_id", "turn", "role", "digest").agg(
        F.count(F.lit(1)).alias("n"), F.first("blank").alias("blank"), F.first("truncated").alias("truncated"))
    order = F.struct(F.col("turn").isNotNull().alias("z"), F.col("turn").alias("t"))
    # Texts that stand in one turn only, nearly all, need no look at their first turn.
    first = (once.where("not blank").groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"))
             .agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("turns")).where("turns > 1").drop("turns"))
    met = once.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r"))
                    & (F.col("digest") == F.col("d")), "left")
    again = F.coalesce(order != F.col("first"), F.lit(False))
    return met.select("conv_id", "turn", "role", "digest", "n", "blank", "truncated", again.alias("again"))


def by_turn() -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]


def diagnose(facts: DataFrame) -> DataFrame:
    """Every conversation's figures, least cost and audit."""
    kind = dict(facts.dtypes)["conv_id"]
    runs_schema = (f"conv_id {kind}, whole boolean, place binary, {FIGURES}, turns long, low long, high long, "
                   "first string, last string, step string")

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        run, now, place, first_run = None, None, 0, True

        def close(last: bool) -> None:
            row = run.row() | {"conv_id": now, "place": place.to_bytes(8, "big")}
            # The outer runs of a task may go on in its neighbours.
            if first_run or last:
                row |= {"whole": False, "step": json.dumps(run.whole())}
            else:
                cost, audit = run.answer()
                row |= {"whole": True, "cost": cost, "audit": audit, "gaps": gaps(run.low, run.high, run.turns)}
            out.append(row)

        for b in batches:
            for conv, turn, initial, n, blank, truncated, again, at in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if run is None or conv != now:
                    if run is not None:
                        close(False)
                        first_run = False
                    run, now, place = Run(), conv, at
                run.add(turn, initial, n, blank, truncated, again)
            if len(out) >= 1000:
                yield records(out)
                out = []
        if run is not None:
            close(True)
        if out:
            yield records(out)

    fields = [("conv_id", None), ("whole", pa.bool_()), ("place", pa.binary()),
              *[(k, pa.int64()) for k in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()),
              *[(k, pa.int64()) for k in ("turns", "low", "high")], ("first", pa.string()), ("last", pa.string()), ("step", pa.string())]
    id_type = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}[kind]

    def records(out: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in out], t or id_type) for n, t in fields], [n for n, _ in fields])

    def together(t: pa.Table) -> pa.Table:
        parts = sorted(t.to_pylist(), key=lambda r: r["place"])
        found = meet(parts) | {"conv_id": parts[0]["conv_id"]}
        names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
        kinds = dict(fields)
        return pa.table([pa.array([found[n]], kinds[n] or id_type) for n in names], names)

    dealt = facts.repartitionByRange(*by_turn()).sortWithinPartitions(*by_turn())
    # Range partitions are numbered in the order of their keys, so a run's place needs no key.
    place = F.spark_partition_id().cast("long")
    found = dealt.select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "n", "blank", "truncated", "again",
                         place.alias("at")).mapInArrow(runs, runs_schema)
    found = materialize(found, "conversations-runs")
    names = ["conv_id", *[f.split()[0] for f in FIGURES.split(", ")]]
    cut = found.where("not whole").groupBy("conv_id").applyInArrow(together, f"conv_id {kind}, {FIGURES}")
    return found.where("whole").select(*names).unionByName(cut.select(*names))


def edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The repaired (role, text) pairs: ``rows`` in order under the edits of ``audit``."""
    state = START
    for edit in audit:
        if edit == "I":
            state = NEXT[state]
            yield ROLE[state], ""
            continue
        role, text = next(rows)
        if edit == "K":
            state = MOVES[state, role[:1]]
            yield role, text
        elif edit == "R":
            state = NEXT[state]
            yield ROLE[state], text


def streamed(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Every conversation's audit and, behind it, its rows in order, all in one partition."""
    ahead = audits.select("conv_id", F.lit(0).alias("tag"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                          F.lit(b"").alias("digest"), F.col("audit").alias("text"))
    behind = rows.select("conv_id", F.lit(1).alias("tag"), "turn", "role", "digest", "text")
    first, *rest = by_turn()
    return (ahead.unionByName(behind).repartition("conv_id").sortWithinPartitions(first, F.col("tag"), *rest)
            .select("conv_id", "tag", "role", "text"))


def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[tuple[str, str]]]]:
    """(conversation, its repaired rows) from a stream in the order of ``streamed``."""
    def flat():
        for b in batches:
            yield from zip(*(c.to_pylist() for c in b.columns), strict=True)

    stream = flat()
    ahead = [next(stream, None)]

    def body():
        while ahead[0] is not None and ahead[0][1] == 1:
            yield ahead[0][2], ahead[0][3]
            ahead[0] = next(stream, None)

    while ahead[0] is not None:
        conv, _, _, audit = ahead[0]
        ahead[0] = next(stream, None)
        rows = body()
        yield conv, edited(audit, rows)
        for _ in rows:  # rows that nobody asked for
            pass


def normal(df: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """The four columns under their own names, nulls settled, with the text's SHA-256."""
    space = F.lit(" ")
    kind = dict(df.dtypes)[conv_id]
    known = F.col(conv_id) if kind in ("bigint", "int") else F.col(conv_id).cast("string")
    named = df.select(known.alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                      F.coalesce(F.col(role).cast("string"), space).alias("role"),
                      F.coalesce(F.col(text).cast("string"), space).alias("text"))
    return named.withColumn("digest", F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)))


def repair(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation of ``df``: faults, least cost and audit of its repair."""
    return diagnose(materialize(faults(normal(df, conv_id, turn, role, text)), "conversations-facts"))


def repaired_rows(df: DataFrame, audits: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """The repaired conversations: ``conv_id``, ``pos`` (from 0), ``role``, ``text``."""
    rows = normal(df, conv_id, turn, role, text)
    kind = dict(rows.dtypes)["conv_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for conv, pairs in conversations(batches):
            for pos, (its_role, its_text) in enumerate(pairs):
                held.append((conv, pos, its_role, its_text))
                if len(held) >= 1000:
                    yield batch(held)
                    held = []
        if held:
            yield batch(held)

    id_type = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}[kind]

    def batch(held: list[tuple]) -> pa.RecordBatch:
        cols = zip(*held, strict=True)
        kinds = [id_type, pa.int64(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["conv_id", "pos", "role", "text"])

    return streamed(rows, audits).mapInArrow(run, f"conv_id {kind}, pos long, role string, text string")


def digests(df: DataFrame, audits: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """``conv_id`` and the SHA-256 of its repaired ``role:text`` rows, joined by line ends."""
    rows = normal(df, conv_id, turn, role, text)
    kind = dict(rows.dtypes)["conv_id"]
    id_type = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, hashes = [], []
        for conv, pairs in conversations(batches):
            h = hashlib.sha256()
            for pos, (its_role, its_text) in enumerate(pairs):
                h.update((b"\n" if pos else b"") + f"{its_role}:{its_text}".encode())
            ids.append(conv)
            hashes.append(h.hexdigest())
            if len(ids) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(ids, id_type), pa.array(hashes)], ["conv_id", "repaired_sha256"])
                ids, hashes = [], []
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(ids, id_type), pa.array(hashes)], ["conv_id", "repaired_sha256"])

    return streamed(rows, audits).mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def damage(df: DataFrame) -> DataFrame:
    """``conversations`` rows with faults by crc32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its
    text, 2 removes ``.!?`` from it, 3 repeats the row, 4 makes its role ``user``.  Nulls are one space."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    fault = F.crc32(F.encode(key, "UTF-8")) % 20
    text = F.coalesce(F.col("text").cast("string"), space)
    hurt = df.select("conv_id", "turn", F.when(fault == 4, F.lit("user")).otherwise(F.coalesce(F.col("role").cast("string"), space)).alias("role"),
                     F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
                     F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("times"))
    return hurt.withColumn("once", F.explode(F.array_repeat(F.lit(1), F.col("times")))).select("conv_id", "turn", "role", "text")
