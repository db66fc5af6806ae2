"""Quality rules: line sequence labelling with a linear-chain CRF.

Every line of a text is described by a few yes/no features.  A linear-chain
conditional random field with two labels (content, boilerplate) scores the
sequence of lines, Viterbi decoding gives the best labelling, and a document is
kept if at least half of its words stand in lines labelled content.  Documents
that fail the plain rules (fewer than 10 words, or over a fifth of the words in
repeated 5-word windows) are never kept.

The CRF is fitted here, by conditional likelihood, on a bounded sample of
labelled documents (``TRAIN_DOCS``): each line of a sampled document carries
its document's label.  Without labelled rows all weights are 0 and every line
counts as content.

Null and empty texts have no words, fail the rules and are not kept.  Rows are
judged one by one, so ties, repeated rows and extra columns do not matter; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbering

#: Labelled documents that the CRF is fitted on, at most.
TRAIN_DOCS = 1000
#: Documents with fewer words, or a larger share of repeated words (in %), fail.
MIN_WORDS, MAX_REPEAT_PCT, WINDOW = 10, 20, 5
#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
#: Share of words in content lines from which a document is kept.
MIN_CONTENT = 0.5
SPACE = " \t\n\r\x0b\x0c"
FEATURES = ("few_words", "many_words", "some_symbols", "many_symbols", "pipes", "shouting", "exclaiming",
            "long_words", "no_full_stop", "digits", "repeated_line", "repeated_words")
COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def line_features(text: str) -> tuple[list[int], list[int], int]:
    """A bit set of ``FEATURES`` and a word count for each line with a word, and
    how many of them equal an earlier line."""
    seen: set[str] = set()
    bits, counts, repeated = [], [], 0
    for line in text.split("\n"):
        bare = line.strip(SPACE)
        if not bare:
            continue
        words = bare.split()
        n, size = max(len(words), 1), len(bare)
        symbols = sum(map(bare.count, SYMBOLS))
        again = line in seen
        repeated += again
        seen.add(line)
        upper = bare.upper() == bare and bare.lower() != bare
        marks = (n < 3, n >= 12, symbols > 0, 20 * symbols > size, 4 * bare.count("|") > n, upper,
                 5 * bare.count("!") > n, size > 11 * n, bare[-1] not in ".!?…\"", any(c.isdigit() for c in bare),
                 again, n >= 8 and 2 * len(set(words)) < n)
        bits.append(sum(1 << i for i, m in enumerate(marks) if m))
        counts.append(n)
    return bits, counts, repeated


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words covered by ``window``-word sequences that occur twice or more."""
    n = len(words)
    if n <= window:
        return 0
    number = numbering()
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    code, base = ids, len(number)
    for i in range(1, window):  # exact: renumbered before it could overflow
        if base * len(number) >= 1 << 62:
            values = np.sort(code)
            values = values[np.concatenate(([True], values[1:] != values[:-1]))]
            code, base = np.searchsorted(values, code), len(values)
        code = code[: n - i] * len(number) + ids[i:]
        base *= len(number)
    order = np.argsort(code, kind="stable")
    same = np.concatenate(([False], code[order][1:] == code[order][:-1], [False]))
    starts = order[same[:-1] | same[1:]]
    edge = np.zeros(n + 1, np.int64)
    edge[starts] += 1
    edge[starts + window] -= 1
    return int((np.cumsum(edge[:-1]) > 0).sum())


class LineCrf:
    """Two labels (0 boilerplate, 1 content), one weight per feature (and one
    for the bias) for content, and a 2 x 2 table of transition weights."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves
        self.by_bits: dict[int, float] = {}

    @staticmethod
    def zero() -> LineCrf:
        return LineCrf(np.zeros(len(FEATURES) + 1), np.zeros((2, 2)))

    def score(self, bits: int) -> float:
        if bits not in self.by_bits:
            on = [w for i, w in enumerate(self.weights[:-1]) if bits >> i & 1]
            self.by_bits[bits] = float(sum(on) + self.weights[-1])
        return self.by_bits[bits]

    def decode(self, bits: list[int]) -> list[int]:
        """Viterbi; ties go to content."""
        (m00, m01), (m10, m11) = self.moves.tolist()
        best0, best1, back = 0.0, 0.0, []
        for i, b in enumerate(bits):
            if i:
                from0, from1 = best1 + m10 < best0 + m00, best1 + m11 < best0 + m01
                back.append((not from0, not from1))
                best0, best1 = max(best0 + m00, best1 + m10), max(best0 + m01, best1 + m11)
            best1 += self.score(b)
        label = int(best1 >= best0)
        out = [label]
        for step in reversed(back):
            label = int(step[label])
            out.append(label)
        return out[::-1][: len(bits)]

    @staticmethod
    def fit(sequences: list[list[int]], labels: list[int], rounds: int = 80, l2: float = 0.5) -> LineCrf:
        """Conditional maximum likelihood (forward-backward, Adam)."""
        pairs = [(s, y) for s, y in zip(sequences, labels, strict=True) if s]
        if not pairs:
            return LineCrf.zero()
        pairs.sort(key=lambda p: len(p[0]))
        k = len(FEATURES)
        batches = []
        for i in range(0, len(pairs), 100):
            part = pairs[i: i + 100]
            t = len(part[-1][0])
            x = np.zeros((len(part), t, k + 1))
            mask = np.zeros((len(part), t))
            for j, (s, _) in enumerate(part):
                x[j, : len(s), :k] = (np.array(s)[:, None] >> np.arange(k)) & 1
                x[j, : len(s), k] = 1
                mask[j, : len(s)] = 1
            batches.append((x, mask, np.array([y for _, y in part], float)))
        theta, m, v = np.zeros(k + 5), np.zeros(k + 5), np.zeros(k + 5)
        for step in range(1, rounds + 1):
            grad = l2 * theta
            for x, mask, y in batches:
                grad = grad + LineCrf._gradient(theta, x, mask, y)
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
            theta = theta - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        return LineCrf(theta[: k + 1], theta[k + 1:].reshape(2, 2))

    @staticmethod
    def _gradient(theta: np.ndarray, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Expected less observed feature counts; all lines of a row have label ``y``."""
        k, (n, t) = x.shape[2], mask.shape
        moves = theta[k:].reshape(2, 2)
        node = np.zeros((n, t, 2))
        node[:, :, 1] = x @ theta[:k]
        alpha, beta = np.zeros((n, t, 2)), np.zeros((n, t, 2))
        alpha[:, 0] = node[:, 0]
        for i in range(1, t):
            step = np.logaddexp(alpha[:, i - 1, :1] + moves[0], alpha[:, i - 1, 1:] + moves[1]) + node[:, i]
            alpha[:, i] = np.where(mask[:, i, None] > 0, step, alpha[:, i - 1])
        for i in range(t - 2, -1, -1):
            ahead = beta[:, i + 1] + node[:, i + 1]
            step = np.logaddexp(ahead[:, :1] + moves[:, 0], ahead[:, 1:] + moves[:, 1])
            beta[:, i] = np.where(mask[:, i + 1, None] > 0, step, 0)
        total = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
        content = np.exp(alpha[:, :, 1] + beta[:, :, 1] - total[:, None]) * mask
        out = np.zeros_like(theta)
        out[:k] = np.einsum("nt,ntk->k", content - y[:, None] * mask, x)
        both = (alpha[:, :-1, :, None] + moves[None, None] + (node[:, 1:] + beta[:, 1:])[:, :, None, :]
                - total[:, None, None, None])
        pair = np.exp(both) * mask[:, 1:, None, None]
        seen = np.zeros((2, 2))
        length = np.maximum(mask.sum(1) - 1, 0)
        seen[0, 0], seen[1, 1] = (length * (1 - y)).sum(), (length * y).sum()
        out[k:] = (pair.sum((0, 1)) - seen).ravel()
        return out


def train(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS) -> LineCrf:
    """A CRF fitted on at most ``limit`` labelled documents, drawn by a hash of
    their ids; the driver gets a number per line and a label per document."""
    drawn = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
             .dropna().dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("y"), pa.array([line_features(t)[0] for t in texts], pa.list_(pa.int32()))],
                ["doc_id", "y", "bits"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = (texts.join(F.broadcast(drawn), "doc_id").mapInArrow(features, "doc_id long, y int, bits array<int>")
            .dropDuplicates(["doc_id"]).toPandas().sort_values("doc_id"))
    return LineCrf.fit([list(b) for b in rows["bits"]], [int(y > 0) for y in rows["y"]])


def judge(text: str | None, crf: LineCrf) -> tuple[int, int, int, int, int, bool, bool]:
    """The values of ``COLUMNS`` for one text."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    chars = len(text) - sum(map(text.count, SPACE))
    symbols = sum(map(text.count, SYMBOLS))
    bits, counts, again = line_features(text)
    repeats = repeated_words(words)
    failed = n < MIN_WORDS or 100 * repeats > MAX_REPEAT_PCT * n
    kept = False
    if not failed:
        marked = crf.decode(bits)
        kept = sum(c for c, y in zip(counts, marked, strict=True) if y) >= MIN_CONTENT * sum(counts)
    return n, chars, symbols, again, repeats, failed, kept


def assess(docs: DataFrame, crf: LineCrf, columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``docs`` (all of them if None) and ``COLUMNS``; one map, no shuffle."""
    docs = docs.withColumn("_text", F.col("text").cast("string"))
    keep = [c for c in (columns if columns is not None else docs.columns) if c not in (*COLUMNS, "_text")]
    docs = docs.select(*keep, "_text")
    kinds = ["long"] * 5 + ["boolean"] * 2
    schema = docs.drop("_text").schema
    for name, kind in zip(COLUMNS, kinds, strict=True):
        schema = schema.add(name, kind)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [judge(t, crf) for t in b.column("_text").to_pylist()]
            made = [pa.array([r[i] for r in rows], pa.int64() if i < 5 else pa.bool_()) for i in range(7)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *made], [*keep, *COLUMNS])

    return docs.mapInArrow(judged, schema)


def retain(docs: DataFrame, crf: LineCrf) -> DataFrame:
    """The rows of ``docs`` that are kept, unchanged."""

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = pa.array([judge(t, crf)[-1] for t in b.column("text").to_pylist()], pa.bool_())
            yield pa.RecordBatch.from_arrays([*b.columns, keep], [*b.schema.names, "__kept"])

    return docs.mapInArrow(marked, docs.withColumn("__kept", F.lit(True)).schema).where("__kept").select(*docs.columns)
