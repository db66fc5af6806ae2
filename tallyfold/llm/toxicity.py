"""Toxicity by a weighted lexicon, matched with Aho-Corasick over folded text.

**Folding.**  Texts are compatibility-normalised, case-folded, freed of
invisible characters, Cyrillic and Greek look-alikes become the Latin letters
they imitate, and inside a word the digits and signs that stand for letters
(``1d10t``, ``$tupid``) become those letters.  Accents stay: they tell words of
other languages apart.  A folded text is its words with one space between.

**Lexicon.**  Terms are words whose occurrences in training texts labelled
toxic are far more than chance gives, at ``RATIO`` times the rate in clean
ones or more.  Occurrences are counted by distinct
surroundings (the words before and after), so thousands of copies of one text
count once.  A term's weight is the logarithm of its rate in toxic texts over
its rate in clean ones.  Phrases of a term and a neighbour that occur in clean
texts only, more often than chance gives, are *exception phrases*: a term
inside one does not count.  Callers may give terms and exceptions of their own.

**Score.**  One automaton holds terms and exception phrases with their borders.
The weights of a text's matches are added up, normalised by its length, and a
logistic function fitted on training rows turns the two figures (the sum, the
sum per word) into a score from 0 to 1.

Counting covers all training rows that are labelled, and no text is cut.  Two
bounds are parameters: ``MOST_TERMS`` terms (and as many exception phrases), the
most significant ones, and ``SAMPLE`` labelled rows, those of the smallest
hashed ids, which take part in training.

* Null and empty texts have no matches and the score of such texts.
* A doc_id labelled more than once is toxic if one of its labels is 1; null labels do not count.
* Without toxic or clean training rows there is no lexicon and every score is the base rate (0.5 without labels).
* Repeated rows get equal scores; an empty table gives no rows.
* Only the id and the text are read; other columns are ignored, whatever their names are.
* Texts of any length are matched in one pass; a batch of rows is held at a time.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

MOST_TERMS, SAMPLE = 8192, 200_000
#: Candidate words whose surroundings are counted, per term that may be kept.
CANDIDATES = 2
#: Distinct surroundings that a term needs in toxic texts.
LEAST = 3
#: How many times a term's rate in toxic texts must be that in clean ones; lesser words only tell topics and languages.
RATIO, CANDIDATE_RATIO = 5.0, 1.5
THRESHOLD = 0.7

# Letters of other scripts that look like Latin ones, and signs that stand for letters.
CYRILLIC = dict(zip("авеікмнорстухјѕһԁԛԝ", "abeikmhopctyxjshdqw", strict=True))
GREEK = dict(zip("αβεικνορτυχη", "abeikvoptuxn", strict=True))
LATIN = {"ı": "i", "ł": "l", "ø": "o", "đ": "d", "ɡ": "g", "ɑ": "a"}
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i"}

SIMILAR = CYRILLIC | GREEK | LATIN
LOOKALIKES, ANY_SIMILAR = str.maketrans(SIMILAR), re.compile("[" + "".join(SIMILAR) + "]")
SUBSTITUTES = str.maketrans(SIGNS)
#: A word: letters and digits, and signs that a letter or digit follows (the plain form is for texts without such a sign).
TOKEN = re.compile(r"(?:[^\W_]|[@$!](?=[@$!]*[^\W_]))+")
PLAIN, SIGNED, DIGIT = re.compile(r"[^\W_]+"), re.compile(r"[@$!][^\W_]"), re.compile(r"\d")
LETTER, FOREIGN_SIGN = re.compile(r"[^\W\d_]"), re.compile(r"[^\w\x00-\x7f]")
#: ASCII bytes that are no letter or digit become blanks.
BLANKS = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
# Ranges of code points that are not seen.
HIDDEN = [(0xAD, 0xAD), (0x34F, 0x34F), (0x61C, 0x61C), (0x180E, 0x180E), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x2064),
          (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF)]
INVISIBLE = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in HIDDEN) + "]")


def fold(text: str | None) -> list[str]:
    """The folded words of a text."""
    if not text:
        return []
    if text.isascii():
        text = text.lower()
    else:
        text = unicodedata.normalize("NFKC", INVISIBLE.sub("", text)).casefold()
        if ANY_SIMILAR.search(text):
            text = text.translate(LOOKALIKES)
    signed = SIGNED.search(text)
    if signed:
        words = TOKEN.findall(text)
    elif FOREIGN_SIGN.search(text):
        words = PLAIN.findall(text)
    else:  # the same words, faster
        words = text.encode().translate(BLANKS).decode().split()
    if signed or DIGIT.search(text):
        words = [w if w.isalpha() else w.translate(SUBSTITUTES) for w in words if LETTER.search(w)]
    return words


def features(total: float, n_words: float) -> tuple[float, float, float]:
    """Constant, the matches' weight per word and the weight itself, both damped."""
    return 1.0, math.log1p(100.0 * total / (n_words + 30)), math.log1p(total)


@dataclass
class Lexicon:
    """Weighted terms, exception phrases, and the logistic function of the score."""

    terms: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    slope: tuple[float, float, float] = (-4.0, 1.0, 1.0)
    base: float | None = None

    def automaton(self) -> ahocorasick.Automaton | None:
        """Terms (with weight) and exception phrases (without), each between borders."""
        a = ahocorasick.Automaton()
        for term, weight in self.terms.items():
            a.add_word(f" {term} ", (len(term) + 2, weight))
        for phrase in self.exceptions:
            if phrase not in self.terms:
                a.add_word(f" {phrase} ", (len(phrase) + 2, None))
        if not len(a):
            return None
        a.make_automaton()
        return a

    def weight(self, automaton: ahocorasick.Automaton | None, words: list[str]) -> float:
        """The weights of all matches outside exception phrases."""
        if automaton is None or not words:
            return 0.0
        found = [(end - size + 1, end, weight) for end, (size, weight) in automaton.iter(f" {' '.join(words)} ")]
        spared = sorted((a, b) for a, b, w in found if w is None)
        starts, reach = [a for a, _ in spared], list(accumulate((b for _, b in spared), max))
        total = 0.0
        for a, b, w in found:
            before = bisect_right(starts, a)
            if w is not None and not (before and reach[before - 1] >= b):
                total += w
        return total

    def chance(self, total: float, n_words: int) -> float:
        if self.base is not None:
            return self.base
        z = sum(a * b for a, b in zip(self.slope, features(total, n_words), strict=True))
        return 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, z))))

    def score(self, docs: DataFrame) -> DataFrame:
        """``doc_id``, ``n_words``, ``weight`` (of the matches) and ``score`` of every row."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = self.automaton()
            for b in batches:
                n, weights, scores = [], [], []
                for text in b.column(1):
                    words = fold(text.as_py())
                    n.append(len(words))
                    weights.append(self.weight(automaton, words))
                    scores.append(self.chance(weights[-1], n[-1]))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(n, pa.int64()), pa.array(weights, pa.float64()), pa.array(scores, pa.float64())],
                    ["doc_id", "n_words", "weight", "score"])

        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string")).mapInArrow(
            run, "doc_id long, n_words long, weight double, score double")

    def figures(self, lines: DataFrame) -> DataFrame:
        """``y``, ``n_words`` and ``weight`` of folded lines."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = self.automaton()
            for b in batches:
                lines = [line.as_py().split(" ") if line.as_py() else [] for line in b.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([len(w) for w in lines], pa.int64()),
                     pa.array([self.weight(automaton, w) for w in lines], pa.float64())], ["y", "n_words", "weight"])

        return lines.select("y", "line").mapInArrow(run, "y int, n_words long, weight double")


def held_out(doc_id: Column) -> Column:
    """Rows that teach nothing: crc32 of the id's text modulo 3 is 1 (null: empty text)."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 3 == 1


def labelled(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """``doc_id``, ``text`` and ``y`` of at most ``sample`` labelled training ids."""
    known = labels.select(F.col("doc_id").cast("long").alias("its"), F.col("toxic").cast("int").alias("y"))
    known = known.where(F.col("its").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("its")))
    few = known.groupBy("its").agg(F.max("y").alias("y")).orderBy(F.xxhash64("its"), "its").limit(sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.join(F.broadcast(few), F.col("doc_id") == F.col("its")).drop("its")  # at most `sample` rows of 12 bytes


def folded_lines(rows: DataFrame) -> DataFrame:
    """``y`` and the folded words, with one space between, of every training row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([" ".join(fold(t.as_py())) for t in b.column(1)], pa.string())], ["y", "line"])

    return rows.select("y", "text").mapInArrow(run, "y int, line string")


def word_counts(lines: DataFrame) -> DataFrame:
    """How often each folded word occurs in clean and in toxic texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen = (Counter(), Counter())
            for y, line in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                seen[y].update(line.as_py().split())
            words = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array([seen[0][w] for w in words], pa.int64()),
                 pa.array([seen[1][w] for w in words], pa.int64())], ["word", "clean", "toxic"])

    found = lines.select("y", "line").mapInArrow(run, "word string, clean long, toxic long")
    return found.groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def surroundings(lines: DataFrame, words: set[str]) -> DataFrame:
    """The distinct (word before, word, word after) of ``words`` in clean and in toxic texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen = set()
            for y, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                line = ["", *text.as_py().split(), ""]
                seen.update((line[i - 1], w, line[i + 1], y) for i, w in enumerate(line) if w in words)
            cols = list(zip(*seen, strict=True)) if seen else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.string()) for c in cols[:3]], pa.array(cols[3], pa.int32())],
                                             ["before", "word", "after", "y"])

    return lines.select("y", "line").mapInArrow(run, "before string, word string, after string, y int").distinct()


def surprise(toxic: Column, clean: Column, share: Column) -> Column:
    """How unlikely (as a negative logarithm, by the Chernoff bound) so large a toxic part is if the true one is ``share``."""
    n, eps = toxic + clean, F.lit(1e-12)
    q = toxic / n
    bound = n * (F.when(q > 0, q * F.ln(q / share)).otherwise(0.0)
                 + F.when(q < 1, (1 - q) * F.ln((1 - q) / F.greatest(1 - share, eps))).otherwise(0.0))
    return F.when(q > share, bound).otherwise(0.0)


def fit(points: list[tuple[tuple[float, ...], int, int]]) -> tuple[float, float, float]:
    """Logistic regression by Newton steps on (features, label, count), lightly damped; slopes are not negative."""
    x = np.array([p[0] for p in points])
    y, n = np.array([p[1] for p in points], float), np.array([p[2] for p in points], float)
    free, w = [0, 1, 2], np.zeros(3)
    while True:
        w = np.zeros(3)
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(x[:, free] @ w[free], -50, 50)))
            penalty = np.array([1e-3, 1e-2, 1e-2])[free]
            g = x[:, free].T @ (n * (p - y)) + penalty * w[free]
            h = (x[:, free] * (n * p * (1 - p) + 1e-9)[:, None]).T @ x[:, free] + np.diag(penalty)
            step = np.linalg.solve(h, g)
            w[free] -= np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-8:
                break
        bad = [i for i in free if i and w[i] < 0]
        if not bad:
            return tuple(float(v) for v in w)
        free = [i for i in free if i != min(bad, key=lambda i: w[i])]


def learn(docs: DataFrame, labels: DataFrame, terms: dict[str, float] | None = None, exceptions: tuple[str, ...] = (),
          most: int = MOST_TERMS, sample: int = SAMPLE) -> Lexicon:
    """The lexicon of the labelled training rows, and the caller's ``terms`` and ``exceptions``."""
    given = {" ".join(fold(t)): w for t, w in (terms or {}).items()}
    spared = [" ".join(fold(t)) for t in exceptions]
    rows = labelled(docs, labels, sample)
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("t")).first()
    if not size["n"] or size["t"] in (0, size["n"]):
        base = (size["t"] + 0.5) / (size["n"] + 1.0)
        return Lexicon(given, spared, base=None if given else base)

    lines = materialize(folded_lines(rows), "toxicity-lines")
    counts = materialize(word_counts(lines), "toxicity-words")
    all_words = counts.agg(F.count(F.lit(1)).alias("v"), F.sum("toxic").alias("t"), F.sum("clean").alias("c")).first()
    rate = F.lit((all_words["t"] or 0) / max(1, (all_words["t"] or 0) + (all_words["c"] or 0)))
    # Words of nearly the same rate in both (common words, those of a language) are no candidates.
    enough = F.col("toxic") * float((all_words["c"] or 0) + 1) >= CANDIDATE_RATIO * F.col("clean") * float((all_words["t"] or 0) + 1)
    odd = surprise(F.col("toxic"), F.col("clean"), rate)
    likely = counts.where((F.col("toxic") >= LEAST) & enough).withColumn("odd", odd).where("odd > 0")
    words = {r["word"] for r in likely.orderBy(F.desc("odd"), "word").limit(CANDIDATES * most).select("word").collect()}

    around = materialize(surroundings(lines, words), "toxicity-surroundings")
    sides = F.array(F.when(F.col("before") != "", F.concat_ws(" ", "before", "word")),
                    F.when(F.col("after") != "", F.concat_ws(" ", "word", "after")))
    vocabulary = math.log(max(2, all_words["v"] or 2))
    toxic, clean = F.sum("y"), F.sum(1 - F.col("y"))
    per_word = around.groupBy("word").agg(toxic.alias("toxic"), clean.alias("clean")).withColumn(
        "odd", surprise(F.col("toxic"), F.col("clean"), rate))
    # A term's odds must beat the chance that any word of the vocabulary looks as toxic.
    kept = per_word.where((F.col("toxic") >= LEAST) & (F.col("odd") > vocabulary)).orderBy(F.desc("odd"), "word").limit(most)
    found = {r["word"]: (r["toxic"], r["clean"]) for r in kept.collect()}

    # Phrases that stand in clean texts alone, though half of the term's surroundings or more are toxic.
    doubtful = [w for w, (t, c) in found.items() if c >= LEAST]
    mild = set(spared)
    if doubtful:
        phrases = around.where(F.col("word").isin(doubtful)).select("word", F.explode(sides).alias("phrase"), "y").where(
            "phrase is not null").groupBy("word", "phrase").agg(toxic.alias("toxic"), clean.alias("clean"))
        shares = {w: t / (t + c) for w, (t, c) in found.items()}
        top = phrases.where(f"toxic = 0 and clean >= {LEAST}").orderBy(F.desc("clean"), "phrase").limit(most).collect()
        n = math.log(max(2, len(top)))
        mild |= {r["phrase"] for r in top if -r["clean"] * math.log(max(1e-12, 1 - shares[r["word"]])) > n + vocabulary}
        lost = Counter()
        for r in top:
            lost[r["word"]] += r["clean"] if r["phrase"] in mild else 0
        found = {w: (t, max(0, c - lost[w])) for w, (t, c) in found.items()}
    n_toxic, n_clean = (all_words["t"] or 0) + 1.0, (all_words["c"] or 0) + 1.0
    weights = {w: math.log((t + 0.5) / n_toxic) - math.log((c + 0.5) / n_clean) for w, (t, c) in found.items()}
    lexicon = Lexicon({w: v for w, v in weights.items() if v >= math.log(RATIO)} | given, sorted(mild))

    # Figures of the training rows in steps of a twentieth of their logarithm: a small table at any size.
    def step(x):
        return F.expm1(F.round(F.log1p(x) * 20) / 20)

    grid = lexicon.figures(lines).groupBy(step(F.col("weight")).alias("w"), step(F.col("n_words").cast("double")).alias("n"),
                                          "y").agg(F.count(F.lit(1)).alias("k")).collect()
    points = [(features(r["w"], r["n"]), r["y"], r["k"]) for r in grid]
    lexicon.slope = fit(points)
    return lexicon
