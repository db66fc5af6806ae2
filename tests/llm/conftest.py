"""Documents with every awkward case, shared by the tests of the document operators."""

import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size string, shard string, kept string, "
          "leaks string, chunk string, taken string, n_words string, value string, doc string")


def words(rnd, n):
    return " ".join(rnd.choice(["alpha", "beta", "Gamma", "delta", "der", "éta", "the", "of", "zeta", "x1"]) + rnd.choice(["", "", ".", "s"])
                    for _ in range(n))


def build(seed=7):
    """(doc_id, text, source): nulls, empty, blank and long texts, copies, near copies, shared passages, periodic text, repeated rows."""
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 8))) for _ in range(400)]

    def prose(n):
        return " ".join(rnd.choice(vocabulary) for _ in range(n))

    passage = prose(70)
    rows = [(0, None, "a"), (1, "", "a"), (2, " \t\n ", None), (3, "one", "b"), (4, "Two Words", None), (5, "ab " * 400, "a")]
    base = [prose(rnd.randint(30, 120)) for _ in range(14)]
    for i, text in enumerate(base):
        rows.append((10 + i, text, "abc"[i % 3]))
    for i in range(6):
        rows.append((30 + i, base[0], "a"))
        edited = base[1].split()
        edited[rnd.randrange(len(edited))] = "changed"
        rows.append((40 + i, " ".join(edited), "b"))
        rows.append((50 + i, f"{prose(25)} {passage} {prose(25)}", None))
    rows.append((60, prose(9000), "c"))
    rows.append((61, f"{base[2]}\n{passage.upper()}\n{passage}\n{passage}", "c"))
    rows.append((70, base[3], "c"))
    rows.append((70, base[3], "c"))  # a repeated row
    rows.append((71, "　ünï code \U0001f600 words\x0bhere\x0cand there", "é"))
    rows.append((None, base[4], "a"))
    rows.append((None, None, "a"))
    return rows


@pytest.fixture(scope="session")
def rows():
    return build()


def to_frame(spark, rows):
    full = [(i, t, "en", s, len(t or ""), "s", "h", "k", "l", "c", "t", "w", "v", "d") for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, rows):
    return to_frame(spark, rows).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return to_frame(spark, []).limit(0)


def sort_key(row):
    return tuple((x is not None, x) for x in row)
