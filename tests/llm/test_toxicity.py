"""Toxicity: folding, lexicon, exceptions, held-out accuracy."""

import random
import zlib

from tallyfold.llm import toxicity as T
from tallyfold.llm.queries import op11_toxicity

DOCS = "doc_id long, text string, lang string, source string, score string, word string, y string, toxic string, its string, weight string"


def docs_frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", "1", "w", "y", "t", "i", "w") for i, t in rows], DOCS)


def labels_frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def corpus(n=600, seed=1):
    """Clean prose, and toxic prose with one of three bad words; 'dash' is bad, but not in 'mad dash'."""
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(3, 8))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        words = rnd.choices(vocabulary, k=rnd.randint(5, 120))
        bad = i % 6 == 0
        if bad:
            for _ in range(1 + len(words) // 30):
                words.insert(rnd.randrange(len(words)), rnd.choice(["Zork", "blarg!!", "dash,"]))
        elif i % 4 == 1:
            words.insert(rnd.randrange(len(words)), "mad dash")
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return docs, labels


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_folding():
    hidden = f"i{chr(0x200B)}diot"
    assert T.fold(f"Ｚörk 1d10t $TUPID tr4sh!! {hidden} асе 2024 a-b") == [
        "zörk", "idiot", "stupid", "trash", "idiot", "ace", "a", "b"]
    assert T.fold(None) == T.fold("") == T.fold(" \t 12 !!") == []
    assert T.fold("GROẞ") == ["gross"]


def test_lexicon_of_given_terms(spark):
    lexicon = T.Lexicon({"trash": 2.0, "total loser": 3.0}, ["trash can"], slope=(-4.0, 2.0, 1.0))
    a = lexicon.automaton()
    assert lexicon.weight(a, T.fold("Trash trash-can tr4sh")) == 4.0
    assert lexicon.weight(a, T.fold("a TOTAL l0ser")) == 3.0
    assert lexicon.weight(a, T.fold("trashy losers total")) == 0.0
    # Equal weight in a longer text gives a lower score.
    assert lexicon.chance(2.0, 10) > lexicon.chance(2.0, 1000) > lexicon.chance(0.0, 1000)
    rows = lexicon.score(docs_frame(spark, [(1, "trash"), (2, None), (2, None), (None, "trash can " * 100_000)])).collect()
    assert [r["weight"] for r in sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"]))] == [2.0, 0.0, 0.0, 0.0]


def test_learned_lexicon_and_held_out_accuracy(spark):
    docs, labels = corpus()
    lexicon = T.learn(docs_frame(spark, docs).repartition(3), labels_frame(spark, labels))
    assert {"zork", "blarg", "dash"} <= set(lexicon.terms) and len(lexicon.terms) <= 5
    assert "mad dash" in lexicon.exceptions
    got = {r["doc_id"]: r["score"] for r in lexicon.score(docs_frame(spark, docs)).collect()}
    right = [(got[i] >= T.THRESHOLD) == bool(y) for i, _, y in labels if held(i)]
    assert sum(right) >= 0.97 * len(right) and all(0 <= s <= 1 for s in got.values())
    # Disguises and a text of its own.
    more = [(1, "you z0rk dear friend"), (2, "a mad dash for it"), (3, "Blаrg you there")]
    found = {r["doc_id"]: r["weight"] for r in lexicon.score(docs_frame(spark, more)).collect()}
    assert found[1] > 0 and found[2] == 0 and found[3] > 0


def test_copies_count_once_and_held_out_rows_teach_nothing(spark):
    docs, labels = corpus()
    copies = [(10_000 + i, "perfectly harmless sentence about gardening today") for i in range(500)]
    hidden = [(i, "secretword here") for i in range(20_000, 20_300) if held(i)]
    lexicon = T.learn(docs_frame(spark, docs + copies + hidden),
                      labels_frame(spark, labels + [(i, 1, 1) for i, _ in copies + hidden]))
    assert not {"gardening", "harmless", "secretword"} & set(lexicon.terms)
    assert {"zork", "blarg"} <= set(lexicon.terms)


def test_degenerate_labels(spark):
    docs = docs_frame(spark, [(0, "a"), (2, None), (5, "")])
    assert T.learn(docs, labels_frame(spark, [])).base == 0.5
    one = T.learn(docs, labels_frame(spark, [(0, 1, 1), (0, 1, 0), (2, 1, None), (None, 1, 1)]))
    assert one.base == 0.75 and {r["score"] for r in one.score(docs).collect()} == {0.75}
    assert T.learn(docs.limit(0), labels_frame(spark, [(0, 1, 1)])).score(docs.limit(0)).collect() == []
    empty = T.learn(docs_frame(spark, [(0, ""), (3, None)]), labels_frame(spark, [(0, 1, 1), (3, 1, 0)]))
    assert empty.terms == {} and all(0 < r["score"] < 1 for r in empty.score(docs).collect())


def test_query_on_the_given_tables(spark):
    sf = "/root/testdata/sf0.1"
    found = op11_toxicity(spark, sf).cache()
    assert found.count() == 10_000 and found.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = found.where("held_out").join(labels, "doc_id").collect()
    assert all(held(r["doc_id"]) for r in rows)
    hits = [r["predicted"] for r in rows if r["toxic"]]
    false = [r["predicted"] for r in rows if not r["toxic"]]
    print(sum(hits) / len(hits), sum(false) / len(false))
    assert sum(hits) >= 0.85 * len(hits) and sum(false) <= 0.02 * len(false)
