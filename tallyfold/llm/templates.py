"""Line dedup by a log-template tree (native).

Lines are tokenised at white space and tokens with a digit become the field
``<*>``.  A line that two documents or more have, equal after masking, recurs,
whatever its length (a line of fields alone must be equal as it is).

Lines that are not equal may still be of one template.  A tree of fixed depth
sorts lines by token count and then by their first ``LEADING`` tokens.  In a
leaf, a token is constant at a later position if it stands there in at least
``MIN_DOCS`` documents and in half of the leaf's documents; all else
generalises to ``<*>``.  The leading tokens, which all lines of the leaf share,
tell nothing and do not count.  A template is recurring if half of its later
tokens are constant and ``MIN_DOCS`` documents or more have a line of it.
Recurring lines and all lines of recurring templates are dropped, in all documents.

Lines are counted on digests first (128 bits for a line), so that only lines of
leaves that enough documents share, with different lines in them, are looked at
token by token; equal lines are counted together before that, so a line which a
third of all documents carry is one row there.

A document is told by its id and a digest of its text: repeated rows count as
one document and get equal results.  Null and empty texts have no lines; lines
without a token are kept.  Null ids are ids like others.  An empty table gives
no rows.  Lines and texts may be of any length.  Columns of ``docs`` pass
through, but for ``n_lines``, ``n_dropped`` and ``kept_text``, which are
replaced; no other name clashes with the operator's own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import free_name

LEADING, MIN_DOCS, MIN_EQUAL = 3, 5, 2
#: Share of constant tokens that a template needs behind the leading ones, and share of
#: a leaf's documents in which a constant token stands.
MIN_CONSTANT = 0.5
FIELD = "<*>"
SPACES = r"[\x20\x09-\x0D]+"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def tokens_of(line: Column) -> Column:
    return F.filter(F.split(line, SPACES), lambda t: t != "")


def field(token: Column) -> Column:
    return F.when(token.rlike("[0-9]"), F.lit(FIELD)).otherwise(token)


def is_plain(line: Column) -> Column:
    """Tokens are separated by single blanks and nothing else; most lines are, and need no array of tokens."""
    odd = F.contains(line, F.lit("  ")) | F.startswith(line, F.lit(" ")) | F.endswith(line, F.lit(" "))
    for c in "\t\x0b\x0c\r":
        odd = odd | F.contains(line, F.lit(c))
    return ~odd


def masked(line: Column) -> Column:
    """The line's tokens joined by one space, those with a digit as fields."""
    return F.when(is_plain(line) & ~line.rlike("[0-9]"), line).otherwise(
        F.array_join(F.transform(tokens_of(line), field), " "))


def equal_key(line: Column) -> Column:
    """What must be equal for a line to recur: the masked line, or the tokens themselves if all are fields."""
    return F.when(is_plain(line) & ~line.rlike("[0-9]"), line).otherwise(bind(tokens_of(line), lambda w: F.when(
        F.forall(w, lambda t: t.rlike("[0-9]")), F.array_join(w, " ")).otherwise(F.array_join(F.transform(w, field), " "))))


def token_count(line: Column) -> Column:
    """Number of tokens; that of a plain line is told by its length without blanks."""
    plain = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1
    return F.when(line == "", F.lit(0)).when(is_plain(line), plain).otherwise(F.size(tokens_of(line)))


def leaf_of(line: Column) -> Column:
    """A digest of a raw line's place in the tree: token count and leading tokens."""
    first = F.substring_index(line, " ", LEADING)
    any_line = F.array_join(F.transform(F.slice(tokens_of(line), 1, LEADING), field), " ")
    head = F.when(is_plain(first) & ~first.rlike("[0-9]") & is_plain(line), first).otherwise(any_line)
    return F.xxhash64(token_count(line), head)


def doc_key() -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")))


def split_lines(docs: DataFrame, *more: str) -> DataFrame:
    """``doc`` (a digest of id and text), ``pos`` and ``raw`` of every line."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(doc_key().alias("doc"), *more, F.posexplode(F.split(text, "\n", -1)).alias("pos", "raw"))


def placed_lines(docs: DataFrame) -> DataFrame:
    """``doc``, ``pos``, the digests ``h1`` and ``h2`` of the line, and its ``leaf`` (lines with later tokens)."""
    raw, key = F.col("raw"), equal_key(F.col("raw"))
    leaf = F.when(token_count(raw) > LEADING, leaf_of(raw))
    hashed = bind(key, lambda k: F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(F.lit("line"), k).alias("h2")))
    found = split_lines(docs).where(token_count(raw) > 0).select("doc", "pos", leaf.alias("leaf"), hashed.alias("h"))
    return materialize(found.select("doc", "pos", "leaf", "h.h1", "h.h2"), "lines")


def equal_lines(placed: DataFrame) -> DataFrame:
    """``doc`` and ``pos`` of the lines that two documents or more have."""
    often = (placed.select("h1", "h2", "doc").distinct().groupBy("h1", "h2").count()
             .where(F.col("count") >= MIN_EQUAL))
    return placed.join(often, ["h1", "h2"], "left_semi").select("doc", "pos")


def candidate_lines(docs: DataFrame, placed: DataFrame) -> DataFrame:
    """``doc``, ``pos``, ``leaf``, ``hash`` and masked ``line`` of the lines in leaves that enough documents share
    and that hold more than one line."""
    within = placed.where("leaf is not null")
    shared = (within.select("leaf", "doc", "h1").distinct().groupBy("leaf", "doc").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi"))
              .groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
              .where((F.col("n") >= MIN_DOCS) & (F.col("lo") < F.col("hi"))))
    wanted = (within.join(shared, "leaf", "left_semi").groupBy("doc")
              .agg(F.collect_set(F.struct("pos", "leaf")).alias("at")).withColumnRenamed("doc", "key"))
    texts = docs.select("doc_id", "text").join(wanted, doc_key() == F.col("key"))
    every = split_lines(texts, F.map_from_entries("at").alias("leaves"))
    found = every.withColumn("leaf", F.try_element_at("leaves", F.col("pos"))).where("leaf is not null")
    line = masked(F.col("raw"))
    return materialize(found.select("doc", "pos", "leaf", line.alias("line"), F.xxhash64(line).alias("hash")), "candidate-lines")


def enough(docs: Column, of: Column) -> Column:
    return (docs >= MIN_DOCS) & (docs >= MIN_CONSTANT * of)


def recurring(found: DataFrame) -> DataFrame:
    """``leaf`` and ``hash`` of the masked lines that have a recurring template, and that ``template``.

    Documents are counted one by one only where the documents per line do not tell:
    at least those of the line with the most of them, at most their sum."""
    each = found.select("leaf", "hash", "doc").distinct()
    counted = each.groupBy("leaf", "hash").agg(F.count(F.lit(1)).alias("docs"))
    size = each.select("leaf", "doc").distinct().groupBy("leaf").agg(F.count(F.lit(1)).alias("of"))
    lines = materialize(found.groupBy("leaf", "hash").agg(F.min("line").alias("line")).join(counted, ["leaf", "hash"]), "template-lines")
    tokens = lines.select("leaf", "hash", "docs", F.posexplode(F.split("line", " ")).alias("at", "token"))
    later = tokens.where((F.col("at") >= LEADING) & (F.col("token") != FIELD))
    spot = ["leaf", "at", "token"]
    likely = later.groupBy(*spot).agg(F.sum("docs").alias("most"), F.max("docs").alias("least")).join(size, "leaf").where(
        enough(F.col("most"), F.col("of")))
    unsure = likely.where(~enough(F.col("least"), F.col("of"))).select(*spot)
    exact = (later.join(unsure, spot).select("hash", *spot).join(each, ["leaf", "hash"])
             .select(*spot, "doc").distinct().groupBy(*spot).agg(F.count(F.lit(1)).alias("n")))
    constant = likely.join(exact, spot, "left").where(enough(F.coalesce("n", "least"), F.col("of"))).select(
        *spot, F.lit(1).alias("constant"))
    general = tokens.join(constant, spot, "left").groupBy("leaf", "hash").agg(
        F.first("docs").alias("docs"), F.sum("constant").alias("constants"), F.count(F.lit(1)).alias("n"),
        F.array_sort(F.collect_list(F.struct("at", F.when(F.col("constant").isNull() & (F.col("at") >= LEADING), F.lit(FIELD))
                                             .otherwise(F.col("token")).alias("token")))).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["token"]), " ")
    kept = general.where(F.col("constants") >= MIN_CONSTANT * (F.col("n") - LEADING)).select(
        "leaf", "hash", "docs", bind(text, lambda t: F.concat_ws(":", F.xxhash64(t), F.xxhash64(F.lit("template"), t))).alias("template"))
    kept = materialize(kept, "templates")
    seen = kept.groupBy("leaf", "template").agg(F.sum("docs").alias("most"), F.max("docs").alias("least")).where(F.col("most") >= MIN_DOCS)
    counted_docs = (kept.join(seen.where(F.col("least") < MIN_DOCS).select("leaf", "template"), ["leaf", "template"])
                    .join(each, ["leaf", "hash"]).select("leaf", "template", "doc").distinct()
                    .groupBy("leaf", "template").agg(F.count(F.lit(1)).alias("n")))
    often = seen.join(counted_docs, ["leaf", "template"], "left").where(F.coalesce("n", "least") >= MIN_DOCS).select("leaf", "template")
    return kept.join(often, ["leaf", "template"]).select("leaf", "hash", "template")


def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and ``kept_text`` (null texts as empty)."""
    given = docs.drop("n_lines", "n_dropped", "kept_text")
    lost, key = free_name("gone", given.columns), free_name("its_doc", given.columns)
    placed = placed_lines(given)
    found = candidate_lines(given, placed)
    by_template = found.join(recurring(found), ["leaf", "hash"], "left_semi").select("doc", "pos")
    dropped = (equal_lines(placed).unionByName(by_template)
               .groupBy("doc").agg(F.collect_set("pos").alias(lost)).withColumnRenamed("doc", key))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    gone = F.coalesce(F.col(lost), F.array().cast("array<int>"))
    marks = F.map_from_entries(F.transform(gone, lambda p: F.struct(p, F.lit(True))))
    stay = bind(marks, lambda m: F.array_join(F.filter(
        F.split(text, "\n", -1), lambda line, i: F.try_element_at(m, i).isNull()), "\n"))
    return (given.join(dropped, doc_key() == F.col(key), "left")
            .withColumn("n_lines", F.when(text == "", F.lit(0)).otherwise(F.size(F.split(text, "\n", -1))).cast("long"))
            .withColumn("n_dropped", F.size(gone).cast("long"))
            .withColumn("kept_text", F.when(F.col("n_dropped") == 0, text).otherwise(stay)).drop(lost, key))
