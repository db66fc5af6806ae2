"""Personal data by bootstrapped contextual extraction (native).

Seeds are what four expressions find (email, ip, card, phone); each is one known
instance, and of overlapping seeds the longest is.  Tokens with a digit or an at
sign are candidates; those that a seed overlaps stand together as its place, all
others are unknown.  The words around a place in its line are its lexical
patterns (word before, two words before, word before and word after);
neighbouring candidates are one placeholder there, however many they are.
The bipartite graph of patterns and instances is
scored in rounds: a pattern's confidence is the mean confidence of its distinct
instances, counted from ``MIN_KNOWN`` known ones on, and an instance's is its
best pattern's.  Unknown candidates of at least ``MIN_CHARS`` letters or digits whose
confidence reaches ``CONFIDENT`` join the known ones; after the last round they
are reported as spans of kind ``id``.

Positions are code points, end exclusive.  Null and empty texts have no spans;
repeated rows are separate documents; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: Fixed expressions, in the order in which kinds are listed.
KINDS = ("email", "ip", "card", "phone", "id")
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
CANDIDATE = r"[^\x20\x09-\x0D]*[0-9@][^\x20\x09-\x0D]*"
SPACES = r"[\x20\x09-\x0D]+"
#: What Spark's (Java's) engine runs in place of the above, with the same leftmost matches: no group repeats by recursion
#: and no character is scanned from more than a few starts, however long a run of digits or a token is.
JAVA = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9](?:[\x20-]?[0-9])++", PHONE,
        r"(?:^|(?<=[\x20\x09-\x0D]))[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+")
#: Code points around a candidate in which its pattern words are looked for first, and then in the whole line.
REACH = 120
#: Stands for the candidates beside a candidate among its words.
OTHER = "<*>"
ROUNDS, MIN_KNOWN, CONFIDENT = 3, 3, 0.6
#: Letters and digits that an identifier has at least.
MIN_CHARS = 4


def words(part: Column) -> Column:
    return F.filter(F.split(F.lower(part), SPACES), lambda w: w != "")


def words_before(gap: Column) -> Column:
    """The last two words of the line that ``gap`` ends with, the nearest first."""
    line = F.substring_index(gap, "\n", -1)
    whole = F.length(line) <= REACH
    near = words(F.regexp_replace(F.right(line, F.lit(REACH)), r"^[^\x20\x09-\x0D]+", ""))
    found = F.when(whole, words(line)).when(F.size(near) >= 2, near).otherwise(words(line))
    return F.slice(F.reverse(found), 1, 2)


def word_after(gap: Column) -> Column:
    """The first word of the line that ``gap`` begins with."""
    line = F.substring_index(gap, "\n", 1)
    whole = F.length(line) <= REACH
    near = words(F.regexp_replace(F.left(line, F.lit(REACH)), r"[^\x20\x09-\x0D]+$", ""))
    found = F.when(whole, words(line)).when(F.size(near) >= 1, near).otherwise(words(line))
    return F.try_element_at(found, F.lit(1))


def hits(text: Column, pattern: str, possible: Column, kind: int) -> Column:
    """Array of the leftmost matches in order: ``gap``, the length of the text
    since the last one, and ``hit``; candidates' also with the words around and
    whether the last one is in the same line (``joined``).  ``possible`` is a
    cheap test without which nothing can match."""
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    near = F.lit(kind == 4)
    made = F.transform(
        F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("hit"),
                     F.slice(gaps, 2, F.size(found) + 1).alias("tail")),
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("pos"), F.length(x["gap"]).alias("gap"), x["hit"].alias("hit"),
            F.when(near, words_before(x["gap"])).alias("before"), F.when(near, word_after(x["tail"])).alias("after"),
            F.when(near, (i > 0) & ~F.contains(x["gap"], F.lit("\n"))).alias("joined")))
    empty = F.array().cast("array<struct<kind:int,pos:int,gap:int,hit:string,before:array<string>,after:string,joined:boolean>>")
    return F.coalesce(F.when(possible, made), empty)


def luhn(digits: Column) -> Column:
    turned = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(turned, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def is_valid(kind: Column, hit: Column) -> Column:
    """Whether a base match stays: parts, digits and check sum by kind."""
    digits = F.regexp_replace(hit, "[^0-9]", "")
    n = F.length(digits)
    parts = F.transform(F.split(hit, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    small = F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(256)) <= 255))
    return (F.when(kind == 0, F.lit(True)).when(kind == 1, small)
            .when(kind == 2, n.between(14, 19) & luhn(digits)).when(kind == 3, n.between(10, 15))
            .otherwise(F.lit(True)))


def find_matches(docs: DataFrame) -> DataFrame:
    """One row per match of the four expressions or the candidates' (kind 4),
    and one with a null kind for each document without any; ``_row`` tells the
    documents apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    digit, at, plus = text.rlike("[0-9]"), F.contains(text, F.lit("@")), F.contains(text, F.lit("+"))
    one = [hits(text, p, possible, k)
           for k, (p, possible) in enumerate(zip(JAVA, (at, digit, digit, digit & plus, digit | at), strict=True))]
    # The row number is taken before the matches are spread over rows.
    numbered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("_row"),
                           F.concat(*one).alias("m"))
    return numbered.select("_row", "doc_id", F.explode_outer("m").alias("m")).select("_row", "doc_id", "m.*")


def place(found: DataFrame) -> DataFrame:
    """Matches with ``start`` and ``end`` (code points); failing base matches go."""
    so_far = (Window.partitionBy("_row", "kind").orderBy("pos")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    end = F.sum(F.col("gap") + F.length("hit")).over(so_far)
    placed = found.where("kind is not null").withColumn("end", end.cast("int"))
    placed = placed.withColumn("start", F.col("end") - F.length("hit"))
    return placed.where(is_valid(F.col("kind"), F.col("hit")))


def candidates(placed: DataFrame) -> DataFrame:
    """Known instances (``value`` of a seed) and unknown candidates, cut to their
    core (no marks around it), with the patterns of the place that they stand in."""
    order = Window.partitionBy("_row").orderBy("start", "end", "kind")
    before, so_far = (order.rowsBetween(Window.unboundedPreceding, last) for last in (-1, Window.currentRow))
    seed = F.col("kind") < 4

    def begins(reach: Column) -> Column:
        return F.coalesce(F.col("start") >= F.max(reach).over(before), F.lit(True))

    # Matches that overlap are one place; the seeds among them that overlap each other are one instance.
    marked = (placed.withColumn("_place", begins(F.col("end")).cast("int"))
              .withColumn("_seed", (seed & begins(F.when(seed, F.col("end")))).cast("int"))
              .withColumn("_place", F.sum("_place").over(so_far)).withColumn("_seed", F.sum("_seed").over(so_far)))
    longest = Window.partitionBy("_row", "_seed", seed).orderBy(F.length("hit").desc(), "kind")
    marked = marked.withColumn("_best", seed & (F.row_number().over(longest) == 1))
    first, last = (F.when(~seed, F.col("start")), F.when(~seed, F.col("end")))
    places = marked.groupBy("_row", "_place").agg(
        F.min_by(F.struct("before", "joined", "hit", "start"), first).alias("c"), F.max_by("after", last).alias("after"),
        F.collect_list(F.when(F.col("_best"), F.col("hit"))).alias("seeds")).select("_row", "_place", "c.*", "after", "seeds")

    line = Window.partitionBy("_row").orderBy("_place")
    own, own2 = F.get("before", F.lit(0)), F.get("before", F.lit(1))
    listed = F.col("joined") & own.isNull()
    head = F.last(F.when(~listed, F.struct(own.alias("word"))), ignorenulls=True).over(
        line.rowsBetween(Window.unboundedPreceding, Window.currentRow))["word"]
    around = places.select(
        "*", listed.alias("_listed"), F.when(listed, F.lit(OTHER)).otherwise(own).alias("one"),
        F.when(listed, head).otherwise(F.coalesce(own2, F.when(own.isNotNull() & F.col("joined"), F.lit(OTHER)))).alias("two"),
        F.coalesce("after", F.when(F.lead("joined").over(line), F.lit(OTHER))).alias("next"))
    one, two = F.col("one"), F.col("two")
    patterns = F.array(F.when(~F.col("_listed") | two.isNull(), F.concat(F.lit("before:"), one)),
                       F.concat(F.lit("before2:"), two, F.lit(" "), one),
                       F.concat(F.lit("around:"), one, F.lit(" "), F.col("next")))

    lead = F.length(F.regexp_extract("hit", r"^[^\p{L}\p{N}+@]*+", 0))
    tail = F.length(F.regexp_extract(F.reverse("hit"), r"^[^\p{L}\p{N}]*+", 0))
    core = F.substring("hit", lead + 1, F.greatest(F.length("hit") - lead - tail, F.lit(0)))
    known = F.size("seeds") > 0
    # Below the explode, so that a token of many seeds is not repeated beside each of them.
    cut = around.select("_row", (F.col("start") + lead).alias("start"), F.when(~known, core).alias("core"), known.alias("known"),
                        F.filter(patterns, lambda p: p.isNotNull()).alias("patterns"), "seeds")
    spread = cut.select("_row", "start", "core", "known", "patterns", F.explode_outer("seeds").alias("seed"))
    tidy = spread.withColumn("value", F.when(F.col("known"), F.col("seed")).otherwise(F.col("core"))).where(
        F.col("known") | (F.length(F.regexp_replace("value", r"[^\p{L}\p{N}]", "")) >= MIN_CHARS))
    return tidy.select("_row", "start", (F.col("start") + F.length("value")).alias("end"), "value", "known", "patterns")


def score_graph(found: DataFrame, rounds: int = ROUNDS, min_known: int = MIN_KNOWN,
                confident: float = CONFIDENT) -> DataFrame:
    """Values (``value``) that patterns make confident, with ``confidence``.

    Each round is two hash aggregates over the distinct (pattern, value) edges,
    so a pattern with very many instances is summed map-side first.
    """
    edges = (found.select("value", F.col("known").cast("int").alias("known"), F.explode("patterns").alias("pattern"))
             .groupBy("pattern", "value").agg(F.max("known").alias("known")))
    edges = materialize(edges, "pii-edges")
    scored = edges.groupBy("value").agg(F.max("known").cast("double").alias("conf"))
    for _ in range(rounds):
        trusted = scored.where(F.col("conf") >= confident)
        weighed = edges.join(trusted.select("value", "conf"), "value", "left")
        patterns = (weighed.groupBy("pattern").agg(
            F.avg(F.coalesce("conf", F.lit(0.0))).alias("trust"), F.count("conf").alias("n"))
            .where((F.col("n") >= min_known) & (F.col("trust") >= confident)))
        better = edges.join(patterns.select("pattern", "trust"), "pattern", "left").groupBy("value").agg(
            F.greatest(F.max(F.col("known").cast("double")), F.coalesce(F.max("trust"), F.lit(0.0))).alias("conf"))
        scored = materialize(better, "pii-scores")
    return scored.where(F.col("conf") >= confident).select("value", F.col("conf").alias("confidence"))


def extract(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id``, counts by kind, ``spans`` (array of kind,
    start, end; base and discovered) in order of start and kind."""
    found = materialize(find_matches(docs), "pii-matches")
    placed = place(found)
    tokens = materialize(candidates(placed), "pii-candidates")
    learned = (tokens.where("not known").join(score_graph(tokens), "value")
               .select("_row", F.lit(4).alias("kind"), "start", "end"))
    spans = placed.where("kind < 4").select("_row", "kind", "start", "end").unionByName(learned)
    listed = spans.select("_row", F.lit(None).cast("long").alias("doc_id"), F.struct("start", "kind", "end").alias("s"))
    everyone = found.where("kind is null or pos = 0").select("_row", "doc_id", F.lit(None).cast(
        "struct<start:int,kind:int,end:int>").alias("s"))
    per_doc = listed.unionByName(everyone).groupBy("_row").agg(
        F.max("doc_id").alias("doc_id"), F.array_sort(F.collect_list("s")).alias("spans"))

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return per_doc.select("doc_id", *counts, "spans")


def span_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
