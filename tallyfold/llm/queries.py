"""The registered queries of the document operators, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversations, decontaminate, lm, mixing, pii, quality, sharding, simhash, substring, suffix, templates, toxicity, vectors
from .common import table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of 200-byte strings that start in two places, removed from every document."""
    kept = suffix.dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's SimHash and component (3-word shingles, 2 bits)."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_text(F.col("fp")).alias("fingerprint"), "component_id")


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within its error budget, and the items."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = decontaminate.mark(docs, table(spark, sf_dir, "benchmark")).where(F.size("leaks") > 0)
    return found.select("doc_id", F.size("leaks").cast("long").alias("n_items"), F.col("leaks.item_id").alias("item_ids"),
                        F.array_min("leaks.distance").alias("least_distance"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score under a byte model and a word model of the training part."""
    docs = lm.split(table(spark, sf_dir, "documents"))
    model = lm.train(docs.where("not held_out"))
    scored = model.score(docs)
    crc = F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8"))
    return scored.select("doc_id", (crc % 7 == 2).alias("held_out"), "n_tokens", "n_known",
                         F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines of recurring templates."""
    kept = templates.dedup(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of 20-word windows that also start earlier, removed from every document."""
    kept = substring.dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed: sources weigh 3, 1, 2 in turn and give 150 % of all words."""
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select(F.col("doc_id").cast("long").alias("doc_id"), "size", "source_size", "target", "taken")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures of every document and the line CRF's verdict."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    crf = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.assess(docs, crf, ["doc_id"])


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard (0 to 7) and slot, under the law ``bytes``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    placed = sharding.shard_rows(docs.select(
        "doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), sharding.sharding_key().alias("key"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32")))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
                         F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text: base matches and what the patterns add."""
    found = pii.extract(table(spark, sf_dir, "documents"))
    base = pii.span_text(F.filter("spans", lambda s: s["kind"] < 4))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                        F.sha2(F.encode(base, "UTF-8"), 256).alias("base_sha256"), pii.span_text(F.col("spans")).alias("spans"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity by the lexicon of the labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.learn(docs, table(spark, sf_dir, "labels")).score(docs)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by rule and repaired at least cost."""
    given = table(spark, sf_dir, "conversations")
    hurt = conversations.damage(given)
    found = conversations.repair(hurt)
    digests = conversations.digests(hurt, found)
    every = given.select(F.col("conv_id").alias("its")).distinct()
    figures = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    out = every.join(found, F.col("its").eqNullSafe(found["conv_id"]), "left").drop("conv_id")
    out = out.join(digests, F.col("its").eqNullSafe(digests["conv_id"]), "left").drop("conv_id")
    return out.select(F.col("its").alias("conv_id"), *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in figures],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector's code, its error, and the error of its label."""
    found, books = vectors.compress(table(spark, sf_dir, "embeddings"))
    digest = books.sha256() if books else None
    return found.select("vec_id", "code", "error", "label_error", F.lit(digest).cast("string").alias("codebooks_sha256"))


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_line_dedup": op5_line_dedup,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_mixing": op7_mixing,
    "op8_quality_rules": op8_quality_rules,
    "op9_sharding": op9_sharding,
    "op10_personal_data": op10_personal_data,
    "op11_toxicity": op11_toxicity,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_vector_codes": op13_vector_codes,
}
