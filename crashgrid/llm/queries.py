"""The registered queries: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, chat, decontaminate, langid, language_model, merkle, quality, secret_scan, sentencepiece_bpe, simhash, suffix_dedup, toxicity, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"), shingle_words=4, bits=4)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    listed = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", listed, "contaminated")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = remainder("doc_id", 5) == 0
    found = toxicity.score(docs, toxicity.train(docs, labels.where(~held_out)))
    return found.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias("spans"),
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 4) == 2
    filters = langid.train(docs.where(~held_out).select("text", "lang"))
    found = langid.identify(docs, filters)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_sentencepiece(spark: SparkSession, sf_dir: str, model_path: str | None = None) -> DataFrame:
    vocabulary = sentencepiece_bpe.load_vocabulary(model_path or public_model())
    return sentencepiece_bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary, with_ids=False)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.capture_histories(table(spark, sf_dir, "pages"))
    return found.select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=50)


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 5) == 1
    found = language_model.score_texts(docs, docs.where(~held_out).select("doc_id", "text"))
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_report(secret_scan.secret_spans(table(spark, sf_dir, "documents")))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    struck = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    tampered = merkle.leaf_digest("doc_id", "source", "lang", F.col("n_chars") + F.when(struck, 1).otherwise(0), "text")
    found = merkle.manifest(docs, fanout=2, carry={"tampered": tampered})
    folded = merkle.fold(F.col("tampered"), F.col("proof"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof_text(F.col("proof")), 256).alias("proof_sha256"),
        folded.alias("folded_root"), (folded == F.col("root")).alias("verified"),
    )


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    tricky = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    formatted = chat.format_conversations(turns.unionByName(tricky))
    found = chat.read_back(formatted, in_order=True)
    return found.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = alignment.align(table(spark, sf_dir, "documents"), public_model("byte_bpe_50k.json"), public_model())
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    found = alignment.with_pair_counts(aligned.withColumn("groups_sha256", digest).drop("groups"))
    counts = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    return found.select(F.col("id").alias("doc_id"), *counts, "groups_sha256")


def public_model(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in [op1_quality_rules, op2_simhash, op3_decontamination, op4_toxicity, op5_language_id, op6_sentencepiece, op7_warc, op8_suffix_dedup, op9_lm_scoring, op10_secret_scan, op11_merkle_manifest, op12_chat_format, op13_token_alignment]
}
