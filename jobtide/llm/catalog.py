"""The registered queries of the text operators and, where SQL can say the same, their twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.llm import (
    bpe, chat, decontamination, language, lm, merkle, near_dup, quality_net, quality_rules, repair,
    toxicity, urls, warc,
)
from jobtide.llm.common import folder, held_out, rest, stored, table


URL_RULES = [
    urls.rule("allow", "org/"), urls.rule("block", "example.org/es/"),
    urls.rule("block", "example.org/en/1"), urls.rule("allow", "com/fr/"), urls.rule("block", "com/de/"),
]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page."""
    pages = urls.with_rules(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return urls.judge(pages, urls.fit(pages)).select("page_id", "host", "path", "rule", "verdict", "accepted")


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near duplicates of all documents."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    net = quality_net.fit(docs, table(spark, sf_dir, "labels"), modulus=5, remainder=0)
    scored = quality_net.score(docs.select("doc_id", "text"), net, name="score")
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the voting rules for every document."""
    counted = stored(quality_rules.counts(
        table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text"), "counts")
    judged = quality_rules.judge(counted, quality_rules.learn(counted))
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs, out = table(spark, sf_dir, "documents"), held_out("doc_id", 4, 2)
    found = language.identify(docs.select("doc_id", "text"), language.fit(docs, ~out))
    return found.select("doc_id", out.alias("held_out"), F.col("language.lang").alias("lang_pred"),
                        F.col("language.score").alias("score"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    path = folder(spark, "archives")
    warc.write(pages, path)
    records = warc.read(spark, path, lambda payload: {
        "payload_bytes": F.octet_length(payload).cast("long"), "payload_digest": warc.base32(F.sha1(payload))})
    records = stored(records, "records")
    page = lambda c: F.nullif(F.regexp_extract(c, "^<urn:page:(.*)>$", 1), F.lit("")).cast("long")
    full = records.where(F.col("type") == "response").select(
        F.col("record_id").alias("_full"), F.col("payload_bytes").alias("full_bytes"),
        F.col("payload_digest").alias("full_digest")).dropDuplicates(["_full"])
    revisit = F.col("type") == "revisit"
    # a response looks for itself, so that responses don't meet in one task under a null name
    records = records.withColumn("_full", F.coalesce("refers_to", "record_id"))
    return records.join(full, "_full", "left").select(
        page(F.col("record_id")).alias("page_id"),
        F.when(revisit, F.col("full_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("full_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.col("type").alias("record_type"), page(F.col("refers_to")).alias("refers_to"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a passage of the benchmark."""
    found = decontamination.scan(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                 table(spark, sf_dir, "benchmark"))
    hit, items = decontamination.n_hit(F.col("found.spans")), F.col("found.items")
    return found.select(
        "doc_id", "found.n_words", hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text they decode to, as digests."""
    return bpe_digests(table(spark, sf_dir, "documents"))


def bpe_digests(docs: DataFrame) -> DataFrame:
    path = vocabulary("word_bpe_49k.json")
    coded = bpe.decode(bpe.encode(docs, path), path, name="decoded")
    return coded.select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under a model of those that are not held out."""
    out = held_out("doc_id", 7, 2)
    scored = lm.score(table(spark, sf_dir, "documents"), learn=~out & F.col("doc_id").isNotNull())
    return scored.select("doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), modulus=5, remainder=0)
    scored = toxicity.score(docs.select("doc_id", "text"), model, name="score")
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proof of every document in the manifest of all, held against rows of which some have changed."""
    rows = merkle.with_leaves(
        table(spark, sf_dir, "documents"), lambda t: F.replace(t, F.lit("\n"), F.lit("")), rest("doc_id", 2) == 0)
    return merkle.verified(rows).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation, after planted damage."""
    rows = table(spark, sf_dir, "conversations")
    found = repair.repair(repair.damaged(rows)).withColumnRenamed("conv_id", "_conv")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    # of a conversation that lost all its rows nothing is found
    return rows.select("conv_id").distinct().join(
        found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one that says control strings, read back from the packed stream."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], rows.schema)
    return chat.read_back(*chat.pack(rows.unionByName(more)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_url_filter, op2_near_duplicates, op3_quality, op4_quality_rules, op5_language, op6_warc,
        op7_decontamination, op8_bpe, op9_lm_score, op10_toxicity, op11_merkle_manifest,
        op12_conversation_repair, op13_chat_format)
}


def twins() -> dict[str, str]:
    from jobtide.llm import twins as t

    return {"op4_quality_rules": t.quality_rules(), "op6_warc": t.warc(),
            "op11_merkle_manifest": t.merkle_manifest(),
            "op12_conversation_repair": t.conversation_repair(),
            "op13_chat_format": t.chat_format()}
