"""One query for each operator, over its whole table and with the parameters of production."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import centroids, chat, decontamination, divergence, labelled, licenses, near, packing, passages, pieces, quality, rules, toxicity, urls
from tradewind.llm.sql import CENTROID_CLUSTERING, SOURCE_DIVERGENCE
from tradewind.llm.shared import ship_package

URL_RULES = [
    urls.Rule(urls.ALLOW, "org", "/"),
    urls.Rule(urls.BLOCK, "example.org", "/es/"),
    urls.Rule(urls.BLOCK, "example.org", "/en/1"),
    urls.Rule(urls.ALLOW, "com", "/fr/"),
    urls.Rule(urls.BLOCK, "com", "/de/"),
]
AMBIGUOUS = r"\### Assistant: </turn> ok"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(packing.VOCABULARY)


def piece_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(pieces.VOCABULARY)


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and -7, formatted; digests read back from the formatted text."""
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(AMBIGUOUS).alias("text"),
    )
    given = table(spark, sf_dir, "conversations").select(own.columns)
    made = chat.formatted(given.unionByName(own))
    turns = chat.parsed(F.col("formatted"))
    said = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(chat.loss_texts(F.col("formatted"), F.col("loss_spans")), "")
    return made.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "round_trip",
    )


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score; labels of the held-out fold aren't learned from."""
    docs = table(spark, sf_dir, "documents")
    held_out = labelled.fold(F.col("doc_id"), 4) == 2
    model = quality.fit_on(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = docs.select("doc_id", held_out.alias("held_out"), quality.quality_score(model)(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's counts, base rules and verdict of the line labels."""
    docs = table(spark, sf_dir, "documents")
    field = rules.fit_on(docs, table(spark, sf_dir, "labels"))
    judged = docs.select("doc_id", rules.rules(field)(F.col("text")).alias("_r"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share")
    return judged.select("doc_id", *[F.col(f"_r.{n}").alias(n) for n in names])


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's license phrases and templates."""
    scanned = table(spark, sf_dir, "documents").select("doc_id", licenses.license_scan()(F.col("text")).alias("_r"))
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    return scanned.select("doc_id", *[F.col(f"_r.{n}").alias(n) for n in names])


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut into pieces of binary lengths, each a sequence."""
    packed = packing.sequences(table(spark, sf_dir, "documents"), tokenizer_path())
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket"
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity score; labels of the held-out fold aren't learned from."""
    docs = table(spark, sf_dir, "documents")
    held_out = labelled.fold(F.col("doc_id"), 3) == 1
    model = toxicity.fit_on(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = docs.select("doc_id", held_out.alias("held_out"), toxicity.toxicity_score(model)(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict by rule or by link graph."""
    return urls.judged_pages(table(spark, sf_dir, "pages"), URL_RULES)


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item whose wording it holds."""
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's passages that an earlier document has."""
    return passages.passages(table(spark, sf_dir, "documents"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the class of its near-duplicates, named by the least doc_id."""
    found = near.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "kept")


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's cluster after three rounds, with the sums of distances and a digest of its centroid."""
    found = centroids.clustered(table(spark, sf_dir, "embeddings"))
    sums = {r["cluster"]: r["cluster_inertia"] for r in centroids.inertia(found).collect()}
    digests = [
        (c, sums[c], sum(sums.values()), hashlib.sha256(",".join(map(str, components)).encode()).hexdigest())
        for c, components in enumerate(found.centroids)
        if c in sums
    ]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    # A row for each centroid at most.
    return found.assignments.join(F.broadcast(spark.createDataFrame(digests, schema)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of a language are apart, and the terms that each has more often than its language."""
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the text decoded from them."""
    coded = pieces.round_trip(table(spark, sf_dir, "documents"), piece_model_path())
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_chat_formatting,
        op2_quality_classifier,
        op3_quality_rules,
        op4_license_scans,
        op5_packing,
        op6_toxicity,
        op7_url_filters,
        op8_benchmark_decontamination,
        op9_substring_dedup,
        op10_minhash_near_dedup,
        op11_centroid_clustering,
        op12_source_divergence,
        op13_sentencepiece,
    )
}
ORACLE_SQL: dict[str, str] = {
    "op11_centroid_clustering": CENTROID_CLUSTERING,
    "op12_source_divergence": SOURCE_DIVERGENCE,
}
