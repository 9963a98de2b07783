"""Each operator on its whole tables, reduced to the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.llm import (
    alignment,
    decontaminate,
    html,
    jaccard,
    licenses,
    mixing,
    packing,
    pii,
    quality,
    sharding,
    token_files,
    toxicity,
    whitening,
)
from hourcast.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files written in doc_id order; everything returned is read from them."""
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path)
    return token_files.checksums(token_files.read_tokens(spark, path))


def op2_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.bucketed(packing.pack(table(spark, sf_dir, "documents"), with_tokens=False))


def op3_bounded_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24 shards whose rows differ by one at most."""
    placed = sharding.assign(table(spark, sf_dir, "documents"), shards=24)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The policy applied to the stored ledger."""
    entries = quality.stored_ledger(table(spark, sf_dir, "documents"))
    return quality.judged(entries).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "failures",
        "only_rule",
    )


def op5_bilstm_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op6_string_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = toxicity.fit(documents, labels.filter(~held_out))
    return toxicity.score(documents, model).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op7_min_cut_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op8_signature_tree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = jaccard.similar_groups(table(spark, sf_dir, "documents"), width=4, percent=85)
    return groups.select("doc_id", "n_shingles", "component_id")


def op9_prefix_filter_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: source / language / thousand of ids / id."""
    folder = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 1000).cast("string"))
    files = table(spark, sf_dir, "documents").withColumn(
        "path", F.concat_ws("/", folder, F.col("doc_id").cast("string"))
    )
    return licenses.scan(files)


def op11_exact_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    whitened = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return whitened.withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op13_merge_path_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.digest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: f for name, f in list(globals().items()) if name.startswith("op") and "_" in name
}
