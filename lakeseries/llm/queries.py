"""The registered queries of this subpackage, and SQL where it can express them."""

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeseries.llm.alignment import align, with_scores
from lakeseries.llm.bpe import decode, encode
from lakeseries.llm.decontaminate import benchmark_overlaps
from lakeseries.llm.fingerprints import with_next
from lakeseries.llm.licenses import license_notices, templates
from lakeseries.llm.minhash import near_duplicates
from lakeseries.llm.oracles import ORACLES
from lakeseries.llm.quality import KEEP, fit, rate
from lakeseries.llm.stores import fresh_path
from lakeseries.llm.suffixes import without_repeats
from lakeseries.llm.topk import top_products
from lakeseries.llm.toxicity import THRESHOLD, train_and_score, training_row, with_labels
from lakeseries.llm.warc import read_archives, resolved, write_archives
from lakeseries.llm.whitening import whiten
from lakeseries.llm.windows import repeated_windows


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", "text")


def _sha(column: str) -> Column:
    return F.sha2(F.col(column).cast("binary"), 256)


def op1_toxicity_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _texts(spark, sf_dir)
    scored = train_and_score(docs, docs, _table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id",
        F.coalesce(~training_row(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "spans",
    )


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    tokens = encode(_texts(spark, sf_dir), path, public_tokenizers.PATTERN).select("doc_id", "ids")
    return decode(tokens, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias(
            "ids_sha256"
        ),
        _sha("decoded").alias("decoded_sha256"),
    )


def op3_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_texts(spark, sf_dir))


def op4_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = benchmark_overlaps(_texts(spark, sf_dir), _table(spark, sf_dir, "benchmark"))
    return found.select(F.col("doc").alias("doc_id"), "item_id", "matched")


def op5_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_notices(_texts(spark, sf_dir), templates(spark))
    return found.select(F.col("doc").alias("doc_id"), "license", "containment")


def op6_sorted_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(_texts(spark, sf_dir), window=50)
    return found.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", _sha("kept_bytes").alias("kept_sha256")
    )


def op7_superkmer_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_windows(_texts(spark, sf_dir), window=35)
    return found.select("doc_id", "n_words", "n_removed", _sha("kept_text").alias("kept_sha256"))


def op8_phrase_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_next(_texts(spark, sf_dir), edited_texts=False).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


def op9_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades from the labels: 0 poor, 1 well written but toxic, 2 well written."""
    docs = _texts(spark, sf_dir)
    labels = _table(spark, sf_dir, "labels").where("quality is not null and toxic is not null")
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    graded = labels.groupBy("doc_id").agg(F.min(grade).alias("grade"))
    rated = with_labels(docs.where(training_row()), graded)
    tail = F.element_at("tails", 1)
    return rate(docs, fit(rated)).select(
        "doc_id",
        F.coalesce(~training_row(), F.lit(False)).alias("held_out"),
        "expected_grade",
        tail.alias("tail"),
        (tail >= KEEP).alias("keep"),
    )


def op10_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "archives")
    write_archives(_table(spark, sf_dir, "pages"), path)
    records = resolved(read_archives(spark, path, payloads=False))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a_path = public_tokenizers.path("byte_bpe_50k.json")
    b_path = public_tokenizers.path("piece_bpe_32k.model")
    hashed = F.when(F.col("n_a") > 0, _sha("groups")).otherwise(F.lit(""))
    aligned = align(_texts(spark, sf_dir), a_path, b_path).select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        F.size("links").cast("long").alias("n_links"),
        "links",
        hashed.alias("groups_sha256"),
    )
    return with_scores(aligned).select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        "n_best",
        "count_sum",
        "groups_sha256",
    )


def op12_norm_sorted_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return top_products(vectors, F.col("id") % 20 == 0, k=20, scale=64)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings"), scale=256, components=4, weights="one")


QUERIES = {
    "op1_toxicity_crf": op1_toxicity_crf,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_dart_minhash": op3_dart_minhash,
    "op4_spaced_seeds": op4_spaced_seeds,
    "op5_license_notices": op5_license_notices,
    "op6_sorted_suffixes": op6_sorted_suffixes,
    "op7_superkmer_windows": op7_superkmer_windows,
    "op8_phrase_fingerprints": op8_phrase_fingerprints,
    "op9_ordinal_quality": op9_ordinal_quality,
    "op10_warc_revisits": op10_warc_revisits,
    "op11_token_alignment": op11_token_alignment,
    "op12_norm_sorted_topk": op12_norm_sorted_topk,
    "op13_whitening": op13_whitening,
}

__all__ = ["ORACLES", "QUERIES"]
