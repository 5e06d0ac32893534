"""A corpus from raw documents: each stage works on what the one before kept.

Toxic documents go, one document of each group of near duplicates stays, words in
windows that repeat anywhere go, documents with passages of the benchmark go, and
the rest is encoded. Columns other than those of ``documents`` are not passed on.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeseries.llm.bpe import decode, encode
from lakeseries.llm.decontaminate import without_overlaps
from lakeseries.llm.minhash import near_classes
from lakeseries.llm.stores import stored
from lakeseries.llm.toxicity import THRESHOLD, score, trained
from lakeseries.llm.windows import repeated_windows

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxic threshold; the model learns from the labelled rows of ``docs``.

    Without labels of both kinds nothing is known of toxic documents, and all stay.
    Null and empty texts stay; repeated rows are judged alike; long texts are scored
    whole; other columns are not passed on, whatever their names.
    """
    model = trained(docs, _table(spark, sf_dir, "labels"))
    if not model.informed:
        return docs.select(*COLUMNS)
    return score(docs.select(*COLUMNS), model).where(F.col("score") < THRESHOLD).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of every class; rows equal in id and text count once.

    Rows of one id with different texts are different documents. Documents without
    an id are in no class and stay.
    """
    gone = near_classes(docs).where("not first").select("id", "variant").distinct()
    rows = docs.select(*COLUMNS, F.xxhash64(F.coalesce("text", F.lit(""))).alias("_variant"))
    same = (F.col("doc_id") == F.col("id")) & (F.col("_variant") == F.col("variant"))
    kept = rows.join(gone, same, "left_anti")
    named = kept.where("doc_id is not null").dropDuplicates(["doc_id", "_variant"])
    return named.unionByName(kept.where("doc_id is null")).select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in windows of 35 that repeat anywhere go; other texts stay as they are."""
    found = repeated_windows(docs.select(*COLUMNS))
    changed = F.col("n_removed") > 0
    text = F.when(changed, F.col("kept_text")).otherwise(F.col("text"))
    n_chars = F.when(changed, F.char_length(text).cast("long")).otherwise(F.col("n_chars"))
    return found.select(
        "doc_id", text.alias("text"), "lang", "source", n_chars.alias("n_chars")
    )


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return without_overlaps(docs.select(*COLUMNS), _table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document; ``round_trip`` says that decoding gives its text back."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    plain = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    rows = docs.select(*COLUMNS).withColumn("text_hash", plain)
    tokens = encode(rows, path, public_tokenizers.PATTERN).drop("text")
    return decode(tokens, path).select(
        "doc_id", "lang", "source", "n_chars", F.size("ids").cast("long").alias("n_tokens"),
        "ids", (F.xxhash64(F.col("decoded").cast("string")) == F.col("text_hash")).alias("round_trip"),
    )


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontaminate", decontaminate),
    ("tokenize", tokenize),
]

# Learned scores and token merges are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
