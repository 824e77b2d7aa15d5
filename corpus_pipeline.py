"""From raw documents to encoded training data: five stages, each a Spark job of its own.

A stage takes (spark, docs, sf_dir) and returns a frame, which ``run`` writes to the shared
scratch folder as Parquet and reads again for the next one. All but the last return the columns
of documents. No language-model scoring or sampling; every stage works on all rows it gets.

Defined results: an empty table passes through every stage; null and empty texts fail the
quality rules; repeated rows of one id and text count as copies; further columns stay.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dayloom.functions.once import compute_once
from dayloom.llm import bpe, jaccard_join, mixing, quality, substring_dedup
from dayloom.llm.common import named, table, written

#: Near duplicates of the pipeline: shingles of five words, similarity of 0.8.
SHINGLE_WORDS, PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base checks and the likelihood ratio."""
    judged = quality.quality_rules(docs, table(spark, sf_dir, "labels"), keep=tuple(docs.columns))
    rows = judged.toDF(*(f"_{i}" for i in range(len(docs.columns))), "verdict")
    # Behind a generator: a filter on the verdict itself would take in a copy of the whole computation for each use.
    once = compute_once(rows, {"kept": F.col("verdict.kept")})
    return once.where("kept").drop("kept", "verdict").toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document, by id, of each component of similar documents."""
    rows = jaccard_join.near_duplicates(docs, SHINGLE_WORDS, PERCENT)
    key = ["_id", "_place"]
    first = rows.where("first_row").select(jaccard_join.id_key(F.col("doc_id")).alias("_id"), F.col("place").alias("_place"))
    keyed = docs.select(
        F.struct(*(named(c).alias(f"_{i}") for i, c in enumerate(docs.columns))).alias("_row"),
        jaccard_join.id_key(docs["doc_id"]).alias("_id"), jaccard_join.text_place(docs["text"]).alias("_place"),
    )
    one = Window.partitionBy(*key).orderBy(F.xxhash64("_row"))
    kept = keyed.join(first.distinct(), key).withColumn("_n", F.row_number().over(one)).where("_n = 1")
    return kept.select(*(F.col(f"_row._{i}").alias(c) for i, c in enumerate(docs.columns)))


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the windows that start earlier; those of which nothing is left go."""
    names = [f"_{i}" for i in range(len(docs.columns))]
    cut = substring_dedup.remove_repeats(docs, keep=tuple(docs.columns)).toDF(*names, "dedup")
    left = cut.where("dedup.n_words = 0 or dedup.n_removed < dedup.n_words")
    at = {c: F.col(n) for c, n in zip(docs.columns, names)}
    touched = F.col("dedup.n_removed") > 0
    at["text"] = F.when(touched, F.col("dedup.kept")).otherwise(at["text"])
    if "n_chars" in at:
        at["n_chars"] = F.when(touched, F.length("dedup.kept").cast("long")).otherwise(at["n_chars"])
    return left.select(*(at[c].alias(c) for c in docs.columns))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes its words, rounded; repeats are rows."""
    taken = mixing.mix_sources(docs).where("size > 0").groupBy("place").agg(
        F.round(F.sum("taken") / F.sum("size")).cast("int").alias("_copies"))
    keyed = docs.select(
        F.struct(*(named(c).alias(f"_{i}") for i, c in enumerate(docs.columns))).alias("_row"),
        mixing.place(docs["doc_id"], docs["source"], docs["text"]).alias("place"),
    )
    copies = keyed.join(taken, "place").where("_copies > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return copies.select(*(F.col(f"_row._{i}").alias(c) for i, c in enumerate(docs.columns)))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids and the digest of what the ids decode to."""
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, keep=tuple(docs.columns))
    rows = encoded.toDF(*(f"_{i}" for i in range(len(docs.columns))), "bpe")
    return rows.select(
        *(F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)), F.col("bpe.ids").alias("ids"),
        F.size("bpe.ids").cast("long").alias("n_tokens"), F.sha2("bpe.decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup_stage),
    ("mixing", mixing_stage),
    ("byte_bpe", byte_bpe),
]

#: Hashing, components and merges are beyond SQL; tests compare the run with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
