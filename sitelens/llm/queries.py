"""The operators as registered queries over the given tables, and their SQL statements."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from sitelens.functions.scale import shared_dir
from sitelens.llm import collocations, conversations, licenses, near, packing, quality, recompress, segments, shards, suffix, urls, vectors, winnow
from sitelens.llm.oracles import SQL

Query = Callable[[SparkSession, str], DataFrame]
WORD_BPE, PIECE_BPE = "word_bpe_49k.json", "piece_bpe_32k.model"


def over(table: str, run: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: run(spark.read.parquet(f"{folder}/{table}.parquet"))


def quality_rows(docs: DataFrame) -> DataFrame:
    return quality.quality_rules(docs).select("_row.doc_id", "*").drop("_row")


def packed(docs: DataFrame) -> DataFrame:
    return packing.packed_documents(docs, public_tokenizers.path(WORD_BPE))


def sharded(docs: DataFrame) -> DataFrame:
    folder = f"{shared_dir(docs.sparkSession)}/shards-{uuid.uuid4().hex}"
    return shards.write_shards(docs, public_tokenizers.path(WORD_BPE), folder)


def segmented(docs: DataFrame) -> DataFrame:
    return segments.best_segmentations(docs, public_tokenizers.path(PIECE_BPE))


def judged_urls(spark: SparkSession, folder: str) -> DataFrame:
    return urls.url_filter(spark.read.parquet(f"{folder}/pages.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))


def decontaminated(spark: SparkSession, folder: str) -> DataFrame:
    found = winnow.contaminated(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


QUERIES: dict[str, Query] = {
    "op1_quality_rules": over("documents", quality_rows),
    "op2_training_order": over("documents", sharded),
    "op3_suffix_dedup": over("documents", suffix.byte_repeats),
    "op4_nbest_pieces": over("documents", segmented),
    "op5_recompression": over("documents", recompress.word_repeats),
    "op6_bagminhash": over("documents", near.near_duplicates),
    "op7_license_digests": over("documents", licenses.license_scan),
    "op8_pca_tiles": over("embeddings", vectors.near_vectors),
    "op9_url_templates": judged_urls,
    "op10_packing": over("documents", packed),
    "op11_winnowing": decontaminated,
    "op12_collocations": over("documents", collocations.collocations),
    "op13_conversation_repair": over("conversations", conversations.repaired),
    "pipeline": corpus_pipeline.run,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    out = dict(SQL)
    if corpus_pipeline.ORACLE_SQL:
        out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
