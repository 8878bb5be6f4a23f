"""Registered queries of the pipeline operators and their DuckDB statements."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tillcast.llm import (
    alignment,
    bpe,
    hard_negatives,
    host_rules,
    licences,
    one_bit,
    packing,
    prob_minhash,
    pseudonyms,
    shards,
    simhash,
    site_bayes,
    token_files,
)
from tillcast.llm.tables import table
from tillcast.session import importable, shared_folder

BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"
WORD_FILE = "word_bpe_49k.json"
BYTE_FILE, PIECE_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def register(fn):
        @functools.wraps(fn)
        def prepared(spark: SparkSession, folder: str) -> DataFrame:
            importable(spark)
            return fn(spark, folder)

        QUERIES[name] = prepared
        return prepared

    return register


@query("op1_byte_bpe")
def byte_bpe(spark, folder):
    path = public_tokenizers.path(BYTE_RANKS)
    return bpe.digests(table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


@query("op2_prob_minhash")
def near_duplicates(spark, folder):
    return prob_minhash.all_classes(table(spark, folder, "documents")).select("doc_id", "class_id")


@query("op3_site_bayes")
def quality(spark, folder):
    return site_bayes.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op4_pseudonyms")
def personal_data(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pseudonyms.replace(docs, key="query-key", count="n_values")


@query("op5_host_rules")
def rules(spark, folder):
    return host_rules.judge(table(spark, folder, "documents")).withColumn("host_rate", F.round("host_rate", 9))


@query("op6_token_files")
def token_file(spark, folder):
    path = shared_folder(spark, "token-file")
    token_files.write(table(spark, folder, "documents"), path, public_tokenizers.path(WORD_FILE), end_id=1)
    return token_files.read_digests(spark, path)


@query("op7_licence_index")
def licence_labels(spark, folder):
    return licences.scan(table(spark, folder, "documents")).withColumn("score", F.round("score", 9))


@query("op8_one_bit_codes")
def nearest(spark, folder):
    rows = one_bit.vectors(table(spark, folder, "embeddings"))
    return one_bit.search(one_bit.build(rows), rows.where(F.col("vec_id") % 100 == 0))


@query("op9_virtual_slots")
def sharded(spark, folder):
    return shards.assign(table(spark, folder, "documents"))


@query("op10_packing")
def packed(spark, folder):
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path(WORD_FILE), end_id=2)


@query("op11_shared_cuts")
def shared_cuts(spark, folder):
    left, right = public_tokenizers.path(BYTE_FILE), public_tokenizers.path(PIECE_FILE)
    return alignment.digests(table(spark, folder, "documents"), left, right, public_tokenizers.PATTERN)


@query("op12_hard_negatives")
def negatives(spark, folder):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.quantized(table(spark, folder, "embeddings"), label, scale=256)
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


@query("op13_simhash_pivots")
def fingerprint_classes(spark, folder):
    return simhash.classes(table(spark, folder, "documents"))


@query("pipeline")
def pipeline(spark, folder):
    return corpus_pipeline.run(spark, folder)


ORACLES = {
    "op5_host_rules": host_rules.ORACLE,
    "op7_licence_index": licences.oracle(),
    "op8_one_bit_codes": one_bit.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
