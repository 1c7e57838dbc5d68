"""Queries of the text-corpus operators, over the tables of one folder."""

from __future__ import annotations

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import (
    collocations,
    decontaminate,
    jaccard_join,
    kdtree,
    langid,
    packing,
    secrets,
    sharding,
    sql,
    suffix_tree,
    toxicity,
    url_templates,
    warc,
    whitening,
)
from ledgerloom.llm.common import HELD_OUT, fold, held_out, table
from ledgerloom.scratch import STORED, Scratch

SHARDS = 40

# The rules of the URL contract.
URL_RULES = (
    url_templates.Rule("org", "/", "allow"),
    url_templates.Rule("example.org", "/es/", "block"),
    url_templates.Rule("example.org", "/en/1", "block"),
    url_templates.Rule("com", "/fr/", "allow"),
    url_templates.Rule("com", "/de/", "block"),
)

# Packing: vocabulary file and closing id of the contract.
TOKENIZER, END_ID = "word_bpe_49k.json", 2


TOXIC_AT = 0.7

# Pages carry no capture date.
CAPTURED = "2024-01-01T00:00:00Z"


def op1_warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.responses(table(spark, folder, "pages"), CAPTURED)
    return warc.derivatives(records, ["page_id"])


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = langid.fit(docs.filter(fold(F.col("doc_id")) != HELD_OUT))
    return langid.predict(docs, model, ["doc_id"]).select(
        "row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score"
    )


def op9_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return jaccard_join.jaccard_join(docs, Scratch(spark), size=4, percent=85)


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    pieces = packing.packed(docs, tokenizer_path(TOKENIZER), END_ID, Scratch(spark).keep)
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.scan(docs, table(spark, folder, "benchmark"), Scratch(spark).keep)
    return found.select(
        "row.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"),
    )


def op4_kd_topk(spark: SparkSession, folder: str) -> DataFrame:
    return kdtree.top_k(
        table(spark, folder, "embeddings"),
        F.col("vec_id") % 20 == 0,
        Scratch(spark).keep,
        k=20,
        scale=64,
    )


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    learned = table(spark, folder, "labels").filter(fold(F.col("doc_id")) != HELD_OUT)
    model = toxicity.fit(docs, learned, Scratch(spark).keep)
    return toxicity.predict(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_AT).cast("int").alias("predicted"),
        "evidence",
    )


def op6_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = secrets.find(docs, Scratch(spark).keep)

    def of(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["place"] < len(secrets.BASE))
    return found.select(
        "row.doc_id",
        of("assign").alias("n_assign"),
        of("access").alias("n_access"),
        of("hex").alias("n_hex"),
        F.sha2(secrets.described(base), 256).alias("base_sha256"),
        secrets.described(F.col("spans")).alias("spans"),
    )


def op7_url_templates(spark: SparkSession, folder: str) -> DataFrame:
    return url_templates.url_verdicts(
        table(spark, folder, "pages"), URL_RULES, Scratch(spark).keep
    ).select("page_id", "host", "path", "rule", "verdict", "template", "purity")


def op8_hilbert_sharding(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, folder, "documents").select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        "lang",
        "source",
    )
    dimensions = {c: F.col(c) for c in ("lang", "source", "size", "doc_id")}
    return sharding.hilbert_shards(docs, dimensions, Scratch(spark), SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return collocations.collocations(docs, Scratch(spark).keep)


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(
        table(spark, folder, "embeddings"),
        F.col("vec_id"),
        F.col("embedding"),
        Scratch(spark).keep,
    ).withColumn("deviation", F.col("deviation").try_cast("long"))


def op13_suffix_tree_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    fold_of_five = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    learned = docs.filter(fold_of_five != 1)
    model = suffix_tree.fit(learned, Scratch(spark, STORED).keep, bounded=False)
    return suffix_tree.score(docs, model, ["doc_id"]).select(
        "row.doc_id",
        F.coalesce(
            F.crc32(F.col("row.doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False)
        ).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


QUERIES = {
    "op1_warc_derivatives": op1_warc_derivatives,
    "op2_language_id": op2_language_id,
    "op3_decontamination": op3_decontamination,
    "op4_kd_topk": op4_kd_topk,
    "op5_toxicity": op5_toxicity,
    "op6_secret_scan": op6_secret_scan,
    "op7_url_templates": op7_url_templates,
    "op8_hilbert_sharding": op8_hilbert_sharding,
    "op9_ngram_join": op9_ngram_join,
    "op10_packing": op10_packing,
    "op11_collocations": op11_collocations,
    "op12_whitening": op12_whitening,
    "op13_suffix_tree_scores": op13_suffix_tree_scores,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL = {
    "op1_warc_derivatives": sql.warc_derivatives(CAPTURED),
    "op3_decontamination": sql.DECONTAMINATION,
    "op4_kd_topk": sql.TOP_K,
    "op6_secret_scan": sql.secret_scan(),
    "op11_collocations": sql.collocations(
        collocations.LEAST, collocations.LONGEST, collocations.COVER, collocations.TOP
    ),
}
