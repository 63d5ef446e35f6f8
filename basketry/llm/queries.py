"""The registered training-data queries: thin digests over the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import (
    chat,
    decontam,
    embeddings,
    grammar,
    language,
    lexical,
    packing,
    pii,
    sharding,
    simhash,
    spelling,
    toxicity,
    warc,
)
from basketry.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SHARDS = 40
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PROBE = "</s>[INST] ok [/INST]"


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op5_chat_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    return chat.digests(chat.expand(turns.unionByName(probe)))


@query
def op9_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign_shards(table(spark, sf_dir, "documents"), SHARDS)
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


@query
def op7_sum_of_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(table(spark, sf_dir, "documents"), TOKENIZER))


@query
def op10_repair_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "repair")
    return grammar.read_corpus(grammar.write_corpus(table(spark, sf_dir, "documents"), folder, TOKENIZER))


@query
def op2_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.document_components(table(spark, sf_dir, "documents"))


@query
def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontam.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query
def op1_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.deduplicated(table(spark, sf_dir, "pages"))
    packages = warc.write_packages(records, scratch_path(spark, "packages"))
    return warc.read_packages(packages, ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])


@query
def op4_pii_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    is_kind = lambda kind: lambda span: span["kind"] == kind
    found = pii.find(docs, pii.fit(docs))
    counted = {f"n_{kind}": F.size(F.filter("base", is_kind(kind))).cast("long") for kind in pii.KINDS}
    listed = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    return found.select(
        "doc_id",
        *[c.alias(n) for n, c in counted.items()],
        F.sha2(listed("base"), 256).alias("base_sha256"),
        listed("spans").alias("spans"),
    )


@query
def op3_toxicity_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        toxicity.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op8_itq_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op11_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    predicted = language.predict(docs, language.fit(docs))
    return predicted.select("doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred", "score")


@query
def op12_q_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.noisy(spelling.runs(table(spark, sf_dir, "documents")))
    return spelling.group_variants(spelling.vocabulary(found))


@query
def op13_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
