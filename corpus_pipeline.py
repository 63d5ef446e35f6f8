"""The corpus pipeline: documents in, packed training sequences out.

Each stage reads all that its predecessor kept and all but the last return the columns they were given.
Rows travel as one struct beside the two columns a stage reads, so further columns of any name pass
through untouched; NULLs, ties and empty tables are defined by the operators. Of repeated rows in a
near-duplicate group, the smallest by all columns stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import decontam, packing, pii, resemblance, simhash, toxicity
from basketry.llm.components import connected_components
from basketry.operators.scale import attach_by_key
from basketry.session import cut, scratch_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
TOXIC = 0.5


def _wrapped(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the noisy-channel score rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score(_wrapped(docs), toxicity.fit(docs, labels), ["row"])
    return scored.filter(F.col("score") < TOXIC).select("row.*")


def _joined_by_similarity(docs: DataFrame, prints: DataFrame, classes: DataFrame) -> DataFrame:
    """The classes with their components joined where texts resemble each other."""
    sizes = classes.groupBy("component").agg(F.min("component_id").alias("least"), F.count("*").alias("n"))
    placed = attach_by_key(prints, classes.select("fp", "copies", "component"), "fp", "copies")
    nodes = cut(placed.groupBy("hash").agg(F.min("component").alias("component"), F.count("*").alias("n")))
    links = resemblance.component_links(docs.select(F.xxhash64(F.col("text")).alias("hash"), "text"), nodes)
    joined = connected_components(links).select(F.col("node").alias("component"), F.col("component").alias("whole"))
    parts = cut(sizes.join(joined, "component", "left").withColumn("whole", F.coalesce("whole", "component")))
    least = parts.groupBy("whole").agg(F.min("least").alias("component_id"), F.count("*").alias("parts"))
    named = cut(attach_by_key(parts.drop("least"), least, "whole", "parts"))
    return attach_by_key(classes.drop("component_id"), named, "component", "n").drop("component").withColumnRenamed("whole", "component")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str, similar: bool = False) -> DataFrame:
    """One document of each SimHash group stays: that with the smallest doc_id. ``similar`` also joins
    groups with texts of 5-word similarity 0.8 or more."""
    hashed = F.xxhash64(F.col("text"))
    prints = cut(simhash.fingerprints(docs.select("doc_id", "text", hashed.alias("hash")), carried=["hash"]))
    classes = simhash.near_duplicates(prints).select("fp", "copies", "component", "component_id")
    if similar:
        classes = _joined_by_similarity(docs, prints, cut(classes))
    members = attach_by_key(prints, classes, "fp", "copies").filter("doc_id <=> component_id")
    kept = members.groupBy("component").agg(F.min(F.struct("doc_id", "hash")).alias("kept")).select("kept.*")
    rows = _wrapped(docs).select("doc_id", hashed.alias("hash"), "row")
    same = F.expr("a.doc_id <=> b.doc_id and a.hash = b.hash")
    stay = rows.alias("a").join(kept.distinct().alias("b"), same, "left_semi")
    return stay.groupBy("doc_id", "hash").agg(F.min("row").alias("row")).select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the winnowing contract calls contaminated go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.judge(_wrapped(docs), benchmark, ["row"]).filter("not contaminated").select("row.*")


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Found spans are masked in the texts; the recorded length follows the text."""
    masked = pii.redact(_wrapped(docs), pii.fit(docs), ["row"])
    new = {"text": F.col("redacted"), "n_chars": F.length("redacted").cast("long")}
    return masked.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces in sequences of 2048 tokens."""
    return packing.pack(packing.token_pieces(docs, TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("packing", pack),
]
ORACLE_SQL = None  # fingerprints, fitted models and tokens have no SQL form; see tests/llm/test_pipeline.py


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
