"""A training corpus in five stages: each function takes (spark, docs, sf_dir) and returns a DataFrame.

`run` writes every stage's result to the folder that the cluster shares and reads it for the next one.
All stages but the last return the columns of `documents`; the last adds what the mix takes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayflux.llm import decontaminate, jaccard, mixing, quality, spans
from wayflux.llm.common import Stages, free_name

REJECT_BELOW = 0.5


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    name = free_name(docs, "quality")
    meta = tuple(c for c in ("n_chars",) if c in docs.columns)
    scored = quality.classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), name, meta=meta)
    return scored.filter(F.col(name) >= REJECT_BELOW).select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates: five words, similarity 0.8.

    Rows that share the smallest id and text all stay; documents without an id stay if nothing with an
    id is in their group.
    """
    classes = jaccard.jaccard_classes(docs.select("doc_id", "text"), n=5, percent=80)
    doc, version, own = (free_name(docs, c) for c in ("_doc", "_version", "_own"))
    first = classes.filter(F.col("doc").eqNullSafe(F.col("component_id"))).select(F.col("doc").alias(doc), F.col("version").alias(version)).distinct()
    keyed = docs.withColumn(own, F.coalesce(F.xxhash64("text"), F.lit(0)))
    kept = keyed.join(first, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(own) == F.col(version)), "left_semi")
    return kept.select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the sentence spans that occur earlier; n_chars follows."""
    name = free_name(docs, "spans")
    out = spans.remove_repeats(docs, name)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages make up less than one word in twenty."""
    name = free_name(docs, "passages")
    found = decontaminate.find_passages(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), name)
    hit = F.aggregate(F.col(name)["spans"], F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return found.filter(~((hit > 0) & (20 * hit >= F.col(name)["n_words"]))).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document that is left, with the words that the mix of sources takes of it."""
    size, taken = free_name(docs, "size"), free_name(docs, "taken")
    sized = docs.withColumn(size, mixing.word_count(F.col("text")))
    mixed, _, _ = mixing.mix_sources(sized, F.array("source"), mixing.cycled, F.col(size), ["doc_id"], taken)
    return mixed.select(*docs.columns, size, taken)


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("substring dedup", cut_repeats),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix),
]

ORACLE_SQL = None  # learning and seeded choices are not SQL; tests/llm holds run() against the stages' brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages = Stages(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stages.keep(stage(spark, docs, sf_dir), f"stage{k}")
        if k:
            stages.drop(f"stage{k - 1}")
    return docs
