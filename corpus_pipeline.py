"""A training corpus from ``documents``: rejects junk, near copies and benchmark passages, redacts, packs into sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.llm import decontaminate, packing, pii, quality_crf, shingle_join
from gridcast.sources.tables import cut

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier accepts, by a score of 0.7 or more; null texts are scored as empty."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
    field = quality_crf.train_quality(docs, labels)
    return quality_crf.add_quality(docs, field, name="_quality").filter("_quality >= 0.7").drop("_quality")


def keep_one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near copies; rows without an id stay."""
    found = shingle_join.jaccard_components(docs)
    others = cut(found.filter("component_id != doc_id").select("doc_id").distinct())
    return docs.join(others, "doc_id", "left_anti").select(*docs.columns)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without a passage like a benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced; ``n_chars`` counts the new text."""
    out = pii.redact(docs, pii.train_trees(docs))
    if "n_chars" not in docs.columns:
        return out
    size = F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)
    return out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), size))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each piece's place in a sequence of at most 2048 tokens."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_one_of_copies),
    ("benchmark decontamination", keep_uncontaminated),
    ("PII", redact_personal_data),
    ("best-fit packing", pack_sequences),
]

# The classifier and the trees are fitted models, which SQL can't express; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
