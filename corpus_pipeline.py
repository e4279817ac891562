"""The corpus pipeline: each stage works on all that its predecessor kept, written as Parquet and read again.

Toxic documents go, one document of each group of near-duplicates stays, documents with benchmark passages go, personal
data is masked, and the rest is packed into token sequences.

Defined cases: a null or empty text scores as one empty sentence, is linked with nothing and holds no passage or personal data, and
is packed as the end id alone; of rows that share a doc_id one stays, rows without doc_id all stay; of a group of
near-duplicates that with the least doc_id stays; benchmark items of under ten characters, which many clean
documents hold by chance, make none go; without labels nothing is toxic; empty tables give no rows; further
columns, whatever their names, pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomtab.llm import common, decontaminate, neardup, packing, pii, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(common.crc_mod("doc_id", 5) != 0)
    return toxicity.keep_clean(docs, toxicity.train(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.mask(docs, pii.train(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    packed = packing.pack(packing.pieces(docs))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("packing", pack_sequences),
]

#: SQL can express neither the classifier nor the tokenizer; tests hold the rows against the stages done by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
