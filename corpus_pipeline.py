"""From raw documents to packed training sequences.

Each stage takes the documents that its predecessor kept and returns a DataFrame;
all but the last return the columns of ``documents``. A stage's result is written
and read again before the next.

1. quality: documents that the base rules or a certified cutoff reject go.
2. near_duplicates: one document of each group stays, that with the smallest id
   (five-word shingles, similarity 0.8).
3. repeated_bytes: bytes covered by a 250-byte string that starts elsewhere too, or
   by 51 words that stand elsewhere too, are cut from the texts, whole characters at
   a time; n_chars follows.
4. decontaminate: documents holding 0.8 of a benchmark item's five-word shingles go;
   items of fewer words are not looked for, as clean documents may well hold them.
5. pack: the pieces of the remaining texts, placed in sequences of 2048 tokens.

Rows with null ids or texts pass through each stage by its operator's rules: a text
without words fails quality; a null id is kept by near_duplicates. Equal rows count
as one document where ids matter. Empty tables give empty results; columns beyond
those of ``documents`` are dropped.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunetables.llm import decontaminate, neardup, packing, quality, suffixes
from tunetables.operators.staging import materialise
from tunetables.shipping import ship

#: a string of so many bytes that starts twice is a repeat
REPEAT_BYTES = 250
#: and so many words, if they have fewer bytes than that
REPEAT_WORDS = 51
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.kept_documents(docs.select(*COLUMNS), labels)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    judged = neardup.near_duplicates(docs, neardup.Plan(size=5, percent=80, rows=5))
    gone = judged.filter(~F.col("kept")).select("doc_id").distinct()
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti").select(*COLUMNS)


def repeated_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    cut = suffixes.cut_texts(docs.select(*COLUMNS), length=REPEAT_BYTES, batches=2, words=REPEAT_WORDS)
    return cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    rows = docs.select(*COLUMNS).withColumn("_row", F.xxhash64("doc_id", "text"))
    found = decontaminate.contained_items(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="_row", least_words=5)
    return rows.join(found.select("_row").distinct(), "_row", "left_anti").select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_bytes", repeated_bytes),
    ("decontaminate", decontaminated),
    ("pack", packed),
]

#: SQL has no near-duplicate components, tokenizer or packing; see tests/llm for the plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
