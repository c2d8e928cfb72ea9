"""A corpus from the documents table: stages that each apply one operator to all rows so far.

Quality rules, near-duplicates, repeated passages, the mix of sources, and token ids. A stage gets
what its predecessor kept, in the columns of ``documents``, and so does the next one; only the last
returns other columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinview.llm import chunks, lines, mix, near, suffixes
from twinview.session import new_table_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without the lines that too many of their host have.

    n_chars is counted anew.
    """
    rest = lines.quality(docs, as_text=True).where("kept")
    changed = F.col("n_boilerplate") > 0
    columns = {"text": F.col("cleaned")}
    if "n_chars" in docs.columns:
        n_chars = F.char_length("cleaned").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(changed, n_chars).otherwise(F.col("doc.n_chars"))
    return rest.select(*(columns.get(c, F.col("doc")[c]).alias(c) for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id.

    Of its rows, if they are several, the one with the least digest of its text, then of its other
    columns, stays, so that reruns agree. Rows without an id have no near-duplicates and stay.
    """
    found = near.near_duplicates(docs.select("doc_id", "text")).where("kept").select(F.col("doc_id").alias("_id")).distinct()
    with_id = docs.where("doc_id is not null")
    rest = with_id.join(found, with_id["doc_id"] == found["_id"], "left_semi")
    order = F.struct(F.md5("text"), F.md5(F.to_json(F.struct(*(c for c in docs.columns if c != "text")))))
    firsts = rest.groupBy(F.col("doc_id").alias("_id")).agg(F.min_by(F.struct(*docs.columns), order).alias("_row")).select("_row.*")
    return firsts.unionByName(docs.where("doc_id is null"))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the passages that an earlier one has.

    Characters that a cut goes through are left out, n_chars is counted anew, and a document of
    which nothing but separators is left goes.
    """
    rest = suffixes.cut_repeats(docs, as_text=True)
    changed = F.col("n_removed") > 0
    columns = {"text": F.when(changed, F.col("kept")).otherwise(F.col("doc.text"))}
    if "n_chars" in docs.columns:
        n_chars = F.char_length("kept").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(changed, n_chars).otherwise(F.col("doc.n_chars"))
    left = rest.where(~changed | F.col("kept").rlike(mix.WORD))
    return left.select(*(columns.get(c, F.col("doc")[c]).alias(c) for c in docs.columns))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their weights: a document once for every whole copy in the mix."""
    rows = mix.mix(docs).where("copies > 0")
    return rows.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document; decoding them gives the text again (``round_trip``)."""
    found = chunks.encode_checked(docs, ["doc_id", "source"])
    return found.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")


STAGES = [
    ("quality_rules", quality),
    ("minhash_near_dedup", near_dedup),
    ("suffix_array_dedup", suffix_dedup),
    ("source_mixing", mixing),
    ("sentencepiece_ids", token_ids),
]

#: Near-duplicates, repeated strings and token ids can't be said in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other on ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_table_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
