"""A corpus pipeline: five stages of the training-data operators, one after the other.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs, sf_dir)``
and returns a DataFrame, which :func:`run` writes as Parquet and reads again as
the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crashlens.llm.counters import flagged
from crashlens.llm.decontaminate import contamination
from crashlens.llm.minhash_dedup import near_duplicates
from crashlens.llm.mixing import mix
from crashlens.llm.quality import score, train
from crashlens.llm.queries import QUALITY_THRESHOLD
from crashlens.llm.substring_dedup import remove_repeats
from crashlens.llm.tables import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier rejects; it learns from labelled rows of these documents."""
    columns = docs.columns
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).where(F.col("score") >= QUALITY_THRESHOLD).select(*columns)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near-duplicates: of the smallest id (rows without one come last), then text hash.

    Texts without words are in no group; their rows stay.
    """
    # By id and text: rows that share an id, or have none, are grouped each by its own text.
    row = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))
    found = near_duplicates(docs.select(row.alias("row"), "text"), key="row", percent=80).where("n_shingles > 0")
    found = found.groupBy("row").agg(F.min("kept").alias("kept"), F.count("*").alias("n")).where("not kept or n > 1")
    found = written(found.select(F.col("row.id").alias("_id"), F.col("row.hash").alias("_hash"), "kept"), "near-rows")
    own = F.xxhash64(docs["text"])
    out = docs.join(found, docs["doc_id"].eqNullSafe(found["_id"]) & (own == found["_hash"]), "left_anti")
    repeated = found.where("kept").select("_id", "_hash")
    if repeated.isEmpty():
        return out
    # Equal rows collapse before they are joined, so that many copies of one row do not meet in one task.
    some = flagged(docs.withColumn("_own", own), "_own", repeated, "_hash").dropDuplicates(["doc_id", "_own"])
    once = some.join(repeated, some["doc_id"].eqNullSafe(repeated["_id"]) & (some["_own"] == repeated["_hash"]), "left_semi")
    return out.unionByName(once.select(*docs.columns))


def substring(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 13 words or more that an earlier document has; a document of which nothing is left goes."""
    columns = docs.columns
    left = remove_repeats(docs, carry=tuple(c for c in columns if c not in ("doc_id", "text", "n_chars")))
    left = left.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold passages of the benchmark."""
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    bad = found.where("contaminated").select(F.col("doc_id").alias("_id"), "_hash").distinct()
    # By id and text: rows that share an id, or have none, are judged each by its own text.
    same = docs["doc_id"].eqNullSafe(bad["_id"]) & (F.xxhash64(docs["text"]) == bad["_hash"])
    return docs.join(bad, same, "left_anti")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents so that sources have the shares wanted, in a global random order."""
    return mix(docs)


STAGES = [
    ("quality classifier", quality),
    ("minhash near-dedup", near_duplicate),
    ("substring dedup", substring),
    ("benchmark decontamination", decontaminate),
    ("mixing", mixing),
]

#: SQL cannot express a trained classifier; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
