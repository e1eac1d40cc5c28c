"""Registered queries of the training-data operators, and their oracle SQL.

Each ``opN_...`` query applies its operator to the whole table it is meant for
and derives the contract's columns from the operator's result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crashlens.llm import embedding_dedup, fill_middle, html_text, importance, language_id, licenses, oracles, token_counts, toxicity
from crashlens.llm.decontaminate import contamination
from crashlens.llm.minhash_dedup import near_duplicates
from crashlens.llm.mixing import mix
from crashlens.llm.quality import held_out, score, train
from crashlens.llm.substring_dedup import remove_repeats
from crashlens.llm.tables import written

QUALITY_THRESHOLD = 0.3
#: A public vocabulary of ranks, a file that every machine has.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that goes with the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the 13-word passages that a document with a smaller id has."""
    left = remove_repeats(_table(spark, sf_dir, "documents"))
    kept = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return left.select("doc_id", "n_words", "n_removed", F.sha2(kept, 256).alias("kept_sha256"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose 5-word shingle sets have a Jaccard similarity of 0.85 or more."""
    return near_duplicates(_table(spark, sf_dir, "documents"), percent=85)


def op2_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of embeddings of one label with a cosine of 0.93 or more."""
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"), cosine=0.93)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document by n-gram profiles of documents that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    found = language_id.identify(docs.select("doc_id", "text"), language_id.learn(docs))
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of 13 words in documents, by document."""
    found = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents mixed to shares that follow the square root of each source's size, shuffled globally."""
    return mix(_table(spark, sf_dir, "documents"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in every document: how many, which, and the nearest."""
    found = licenses.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    best = F.array_max(F.transform("matches", lambda m: F.struct(m["dice"].alias("dice"), m["licence"].alias("licence"))))
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["licence"])))
    return found.select(
        "doc_id", F.size("matches").cast("long").alias("n_matches"), F.array_join(names, ",").alias("licences"),
        best["licence"].alias("best_licence"), best["dice"].alias("best_dice"),
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after its personal data are redacted, from trees kept over the edits."""
    # A struct is never null, so that rows without an id are matched by their text.
    docs = _table(spark, sf_dir, "documents").select(F.struct("doc_id").alias("row"), "text")
    how = {"path": VOCABULARY, "pattern": PATTERN, "key": "row"}
    trees = written(token_counts.build(docs, **how), "token-trees")
    edits = written(token_counts.redactions(docs, key="row"), "token-edits")
    new = written(token_counts.update(docs, trees, edits, **how).drop("text", "chars", "tokens"), "token-updates")
    new = new.select("row", "hash", F.col("n_tokens").alias("n_new"), "n_edits", "n_encoded")
    return trees.join(new, ["row", "hash"], "left").select(
        "row.doc_id", "n_tokens", F.coalesce("n_new", "n_tokens").alias("n_tokens_edited"),
        F.coalesce("n_edits", F.lit(0)).alias("n_edits"), F.coalesce("n_encoded", F.lit(0)).alias("n_encoded"),
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents by a model trained on labelled ones that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, train(docs, _table(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= QUALITY_THRESHOLD).cast("int")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted.alias("predicted"), "n_passages", "top_passage")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = _table(spark, sf_dir, "pages")
    found = html_text.extract(pages, html_text.train(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_blocks", "n_kept")


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut in three and put together for fill-in-the-middle training, and put back."""
    made = fill_middle.transform(_table(spark, sf_dir, "documents").select("doc_id", "text"), seed="1", percent=90, spm=20)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(fill_middle.restored(), 256).alias("restored_sha256"),
    )


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents by a model trained on labelled ones that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    scored = toxicity.score(docs.select("doc_id", "text"), toxicity.train(docs, _table(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= 0.5).cast("int")
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", predicted.alias("predicted"), "lang_pred")


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents weighted by how much likelier the benchmark's word distribution is to give them, a tenth of them drawn."""
    found = importance.importance(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"),
                                  runs=1, buckets=10_000, percent=10, least=20, seed="2024")
    return found.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_remove_repeats": op1_remove_repeats,
    "op2_embedding_duplicates": op2_embedding_duplicates,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_language": op4_language,
    "op5_decontaminate": op5_decontaminate,
    "op6_mix_sources": op6_mix_sources,
    "op7_licenses": op7_licenses,
    "op8_quality": op8_quality,
    "op9_token_counts": op9_token_counts,
    "op10_html_text": op10_html_text,
    "op11_fill_middle": op11_fill_middle,
    "op12_toxicity": op12_toxicity,
    "op13_importance": op13_importance,
}

def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(oracles.ORACLE_SQL)
