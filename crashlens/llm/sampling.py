"""Bounded samples of rows that teach a model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crashlens.llm.tables import remove, written

#: Texts longer than this many bytes teach nothing (they are scored like all others).
LONGEST = 1 << 16
_PARTS = 1 << 40


def drawn(rows: DataFrame, size: int, sample: int, seed: str, *columns: str, limit: bool = True) -> DataFrame:
    """About ``sample`` of ``size`` distinct rows, by a hash of ``columns``; with ``limit`` never more than twice as many."""
    share = min(1.0, sample / max(size, 1))
    some = rows.where(F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(_PARTS)) < int(share * _PARTS))
    return some.limit(2 * sample) if limit else some


def labelled(docs: DataFrame, labels: DataFrame, held_out: Column, *, key: str, text: str, label: str, sample: int | None,
             longest: int | None = LONGEST, carry: str | None = None) -> DataFrame:
    """``(key, hash, y, text[, carry])`` of about ``sample`` labelled texts (at most twice as many; None: all), each once.

    The sample is drawn from the distinct pairs of id and text, so an id with
    very many rows, equal or not, counts no more than its texts do. Labels
    other than 0 and 1, rows held out (``held_out`` is made of columns of
    ``labels``) and texts that are null or longer than ``longest`` bytes (None: no limit) teach
    nothing. A pair labelled both ways is there with both. Pairs are counted
    and drawn as narrow rows; only drawn texts are read again, and copies of
    one text collapse in each task before they meet.
    """
    known = labels.where(F.col(label).isin(0, 1) & ~held_out).select(F.col(key).alias("key"), F.col(label).cast("int").alias("y")).distinct()
    fits = F.col(text).isNotNull() if longest is None else F.octet_length(text) <= longest
    source = docs.where(F.col(key).isNotNull() & fits).select(
        F.col(key).alias("key"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"), *([F.col(carry).alias("carry")] if carry else []))
    pairs = written(source.select("key", "hash").distinct().join(known, "key"), "labelled-pairs")
    chosen = pairs if sample is None else written(drawn(pairs, pairs.count(), sample, "sample", "key", "hash", "y"), "labelled-sample")
    first = [F.min(c).alias(c) for c in ("text", "carry") if c in source.columns]
    texts = source.join(chosen.select("key", "hash").distinct(), ["key", "hash"], "left_semi").groupBy("key", "hash").agg(*first)
    out = written(texts.join(chosen, ["key", "hash"]), "labelled-texts")
    remove(pairs, chosen)
    return out
