"""Importance resampling towards a target distribution over hashed word features.

A document's features are its runs of up to ``runs`` consecutive words. A
feature's bucket is its CRC-32 modulo ``buckets``. Buckets are counted over all
documents and over all of the target; a bucket's gain is the scaled logarithm
of how much more likely the target is to show it, a document's weight the sum
of its features' gains. Adding a Gumbel number hashed from the id and taking
the highest scores draws documents without replacement in proportion to the
exponential of their weight.

CRCs come from matrices: the distinct features of a slice of text are grouped
by their length into two-dimensional byte arrays, all CRCs of an array are
updated column by column, and the results are scattered back to the features'
occurrences. A feature longer than ``WIDE`` bytes is laid out as rows of that
many bytes, whose CRCs are then put together, so no array is wider.

The corpus sends ``buckets`` counters a task and, to be ranked, one narrow row
per document; one range shuffle orders those, and each partition's offset makes
its positions ranks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crashlens.llm.counters import summed_counters
from crashlens.llm.tables import written
from crashlens.llm.words import NOT_ALNUM, Words, raw_bytes, slices, split_words, windows

BUCKETS = 10_000
SCALE = 1000
WIDE = 256  # bytes of a matrix row
_BLOCK = 1 << 22  # bytes of a matrix
_U32 = np.uint32
_FULL = _U32(0xFFFFFFFF)


@cache
def _table() -> np.ndarray:
    """CRC-32 (reflected polynomial 0xEDB88320) of every byte."""
    table = np.arange(256, dtype=_U32)
    for _ in range(8):
        table = (table >> _U32(1)) ^ np.where(table & _U32(1), _U32(0xEDB88320), _U32(0))
    return table


def _columns(matrix: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """The CRC registers of all rows after each row's bytes, one column after the other."""
    table = _table()
    for column in np.ascontiguousarray(matrix.T):
        crc = table[(crc ^ column) & _U32(0xFF)] ^ (crc >> _U32(8))
    return crc


@cache
def _over_a_row() -> list[list[int]]:
    """What ``WIDE`` zero bytes make of a register, for each of its four bytes."""
    zeros = np.zeros((256, WIDE), dtype=np.uint8)
    return [_columns(zeros, np.arange(256, dtype=_U32) << _U32(8 * i)).tolist() for i in range(4)]


def _long_crc(feature: np.ndarray) -> int:
    """The CRC of one long feature, laid out as rows; the first is filled up in front with zeros, which a register of 0 passes."""
    rows = -(-len(feature) // WIDE)
    laid = np.zeros(rows * WIDE, dtype=np.uint8)
    laid[-len(feature) :] = feature
    laid[-len(feature) :][:4] ^= 0xFF  # as starting from a register of ones
    own = _columns(laid.reshape(rows, WIDE), np.zeros(rows, dtype=_U32)).tolist()
    a, b, c, d = _over_a_row()
    crc = 0
    for one in own:
        crc = one ^ a[crc & 0xFF] ^ b[crc >> 8 & 0xFF] ^ c[crc >> 16 & 0xFF] ^ d[crc >> 24]
    return crc ^ 0xFFFFFFFF


def crc32(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The CRC-32 of each feature ``data[start[i]:end[i]]``, by matrices of features of one length."""
    out = np.zeros(len(start), dtype=_U32)
    length = end - start
    order = np.argsort(length, kind="stable")
    edges = [*np.flatnonzero(np.diff(length[order], prepend=-1)), len(order)]
    for low, high in zip(edges[:-1], edges[1:]):
        size = int(length[order[low]])
        if size > WIDE:
            for i in order[low:high].tolist():
                out[i] = _long_crc(data[start[i] : end[i]])
            continue
        step = max(1, _BLOCK // max(size, 1))
        for at in range(low, high, step):
            some = order[at : min(at + step, high)]
            matrix = data[start[some][:, None] + np.arange(size)]
            out[some] = _columns(matrix, np.full(len(some), _FULL)) ^ _FULL
    return out


def _same(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the ``length`` bytes from ``a`` and from ``b`` are equal, for each pair."""
    out = np.ones(len(a), dtype=bool)
    open_ = np.flatnonzero(a != b)
    at = 0
    while len(open_):
        open_ = open_[length[open_] > at]
        out[open_] = data[a[open_] + at] == data[b[open_] + at]
        open_, at = open_[out[open_]], at + 1
    return out


def _runs(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(text, hash, data, start, end)`` of the runs of ``size`` words: the bytes of each, words joined by one space."""
    at, hashes = windows(words, size)
    if size == 1:
        return words.text, words.hash, words.data, words.start, words.end
    length = words.end - words.start + 1
    spread = np.concatenate([length[at + i] for i in range(size)]).reshape(size, -1).T.reshape(-1)  # with the space behind
    to = np.cumsum(spread)
    data = np.full(int(to[-1]) if len(to) else 0, 0x20, dtype=np.uint8)
    first = words.start[(at[:, None] + np.arange(size)).reshape(-1)]
    shift = np.repeat(first - (to - spread), spread)
    inside = np.ones(len(data), dtype=bool)
    inside[to - 1] = False
    places = np.flatnonzero(inside)
    data[places] = words.data[places + shift[places]]
    end = to[size - 1 :: size] - 1
    start = np.concatenate([[0], to[size - 1 :: size][:-1]]) if len(at) else end
    return words.text[at], hashes, data, start, end


def feature_buckets(texts: pa.Array, runs: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(text, bucket)`` of the features of each run length, and at last the words of each text as ``(count, empty)``."""
    words = split_words(*raw_bytes(texts), NOT_ALNUM, lower=True)
    for size in range(1, runs + 1):
        text, hashes, data, start, end = _runs(words, size)
        # Occurrences are grouped by a hash and compared with their group's first; any that differ count as features of their own.
        _, first, group = np.unique(hashes, return_index=True, return_inverse=True)
        like = first[group]
        length = end - start
        equal = (length == length[like]) & _same(data, start, start[like], np.minimum(length, length[like]))
        crc = crc32(data, start[first], end[first])[group]
        odd = np.flatnonzero(~equal)
        crc[odd] = crc32(data, start[odd], end[odd])
        yield text, (crc % _U32(buckets)).astype(np.int64)
    yield words.counts, np.zeros(0, dtype=np.int64)


def bucket_counts(docs: DataFrame, text: str, runs: int, buckets: int) -> np.ndarray:
    """Features of all rows by bucket."""

    def count(batch: pa.RecordBatch, counters: np.ndarray) -> None:
        for part in slices(batch, "text"):
            *found, _ = feature_buckets(part.column("text"), runs, buckets)
            for _, bucket in found:
                counters += np.bincount(bucket, minlength=buckets)

    return summed_counters(docs.select(F.col(text).alias("text")), buckets, count)


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket from its counts in the corpus and in the target, each smoothed by one, rounded down."""
    size, s, t = float(len(corpus)), corpus.astype(float), target.astype(float)
    return np.floor(SCALE * np.log((t + 1) * (s.sum() + size) / ((s + 1) * (t.sum() + size)))).astype(np.int64)


def gumbel(seed: str, key: Column) -> Column:
    """A Gumbel number, scaled and rounded down, from the first 32 bits of the sha256 of ``seed:key`` (a null key is empty)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-float(SCALE)) * F.ln(-F.ln(uniform)))


def importance(docs: DataFrame, target: DataFrame, *, key: str = "doc_id", text: str = "text", target_text: str = "text",
               runs: int = 1, buckets: int = BUCKETS, percent: int = 10, least: int = 20, seed: str = "2024",
               carry: tuple[str, ...] = ()) -> DataFrame:
    """``(key, n_features, n_words, weight, score, rank)``, all numbers long, and the ``carry`` columns for every row of ``docs``.

    ``rank`` (1, 2, 3, ...) is given to the ``percent`` in a hundred (rounded
    down) of the documents of at least ``least`` words that have the highest
    scores, ties to the smaller key (null last); it is null for all others.
    Words are lower-cased (A-Z) runs of anything but ASCII that is no letter or
    digit. Null, empty and wordless texts have no features, weight 0 and no
    rank. Repeated rows have equal scores and take ranks one after the other,
    rows of one key in the order of a hash of their texts. A target without
    words gives gains from the corpus alone; an empty table gives an empty
    result. Other columns are not read; one called ``n_features``,
    ``n_words``, ``weight``, ``score`` or ``rank`` cannot be carried.
    """
    gain = gains(bucket_counts(docs, text, runs, buckets), bucket_counts(target, target_text, runs, buckets))
    more = [f"_carried{i}" for i in range(len(carry))]
    source = docs.select(F.col(key).alias("_key"), F.col(text).alias("text"), F.xxhash64(text).alias("_hash"),
                         *(F.col(c).alias(m) for c, m in zip(carry, more)))
    names = ["_key", "_hash", *more]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                *found, (n_words, _) = feature_buckets(part.column("text"), runs, buckets)
                n, weight = (np.zeros(part.num_rows, dtype=np.int64) for _ in range(2))
                for own, bucket in found:
                    n += np.bincount(own, minlength=part.num_rows)
                    np.add.at(weight, own, gain[bucket])
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), pa.array(n), pa.array(n_words.astype(np.int64)), pa.array(weight)],
                    [*names, "n_features", "n_words", "weight"])

    schema = T.StructType([source.schema[c] for c in names])
    for c in ("n_features", "n_words", "weight"):
        schema = schema.add(c, T.LongType())
    score = (F.col("weight") + gumbel(seed, F.col("_key"))).alias("score")
    # The position in the written table tells equal rows apart, so that many copies of one row are dealt out too.
    scored = source.mapInArrow(weigh, schema).select("*", score, F.monotonically_increasing_id().alias("_at"))
    scored = written(scored, "importance-scores")
    long_enough = F.col("n_words") >= least
    eligible = scored.where(long_enough)
    wanted = eligible.count() * percent // 100
    order = [F.col("score").desc(), F.col("_key").asc_nulls_last(), F.col("_hash").asc_nulls_last(), F.col("_at").asc()]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = eligible.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = written(placed.select("*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid")), "importance-order")
    sizes = placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = sizes.select(F.col("_pid").alias("_p"), F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    rank = F.col("_offset") + F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33) + 1
    ranked = placed.join(F.broadcast(offsets), F.col("_pid") == F.col("_p")).withColumn("rank", F.when(rank <= wanted, rank))
    columns = ["_key", "n_features", "n_words", "weight", "score", "rank", *more]
    rest = scored.where(~long_enough).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*columns).unionByName(rest.select(*columns)).withColumnsRenamed({"_key": key} | dict(zip(more, carry)))


def resample(docs: DataFrame, target: DataFrame, *, key: str = "doc_id", **options) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns, and ``rank`` (an existing one is replaced); see :func:`importance`."""
    kept = docs.drop("rank")
    renamed = {c: f"_own{i}" for i, c in enumerate(kept.columns)}
    found = importance(kept.select("*", *(F.col(f"`{c}`").alias(r) for c, r in renamed.items())), target, key=key, carry=tuple(renamed.values()), **options)
    return found.where(F.col("rank").isNotNull()).select(*(F.col(r).alias(c) for c, r in renamed.items()), "rank")
