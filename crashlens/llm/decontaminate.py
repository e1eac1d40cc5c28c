"""Benchmark decontamination by a prefix-filtered set join.

Every benchmark item is cut into windows of consecutive words (an item shorter
than a window is one window), and a window into its word shingles, the tokens
of the join. Shingles are ordered by how often they occur in the documents,
counted over all of them. A window that lies in a document whole has all its
shingles there, so its necessary prefix is one token: the rarest. Documents
send only occurrences of such tokens, with the few words around them; the join
on the token gives candidates, bounds on length and position drop those for
which the window would stick out of the document, and comparing the words
confirms the rest.

Which document shingles are worth sending is told by bitmaps of a fixed size.
A larger benchmark fills them up, which sends more and loses nothing; the
benchmark itself is joined, never broadcast by this module.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crashlens.llm.counters import hash_flags
from crashlens.llm.tables import remove, written
from crashlens.llm.words import NOT_ALNUM, Words, raw_bytes, shrink, slices, split_words, windows

BITMAP_BITS = 22  # logarithm of a bitmap's flags: 4 MB for each shingle size in use
ITEM_BYTES = 1 << 18  # item text cut into windows at once


def _words(texts: pa.Array) -> Words:
    return split_words(*raw_bytes(texts), NOT_ALNUM, lower=True)


def _joined(words: Words, low: int, high: int) -> str:
    """Words ``low`` to ``high - 1``, joined by spaces."""
    data = words.data
    return b" ".join(data[s:e].tobytes() for s, e in zip(words.start[low:high], words.end[low:high])).decode("utf-8", "replace")


def item_windows(items: DataFrame, item: str, text: str, window: int, shingle: int) -> DataFrame:
    """``(item, words, window, size, offset, token)``: every shingle of every window of every item."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", ITEM_BYTES):
                words = _words(part.column("text"))
                rows: dict[str, list] = {c: [] for c in ("row", "window", "words", "size", "offset", "token")}
                hashes = {m: dict(zip(*(x.tolist() for x in _signed(windows(words, m))))) for m in range(1, shingle + 1)}
                for i, n in enumerate(words.counts.tolist()):
                    length, first = min(n, window), int(words.first[i])
                    size = min(length, shingle)
                    for at in range(first, first + n - length + 1) if n else ():
                        for offset in range(length - size + 1):
                            for c, v in zip(rows, (i, _joined(words, at, at + length), length, size, offset, hashes[size][at + offset])):
                                rows[c].append(v)
                out = {"item": part.column("item").take(pa.array(rows["row"], pa.int32())), "window": pa.array(rows["window"], pa.string())}
                out |= {c: pa.array(rows[c], pa.int32()) for c in ("words", "size", "offset")} | {"token": pa.array(rows["token"], pa.int64())}
                yield pa.RecordBatch.from_arrays(list(out.values()), list(out))

    source = items.where(F.col(text).isNotNull()).select(F.col(item).cast("string").alias("item"), F.col(text).alias("text"))
    return source.mapInArrow(make, "item string, window string, words int, size int, offset int, token long")


def _signed(found: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return found[0], found[1].view(np.int64)


def _occurrences(docs: DataFrame, flags: dict[int, np.ndarray], window: int) -> DataFrame:
    """Documents with their word count and the occurrences of flagged shingles, with the words around."""
    key_type = docs.schema["_key"].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = _words(part.column("text"))
                text, rows = words.text, {c: [] for c in ("row", "size", "token", "at", "low", "near")}
                for size, own in flags.items():
                    at, tokens = _signed(windows(words, size))
                    hit = own[shrink(tokens.view(np.uint64), BITMAP_BITS)]
                    for i, token in zip(at[hit].tolist(), tokens[hit].tolist()):
                        first, last = words.first[text[i]], words.first[text[i] + 1]
                        low, high = max(first, i - window + size), min(last, i + window)
                        for c, v in zip(rows, (text[i], size, token, i - first, low - first, _joined(words, low, high))):
                            rows[c].append(v)
                order = np.argsort(np.array(rows["row"], dtype=np.int64), kind="stable")
                found = pa.StructArray.from_arrays(
                    [pa.array(rows[c], t).take(pa.array(order)) for c, t in _FOUND.items()], list(_FOUND))
                offsets = np.searchsorted(np.array(rows["row"], dtype=np.int64)[order], np.arange(part.num_rows + 1))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), found)
                out = {"_key": part.column("_key"), "_hash": part.column("_hash"), "n_words": pa.array(words.counts, pa.int64()), "found": lists}
                yield pa.RecordBatch.from_arrays(list(out.values()), list(out))

    schema = f"_key {key_type}, _hash long, n_words long, found array<struct<size:int,token:long,at:int,low:int,near:string>>"
    return docs.mapInArrow(make, schema)


_FOUND = {"size": pa.int32(), "token": pa.int64(), "at": pa.int32(), "low": pa.int32(), "near": pa.string()}


def _frequencies(docs: DataFrame, flags: dict[int, np.ndarray]) -> DataFrame:
    """``(size, token, n)``: occurrences of flagged shingles in all documents."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words = _words(part.column("text"))
                for size, own in flags.items():
                    _, tokens = windows(words, size)
                    some, n = np.unique(tokens[own[shrink(tokens, BITMAP_BITS)]].view(np.int64), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), size, dtype=np.int32)), pa.array(some), pa.array(n.astype(np.int64))], ["size", "token", "n"])

    counted = docs.select("text").mapInArrow(make, "size int, token long, n long")
    return counted.groupBy("size", "token").agg(F.sum("n").alias("n"))


def occurrences(docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text", item: str = "item_id",
                item_text: str = "text", window: int = 13, shingle: int = 5) -> DataFrame:
    """One row per document: ``_key, _hash, n_words, spans, items``.

    ``spans`` are the places (``start``, ``end`` in words) at which a window of
    some item occurs, ``items`` the ids (as strings, sorted) of those items.
    ``_hash`` is a hash of the text, so that rows that share an id are judged
    each by its own text; equal rows give equal results. Null, empty or
    wordless texts have no words and no spans. Items without a text or words take
    no part; those without an id have spans, but nothing in ``items``. Other
    columns are not read.
    """
    source = docs.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_hash"), F.col(text).alias("text"))
    tokens = written(item_windows(items, item, item_text, window, shingle), "item-windows")
    sizes = [r["size"] for r in tokens.select("size").distinct().collect()]  # at most `shingle` numbers
    flags = {m: hash_flags(tokens.where(F.col("size") == m), "token", BITMAP_BITS) for m in sizes}
    known = tokens.join(_frequencies(source, flags), ["size", "token"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = F.min(F.struct("n", "token", "offset", "size"))
    prefix = known.groupBy("window", "words").agg(rarest.alias("r")).where("r.n > 0")
    prefix = written(prefix.select("window", "words", "r.size", "r.token", "r.offset"), "item-prefixes")
    flags = {m: hash_flags(prefix.where(F.col("size") == m), "token", BITMAP_BITS) for m in sizes}
    found = written(_occurrences(source, flags, window), "occurrences")
    spread = found.select("_key", "_hash", "n_words", F.explode("found").alias("f")).select("_key", "_hash", "n_words", "f.*")
    start = F.col("at") - F.col("offset")
    inside = (start >= 0) & (start + F.col("words") <= F.col("n_words"))  # length and position
    same = F.array_join(F.slice(F.split("near", " "), start - F.col("low") + 1, F.col("words")), " ") == F.col("window")
    hits = (
        spread.join(prefix, ["size", "token"]).where(inside).where(same)
        .select("_key", "_hash", "window", start.alias("start"), (start + F.col("words")).alias("end"))
    )
    owners = tokens.groupBy("window").agg(F.collect_set("item").alias("items"))
    hits = hits.join(owners, "window").groupBy("_key", "_hash").agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    hits = written(hits, "hits").select(F.col("_key").alias("_k"), F.col("_hash").alias("_h"), "spans", "items")
    joined = found.join(hits, found["_key"].eqNullSafe(hits["_k"]) & (found["_hash"] == hits["_h"]), "left")
    remove(tokens, prefix)
    return joined.select(
        "_key", "_hash", "n_words",
        F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def covered(spans: str = "spans") -> F.Column:
    """Words in the union of sorted spans."""
    start = F.struct(F.lit(0).alias("to"), F.lit(0).cast("long").alias("n"))

    def step(acc: F.Column, x: F.Column) -> F.Column:
        more = F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], acc["to"]))
        return F.struct(F.greatest(acc["to"], x["end"]).alias("to"), (acc["n"] + more).alias("n"))

    return F.aggregate(spans, start, step, lambda acc: acc["n"])


def contamination(docs: DataFrame, items: DataFrame, *, key: str = "doc_id", share: int = 20, **options) -> DataFrame:
    """``(key, _hash, n_words, n_hit, items, contaminated)`` per row of ``docs``; see :func:`occurrences`.

    A word inside a span is hit. A document is contaminated if it has a hit and
    at least one word in ``share`` is hit.
    """
    found = occurrences(docs, items, key=key, **options).withColumn("n_hit", covered())
    return found.select(
        F.col("_key").alias(key), "_hash", "n_words", "n_hit", "items",
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )
