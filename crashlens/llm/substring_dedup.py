"""Substring dedup by prefix-partitioned suffix trees over words.

Every word position starts a suffix. Suffixes are split by a prefix of
variable length: by their first word; where that leaves more suffixes than a
group may hold, by their first two words, and so on, up to the length of the
repeats looked for. The sizes that decide this are counted over all documents,
one pass for each prefix length that is still needed; prefixes are then packed
into groups of at most ``GROUP`` suffixes. A group's suffixes meet in one
place, which builds the part of the tree below the group's prefixes that
matters: its internal nodes at the depth of ``window`` words. A node is a word
sequence, its leaves the documents in which it starts; a node with leaves in
two documents is a repeat, and neighbouring repeats of a document join to its
maximal ones.

A suffix is sent as its document and 56 bits of the hash of its first
``window`` words. As groups are bounded, so is the chance that two different
sequences of a group share those bits: ``GROUP / 2**56`` (4e-12) a suffix,
however large the corpus. Equal suffixes of the documents that a task holds
together are merged before they are sent, so a passage that a third of all
documents share sends one leaf a task and never makes a large group.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crashlens.llm.counters import marked_flags, summed_counters
from crashlens.llm.tables import remove, written
from crashlens.llm.words import WHITE_SPACE, U64, Words, _mix, raw_bytes, shrink, slices, split_words, windows

GROUP = 1 << 18  # suffixes of a group
HELD = 1 << 20  # suffixes a task merges at once
FLAG_BITS = 23  # logarithm of the flags that tell which documents have a repeat
HOT = 256  # an id with one row in so many, and more than SALTED rows, has its rows dealt to several blocks
SALTED = 64
FIRST_BITS, NEXT_BITS = 12, 8  # a prefix is told by bits of its words' hashes
BLOCK = 1 << 20  # words of the documents that get their repeats together


class Prefixes(NamedTuple):
    """For each prefix length a table: the group of a prefix, or ``-1 - child`` if it goes on in the next table."""

    tables: list[np.ndarray]

    def codes(self, words: Words, at: np.ndarray, upto: int) -> tuple[np.ndarray, np.ndarray]:
        """Place of each suffix in table ``upto`` (those that reach it), and which suffixes those are."""
        code = (words.hash[at] >> U64(64 - FIRST_BITS)).astype(np.int64)
        who = np.arange(len(at))
        for depth in range(upto):
            child = -1 - self.tables[depth][code]
            on = child >= 0
            who = who[on]
            code = (child[on] << NEXT_BITS) + (words.hash[at[who] + depth + 1] >> U64(64 - NEXT_BITS)).astype(np.int64)
        return code, who

    def groups(self, words: Words, at: np.ndarray) -> np.ndarray:
        out = np.empty(len(at), dtype=np.int32)
        for depth, table in enumerate(self.tables):
            code, who = self.codes(words, at, depth)
            out[who] = table[code]  # overwritten by the next table where negative
        return out


def _cut(part: pa.RecordBatch) -> Words:
    return split_words(*raw_bytes(part.column("text")), WHITE_SPACE)


def find_prefixes(docs: DataFrame, window: int, group: int) -> tuple[Prefixes, int, int]:
    """The prefix tables, how many groups they name, and how many suffixes there are."""
    tables: list[np.ndarray] = []
    size, total, groups, room = 1 << FIRST_BITS, 0, 0, 0
    for depth in range(window):
        known = Prefixes(list(tables))

        def count(batch: pa.RecordBatch, counters: np.ndarray, known: Prefixes = known, depth: int = depth) -> None:
            for part in slices(batch, "text"):
                words = _cut(part)
                at, _ = windows(words, window)
                code, _ = known.codes(words, at, depth)
                counters += np.bincount(code, minlength=len(counters))

        counts = summed_counters(docs, size, count)
        total = total or int(counts.sum())
        table = np.zeros(size, dtype=np.int64)
        heavy = 0
        for code, n in enumerate(counts.tolist()):
            if n > group and depth + 1 < window:
                table[code] = -1 - heavy
                heavy += 1
                continue
            if n > room:
                groups, room = groups + 1, group
            table[code] = max(groups - 1, 0)
            room = max(0, room - n)
        tables.append(table)
        if not heavy:
            break
        size = heavy << NEXT_BITS
    return Prefixes(tables), max(groups, 1), total


def _encode(ids: np.ndarray, hashes: np.ndarray) -> bytes:
    """Suffixes by document id and 56-bit hash; bytes of a kind lie together, which compresses the ids."""
    step = np.diff(ids, prepend=0).astype("<i8")
    planes = [np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :n].T).tobytes() for x, n in ((step, 8), (hashes.astype("<u8"), 7))]
    return b"".join(planes)


def _decode(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(raw) // 15
    bytes_ = np.frombuffer(raw, dtype=np.uint8).reshape(15, n)
    step = np.ascontiguousarray(bytes_[:8].T).view("<i8").reshape(-1)
    hashes = np.zeros((n, 8), dtype=np.uint8)
    hashes[:, :7] = bytes_[8:].T
    return np.cumsum(step), hashes.view("<u8").reshape(-1)


def _nodes(ids: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorts the suffixes into nodes; returns their order and, in it, the smallest document of each one's node."""
    order = np.lexsort((ids, hashes))
    own, node = ids[order], hashes[order]
    new = np.ones(len(own), dtype=bool)
    new[1:] = node[1:] != node[:-1]
    return order, own[new][np.cumsum(new) - 1]


def _rows(keys: np.ndarray, ids: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch:
    """One row ``(group, suffixes)`` for each key."""
    order = np.argsort(keys, kind="stable")
    keys, ids, hashes = keys[order], ids[order], hashes[order]
    edges = [*np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1)), len(keys)]
    return pa.RecordBatch.from_arrays(
        [pa.array(keys[edges[:-1]], pa.int32()), pa.array([_encode(ids[a:b], hashes[a:b]) for a, b in itertools.pairwise(edges)], pa.binary())], ["group", "suffixes"])


def _suffixes(docs: DataFrame, prefixes: Prefixes, window: int, blocks: int) -> DataFrame:
    """Suffixes by group; those that repeat an earlier document of the same task go to their block, as ``-1 - block``."""

    def send(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        ids, hashes, groups = (np.concatenate(x) for x in zip(*parts))
        order, least = _nodes(ids, hashes)
        ids, hashes, groups = ids[order], hashes[order], groups[order]
        new = np.ones(len(ids), dtype=bool)
        new[1:] = (ids[1:] != ids[:-1]) | (hashes[1:] != hashes[:-1])
        keys = np.where(ids > least, -1 - (ids % blocks), groups)[new]
        ids, hashes = ids[new], hashes[new]
        order = np.argsort(ids, kind="stable")
        return _rows(keys[order], ids[order], hashes[order])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                words = _cut(part)
                at, hashes = windows(words, window)
                ids = part.column("_key").to_numpy(zero_copy_only=False).astype(np.int64)
                held.append((ids[words.text[at]], hashes >> U64(8), prefixes.groups(words, at)))
                n += len(at)
                if n >= HELD:
                    yield send(held)
                    held, n = [], 0
        if n:
            yield send(held)

    return docs.mapInArrow(make, "group int, suffixes binary")


def _repeats(suffixes: DataFrame, blocks: int) -> DataFrame:
    """``(block, suffixes)``: the suffixes whose node also has a leaf in a smaller document."""

    def deep(table: pa.Table) -> pa.Table:
        group = table.column("group")[0].as_py()
        if group < 0:
            keys, raw = pa.array([-1 - group] * table.num_rows, pa.int32()), table.column("suffixes")
            return pa.table({"block": keys, "suffixes": raw})
        ids, hashes = (np.concatenate(x) for x in zip(*(_decode(x.as_py()) for x in table.column("suffixes"))))
        order, least = _nodes(ids, hashes)
        order = order[ids[order] > least]
        order = order[np.argsort(ids[order], kind="stable")]
        ids, hashes = ids[order], hashes[order]
        rows = _rows(ids % blocks, ids, hashes) if len(ids) else _NONE
        return pa.table({"block": rows.column(0), "suffixes": rows.column(1)})

    return suffixes.groupBy("group").applyInArrow(deep, "block int, suffixes binary")


_NONE = pa.RecordBatch.from_arrays([pa.array([], pa.int32()), pa.array([], pa.binary())], ["group", "suffixes"])


def _without(words: Words, data: bytes, low: int, high: int, gone: np.ndarray) -> str:
    """A text without the words flagged in ``gone``; a removed run goes with the white space that follows it."""
    starts, out, at = words.start, [], low
    flips = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0))
    for i, flip in enumerate(flips.tolist()):
        to = int(starts[flip])
        if i % 2 == 0:
            out.append(data[at:to])
        at = to
    if len(flips) % 2 == 0:
        out.append(data[at:high])
    return b"".join(out).decode("utf-8", "replace")


def _flag(ids: np.ndarray) -> np.ndarray:
    """The flag of each document id."""
    return shrink(_mix(ids.astype(np.int64).view(U64)), FLAG_BITS)


def _mark_hits(batch: pa.RecordBatch, flags: np.ndarray) -> None:
    """Sets the flags of the documents that rows of repeats name."""
    for raw in batch.column("suffixes"):
        flags[_flag(_decode(raw.as_py())[0])] = True


def _hot_ids(rows: DataFrame, blocks: int) -> tuple[list[int], int]:
    """Ids that one row in ``HOT`` or more has (``HOT`` ids at most), and how many blocks the rows of the largest would fill."""
    sizes = written(rows.groupBy("_key").agg(F.count(F.lit(1)).alias("n")), "rows-by-id")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    hot = sizes.where((F.col("n") * HOT >= total) & (F.col("n") > SALTED)).collect()
    remove(sizes)
    return [r["_key"] for r in hot], max(1, *(-(-r["n"] * blocks // total) for r in hot), 1)


def remove_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", window: int = 13, group: int = GROUP,
                   carry: tuple[str, ...] = ()) -> DataFrame:
    """``(key, text, n_words, n_removed, spans)`` and the ``carry`` columns for every row of ``docs``.

    A word is removed if it lies in a window of ``window`` consecutive words (runs
    of anything but ASCII white space) whose sequence also starts in a document
    with a smaller id; windows are those of the input. ``text`` is what is left,
    with its white space, and ``spans`` (``start``, ``end`` in words) are the
    maximal removed runs.

    ``key`` must be an integer column. Rows that share an id count as one
    document and do not remove each other's words. Null texts have no words
    and stay null; rows with a null id neither lose words nor make others lose
    any. Columns not in ``carry`` are not read; one that is called ``n_words``,
    ``n_removed`` or ``spans`` cannot be carried.

    Only rows of documents with a repeat are shuffled with their texts (and the
    few that share a flag with one); all others pass in a map stage. The rows
    of an id that very many rows have are dealt to several blocks, each of which
    gets that id's repeats.
    """
    more = [f"_carried{i}" for i in range(len(carry))]
    source = docs.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("text"), *(F.col(c).alias(m) for c, m in zip(carry, more)))
    usable = source.where(F.col("_key").isNotNull() & F.col("text").isNotNull()).select("_key", "text")
    prefixes, _, total = find_prefixes(usable, window, group)
    blocks = 2 * (total // BLOCK // 2) + 7  # odd
    found = written(_repeats(_suffixes(usable, prefixes, window, blocks), blocks), "repeats")
    flags = np.packbits(marked_flags(found, FLAG_BITS, _mark_hits), bitorder="little")
    hot, salts = _hot_ids(usable, blocks)

    def chosen(batch: pa.RecordBatch, hit: bool) -> pa.RecordBatch:
        keys = batch.column("_key")
        at = _flag(keys.fill_null(0).to_numpy())
        own = ((flags[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1) & keys.is_valid().to_numpy(zero_copy_only=False)
        return batch.filter(pa.array(own if hit else ~own))

    def finish(left: pa.Table, right: pa.Table | None) -> pa.Table:
        ids, hashes = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=U64)
        if right is not None and right.num_rows:
            ids, hashes = (np.concatenate(x) for x in zip(*(_decode(x.as_py()) for x in right.column("suffixes"))))
            order = np.lexsort((hashes, ids))
            ids, hashes = ids[order], hashes[order]
        out: dict[str, list] = {c: [] for c in ("_key", "text", "n_words", "n_removed", "spans")}
        for batch in left.to_batches():
            for part in slices(batch, "text"):
                words = _cut(part)
                at, own = windows(words, window)
                own = own >> U64(8)
                first = np.searchsorted(at, words.first)
                data, offsets = raw_bytes(part.column("text"))
                whole = data.tobytes()
                keys = part.column("_key")
                for i in range(part.num_rows):
                    n, base = int(words.first[i + 1] - words.first[i]), int(words.first[i])
                    removed, spans, kept = 0, [], part.column("text")[i].as_py()
                    row = keys[i].as_py()
                    a, b = np.searchsorted(ids, (row, row + 1)) if row is not None else (0, 0)
                    if a < b:
                        hit = np.isin(own[first[i] : first[i + 1]], hashes[a:b])
                        starts = at[first[i] : first[i + 1]][hit] - base
                        depth = np.zeros(n + 1, dtype=np.int32)
                        np.add.at(depth, starts, 1)
                        np.add.at(depth, starts + window, -1)
                        gone = np.cumsum(depth)[:n] > 0
                        removed = int(gone.sum())
                        if removed:
                            edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
                            spans = [{"start": int(x), "end": int(y)} for x, y in edges.reshape(-1, 2)]
                            mine = words._replace(start=words.start[base : base + n])
                            kept = _without(mine, whole, int(offsets[i]), int(offsets[i + 1]), gone)
                    for c, v in zip(out, (row, kept, n, removed, spans)):
                        out[c].append(v)
        kinds = {"_key": pa.int64(), "text": pa.string(), "n_words": pa.int64(), "n_removed": pa.int64(), "spans": _SPANS}
        return pa.table({c: pa.array(out[c], kinds[c]) for c in out} | {m: left.column(m) for m in more})

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(chosen(batch, False), "text"):
                counts = _cut(part).counts.astype(np.int64)
                nothing = pa.ListArray.from_arrays(pa.array(np.zeros(part.num_rows + 1, dtype=np.int32)), pa.array([], _SPANS.value_type))
                columns = [part.column("_key"), part.column("text"), pa.array(counts), pa.array(np.zeros(part.num_rows, dtype=np.int64)), nothing]
                yield pa.RecordBatch.from_arrays([*columns, *(part.column(m) for m in more)], ["_key", "text", "n_words", "n_removed", "spans", *more])

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield chosen(batch, True)

    span = T.StructType().add("start", T.IntegerType()).add("end", T.IntegerType())
    long = T.LongType()
    schema = T.StructType().add("_key", long).add("text", T.StringType()).add("n_words", long).add("n_removed", long).add("spans", T.ArrayType(span))
    for m in more:
        schema = schema.add(source.schema[m])
    rows = source.mapInArrow(hits, source.schema)
    salt = F.when(F.col("_key").isin(hot), F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")).otherwise(0)
    rows = rows.withColumn("block", F.pmod("_key", F.lit(blocks)).cast("int")).withColumn("salt", salt)
    every = F.when(F.col("block").isin([i % blocks for i in hot]), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    repeats = found.withColumn("salt", F.explode(every))
    done = rows.groupBy("block", "salt").cogroup(repeats.groupBy("block", "salt")).applyInArrow(finish, schema)
    done = done.unionByName(source.mapInArrow(clean, schema))
    return done.withColumnsRenamed({"_key": key, "text": text} | dict(zip(more, carry)))


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
