"""Near-duplicate documents by bottom-k sketches.

1. **Sketch.** Every document becomes its set of distinct word shingles, each
   shingle a hash; the documents' sets are classes (equal sets, one class). One
   hash function, with shingles that are frequent in the corpus moved behind
   all others, orders the shingles, and a set of n keeps its bottom k for
   ``k = n - ceil(t n) + 1``. With that k two sets of similarity t or more
   always share a retained value, so no link can be lost. Which shingles are
   frequent is read off a fixed number of counters over all documents; what the
   counters say moves work about, never results.
2. **Inverted lists** of the retained values give pairs. In each list members
   are first paired with one hub (the member with the fewest rarer values), so
   a list costs as many pairs as it has members.
3. **Filters.** The place of the shared value in both sketches bounds the
   overlap; after that the union of two sketches of ``SKETCH`` values estimates
   the similarity, and pairs far below the threshold (six standard deviations)
   go.
4. **Exact Jaccard** on the full sets confirms a link. Only documents that
   still stand in a pair have their full sets made and sent.
5. A second round pairs members of a list that the first round left in
   *different* components, in blocks, so that a hot list is shared out and a
   group of copies is never expanded into its pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crashlens.llm.counters import hash_flags, summed_counters
from crashlens.llm.graph import components
from crashlens.llm.tables import remove, written
from crashlens.llm.words import WHITE_SPACE, U64, _mix, raw_bytes, shingle_sets, shrink, slices, split_words, windows

COUNTER_BITS = 20
SKETCH = 32  # values compared to estimate a similarity
FLAG_BITS = 23  # logarithm of the flags that tell which documents' full sets are wanted
BLOCK = 512  # members of a list compared with each other at once


def _sets(texts: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = raw_bytes(texts)
    return shingle_sets(split_words(data, offsets, WHITE_SPACE, lower=True), length)


def _least(n: np.ndarray, percent: int) -> np.ndarray:
    """The smallest overlap with which a set of ``n`` can reach the threshold."""
    return (percent * n + 99) // 100


def _counters(docs: DataFrame, length: int) -> np.ndarray:
    """Shingle occurrences over all documents, by the top bits of the hash (a fixed number of counters)."""

    def count(batch: pa.RecordBatch, table: np.ndarray) -> None:
        for part in slices(batch, "text"):
            data, offsets = raw_bytes(part.column("text"))
            _, hashes = windows(split_words(data, offsets, WHITE_SPACE, lower=True), length)
            table += np.bincount(shrink(hashes, COUNTER_BITS), minlength=len(table))

    return summed_counters(docs.where(F.col("text").isNotNull()).select("text"), 1 << COUNTER_BITS, count)


def _frequency_classes(table: np.ndarray) -> np.ndarray:
    """0 for counters near the usual count, 1 and more the farther a counter lies above it."""
    usual = float(np.median(table))
    step = max(32.0, 6 * usual**0.5)
    above = np.maximum(table - usual, 1) / step
    return np.where(above < 1, 0, 1 + np.floor(np.log2(np.maximum(above, 1)))).astype(np.int64)


def _first_of(groups: np.ndarray) -> np.ndarray:
    """Position of the first row of each row's run of equal values."""
    new = np.ones(len(groups), dtype=bool)
    new[1:] = groups[1:] != groups[:-1]
    return np.flatnonzero(new)[np.cumsum(new) - 1]


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _set_ids(text: np.ndarray, hashes: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and class (a 64-bit fingerprint of the set) of each text; class 0 stands for the empty set."""
    sizes = np.bincount(text, minlength=rows)
    ids = np.zeros(rows, dtype=U64)
    some = np.flatnonzero(sizes)
    if len(some):
        starts = np.flatnonzero(_first_of(text) == np.arange(len(text)))
        ids[some] = _mix(np.add.reduceat(_mix(hashes), starts) + sizes[some].astype(U64)) | U64(1)
    return sizes, _signed(ids)


def _batch(columns: dict[str, np.ndarray | pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns.values()], list(columns))


def _postings(docs: DataFrame, length: int, percent: int, classes: np.ndarray) -> DataFrame:
    """``(value, class, n, place)``: every retained value of every set, with its place in the set's order.

    A task sends a class once, however many copies of it the task has.
    """
    classes = classes.astype(np.uint8)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in slices(batch, "text"):
                text, hashes = _sets(part.column("text"), length)
                sizes, ids = _set_ids(text, hashes, part.num_rows)
                new = np.zeros(part.num_rows, dtype=bool)
                for i, own in enumerate(ids.tolist()):
                    if own not in seen:
                        seen.add(own)
                        new[i] = True
                rank = classes[shrink(hashes, COUNTER_BITS)]
                if rank.any():  # frequent shingles go behind all others
                    order = np.argsort(text * 256 + rank, kind="stable")
                    text, hashes = text[order], hashes[order]
                place = np.arange(len(text)) - _first_of(text)
                keep = (place < (sizes - _least(sizes, percent) + 1)[text]) & new[text]
                text = text[keep]
                yield _batch({"value": _signed(hashes[keep]), "class": ids[text], "n": sizes[text].astype(np.int32), "place": place[keep].astype(np.int32)})

    schema = "value long, class long, n int, place int"
    return docs.where(F.col("text").isNotNull()).select("text").mapInArrow(make, schema)


def _may_link(n1: np.ndarray, p1: np.ndarray, n2: np.ndarray, p2: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes, whose first shared value is at these places, can reach the threshold."""
    overlap = np.minimum(n1 - p1, n2 - p2)
    return (100 + percent) * overlap >= percent * (n1 + n2)


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """Rows of sorted batches as arrays, cut only between runs of equal keys."""
    kept: list[pa.RecordBatch] = []

    def arrays(parts: list[pa.RecordBatch]) -> dict[str, np.ndarray]:
        table = pa.Table.from_batches(parts)
        return {c: table.column(c).to_numpy() for c in table.column_names}

    for batch in batches:
        if batch.num_rows == 0:
            continue
        same = np.ones(batch.num_rows, dtype=bool)
        for key in keys:
            column = batch.column(key).to_numpy(zero_copy_only=False)
            same &= column == column[-1]
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if cut:
            yield arrays([*kept, batch.slice(0, cut)])
            kept = []
        elif kept and any(kept[-1].column(k)[0].as_py() != batch.column(k)[0].as_py() for k in keys):
            yield arrays(kept)
            kept = []
        kept.append(batch.slice(cut))
    if kept:
        yield arrays(kept)


def _hub_lists(postings: DataFrame, percent: int, hubs: int = 4) -> DataFrame:
    """Lists of two classes or more, and pairs of their members with a hub.

    Rows ``(kind, value, class, n, place, size, other)``: kind 0 is a posting of a list
    of ``size`` members, kind 1 a pair (``class``, ``other``). A member that the
    filter keeps from the first hub is tried with up to ``hubs`` more.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, ["value"]):
            value, who, n, place = (rows[c] for c in ("value", "class", "n", "place"))
            keep = np.ones(len(value), dtype=bool)
            keep[1:] = (value[1:] != value[:-1]) | (who[1:] != who[:-1])  # exact copies
            value, who, n, place = value[keep], who[keep], n[keep].astype(np.int64), place[keep].astype(np.int64)
            first = _first_of(value)
            size = np.bincount(first, minlength=len(value))[first]
            keep = size > 1
            value, who, n, place, size = value[keep], who[keep], n[keep], place[keep], size[keep]
            if not len(value):
                continue
            none = np.zeros(len(value), dtype=np.int64)
            yield _batch({"kind": none.astype(np.int32), "value": value, "class": who, "n": n.astype(np.int32), "place": place.astype(np.int32), "size": size.astype(np.int32), "other": none})
            left = np.arange(len(value))
            for _ in range(hubs):
                hub = left[_first_of(value[left])]
                fits = _may_link(n[left], place[left], n[hub], place[hub], percent) & (hub != left)
                if fits.any():
                    a, b = who[hub[fits]], who[left[fits]]
                    zero = np.zeros(len(a), dtype=np.int32)
                    yield _batch({"kind": zero + 1, "value": a, "class": b, "n": zero, "place": zero, "size": zero, "other": a})
                left = left[~fits & (hub != left)]
                if not len(left):
                    break

    schema = "kind int, value long, class long, n int, place int, size int, other long"
    return postings.repartition("value").sortWithinPartitions("value", "place", "class").mapInArrow(make, schema)


def _floor(percent: int) -> float:
    """The share of a sketch's values that linked sets share, less six standard deviations."""
    t = percent / 100
    return t - 6 * (t * (1 - t) / SKETCH) ** 0.5


def _marks(sketches: pa.Array) -> np.ndarray:
    """16 bits of each sketch value; -1 where a set has fewer values."""
    data, offsets = raw_bytes(sketches)
    counts = np.diff(offsets) // 8
    out = np.full((len(counts), SKETCH), -1, dtype=np.int32)
    out[np.arange(SKETCH) < counts[:, None]] = np.frombuffer(data.tobytes(), dtype=U64) & U64(0xFFFF)
    return out


def _enough(x: np.ndarray, y: np.ndarray, share: float) -> np.ndarray:
    """Row by row, whether two sets of marks agree in ``share`` of the smaller one's."""
    out = np.zeros(len(x), dtype=bool)
    for at in range(0, len(x), 4096):
        a, b = x[at : at + 4096], y[at : at + 4096]
        both = ((a[:, :, None] == b[:, None, :]) & (a >= 0)[:, :, None]).any(axis=2).sum(axis=1)
        out[at : at + 4096] = both >= np.floor(share * np.minimum((a >= 0).sum(axis=1), (b >= 0).sum(axis=1)))
    return out


def _across(lists: DataFrame, parts: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs (``a`` < ``b``) of list members that lie in different components and pass the filters."""
    share = _floor(percent)
    labelled = lists.join(parts.select(F.col("id").alias("class"), "component"), "class", "left")
    labelled = written(labelled.withColumn("component", F.coalesce("component", "class")), "lists-labelled")
    several = (
        labelled.groupBy("value").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high").select("value")
    )
    several = written(several, "lists-open")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    left = written(labelled.join(several, "value", "left_semi"), "lists-left")
    # Two members that have the same open list just before this one meet there already.
    before = F.coalesce(F.lag("value").over(Window.partitionBy("class").orderBy("place")), "class")
    spread = (
        left.join(sketches.select("class", "sketch"), "class").withColumn("before", before)
        .withColumn("mine", F.pmod(F.hash("class"), blocks))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("value", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "class", "n", "place", "component", "before", "sketch")
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = _marks(batch.column("sketch")).astype(np.uint16)
            n = np.minimum(batch.column("n").to_numpy(), SKETCH)
            raw = pa.array([m[:k].tobytes() for m, k in zip(marks, n.tolist())], pa.binary())
            yield batch.set_column(batch.schema.get_field_index("sketch"), "sketch", raw)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["value", "i", "j"]
        for rows in _runs(batches, keys):
            change = np.zeros(len(rows["value"]), dtype=bool)
            for key in keys:
                change[1:] |= rows[key][1:] != rows[key][:-1]
            edges = [0, *np.flatnonzero(change), len(change)]
            found_a, found_b = [], []
            for low, high in zip(edges[:-1], edges[1:]):
                who, n, place, part, block = (rows[c][low:high] for c in ("class", "n", "place", "component", "mine"))
                if high - low < 2 or (part == part[0]).all():
                    continue
                n, place = n.astype(np.int64), place.astype(np.int64)
                before = rows["before"][low:high]
                marks = np.full((high - low, SKETCH), -1, dtype=np.int32)
                for at, raw in enumerate(rows["sketch"][low:high]):
                    own = np.frombuffer(raw, dtype=np.uint16)
                    marks[at, : len(own)] = own
                i, j = rows["i"][low], rows["j"][low]
                left = np.flatnonzero(block == i)
                right = left if i == j else np.flatnonzero(block == j)
                for at in range(0, len(left), BLOCK):
                    x = left[at : at + BLOCK, None]
                    ok = _may_link(n[x], place[x], n[right], place[right], percent) & (part[x] != part[right]) & (before[x] != before[right])
                    a, b = np.nonzero(ok & ((who[x] < who[right]) | (i != j)))
                    a, b = left[at + a], right[b]
                    good = _enough(marks[a], marks[b], share)
                    found_a.append(who[a[good]])
                    found_b.append(who[b[good]])
            if found_a:
                a, b = np.concatenate(found_a), np.concatenate(found_b)
                ab = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
                yield _batch({"a": ab[:, 0].copy(), "b": ab[:, 1].copy()})

    packed = spread.mapInArrow(pack, spread.schema)
    pairs = packed.repartition("value", "i", "j").sortWithinPartitions("value", "i", "j").mapInArrow(make, "a long, b long")
    found = written(pairs.distinct(), "pairs-across")
    remove(several, labelled, left)
    return found


def _estimated(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs whose similarity, estimated from the union of both sketches, may reach the threshold."""
    share = _floor(percent)

    def likely(x: np.ndarray, y: np.ndarray) -> bool:
        union = np.union1d(x, y)[:SKETCH]
        shared = np.isin(union, x, assume_unique=True) & np.isin(union, y, assume_unique=True)
        return shared.mean() >= share

    return _judged(pairs, sketches, "sketch", likely)


def _judged(pairs: DataFrame, values: DataFrame, column: str, good: Callable[[np.ndarray, np.ndarray], bool]) -> DataFrame:
    """The pairs for whose two sorted hash arrays ``good`` holds."""
    own = values.select(F.col("class").alias("b"), F.col(column).alias("set_b"))
    hub = values.select(F.col("class").alias("a"), F.col(column).alias("set_a"))

    def arrays(column: pa.Array) -> list[np.ndarray]:
        return [np.frombuffer(x.as_buffer(), dtype=U64) for x in column]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = pa.array([good(x, y) for x, y in zip(arrays(batch.column("set_a")), arrays(batch.column("set_b")))], pa.bool_())
            yield batch.select(["a", "b"]).filter(keep)

    return pairs.join(own, "b").join(hub, "a").select("a", "b", "set_a", "set_b").mapInArrow(make, "a long, b long")


def _confirmed(pairs: DataFrame, classes: DataFrame, source: DataFrame, length: int, percent: int, name: str) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    wanted = classes.join(wanted, "class", "left_semi").select(F.xxhash64("_key").alias("h"))
    flags = np.packbits(hash_flags(wanted, "h", FLAG_BITS), bitorder="little")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = shrink(batch.column("h").to_numpy().view(U64), FLAG_BITS)
            chosen = batch.filter(pa.array((flags[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1))
            for part in slices(chosen, "text"):
                found, hashes = _sets(part.column("text"), length)
                sizes, ids = _set_ids(found, hashes, part.num_rows)
                at = np.concatenate([[0], np.cumsum(sizes)])
                raw = [hashes[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]
                yield _batch({"class": ids, "shingles": pa.array(raw, pa.binary())})

    texts = source.where(F.col("text").isNotNull() & F.col("_key").isNotNull()).select(F.xxhash64("_key").alias("h"), "text")
    sets = written(texts.mapInArrow(fill, "class long, shingles binary"), f"sets-{name}")

    def similar(x: np.ndarray, y: np.ndarray) -> bool:
        both = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * both >= percent * (len(x) + len(y) - both)

    # One row a class: copies of it pass the flags too, and would meet in the join copy by copy.
    links = written(_judged(pairs, sets.dropDuplicates(["class"]), "shingles", similar), f"links-{name}")
    remove(sets)
    return links


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """``(key, n_shingles, component_id, kept)`` for every row of ``docs``.

    Two documents are linked if ``100 |A & B| >= percent |A | B|`` for their sets
    of ``shingle``-word shingles (ASCII letters lower-cased; a shorter text is
    one shingle). ``component_id`` is the smallest id reachable by links, and
    ``kept`` says whether that is the row itself.

    Null, empty and blank texts have an empty set and stand alone. Repeated
    rows give repeated results. A row with a null id is grouped with rows of equal
    sets only, gets their smallest id, and is kept only if they have none. Other
    columns are not read.
    """
    source = docs.select(F.col(key).alias("_key"), F.col(text).alias("text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found, hashes = _sets(part.column("text"), shingle)
                sizes, ids = _set_ids(found, hashes, part.num_rows)
                at = np.concatenate([[0], np.cumsum(sizes)])[:-1]
                raw = [hashes[a : a + min(n, SKETCH)].tobytes() for a, n in zip(at.tolist(), sizes.tolist())]
                yield _batch({"_key": part.column("_key"), "n": sizes.astype(np.int32), "class": pa.array(ids, mask=sizes == 0), "sketch": pa.array(raw, pa.binary())})

    key_type = source.schema["_key"].dataType.simpleString()
    sized = written(source.mapInArrow(measure, f"_key {key_type}, n int, class long, sketch binary"), "sizes")
    lists = _hub_lists(_postings(source, shingle, percent, _frequency_classes(_counters(source, shingle))), percent)
    lists = written(lists, "lists")
    postings = lists.where("kind = 0").select("value", "class", "n", "place", "size")
    hubs = lists.where("kind = 1").select(F.least("class", "other").alias("a"), F.greatest("class", "other").alias("b"))
    hubs = written(hubs.distinct(), "pairs")
    # One row, with one document, for each class that stands in some list.
    classes = sized.where("class is not null and _key is not null").groupBy("class").agg(F.min("_key").alias("_key"), F.min("sketch").alias("sketch"))
    classes = written(classes.join(postings.select("class").distinct(), "class", "left_semi"), "classes")

    first = written(_estimated(hubs, classes, percent), "pairs-likely")
    links = _confirmed(first, classes, source, shingle, percent, "hubs")
    parts = components(links)
    across = _across(postings, parts, classes, percent)
    second = written(_estimated(across.join(hubs, ["a", "b"], "left_anti"), classes, percent), "pairs-likely")
    if not second.isEmpty():
        more = _confirmed(second, classes, source, shingle, percent, "across")
        remove(parts)
        parts = components(links.unionByName(more))
        remove(more)
    remove(lists, hubs, classes, first, links, across, second)

    some = sized.where("class is not null").join(parts.withColumnRenamed("id", "class"), "class", "left")
    some = written(some.select("_key", "n", F.coalesce("component", "class").alias("component")), "members-labelled")
    least = written(some.groupBy("component").agg(F.min("_key").alias("component_id")), "components-least")
    grouped = some.join(least, "component").select("_key", "n", "component_id")
    alone = sized.where("class is null").select("_key", "n", F.col("_key").alias("component_id"))
    return grouped.unionByName(alone).select(
        F.col("_key").alias(key), F.col("n").cast("long").alias("n_shingles"), "component_id",
        F.coalesce(F.col("_key") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"),
    )
