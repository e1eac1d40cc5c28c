"""Near-duplicate embeddings by Euclidean p-stable hashing.

Vectors are scaled to length 1, where a cosine of c is a distance of
``sqrt(2 - 2c)``. A table has ``PROJECTIONS`` random Gaussian directions;
a vector's bucket is the list of its projections, shifted at random, divided
by ``WIDTH`` and rounded down. With ``TABLES`` independent tables a pair at
the threshold 0.93 shares no bucket with a chance of about 3e-6, closer pairs
with less. Vectors of a bucket are compared by exact cosines in double
precision, a pair only in the first table in which it shares a bucket, so each
link counts once.

Equal vectors are merged first, so copies are one vector with a weight. A
large bucket is compared in blocks, each pair of blocks a group of its own. A
block sends on how many links each vector has there and a spanning forest of
the links, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crashlens.llm.graph import components
from crashlens.llm.minhash_dedup import _runs
from crashlens.llm.tables import remove, written
from crashlens.llm.words import U64, _mix

TABLES, PROJECTIONS, WIDTH = 24, 4, 1.5
BLOCK = 512


def _unit(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column of one length, in double precision, scaled to length 1; and their lengths."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(vectors), -1)
    return x, np.sqrt(np.einsum("ij,ij->i", x, x))


def _hash_tables(width: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, width])
    return rng.normal(size=(width, TABLES * PROJECTIONS)), rng.uniform(0, WIDTH, TABLES * PROJECTIONS)


def _codes(x: np.ndarray, seed: int) -> np.ndarray:
    """A hash of each vector's bucket in every table: rows by ``TABLES``."""
    directions, shifts = _hash_tables(x.shape[1], seed)
    cells = np.floor((x @ directions + shifts) / WIDTH).astype(np.int64).view(U64).reshape(len(x), TABLES, PROJECTIONS)
    code = np.tile(np.arange(1, TABLES + 1, dtype=U64), (len(x), 1))
    for i in range(PROJECTIONS):
        code = _mix(code * U64(0x9E3779B97F4A7C15) + cells[:, :, i])
    return code.view(np.int64)


def _forest(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Positions of the links that a spanning forest keeps."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    keep = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
            keep.append(i)
    return keep


def near_duplicates(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", label: str | None = "label",
                    cosine: float = 0.93, seed: int = 11) -> DataFrame:
    """``(key, n_links, component_id, kept)`` for every row of ``vectors``.

    Rows are linked if their labels are equal and not null (``label=None``: all
    rows may link) and their vectors, of one length, have a cosine of at least
    ``cosine``. ``n_links`` counts the other rows linked directly, ``component_id``
    is the smallest id reachable by links, ``kept`` says whether that is the row.

    Vectors that are null, empty, zero, or hold null or non-finite numbers link
    with nothing, nor do rows with a null label. Equal vectors are linked like
    others, repeated rows too. A row with a null id is linked and counted, gets
    the smallest id of its component, and is kept if there is none. Other
    columns are not read.
    """
    value = F.col(vector).cast("array<double>")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(finite & F.exists(value, lambda x: x != 0), F.lit(False))
    group = F.lit(0).cast("string") if label is None else F.col(label).cast("string")
    rows = vectors.select(F.col(key).alias("_key"), group.alias("_label"), value.alias("_vec"), (usable & group.isNotNull()).alias("_ok"))
    # -0.0 and 0.0 are one number; a class of equal vectors is told by a hash of label and vector.
    exact = F.transform("_vec", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    rows = rows.withColumn("class", F.when(F.col("_ok"), F.xxhash64("_label", exact)))
    rows = written(rows.drop("_ok"), "vectors")
    classes = rows.where("class is not null").groupBy("class").agg(
        F.count(F.lit(1)).alias("weight"), F.min(F.struct("_label", "_vec")).alias("v"))
    classes = written(classes.select("class", "weight", "v.*", F.size("v._vec").alias("width")), "vector-classes")

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column("width").to_numpy()
            for width in np.unique(widths):
                part = batch.filter(pa.array(widths == width))
                x, norms = _unit(part.column("_vec"))
                codes = _codes(x / norms[:, None], seed)
                columns = [part.column(c) for c in ("class", "weight", "_label", "width")]
                lists = pa.FixedSizeListArray.from_arrays(pa.array(codes.reshape(-1)), TABLES).cast(pa.list_(pa.int64()))
                raw = [pa.array([row.tobytes() for row in table], pa.binary()) for table in (codes, x)]
                yield pa.RecordBatch.from_arrays([*columns, lists, *raw], ["class", "weight", "_label", "width", "codes", "_codes", "_vec"])

    projected = written(classes.mapInArrow(project, "class long, weight long, _label string, width int, codes array<long>, _codes binary, _vec binary"), "vector-codes")
    buckets = ["_label", "width", "table", "code"]
    placed = projected.select("_label", "width", F.posexplode("codes").alias("table", "code"), "class", "weight", "_codes", "_vec")
    sizes = projected.select("_label", "width", F.posexplode("codes").alias("table", "code")).groupBy(*buckets).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    sizes = written(sizes, "bucket-sizes")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    spread = (
        placed.join(sizes, buckets).withColumn("mine", F.pmod(F.hash("class"), blocks))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other"))
        .select(*buckets, "i", "j", "mine", "class", "weight", "_codes", "_vec")
    )
    keys = [*buckets, "i", "j"]

    def group(rows: dict[str, np.ndarray], low: int, high: int) -> tuple[np.ndarray, ...]:
        """Vectors with links, their links, and the ends of a spanning forest, of one pair of blocks."""
        number, who, mine, weight = int(rows["table"][low]), rows["class"][low:high], rows["mine"][low:high], rows["weight"][low:high]
        x = np.frombuffer(b"".join(rows["_vec"][low:high]), dtype=np.float64).reshape(high - low, -1)
        codes = np.frombuffer(b"".join(rows["_codes"][low:high]), dtype=np.int64).reshape(high - low, -1)[:, :number]
        norms = np.sqrt(np.einsum("ij,ij->i", x, x))
        i, j = rows["i"][low], rows["j"][low]
        left = np.flatnonzero(mine == i)
        right = left if i == j else np.flatnonzero(mine == j)
        links, ends_a, ends_b = np.zeros(high - low, dtype=np.int64), [], []
        for at in range(0, len(left), BLOCK):
            own = left[at : at + BLOCK]
            # (x . y) >= c |x| |y| in double precision
            a, b = np.nonzero(x[own] @ x[right].T >= cosine * (norms[own][:, None] * norms[right]))
            a, b = own[a], right[b]
            if i == j:
                a, b = a[a < b], b[a < b]
            if number and len(a):  # not if an earlier table has the pair
                fresh = ~(codes[a] == codes[b]).any(axis=1)
                a, b = a[fresh], b[fresh]
            if len(a):
                np.add.at(links, a, weight[b])
                np.add.at(links, b, weight[a])
                keep = _forest(a, b)
                ends_a.append(who[a[keep]])
                ends_b.append(who[b[keep]])
        some = np.flatnonzero(links)
        none = np.zeros(0, dtype=np.int64)
        return who[some], links[some], np.concatenate([none, *ends_a]), np.concatenate([none, *ends_b])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, keys):
            change = np.zeros(len(rows["class"]), dtype=bool)
            for key in keys:
                change[1:] |= rows[key][1:] != rows[key][:-1]
            edges = [0, *np.flatnonzero(change).tolist(), len(change)]
            found = [group(rows, low, high) for low, high in zip(edges[:-1], edges[1:]) if high - low > 1]
            if found:
                who, links, a, b = (np.concatenate(x) for x in zip(*found))
                other = pa.array(np.concatenate([np.zeros(len(who), np.int64), b]), mask=np.arange(len(who) + len(b)) < len(who))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([who, a])), pa.array(np.concatenate([links, np.zeros(len(a), np.int64)])), other], ["class", "links", "other"])

    compared = spread.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare, "class long, links long, other long")
    found = written(compared, "vector-links")
    parts = components(found.where("other is not null").select(F.col("class").alias("a"), F.col("other").alias("b")))
    counts = written(found.where("links > 0").groupBy("class").agg(F.sum("links").alias("links")), "vector-counts")
    per_class = classes.select("class", "weight").join(counts, "class", "left").join(parts.withColumnRenamed("id", "class"), "class", "left")
    per_class = written(per_class.select("class", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "class").alias("component")), "vector-components")
    members = written(rows.where("class is not null").join(per_class, "class").select("_key", "n_links", "component"), "vector-members")
    least = written(members.groupBy("component").agg(F.min("_key").alias("component_id")), "vector-least")
    remove(classes, projected, sizes, found, counts, per_class)
    grouped = members.join(least, "component").select("_key", "n_links", "component_id")
    alone = rows.where("class is null").select("_key", F.lit(0).cast("long").alias("n_links"), F.col("_key").alias("component_id"))
    return grouped.unionByName(alone).select(
        F.col("_key").alias(key), "n_links", "component_id",
        F.coalesce(F.col("_key") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"),
    )
