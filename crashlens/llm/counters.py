"""A fixed number of counters or flags over all rows of a table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crashlens.llm.words import U64, shrink

_SLICES = 64


def _pack(x: np.ndarray) -> bytes:
    """Counts in the narrowest unsigned type that holds them; the first byte is its size."""
    top = int(x.max(initial=0))
    size = next(s for s in (1, 2, 4, 8) if top < 1 << 8 * s)
    return bytes([size]) + x.astype(f"u{size}").tobytes()


def _unpack(x: bytes) -> np.ndarray:
    return np.frombuffer(x, dtype=f"u{x[0]}", offset=1).astype(np.int64)


def summed_counters(df: DataFrame, size: int, count: Callable[[pa.RecordBatch, np.ndarray], None]) -> np.ndarray:
    """``size`` counters, added up over all rows: ``count(batch, counters)`` adds a batch's share.

    Every task keeps one array of counters; slices of them are added up on the
    executors, and the driver gets ``size`` numbers, however long the table is.
    """
    width = -(-size // _SLICES)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(width * _SLICES, dtype=np.int64)
        for batch in batches:
            count(batch, own[:size])
        parts = own.reshape(_SLICES, width)
        keep = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keep, pa.int32()), pa.array([_pack(parts[i]) for i in keep], pa.binary())], ["slice", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(width, dtype=np.int64)
        for x in table.column("counts"):
            total += _unpack(x.as_py())
        return pa.table({"slice": table.column("slice").slice(0, 1).cast(pa.int32()), "counts": pa.array([_pack(total)], pa.binary())})

    schema = "slice int, counts binary"
    total = np.zeros((_SLICES, width), dtype=np.int64)
    for row in df.mapInArrow(tasks, schema).groupBy("slice").applyInArrow(add, schema).collect():  # _SLICES rows at most
        total[row["slice"]] = _unpack(bytes(row["counts"]))
    return total.reshape(-1)[:size]


def marked_flags(df: DataFrame, bits: int, mark: Callable[[pa.RecordBatch, np.ndarray], None]) -> np.ndarray:
    """``2**bits`` flags over all rows: ``mark(batch, flags)`` sets those of a batch.

    A task sends its flags as ``_SLICES`` bitmaps at most, which are put together on the executors.
    """
    width = (1 << bits) // _SLICES

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(1 << bits, dtype=bool)
        for batch in batches:
            mark(batch, own)
        parts = own.reshape(_SLICES, width)
        keep = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(keep, pa.int32()), pa.array([np.packbits(parts[i]).tobytes() for i in keep], pa.binary())], ["slice", "flags"])

    def unite(table: pa.Table) -> pa.Table:
        both = np.bitwise_or.reduce([np.frombuffer(x.as_py(), dtype=np.uint8) for x in table.column("flags")])
        return pa.table({"slice": table.column("slice").slice(0, 1).cast(pa.int32()), "flags": pa.array([both.tobytes()], pa.binary())})

    schema = "slice int, flags binary"
    out = np.zeros((_SLICES, width), dtype=bool)
    for row in df.mapInArrow(tasks, schema).groupBy("slice").applyInArrow(unite, schema).collect():  # _SLICES rows at most
        out[row["slice"]] = np.unpackbits(np.frombuffer(bytes(row["flags"]), dtype=np.uint8), count=width)
    return out.reshape(-1)


def hash_flags(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """``2**bits`` flags: those of the top bits of the 64-bit hashes in ``column`` are set."""
    value = F.shiftrightunsigned(column, 64 - bits)
    rows = df.groupBy(F.bitmap_bucket_number(value).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("flags"))
    out = np.zeros(1 << bits, dtype=bool)
    for row in rows.collect():  # one row for each 32768 flags
        flags = np.unpackbits(np.frombuffer(bytes(row["flags"]), dtype=np.uint8), bitorder="little")
        # Bucket b holds the values from 32768 (b - 1) + 1 on; value 0 has bucket 0 for itself.
        values = np.flatnonzero(flags) + (row["bucket"] - 1) * len(flags) + 1 if row["bucket"] else np.zeros(1, dtype=np.int64)
        out[values[values < len(out)]] = True
    return out


def flagged(df: DataFrame, column: str, wanted: DataFrame, hashes: str, bits: int = 23) -> DataFrame:
    """The rows of ``df`` whose 64-bit hash in ``column`` may be among ``hashes`` of ``wanted``: all that are, few others."""
    flags = np.packbits(hash_flags(wanted, hashes, bits), bitorder="little")

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = shrink(batch.column(column).to_numpy().view(U64), bits)
            yield batch.filter(pa.array((flags[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1))

    return df.mapInArrow(chosen, df.schema)
