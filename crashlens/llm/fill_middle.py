"""Fill-in-the-middle: documents cut at two code points and put together in another order.

Cuts are counted in code points, texts lie in memory as UTF-8 bytes, and a cut
must be turned into a byte offset. A slice of texts gets a learned rank index:
the offset of every code point boundary as a function of its rank is covered by
straight segments that miss no boundary by more than ``ERROR`` bytes, found
greedily by a shrinking cone of slopes; what a segment still misses at each
boundary is stored in one byte. A cut is predicted by its segment and corrected
by the stored residual, which gives the exact offset without a walk over the
text. ASCII is one segment, and mixed scripts need one where the mean width of
characters changes.

Boundaries are found block by block, twice (to fit, and to store residuals),
so the index of a very long text needs one byte for each code point.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crashlens.llm.words import raw_bytes, slices

ERROR = 120  # bytes; residuals are stored in one signed byte
BLOCK = 1 << 20  # bytes whose boundaries are held at once
_WINDOW = 512  # boundaries tried first for a new segment
# The marks of a transformed text.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


class RankIndex(NamedTuple):
    """Byte offsets by code point rank: segments (first rank, offset there, slope) and the residual of each rank."""

    anchor: np.ndarray
    base: np.ndarray
    slope: np.ndarray
    residual: np.ndarray

    def predicted(self, ranks: np.ndarray) -> np.ndarray:
        own = np.searchsorted(self.anchor, ranks, side="right") - 1
        return self.base[own] + np.floor(self.slope[own] * (ranks - self.anchor[own])).astype(np.int64)

    def offsets(self, ranks: np.ndarray) -> np.ndarray:
        """The exact byte offset of each rank."""
        return self.predicted(ranks) + self.residual[ranks]


def boundaries(data: np.ndarray, block: int = BLOCK) -> Iterator[tuple[int, np.ndarray]]:
    """``(first rank, byte offsets)`` of the code point boundaries of each block; the end of the data is the last one."""
    rank = 0
    for low in range(0, len(data), block):
        at = np.flatnonzero((data[low : low + block] & 0xC0) != 0x80) + low
        yield rank, at
        rank += len(at)
    yield rank, np.array([len(data)], dtype=np.int64)


def fit(data: np.ndarray, error: int = ERROR, block: int = BLOCK) -> RankIndex:
    """The rank index of UTF-8 bytes; ``error`` is at most 126."""
    anchors, bases, slopes = [], [], []
    low, high, size, total = -np.inf, np.inf, _WINDOW, 0
    for rank, offsets in boundaries(data, block):
        total = rank + len(offsets)
        at = 0
        while at < len(offsets):
            if not anchors or low > high:  # a segment starts at this boundary
                anchors.append(rank + at)
                bases.append(int(offsets[at]))
                slopes.append(1.0)
                low, high, at = -np.inf, np.inf, at + 1
                continue
            some = offsets[at : at + size]
            run = rank + at + np.arange(len(some)) - anchors[-1]
            rise = some - bases[-1]
            lows = np.maximum(np.maximum.accumulate((rise - error) / run), low)
            highs = np.minimum(np.minimum.accumulate((rise + error) / run), high)
            bad = np.flatnonzero(lows > highs)
            if len(bad):
                at += int(bad[0])
                if bad[0]:
                    slopes[-1] = (lows[bad[0] - 1] + highs[bad[0] - 1]) / 2
                low, high, size = np.inf, -np.inf, _WINDOW
            else:
                at += len(some)
                low, high = lows[-1], highs[-1]
                slopes[-1] = (low + high) / 2
                size = min(2 * size, block)
    index = RankIndex(np.array(anchors), np.array(bases), np.array(slopes), np.zeros(total, dtype=np.int8))
    for rank, offsets in boundaries(data, block):
        ranks = np.arange(rank, rank + len(offsets))
        index.residual[rank : rank + len(offsets)] = offsets - index.predicted(ranks)
    return index


def _starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The rank of the boundary at each of the sorted byte ``offsets`` (starts and ends of texts)."""
    out = np.zeros(len(offsets), dtype=np.int64)
    for rank, at in boundaries(data):
        if len(at):
            low, high = np.searchsorted(offsets, (at[0], at[-1] + 1))
            out[low:high] = rank + np.searchsorted(at, offsets[low:high])
    return out


def _numbers(seed: str, key: object) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]


def transform(docs: DataFrame, *, key: str = "doc_id", text: str = "text", seed: str = "1", percent: int = 90, spm: int = 20) -> DataFrame:
    """All columns of ``docs``, then ``n``, ``form``, ``prefix_chars``, ``middle_chars`` (long) and ``output``.

    Four numbers from the sha256 of ``seed:key`` decide: two cuts (modulo one
    more than the code points), whether the text is transformed at all
    (``percent`` in a hundred are), and whether the suffix comes first (``spm``
    in a hundred of those). ``form`` is ``plain`` (output is the text; both
    lengths are null), ``psm`` or ``spm``. Texts that hold a mark stay plain,
    since they could not be restored; so do empty ones. A null text counts as
    empty, a null key as an empty one. Rows are judged each by itself: equal
    rows give equal outputs. Existing columns of the new names are replaced,
    all others stay, whatever they are called.
    """
    new = ("n", "form", "prefix_chars", "middle_chars", "output")
    kept = docs.drop(*(c for c in new if c not in (key, text)))
    names = kept.columns
    prefix, suffix, middle = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                data, edges = raw_bytes(part.column(text))
                whole = data.tobytes()
                rank = _starts(data, edges)
                n = np.diff(rank)
                drawn = np.array([_numbers(seed, k) for k in part.column(key).to_pylist()], dtype=np.int64).reshape(-1, 4)
                cuts = np.sort(drawn[:, :2] % (n + 1)[:, None], axis=1)
                index = fit(data)
                first, second = (index.offsets(rank[:-1] + cuts[:, i]).tolist() for i in (0, 1))
                forms, out = [], []
                for i, (a, b, c, d) in enumerate(zip(edges[:-1].tolist(), first, second, edges[1:].tolist())):
                    own = whole[a:d]
                    if a == d or drawn[i, 2] % 100 >= percent or prefix in own or suffix in own or middle in own:
                        forms.append("plain")
                        out.append(own)
                    elif drawn[i, 3] % 100 < spm:
                        forms.append("spm")
                        out.append(b"".join((suffix, whole[c:d], prefix, whole[a:b], middle, whole[b:c])))
                    else:
                        forms.append("psm")
                        out.append(b"".join((prefix, whole[a:b], suffix, whole[c:d], middle, whole[b:c])))
                plain = np.array([f == "plain" for f in forms], dtype=bool)
                more = [pa.array(n.astype(np.int64)), pa.array(forms, pa.string()), pa.array(cuts[:, 0], mask=plain),
                        pa.array(cuts[:, 1] - cuts[:, 0], mask=plain), pa.array(out, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), *more], [*names, *new])

    schema = T.StructType(kept.schema.fields[:])
    for name, kind in zip(new, ("long", "string", "long", "long", "string")):
        schema = schema.add(name, kind)
    return kept.mapInArrow(make, schema)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that ``output`` was made from; its parts hold no mark, and no two marks can overlap."""
    out, kind = F.col(output), F.col(form)
    s, m, p = (F.locate(mark, out) for mark in (SUFFIX, MIDDLE, PREFIX))

    def between(after: Column | int, before: Column) -> Column:
        return F.substring(out, F.lit(after) + 3, before - F.lit(after) - 3)

    end = F.length(out) + 1
    return (
        F.when(kind == "psm", F.concat(between(1, s), between(m, end), between(s, m)))
        .when(kind == "spm", F.concat(between(p, m), between(m, end), between(1, p)))
        .otherwise(out)
    )
