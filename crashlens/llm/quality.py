"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words, all of it, however long.
Each passage is described by shares of character and word kinds, encoded by
one hidden layer, and weighted by gated attention; the weighted mean of the
encoded passages is what the document's score is computed from. Only documents
carry labels: the attention learns by itself which passages decide.

Training takes a bounded sample of the labelled documents, drawn by a hash of
id and text, whose passage features, not texts, come to the driver. Scoring is one pass over the documents without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crashlens.llm.sampling import labelled
from crashlens.llm.tables import remove
from crashlens.llm.words import WHITE_SPACE, raw_bytes, slices, split_words

PASSAGE = 64  # words
SAMPLE = 6000  # labelled documents that train the model
HIDDEN, GATE = 16, 8

_KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "stop": b".,;:?", "shout": b"!", "bar": b"|",
    "symbol": b"#$%&*+<=>@\\^_`{}~", "path": b"/", "quote": b"\"'()[]-", "line": b"\n", "high": bytes(range(128, 256)),
}
_FLAGS = np.stack([np.isin(np.arange(256, dtype=np.uint8), np.frombuffer(x, dtype=np.uint8)) for x in _KINDS.values()]).astype(np.int64)
FEATURES = len(_KINDS) + 11


class Model(NamedTuple):
    """Weights of the network; ``mean`` and ``scale`` bring features to a common scale."""

    mean: np.ndarray
    scale: np.ndarray
    enc_w: np.ndarray
    enc_b: np.ndarray
    att_v: np.ndarray
    att_u: np.ndarray
    att_w: np.ndarray
    out_w: np.ndarray
    out_b: np.ndarray


def passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage, and for each text the position of its first passage (texts + 1 numbers).

    A text without words is one empty passage.
    """
    data, offsets = raw_bytes(texts)
    words = split_words(data, offsets, WHITE_SPACE)
    counts = words.counts
    per = np.maximum(1, -(-counts // PASSAGE))
    first = np.concatenate([[0], np.cumsum(per)])
    x = np.zeros((first[-1], FEATURES))
    n = len(words.hash)
    if not n:
        return x, first
    own = words.text
    passage = first[own] + (np.arange(n) - words.first[own]) // PASSAGE
    starts = np.flatnonzero(np.diff(passage, prepend=-1))
    which = passage[starts]
    ends = np.append(starts[1:], n)
    low, high = words.start[starts], words.end[ends - 1]
    size = (high - low).astype(float)
    for i, flags in enumerate(_FLAGS):
        sums = np.concatenate([[0], np.cumsum(flags[data])])
        x[which, i] = (sums[high] - sums[low]) / size
    many = (ends - starts).astype(float)
    length = (words.end - words.start).astype(float)
    same = np.zeros((2, n))
    for back in (1, 2):
        same[back - 1, back:] = (words.hash[back:] == words.hash[:-back]) & (own[back:] == own[:-back])
    tail = data[words.end - 1]
    order = np.lexsort((words.hash, passage))
    fresh = np.ones(n)
    fresh[1:] = (words.hash[order][1:] != words.hash[order][:-1]) | (passage[order][1:] != passage[order][:-1])
    rows = np.stack([
        length, length**2, length <= 3, length >= 16, same[0], same[1], _FLAGS[0][data[words.start]],
        (_FLAGS[3] | _FLAGS[4] | _FLAGS[5])[tail], _FLAGS[2][tail],
    ])
    mean = np.add.reduceat(rows, starts, axis=1) / many
    distinct = np.add.reduceat(fresh, starts) / many
    k = len(_KINDS)
    x[which, k : k + 9] = np.concatenate([mean[:1], np.sqrt(np.maximum(mean[1:2] - mean[:1] ** 2, 0)), mean[2:]]).T
    x[which, k + 9] = distinct
    x[which, k + 10] = np.log1p(many)
    return x, first


def _softmax(e: np.ndarray, first: np.ndarray) -> np.ndarray:
    counts = np.diff(first)
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, first[:-1]), counts))
    return e / np.repeat(np.add.reduceat(e, first[:-1]), counts)


def forward(model: Model, x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """Scores of the bags, the attention of their passages, and what the gradient needs."""
    z = np.clip((x - model.mean) / model.scale, -8, 8)
    h = np.tanh(z @ model.enc_w + model.enc_b)
    v, u = np.tanh(h @ model.att_v), 1 / (1 + np.exp(-(h @ model.att_u)))
    a = _softmax((v * u) @ model.att_w, first)
    m = np.add.reduceat(a[:, None] * h, first[:-1], axis=0)
    p = 1 / (1 + np.exp(-(m @ model.out_w + model.out_b)))
    return p, a, z, h, v, u, m


def fit(x: np.ndarray, first: np.ndarray, y: np.ndarray, *, steps: int = 200, rate: float = 0.05, decay: float = 1e-3, seed: int = 7) -> Model:
    """Full-batch Adam on the logistic loss, from a seeded start."""
    rng = np.random.default_rng(seed)
    draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    mean, scale = x.mean(0), x.std(0) + 1e-3
    rest = [draw(FEATURES, HIDDEN), np.zeros(HIDDEN), draw(HIDDEN, GATE), draw(HIDDEN, GATE), draw(GATE), draw(HIDDEN), np.zeros(1)]
    moment, square = [np.zeros_like(w) for w in rest], [np.zeros_like(w) for w in rest]
    counts = np.diff(first)
    for step in range(1, steps + 1):
        model = Model(mean, scale, *rest)
        p, a, z, h, v, u, m = forward(model, x, first)
        d_out = (p - y) / len(y)
        d_m = np.repeat(np.outer(d_out, model.out_w), counts, axis=0)
        d_a = (d_m * h).sum(1)
        d_e = a * (d_a - np.repeat(np.add.reduceat(a * d_a, first[:-1]), counts))
        d_v, d_u = np.outer(d_e, model.att_w) * u * (1 - v**2), np.outer(d_e, model.att_w) * v * u * (1 - u)
        d_h = (a[:, None] * d_m + d_v @ model.att_v.T + d_u @ model.att_u.T) * (1 - h**2)
        grads = [z.T @ d_h, d_h.sum(0), h.T @ d_v, h.T @ d_u, (v * u).T @ d_e, m.T @ d_out, np.array([d_out.sum()])]
        for i, g in enumerate(grads):
            g = g + decay * rest[i] * (rest[i].ndim > 1)
            moment[i] = 0.9 * moment[i] + 0.1 * g
            square[i] = 0.999 * square[i] + 0.001 * g * g
            at = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            rest[i] = rest[i] - at * (moment[i] / (1 - 0.9**step)) / (np.sqrt(square[i] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, *rest)


def held_out(key: str = "doc_id") -> F.Column:
    """Rows that no model learns from: crc32 of the id as text, modulo 5, is 0 (a null id is held out)."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Model:
    """A model of ``label`` (1 or 0) from labelled rows that are not held out.

    See :func:`crashlens.llm.sampling.labelled` for the rows that teach: about
    ``sample`` distinct pairs of id and text, however many rows repeat them; null labels and
    null or very long texts teach nothing. Without any example, or with one
    class only, the model still scores (all alike).
    """
    texts = labelled(docs, labels, held_out(key), key=key, text=text, label=label, sample=sample)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                x, first = passages(part.column("text"))
                raw = [x[a:b].astype(np.float32).tobytes() for a, b in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays([part.column("key").cast(pa.string()), part.column("y"), pa.array(raw, pa.binary())], ["k", "y", "x"])

    rows = sorted(texts.mapInArrow(features, "k string, y int, x binary").collect(), key=lambda r: (r["k"], r["y"], r["x"]))
    remove(texts)
    if not rows:
        return fit(np.zeros((1, FEATURES)), np.array([0, 1]), np.array([0.5]), steps=1)
    bags = [np.frombuffer(r["x"], dtype=np.float32).reshape(-1, FEATURES).astype(float) for r in rows]
    first = np.concatenate([[0], np.cumsum([len(b) for b in bags])])
    return fit(np.concatenate(bags), first, np.array([r["y"] for r in rows], dtype=float))


def score(docs: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs``, then ``score`` (0 to 1), ``n_passages`` and ``top_passage``.

    ``top_passage`` is the number (from 0) of the passage with the most
    attention, the first of equals. Null and empty texts are scored as one
    empty passage. Existing columns of these names are replaced.
    """
    kept = docs.drop("score", "n_passages", "top_passage")
    names = [c for c in kept.columns]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                x, first = passages(part.column(text))
                p, a, *_ = forward(model, x, first)
                most = np.repeat(np.maximum.reduceat(a, first[:-1]), np.diff(first))
                top = np.minimum.reduceat(np.where(a == most, np.arange(len(a)), len(a)), first[:-1]) - first[:-1]
                more = [pa.array(p), pa.array(np.diff(first), pa.int64()), pa.array(top, pa.int64())]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), *more], [*names, "score", "n_passages", "top_passage"])

    schema = T.StructType(kept.schema.fields[:]).add("score", "double").add("n_passages", "long").add("top_passage", "long")
    return kept.mapInArrow(make, schema)
