"""Toxicity by a convolutional text classifier over hashed word embeddings.

A word's embedding is the mean of the vectors of its hash and of the hashes of
its prefixes, so that forms of one stem that training never saw have a place.
Filters of several widths slide over a document's words; each filter's
largest response over the whole document, however long, is what a logistic
layer scores. It is trained in numpy on labelled documents, and the score at
which a document counts as toxic is calibrated for each language on labelled
documents kept aside: the language is told from the text by rank-order
profiles, and its threshold is shifted to a score of 0.5.

Training takes every labelled document, whole. Their hashed words are written
once, dealt to shards of about ``SHARD`` documents; in each round every shard
goes on from the same weights by itself, in its task, and the means of weights
and moments, weighted by documents, are what the next round starts from. Only
such means come to the driver. Scoring is one pass over the documents without
a shuffle: the product of every embedding with every filter column is taken
once for each distinct word of a slice of text.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crashlens.llm import language_id
from crashlens.llm.sampling import labelled
from crashlens.llm.tables import remove, written
from crashlens.llm.words import NOT_ALNUM, U64, raw_bytes, slices, split_words

SHARD = 16_384  # labelled documents that one task trains on between two means, about
HELD_BYTES = 1 << 25  # packed documents that a task holds at once; a shard with more is met in parts
PLACES = 1 << 17  # words of a batch, unless one document alone has more
MET_AT_ONCE = 8  # states whose mean one step takes
STEPS_PER_LOGIT = 256  # thresholds are found among counts of logits rounded to so many steps
ASIDE = 4  # one in so many of these calibrates the thresholds
NEAR = 0.03  # error rates that differ by less are told apart by the width of the gap, so a mislabelled document does not decide
BITS = 15  # logarithm of the hashed vectors; their numbers are sent in 16 bits
DIM, FILTERS, WIDTHS = 12, 12, (1, 2, 3)
PREFIXES = (4, 5, 6, 7, 8)  # bytes
_NONE = 1 << BITS  # the vector of what is not there: zeros
_PAD = max(WIDTHS)  # places without a word behind each text; a filter is placed on the first of them at most


class Model(NamedTuple):
    """Weights, the languages' profiles, and the logit that counts as toxic: of each language, and at last of any other."""

    vectors: np.ndarray  # (2 ** BITS + 1, DIM)
    filters: list[np.ndarray]  # for each width (width, DIM, FILTERS)
    bias: np.ndarray  # (widths * FILTERS)
    out_w: np.ndarray
    out_b: float
    profiles: language_id.Profiles
    thresholds: np.ndarray


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return (x ^ (x >> U64(33))) >> U64(64 - BITS)


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(parts, word, first)``: the vectors of each distinct word, the distinct word at each place, and the first place of each text.

    ``parts`` has a row of vector numbers for every distinct word, the last one
    for no word; ``first`` has one number more than there are texts. Every
    text ends with ``_PAD`` places without a word.
    """
    words = split_words(*raw_bytes(texts), NOT_ALNUM, lower=True)
    _, one, which = np.unique(words.hash, return_index=True, return_inverse=True)
    start, length = words.start[one], words.end[one] - words.start[one]
    parts = np.full((len(one) + 1, 1 + len(PREFIXES)), _NONE, dtype=np.uint16)
    parts[:-1, 0] = _spread(words.hash[one])
    head = np.zeros(len(one), dtype=U64)
    data = np.append(words.data, np.zeros(max(PREFIXES), dtype=np.uint8))
    for i in range(max(PREFIXES)):
        head |= data[start + i].astype(U64) << U64(8 * i)
        if i + 1 in PREFIXES:
            longer = length > i + 1
            parts[:-1, 1 + PREFIXES.index(i + 1)][longer] = _spread(head[longer] * U64(2 * i + 3))
    counts = words.counts
    first = np.concatenate([[0], np.cumsum(counts + _PAD)])
    word = np.full(int(first[-1]), len(one), dtype=np.int32)
    word[np.arange(len(which)) + _PAD * words.text] = which
    return parts, word, first


def _size(parts: np.ndarray) -> np.ndarray:
    """How many vectors each word has, as a column (a short word has few, which count the more)."""
    return np.maximum((parts != _NONE).sum(axis=1, keepdims=True), 1).astype(np.float32)


def _embedded(vectors: np.ndarray, parts: np.ndarray) -> np.ndarray:
    out = vectors.take(parts[:, 0], axis=0)
    for i in range(1, parts.shape[1]):
        out += vectors.take(parts[:, i], axis=0)
    out /= _size(parts)
    return out


def _responses(filters: list[np.ndarray], embedded: np.ndarray, word: np.ndarray) -> Iterator[np.ndarray]:
    """For each width the response of its filters at each place; those of a text's last ``_PAD - 1`` places are of no use."""
    for f in filters:
        out = (embedded @ f[0]).take(word, axis=0)
        for offset in range(1, len(f)):
            out[:-offset] += (embedded @ f[offset]).take(word[offset:], axis=0)
        yield out


def _pooled(filters: list[np.ndarray], embedded: np.ndarray, word: np.ndarray, first: np.ndarray) -> np.ndarray:
    spans = np.stack([first[:-1], first[1:] - _PAD + 1], axis=1).ravel()
    return np.concatenate([np.maximum.reduceat(r, spans, axis=0)[::2] for r in _responses(filters, embedded, word)], axis=1)


def logits(model: Model, texts: pa.Array) -> np.ndarray:
    """What the logistic layer makes of each text, before calibration."""
    if not len(texts):
        return np.zeros(0)
    parts, word, first = hashed_words(texts)
    pooled = _pooled(model.filters, _embedded(model.vectors, parts), word, first)
    return np.tanh(np.maximum(pooled + model.bias, 0)) @ model.out_w + model.out_b


class State(NamedTuple):
    """Where training stands: weights (vectors, filters, biases, output layer), their moments, and the steps taken."""

    weights: list[np.ndarray]
    means: list[np.ndarray]
    squares: list[np.ndarray]
    step: float

    def packed(self) -> bytes:
        return np.concatenate([w.ravel() for some in self[:3] for w in some]).tobytes()


def _shapes() -> list[tuple[int, ...]]:
    n_out = len(WIDTHS) * FILTERS
    return [(_NONE + 1, DIM), *((w, DIM, FILTERS) for w in WIDTHS), (n_out,), (n_out,), (1,)]


def _unpacked(raw: np.ndarray, step: float) -> State:
    shapes = _shapes() * 3
    cuts = np.cumsum([0, *(int(np.prod(x)) for x in shapes)])
    arrays = [raw[a:b].reshape(x).astype(np.float32) for a, b, x in zip(cuts[:-1], cuts[1:], shapes)]
    n = len(shapes) // 3
    return State(arrays[:n], arrays[n : 2 * n], arrays[2 * n :], step)


def _start(rng: np.random.Generator) -> State:
    vectors = rng.normal(0, 0.3, (_NONE + 1, DIM)).astype(np.float32)
    vectors[_NONE] = 0
    filters = [rng.normal(0, 0.5 / np.sqrt(w), (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    n_out = len(WIDTHS) * FILTERS
    weights = [vectors, *filters, np.zeros(n_out, np.float32), rng.normal(0, 0.3, n_out).astype(np.float32), np.zeros(1, np.float32)]
    return State(weights, [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0)


def _batches(docs: list[tuple[np.ndarray, np.ndarray]], order: np.ndarray, batch: int) -> Iterator[np.ndarray]:
    """``order`` in runs of ``batch`` documents, or of fewer with ``PLACES`` words."""
    low = places = 0
    for i, doc in enumerate(order):
        size = len(docs[doc][1])
        if i > low and (i - low == batch or places + size > PLACES):
            yield order[low:i]
            low, places = i, 0
        places += size
    if low < len(order):
        yield order[low:]


def _met(state: State, docs: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, rng: np.random.Generator, share: float, begin: float, end: float, *,
         batch: int = 64, rate: float = 0.02, decay: float = 3e-4, dropped: float = 0.4) -> State:
    """The state after all of ``docs`` were met once, while training as a whole goes from ``begin`` to ``end`` (0 to 1).

    ``docs`` are ``(parts, word)`` of single documents, ``share`` that of toxic
    ones among all. A filter's gradient goes to the place of its largest
    response. Each time a document is met, a share ``dropped`` of its distinct
    words is left out, so that it cannot be told by one of them alone and the
    others are learned too.
    """
    weights, means, squares = ([w.copy() for w in some] for some in state[:3])
    step, seen_docs = state.step, 0
    spare = [(np.empty_like(w), np.empty_like(w)) for w in weights]
    for some in _batches(docs, rng.permutation(len(docs)), batch):
        step += 1
        seen_docs += len(some)
        vectors, filters, (bias, out_w, out_b) = weights[0], weights[1:-3], weights[-3:]
        parts = np.concatenate([docs[i][0] for i in some])
        shift = np.cumsum([0, *(len(docs[i][0]) for i in some)])
        word = np.concatenate([docs[i][1] + s for i, s in zip(some, shift)])
        first = np.cumsum([0, *(len(docs[i][1]) for i in some)])
        embedded = _embedded(vectors, parts)
        gone = rng.random(len(parts)) < dropped
        embedded[gone] = 0
        best, tops = [], []
        for r in _responses(filters, embedded, word):
            at = np.stack([r[a : b - _PAD + 1].argmax(axis=0) + a for a, b in zip(first[:-1], first[1:])])
            best.append(at)
            tops.append(np.take_along_axis(r, at, axis=0))
        z = np.concatenate(tops, axis=1) + bias
        a = np.tanh(np.maximum(z, 0))
        p = 1 / (1 + np.exp(-(a @ out_w + out_b)))
        own = y[some]
        d = (p - own) * np.where(own == 1, 0.5 / share, 0.5 / (1 - share)) / len(some)
        dz = np.outer(d, out_w) * (1 - a**2) * (z > 0)
        d_embedded = np.zeros_like(embedded)
        reached = np.zeros(len(parts), dtype=bool)
        d_filters = []
        for i, f in enumerate(filters):
            g = dz[:, i * FILTERS : (i + 1) * FILTERS]
            df = np.zeros_like(f)
            for offset in range(len(f)):
                seen = word[best[i] + offset]
                reached[seen] = True
                df[offset] = np.einsum("bf,bfd->df", g, embedded[seen])
                np.add.at(d_embedded, seen, g[:, :, None] * f[offset].T[None])
            d_filters.append(df)
        touched = np.flatnonzero(reached & ~gone)
        touched = touched[d_embedded[touched].any(axis=1)]
        d_vectors = np.zeros_like(vectors)
        # One flat index for each number: numpy adds those up several times faster than rows.
        of = parts[touched].astype(np.intp)
        flat = (of[:, :, None] * DIM + np.arange(DIM)).ravel()
        np.add.at(d_vectors.reshape(-1), flat, np.repeat(d_embedded[touched] / _size(of), of.shape[1], axis=0).ravel())
        grads = [d_vectors, *d_filters, dz.sum(0), a.T @ d, np.array([d.sum()])]
        now = rate * min(1.0, 2 * (1 - min(1.0, begin + (end - begin) * seen_docs / len(docs)) * 0.999))
        for w, g, m, s, (t, u) in zip(weights, grads, means, squares, spare):
            # In place, as the vectors are many: g + decay w, the moments' moves, and their quotient.
            g = g.astype(np.float32, copy=False)
            g += np.multiply(w, decay, out=t)
            np.subtract(g, m, out=t)
            t *= 0.1
            m += t
            np.multiply(g, g, out=t)
            t -= s
            t *= 0.001
            s += t
            np.divide(m, 1 - 0.9**step, out=t)
            t *= now
            np.divide(s, 1 - 0.999**step, out=u)
            np.sqrt(u, out=u)
            u += 1e-7
            t /= u
            w -= t
        weights[0][_NONE] = 0
    return State(weights, means, squares, step)


def _share(positive: float, n: float) -> float:
    return min(max(positive / max(n, 1), 1e-3), 1 - 1e-3)


def _layers(state: State) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray, float]:
    weights = state.weights
    return weights[0], weights[1:-3], weights[-3], weights[-2], float(weights[-1][0])


def fit(docs: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, *, epochs: int = 12, seed: int = 3,
        **how: float) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray, float]:
    """Vectors, filters, biases and output layer: Adam on the logistic loss of batches, both classes weighing alike; see :func:`_met`."""
    rng = np.random.default_rng(seed)
    state, share = _start(rng), _share(float(np.sum(y)), len(y))
    for epoch in range(epochs):
        state = _met(state, docs, y, rng, share, epoch / epochs, (epoch + 1) / epochs, **how)
    return _layers(state)


def held_out(key: str = "doc_id") -> F.Column:
    """Rows that no model learns from: crc32 of the id as text, modulo 5, is 0 (a null id is held out)."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(True))


def _rates(z: np.ndarray, y: np.ndarray, n: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of toxic documents missed and of others caught if logits above each of ``at`` count as toxic; ``n`` documents have each logit."""
    below = []
    for label in (1, 0):
        order = np.argsort(z[y == label])
        upto = np.concatenate([[0], np.cumsum(n[y == label][order])])
        below.append(upto[np.searchsorted(z[y == label][order], at, side="right")] / max(upto[-1], 1))
    return below[0], 1 - below[1]


def threshold(z: np.ndarray, y: np.ndarray, own: np.ndarray | None = None, least: int = 20, n: np.ndarray | None = None) -> float | None:
    """The logit that parts the classes with the smallest sum of both error rates; None without both classes.

    Of logits within ``NEAR`` of the smallest sum the middle of the widest gap
    is taken. Where ``own`` flags the rows of a language, each of its rates counts
    by its examples against ``least`` of all rows, so a language with few
    examples of a class keeps near what holds for all. A row stands for ``n``
    documents (one, if not given).
    """
    if not (y == 1).any() or not (y == 0).any():
        return None
    values = np.unique(z)
    low, high = np.concatenate([values[:1] - 1, values]), np.concatenate([values, values[-1:] + 1])
    error = np.zeros(len(low))
    own = np.zeros(len(z), dtype=bool) if own is None else own
    n = np.ones(len(z)) if n is None else n
    for label, every, mine in zip((1, 0), _rates(z, y, n, low), _rates(z[own], y[own], n[own], low)):
        size = n[own & (y == label)].sum()
        error += (size * mine + least * every) / (size + least)
    near = error <= error.min() + NEAR
    edges = np.flatnonzero(np.diff(near.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)  # runs of such logits
    first, last = max(edges.tolist(), key=lambda e: high[e[1] - 1] - low[e[0]])
    return float(low[first] + high[last - 1]) / 2


def train(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic", lang: str | None = "lang",
          epochs: int = 12, shard: int = SHARD) -> Model:
    """A model of ``label`` (1 or 0) from all labelled rows that are not held out.

    See :func:`crashlens.llm.sampling.labelled` for the rows that teach: every
    distinct pair of id and text, whole. One in ``ASIDE`` of them calibrates the
    thresholds: by language, told from the text by profiles learned from the
    ``lang`` of all rows that are not held out (a language with few examples
    keeps near the threshold of all). Without examples of both classes every
    document gets the same score, below 0.5.
    """
    rows = labelled(docs, labels, held_out(key), key=key, text=text, label=label, sample=None, longest=None)
    aside = F.pmod(F.xxhash64(F.lit("aside"), "key", "hash"), F.lit(ASIDE)) == 0
    none = language_id.Profiles([], [], np.zeros((0, 0), dtype=np.int32))
    profiles = language_id.learn(docs.where(~held_out(key)), key=key, text=text, lang=lang, sample=None) if lang else none
    model = _fitted(rows.where(~aside), profiles, epochs, shard)
    if model.out_w.any():
        _calibrate(model, rows.where(aside))
    remove(rows)
    return model


def _opened(x: bytes) -> tuple[np.ndarray, np.ndarray]:
    x = zlib.decompress(x)
    width = 1 + len(PREFIXES)
    cut = 4 + int(np.frombuffer(x, np.int32, 1)[0]) * width * 2
    return np.frombuffer(x[4:cut], np.uint16).reshape(-1, width), np.frombuffer(x[cut:], np.int32)


def _fitted(rows: DataFrame, profiles: language_id.Profiles, epochs: int, shard: int) -> Model:
    """A model of the ``y`` of ``rows``, trained on the executors; thresholds are still 0."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                raw = []
                for one in part.column("text"):
                    parts, word, _ = hashed_words(pa.array([one.as_py()], pa.string()))
                    raw.append(zlib.compress(np.int32(len(parts)).tobytes() + parts.tobytes() + word.astype(np.int32).tobytes(), 1))
                yield pa.RecordBatch.from_arrays([part.column("shard"), part.column("hash"), part.column("key").cast(pa.string()), part.column("y"), pa.array(raw, pa.binary())], ["shard", "h", "k", "y", "x"])

    n, positive = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    n_out, thresholds = len(WIDTHS) * FILTERS, np.zeros(len(profiles.languages) + 1)
    if not 0 < positive < n:
        nothing = [np.zeros((w, DIM, FILTERS), np.float32) for w in WIDTHS]
        return Model(np.zeros((_NONE + 1, DIM), np.float32), nothing, np.zeros(n_out, np.float32), np.zeros(n_out, np.float32), 0.0, profiles, thresholds + 1)
    shards, share = -(-n // shard), _share(positive, n)
    of = F.pmod(F.xxhash64(F.lit("shard"), "hash", "key"), F.lit(shards)).alias("shard")
    dealt = rows.select(of, "hash", "key", "y", "text").mapInArrow(features, "shard long, h long, k string, y int, x binary")
    packed = written(dealt.repartition(shards, "shard").sortWithinPartitions("shard", "h", "k", "y"), "toxicity-words")

    rounds, rng = (epochs, 1)[shards == 1], np.random.default_rng(3)
    state = _start(rng)
    for i in range(rounds):
        state = _round(packed, state, rng, share, i, rounds, epochs // rounds, n / shards, shards)
    remove(packed)
    return Model(*_layers(state), profiles, thresholds)


def _round(packed: DataFrame, state: State, rng: np.random.Generator, share: float, i: int, rounds: int, passes: int, expected: float, shards: int) -> State:
    """The mean of the states that the shards reach from ``state``, each meeting its documents ``passes`` times."""
    size = sum(int(np.prod(x)) for x in _shapes()) * 3

    def trained(shard: int, parts: Iterator[list[tuple]]) -> tuple[int, int, float, bytes]:
        own, drawn, met = state, rng if shards == 1 else np.random.default_rng([3, i, shard]), 0
        for rows in parts:
            docs, y = [_opened(r[1]) for r in rows], np.array([r[0] for r in rows], dtype=float)
            for p in range(passes):
                done = min(1.0, met / expected) if passes == 1 else p / passes
                more = min(1.0, (met + len(rows)) / expected) if passes == 1 else (p + 1) / passes
                own = _met(own, docs, y, drawn, share, (i + done) / rounds, (i + more) / rounds)
            met += len(rows)
        return shard, met, own.step, own.packed()

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in ("shard", "y", "x"))))
        for shard, own in itertools.groupby(rows, key=lambda r: r[0]):
            yield _state_rows([trained(shard, _held(r[1:] for r in own))])

    def mean(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_state_rows([_mean(table.to_pylist(), size)])])

    states = packed.mapInArrow(learn, _STATES)
    while shards > MET_AT_ONCE:
        states = states.withColumn("shard", F.floor(F.col("shard") / MET_AT_ONCE)).groupBy("shard").applyInArrow(mean, _STATES)
        shards = -(-shards // MET_AT_ONCE)
    _, _, step, raw = _mean([r.asDict() for r in states.collect()], size)  # a few states
    return _unpacked(np.frombuffer(raw, np.float32), step)


_STATES = "shard long, n long, step double, raw binary"


def _state_rows(rows: list[tuple[int, int, float, bytes]]) -> pa.RecordBatch:
    columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), (pa.int64(), pa.int64(), pa.float64(), pa.binary()))]
    return pa.RecordBatch.from_arrays(columns, ["shard", "n", "step", "raw"])


def _mean(states: list[dict], size: int) -> tuple[int, int, float, bytes]:
    """The mean of packed states, weighted by the documents they met."""
    total, n, step = np.zeros(size), 0, 0.0
    for s in sorted(states, key=lambda s: (s["shard"], s["n"], bytes(s["raw"]))):
        total += np.frombuffer(s["raw"], np.float32) * float(s["n"])
        n, step = n + s["n"], step + s["step"] * s["n"]
    return states[0]["shard"], n, step / n, (total / n).astype(np.float32).tobytes()


def _held(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """``(y, x)`` in runs of about ``HELD_BYTES``."""
    own, held = [], 0
    for row in rows:
        own.append(row)
        held += len(row[1])
        if held >= HELD_BYTES:
            yield own
            own, held = [], 0
    if own:
        yield own


def _calibrate(model: Model, rows: DataFrame) -> None:
    """Sets the thresholds by the logits of labelled ``rows``, computed and counted on the executors."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = language_id.nearest(model.profiles)
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text")
                z = np.clip(np.rint(logits(model, texts).astype(float) * STEPS_PER_LOGIT), -(1 << 15), 1 << 15)
                yield pa.RecordBatch.from_arrays([pa.array(z.astype(np.int64)), pa.array(find(texts), pa.int64()), part.column("y")], ["z", "lang", "y"])

    counted = rows.mapInArrow(judge, "z long, lang long, y int").groupBy("z", "lang", "y").count().orderBy("z", "lang", "y")
    got = counted.collect()  # at most a row per rounded logit, language and class
    z, of, y, n = (np.array([r[c] for r in got]) for c in ("z", "lang", "y", "count"))
    z = z / STEPS_PER_LOGIT
    model.thresholds[:] = (threshold(z, y, n=n) if len(got) else None) or 0.0
    for i in range(len(model.profiles.languages)):
        model.thresholds[i] = (threshold(z, y, of == i, n=n) if len(got) else None) or 0.0


def score(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """All columns of ``docs``, then ``score`` (0 to 1; 0.5 and more is toxic) and ``lang_pred``, the language whose threshold was used.

    Existing columns of these names are replaced. Null, empty and wordless
    texts are scored as a text without words, with the threshold of no
    language (``und``). Rows are scored each by itself: equal texts get equal
    scores.
    """
    new = ("score", "lang_pred")
    kept = docs.drop(*new)
    names, languages = kept.columns, [*model.profiles.languages, language_id.UNKNOWN]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = language_id.nearest(model.profiles)
        for batch in batches:
            for part in slices(batch, text):
                texts = part.column(text)
                of = find(texts)
                p = 1 / (1 + np.exp(model.thresholds[of] - logits(model, texts)))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(p), pa.array([languages[i] for i in of], pa.string())], [*names, *new])

    schema = T.StructType(kept.schema.fields[:]).add("score", T.DoubleType()).add("lang_pred", T.StringType())
    return kept.mapInArrow(make, schema)
