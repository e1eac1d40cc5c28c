"""Language identification by rank-order profiles of letter n-grams.

A profile is a language's most frequent n-grams (1 to 3 characters of a word,
with a mark for a word's ends), most frequent first. A document is ranked the
same way over its whole text, and its distance to a language is the sum, over
its most frequent n-grams, of how far each one's rank lies from its rank in
the profile (at most ``PROFILE``, which is also the price of an n-gram that the
profile lacks). The nearest profile names the language. All n-grams of a
document are ranked, those that no profile has too, so a text in a language
that was not learned is far from all and gets a low score.

Profiles are learned from a bounded hash sample of the labelled documents of
each language: about ``SAMPLE`` each, told by a hash of the id. N-grams are
counted on the executors; the driver picks the most frequent.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crashlens.llm.words import slices

SAMPLE = 1500  # documents a language, about
PROFILE = 400  # n-grams of a language
RANKED = 300  # n-grams of a document
LENGTHS = (1, 2, 3)
UNKNOWN = "und"
SLICE = 1 << 19  # bytes of text ranked at once
NEAR_SLICE = 1 << 17  # the same where only the nearest language is asked for: arrays that stay in a core's cache
_POINT = 21  # bits of a code point


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def letters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased letters of all texts as code points, runs of anything else as one 0; the text of each; letters by text."""
    strings = [(x or "").lower() for x in texts.to_pylist()]
    points = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    owner = np.repeat(np.arange(len(strings)), [len(s) for s in strings])
    known = _letters()[points]
    count = np.bincount(owner[known], minlength=len(strings))
    # A text's letters lie between marks of its own.
    keep = known.copy()
    keep[1:] |= known[:-1] & (owner[1:] == owner[:-1])
    last = np.append(owner[1:] != owner[:-1], True)[: len(owner)]
    open_end = last & known
    points, owner2 = np.where(known, points, 0)[keep], owner[keep]
    ends = np.cumsum(keep)[open_end]
    points, owner2 = np.insert(points, ends, 0), np.insert(owner2, ends, owner[open_end])
    first = np.append(True, owner2[1:] != owner2[:-1])[: len(owner2)]
    starts = np.flatnonzero(first & (points != 0))
    return np.insert(points, starts, 0).astype(np.int64), np.insert(owner2, starts, owner2[starts]), count


def _grams(points: np.ndarray, owner: np.ndarray, base: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(code, text)`` of the n-grams of each length: digits to ``base`` of symbols, marks at ends only."""
    for n in LENGTHS:
        size = len(points) - n + 1
        if size < 1:
            return
        code = np.zeros(size, dtype=np.int64)
        ok = owner[:size] == owner[n - 1 :]
        for i in range(n):
            part = points[i : i + size]
            code = code * base + part
            if 0 < i < n - 1 or n == 1:
                ok &= part != 0
        if n == 2:
            ok &= code != 0
        yield code[ok], owner[:size][ok]


class Profiles(NamedTuple):
    languages: list[str]
    grams: list[str]  # all n-grams of the profiles; a word's end is a space
    ranks: np.ndarray  # languages by n-grams; PROFILE and more where the language lacks it


def held_out(key: str = "doc_id") -> F.Column:
    """Rows that no profile learns from: crc32 of the id as text, modulo 3, is 1 (a null id is held out)."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(True))


def learn(docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int | None = SAMPLE) -> Profiles:
    """Profiles of the languages named by rows that are not held out; rows without text or language teach nothing.

    About ``sample`` documents of each language teach, or all of them (None).
    """
    known = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & ~held_out(key))
    sizes = {r["l"]: r["n"] for r in known.groupBy(F.col(lang).alias("l")).agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a language
    if not sizes:
        return Profiles([], [], np.zeros((0, 0), dtype=np.int32))
    share = F.lit(0.0)
    for name, n in sorted(sizes.items()):
        share = F.when(F.col(lang) == name, 1.0 if sample is None else min(1.0, sample / n)).otherwise(share)
    drawn = F.pmod(F.xxhash64(F.lit("language"), key), F.lit(1 << 20)) / float(1 << 20) < share

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                points, owner, _ = letters(part.column("text"))
                names, which = np.unique(np.array(part.column("lang").to_pylist(), dtype=object).astype(str), return_inverse=True)
                for size, (code, text_of) in zip(LENGTHS, _grams(points, owner, 1 << _POINT)):
                    for i, name in enumerate(names.tolist()):
                        some, n = np.unique(code[which[text_of] == i], return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([name] * len(some), pa.string()), pa.array([size] * len(some), pa.int32()), pa.array(some), pa.array(n.astype(np.int64))],
                            ["lang", "size", "gram", "n"])

    taught = known if sample is None else known.where(drawn)
    counted = taught.select(F.col(lang).alias("lang"), F.col(text).alias("text")).mapInArrow(count, "lang string, size int, gram long, n long")
    often = counted.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n")).where("n > 1")
    place = F.rank().over(Window.partitionBy("lang").orderBy(F.col("n").desc()))
    rows = often.withColumn("place", place).where(F.col("place") <= PROFILE).collect()  # a profile a language, and ties with its last
    languages = sorted(sizes)
    best = {name: sorted(((r["n"], _spelled(r["gram"], r["size"])) for r in rows if r["lang"] == name), key=lambda x: (-x[0], x[1]))[:PROFILE] for name in languages}
    grams = sorted({g for own in best.values() for _, g in own})
    at = {g: i for i, g in enumerate(grams)}
    ranks = np.full((len(languages), len(grams)), 4 * PROFILE, dtype=np.int32)
    for row, name in enumerate(languages):
        for rank, (_, gram) in enumerate(best[name]):
            ranks[row, at[gram]] = rank
    return Profiles(languages, grams, ranks)


def _spelled(code: int, size: int) -> str:
    """The characters of a code to base ``2**_POINT``; a mark is a space."""
    out = []
    for _ in range(size):
        out.append(code & (1 << _POINT) - 1)
        code >>= _POINT
    return "".join(chr(c) if c else " " for c in reversed(out))


def _often_first(text: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """The order by ``text``, then by ``seen`` from the most on; equals stay as they are."""
    most, n = int(seen.max(initial=0)), max(len(seen), 1)
    if int(text.max(initial=0)).bit_length() + most.bit_length() + n.bit_length() > 62:
        return np.lexsort((-seen, text))
    # One number for each: sorting numbers is several times faster than sorting by two keys.
    key = (((text << most.bit_length()) | (most - seen)) << n.bit_length()) | np.arange(len(seen))
    key.sort()
    return key & ((1 << n.bit_length()) - 1)


class _Ranker:
    """Distances of documents to profiles."""

    def __init__(self, profiles: Profiles):
        self.profiles = profiles
        #: Code points of the profiles' n-grams, a mark as 0, nothing as -1.
        self.points = np.full((len(profiles.grams), max(LENGTHS)), -1, dtype=np.int64)
        for row, gram in enumerate(profiles.grams):
            self.points[row, : len(gram)] = [0 if c == " " else ord(c) for c in gram]

    def distances(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distance of each text to each language, n-grams that were ranked, letters.

        All n-grams of a text are counted and ranked, known to some profile or
        not, equally frequent ones by their spelling. An n-gram is a number whose
        digits are the slice's own letters (0: nothing, 1: a mark), so numbers
        sort as the n-grams are spelled; what is held follows the n-grams there
        are, not the languages.
        """
        points, owner, count = letters(texts)
        rows, width = len(texts), max(LENGTHS)
        there = np.zeros(int(points.max(initial=0)) + 1, dtype=bool)
        there[0] = there[points] = True
        symbols = np.flatnonzero(there)
        bits = (len(symbols) + 1).bit_length()
        if rows > 1 and rows.bit_length() + width * bits > 62:
            parts = [self.distances(x) for x in (texts.slice(0, rows // 2), texts.slice(rows // 2))]
            return tuple(np.concatenate(x) for x in zip(*parts))
        digits, keys = np.cumsum(there)[points], []
        mark, high = digits == 1, owner << width * bits
        shifted = [digits << (width - 1 - i) * bits for i in range(width)]
        for n in LENGTHS:
            size = max(len(points) - n + 1, 0)
            code = high[:size].copy()
            ok = owner[:size] == owner[len(owner) - size :]
            for i in range(n):
                code |= shifted[i][i : i + size]
                if 0 < i < n - 1 or n == 1:
                    ok &= ~mark[i : i + size]
            if n == 2:
                ok &= ~(mark[:size] & mark[1 : size + 1])
            keys.append(code[ok])
        gram = np.concatenate(keys)
        gram.sort()
        new = np.flatnonzero(np.append(True, gram[1:] != gram[:-1])[: len(gram)])
        gram, seen = gram[new], np.diff(new, append=len(gram))
        text = gram >> width * bits
        order = _often_first(text, seen)
        gram, text = gram[order] & (1 << width * bits) - 1, text[order]
        own = np.bincount(text, minlength=rows)
        place = np.arange(len(text)) - np.repeat(np.cumsum(own) - own, own)
        top = place < RANKED
        gram, text, place = gram[top], text[top], place[top]
        # The profiles' n-grams in this slice's digits; those with a letter that it lacks do not occur.
        at = np.minimum(np.searchsorted(symbols, self.points), len(symbols) - 1)
        here = (symbols[at] == self.points) | (self.points < 0)
        codes = (np.where(self.points < 0, 0, at + 1) << np.arange(width - 1, -1, -1) * bits).sum(axis=1)
        which = np.flatnonzero(here.all(axis=1))
        which = which[np.argsort(codes[which])]
        known = np.full(len(gram), -1)
        if len(which):
            found = np.minimum(np.searchsorted(codes[which], gram), len(which) - 1)
            known = np.where(codes[which][found] == gram, which[found], -1)
        far = np.zeros((rows, len(self.profiles.languages)), dtype=np.int64)
        for i, ranks in enumerate(self.profiles.ranks):
            price = np.where(known < 0, PROFILE, np.minimum(np.abs(ranks[known] - place), PROFILE)) if len(ranks) else np.full(len(gram), PROFILE)
            far[:, i] = np.bincount(text, weights=price, minlength=rows)
        return far, np.bincount(text, minlength=rows), count


def nearest(profiles: Profiles) -> Callable[[pa.Array], np.ndarray]:
    """A function from texts to the number of each one's nearest language; -1 for texts without letters, or if nothing was learned."""
    if not profiles.languages:
        return lambda texts: np.full(len(texts), -1)
    ranker = _Ranker(profiles)

    def find(texts: pa.Array) -> np.ndarray:
        found = [np.zeros(0, dtype=np.int64)]
        for part in slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text", NEAR_SLICE):
            far, _, count = ranker.distances(part.column("text"))
            found.append(np.where(count > 0, far.argmin(axis=1), -1))
        return np.concatenate(found)

    return find


def identify(docs: DataFrame, profiles: Profiles, *, text: str = "text") -> DataFrame:
    """All columns of ``docs``, then ``lang_pred`` and ``score`` (existing columns of these names are replaced).

    ``score`` is 1 less the mean out-of-place distance over ``PROFILE``. Equally near
    languages give the first by name; texts with letters, but no n-gram of any
    profile, get score 0. Rows are judged each by itself: equal texts get equal
    results. Null texts, texts without a letter and all texts
    where nothing was learned are ``und`` with score 0.
    """
    kept = docs.drop("lang_pred", "score")
    names = kept.columns
    ranker = _Ranker(profiles) if profiles.languages else None

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, SLICE):
                pred, score = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows)
                if ranker is not None:
                    far, ranked, count = ranker.distances(part.column(text))
                    best = far.argmin(axis=1)
                    pred = [profiles.languages[b] if n else UNKNOWN for b, n in zip(best.tolist(), count.tolist())]
                    some = ranked > 0
                    score[some] = 1 - far[some, best[some]] / (ranked[some] * PROFILE)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(pred, pa.string()), pa.array(score)], [*names, "lang_pred", "score"])

    schema = T.StructType(kept.schema.fields[:]).add("lang_pred", T.StringType()).add("score", T.DoubleType())
    return kept.mapInArrow(make, schema)
