"""Token counts of documents that stay right under edits.

A document's pre-tokens are grouped into segments of about ``SEGMENT``
characters, cut only where the pre-tokenizer must cut too: before a space
between two characters that are no white space. Over the segments lies a
binary tree of sums, characters and tokens (:class:`Tree`, a flat array, node i
above nodes 2i and 2i + 1). An edit finds its segments by walking down the
characters' sums, takes in a neighbour where it touches the characters that
make a cut valid, encodes that region anew and updates the sums on the paths to
the root. Nothing else of the document is encoded again.

Trees are built by one pass over the documents and kept as a table without the
texts; edits are joined to them by id.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crashlens.llm.counters import flagged
from crashlens.llm.words import slices

SEGMENT = 512  # characters
GROWN = 16  # a tree is built anew if a region outgrows this many segments

_CUT = re.compile(r"(?<=\S) (?=\S)")


@lru_cache(maxsize=4)
def tokenizer(path: str, pattern: str) -> Callable[[list[str]], list[int]]:
    """Token counts of strings by a public vocabulary of ranks (``path``, a file every executor has) and its pre-token ``pattern``."""
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}
    encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return lambda texts: [len(encoding.encode_ordinary(x)) for x in texts]


def segments(text: str) -> list[str]:
    """``text`` cut at valid places into pieces of ``SEGMENT`` characters and up to the next cut."""
    out, at = [], 0
    while len(text) - at > SEGMENT:
        found = _CUT.search(text, at + SEGMENT - 1)
        if not found:
            break
        out.append(text[at : found.start()])
        at = found.start()
    out.append(text[at:])
    return out


class Tree(NamedTuple):
    """Sums of characters and of tokens; leaves are the last half of the arrays, the root is node 1."""

    chars: np.ndarray
    tokens: np.ndarray

    @classmethod
    def of(cls, chars: list[int], tokens: list[int]) -> Tree:
        size = 1 << max(0, (len(chars) - 1).bit_length())
        sums = []
        for leaves in (chars, tokens):
            nodes = np.zeros(2 * size, dtype=np.int64)
            nodes[size : size + len(leaves)] = leaves
            level = size
            while level > 1:
                nodes[level // 2 : level] = nodes[level : 2 * level : 2] + nodes[level + 1 : 2 * level : 2]
                level //= 2
            sums.append(nodes)
        return cls(*sums)

    @property
    def size(self) -> int:
        return len(self.chars) // 2

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at`` (the last one with characters, if it is the text's end), and where it starts."""
        node, start = 1, 0
        at = max(0, min(at, int(self.chars[1]) - 1))
        while node < self.size:
            node *= 2
            if at - start >= self.chars[node]:
                start += int(self.chars[node])
                node += 1
        return node - self.size, start

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        node = leaf + self.size
        more = chars - int(self.chars[node]), tokens - int(self.tokens[node])
        while node:
            self.chars[node] += more[0]
            self.tokens[node] += more[1]
            node //= 2


def apply(text: str, tree: Tree, edits: list[tuple[int, int, str]], count: Callable[[list[str]], list[int]]) -> tuple[str, Tree, int]:
    """The text and the tree after ``(at, removed, inserted)`` edits, one after the other, and the characters encoded anew."""
    encoded = 0
    for at, removed, inserted in edits:
        at = max(0, min(at, len(text)))
        end = min(len(text), at + max(0, removed))
        # A cut between characters i - 1 and i depends on characters i - 1 to i + 1.
        first, low = tree.find(at - 2)
        last, last_low = tree.find(end + 1)
        high = last_low + int(tree.chars[last + tree.size])
        text = text[:at] + inserted + text[end:]
        region = text[low : high + len(inserted) - (end - at)]
        pieces = segments(region)
        counts = count(pieces)
        encoded += len(region)
        if len(pieces) > GROWN + last - first:
            ahead = [(int(c), int(t)) for c, t in zip(tree.chars[tree.size :], tree.tokens[tree.size :])]
            leaves = ahead[:first] + [(len(p), n) for p, n in zip(pieces, counts)] + ahead[last + 1 :]
            leaves = [x for x in leaves if x[0]] or [(0, 0)]
            tree = Tree.of([c for c, _ in leaves], [t for _, t in leaves])
            continue
        # The region's leaves share its pieces, the last one taking what is over.
        room = last - first + 1
        for i in range(room):
            own = slice(i, i + 1) if i < room - 1 else slice(i, None)
            tree.put(first + i, sum(map(len, pieces[own])), sum(counts[own]))
    return text, tree, encoded


def build(docs: DataFrame, *, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, hash, n_tokens, chars, tokens)``: the leaves of every document's tree and its token count.

    ``hash`` is a hash of the text, which tells rows that share an id apart. Null
    and empty texts have one empty leaf. Other columns are not read.
    """
    source = docs.select(F.col(key).alias("_key"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = tokenizer(path, pattern)
        for batch in batches:
            for part in slices(batch, "text"):
                cut = [segments(x or "") for x in part.column("text").to_pylist()]
                tokens = [count(pieces) for pieces in cut]
                yield pa.RecordBatch.from_arrays(
                    [part.column("_key"), part.column("hash"), pa.array([sum(x) for x in tokens], pa.int64()),
                     pa.array([list(map(len, pieces)) for pieces in cut], pa.list_(pa.int32())), pa.array(tokens, pa.list_(pa.int32()))],
                    [key, "hash", "n_tokens", "chars", "tokens"])

    numbers = T.ArrayType(T.IntegerType())
    schema = T.StructType([T.StructField(key, source.schema["_key"].dataType)])
    return source.mapInArrow(make, schema.add("hash", T.LongType()).add("n_tokens", T.LongType()).add("chars", numbers).add("tokens", numbers))


def update(docs: DataFrame, trees: DataFrame, edits: DataFrame, *, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents that have edits, edited: ``(key, hash, text, n_tokens, chars, tokens, n_edits, n_encoded)``, one row for each key and text.

    ``edits`` has ``key``, ``hash`` (that of the text it is for) and ``edits``, an array of
    ``(at, removed, inserted)`` structs in the order to apply: character
    positions in the text as the edits before left it; positions beyond the end
    mean the end. ``n_encoded`` is the number of characters encoded again. Rows of
    ``edits`` without a document, or with an empty array, are left out; so are rows
    whose key is null (a struct of a null is a key like others).
    """
    source = docs.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_hash"), F.col(text).alias("text")).where("text is not null")
    todo = edits.where(F.size("edits") > 0).select(F.col(key).alias("_key"), F.col("hash").alias("_hash"), "edits").dropDuplicates(["_key", "_hash"])
    # Equal rows collapse before the joins; a text without edits is not sent.
    source = flagged(source, "_hash", todo, "_hash").dropDuplicates(["_key", "_hash"])
    known = flagged(trees.select(F.col(key).alias("_key"), F.col("hash").alias("_hash"), "chars", "tokens"), "_hash", todo, "_hash")
    known = known.dropDuplicates(["_key", "_hash"]).join(todo, ["_key", "_hash"])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = tokenizer(path, pattern)
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("text", "n_tokens", "chars", "tokens", "n_edits", "n_encoded")}
            for row in batch.select(["text", "chars", "tokens", "edits"]).to_pylist():
                todo = [(e["at"], e["removed"], e["inserted"] or "") for e in row["edits"]]
                new, tree, encoded = apply(row["text"], Tree.of(row["chars"], row["tokens"]), todo, count)
                leaves = tree.chars[tree.size :], tree.tokens[tree.size :]
                for c, v in zip(out, (new, int(tree.tokens[1]), leaves[0].tolist(), leaves[1].tolist(), len(todo), encoded)):
                    out[c].append(v)
            kinds = [pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key"), batch.column("_hash"), *(pa.array(out[c], k) for c, k in zip(out, kinds))], [key, "hash", *out])

    numbers = T.ArrayType(T.IntegerType())
    schema = T.StructType([T.StructField(key, source.schema["_key"].dataType)]).add("hash", T.LongType()).add("text", T.StringType())
    schema = schema.add("n_tokens", T.LongType()).add("chars", numbers).add("tokens", numbers).add("n_edits", T.LongType()).add("n_encoded", T.LongType())
    return source.join(known, ["_key", "_hash"]).mapInArrow(make, schema)


# What a redaction replaces.
PERSONAL = {"<EMAIL>": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "<ADDRESS>": r"\b(?:\d{1,3}\.){3}\d{1,3}\b", "<NUMBER>": r"\+?\d[\d ()-]{8,}\d"}


def redactions(docs: DataFrame, *, key: str = "doc_id", text: str = "text", patterns: dict[str, str] = PERSONAL) -> DataFrame:
    """Edits for :func:`update` that replace what the patterns find, from the text's end to its start; only documents that have some."""
    source = docs.select(F.col(key).alias("_key"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))
    found = re.compile("|".join(f"(?P<p{i}>{p})" for i, p in enumerate(patterns.values())))
    marks = list(patterns)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                [{"at": m.start(), "removed": m.end() - m.start(), "inserted": marks[int(m.lastgroup[1:])]} for m in found.finditer(x or "")][::-1]
                for x in batch.column("text").to_pylist()
            ]
            edits = pa.array(rows, pa.list_(pa.struct([("at", pa.int32()), ("removed", pa.int32()), ("inserted", pa.string())])))
            some = pa.array([bool(r) for r in rows], pa.bool_())
            yield pa.RecordBatch.from_arrays([c.filter(some) for c in (batch.column("_key"), batch.column("hash"), edits)], [key, "hash", "edits"])

    edit = T.StructType().add("at", T.IntegerType()).add("removed", T.IntegerType()).add("inserted", T.StringType())
    schema = T.StructType([T.StructField(key, source.schema["_key"].dataType)]).add("hash", T.LongType()).add("edits", T.ArrayType(edit))
    return source.mapInArrow(make, schema)
