"""Fill-in-the-middle and importance resampling against brute force and exact round trips."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from crashlens.llm import fill_middle, importance
from llm_common import docs_of, workers_path  # noqa: F401
from test_llm_dedup import lower, sentence

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def wide(rng, n):
    return "".join(rng.choice(["aé", "日本", "x𝄞y", "plain text ", "\n"]) for _ in range(n))


def brute_fim(key, text, seed="1", percent=90, spm=20):
    x = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(x)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not x or any(m in x for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return n, "plain", None, None, x
    if h[3] % 100 < spm:
        return n, "spm", a, b - a, f"<S>{x[b:]}<P>{x[:a]}<M>{x[a:b]}"
    return n, "psm", a, b - a, f"<P>{x[:a]}<S>{x[b:]}<M>{x[a:b]}"


def test_fill_middle_is_that_of_brute_force(docs_of):
    rng = random.Random(4)
    rows = [(i, wide(rng, rng.randrange(0, 60))) for i in range(300)]
    rows += [(400, None), (401, ""), (None, "without an id, é"), (None, None), (402, "holds <M> itself"), (403, "<P>"), (404, "<<<P S> M>>")]
    rows += [(405, wide(rng, 200_000)), (406, "a" * 3000 + "𝄞" * 3000), (7, "one"), (7, "one"), (7, "öther")]
    rows += [(500 + i, "<" * (i % 5) + "S><" + "P" * (i % 3) + ">M" + "<" * (i % 4)) for i in range(60)]
    made = fill_middle.transform(docs_of(rows)).withColumn("back", fill_middle.restored())
    got = made.collect()
    assert len(got) == len(rows) and made.columns[-6:] == ["n", "form", "prefix_chars", "middle_chars", "output", "back"]
    want = sorted((str((k, t)), *map(str, brute_fim(k, t))) for k, t in rows)
    assert sorted((str((r.doc_id, r.text)), *map(str, (r.n, r.form, r.prefix_chars, r.middle_chars, r.output))) for r in got) == want
    assert all(r.back == (r.text or "") and r["block"] == "x" for r in got)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_fill_middle_replaces_its_own_columns(spark):
    docs = spark.createDataFrame([(1, "some text", "x", 2, "y")], "id long, body string, output string, n int, other string")
    assert fill_middle.transform(docs, key="id", text="body", percent=100).columns == [
        "id", "body", "other", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert fill_middle.transform(docs.limit(0), key="id", text="body").collect() == []


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(["a", "é", "日", "𝄞"]), max_size=400), st.integers(1, 50), st.sampled_from([1, 5, 120]))
def test_rank_index_is_exact(text, block, error):
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    index = fill_middle.fit(data, error=error, block=block)
    want = np.cumsum([0] + [len(c.encode()) for c in text])
    assert (index.offsets(np.arange(len(text) + 1)) == want).all()
    assert np.abs(index.residual).max() <= error + 1


def test_rank_index_needs_few_segments():
    data = np.frombuffer(("a" * 10**6 + "日" * 10**6).encode(), dtype=np.uint8)
    assert len(fill_middle.fit(data).anchor) <= 3
    rng = random.Random(2)
    mixed = np.frombuffer("".join(rng.choice("abcdefgé") for _ in range(10**6)).encode(), dtype=np.uint8)
    assert len(fill_middle.fit(mixed).anchor) < 500


@pytest.mark.parametrize("size", [0, 1, 3, 4, 255, 256, 257, 512, 513, 5000])
def test_crc_of_matrices(size):
    rng = random.Random(size)
    texts = [bytes(rng.randrange(256) for _ in range(size)) for _ in range(5)]
    data = np.frombuffer(b"".join(texts) + b"-", dtype=np.uint8)
    start = np.arange(5) * size
    assert importance.crc32(data, start, start + size).tolist() == [zlib.crc32(t) for t in texts]


def test_features_that_share_a_hash_are_told_apart(monkeypatch):
    real = importance.split_words
    monkeypatch.setattr(importance, "split_words", lambda *a, **k: (w := real(*a, **k))._replace(hash=w.hash % np.uint64(3)))
    texts = ["one two three four five one", "six seven eight", "ab ac ab"]
    (text, bucket), _ = importance.feature_buckets(pa.array(texts), 1, 10_000)
    want = [(i, zlib.crc32(w.encode()) % 10_000) for i, t in enumerate(texts) for w in t.split()]
    assert list(zip(text.tolist(), bucket.tolist())) == want


def brute_importance(rows, target, runs, buckets, percent, least, seed):
    def features(text):
        w = WORD.findall(lower(text))
        return len(w), [zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets for k in range(1, runs + 1) for i in range(len(w) - k + 1)]

    s, t = [0] * buckets, [0] * buckets
    for side, texts in ((s, [x for _, x in rows]), (t, target)):
        for x in texts:
            for b in features(x)[1]:
                side[b] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    out = []
    for key, text in rows:
        n, own = features(text)
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in own)
        out.append((key, len(own), n, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[2] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    return out, able[: percent * len(able) // 100]


@pytest.mark.parametrize("runs, percent", [(1, 10), (2, 35)])
def test_importance_is_that_of_brute_force(docs_of, spark, runs, percent):
    rng = random.Random(runs)
    rows = [(i, sentence(rng, rng.randrange(0, 80), 60 if i % 3 else 200)) for i in range(250)]
    rows += [(300, None), (301, ""), (302, "!?"), (303, "É" * 700 + " x " * 30), (304, sentence(rng, 30_000)), (305, "Ab aB " * 20)]
    rows += [(400, sentence(random.Random(9), 40))] * 30 + [(401, "w1 " * 25), (None, "w2 " * 25), (None, "w2 " * 25)]
    target = [sentence(rng, 50, 30) for _ in range(20)] + [None, ""]
    items = spark.createDataFrame([(i, t, "x") for i, t in enumerate(target)], "item_id long, text string, score string")
    docs = docs_of(rows).repartition(7)
    got = importance.importance(docs, items, runs=runs, buckets=500, percent=percent, carry=("class", "source")).collect()
    want, drawn = brute_importance(rows, target, runs, 500, percent, 20, "2024")
    assert sorted((str(r.doc_id), r.n_features, r.n_words, r.weight, r.score) for r in got) == sorted((str(k), *r) for k, *r in want)
    ranked = sorted((r for r in got if r.rank is not None), key=lambda r: r.rank)
    assert [r.rank for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r.doc_id, r.score) for r in ranked] == [(r[0], r[4]) for r in drawn]
    assert {r["class"] for r in got} == {"x"}


def test_resample_keeps_all_columns(docs_of, spark):
    rng = random.Random(5)
    docs = docs_of([(i, sentence(rng, 30)) for i in range(50)]).withColumnRenamed("value", "rank")
    target = spark.createDataFrame([("w1 w2 w3",)], "text string")
    got = importance.resample(docs, target, percent=20)
    assert got.columns == [c for c in docs.columns if c != "rank"] + ["rank"]
    rows = got.collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert sorted(r["rank"] for r in rows) == list(range(1, 11)) and all(texts[r.doc_id] == r.text for r in rows)


def test_importance_of_empty_tables(docs_of, spark):
    docs = docs_of([(1, "a b c " * 10)])
    none = spark.createDataFrame([], "text string")
    assert importance.importance(docs.limit(0), none).collect() == []
    row = importance.importance(docs, none, percent=100).collect()[0]
    assert (row.doc_id, row.n_features, row["rank"]) == (1, 30, 1) and row.weight < 0
