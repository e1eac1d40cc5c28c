"""Substring dedup, MinHash near-dedup and embedding near-dedup against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from crashlens.llm import embedding_dedup, minhash_dedup, substring_dedup
from crashlens.llm.graph import components
from llm_common import docs_of, workers_path  # noqa: F401

SPACE = re.compile("[\x20\x09-\x0d]+")


def words_of(text):
    return [w for w in SPACE.split(text or "") if w]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def corpus(seed=1):
    """Passages shared by documents, near copies, copies, nulls, blanks, one long text, odd white space."""
    rng = random.Random(seed)
    base, passage, line = sentence(rng, 120), sentence(rng, 40), sentence(rng, 14)
    rows = [(100 + i, sentence(rng, rng.randrange(0, 60))) for i in range(30)]
    for i in range(25):
        w = base.split()
        for _ in range(i % 6):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
        rows.append((200 + i, " ".join(w)))
    rows += [(300 + i, f"{sentence(rng, 20)}\n{passage}\t {sentence(rng, 8)}") for i in range(8)]
    rows += [(400 + i, f"{line}\x0b{sentence(rng, 25)} {line}") for i in range(8)]
    rows += [(500, None), (501, ""), (502, " \n\t "), (503, "one"), (504, "One"), (505, "a b c d"), (506, "A b c d"), (507, base), (508, base.upper())]
    rows += [(600, sentence(rng, 6000) + " " + passage), (601, "é ü " * 30), (-5, passage), (None, passage), (None, base)]
    rng.shuffle(rows)
    return rows


def groups(links, ids):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def brute_repeats(rows, window):
    texts = {i: words_of(t) for i, t in rows if i is not None and t is not None}
    least = {}
    for i in sorted(texts):
        w = texts[i]
        for a in range(len(w) - window + 1):
            least.setdefault(tuple(w[a : a + window]), i)
    out = {}
    for i, w in texts.items():
        gone = [False] * len(w)
        for a in range(len(w) - window + 1):
            if least[tuple(w[a : a + window])] < i:
                gone[a : a + window] = [True] * window
        out[i] = gone
    return out


@pytest.mark.parametrize("group", [substring_dedup.GROUP, 50])
def test_repeats_are_those_of_brute_force(docs_of, group):
    rows = corpus()
    want = brute_repeats(rows, 13)
    got = substring_dedup.remove_repeats(docs_of(rows), group=group, carry=("source", "class")).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        if r.doc_id is None:
            assert r.n_removed == 0 and r.text in [t for i, t in rows if i is None]
        elif r.text is None:
            assert texts[r.doc_id] is None and r.n_words == 0
        else:
            gone = want[r.doc_id]
            assert (r.n_words, r.n_removed) == (len(gone), sum(gone))
            assert words_of(r.text) == [w for w, g in zip(words_of(texts[r.doc_id]), gone) if not g]
            spans = [False] * len(gone)
            for s in r.spans:
                spans[s.start : s.end] = [True] * (s.end - s.start)
            assert spans == gone
            if not r.n_removed:
                assert r.text == texts[r.doc_id]
        assert r["class"] == "x"
    assert sum(r.n_removed > 0 for r in got) > 30


def test_small_groups_need_longer_prefixes(docs_of):
    prefixes, n, total = substring_dedup.find_prefixes(docs_of([(i, t) for i, t in corpus() if t]).selectExpr("doc_id as _key", "text"), 13, 20)
    assert len(prefixes.tables) > 2 and n > total / 40


def test_rows_of_one_id_do_not_remove_each_other(docs_of):
    text = sentence(random.Random(3), 30)
    got = substring_dedup.remove_repeats(docs_of([(7, text), (7, text), (7, text + " more"), (9, text), (9, text)])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(7, 0), (7, 0), (7, 0), (9, 30), (9, 30)]


def test_rows_of_a_hot_id_are_dealt_out(docs_of, monkeypatch):
    rng = random.Random(13)
    monkeypatch.setattr(substring_dedup, "BLOCK", 2000)
    passage = sentence(rng, 20, 10**6)
    rows = [(50, f"{passage} {sentence(rng, 30, 10**6)}") for _ in range(150)] + [(50, passage)] * 150 + [(3, passage), (51, passage)]
    rows += [(100 + i, sentence(rng, 40, 10**6)) for i in range(200)] + [(None, passage), (50, None)]
    docs = docs_of(rows).repartition(5)
    hot, salts = substring_dedup._hot_ids(docs.where("text is not null").selectExpr("doc_id as _key"), 7)
    assert hot == [50] and salts > 3
    got = substring_dedup.remove_repeats(docs).collect()
    assert len(got) == len(rows)
    assert all(r.n_removed == (20 if r.doc_id in (50, 51) and r.text is not None else 0) for r in got)
    assert sum(r.doc_id == 50 and r.n_words == 50 for r in got) == 150


def test_empty_tables(docs_of, spark):
    empty = docs_of([(1, "x")]).limit(0)
    assert substring_dedup.remove_repeats(empty).collect() == []
    assert minhash_dedup.near_duplicates(empty).collect() == []
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.near_duplicates(vectors).collect() == []


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_are_those_of_brute_force(docs_of, percent):
    rows = corpus(percent)
    got = minhash_dedup.near_duplicates(docs_of(rows), percent=percent).collect()
    assert len(got) == len(rows)
    sets = {}
    for i, t in rows:
        w = words_of(lower(t))
        sets[i] = {tuple(w[a : a + 5]) for a in range(max(1, len(w) - 4))} if w else set()
    ids = [i for i, _ in rows if i is not None]
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = groups(links, ids)
    for r in got:
        if r.doc_id is None:
            continue
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)
    assert len(links) > 20
    null = [r for r in got if r.doc_id is None]
    assert {(r.component_id, r.kept) for r in null} == {(-5, False), (want[507], False)}


def test_many_near_copies_without_a_pair_for_each(docs_of, monkeypatch):
    """A hot list in blocks: copies with 0 to 7 edits of one text, and one line that all share."""
    monkeypatch.setattr(minhash_dedup, "BLOCK", 16)
    rng = random.Random(9)
    base = sentence(rng, 146, 10**6).split()
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(i % 8):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**9)}"
        rows.append((i, " ".join(w)))
    got = {r.doc_id: r for r in minhash_dedup.near_duplicates(docs_of(rows), percent=85).collect()}
    sets = {i: {tuple(t.split()[a : a + 5]) for a in range(142)} for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    want = groups(links, list(sets))
    assert {i: r.component_id for i, r in got.items()} == want


def test_repeated_rows_are_one_class(docs_of):
    got = minhash_dedup.near_duplicates(docs_of([(3, "a b c d e f"), (3, "a b c d e f"), (2, "a b c d e f"), (4, "")])).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got) == [(2, 2, True), (3, 2, False), (3, 2, False), (4, 4, True)]


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(70, 60), (5, 5)]
    random.Random(1).shuffle(chain)
    links = spark.createDataFrame([(a, b) if a % 2 else (b, a) for a, b in chain], "a long, b long")
    got = {r.id: r.component for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(61)}, 70: 0, **{1000 + i: 1000 for i in range(50)}}


def vectors():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    rows = []
    for i in range(240):
        v = centres[i % 12] + rng.normal(size=16) * (0.1 + 0.3 * (i % 4) / 3)
        rows.append((i, [float(x) for x in v], i % 3 if i % 10 else None))
    rows += [(300, rows[1][1], rows[1][2]), (301, rows[1][1], rows[1][2]), (302, [2 * x for x in rows[1][1]], rows[1][2])]
    rows += [(400, None, 1), (401, [], 1), (402, [0.0] * 16, 1), (403, [math.nan] * 16, 1), (404, [None] + [1.0] * 15, 1), (405, [math.inf] + [1.0] * 15, 1)]
    rows += [(500, [1.0, 0.0], 1), (501, [1.0, 0.1], 1), (502, [1.0, -0.0], 1)]
    return rows


def test_embedding_duplicates_are_those_of_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 8)
    rows = vectors()
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<double>, label int, class string, weight string")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df).collect()}
    assert len(got) == len(rows)

    def usable(v):
        return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    links = []
    for i, v, a in rows:
        for j, w, b in rows:
            if i < j and a is not None and a == b and usable(v) and usable(w) and len(v) == len(w):
                if np.dot(v, w) >= 0.93 * np.linalg.norm(v) * np.linalg.norm(w):
                    links.append((i, j))
    want, count = groups(links, list(got)), Counter(x for link in links for x in link)
    assert len(links) > 100
    for i, r in got.items():
        assert (r.n_links, r.component_id, r.kept) == (count[i], want[i], want[i] == i), i


def test_embeddings_without_labels(spark):
    df = spark.createDataFrame([(2, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0]), (5, [0.0, 1.0])], "vec_id long, embedding array<float>")
    got = embedding_dedup.near_duplicates(df, label=None).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in got) == [(0, 2, 1, False), (1, 2, 1, True), (2, 2, 1, False), (5, 0, 5, True)]


def test_copies_of_a_class_meet_once(spark, docs_of, monkeypatch):
    """A class has one posting of a value from a task, and one set in the join of pairs, however many copies it has."""
    rng = random.Random(41)
    a = sentence(rng, 100, 10**5)
    rows = [(5, a)] * 60 + [(6, f"{a} more")] * 60
    docs, seen = docs_of(rows).coalesce(1), []
    source = docs.selectExpr("doc_id as _key", "text")
    postings = minhash_dedup._postings(source, 5, 85, np.zeros(1 << minhash_dedup.COUNTER_BITS, dtype=np.int64))
    assert postings.groupBy("value", "class").count().where("count > 1").isEmpty()
    judged = minhash_dedup._judged

    def counted(pairs, values, column, good):
        seen.append(values.count() - values.select("class").distinct().count())
        return judged(pairs, values, column, good)

    monkeypatch.setattr(minhash_dedup, "_judged", counted)
    got = minhash_dedup.near_duplicates(docs, percent=85).collect()
    assert seen and not any(seen)
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got) == [(5, 5, True)] * 60 + [(6, 5, False)] * 60
