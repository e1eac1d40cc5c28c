"""Mixing, language, quality, decontamination, licences, token counts and page text: brute force, held-out accuracy, edge cases."""

import hashlib
import math
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from crashlens.llm import html_text, language_id, licenses, quality, queries, token_counts
from crashlens.llm.decontaminate import contamination, occurrences
from crashlens.llm.mixing import mix, source_rates
from crashlens.llm.queries import PATTERN, VOCABULARY
from llm_common import docs_of, workers_path  # noqa: F401
from test_llm_dedup import lower, sentence

ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def alnum(text):
    return ALNUM.findall(lower(text))


# --- mixing


def uniform(*parts):
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:13], 16) / 2**52


def copies(u, rate):
    k, cdf = 0, math.exp(-rate)
    while cdf <= u:
        k += 1
        cdf += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
    return k


def test_mixing_inverts_the_poisson_distribution(spark):
    rows = [(i, f"t{i}", "big" if i % 3 else f"s{i % 7}") for i in range(600)] + [(700, None, None), (None, "n", "s1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("copy", F.lit("old"))
    rates = {r["_source"]: r["rate"] for r in source_rates(docs).collect()}
    n = {s: sum(r[2] == s for r in rows) for s in rates}
    total = sum(math.sqrt(x) for x in n.values())
    for s, rate in rates.items():
        assert rate == pytest.approx(math.sqrt(n[s]) / total * len(rows) / n[s])
    want = []
    for i, t, s in rows:
        for c in range(1, copies(uniform("mix", "" if i is None else i), rates[s]) + 1):
            want.append((i, t, s, c, uniform("mix-order", "" if i is None else i, c)))
    got = mix(docs)
    assert got.columns == ["doc_id", "text", "source", "copy", "shuffle_key"]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    order = [r.shuffle_key for r in got.collect()]
    assert order == sorted(order)


def test_mixing_to_given_weights(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "case when id % 4 = 0 then 'a' when id % 4 = 1 then 'b' else 'c' end as source")
    got = {r.source: r.n for r in mix(docs, {"a": 3, "b": 1}).groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert set(got) == {"a", "b"}
    assert abs(got["a"] - 3000) < 250 and abs(got["b"] - 1000) < 150
    assert mix(docs.limit(0)).collect() == []


def test_mixing_splits_large_rates(spark):
    docs = spark.range(3).selectExpr("id as doc_id", "'a' as source")
    got = mix(docs, {"a": 1}, rows=900.0).collect()  # exp(-900) is no double
    want = []
    for i in range(3):
        for part in range(1, 30):  # 900 / 32, rounded up
            want += [(i, (part - 1) * 128 + c) for c in range(1, copies(uniform("mix", i, part), 900 / 29) + 1)]
    assert sorted((r.doc_id, r["copy"]) for r in got) == want and abs(len(want) - 2700) < 300
    one = spark.createDataFrame([(1, "rare")], "doc_id long, source string").unionByName(spark.range(2, 5002).selectExpr("id as doc_id", "'common' as source"))
    many = mix(one, {"rare": 1.0, "common": 0.01}, rows=20.0)  # a rate of 99,000 for one row
    assert abs(many.where("source = 'rare'").count() - 99_000) < 2_000
    assert many.where("source = 'rare'").select("copy").distinct().count() == many.where("source = 'rare'").count()


def test_rows_that_share_an_id_draw_each_for_itself(spark):
    same = spark.range(2000).selectExpr("cast(null as long) as doc_id", "'copy' as text", "'none' as source")
    hot = spark.range(3000).selectExpr("7L as doc_id", "cast(id as string) as text", "'hot' as source")
    rest = spark.range(100, 2100).selectExpr("id as doc_id", "'x' as text", "'rest' as source")
    docs = same.unionByName(hot).unionByName(rest).repartition(5)
    mixed = mix(docs, {"none": 2000, "hot": 6000, "rest": 1000}, rows=9 / 7)
    got = {r.source: r.n for r in mixed.groupBy("source").agg(F.count("*").alias("n")).collect()}
    for name, n in (("none", 2000), ("hot", 6000), ("rest", 1000)):
        assert abs(got[name] - n) < 6 * n**0.5
    assert mixed.select("shuffle_key").distinct().count() == mixed.count()


def test_mixing_keeps_columns_of_any_name(spark):
    names = ["doc_id", "source", "row", "key", "place", "parts", "steps", "u", "n", "id", "several", "_u", "_steps", "_source", "_copies", "part", "i"]
    docs = spark.createDataFrame([(k, "s", *[f"{c}{k}" for c in names[2:]]) for k in range(50)], ", ".join(f"`{c}` {'long' if c == 'doc_id' else 'string'}" for c in names))
    got = mix(docs, rows=2.0)
    assert got.columns == [*names, "copy", "shuffle_key"]
    assert all(tuple(r)[2:17] == tuple(f"{c}{r.doc_id}" for c in names[2:]) for r in got.collect())


# --- decontamination


def brute_hits(text, items, window=13):
    words, found, hit = alnum(text), set(), set()
    for item, own in items:
        if item is None or not own:
            continue
        n = min(window, len(own))
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)}
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in windows:
                found.add(str(item))
                hit.update(range(i, i + n))
    return len(words), len(hit), sorted(found)


def test_contamination_is_that_of_brute_force(spark, docs_of):
    rng = random.Random(2)
    items = [(i, sentence(rng, 30, 5000)) for i in range(10)] + [(10, "tiny item"), (11, "Word"), (12, ""), (13, None), (None, sentence(rng, 20)), (2, sentence(rng, 15, 5000))]
    items += [(14, "é" + sentence(rng, 12, 5000)), (0, items[0][1])]
    rows = [(i, sentence(rng, rng.randrange(0, 200), 3000)) for i in range(40)]
    for i in range(30):
        own = (items[i % 10][1] or "").split()
        part = own[rng.randrange(0, 12) :][: rng.randrange(10, 25)]
        rows.append((100 + i, f"{sentence(rng, 60)}, {'-'.join(part).upper()}! {sentence(rng, rng.randrange(0, 300))}"))
    rows += [(200, None), (201, ""), (202, "a tiny, ITEM here"), (203, "word" * 3), (204, "Word word wOrd"), (205, items[0][1]), (205, "other"), (None, items[1][1])]
    rows += [(206, " ".join(items[3][1].split()[:12])), (207, items[-2][1])]
    bench = spark.createDataFrame([(i, t, "q") for i, t in items], "item_id long, text string, window string")
    got = contamination(docs_of(rows), bench).collect()
    assert len(got) == len(rows)
    words = [(i, alnum(t)) for i, t in items]
    want = sorted((str(i), n, k, found, 0 < k and 20 * k >= n) for i, t in rows for n, k, found in [brute_hits(t, words)])
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in got) == want
    assert sum(r.contaminated for r in got) > 15


def test_items_without_an_id_contaminate(spark, docs_of):
    rng = random.Random(3)
    a, b = sentence(rng, 15, 5000), sentence(rng, 20, 5000)
    bench = spark.createDataFrame([(None, a), (7, b), (None, b)], "item_id long, text string")
    got = contamination(docs_of([(1, f"x {a} y"), (2, f"x {b}"), (3, "clean")]), bench).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in got] == [(17, 15, [], True), (21, 20, ["7"], True), (1, 0, [], False)]


def test_contamination_without_items_or_documents(spark, docs_of):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert [(r.n_words, r.n_hit, r.contaminated) for r in contamination(docs_of([(1, "a b"), (2, None)]), bench).orderBy("doc_id").collect()] == [(2, 0, False), (0, 0, False)]
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert occurrences(docs_of([(1, "x")]).limit(0), some).collect() == []


# --- language

LANGUAGES = {
    "en": "the of and to in that is was for with as his on be at by this had not are but from or have an they which one you were",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach",
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec son mais comme nous être",
}


def test_language_held_out_accuracy_and_edge_cases(spark):
    rng = random.Random(5)
    rows = []
    for i in range(240):
        lang = list(LANGUAGES)[i % 3]
        rows.append((i, " ".join(rng.choice(LANGUAGES[lang].split()) for _ in range(rng.randrange(5, 80))), lang))
    rows += [(1000, None, "en"), (1001, "", "de"), (1002, "12 34 !?", "fr"), (1003, "the of", None), (None, "und der die das", "de"), (1004, "日本語", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("old"))
    profiles = language_id.learn(docs)
    assert profiles.languages == ["de", "en", "fr"]
    got = language_id.identify(docs, profiles)
    assert got.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    found = {r.doc_id: r for r in got.collect()}
    held = [i for i in range(240) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert held and sum(found[i].lang_pred == found[i].lang for i in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in found.values())
    assert [found[i].lang_pred for i in (1000, 1001, 1002, 1003, None)] == ["und", "und", "und", "en", "de"]
    assert found[1004].lang_pred in profiles.languages and found[1004].score == 0
    none = language_id.learn(docs.limit(0))
    assert {r.lang_pred for r in language_id.identify(docs, none).collect()} == {"und"}
    assert language_id.identify(docs.limit(0), profiles).collect() == []


def brute_grams(text, ranked):
    """The n-grams of a text from its words, most frequent first, then by spelling."""
    words = re.findall(r"[^\W\d_]+", text.lower())
    found = Counter()
    for w in words:
        marked = f" {w} "
        found.update(w)
        found.update(marked[i : i + 2] for i in range(len(marked) - 1))
        found.update(marked[i : i + 3] for i in range(len(marked) - 2))
    return sorted(found, key=lambda g: (-found[g], g))[:ranked]


@pytest.mark.parametrize("ranked", [10, 300])
def test_language_distance_is_out_of_place(monkeypatch, ranked):
    monkeypatch.setattr(language_id, "RANKED", ranked)
    rng = random.Random(3)
    own = {"x": ["a", "b", "ab", " ab"], "y": ["b", " ab", "ü", "zz"], "z": ["q"]}
    grams = sorted({g for x in own.values() for g in x})
    ranks = np.full((3, len(grams)), 4 * language_id.PROFILE, dtype=np.int32)
    for row, some in enumerate(own.values()):
        for rank, g in enumerate(some):
            ranks[row, grams.index(g)] = rank
    profiles = language_id.Profiles(list(own), grams, ranks)
    texts = ["ab a!", "", None, "zz ü 12 b", "日本語 ab", "Über ab AB b", " ".join("".join(rng.choice("abüzqé日") for _ in range(rng.randrange(1, 6))) for _ in range(3000))]
    texts += ["".join(chr(c) for c in range(0x4E00, 0x9000)) + " ab ab"]  # so many letters that texts are ranked apart
    far, n, letters = language_id._Ranker(profiles).distances(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        order = brute_grams(text or "", ranked)
        assert n[i] == len(order) and letters[i] == sum(c.isalpha() for c in (text or "").lower())
        for row, some in enumerate(own.values()):
            assert far[i, row] == sum(min(abs(some.index(g) - place), language_id.PROFILE) if g in some else language_id.PROFILE for place, g in enumerate(order))


def test_language_memory_follows_the_text_not_the_languages():
    rng = random.Random(8)
    grams = sorted({"".join(rng.choice("abcdefghijklmnopqrstuvwxyzäöüéèß") for _ in range(rng.randrange(1, 4))) for _ in range(20_000)})
    ranks = np.full((100, len(grams)), 4 * language_id.PROFILE, dtype=np.int32)
    for row in range(100):
        ranks[row, rng.sample(range(len(grams)), language_id.PROFILE)] = np.arange(language_id.PROFILE)
    ranker = language_id._Ranker(language_id.Profiles([f"l{i:03}" for i in range(100)], grams, ranks))
    texts = pa.array([sentence(rng, 3) + " abc" for _ in range(5000)])
    tracemalloc.start()
    ranker.distances(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6


# --- quality


def junk(rng, n):
    return " ".join(f"{w}$$$" for w in sentence(rng, n).split())


def test_quality_held_out_accuracy_and_edge_cases(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(300):
        good = i % 4 > 0
        body = sentence(rng, rng.randrange(20, 300))
        rows.append((i, body if good else f"{body} {junk(rng, 80)}"))
        labels.append((i, int(good), None))
    rows += [(900, None), (901, ""), (902, "\n"), (903, "x " * 20000), (None, "text"), (5, rows[5][1])]
    labels += [(900, 1, 0), (901, None, 1), (None, 0, 0), (5, labels[5][1], 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("top_passage", F.lit("old"))
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality.train(docs, marks)
    got = quality.score(docs, model)
    assert got.columns == ["doc_id", "text", "score", "n_passages", "top_passage"]
    found = {r.doc_id: r for r in got.collect()}
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((found[i].score >= 0.3) == (i % 4 > 0) for i in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in found.values()) and got.count() == len(rows)
    assert found[903].n_passages == math.ceil(20000 / quality.PASSAGE) and found[900].n_passages == 1
    for i in held:  # attention goes to the junk at the end
        if i % 4 == 0 and found[i].n_passages > 2:
            assert found[i].top_passage >= 1
    bare = quality.train(docs, marks.limit(0))
    assert quality.score(docs, bare).count() == len(rows)
    assert quality.score(docs.limit(0), model).collect() == []


def test_quality_gradient():
    """The loss falls along the gradient of a small model."""
    rng = quality.np.random.default_rng(1)
    x, first, y = rng.normal(size=(40, quality.FEATURES)), quality.np.arange(0, 41, 4), (quality.np.arange(10) % 2).astype(float)

    def loss(steps):
        p = quality.forward(quality.fit(x, first, y, steps=steps, decay=0), x, first)[0]
        return -(y * quality.np.log(p) + (1 - y) * quality.np.log(1 - p)).mean()

    assert loss(100) < 0.2 * loss(1)


# --- licences


def brute_licences(text, dice):
    sets = {n: {tuple(alnum(t)[i : i + 2]) for i in range(len(alnum(t)) - 1)} for n, t in licenses.TEMPLATES.items()}
    paragraphs = [p for p in re.split(r"\n(?:[ \t]*\n)+", text or "") if p.strip()]
    found = set()
    for part in [*(text or "").split("\n"), *paragraphs, "\n".join(paragraphs)]:
        w = alnum(part)
        own = {tuple(w[i : i + 2]) for i in range(len(w) - 1)}
        best = max(((2 * len(own & s) / (len(own) + len(s)), n) for n, s in sets.items()), key=lambda x: x[0])
        if own and best[0] >= dice:
            found.add(best[1])
    return found


def test_licences_are_those_of_brute_force(docs_of):
    rng = random.Random(8)
    rows = []
    for i, (name, text) in enumerate(sorted(licenses.TEMPLATES.items()) * 3):
        w = text.split()
        if i % 3 == 1:
            w[rng.randrange(len(w))] = "changed"
        body = " ".join(w) if i % 2 else "\n".join(" ".join(w[a : a + 8]) for a in range(0, len(w), 8))
        rows.append((i, f"{sentence(rng, 20)}\n\n{body}\n\n{sentence(rng, 9)}"))
    rows += [(100, None), (101, ""), (102, "MIT"), (103, "released UNDER the mit-license"), (104, sentence(rng, 3000)), (105, "a b\n" * 50)]
    got = {r.doc_id: r for r in licenses.scan(docs_of(rows)).collect()}
    for i, text in rows:
        raw = (text or "").encode()
        assert {m.licence for m in got[i].matches} == brute_licences(text, 0.8), i
        for m in got[i].matches:
            assert m.dice >= 0.8 and 0 <= m.start < m.end <= len(raw)
    assert sum(len(r.matches) > 0 for r in got.values()) > 25
    assert licenses.scan(docs_of(rows).limit(0)).collect() == []
    assert got[0]["class"] == "x"


def test_a_long_list_of_licence_lines_takes_linear_time(spark):
    name, text = next((n, t) for n, t in licenses.TEMPLATES.items() if t)
    took = []
    for n in (1000, 4000):
        docs = spark.createDataFrame([(1, "\n".join(text for _ in range(n)))], "doc_id long, text string")
        start = time.time()
        assert len(licenses.scan(docs).first().matches) >= n
        took.append(time.time() - start)
    assert took[1] < 12 * max(took[0], 0.5)


def test_licences_inside_lines_and_comments(docs_of):
    rng = random.Random(9)
    full = licenses.TEMPLATES
    gpl = full["GPL-3.0-or-later notice"].split()
    header = "\n".join([" * x.c: " + sentence(rng, 6), " *", *(" * " + " ".join(gpl[a : a + 9]) for a in range(0, len(gpl), 9)), " *", " * " + sentence(rng, 60), " */", sentence(rng, 30)])
    rows = [
        (1, "This software is released under the MIT License, see the LICENSE file.", ["MIT"]),
        (2, "Copyright 2021 Example Authors. Licensed under the Apache License, Version 2.0. See the LICENSE file.", ["Apache-2.0"]),
        (3, f"{sentence(rng, 300)} {full['MIT text']} {sentence(rng, 400)} {full['Apache-2.0 notice']} {sentence(rng, 9)}", ["Apache-2.0 notice", "MIT text"]),
        (4, header, ["GPL-3.0-or-later notice"]),
        (5, header.replace(" * ", " # ").replace(" *", " #"), ["GPL-3.0-or-later notice"]),
        (6, f"{sentence(rng, 40)} {full['CC-BY-SA-4.0']} {sentence(rng, 40)}\n{full['ISC']}", ["CC-BY-SA-4.0", "ISC"]),
        (7, f"{sentence(rng, 40)} released under licence of the MIT", []),
        (8, " ".join(["we are released under the MIT License"] * 3), ["MIT"] * 3),
        (9, f"{sentence(rng, 5)} released under", []), (10, f"the MIT License {sentence(rng, 5)}", []),
    ]
    got = {r.doc_id: r.matches for r in licenses.scan(docs_of([r[:2] for r in rows])).collect()}
    for i, text, want in rows:
        assert sorted(m.licence for m in got[i]) == want, i
        for m in got[i]:
            assert m.dice == 1 and alnum(text.encode()[m.start : m.end].decode()) == alnum(full[m.licence])


# --- token counts

HOW = {"path": VOCABULARY, "pattern": PATTERN}


def random_text(rng, n):
    return "".join(rng.choice(["word", " ", "  ", "\n", "é", "'re", "'", "12", "!", " the", ". ", "\t", "日本", "x"]) for _ in range(n))


def test_counts_after_edits_equal_a_full_count():
    count = token_counts.tokenizer(VOCABULARY, PATTERN)
    rng = random.Random(3)
    for case in range(60):
        text = random_text(rng, rng.choice([0, 1, 30, 3000]))
        pieces = token_counts.segments(text)
        assert "".join(pieces) == text and sum(count(pieces)) == count([text])[0]
        tree = token_counts.Tree.of([len(p) for p in pieces], count(pieces))
        for _ in range(8):
            edit = (rng.randrange(len(text) + 3), rng.choice([0, 1, 5, 700]), random_text(rng, rng.choice([0, 1, 3, 4000 if case % 9 == 0 else 5])))
            at, end = min(edit[0], len(text)), min(len(text), min(edit[0], len(text)) + edit[1])
            want = text[:at] + edit[2] + text[end:]
            text, tree, encoded = token_counts.apply(text, tree, [edit], count)
            assert text == want
            assert (int(tree.chars[1]), int(tree.tokens[1])) == (len(text), count([text])[0]), (case, edit)
    long = sentence(rng, 20000)
    pieces = token_counts.segments(long)
    tree = token_counts.Tree.of([len(p) for p in pieces], count(pieces))
    assert token_counts.apply(long, tree, [(len(long) // 2, 3, "new words")], count)[2] < 4 * token_counts.SEGMENT


def test_token_tables(docs_of):
    rng = random.Random(4)
    rows = [(i, sentence(rng, 200) + (f" mail a{i}@b.example.com or +1 (988) 555-24{i % 10}5 " if i % 3 == 0 else "")) for i in range(20)]
    rows += [(50, None), (51, ""), (3, rows[3][1]), (3, "other 1.2.3.4"), (None, "x 10.20.30.40 y")]
    docs, count = docs_of(rows), token_counts.tokenizer(VOCABULARY, PATTERN)
    trees = token_counts.build(docs, **HOW)
    assert sorted((str(r.doc_id), r.n_tokens) for r in trees.collect()) == sorted((str(i), count([t or ""])[0]) for i, t in rows)
    got = token_counts.update(docs, trees, token_counts.redactions(docs), **HOW).collect()
    assert {r.doc_id for r in got} == {0, 3, 6, 9, 12, 15, 18}
    for r in got:
        assert "@" not in r.text and r.n_edits >= 1 and r.n_tokens == count([r.text])[0] == sum(r.tokens)
    empty = docs.limit(0)
    assert token_counts.update(empty, token_counts.build(empty, **HOW), token_counts.redactions(empty), **HOW).collect() == []


def test_token_query_has_one_row_for_each_document_row(docs_of, tmp_out):
    rows = [(1, "mail a@b.example.com now")] * 5 + [(1, "other 1.2.3.4"), (1, "plain"), (2, None), (None, "x 10.20.30.40 y"), (None, "x 10.20.30.40 y"), (None, "z c@d.example.com"), (None, None)]
    docs_of(rows).repartition(4).write.parquet(f"{tmp_out}/documents.parquet")
    got = queries.op9_token_counts(docs_of(rows).sparkSession, tmp_out)
    assert got.columns == ["doc_id", "n_tokens", "n_tokens_edited", "n_edits", "n_encoded"]
    count = token_counts.tokenizer(VOCABULARY, PATTERN)
    want = []
    for i, text in rows:
        new, n = text or "", 0
        for mark, pattern in token_counts.PERSONAL.items():
            new, k = re.subn(pattern, mark, new)
            n += k
        want.append((i, *count([text or "", new]), n, n > 0))
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.n_tokens, r.n_tokens_edited, r.n_edits, r.n_encoded > 0)) for r in got.collect())


# --- page text


def test_blocks_of_broken_pages():
    page = "<html><head><title>T</title><script>x</script></head><body><nav><a href=#>Home</a></nav><p>a &amp; b<br>c<p>d\n  e</p>&eacute;<!-- no --><div>f<b>g</b>"
    got = html_text.blocks(page)
    assert [b.text for b in got] == ["Home", "a & b c", "d e", "é", "fg"]
    assert got[0].tags == ("html", "body", "nav") and got[0].linked == 1 and got[2].tags == ("html", "body", "p")
    assert html_text.blocks(None) == html_text.blocks("") == html_text.blocks("<p> </p><script>a") == []


@pytest.mark.parametrize("page, want", [
    ("<article><svg/>lost text<p>ok</p>more</article>", ["lost text", "ok", "more"]),
    ("<p>Let <math>x</math> be <svg/> and more text</p>", ["Let x be and more text"]),
    ("<p>a <svg><title>t</title><path d='x'/><text>label</text></svg> b<br/>c</p>", ["a label b c"]),
    ("<article>a <noscript>b</noscript> <object>c</object> <button>d</button> <textarea>e</textarea></article>", ["a b c d e"]),
    ("<div/>x<p/>y<script/>z<style>s</style><template><p>t</p></template>w", ["x", "yz", "w"]),
    ("<table><tr><td>1<td>2<tr><th>3</table><dl><dt>k<dd>v</dl><ul><li>i<li>j</ul>", ["1", "2", "3", "k", "v", "i", "j"]),
])
def test_blocks_drop_only_what_no_page_shows(page, want):
    assert [b.text for b in html_text.blocks(page)] == want


def brute_best(field, page):
    import itertools

    emit = [field.bias + sum(field.weight[field.index[f]] for f in html_text.features(b) if f in field.index) for b in page]

    def value(labels):
        out = field.first[labels[0]] + sum(e for e, y in zip(emit, labels) if y)
        return out + sum(field.pair[a, b] for a, b in zip(labels, labels[1:]))

    return max(value(y) for y in itertools.product((0, 1), repeat=len(page))), value


def test_field_on_held_out_pages_of_other_layouts():
    rng = random.Random(12)
    other = [sentence(rng, rng.randrange(1, 30)) for _ in range(200)]

    def pages(n):
        out = []
        while len(out) < n:
            laid, kept = html_text.relaid(rng, [sentence(rng, rng.randrange(5, 60), 10**6) for _ in range(rng.randrange(1, 9))], other)
            own = html_text.blocks(laid)
            out.append((own, [int(b.text in kept) for b in own]))
        return out

    field = html_text.fit(pages(300), steps=80)
    held = pages(60)
    right = sum(a == b for page, labels in held for a, b in zip(html_text.decode(field, page), labels))
    assert right >= 0.97 * sum(len(p) for p, _ in held)
    for page, _ in held[:20]:
        if 0 < len(page) <= 12:
            best, value = brute_best(field, page)
            assert value(html_text.decode(field, page)) == pytest.approx(best)


def test_pages(spark):
    rng = random.Random(13)
    rows, want = [], {}
    for i in range(40):
        text = [sentence(rng, rng.randrange(3, 40)) for _ in range(rng.randrange(1, 6))]
        want[i] = "\n\n".join(text)
        body = "".join(f"<p>{t}</p>" for t in text)
        end = "" if i % 5 == 0 else "</body></html>"
        rows.append((i, f"http://h/{i}", f"<html><body><nav><a href='/'>{sentence(rng, 2)}</a></nav><article>{body}</article><footer>&copy; {sentence(rng, 5)}</footer>{end}"))
    rows += [(100, None, None), (101, "u", ""), (102, "u", "<script>x</script>"), (None, "u", rows[0][2]), (0, "http://h/0", rows[0][2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("n_blocks", F.lit("old"))
    pages = pages.withColumns({c: F.lit("own") for c in ("_html", "_html0", "k", "h")})
    got = html_text.extract(pages, html_text.train(pages, layouts=1))
    assert got.columns == ["page_id", "url", "_html", "_html0", "k", "h", "text", "n_blocks", "n_kept"]
    found = [(r.page_id, r.url, r.text, r.n_blocks, r.n_kept) for r in got.collect()]
    assert len(found) == len(rows)
    for i, _, text, *_ in found:
        assert text == (want[i] if i in want else want[0] if i is None else "")
    assert html_text.extract(pages.limit(0), html_text.train(pages.limit(0))).collect() == []
