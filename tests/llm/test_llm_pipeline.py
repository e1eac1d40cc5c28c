"""The pipeline's stages against brute force, and the registered queries."""

import random

import corpus_pipeline
from crashlens.llm import queries
from crashlens.llm.tables import written
from llm_common import workers_path  # noqa: F401
from test_llm_dedup import brute_repeats, corpus, groups, lower, sentence, words_of
from test_llm_text import alnum, brute_hits, junk


def small_tables(spark, folder):
    rng = random.Random(21)
    rows = [(i, t) for i, t in corpus(5) if i is not None]
    rows += [(2000 + i, f"{sentence(rng, 30)} {junk(rng, 60)}") for i in range(40)]
    items = [(i, sentence(rng, 20, 10**5)) for i in range(4)]
    rows += [(3000 + i, f"{sentence(rng, 40)} {items[i % 4][1]} {sentence(rng, 40)}") for i in range(6)]
    docs = [(i, t, "en", f"s{i % 3}", len(t) if t is not None else None) for i, t in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(not 2000 <= i < 2040), 0) for i, _ in rows], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return items


def test_stages_against_brute_force(spark, tmp_out):
    items = small_tables(spark, tmp_out)
    docs = spark.read.parquet(f"{tmp_out}/documents.parquet")
    columns = docs.columns
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, tmp_out), "test-stage")
        after = {r.doc_id: r for r in out.collect()}
        if name != "mixing":
            assert out.columns == columns
        if name == "quality classifier":
            assert not [i for i in after if 2000 <= i < 2040]
            assert [i for i in before if 100 <= i < 330] == [i for i in before if 100 <= i < 330 and i in after]
        elif name == "minhash near-dedup":
            sets = {}
            for i, r in before.items():
                w = words_of(lower(r.text))
                sets[i] = {tuple(w[a : a + 5]) for a in range(max(1, len(w) - 4))} if w else set()
            links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
            assert set(after) == {i for i, c in groups(links, list(sets)).items() if i == c}
        elif name == "substring dedup":
            want = brute_repeats([(i, r.text) for i, r in before.items()], 13)
            for i, gone in want.items():
                left = [w for w, g in zip(words_of(before[i].text), gone) if not g]
                assert (i in after) == (bool(left) or not gone)
                if i in after:
                    assert words_of(after[i].text) == left and after[i].n_chars == len(after[i].text)
                    assert after[i].text == before[i].text or any(gone)
        elif name == "benchmark decontamination":
            own = [(i, alnum(t)) for i, t in items]
            bad = set()
            for i, r in before.items():
                n, k, _ = brute_hits(r.text, own)
                if 0 < k and 20 * k >= n:
                    bad.add(i)
            assert bad and set(after) == set(before) - bad
        else:
            assert set(after) <= set(before) and out.count() > len(before) / 2
        docs, before = out, after


def test_near_duplicate_keeps_one_row_of_a_group(spark, tmp_out):
    rng = random.Random(31)
    a, b, c, d, e = (sentence(rng, 80, 10**5) for _ in range(5))
    near = lambda t: f"{t} more"
    rows = [(1, a)] * 40 + [(1, a.upper()), (2, near(a)), (None, a), (None, near(near(a)))]  # a hot row, copies with and without an id
    rows += [(3, b), (4, near(b)), (4, c)]  # one text of id 4 is a near copy of id 3, the other is alone
    rows += [(None, d)] * 3 + [(None, e), (7, near(e)), (7, near(e))]
    rows += [(8, None), (8, None), (None, ""), (9, " ")]
    full = [(i, t, "en", f"s{k % 3}", len(t) if t is not None else None) for k, (i, t) in enumerate(rows)]
    docs = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").repartition(6)
    docs = written(docs, "test-near")
    got = corpus_pipeline.near_duplicate(spark, docs, tmp_out)
    assert got.columns == docs.columns
    found = [(r.doc_id, lower(r.text) if r.text is not None else None) for r in got.collect()]
    want = [(1, a), (3, b), (4, c), (None, d), (7, near(e)), (8, None), (8, None), (None, ""), (9, " ")]
    assert sorted(map(str, found)) == sorted(map(str, want))


def test_run_gives_the_rows_of_the_stages(spark, tmp_out):
    small_tables(spark, tmp_out)
    rows = corpus_pipeline.run(spark, tmp_out)
    assert rows.columns == ["doc_id", "text", "lang", "source", "n_chars", "copy", "shuffle_key"]
    assert rows.count() > 20


def test_every_operator_has_one_query():
    names = list(queries.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert set(queries.oracle_sql()) <= set(names)


def test_stages_on_empty_tables(spark, tmp_out):
    """No documents, no labels, no benchmark: each stage gives the columns of documents, and loses nothing where there is nothing to go by."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rng = random.Random(9)
    texts = [sentence(rng, 60, 10**5) for _ in range(6)]
    docs = written(spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)] + [(9, None, None, None, None)], schema), "test-docs")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_out}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_out}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        none = stage(spark, docs.limit(0), tmp_out)
        assert none.collect() == [] and none.columns[: len(docs.columns)] == docs.columns
        if name != "mixing":
            assert sorted(r.doc_id for r in stage(spark, docs, tmp_out).collect()) == [0, 1, 2, 3, 4, 5, 9], name


def test_stages_carry_other_columns(spark, tmp_out):
    items = small_tables(spark, tmp_out)
    docs = spark.read.parquet(f"{tmp_out}/documents.parquet")
    more = ["class", "component", "block", "salt", "hash", "value", "place", "key", "row"]
    wide = written(docs.select("*", *[docs.doc_id.cast("string").alias(c) for c in more]), "test-wide")
    assert items
    for _, stage in corpus_pipeline.STAGES:
        wide = written(stage(spark, wide, tmp_out), "test-wide")
        rows = wide.collect()
        assert rows and all(r[c] == str(r.doc_id) for r in rows for c in more)
