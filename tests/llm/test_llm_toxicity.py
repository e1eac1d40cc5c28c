"""The convolutional toxicity classifier: responses and thresholds against brute force, held-out accuracy, edge cases, the sample's bounds."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from crashlens.llm import language_id, sampling, toxicity
from llm_common import docs_of, workers_path  # noqa: F401
from test_llm_dedup import lower, sentence

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
NO_LANGUAGES = language_id.Profiles([], [], np.zeros((0, 0), dtype=np.int32))


def random_model(seed=0):
    rng = np.random.default_rng(seed)
    vectors = rng.normal(size=((1 << toxicity.BITS) + 1, toxicity.DIM))
    vectors[-1] = 0
    n = len(toxicity.WIDTHS) * toxicity.FILTERS
    filters = [rng.normal(size=(w, toxicity.DIM, toxicity.FILTERS)) for w in toxicity.WIDTHS]
    return toxicity.Model(vectors, filters, rng.normal(size=n), rng.normal(size=n), 0.3, NO_LANGUAGES, np.zeros(1))


def brute_logit(model, text):
    words = WORD.findall(lower(text or ""))
    vectors = []
    for w in words:
        parts, _, _ = toxicity.hashed_words(pa.array([w]))
        own = [int(p) for p in parts[0] if p != 1 << toxicity.BITS]
        vectors.append(sum(model.vectors[p] for p in own) / len(own))
    vectors += [np.zeros(toxicity.DIM)] * 4
    pooled = []
    for f in model.filters:
        places = range(len(words) + 2)
        pooled += list(np.max([sum(vectors[p + o] @ f[o] for o in range(len(f)) if p + o < len(words)) + np.zeros(toxicity.FILTERS) for p in places], axis=0))
    return float(np.tanh(np.maximum(np.array(pooled) + model.bias, 0)) @ model.out_w + model.out_b)


def test_logits_are_those_of_brute_force():
    rng = random.Random(1)
    texts = [sentence(rng, n, 50) for n in (0, 1, 2, 3, 10, 60)] + [None, "!!", "É Üx abcdefghijkl ABCDEFGHIJKL x", "prefix prefixes pre"]
    model = random_model()
    got = toxicity.logits(model, pa.array(texts, pa.string()))
    assert np.allclose(got, [brute_logit(model, t) for t in texts])
    assert np.allclose(got, np.concatenate([toxicity.logits(model, pa.array([t], pa.string())) for t in texts]))


def test_forms_of_a_stem_share_vectors():
    parts, word, _ = toxicity.hashed_words(pa.array(["insulting insulted other"]))
    a, b, c = (set(parts[w].tolist()) - {1 << toxicity.BITS} for w in word[:3])
    assert len(a & b) == 3 and not a & c


def test_gradient_lowers_the_loss():
    rng = random.Random(2)
    texts = [sentence(rng, 30, 300) + (" nasty" if i % 4 == 0 else "") for i in range(200)]
    y = np.array([i % 4 == 0 for i in range(200)], dtype=float)
    docs = [toxicity.hashed_words(pa.array([t]))[:2] for t in texts]
    for epochs, right in ((1, 0), (15, 198)):
        weights = toxicity.fit(docs, y, epochs=epochs, dropped=0.0)
        z = toxicity.logits(toxicity.Model(*weights, NO_LANGUAGES, np.zeros(1)), pa.array(texts))
        assert ((z > 0) == (y == 1)).sum() >= right
    assert np.isfinite(z).all()


def test_threshold_is_near_that_of_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(50):
        y = (rng.random(60) < 0.3).astype(int)
        z = (rng.normal(size=60) + y).round(1)
        own = rng.random(60) < 0.5

        def error(at, of):
            out = 0
            for label in (1, 0):
                wrong = (z <= at) if label else (z > at)
                n = (of & (y == label)).sum()
                out += ((of & (y == label) & wrong).sum() + 20 * wrong[y == label].mean()) / (n + 20)
            return out

        for of in (np.zeros(60, dtype=bool), own):
            least = min(error(x, of) for x in [*z, z.min() - 1])
            # The middle of a run of gaps that are all near the least.
            assert error(toxicity.threshold(z, y, of), of) <= least + toxicity.NEAR + 0.001
    assert toxicity.threshold(np.array([1.0, 5.0]), np.array([0, 1])) == 3.0
    assert toxicity.threshold(np.array([1.0, 5.0]), np.array([1, 1])) is None
    # Few examples of a language do not move the threshold of many.
    z, y = np.concatenate([np.linspace(-3, -1, 90), np.full(40, 4.0), [3.0, -1.5, -3.0]]), np.array([0] * 90 + [1] * 40 + [1, 1, 0])
    assert 0 < toxicity.threshold(z, y, np.arange(133) >= 130) < 3


def toxic_rows(n, seed):
    """Two languages, each with its own words of abuse, some of which occur harmlessly cut."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = ("xx", "yy")[i % 2]
        body = [f"{rng.choice('bcd' if lang == 'xx' else 'klm')}{rng.choice('aeiou')}{rng.randrange(200)}" for _ in range(rng.randrange(20, 80))]
        toxic = rng.random() < 0.3
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                body.insert(rng.randrange(len(body)), {"xx": rng.choice(["grobbly", "snarfful"]), "yy": f"quezzor{rng.randrange(300)}"}[lang])
        rows.append((i, " ".join(body), lang, int(toxic)))
    return rows


def test_toxic_documents_are_found(spark):
    rows = toxic_rows(1800, 5)
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert len(model.thresholds) == 3
    got = {r.doc_id: r for r in toxicity.score(docs.drop("lang"), model).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    right = sum((got[i].score >= 0.5) == (y == 1) for i, _, _, y in held)
    assert len(held) > 240 and right >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.lang_pred in ("xx", "yy") for r in got.values())


def test_edge_cases(docs_of, spark):
    rng = random.Random(7)
    rows = [(1, None), (2, ""), (3, "?!"), (None, "some words"), (4, sentence(rng, 50_000)), (5, "copy"), (5, "copy"), (6, "copy")]
    docs = docs_of(rows).withColumnRenamed("class", "lang_pred")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 30)] + [(5, 0), (None, 1), (7, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, epochs=1)
    out = toxicity.score(docs, model)
    assert out.columns == [c for c in docs.columns if c not in ("score", "lang_pred")] + ["score", "lang_pred"]
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.text == "copy"}) == 1 and len({r.score for r in got if not (r.text or "").strip("?! ")}) == 1
    empty = toxicity.train(docs.limit(0), labels.limit(0))
    assert toxicity.score(docs.limit(0), empty).collect() == []
    assert {r.score < 0.5 for r in toxicity.score(docs, empty).collect()} == {True}


@pytest.mark.parametrize("hot", ["equal", "different"])
def test_a_hot_id_does_not_fill_the_sample(spark, hot):
    rows = [(7, f"text {i if hot == 'different' else 0}") for i in range(3000)] + [(100 + i, f"other {i}") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    labels = spark.createDataFrame([(i, i % 2) for i in [7, *range(100, 1600)]] + [(100, 1)], "doc_id long, toxic int")
    out = sampling.labelled(docs, labels, toxicity.held_out(), key="doc_id", text="text", label="toxic", sample=300).collect()
    assert 200 < len(out) < 600 and len({(r.key, r.hash, r.y) for r in out}) == len(out)
    assert all(zlib.crc32(str(r.key).encode()) % 5 for r in out)
    assert sum(r.key == 7 for r in out) <= (1 if hot == "equal" else 300)


def test_all_labelled_rows_teach(spark, monkeypatch):
    """Whatever their number and length, and though no task meets more than a few hundred of them."""
    rows = toxic_rows(1800, 8)
    rows = [(i, text + " x" * 40_000 if i % 300 == 1 else text, lang, y) for i, text, lang, y in rows]
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    teach = {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 5}
    seen = []
    monkeypatch.setattr(toxicity, "labelled", lambda *a, **k: seen.append(sampling.labelled(*a, **k)) or seen[0])
    monkeypatch.setattr(toxicity, "remove", lambda *frames: None)
    model = toxicity.train(docs, labels, shard=600)
    assert {r.key for r in seen[0].collect()} == teach and any(i % 300 == 1 for i in teach)
    got = {r.doc_id: r.score for r in toxicity.score(docs.drop("lang"), model).collect()}
    held = [r for r in rows if r[0] not in teach]
    assert sum((got[i] >= 0.5) == (y == 1) for i, _, _, y in held) >= 0.97 * len(held)


def test_counted_logits_have_the_threshold_of_their_rows():
    rng = np.random.default_rng(4)
    y = (rng.random(400) < 0.3).astype(int)
    z, own = (rng.normal(size=400) + 2 * y).round(1), rng.random(400) < 0.4
    rows, n = np.unique(np.stack([z, y, own], axis=1), axis=0, return_counts=True)
    assert toxicity.threshold(rows[:, 0], rows[:, 1], rows[:, 2] == 1, n=n) == pytest.approx(toxicity.threshold(z, y, own))


def test_nearest_language_ranks_short_runs_of_texts(monkeypatch):
    profiles = language_id.Profiles(["a", "b"], ["ab", "cd"], np.array([[0, 1600], [1600, 0]], dtype=np.int32))
    texts = pa.array([x * 700 for x in ("ab ", "cd ", "12 ", "AB x ")] * 150 + [None, "", "cd " * 100_000])
    far, _, count = language_id._Ranker(profiles).distances(texts)
    expected = np.where(count > 0, far.argmin(axis=1), -1).tolist()
    sizes, plain = [], language_id._Ranker.distances
    monkeypatch.setattr(language_id._Ranker, "distances", lambda self, x: sizes.append((len(x), x.nbytes)) or plain(self, x))
    assert language_id.nearest(profiles)(texts).tolist() == expected
    assert max(size for n, size in sizes if n > 1) < 1 << 18
    assert language_id.nearest(profiles)(texts.slice(0, 0)).tolist() == []


def test_n_grams_are_ordered_as_by_two_keys():
    rng = np.random.default_rng(5)
    for most, texts in ((9, 4), (1 << 40, 1 << 20)):  # the second has too many bits for one number
        seen, text = rng.integers(1, most, 3000), np.sort(rng.integers(0, texts, 3000))
        assert language_id._often_first(text, seen).tolist() == np.lexsort((-seen, text)).tolist()


def test_a_step_adds_up_what_each_vector_gets():
    """The first step moves every weight by the rate against its gradient's sign; a vector shared by words gets all of theirs."""
    docs = [toxicity.hashed_words(pa.array([t]))[:2] for t in ("poison poisons poisoned", "poisoning clean day", "clean days daily")]
    state = toxicity._start(np.random.default_rng(1))
    met = toxicity._met(state, docs, np.array([1.0, 1.0, 0.0]), np.random.default_rng(2), 0.5, 0.0, 0.0, decay=0.0, dropped=0.0)

    def loss(vectors):
        model = toxicity.Model(vectors, state.weights[1:-3], state.weights[-3], state.weights[-2], float(state.weights[-1][0]), NO_LANGUAGES, np.zeros(1))
        p = 1 / (1 + np.exp(-toxicity.logits(model, pa.array(["poison poisons poisoned", "poisoning clean day", "clean days daily"])).astype(float)))
        return -(np.log(p[0]) + np.log(p[1]) + np.log(1 - p[2])) / 3

    used = np.unique(np.concatenate([d[0].ravel() for d in docs]))
    used = used[used != 1 << toxicity.BITS]
    for v in used[:6]:
        for c in (0, 7):
            up, down = (state.weights[0].astype(float) for _ in range(2))
            up[v, c] += 1e-5
            down[v, c] -= 1e-5
            slope = (loss(up) - loss(down)) / 2e-5
            if abs(slope) > 1e-4:
                assert met.means[0][v, c] == pytest.approx(0.1 * slope, rel=0.02)
