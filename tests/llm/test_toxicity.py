"""Nearest examples against all cosines; held-out accuracy."""

import random

import numpy as np
from pyspark.sql import functions as F

from staylens.llm import queries
from staylens.llm import toxicity as T


def world(n=400, seed=1):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(60)]
    bad = ["grot", "scunge", "vileness", "mucky"]
    texts, labels = [], []
    for i in range(n):
        w = [rng.choice(words) for _ in range(rng.randrange(10, 60))]
        y = int(i % 4 == 0)
        for _ in range(rng.randrange(1, 5) if y else 0):
            w.insert(rng.randrange(len(w)), rng.choice(bad) + rng.choice(["", ",", "!"]))
        texts.append(" ".join(w))
        labels.append(y)
    return texts, labels, bad


def test_blocks_find_the_exact_nearest():
    rng = np.random.default_rng(2)
    v = rng.random((700, 30)) * (rng.random((700, 30)) < .2)
    v = v[v.any(axis=1)]
    v /= np.linalg.norm(v, axis=1)[:, None]
    index = T.Index({}, np.ones(30), v, list(range(len(v))), np.zeros(len(v)), 0, 0)
    index.highest = np.array([v[b:b + T.BLOCK].max(axis=0) for b in range(0, len(v), T.BLOCK)]).T
    for q in v[:100]:
        best, cosines = index.nearest(q, 10)
        every = v @ q
        want = np.lexsort((np.arange(len(v)), -np.round(every, 12)))[:10]
        want = want[every[want] > 0]
        assert best.tolist() == want.tolist() and np.allclose(cosines, every[want])


def test_terms_are_the_telling_words():
    texts, labels, bad = world()
    copies = ["the same copied quixotic text again"] * 30
    terms = T.telling_terms(texts + copies, np.array(labels + [1] * 30))
    assert set(bad) <= set(terms) and "quixotic" not in terms and len(terms) < 12


def test_cosines_cover_every_word(spark, make_docs):
    texts, labels, _ = world(150)
    probe = [" ".join(t.split()[:6]) + " unheard unheard, of" for t in texts[:40]]  # mostly no telling word
    index = T.build(list(range(150)), texts, labels, frequent=20)
    table = spark.createDataFrame(list(enumerate(labels)), "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in T.toxicity(spark, make_docs(texts + probe), table).collect()}
    assert len(index.starts) > 30 and len(index.factors) == len(index.terms) + 1 > 60

    def vector(text):
        words = [w for w in map(T.plain, text.split()) if w]
        return {w: (1 + np.log(words.count(w))) * index.factors[index.terms.get(w, -1)] for w in words}
    def cosine(a, b):
        return sum(v * b.get(w, 0) for w, v in a.items()) / np.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))
    examples = [vector(t) for t in texts]
    where = {e: i for i, e in enumerate(index.ids)}
    for i, t in enumerate(probe):
        every = [cosine(vector(t), e) for e in examples]
        want = sorted(range(150), key=lambda j: (-round(every[j], 9), where[j]))[:3]
        found = got[150 + i]["evidence"]
        assert np.allclose([e["cosine"] for e in found], [every[j] for j in want]) and got[150 + i]["n_terms"] == 6
        assert np.allclose([every[e["example_id"]] for e in found], [every[j] for j in want])


def test_isotonic_rises():
    rng = np.random.default_rng(1)
    x = rng.random(200)
    xs, ys = T.isotonic(x, (rng.random(200) < x).astype(float))
    assert (np.diff(xs) >= 0).all() and (np.diff(ys) >= -1e-12).all() and abs(np.interp(.5, xs, ys) - .5) < .25


def test_scores_and_awkward_rows(spark, make_docs, sample_texts):
    texts, labels, _ = world()
    docs = make_docs(texts + sample_texts + ["you grot, scunge!"])
    table = spark.createDataFrame([(i, y, None) for i, y in enumerate(labels) if i % 5] + [(None, 1, ""), (3, None, ""), (1, 0, "")],
                                  "doc_id long, toxic int, text string")
    got = T.toxicity(spark, docs, table).collect()
    assert len(got) == docs.count()
    by = {r["doc_id"]: r for r in got}
    assert sum((by[i]["score"] >= .5) == (labels[i] == 1) for i in range(0, len(texts), 5)) >= .97 * len(texts) / 5
    last = by[len(texts) + len(sample_texts)]
    assert last["score"] > .5 and last["evidence"][0]["label"] == 1 and last["n_terms"] == 2
    assert all(0 <= r["score"] <= 1 for r in got) and by[len(texts)]["evidence"] == []
    assert {r["score"] for r in T.toxicity(spark, docs, table.where("false")).collect()} == {0.0}
    assert T.toxicity(spark, docs.where("false"), table).count() == 0


def test_folds_choose_the_weighing():
    texts, labels, _ = world()
    losses = {w: T.fold_loss(list(range(len(texts))), texts, labels, w) for w in (T.WEIGHING, 1e9)}
    assert losses[T.WEIGHING] < losses[1e9] < 0.7
    assert T.fold_loss([], [], []) == 0.0 and T.fold_loss([1], ["a"], [1]) > 0
    assert np.isfinite(T.fold_loss([1, 2, 3, 4], ["", "a b", "...", "a c"], [0, 1, 0, 1]))


def test_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op1_toxicity(spark, sf)
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    rows = got.where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").select("toxic", "score", "predicted").collect()
    good = [r["score"] for r in rows if r["toxic"] == 0]
    bad = [r["score"] for r in rows if r["toxic"] == 1]
    assert np.mean([a < b for a in good for b in bad]) > .8
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) > .93
