"""Classes against all pairs compared by brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from staylens.llm import components as C
from staylens.llm import ngram_join as J


def brute_sets(texts):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def brute(ids, texts):
    found = brute_sets(texts)
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(texts)):
        for j in range(i):
            both = len(found[i] & found[j])
            if found[i] and 100 * both >= 80 * len(found[i] | found[j]) and find(i) != find(j):
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(len(s), least.get(find(i))) for i, s in enumerate(found)]


def brute_links(texts):
    """Per text, its linked texts and the different sets among them; and the links of different sets."""
    found = brute_sets(texts)
    linked = [[j for j, t in enumerate(found) if j != i and s and 100 * len(s & t) >= 80 * len(s | t)] for i, s in enumerate(found)]
    counts = [(len(js), len({frozenset(found[j]) for j in js} - {frozenset(found[i])})) for i, js in enumerate(linked)]
    least = {}
    for i, s in enumerate(found):
        least.setdefault(frozenset(s), i)
    name = lambda i: least[frozenset(found[i])]
    pairs = {(name(i), name(j), len(found[i] & found[j]), len(found[i]), len(found[j]))
             for i, js in enumerate(linked) for j in js if name(i) < name(j)}
    return counts, pairs


def corpus(seed, n=260):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + rng.choice("klmnop") + rng.choice("qrstuv")
    lines = [" ".join(word() for _ in range(rng.choice([8, 14, 30]))) for _ in range(6)]
    texts = []
    for _ in range(n):
        kind = rng.random()
        if kind < .45 and texts:  # an edited copy: near the threshold for about half of them
            w = rng.choice(texts).split()
            for _ in range(rng.randrange(0, max(2, len(w) // 22))):
                w[rng.randrange(len(w))] = word()
            texts.append(" ".join(w[rng.randrange(0, 4):]) or "x")
        elif kind < .6:  # little but shared lines
            texts.append("\n".join(rng.sample(lines, 3) + [word()]))
        elif kind < .65 and texts:
            texts.append(rng.choice(texts).upper())
        else:
            texts.append(" ".join([*(word() for _ in range(rng.randrange(1, 120))), *rng.sample(lines, rng.randrange(2))]))
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_equal_all_pairs(spark, make_docs, seed):
    texts = corpus(seed)
    got = J.join_classes(spark, make_docs(texts)).collect()
    ids = [*range(len(texts)), None]
    want = dict(zip(ids, brute(ids, [*texts, "no id here"])))
    assert len(got) == len(ids) and len({v for _, v in want.values()}) < len(texts) * .8
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


def test_matrix_alone_finds_all_links(spark, make_docs, monkeypatch):
    """Without stars each class is a family, and the matrix has to find every link."""
    monkeypatch.setattr(J, "_stars", lambda rows, percent: rows.limit(0).selectExpr("cls a", "cls b"))
    texts = corpus(3, 160)
    got = {r["doc_id"]: r["component_id"] for r in J.join_classes(spark, make_docs(texts)).collect()}
    ids = [*range(len(texts)), None]
    assert got == {i: c for i, (_, c) in zip(ids, brute(ids, [*texts, "no id here"]))}


@pytest.mark.parametrize("tokens", [1 << 17, 600])
def test_no_link_is_lost(spark, make_docs, monkeypatch, tokens):
    """Links inside a family too, in one chunk and over many of a few sets each."""
    monkeypatch.setattr(J, "CHUNK_TOKENS", tokens)
    texts = corpus(4, 200)
    counts, pairs = brute_links(texts)
    docs = make_docs(texts)
    got = {r["doc_id"]: (r["n_links"], r["n_class_links"]) for r in J.join_classes(spark, docs).collect()}
    assert got == {**dict(enumerate(counts)), None: (0, 0)} and max(counts)[0] > 8
    rows = J.class_links(spark, docs).collect()
    assert len(rows) == len(pairs) > 50 and {tuple(r) for r in rows} == pairs


def test_awkward_rows(spark, make_docs, sample_texts):
    texts = sample_texts + ["same few words", "Same few\nwords", "same few"]
    docs = make_docs(texts, [(None, "same few words", None, None, None, 0), (7, None, None, None, None, 0)])
    got = J.join_classes(spark, docs).collect()
    ids = [*range(len(texts)), None, None, 7]
    want = sorted(zip(map(str, ids), *zip(*[(n, str(c) if n else str(d)) for d, (n, c) in zip(
        ids, brute(ids, [*texts, "no id here", "same few words", None]))])))
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == want
    assert J.join_classes(spark, docs.where("false")).count() == 0


def test_shared_tokens_over_small_batches(spark):
    rng = random.Random(9)
    rows = [(rng.randrange(40) ** 2 // 20, rng.randrange(3), rng.randrange(30)) for _ in range(900)]
    rows = sorted({(t, c % 3 if t % 3 else 1, c) for t, _, c in rows})
    want = {}
    for t, lab, c in rows:
        if len({x for u, x, _ in rows if u == t}) > 1:
            want[c] = want.get(c, 0) + 1
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        df = spark.createDataFrame(rows, "token long, label long, cls long")
        assert {r["cls"]: r["shared"] for r in J.shared_tokens(df).collect()} == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)


def test_components(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)]
    got = {r["node"]: r["root"] for r in C.components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(200):
        for a, b in edges:
            if a != b:
                want[a] = want[b] = min(want[a], want[b])
    assert got == want
