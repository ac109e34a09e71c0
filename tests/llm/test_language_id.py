"""Automata and parses against brute force; accuracy on held-out rows."""

import numpy as np
from pyspark.sql import functions as F

from staylens.llm import language_id as L
from staylens.llm import queries


def greedy(known, text):
    n, i = 0, 0
    while i < len(text):
        j = i + 1
        while j <= len(text) and text[i:j] in known:
            j += 1
        n, i = n + 1, max(j - 1, i + 1)
    return n


def test_phrases_equal_a_greedy_parse():
    texts = {"x": ["abracadabra cadabra barca"], "y": ["lorem ipsum dolor sit amet orem sum"]}
    m = L.train(texts, chars=200)
    codes = m.codes()
    probe = ["abra lorem", "cad", "zzz q", "dolor cadabra sit barca zz lorem ipsum"]
    got = L.costs(m, codes, probe, segment=1000)
    for i, t in enumerate(probe):
        for k, lang in enumerate(m.languages):
            known = "".join(c if c in m.symbols else "\1" for c in L.fold(texts[lang][0]))
            seen = "".join(c if c in m.symbols else "\1" for c in t)
            assert round(got[i, k] * len(t) / m.bits[k]) == greedy(known, seen), (t, lang)


def test_segments_cover_whole_texts():
    m = L.train({"x": ["abcabcabc" * 30], "y": ["xyzzyx" * 40]})
    got = L.costs(m, m.codes(), ["abc" * 500 + "xyzzyx" * 2000, "q"], segment=64)
    assert got[0, 1] < got[0, 0] and np.isfinite(got).all()


def test_edge_cases(spark, make_docs, sample_texts):
    rows = [(1000 + i, t, lang, "s", None, 0) for i, (t, lang) in enumerate(
        [("the cat and the hat " * 9, "en"), ("der hund und die katze " * 9, "de")] * 5)]
    docs = make_docs(sample_texts, rows)
    out = L.identify(spark, docs).collect()
    assert len(out) == len(sample_texts) + 11
    by = {r["doc_id"]: r for r in out}
    for i, t in enumerate(sample_texts):
        assert (by[i]["lang_pred"] == "und") == (not L.fold(t or "")), repr(t)[:40]
        assert 0 <= by[i]["score"] <= 1
    assert by[1000]["lang_pred"] == "en" and by[1001]["lang_pred"] == "de"
    assert {r["lang_pred"] for r in L.identify(spark, docs, learn=F.lit(False)).collect()} == {"und"}
    assert L.identify(spark, docs.where("false")).count() == 0


def test_figures_are_no_letters(spark, make_docs):
    rows = [(1000 + i, "the cat and the hat " * 9, "en", "s", None, 0) for i in range(4)]
    docs = make_docs(["\u00bd \u00b2 \u2167", "12 \u0663 _ \u2460", "\u00bd cup", "\u0915", "\u00aa"], rows)
    by = {r["doc_id"]: r["lang_pred"] for r in L.identify(spark, docs).collect()}
    assert [by[i] == "und" for i in range(5)] == [True, True, False, False, False]


def test_a_language_of_long_texts_only_is_learned(spark, make_docs):
    import random
    rng = random.Random(3)

    def text(words, n):
        return " ".join(rng.choice(words) for _ in range(n))
    en, de = ["the", "cat", "and", "hat", "with", "that"], ["der", "hund", "und", "katze", "mit", "nicht"]
    rows = [(100 + i, text(en, 60), "en", "s", None, 0) for i in range(10)]
    rows += [(200 + i, text(de, 9000), "de", "s", None, 0) for i in range(10)]
    docs = make_docs([], rows)
    assert {k: max(map(len, v)) for k, v in L.sample(docs).items() if k == "de"} == {"de": L.PASSAGE}
    by = {r["doc_id"]: r["lang_pred"] for r in L.identify(spark, docs).collect()}
    assert {by[100 + i] for i in range(10)} == {"en"} and {by[200 + i] for i in range(10)} == {"de"}


def test_sample_is_bounded_and_merges_repeated_ids(spark, make_docs):
    rows = [(7, f"text number {i}", "xx", "s", None, 0) for i in range(50)] + [(i, "b " * 3000, "yy", "s", None, 0) for i in range(900)]
    got = L.sample(make_docs([], rows), cells=20)
    assert got["xx"] == ["text number 0"] and len(got["yy"]) == 20 and {len(t) for t in got["yy"]} == {L.PASSAGE}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text")
    got = queries.op9_language_id(spark, sf).join(docs, "doc_id").where("held_out and lang is not null")
    hits = got.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert hits > 0.97
