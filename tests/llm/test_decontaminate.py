"""Alignment against plain dynamic programming; planted exact, edited and clean passages."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from staylens.llm import decontaminate as D


def brute(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            h[i + 1][j + 1] = max(0, h[i][j] + (2 if x == y else -1), h[i][j + 1] - 1, h[i + 1][j] - 1)
    return max(map(max, h))


def test_align_equals_dynamic_programming():
    rng = random.Random(1)
    for _ in range(300):
        a = [rng.randrange(5) for _ in range(rng.randrange(1, 14))]
        b = [rng.randrange(5) for _ in range(rng.randrange(1, 20))]
        score, end = D.align(np.array(a), np.array(b))
        assert score == brute(a, b)
        if score:
            assert brute(a, b[:end]) == score and b[end - 1] in a


def world(seed=3):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 8))) for _ in range(3000)]
    common = ["the", "of", "and", "a", "in"]
    word = lambda: rng.choice(common) if rng.random() < .5 else rng.choice(words)
    items = [" ".join(word() for _ in range(rng.randrange(16, 50))) for _ in range(25)]
    docs, want = [], {}
    for i in range(300):
        w = [word() for _ in range(rng.randrange(20, 200))]
        if i % 5 == 0:
            k = rng.randrange(len(items))
            passage = items[k].split()
            for _ in range(0 if i % 10 else len(passage) // 6):  # edited copies
                j = rng.randrange(len(passage))
                passage[j:j + 1] = rng.choice([[], [word()], [passage[j].upper() + ",", word()]])
            at = rng.randrange(len(w))
            w[at:at] = passage
            want[i] = k
        elif i % 5 == 1:  # a few words of an item are no leak
            w[3:3] = rng.choice(items).split()[:6]
        docs.append(" ".join(w))
    return items, docs, want


def test_planted_passages(spark, make_docs):
    items, texts, want = world()
    bench = spark.createDataFrame([(i, t, "x") for i, t in enumerate(items)], "item_id long, text string, doc_id string")
    got = D.contaminated(spark, make_docs(texts), bench).collect()
    assert {r["doc_id"]: r["item_id"] for r in got} == want
    for r in got:
        passage = [D.plain(w) for w in texts[r["doc_id"]].split()][r["word_start"]:r["word_end"]]
        item = D.item_words(items[r["item_id"]])
        assert abs(brute(item, passage) / (2 * len(item)) - r["score"]) < 1e-9
        assert passage[0] in item and passage[-1] in item


def test_benchmark_in_parts_gives_the_same(spark, make_docs):
    items, texts, want = world(4)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = D.contaminated(spark, make_docs(texts), bench, part_bytes=1500).collect()
    assert {r["doc_id"]: r["item_id"] for r in got} == want


def test_frequent_leaks_keep_their_seeds(spark, make_docs):
    items, texts, _ = world(5)
    texts = [t for t in texts[2::5]] + [f"start {items[0]} end"] * 200
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = [r["doc_id"] for r in D.contaminated(spark, make_docs(texts), bench).collect()]
    assert sorted(got) == list(range(60, 260))


def test_awkward_rows(spark, make_docs, sample_texts):
    bench = spark.createDataFrame([(1, None), (2, ""), (None, "one two three four five six seven eight nine ten"),
                                   (4, "ok"), (4, "?? !!"), (5, "the the the the")], "item_id long, text string")
    docs = make_docs([*sample_texts, "One, two three: four five six seven eight nine TEN", "OK.", "one two\x85three", "the the the the"])
    n = len(sample_texts)
    got = {(r["doc_id"], r["item_id"], r["score"]) for r in D.contaminated(spark, docs, bench).collect()}
    assert (n, None, 1.0) in got and {i for _, i, _ in got} == {None}  # short items are no evidence
    assert D.contaminated(spark, docs.where("false"), bench).count() == 0
    assert D.contaminated(spark, docs, bench.where("false")).count() == 0


def test_items_that_chance_brings_mark_nothing(spark, make_docs):
    _, texts, _ = world(6)
    items = ["the", "yes", "The of.", "of the and a", None, ""]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = make_docs([*texts, "yes", "the", "of the and a", "oh yes the"])
    assert D.contaminated(spark, docs, bench).count() == 0
    rng = random.Random(2)
    few = make_docs([" ".join(rng.choice("abcd") for _ in range(100)) for _ in range(60)])
    bench = spark.createDataFrame([(1, "a b c d a"), (2, "a b c d a b c d a b c d a b c d")], "item_id long, text string")
    assert D.contaminated(spark, few, bench.where("item_id = 1")).count() == 0  # chance brings it six times
    planted = few.unionByName(make_docs(["d d a b c d a b c d a b c d a b c d b b"]).where("doc_id = 0").withColumn("doc_id", F.lit(-5)))
    assert [r["doc_id"] for r in D.contaminated(spark, planted, bench).where("score = 1").collect()] == [-5]
    assert D.remove(spark, docs, bench).count() == docs.count()


def test_other_white_space_parts_words_on_both_sides(spark, make_docs):
    items, texts, want = world(7)
    spaces = ["\u00a0", "\u3000", "\u2028", "\x85", " \u00a0 ", "\x1f"]
    strange = [t.replace(" ", spaces[i % len(spaces)]) if i in want else t for i, t in enumerate(texts)]
    for bench_items, docs in ((items, strange), ([t.replace(" ", "\u00a0") for t in items], texts),
                              ([t.replace(" ", "\u2028") for t in items], strange)):
        bench = spark.createDataFrame(list(enumerate(bench_items)), "item_id long, text string")
        got = D.contaminated(spark, make_docs(docs), bench).collect()
        assert {r["doc_id"]: r["item_id"] for r in got} == want


def test_seeds_do_not_cross_documents():
    v = {w: i + 1 for i, w in enumerate("abcdefgh")}
    s = D.seeds([0], [list("abcdefgh")], v, np.ones(9), 10**6)
    numbers, offsets = D.Numbers(v).of(pa.array(["x a b c d", "e f g h x"]))
    docs, places, firsts = D.seed_hits(s, numbers, offsets)
    assert offsets.tolist() == [0, 5, 10] and set(zip(docs.tolist(), firsts.tolist())) == {(0, 1), (1, 1)}
    assert len(docs) == 4  # abc bcd | efg fgh
