"""Each stage of the pipeline against brute force on one small corpus."""

import random
import re

import numpy as np
import pytest

import corpus_pipeline as P
from staylens.llm import common, packing
from tests.llm.test_ngram_join import brute
from tests.llm.test_pii import brute as private


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    rng = random.Random(6)
    parts = {"en": ["the", "and", "ing", "tion", "wh", "er"], "fr": ["eau", "que", "les", "oi", "é", "ment"]}
    word = lambda lang: "".join(rng.choice(parts[lang]) for _ in range(rng.randrange(1, 5)))
    sound = lambda lang, n: " ".join(word(lang) for _ in range(n))
    bench = [sound("en", 30), sound("fr", 25)]
    rows = []
    for i in range(60):
        lang = "en" if i % 3 else "fr"
        rows.append([i, sound(lang, rng.randrange(30, 90)), lang if i % 4 else None, "s", 0])
    rows[10][1] += " write to me@mail.example.com or 10.0.0.1 today"
    rows[11][1] = rows[12][1] + " plus"
    rows[13][1] = rows[12][1].upper()
    rows[20][1] = f"{rows[20][1]} {bench[0]} {sound('en', 9)}"
    rows[21][1] = f"{rows[21][1]} {bench[1]}"
    rows[30][1], rows[31][1], rows[32][1] = None, "", "12345 !!! 678"
    rows[40][1] = sound("en", 6000)
    rows += [[None, sound("en", 40), "en", None, None], [5, rows[5][1], None, None, None], [6, sound("en", 35), "en", "other", 1]]
    folder = tmp_path_factory.mktemp("pipeline")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(enumerate(bench)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), rows, bench


@pytest.fixture(scope="module")
def stages(spark, world):
    folder, _, _ = world
    docs, out = common.read_table(spark, folder, "documents"), []
    for name, stage in P.STAGES:
        docs = common.written(spark, stage(spark, docs, folder), f"test-{name}")
        out.append(docs)
    return out


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def key(row):
    return str(row[0]), str(row[1])


def test_language_rejects_what_has_no_letters(world, stages):
    _, rows, _ = world
    want = [(r[0], r[1]) for r in rows if re.search("[a-zé]", r[1] or "", re.I)]
    assert sorted(rows_of(stages[0]), key=key) == sorted(want, key=key)
    assert {r["lang"] for r in stages[0].collect()} == {"en", "fr"}


def test_one_of_each_group_stays(stages):
    given, got = rows_of(stages[0]), rows_of(stages[1])
    label = brute([i for i, _ in given], [t for _, t in given])
    groups = {}
    for (i, t), (_, c) in zip(given, label):
        groups.setdefault(c, []).append((i, t))
    # ids 6 are two documents of their own, and the null id is alone
    assert len(got) == len(set(got)) == len(groups) + 1
    assert {c for c in groups} == {i for i, _ in got}
    assert (12, [t for i, t in given if i == 12][0]) not in got or len(groups[11]) < 3


def test_documents_with_items_go(world, stages):
    _, _, bench = world
    given, got = rows_of(stages[1]), rows_of(stages[2])
    assert sorted(got, key=key) == sorted((r for r in given if not any(b in r[1] for b in bench)), key=key)
    assert len(given) - len(got) == 2


def test_private_data_is_replaced(stages):
    given = dict(rows_of(stages[2]))
    for r in stages[3].collect():
        if not private(given[r["doc_id"]]) and r["doc_id"] != 6:
            assert r["text"] == given[r["doc_id"]]
        assert not private(r["text"]) and r["n_chars"] == len(r["text"])
    assert "[EMAIL] or [IP] today" in dict(rows_of(stages[3]))[10]


def test_packed_ids_are_the_texts(stages):
    t = common.load_tokenizer(packing.TOKENIZER)
    want = sorted([*t.encode(x, add_special_tokens=False).ids, 1] for i, x in rows_of(stages[3]) if i != 6)
    by_doc = {}
    for r in stages[4].orderBy("doc_id", "start").collect():
        if r["doc_id"] != 6:
            by_doc.setdefault(r["doc_id"], []).extend(np.frombuffer(r["ids"], "<u4").tolist())
    assert sorted(by_doc.values()) == want
    assert stages[4].groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0


def test_columns_and_run(spark, world, stages):
    folder, _, _ = world
    names = common.read_table(spark, folder, "documents").schema
    for df in stages[:-1]:
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in names]
    assert P.run(spark, folder).count() == stages[-1].count()


def test_empty(spark, world):
    folder, _, _ = world
    docs = common.read_table(spark, folder, "documents").where("false")
    for _, stage in P.STAGES[:-1]:
        docs = common.written(spark, stage(spark, docs, folder), "test-empty")
        assert docs.count() == 0
    assert P.STAGES[-1][1](spark, docs, folder).count() == 0
