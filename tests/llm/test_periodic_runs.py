"""Periodic runs against a plain search over all periods and places."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from staylens.llm import periodic_runs
from staylens.llm.queries import op11_periodic_runs


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_runs(words, least=6):
    """All maximal stretches of each period; a stretch counts at its smallest period."""
    n, seen, out = len(words), set(), []
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            start, end = i, j + p
            if j > i and end - start >= 4 * p and (start, end) not in seen:
                seen.add((start, end))
                if end - start >= least:
                    out.append((start, end - start, p))
            i = max(j, i + 1) if j > i else i + 1
    return sorted(out)


def tailed(doc_id, words):
    h = zlib.crc32(str("" if doc_id is None else doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def dropped(words, runs):
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def random_text(rng):
    words = []
    while len(words) < rng.choice([5, 40, 200, 700]):
        unit = [rng.choice("abcde") for _ in range(rng.choice([1, 1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 33, 64]))]
        if rng.random() < 0.3:
            unit = unit * rng.randint(2, 6)  # runs within runs
        part = unit * rng.randint(1, 7)
        words += part[:rng.randint(1, len(part))]
        if rng.random() < 0.3:
            words.append(f"w{rng.randrange(1000)}")
    return words


@pytest.mark.parametrize("seed", range(12))
def test_blocks_equal_plain_search(seed):
    rng = random.Random(seed)
    docs = [random_text(rng) if rng.random() < 0.9 else [] for _ in range(25)]
    number = {}
    codes = np.array([number.setdefault(w, len(number)) for d in docs for w in d], np.int64)
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    got = [[] for _ in docs]
    for d, start, end, period in periodic_runs._block_runs(codes, offsets):
        if end - start >= 6:
            got[d].append((start, end - start, period))
    for d, words in enumerate(docs):
        assert got[d] == plain_runs(words), " ".join(words)


def test_synchronising_set_is_dense_and_consistent():
    rng = np.random.default_rng(5)
    words = rng.integers(0, 3, 4000)
    words[1000:1400] = words[1000]  # highly periodic: no position is chosen inside
    words[3000:3300] = words[200:500]
    runs = periodic_runs.Runs()
    periodic_runs._small_periods(words, runs)
    h, scale = periodic_runs._mixed(words.astype(np.uint64), np.uint64(1)), 1
    while scale < 16:
        h, scale = periodic_runs._joined(h, scale), scale * 2
    omitted = runs.highly_periodic(len(words), 16)
    ids = np.where(omitted, periodic_runs._NONE, h)
    least = periodic_runs._window_min(ids, 17)
    chosen = [i for i in range(len(words) - 32) if least[i] != periodic_runs._NONE
              and least[i] in (ids[i], ids[i + 16])]
    assert [least[i] for i in range(0, 3900, 97)] == [ids[i:i + 17].min() for i in range(0, 3900, 97)]
    assert not [i for i in chosen if 1000 <= i < 1400 - 48]
    inside = set(chosen)
    for i in range(0, 3900):
        assert omitted[i:i + 32].all() or inside & set(range(i, i + 16))
    assert {i - 200 for i in inside if 200 <= i < 468} == {i - 3000 for i in inside if 3000 <= i < 3268}


def test_long_period_and_very_long_run():
    rng = np.random.default_rng(2)
    unit = rng.integers(0, 1 << 30, 5003)
    words = np.concatenate([rng.integers(0, 1 << 30, 777), np.tile(unit, 5)[:4 * 5003 + 11], rng.integers(0, 1 << 30, 99),
                            np.zeros(200_000, np.int64), [1, 2] * 3000])
    got = periodic_runs._block_runs(words, np.array([0, len(words)]))
    at = 777 + 4 * 5003 + 11 + 99
    assert got == [(0, 777, 777 + 4 * 5003 + 11, 5003), (0, at, at + 200_000, 1), (0, at + 200_000, at + 206_000, 2)]


def test_query_equals_plain_search(spark, tmp_path, sample_texts, monkeypatch):
    rng = random.Random(7)
    texts = sample_texts + [" ".join(random_text(rng)) for _ in range(60)] + ["a\x1cb c " * 8, "la la\tla\nla  la la", "x y " * 4, "b" * 9,
                                                                           "again and again " * 9, "again and again " * 9]
    rows = [(i, t, None, "s", 1, i) for i, t in enumerate(texts)] + [(None, "ab " * 30, None, "s", 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, runs long, length long")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = op11_periodic_runs(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    some = 0
    for r in got:
        words = tailed(r["doc_id"], words_of("ab " * 30 if r["doc_id"] is None else texts[r["doc_id"]]))
        want = plain_runs(words)
        some += bool(want)
        best = max(want, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        assert r["n_runs"] == len(want)
        assert (r["start"], r["length"], r["period"]) == (best or (None, None, None))
        assert r["exponent_milli"] == (best and 1000 * best[1] // best[2])
        assert r["runs_sha256"] == hashlib.sha256("".join("%d,%d,%d\n" % x for x in want).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(dropped(words, want).encode()).hexdigest()
    assert some > 40


def test_empty_table(spark, make_docs):
    assert periodic_runs.periodic_runs(make_docs([]).where("false")).count() == 0


def test_real_outputs(spark, make_docs):
    got = {r["doc_id"]: r for r in periodic_runs.periodic_runs(make_docs(["so it goes so it goes so it goes so it goes on", None])).collect()}
    assert [tuple(x) for x in got[0]["runs"]] == [(0, 12, 3)] and got[0]["collapsed"] == "so it goes on"
    assert got[1]["runs"] == [] and got[1]["collapsed"] == ""
