"""Token counts and packing against the tokenizers library itself."""

import binascii

import numpy as np

from staylens.llm import common, packing, token_counts


def test_counts_equal_library(spark, make_docs, sample_texts):
    t = common.load_tokenizer(token_counts.TOKENIZER)
    docs = make_docs(sample_texts)
    docs = docs.unionByName(docs.where("doc_id = 30"))
    got = token_counts.with_limit(token_counts.token_counts(docs), 1024).collect()
    assert len(got) == len(sample_texts) + 2
    for r in got:
        text = "no id here" if r["doc_id"] is None else sample_texts[r["doc_id"]] or ""
        n = len(t.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 1024), text[:40]


def test_counts_of_empty_table(spark, make_docs):
    assert token_counts.token_counts(make_docs([]).where("false")).count() == 0


def test_high_frequencies_take_several_cells(spark, make_docs):
    n = 3 * 65535 + 7
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(make_docs(["a" + " a" * n, "b"])).collect()}
    assert got[0] == n + 1 and got[1] == 1


def test_pieces_hold_the_library_ids(spark, make_docs, sample_texts):
    t = common.load_tokenizer(packing.TOKENIZER)
    docs = make_docs(sample_texts)
    parts = packing.pieces(docs)
    packed = packing.pack(parts).collect()
    by_doc, by_seq = {}, {}
    for r in packed:
        by_doc.setdefault(r["doc_id"], []).append((r["start"], np.frombuffer(r["ids"], "<u4")))
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert r["length"] == len(r["ids"]) // 4
    for i, text in [*enumerate(sample_texts), (None, "no id here")]:
        want = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        cuts = sorted(by_doc[i], key=lambda x: x[0])
        assert np.concatenate([c for _, c in cuts]).tolist() == want, repr(text)[:60]
        assert [s for s, _ in cuts] == np.cumsum([0, *(len(c) for _, c in cuts)])[:-1].tolist()
    for cells in by_seq.values():
        at = 0
        for offset, n in sorted(cells):
            assert offset == at
            at += n
        assert at <= packing.WINDOW


def test_ids_equal_the_library_whatever_was_seen_before():
    """Quotes, dashes, dotted and combining letters; one worker's cache, its reverse order, and fresh ones."""
    import random

    import pyarrow as pa
    rng, t = random.Random(11), common.load_tokenizer(packing.TOKENIZER)
    parts = ['"', "'", "\u201c", "-", "\u2014", ",", ".", "!", "?", ")", "(", "yes", "End", "don't", "\u0130", "\u0131", "e\u0301", "\u00e9", "\u00df",
             "7", "42", "_", "\u65e5\u672c", "\u03a3", "x", "*", "/", "\u00ad", "\u200d", " ", " ", " ", "\n"]
    texts = ['He said "yes" now', 'and "yes", then', "- and -) so", 'end" and end".']
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(30_000)]
    want = {x: t.encode(x, add_special_tokens=False).ids for x in texts}
    shared = packing.WordIds(packing.TOKENIZER)

    def same(words, order):
        ids, counts = words.of(pa.array(order))
        return [x for x, got in zip(order, np.split(ids, np.cumsum(counts)[:-1])) if got.tolist() != want[x]]
    assert not same(shared, texts) and not same(shared, texts[::-1])
    for a in range(0, 600, 3):
        assert not same(packing.WordIds(packing.TOKENIZER) if a < 30 else shared, texts[a:a + 3])
    shared.clear()
    assert not [x for x in rng.sample(texts, 3000) if same(shared, [x])]


def test_pack_leaves_out_clashing_columns(spark, make_docs):
    parts = packing.pieces(make_docs(["a b", "c"])).selectExpr("*", "'x' as sequence_id", "'y' as offset")
    assert sorted(r["offset"] for r in packing.pack(parts).collect())[0] == 0


def test_crc_is_of_little_endian_ids(spark, make_docs):
    from pyspark.sql import functions as F
    r = packing.pieces(make_docs(["a b"])).where("doc_id = 0").select("ids", F.crc32("ids").alias("c")).first()
    assert r["c"] == binascii.crc32(bytes(r["ids"]))


def test_best_fit_takes_the_tightest_window():
    lengths = np.array([9, 8, 7, 3, 2, 2, 1, 1])
    number, offset = packing.best_fit(lengths, 10)
    assert number.tolist() == [0, 1, 2, 2, 1, 3, 0, 3] and offset.tolist() == [0, 0, 0, 7, 8, 0, 9, 2]
    rng = np.random.default_rng(1)
    lengths = np.sort(rng.integers(1, 2048, 3000))[::-1]
    number, offset = packing.best_fit(lengths, 2048)
    open_, want = {}, []  # brute force: the open window with the least room that is enough
    for n in lengths.tolist():
        fits = [(room, w) for w, room in open_.items() if room >= n]
        w = min(fits)[1] if fits else len(open_)
        want.append(min(fits)[0] - n if fits else 2048 - n)
        open_[w] = want[-1]
    assert (2048 - offset - lengths).tolist() == want


def test_pack_empty(spark, make_docs):
    assert packing.pack(packing.pieces(make_docs([]).where("false"))).count() == 0


def test_cached_and_uncached_paths_agree():
    import pyarrow as pa
    from tests.llm.conftest import AWKWARD
    a = token_counts.PreTokens(token_counts.TOKENIZER)
    texts = [*AWKWARD, *AWKWARD[::-1]]
    place, number = a.of(pa.array(texts))
    for i, text in enumerate(texts):
        assert sorted(number[place == i].tolist()) == sorted(a.whole(text or "")), repr(text)
