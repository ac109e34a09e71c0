"""Certified packing: ids against the library, bounds against exact optima, exchanges against shares."""

import binascii
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from staylens.llm import certified_packing as cp
from staylens.llm import common
from staylens.llm.queries import op13_best_fit_packing


def optimum(lengths, window):
    """The least number of sequences, by trying every open one for each piece."""
    lengths, best = sorted(lengths, reverse=True), [len(lengths)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for room in {r for r in rooms if r >= lengths[i]}:
            j = rooms.index(room)
            place(i + 1, rooms[:j] + [room - lengths[i]] + rooms[j + 1:])
        place(i + 1, rooms + [window - lengths[i]])
    place(0, [])
    return best[0] if lengths else 0


def test_bound_is_below_every_optimum_and_often_meets_it():
    rng, met = random.Random(3), 0
    for _ in range(250):
        window = rng.choice([10, 12, 30])
        lengths = [rng.randint(1, window) for _ in range(rng.randint(1, 9))]
        got, want = cp.bound(np.bincount(lengths, minlength=window + 1), window), optimum(lengths, window)
        assert got <= want
        met += got == want
    assert met > 220
    assert cp.bound(np.bincount([6] * 7, minlength=11), 10) == 7  # the mere sum gives 5
    assert cp.bound(np.bincount([4] * 7, minlength=11), 10) == 4  # two to a sequence; the sum gives 3
    assert cp.bound(np.zeros(11, np.int64), 10) == 0


def test_functions_are_dual_feasible():
    """No set that fits has a bound above one sequence."""
    for window in (7, 12):
        for n in range(1, 5):
            for lengths in itertools.combinations_with_replacement(range(1, window + 1), n):
                if sum(lengths) <= window:
                    assert cp.bound(np.bincount(lengths, minlength=window + 1), window) == 1


AWKWARD_MORE = ['He said "yes" now', 'and "yes", then', "end\". - and -) so", "a <|endoftext|>b c<|endoftext|>", "x y z", "tail ", " head",
                "many  spaces   here", "line\nnext\n\nline", "\ttab\tx", "I'm we'll'd 's", "ends with\n next", "日本語 の 文"]


def test_settled_characters_are_split_alike():
    """Each settled character between letters, figures, marks and spaces, by both encoders."""
    ids = cp.ByteIds(cp.TOKENIZER)
    assert ids.ranks is not None
    settled = [c for c in map(chr, range(0x10000)) if cp._SETTLED.fullmatch(c)]
    assert len(settled) > 30_000
    for a in range(0, len(settled), 200):
        text = "".join(f"a{c}{c} {c}1{c}, {c}\n" for c in settled[a:a + 200])
        assert ids.ranks.encode_ordinary(text) == ids.t.encode(text, add_special_tokens=False).ids


def test_overlong_stretches_are_seen():
    assert not cp.overlong("") and not cp.overlong("word " * 2000) and not cp.overlong("x" * 499)
    for n in (0, 1, 250, 499):
        assert cp.overlong("ab " * n + "x" * 1000 + " cd" * 300) and cp.overlong("ab " * n + " " * 1000 + "cd " * 300)
    ids = cp.ByteIds(cp.TOKENIZER)
    text = "so " * 100 + "xy" * 20_000 + " " * 5000 + "end"
    assert ids.of(pa.array([text]))[0].tolist() == ids.t.encode(text, add_special_tokens=False).ids


def test_rare_letter_sequences_merge_alike():
    rng, ids = random.Random(9), cp.ByteIds(cp.TOKENIZER)
    vocab = [x.replace("\u0120", " ") for x in sorted(ids.t.get_vocab())
             if (x.isascii() or x[0] == "\u0120") and x not in ids.specials]
    for _ in range(4000):
        text = "".join(rng.choice(vocab) if rng.random() < 0.6 else rng.choice("etaoinshrdlu\u00e9\u00fc\u00df'- ") for _ in range(30))
        assert ids.ranks.encode_ordinary(text) == ids.t.encode(text, add_special_tokens=False).ids, text


def test_ids_equal_the_library_in_any_order(sample_texts):
    t = common.load_tokenizer(cp.TOKENIZER)
    rng = random.Random(1)
    parts = ['"', "'", ",", ".", "-", "yes", "end", "don't", "İ", "é", "é", "\n", " ", "  ", "\t", "12", "_", "<|endoftext|>", "日", " ", "(", ")", "—"]
    texts = [x or "" for x in sample_texts] + AWKWARD_MORE
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 25))) for _ in range(6000)]
    shared = cp.ByteIds(cp.TOKENIZER)
    for order in (texts, texts[::-1]):
        ids, counts = shared.of(pa.array(order))
        for text, got in zip(order, np.split(ids, np.cumsum(counts)[:-1])):
            assert got.tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)


def test_query_holds_every_id_once(spark, tmp_path, sample_texts):
    t = common.load_tokenizer(cp.TOKENIZER)
    texts = [*sample_texts, *AWKWARD_MORE, "long words of text " * 3000, *["the same text again"] * 40]
    rows = [(i, x, None, "s", 1, i, 7) for i, x in enumerate(texts)] + [(None, "no id", None, "s", 1, 1, 1), (3, texts[3], None, "s", 1, 1, 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, sequence_id long, piece int"
                          ).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = op13_best_fit_packing(spark, str(tmp_path)).collect()
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, text in [*enumerate(texts), (None, "no id")]:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 2048 or min(len(ids), 2048)
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        want = [(p, a, b - a, binascii.crc32(np.array(ids[a:b], "<u4").tobytes())) for p, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        assert sorted(by_doc[i]) == sorted(want * (2 if i == 3 else 1)), repr(text)[:60]
    for cells in by_seq.values():
        cells.sort()
        assert [o for o, _ in cells] == np.cumsum([0, *(n for _, n in cells)])[:-1].tolist()
        assert sum(n for _, n in cells) <= 2048
    lengths = [r["length"] for r in got]
    assert len(by_seq) == cp.bound(np.bincount(lengths, minlength=2049))  # one share here: certified


@pytest.fixture
def small_shares(spark):
    names = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    before = {k: spark.conf.get(k) for k in names}
    spark.conf.set(names[1], "1k")
    spark.conf.set(names[0], "16k")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def held(got, lengths):
    """The number of sequences, after a look at the places."""
    assert sorted(zip(got.doc_id, got.length)) == list(enumerate(lengths))
    got = got.sort_values(["sequence_id", "offset"])
    assert (got.groupby("sequence_id").length.cumsum() - got.length == got.offset).all()
    assert got.groupby("sequence_id").length.sum().max() <= 2048
    return got.sequence_id.nunique()


def lengths_as_parts(spark, lengths):
    return spark.createDataFrame([(i, 0, 0, n, 1) for i, n in enumerate(lengths)],
                                 "doc_id long, piece int, start long, length long, ids_crc32 long")


def test_exchange_meets_the_whole_bound(spark, small_shares):
    """Each share loses a part of a sequence to rounding; the exchange wins these back."""
    rng = random.Random(2)
    lengths = [rng.randint(1, 500) for _ in range(3000)]
    parts, least = lengths_as_parts(spark, lengths), cp.bound(np.bincount(lengths, minlength=2049))
    assert held(cp.pack(spark, parts, rounds=0).toPandas(), lengths) > least
    assert held(cp.pack(spark, parts).toPandas(), lengths) == least


def test_shares_with_gaps_never_get_worse(spark, small_shares):
    rng = random.Random(2)
    lengths = [rng.choice([1100, 700, 650, 340, 90, 5]) + rng.randint(0, 60) for _ in range(6000)]
    parts, least = lengths_as_parts(spark, lengths), cp.bound(np.bincount(lengths, minlength=2049))
    alone = cp.packed(parts, 0).toPandas()
    assert alone.gap.max() > 0 and alone[alone.gap > 0].open.any()
    full = alone.groupby("sequence_id").length.transform("sum") == 2048
    assert not alone[full].open.any() and alone[(alone.gap > 0) & ~full].open.all()
    assert least <= held(cp.pack(spark, parts).toPandas(), lengths) <= held(alone, lengths)


@pytest.mark.parametrize("rounds", [0, 4])
def test_empty(spark, make_docs, rounds):
    parts = cp.pieces(make_docs([]).where("false")).drop("ids").selectExpr("*", "1L as ids_crc32")
    assert cp.pack(spark, parts, rounds=rounds).count() == 0
