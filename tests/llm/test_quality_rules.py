"""Base counts against a plain reading of the definitions; bands on clear cases."""

import random
import re

from staylens.llm import quality_rules as Q


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, at = {}, set()
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i:i + 5]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            at.update(p + k for p in places for k in range(5))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(at))


def test_base_counts(spark, make_docs, sample_texts):
    texts = [*sample_texts, "a b c d e a b c d e f", "l1 x\nl1 x\n \n \nl2", "#*$ %&| <>\n" * 7]
    got = {r["doc_id"]: r for r in Q.quality(make_docs(texts)).collect()}
    assert len(got) == len(texts) + 1
    for i, t in enumerate(texts):
        r, want = got[i], brute(t or "")
        assert tuple(r[c] for c in Q._INTS) == want, repr(t)[:50]
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r["kept"] and r["base_failed"])


def test_many_distinct_words_do_not_overflow():
    rng = random.Random(3)
    words = [f"w{rng.randrange(9000)}" for _ in range(20000)]
    words += words[500:540]
    assert Q.repeat_words(words) == brute(" ".join(words))[4] >= 80


def test_bands(spark, make_docs):
    rng = random.Random(5)
    def sound(n):
        return " ".join(rng.choice(["the", "of", "a"]) if rng.random() < .3 else "".join(
            rng.choice(["an", "er", "tion", "st", "ou", "re", "th"]) for _ in range(rng.randrange(2, 5))) for _ in range(n))
    noise = "".join(chr(rng.randrange(0x4e00, 0x9f00)) if i % 9 else " " for i in range(6000))
    half = sound(900) + " " + " ".join(f"{w} {w} {w}" for w in ["buy", "now"] * 900)
    texts = [sound(60), sound(300), sound(4000), "spam ham eggs rice tea " * 300, noise, half]
    got = {r["doc_id"]: r["kept"] for r in Q.quality(make_docs(texts)).collect()}
    assert [got[i] for i in range(6)] == [True, True, True, False, False, False]
    assert Q.band_verdict(b"", None, Q.Bands())[3] is False
    import zstandard
    z = zstandard.ZstdCompressor(level=3).compress
    assert Q.band_verdict(half.encode(), z, Q.Bands())[3] is False


def sound_text(rng, size):
    """Prose of words in a skewed vocabulary."""
    words = ["".join(rng.choice(["an", "er", "ti", "on", "st", "ou", "re", "th", "al", "le", "ne", "mi", "da", "so"])
                     for _ in range(rng.randrange(1, 5))) for _ in range(900)]
    out = ""
    while len(out) < size:
        out += rng.choice(words[:40] if rng.random() < .4 else words) + rng.choice([" ", " ", " ", ", ", ". "])
    return out[:size]


def plain_verdict(data, bands):
    """The rule read plainly: every byte lies in a judged chunk."""
    import zstandard
    ratio = lambda x: len(x) / len(zstandard.ZstdCompressor(level=bands.level).compress(x))
    size = max([c for c, _, _ in bands.chunks if 2 * c <= len(data)], default=0)
    chunks, at = [], 0
    while size and at + size < len(data):
        chunks.append(data[at:at + size])
        at += size
    if size:
        chunks.append(data[-size:])
        assert at >= len(data) - size
    limits = {c: (low, high) for c, low, high in bands.chunks}
    bad = [x for x in chunks if not limits[size][0] <= ratio(x) <= limits[size][1]]
    low, high = next((a, b) for n, a, b in reversed(bands.whole) if len(data) >= n)
    return low <= ratio(data) <= high and len(bad) <= bands.bad_chunks * len(chunks), len(chunks), len(bad)


def test_verdict_equals_a_plain_reading_at_all_lengths():
    import base64

    import zstandard
    rng, bands = random.Random(8), Q.Bands()
    z = zstandard.ZstdCompressor(level=bands.level).compress
    for _ in range(400):
        data = sound_text(rng, rng.choice([1, 20, 63, 64, 127, 255, 256, 511, 512, 1500, 2047, 2048, 4095, 4096, 4097, 9000])).encode()
        data += rng.choice([b"", b"", base64.b64encode(rng.randbytes(1700))[:rng.randrange(2200)], b"la " * rng.randrange(700)])
        ratio, chunks, bad, ok = Q.band_verdict(data, z, bands)
        assert (ok, chunks, bad) == plain_verdict(data, bands)


def test_junk_tails_and_short_junk_are_seen():
    import base64

    import zstandard
    rng, bands = random.Random(4), Q.Bands()
    z = zstandard.ZstdCompressor(level=bands.level).compress

    def kept(data):
        return Q.band_verdict(data, z, bands)[3]
    clean = {n: [sound_text(rng, n).encode() for _ in range(40)] for n in (600, 1200, 2050, 4096, 6136, 20_000)}
    for n, texts in clean.items():
        assert sum(map(kept, texts)) >= 39, n
    junk = base64.b64encode(rng.randbytes(1530))
    for n, tail in ((600, 512), (1200, 1024), (2050, 2040), (4096, 2040)):
        assert not any(kept(t + junk[:tail]) for t in clean[n]), (n, tail)
        assert not any(kept(t + (b"ha " * 1000)[:tail]) for t in clean[n]), (n, tail)
    assert not any(kept(b"x" * n) for n in (24, 31, 32, 40, 63, 64, 100, 130))
    assert all(kept(sound_text(rng, n).encode()) for n in (5, 16, 31, 40, 63))


def test_empty(spark, make_docs):
    assert Q.quality(make_docs([]).where("false")).count() == 0
