"""Base spans against a plain reading of the definitions; disclosure on planted terms."""

import hashlib
import math
import random
import re

from pyspark.sql import functions as F

from staylens.llm import pii, queries

KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    out = []
    for k, (kind, p) in enumerate(KINDS.items()):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(x) < 256 for x in m[0].split("."))
                    or kind == "card" and 14 <= len(d) <= 19 and luhn(d) or kind == "phone" and 10 <= len(d) <= 15):
                out.append((m.start(), k, m.end()))
    return [(list(KINDS)[k], a, b) for a, k, b in sorted(out)]


def digits(rng):
    d = "".join(rng.choice("0123456789") for _ in range(15))
    return next(d + c for c in "0123456789" if luhn(d + c))


TRICKY = [
    "a@b.com_x@y.z", "a@b@c.d", "x.@-.-", "a@b.c.d.e f@g", "1.2.3.4.5.6.7.8", "256.1.1.1 255.001.0.9", "1.2.3", "999.1.1.1.1.1.1",
    "4111 1111 1111 1111", "4111-1111-1111-1111 4111  1111 1111 1111", "4111111111111111 4111111111111111", "-4111111111111111-",
    "+1 (555) 123-4567", "+1 555 123 4567 890 123 4567", "++49 30 1234567.", "+1 2", "\U0001f600 a@b.co é +1 555 123 4567",
    "1 " * 30000, "a." * 20000 + "@b.c" + ".d" * 20000, "9" * 40000, "a" * 50000, "+1" + "(" * 20000, "user@" * 5000, "Ⅷ ٣٤ 1.1.1.٣"]


def rows_of(spark, docs):
    found, terms = pii.find(spark, docs)
    return pii.with_terms(found, terms)


def test_base_spans(spark, make_docs, sample_texts):
    rng = random.Random(2)
    parts = ["a@b.com", "1.2.3.4", "4111 1111 1111 1111", "+49 30 123456-78", " ", "x", "-", ".", "7", "@", "\n", "é", "12", "+"]
    texts = [*sample_texts, *TRICKY, *("".join(rng.choice(parts) for _ in range(12)) for _ in range(300))]
    got = {r["doc_id"]: r["base"] for r in rows_of(spark, make_docs(texts)).collect()}
    assert len(got) == len(texts) + 1
    for i, t in enumerate(texts):
        assert [(pii.KINDS[s["kind"]], s["start"], s["end"]) for s in got[i]] == brute(t or ""), repr(t)[:80]


def planted(n=400):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(4, 7)))
    texts = []
    for i in range(n):
        words = [rng.choice(["this", "that", "with", "from"]) if rng.random() < .4 else word() for _ in range(40)]
        if i % 40 == 0:  # a name that stands by one address and nowhere else
            words[20:20] = ["Zebulon", "writes", "from", "zq@mail.example"]
        if i % 50 == 1:  # an address in ordinary words
            words[10:10] = ["with", f"common{i % 3}@mail.example", "from"]
        texts.append(" ".join(words))
    return texts + ["copy of Quagmire by only@one.example near Xylophone"] * 9


def test_terms_that_disclose(spark, make_docs):
    texts = planted()
    docs = make_docs(texts)
    out = {r["doc_id"]: r for r in rows_of(spark, docs).collect()}
    for i, t in enumerate(texts):
        found = {t[s["start"]:s["end"]] for s in out[i]["spans"] if s["kind"] == 4}
        assert found == ({"Zebulon", "writes"} if "Zebulon" in t else set()), t
    clean = {r["doc_id"]: r["text"] for r in pii.redact(spark, docs).collect()}
    assert "Zebulon" not in clean[0] and "[EMAIL]" in clean[0] and clean[2] == texts[2]


def test_terms_far_from_the_mention(spark, make_docs):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    fill = lambda: " ".join(word() for _ in range(40))
    # the name stands in the salutation and the signature, hundreds of letters from the address
    texts = [f"Dear Zebulon, {fill()} write zq@mail.example or zq@mail.example {fill()} é Yours, Zebulon" for _ in range(5)]
    # an address with as many mentions as there are documents
    texts += [f"{' '.join(f'{word()} hot@mail.example' for _ in range(12))} {fill()} Quillon" for _ in range(4)]
    texts += [fill() for _ in range(30)]
    docs = make_docs(texts)
    out = {r["doc_id"]: r for r in rows_of(spark, docs).collect()}
    for i, t in enumerate(texts):
        found = [(s["start"], s["end"]) for s in out[i]["spans"] if s["kind"] == 4]
        assert found == [m.span() for m in re.finditer("Dear|Zebulon|write|Yours|Quillon", t)], t
    clean = {r["doc_id"]: r["text"] for r in pii.redact(spark, docs).collect()}
    assert not any("Zebulon" in (t or "") or "Quillon" in (t or "") for t in clean.values())


def test_disclosure_equals_the_formula(spark, make_docs):
    texts = planted(120)
    docs = make_docs(texts)
    found = pii.base_spans(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "text").withColumn(
        "contexts", pii._contexts(F.col("text"), F.col("base")))
    got = {(r["entity"], r["term"]): r["disclosure"] for r in pii.disclosing(docs, found).collect()}
    n = len(texts) + 1
    with_e = sum("zq@mail" in t for t in texts)
    n_t = sum("zebulon" in t.lower() for t in texts)
    want = 1 + math.log2(min(1, with_e / n_t)) / math.log2(n / with_e)
    assert abs(got["0:zq@mail.example", "zebulon"] - want) < 1e-9


def test_redacts_and_keeps_columns(spark, make_docs):
    docs = make_docs(["mail a@b.com or +1 (555) 123-4567 now", None, "", "4111111111111111 é 1.2.3.4"])
    out = pii.redact(spark, docs)
    assert out.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {
        0: "mail [EMAIL] or [PHONE] now", 1: None, 2: "", 3: "[CARD] é [IP]", None: "no id here"}
    assert pii.redact(spark, docs.where("false")).count() == 0


def test_query_digests(spark, tmp_path, make_docs):
    texts = ["x a@b.com 1.2.3.4", "none", "", None]
    make_docs(texts).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op10_pii(spark, str(tmp_path)).collect()}
    for i, t in enumerate(texts):
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in brute(t or ""))
        assert got[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest() and got[i]["spans"] == joined
    assert (got[0]["n_email"], got[0]["n_ip"], got[0]["n_card"], got[0]["n_phone"]) == (1, 1, 0, 0)
