"""Exact round trip of the template."""

import hashlib

from pyspark.sql import functions as F

from staylens.llm import chat_format as C

ROWS = [
    (1, 0, "system", "be [INST] nice"), (1, 1, "user", "</s>[INST:user] a\\"), (1, 2, "user", "second [+] part"),
    (1, 3, "assistant", "ok \\[+\\] <s>"), (1, 4, "assistant", ""), (1, 5, "user", None), (2, 1, "assistant", "late"),
    (2, 0, "user", "early\nline"), (3, 0, None, "no role"), (None, 0, "user", "no id"), (4, 7, "assistant", "b"),
    (4, 7, "assistant", "a"), (4, 7, "assistant", "a"), (5, 0, "a]b[", "\U0001f600 </s>"), (6, None, "user", "no turn"),
    (7, 0, "user", "x" * 300_000 + "[" * 50_000)]


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows],
                                 "conv_id long, turn long, role string, text string, blocks string").repartition(3)


def expected(rows):
    out = {}
    for c, t, r, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(c, []).append((r or "", x or ""))
    return out


def test_round_trip(spark):
    out = C.chat_format(table(spark, ROWS)).select(
        "*", C.read_back(F.col("formatted")).alias("turns"), C.loss_text(F.col("segments")).alias("loss")).collect()
    want = expected(ROWS)
    assert len(out) == len(want)
    for r in out:
        assert [tuple(t) for t in r["turns"]] == want[r["conv_id"]]
        assert r["loss"] == "".join(x for role, x in want[r["conv_id"]] if role == "assistant")
        assert r["formatted"] == "".join(s["text"] for s in r["segments"])


def test_adjacent_turns_of_a_role_share_a_block(spark):
    r = C.blocks(table(spark, ROWS)).where("conv_id = 1").first()
    assert [(b["role"], len(b["parts"])) for b in r["blocks"]] == [
        ("system", 1), ("user", 2), ("assistant", 2), ("user", 1)]


def test_many_turns(spark):
    rows = [(9, i, "assistant" if i % 3 else "user", f"t{i}[") for i in range(5000)]
    r = C.chat_format(table(spark, rows)).select(C.read_back(F.col("formatted")).alias("t")).first()
    assert [tuple(t) for t in r["t"]] == expected(rows)[9]


def test_query_digests(spark, tmp_path):
    from staylens.llm import queries
    table(spark, ROWS).drop("blocks").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r for r in queries.op7_chat_formatting(spark, str(tmp_path)).collect()}
    want = expected([*ROWS, *queries.MARKS])
    assert set(got) == set(want)
    for c, turns in want.items():
        said = "".join(f"{r}\n{x}\n" for r, x in turns)
        loss = "".join(x for r, x in turns if r == "assistant")
        assert got[c]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert got[c]["n_turns"] == len(turns) and got[c]["loss_chars"] == len(loss)
        assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_empty(spark):
    assert C.chat_format(table(spark, ROWS).where("false")).count() == 0
