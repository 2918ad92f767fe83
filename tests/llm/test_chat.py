import hashlib

from pyspark.sql import functions as F

from clientele.llm import chat, queries

SCHEMA = "conv_id long, turn long, role string, text string, window string, tokens int"
HARD = ["\\", "\\b", "</turn>", "<\\/turn>", "### ", "#### # ", "#\\## x", "a: b", "</turn", "", None, "\n### assistant: x</turn>\n", "é" * 40]


def talk():
    rows = [(1, i, ["user", "assistant"][i % 2], f"turn {i} " + "w " * (i * 13 % 90)) for i in range(300)]
    rows += [(2, 0, "system", "be kind " * 9)] + [(2, i, ["assistant", "user"][i % 2], "x y z " * (i % 40)) for i in range(1, 200)]
    rows += [(3, i, "assistant", t) for i, t in enumerate(HARD)] + [(3, None, "sys: tem", "late")]
    rows += [(4, 0, "system", "only")] + [(5, 0, None, None)] + [(None, 1, "assistant", "no id")] * 2
    rows += [(6, 0, "system", "long " * 3000), (6, 1, "user", "long " * 5000), (6, 2, "assistant", "ok")]
    return [(*r, "w", 0) for r in rows]


def digests(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(
            ((r[1], r[2] or "", r[3] or "") for r in rows if r[0] == conv),
            key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]),
        )
        loss = "".join(t for _, role, t in turns if role == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, r, t in turns)), len(loss), sha(loss))
    return out


def test_query_reads_back_every_turn_once(spark, tmp_path):
    rows = talk()
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op2_chat_windows(spark, str(tmp_path)).collect()
    want = digests(rows + [(-7, 0, "user", queries.PROBE), (-7, 1, "assistant", queries.PROBE)])
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == want
    assert all(r.formatted_chars > 0 for r in got)


def test_windows_keep_budget_system_and_history(spark):
    frame = spark.createDataFrame([r for r in talk() if r[0] in (1, 2)], SCHEMA)
    windows = chat.chat_windows(frame, budget=300, history=60).orderBy("conv_id", "window")
    rows = windows.withColumn("turns", chat.read_turns(F.col("formatted"))).collect()
    assert len(rows) > 20 and all(r.tokens <= 300 for r in rows)
    for conv in (1, 2):
        of = [r for r in rows if r.conv_id == conv]
        fresh = []
        for r in of:
            context = r.turns[: r.context_turns]
            if conv == 2 and fresh:
                assert context[0].role == "system"
                context = context[1:]
            assert context == fresh[len(fresh) - len(context) :]
            fresh += r.turns[r.context_turns :]
            learnt = [t.text for t in r.turns[r.context_turns :] if t.role == "assistant"]
            assert [chat_text(r.formatted, s) for s in r.loss] == learnt
        assert any(r.context_turns > 1 for r in of)


def test_budget_holds_for_long_turns_and_long_system_turns(spark):
    rows, role = [], ["user", "assistant"]
    for conv, (system, sizes) in enumerate([(0, (200, 900, 30, 1000, 50, 790)), (700, (40, 200, 90, 300)), (900, (30, 50, 20, 110)), (1000, (5, 9, 3, 15))]):
        rows += [(conv, 0, "system", "s " * (system - chat.MARKS), "w", 0)] * (system > 0)
        rows += [(conv, i, role[i % 2], "w " * (sizes[i % len(sizes)] - chat.MARKS), "w", 0) for i in range(1, 60) if sizes[i % len(sizes)] > chat.MARKS]
    windows = chat.chat_windows(spark.createDataFrame(rows, SCHEMA)).collect()
    assert max(r.tokens for r in windows) <= chat.BUDGET
    assert any(r.context_turns > 1 for r in windows if r.conv_id == 1)
    assert sum(len(r.loss) for r in windows) == sum(r[2] == "assistant" for r in rows)


def chat_text(formatted, span):
    return formatted[span.start : span.start + span.length]


def test_escapes_are_undone(spark):
    texts = [(a + b + c,) for a in HARD if a for b in HARD if b for c in ("#", "\\", "<")]
    frame = spark.createDataFrame(texts, "t string")
    escaped = frame.select("t", chat.escape(F.col("t")).alias("e"), chat.escape_role(F.col("t")).alias("r"))
    back = escaped.select("*", chat.unescape(F.col("e")).alias("b"), chat.unescape_role(F.col("r")).alias("br"))
    for r in back.collect():
        assert r.b == r.t == r.br and "</turn>" not in r.e and "### " not in r.e and ":" not in r.r


def test_empty_table(spark):
    assert chat.chat_windows(spark.createDataFrame([], SCHEMA)).count() == 0
