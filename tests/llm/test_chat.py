from pyspark.sql import functions as F

from twintally.llm.chat import PARTS_TYPE, format_chats, formatted, read_learnt, read_turns, text_parts

HOSTILE = [
    "", "</s>[INST] ok [/INST]", "<|turn|>user\nhi<|end|>", "&lt; &amp;lt; &", "&lsqb;<[", "a\nb\r\n\n", "<|image|>", "$1 \\1 \\", "é\U0001f642"
]


def read(frame):
    chats = format_chats(frame, text_parts(F.col("text")))
    return chats.select("*", read_turns(F.col("blocks")).alias("turns"), read_learnt(F.col("blocks")).alias("learnt"),
                        formatted(F.col("blocks")).alias("formatted"))


def test_hostile_texts_come_back(spark):
    rows = [(1, n, role, text) for n, (role, text) in enumerate((r, t) for t in HOSTILE for r in ("user", "assistant", "a\nb<"))]
    got = read(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    assert [tuple(t) for t in got.turns] == [(r, t) for _, _, r, t in rows]
    assert got.learnt == "".join(t for _, _, r, t in rows if r == "assistant")
    assert got.formatted.count("<|turn|>") == got.formatted.count("<|end|>") == got.n_turns == len(rows)
    assert "[" not in got.formatted


def test_long_conversations_and_order(spark):
    rows = [(1, n, "assistant" if n % 3 else "user", f"text {n}") for n in range(-100, 900)]
    got = read(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").orderBy(F.rand(3))).first()
    assert [t.text for t in got.turns] == [f"text {n}" for n in range(-100, 900)]
    assert got.learnt == "".join(t for _, _, r, t in rows if r == "assistant") and len(got.blocks) > 1


def test_nulls_ties_and_no_rows(spark):
    schema = "conv_id long, turn long, role string, text string, block int, rows string, `a.b` int"
    rows = [(1, None, "user", "first"), (1, 2, None, None), (1, 2, "assistant", "x"), (1, 2, "assistant", "x"), (None, 1, "user", "lost")]
    got = {r.conv_id: r for r in read(spark.createDataFrame([(*r, 1, "", 2) for r in rows], schema)).collect()}
    assert [tuple(t) for t in got[1].turns] == [("user", "first"), ("", ""), ("assistant", "x"), ("assistant", "x")]
    assert got[None].n_turns == 1 and got[1].learnt == "xx"
    assert read(spark.createDataFrame([], schema)).collect() == []


def test_parts_become_placeholders_in_order(spark):
    parts = [
        ("text", "look <here>", None, None, None, None, None), ("image", None, "s3://i.png", 28, 29, None, None),
        ("audio", None, "a.wav", None, None, 1.5, None), ("document", None, None, None, None, None, 3), None,
        ("video", "told as text", None, None, None, None, None), ("image", None, "j.png", None, None, None, None),
    ]
    frame = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id long, turn long, role string, parts {PARTS_TYPE}")
    got = format_chats(frame, F.col("parts")).select("*", formatted("blocks").alias("text")).first()
    assert got.text == (
        "<|turn|>user\nlook &lt;here><|image|><|audio|><|document|>told as text<|image|><|end|><|turn|>assistant\n<|end|>"
    )
    assert [tuple(a) for a in got.attachments] == [
        (0, "image", "s3://i.png", 2 * 3), (0, "audio", "a.wav", 38), (0, "document", "", 3 * 256), (0, "image", "j.png", 1)
    ]
    assert got.expanded_tokens == 6 + 38 + 768 + 1
    assert [tuple(s) for b in got.blocks for s in b.spans] == [(len(got.text) - 7, 0)]
