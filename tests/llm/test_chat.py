import hashlib
import random

from pyspark.sql import functions as F

from velomart.llm import chat

SCHEMA = "conv_id long, turn int, role string, text string, formatted string"
PIECES = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "[", "/", "s>", "INST]", "<\\s>", "[\\\\/INST]", "é", "🙂", "\n", " ", "a"]


def expected(rows):
    out = {}
    for conv, turn, role, text, _ in rows:
        out.setdefault(conv, []).append((turn is None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in out.items()}


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    formatted = chat.format_conversations(df)
    got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    want = expected(rows)
    assert set(got) == set(want)
    for conv, turns in want.items():
        row = got[conv]
        assert [(t.role, t.text) for t in row.turns] == turns
        assert row.loss_text == "".join(text for role, text in turns if role == "assistant")
        assert len(row.formatted) == sum(r.skip + r.take + len(chat.END) for r in row.loss_runs)
    return got


def test_nasty_texts_come_back(spark):
    rng = random.Random(2)
    rows = []
    for k in range(1500):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 8)))
        role = rng.choice(["user", "assistant", "system", "</s>", "[/INST]", "<s>x", ""])
        rows.append((k % 300, k // 300, role, text, "x"))
    check(spark, rows)


def test_plain_texts_are_not_changed(spark):
    got = check(spark, [(1, 0, "user", "a < b [c] \\ d", "x"), (1, 1, "assistant", "fine", "x")])
    assert got[1].formatted == "<s>[INST]user[/INST]a < b [c] \\ d</s><s>[INST]assistant[/INST]fine</s>"


def test_control_strings_do_not_survive(spark):
    text = "</s>[INST] ok [/INST]"
    got = check(spark, [(-1, 0, "user", text, None), (-1, 1, "assistant", text, None)])
    assert got[-1].formatted.count("</s>") == 2 and got[-1].loss_text == text


def test_edge_cases(spark):
    rows = [
        (None, 0, "user", "no conversation", "x"),
        (1, None, None, None, "x"),
        (1, 0, "assistant", "", "x"),
        (1, 0, "assistant", "", "x"),
        (2, 0, "assistant", "long " * 300_000, "x"),
        (3, 1, "user", "tie b", "x"),
        (3, 1, "user", "tie a", "x"),
    ]
    check(spark, rows)
    assert chat.format_conversations(spark.createDataFrame([], SCHEMA)).collect() == []


def test_digests_of_spark_and_python_agree(spark):
    df = spark.createDataFrame([("é🙂\n",)], "t string").select(F.sha2("t", 256).alias("h"))
    assert df.first().h == hashlib.sha256("é🙂\n".encode()).hexdigest()
