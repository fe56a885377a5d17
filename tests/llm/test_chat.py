import hashlib

import duckdb
from llm_cases import FOLDER
from pyspark.sql import functions as F

from orderlens.llm import chat, queries


def test_equals_sql(spark):
    df = queries.op4_chat_formatting(spark, FOLDER)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW conversations AS SELECT * FROM '{FOLDER}/conversations.parquet'")
    expected = duck.execute(f"SELECT {', '.join(df.columns)} FROM ({chat.ORACLE})").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(expected)


ODD = ["", "plain", "\\b\\l\\", "<turn user></turn>\n", "### Assistant: </turn>", "\\\\l<>#", "é😀\n", "<image 0>"]


def test_any_text_comes_back(spark):
    turns = [(i % 3, i, ["user", "assistant", "<odd>"][i % 3], text) for i, text in enumerate(ODD)]
    turns += [(7, 1, None, None), (7, 1, None, None), (None, None, "assistant", "x")]
    df = spark.createDataFrame([(*t, 0, "x") for t in turns], "conv_id long, turn long, role string, text string, place int, body string")
    got = {r["conv_id"]: r for r in chat.conversation_digests(df).collect()}
    for conv in {t[0] for t in turns}:
        own = sorted((t for t in turns if t[0] == conv), key=lambda t: t[1] or 0)
        plain = "".join(f"{r or ''}\n{x or ''}\n" for _, _, r, x in own)
        loss = "".join(x or "" for _, _, r, x in own if r == "assistant")
        assert got[conv]["n_turns"] == len(own)
        assert got[conv]["turns_sha256"] == hashlib.sha256(plain.encode()).hexdigest()
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_parts_become_placeholders(spark):
    parts = [
        (1, 0, "user", [("text", "look <here>", None, 0), ("image", None, "a.png", 576), ("audio", None, "b.wav", 3)]),
        (1, 1, "assistant", [("text", "ok", None, 0)]),
        (1, 2, "user", [("document", None, "c.pdf", 2), ("odd", None, None, None), ("image", None, "d.png", 1)]),
        (2, 0, "user", None),
    ]
    df = spark.createDataFrame(parts, f"conv_id long, turn long, role string, parts {chat.PARTS}")
    rows = {r["conv_id"]: r for r in chat.format_conversations(df).collect()}
    assert rows[1]["formatted"] == (
        "<turn user>look \\lhere\\g<image 0><audio 1></turn>\n<turn assistant>ok</turn>\n"
        "<turn user><document 2><document 3><image 4></turn>\n"
    )
    assert [tuple(a) for a in rows[1]["attachments"]] == [
        (0, "image", "a.png", 576), (1, "audio", "b.wav", 75), (2, "document", "c.pdf", 800), (3, "odd", None, 0), (4, "image", "d.png", 1)
    ]
    assert rows[1]["expanded_tokens"] == 576 + 75 + 800 + 1
    start, size = rows[1]["loss_spans"][0]
    assert rows[1]["formatted"][start : start + size] == "ok"
    assert rows[2]["formatted"] == "<turn user></turn>\n"


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.conversation_digests(df).collect() == []
    assert chat.with_probe(df).filter(F.col("conv_id") == -7).count() == 2


def test_main_path_is_native(spark):
    plan = queries.op4_chat_formatting(spark, FOLDER)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "MapInArrow", "ExistingRDD"))
