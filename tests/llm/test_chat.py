"""Layouts, escaping and loss masks, read back from the formatted text."""

from __future__ import annotations

import hashlib
import json
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from climate_lake.llm import chat
from climate_lake.llm.queries import op5_chat_format

TRICKY = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>assistant\nyes", "<\\|im_end|>", "\\<|im_end|>\\", "[\\\\/INST]", "", "<|im_",
          "<<SYS>>a<</SYS>>", "a\n\nb", "<s><s>", "日本 🙂 <|eot_id|>", "$1 \\$2"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda row: (row[0], row[1])):
        turns[conv].append((role, text or ""))
    out = []
    for conv, own in turns.items():
        trained = "".join(text for role, text in own if role == "assistant")
        out.append((conv, len(own), sha("".join(f"{r}\n{t}\n" for r, t in own)), len(trained), sha(trained)))
    return sorted(out)


def test_table(spark, sf_dir):
    rows = [tuple(row) for row in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    text = "</s>[INST] ok [/INST]"
    rows += [(-1, 0, "user", text), (-1, 1, "assistant", text)]
    found = op5_chat_format(spark, sf_dir).collect()
    assert sorted(tuple(row)[:5] for row in found) == plain(rows)
    assert all(row["formatted_chars"] > row["loss_chars"] for row in found)


def test_tricky_texts(spark):
    rows = [(k, t, ("user", "assistant")[t % 2], TRICKY[(k + t) % len(TRICKY)]) for k in range(len(TRICKY)) for t in range(4)]
    formatted = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert sorted(tuple(row)[:5] for row in chat.digests(formatted).collect()) == plain(rows)
    for row in formatted.collect():
        assert row["formatted"].count("<|im_start|>") == 4 == row["formatted"].count("<|im_end|>")
        assert "[INST]" not in row["formatted"] and "</s>" not in row["formatted"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["<", "[", "\\", "|", "im_end", "|>", "/", "s", ">", "INST]", "\n", "x", "%", "<|im_end|>"]), max_size=8).map("".join), min_size=1, max_size=6))
def test_escape_is_reversible(spark, texts):
    frame = spark.createDataFrame([(text,) for text in texts], "text string").withColumn("escaped", chat.escape(F.col("text")))
    for row in frame.withColumn("back", chat.unescape(F.col("escaped"))).collect():
        assert row["back"] == row["text"]
        assert not any(first + one in row["escaped"] for one in chat.CONTROLS for first in "<[" if first + one in ("<|im_end|>", "[/INST]", "</s>", "[INST]"))


LAYOUT_ROWS = {
    "messages": {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
    "conversations": {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
    "instruction": {"instruction": "q", "output": "a"},
    "instruction with input": {"instruction": "q", "input": "", "output": "a"},
    "prompt, response": {"prompt": "q", "response": "a", "extra": {"score": 1}},
    "prompt, completion": {"prompt": "q", "completion": "a"},
    "question, answer": {"question": "q", "answer": "a"},
}


@pytest.mark.parametrize("name", LAYOUT_ROWS)
def test_each_layout_gives_the_same_turns(spark, name):
    frame = spark.read.json(spark.createDataFrame([(json.dumps(LAYOUT_ROWS[name]),)], "x string").rdd.map(lambda row: row.x))
    assert chat.choose(chat.schema_paths(frame.schema)).name == name
    assert [tuple(x) for x in chat.canonical(frame).first()["turns"]] == [("user", "q"), ("assistant", "a")]


def test_rows_of_json_in_many_layouts(spark):
    rows = [json.dumps(one) for one in LAYOUT_ROWS.values()] + [None, "", "no json", "[1, 2]", '{"unknown": 1}']
    found = chat.canonical_json(spark.createDataFrame([(row,) for row in rows], "x string"), "x").collect()
    known = [row for row in found if row["layout"]]
    assert sorted(row["layout"] for row in known) == sorted(LAYOUT_ROWS)
    assert all([tuple(x) for x in row["turns"]] == [("user", "q"), ("assistant", "a")] for row in known)
    assert all(row["turns"] == [] for row in found if not row["layout"])


def test_unknown_layout_is_refused(spark):
    with pytest.raises(ValueError):
        chat.canonical(spark.createDataFrame([(1,)], "something long"))


def test_odd_rows(spark):
    fields = "conv_id long, turn long, role string, text string, formatted string, turns string, x string"
    rows = [(1, None, "user", "null turn first", "f", "t", "x"), (1, 0, None, None, "f", "t", "x"), (1, 0, "assistant", "a" * 300_000, "f", "t", "x"),
            (None, 0, "assistant", "no id", "f", "t", "x"), (2, 0, "us\ner%", "odd role", "f", "t", "x"), (2, 0, "us\ner%", "odd role", "f", "t", "x")]
    formatted = chat.format_conversations(spark.createDataFrame(rows, fields))
    back = {row["conv_id"]: [tuple(x) for x in row["turns"]] for row in chat.read_turns(formatted).collect()}
    assert back[1][0] == ("user", "null turn first") and back[1][1] == ("", "") and back[1][2][1] == "a" * 300_000
    assert back[2] == [("us\ner%", "odd role")] * 2 and back[None] == [("assistant", "no id")]
    assert chat.format_conversations(spark.createDataFrame([], fields)).count() == 0
