import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from starlot.llm import chat

ROWS = "conv_id bigint, turn bigint, role string, text string, prompt int, turns int"


def rows(spark, data):
    return spark.createDataFrame([(*r, 1, 2) for r in data], ROWS)


def back(spark, turns):
    made = chat.formatted(turns)
    return {r.conv_id: r for r in made.withColumns({"turns": chat.parsed(F.col("text")), "learned": chat.learned(F.col("text"), F.col("loss"))}).collect()}


def test_round_trip_of_any_text(spark):
    rnd = random.Random(2)
    pieces = [*chat.CONTROL, "\\", "<", "[", "\n", "a", "é", "😀", " ", "|im_end|>", "s>", "INST]", "<\\s>", "<\\\\|im_end|>", "$1", "\u0001", "%41", "+"]
    data = [(k, t, rnd.choice(["user", "assistant", "system", "a+b c\n\\é%"]), "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 12)))) for k in range(150) for t in range(4)]
    got = back(spark, chat.table_turns(rows(spark, data)))
    for k in range(150):
        own = [(role, text) for c, _, role, text in data if c == k]
        assert [(t.role, t.text) for t in got[k].turns] == own
        assert got[k].learned == "".join(t for r, t in own if r == "assistant")
        inner = got[k].text
        assert inner.count(chat.OPEN) == inner.count(chat.CLOSE) == 4 and "</s>" not in inner and "[INST]" not in inner


def test_nulls_ties_repeats_and_empty_table(spark):
    data = [(1, 2, "assistant", None), (1, 1, None, "x"), (1, 2, "assistant", None), (None, 0, "user", "alone"), (2, None, "user", ""), (3, 1, "user", "b"), (3, 1, "user", "a")]
    got = back(spark, chat.table_turns(rows(spark, data)))
    assert [(t.role, t.text) for t in got[1].turns] == [("", "x"), ("assistant", ""), ("assistant", "")]
    assert [(t.role, t.text) for t in got[None].turns] == [("user", "alone")] and got[2].turns[0].text == ""
    assert [t.text for t in got[3].turns] == ["a", "b"]
    assert chat.formatted(chat.table_turns(rows(spark, []))).count() == 0


def test_very_long_text(spark):
    long = "</s>[INST] word \\ " * 60_000
    got = back(spark, chat.table_turns(rows(spark, [(1, 0, "user", "q"), (1, 1, "assistant", long)])))
    assert got[1].learned == long


def test_layouts_by_fingerprint(spark):
    records = {
        1: {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
        2: {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        3: {"prompt": "q", "response": "a"},
        4: {"output": "a", "instruction": "q"},
        5: {"instruction": "q", "input": "i", "output": "a"},
        6: {"instruction": "q", "input": "", "output": None},
        7: {"question": "q", "answer": "a"},
        8: {"prompt": "q", "response": "a", "unknown": 1},
        9: {"messages": []},
        10: {"system": "s", "prompt": "q", "response": "a"},
        11: {"dialog": [{"speaker": "bot", "text": "a"}]},
    }
    data = [(k, json.dumps(v)) for k, v in records.items()] + [(20, None), (21, "no json"), (22, "{}")]
    got = {r.conv_id: r for r in chat.json_turns(spark.createDataFrame(data, "conv_id bigint, record string"), "conv_id", "record").collect()}
    turns = {k: None if r.turns is None else [(t.role, t.text) for t in r.turns] for k, r in got.items()}
    assert turns[1] == turns[2] == turns[3] == turns[4] == turns[7] == [("user", "q"), ("assistant", "a")]
    assert turns[5] == [("user", "q\n\ni"), ("assistant", "a")] and turns[6] == [("user", "q"), ("assistant", "")]
    assert turns[10][0] == ("system", "s") and turns[11] == [("assistant", "a")]
    assert turns[8] is turns[20] is turns[21] is turns[22] is None and got[8].fingerprint and got[9].layout is None
    assert got[3].fingerprint != got[4].fingerprint and got[1].layout == "messages"


def test_tables_of_other_layouts(spark):
    flat = spark.createDataFrame([(1, "q", "a", 0)], "conv_id bigint, prompt string, response string, score int")
    nested = spark.createDataFrame([(1, [("human", "q"), ("gpt", "a")])], "conv_id bigint, conversations array<struct<from:string,value:string>>")
    for df in (flat, nested):
        assert [(t.role, t.text) for t in chat.table_turns(df).first().turns] == [("user", "q"), ("assistant", "a")]
    with pytest.raises(ValueError):
        chat.table_turns(spark.createDataFrame([(1, "x")], "conv_id bigint, story string"))


def test_query_columns(spark, tmp_path):
    rows(spark, [(1, 0, "user", "hi"), (1, 1, "assistant", "yo</s>")]).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: r for r in chat.op6_chat_turns(spark, str(tmp_path)).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert got[1].turns_sha256 == sha("user\nhi\nassistant\nyo</s>\n") and got[1].loss_sha256 == sha("yo</s>") and got[1].loss_chars == 6
    planted = "</s>[INST] ok [/INST]"
    assert got[-7].turns_sha256 == sha(f"user\n{planted}\nassistant\n{planted}\n") and got[-7].n_turns == 2 and got[-7].loss_sha256 == sha(planted)
