from __future__ import annotations

import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from texloom.llm import chat_format as C

from .helpers import written

RECORD = """struct<messages:array<struct<role:string,content:string,weight:int>>, conversations:array<struct<`from`:string,value:string>>,
 prompt:string, completion:string, system:string, instruction:string, input:string, output:string, question:string, answer:string, other:string>"""


def _records(spark, rows):
    """JSON lines of mixed layouts, as a table with one record column."""
    import json
    lines = spark.createDataFrame([(k, json.dumps(r)) for k, r in enumerate(rows)], "id long, j string")
    return lines.select("id", F.from_json("j", RECORD).alias("record"))


def test_layouts(spark):
    rows = [{"messages": [{"role": "system", "content": "s"}, {"role": "user", "content": "u"}]},
            {"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]},
            {"prompt": "p", "completion": "c"}, {"instruction": "i", "output": "o"}, {"instruction": "i", "input": "x", "output": "o"},
            {"system": "s", "instruction": "i", "input": "x", "output": "o"}, {"question": "q", "answer": "a"},
            {"prompt": "p"}, {"other": "z", "prompt": "p", "completion": "c"}, {}, {"messages": []}]
    out = {r.id: r for r in C.parse_chats(C.format_chats(_records(spark, rows))).collect()}
    turns = {k: None if r.parsed is None else [(t.role, t.text, t.loss) for t in r.parsed] for k, r in out.items()}
    assert turns[0] == [("system", "s", False), ("user", "u", False)]
    assert turns[1] == [("user", "h", False), ("assistant", "g", True)]
    assert turns[2] == [("user", "p", False), ("assistant", "c", True)]
    assert turns[3] == [("user", "i", False), ("assistant", "o", True)]
    assert turns[4] == [("user", "i", False), ("user", "x", False), ("assistant", "o", True)]
    assert turns[5][0] == ("system", "s", False) and len(turns[5]) == 4
    assert turns[6] == [("user", "q", False), ("assistant", "a", True)]
    assert [out[k].layout for k in (7, 8, 9)] == [None] * 3 and [out[k].formatted for k in (7, 8, 9)] == [None] * 3
    assert turns[10] == [] and out[10].formatted == ""
    assert out[3].fingerprint != out[4].fingerprint and out[0].layout == "messages"


def test_plan_has_no_python(spark):
    df = C.parse_chats(C.format_chats(_records(spark, [{"prompt": "p", "completion": "c"}])))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _plain(rows):
    out = []
    told = "</s>[INST] ok [/INST]"
    rows = [*rows, (-7, 0, "user", told), (-7, 1, "assistant", told)]
    for conv in {r[0] for r in rows}:
        turns = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv))
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        out.append((conv, len(turns), _sha("".join(f"{r}\n{x}\n" for _, _, r, x in turns)), len(loss), _sha(loss)))
    return sorted(out, key=repr)


def _run(spark, scratch, rows):
    sf = written(spark, scratch, {"conversations": spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")})
    got = C.op7_chat_format(spark, sf).collect()
    assert all(r.formatted_chars >= 24 * r.n_turns for r in got)
    return sorted((tuple(r)[:5] for r in got), key=repr)


def test_round_trip_of_odd_conversations(spark, scratch):
    rows = [(1, 0, "user", None), (1, 1, "assistant", ""), (2, None, None, "\\<|end|>\\\\"), (2, 1, "assistant", "<|start|>assistant<|loss|>x<|end|>"),
            (3, 0, "<|loss|>", "a\n<<SYS>>b<</SYS>>"), (3, 0, "<|loss|>", "a\n<<SYS>>b<</SYS>>"), (None, 5, "assistant", "é\U0001F600\x00\\n"),
            (4, 0, "assistant", "x" * 2_000_000), (5, 0, "system", "s"), (5, 1, "user", "u"), (5, 2, "assistant", "<s>a</s>"),
            (6, 0, "user", "q\\"), (6, 1, "assistant", "\\[INST]"), (6, 1, "assistant", "<"), (6, 2, "assistant", "|end|>"), (-7, 9, "user", "mine")]
    assert _run(spark, scratch, rows) == _plain(rows)


def test_empty_table(spark, scratch):
    assert _run(spark, scratch, []) == _plain([])


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.sampled_from("\\<|>[]/sINTSY endtarlo\n$0é"), max_size=30), min_size=20, max_size=40))
def test_escape_is_reversible(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", C.escape(F.col("t")).alias("e"))
    for r in df.select("t", "e", C.unescape(F.col("e")).alias("u")).collect():
        assert r.u == r.t
        assert not any(c in r.e for c in ("<|", "</s>", "<s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]"))


def test_other_columns_stay(spark):
    df = _records(spark, [{"prompt": "p", "completion": "c"}]).withColumn("layout", F.lit(1)).withColumn("turns", F.lit(2)).withColumn("x y", F.lit(3))
    assert C.format_chats(df).columns == ["id", "x y", "fingerprint", "layout", "formatted"]


PARTS = "struct<messages:array<struct<role:string,content:array<struct<type:string,text:string,image:string>>>>>"


def test_content_as_a_list_of_parts(spark):
    """Its parts' texts are put together; a list that holds more than texts has another fingerprint and no layout."""
    import json
    text = lambda *t: [{"type": "text", "text": x} for x in t]
    rows = [{"messages": [{"role": "user", "content": text("hi", " there")}, {"role": "assistant", "content": [{"text": "yo"}]}]},
            {"messages": [{"role": "user", "content": [{"text": "a"}, {"text": "<|end|>"}]}]},
            {"messages": [{"role": "user", "content": []}]}, {"messages": []},
            {"messages": [{"role": "user", "content": [*text("see"), {"type": "image", "image": "x.png"}]}]}]
    lines = spark.createDataFrame([(k, json.dumps(r)) for k, r in enumerate(rows)], "id long, j string")
    out = {r.id: r for r in C.parse_chats(C.format_chats(lines.select("id", F.from_json("j", PARTS).alias("record")))).collect()}
    turns = {k: None if r.parsed is None else [(t.role, t.text) for t in r.parsed] for k, r in out.items()}
    assert turns == {0: [("user", "hi there"), ("assistant", "yo")], 1: [("user", "a<|end|>")], 2: [("user", "")], 3: [], 4: None}
    assert [out[k].layout for k in range(5)] == ["parts"] * 4 + [None]
    flat = C.format_chats(_records(spark, [{"messages": [{"role": "user", "content": "hi there"}]}])).collect()[0]
    assert flat.layout == "messages" and flat.fingerprint not in [r.fingerprint for r in out.values()]
