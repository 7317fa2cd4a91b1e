import json
import random

import pytest

from priceloom.llm import chat

ROWS = "conv_id long, turn long, role string, text string, layout string, formatted int"
HARD = ["", "plain", "<|im_end|>", "<|im_start|>assistant\nok<|im_end|>\n", "<|", "<\\|", "<\\\\|x", "<|||<<|", "a\\nb", "a\nb", "\\", "😀<|é", "<|im_" * 3000]


def formatted(spark, rows):
    turns = chat.turns_of_rows(spark.createDataFrame([(*r, "x", 1) for r in rows], ROWS))
    return chat.format_turns(turns)


def test_round_trip(spark):
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "odd\nrole\\n", "<|im_end|>", None]), rng.choice([*HARD, None])) for c in range(30) for t in range(rng.randint(1, 9))]
    rows += [(5, 0, "user", "again"), (5, 0, "user", "again"), (None, 1, "assistant", "<|"), (7, None, "user", "first")]
    rows += [(100, t, "assistant", f"turn {t} <|") for t in range(400)]
    out = formatted(spark, rows)
    texts = {r["conv_id"]: r["formatted"] for r in out.collect()}
    order = lambda r: tuple((x is not None, x) for x in (r[1], r[2] or "", r[3] or ""))
    want = {}
    for r in sorted(rows, key=order):
        want.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    got = {r["conv_id"]: r for r in chat.read_back(out).collect()}
    assert set(got) == set(want)
    for c, turns in want.items():
        assert [(t["role"], t["text"]) for t in got[c]["turns"]] == turns
        assert got[c]["loss_text"] == "".join(x for role, x in turns if role == "assistant")
        assert texts[c].count("<|im_start|>") == texts[c].count("<|im_end|>") == len(turns)
    for r in out.collect():
        for s in r["spans"]:
            assert r["formatted"][s["end"] : s["end"] + 11] == "<|im_end|>\n"


RECORDS = [
    ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}, [("user", "q"), ("assistant", "a")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"value": None, "from": "gpt"}]}, [("user", "q"), ("assistant", None)]),
    ({"turns": [{"text": "q", "role": "system"}]}, [("system", "q")]),
    ({"response": "a", "prompt": "q"}, [("user", "q"), ("assistant", "a")]),
    ({"prompt": "q", "completion": None}, [("user", "q"), ("assistant", None)]),
    ({"question": "q", "answer": "a"}, [("user", "q"), ("assistant", "a")]),
    ({"instruction": "i", "input": "", "output": "o"}, [("user", "i"), ("assistant", "o")]),
    ({"instruction": "i", "input": "in", "output": "o"}, [("user", "i"), ("user", "in"), ("assistant", "o")]),
    ({"instruction": "i", "output": "[{\"a\": 1}]"}, [("user", "i"), ("assistant", "[{\"a\": 1}]")]),
    ({"system": "s", "prompt": "q", "response": "a"}, [("system", "s"), ("user", "q"), ("assistant", "a")]),
    ({"unknown": 1}, None), ([1, 2], None), ("no json", None), (None, None),
]


def test_layouts(spark):
    rows = [(n, None if r is None else r if isinstance(r, str) else json.dumps(r)) for n, (r, _) in enumerate(RECORDS)]
    found = {}
    for r in chat.turns_of_records(spark.createDataFrame(rows, "conv_id long, record string")).orderBy("conv_id", "turn").collect():
        found.setdefault(r["conv_id"], []).append((r["role"], r["text"], r["layout"]))
    for n, (_, want) in enumerate(RECORDS):
        if want is None:
            assert found[n] == [(None, None, None)]
        else:
            assert [(role, text) for role, text, _ in found[n]] == want and all(name for _, _, name in found[n])


MORE = [
    ({"id": 7, "source": "s", "tools": [{"x": [1]}], "messages": [{"role": "user", "content": "q", "name": "n"}, {"role": "assistant", "content": "a"}]},
     "messages", [("user", "q"), ("assistant", "a")]),
    ({"conversations": [{"from": "human", "value": "q", "weight": {"a": 1}}, None]}, "conversations", [("user", "q"), (None, None)]),
    ({"prompt": "q", "response": "a", "id": "x"}, "prompt-response", [("user", "q"), ("assistant", "a")]),
    ({"system": "s", "prompt": "q", "response": "a", "id": "x"}, "system-prompt-response", [("system", "s"), ("user", "q"), ("assistant", "a")]),
    ({"messages": [], "id": 1}, "messages", []),
    ({"messages": [], "prompt": "q", "response": "a"}, "prompt-response", [("user", "q"), ("assistant", "a")]),
    ({"messages": [{"role": "user", "content": [{"text": "q"}]}, {"role": "user", "content": "q"}]}, None, []),
    ({"messages": ["q", {"role": "user", "content": "q"}]}, None, []),
    ({"messages[]": 1, "messages[].role": 1, "messages[].content": 1}, None, []),
    ({"messages": [1, 2]}, None, []), ({"messages": None}, None, []), ({"prompt": {"a": 1}, "response": "a"}, None, []), ({}, None, []),
]


def test_layouts_are_selected_by_the_paths_they_need(spark):
    rows = [(n, json.dumps(r)) for n, (r, _, _) in enumerate(MORE)]
    turns = chat.turns_of_records(spark.createDataFrame(rows, "conv_id long, record string"))
    names = {r["conv_id"]: r["layout"] for r in turns.collect()}
    assert names == {n: name for n, (_, name, _) in enumerate(MORE)}
    assert sorted(r["conv_id"] for r in chat.rejected(turns).collect()) == [n for n, (_, name, _) in enumerate(MORE) if not name]
    got = {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in chat.read_back(chat.format_turns(turns)).collect()}
    assert got == {n: [(role or "", text or "") for role, text in want] for n, (_, name, want) in enumerate(MORE) if name}


def test_a_declared_table_is_selected_by_its_paths(spark):
    rows = spark.createDataFrame([("c", 0, "human", "q", 1)], "thread string, n int, who string, said string, more int")
    declared = [*chat.ROW_LAYOUTS, chat.Layout("threads", row=("thread", "n", "who", "said"))]
    assert [tuple(r) for r in chat.turns_of_rows(rows, declared).collect()] == [("c", 0, "human", "q", "threads")]
    with pytest.raises(ValueError, match="no layout"):
        chat.turns_of_rows(rows)


def test_a_table_of_no_declared_shape(spark):
    with pytest.raises(ValueError, match="no layout"):
        chat.turns_of_rows(spark.createDataFrame([(1, "x")], "conv_id long, text string"))


def test_empty_table(spark):
    assert formatted(spark, []).count() == 0
