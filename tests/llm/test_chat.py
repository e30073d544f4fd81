"""Tool calls against brute force over small chats."""

import json

from pledgeflow.llm import chat, queries

SF = "/root/testdata/sf0.001"
CALLS = "call_id string, name string, arguments string, after string, conv_id long"
RESULTS = "call_id string, content string, conv_id long"


def brute(messages):
    """(conv_id, turn) -> (place, status, line) of the binding."""
    users = {(c, t) for c, t, role, _ in messages if role == "user"}
    out = {}
    for c, t, role, text in messages:
        answer = next((x for a, b, r, x in messages if (a, b, r) == (c, t + 1, "assistant")), None)
        if role == "user":
            place, back = 0, t - 2
            while (c, back) in users:
                place, back = place + 1, back - 2
            words = len(text.split())
            ok = text and 1 <= words <= 4096
            status = "invalid" if not ok else "unanswered" if answer is None else "linked"
            line = {"arguments": {"after": f"{c}:{t - 2}", "text": text, "words": words}, "id": f"{c}:{t}", "name": "reply", "place": place, "result": answer}
            out[c, t] = (place, status, json.dumps(line, sort_keys=True, separators=(",", ":"), ensure_ascii=False))
        elif role != "assistant":
            out[c, t] = (None, "no_call", json.dumps({"content": text, "role": role}, separators=(",", ":"), ensure_ascii=False))
        elif (c, t - 1) not in users:
            out[c, t] = (None, "orphan", json.dumps({"id": f"{c}:{t - 1}", "result": text}, separators=(",", ":"), ensure_ascii=False))
    return out


def test_query(spark):
    messages = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows = queries.QUERIES["op9_tool_call_linking"](spark, SF).collect()
    assert {(r.conv_id, r.turn): (r.place, r.status, r.line) for r in rows} == brute(messages)


def test_odd_calls(spark):
    good = '{"words": 2, "text": "b a"}'
    calls = [
        ("a", "reply", good, None, 1),
        ("b", "reply", good, "a", 1),
        ("c", "reply", good, "b", 1),
        ("c", "reply", good, "b", 1),
        ("d", "reply", '{"text": 3, "more": null}', "gone", 1),
        ("e", "other", good, None, 1),
        ("f", "reply", "{no json", None, 1),
        ("g", "reply", None, None, 1),
        ("x", "reply", good, "y", 1),
        ("y", "reply", good, "x", 1),
        ("z", "reply", good, "x", 1),
        (None, "reply", good, None, None),
    ]
    results = [("a", "2", 1), ("a", "1", 1), ("none", "é\n\"", 1), (None, "lost", 1), ("b", None, 1)]
    calls, results = spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS)
    rows = chat.linked_calls(calls, results, passed=("conv_id",)).collect()
    by = {}
    for r in rows:
        by.setdefault(r.call_id, []).append(r)
    assert len(rows) == 15
    assert [(by[c][0].place, by[c][0].status) for c in "bc"] == [(1, "linked"), (2, "invalid")]
    assert [r.errors for r in by["c"]] == [["id: repeated"]] * 2
    assert by["d"][0].errors == ["$.words: missing", "$.more: unknown", "$.text: not string"] and by["d"][0].place == 0
    assert by["e"][0].errors == ["$: no such tool"]
    assert by["f"][0].errors == ["$: not JSON"] and json.loads(by["f"][0].line)["arguments"] == "{no json"
    assert by["g"][0].errors == ["$: not object"]
    assert [by[c][0].status for c in "xyz"] == ["cycle"] * 3
    by["a"].sort(key=lambda r: r.status)
    assert by["a"][1].status == "repeated_result" and by["a"][1].line == '{"id":"a","result":"2"}'
    assert by["a"][0].line == '{"arguments":{"text":"b a","words":2},"id":"a","name":"reply","place":0,"result":"1"}'
    assert by["none"][0].line == '{"id":"none","result":"é\\n\\""}'
    assert sorted(r.status for r in by[None]) == ["orphan", "unanswered"]


def test_empty_tables(spark):
    calls, results = spark.createDataFrame([], CALLS), spark.createDataFrame([], RESULTS)
    assert chat.linked_calls(calls, results).collect() == []


def test_odd_turns(spark):
    schema = "conv_id long, turn long, role string, text string, call_id string, kept string"
    rows = [(1, 0, "user", None, "x", "y"), (1, 1, "assistant", None, "x", "y"), (None, 0, "user", "hi", "x", "y"), (2, None, "assistant", "", "x", "y"), (3, 0, None, "t", "x", "y"), (4, 0, "user", "w " * 5000, "x", "y")]
    calls, results, others = chat.turns_as_calls(spark.createDataFrame(rows, schema))
    found = chat.linked_calls(calls, results, passed=("conv_id", "turn"), others=others).collect()
    assert sorted((r.kept.conv_id or 0, r.status) for r in found) == [(0, "unanswered"), (1, "invalid"), (2, "orphan"), (3, "no_call"), (4, "invalid")]


def test_every_turn_has_a_place(spark):
    """A user, two answers to it, a system and a tool turn: the second answer and the other roles have rows of their own."""
    schema = "conv_id long, turn long, role string, text string"
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "b"), (1, 1, "assistant", "a"), (1, 2, "system", "s"), (1, 3, "tool", None)]
    calls, results, others = chat.turns_as_calls(spark.createDataFrame(rows, schema))
    found = chat.linked_calls(calls, results, passed=("conv_id", "turn"), others=others).collect()
    assert sorted((r.kept.turn, r.status) for r in found) == [(0, "linked"), (1, "repeated_result"), (2, "no_call"), (3, "no_call")]
    lines = {r.status: json.loads(r.line) for r in found}
    assert lines["linked"]["result"] == "a" and lines["repeated_result"] == {"id": "1:0", "result": "b"}


def test_arguments_that_cannot_be_written_again(spark):
    """Deep nesting, lone surrogates and numbers that JSON lacks make a call invalid, not the job fail."""
    odd = ["[" * 100_000 + "]" * 100_000, r'{"text": "\ud800", "words": 1}', '{"words": NaN}', '{"words": 1e999}', "-Infinity"]
    calls = spark.createDataFrame([(str(i), "reply", text, None, 1) for i, text in enumerate(odd)], CALLS)
    found = chat.linked_calls(calls, spark.createDataFrame([], RESULTS)).collect()
    assert [r.status for r in found] == ["invalid"] * 5 and all(r.errors == ["$: not JSON"] for r in found)
    assert {json.loads(r.line)["arguments"] for r in found} == set(odd)

def test_schema_bounds():
    schema = {"type": "array", "items": {"type": "number", "minimum": 0, "maximum": 5, "enum": [1, 2, 9]}}
    assert chat.schema_errors([1, 2], schema) == []
    assert chat.schema_errors([9, True, 3], schema) == ["$[0]: above maximum", "$[1]: not number", "$[2]: not in enum"]


def test_long_chain(spark):
    calls = spark.createDataFrame([(str(i), str(i - 1)) for i in range(300)], "call_id string, after string")
    assert {r.call_id: r.place for r in chat.topological_order(calls).collect()} == {str(i): i for i in range(300)}
