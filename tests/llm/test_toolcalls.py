import json

from planmart.llm import toolcalls

SCHEMAS = [("add", {"x": "integer", "y": "number"}, ["x"]), ("say", {"text": "string", "to": "array", "opt": "object"}, []),
           ("add", {"x": "string"}, ["q"])]


def run(session, calls, results):
    c = session.createDataFrame([(*r, "x") for r in calls], "conv_id long, turn long, call_id string, parent_id string, "
                                "name string, arguments string, level string")
    r = session.createDataFrame(results, "conv_id long, turn long, call_id string, content string")
    s = session.createDataFrame(SCHEMAS[:2], "name string, params map<string,string>, required array<string>")
    return toolcalls.link(c, r, s).collect()


def test_order_links_and_errors(session):
    calls = [(1, 1, "a", None, "add", '{"y": 1.5, "x": 2}'), (1, 3, "b", "a", "say", '{"text":"é\\n","to":[1,{"b":1,"a":2}]}'),
             (1, 2, "c", "b", "add", '{"y":"no"}'), (2, 1, "d", "gone", "nope", "{}"), (2, 2, "e", "f", "say", "[1]"),
             (2, 3, "f", "e", "say", '{"text":5,"zzz":null}'), (3, 1, "g", "g", "say", "not json"), (3, 2, None, "a", "say", None),
             (4, 9, "a", None, "add", '{"x":1}')]
    results = [(1, 2, "a", "ok"), (1, 9, "a", "again"), (1, 1, "c", None), (5, 1, "none", "x"), (5, 2, None, "y")]
    rows = run(session, calls, results)
    assert len(rows) == len(calls) + len(results)
    call = {(r.call_id, r.turn): r for r in rows if r.kind == "call"}
    got = {(r.call_id, r.turn): r for r in rows if r.kind == "result"}
    assert {k: r.level for k, r in call.items()} == {
        ("a", 1): 0, ("b", 3): 2, ("c", 2): 4, ("d", 1): 0, ("e", 2): None, ("f", 3): None, ("g", 1): None, (None, 2): None, ("a", 9): 0}
    assert {k: r.errors for k, r in call.items()} == {
        ("a", 1): "", ("b", 3): "", ("c", 2): "missing:x,type:y", ("d", 1): "unknown_tool", ("e", 2): "bad_json",
        ("f", 3): "type:text,unknown:zzz", ("g", 1): "bad_json", (None, 2): "bad_json", ("a", 9): ""}
    assert {k for k, r in call.items() if r.linked} == {("a", 1), ("c", 2), ("a", 9)}
    assert [k for k, r in call.items() if r.repeated] == [("a", 9)]
    assert {k: (r.level, r.linked, r.repeated) for k, r in got.items()} == {
        ("a", 2): (1, True, False), ("a", 9): (1, True, True), ("c", 1): (5, True, False),
        ("none", 1): (None, False, False), (None, 2): (None, False, False)}
    assert call["b", 3].json == ('{"arguments":{"text":"é\\n","to":[1,{"a":2,"b":1}]},"call_id":"b","conv_id":1,'
                                 '"kind":"call","name":"say","turn":3}')
    assert json.loads(call["g", 1].json)["arguments"] == "not json"
    assert json.loads(call[None, 2].json)["arguments"] is None
    for r in rows:
        assert r.json == json.dumps(json.loads(r.json), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_one_parser_for_checks_and_output(session):
    """What is kept as a JSON string is bad_json, and the other way round; nothing is lost silently."""
    long = json.dumps({"text": "ab " * 200_000})
    cases = {'{"x":1} trailing': "bad_json", '{"x":1,"x":2}': "bad_json", '{"x":1e400}': "bad_json", '{"x":1}] x': "bad_json",
             '{"x":1}} x': "bad_json", '{"x":1},{"x":2}': "bad_json", '{"x":1},"y":{}': "bad_json", '{"x":5.0}': "", '{"x":12345678901234567890}': "",
             '{"x":1.5}': "type:x", '{"x":1e3}': "type:x", ' {"x" : 1 , "y":-0.5e-3} ': "", '{"x":1,"y":"Infinity"}': "type:y",
             "{}": "missing:x", "": "bad_json", "[]": "bad_json", "5": "bad_json", '{"x":null}': "type:x", long: "missing:x,unknown:text"}
    rows = run(session, [(1, i, f"c{i}", None, "add", text) for i, text in enumerate(cases)], [])
    for r in rows:
        text = list(cases)[r.turn]
        assert (text[:40], r.errors) == (text[:40], cases[text])
        out = json.loads(r.json)["arguments"]
        if r.errors == "bad_json" and text not in ("[]", "5"):
            assert out == text
        else:
            assert out == json.loads(text)


def test_long_chains_take_few_joins(session):
    calls = [(1, i, f"c{i}", f"c{i - 1}" if i else None, "say", "{}") for i in range(300)]
    rows = run(session, calls[::-1], [])
    assert sorted((r.turn, r.level) for r in rows) == [(i, 2 * i) for i in range(300)]


def test_empty_tables(session):
    assert run(session, [], []) == []


def test_the_plan_is_native_and_hashes(session, small_dir):
    turns = session.read.parquet(f"{small_dir}/conversations.parquet")
    plan = toolcalls.link(toolcalls.conversation_calls(turns), toolcalls.conversation_results(turns),
                          toolcalls.schema_table(session))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ShuffledHashJoin" in plan
