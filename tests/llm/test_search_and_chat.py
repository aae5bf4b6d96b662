"""Top-k search and tool-call linking against brute force."""

import json
import random

import numpy as np
from pyspark.sql import functions as F

from geomere.llm import chat, knn


def _brute(vectors, k):
    ids = sorted(vectors)
    m = np.array([vectors[i] for i in ids], dtype=object)
    out = {}
    for i in ids:
        if i % 100 == 0:
            scores = sorted((-int(np.dot(m[j], vectors[i])), x) for j, x in enumerate(ids) if x != i)
            out |= {(i, r + 1): (x, -s) for r, (s, x) in enumerate(scores[:k])}
    return out


def _check(spark, rows, k=10):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, v string")
    good = {i: [int(np.floor(1024 * float(np.float32(c)))) for c in v] for i, v, _ in rows if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)}
    widest = max(map(len, good.values()))
    good = {i: v + [0] * (widest - len(v)) for i, v in good.items()}
    found = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in knn.top_k(df, F.col("_id") % 100 == 0, k).collect()}
    assert found == _brute(good, k)


def test_top_k_with_ties_copies_and_bad_rows(spark):
    r = random.Random(1)
    rows = [(i, [r.gauss(0, 1) for _ in range(8)], "x") for i in range(700)]
    rows += [(1000 + i, rows[5][1], "x") for i in range(60)] + [(2000 + i, [float(i % 2)] * 8, "x") for i in range(40)]
    rows += [(3000, None, "x"), (3100, [float("nan")] * 8, None), (3200, [None] + [0.0] * 7, "x"), (3300, [0.1], "x"), (3400, [0.0] * 8, "x"), (3400, [0.0] * 8, "x"), (None, [1.0] * 8, "x"), (3500, [float("inf")] * 8, "x"), (3600, [], "x")]
    _check(spark, rows)


def test_top_k_of_few_and_large(spark):
    _check(spark, [(0, [1.0] * 8, "x"), (100, [2.0] * 8, "x"), (7, [-1.0] * 8, "x")])
    _check(spark, [(i * 50, [float(10**5 * (i + 1))] * 8, "x") for i in range(9)])
    assert knn.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("_id") % 100 == 0).count() == 0


def test_bounds_spare_cells_of_clustered_vectors(spark, monkeypatch):
    r = random.Random(2)
    centres = [[r.gauss(0, 3) for _ in range(16)] for _ in range(30)]
    rows = [(i, [c + r.gauss(0, 0.05) for c in centres[i % 30]], "x") for i in range(3000)]
    made = {}
    real = knn.written
    monkeypatch.setattr(knn, "written", lambda df, name: made.setdefault(name, real(df, name)))
    _check(spark, rows)
    assert made["necessary"].count() < 0.5 * 30 * made["cells"].select("cell").distinct().count()


def test_a_hot_cell_is_solved_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK", 50)
    monkeypatch.setattr(knn, "QUERIES", 3)
    r = random.Random(3)
    _check(spark, [(i * 10, [r.gauss(0, 1) if i % 3 else 2.0 + r.gauss(0, 1e-3) for _ in range(4)], "x") for i in range(900)], k=4)


def test_canonical_json():
    assert chat.canonical({"b": [1.0, 2.5, True, None], "a": "é\n\"", "c": {"z": 1e21, "y": 1e-7, "x": 0.000001}}) == '{"a":"é\\n\\"","b":[1,2.5,true,null],"c":{"x":0.000001,"y":1e-7,"z":1e+21}}'
    assert json.loads(chat.canonical({"k": -0.5, "x": 123456789012})) == {"k": -0.5, "x": 123456789012}


SCHEMA = {"type": "object", "properties": {"n": {"type": "integer", "minimum": 0}, "s": {"enum": ["a", "b"]}, "l": {"type": "array", "items": {"type": "string", "maxLength": 2}}}, "required": ["n"], "additionalProperties": False}


def test_schema_violations():
    bad = lambda x: chat.violations(x, SCHEMA)
    assert not bad({"n": 1, "s": "a", "l": ["xx"]})
    assert bad({}) and bad({"n": -1}) and bad({"n": True}) and bad({"n": 1.5}) and bad({"n": 1, "s": "c"}) and bad({"n": 1, "l": ["xxx"]}) and bad({"n": 1, "q": 0}) and bad([])
    assert not bad({"n": 2.0})


def test_linking_ordering_and_states(spark):
    calls = [
        (1, 0, "a", "t", '{"n":1}', []), (1, 2, "b", "t", '{"n": -1}', ["a"]), (1, 4, "c", "t", "not json", ["a", "b", None, "gone"]), (1, 6, "d", "other", "{}", ["e"]), (1, 7, "e", "t", '{"n":2}', ["d"]),
        (2, 0, "a", "t", '{"n":9}', []), (2, 1, None, "t", '{"n":3}', []), (1, 0, "a", "t", '{"n":1}', []), (3, 0, "f", None, None, None),
    ]
    results = [(1, 1, "a", "ok"), (1, 3, "b", None), (1, 9, "a", "late"), (1, 5, "zz", "lost"), (1, 5, None, "none")]
    c = spark.createDataFrame(calls, "conv_id long, turn long, call_id string, name string, arguments string, after array<string>")
    r = spark.createDataFrame(results, "conv_id long, turn long, call_id string, content string")
    out = {(x.conv_id, x.turn, x.call_id): x for x in chat.linked(c, r, {"t": SCHEMA}).collect()}
    assert len(out) == 11
    state = {k: (v.status, v.level, v.valid) for k, v in out.items()}
    assert state[1, 0, "a"] == ("linked", 0, True) and state[1, 2, "b"] == ("linked", 1, False) and state[1, 4, "c"] == ("unanswered", 2, False)
    assert state[1, 6, "d"][1] is None and state[1, 7, "e"][1] is None
    assert state[2, 0, "a"] == ("unanswered", 0, True) and state[1, 9, "a"][0] == "duplicate"
    assert state[1, 5, "zz"][0] == "orphan" and state[1, 5, None][0] == "orphan" and state[2, 1, None][0] == "unanswered"
    assert out[1, 0, "a"].json == '{"arguments":{"n":1},"id":"a","name":"t","result":"ok"}'
    empty = chat.linked(c.limit(0), r.limit(0), {})
    assert empty.count() == 0


def test_identifiers_are_used_anew_in_other_conversations(spark):
    calls = [(c, 0, "call_1", "t", f'{{"n":{c}}}', None) for c in range(1, 30)] + [(c, 2, "call_2", "t", '{"n":0}', ["call_1"]) for c in range(1, 30)] + [(None, 0, "call_1", "t", '{"n":5}', None)]
    results = [(c, k + 1, f"call_{k // 2 + 1}", f"{c}-{k}") for c in range(1, 30) for k in (0, 2)] + [(None, 1, "call_1", "none"), (99, 1, "call_1", "other")]
    c = spark.createDataFrame(calls, "conv_id long, turn long, call_id string, name string, arguments string, after array<string>")
    r = spark.createDataFrame(results, "conv_id long, turn long, call_id string, content string")
    out = chat.linked(c, r, {"t": SCHEMA}).collect()
    assert len(out) == 60 and all((x.status, x.level) == ("linked", x.turn // 2) and json.loads(x.json)["result"] == ("none" if x.conv_id is None else f"{x.conv_id}-{x.turn}") for x in out if x.conv_id != 99)
    assert [x.status for x in out if x.conv_id == 99] == ["orphan"]


def _calls():
    calls = [(f"a{i}", [f"a{i - 1}"] if i else []) for i in range(150)]
    calls += [("m", ["a149", "b1", "a3"]), ("b0", []), ("b1", ["b0"]), ("n", ["m"]), ("o", ["n", "m", None, "gone"]), ("x", ["y"]), ("y", ["z"]), ("z", ["x"]), ("w", ["x"]), ("v", ["w", "b0"]), ("s", ["s"])]
    return calls, {f"a{i}": i for i in range(150)} | {"m": 150, "b0": 0, "b1": 1, "n": 151, "o": 152}


def test_levels_of_long_chains_and_branches(spark, monkeypatch):
    calls, want = _calls()
    assert chat.topological(calls) == want
    given = spark.createDataFrame([(c, i, a) for c in (1, 2, None) for i, a in calls] + [(3, "a1", ["a0"]), (3, None, None)], "conv_id long, call_id string, after array<string>")
    everything = {(c, k): v for c in (1, 2, None) for k, v in want.items()} | {(3, "a1"): 0}
    for bound in (10_000, 100):  # in a task, and by rounds
        monkeypatch.setattr(chat, "IN_TASK", bound)
        assert {(r.conv_id, r.call_id): r.level for r in chat.levels(given).collect()} == everything


def test_clashing_columns_long_texts_and_nulls(spark):
    rows = [(1, 0, "user", "q" * 300_000, 1, "x"), (1, 1, "assistant", "a" * 3_000_000, 2, "y"), (1, 2, "user", None, 3, None), (None, 0, "user", "hi", None, None), (1, 0, "user", "q" * 300_000, 1, "x"), (2, None, "user", "", 1, "z")]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, level long, json string")
    found = {(r.conv_id, r.turn): r for r in chat.turns(given).collect()}
    assert found[1, 0].status == "linked" and not found[1, 0].valid and len(found[1, 0].json) > 3_300_000
    assert found[1, 2].status == "unanswered" and len(found) == 4


def test_turns_of_every_role(spark):
    rows = [(1, 0, "system", "be brief"), (1, 1, "user", "hi"), (1, 2, "assistant", "ho"), (1, 3, "tool", "t"), (1, 4, None, None), (2, 0, "system", "alone")]
    found = chat.turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {(r.conv_id, r.turn, r.status) for r in found} == {(1, 0, "system"), (1, 1, "linked"), (1, 3, "other"), (1, 4, "other"), (2, 0, "system")}
    assert len(found) == 5 and {r.json for r in found if r.conv_id == 2} == {'{"role":"system","text":"alone","turn":0}'}
