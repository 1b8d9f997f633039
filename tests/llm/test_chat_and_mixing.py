"""Tool calls and mixing, against brute force."""

import collections
import json
import re

import pytest
from pyspark.sql import functions as F

from rivulet.llm import mixing, tool_calls

from .data import CLASHING, documents

SCHEMAS = {"find": {"q": {"type": "string", "required": True, "least": 1, "most": 5}, "n": {"type": "integer", "least": 0, "most": 9}}, "stop": {}}
FIELDS = "conv_id bigint, turn bigint, role string, kind string, call_id string, parent_id string, name string, arguments string, content string"
FINE = '{"q": "a", "n": 1}'


def call(conv, turn, id_, parent=None, name="find", arguments=FINE):
    return (conv, turn, "assistant", "call", id_, parent, name, arguments, None)


def result(conv, turn, id_, content="ok"):
    return (conv, turn, "tool", "result", id_, None, None, None, content)


ROWS = [
    call(1, 0, "a"), result(1, 1, "a"), call(1, 2, "b", "a"), result(1, 3, "b"), result(1, 4, "b"), call(1, 5, "c", "b"),
    call(2, 0, "a"), call(2, 1, "b"), result(3, 0, "a"),  # the same ids in other conversations
    call(4, 0, "x", "y"), call(4, 1, "y", "z"), call(4, 2, "z", "x"), call(4, 3, "w", "z"), call(4, 4, "s", "s"),  # cycles and behind
    call(5, 0, "p", "nowhere"), call(5, 1, "q", "p"), call(5, 1, "q", "p"), call(5, 2, "q", "zz"), result(5, 3, "q"),  # repeats and ties
    call(None, 0, "a"), result(None, 1, "a"), call(6, 0, None), result(6, 1, None), call(6, 2, "t", None, None, None),
    (6, 3, "user", None, None, None, None, None, "plain \"text\" é"), (6, 4, None, "note", "t", None, None, None, None), (None,) * 9,
    (6, 5, "user", "note", "t", None, None, None, ""), (6, 6, "user", None, None, None, None, None, "long " * 50000),
    *(call(7, i, f"k{i}", f"k{i - 1}") for i in range(40)), result(7, 41, "k39"),
    *(call(8, i, f"e{i}", None, *e) for i, e in enumerate([
        ("find", "{}"), ("find", '{"q": ""}'), ("find", '{"q": "toolong"}'), ("find", '{"q": 1}'), ("find", '{"q": "a", "n": 10, "z": 0}'),
        ("find", "[1]"), ("find", "no json"), ("find", None), ("other", FINE), ("stop", "{}"), ("stop", '{"a": 1}'), ("find", '{"q": "a", "n": null}')])),
]


def brute_levels(rows):
    key = lambda r: (r[0], r[4]) if r[3] in ("call", "result") and r[0] is not None and r[4] is not None else None
    parents = collections.defaultdict(list)
    for r in rows:
        if r[3] == "call" and key(r):
            parents[key(r)].append(r[5])
    parent = {k: min((p for p in ps if p is not None), default=None) for k, ps in parents.items()}
    answered = {key(r) for r in rows if r[3] == "result" and key(r)}

    def depth(k):
        n, seen = 1, {k}
        while (up := (k[0], parent[k])) in parent:
            if up in seen:
                return None
            seen.add(up)
            n, k = n + 1, up
        return n

    out = []
    for r in rows:
        k = key(r)
        d = depth(k) if k in parent else None
        if r[3] == "call":
            out.append((*r[:3], r[4], 1 if k is None else d and d * 2 - 1, k in answered))
        elif r[3] == "result":
            out.append((*r[:3], r[4], d and d * 2, k in parent))
        else:
            out.append((*r[:3], r[4], 0, None))
    return collections.Counter(out)


def messages(spark, rows):
    names = [n for n in [*CLASHING, "depth", "has_call", "has_result", "next", "there", "json", "problems", "linked"] if n not in FIELDS]
    return spark.createDataFrame(rows, FIELDS).select("*", *(F.lit(i).alias(n) for i, n in enumerate(dict.fromkeys(names)))).repartition(3)


def test_links_and_levels(spark):
    got = tool_calls.linked(messages(spark, ROWS), SCHEMAS).collect()
    assert collections.Counter((r.conv_id, r.turn, r.role, r.call_id, r.level, r.linked) for r in got) == brute_levels(ROWS)


def test_problems_and_json(spark):
    got = {r.turn: r for r in tool_calls.linked(messages(spark, ROWS), SCHEMAS).where("conv_id = 8").collect()}
    assert [got[i].problems for i in range(12)] == [
        "q: missing", "q: below 1", "q: above 5", "q: not string", "n: above 9; z: unknown", "arguments: no object", "arguments: no object",
        "arguments: no object", "unknown tool", "", "a: unknown", "",
    ]
    assert got[4].json == '{"arguments":{"n":10,"q":"a","z":0},"id":"e4","name":"find","role":"assistant"}'
    assert json.loads(got[6].json)["arguments"] == "no json"
    rest = tool_calls.linked(messages(spark, ROWS), SCHEMAS).where("conv_id = 6 AND level = 0").collect()
    assert {r.turn: json.loads(r.json)["content"] for r in rest if r.json} == {3: 'plain "text" é', 4: None, 5: "", 6: "long " * 50000}


def test_no_messages(spark):
    assert tool_calls.linked(messages(spark, []), SCHEMAS).collect() == []


def brute_targets(sizes):
    """Source -> target, by the rule of weights and limits."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, free, out = 1.5 * sum(sizes.values()), set(names), {}
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > 2 * sizes[s]]
        if not over:
            out |= {s: left * weight[s] / total for s in free}
            break
        for s in over:
            out[s] = 2.0 * sizes[s]
        left -= sum(out[s] for s in over)
        free -= set(over)
    return out


@pytest.mark.parametrize("kind", ["mixed", "empty texts"])
def test_mix(spark, kind):
    rows = None if kind == "mixed" else [(1, "", "a"), (2, None, "b"), (None, " ", None)]
    docs = documents(spark, rows).cache()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = collections.Counter()
    for r in docs.collect():
        sizes[r.source] += size(r.text)
    want = brute_targets(sizes)
    got = mixing.mixed(docs).collect()
    names = collections.defaultdict(list)
    for r in docs.collect():
        names[r.doc_id, size(r.text)].append(r.source)
    assert collections.Counter((r.doc_id, r.size) for r in got) == collections.Counter((r.doc_id, size(r.text)) for r in docs.collect())
    taken = collections.Counter()
    for r in got:
        fits = [s for s in names[r.doc_id, r.size] if sizes[s] == r.source_size]
        assert fits and r.target == pytest.approx(want[fits[0]]) and 0 <= r.taken <= 2 * r.size
        taken[fits[0]] += r.taken
    longest = max((r.size for r in got), default=0)
    assert all(abs(taken[s] - want[s]) <= longest + 1 for s in sizes)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mixed(docs.repartition(7)).collect()))


def test_mix_of_nothing(spark):
    assert mixing.mixed(documents(spark, [])).collect() == []
