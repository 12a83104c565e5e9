"""Commands that are lists, lists of payloads and inputs, and values of any depth."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from commandwatch import CATALOG_POLICY, CATALOG_RULES, Policy, Rule, audit
from commandwatch.operators import all_matches, classify, extract_command, in_context, tag_rules


def frame(spark, payloads):
    return spark.createDataFrame(list(enumerate(payloads)), "id INT, payload STRING")


def values(payload):
    """Every value at the command's path, through lists of payloads and of inputs."""
    for entry in payload if isinstance(payload, list) else [payload]:
        inside = entry.get("tool_input") if isinstance(entry, dict) else None
        for one in inside if isinstance(inside, list) else [inside]:
            if isinstance(one, dict):
                yield one.get("command")


def expected(text):
    """command, arguments and reason of a payload, by a strict parser."""
    if not text:
        return None, None, "empty_payload"
    try:
        found = list(values(json.loads(text)))
    except ValueError:
        return None, None, "malformed"
    strings = []
    for value in found:
        for one in value if isinstance(value, list) else [value]:
            if one is None:
                continue
            if not isinstance(one, str):
                return None, None, "non_string_command"
            strings.append(one)
    if len(strings) > 1:
        return None, strings, None
    return (strings[0], None, None) if strings and strings[0] else (None, None, "no_command")


def payloads(n, seed):
    rng = random.Random(seed)
    words = ["ls", "", "use catalog", "system", "[", "{}", "5", "true", '["a"]', "é\t\"", "a],", '],"x":[', "NaN", "\\"]
    odd = [5, -1.5, True, False, {"command": "no"}, [], ["x"], {}]

    def command():
        kind = rng.random()
        if kind < 0.4:
            return rng.choice(words)
        if kind < 0.75:
            return [rng.choice([*words, None, None] if rng.random() < 0.8 else odd) for _ in range(rng.randint(0, 4))]
        return rng.choice([*odd, None])

    def input_():
        found = {"x": rng.choice([1, [], ["],"], None])}
        if rng.random() < 0.85:
            found["command"] = command()
        return found if rng.random() < 0.9 else rng.choice([None, 5, "text", '{"command":"hidden"}'])

    def entry():
        inside = [input_() for _ in range(rng.randint(0, 3))] if rng.random() < 0.2 else input_()
        if isinstance(inside, list):  # the text of an object in a list counts as an object
            inside = [x for x in inside if not isinstance(x, str)]
        return {"tool_input": inside, "y": [rng.choice(words)]} if rng.random() < 0.9 else rng.choice([{}, None, 7])

    for _ in range(n):
        whole = [entry() for _ in range(rng.randint(0, 3))] if rng.random() < 0.25 else entry()
        yield json.dumps(whole, ensure_ascii=rng.random() < 0.5, separators=rng.choice([(",", ":"), (", ", " : ")]))


def test_all_shapes_against_a_strict_parser(spark):
    texts = list(payloads(4000, 2))
    rows = extract_command(frame(spark, texts)).collect()
    kinds = set()
    for row in rows:
        assert (row.command, row.arguments, row.reason) == expected(row.payload), row.payload
        kinds.add(row.reason or ("command" if row.command else "arguments"))
    assert kinds == {"command", "arguments", "no_command", "non_string_command"}


def test_a_value_of_any_depth_ends_no_job(spark):
    depth = 200_000
    lists, objects = "[" * depth + "]" * depth, '{"a":' * depth + "1" + "}" * depth
    rows = [
        f'{{"tool_input":{{"command":{lists}}}}}',
        f'{{"tool_input":{{"command":{objects}}}}}',
        f'{{"tool_input":{{"command":["use catalog system",{lists}]}}}}',
        f'{{"tool_input":{{"x":{lists},"command":"use catalog system"}}}}',
        f'{{"x":{objects},"tool_input":{{"command":["use catalog","system"]}}}}',
        f'[{{"tool_input":{{"command":{lists}}}}}]',
        f'{{"tool_input":{{"command":{"[" * 900}{"]" * 900}}}}}',
        f'{{"tool_input":{{"command":{lists}}}',
        '{"tool_input":{"command":"use catalog samples"}}',
    ]
    got = audit(frame(spark, rows)).orderBy("id").select("reason", "catalog").collect()
    assert [tuple(r) for r in got] == [
        ("deep_command", None),
        ("deep_command", None),
        ("deep_command", None),
        ("match", "system"),
        ("match", "system"),
        ("deep_command", None),
        ("non_string_command", None),
        ("malformed", None),
        ("match", "samples"),
    ]


def test_lists_are_matched_string_by_string(spark):
    rng = random.Random(8)
    parts = ["databricks", "use", "catalog", "use catalog", "system", "SAMPLES", "drop", "gops_dev x", "show\ntables", "", "a"]
    rows = [(k, [rng.choice(parts) for _ in range(rng.randint(0, 5))]) for k in range(3000)]
    log = spark.createDataFrame(rows, "id INT, arguments ARRAY<STRING>").withColumn("command", F.lit(None).cast("string"))
    fired, held, verdicts = set(), set(), {}
    for k, strings in rows:
        lowered = [s.lower() for s in strings]
        for rule in CATALOG_RULES:
            if any(re.search(rule.pattern, s) for s in lowered):
                fired.add((k, rule.rule_id))
        names = [n for n in CATALOG_POLICY.denied if any(re.search(rf"\b{n}\b", s) for s in lowered)]
        context = any(k == f[0] for f in fired if f[0] == k)
        held |= {(k, n) for n in names if context}
        verdicts[k] = names[0] if names and context else None
    tagged = tag_rules(log, CATALOG_RULES, arguments="arguments").select("id", "rule_id")
    assert {tuple(r) for r in tagged.collect()} == fired
    matches = all_matches(log, CATALOG_RULES, CATALOG_POLICY, arguments="arguments")
    assert {(r.id, r.catalog) for r in matches.collect()} == held
    decided = classify(log, CATALOG_RULES, CATALOG_POLICY, arguments="arguments")
    assert {r.id: r.catalog for r in decided.collect()} == verdicts
    assert {r.id for r in in_context(log, CATALOG_RULES, arguments="arguments").collect()} == {k for k, _ in fired}


def test_rules_of_any_kind_see_one_string_at_a_time(spark):
    rules = [Rule(1, "^b$"), Rule(2, "a[^x]b"), Rule(3, r"(?s)a.+b"), Rule(4, r"^a")]
    log = spark.createDataFrame([(1, None, ["a", "b"]), (2, "a b", None), (3, None, ["xa b"])], "id INT, command STRING, arguments ARRAY<STRING>")
    found = {tuple(r) for r in tag_rules(log, rules, arguments="arguments").select("id", "rule_id").collect()}
    assert found == {(1, 1), (1, 4), (2, 2), (2, 3), (2, 4), (3, 2), (3, 3)}
    assert classify(log, rules, Policy(denied=("a b",)), arguments="arguments").filter("verdict = 'deny'").count() == 1


def test_a_name_with_a_null_character_is_refused():
    with pytest.raises(ValueError):
        Policy(denied=("a\0b",))
