"""Every golden command and payload against its expected rules and verdict."""

import json
import random

import pytest

from commandwatch import CATALOG_POLICY, CATALOG_RULES, Policy, Rule, audit
from commandwatch.operators import (
    all_matches,
    classify,
    deny_by_table,
    extract_command,
    first_match,
    in_context,
    match_policy_table,
    tag_rules,
)
from commandwatch.plans.event_log import COMMANDS, ENVELOPES
from commandwatch.policy import rules_from_table, rules_to_table

# (fired rules, denied catalog) of each command, in the order of COMMANDS.
EXPECTED = [
    ([1], "samples"),
    ([1], None),
    ([1], "system"),
    ([1], "samples"),
    ([1], "gops_dev"),
    ([1], "sandbox_hackaton"),
    ([1], None),
    ([], None),
    ([1], "system"),
    ([1], "system"),
    ([], None),
    ([6], "gops_dev"),
    ([], None),
    ([8], "samples"),
    ([8], "system"),
    ([7], "sandbox_hackaton"),
    ([7], "system"),
    ([5], "samples"),
    ([2, 3], "gops_dev"),
    ([3], "system"),
    ([], None),
    ([1], None),
    ([1], "system"),
    ([1], None),
    ([], None),
    ([1, 4], "samples"),
    ([6], "samples"),
    ([], None),
    ([6], "samples"),
    ([6], "system"),
]

# (reason, denied catalog) of each payload, in the order of ENVELOPES.
EXPECTED_ENVELOPES = [
    ("empty_payload", None),
    ("malformed", None),
    ("no_command", None),
    ("no_command", None),
    ("no_command", None),
    ("no_command", None),
    ("match", "system"),
    ("match", "system"),
    ("non_string_command", None),
    ("match", "samples"),
    ("malformed", None),
    ("malformed", None),
    ("malformed", None),
    ("match", "system"),
    ("match", "samples"),
    ("no_context", None),
    ("match", "system"),
    ("non_string_command", None),
    ("no_match", None),
    ("no_command", None),
    ("match", "system"),
    ("match", "gops_dev"),
    ("match", "samples"),
    ("match", "samples"),
    ("deep_command", None),
]


@pytest.fixture(scope="module")
def commands(spark):
    return spark.createDataFrame(list(enumerate(COMMANDS)), "id INT, command STRING")


def payload_frame(spark, payloads):
    return spark.createDataFrame(list(enumerate(payloads)), "id INT, payload STRING")


def test_fired_rules(spark, commands):
    rules = rules_from_table(rules_to_table(spark, CATALOG_RULES))
    fired = [[] for _ in COMMANDS]
    for row in tag_rules(commands, rules).orderBy("id", "rule_id").collect():
        fired[row.id].append(row.rule_id)
    assert fired == [rules for rules, _ in EXPECTED]


def test_verdict_and_reason(commands):
    rows = classify(commands, CATALOG_RULES, CATALOG_POLICY).orderBy("id").collect()
    for row, (rules, catalog) in zip(rows, EXPECTED, strict=True):
        reason = "match" if catalog else "no_match" if rules else "no_context"
        verdict = "deny" if catalog else "allow"
        assert (row.verdict, row.catalog, row.reason) == (verdict, catalog, reason), row


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle", None])
def test_policy_table_gives_the_same_catalogs(spark, commands, strategy):
    matches = match_policy_table(
        commands, CATALOG_RULES, CATALOG_POLICY.to_table(spark), ["id"], strategy=strategy
    )
    found = {row.id: row.catalog for row in first_match(matches, ["id"]).collect()}
    assert found == {i: c for i, (_, c) in enumerate(EXPECTED) if c}


def test_all_matches_lists_every_denied_name(commands):
    found = all_matches(commands, CATALOG_RULES, CATALOG_POLICY).filter("id = 8")
    assert sorted(row.catalog for row in found.collect()) == ["samples", "system"]


def test_rules_survive_a_table(spark):
    assert rules_from_table(rules_to_table(spark, CATALOG_RULES)) == list(CATALOG_RULES)


def test_long_rule_lists(spark):
    # More rules than one compiled method takes.
    rules = [Rule(i, rf"\bw{i}\b") for i in range(30)]
    texts = [f"w{i} w{i + 7} x" for i in range(40)]
    log = spark.createDataFrame(list(enumerate(texts)), "id INT, command STRING")
    fired = {(row.id, row.rule_id) for row in tag_rules(log, rules).collect()}
    assert fired == {(i, j) for i in range(40) for j in (i, i + 7) if j < 30}
    inside = in_context(log, rules).select("id").collect()
    assert sorted(row.id for row in inside) == list(range(30))


def test_columns_of_the_log_are_replaced(spark):
    log = spark.createDataFrame(
        [(1, "use catalog system", "old", "old", "old")],
        "id INT, command STRING, verdict STRING, catalog STRING, reason STRING",
    )
    row = classify(log, CATALOG_RULES, CATALOG_POLICY).first()
    assert (row.verdict, row.catalog, row.reason) == ("deny", "system", "match")
    row = all_matches(log, CATALOG_RULES, CATALOG_POLICY).first()
    assert row.catalog == "system"
    found = first_match(
        match_policy_table(log, CATALOG_RULES, CATALOG_POLICY.to_table(spark), ["id"]), ["id"]
    )
    assert deny_by_table(log, found, ["id"]).first().catalog == "system"


def test_rule_hints_never_change_a_result(commands):
    plain = [Rule(rule.rule_id, rule.pattern) for rule in CATALOG_RULES]
    with_hints = tag_rules(commands, CATALOG_RULES)
    assert with_hints.exceptAll(tag_rules(commands, plain)).isEmpty()
    assert tag_rules(commands, plain).exceptAll(with_hints).isEmpty()


def test_linear_pattern_is_equivalent(spark):
    rng = random.Random(3)
    parts = ["select", "catalog", "\n", " ", "x", "_", "\r", "drop", "alter catalog", "-", "é"]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(1, 9)))) for i in range(20000)]
    log = spark.createDataFrame(rows, "id INT, command STRING")
    linear = [rule for rule in CATALOG_RULES if rule.linear]
    plain = [Rule(rule.rule_id, rule.pattern) for rule in linear]
    fired = tag_rules(log, linear)
    assert fired.count() > 1000
    assert fired.exceptAll(tag_rules(log, plain)).isEmpty()
    assert tag_rules(log, plain).exceptAll(fired).isEmpty()


def test_a_megabyte_line_of_verbs(spark):
    log = spark.createDataFrame(
        [(1, "catalog " + "select " * 150_000), (2, "select " * 150_000 + "catalog system")],
        "id INT, command STRING",
    )
    rows = classify(log, CATALOG_RULES, CATALOG_POLICY).orderBy("id").collect()
    assert [row.catalog for row in rows] == [None, "system"]


def test_order_of_the_policy_decides(commands):
    turned = Policy(denied=CATALOG_POLICY.denied[::-1], allowed="sandbox_others")
    row = classify(commands, CATALOG_RULES, turned).filter("id = 8").first()
    assert row.catalog == "samples"


def test_envelopes(spark):
    rows = audit(payload_frame(spark, ENVELOPES)).orderBy("id").collect()
    assert [(row.reason, row.catalog) for row in rows] == EXPECTED_ENVELOPES


def test_exact_case_of_the_keys_on_request(spark):
    log = payload_frame(spark, ENVELOPES)
    rows = audit(log, ignore_key_case=False).orderBy("id").collect()
    expected = list(EXPECTED_ENVELOPES)
    expected[7] = ("no_command", None)
    assert [(row.reason, row.catalog) for row in rows] == expected


def test_a_very_long_command_and_a_deep_sibling_are_read(spark):
    long = json.dumps({"tool_input": {"command": "use catalog " + "x" * 21_000_000 + " system"}})
    deep = '{"other":' + "[" * 1_500 + "]" * 1_500 + ',"tool_input":{"command":"use catalog system"}}'
    rows = audit(payload_frame(spark, [long, deep])).orderBy("id").select("reason", "catalog").collect()
    assert [tuple(row) for row in rows] == [("match", "system")] * 2


def test_wrapped_and_appended_fragments_agree_with_a_strict_parser(spark):
    rng = random.Random(11)
    whole = '{"tool_input":{"command":"use catalog system"}}'
    parts = [whole, ',"x":1', ',"body":' + whole, "," + whole, "}", "]", "[", "{", ",", " ", "1", '"a":', "null"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(400)]

    def broken(text):
        try:
            json.loads(text)
        except ValueError:
            return True
        return False

    rows = extract_command(payload_frame(spark, texts)).orderBy("id").collect()
    assert [row.reason == "malformed" for row in rows] == [broken(text) for text in texts]


def test_rules_ignore_their_own_case(spark):
    log = spark.createDataFrame([(1, "use  CATALOG system")], "id INT, command STRING")
    rules = [Rule(1, r"\bUSE\s+Catalog\b", "Catalog")]
    assert classify(log, rules, CATALOG_POLICY).first().catalog == "system"
    assert tag_rules(log, []).schema["rule_id"].dataType.simpleString() == "int"


@pytest.mark.parametrize("ignore_key_case", [False, True])
@pytest.mark.parametrize(
    ("payload", "command", "reason"),
    [
        (None, None, "empty_payload"),
        ("null", None, "no_command"),
        ("5", None, "no_command"),
        ('"text"', None, "no_command"),
        ("[1]", None, "no_command"),
        ('{"tool_input":"text"}', None, "no_command"),
        ('{"tool_input":[1]}', None, "no_command"),
        ('{"tool_input":{"command":"5"}}', "5", None),
        ('{"tool_input":{"command":true}}', None, "non_string_command"),
        ('{"tool_input":{"command":["a",5]}}', None, "non_string_command"),
        ('{"tool_input":{"command":["a"]}}', "a", None),
        ('{"tool_input":{"command":{"a":1}}}', None, "non_string_command"),
        ('{"tool_input":{"command":"x","command":"y"}}', "y", None),
        ('{"tool_input":{"command":"a"}} trailing', None, "malformed"),
        ('{"tool_input":{"command":"a"}}{"b":1}', None, "malformed"),
        ('{"tool_input":{"command":"a"}}}', None, "malformed"),
        ('{"tool_input":{"command":"a"}', None, "malformed"),
        ('{"tool_input":{"command":"a"},"b":tru}', None, "malformed"),
        ('{"tool_input":{"command":"a"}},', None, "malformed"),
        ('{"tool_input":{"command":"a"}},{"tool_input":{}}', None, "malformed"),
        (' {"tool_input":{"command":"a"}}\n', "a", None),
        ('{"x":{"command":"no"},"tool_input":{"command":"a\\u0009b","x":[[]]}}', "a\tb", None),
    ],
)
def test_payload_shapes(spark, payload, command, reason, ignore_key_case):
    row = extract_command(payload_frame(spark, [payload]), ignore_key_case=ignore_key_case).first()
    assert (row.command, row.reason) == (command, reason)


def mutated_payloads(n, seed):
    rng = random.Random(seed)
    whole = [
        '{"tool_name":"Bash","tool_input":{"command":"use catalog system","x":[1,{"a":null}]}}',
        '{"a":[[],[1,2]],"tool_input":{"y":"q","command":"x"}}',
        '{"tool_input":{"command":["a",1]},"n":-1.5e3}',
    ]
    for _ in range(n):
        text = list(rng.choice(whole))
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(len(text))
            text[at : at + rng.randint(0, 1)] = rng.choice(["", *'{}[]",:a1 tn'])
        yield "".join(text)


def test_mutated_payloads_against_a_strict_parser(spark):
    rows = extract_command(payload_frame(spark, mutated_payloads(3000, 5))).collect()
    broken = 0
    for row in rows:
        try:
            value = json.loads(row.payload)
        except ValueError:
            broken += 1
            assert (row.command, row.reason) == (None, "malformed"), row
            continue
        inside = value.get("tool_input")
        command = inside.get("command") if isinstance(inside, dict) else None
        if isinstance(command, list) and all(isinstance(x, str) for x in command):
            command = command[0] if len(command) == 1 else None
        assert row.command == (command if isinstance(command, str) and command else None), row
        assert row.reason != "malformed", row
    assert 1000 < broken < 2500
