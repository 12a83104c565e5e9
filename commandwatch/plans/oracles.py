"""The registered queries in SQL, for DuckDB on the same tables."""

from __future__ import annotations

from commandwatch.plans.event_log import COMMANDS, DEEPEST, ENVELOPES

# Fixed values, written here again so that the SQL doesn't follow the code under test: the
# patterns by rule id, and the names in order.
CATALOG_RULES = {
    1: r"\bdatabricks\b",
    2: r"\bunity-catalog\b",
    3: r"/api/2\.[01]/unity-catalog",
    4: r"\bcloud\.databricks\.com\b",
    5: r"\bazuredatabricks\.net\b",
    6: r"\b(select|insert|update|delete|create|drop|alter|grant|revoke|merge|truncate)\b.*\bcatalog\b",
    7: r"use\s+catalog",
    8: r"show\s+(catalogs|schemas|tables)",
}
CATALOG_NAMES = ("system", "samples", "gops_dev", "sandbox_hackaton")
CATALOG_ALLOWED = "sandbox_others"
LICENSE_RULES = {1: r"\blicensed\s+under\b", 2: r"\breleased\b.*\blicense\b", 3: r"\btoken\s*="}
LICENSE_NAMES = ("gnu", "apache", "token", "mit", "cc by-nc")
TERMS = ("license", "licensed", "apache", "token", "the", "ré", "ción", "der", "gnu general", "by-nc")
PAGE_RULES = {1: r"\bblog\.\w+\.example\.(com|net)\b", 2: r"^https://.*[?&]ref="}
PAGE_NAMES = ("und", "page", "script")
HISTORY = (
    ("2024-01-01 00:00:00", "2024-01-10 00:00:00", ("system",)),
    ("2024-01-10 00:00:00", "2024-01-20 12:00:00", ("samples", "system")),
    ("2024-01-20 12:00:00", None, ("gops_dev", "system", "sandbox_hackaton", "sandbox_others")),
)

# DuckDB's \b and \w see ASCII only, so whole words are matched with letter classes.
_OTHER = r"[^\p{L}\p{M}\p{N}_]"


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(map(_quote, values)) + "]"


def _word(text: str, name: str) -> str:
    escaped = name.replace("-", r"\-")
    return f"regexp_matches({text}, {_quote(f'(^|{_OTHER}){escaped}({_OTHER}|$)')})"


def _fires(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, {_quote(pattern)})"


def _context(text: str, rules: dict[int, str]) -> str:
    return "(" + " OR ".join(_fires(text, pattern) for pattern in rules.values()) + ")"


def _first(text: str, names) -> str:
    whens = " ".join(f"WHEN {_word(text, name)} THEN {_quote(name)}" for name in names)
    return f"CASE {whens} END"


def _commands(slot: str, rounds: str) -> str:
    return (
        f"({_list(COMMANDS)}[{slot} + 1] || CASE WHEN {rounds} % 2 = 1 "
        "THEN ' # ' || event_type || ' ' || CAST(user_id AS VARCHAR) || ' ' || props "
        "ELSE '' END)"
    )


_N, _M = len(COMMANDS), len(COMMANDS) + len(ENVELOPES)

_LOG = (
    "log AS (SELECT event_id, ts, event_type, "
    f"lower({_commands(f'event_id % {_N}', f'(event_id // {_N})')}) AS text FROM events)"
)
_DECIDED = (
    f"{_LOG}, tagged AS (SELECT *, {_context('text', CATALOG_RULES)} AS in_context FROM log), "
    "decided AS (SELECT *, CASE WHEN in_context THEN "
    f"{_first('text', CATALOG_NAMES)} END AS catalog FROM tagged)"
)
_REASON = (
    "CASE WHEN catalog IS NOT NULL THEN 'match' WHEN in_context THEN 'no_match' "
    "ELSE 'no_context' END"
)
_VERDICT = "CASE WHEN catalog IS NULL THEN 'allow' ELSE 'deny' END"

_PAYLOADS = f"""payloads AS (
  SELECT event_id, CASE WHEN event_id % {_M} < {_N} THEN CAST(json_object(
      'tool_name', 'Bash',
      'tool_input', json_object(
        'command', {_commands(f'(event_id % {_M})', f'(event_id // {_M})')},
        'description', props),
      'session', json_object('user_id', user_id, 'event_type', event_type)) AS VARCHAR)
    ELSE {_list(ENVELOPES)}[event_id % {_M} - {_N} + 1] END AS payload
  FROM events)"""


def _extracted(any_case: bool) -> str:
    """Commands as lists of strings, from lists of payloads and of inputs as well."""
    json = "payload"
    if any_case:
        json = (
            "replace(replace(payload, '\"Tool_Input\"', '\"tool_input\"'), "
            "'\"Command\"', '\"command\"')"
        )
    # The payloads of the log are too deep exactly where they have so many brackets.
    deep = f"length(payload) - length(replace(payload, '[', '')) > {DEEPEST}"
    return f"""{_PAYLOADS}, checked AS (
  SELECT event_id, payload, json_valid(payload) AS valid, {deep} AS deep,
    CASE WHEN json_valid(payload) AND NOT ({deep}) THEN CAST({json} AS JSON) END AS j
  FROM payloads), entries AS (
  SELECT *, CASE WHEN json_type(j) = 'ARRAY' THEN json_extract(j, '$[*]') WHEN j IS NOT NULL THEN [j]
    ELSE [] END AS entries FROM checked), inputs AS (
  SELECT *, flatten(list_transform(entries, lambda e: CASE json_type(e, '$.tool_input')
    WHEN 'ARRAY' THEN list_filter(json_extract(e, '$.tool_input[*]'), lambda x: json_type(x) = 'OBJECT')
    WHEN 'OBJECT' THEN [json_extract(e, '$.tool_input')] ELSE [] END)) AS inputs FROM entries), listed AS (
  SELECT *, list_filter(flatten(list_transform(inputs, lambda i: CASE json_type(i, '$.command')
    WHEN 'ARRAY' THEN json_extract(i, '$.command[*]') ELSE [json_extract(i, '$.command')] END)),
    lambda c: c IS NOT NULL AND json_type(c) <> 'NULL') AS commands FROM inputs), strings AS (
  SELECT *, len(list_filter(commands, lambda c: json_type(c) <> 'VARCHAR')) > 0 AS odd,
    list_transform(commands, lambda c: json_extract_string(c, '$')) AS found FROM listed), extracted AS (
  SELECT event_id, CASE WHEN NOT odd AND len(found) = 1 AND found[1] <> '' THEN found[1] END AS command,
    CASE WHEN NOT odd AND len(found) > 1 THEN found END AS arguments,
    CASE WHEN payload = '' THEN 'empty_payload'
      WHEN NOT valid THEN 'malformed'
      WHEN deep THEN 'deep_command'
      WHEN odd THEN 'non_string_command'
      WHEN len(found) = 0 OR (len(found) = 1 AND found[1] = '') THEN 'no_command' END AS reason
  FROM strings)"""


def _any(strings: str, test: str) -> str:
    return f"len(list_filter({strings}, lambda s: {test})) > 0"


def _first_of_any(strings: str, names) -> str:
    whens = " ".join(f"WHEN {_any(strings, _word('s', n))} THEN {_quote(n)}" for n in names)
    return f"CASE {whens} END"


_AUDITED = f"""{_extracted(True)}, spoken AS (
  SELECT event_id, reason AS earlier,
    list_transform(coalesce(arguments, CASE WHEN command IS NULL THEN [] ELSE [command] END), lambda s: lower(s)) AS strings
  FROM extracted), tagged AS (
  SELECT *, {_any('strings', _context('s', CATALOG_RULES))} AS in_context FROM spoken), decided AS (
  SELECT *, CASE WHEN in_context THEN {_first_of_any('strings', CATALOG_NAMES)} END AS catalog
  FROM tagged), audited AS (
  SELECT event_id, {_VERDICT} AS verdict, catalog, coalesce(earlier, {_REASON}) AS reason
  FROM decided)"""

_MESSAGE = (
    "'Command denied: it names catalog ''' || catalog || "
    "''' and looks like a platform CLI, SQL or catalog API call. "
    f"Work in this project is limited to catalog ''{CATALOG_ALLOWED}''. "
    "The command policy table lists what is denied; "
    "ask the policy owner to change it if this catalog is really needed.'"
)
_JSON = (
    "CAST(json_object('continue', false, 'stopReason', message, 'systemMessage', message, "
    "'hookSpecificOutput', json_object('hookEventName', 'PreToolUse', 'permissionDecision', "
    "'deny', 'permissionDecisionReason', message)) AS VARCHAR)"
)
_DENIED = (
    f"{_DECIDED}, denied AS (SELECT event_id, {_MESSAGE} AS message FROM decided "
    "WHERE catalog IS NOT NULL)"
)


def _names_held(key: str, label: str, source: str, names) -> str:
    return " UNION ALL ".join(
        f"SELECT {key}, {_quote(name)} AS {label} FROM {source} WHERE {_word('text', name)}"
        for name in names
    )


def _history() -> str:
    whens = []
    for start, end, names in HISTORY:
        until = f" AND ts < TIMESTAMP '{end}'" if end else ""
        whens.append(
            f"WHEN ts >= TIMESTAMP '{start}'{until} THEN {_first('text', names)}"
        )
    return (
        f"{_LOG}, tagged AS (SELECT *, {_context('text', CATALOG_RULES)} AS in_context "
        "FROM log), decided AS (SELECT event_id, CASE WHEN in_context THEN "
        f"CASE {' '.join(whens)} END END AS catalog FROM tagged)"
    )


def _text_verdict(table: str, key: str, text: str, rules, names) -> str:
    return f"""WITH log AS (SELECT {key}, lower({text}) AS text FROM {table}), tagged AS (
  SELECT *, {_context('text', rules)} AS in_context FROM log), decided AS (
  SELECT *, CASE WHEN in_context THEN {_first('text', names)} END AS catalog
  FROM tagged)
SELECT {key}, {_VERDICT} AS verdict, catalog AS term, {_REASON} AS reason FROM decided"""


_DOCUMENTS = "WITH log AS (SELECT doc_id, lower(text) AS text FROM documents) "
_IN_CONTEXT = f"WITH {_DECIDED}, held AS (SELECT * FROM tagged WHERE in_context) "

_COMMAND_VERDICT = (
    f"WITH {_DECIDED} SELECT event_id, {_VERDICT} AS verdict, catalog FROM decided"
)
_DENIED_COMMANDS = (
    f"WITH {_DECIDED} SELECT event_id, catalog FROM decided WHERE catalog IS NOT NULL"
)
_ALLOWED_COMMANDS = f"WITH {_DECIDED} SELECT event_id FROM decided WHERE catalog IS NULL"
_ALL_MATCHES = _IN_CONTEXT + _names_held("event_id", "catalog", "held", CATALOG_NAMES)
_DOCUMENT_TERMS = _DOCUMENTS + _names_held("doc_id", "term", "log", TERMS)
_EXTRACT = "SELECT event_id, command, array_to_string(arguments, chr(10)) AS arguments, reason FROM extracted"
_ENVELOPE_VERDICT = f"WITH {_AUDITED} SELECT * FROM audited"


def _coverage() -> str:
    status = [(name, "deny") for name in CATALOG_NAMES]
    status.append((CATALOG_ALLOWED, "allow"))
    rows = ", ".join(f"({_quote(name)}, {_quote(effect)})" for name, effect in status)
    return (
        f"{_IN_CONTEXT}, named AS ("
        + _names_held("event_id", "catalog", "held", (*CATALOG_NAMES, CATALOG_ALLOWED))
        + f"), listed(catalog, status) AS (VALUES {rows}) "
        "SELECT catalog, status, count(event_id) AS n_commands "
        "FROM listed LEFT JOIN named USING (catalog) GROUP BY ALL"
    )


_NAMED = "CASE WHEN user_id % 7 = 0 THEN 'user u' ELSE 'u' END || user_id"
_VALUES = f"""parts AS (SELECT *, 'u' || user_id AS u, {_NAMED} AS named,
  'u' || regexp_extract(props, '[0-9]+') AS number FROM events), log AS (
  SELECT event_id, ts, CASE event_type WHEN 'view' THEN 'use catalog ' || named
    WHEN 'click' THEN 'databricks tables list ' || u || ' ' || number
    WHEN 'error' THEN 'cat ' || named || ' ' || number
    WHEN 'purchase' THEN 'select * from ' || u || '.s.t join `' || number || '`.s.`t t` on a = b'
    WHEN 'signup' THEN 'curl https://h/api/2.1/unity-catalog/schemas?catalog_name=' || u || '&n=' || number
    ELSE 'ls' END AS text FROM parts)"""
VALUE_NAMES = ("u42", "user u14", "u7", "u143", "u69", "user u7")
_VALUE_DECIDED = (
    f"{_VALUES}, tagged AS (SELECT *, {_context('text', CATALOG_RULES)} AS in_context FROM log), "
    f"decided AS (SELECT *, CASE WHEN in_context THEN {_first('text', VALUE_NAMES)} END AS catalog FROM tagged)"
)
# Words with one space between two; in this log only single spaces stand inside a name.
_SPACED = "' ' || regexp_replace(text, '[^a-z0-9_]+', ' ', 'g') || ' '"
_LONG = f"""WITH {_VALUES}, tagged AS (
  SELECT event_id, ts, {_SPACED} AS words FROM log WHERE {_context('text', CATALOG_RULES)}), policy AS (
  SELECT CAST(c_nationkey AS BIGINT) * 1000000 + c_custkey AS pos,
    CASE WHEN c_custkey % 3 = 0 THEN 'user u' ELSE 'u' END || c_custkey AS name FROM customer), denied AS (
  SELECT event_id, arg_min(name, pos) AS catalog FROM tagged JOIN policy ON contains(words, ' ' || name || ' ') GROUP BY event_id)
SELECT event_id, {_VERDICT} AS verdict, catalog FROM log LEFT JOIN denied USING (event_id)"""
_AS_OF_TABLE = f"""WITH {_VALUES}, tagged AS (
  SELECT event_id, ts, {_SPACED} AS words FROM log WHERE {_context('text', CATALOG_RULES)}), history AS (
  SELECT c_custkey AS pos, 'U' || (c_custkey % 200) AS name, TIMESTAMP '2024-01-01' + to_minutes(20 * c_custkey) AS begins,
    CASE WHEN c_custkey % 29 <> 0 THEN TIMESTAMP '2024-01-01' + to_minutes(20 * c_custkey + 480 * (1 + c_nationkey)) END AS ends
  FROM customer), denied AS (
  SELECT event_id, arg_min(name, pos) AS catalog FROM tagged JOIN history
  ON contains(words, ' ' || lower(name) || ' ') AND ts >= begins AND (ends IS NULL OR ts < ends) GROUP BY event_id)
SELECT event_id, {_VERDICT} AS verdict, catalog FROM log LEFT JOIN denied USING (event_id)"""
_FAULTS = """WITH paired AS (
  SELECT *, c_custkey // 2 AS pair, TIMESTAMP '2024-01-01' + to_minutes(40 * ((c_custkey % 100) // 2) + 16500 * (c_custkey // 100)) AS begins FROM customer
), history AS (
  SELECT CASE WHEN c_custkey % 34 = 1 THEN 2 * pair ELSE c_custkey END AS pos,
    'u' || (CASE WHEN c_custkey % 26 = 1 THEN 2 * pair ELSE c_custkey END % 40) AS name,
    CASE WHEN c_custkey % 46 <> 0 THEN begins END AS valid_from,
    CASE WHEN c_custkey % 22 = 0 THEN begins ELSE begins + to_minutes(480 * (1 + c_nationkey)) END AS valid_to FROM paired
), valid AS (
  SELECT * FROM history WHERE valid_from < valid_to
), faults AS (
  SELECT 'no_start' AS fault, name, CAST(NULL AS TIMESTAMP) AS "at" FROM history WHERE valid_from IS NULL
  UNION SELECT 'empty_period', name, valid_from FROM history WHERE valid_from >= valid_to
  UNION SELECT 'repeated_name', name, valid_from FROM valid GROUP BY name, valid_from HAVING count(*) > 1
  UNION SELECT 'repeated_position', min(name), valid_from FROM valid GROUP BY pos, valid_from HAVING count(DISTINCT name) > 1
  UNION SELECT 'overlap', a.name, a.valid_from FROM valid a JOIN valid b ON a.name = b.name AND b.valid_from < a.valid_from AND a.valid_from < b.valid_to
  UNION SELECT 'gap', NULL, e.valid_to FROM valid e WHERE e.valid_to < (SELECT max(valid_from) FROM valid)
    AND NOT EXISTS (SELECT 1 FROM valid p WHERE p.valid_from <= e.valid_to AND e.valid_to < p.valid_to)
)
SELECT fault, name, strftime("at", '%Y-%m-%d %H:%M:%S') AS "at" FROM faults"""

_PART = r"(?:`[^`\n]+`|[\w-]+)"
_PLACES = (
    r"(?:\b(?:schemas|tables|volumes|functions)\s+list\s+|\bcatalogs\s+(?:get|create|update|delete)\s+|\bcatalog_name=|"
    r"/unity-catalog/catalogs/|\buse\s+catalog\s+|\b(?:create|drop|alter)\s+catalog\s+(?:if\s+(?:not\s+)?exists\s+)?|"
    rf"\bshow\s+(?:schemas|tables)\s+(?:in|from)\s+)({_PART}(?:\.{_PART})*)"
)
_RELATIONS = rf"(?:\b(?:from|join|into|update|table|view)\s+|\btables\s+(?:get|delete)\s+)({_PART}(?:\.{_PART})*)"


def _both(decided: str, allowed: str) -> str:
    """The targets of a command and the verdict of the written rule, beside the other one."""
    parts = f"list_transform(regexp_extract_all(n, {_quote(_PART)}), lambda p: replace(p, '`', ''))"
    return f"""{decided}, aimed AS (
  SELECT *, list_concat(list_transform(regexp_extract_all(text, {_quote(_PLACES)}, 1), lambda n: ({parts})[1]),
    list_transform(list_filter(list_transform(regexp_extract_all(text, {_quote(_RELATIONS)}, 1), lambda n: {parts}),
      lambda p: len(p) >= 3), lambda p: p[1])) AS found FROM decided), compared AS (
  SELECT *, list_filter(found, lambda t: t <> {_quote(allowed)})[1] AS prose_catalog,
    {_context('text', {k: v for k, v in CATALOG_RULES.items() if k <= 5})} AS platform FROM aimed)"""


def _gap_rows(decided: str, allowed: str, names) -> str:
    listed = f"list_contains({_list(names)}, prose_catalog)"
    return f"""WITH {_both(decided, allowed)}
SELECT event_id, CASE WHEN catalog IS NULL THEN CASE WHEN {listed} THEN 'D2' ELSE 'D1' END
  WHEN platform THEN 'D3' ELSE 'D4' END AS gap, coalesce(prose_catalog, catalog) AS gap_catalog
FROM compared WHERE (catalog IS NULL) <> (prose_catalog IS NULL)"""


_INVENTORY = f"""WITH {_VALUES}, policy AS (
  SELECT 'u' || (c_custkey + 40) AS catalog, CASE WHEN c_nationkey % 2 = 0 THEN 'deny' ELSE 'allow' END AS effect FROM customer
), known AS (SELECT 'u' || c_custkey AS catalog FROM customer WHERE c_nationkey < 20
), named AS (
  SELECT catalog, count(*) AS n FROM policy JOIN (SELECT {_SPACED} AS words FROM log WHERE {_context('text', CATALOG_RULES)})
  ON contains(words, ' ' || catalog || ' ') GROUP BY catalog)
SELECT catalog, CASE WHEN known.catalog IS NULL THEN 'not in inventory' ELSE coalesce(effect, 'unlisted') END AS status,
  coalesce(n, 0) AS n_commands
FROM policy FULL JOIN known USING (catalog) LEFT JOIN named USING (catalog)"""
_FILES = f"""WITH {_VALUE_DECIDED}, filed AS (
  SELECT event_id // 16 AS file, count(*) AS n_commands, bool_or(in_context) AS in_context, list(text) AS strings FROM decided GROUP BY file
), judged AS (
  SELECT n_commands, in_context, CASE WHEN in_context THEN {_first_of_any('strings', VALUE_NAMES)} END AS catalog FROM filed)
SELECT {_REASON} AS reason, catalog, CAST(n_commands AS INT) AS n_commands, count(*) AS n FROM judged GROUP BY ALL"""

ORACLES: dict[str, str] = {
    "payload_extract": f"WITH {_extracted(False)} {_EXTRACT}",
    "payload_extract_any_case": f"WITH {_extracted(True)} {_EXTRACT}",
    "envelope_verdict": _ENVELOPE_VERDICT,
    "context_rules": f"WITH {_LOG} "
    + " UNION ALL ".join(
        f"SELECT event_id, {rule_id} AS rule_id FROM log WHERE {_fires('text', pattern)}"
        for rule_id, pattern in CATALOG_RULES.items()
    ),
    "commands_in_context": f"WITH {_DECIDED} SELECT event_id FROM decided WHERE in_context",
    "command_verdict": _COMMAND_VERDICT,
    "command_verdict_table": _COMMAND_VERDICT,
    "verdict_reason": f"WITH {_DECIDED} SELECT event_id, {_REASON} AS reason, catalog "
    "FROM decided",
    "denied_commands": _DENIED_COMMANDS,
    "denied_commands_join": _DENIED_COMMANDS,
    "denied_commands_shuffle": _DENIED_COMMANDS,
    "command_verdict_join": _COMMAND_VERDICT,
    "allowed_commands": _ALLOWED_COMMANDS,
    "allowed_commands_anti": _ALLOWED_COMMANDS,
    "all_matches": _ALL_MATCHES,
    "all_matches_table": _ALL_MATCHES,
    "all_matches_join": _ALL_MATCHES,
    "verdict_records": f"WITH {_DENIED} SELECT event_id, false AS continue_flag, "
    "message AS stop_reason, message AS system_message, 'PreToolUse' AS event_name, "
    "'deny' AS decision, message AS decision_reason FROM denied",
    "verdict_json": f"WITH {_DENIED} SELECT event_id, {_JSON} AS value FROM denied",
    "written_verdict_lines": f"WITH {_DENIED} SELECT {_JSON} AS value FROM denied",
    "text_log_reasons": f"WITH {_AUDITED} SELECT reason, catalog, count(*) AS n "
    "FROM audited GROUP BY ALL",
    "verdict_counts": f"WITH {_DECIDED} SELECT coalesce(catalog, 'allow') AS catalog, "
    "count(*) AS n FROM decided GROUP BY ALL",
    "verdict_rollup": f"WITH {_DECIDED}, judged AS (SELECT event_type, {_VERDICT} AS verdict, "
    f"{_REASON} AS reason FROM decided) SELECT event_type, verdict, reason, count(*) AS n, "
    "CAST(grouping_id(event_type, verdict, reason) AS INTEGER) AS level "
    "FROM judged GROUP BY ROLLUP (event_type, verdict, reason)",
    "policy_coverage": _coverage(),
    "verdict_as_of": f"WITH {_history()} SELECT event_id, {_VERDICT} AS verdict, catalog "
    "FROM decided",
    "denied_as_of_join": f"WITH {_history()} SELECT event_id, catalog FROM decided "
    "WHERE catalog IS NOT NULL",
    "document_verdict": _text_verdict(
        "documents", "doc_id", "text", LICENSE_RULES, LICENSE_NAMES
    ),
    "document_terms": _DOCUMENT_TERMS,
    "document_terms_join": _DOCUMENT_TERMS,
    "document_terms_shuffle": _DOCUMENT_TERMS,
    "conversation_terms_join": "WITH log AS (SELECT conv_id, turn, lower(text) AS text "
    f"FROM conversations), decided AS (SELECT *, {_first('text', TERMS)} AS term "
    "FROM log) SELECT conv_id, turn, term FROM decided WHERE term IS NOT NULL",
    "page_verdict": _text_verdict(
        "pages", "page_id", "url || chr(10) || html", PAGE_RULES, PAGE_NAMES
    ),
    "value_verdict": f"WITH {_VALUE_DECIDED} SELECT event_id, {_VERDICT} AS verdict, catalog, {_REASON} AS reason FROM decided",
    "value_matches": f"WITH {_VALUE_DECIDED}, held AS (SELECT * FROM tagged WHERE in_context) "
    + _names_held("event_id", "catalog", "held", VALUE_NAMES),
    "command_verdict_long_policy": _LONG,
    "command_verdict_long_shuffle": _LONG,
    "verdict_as_of_table": _AS_OF_TABLE,
    "policy_history_faults": _FAULTS,
    "prose_verdict": f"WITH {_both(_DECIDED, CATALOG_ALLOWED)} SELECT event_id, {_VERDICT} AS verdict, catalog, "
    "CASE WHEN prose_catalog IS NULL THEN 'allow' ELSE 'deny' END AS prose_verdict, prose_catalog, "
    "array_to_string(list_filter(found, lambda t, i: list_position(found, t) = i), ',') AS targets FROM compared",
    "policy_gaps": _gap_rows(_DECIDED, CATALOG_ALLOWED, CATALOG_NAMES),
    "value_policy_gaps": _gap_rows(_VALUE_DECIDED, "u8", VALUE_NAMES),
    "inventory_coverage": _INVENTORY,
    "stream_verdict": _COMMAND_VERDICT,
    "stream_verdict_table": _LONG,
    "whole_file_reasons": _FILES,
    "stream_payload_verdict": _ENVELOPE_VERDICT,
}
