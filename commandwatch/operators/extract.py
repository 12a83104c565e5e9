"""Take the command out of a JSON payload, with a reason where there is none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commandwatch.functions.staged import once

EMPTY_PAYLOAD = "empty_payload"
MALFORMED = "malformed"
NO_COMMAND = "no_command"
NON_STRING_COMMAND = "non_string_command"
DEEP_COMMAND = "deep_command"

# The payload is parsed as the only element of a list in an outer object with a closing flag:
# trailing text, a second document or a missing brace leave the flag null or make the list
# longer, where the JSON functions alone would accept the payload. Text that would end the
# list and go on with other keys can't stand there without the list's brackets as well, so
# a payload in which it may occur has to be valid in both frames.
_LISTED = '{"body":[', '],"complete":true}'
_PLAIN = '{"body":', ',"complete":true}'
_LEAVES_LIST = r'\]\s*,\s*"'
_MAIN = "body ARRAY<STRUCT<tool_input: STRUCT<command: STRING>>>, complete BOOLEAN, corrupt STRING"
_WHOLE = "complete BOOLEAN, corrupt STRING"
# No limits of the reader's own: a long command or a deep sibling isn't a broken payload.
_OPTIONS = {
    "columnNameOfCorruptRecord": "corrupt",
    "maxStringLen": str(2**31 - 1),
    "maxNestingDepth": str(2**31 - 1),
}
# As text, a command that isn't a string looks like one of these; so may a string.
_MAYBE_NO_STRING = r'^(?:[\[{]|[-+]?[0-9]|"?[-+]?(?:NaN|INF|Infinity)"?$|(?:true|false)$)'
# In the text of an object, a list, an object or a boolean is behind a colon; so may be a part
# of a string. It is another than the one read where a key is repeated.
_MAYBE_NO_STRING_IN = r":\s*[\[{tf]"


def _parsed(text: Column, schema: str) -> Column:
    return F.from_json(text, schema, _OPTIONS)


def _framed(payload: Column, frame: tuple[str, str]) -> Column:
    return F.concat(F.lit(frame[0]), payload, F.lit(frame[1]))


def _lower_keys(payload: Column) -> Column:
    """Lowercase the keys on the path. In valid JSON a quoted word before a colon is a key."""
    for key in ("tool_input", "command"):
        payload = F.regexp_replace(payload, rf'(?i)"{key}"(?=\s*:)', f'"{key}"')
    return payload


def _validity(json: Column, payload: Column, text: Column) -> Column:
    """Is the payload one JSON value by itself? ``text`` is what has been parsed of it."""

    def whole(frame: tuple[str, str]) -> Column:
        found = _parsed(_framed(text, frame), _WHOLE)
        return found["corrupt"].isNull() & found["complete"].isNotNull()

    fits = json["corrupt"].isNull() & json["complete"].isNotNull()
    stays = ~(F.contains(payload, F.lit("]")) & payload.rlike(_LEAVES_LIST))
    alone = F.size(json["body"]) == 1
    # A record is also corrupt if it is valid but of another shape; only then parse again.
    return F.when(fits & stays, alone).otherwise(whole(_LISTED) & whole(_PLAIN) & (~fits | alone))


def _objects(found: Column) -> Column:
    return F.filter(found, lambda e: e.startswith("{"))


def _collected(payload: Column) -> Column:
    """Every value at the command's path, also through lists of payloads and of inputs: as
    text, as a list of strings if it is a list, and whether it is another kind of value."""

    def inputs(entry: Column) -> Column:
        # Only a list has a bracket; to find that an object is none would cost an exception.
        listed = F.when(F.contains(entry, F.lit("[")), _parsed(entry, "tool_input ARRAY<STRING>")["tool_input"])
        plain = _parsed(entry, "tool_input STRUCT<command: STRING>")["tool_input"]
        one = F.array(_parsed(entry, "tool_input STRING")["tool_input"])
        nothing = F.array().cast("array<string>")
        return F.when(listed.isNotNull(), _objects(listed)).when(plain.isNotNull(), one).otherwise(nothing)

    def as_(input_: Column, kind: str) -> Column:
        return _parsed(input_, f"command {kind}")["command"]

    def told(input_: Column) -> Column:
        return F.struct(input_.alias("input"), as_(input_, "STRING").alias("text"))

    def command(c: Column) -> Column:
        # Each other kind that a string is not costs an exception, so they are tried on few.
        input_, text = c["input"], c["text"]
        maybe = text.isNull() | text.startswith('"') | text.rlike(_MAYBE_NO_STRING) | input_.rlike(_MAYBE_NO_STRING_IN)
        number = as_(input_, "DOUBLE").isNotNull() & text.rlike(r'^(?:[-+]?[0-9]|")')
        other = as_(input_, "MAP<STRING, STRING>").isNotNull() | as_(input_, "BOOLEAN").isNotNull() | number
        return F.struct(
            text.alias("text"),
            F.when(maybe, as_(input_, "ARRAY<STRING>")).alias("list"),
            F.when(maybe, other).otherwise(False).alias("other"),
        )

    listed = _parsed(_framed(payload, _PLAIN), "body ARRAY<STRING>, corrupt STRING")
    # Any value can be read as a string, unless it is too deep; then the list is unknown.
    read = F.get(F.transform(F.array(listed), lambda r: F.when(r["corrupt"].isNull(), _objects(r["body"]))), F.lit(0))
    entries = F.when(F.ltrim(payload).startswith("["), read).otherwise(F.array(payload))
    return F.transform(F.transform(F.flatten(F.transform(entries, inputs)), told), command)


def _strings(found: Column) -> Column:
    """All strings among the collected commands; nulls in lists are passed over."""

    def strings(c: Column) -> Column:
        listed = F.filter(c["list"], lambda e: e.isNotNull())
        none = F.array().cast("array<string>")
        return F.when(c["list"].isNotNull(), listed).when(c["text"].isNotNull(), F.array(c["text"])).otherwise(none)

    return F.flatten(F.transform(found, strings))


def _has_no_string(found: Column) -> Column:
    """Is any collected command, or any element of a list, neither a string nor null? Only
    a list of strings and nulls reads the same when it is written again."""
    return F.exists(
        found,
        lambda c: F.coalesce(c["other"], F.lit(False))
        | (c["list"].isNotNull() & (F.to_json(c["list"]) != c["text"])),
    )


def extract_command(
    log: DataFrame, payload: str = "payload", ignore_key_case: bool = True
) -> DataFrame:
    """Add ``command``, ``arguments`` and ``reason`` to a log of JSON payloads.

    ``command`` is the non-empty string at ``tool_input.command``. If that is a list of
    strings, or the payload or its input is a list, all strings found there are
    ``arguments`` (a single one is the command), to be matched one by one; nulls are passed
    over. Where both are null, ``reason`` says why. Of repeated keys the last one counts.
    ``Tool_Input.Command`` and the like are accepted too, unless ``ignore_key_case`` is off.

    Nothing recurses into a value: a command nested deeper than the JSON writer allows (1,000
    levels) is a ``deep_command``, whatever its depth, and siblings may be of any depth.
    """
    lowered, text = log, F.col(payload)
    if ignore_key_case:
        lowered, text = once(log, "_lowered", _lower_keys(text)), F.col("_lowered")
    parsed = lowered.withColumn("_json", _parsed(_framed(text, _LISTED), _MAIN))
    json, raw = F.col("_json"), F.col(payload)
    entry = F.get(json["body"], F.lit(0))
    found_text = entry["tool_input"]["command"]
    is_object = F.ltrim(raw).startswith("{")
    lost = entry.isNull() | (entry["tool_input"].isNotNull() & found_text.isNull())
    state = F.struct(
        (F.coalesce(F.length(raw), F.lit(0)) == 0).alias("empty"),
        F.coalesce(_validity(json, raw, text), F.lit(False)).alias("complete"),
        found_text.alias("text"),
        # Only a value that can't be written as text again is lost on its way to a string.
        (json["corrupt"].isNotNull() & is_object & lost).alias("deep"),
    )
    known = once(parsed, "_read", state)
    state = F.col("_read")
    readable = state["complete"] & ~state["empty"] & ~state["deep"]
    # Without a bracket there is no list to look into.
    listed = state["text"].isNull() & F.contains(raw, F.lit("["))
    odd = readable & F.coalesce(state["text"].rlike(_MAYBE_NO_STRING), listed)

    def judged(found: Column) -> Column:
        return F.struct(
            _strings(found).alias("strings"),
            F.coalesce(_has_no_string(found), F.lit(False)).alias("no_string"),
        )

    looked = F.get(F.transform(F.array(_collected(text)), judged), F.lit(0))
    known = known.withColumn("_odd", F.when(odd, looked))
    plain = F.col("_odd").isNull()
    given, no_string = F.col("_odd.strings"), F.coalesce(F.col("_odd.no_string"), F.lit(False))
    # A list with an element that is too deep is null as a whole.
    deep = state["deep"] | (~plain & ~no_string & given.isNull())
    single = F.when(plain, state["text"]).when(F.size(given) == 1, F.get(given, F.lit(0)))
    command = F.when(readable & ~no_string & (single != ""), single)
    several = F.when(~plain & ~no_string & (F.size(given) > 1), given)
    return known.select(
        *(name for name in log.columns if name not in ("command", "arguments", "reason")),
        command.alias("command"),
        several.alias("arguments"),
        F.when(state["empty"], EMPTY_PAYLOAD)
        .when(~state["complete"], MALFORMED)
        .when(deep, DEEP_COMMAND)
        .when(no_string, NON_STRING_COMMAND)
        .when(command.isNull() & several.isNull(), NO_COMMAND)
        .alias("reason"),
    )
