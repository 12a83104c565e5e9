"""Command and payload logs derived from the ``events`` table.

Each event stands for one logged command. Its id picks the kind of command; in every
second round the command also carries the event's own values in a trailing comment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# One command per behaviour that a verdict must get right.
COMMANDS = (
    "databricks-connect test samples.x",
    "databricks catalogs list",
    "databricks schemas list system",
    "databricks tables list samples nyctaxi",
    "databricks tables list gops_dev bronze",
    "databricks schemas list sandbox_hackaton",
    "databricks schemas list sandbox_others",
    "cat system samples",
    "databricks tables list samples system",
    "DATABRICKS Schemas LIST System",
    "select * from system.access.audit",
    "create catalog gops_dev",
    "select 1;\nshow catalog system",
    "show schemas in samples",
    "show \t tables in system",
    "use catalog sandbox_hackaton",
    "reuse catalogue system",
    "curl https://adb-1.azuredatabricks.net/x?c=samples",
    "curl https://h/api/2.1/unity-catalog/schemas?catalog_name=gops_dev",
    "curl https://h/api/2.0/unity-catalog_x/system",
    "curl https://h/api/2.2/unity-catalogs/system",
    "databricks tables list system_tables",
    "databricks fs ls dbfs:/system/x",
    "databricks tables list main",
    "databricks_x system",
    "curl https://x.cloud.databricks.com/samples",
    "drop schema a; alter catalog samples",
    "select catalog_name from system.x",
    "git update catalog readme for samples",
    "insert into sandbox_others.t select * from catalog.system.t",
)

# Payloads around the edges of the format.
ENVELOPES = (
    "",
    "not json",
    "{}",
    '{"tool_input":{}}',
    '{"tool_input":{"command":""}}',
    '{"tool_input":{"command":null}}',
    '{"tool_name":"Read","tool_input":{"command":"databricks schemas list system"}}',
    '{"Tool_Input":{"Command":"databricks schemas list system"}}',
    '{"tool_input":{"command":5}}',
    '{"tool_input":{"command":"use catalog\\n samples"}}',
    '{"tool_input":{"command":"use catalog samples"}},"x":1',
    '{"tool_input":{"command":"ls"}},"body":{"tool_input":{"command":"use catalog system"}}',
    '{"tool_input":{"command":"use catalog system"}},{"tool_input":{"command":"ls"}}',
    '{"tool_input":{"command":["databricks","schemas","list","system"]}}',
    '{"tool_input":{"command":["drop schema a","alter catalog","samples","gops_dev"]}}',
    '{"tool_input":{"command":["use","catalog system"]}}',
    '{"tool_input":{"command":["use catalog system"]}}',
    '{"tool_input":{"command":["use catalog system",5]}}',
    '{"tool_input":{"command":["use catalog",null,"not_system"]}}',
    '{"tool_input":{"command":[]}}',
    '{"tool_input":{"command":"[\\"use catalog\\",\\"system\\"]"}}',
    '[{"tool_input":{"command":"ls"}},{"tool_input":{"command":["use catalog","gops_dev"]}}]',
    '[{"tool_input":{"command":"use catalog samples"}},null,{"tool_name":"Read"}]',
    '{"tool_input":[{"command":"show tables"},{"command":"cat samples"}]}',
    '{"tool_input":{"command":' + "[" * 1_500 + "]" * 1_500 + "}}",
)
#: Levels of a value that can still be read.
DEEPEST = 1_000


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (index + 1).cast("int"))


def _command(events: DataFrame, slot: Column, rounds: Column) -> Column:
    user = F.col("user_id").cast("string")
    comment = F.concat(F.lit(" # "), F.concat_ws(" ", "event_type", user, "props"))
    return F.concat(_pick(COMMANDS, slot), F.when(rounds % 2 == 1, comment).otherwise(""))


def command_log(events: DataFrame) -> DataFrame:
    """event_id, ts, event_type, command."""
    event_id = F.col("event_id")
    n = len(COMMANDS)
    command = _command(events, event_id % n, F.floor(event_id / n))
    return events.select("event_id", "ts", "event_type", command.alias("command"))


def payload_log(events: DataFrame) -> DataFrame:
    """event_id, ts, payload: commands in JSON, and every kind of odd payload."""
    n = len(COMMANDS) + len(ENVELOPES)
    event_id = F.col("event_id")
    slot = event_id % n
    wrapped = F.to_json(
        F.struct(
            F.lit("Bash").alias("tool_name"),
            F.struct(
                _command(events, slot, F.floor(event_id / n)).alias("command"),
                F.col("props").alias("description"),
            ).alias("tool_input"),
            F.struct("user_id", "event_type").alias("session"),
        )
    )
    odd = _pick(ENVELOPES, slot - len(COMMANDS))
    payload = F.when(slot < len(COMMANDS), wrapped).otherwise(odd)
    return events.select("event_id", "ts", payload.alias("payload"))


def value_log(events: DataFrame) -> DataFrame:
    """event_id, ts, command: the event's own values make the command and the names in it.

    The catalogs are u<user_id>, spelled as "user u<user_id>" for every seventh user; the type
    of the event picks the kind of command, and a number in its properties a further name.
    """
    user = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    named = F.when(F.col("user_id") % 7 == 0, F.concat(F.lit("user "), user)).otherwise(user)
    number = F.concat(F.lit("u"), F.regexp_extract("props", "([0-9]+)", 1))

    def kind(event_type: str, *parts: str | Column) -> tuple[Column, Column]:
        texts = (F.lit(p) if isinstance(p, str) else p for p in parts)
        return F.col("event_type") == event_type, F.concat(*texts)

    command = F.lit("ls")
    for condition, text in (
        kind("view", "use catalog ", named),
        kind("click", "databricks tables list ", user, " ", number),
        kind("error", "cat ", named, " ", number),
        kind("purchase", "select * from ", user, ".s.t", " join `", number, "`.s.`t t` on a = b"),
        kind("signup", "curl https://h/api/2.1/unity-catalog/schemas?catalog_name=", user, "&n=", number),
    ):
        command = F.when(condition, text).otherwise(command)
    return events.select("event_id", "ts", command.alias("command"))


def payload_files(log: DataFrame, per_file: int = 16, tasks: int | None = None) -> DataFrame:
    """payload: a list of the payloads of up to ``per_file`` commands, indented over many lines.

    With ``tasks`` they are dealt to as many partitions, however few bytes they are.
    """
    wrapped = F.to_json(F.struct("command"))
    payload = F.concat(F.lit('{\n  "tool_input":\n    '), wrapped, F.lit("\n}"))
    rows = log.select(F.floor(F.col("event_id") / per_file).alias("file"), F.struct("event_id", payload.alias("payload")).alias("row"))
    rows = rows.repartition(tasks, "file") if tasks else rows
    grouped = rows.groupBy("file").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    listed = F.array_join(F.transform("rows", lambda r: r["payload"]), ",\n")
    return grouped.select(F.concat(F.lit("[\n"), listed, F.lit("\n]")).alias("payload"))
