"""The registered queries: every operator over a whole table."""

from __future__ import annotations

import functools
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commandwatch.operators import (
    all_matches,
    allowed,
    allowed_rest,
    classify,
    classify_as_of,
    classify_as_of_table,
    classify_by_table,
    denials,
    deny_by_table,
    extract_command,
    first_match,
    history_faults,
    in_context,
    match_policy_table,
    policy_coverage,
    policy_gaps,
    prose_verdict,
    tag_rules,
    verdict_counts,
    verdict_json,
    verdict_records,
    verdict_rollup,
)
from commandwatch.plans import policies
from commandwatch.plans.audit import audit
from commandwatch.operators.prose import PLATFORM_RULES
from commandwatch.plans.event_log import command_log, payload_files, payload_log, value_log
from commandwatch.policy import (
    CATALOG_INVENTORY,
    CATALOG_POLICY,
    CATALOG_RULES,
    Policy,
    rules_from_table,
    rules_to_table,
)
from commandwatch.sources import (
    many_small_files,
    read_log,
    read_text_log,
    scratch_dir,
    stream_log,
    stream_text_log,
    write_bucketed,
    write_files,
    write_verdict_lines,
)
from commandwatch.streaming import start_audit, start_table_audit

KEY = ["event_id"]
BUCKETS = 8
#: Files in a folder that a stream takes in; the driver holds what it knows of each.
FILES_AT_ONCE = 50_000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_log(spark, f"{sf_dir}/{name}.parquet")


def _commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return command_log(_table(spark, sf_dir, "events"))


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payload_log(_table(spark, sf_dir, "events"))


def _verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(_commands(spark, sf_dir), CATALOG_RULES, CATALOG_POLICY)


def _table_matches(
    spark: SparkSession, sf_dir: str, strategy: str | None = "broadcast"
) -> DataFrame:
    return match_policy_table(
        _commands(spark, sf_dir),
        CATALOG_RULES,
        CATALOG_POLICY.to_table(spark),
        KEY,
        strategy=strategy,
    )


def _extracted(spark: SparkSession, sf_dir: str, ignore_key_case: bool) -> DataFrame:
    found = extract_command(_payloads(spark, sf_dir), ignore_key_case=ignore_key_case)
    lines = F.array_join("arguments", "\n").alias("arguments")
    return found.select("event_id", "command", lines, "reason")


def payload_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extracted(spark, sf_dir, ignore_key_case=False)


def payload_extract_any_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extracted(spark, sf_dir, ignore_key_case=True)


def envelope_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = audit(_payloads(spark, sf_dir))
    return decided.select("event_id", "verdict", "catalog", "reason")


def context_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = rules_from_table(rules_to_table(spark, CATALOG_RULES))
    return tag_rules(_commands(spark, sf_dir), rules).select("event_id", "rule_id")


def commands_in_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_context(_commands(spark, sf_dir), CATALOG_RULES).select("event_id")


def command_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _verdicts(spark, sf_dir).select("event_id", "verdict", "catalog")


def verdict_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    policy = Policy.from_table(CATALOG_POLICY.to_table(spark))
    decided = classify(_commands(spark, sf_dir), CATALOG_RULES, policy)
    return decided.select("event_id", "reason", "catalog")


def denied_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return denials(_verdicts(spark, sf_dir)).select("event_id", "catalog")


def denied_commands_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_match(_table_matches(spark, sf_dir), KEY)


def denied_commands_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_match(_table_matches(spark, sf_dir, "shuffle"), KEY)


def command_verdict_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    policy = CATALOG_POLICY.to_table(spark)
    decided = classify_by_table(_commands(spark, sf_dir), CATALOG_RULES, policy, KEY)
    return decided.select("event_id", "verdict", "catalog")


def command_verdict_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    denied = denied_commands_join(spark, sf_dir)
    log = _commands(spark, sf_dir)
    return deny_by_table(log, denied, KEY).select("event_id", "verdict", "catalog")


def allowed_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return allowed(_verdicts(spark, sf_dir)).select("event_id")


def allowed_commands_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log and the denials are written in the same buckets, and joined as they lie."""
    base = scratch_dir(spark, "anti")
    made = base.rsplit("-", 1)[-1]
    log = _commands(spark, sf_dir).select("event_id", "command")
    log = write_bucketed(log, f"log_{made}", f"{base}/log", KEY, BUCKETS)
    denied = classify(log, CATALOG_RULES, CATALOG_POLICY).filter("verdict = 'deny'").select("event_id")
    denied = write_bucketed(denied, f"denied_{made}", f"{base}/denied", KEY, BUCKETS)
    return allowed_rest(log, denied, KEY).select("event_id")


def inline_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = all_matches(_commands(spark, sf_dir), CATALOG_RULES, CATALOG_POLICY)
    return found.select("event_id", "catalog")


def table_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table_matches(spark, sf_dir, None).select("event_id", "catalog")


def join_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table_matches(spark, sf_dir).select("event_id", "catalog")


def verdict_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    denied = denials(_verdicts(spark, sf_dir))
    nested = "record.hookSpecificOutput"
    return verdict_records(denied, CATALOG_POLICY.allowed).select(
        "event_id",
        F.col("record.continue").alias("continue_flag"),
        F.col("record.stopReason").alias("stop_reason"),
        F.col("record.systemMessage").alias("system_message"),
        F.col(f"{nested}.hookEventName").alias("event_name"),
        F.col(f"{nested}.permissionDecision").alias("decision"),
        F.col(f"{nested}.permissionDecisionReason").alias("decision_reason"),
    )


def verdict_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    denied = denials(_verdicts(spark, sf_dir))
    return verdict_json(denied, CATALOG_POLICY.allowed).select("event_id", "value")


def written_verdict_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "verdict-lines") + "/out"
    write_verdict_lines(denials(_verdicts(spark, sf_dir)), CATALOG_POLICY.allowed, path)
    return spark.read.text(path)


def text_log_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "payload-lines") + "/out"
    _payloads(spark, sf_dir).select("payload").write.text(path)
    decided = audit(read_text_log(spark, path))
    return decided.groupBy("reason", "catalog").agg(F.count("*").alias("n"))


def verdict_counts_by_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdict_counts(_verdicts(spark, sf_dir)).select("catalog", "n")


def verdict_subtotals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdict_rollup(_verdicts(spark, sf_dir), "event_type", "verdict", "reason")


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    mentions = all_matches(
        _commands(spark, sf_dir), CATALOG_RULES, Policy(denied=CATALOG_INVENTORY)
    )
    return policy_coverage(spark, CATALOG_INVENTORY, CATALOG_POLICY, mentions)


def verdict_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = classify_as_of(
        _commands(spark, sf_dir), CATALOG_RULES, policies.HISTORY, at="ts"
    )
    return decided.select("event_id", "verdict", "catalog")


def denied_as_of_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches = match_policy_table(
        _commands(spark, sf_dir),
        CATALOG_RULES,
        policies.history_table(spark),
        KEY,
        as_of="ts",
    )
    return first_match(matches, KEY)


def document_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = classify(
        _table(spark, sf_dir, "documents"),
        policies.LICENSE_RULES,
        policies.LICENSE_POLICY,
        command="text",
    )
    return decided.select("doc_id", "verdict", F.col("catalog").alias("term"), "reason")


def document_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = all_matches(
        _table(spark, sf_dir, "documents"),
        policies.ANY_TEXT,
        Policy(denied=policies.TERMS),
        command="text",
    )
    return found.select("doc_id", F.col("catalog").alias("term"))


def _document_terms(spark: SparkSession, sf_dir: str, strategy: str) -> DataFrame:
    found = match_policy_table(
        _table(spark, sf_dir, "documents"),
        policies.ANY_TEXT,
        policies.term_table(spark),
        ["doc_id"],
        command="text",
        strategy=strategy,
    )
    return found.select("doc_id", F.col("catalog").alias("term"))


def document_terms_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _document_terms(spark, sf_dir, "broadcast")


def document_terms_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _document_terms(spark, sf_dir, "shuffle")


def conversation_terms_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = ["conv_id", "turn"]
    found = match_policy_table(
        _table(spark, sf_dir, "conversations"),
        policies.ANY_TEXT,
        policies.term_table(spark),
        key,
        command="text",
        strategy="broadcast",
    )
    first = first_match(found, key)
    return first.select(*key, F.col("catalog").alias("term"))


def page_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").withColumn(
        "text", F.concat_ws("\n", "url", "html")
    )
    decided = classify(pages, policies.PAGE_RULES, policies.PAGE_POLICY, command="text")
    return decided.select("page_id", "verdict", F.col("catalog").alias("term"), "reason")


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = _table(spark, sf_dir, "events").schema
    return stream_log(spark, f"{sf_dir}/events*.parquet", schema)


def _run_stream(spark: SparkSession, verdicts: DataFrame) -> DataFrame:
    base = scratch_dir(spark, "audit-stream")
    start_audit(verdicts, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema(verdicts.schema).parquet(f"{base}/out")


def stream_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = command_log(_event_stream(spark, sf_dir))
    decided = classify(log, CATALOG_RULES, CATALOG_POLICY)
    return _run_stream(spark, decided.select("event_id", "verdict", "catalog"))


def stream_payload_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = audit(payload_log(_event_stream(spark, sf_dir)))
    return _run_stream(spark, decided.select("event_id", "verdict", "catalog", "reason"))


def _values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_log(_table(spark, sf_dir, "events"))


def value_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = classify(_values(spark, sf_dir), CATALOG_RULES, policies.VALUE_POLICY)
    return decided.select("event_id", "verdict", "catalog", "reason")


def value_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = all_matches(_values(spark, sf_dir), CATALOG_RULES, policies.VALUE_POLICY)
    return found.select("event_id", "catalog")


def _long_policy_verdict(spark: SparkSession, sf_dir: str, strategy: str) -> DataFrame:
    decided = classify_by_table(
        _values(spark, sf_dir),
        CATALOG_RULES,
        policies.customer_policy(_table(spark, sf_dir, "customer")),
        strategy=strategy,
    )
    return decided.select("event_id", "verdict", "catalog")


def command_verdict_long_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long_policy_verdict(spark, sf_dir, "broadcast")


def command_verdict_long_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long_policy_verdict(spark, sf_dir, "shuffle")


def verdict_as_of_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = policies.customer_history(_table(spark, sf_dir, "customer"))
    decided = classify_as_of_table(_values(spark, sf_dir), CATALOG_RULES, history, at="ts")
    return decided.select("event_id", "verdict", "catalog")


def policy_history_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = history_faults(policies.faulty_history(_table(spark, sf_dir, "customer")))
    return found.select("fault", "name", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("at"))


def _both_verdicts(log: DataFrame, policy: Policy) -> DataFrame:
    return prose_verdict(classify(log, CATALOG_RULES, policy), policy.allowed)


def prose_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = _both_verdicts(_commands(spark, sf_dir), CATALOG_POLICY)
    targets = F.array_join("targets", ",").alias("targets")
    return decided.select("event_id", "verdict", "catalog", "prose_verdict", "prose_catalog", targets)


def _gaps(log: DataFrame, policy: Policy) -> DataFrame:
    platform = [rule for rule in CATALOG_RULES if rule.rule_id in PLATFORM_RULES]
    tagged = classify(log, platform, Policy(denied=()))
    tagged = tagged.withColumn("platform", F.col("reason") == "no_match").drop("verdict", "catalog", "reason")
    return policy_gaps(_both_verdicts(tagged, policy), policy).select("event_id", "gap", "gap_catalog")


def command_policy_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gaps(_commands(spark, sf_dir), CATALOG_POLICY)


def value_policy_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gaps(_values(spark, sf_dir), policies.VALUE_POLICY)


def inventory_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _table(spark, sf_dir, "customer")
    effects = policies.customer_effects(customer)
    every = effects.select("pos", "name")
    named = match_policy_table(_values(spark, sf_dir), CATALOG_RULES, every, KEY, strategy="broadcast")
    return policy_coverage(spark, policies.customer_inventory(customer), effects, named)


def stream_verdict_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    policy = policies.customer_policy(_table(spark, sf_dir, "customer"))
    log = value_log(_event_stream(spark, sf_dir))
    base = scratch_dir(spark, "audit-table")
    query = start_table_audit(log, CATALOG_RULES, policy, f"{base}/out", f"{base}/checkpoint", strategy="broadcast")
    query.awaitTermination()
    return spark.read.parquet(f"{base}/out").select("event_id", "verdict", "catalog")


def whole_file_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_dir(spark, "payload-files")
    # One payload in each file. What takes time is their number, not their size, so all tasks
    # write as many.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folders = write_files(payload_files(_values(spark, sf_dir), tasks=tasks), f"{base}/in", tasks, FILES_AT_ONCE)

    def audited(k: int) -> DataFrame:
        log = stream_text_log(spark, folders[k], whole_files=True, compressed=False)
        decided = audit(log, policy=policies.VALUE_POLICY).select("reason", "catalog", F.size("arguments").alias("n_commands"))
        out = f"{base}/out-{k}" if k else f"{base}/out"
        # Each part of a scan would write a file of its own.
        start_audit(decided.coalesce(tasks), out, f"{base}/checkpoint-{k}").awaitTermination()
        return spark.read.schema(decided.schema).parquet(out)

    # While the driver lists and plans one folder, the tasks of another run.
    with many_small_files(spark, tasks), ThreadPoolExecutor(2) as side_by_side:
        parts = list(side_by_side.map(audited, range(len(folders))))
    written = functools.reduce(DataFrame.unionAll, parts)
    return written.groupBy("reason", "catalog", "n_commands").agg(F.count("*").alias("n"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "payload_extract": payload_extract,
    "payload_extract_any_case": payload_extract_any_case,
    "envelope_verdict": envelope_verdict,
    "context_rules": context_rules,
    "commands_in_context": commands_in_context,
    "command_verdict": command_verdict,
    "command_verdict_table": command_verdict_table,
    "verdict_reason": verdict_reason,
    "denied_commands": denied_commands,
    "denied_commands_join": denied_commands_join,
    "denied_commands_shuffle": denied_commands_shuffle,
    "command_verdict_join": command_verdict_join,
    "allowed_commands": allowed_commands,
    "allowed_commands_anti": allowed_commands_anti,
    "all_matches": inline_matches,
    "all_matches_table": table_matches,
    "all_matches_join": join_matches,
    "verdict_records": verdict_fields,
    "verdict_json": verdict_lines,
    "written_verdict_lines": written_verdict_lines,
    "text_log_reasons": text_log_reasons,
    "verdict_counts": verdict_counts_by_catalog,
    "verdict_rollup": verdict_subtotals,
    "policy_coverage": coverage,
    "verdict_as_of": verdict_as_of,
    "denied_as_of_join": denied_as_of_join,
    "document_verdict": document_verdict,
    "document_terms": document_terms,
    "document_terms_join": document_terms_join,
    "document_terms_shuffle": document_terms_shuffle,
    "conversation_terms_join": conversation_terms_join,
    "page_verdict": page_verdict,
    "value_verdict": value_verdict,
    "value_matches": value_matches,
    "command_verdict_long_policy": command_verdict_long_policy,
    "command_verdict_long_shuffle": command_verdict_long_shuffle,
    "verdict_as_of_table": verdict_as_of_table,
    "policy_history_faults": policy_history_faults,
    "prose_verdict": prose_verdicts,
    "policy_gaps": command_policy_gaps,
    "value_policy_gaps": value_policy_gaps,
    "inventory_coverage": inventory_coverage,
    "stream_verdict": stream_verdict,
    "stream_verdict_table": stream_verdict_table,
    "whole_file_reasons": whole_file_reasons,
    "stream_payload_verdict": stream_payload_verdict,
}
