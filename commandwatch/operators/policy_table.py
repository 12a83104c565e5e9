r"""Match commands against a policy table of any size.

A short table becomes part of the plan, a longer one is joined. A name is held as a whole word
exactly if it equals an n-gram of the command: so many words in a row with what lies between
them (and, if a name begins or ends with other characters, all that lies between its end and
the next word). So the match is an equi-join on the n-grams of the lengths that occur in the
policy. Texts are read once, and only their n-grams travel.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commandwatch.functions.staged import explode_hits
from commandwatch.functions.text import REGEX_FLAGS, word_hit
from commandwatch.operators.classify import ALLOW, DENY, classify, with_context
from commandwatch.operators.periods import bins_of, in_bins, in_force, merged_periods
from commandwatch.policy import MAX_INLINE_NAMES, Policy, Rule

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
#: N-grams whose number is measured, and the counters that the sketch keeps for that.
HEAVY, COUNTERS = 256, 8_192
#: Names up to which their hashes, 8 bytes each, go to all tasks before a shuffle join.
MAX_HASHED_ROWS = 4_000_000


@dataclass(frozen=True)
class Shape:
    """Names of so many words that begin or end with other characters or don't."""

    words: int
    leads: bool
    trails: bool

    @property
    def pattern(self) -> str:
        """One match for each word (or gap) at which an n-gram of this shape begins."""
        gram = r"\w++" + rf"(?:\W++\w++){{{self.words - 1}}}" * (self.words > 1)
        if self == Shape(1, False, False):
            return f"({gram})"  # the same matches, found without looking ahead
        gram = r"\W++" * self.leads + gram + r"\W++(?=\w)" * self.trails
        return rf"(?<=\w)(?=({gram}))\W" if self.leads else rf"(?=({gram}))\w++"


@dataclass(frozen=True)
class Extent:
    """What is measured of a policy before it is joined."""

    shapes: tuple[Shape, ...]
    rows: int
    size: int
    longest: int

    @property
    def fits(self) -> bool:
        return self.rows <= MAX_BROADCAST_ROWS and self.size <= MAX_BROADCAST_BYTES


def _denied(policy: DataFrame) -> DataFrame:
    return policy.filter("effect = 'deny'") if "effect" in policy.columns else policy


def _denied_names(policy: DataFrame, as_of: str | None) -> DataFrame:
    rows = _denied(policy).filter(F.col("name").isNotNull())
    columns = [F.col(name).alias(f"_{name}") for name in ("pos", "name")]
    if as_of:
        columns += [rows[name].alias(f"_{name}") for name in ("valid_from", "valid_to")]
    return rows.select(*columns, F.lower("name").alias("_gram"))


def _extent(names: DataFrame) -> Extent:
    gram = F.col("_gram")
    sizes = names.groupBy(
        F.size(F.regexp_extract_all(gram, F.lit(REGEX_FLAGS + r"(\w+)"))).alias("words"),
        gram.rlike(REGEX_FLAGS + r"^\W").alias("leads"),
        gram.rlike(REGEX_FLAGS + r"\W\z").alias("trails"),
    ).agg(
        F.count("*").alias("rows"),
        F.sum(2 * F.octet_length("_name")).alias("size"),
        F.max(F.length(gram)).alias("longest"),
    )
    found = sizes.filter("words IS NOT NULL").collect()
    if any(not row.words for row in found):
        raise ValueError("a denied name needs at least one word character")
    return Extent(
        tuple(sorted((Shape(r.words, r.leads, r.trails) for r in found), key=repr)),
        sum(row.rows for row in found),
        sum(row.size for row in found),
        max((row.longest for row in found), default=0),
    )


def _grams(texts: DataFrame, extent: Extent) -> DataFrame:
    """One row for each n-gram of a text that could be a name, the text left out."""
    found = [
        F.regexp_extract_all("_text", F.lit(REGEX_FLAGS + shape.pattern), 1)
        for shape in extent.shapes
    ]
    short = F.filter(F.concat(*found), lambda gram: F.length(gram) <= extent.longest)
    kept = [name for name in texts.columns if name != "_text"]
    # explode() would add a filter on the number of n-grams that reads the text once more.
    return texts.select(*kept, F.explode_outer(F.array_distinct(short)).alias("_gram"))


def _likely(grams: DataFrame, hashes: DataFrame) -> DataFrame:
    """The n-grams with the hash of a name: all that match, and hardly another one, so that a
    shuffle carries as many rows as there are matches and not as many as there are words."""
    return grams.join(F.broadcast(hashes), F.xxhash64("_gram") == F.col("_hash"), "left_semi")


# Joins -------------------------------------------------------------------------------------


def _match_inline(texts: DataFrame, names: DataFrame, key: list[str]) -> DataFrame:
    pos_type = names.schema["_pos"].dataType
    cases = []
    for pos, name in names.select("_pos", "_name").collect():
        label = F.struct(
            F.lit(pos).cast(pos_type).alias("pos"), F.lit(name).alias("catalog")
        )
        cases.append((word_hit(F.col("_text"), name), label))
    return explode_hits(texts, "_hit", cases).select(*key, "_hit.pos", "_hit.catalog")


def _salts(grams: DataFrame) -> dict[int, int]:
    """By hash of an n-gram: over how many tasks to spread it, if it is among the most
    frequent ones and has more than one task's share."""
    tasks = int(grams.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    top = F.expr(f"approx_top_k(xxhash64(_gram), {HEAVY}, {COUNTERS})").alias("top")
    row = grams.filter("_gram IS NOT NULL").agg(top, F.count("*").alias("n")).first()
    share = max(1, row.n // tasks)
    found = {x["item"]: min(tasks, -(-x["count"] // share)) for x in row.top or ()}
    return {item: salts for item, salts in found.items() if salts > 1}


def _join_shuffled(
    grams: DataFrame, names: DataFrame, on: list[str], spread_by: list[str]
) -> DataFrame:
    """A merge join that spreads the n-grams that the log has most often over several tasks.

    Only the names equal to these are repeated, once for each salt; a salt is a hash of the
    key, so that a task that runs again gives the same rows.
    """
    salts = _salts(grams)
    hashed = F.xxhash64("_gram")
    if not salts:
        return grams.join(names.hint("merge"), on)
    table = F.create_map(*(F.lit(x) for pair in salts.items() for x in pair))
    parts = F.when(hashed.isin(list(salts)), F.element_at(table, hashed)).otherwise(1)
    salted = grams.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), parts).cast("int"))
    spread = names.withColumn("_salt", F.explode(F.sequence(F.lit(0), parts.cast("int") - 1)))
    return salted.join(spread.hint("merge"), [*on, "_salt"]).drop("_salt")


def match_policy_table(
    log: DataFrame,
    rules: Sequence[Rule],
    policy: DataFrame,
    key: Sequence[str],
    command: str = "command",
    as_of: str | None = None,
    strategy: str | None = None,
    arguments: str | None = None,
    collapse: bool = False,
) -> DataFrame:
    """One row per command in context and denied name it holds: ``key``, pos, catalog.

    ``policy`` has ``pos`` and ``name``, optionally ``effect``, and with ``as_of`` (a
    timestamp column of the log) also ``valid_from`` and ``valid_to``: only the rows in
    force at that time apply. Periods of a name that touch become one, and are looked up by
    bins of time, so that a long history isn't searched revision by revision. Rows whose
    ``key`` repeats or is null are matched one by one; ``collapse`` is for a key that tells
    the command, and matches equal keys once.

    The measured size of the policy decides between tests in the plan, a broadcast join
    (neither shuffles) and a shuffle join. ``strategy`` ("broadcast", "shuffle") asks for one
    of the joins; a policy over the limits is never broadcast. The rows are always the same.
    """
    if strategy not in (None, "broadcast", "shuffle"):
        raise ValueError(f"unknown strategy {strategy!r}")
    key = list(key)
    names = _denied_names(policy, as_of)
    extent = _extent(names)
    if strategy == "broadcast" and not extent.fits:
        raise ValueError("the policy is too large to broadcast")

    in_context = with_context(log, rules, command, arguments).filter("_context")
    carried = [*key, *([as_of] if as_of and as_of not in key else [])]
    texts = in_context.select(*carried, "_text")
    if strategy is None and not as_of and 0 < extent.rows <= MAX_INLINE_NAMES:
        hits = _match_inline(texts, names, key)
        return hits.distinct() if collapse else hits
    if not extent.shapes:
        names, extent = names.limit(0), Extent((Shape(1, False, False),), 0, 0, 0)
    grams, on = _grams(texts, extent), ["_gram"]
    if (strategy == "shuffle" or not extent.fits) and extent.rows <= MAX_HASHED_ROWS:
        grams = _likely(grams, names.select(F.xxhash64("_gram").alias("_hash")).distinct())
    if as_of:
        names = merged_periods(names, "_pos", "_name", "_gram")
        bins = bins_of(names)
        names, on = in_bins(names, bins), [*on, "_bin"]
        grams = grams.withColumn("_bin", bins.of(F.col(as_of)))
    if strategy != "shuffle" and extent.fits:
        hits = grams.join(F.broadcast(names), on)
    else:
        # Equal commands meet before the join, and within a task before the shuffle.
        rows = grams.distinct() if collapse else grams
        hits = _join_shuffled(rows, names, on, key)
    if as_of:
        hits = hits.filter(in_force(F.col(as_of)))
    hits = hits.select(*key, F.col("_pos").alias("pos"), F.col("_name").alias("catalog"))
    return hits.distinct() if collapse else hits


def first_match(matches: DataFrame, key: Sequence[str]) -> DataFrame:
    """The match with the lowest position per command."""
    return matches.groupBy(*key).agg(F.min_by("catalog", "pos").alias("catalog"))


def deny_by_table(log: DataFrame, denied: DataFrame, key: Sequence[str]) -> DataFrame:
    """Every row of the log with its verdict, given the denied keys and their catalog."""
    verdict = F.when(F.col("catalog").isNotNull(), DENY).otherwise(ALLOW)
    rows = log.drop("verdict", "catalog")
    return rows.join(denied.select(*key, "catalog"), list(key), "left").withColumn(
        "verdict", verdict
    )


def _with_digest(log: DataFrame, command: str, arguments: str | None) -> DataFrame:
    """Add what tells a command: its text, or its strings, each with its length."""
    told = F.concat(F.lit("text "), F.col(command))
    if arguments is not None:
        strings = F.transform(arguments, lambda s: F.concat_ws(":", F.length(s), s))
        listed = F.concat(F.lit("list "), F.array_join(strings, " "))
        told = F.when(F.col(arguments).isNull(), told).otherwise(listed)
    return log.withColumn("_digest", F.sha2(told, 256))


def classify_by_table(
    log: DataFrame,
    rules: Sequence[Rule],
    policy: DataFrame,
    key: Sequence[str] = (),
    command: str = "command",
    arguments: str | None = None,
    strategy: str | None = None,
) -> DataFrame:
    """Add ``verdict`` and ``catalog`` to every row, without a shuffle for a short policy.

    The rows are the same for any size of the policy. The text alone decides and identifies
    a command, so each distinct command is matched once, and ``key`` isn't needed; it may
    repeat or be null.
    """
    if strategy is None:
        denied = _denied(policy).groupBy(F.lower("name")).agg(F.min_by("name", "pos"), F.min("pos"))
        first = denied.toDF("lower", "name", "pos").filter("lower IS NOT NULL").orderBy("pos")
        names = tuple(row.name for row in first.limit(MAX_INLINE_NAMES + 1).collect())
        if len(names) <= MAX_INLINE_NAMES:
            return classify(log, rules, Policy(denied=names), command, arguments).drop("reason")
    keyed = _with_digest(log, command, arguments)
    matches = match_policy_table(
        keyed,
        rules,
        policy,
        ["_digest"],
        command,
        strategy=strategy,
        arguments=arguments,
        collapse=True,
    )
    return deny_by_table(keyed, first_match(matches, ["_digest"]), ["_digest"]).drop("_digest")


def classify_as_of_table(
    log: DataFrame,
    rules: Sequence[Rule],
    history: DataFrame,
    at: str,
    command: str = "command",
    arguments: str | None = None,
    strategy: str | None = None,
) -> DataFrame:
    """Add ``verdict`` and ``catalog`` under the policy in force at column ``at``.

    ``history`` is a policy table with ``valid_from`` and ``valid_to`` (null: open), of any
    number of revisions; the plan does not grow with them. Rows without a time are allowed.
    """
    keyed = _with_digest(log, command, arguments)
    matches = match_policy_table(
        keyed,
        rules,
        history,
        ["_digest", at],
        command,
        as_of=at,
        strategy=strategy,
        arguments=arguments,
        collapse=True,
    )
    both = ["_digest", at]
    return deny_by_table(keyed, first_match(matches, both), both).drop("_digest")
