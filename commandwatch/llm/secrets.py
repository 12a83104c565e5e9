"""Operator 1: secret scan, candidates judged by a random forest, with Spark's functions alone.

Candidates are long runs of letters, digits and _+/- that mix letters and digits, tokens with
dots, quoted, assigned or query string values, and private key blocks. A candidate starts
behind the last = or : of an assignment, not at its name. Each is described by its
length, its changes between kinds of characters, how much of it dictionary words cover,
whether it is part of a path or an address, and the words beside it. A random forest trained
on labelled findings says which candidates are secrets; its trees become nested conditional
expressions, so that scanning is one narrow projection with no join and no shuffle.

Labelled findings are rows (before, value, after, label). `seed_findings` derives them from a
bounded sample of documents (`SEEDS`): digests and words (of any alphabet) of a document put
into the settings in which secrets and their look-alikes (checksums, paths, identifiers,
placeholders) stand. The value of a query string is a candidate of its own if its parameter's
name has at most 40 characters; behind a longer one it ends where an assigned value does.
The dictionary, the `DICTIONARY` words of three letters or more of any alphabet that most
documents have, is counted over the whole texts of all documents. All rows and whole texts
are scanned.

Results: a null text has no candidates and stays null; an empty text stays empty. Repeated
rows are scanned alike. Without labelled findings of both kinds no candidate is a secret.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commandwatch.functions.staged import once

NAMES = r"api[_-]?key|access[_-]?key|private[_-]?key|secret|token|passwd|password|pwd|credential|bearer|auth"
# A name before = is not part of a candidate; = inside one is padding, or has no value behind.
_VALUE = r"[A-Za-z0-9_+/.!@#$%^&*-]"
RUN = r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*[0-9])(?=[0-9_+/-]*[A-Za-z])[A-Za-z0-9_+/-]{16,}+(?:={1,2}+(?![A-Za-z0-9_+/.\"'-])|(?!=))"
DOTTED = r"(?<![A-Za-z0-9_+/.-])(?=[A-Za-z_-]*+[.]?[A-Za-z_.-]*[0-9])[A-Za-z0-9_-]{2,}+(?:\.[A-Za-z0-9_-]{6,}+)++(?!=)"
QUOTED = rf"(?<=[\"'])(?![^\s\"']*?(?:[?&;][A-Za-z0-9_.-]{{1,40}}=|(?i:{NAMES})[A-Za-z0-9_-]{{0,40}}[=:])[^\s\"']{{8}})[^\s\"']{{8,}}+(?=[\"'])"
QUERY = r"(?<==)(?<=[?&;][A-Za-z0-9_.-]{1,40}=)[^\s\"'&;#<>=]{8,}+={0,2}+"
ASSIGNED = rf"(?<=[=:] ?)(?:{_VALUE}|=(?!{_VALUE}{{8}})){{8,}}+(?!=)"
BLOCK = r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----[A-Za-z0-9+/=\s]*+(?:-----END [A-Z ]{0,30}PRIVATE KEY-----)?"
CANDIDATE = f"(?:{BLOCK}|{QUOTED}|{QUERY}|{DOTTED}|{RUN}|{ASSIGNED})"
AROUND = 40
SEEDS, DICTIONARY = 600, 1_000
WORD = r"(\p{L}{3,})"
# Words for seeds of texts that have too few of their own.
FILLERS = "garden window summer letter bridge market silver winter forest corner bottle pocket".split()
SEED_WORDS = len(FILLERS)
TREES, DEPTH = 15, 6
SECRET_FROM = 0.5
MARK = "[secret]"


def _share(count: Column, of: Column) -> Column:
    return count / F.greatest(of, F.lit(1))


def described(before: Column, value: Column, after: Column, dictionary: list[str]) -> dict[str, Column]:
    """The features of one candidate, all numbers."""
    size = F.length(value)
    kinds = F.length(F.regexp_replace(value, r"[0-9]+|[a-z]+|[A-Z]+|[^0-9A-Za-z]+", "x"))
    alternating = F.length(F.regexp_replace(F.lower(value), r"[aeiou]+|[bcdfghjklmnpqrstvwxyz]+|[^a-z]+", "x"))
    words = F.regexp_extract_all(F.lower(value), F.lit(WORD), 1)
    listed = F.split(F.lit(" ".join(dictionary)), " ")  # one constant, however long
    known = F.aggregate(F.filter(words, lambda w: F.array_contains(listed, w)), F.lit(0), lambda n, w: n + F.length(w))
    beside = F.concat(before, F.lit(" "), after)

    def says(where: Column, pattern: str) -> Column:
        return where.rlike(pattern).cast("int")

    return {
        "length": size,
        "kind_changes": _share(kinds, size),
        "vowel_changes": _share(alternating, size),
        "digit_share": _share(F.length(F.regexp_replace(value, "[^0-9]", "")), size),
        "letter_share": _share(F.length(F.regexp_replace(value, "[^A-Za-z]", "")), size),
        "distinct_share": _share(F.size(F.array_distinct(F.split(value, ""))), F.least(size, F.lit(40))),
        "dictionary_share": _share(known, size),
        "hexadecimal": says(value, "^(?:[0-9a-f]+|[0-9A-F]+)$"),
        "known_prefix": says(value, "^(?:AKIA|ASIA|gh[pousr]_|xox[abprs]-|sk_live_|glpat-|eyJ|-----BEGIN)"),
        "placeholder": says(value, "(?i)example|your|here|change|dummy|xxxx|0000|1234"),
        "path": says(F.concat(F.right(before, F.lit(12)), value), r"(?i)(?:https?:|www\.|[a-z0-9_-]{2,}/[a-z0-9_-]{2,}/|^/|\s/)"),
        "file": says(after, r"^\.[a-z]{2,4}(?:[^a-z]|$)"),
        "address": says(after, "^@"),
        "assigned": says(before, r"[=:]\s*[\"']?$"),
        "quoted": (says(before, r"[\"']$") * says(after, r"^[\"']")),
        "secret_word": says(before, rf"(?i)(?:{NAMES})[^A-Za-z0-9]{{0,8}}$"),
        "checksum_word": says(before, r"(?i)(?:sha-?\d*|md5|commit|checksum|digest|etag|hash|uuid|revision|integrity|id|version)[^A-Za-z0-9]{0,8}$"),
        "words_beside": F.size(F.filter(F.split(F.lower(beside), r"[^\p{L}]+"), lambda w: F.array_contains(listed, w) & (w != ""))),
    }


FEATURES = (
    "length kind_changes vowel_changes digit_share letter_share distinct_share dictionary_share hexadecimal known_prefix"
    " placeholder path file address assigned quoted secret_word checksum_word words_beside"
).split()


@dataclass(frozen=True)
class Forest:
    """Trees as text of nested conditions, and the dictionary that a feature needs."""

    trees: tuple[tuple, ...]
    dictionary: tuple[str, ...]

    def score(self, features: Callable[[str], Column]) -> Column:
        """Share of the trees that call it a secret."""
        if not self.trees:
            return F.lit(0.0)

        def vote(node: tuple) -> Column:
            if len(node) == 1:
                return F.lit(node[0])
            feature, threshold, low, high = node
            return F.when(features(FEATURES[feature]) <= threshold, vote(low)).otherwise(vote(high))

        total = vote(self.trees[0])
        for tree in self.trees[1:]:
            total = total + vote(tree)
        return total / len(self.trees)


def _tree(lines: list[str]) -> tuple:
    """A tree from its printed form; takes its lines off the list."""
    line = lines.pop(0).strip()
    if line.startswith("Predict"):
        return (float(line.split()[1]),)
    feature, threshold = re.match(r"If \(feature (\d+) <= ([-0-9.E]+)\)", line).groups()
    low = _tree(lines)
    lines.pop(0)  # Else
    return int(feature), float(threshold), low, _tree(lines)


def trained(findings: DataFrame, dictionary: list[str]) -> Forest:
    """A forest from labelled findings (before, value, after, label); a bounded number of rows."""
    found = described(F.col("before"), F.col("value"), F.col("after"), dictionary)
    rows = findings.select(F.col("label").cast("double").alias("label"), *(found[c].cast("double").alias(c) for c in FEATURES))
    rows = rows.orderBy("label", *FEATURES).coalesce(1)  # the same forest from the same findings
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows).select("label", "features").cache()
    kinds = rows.select("label").distinct().count()
    trees: list[tuple] = []
    if kinds == 2:
        forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=1, maxBins=64, minInstancesPerNode=4).fit(rows)
        for model in forest.trees:
            trees.append(_tree([x for x in model.toDebugString.splitlines()[1:] if x.strip()]))
    rows.unpersist()
    return Forest(tuple(trees), tuple(dictionary))


def _sample(docs: DataFrame, rows: int) -> DataFrame:
    """The rows with the least hashes: the digests of their texts and some of their words.

    Words of any alphabet, those with the least hashes of the whole text; where a text has
    fewer than a seed needs, `FILLERS` stand in for them.
    """
    order = F.xxhash64("doc_id", F.lit(17))
    some = docs.where("doc_id is not null and text is not null").select("doc_id", order.alias("order")).orderBy("order", "doc_id").limit(rows)
    few = F.broadcast(docs.sparkSession.createDataFrame(some.select("doc_id").toArrow()).distinct())  # as Arrow, without Python workers
    inside = F.array_distinct(F.regexp_extract_all("text", F.lit(r"(\p{L}{3,12})"), 1))
    dealt = F.transform(F.sort_array(F.transform(inside, lambda w: F.struct(F.xxhash64(w).alias("by"), w.alias("word")))), lambda x: x["word"])
    words = F.slice(F.concat(F.slice(dealt, 1, SEED_WORDS), F.array(*map(F.lit, FILLERS))), 1, SEED_WORDS)
    return docs.where("text is not null").join(few, "doc_id", "left_semi").select(words.alias("words"), F.sha1("text").alias("hex"), F.sha2("text", 512).alias("long_hex"))


def dictionary_of(docs: DataFrame, size: int = DICTIONARY) -> list[str]:
    """The words that most documents have, in whole texts of all of them."""
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(WORD), 1))).alias("word"))
    return [r["word"] for r in words.groupBy("word").count().orderBy(F.desc("count"), "word").limit(size).collect()]


def seed_findings(sample: DataFrame) -> DataFrame:
    """Labelled findings in the settings in which secrets and look-alikes stand."""
    word = lambda k: F.get("words", F.lit(k))
    text = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    secret64 = F.regexp_replace(F.base64(F.unhex(F.substring("long_hex", 1, 60))), "[/+]", "")
    short64 = F.substring(secret64, 1, 24)
    joined = lambda sign, a, n: F.array_join(F.slice("words", a, n), sign)
    digits = F.regexp_replace("long_hex", "[a-f]", "")
    uuid = F.concat_ws("-", F.substring("hex", 1, 8), F.substring("hex", 9, 4), F.substring("hex", 13, 4), F.substring("hex", 17, 4), F.substring("hex", 21, 12))
    dotted = F.concat_ws(".", F.concat(F.lit("eyJ"), F.substring(secret64, 1, 15)), F.concat(F.lit("eyJ"), F.substring(secret64, 8, 20)), F.substring(secret64, 5, 30))
    block = text("-----BEGIN RSA PRIVATE KEY-----\n", secret64, "\n", F.substring(secret64, 3, 30), "\n-----END RSA PRIVATE KEY-----")
    rows = [
        (text(word(0), " API_KEY="), text("sk_live_", short64), text(" ", word(1)), 1),
        (text(word(1), " password="), F.concat(F.substring(word(4), 1, 6), F.substring("long_hex", 1, 3), F.substring(secret64, 1, 4)), text(" ", word(2)), 1),
        (text(word(2), " SECRET_TOKEN="), F.col("hex"), text(" ", word(3)), 1),
        (text(word(3), " https://example.com/", word(4), "?token="), short64, text("&page=", F.substring(digits, 1, 1)), 1),
        (text(word(4), " "), dotted, text(" ", word(5)), 1),
        (text(word(5), " Authorization: Bearer "), dotted, text(" ", word(6)), 1),
        (text(word(6), " "), block, text(" ", word(7)), 1),
        (text(word(7), " revision="), F.col("hex"), text(" ", word(8)), 0),
        (text(word(8), " https://example.com/", word(9), "?page="), joined("-", 2, 3), text("&id=", F.substring(digits, 1, 2)), 0),
        (text(word(9), " name="), joined("_", 3, 3), text(" ", word(0)), 0),
        (text(word(10), " "), text(joined(".", 1, 3), F.substring(digits, 1, 2)), text(" ", word(1)), 0),
        (text(word(0), ' token = "'), F.col("hex"), text('" ', word(1)), 1),
        (text(word(1), " secret: "), secret64, text(" ", word(2)), 1),
        (text(word(2), ' api_key="'), short64, text('" ', word(3)), 1),
        (text(word(3), " password = '"), F.concat(F.substring(word(4), 1, 4), F.substring("long_hex", 1, 3), F.lit("!"), F.substring(secret64, 1, 6)), text("' ", word(5)), 1),
        (text("Bearer: "), F.substring(secret64, 1, 36), text(" ", word(6)), 1),
        (text(word(5), " "), text("AKIA", F.upper(F.substring("long_hex", 1, 16))), text(" ", word(6)), 1),
        (text(word(6), " "), text("ghp_", F.substring(secret64, 1, 36)), text(" ", word(7)), 1),
        (text(word(7), " "), secret64, text(" ", word(8)), 1),
        (text(word(8), " commit "), F.col("hex"), text(" ", word(9)), 0),
        (text(word(9), " sha256: "), F.substring("long_hex", 1, 64), text(" ", word(10)), 0),
        (text(word(0), " id="), uuid, text(" ", word(1)), 0),
        (text(word(1), " "), uuid, text(" ", word(2)), 0),
        (text(word(2), " "), text(joined("-", 1, 4), "-", F.substring(digits, 1, 2)), text(" ", word(3)), 0),
        (text(word(3), " https://example.com/"), text(joined("/", 3, 4), "/", F.substring(digits, 1, 3)), text(".html ", word(4)), 0),
        (text(word(4), " "), text("src/", joined("/", 5, 3), "/v", F.substring(digits, 1, 1)), text(".py ", word(5)), 0),
        (text(word(5), ' token = "'), text("your_", word(6), "_token_here"), text('" ', word(7)), 0),
        (text(word(6), ' password = "'), text("change", word(7), F.substring(digits, 1, 4)), text('" ', word(8)), 0),
        (text(word(7), " secret: "), joined("_", 2, 3), text(" ", word(8)), 0),
        (text(word(8), ' api_key = "'), F.lit("xxxxxxxxxxxxxxxxxxxx0"), text('" ', word(9)), 0),
        (text(word(9), " "), text(joined("", 1, 3), F.substring(digits, 1, 3)), text("@mail", word(0)), 0),
        (text(word(10), " "), text(joined("_", 4, 3), "_", F.substring(digits, 1, 4)), text(" ", word(1)), 0),
    ]
    kind = F.explode(F.array(*(F.struct(b.alias("before"), v.alias("value"), a.alias("after"), F.lit(y).alias("label")) for b, v, a, y in rows)))
    return sample.select(kind.alias("row")).select("row.*")


def fit(docs: DataFrame, rows: int = SEEDS) -> Forest:
    """A forest from the seed findings of a bounded sample, and a dictionary of all documents."""
    dictionary = dictionary_of(docs)
    sample = _sample(docs, rows).cache()
    forest = trained(seed_findings(sample), dictionary)
    sample.unpersist()
    return forest


def _free(docs: DataFrame, name: str) -> str:
    """A name that no column has, nor with another underscore."""
    taken = {c.lower() for c in docs.columns}
    while name in taken or f"{name}_" in taken:
        name += "_"
    return name


def with_candidates(docs: DataFrame, forest: Forest, name: str) -> DataFrame:
    """The rows with a struct of that name: `gaps` (the text between candidates) and `found`
    (value, score), both null where the text has no candidate.

    Each step is computed once, whatever reads it: the candidates, their features, their scores.
    """
    any_there = F.col("text").rlike(CANDIDATE)  # most texts have none, and are read once
    cut = F.struct(F.split("text", CANDIDATE, -1).alias("gaps"), F.regexp_extract_all("text", F.lit(f"({CANDIDATE})"), 1).alias("values"))
    gaps = F.col(f"{name}.gaps")

    def judged(value: Column, i: Column) -> Column:
        before = F.right(F.get(gaps, i), F.lit(AROUND))
        after = F.left(F.get(gaps, i + 1), F.lit(AROUND))
        features = described(before, value, after, list(forest.dictionary))
        return F.struct(value.alias("value"), F.struct(*(features[c].cast("double").alias(c) for c in FEATURES)).alias("features"))

    def scored(x: Column) -> Column:
        return F.struct(x["value"].alias("value"), forest.score(lambda feature: x["features"][feature]).alias("score"))

    rows = once(docs, name, F.when(any_there, cut))
    for step in (F.transform(f"{name}.values", judged), F.transform(f"{name}.found", scored)):
        rows = once(rows, f"{name}_", F.when(F.col(name).isNotNull(), F.struct(gaps.alias("gaps"), step.alias("found"))))
        rows = rows.drop(name).withColumnRenamed(f"{name}_", name)
    return rows


def redacted(docs: DataFrame, forest: Forest, mark: str = MARK) -> DataFrame:
    """All columns of the rows, each secret of the text replaced by a mark."""
    name = _free(docs, "candidates")
    gaps, found = F.col(f"{name}.gaps"), F.col(f"{name}.found")
    kept = F.transform(found, lambda x: F.when(x["score"] >= SECRET_FROM, F.lit(mark)).otherwise(x["value"]))
    pieces = F.zip_with(gaps, kept, lambda gap, value: F.concat(F.coalesce(gap, F.lit("")), F.coalesce(value, F.lit(""))))
    text = F.when(F.exists(found, lambda x: x["score"] >= SECRET_FROM), F.array_join(pieces, "")).otherwise(F.col("text"))
    return with_candidates(docs, forest, name).withColumn("text", text).select(*(F.col(f"`{c}`") for c in docs.columns))


def findings(docs: DataFrame, forest: Forest) -> DataFrame:
    """One row for each candidate: place, digest, score, and whether it is a secret."""
    rows = with_candidates(docs.select("doc_id", "text"), forest, "candidates").where("candidates is not null")
    rows = rows.select("doc_id", F.monotonically_increasing_id().alias("row"), "candidates.*")
    places = F.transform(
        "found", lambda x, i: F.struct(F.length(F.get("gaps", i)).alias("gap"), F.length(x["value"]).alias("size"), F.sha2(x["value"], 256).alias("value_sha256"), x["score"].alias("score"))
    )
    each = rows.select("doc_id", "row", F.posexplode(places).alias("number", "x"))
    so_far = Window.partitionBy("row").orderBy("number").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.sum(F.col("x.gap") + F.col("x.size")).over(so_far) - F.col("x.size")
    return each.select("doc_id", "number", start.alias("start"), F.col("x.size").cast("bigint").alias("length"), "x.value_sha256", "x.score", (F.col("x.score") >= SECRET_FROM).alias("is_secret"))


def secret_findings(docs: DataFrame) -> DataFrame:
    return findings(docs, fit(docs))
