"""The filter audit against brute force over all orders, row by row."""

from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from commandwatch.llm import filter_audit
from commandwatch.llm.spark_io import prepare

DOCS = "doc_id bigint, text string, lang string"
LABELS = "doc_id bigint, quality int, toxic int"


def fails(text: str | None) -> str:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    found = "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words))
    return found + "C" * (100 * len(re.findall("[A-Z]", text)) > 3 * len(text)) + "D" * bool(re.search("[#$%&*|]", text))


def expected(docs: list[tuple], labels: list[tuple]) -> list[tuple]:
    number = lambda d: float("inf") if d is None else d
    first: dict[str, float] = {}
    for d, t, _ in docs:
        first[t or ""] = min(number(d), first.get(t or "", number(d)))
    rows = []
    for d, t, lang in docs:
        failed = fails(t) + "E" * (first[t or ""] < number(d))
        good, toxic = (any(x[k] == 1 for x in labels if d is not None and x[0] == d) for k in (1, 2))
        rows.append((lang or "", failed, good, toxic))
    found = []
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        orders = ["".join(o) for o in itertools.permutations("ABCDE")]
        removed_by: dict[str, int] = dict.fromkeys("ABCDE", 0)
        steps = []
        for order in orders:
            left = mine
            for k, f in enumerate(order):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                removed_by[f] += len(gone)
                redundant = sum(f in r[1] for r in mine) - len(gone)
                steps.append((order, k + 1, f, len(left), len(gone), redundant, sum(r[2] for r in gone), sum(r[3] for r in gone)))
        for order, k, f, kept, gone, redundant, good, toxic in steps:
            found.append((part, order, k, kept, gone, redundant, sum(r[1] == f for r in mine), good, toxic, removed_by[f]))
    return sorted(found)


def given() -> tuple[list[tuple], list[tuple]]:
    rng = random.Random(12)
    texts = [None, "", " ", "one two", "AB c", "x " * 300, " ".join(f"w{k}" for k in range(250)), " ".join(f"W{k} Q" for k in range(250)), "# note", "é" * 90 + "|"]
    texts += [" ".join(f"v{k}" for k in range(n)) + " $" * (n % 2) for n in (199, 200, 201, 260)]
    texts += ["a" * 2_500_000 + " b\tc" * 60, "q r\n" * 500_000]
    docs = [(rng.choice([*range(400), 70_000, -5, -20_000]), rng.choice(texts), rng.choice(["en", "de", "", None])) for _ in range(150)]
    docs += docs[:20] + [(None, t, "en") for t in texts[:9]] + [(None, "two rows", None)] * 2 + [(9, texts[6], "en")] * 30
    labels = [(rng.choice([*range(400), None]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(300)]
    return docs, labels


def test_audit_equals_brute_force(spark):
    prepare(spark)
    docs, labels = given()
    table = spark.createDataFrame(docs, DOCS).withColumns({c: F.lit("x") for c in ("part", "failed", "digest", "first", "range", "rows")})
    noted = spark.createDataFrame(labels, LABELS).withColumn("text", F.lit("x"))
    got = sorted(map(tuple, filter_audit.filter_audit(table.repartition(5), noted).collect()))
    assert got == expected(docs, labels)


def test_audit_of_nothing(spark):
    prepare(spark)
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert filter_audit.filter_audit(docs, labels).count() == 0
    alone = filter_audit.filter_audit(spark.createDataFrame([(1, "a", "en")], DOCS), labels).collect()
    assert len(alone) == 600 and all(r["kept"] == (r["filter_order"].index("A") >= r["step"]) for r in alone)


@pytest.mark.parametrize("seed", range(30))
def test_galloping_equals_sets(seed):
    rng = random.Random(seed)
    lists = [np.array(sorted(rng.sample(range(60), rng.choice([0, 1, 5, 40]))), np.int64) for _ in range(4)]
    for a, b in itertools.product(lists, repeat=2):
        assert filter_audit.minus(a, b).tolist() == sorted(set(a.tolist()) - set(b.tolist()))
    assert filter_audit.union(lists).tolist() == sorted(set().union(*map(np.ndarray.tolist, lists)))
    assert filter_audit.union([]).tolist() == []


def test_long_texts_are_read_in_parts(monkeypatch):
    rng = random.Random(1)
    texts = ["".join(rng.choice(["ab", "C", " ", "\n", "\x0b", "é", "#"]) for _ in range(n)).encode() for n in range(60)]
    whole = [filter_audit.failures(t) for t in texts]
    for size in (1, 2, 7, 30):
        monkeypatch.setattr(filter_audit, "CHUNK", size)
        assert [filter_audit.failures(t) for t in texts] == whole
        assert all(b"".join(filter_audit._pieces(t)) == t for t in texts)
