"""Fill-in-the-middle texts against a plain re-reading of the contract, and round trips."""

from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

from commandwatch.llm import fill_in_middle as fim
from commandwatch.llm.spark_io import prepare

TOKENS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string"


def expected(doc_id: int | None, text: str | None) -> tuple:
    text = text or ""
    tokens = TOKENS.findall(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in range(0, 32, 8))
    n, sha = len(tokens), lambda x: hashlib.sha256(x.encode()).hexdigest()
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(tokens[a:b]) for a, b in ((0, low), (low, high), (high, n)))
    form = "spm" if h4 % 100 < 80 else "psm"
    output = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, n, form, len(p), len(m), sha(output), sha(text)


def rows() -> list[tuple[int | None, str | None]]:
    rng = random.Random(5)
    pool = ["a", "né", "一二", "🙂", " ", "\n", "\t ", "\x0b", "\x85", "\xa0", "\x1c", "<", "<P", ">", "S>", "M", "w"]
    found: list[tuple[int | None, str | None]] = [(k, "".join(rng.choice(pool) for _ in range(rng.randint(0, 40)))) for k in range(600)]
    found += [(1_000, None), (1_001, ""), (1_002, " \t "), (None, "a b c"), (1_003, "has <M> inside"), (7, "seven again"), (7, "seven again")]
    return found + [(2_000 + k, "é" * 700_000 + " end\n " + "z y " * 300_000) for k in range(4)]


def test_digests_equal_the_contract(spark):
    prepare(spark)
    given = spark.createDataFrame(rows(), SCHEMA).withColumn("form", F.lit("x")).withColumn("n", F.lit(1)).repartition(3)
    got = sorted(map(repr, map(tuple, fim.arrangement_digests(given).collect())))
    assert got == sorted(repr(expected(d, t)) for d, t in rows())
    assert {r["form"] for r in fim.arrangement_digests(given).collect()} == {"plain", "psm", "spm"}
    assert fim.arrangement_digests(spark.createDataFrame([], SCHEMA)).count() == 0


def test_texts_come_back(spark):
    prepare(spark)
    given = [(d, t) for d, t in rows() if d is not None]
    arranged = fim.fill_in_middle(spark.createDataFrame(given, SCHEMA), fim.Choice(percent=100))
    back = sorted(map(tuple, fim.plain_texts(arranged).collect()))
    assert back == sorted((d, t or "") for d, t in given)
    stay = sum(not t or bool(re.search("<[PSM]>", t)) for _, t in given)
    assert arranged.where("form = 'plain'").count() == stay
    assert arranged.where("form = 'psm'").count() > 60


def test_splitting_makes_descriptors_only():
    data = b"abcdef"
    left, right = fim.split([(data, 0, 2), (data, 4, 6)], 3)
    assert left == [(data, 0, 2), (data, 4, 5)] and right == [(data, 5, 6)]
    assert fim.split([(data, 0, 6)], 6) == ([(data, 0, 6)], [])
    assert all(piece[0] is data for piece in left + right)


def test_places_across_chunks(monkeypatch):
    text = b"ab  c\n defg h  "
    whole = [fim.places(text, (a, b)) for a in range(6) for b in range(a, 6)]
    for size in range(1, 17):
        monkeypatch.setattr(fim, "CHUNK", size)
        assert fim.n_tokens(text) == 5
        assert [fim.places(text, (a, b)) for a in range(6) for b in range(a, 6)] == whole
        assert fim.characters("né一🙂x".encode(), 1, 10) == 3
