"""The join on prefix trees against all pairs."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from commandwatch.llm import ngram_join
from commandwatch.llm.ngram_join import Bounds, PrefixTree
from commandwatch.llm.spark_io import prepare

SCHEMA = "doc_id bigint, text string"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ngrams(text: str | None, size: int) -> frozenset:
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def expected(rows: list[tuple], like: Bounds) -> Counter:
    sets = [(d, ngrams(t, like.words)) for d, t in rows]
    least: dict[frozenset, int] = {}
    for d, s in sets:
        if d is not None and s:
            least[s] = min(d, least.get(s, d))
    of = {d: d for d in least.values()}

    def root(x: int) -> int:
        while of[x] != x:
            x = of[x]
        return x

    keys = list(least)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if 100 * len(a & b) >= like.percent * len(a | b):
                x, y = sorted((root(least[a]), root(least[b])))
                of[y] = x
    return Counter((d, len(s), d if not s else root(least[s]) if s in least else None) for d, s in sets)


def given() -> list[tuple[int | None, str | None]]:
    rng = random.Random(13)
    word = lambda: f"w{rng.randint(0, 4_000)}"
    rows: list[tuple[int | None, str | None]] = []
    for base in range(12):  # copies with few to many edits, some in chains, in rising and falling ids
        text = [word() for _ in range(rng.choice([6, 20, 90, 400]))]
        for k in range(14):
            rows.append((base * 1_000 + (k * 7 % 14), " ".join(text)))
            for _ in range(rng.choice([0, 1, 1, 2, 8])):
                text[rng.randrange(len(text))] = word()
    template = [word() for _ in range(100)]
    for k in range(60):  # much in common, but mostly not enough
        own = [word() for _ in range(k)]
        rows.append((50_000 + k, " ".join(template[: 60 + k % 40] + own)))
    passage = " ".join(word() for _ in range(60))
    rows += [(60_000 + k, f"{' '.join(word() for _ in range(150))} {passage} {' '.join(word() for _ in range(40))}") for k in range(20)]
    rows += [(70_000 + k, t) for k, t in enumerate(["a", "A", "a b", "A  B", "b a", "a b c d", "a b c d e", "a b c d e f", "x " * 50, "x " * 51, "é È"])]
    rows += [(80_000, None), (80_001, ""), (80_002, " \n"), (None, rows[3][1]), (None, "nobody else has these words"), (None, None)]
    long = " ".join(f"v{k}" for k in range(60_000))
    rows += [(90_000, long), (90_001, f"{long} end"), (90_002, long[: len(long) // 2]), (90_003, "y" * 300_000)]
    return rows + [(1_003, rows[5][1]), (1_003, rows[5][1]), (50_001, "another text under an id that is there")]


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    found = spark.createDataFrame(given(), SCHEMA)
    for name in ("id", "n", "cell", "component", "digest", "label"):
        found = found.withColumn(name, F.lit("x"))
    return found.repartition(4)


@pytest.mark.parametrize("like", [Bounds(), Bounds(2, 60, more=0)])
def test_components_equal_all_pairs(docs, like):
    assert Counter(map(tuple, ngram_join.joined(docs, like).collect())) == expected(given(), like)


def test_small_cells_blocks_and_other_ways_lose_no_link(docs, monkeypatch):
    for name, value in (("NGRAMS_PER_CELL", 300), ("NGRAMS_PER_GROUP", 3_000), ("NGRAMS_PER_BLOCK", 500), ("MAX_BROADCAST_IDS", 10), ("ROUNDS", 0)):
        monkeypatch.setattr(ngram_join, name, value)
    assert Counter(map(tuple, ngram_join.joined(docs).collect())) == expected(given(), Bounds())


def test_nothing(spark):
    prepare(spark)
    assert ngram_join.joined(spark.createDataFrame([], SCHEMA)).count() == 0
    alone = [(1, None), (2, ""), (None, "a b")]
    got = ngram_join.joined(spark.createDataFrame(alone, SCHEMA)).collect()
    assert Counter(map(tuple, got)) == expected(alone, Bounds())


@pytest.mark.parametrize("seed", range(40))
def test_tree_equals_all_sets(seed, monkeypatch):
    monkeypatch.setattr(ngram_join, "STEP", random.Random(seed).choice([1, 3, 2_048]))
    rng = random.Random(seed)
    like = Bounds(percent=rng.choice([60, 80, 90]))
    rank = {int(h): k for k, h in enumerate(rng.sample(range(1, 1 << 40), 60))}
    base = rng.sample(list(rank), 25)
    rows = []
    for doc in range(30):
        own = set(base) ^ set(rng.sample(list(rank), rng.randint(0, 8)))
        extra = rng.randint(0, 3)  # n-grams that nobody else has are counted, but not stored
        rows.append((doc, doc // 2, len(own) + extra, np.array(sorted(own, key=rank.get), np.uint64).tobytes()))
    tree = PrefixTree(rows)
    for doc, component, n, path in rows:
        mine = set(np.frombuffer(path, np.uint64).tolist())
        right = set()
        for other, of, m, theirs in rows:
            both = len(mine & set(np.frombuffer(theirs, np.uint64).tolist()))
            if of != component and 100 * both >= like.percent * (n + m - both):
                right.add(of)
        found = tree.partners(doc, component, n, np.frombuffer(path, np.uint64), like)
        assert Counter(x // 2 for x in found) == Counter(right)


def test_bounds_hold_for_every_size():
    for like in (Bounds(), Bounds(3, 85), Bounds(percent=60), Bounds(percent=95, more=0)):
        for n in range(1, 400):
            assert 1 <= like.index(n) <= like.probe(n) <= like.sampled(n) <= n
            for m in range(like.least_common(n), n + 1):
                common = max(like.common(n, m), 1)
                if common <= m:  # in a common order, prefixes of these sizes meet so often
                    assert like.probe(n) + common > n and like.index(m) + common > m
                    for a in (n, m):
                        assert min(like.sampled(n) + common - n, like.sampled(m) + common - m, common) >= like.sampled_common(a) >= 1
