"""Add costly columns so that they are computed once, in methods small enough to compile.

Catalyst pushes a filter on a projected column below the projection, and so evaluates a
costly expression a second time. It does not push through a generator, and a generator over
a one-element array stays inside whole-stage codegen. Each generator also becomes a method
of its own. The JVM leaves methods above some 8000 bytes to its interpreter, so long lists
of tests are spread over several generators.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TESTS_PER_STAGE = 8


def _chunks(items: Sequence) -> list[Sequence]:
    return [items[i : i + TESTS_PER_STAGE] for i in range(0, len(items), TESTS_PER_STAGE)]


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add ``value`` as a column that later filters read instead of recomputing."""
    return df.select("*", F.explode_outer(F.array(value)).alias(name))


def add_any(df: DataFrame, name: str, hits: Sequence[Column]) -> DataFrame:
    """Add whether any of ``hits`` is true; later ones are not tried after a hit."""
    found, helpers = F.lit(False), []
    for i, chunk in enumerate(_chunks(hits)):
        helpers.append(f"{name}_{i}")
        df = once(df, helpers[-1], functools.reduce(operator.or_, chunk, found))
        found = F.col(helpers[-1])
    return df.withColumn(name, found).drop(*helpers)


def add_first(
    df: DataFrame, name: str, cases: Sequence[tuple[Column, str]], only: Column
) -> DataFrame:
    """Add the label of the first case that is true, or null; null also outside ``only``."""
    found, helpers = F.lit(None).cast("string"), []
    for i, chunk in enumerate(_chunks(cases)):
        value = F.when(found.isNotNull(), found)
        for hit, label in chunk:
            value = value.when(only & hit, F.lit(label))
        helpers.append(f"{name}_{i}")
        df = once(df, helpers[-1], value)
        found = F.col(helpers[-1])
    return df.withColumn(name, found).drop(*helpers)


def explode_hits(
    df: DataFrame,
    name: str,
    cases: Sequence[tuple[Column, Column | str | int]],
    kind: str = "string",
) -> DataFrame:
    """One row per case that is true, with its label; a row without any yields none.

    ``kind`` is the type of the labels, which matters if there are no cases.
    """
    df = df.drop(name)
    kept = df.columns
    helpers = []
    for i, chunk in enumerate(_chunks(cases)):
        labels = F.array(*(F.when(hit, F.lit(label)) for hit, label in chunk))
        helpers.append(f"{name}_{i}")
        df = df.withColumn(helpers[-1], labels) if i == 0 else once(df, helpers[-1], labels)
    labels = F.concat(*helpers) if helpers else F.array().cast(f"array<{kind}>")
    exploded = df.select(*kept, F.explode_outer(labels).alias(name))
    return exploded.filter(F.col(name).isNotNull())
