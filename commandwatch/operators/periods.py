"""Policies with periods: rows that are in force from ``valid_from`` until just before ``valid_to``.

A null ``valid_to`` is open. Inside, the two columns are named ``_valid_from`` and ``_valid_to``,
apart from those of a log.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EMPTY, NO_START, OVERLAP = "empty_period", "no_start", "overlap"
REPEATED_NAME, REPEATED_POSITION, GAP = "repeated_name", "repeated_position", "gap"
_FAR = "9999-12-31 23:59:59"


def _seconds(time: Column) -> Column:
    """Seconds of a time without zone, the same in every zone of the session."""
    time = time.cast("timestamp_ntz")
    days = F.datediff(time, F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86_400 + F.hour(time) * 3_600 + F.minute(time) * 60 + F.second(time)


def _end() -> Column:
    return F.coalesce(F.col("_valid_to"), F.lit(_FAR).cast("timestamp_ntz"))


def in_force(time: Column) -> Column:
    return (time >= F.col("_valid_from")) & (
        F.col("_valid_to").isNull() | (time < F.col("_valid_to"))
    )


def merged_periods(rows: DataFrame, *same: str) -> DataFrame:
    """The rows with the periods of the same row that touch or overlap made one; empty ones go."""
    dated = rows.withColumn("_end", _end()).filter("_valid_from < _end")
    before = Window.partitionBy(*same).orderBy("_valid_from", "_end")
    reached = F.max("_end").over(before.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce(F.col("_valid_from") > reached, F.lit(True)).cast("int")
    islands = dated.withColumn("_begins", begins)
    islands = islands.withColumn("_island", F.sum("_begins").over(before))
    merged = islands.groupBy(*same, "_island").agg(
        F.min("_valid_from").alias("_valid_from"),
        F.max("_end").alias("_end"),
        F.bool_or(F.col("_valid_to").isNull()).alias("_open"),
    )
    return merged.select(*same, "_valid_from", F.when(~F.col("_open"), F.col("_end")).alias("_valid_to"))


@dataclass(frozen=True)
class Bins:
    """Stretches of time, so wide that all periods together lie in a few bins each."""

    start: int
    width: int
    last: int

    def of(self, time: Column) -> Column:
        """The bin of a time; all times from the last boundary on have the last one."""
        place = F.floor((_seconds(time) - self.start) / self.width)
        return F.least(place, F.lit(self.last)).cast("bigint")


def bins_of(periods: DataFrame) -> Bins:
    """Bins as wide as the mean period, so that these lie in some two bins on average."""
    start, end = _seconds(F.col("_valid_from")), _seconds(F.col("_valid_to"))
    row = periods.agg(
        F.count("*").alias("n"),
        F.min(start).alias("first"),
        F.max(F.greatest(start, end)).alias("last"),
        F.sum(end - start).alias("closed"),
        F.sum(F.when(end.isNull(), start)).alias("open_from"),
        F.count(F.when(end.isNull(), 1)).alias("open"),
    ).first()
    if not row.n:
        return Bins(0, 1, 0)
    total = (row.closed or 0) + row.open * row.last - (row.open_from or 0)
    width = max(1, -(-total // row.n))
    return Bins(row.first, width, (row.last - row.first) // width)


def in_bins(periods: DataFrame, bins: Bins) -> DataFrame:
    """One row for each period and bin that it lies in, in column ``_bin``."""
    until = F.coalesce(bins.of(F.col("_valid_to")), F.lit(bins.last).cast("bigint"))
    each = F.explode(F.sequence(bins.of(F.col("_valid_from")), until))
    return periods.withColumn("_bin", each)


def history_faults(history: DataFrame) -> DataFrame:
    """What is wrong with a policy history: fault, name, at.

    ``empty_period``: a row that ends when or before it begins. ``no_start``: one that has no
    begin (at is null). ``repeated_name``, ``repeated_position``: several rows that begin at
    the same time have the same name (ignoring case), or several names the same position.
    ``overlap``: a name's period begins while an earlier one lasts. ``gap``: a period ends and
    none, of any name, is in force from then on, although another one begins later (name is
    null). Each fault is given once.
    """
    rows = history.select(
        F.lower("name").alias("name"),
        "pos",
        F.col("valid_from").cast("timestamp_ntz").alias("_valid_from"),
        F.col("valid_to").cast("timestamp_ntz").alias("_valid_to"),
    )
    at = F.col("_valid_from").alias("at")

    def fault(found: DataFrame, kind: str, name: Column, time: Column = at) -> DataFrame:
        return found.select(F.lit(kind).alias("fault"), name.alias("name"), time).distinct()

    started = rows.filter("_valid_from IS NOT NULL").withColumn("_end", _end())
    valid = started.filter("_valid_from < _end")
    by_name = valid.groupBy("name", "_valid_from").agg(F.max("_end").alias("_end"), F.count("*").alias("n"))
    earlier = Window.partitionBy("name").orderBy("_valid_from").rowsBetween(Window.unboundedPreceding, -1)
    overlap = by_name.withColumn("reached", F.max("_end").over(earlier)).filter("_valid_from < reached")
    by_place = valid.groupBy("pos", "_valid_from").agg(F.min("name").alias("name"), F.max("name").alias("other"))

    # A gap begins at an end that no period covers; ends are looked up by bins of time.
    periods = valid.select("_valid_from", "_valid_to").distinct()
    bins = bins_of(periods)
    ends = periods.filter("_valid_to IS NOT NULL").select(F.col("_valid_to").alias("at")).distinct()
    ends = ends.withColumn("_bin", bins.of(F.col("at")))
    spans = in_bins(periods, bins)
    bare = ends.join(spans, (ends["_bin"] == spans["_bin"]) & in_force(F.col("at")), "left_anti")
    last = periods.agg(F.max("_valid_from").cast("string")).first()[0]
    gaps = bare.filter(F.col("at") < F.lit(last).cast("timestamp_ntz"))
    name, never = F.col("name"), F.lit(None).cast("timestamp_ntz").alias("at")
    return (
        fault(rows.filter("_valid_from IS NULL"), NO_START, name, never)
        .unionByName(fault(started.filter("_valid_from >= _end"), EMPTY, name))
        .unionByName(fault(by_name.filter("n > 1"), REPEATED_NAME, name))
        .unionByName(fault(by_place.filter("name < other"), REPEATED_POSITION, name))
        .unionByName(fault(overlap, OVERLAP, name))
        .unionByName(fault(gaps, GAP, F.lit(None).cast("string"), F.col("at")))
    )
