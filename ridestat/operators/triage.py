"""Datetime triage of raw trip rows (strict four-digit-year parse).

Input: raw rows with ``source_file``, ``row_index`` (file order) and the nine text columns;
filter them to the files of interest before calling (the source system triaged one month).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.datetimes import (
    datetime_text,
    duration_minutes,
    duration_seconds,
    with_parsed_datetime,
)
from ..functions.fixed import CANONICAL_COLUMNS, TRIAGE_SAMPLE_ROWS, TRIAGE_VALUE_COUNTS
from ..session import ensure_checkpoint_dir


def strict_datetimes(raw: DataFrame) -> DataFrame:
    """Adds raw_start/end_datetime_text and strictly parsed start/end_datetime."""
    t = raw.withColumns(
        {
            "raw_start_datetime_text": datetime_text("Fecha_Retiro", "Hora_Retiro"),
            "raw_end_datetime_text": datetime_text("Fecha_Arribo", "Hora_Arribo"),
        }
    )
    t = with_parsed_datetime(t, "raw_start_datetime_text", "start_datetime", two_digit_years=False)
    return with_parsed_datetime(t, "raw_end_datetime_text", "end_datetime", two_digit_years=False)


def datetime_triage_summary(raw: DataFrame) -> DataFrame:
    t = strict_datetimes(raw)
    return t.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("start_datetime").isNull()).alias("invalid_start_datetime"),
        F.count_if(F.col("end_datetime").isNull()).alias("invalid_end_datetime"),
    )


# None of these filters rows on a parsed datetime *before* an aggregate or top-k: a filter is
# pushed below the projections that compute its columns and would inline the whole parse into
# the scan's filter. Validity is folded into aggregates (count_if / null-skipping) or applied
# after the limit instead.


def _valid() -> F.Column:
    return F.col("start_datetime").isNotNull() & F.col("end_datetime").isNotNull()


def invalid_datetime_sample(raw: DataFrame, n: int = TRIAGE_SAMPLE_ROWS) -> DataFrame:
    """First ``n`` rows (file order) whose start or end does not parse, with the joined texts."""
    t = strict_datetimes(raw).withColumn("__ok", _valid())
    cols = ["source_file", "row_index", *CANONICAL_COLUMNS, "raw_start_datetime_text", "raw_end_datetime_text"]
    # invalid rows sort first, so the first n of this order hold the first n invalid rows
    return (
        t.select(*cols, "__ok")
        .orderBy("__ok", F.col("source_file").asc_nulls_last(), "row_index")
        .limit(n)
        .where(~F.col("__ok"))
        .drop("__ok")
    )


def invalid_start_value_counts(raw: DataFrame, n: int = TRIAGE_VALUE_COUNTS) -> DataFrame:
    """Most common Fecha_Retiro and Hora_Retiro values (missing included) among invalid starts.

    ``n`` per field, most frequent first, ties by value (missing first).
    """
    t = strict_datetimes(raw).withColumn("__bad", F.col("start_datetime").isNull())
    fields = F.array(
        F.struct(F.lit("Fecha_Retiro").alias("field"), F.col("Fecha_Retiro").alias("value")),
        F.struct(F.lit("Hora_Retiro").alias("field"), F.col("Hora_Retiro").alias("value")),
    )
    counts = (
        t.select("__bad", F.inline(fields))
        .groupBy("field", "value")
        .agg(F.count_if("__bad").alias("trips"))
        .where(F.col("trips") > 0)
    )
    # top n per field: Spark plans a per-task group limit before the window's shuffle, so
    # only n rows per field and task move (a distributed top-k, one scan of the raw rows)
    w = Window.partitionBy("field").orderBy(F.col("trips").desc(), F.col("value").asc_nulls_first())
    return (
        counts.withColumn("__rank", F.row_number().over(w))
        .where(F.col("__rank") <= n)
        .orderBy("field", "__rank")
        .drop("__rank")
    )


def with_valid_duration(raw: DataFrame) -> DataFrame:
    """Strict datetimes plus ``duration_minutes`` (null unless both ends parse)."""
    t = strict_datetimes(raw)
    return t.withColumn("duration_minutes", F.when(_valid(), duration_minutes("start_datetime", "end_datetime")))


def duration_describe(raw: DataFrame) -> DataFrame:
    """count, mean, sample std, min, 25/50/75 % (interpolated, exact), max of valid durations."""
    return describe_durations(with_valid_duration(raw))


# Seconds in a bucket of the running count: a few hundred thousand buckets span all datetimes.
RANK_BUCKET = 1 << 16
QUARTILES = (0.25, 0.5, 0.75)


def describe_durations(d: DataFrame, column: str = "duration_minutes") -> DataFrame:
    """Describe a minutes column (nulls skipped); percentiles exact, std rounded to 6 places.

    Rows are counted per whole second (cut here: the counts are read twice, and the datetime parse stays out
    of the ranking's plan); ranks come from running counts inside buckets of seconds plus the buckets'
    offsets, so no task or buffer holds all distinct durations. One row of totals comes to the driver.
    """
    ensure_checkpoint_dir(d.sparkSession)
    # one use of the parsed column; rows without a duration are one group, left out below
    counts = d.groupBy(duration_seconds(F.col(column)).alias("sec")).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("bucket", F.floor(F.col("sec") / RANK_BUCKET)).checkpoint().where(F.col("sec").isNotNull())
    seconds = F.sum(F.col("n") * F.col("sec"))
    whole = counts.agg(F.sum("n").alias("total"), seconds.alias("seconds"), F.min("sec").alias("low"), F.max("sec").alias("high")).first()
    total = whole["total"] or 0
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.groupBy("bucket").agg(F.sum("n").alias("bn")).select("bucket", F.coalesce(F.sum("bn").over(before), F.lit(0)).alias("offset"))
    upto = F.sum("n").over(Window.partitionBy("bucket").orderBy("sec").rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.join(offsets, "bucket").withColumn("end", F.col("offset") + upto).withColumn("start", F.col("end") - F.col("n"))

    def quartile(q: float) -> F.Column:
        place = max(0, total - 1) * q
        at = lambda rank: F.max(F.when((F.col("start") <= rank) & (F.col("end") > rank), F.col("sec")))
        return (at(math.floor(place)) + (at(math.ceil(place)) - at(math.floor(place))) * (place - math.floor(place))) / F.lit(60.0)

    mean = whole["seconds"] / total if total else None
    squares = F.sum(F.col("n") * F.pow(F.col("sec") - F.lit(mean).cast("double"), F.lit(2.0)))
    return ranked.agg(
        F.lit(total).cast("bigint").alias("count"),
        F.lit(whole["seconds"] / (total * 60) if total else None).cast("double").alias("mean"),
        F.round(F.sqrt(squares / (total - 1)) / 60.0 if total > 1 else F.lit(None).cast("double"), 6).alias("std"),
        (F.lit(whole["low"]).cast("double") / 60.0).alias("min"),
        *[quartile(q).alias(f"p{q * 100:.0f}") for q in QUARTILES],
        (F.lit(whole["high"]).cast("double") / 60.0).alias("max"),
    )


def longest_trips(raw: DataFrame, n: int = TRIAGE_SAMPLE_ROWS) -> DataFrame:
    """The ``n`` longest valid trips (ties in file order)."""
    d = with_valid_duration(raw)
    return (
        d.select("source_file", "row_index", *CANONICAL_COLUMNS, "start_datetime", "end_datetime", "duration_minutes")
        .orderBy(F.col("duration_minutes").desc_nulls_last(), F.col("source_file").asc_nulls_last(), "row_index")
        .limit(n)
        .where(F.col("duration_minutes").isNotNull())
    )
