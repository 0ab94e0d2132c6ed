"""Alarms and monitor series over the run log, for batch and streaming input.

An alarm that needs several periods in a row is one sliding window over all of
them, with a conditional aggregate per period.  That is an ordinary windowed
aggregation: partial aggregates before the shuffle, and in a stream only the
open windows as state.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Alarm:
    """``statistic`` of ``value`` per period against a threshold.

    The alarm is on when ``periods`` periods in a row breach; a period without
    data does not breach.
    """

    name: str
    value: str
    statistic: str
    minutes: int
    threshold: float
    periods: int = 1
    inclusive: bool = False

    def breach(self, measured: Column) -> Column:
        over = measured >= self.threshold if self.inclusive else measured > self.threshold
        return F.coalesce(over, F.lit(False))


# The four alarms and their thresholds.
ERROR_RATE = Alarm("error_rate", "errors", "sum", 5, 5, periods=2)
LATENCY = Alarm("latency", "duration_ms", "avg", 5, 120_000, periods=2)
THROTTLE = Alarm("throttle", "throttles", "sum", 5, 1, inclusive=True)
VOLUME = Alarm("volume", "invocations", "sum", 60, 1000)
ALARMS = (ERROR_RATE, LATENCY, THROTTLE, VOLUME)

MONITOR_MINUTES = 5


def _timed(runs: DataFrame, ts: str, late: str | None) -> DataFrame:
    runs = runs.withColumn(ts, F.col(ts).cast("timestamp"))
    return runs.withWatermark(ts, late) if late else runs


def alarm_periods(
    runs: DataFrame, alarm: Alarm, ts: str = "ts", late: str | None = None
) -> DataFrame:
    """``(alarm, period_start, measured, breach, alarm_on)`` for periods with data.

    ``late`` sets the watermark of a streaming input.
    """
    runs = _timed(runs, ts, late)
    step = f"{alarm.minutes} minutes"
    span = f"{alarm.minutes * alarm.periods} minutes"
    fn = {"sum": F.sum, "avg": F.avg}[alarm.statistic]
    period = F.timestamp_seconds(
        F.floor(F.unix_micros(ts) / F.lit(alarm.minutes * 60_000_000)) * F.lit(alarm.minutes * 60)
    )
    slots = runs.withColumn("_period", period)
    aggregates, measured = [], []
    for i in range(alarm.periods):
        # Period i of the window; the last one is the period being judged.
        within = F.col("_w.start") + F.expr(f"INTERVAL {alarm.minutes * i} MINUTES") == F.col("_period")
        aggregates.append(fn(F.when(within, F.col(alarm.value))).alias(f"m{i}"))
        measured.append(F.col(f"m{i}"))
    last = measured[-1]
    every = alarm.breach(measured[0])
    for m in measured[1:]:
        every = every & alarm.breach(m)
    windowed = slots.withColumn("_w", F.window(ts, span, step)).groupBy("_w").agg(*aggregates)
    return windowed.filter(last.isNotNull()).select(
        F.lit(alarm.name).alias("alarm"),
        (F.col("_w.end") - F.expr(f"INTERVAL {alarm.minutes} MINUTES")).alias("period_start"),
        last.cast("double").alias("measured"),
        alarm.breach(last).alias("breach"),
        every.alias("alarm_on"),
    )


def monitor_series(runs: DataFrame, ts: str = "ts", late: str | None = None) -> DataFrame:
    """Runs, errors and mean duration per five minutes."""
    runs = _timed(runs, ts, late)
    return (
        runs.groupBy(F.window(ts, f"{MONITOR_MINUTES} minutes").alias("w"))
        .agg(
            F.count("*").alias("runs"),
            F.sum("errors").alias("errors"),
            F.avg("duration_ms").alias("mean_ms"),
        )
        .select(F.col("w.start").alias("period_start"), "runs", "errors", "mean_ms")
    )


def max_concurrency(runs: DataFrame, ts: str = "ts", duration_ms: str = "duration_ms") -> DataFrame:
    """Most runs in progress at once per five minutes: ``(period_start, max_running)``.

    A run counts from its start up to, not including, its end.  There is a row for every period in which a
    run starts, ends or goes on.  The running sum of +1/-1 goes in three steps (instants within a second,
    seconds within an hour, hours), so no window sorts more than a bounded stretch of time, no
    matter how many runs fall into it.  Runs of null time or duration do not count.
    """
    start = F.unix_micros(F.col(ts).cast("timestamp"))
    end = start + F.round(F.col(duration_ms) * 1000).cast("bigint")
    period = MONITOR_MINUTES * 60
    per_hour = 3600 // period
    second = F.floor(F.col("us") / F.lit(1_000_000))
    hour = F.floor(F.col("sec") / F.lit(3600))
    instants = (
        runs.where(start.isNotNull() & end.isNotNull())
        .select(
            F.inline(
                F.array(
                    F.struct(start.alias("us"), F.lit(1).alias("d")),
                    F.struct(end.alias("us"), F.lit(-1).alias("d")),
                )
            )
        )
        .groupBy("us")
        .agg(F.sum("d").alias("d"))
        .withColumn("sec", second)
        .withColumn("hour", hour)
    )
    up_to = (Window.unboundedPreceding, Window.currentRow)
    before = (Window.unboundedPreceding, -1)
    in_second = Window.partitionBy("hour", "sec").orderBy("us").rowsBetween(*up_to)
    # What runs as a period begins is in it, but for what ends at that very instant.
    begins = (F.min("us") == F.col("sec") * 1_000_000) & (F.col("sec") % period == 0)
    seconds = (
        instants.withColumn("level", F.sum("d").over(in_second))
        .groupBy("hour", "sec")
        .agg(F.sum("d").alias("net"), F.when(begins, F.max("level")).otherwise(F.greatest(F.max("level"), F.lit(0))).alias("peak"))
    )
    hours = seconds.groupBy("hour").agg(F.sum("net").alias("hour_net"))
    # One row per hour of the log: 8,760 a year.
    by_hour = Window.orderBy("hour")
    base = hours.select(
        "hour", "hour_net", F.coalesce(F.sum("hour_net").over(by_hour.rowsBetween(*before)), F.lit(0)).alias("base"), F.lead("hour").over(by_hour).alias("next")
    )
    inside = F.coalesce(F.sum("net").over(Window.partitionBy("hour").orderBy("sec").rowsBetween(*before)), F.lit(0))
    slots = (
        seconds.withColumn("inside", inside)
        .groupBy("hour", F.floor(F.col("sec") / F.lit(period)).alias("slot"))
        .agg(F.max(F.col("inside") + F.col("peak")).alias("peak"), F.max_by(F.col("inside") + F.col("net"), "sec").alias("after"))
    )
    own = F.sequence(F.col("hour") * per_hour, F.col("hour") * per_hour + per_hour - 1)
    grid = base.select("hour", "base", F.explode(own).alias("slot")).join(slots, ["hour", "slot"], "left")
    carried = F.coalesce(F.last("after", ignorenulls=True).over(Window.partitionBy("hour").orderBy("slot").rowsBetween(*before)), F.lit(0))
    busy = grid.withColumn("going", F.col("base") + carried).select(
        "slot", F.coalesce(F.col("base") + F.col("peak"), F.when(F.col("going") > 0, F.col("going"))).alias("max_running")
    )
    # Hours in which nothing starts or ends, while something goes on.
    left = F.col("base") + F.col("hour_net")
    quiet = base.where((left > 0) & (F.col("next") > F.col("hour") + 1)).select(
        F.explode(F.sequence((F.col("hour") + 1) * per_hour, F.col("next") * per_hour - 1)).alias("slot"), left.alias("max_running")
    )
    return (
        busy.where("max_running is not null")
        .unionByName(quiet)
        .select(F.timestamp_seconds(F.col("slot") * F.lit(period)).alias("period_start"), "max_running")
    )
