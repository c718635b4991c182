"""Anomalies in daily metrics, by distance from the recent mean; shifts of whole distributions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def daily_metrics(
    rows: DataFrame, event_time: str, metrics: dict[str, Column], by: Sequence[str] = ()
) -> DataFrame:
    """One row per day (and per ``by``) from the first day to the last: row count and the given aggregates.

    A silent day has 0 rows and, since nothing can be said about its rows, NULL metrics.
    The calendar spans all rows, so a group that begins late or stops is silent there too.
    """
    counted = rows.groupBy(*by, F.to_date(event_time).alias("day")).agg(
        F.count("*").alias("row_count"), *[column.alias(name) for name, column in metrics.items()]
    ).where("day IS NOT NULL")
    span = counted.agg(F.min("day").alias("first"), F.max("day").alias("last"))
    days = span.select(F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 DAY"))).alias("day"))
    calendar = counted.select(*by).distinct().join(F.broadcast(days)) if by else days  # groups by days: no data rows
    same = [F.col(f"c.{c}").eqNullSafe(F.col(f"m.{c}")) for c in [*by, "day"]]
    return calendar.alias("c").join(counted.alias("m"), same, "left").select(
        *[F.col(f"c.{c}").alias(c) for c in [*by, "day"]],
        F.coalesce("m.row_count", F.lit(0)).alias("row_count"),
        *[F.col(f"m.{name}").alias(name) for name in metrics],
    )


def schema_changes(records: DataFrame, event_time: str, fields: Column) -> DataFrame:
    """Fields that appear, vanish or change their type from one day with records to the next.

    ``fields`` maps a record's field names to types. ``day, field_name, change, old_type,
    new_type``; a day's types of one field are joined by ``|``. The first day changes nothing.
    """
    day = F.to_date(event_time).alias("day")
    seen = records.select(day, F.explode(fields).alias("field_name", "type")).where("day IS NOT NULL").distinct()
    daily = seen.groupBy("day", "field_name").agg(F.array_join(F.array_sort(F.collect_set("type")), "|").alias("types"))
    days = records.select(day).where("day IS NOT NULL").distinct()
    following = days.select("day", F.lead("day").over(Window.orderBy("day")).alias("next")).where("next IS NOT NULL")
    old = daily.join(following, "day").select(F.col("next").alias("day"), "field_name", F.col("types").alias("old_type"))
    new = daily.join(following.select(F.col("next").alias("day")), "day").withColumnRenamed("types", "new_type")
    change = (
        F.when(F.col("old_type").isNull(), "appeared").when(F.col("new_type").isNull(), "vanished").otherwise("retyped")
    )
    return (
        old.join(new, ["day", "field_name"], "full_outer")
        .where(~F.col("old_type").eqNullSafe(F.col("new_type")))
        .select("day", "field_name", change.alias("change"), "old_type", "new_type")
    )


def anomalies(
    daily: DataFrame, metric: str, by: Sequence[str] = (), days: int = 14, min_days: int = 7, sigmas: float = 3.0
) -> DataFrame:
    """Each day's Z-score against the ``days`` days before it.

    No verdict is given with fewer than ``min_days`` days of history or when they do not
    vary. The window runs over daily rows, a calendar's worth per group, never over data.
    """
    history = Window.partitionBy(*by).orderBy("day").rowsBetween(-days, -1)
    value = F.col(metric).cast("double")
    mean, spread = F.avg(value).over(history), F.stddev_samp(value).over(history)
    enough = F.count(value).over(history) >= min_days
    z_score = F.when(enough & (spread > 0), F.round((value - mean) / spread, 6))
    return (
        daily.select(*by, "day", metric, z_score.alias("z_score"))
        .withColumn("is_anomaly", F.coalesce(F.abs("z_score") > sigmas, F.lit(False)))
        .orderBy(*by, "day")
    )


#: Size of a sketch; ranks read from it are off by at most 0.7 % in 99 of 100 cases.
SKETCH_K = 400
#: Steps of the quantiles that stand for a distribution.
GRID = 128
#: How often a day of the reference's own distribution may look like a shift by chance.
FALSE_ALARMS = 1e-6


def rank_error(k: int = SKETCH_K) -> float:
    """How far a rank read from a sketch is off at most, in 99 of 100 cases."""
    return 2.296 / k**0.9723


def sketch(value: Column, k: int = SKETCH_K) -> Column:
    """An aggregate for ``daily_metrics``: the distribution of a value in some kilobytes, however many rows.

    Sketches are made beside the rows and merged, so no value is shuffled. NULLs are not in it.
    """
    return F.kll_sketch_agg_double(value.cast("double"), k)


def _median(values: Column) -> Column:
    ordered, n = F.array_sort(values), F.size(values)
    middle = (F.get(ordered, F.floor((n - 1) / 2).cast("int")) + F.get(ordered, F.floor(n / 2).cast("int"))) / 2
    return F.when(n > 0, middle)


def distribution_shifts(
    daily: DataFrame,
    by: Sequence[str] = (),
    days: int = 14,
    min_days: int = 7,
    deviations: float = 6.0,
    least: float = 0.1,
    k: int = SKETCH_K,
) -> DataFrame:
    """Days whose values are distributed otherwise than those of the ``days`` days before.

    ``daily`` has a row per day (and per ``by``) with a ``sketch`` of its values, NULL for silent days.
    ``n`` is the number of values, ``distance`` the largest difference between the distribution
    functions of the day and of all days before it together (Kolmogorov and Smirnov's), which a change
    of shape moves also where the mean stays. Read from quantiles of sketches it is at most
    ``2 * rank_error + 1 / GRID`` too large and ``2 * rank_error + 2 / GRID`` too small (each rank in 99
    of 100 cases).

    A day is a shift if its distance, less that error, is above ``least``, above what chance gives
    samples of these sizes, and ``deviations`` robust deviations above the median of the distances of
    the days before. Days that look like shifts at first are then left out of what later days are
    compared with, and all days are judged again: a strange day neither hides the next nor makes
    ordinary days after it look strange. With fewer than ``min_days`` days of values before it no day
    is a shift.
    """
    size = F.coalesce(F.kll_sketch_get_n_double("sketch"), F.lit(0))
    kept = daily.select(*by, "day", size.alias("n"), F.when(size > 0, F.col("sketch")).alias("_own"))
    options = (by, days, min_days, deviations, least, k)
    first = _judged(kept.withColumn("_part", F.col("_own")), *options)
    usual = first.withColumn("_part", F.when(~F.col("is_shift"), F.col("_own"))).drop("distance", "is_shift")
    return _judged(usual, *options).drop("_own", "_part")


def _judged(
    kept: DataFrame, by: Sequence[str], days: int, min_days: int, deviations: float, least: float, k: int
) -> DataFrame:
    """Days with ``distance`` and ``is_shift``, against the sketches in ``_part`` of the days before."""
    history = Window.partitionBy(*by).orderBy("day").rowsBetween(-days, -1)
    merged = F.reduce(
        F.slice("_before", 2, days), F.get("_before", F.lit(0)), lambda a, b: F.kll_sketch_merge_double(a, b)
    )
    grid = F.array(*[F.lit(step / GRID) for step in range(GRID + 1)])
    both = kept.withColumns({"_before": F.collect_list("_part").over(history), "_days": F.count("_own").over(history)})
    both = both.withColumn("_ref", merged).drop("_before")
    known = F.col("_own").isNotNull() & F.col("_ref").isNotNull()
    both = both.withColumns(
        {f"_q{side}": F.when(known, F.kll_sketch_get_quantile_double(side, grid)) for side in ("_own", "_ref")}
    )

    def rank(of: str, x: Column) -> Column:
        return F.size(F.filter(of, lambda q: q <= x)) / F.lit(GRID)

    points = F.array_distinct(F.concat("_q_own", "_q_ref"))
    apart = F.array_max(F.transform(points, lambda x: F.abs(rank("_q_own", x) - rank("_q_ref", x))))
    m = F.kll_sketch_get_n_double("_ref")
    chance = math.sqrt(-math.log(FALSE_ALARMS / 2) / 2) * F.sqrt((F.col("n") + m) / (F.col("n") * m))
    measured = both.select(
        *kept.columns, "_days", apart.alias("distance"), F.when(known, chance).alias("_chance")
    )
    earlier = measured.withColumn("_earlier", F.collect_list("distance").over(history))
    center = earlier.withColumn("_median", _median(F.col("_earlier")))
    spread = _median(F.transform("_earlier", lambda x: F.abs(x - F.col("_median"))))
    usual = F.coalesce(F.col("_median") + deviations * 1.4826 * spread, F.lit(0.0))
    sure = F.col("distance") - 2 * rank_error(k) - 1 / GRID
    shift = (F.col("_days") >= min_days) & (sure > F.greatest(F.col("_chance"), F.lit(least), usual))
    return center.withColumn("is_shift", F.coalesce(shift, F.lit(False))).select(*kept.columns, "distance", "is_shift")
