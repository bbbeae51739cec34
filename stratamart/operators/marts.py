"""Aggregates over the fact and the questions they answer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.contracts import AGG_HOURLY_DAILY, AGG_MONTHLY_TAXI
from stratamart.functions.calendar import month_number
from stratamart.functions.measures import COUNT_DIGITS, MONEY_DIGITS, mean, ratio, trip_measures


def hourly_daily(fact: DataFrame) -> DataFrame:
    """Trips by day, hour and source. Groups are few, so nearly all work is map-side."""
    return fact.groupBy(
        "date_key", F.hour("pickup_datetime").alias("pickup_hour"), "taxi_type"
    ).agg(*trip_measures()).select(*AGG_HOURLY_DAILY.columns)


def monthly(fact: DataFrame) -> DataFrame:
    """Trips by month and source, from the fact."""
    when = F.col("pickup_datetime")
    return fact.groupBy(
        month_number(when).alias("month_key"),
        F.year(when).alias("year"),
        F.month(when).alias("month"),
        "taxi_type",
    ).agg(*trip_measures()).select(*AGG_MONTHLY_TAXI.columns)


def monthly_from_hourly(hourly: DataFrame) -> DataFrame:
    """The same rows as :func:`monthly`, rolled up from the hourly mart: the sums are additive,
    so the fact need not be scanned a second time."""
    day = F.col("date_key")
    rolled = hourly.groupBy(
        F.expr("CAST(date_key DIV 100 AS INT)").alias("month_key"),
        F.expr("CAST(date_key DIV 10000 AS INT)").alias("year"),
        F.expr("CAST(date_key DIV 100 % 100 AS INT)").alias("month"),
        "taxi_type",
    ).agg(
        F.sum("trip_count").alias("trip_count"),
        F.sum("total_amount_sum").cast("decimal(18,2)").alias("total_amount_sum"),
        F.sum("passenger_count_sum").alias("passenger_count_sum"),
    )
    return rolled.withColumns(
        {
            "avg_total_amount": decimal_mean("total_amount_sum", "trip_count"),
            "avg_passenger_count": ratio(
                F.col("passenger_count_sum"), F.col("trip_count"), COUNT_DIGITS
            ),
        }
    ).select(*AGG_MONTHLY_TAXI.columns)


def decimal_mean(total: str, rows: str) -> Column:
    """Mean of a DECIMAL(10,2) from its sum and count, equal to ``round(avg(x), 2)``.

    Spark's average of such a decimal keeps six digits before it is rounded to two, half away
    from zero both times. Whole-number arithmetic repeats exactly that.
    """
    cents = f"CAST(abs({total}) * 100 AS DECIMAL(22,0))"
    micros = f"(({cents} * 20000 + {rows}) DIV (2 * {rows}))"
    return F.expr(f"sign({total}) * (({micros} + 5000) DIV 10000) / 100D")


# --- The questions ---------------------------------------------------------------------------


def monthly_mean(mart: DataFrame, source: str) -> DataFrame:
    """Question 1, read from the monthly mart."""
    return (
        mart.filter(F.col("taxi_type") == source)
        .select("year", "month", "avg_total_amount", "trip_count")
        .orderBy("year", "month")
    )


def monthly_mean_from_fact(fact: DataFrame, dates: DataFrame, source: str) -> DataFrame:
    """Question 1, recomputed from the fact. ``dates`` is a calendar, see :func:`days_of`."""
    return (
        fact.filter(F.col("taxi_type") == source)
        .join(dates.select("date_key", "year", "month"), "date_key")
        .groupBy("year", "month")
        .agg(
            mean("total_amount", MONEY_DIGITS).alias("avg_total_amount"),
            F.count("*").alias("trip_count"),
        )
        .orderBy("year", "month")
    )


def days_of(dates: DataFrame, year: int, month: int) -> DataFrame:
    """The at most 31 keys of a month's days: a side that is always small enough to broadcast."""
    one_month = dates.filter((F.col("year") == year) & (F.col("month") == month))
    return F.broadcast(one_month.select("date_key"))


def hourly_passengers(mart: DataFrame, dates: DataFrame, year: int, month: int) -> DataFrame:
    """Question 2 from the hourly mart: a ratio of sums, not a mean of means."""
    return (
        mart.join(days_of(dates, year, month), "date_key")
        .groupBy("pickup_hour")
        .agg(
            ratio(F.sum("passenger_count_sum"), F.sum("trip_count"), COUNT_DIGITS).alias(
                "avg_passengers"
            ),
            F.sum("trip_count").alias("trip_count"),
        )
        .orderBy("pickup_hour")
    )


def hourly_passengers_from_fact(
    fact: DataFrame, dates: DataFrame, year: int, month: int
) -> DataFrame:
    """Question 2, recomputed from the fact; the day keys prune the fact's folders at run time."""
    return (
        fact.join(days_of(dates, year, month), "date_key")
        .groupBy(F.hour("pickup_datetime").alias("pickup_hour"))
        .agg(
            mean("passenger_count", COUNT_DIGITS).alias("avg_passengers"),
            F.count("*").alias("trip_count"),
        )
        .orderBy("pickup_hour")
    )
