"""Questions to the hourly history."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterflow.functions.bands import SEASONS, daypart, season
from meterflow.functions.clock import calendar_parts, local_date
from meterflow.schemas import TOTAL


def for_year(hist: DataFrame, year: int | None) -> DataFrame:
    """Rows of one year. ``year`` is a directory column of the store, so this prunes files."""
    return hist if year is None else hist.where(F.col("year") == year)


def yearly_by_meter(hist: DataFrame) -> DataFrame:
    """Total per year and meter."""
    return hist.groupBy("year", "meterID").agg(F.sum(TOTAL).alias("totalYearlyConsumption"))


def yearly_average(hist: DataFrame) -> DataFrame:
    """Average, per year, of the yearly totals of the meters."""
    return (
        yearly_by_meter(hist)
        .groupBy("year")
        .agg(F.avg("totalYearlyConsumption").alias("averageYearlyConsumption"))
    )


def above_average_consumers(hist: DataFrame, year: int | None = None) -> DataFrame:
    """Meters whose yearly total is at or above the average of their year.

    The average has one row per calendar year, which bounds the broadcast. It is taken
    from the same yearly totals: Spark reuses their shuffle, so history is read once. A
    window over the year would instead move all meters of a year into one task.
    """
    chosen = for_year(hist, year)
    totals = yearly_by_meter(chosen).withColumnRenamed("totalYearlyConsumption", "totalConsumptionInYear")
    above = totals.join(F.broadcast(yearly_average(chosen)), "year").where(
        "totalConsumptionInYear >= averageYearlyConsumption"
    )
    columns = ["meterID", "totalConsumptionInYear", "averageYearlyConsumption"]
    return above.select(*([] if year is not None else ["year"]), *columns)


def above_average_sql(hist: DataFrame, year: int) -> DataFrame:
    """:func:`above_average_consumers` of one year as SQL text.

    The average is a scalar subquery, not a cross join with a one-row table.
    """
    return hist.sparkSession.sql(
        """
        WITH totals AS (
          SELECT meterID, sum(aggregatedActiveDelta) AS totalConsumptionInYear
          FROM {hist} WHERE year = :year GROUP BY meterID
        ), compared AS (
          SELECT *, (SELECT avg(totalConsumptionInYear) FROM totals) AS averageYearlyConsumption FROM totals
        )
        SELECT * FROM compared WHERE totalConsumptionInYear >= averageYearlyConsumption
        """,
        args={"year": year},
        hist=hist,
    )


def top_consumers(hist: DataFrame, n: int = 10, year: int | None = None, per_year: bool = False) -> DataFrame:
    """The ``n`` largest yearly totals, over all years or within each; ties go by meter.

    Within each year Spark keeps the first ``n`` rows per task before it shuffles
    (``WindowGroupLimit``), so no task receives a whole year.
    """
    totals = yearly_by_meter(for_year(hist, year))
    largest = F.desc("totalYearlyConsumption")
    if not per_year:
        return totals.orderBy(largest, "year", "meterID").limit(n)
    ranked = totals.withColumn("rank", F.row_number().over(Window.partitionBy("year").orderBy(largest, "meterID")))
    return ranked.where(F.col("rank") <= n)


def season_hour_profile(hist: DataFrame) -> DataFrame:
    """Average by hour of the day, one column per season, in hour order."""
    names = [name for name, *_ in SEASONS["history"]]
    return (
        hist.withColumn("season", season("month", "history"))
        .groupBy("hour")
        .pivot("season", names)
        .agg(F.avg(TOTAL))
        .orderBy("hour")
    )


def daily_average(hist: DataFrame, tz: str = "UTC") -> DataFrame:
    """Average by day of the month."""
    return (
        calendar_parts(hist, "date", tz, ["day"])
        .groupBy("day")
        .agg(F.avg(TOTAL).alias("averageActiveDelta"))
    )


def daily_by_meter(readings: DataFrame, tz: str = "UTC") -> DataFrame:
    """Total per meter, city and local day; the day is ``yyyy-MM-dd`` text."""
    day = local_date("timestamp", tz).alias("date")
    totals = readings.groupBy("meterID", "cityID", day).agg(F.sum("activeDelta").alias(TOTAL))
    return totals.withColumn("date", F.col("date").cast("string"))


def daypart_profile(hist: DataFrame) -> DataFrame:
    """Sum, average and count by part of the day and quarter season."""
    return hist.groupBy(
        season("month", "quarter").alias("season"), daypart("hour").alias("daypart")
    ).agg(
        F.sum(TOTAL).alias("total"),
        F.avg(TOTAL).alias("average"),
        F.count(TOTAL).alias("n"),
    )
