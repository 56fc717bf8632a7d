"""Adaptive time slices: the coarsest granule whose count stays within the source's cap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def time_slices(df: DataFrame, when: Column, cap: int) -> DataFrame:
    """Slices ``level`` (year, month, day), ``first_day``, ``last_day``, ``n``, ``truncated``.

    A year within the cap is one slice, else its months are, else their days; a day above the cap
    is a slice and marked. Rows are counted by day once; months and years add the days up.
    """
    days = df.select(F.to_date(when).alias("d")).where("d IS NOT NULL").groupBy("d").agg(F.count("*").alias("n"))
    # From here on a row is a day. One exchange by year serves both windows and the last aggregate.
    days = days.withColumn("y", F.trunc("d", "year")).withColumn("m", F.trunc("d", "month")).repartition("y")
    days = days.withColumn("n_year", F.sum("n").over(W.partitionBy("y"))).withColumn("n_month", F.sum("n").over(W.partitionBy("y", "m")))
    level = F.when(F.col("n_year") <= cap, "year").when(F.col("n_month") <= cap, "month").otherwise("day")
    days = days.withColumn("level", level).withColumn("first_day", F.when(F.col("level") == "year", F.col("y")).when(F.col("level") == "month", F.col("m")).otherwise(F.col("d")))
    made = days.groupBy("y", "level", "first_day").agg(F.sum("n").alias("n"))
    last = F.when(F.col("level") == "year", F.last_day(F.add_months("first_day", 11))).when(F.col("level") == "month", F.last_day("first_day")).otherwise(F.col("first_day"))
    return made.select("level", "first_day", last.alias("last_day"), "n", (F.col("n") > cap).alias("truncated"))


def pages(slices: DataFrame, page: int = 100, cap: int = 2000) -> DataFrame:
    """``first_day``, ``page_no``, ``range_begin``, ``range_end`` of every page of every slice."""
    n = F.least("n", F.lit(cap))
    starts = F.explode(F.sequence(F.lit(0), F.ceil(n / page).cast("int") - 1)).alias("page_no")
    return slices.where("n > 0").select("level", "first_day", n.alias("n"), starts).select(
        "level", "first_day", "page_no", (F.col("page_no") * page + 1).cast("long").alias("range_begin"), F.least((F.col("page_no") + 1) * page, F.col("n")).cast("long").alias("range_end")
    )
