"""Timelines and rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataline.functions.text import valid_year
from strataline.operators.families import first_per_key


def timeline(df: DataFrame, family: Column, year: Column, order: list[Column], low: int, high: int) -> DataFrame:
    """``year`` and ``n``: first record of each family, counted by valid year within both bounds."""
    # Only what decides goes through the aggregate.
    slim = df.select(family.alias("family"), year.alias("year"), *[o.alias(f"o{i}") for i, o in enumerate(order)])
    first = first_per_key(slim, F.col("family"), [F.col(f"o{i}") for i in range(len(order))])
    return first.select(valid_year(F.col("year")).alias("year")).where(F.col("year").between(low, high)).groupBy("year").agg(F.count("*").alias("n"))


def top_n(df: DataFrame, keys: list[str], value: Column, n: int) -> DataFrame:
    """The ``n`` groups of greatest ``value``; ties by the keys."""
    return df.groupBy(*keys).agg(value.alias("n")).orderBy(F.desc("n"), *keys).limit(n)
