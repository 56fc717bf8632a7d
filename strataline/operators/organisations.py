"""Organisations behind packed applicant cells: normalise, reject, unify, count."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataline import lexicons as L
from strataline.functions.text import fold, trim


def normalised(c: Column) -> Column:
    """A name in the form that is compared; the order of the steps matters.

    Upper case, without bracketed country, accents and marks; ``&`` reads AND, a leading THE goes,
    UNIV is spelt out, words of a legal form go wherever they stand.
    """
    name = F.regexp_replace(F.upper(trim(c)), r"\[.*?\]", "")
    name = F.regexp_replace(fold(name), r"[,.()]", "")
    name = F.replace(F.replace(F.replace(name, F.lit("-"), F.lit(" ")), F.lit("'"), F.lit("")), F.lit("&"), F.lit("AND"))
    name = F.regexp_replace(name, r"^THE\s+", "")
    name = F.regexp_replace(name, r"\bUNIV\b", "UNIVERSITY")
    name = F.regexp_replace(name, rf"\b(?:{L.LEGAL_WORDS})\b", "")
    return F.trim(F.regexp_replace(name, r"[\s\x1c-\x1f]+", " "))


def acceptable(name: Column) -> Column:
    """Not empty, with a letter, and none of the listed persons."""
    return name.rlike("[A-Z]") & ~name.rlike("|".join(L.PERSONS))


def unified(name: Column) -> Column:
    """The organisation of the first listed part found in the name, else the name."""
    return reduce(lambda rest, pair: F.when(name.contains(pair[0]), pair[1]).otherwise(rest), reversed(L.ORGANISATIONS), name)


def facts(df: DataFrame) -> DataFrame:
    """``family_id``, ``company``, ``priority_date``: each organisation of a record once, full credit each.

    A narrow projection: repeats inside a cell go while it is an array, so that nothing is
    shuffled. Null applicants have no rows; repeated records each have theirs.
    """
    rows = df.where("applicant IS NOT NULL").select("seq", "family_id", "priority_date", F.array_distinct(F.split("applicant", r"\|")).alias("parts"))
    rows = rows.withColumn("names", F.array_distinct(F.transform("parts", normalised)))
    rows = rows.withColumn("companies", F.array_distinct(F.transform(F.filter("names", acceptable), unified)))
    return rows.select("seq", "family_id", F.explode("companies").alias("company"), "priority_date")


def top(df: DataFrame, n: int) -> DataFrame:
    """Organisations by number of families, then name; null families count as one."""
    counted = df.groupBy("company").agg(
        F.countDistinct(F.coalesce("family_id", F.lit("nan"))).alias("n_families"), F.min(F.nullif("priority_date", F.lit(""))).alias("earliest")
    )
    return counted.orderBy(F.desc("n_families"), "company").limit(n)
