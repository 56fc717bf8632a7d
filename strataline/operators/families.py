"""One record per family, under explicit preferences; every tie has a defined winner.

Keep-first is an aggregate (``min_by`` of a struct) wherever possible, so that each partition
sends one row per family; a family that holds a third of all rows is no hot task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataline.functions.keys import office_rank
from strataline.functions.text import trim

#: Values of ``seq`` whose rows without any id are numbered together.
STRETCH = 100_000


def first_per_key(df: DataFrame, key: Column, order: list[Column]) -> DataFrame:
    """The first row of each ``key`` by ``order``, which must decide all ties; null is a key."""
    columns = df.columns
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    best = df.groupBy(key.alias("__key")).agg(F.min_by(row, F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])).alias("__row"))
    return best.select(*[F.col("__row").getField(c).alias(c) for c in columns])


def by_office(ids: DataFrame) -> DataFrame:
    """One id per family, best office first, then the earliest; records without family once per id.

    ``ids``: ``id``, ``family_id``, ``country``, ``seq``. Adds ``has_family``.
    """
    family = F.nullif(trim(F.coalesce("family_id", F.lit(""))), F.lit(""))
    rows = ids.select("id", family.alias("family_id"), "country", "seq")
    whole = first_per_key(rows.where("family_id IS NOT NULL"), F.col("family_id"), [office_rank(F.col("country")), F.col("seq")]).withColumn("has_family", F.lit(True))
    single = first_per_key(rows.where("family_id IS NULL"), F.col("id"), [F.col("seq")]).withColumn("has_family", F.lit(False))
    return whole.unionByName(single)


def repaired_family(df: DataFrame) -> DataFrame:
    """``df`` with a blank ``family_id`` replaced by the publication id, else by a numbered placeholder.

    Placeholders count the rows with neither from 0, in order of ``seq`` and by year of publication.
    Only those rows are ranked: within stretches of ``seq``, on top of the number of such rows in the
    stretches before, so that a year of any number of rows is no single task.
    """
    family = F.nullif(F.coalesce("family_id", F.lit("")), F.lit(""))
    own = F.coalesce(family, F.nullif(F.coalesce("patent_id", F.lit("")), F.lit("")))
    year = F.coalesce(F.nullif(F.substring("publication_date", 1, 4), F.lit("")), F.lit("0000"))
    known = df.where(own.isNotNull()).withColumn("family_id", own)
    lost = df.where(own.isNull()).withColumn("__year", year).withColumn("__stretch", F.floor(F.col("seq") / F.lit(STRETCH)))
    sizes = lost.groupBy("__year", "__stretch").agg(F.count("*").alias("n"))
    before = sizes.select("__year", "__stretch", (F.sum("n").over(W.partitionBy("__year").orderBy("__stretch")) - F.col("n")).alias("__before"))
    rank = F.row_number().over(W.partitionBy("__year", "__stretch").orderBy("seq")) - 1
    lost = lost.withColumn("__rank", rank).join(before, ["__year", "__stretch"])
    number = (F.col("__before") + F.col("__rank")).cast("string")
    lost = lost.withColumn("family_id", F.concat(F.lit("UNKNOWN_FAM_"), number, F.lit("_"), F.col("__year"))).select(*df.columns)
    return known.unionByName(lost)


def by_text_and_priority(df: DataFrame, good: Column) -> DataFrame:
    """Per family the record with good text, then the earliest priority (null last), then ``seq``."""
    missing = F.when(F.coalesce(F.col("priority_date"), F.lit("")) == "", 1).otherwise(0)
    return first_per_key(df, F.col("family_id"), [F.when(good, 0).otherwise(1), missing, F.coalesce("priority_date", F.lit("")), F.col("seq")])


def by_publication(df: DataFrame) -> DataFrame:
    """Per family the earliest publication; all blank families are one."""
    return first_per_key(df, F.coalesce("family_id", F.lit("")), [F.coalesce("publication_date", F.lit("~")), F.col("seq")])


def distinct_ids(df: DataFrame, key: str, order: str) -> DataFrame:
    """Each id once, as it came first."""
    return df.groupBy(key).agg(F.min(order).alias(f"first_{order}"))
