"""Compiling terms and codes to the query language of the remote source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataline import lexicons as L


def formatted(term: Column) -> Column:
    """``ta=`` of a quoted phrase or a single word as it is, of other phrases all words with AND."""
    quoted = (F.length(term) > 1) & term.startswith('"') & term.endswith('"')
    words = F.filter(F.split(term, r"\s+"), lambda w: w != "")
    return F.when(quoted | ~term.contains(" "), F.concat(F.lit("ta="), term)).otherwise(F.concat(F.lit("ta=("), F.array_join(words, " AND "), F.lit(")")))


def block_queries(spark: SparkSession, first: int, last: int, per_block: int = 2, applicant: str | None = None) -> DataFrame:
    """``year``, ``block``, ``query``: terms in blocks, any of a block, and one of the class codes."""
    terms = spark.createDataFrame([(i // per_block, i, t) for i, t in enumerate(L.BLOCK_TERMS)], "block int, ord int, term string")
    blocks = terms.groupBy("block").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", formatted(F.col("term")).alias("q")))), lambda x: x["q"]), " OR ").alias("any"))
    codes = " OR ".join(f"cpc={c}" for c in L.BLOCK_CODES)
    tail = F.lit(f' AND pa="{applicant}"' if applicant else "")
    years = blocks.select("*", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("year"))
    query = F.concat(F.lit("("), F.col("any"), F.lit(f") AND ({codes})"), tail, F.lit(" AND pd="), F.col("year").cast("string"))
    return years.select("year", "block", query.alias("query"))


def single_queries(spark: SparkSession, applicant: str | None = None) -> DataFrame:
    """``ord`` and ``query``: one independent query per code and term, each without the excluded classes."""
    excluded = f" NOT ({' OR '.join(f'cpc={chr(34)}{c}{chr(34)}' for c in L.EXCLUDED_CODES)})"
    heads = [f'cpc=/low "{c}"' for c in L.SINGLE_LOW_CODES] + [f'ipc="{c}"' for c in L.SINGLE_IPC_CODES] + [f"ta={t}" for t in L.SINGLE_TERMS]
    rows = spark.createDataFrame(list(enumerate(heads)), "ord int, head string")
    tail = F.lit(f' AND pa="{applicant}"' if applicant else "")
    return rows.select("ord", F.concat(F.lit("("), "head", F.lit(f"{excluded})"), tail).alias("query"))
