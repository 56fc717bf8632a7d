"""Delimited files: semicolons, header, UTF-8 with a byte-order mark, quotes doubled, lines inside quotes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strataline.functions.text import trim

OPTIONS = {"sep": ";", "header": "true", "multiLine": "true", "quote": '"', "escape": '"', "encoding": "UTF-8"}


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` if it has all ``columns``; a ValueError that names the missing ones otherwise."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def existing(spark: SparkSession, path: str) -> str:
    """``path`` if there is anything; a FileNotFoundError that names it otherwise."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(place):
        raise FileNotFoundError(path)
    return path


def read(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All columns as strings, so that leading zeros stay; empty values are null; the mark at the start is ignored."""
    schema = StructType([StructField(c, StringType()) for c in columns])
    df = spark.read.options(**OPTIONS).option("enforceSchema", "true").schema(schema).csv(existing(spark, path))
    return df.select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in columns])


def write(df: DataFrame, path: str, mark: bool = True, by: tuple[str, ...] = (), add: bool = False) -> None:
    """One folder of delimited files, or one for each value of ``by``; nulls as empty values.

    Files are written in parallel. The byte-order mark, where asked for, is the first character
    of the header of every file.
    """
    columns = [c for c in df.columns if c not in by]
    out = df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(("\ufeff" if mark and i == 0 else "") + c) for i, c in enumerate(columns)], *by)
    writer = out.write.mode("append" if add else "overwrite").options(**OPTIONS).option("emptyValue", "")
    (writer.partitionBy(*by) if by else writer).csv(path)


def write_by_year(df: DataFrame, path: str, date: str = "publication_date") -> None:
    """Parquet by year, replacing only the years that ``df`` holds."""
    year = F.coalesce(F.nullif(F.substring(trim(F.col(date)), 1, 4), F.lit("")), F.lit("none"))
    df.withColumn("year", year).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path)


def output_name(path: str, prefix: str) -> str:
    """``prefix`` put before the file name, in the same folder."""
    folder, _, name = path.rpartition("/")
    return f"{folder}/{prefix}{name}" if folder else f"{prefix}{name}"
