"""Ordered rules over text signals: the first condition that holds gives the label.

A classification is one narrow projection: no shuffle, one regular expression per signal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataline import lexicons as L
from strataline.functions.text import search_text


def matches(c: Column, pattern: str) -> Column:
    """Unicode-aware, case-insensitive search; null doesn't match."""
    return F.coalesce(c, F.lit("")).rlike(f"(?iU)(?:{pattern})")


def any_word(patterns: tuple[str, ...]) -> str:
    return rf"\b(?:{'|'.join(patterns)})\b"


def signals(title: Column, abstract: Column, cpcs: Column, ipcs: Column) -> dict[str, Column]:
    """The boolean signals of a record: text, anchor, forbidden, agri, diag."""
    text = search_text(title, abstract)
    anchor = lambda c: F.coalesce(c, F.lit("")).contains(L.ANCHOR)
    return {
        "text": matches(text, "|".join(L.SIGNAL)),
        "anchor": anchor(cpcs) | anchor(ipcs),
        "forbidden": matches(text, any_word(L.FORBIDDEN)),
        "agri": matches(text, any_word(L.AGRI)),
        "diag": matches(text, any_word(L.DIAGNOSTIC)) & ~matches(text, any_word(L.TREATMENT)),
    }


def tier(s: Column, a: Column, f: Column, g: Column, d: Column) -> Column:
    """The label of a combination of signals; the order of the rules decides overlaps."""
    conditions = (
        s & a & ~f & ~g & ~d,
        s & ~a & ~f & ~g & ~d,
        ~s & a & ~f & ~g & ~d,
        s & f & ~d,
        d,
        g & a & ~d,
        ~s & ~a & ~g & ~d,
        g & ~a & ~d,
    )
    label = F.lit(L.UNCLASSIFIED)
    for condition, name in reversed(list(zip(conditions, L.TIERS))):
        label = F.when(condition, name).otherwise(label)
    return label


def classified(df: DataFrame) -> DataFrame:
    """``df`` with its signals and ``tier``; no row is dropped."""
    made = signals(F.col("title"), F.col("abstract"), F.col("cpcs"), F.col("ipcs"))
    rows = df.select("*", *[c.alias(f"has_{k}") for k, c in made.items()])
    return rows.withColumn("tier", tier(*[F.col(f"has_{k}") for k in ("text", "anchor", "forbidden", "agri", "diag")]))


def tier_counts(df: DataFrame) -> DataFrame:
    """Every label in order with its count, labels without rows too, and a bar of a block per hundred."""
    labels = [*L.TIERS, L.UNCLASSIFIED]
    spark = df.sparkSession
    dim = spark.createDataFrame([(i, t) for i, t in enumerate(labels)], "tier_ord int, tier string")
    counts = df.groupBy("tier").agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0))
    return dim.join(counts, "tier", "left").select("tier_ord", "tier", n.cast("long").alias("n_patents"), F.repeat(F.lit("█"), (n / 100).cast("int")).alias("bar"))


def run_counts(df: DataFrame, review: Column) -> DataFrame:
    """One row: ``n_records`` and ``n_review``, the records that somebody must look at."""
    return df.agg(F.count("*").alias("n_records"), F.count_if(review).alias("n_review"))


def heading(tier: str, n: int) -> str:
    """The first cell of a section's heading row."""
    return f"--- {tier.upper()} ({n} patents) ---"


def sectioned(df: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of every labelled tier below a heading row; rows of no tier are left out.

    All columns are strings; headings stand in the first column. Order: ``tier_ord``, ``is_row``, ``seq``.
    """
    order = F.array_position(F.array(*[F.lit(t) for t in L.TIERS]), F.col("tier")).cast("int") - 1
    rows = df.where(F.col("tier") != L.UNCLASSIFIED).withColumn("tier_ord", order)
    body = rows.select("tier_ord", F.lit(1).alias("is_row"), "seq", *[F.col(c).cast("string").alias(c) for c in columns])
    heads = rows.groupBy("tier_ord", "tier").agg(F.count("*").alias("n")).select(
        "tier_ord",
        F.lit(0).alias("is_row"),
        F.lit(0).cast("long").alias("seq"),
        F.concat(F.lit("--- "), F.upper("tier"), F.lit(" ("), F.col("n").cast("string"), F.lit(" patents) ---")).alias(columns[0]),
        *[F.lit("").alias(c) for c in columns[1:]],
    )
    return heads.unionByName(body)
