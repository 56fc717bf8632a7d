"""The usual runs from end to end: search, curate, classify, analyse."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strataline.functions import text as T
from strataline.lexicons import AGRI_TITLE, COMPETITOR, NO_ABSTRACT, TIERS
from strataline.operators import analytics, biblio, families, organisations, rules
from strataline.sources import delimited, remote

#: Columns of the main table, as files name them.
RAW_COLUMNS = ["Patent_ID", "Country", "Number", "Kind", "Family_ID", "Priority_Date", "Publication_Date", "Applicant", "Title", "Abstract", "IPCs", "CPCs"]
#: Columns of the older run's table.
FIRST_COLUMNS = ["patent_id", "publication_date", "applicant", "title", "link", "warning", "cpcs", "family_id", "seq"]
CLASSIFIED_COLUMNS = ["patent_id", "priority_date", "publication_date", "applicant", "title", "abstract", "link", "tier", "needs_review", "warning", "ipcs", "cpcs", "family_id"]


def present(df: DataFrame, columns: list[str]) -> DataFrame:
    """Those of ``columns`` that ``df`` has, in this order."""
    return df.select(*[f"`{c}`" for c in columns if c in df.columns])


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """A delimited main table with lower-case names and ``seq`` in file order."""
    df = delimited.read(spark, path, RAW_COLUMNS).toDF(*[c.lower() for c in RAW_COLUMNS])
    return df.withColumn("seq", F.monotonically_increasing_id())


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows in order of arrival."""
    return df.orderBy("seq").limit(n) if "seq" in df.columns else df.limit(n)


def search(spark: SparkSession, queries: list[str], first: int, last: int, **options: str) -> DataFrame:
    """One id per family over all queries and years: the ids whose details are worth fetching."""
    remote.register(spark)
    found = spark.read.format("patent_search").options(queries=json.dumps(queries), firstyear=str(first), lastyear=str(last), **options).load()
    return families.by_office(found)


def fetch(ids: DataFrame, folder: str, batch: int = remote.BATCH, /, **options: str) -> DataFrame:
    """Flat records of ``ids`` with ``seq``, missing abstracts asked for a second time by themselves.

    Answers are written below ``folder`` as they come and read from there, so that nothing is asked
    for twice, however often the result is used.
    """
    spark = ids.sparkSession

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    details = kept(remote.records(ids, "id", options, "biblio", batch), "details").where("body IS NOT NULL")
    flat = biblio.flattened(details, "first_id", "body").withColumn("docdb", F.concat_ws(".", *[F.nullif(c, F.lit("")) for c in ("country", "number", "kind")]))
    lacking = flat.where((F.col("abstract") == NO_ABSTRACT) & (F.col("docdb") != ""))
    again = kept(remote.records(lacking.select(F.col("docdb").alias("id")), "id", options, "abstract", 1), "abstracts").where("body IS NOT NULL")
    others = biblio.flattened(again, "first_id", "body").select(F.col("first_id").alias("docdb"), "abstract")
    whole = biblio.with_second_chance(flat, others, "docdb").drop("docdb")
    return kept(whole.withColumn("seq", F.monotonically_increasing_id()).drop("first_id", "doc_no"), "flat")


def first_run(flat: DataFrame) -> DataFrame:
    """The older run over flat records of ``first_form``: no titles of other fields, the earliest publication of each family, linked and flagged."""
    kept = flat.where(~F.coalesce(F.col("title").rlike(f"(?iu){AGRI_TITLE}"), F.lit(False)))
    rows = families.by_publication(kept)
    flag = F.when(F.coalesce(F.col("title"), F.lit("")).rlike(f"(?iu){COMPETITOR}"), "Check Tech").otherwise("")
    link = T.record_link(F.col("country"), F.col("number"), F.col("kind"))
    return present(rows.withColumn("warning", flag).withColumn("link", link), FIRST_COLUMNS)


def second_run(spark: SparkSession, queries: list[str], first: int, last: int, folder: str, /, **options: str) -> DataFrame:
    """The newer run: search, one id per family, fetch, repair and curate; the raw table below ``folder`` by year."""
    curated = curate(fetch(search(spark, queries, first, last, **options), folder, remote.BATCH, **options))
    delimited.write_by_year(curated, f"{folder}/years")
    return curated


def curate(flat: DataFrame) -> DataFrame:
    """Flat records with ``seq``: family ids repaired, then the best text and priority of each family."""
    return families.by_text_and_priority(families.repaired_family(flat), T.good_text(F.col("title"), F.col("abstract")))


def classify(raw: DataFrame) -> DataFrame:
    """Every record with its link, tier and review flag; the warning only where the input has one."""
    rows = rules.classified(raw)
    rows = rows.withColumn("link", T.record_link(F.col("country"), F.col("number"), F.col("kind"))).withColumn("needs_review", T.needs_review(F.col("title"), F.col("abstract")))
    return present(rows, [*CLASSIFIED_COLUMNS, "seq"])


def write_classified(raw: DataFrame, path: str, single_file: bool = False) -> None:
    """The classified records below their headings, as delimited files.

    A folder per section in the order of the tiers (``section=0`` first), in it the heading
    (``is_row=0``) and the records (``is_row=1``), as many files as there are partitions. Records are
    classified and written in one pass, which counts them for the headings. ``single_file``: one
    ordered file instead, written by one task, for results that fit there.
    """
    rows = classify(raw)
    columns = [c for c in rows.columns if c != "seq"]
    if single_file:
        ordered = rules.sectioned(rows, columns).orderBy("tier_ord", "is_row", "seq")
        delimited.write(ordered.select(*columns).coalesce(1), path)
        return
    seen = Observation()
    counts = [F.count_if(F.col("tier") == t).alias(f"n{i}") for i, t in enumerate(TIERS)]
    section = F.array_position(F.array(*[F.lit(t) for t in TIERS]), F.col("tier")).cast("int") - 1
    body = rows.observe(seen, *counts).where(F.col("tier").isin(list(TIERS)))
    delimited.write(body.select(*columns, section.alias("section"), F.lit(1).alias("is_row")), path, by=("section", "is_row"))
    sizes = seen.get
    heads = [(rules.heading(t, sizes[f"n{i}"]), i) for i, t in enumerate(TIERS) if sizes[f"n{i}"]]
    if heads:
        made = raw.sparkSession.createDataFrame(heads, "head string, section int").coalesce(1)
        filled = made.select(F.col("head").alias(columns[0]), *[F.lit("").alias(c) for c in columns[1:]], "section", F.lit(0).alias("is_row"))
        delimited.write(filled, path, by=("section", "is_row"), add=True)


def timeline(raw: DataFrame, first: int = 2000, last: int = 2026) -> DataFrame:
    """Families by year, in order."""
    year = T.year(F.col("priority_date"), F.col("publication_date"))
    return analytics.timeline(delimited.require(raw, ["family_id", "priority_date"]), F.col("family_id"), year, [F.col("seq")], first, last).orderBy("year")


def top_applicants(raw: DataFrame, n: int = 100) -> DataFrame:
    """Organisations by number of families."""
    return organisations.top(organisations.facts(delimited.require(raw, ["applicant", "family_id", "priority_date"])), n)
