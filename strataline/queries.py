"""Queries over the tables of a scale-factor folder: one entry per operator.

Each takes ``(spark, sf_dir)`` and runs over whole tables with production parameters. The SQL
that says the same is in ``strataline.sql``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataline import lexicons as L
from strataline.functions import text as T
from strataline.functions.keys import office_rank
from strataline.operators import analytics, biblio, families, organisations, rules
from strataline.operators.nested import link, node_tables
from strataline.operators.packed import explode_packed
from strataline.plans import slices, terms
from strataline.sources import remote
from strataline.session import table

Query = Callable[[SparkSession, str], DataFrame]


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values of every packed cell, with positions."""
    return explode_packed(table(spark, sf_dir, "patents_raw"), ["seq"], {"applicant": "names", "ipcs": "codes", "cpcs": "codes"})


def _linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "exchange_documents")
    return link(node_tables(raw, "rec_id", "body"), "rec_id", {"document": "", "applicant": "document"})


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the record bodies with its own and its parent's position."""
    return _linked(spark, sf_dir).select(
        "rec_id",
        F.col("document_no").alias("doc_no"),
        F.col("kind").alias("node"),
        F.when(F.col("kind") == "name", F.col("applicant_no")).otherwise(0).cast("int").alias("parent_no"),
        F.col("no").alias("node_no"),
    )


def p4_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of applicant names with the interval labels of their applicant and document."""
    nodes = _linked(spark, sf_dir).where("kind = 'name'")
    return nodes.select("rec_id", F.col("document_pre"), F.col("applicant_pre"), "pre", "post", "lang", "text")


def _patents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "patents_raw")


def top_applicants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hundred organisations of most families."""
    return organisations.top(organisations.facts(_patents(spark, sf_dir)), 100)


def entity_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every different applicant part with its normalised form."""
    parts = _patents(spark, sf_dir).where("applicant IS NOT NULL").select(F.explode(F.split("applicant", r"\|")).alias("part")).distinct()
    return parts.select("part", organisations.normalised(F.col("part")).alias("name"))


def canonical_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every different normalised applicant, beside names that hold a listed organisation's key, and what it is unified to."""
    parts = _patents(spark, sf_dir).where("applicant IS NOT NULL").select(F.explode(F.split("applicant", r"\|")).alias("part")).distinct()
    names = parts.select(organisations.normalised(F.col("part")).alias("name")).distinct()
    keys = spark.createDataFrame([(f"THE {key} X",) for key, _ in L.ORGANISATIONS], "name string")
    return names.unionByName(keys).select("name", organisations.unified(F.col("name")).alias("company"))


def explode_applicants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per organisation and record."""
    return organisations.facts(_patents(spark, sf_dir))


def timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Families by year of their first record, 2000 to 2026."""
    return analytics.timeline(_patents(spark, sf_dir), F.col("family_id"), T.year(F.col("priority_date"), F.col("publication_date")), [F.col("seq")], 2000, 2026)


def timeline_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by year of their first order."""
    year = F.date_format("o_orderdate", "yyyy")
    return analytics.timeline(table(spark, sf_dir, "orders"), F.col("o_custkey"), year, [F.col("o_orderdate"), F.col("o_orderkey")], 1995, 2001)


def tier_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record with its signals and label."""
    return rules.classified(_patents(spark, sf_dir)).select("seq", "has_text", "has_anchor", "has_forbidden", "has_agri", "has_diag", "tier")


def tier_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all labels, empty ones too."""
    return rules.tier_counts(rules.classified(_patents(spark, sf_dir)))


def tier_compat_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the labels that a sectioned file shows."""
    return rules.classified(_patents(spark, sf_dir)).where(F.col("tier") != L.UNCLASSIFIED).groupBy("tier").agg(F.count("*").alias("n"))


def sectioned_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows below headings, all columns strings."""
    return rules.sectioned(rules.classified(_patents(spark, sf_dir)), ["patent_id", "title", "family_id"])


def tier_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of records made of the documents by rule, so that every combination of signals occurs."""
    d, pick = F.col("doc_id"), lambda c, text: F.when(c, text).otherwise("")
    bit = lambda b: F.col("doc_id").bitwiseAND(F.lit(b)) != 0
    marks = [pick(bit(1), "siRNA "), pick(bit(4), "CRISPR "), pick(bit(8), "maize "), pick(bit(16), "biomarker "), pick(d % 5 == 0, "siRNAs "), pick(d % 5 == 1, "mRNA vaccine "), pick(d % 5 == 2, "treatment "), pick(d % 5 == 3, "tomato cell ")]
    body = F.concat(F.lit("<p>"), *marks, F.lit(" [0001] "), F.coalesce("text", F.lit("")), F.lit("</p>"))
    made = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(d % 17 != 0, F.substring("text", 1, 60)).alias("title"),
        F.when(d % 11 == 0, L.NO_ABSTRACT).when(d % 19 == 0, "").otherwise(body).alias("abstract"),
        F.when(bit(2), "A61K31/713, C12N15/1135").otherwise("A61K31/713").alias("cpcs"),
        F.lit("A61K31/713").alias("ipcs"),
    )
    return rules.classified(made).select("doc_id", "has_text", "has_anchor", "has_forbidden", "has_agri", "has_diag", "tier")


def run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records, and those that somebody must look at."""
    return rules.run_counts(_patents(spark, sf_dir), T.needs_review(F.col("title"), F.col("abstract")))


def needs_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality flags of every record."""
    title, abstract = F.col("title"), F.col("abstract")
    return _patents(spark, sf_dir).select(
        "seq", T.no_abstract(abstract).alias("lacks_abstract"), T.non_ascii(title).alias("non_ascii"), T.good_text(title, abstract).alias("good"), T.needs_review(title, abstract).alias("review")
    )


def non_ascii_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by language and whether they hold other than ASCII."""
    flag = T.non_ascii(F.col("text")).alias("non_ascii")
    return table(spark, sf_dir, "documents").groupBy("lang", flag).agg(F.count("*").alias("n"))


def good_text_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per repaired family: good text first, then the earliest priority."""
    rows = families.repaired_family(_patents(spark, sf_dir).select("seq", "patent_id", "family_id", "priority_date", "publication_date", "title", "abstract"))
    good = T.good_text(F.col("title"), F.col("abstract"))
    slim = rows.withColumn("good", good).drop("title", "abstract")
    return families.by_text_and_priority(slim, F.col("good")).select("family_id", "seq", "good", "priority_date")


def family_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One id per family by office, and the ids without family."""
    return families.by_office(table(spark, sf_dir, "id_records")).select("id", "family_id", "country", "seq", "has_family")


def orders_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most urgent, then earliest order of each customer."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate")
    return families.first_per_key(orders, F.col("o_custkey"), [F.col("o_orderpriority"), F.col("o_orderdate"), F.col("o_orderkey")])


def blank_family_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record with a family id."""
    return families.repaired_family(_patents(spark, sf_dir).select("seq", "patent_id", "family_id", "publication_date"))


def earliest_publication(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per family the earliest publication that isn't of another field, flagged and linked."""
    rows = _patents(spark, sf_dir).select("seq", "patent_id", "country", "number", "kind", "family_id", "publication_date", "title")
    kept = rows.where(~F.coalesce(F.col("title").rlike(f"(?iu){L.AGRI_TITLE}"), F.lit(False)))
    first = families.by_publication(kept)
    flag = F.when(F.coalesce(F.col("title"), F.lit("")).rlike(f"(?iu){L.COMPETITOR}"), "Check Tech").otherwise("")
    link_ = T.record_link(F.col("country"), F.col("number"), F.col("kind"))
    return first.select("seq", "family_id", "publication_date", flag.alias("warning"), link_.alias("link"))


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Abstracts without tags, paragraph numbers and superfluous blanks."""
    return _patents(spark, sf_dir).select("seq", T.clean(F.col("abstract")).alias("abstract"))


def accent_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents folded to ASCII."""
    return table(spark, sf_dir, "documents").select("doc_id", T.fold(F.col("text")).alias("folded"))


def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum of a property in JSON by event type."""
    value = F.expr("try_variant_get(try_parse_json(props), '$.k', 'int')")
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.sum(value).alias("total"), F.count(value).alias("n"))


def biblio_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flat row per exchange document."""
    return biblio.flattened(table(spark, sf_dir, "exchange_documents"))


def abstract_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat rows with missing abstracts taken from the main table."""
    flat = biblio.flattened(table(spark, sf_dir, "exchange_documents"))
    return biblio.with_second_chance(flat, _patents(spark, sf_dir).select("patent_id", "abstract"))


def first_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat rows with the codes of the older run."""
    return biblio.flattened(table(spark, sf_dir, "exchange_documents"), first_form=True).select("rec_id", "doc_no", "patent_id", "title", "applicant", "cpcs")


def detail_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of all ids, fetched in batches from a service that refuses ids without kind."""
    ids = table(spark, sf_dir, "id_records").select(F.when(F.col("seq") % 7 == 0, F.regexp_replace("id", r"\.[^.]*$", "")).otherwise(F.col("id")).alias("id"))
    found = remote.records(ids, "id", {"transport": "echo", "parallel": str(spark.sparkContext.defaultParallelism)})
    return biblio.flattened(found.where("body IS NOT NULL"), "first_id", "body").select("country", "number", "kind", "patent_id")


def term_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search terms in the source's language."""
    sample = [*dict.fromkeys([*L.BLOCK_TERMS, *L.SINGLE_TERMS]), "gene silencing therapy", "two  words"]
    return spark.createDataFrame([(t,) for t in sample], "term string").select("term", terms.formatted(F.col("term")).alias("query"))


def query_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compiled block queries of three years."""
    return terms.block_queries(spark, 2000, 2002)


def query_compile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compiled independent queries."""
    return terms.single_queries(spark)


def query_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Independent queries for one applicant as they stand in an address."""
    return terms.single_queries(spark, "Foo & Bar").select("ord", T.url_quote(F.col("query")).alias("encoded"))


def time_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices of the events within a cap of two hundred."""
    return slices.time_slices(table(spark, sf_dir, "events"), F.col("ts"), 200)


def time_slices_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices of the orders within a cap of two thousand."""
    return slices.time_slices(table(spark, sf_dir, "orders"), F.col("o_orderdate"), 2000)


def page_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of the order slices."""
    return slices.pages(time_slices_orders(spark, sf_dir))


def id_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each id once, with its first arrival."""
    return families.distinct_ids(table(spark, sf_dir, "id_records"), "id", "seq")


def dedup_savings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ids against different ones."""
    return table(spark, sf_dir, "id_records").agg(F.count("*").alias("n_raw"), F.countDistinct("id").alias("n_ids"), (F.count("*") - F.countDistinct("id")).alias("saved"))


def events_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different pairs of user and event type."""
    return table(spark, sf_dir, "events").select("user_id", "event_type").distinct()


def topn_generic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty parts of most order lines."""
    return analytics.top_n(table(spark, sf_dir, "lineitem"), ["l_partkey"], F.count("*"), 20)


def group_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different parts and the earliest shipping by supplier."""
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.countDistinct("l_partkey").alias("n_parts"), F.min("l_shipdate").alias("first_ship"))


QUOTA_HEADERS = [
    (1, "busy (images=green:100, search=green:30, retrieval=green:200)", "2147483648", "1048576"),
    (2, "overloaded (search=red:5)", "", "1048576"),
    (3, None, None, None),
    (4, "idle (search=yellow:15)", "4294967296", ""),
    (5, "idle", "n/a", "7"),
]


def quota_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quota figures of response headers."""
    headers = spark.createDataFrame(QUOTA_HEADERS, "n int, traffic string, week_used string, hour_used string")
    return biblio.quota(headers).select("n", "used_mb", "used_pct", "left_pct", "search_rpm", "status")


def office_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by position of their office."""
    return _patents(spark, sf_dir).groupBy(office_rank(F.col("country")).alias("office")).agg(F.count("*").alias("n"))


_ALL = (
    p3_found, p4_found, p4_names, top_applicants, entity_normalise, canonical_map, explode_applicants, timeline, timeline_orders, tier_classify, tier_summary,
    tier_compat_drop, sectioned_output, tier_view, run_counts, first_flatten, detail_fetch, query_urls, needs_review, non_ascii_documents, good_text_dedup, family_by_country, orders_by_priority, blank_family_repair,
    earliest_publication, clean_text, accent_fold, json_extract, biblio_flatten, abstract_fallback, term_format, query_blocks, query_compile, time_slices,
    time_slices_orders, page_plan, id_dedup, dedup_savings, events_distinct, topn_generic, group_distinct, quota_status, office_order,
)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in _ALL}
