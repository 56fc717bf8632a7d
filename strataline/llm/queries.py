"""Queries of the training-data operators, by problem."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataline.functions.keys import is_missing, office_rank, plain_family
from strataline.llm.bpe import encoded, token_counts
from strataline.llm.langid import Model, fit, identified, languages, training_sample
from strataline.llm.names import entities, entity_pairs
from strataline.llm.packing import fill_report, packed
from strataline.llm.pii import found
from strataline.llm.pii_examples import trained
from strataline.llm.skeleton import disguised, look_alikes
from strataline.llm.survivors import Bundle, choose_rows, survivors, unbeaten
from strataline.session import table

Query = Callable[[SparkSession, str], DataFrame]


#: A table of more codes than this is none of languages, and refused.
MOST_LANGUAGES = 10_000
#: Text columns of patents_raw with the columns of their labels.
LABELLED = {"title": "title_lang", "abstract": "abstract_lang"}


def _language_model(spark: SparkSession, sf_dir: str) -> Model:
    """Trained on a bounded sample of labelled documents: at most 300 texts per language."""
    sample = training_sample(table(spark, sf_dir, "documents"), "text", "lang", "doc_id")
    return fit([(r["lang"], r["text"], r["rank"]) for r in sample.collect()])


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "patents_raw")
    held = raw.select("seq", *[F.when(~is_missing(F.col(t)), F.col(t)).alias(t) for t in LABELLED], *LABELLED.values())
    return identified(held, ["seq"], LABELLED, _language_model(spark, sf_dir))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The languages of every title and abstract that is unlabelled, labelled wrongly or mixed."""
    codes = [r["lang"] for r in table(spark, sf_dir, "lang_codes").select("lang").where("lang IS NOT NULL").distinct().limit(MOST_LANGUAGES + 1).collect()]
    if len(codes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} language codes")
    label = F.lower(F.trim(F.coalesce("label", F.lit(""))))
    rows = _segments(spark, sf_dir).select("seq", "field", label.alias("label"), languages(F.col("segments")).alias("langs"))
    case = ~F.col("label").isin(codes) | (F.size("langs") > 1) | ~F.array_contains("langs", F.col("label"))
    return rows.where(case).select("seq", "field", F.explode("langs").alias("lang"))


def p1_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every title and abstract by segments, each with its language and confidence."""
    parts = F.posexplode("segments").alias("segment", "s")
    return _segments(spark, sf_dir).select("seq", "field", parts).select("seq", "field", "segment", "s.lang", "s.confidence", "s.start_pos", "s.end_pos")


def _entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entities(table(spark, sf_dir, "applicant_names"), "name_id", "applicant_name", "country")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each pair of spellings of one entity."""
    return entity_pairs(_entities(spark, sf_dir))


def p2_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entity of every spelling."""
    return _entities(spark, sf_dir)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every applicant or title that isn't in its plain form."""
    return disguised(table(spark, sf_dir, "patents_raw"), ["seq"], ["applicant", "title"]).select("seq", "field")


def p5_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applicants and titles that look alike, by skeleton."""
    return look_alikes(table(spark, sf_dir, "patents_raw"), ["applicant", "title"])


def _abstract_length() -> Column:
    return F.when(is_missing(F.col("abstract")), 0).otherwise(F.length("abstract"))


#: Microseconds since 1970, whatever the zone of the session.
ARRIVED = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(loaded_at AS TIMESTAMP_NTZ))"


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row of each family that no other row beats in abstract, office or arrival."""
    trusts = {"abstract": _abstract_length(), "office": -office_rank(F.col("country")), "recency": F.expr(ARRIVED)}
    best = unbeaten(table(spark, sf_dir, "patents_raw"), plain_family(F.col("family_id")), trusts, "seq")
    return best.where("at_root").select(F.col("group").alias("family_id"), "seq")


def p6_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One surviving record per family, bundle by bundle, title and abstract of rows of one language.

    A row's language is its title's label, failing that its abstract's, as its SQL has it. The
    labels of the two texts themselves may differ; ``p6_consistent`` has them equal.
    """
    lang = F.lower(F.trim(F.coalesce("title_lang", "abstract_lang", F.lit(""))))
    return _survivors(spark, sf_dir, dict.fromkeys(LABELLED, lang))


def p6_consistent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One surviving record per family, bundle by bundle, title and abstract labelled alike.

    Each text has its own label; null and blank ones are unknown, which agrees with unknown only.
    """
    return _survivors(spark, sf_dir, {k: F.lower(F.trim(F.coalesce(c, F.lit("")))) for k, c in LABELLED.items()})


def _survivors(spark: SparkSession, sf_dir: str, lang: dict[str, Column]) -> DataFrame:
    """The most complete values; of those as complete the ones of the better office, then the later ones."""
    raw, family = table(spark, sf_dir, "patents_raw"), plain_family(F.col("family_id"))
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    text = lambda c: F.when(~is_missing(F.col(c)), F.length(c))
    codes = F.when(~blank("ipcs") | ~blank("cpcs"), F.length(F.coalesce("ipcs", F.lit(""))) + F.length(F.coalesce("cpcs", F.lit(""))))
    # Fields of a bundle are taken from one row together.
    bundles = {
        "abstract": Bundle(text("abstract"), ("abstract", "abstract_lang"), {"text_lang": lang["abstract"]}),
        "title": Bundle(text("title"), ("title", "title_lang"), {"text_lang": lang["title"]}),
        "office": Bundle(F.when(~blank("patent_id"), 1000.0 - 100 * office_rank(F.col("country"))), ("patent_id", "country", "number", "kind", "publication_date", "priority_date")),
        "codes": Bundle(codes, ("ipcs", "cpcs")),
        "applicant": Bundle(F.when(~blank("applicant"), F.length("applicant")), ("applicant",)),
    }
    chosen = choose_rows(raw, family, bundles, [-office_rank(F.col("country")), F.expr(ARRIVED)])
    return survivors(raw, family, chosen.drop("nodes"), bundles).withColumnRenamed("group", "family_id")


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token ids of every document."""
    return encoded(table(spark, sf_dir, "documents"), "doc_id", "text")


def p7_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, tokens and empty documents per source."""
    counts = token_counts(table(spark, sf_dir, "documents"), "source", "text")
    return counts.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), F.count_if(F.col("n_tokens") == 0).alias("n_empty"))


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in a container of each capacity.

    The opening line of a letter or note is what a reader is given and bears no loss.
    """
    return _containers(spark, sf_dir)


def _containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    opening = F.when(F.col("doc_kind").isin("letter", "note"), F.regexp_extract("text", r"^[^\n]*\n", 0))
    sized = token_counts(documents.select("doc_id", "text", opening.alias("opening")), "doc_id", "text", "opening")
    return packed(sized, table(spark, sf_dir, "pack_limits"), documents.count())


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers of each capacity are."""
    return fill_report(_containers(spark, sf_dir), table(spark, sf_dir, "pack_limits"))


def _redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found(table(spark, sf_dir, "documents"), "doc_id", "text", *trained())


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each item of personal information in the documents."""
    return _redacted(spark, sf_dir).select("doc_id", F.inline("spans"))


def p9_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents with typed placeholders in place of personal information."""
    return _redacted(spark, sf_dir).select("doc_id", "redacted", F.size("spans").alias("n_items"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (p1_found, p1_segments, p2_found, p2_entities, p5_found, p5_groups, p6_found, p6_survivors, p6_consistent, p7_ids, p7_lengths, p8_containers, p8_fill, p9_found, p9_redacted)}
