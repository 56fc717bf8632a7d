"""Bibliographic records from nested JSON: one flat row per exchange document.

JSON is parsed once to VARIANT; nodes may be one or many, with or without a namespace prefix,
objects with ``$`` or bare strings. Everything stays inside the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataline.functions.text import clean
from strataline.lexicons import NO_ABSTRACT, NO_TITLE


def _get(node: str, name: str) -> str:
    return f"try_variant_get({node}, '$[\"{name}\"]', 'variant')"


def _filled(node: str) -> str:
    """SQL: the node, null if it is an empty object, list or text or a JSON null."""
    entries, items = f"size(try_variant_get({node}, '$', 'map<string,variant>'))", f"size(try_variant_get({node}, '$', 'array<variant>'))"
    return (
        f"CASE WHEN is_variant_null({node}) THEN NULL WHEN {entries} IS NOT NULL THEN if({entries} = 0, NULL, {node}) "
        f"WHEN {items} IS NOT NULL THEN if({items} = 0, NULL, {node}) WHEN try_variant_get({node}, '$', 'string') = '' THEN NULL ELSE {node} END"
    )


def _step(node: str, name: str) -> str:
    """SQL: the child ``ops:name`` unless it is absent, or empty beside a child ``name``, else the child ``name``."""
    marked, plain = _get(node, f"ops:{name}"), _get(node, name)
    return f"CASE WHEN {marked} IS NULL THEN {plain} WHEN {plain} IS NULL THEN {marked} ELSE coalesce({_filled(marked)}, {plain}) END"


def _down(df: DataFrame, column: str, start: str, *names: str) -> DataFrame:
    """``df`` with the node reached from column ``start`` by ``names``; every step is a projection of its own, so that none is repeated."""
    df = df.withColumn(column, F.expr(_step(f"`{start}`", names[0])))
    for name in names[1:]:
        df = df.withColumn(column, F.expr(_step(f"`{column}`", name)))
    return df


def _many(node: str) -> str:
    """SQL: the elements of a node that may be one or many; absent and null ones are left out."""
    some = f"coalesce(try_variant_get({node}, '$', 'array<variant>'), array({node}))"
    return f"filter({some}, x -> x IS NOT NULL AND NOT is_variant_null(x))"


def _value(node: str) -> str:
    """SQL: the text of a node, that of its ``$`` or its own; empty if it has none."""
    return f"coalesce(try_variant_get({node}, '$[\"$\"]', 'string'), if(schema_of_variant({node}) LIKE 'OBJECT%' OR schema_of_variant({node}) LIKE 'ARRAY%', NULL, try_variant_get({node}, '$', 'string')), '')"


def _field(node: str, name: str) -> str:
    """SQL: the text of a child that is an object with ``$`` or a bare value."""
    return f"coalesce(try_variant_get({node}, '$[\"{name}\"][\"$\"]', 'string'), if(coalesce(schema_of_variant(try_variant_get({node}, '$[\"{name}\"]', 'variant')), 'VOID') LIKE 'OBJECT%', NULL, try_variant_get({node}, '$[\"{name}\"]', 'string')), '')"


def _english(items: str, text: str) -> str:
    """SQL: the first English element that has text, else the first element."""
    english = f"filter({items}, x -> lower(try_variant_get(x, '$[\"@lang\"]', 'string')) = 'en')"
    first = f"nullif(get(transform({english}, x -> {text}), 0), '')"
    return f"coalesce({first}, get(transform({items}, x -> {text}), 0))"


_DOCDB = "try_variant_get(x, '$[\"@document-id-type\"]', 'string') = 'docdb'"


def documents(df: DataFrame, key: str, body: str) -> DataFrame:
    """``key``, ``doc_no`` and the VARIANT ``d`` of every exchange document; malformed bodies have none.

    A key with the prefix counts before the one without; if it is empty, the other one does.
    """
    parsed = df.select(F.col(f"`{key}`"), F.try_parse_json(F.col(f"`{body}`")).alias("v")).where("v IS NOT NULL")
    found = _down(parsed, "v", "v", "world-patent-data", "exchange-documents", "exchange-document")
    found = found.withColumn("v", F.expr(_filled("v")))
    return found.select(key, F.posexplode(F.expr(_many("v"))).alias("__p", "d")).select(key, (F.col("__p") + 1).alias("doc_no"), "d")


def flattened(df: DataFrame, key: str = "rec_id", body: str = "body", first_form: bool = False) -> DataFrame:
    """One row per exchange document, with the columns of the main table.

    The last ``docdb`` publication id counts; the priority date is the earliest of the ``docdb``
    claims, else the publication date; texts are English where they can be, else the first; codes
    without a known scheme count for both classifications. Missing titles and abstracts have their
    sentinels, other missing texts are empty. ``first_form`` gives the codes of the older run:
    ``cpcs`` has those of every scheme, outer slashes kept, and ``ipcs`` none.
    """
    d = documents(df, key, body)
    d = _down(d, "bib", "d", "bibliographic-data")
    d = _down(d, "titles", "bib", "invention-title")
    d = _down(d, "abstracts", "d", "abstract")
    d = _down(d, "applicants", "bib", "parties", "applicants", "applicant")
    d = _down(d, "ids", "bib", "publication-reference", "document-id")
    d = _down(d, "claims", "bib", "priority-claims", "priority-claim")
    d = _down(d, "classes", "bib", "patent-classifications", "patent-classification")
    nodes = ("titles", "abstracts", "applicants", "ids", "claims", "classes")
    d = d.select(key, "doc_no", F.expr("coalesce(try_variant_get(d, '$[\"@family-id\"]', 'string'), '')").alias("family_id"), *[F.expr(_many(c)).alias(c) for c in nodes])
    # Steps inside lists, too, are projections of their own.
    d = d.withColumn("abstracts", F.expr(f"transform(abstracts, a -> struct(try_variant_get(a, '$[\"@lang\"]', 'string') AS lang, {_step('a', 'p')} AS p, a AS node))"))
    d = d.withColumn("names", F.expr(f"transform(applicants, a -> {_step('a', 'applicant-name')})")).withColumn("names", F.expr(f"transform(names, n -> {_step('n', 'name')})"))
    d = d.withColumn("claims", F.expr(f"flatten(transform(transform(claims, c -> {_step('c', 'document-id')}), c -> {_many('c')}))"))
    # Paragraphs, failing these the text of the abstract itself.
    text = f"if(a.p IS NULL, {_value('a.node')}, array_join(filter(transform({_many('a.p')}, p -> {_value('p')}), t -> t <> ''), ' '))"
    d = d.withColumn("abstracts", F.expr(f"transform(abstracts, a -> struct(a.lang AS lang, {text} AS text))"))
    slash = "" if first_form else "'^/+|/+$'"
    code = f"concat({_field('x', 'section')}, {_field('x', 'class')}, {_field('x', 'subclass')}, {_field('x', 'main-group')}, '/', {_field('x', 'subgroup')})"
    d = d.select(
        key,
        "doc_no",
        "family_id",
        F.expr(f"coalesce(nullif({_english('titles', _value('x'))}, ''), '{NO_TITLE}')").alias("title"),
        F.expr("coalesce(nullif(get(filter(abstracts, a -> lower(a.lang) = 'en'), 0).text, ''), get(abstracts, 0).text)").alias("abstract"),
        F.expr(f"array_join(filter(transform(names, n -> coalesce({_english(_many('n'), _value('x'))}, '')), t -> t <> ''), ' | ')").alias("applicant"),
        F.expr(f"get(reverse(filter(ids, x -> {_DOCDB})), 0)").alias("id"),
        F.expr(f"array_min(filter(transform(filter(claims, x -> {_DOCDB}), x -> {_field('x', 'date')}), t -> t <> ''))").alias("priority"),
        F.expr(
            f"transform(classes, x -> struct({code if first_form else f'regexp_replace({code}, {slash}, {chr(39) * 2})'} AS code, "
            "upper(coalesce(try_variant_get(x, '$[\"ops:classification-scheme\"][\"@scheme\"]', 'string'), try_variant_get(x, '$[\"classification-scheme\"][\"@scheme\"]', 'string'), "
            "try_variant_get(x, '$[\"classification-scheme\"]', 'string'), '')) AS scheme))"
        ).alias("codes"),
    )

    def joined(scheme: str) -> Column:
        # A scheme that names CPC is that whatever else it names.
        own = "TRUE" if first_form else "c.scheme LIKE '%CPC%' OR c.scheme NOT LIKE '%IPC%'" if scheme == "CPC" else "c.scheme NOT LIKE '%CPC%'"
        return F.expr(f"array_join(array_sort(array_distinct(transform(filter(codes, c -> length(c.code) > 2 AND ({own})), c -> c.code))), ', ')")

    part = lambda name: F.expr(f"if(id IS NULL, '', {_field('id', name)})")
    d = d.select("*", part("country").alias("country"), F.replace(part("doc-number"), F.lit("."), F.lit("")).alias("number"), part("kind").alias("kind"), part("date").alias("publication_date"))
    abstract = F.nullif(clean(F.coalesce("abstract", F.lit(""))), F.lit(""))
    return d.select(
        key,
        "doc_no",
        F.concat("country", "number", "kind").alias("patent_id"),
        "country",
        "number",
        "kind",
        "family_id",
        F.coalesce("priority", "publication_date").alias("priority_date"),
        "publication_date",
        "applicant",
        "title",
        F.coalesce(abstract, F.lit(NO_ABSTRACT)).alias("abstract"),
        F.lit("").alias("ipcs") if first_form else joined("IPC").alias("ipcs"),
        joined("CPC").alias("cpcs"),
    )


def with_second_chance(df: DataFrame, others: DataFrame, key: str = "patent_id") -> DataFrame:
    """``df`` with missing abstracts taken from ``others`` (``key``, ``abstract``; the smallest text if several)."""
    known = others.where(F.col("abstract").isNotNull() & (F.col("abstract") != NO_ABSTRACT)).groupBy(key).agg(F.min("abstract").alias("__other"))
    own = F.nullif(F.nullif("abstract", F.lit(NO_ABSTRACT)), F.lit(""))
    return df.join(known, key, "left").withColumn("abstract", F.coalesce(own, "__other", F.lit(NO_ABSTRACT))).drop("__other")


def quota(headers: DataFrame, weekly_mb: float = 4000.0) -> DataFrame:
    """Quota figures from response headers: ``traffic``, ``week_used``, ``hour_used`` (bytes as text)."""
    rpm = F.regexp_extract("traffic", r"search=\w+:(\d+)", 1).try_cast("int")
    used = F.coalesce(F.nullif(F.trim("week_used"), F.lit("")), F.nullif(F.trim("hour_used"), F.lit("")), F.lit("0")).try_cast("bigint")
    mb = F.coalesce(used, F.lit(0)) / F.lit(1024.0 * 1024.0)
    percent = mb / F.lit(weekly_mb) * 100
    status = F.when(percent >= 100, "EXHAUSTED").when(F.coalesce("traffic", F.lit("")).contains("overloaded"), "OVERLOADED").otherwise("OK")
    return headers.select("*", F.round(mb, 6).alias("used_mb"), F.round(percent, 6).alias("used_pct"), F.round(F.greatest(F.lit(0.0), 100 - percent), 6).alias("left_pct"), rpm.alias("search_rpm"), status.alias("status"))
